"""Explicit row order.

An order key is a list of columns ``[*lead, row]``. ``row`` is an integer that rises inside each
combination of the lead columns (source, file, block); the whole key is unique and never null.
Positions are found from sums per bucket of ``row``, and these from a tree of sums: however many
files there are and however sparse the rows, no window holds more than ``FAN`` sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from textmill.storage import stage_table

BUCKET_ROWS = 128
#: Sums that one window may hold; a power of two.
FAN = 8192
BUCKET = "_bucket"


def floor_div(c: Column, size: int) -> Column:
    """Integer floor division, exact for every BIGINT, negative ones included."""
    c = c.cast("bigint")
    return F.call_function("div", c - F.pmod(c, F.lit(size)), F.lit(size).cast("bigint"))


def bucket_of(order: list[str], bucket_rows: int = BUCKET_ROWS) -> Column:
    return floor_div(F.col(order[-1]), bucket_rows)


def _before(partition: list[str], by: list[str]):
    return (
        Window.partitionBy(*partition)
        .orderBy(*by)
        .rowsBetween(Window.unboundedPreceding, -1)
    )


def running_sums(sums: DataFrame, by: list[str], load: str, name: str) -> DataFrame:
    """Add ``name``: the sum of ``load`` over all rows before, in the order of the unique key ``by``.

    Up to ``FAN`` rows are one window. Beyond that, rows are dealt to ranges of the key and sorted; a
    node is ``FAN`` neighbours at most. The sums of the nodes are running sums of the same kind, one
    level up, and inside a node a window adds what lies before.
    """
    staged = stage_table(sums, "sums")
    n = staged.count()
    if n <= FAN:
        return staged.withColumn(name, F.coalesce(F.sum(load).over(_before([], by)), F.lit(0)))
    ordered = staged.repartitionByRange(max(n // (16 * FAN), 1), *by).sortWithinPartitions(*by)
    # ids rise inside a task and from task to task, in the order of the ranges
    node, above = f"{name}_node", f"{name}_above"
    own = F.shiftright(F.monotonically_increasing_id(), FAN.bit_length() - 1)
    placed = stage_table(ordered.withColumn(node, own), "placed")
    nodes = placed.groupBy(node).agg(F.sum(load).cast("bigint").alias("_load"))
    upper = running_sums(nodes, [node], "_load", above).drop("_load")
    inside = F.coalesce(F.sum(load).over(_before([node], by)), F.lit(0))
    return placed.join(upper, node).withColumn(name, F.col(above) + inside).drop(node, above)


def _bucket_sums(df: DataFrame, weight: Column, order: list[str], bucket_rows: int) -> DataFrame:
    """``[*lead, _bucket, load]``: weight inside each bucket."""
    keys = [*order[:-1], bucket_of(order, bucket_rows).alias(BUCKET)]
    return df.groupBy(*keys).agg(F.sum(weight).cast("bigint").alias("load"))


def bucket_bases(
    df: DataFrame, weight: Column, order: list[str], bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """``[*lead, _bucket, load, base]``: weight inside each bucket and before it."""
    sums = _bucket_sums(df, weight, order, bucket_rows)
    return running_sums(sums, [*order[:-1], BUCKET], "load", "base")


def with_start(
    df: DataFrame,
    weight: Column,
    order: list[str],
    name: str = "start",
    bucket_rows: int = BUCKET_ROWS,
    moved: DataFrame | None = None,
) -> DataFrame:
    """Add the weight of all earlier rows as ``name``, plus ``_bucket``, ``base`` and ``load``.

    ``df`` is read twice, for the sums and for the rows, so it should be a staged table. The join and the window share the bucket as key, so rows move once.
    ``moved`` has the same rows in the form in which they move.
    """
    lead = order[:-1]
    keys = [*lead, BUCKET]
    bases = bucket_bases(df, weight, order, bucket_rows)
    earlier = F.coalesce(F.sum(weight).over(_before(keys, [order[-1]])), F.lit(0))
    return (
        (df if moved is None else moved).withColumn(BUCKET, bucket_of(order, bucket_rows))
        .join(bases, keys)
        .withColumn(name, F.col("base") + earlier)
    )


def spread(df: DataFrame, order: list[str]) -> DataFrame:
    """Spread the rows of a scan that has fewer tasks than the cluster has cores.

    That is the case for a few files with few row groups; a large table is returned unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *order) if df.rdd.getNumPartitions() < cores else df


def first_rows(
    df: DataFrame, n: int, order: list[str], bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """The first ``n`` rows in order, without sorting or gathering the table.

    Buckets that begin at or after position ``n`` are dropped first; only the rows of the
    remaining ones are numbered.
    """
    lead = order[:-1]
    keys = [*lead, BUCKET]
    if n <= 100_000:
        # every bucket holds at least one row, so at most n buckets begin before position n
        first = _bucket_sums(df, F.lit(1), order, bucket_rows).orderBy(*keys).limit(n)
        base = F.coalesce(F.sum("load").over(_before([], keys)), F.lit(0))
        bases = F.broadcast(first.withColumn("base", base).filter(F.col("base") < n))
    else:
        bases = bucket_bases(df, F.lit(1), order, bucket_rows).filter(F.col("base") < n)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(order[-1]))
    return (
        df.withColumn(BUCKET, bucket_of(order, bucket_rows))
        .join(bases, keys)
        .withColumn("_rank", F.col("base") + rank)
        .filter(F.col("_rank") <= n)
        .select(*df.columns)
    )
