"""Shuffled split, micro-batches and steps over a packed table.

The shuffle order is the MD5 of seed and row number, so it is the same on every run and for every
partitioning. Row numbers alone are ranked, inside hash buckets; bucket counts give the rank before
each bucket. The ranks are joined to the rows by row number, which is unique and never null: token
arrays move once and are never sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from textmill.functions.tokens import IGNORED_LABEL, lm_labels

BUCKET_DIGITS = 4  # 65,536 buckets, so the bucket table is always small
TEST_FRACTION = 0.001


def shuffle_key(seed, row: Column) -> Column:
    return F.md5(F.concat_ws("-", F.lit(str(seed)), row.cast("string")))


def _bucket(key: Column) -> Column:
    return F.substring(key, 1, BUCKET_DIGITS)


def _bases(keyed: DataFrame, within: list[str]) -> DataFrame:
    """``[*within, _bucket, load, base, total]``; at most 65,536 rows per value of ``within``."""
    counts = keyed.groupBy(*within, _bucket(F.col("_key")).alias("_bucket")).agg(
        F.count(F.lit(1)).alias("load")
    )
    everything = Window.partitionBy(*within)
    earlier = everything.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("base", F.coalesce(F.sum("load").over(earlier), F.lit(0))).withColumn(
        "total", F.sum("load").over(everything)
    )


def train_test_split(
    df: DataFrame, frac: float = TEST_FRACTION, seed: int = 0, row: str = "chunk"
) -> DataFrame:
    """Add ``split``: ``test`` for the first ``ceil(frac * n)`` rows in shuffle order.

    Rows do not move. The cut lies inside one bucket; the key at the cut is found from row numbers
    alone, and every row is then compared with it.
    """
    keyed = df.withColumn("_key", shuffle_key(seed, F.col(row)))
    narrow = keyed.select("_key", row)
    bases = _bases(narrow, []).withColumn("_k", F.ceil(F.col("total") * F.lit(frac)))
    open_bucket = bases.filter("base < _k and base + load > _k")
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy("_key", row))
    cut = (
        narrow.withColumn("_bucket", _bucket(F.col("_key")))
        .join(F.broadcast(open_bucket), "_bucket")
        .withColumn("_place", F.col("base") + place)
        .filter("_place = _k")
        .select("_bucket", F.col("_key").alias("_cut_key"), F.col(row).alias("_cut_row"))
    )
    cuts = bases.join(F.broadcast(cut), "_bucket", "left").select(
        "_bucket", (F.col("base") + F.col("load") <= F.col("_k")).alias("_all"), "_cut_key", "_cut_row"
    )
    before_cut = F.struct(F.col("_key"), F.col(row)) <= F.struct(
        F.col("_cut_key").alias("_key"), F.col("_cut_row").alias(row)
    )
    is_test = F.col("_all") | (F.col("_cut_key").isNotNull() & before_cut)
    return (
        keyed.withColumn("_bucket", _bucket(F.col("_key")))
        .join(F.broadcast(cuts), "_bucket")
        .withColumn("split", F.when(is_test, F.lit("test")).otherwise(F.lit("train")))
        .select(*df.columns, "split")
    )


def split_sizes(df: DataFrame, frac: float = TEST_FRACTION) -> DataFrame:
    """Rows in each part, from the row count alone."""
    n = df.agg(F.count(F.lit(1)).alias("n_rows"))
    test = F.ceil(F.col("n_rows") * F.lit(frac)).cast("bigint")
    return n.select(
        "n_rows", test.alias("test_rows"), (F.col("n_rows") - test).alias("train_rows")
    )


#: Bucket tables up to this number of rows are broadcast; there are 65,536 per epoch.
BROADCAST_ROWS = 1 << 20


def _ranked(keyed: DataFrame, within: list[str], row: str, groups: int = 1) -> DataFrame:
    """Add ``_rank`` (0-based shuffle position) and ``total`` to the narrow ``[*within, _key, row]``;
    ``groups``: values of ``within``."""
    keys = [*within, "_bucket"]
    bases = _bases(keyed.select(*within, "_key"), within).drop("load")
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("_key", row))
    return (
        keyed.withColumn("_bucket", _bucket(F.col("_key")))
        .join(F.broadcast(bases) if groups << 16 <= BROADCAST_ROWS else bases, keys)
        .withColumn("_rank", F.col("base") + place - 1)
    )


def _batched(ranked: DataFrame, batch_rows: int) -> DataFrame:
    size = F.lit(batch_rows).cast("bigint")
    return (
        ranked.withColumn("batch", F.call_function("div", F.col("_rank"), size))
        .withColumn("slot", (F.col("_rank") % size).cast("int"))
        .withColumn("_batches", F.call_function("div", F.col("total"), size))
        .filter(F.col("batch") < F.col("_batches"))
    )


def micro_batches(df: DataFrame, batch_rows: int = 1, seed: int = 0, row: str = "chunk") -> DataFrame:
    """Add ``batch`` and ``slot`` in shuffle order; the incomplete last batch is dropped."""
    keyed = df.select(row, shuffle_key(seed, F.col(row)).alias("_key"))
    placed = _batched(_ranked(keyed, [], row), batch_rows).select(row, "batch", "slot")
    return df.join(placed.hint("shuffle_hash"), row).select(*df.columns, "batch", "slot")


def assign_steps(
    df: DataFrame,
    batch_rows: int = 1,
    accum: int = 1,
    epochs: int = 1,
    seed: int = 0,
    row: str = "chunk",
) -> DataFrame:
    """Add ``epoch, step, micro, batch, slot``; every epoch is shuffled with its own key.

    ``accum`` batches make one step; a step never spans two epochs. Steps are numbered through.
    """
    key = F.md5(F.concat_ws("-", F.lit(str(seed)), F.col("epoch"), F.col(row)))
    per_epoch = df.select(row, F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"))
    batched = _batched(_ranked(per_epoch.withColumn("_key", key), ["epoch"], row, epochs), batch_rows)
    size = F.lit(accum).cast("bigint")
    steps = F.call_function("div", F.col("_batches") + size - 1, size)
    placed = batched.select(
        row,
        "epoch",
        (F.col("epoch") * steps + F.call_function("div", F.col("batch"), size)).alias("step"),
        (F.col("batch") % size).cast("int").alias("micro"),
        "batch",
        "slot",
    )
    return df.join(placed.hint("shuffle_hash"), row).select(*df.columns, *placed.columns[1:])


def flatten_batches(df: DataFrame) -> DataFrame:
    """One row per batch: its sequences end to end, with what attention needs to keep them apart.

    ``labels`` ignore the first token of each sequence, ``position_ids`` restart per sequence,
    ``seq_idx`` numbers the sequences, ``cu_seq_lens`` are their borders. A group has ``batch_rows``
    sequences.
    """
    sequences = df.groupBy("batch").agg(
        F.sort_array(F.collect_list(F.struct("slot", "input_ids"))).alias("_s")
    ).select("batch", F.col("_s.input_ids").alias("_ids"))
    ids = F.col("_ids")

    def labels(s: Column) -> Column:
        rest = F.slice(s, F.lit(2), F.greatest(F.size(s) - 1, F.lit(0)))
        return F.when(F.size(s) > 0, F.concat(F.array(F.lit(IGNORED_LABEL)), rest)).otherwise(s)

    def positions(s: Column) -> Column:
        return F.transform(s, lambda _, i: i)

    borders = F.aggregate(
        ids,
        F.array(F.lit(0)),
        lambda acc, s: F.concat(acc, F.array(F.element_at(acc, -1) + F.size(s))),
    )
    return sequences.select(
        "batch",
        F.flatten(ids).alias("input_ids"),
        F.flatten(F.transform(ids, labels)).alias("labels"),
        F.flatten(F.transform(ids, positions)).alias("position_ids"),
        F.flatten(F.transform(ids, lambda s, i: F.array_repeat(i, F.size(s)))).alias("seq_idx"),
        borders.alias("cu_seq_lens"),
        F.array_max(F.transform(ids, lambda s: F.size(s))).alias("max_length"),
    )


def with_labels(df: DataFrame, pad: int | None) -> DataFrame:
    """Add ``labels``: the ids, pad positions ignored."""
    return df.withColumn("labels", lm_labels("input_ids", pad))
