"""Exact deduplication where the first row in order survives."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from textmill.operators.clean import MIN_CHARS, min_chars
from textmill.storage import stage_table


#: Losers up to this number are sent to every task; a row is an order key of some 50 bytes.
BROADCAST_ROWS = 500_000
#: A group with very many copies is compared by so many tasks.
SALTS = 16


def dedup_first(
    df: DataFrame, order: list[str], key: str = "text", exact: bool = False
) -> DataFrame:
    """Keep the first row in ``order`` for each value of ``key``.

    Digest and order key are aggregated with partial sums per task, so a text that makes up a third
    of the table costs one row per task. The order keys of all later copies are staged and counted;
    rows are anti-joined with them by the order key, which is unique. Where the copies are few, they
    are broadcast and no text moves. Digests and order keys are staged, so the texts are read twice: for
    the digests, and for the result. ``exact=True`` groups by the value itself instead of its SHA-256.
    """
    group = F.col(key) if exact else F.unhex(F.sha2(F.col(key), 256))
    narrow = df.select(group.alias("_group"), F.struct(*order).alias("_at"))
    if not exact:
        narrow = stage_table(narrow, "digests")
    # groups with one row have no copies; null values are a group of their own
    groups = narrow.groupBy("_group").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    copied = groups.filter("_n > 1").select(
        F.col("_group").alias("_copied"), "_first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_to")
    )
    salt = F.pmod(F.xxhash64("_at"), F.lit(SALTS)).cast("int")
    match = F.col("_group").eqNullSafe(F.col("_copied")) & (F.col("_salt") == F.col("_to"))
    later = narrow.withColumn("_salt", salt).join(copied, match).filter("_at <> _first").select("_at.*")
    later = stage_table(later, "copies")
    few = later.count() <= BROADCAST_ROWS
    return df.join(F.broadcast(later) if few else later, order, "left_anti")


def quality_and_unique(
    df: DataFrame, order: list[str], n: int = MIN_CHARS, exact: bool = False
) -> DataFrame:
    """Length gate first, so short texts never compete, then :func:`dedup_first`."""
    return dedup_first(min_chars(df, n), order, exact=exact)
