"""Small tables of proven size taken from large ones without gathering candidates of every task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def smallest_hashes(rows: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` rows with the smallest hash of ``key``. Of a large table only rows below a hash
    that about ``2 n`` rows fall short of are sorted."""
    own = F.xxhash64(key)
    total = rows.count()
    if total > 4 * n:
        rows = rows.filter(own < int(-(2**63) + 2**64 * (2 * n / total)))
    return rows.orderBy(own, key).limit(n)


def frequency_class(column: str) -> Column:
    return F.floor(F.log2(column) * 8)


def least_class(counts: DataFrame, column: str, most: int) -> int | None:
    """The lowest class of ``column`` from which on at most ``most`` rows are left; None: no class.
    There are some hundred classes, whatever the size of the table."""
    least, total = None, 0
    for row in sorted(counts.groupBy(frequency_class(column).alias("c")).count().collect(), reverse=True):
        total += row["count"]
        if total > most:
            break
        least = row["c"]
    return least
