"""Token gate and selection by position."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

MIN_TOKENS = 150


def min_tokens(df: DataFrame, n: int = MIN_TOKENS, ids: str = "input_ids") -> DataFrame:
    """Keep rows with at least ``n`` tokens, the end token counted."""
    return df.filter(F.size(ids) >= n)


def select_rows(df: DataFrame, positions: DataFrame, order: list[str]) -> DataFrame:
    """Keep the rows whose order key appears in ``positions``."""
    return df.join(positions.select(*order), order, "left_semi")
