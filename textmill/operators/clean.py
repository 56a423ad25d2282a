"""Cleaning and the character gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from textmill.functions.text import coalesce_text, drop_invalid_utf8, strip_ws, text_or_null

MIN_CHARS = 100


def clean_text(df: DataFrame, col: str = "text") -> DataFrame:
    """Missing text to "", strip, then drop bytes that are not UTF-8.

    Lone surrogates are not UTF-8 either, so the last step removes them as well. Stripping happens
    first and is not repeated.
    """
    return df.withColumn(col, drop_invalid_utf8(strip_ws(coalesce_text(text_or_null(df, col)))))


def min_chars(df: DataFrame, n: int = MIN_CHARS, col: str = "text") -> DataFrame:
    """Keep rows with at least ``n`` code points."""
    return df.filter(F.char_length(col) >= n)
