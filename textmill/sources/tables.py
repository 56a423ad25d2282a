"""Packed tables and vocabularies on disk."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Vocabulary:
    """Three small tables; none has more rows than the vocabulary size asked for.

    ``vocab(id, bytes, token)``, ``merges(rank, left, right, id)`` and
    ``added(id, token, special, normalized, unk, pad, eos)``.
    """

    vocab: DataFrame
    merges: DataFrame
    added: DataFrame


def write_packed(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_vocab(tables: Vocabulary, path: str) -> None:
    for name in ("vocab", "merges", "added"):
        getattr(tables, name).coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")


def read_vocab(spark: SparkSession, path: str) -> Vocabulary:
    """Read a saved vocabulary and check that its ids are 0..n-1, each once."""
    tables = Vocabulary(*(spark.read.parquet(f"{path}/{n}") for n in ("vocab", "merges", "added")))
    ids = tables.vocab.select("id").unionByName(tables.added.select("id"))
    seen = ids.selectExpr(
        "count(1) as n", "count(distinct id) as d", "min(id) as lo", "max(id) as hi"
    ).first()
    if seen.n == 0 or seen.d != seen.n or seen.lo != 0 or seen.hi != seen.n - 1:
        raise ValueError(f"broken vocabulary in {path}: {seen.asDict()}")
    return tables
