"""Corpus pipeline: quality, lines, near-duplicates, mixture, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``docs`` holds the columns of
``documents``. Every stage but the last returns those columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from textmill.llm import line_dedup, lsh_forest, mixing, quality_fm, sos_packing
from textmill.llm.queries import KEEP_SCORE, METADATA, vocabulary
from textmill.storage import stage_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier rejects (score below ``KEEP_SCORE``) go."""
    docs = docs.select(COLUMNS)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    machine = quality_fm.fit(docs, labels, metadata=METADATA)
    scored = quality_fm.score(docs, machine, metadata=METADATA, name="_score")
    return scored.filter(F.col("_score") >= KEEP_SCORE).select(COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of lines go; a document that has lost every line goes too."""
    cleaned = line_dedup.dedup_lines(docs.select(COLUMNS))
    left = (F.col("_n_removed") == 0) | (F.col("_n_removed") < F.col("_n_lines"))
    n_chars = F.when(F.col("_n_removed") > 0, F.char_length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return cleaned.filter(left).withColumn("n_chars", n_chars).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    found = lsh_forest.near_duplicates(docs)  # shingles of five words, similarity 0.8 or more
    key, version = F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.xxhash64("text")
    gone = found.filter("not first").select(key.alias("_id"), F.col("version").alias("_version")).distinct()
    keyed = docs.select(COLUMNS).withColumns({"_id": key, "_version": version})
    # a row that repeats id and text is a copy as well
    left = keyed.join(stage_table(gone, "duplicates"), ["_id", "_version"], "left_anti")
    return left.dropDuplicates(["_id", "_version"]).select(COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources near their target weights: a document stands as often as it has copies."""
    mixed = mixing.mix(docs.select(COLUMNS)).filter("_copies > 0")
    return mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select(COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sos_packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality", quality),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("packing", packing),
]

#: A factorisation machine cannot be fitted in SQL; ``tests/llm`` holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; each result is written once and read by the next stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
