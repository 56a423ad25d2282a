"""Stage statistics: each is one aggregation that returns one row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F


def _total(c: Column) -> Column:
    return F.coalesce(F.sum(c.cast("bigint")), F.lit(0)).cast("bigint")


def stage_rows(df: DataFrame, stage: str, decimals: int = 2) -> DataFrame:
    """Rows of a stage, and in millions."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(stage).alias("stage"),
        "n_rows",
        F.round(F.col("n_rows") / F.lit(1e6), decimals).alias("n_rows_m"),
    )


def observe_rows(df: DataFrame, stage: str) -> tuple[DataFrame, Observation]:
    """Count rows while another action runs over the returned frame."""
    seen = Observation(stage)
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows")), seen


def filter_token_stats(df: DataFrame, n: int, tokens: Column | None = None) -> DataFrame:
    """Rows and tokens before, after and dropped by the token gate.

    ``tokens`` is the token count per row; a stored count column spares reading the arrays.
    """
    size = F.size("input_ids") if tokens is None else tokens
    kept = F.when(size >= n, size)
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count(kept).alias("rows_after"),
        _total(size).alias("tokens_before"),
        _total(kept).alias("tokens_after"),
    ).withColumn("tokens_dropped", F.col("tokens_before") - F.col("tokens_after"))


def tail_stats(df: DataFrame, sequence_len: int, tokens: Column | None = None) -> DataFrame:
    """Full chunks and the tokens lost in the incomplete last one."""
    size = F.size("input_ids") if tokens is None else tokens
    return df.agg(_total(size).alias("tokens")).select(
        "tokens",
        F.call_function("div", F.col("tokens"), F.lit(sequence_len)).alias("full_chunks"),
        (F.col("tokens") % F.lit(sequence_len)).cast("bigint").alias("tail_tokens"),
    )


def packed_stats(packed: DataFrame) -> DataFrame:
    """Packed rows, tokens, and tokens in billions."""
    return packed.agg(
        F.count(F.lit(1)).alias("packed_rows"), _total(F.size("input_ids")).alias("tokens")
    ).withColumn("tokens_b", F.round(F.col("tokens") / F.lit(1e9), 3))


def wrong_lengths(packed: DataFrame, sequence_len: int) -> DataFrame:
    """Position and length of every packed row that is not ``sequence_len`` long."""
    size = F.size("input_ids")
    return packed.filter(size != sequence_len).select("chunk", size.alias("n_tokens"))


def length_audit(packed: DataFrame, sequence_len: int) -> DataFrame:
    """One row: rows, wrong rows, first and last wrong position, all-correct flag.

    The positions themselves are a table, :func:`wrong_lengths`; they are not gathered in one row.
    """
    wrong = F.when(F.size("input_ids") != sequence_len, F.col("chunk"))
    return packed.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(wrong).alias("wrong_rows"),
        F.min(wrong).alias("first_wrong"),
        F.max(wrong).alias("last_wrong"),
    ).withColumn("all_correct", F.col("wrong_rows") == 0)


def stage_report(stages: list[tuple[str, DataFrame]]) -> DataFrame:
    """One row per number: ``stage, metric, value, number`` from one-row statistics frames.

    ``value`` holds integers, and flags as 0 or 1; ``number`` also what has decimals (millions and
    billions), where ``value`` is null.
    """

    def long_form(stage: str, stats: DataFrame) -> DataFrame:
        kinds = {f.name: f.dataType.simpleString() for f in stats.schema}

        def pair(name: str) -> Column:
            whole = F.lit(None) if kinds[name] == "double" else F.col(name)
            number = F.col(name).cast("int" if kinds[name] == "boolean" else kinds[name]).cast("double")
            return F.struct(
                F.lit(name).alias("metric"), whole.cast("bigint").alias("value"), number.alias("number")
            )

        numbers = [n for n, kind in kinds.items() if kind in ("bigint", "int", "double", "boolean")]
        pairs = stats.select(F.explode(F.array(*map(pair, numbers))).alias("m"))
        return pairs.select(F.lit(stage).alias("stage"), "m.*")

    return reduce(DataFrame.unionByName, [long_form(s, d) for s, d in stages])


def vocab_stats(vocab: DataFrame, added: DataFrame) -> DataFrame:
    """Vocabulary size and whether it is a multiple of 64."""
    ids = vocab.select("id").unionByName(added.select("id"))
    return ids.agg(F.count_distinct("id").alias("vocab_size")).withColumn(
        "multiple_of_64", F.col("vocab_size") % 64 == 0
    )
