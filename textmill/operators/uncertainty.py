"""Loss, entropy and candidates per token over a table of logits.

Input columns: ``seq_id, pos, target, logits`` and, for surfaces, ``text, start, end``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from textmill.functions import scores
from textmill.operators.order import floor_div
from textmill.operators.tokenize import TokenLookup
from textmill.sources.tables import Vocabulary

PART_ROWS = 8192
RESET = "\x1b[0m"


def token_loss(df: DataFrame, mode: str = "raw") -> DataFrame:
    """Add ``loss``: the score of the token at the same position, negated."""
    return df.withColumn("loss", scores.token_loss("logits", "target", mode))


def token_entropy(df: DataFrame) -> DataFrame:
    """Add ``entropy`` of the softmax, natural log."""
    return df.withColumn("entropy", scores.token_entropy("logits"))


def candidates(df: DataFrame, k: int = 5, descending: bool = False) -> DataFrame:
    """Add ``candidates``: ids of the ``k`` lowest scores, or highest with ``descending``."""
    return df.withColumn("candidates", scores.candidates("logits", k, descending))


def token_text(df: DataFrame) -> DataFrame:
    """Add ``token``, the text between the character offsets."""
    return df.withColumn("token", scores.token_text("text", "start", "end"))


def score_tokens(
    df: DataFrame, mode: str = "raw", k: int = 5, descending: bool = False
) -> DataFrame:
    """All scores in one pass over the logits, which are dropped."""
    return candidates(token_entropy(token_loss(df, mode)), k, descending).drop("logits")


def minmax_by_seq(
    df: DataFrame, columns: tuple[str, ...] = ("entropy", "loss"), part_rows: int = PART_ROWS
) -> DataFrame:
    """Add ``<c>_min`` and ``<c>_max`` over the whole sequence.

    A sequence is aggregated in parts of ``part_rows`` positions and joined back by part, so even
    one that holds a third of the table is spread over many tasks.
    """
    parted = df.withColumn("_part", floor_div(F.col("pos"), part_rows))
    keys = ["seq_id", "_part"]
    sides = [(f"{c}_{f}", f, c) for c in columns for f in ("min", "max")]
    parts = parted.groupBy(*keys).agg(*[getattr(F, f)(c).alias(n) for n, f, c in sides])
    whole = parts.groupBy("seq_id").agg(*[getattr(F, f)(n).alias(n) for n, f, _ in sides])
    ranges = parts.select(*keys).join(whole, "seq_id")
    return parted.join(ranges, keys).select(*df.columns, *[n for n, _, _ in sides])


def shade(df: DataFrame) -> DataFrame:
    """Add ``entropy_shade`` and ``loss_shade`` from the ranges of :func:`minmax_by_seq`."""

    def of(c: str) -> Column:
        return scores.shade(F.col(c), F.col(f"{c}_min"), F.col(f"{c}_max"))

    return df.withColumn("entropy_shade", of("entropy")).withColumn("loss_shade", of("loss"))


def uncertainty_report(
    shaded: DataFrame,
    vocabulary: Vocabulary | None = None,
    ansi: bool = False,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """One record per sequence: tokens, losses, entropies, candidate lines and rendered lines.

    Needs ``token`` and the columns of :func:`score_tokens` and :func:`shade`. A sequence longer
    than ``part_rows`` tokens becomes several records, numbered by ``part``.
    """
    names = F.col("candidates").cast("array<string>")
    if vocabulary is not None:
        lookup = TokenLookup(vocabulary)
        names = F.transform("candidates", lambda i: lookup.decode(F.array(i)))
    info = F.array_join(
        F.transform(
            names,
            lambda name, i: F.concat(F.lit("pred "), (i + 1).cast("string"), F.lit(": "), name),
        ),
        "\n",
    )

    def painted(shade_col: str, red: bool) -> Column:
        if not ansi:
            return F.concat("token", F.lit("["), F.col(shade_col).cast("string"), F.lit("]"))
        s = F.col(shade_col).cast("string")
        rgb = (F.lit("255"), s, s) if red else (s, s, F.lit("255"))
        return F.concat(
            F.lit("\x1b[48;2;"), F.concat_ws(";", *rgb), F.lit("m"), F.col("token"), F.lit(RESET)
        )

    row = F.struct(
        "pos",
        "token",
        "loss",
        "entropy",
        info.alias("token_info"),
        painted("entropy_shade", True).alias("entropy_token"),
        painted("loss_shade", False).alias("loss_token"),
    )
    part = floor_div(F.col("pos"), part_rows).alias("part")
    grouped = shaded.groupBy("seq_id", part).agg(F.sort_array(F.collect_list(row)).alias("r"))
    return grouped.select(
        "seq_id",
        "part",
        F.col("r.token").alias("tokens"),
        F.col("r.loss").alias("losses"),
        F.col("r.entropy").alias("entropies"),
        F.col("r.token_info").alias("token_info"),
        F.col("r.entropy_token").alias("entropy_tokens"),
        F.col("r.loss_token").alias("loss_tokens"),
        F.array_join("r.entropy_token", "").alias("entropy_line"),
        F.array_join("r.loss_token", "").alias("loss_line"),
    )
