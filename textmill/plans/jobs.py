"""Jobs composed of the operators: corpus, vocabulary, packed table, inspection, uncertainty."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from textmill.functions.tokens import attention_mask, token_type_ids
from textmill.operators import stats
from textmill.operators.bpe import MAX_TOKEN_BYTES, MIN_FREQUENCY, VOCAB_SIZE, train_bpe
from textmill.operators.clean import MIN_CHARS, clean_text
from textmill.operators.dedup import quality_and_unique
from textmill.operators.filters import MIN_TOKENS, min_tokens
from textmill.operators.inspect import head_samples, render_samples
from textmill.operators.pack import pack_wrapped
from textmill.operators.tokenize import Tokenizer, tokenize
from textmill.operators.uncertainty import (
    minmax_by_seq,
    score_tokens,
    shade,
    token_text,
    uncertainty_report,
)
from textmill.sources.corpus import CORPUS_ORDER, Source, read_corpus
from textmill.sources.tables import Vocabulary, read_packed, write_packed, write_vocab
from textmill.storage import drop_path, stage_path, stage_table

Clean = Callable[[DataFrame], DataFrame]


def prepare_rows(
    df: DataFrame,
    order: list[str],
    clean: Clean = clean_text,
    n: int = MIN_CHARS,
    keep: Clean | None = None,
    exact: bool = False,
) -> DataFrame:
    """Clean, filter, gate and deduplicate rows that are already read.

    ``keep`` is a filter of the user on the cleaned rows, for example
    ``lambda df: filter_batches(df, good, ["text"])``; it runs before the gate, so rows it drops
    never count as first occurrence. ``exact`` compares texts instead of their digests.
    """
    cleaned = clean(df)
    return quality_and_unique(keep(cleaned) if keep else cleaned, order, n, exact)


def prepare_corpus(
    spark: SparkSession,
    sources: list[Source],
    clean: Clean = clean_text,
    n: int = MIN_CHARS,
    keep: Clean | None = None,
    exact: bool = False,
) -> DataFrame:
    """Read, join, clean, filter, gate and deduplicate the sources."""
    return prepare_rows(read_corpus(spark, sources), CORPUS_ORDER, clean, n, keep, exact)


def stage_tokens(
    corpus: DataFrame, tokenizer: Tokenizer, order: list[str], path: str | None = None
) -> DataFrame:
    """Encode once and stage ``[*order, input_ids, n_tokens]``, at ``path`` if one is given.

    Statistics read ``n_tokens`` only, and packing reads the ids without repeating the scan,
    deduplication and encoding.
    """
    tokens = tokenize(corpus, tokenizer, order).withColumn("n_tokens", F.size("input_ids"))
    return stage_table(tokens, "tokens", path)


def pack_staged(
    tokens: DataFrame, sequence_len: int, min_length: int, order: list[str]
) -> DataFrame:
    """Token gate and packing over staged tokens."""
    kept = tokens.filter(F.col("n_tokens") >= min_length)
    return pack_wrapped(kept, sequence_len, order, tokens=F.col("n_tokens"))


def pack_rows(
    df: DataFrame,
    tokenizer: Tokenizer,
    sequence_len: int,
    order: list[str],
    min_length: int = MIN_TOKENS,
) -> DataFrame:
    """Rows to packed table without staging: the scan runs for sizes and again for the ids."""
    return pack_wrapped(min_tokens(tokenize(df, tokenizer, order), min_length), sequence_len, order)


def preprocess(
    spark: SparkSession,
    sources: list[Source],
    tokenizer: Tokenizer,
    sequence_len: int,
    prepared_path: str,
    min_length: int = MIN_TOKENS,
    clean: Clean = clean_text,
    with_token_types: bool = False,
    keep: Clean | None = None,
    exact: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Sources to packed table at ``prepared_path``; returns the table and the stage report.

    The staged tokens are removed once the report has read them. ``inspect_packed`` renders samples
    of the table.
    """
    tokens_path = stage_path(spark, "tokens")
    raw = read_corpus(spark, sources)
    prepared = prepare_rows(raw, CORPUS_ORDER, clean, keep=keep, exact=exact)
    tokens = stage_tokens(prepared, tokenizer, CORPUS_ORDER, tokens_path)
    packed = pack_staged(tokens, sequence_len, min_length, CORPUS_ORDER)
    # ones and zeros are as long as the ids, so they are written, not packed
    packed = packed.withColumn("attention_mask", attention_mask("input_ids"))
    if with_token_types:
        packed = packed.withColumn("token_type_ids", token_type_ids("input_ids"))
    write_packed(packed, prepared_path)
    written = read_packed(spark, prepared_path)
    cleaned = None if clean is clean_text else clean(raw)
    report = preprocess_report(raw, tokens, written, sequence_len, min_length, cleaned)
    report = stage_table(report.coalesce(1), "report")
    drop_path(spark, tokens_path)
    return written, report


def preprocess_report(
    raw: DataFrame,
    tokens: DataFrame,
    packed: DataFrame,
    sequence_len: int,
    min_length: int,
    cleaned: DataFrame | None = None,
) -> DataFrame:
    """``stage, metric, value, number``. The default cleaning keeps every row and needs no count of its
    own; ``cleaned`` is what another cleaner returned."""
    combined = stats.stage_rows(raw, "combined")
    n = F.col("n_tokens")
    return stats.stage_report(
        [
            ("combined", combined),
            ("cleaned", combined if cleaned is None else stats.stage_rows(cleaned, "cleaned")),
            ("final", stats.stage_rows(tokens, "final", 4)),
            ("filter", stats.filter_token_stats(tokens, min_length, n)),
            ("tail", stats.tail_stats(tokens.filter(n >= min_length), sequence_len, n)),
            ("packed", stats.packed_stats(packed)),
            ("audit", stats.length_audit(packed, sequence_len)),
        ]
    )


def train_tokenizer(
    spark: SparkSession,
    sources: list[Source],
    output_path: str,
    vocab_size: int = VOCAB_SIZE,
    min_freq: int = MIN_FREQUENCY,
    max_token_length: int = MAX_TOKEN_BYTES,
    clean: Clean = clean_text,
    keep: Clean | None = None,
    exact: bool = False,
) -> tuple[Vocabulary, DataFrame]:
    """Train on the prepared corpus (the token gate does not apply) and save the vocabulary."""
    corpus = prepare_corpus(spark, sources, clean, keep=keep, exact=exact)
    vocabulary = train_bpe(corpus, vocab_size, min_freq, max_token_length)
    write_vocab(vocabulary, output_path)
    return vocabulary, stats.vocab_stats(vocabulary.vocab, vocabulary.added)


def inspect_packed(
    spark: SparkSession, path: str, vocabulary: Vocabulary, n: int = 5, ansi: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Statistics of a saved packed table, and its first samples rendered."""
    packed = read_packed(spark, path)
    samples = render_samples(head_samples(packed, n), vocabulary, ansi)
    return stats.packed_stats(packed), samples.orderBy("chunk")


def inspect_predictions(
    logits: DataFrame,
    vocabulary: Vocabulary | None = None,
    mode: str = "raw",
    descending: bool = False,
    ansi: bool = False,
) -> DataFrame:
    """Report per sequence from ``seq_id, pos, target, logits, text, start, end``.

    The scores are staged, so the wide logits are read once.
    """
    narrow = token_text(score_tokens(logits, mode, descending=descending)).drop("text", "start", "end")
    scored = stage_table(narrow, "scores")
    return uncertainty_report(shade(minmax_by_seq(scored)), vocabulary, ansi)
