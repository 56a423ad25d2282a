"""Registered queries: ``entry``, ``queries`` and the SQL each one must agree with."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession, functions as F  # noqa: E402

from oracles import (  # noqa: E402
    ACCUM,
    BATCH_ROWS,
    EPOCHS,
    MERGES,
    MIN_LENGTH,
    ORACLES,
    SEED,
    SEQUENCE_LEN,
    SLICE,
    TEST_FRACTION,
)
from textmill.functions import text as tx  # noqa: E402
from textmill.functions.tokens import joined_ids, token_hex  # noqa: E402
from textmill.operators import batches, bpe, clean, dedup, filters, pack, stats, udf  # noqa: E402
from textmill.operators import inspect as ins  # noqa: E402
from textmill.operators import uncertainty as unc  # noqa: E402
from textmill.operators.order import spread  # noqa: E402
from textmill.operators.tokenize import (  # noqa: E402
    ByteTokenizer,
    byte_vocabulary,
    decode,
    encode_bpe,
    roundtrip_check,
    tokenize,
)
from textmill.plans import jobs  # noqa: E402
from textmill.sources.corpus import Source, read_corpus, slice_rows  # noqa: E402
from textmill.sources.tables import read_vocab, write_vocab
from textmill.storage import drop_path, shuffles_dropped, small_batches, stage_path, stage_table  # noqa: E402

ORDER = ["doc_id"]

Query = Callable[[SparkSession, str], DataFrame]


# ---- inputs -------------------------------------------------------------------------------------


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread(_table(spark, sf, "documents").select("doc_id", "text"), ORDER)


def _sources(sf: str) -> list[Source]:
    return [
        Source(f"{sf}/documents.parquet"),
        Source(f"{sf}/conversations.parquet"),
        Source(f"{sf}/benchmark.parquet"),
        Source(f"{sf}/pages.parquet", text_column="html"),
    ]


def _prepared(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.prepare_rows(_documents(spark, sf), ORDER)


def _byte_rows(spark: SparkSession, sf: str, **columns) -> DataFrame:
    return tokenize(_prepared(spark, sf), ByteTokenizer(), ORDER, **columns)


def _packed(spark: SparkSession, sf: str) -> DataFrame:
    """The packed table, staged; its tokens and shuffles go when it is written."""
    path = stage_path(spark, "tokens")
    with shuffles_dropped(spark), small_batches(spark):
        tokens = jobs.stage_tokens(_prepared(spark, sf), ByteTokenizer(), ORDER, path)
        packed = stage_table(jobs.pack_staged(tokens, SEQUENCE_LEN, MIN_LENGTH, ORDER), "packed")
    drop_path(spark, path)
    return packed


_trained: dict[tuple[str, str], bpe.Vocabulary] = {}


def _vocabulary(spark: SparkSession, sf: str) -> bpe.Vocabulary:
    """Trained once per session and data set; several queries start from it."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _trained:
        size = 256 + MERGES + len(bpe.ADDED_TOKENS)
        _trained[key] = bpe.train_bpe(_prepared(spark, sf), size)
    return _trained[key]


def _logits(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "embeddings").select(
        F.call_function("div", F.col("vec_id"), F.lit(10)).alias("seq_id"),
        (F.col("vec_id") % 10).alias("pos"),
        F.col("label").alias("target"),
        F.col("embedding").alias("logits"),
    )


def _joined(ids: Column) -> Column:
    return F.array_join(ids.cast("array<string>"), ",")


def _ordered_md5(place: str, text: str) -> Column:
    """MD5 of the texts of a group in order; a group is part of one packed row."""
    ordered = F.sort_array(F.collect_list(F.struct(place, text)))
    return F.md5(F.array_join(ordered[text], "|")).alias("text_md5")


def _chunk_hash(packed: DataFrame) -> DataFrame:
    return packed.select("chunk", F.md5(token_hex("input_ids")).alias("ids_md5"))


# ---- sources, cleaning, deduplication -----------------------------------------------------------


def corpus_union(spark, sf):
    return read_corpus(spark, _sources(sf)).select(
        "src", F.char_length("text").alias("n_chars"), F.md5("text").alias("text_md5")
    )


def corpus_slice(spark, sf):
    return slice_rows(_documents(spark, sf), SLICE, ORDER).select(
        "doc_id", F.md5("text").alias("text_md5")
    )


def clean_documents(spark, sf):
    padded = _documents(spark, sf).withColumn(
        "text",
        F.concat(F.lit(" 　\t"), "text", F.lit("  \u0085\n")),
    )
    missing = padded.select((-1 - F.col("doc_id")).alias("doc_id"), F.lit(None).cast("string").alias("text"))
    return clean.clean_text(padded.unionByName(missing)).select(
        "doc_id", F.char_length("text").alias("n_chars"), F.md5("text").alias("text_md5")
    )


def repair_utf8(spark, sf):
    data = F.encode("text", "UTF-8")
    broken = F.concat(F.unhex(F.lit("FF")), data, F.unhex(F.lit("EDA080E282"))).cast("string")
    return _documents(spark, sf).select(
        "doc_id", F.md5(tx.drop_invalid_utf8(broken)).alias("text_md5")
    )


def quality_gate(spark, sf):
    gated = clean.min_chars(clean.clean_text(_documents(spark, sf)))
    return gated.select("doc_id", F.char_length("text").alias("n_chars"))


def dedup_first(spark, sf):
    return dedup.dedup_first(_documents(spark, sf), ORDER).select(
        "doc_id", F.md5("text").alias("text_md5")
    )


def prepare_corpus(spark, sf):
    return jobs.prepare_corpus(spark, _sources(sf)).select("src", F.md5("text").alias("text_md5"))


def select_rows(spark, sf):
    good = _table(spark, sf, "labels").filter("quality = 1")
    return filters.select_rows(_documents(spark, sf), good, ORDER).select(
        "doc_id", F.md5("text").alias("text_md5")
    )


# ---- tokens and packing -------------------------------------------------------------------------


def byte_tokens(spark, sf):
    return _byte_rows(spark, sf).select(
        "doc_id", F.size("input_ids").alias("n_tokens"), F.md5(token_hex("input_ids")).alias("ids_md5")
    )


def token_masks(spark, sf):
    rows = _byte_rows(spark, sf, masks=True, with_token_types=True)

    def total(c: str) -> Column:
        return F.aggregate(c, F.lit(0), lambda acc, x: acc + x)

    return rows.select(
        "doc_id",
        F.size("attention_mask").alias("mask_len"),
        total("attention_mask").alias("mask_sum"),
        F.size("token_type_ids").alias("type_len"),
        total("token_type_ids").alias("type_sum"),
    )


def min_tokens(spark, sf):
    return filters.min_tokens(_byte_rows(spark, sf), MIN_LENGTH).select(
        "doc_id", F.size("input_ids").alias("n_tokens")
    )


def pack_wrapped(spark, sf):
    return _chunk_hash(_packed(spark, sf))


def pack_masks(spark, sf):
    rows = filters.min_tokens(_byte_rows(spark, sf, masks=True), MIN_LENGTH)
    packed = pack.pack_wrapped(
        rows, SEQUENCE_LEN, ORDER, keep_tail=True, columns=("input_ids", "attention_mask")
    )
    return packed.select(
        "chunk",
        F.size("attention_mask").alias("mask_len"),
        F.md5(token_hex("input_ids")).alias("ids_md5"),
    )


def pack_plan(spark, sf):
    rows = _prepared(spark, sf).select("doc_id", (F.octet_length("text") + 1).alias("n"))
    return pack.pack_plan(rows.filter(F.col("n") >= MIN_LENGTH), SEQUENCE_LEN, ORDER, F.col("n"))


def pack_corpus(spark, sf):
    path = stage_path(spark, "prepared")
    packed, _ = jobs.preprocess(
        spark, [Source(f"{sf}/documents.parquet")], ByteTokenizer(), SEQUENCE_LEN, path, MIN_LENGTH
    )
    return packed.select(
        "chunk", F.size("attention_mask").alias("mask_len"), F.md5(token_hex("input_ids")).alias("ids_md5")
    )


# ---- statistics ---------------------------------------------------------------------------------


def stage_rows(spark, sf):
    raw = _documents(spark, sf)
    return (
        stats.stage_rows(raw, "combined")
        .unionByName(stats.stage_rows(clean.clean_text(raw), "cleaned"))
        .unionByName(stats.stage_rows(_prepared(spark, sf), "final", 4))
    )


def filter_token_stats(spark, sf):
    return stats.filter_token_stats(_byte_rows(spark, sf), MIN_LENGTH)


def tail_stats(spark, sf):
    return stats.tail_stats(filters.min_tokens(_byte_rows(spark, sf), MIN_LENGTH), SEQUENCE_LEN)


def packed_stats(spark, sf):
    return stats.packed_stats(_packed(spark, sf))


def length_audit(spark, sf):
    rows = pack.pack_wrapped(
        filters.min_tokens(_byte_rows(spark, sf), MIN_LENGTH), SEQUENCE_LEN, ORDER, keep_tail=True
    )
    return stats.length_audit(rows, SEQUENCE_LEN)


def wrong_lengths(spark, sf):
    rows = _byte_rows(spark, sf).withColumnRenamed("doc_id", "chunk")
    return stats.wrong_lengths(rows, SEQUENCE_LEN)


def stage_report(spark, sf):
    path = stage_path(spark, "prepared")
    _, report = jobs.preprocess(
        spark, [Source(f"{sf}/documents.parquet")], ByteTokenizer(), SEQUENCE_LEN, path, MIN_LENGTH
    )
    return report


# ---- training-set preparation -------------------------------------------------------------------


def split_sizes(spark, sf):
    return batches.split_sizes(_packed(spark, sf))


def train_test_split(spark, sf):
    return batches.train_test_split(_packed(spark, sf), TEST_FRACTION, SEED).select("chunk", "split")


def lm_labels(spark, sf):
    labelled = batches.with_labels(_packed(spark, sf), ByteTokenizer().eos)
    return labelled.select("chunk", F.md5(joined_ids("labels")).alias("labels_md5"))


def micro_batches(spark, sf):
    return batches.micro_batches(
        _packed(spark, sf).select("chunk"), BATCH_ROWS, SEED
    )


def flatten_batches(spark, sf):
    grouped = batches.micro_batches(_packed(spark, sf), BATCH_ROWS, SEED)

    def total(c: str) -> Column:
        return F.aggregate(c, F.lit(0).cast("bigint"), lambda acc, x: acc + x)

    return batches.flatten_batches(grouped).select(
        "batch",
        F.md5(token_hex("input_ids")).alias("ids_md5"),
        F.md5(joined_ids("labels")).alias("labels_md5"),
        total("position_ids").alias("position_sum"),
        total("seq_idx").alias("seq_idx_sum"),
        _joined(F.col("cu_seq_lens")).alias("cu_seq_lens"),
        "max_length",
    )


def assign_steps(spark, sf):
    return batches.assign_steps(
        _packed(spark, sf).select("chunk"), BATCH_ROWS, ACCUM, EPOCHS, SEED
    )


# ---- vocabulary ---------------------------------------------------------------------------------


def nfkc_documents(spark, sf):
    # the texts are normal already; what is appended is not
    marked = F.concat("text", F.lit("\ufb01\u2460\uff21e\u0301"))
    return _documents(spark, sf).select("doc_id", F.md5(tx.nfkc(marked)).alias("text_md5"))


def pre_split(spark, sf):
    return _documents(spark, sf).select("doc_id", tx.pre_split("text").alias("pieces")).select(
        "doc_id",
        F.size("pieces").alias("n_pieces"),
        F.md5(F.array_join("pieces", "|")).alias("pieces_md5"),
    )


def word_freq(spark, sf):
    return bpe.word_freq(_prepared(spark, sf))


def pair_counts(spark, sf):
    return bpe.pair_counts(bpe.word_freq(_prepared(spark, sf)))


def train_bpe(spark, sf):
    return _vocabulary(spark, sf).merges


def assemble_vocab(spark, sf):
    tables = _vocabulary(spark, sf)
    return tables.vocab.select(
        "id", F.hex("bytes").alias("bytes_hex"), F.lit(False).alias("special")
    ).unionByName(
        tables.added.select("id", F.hex(F.encode("token", "UTF-8")).alias("bytes_hex"), "special")
    )


def reload_vocab(spark, sf):
    path = stage_path(spark, "vocabulary")
    write_vocab(_vocabulary(spark, sf), path)
    return read_vocab(spark, path).merges


def vocab_stats(spark, sf):
    tables = _vocabulary(spark, sf)
    return stats.vocab_stats(tables.vocab, tables.added)


def encode_documents(spark, sf):
    return encode_bpe(_prepared(spark, sf), _vocabulary(spark, sf)).select(
        "doc_id", F.size("input_ids").alias("n_tokens"), F.md5(joined_ids("input_ids")).alias("ids_md5")
    )


def decode_documents(spark, sf):
    tables = _vocabulary(spark, sf)
    encoded = encode_bpe(_prepared(spark, sf), tables).drop("text")
    return decode(encoded, tables).select("doc_id", F.md5("text").alias("text_md5"))


def roundtrip(spark, sf):
    return roundtrip_check(_documents(spark, sf), _vocabulary(spark, sf))


# ---- inspection ---------------------------------------------------------------------------------


def head_samples(spark, sf):
    return _chunk_hash(ins.head_samples(_packed(spark, sf), 5))


def explode_tokens(spark, sf):
    tokens = ins.explode_tokens(ins.by_chunk(_packed(spark, sf)), byte_vocabulary(spark))
    return tokens.groupBy("chunk", "class").agg(
        F.count(F.lit(1)).alias("n_tokens"), F.sum("pos").alias("pos_sum"), F.sum("id").alias("id_sum"),
        _ordered_md5("pos", "text"),
    )


def token_segments(spark, sf):
    packed = ins.by_chunk(_packed(spark, sf))
    return ins.token_segments(packed, byte_vocabulary(spark), ins.segment_totals, ins.TOTALS)


def render_samples(spark, sf):
    lines = ins.render_samples(_packed(spark, sf), byte_vocabulary(spark))
    return lines.select("chunk", F.md5("line").alias("line_md5"))


def inspect_packed(spark, sf):
    path = stage_path(spark, "prepared")
    _packed(spark, sf).write.parquet(path)
    _, samples = jobs.inspect_packed(spark, path, byte_vocabulary(spark))
    return samples.select("chunk", F.md5("line").alias("line_md5"))


# ---- scores -------------------------------------------------------------------------------------


def token_loss(spark, sf):
    scored = unc.token_loss(_logits(spark, sf))
    soft = unc.token_loss(scored.withColumnRenamed("loss", "raw_loss"), "log_softmax")
    return soft.select(
        "seq_id", "pos", F.round("raw_loss", 6).alias("loss"), F.round("loss", 6).alias("cross_entropy")
    )


def token_entropy(spark, sf):
    return unc.token_entropy(_logits(spark, sf)).select(
        "seq_id", "pos", F.round("entropy", 6).alias("entropy")
    )


def candidates(spark, sf):
    low = unc.candidates(_logits(spark, sf)).withColumnRenamed("candidates", "low")
    return unc.candidates(low, descending=True).select(
        "seq_id", "pos", _joined(F.col("low")).alias("lowest"), _joined(F.col("candidates")).alias("highest")
    )


def minmax_by_seq(spark, sf):
    ranged = unc.minmax_by_seq(unc.token_loss(_logits(spark, sf)).drop("logits"), ("loss",))
    return ranged.select(
        "seq_id", "pos", F.round("loss_min", 6).alias("loss_min"), F.round("loss_max", 6).alias("loss_max")
    )


def shade(spark, sf):
    scored = stage_table(unc.score_tokens(_logits(spark, sf)), "scores")
    return unc.shade(unc.minmax_by_seq(scored)).select("seq_id", "pos", "entropy_shade", "loss_shade")


def token_text(spark, sf):
    start = F.col("doc_id") % 7
    spans = _documents(spark, sf).select(
        "doc_id", "text", start.cast("int").alias("start"), (start + 5 + F.col("doc_id") % 11).cast("int").alias("end")
    )
    return unc.token_text(spans).select("doc_id", "token")


def uncertainty_report(spark, sf):
    named = _logits(spark, sf).withColumn("text", F.concat(F.lit("tok "), F.col("target").cast("string")))
    spans = named.withColumn("start", F.lit(0)).withColumn("end", F.char_length("text"))
    report = jobs.inspect_predictions(spans)

    def rounded(c: str) -> Column:
        return F.array_join(F.transform(c, lambda x: F.round(x, 5).cast("decimal(12,5)").cast("string")), ",").alias(c)

    return report.select(
        "seq_id",
        "part",
        F.array_join("tokens", "|").alias("tokens"),
        rounded("losses"),
        rounded("entropies"),
        F.md5("entropy_line").alias("entropy_line_md5"),
        F.md5(F.array_join("token_info", "|")).alias("info_md5"),
        "loss_line",
    )


# ---- user functions -----------------------------------------------------------------------------


def map_rows(spark, sf):
    def measure(row: dict) -> dict:
        return {"n_words": len(row["text"].split(" ")), "lang": row["lang"].upper()}

    docs = _table(spark, sf, "documents").select("doc_id", "text", "lang")
    return udf.map_rows(docs, measure, "n_words int, lang string").select("doc_id", "lang", "n_words")


def map_batches(spark, sf):
    def price(rows):
        cents = rows["l_extendedprice"] * (1 - rows["l_discount"]) * 100
        return rows.assign(cents=cents // 1)[["l_orderkey", "l_linenumber", "cents"]]

    lines = _table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount")
    priced = udf.map_batches(lines, price, "l_orderkey bigint, l_linenumber int, cents bigint")
    return priced.groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("cents").alias("cents")
    )


def filter_rows(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id", "text", "lang")
    return udf.filter_rows(docs, lambda row: row["lang"] == "en" and "the" in row["text"]).select("doc_id")


QUERIES: list[Query] = [
    corpus_union, corpus_slice, clean_documents, repair_utf8, quality_gate, dedup_first,
    prepare_corpus, select_rows, byte_tokens, token_masks, min_tokens, pack_wrapped, pack_masks,
    pack_plan, pack_corpus, stage_rows, filter_token_stats, tail_stats, packed_stats, length_audit,
    wrong_lengths, stage_report, split_sizes, train_test_split, lm_labels, micro_batches,
    flatten_batches, assign_steps, nfkc_documents, pre_split, word_freq, pair_counts, train_bpe,
    assemble_vocab, reload_vocab, vocab_stats, encode_documents, decode_documents, roundtrip, head_samples,
    explode_tokens, token_segments, render_samples, inspect_packed, token_loss, token_entropy,
    candidates, minmax_by_seq, shade, token_text, uncertainty_report, map_rows, map_batches,
    filter_rows,
]


def entry(spark: SparkSession) -> DataFrame:
    """The packed table of the smallest data set."""
    return _packed(spark, "/root/testdata/sf0.001")


def _llm():
    """The queries of the ``llm`` subpackage; None where it or its pipeline is not installed."""
    try:
        import corpus_pipeline  # noqa: F401
        from textmill.llm import queries as llm
    except ModuleNotFoundError as error:
        if error.name not in ("textmill.llm", "textmill.llm.queries", "corpus_pipeline"):
            raise
        return None
    return llm


def queries() -> dict[str, Query]:
    llm = _llm()
    return {query.__name__: query for query in QUERIES} | (llm.queries() if llm else {})


def oracle_sql() -> dict[str, str]:
    llm = _llm()
    return dict(ORACLES) | (llm.oracle_sql() if llm else {})
