"""The queries of this subpackage and the SQL that some of them must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from textmill.llm import (
    ann_blocks, bm25_search, conversation_repair, hmm_lm, line_dedup, lsh_forest, mixing, partenum_join, quality_fm, secret_scan,
    sos_packing, token_alignment, token_files,
)
from textmill.storage import stage_path

#: Numeric metadata the quality classifier may see.
METADATA = ("n_chars",)
KEEP_SCORE = 0.3


def vocabulary(name: str) -> str:
    """Path of a public tokenizer file; the package that has it is installed on every node."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _table(spark, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_secret_scan(spark, sf):
    documents = _table(spark, sf, "documents").select("doc_id", "text")
    scanned = secret_scan.scan(documents, stage_path(spark, "secrets"))

    def number(kind: str):
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = secret_scan.digest(kinds=secret_scan.BASE_KINDS)
    return scanned.select(
        "doc_id",
        *[number(rule.kind) for rule in secret_scan.RULES],
        F.sha2(base, 256).alias("base_sha256"),
        secret_scan.digest().alias("spans"),
    )


def _secret_sql() -> str:
    """Gaps from the split, lengths from the matches; running sums give the offsets."""
    parts = []
    for place, rule in enumerate(secret_scan.RULES):
        pattern = "'" + rule.pattern.replace("'", "''") + "'"
        parts.append(f"""
  SELECT doc_id, {place} AS place, '{rule.kind}' AS kind, {rule.least} AS least,
         [length(x) FOR x IN string_split_regex(t, {pattern})] AS gaps,
         [length(x) FOR x IN regexp_extract_all(t, {pattern})] AS hits,
         [length(x) FOR x IN regexp_extract_all(t, {pattern}, {rule.group})] AS own FROM texts""")
    kinds = ", ".join(f"'{k}'" for k in secret_scan.BASE_KINDS)
    numbers = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in secret_scan.RULES)
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
parts AS ({" UNION ALL ".join(parts)}),
steps AS (
  SELECT doc_id, place, kind, least, unnest(range(1, len(hits) + 1)) AS i, gaps, hits, own FROM parts),
sized AS (
  SELECT doc_id, place, kind, hits[i] AS size, own[i] >= least AS kept,
         sum(gaps[i] + hits[i]) OVER (PARTITION BY doc_id, kind ORDER BY i) AS stop
  FROM steps),
spans AS (
  SELECT doc_id, place, kind, (stop - size)::BIGINT AS start, kind || ':' || (stop - size)::BIGINT || ':' || stop::BIGINT AS span
  FROM sized WHERE kept),
joined AS (
  SELECT doc_id, {numbers},
         coalesce(string_agg(span, ',' ORDER BY start, place) FILTER (kind IN ({kinds})), '') AS base,
         string_agg(span, ',' ORDER BY start, place) AS spans
  FROM spans GROUP BY doc_id)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0)::BIGINT AS n_{r.kind}" for r in secret_scan.RULES)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN joined USING (doc_id)"""


def op2_search(spark, sf):
    documents = _table(spark, sf, "documents").select("doc_id", "text")
    return bm25_search.search(documents, documents.filter("doc_id % 20 = 0"))


def op3_near_duplicates(spark, sf):
    found = lsh_forest.near_duplicates(_table(spark, sf, "documents"), width=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op4_mix_sources(spark, sf):
    documents = _table(spark, sf, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix(documents)
    return mixed.select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_copies") * F.col("_size")).alias("taken"),
    )


def op5_nearest(spark, sf):
    embeddings = _table(spark, sf, "embeddings")
    return ann_blocks.nearest(embeddings, embeddings.filter("vec_id % 50 = 0"), k=5).select(
        F.col("query_id"), F.col("rank"), F.col("vec_id"), F.col("score")
    )


def op6_pack(spark, sf):
    return sos_packing.pack(_table(spark, sf, "documents"), vocabulary("word_bpe_49k.json"))


def op7_token_files(spark, sf):
    path = stage_path(spark, "token_files")
    token_files.write(_table(spark, sf, "documents"), path, vocabulary("byte_bpe_50k.json"), end_id=2)
    return token_files.read(spark, path)


def op8_line_dedup(spark, sf):
    cleaned = line_dedup.dedup_lines(_table(spark, sf, "documents").select("doc_id", "text"))
    return cleaned.select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"), "text"
    )


def op9_hmm_scores(spark, sf):
    return hmm_lm.score(_table(spark, sf, "documents"))


def op10_quality(spark, sf):
    documents = _table(spark, sf, "documents").select("doc_id", "text", *METADATA)
    machine = quality_fm.fit(documents, _table(spark, sf, "labels"), metadata=METADATA)
    scored = quality_fm.score(documents, machine, metadata=METADATA)
    return scored.select(
        "doc_id",
        quality_fm.held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted"),
    )


def op11_jaccard_join(spark, sf):
    joined = partenum_join.join(_table(spark, sf, "documents").select("doc_id", "text"))
    return joined.select("doc_id", "n_shingles", "component_id")


def op12_token_alignment(spark, sf):
    documents = _table(spark, sf, "documents").select("doc_id", "text")
    aligned, _ = token_alignment.align(documents, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
    return aligned


def op13_conversation_repair(spark, sf):
    return conversation_repair.audit(_table(spark, sf, "conversations"))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

def _linked_sql(width: int, similar: int, columns: str) -> str:
    """Components of documents whose sets of word shingles are similar, by counting common shingles."""
    shingle = " || ' ' || ".join(f"ws[i + {k}]" for k in range(width))
    return rf"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN ws WHEN len(ws) < {width} THEN [array_to_string(ws, ' ')]
    ELSE [{shingle} FOR i IN range(1, len(ws) - {width} + 2)] END) AS s
  FROM worded),
sizes AS (SELECT doc_id, len(s)::BIGINT AS n FROM sets),
members AS (SELECT doc_id, unnest(s) AS x FROM sets),
common AS (
  SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS c FROM members p JOIN members q ON p.x = q.x AND p.doc_id < q.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= {similar} * (p.n + q.n - c)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, w.b FROM reached r JOIN ways w ON w.a = r.b)
SELECT doc_id, n AS n_shingles, {columns}
FROM sizes JOIN reached ON a = doc_id GROUP BY doc_id, n"""


QUERIES = [
    op1_secret_scan, op2_search, op3_near_duplicates, op4_mix_sources, op5_nearest, op6_pack, op7_token_files, op8_line_dedup, op9_hmm_scores,
    op10_quality, op11_jaccard_join, op12_token_alignment, op13_conversation_repair,
]


def queries():
    import corpus_pipeline

    return {query.__name__: query for query in QUERIES} | {"pipeline": corpus_pipeline.run}


def oracle_sql():
    import corpus_pipeline

    own = {
        "op1_secret_scan": _secret_sql(), "op3_near_duplicates": _linked_sql(2, 80, "min(b) AS component_id, doc_id = min(b) AS kept"),
        "op11_jaccard_join": _linked_sql(3, 90, "min(b) AS component_id"), "pipeline": corpus_pipeline.ORACLE_SQL,
    }
    return {name: sql for name, sql in own.items() if sql}
