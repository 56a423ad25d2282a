import math
import re

import pytest
from pyspark.sql import functions as F

from textmill.operators import inspect as ins
from textmill.operators import udf
from textmill.operators import uncertainty as unc
from textmill.operators.tokenize import ByteTokenizer, byte_vocabulary
from textmill.plans import jobs
from textmill.sources.corpus import Source


def packed(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "chunk bigint, input_ids array<int>")


def expected_segments(ids):
    out, i = [], 0
    kind = lambda t: "special" if t == 256 else "word" if re.match(r"\w", bytes([t]).decode("utf-8", "replace")) else "non_word"
    while i < len(ids):
        j = i + 1
        if kind(ids[i]) == "non_word":
            while j < len(ids) and kind(ids[j]) == "non_word":
                j += 1
        run = ids[i:j]
        text = "<|boundary|>" if run == [256] else bytes(run).decode("utf-8", "replace")
        out.append((kind(ids[i]), run, text))
        i = j
    return out


ROWS = [
    [97, 32, 33, 256, 33, 98],
    list("한글 a".encode()) + [256, 256] + list("½".encode()),
    [33],
    [97],
    [0xE2, 0x82, 256, 0xAC],
]


def test_segments_and_rendering(spark):
    table = packed(spark, ROWS)
    vocabulary = byte_vocabulary(spark)
    got = ins.token_segments(table, vocabulary).orderBy("chunk", "segment").collect()
    for chunk, ids in enumerate(ROWS):
        mine = [(r["class"], list(r.ids), r.text) for r in got if r.chunk == chunk]
        assert mine == expected_segments(ids)
    lines = {r.chunk: r.line for r in ins.render_samples(table, vocabulary).collect()}
    for chunk, ids in enumerate(ROWS):
        items = [f"{text}({','.join(map(str, run))})" for _, run, text in expected_segments(ids)]
        assert lines[chunk] == f"[PACKED SAMPLE {chunk}] " + " ".join(items)
    painted = ins.render_samples(table.filter("chunk = 3"), vocabulary, ansi=True).first().line
    assert painted == "\x1b[1;43;30m[PACKED SAMPLE 3]\x1b[0m \x1b[44;97ma\x1b[0m(97)"


def test_exploded_tokens_and_head(spark):
    table = packed(spark, ROWS)
    rows = ins.explode_tokens(ins.head_samples(table, 1), byte_vocabulary(spark)).orderBy("pos").collect()
    assert [(r.id, r.text, r["class"]) for r in rows] == [
        (97, "a", "word"), (32, " ", "non_word"), (33, "!", "non_word"), (256, "<|boundary|>", "special"),
        (33, "!", "non_word"), (98, "b", "word"),
    ]


def test_preprocess_and_inspect_jobs(spark, tmp_path):
    docs = [f"{i} " + "word " * (30 + i) for i in range(8)] + ["tiny"]
    spark.createDataFrame([(d,) for d in docs], "text string").coalesce(2).write.parquet(f"{tmp_path}/docs")
    table, report = jobs.preprocess(
        spark, [Source(f"{tmp_path}/docs")], ByteTokenizer(), 64, f"{tmp_path}/out", 160, with_token_types=True
    )
    cleaned = [d.strip() for d in docs if len(d.strip()) >= 100]
    kept = sum(len(d) + 1 for d in cleaned if len(d) + 1 >= 160)
    values = {(r.stage, r.metric): r.value for r in report.collect()}
    assert values[("combined", "n_rows")] == 9 and values[("final", "n_rows")] == 8
    assert values[("filter", "tokens_after")] == kept
    assert values[("tail", "tail_tokens")] == kept % 64
    assert values[("packed", "packed_rows")] == kept // 64 == table.count()
    assert values[("audit", "wrong_rows")] == 0 and values[("audit", "all_correct")] == 1
    numbers = {(r.stage, r.metric): r.number for r in report.collect()}
    assert numbers[("final", "n_rows")] == 8 and numbers[("audit", "all_correct")] == 1.0
    assert numbers[("combined", "n_rows_m")] == 0.0 and values[("combined", "n_rows_m")] is None
    assert set(numbers) >= {("cleaned", "n_rows_m"), ("final", "n_rows_m"), ("packed", "tokens_b")}
    assert {len(r.attention_mask) for r in table.collect()} == {64}
    counts, samples = jobs.inspect_packed(spark, f"{tmp_path}/out", byte_vocabulary(spark))
    assert counts.first().packed_rows == kept // 64
    assert [r.chunk for r in samples.collect()] == list(range(min(5, kept // 64)))
    vocabulary, size = jobs.train_tokenizer(spark, [Source(f"{tmp_path}/docs")], f"{tmp_path}/vocab", 280)
    assert size.first().vocab_size == vocabulary.vocab.count() + 11


LOGITS = {
    0: [([1.0, 1.0, 1.0], 0), ([1e4, -1e4, 0.0], 1), ([0.0, 5.0, 5.0], 2)],
    1: [([2.0, 3.0, 1.0], 1)],
}


def scores_frame(spark):
    rows = [
        (seq, pos, target, logits, "añb c", pos, pos + 2)
        for seq, items in LOGITS.items()
        for pos, (logits, target) in enumerate(items)
    ]
    return spark.createDataFrame(
        rows, "seq_id bigint, pos bigint, target int, logits array<float>, text string, start int, end int"
    )


def entropy(x):
    z = sum(math.exp(v - max(x)) for v in x)
    p = [math.exp(v - max(x)) / z for v in x]
    return -sum(q * math.log(q) for q in p if q)


@pytest.mark.parametrize("part_rows", [1, 2, 8192])
def test_scores_ranges_and_shades(spark, part_rows):
    scored = unc.score_tokens(scores_frame(spark), k=2)
    got = unc.shade(unc.minmax_by_seq(scored, part_rows=part_rows)).orderBy("seq_id", "pos").collect()
    flat = [(s, p, x, t) for s, items in LOGITS.items() for p, (x, t) in enumerate(items)]
    for r, (s, p, x, t) in zip(got, flat, strict=True):
        assert (r.seq_id, r.pos) == (s, p) and r.loss == -x[t]
        assert abs(r.entropy - entropy(x)) < 1e-9
        assert r.candidates == sorted(range(len(x)), key=lambda i: (x[i], i))[:2]
        for c, of in (("loss", lambda y, u: -y[u]), ("entropy", lambda y, u: entropy(y))):
            every = [of(y, u) for y, u in LOGITS[s]]
            span = (max(every) - min(every)) if max(every) > min(every) else 1.0
            assert r[f"{c}_shade"] == int((1 - (of(x, t) - min(every)) / span) * 255)


def test_options_and_surfaces(spark):
    df = scores_frame(spark)
    top = unc.candidates(df, 1, descending=True).orderBy("seq_id", "pos").collect()
    assert [r.candidates for r in top] == [[0], [0], [1], [1]]
    soft = unc.token_loss(df, "log_softmax").orderBy("seq_id", "pos").collect()
    assert abs(soft[0].loss - math.log(3)) < 1e-9
    assert [r.token for r in unc.token_text(df).orderBy("seq_id", "pos").collect()] == ["añ", "ñb", "b ", "añ"]
    with pytest.raises(ValueError):
        unc.token_loss(df, "other")


def test_report(spark):
    report = {r.seq_id: r for r in jobs.inspect_predictions(scores_frame(spark), byte_vocabulary(spark), ansi=True).collect()}
    first = report[0]
    assert first.tokens == ["añ", "ñb", "b "] and first.losses == [-1.0, 10000.0, -5.0]
    assert first.token_info[0] == "pred 1: \x00\npred 2: \x01\npred 3: \x02"
    assert first.loss_tokens[1] == "\x1b[48;2;0;0;255mñb\x1b[0m"
    assert first.loss_line == "".join(first.loss_tokens)
    assert report[1].entropy_tokens == ["\x1b[48;2;255;255;255mañ\x1b[0m"]
    short = unc.uncertainty_report(
        unc.shade(unc.minmax_by_seq(unc.token_text(unc.score_tokens(scores_frame(spark))))), part_rows=2
    )
    assert sorted((r.seq_id, r.part, len(r.tokens)) for r in short.collect()) == [(0, 0, 2), (0, 1, 1), (1, 0, 1)]


SEEN = set()


def test_user_functions(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, text string")
    mapped = udf.map_rows(df, lambda r: {"text": r["text"].upper(), "twice": r["n"] * 2}, "text string, twice int")
    assert sorted(tuple(r) for r in mapped.select("n", "text", "twice").collect()) == [(1, "A", 2), (2, "B", 4)]
    batched = udf.map_batches(df, lambda b: b.assign(m=b["n"] + 1)[["m"]], "m int")
    assert sorted(r.m for r in batched.collect()) == [2, 3]
    assert [r.n for r in udf.filter_rows(df, lambda r: r["n"] > 1).collect()] == [2]
    with pytest.raises(ValueError, match="dedup_first"):
        udf.filter_rows(df, lambda r: r["text"] not in SEEN)


def test_predicates_with_state_are_refused(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "text string, n int")
    stop = {"a"}

    class Seen:
        def __init__(self):
            self.seen = set()

        def new(self, row):
            return row["text"] not in self.seen

        __call__ = new

    def defaulted(row, seen=[]):  # noqa: B006
        return row["text"] not in seen

    for bad in (Seen().new, Seen(), defaulted, lambda r: r["text"] not in stop):
        with pytest.raises(ValueError):
            udf.filter_rows(df, bad)
    frozen = frozenset(stop)
    assert [r.text for r in udf.filter_rows(df, lambda r: r["text"] not in frozen).collect()] == ["b"]
    assert [r.text for r in udf.filter_rows(df, lambda r: r["text"] not in stop, ["text"], read_only=True).collect()] == ["b"]
    assert [r.text for r in udf.filter_batches(df, lambda b: b["n"] < 2, ["n"]).collect()] == ["a"]


def test_map_rows_sends_only_named_columns(spark):
    df = spark.createDataFrame([("a", 1)], "text string, n int")
    seen = udf.map_rows(df, lambda r: {"k": ",".join(sorted(r))}, "k string", ["n"]).collect()
    assert seen[0].asDict() == {"text": "a", "n": 1, "k": "n"}


@pytest.mark.parametrize("size, k", [(32_000, 5), (3, 5), (64, 1), (0, 4)])
def test_candidates_of_wide_logits_with_ties(spark, size, k):
    rng = random.Random(size)
    rows = [(i, [rng.choice([float(rng.randint(0, size // 8 + 1)), float("nan")] + [0.5] * (i % 2)) for _ in range(size)]) for i in range(6)]
    df = spark.createDataFrame(rows, "i int, logits array<double>")
    got = df.select("i", scores.candidates("logits", k).alias("low"), scores.candidates("logits", k, descending=True).alias("high")).collect()
    for r in got:
        x = rows[r.i][1]
        place = [(math.isnan(v), v if v == v else 0.0, i) for i, v in enumerate(x)]
        assert r.low == [p[2] for p in sorted(place)[:k]]
        assert r.high == [p[2] for p in sorted((nan, -v, i) for nan, v, i in place)[:k]]
