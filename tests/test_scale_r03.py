"""Work that grows no faster than the rows: what moves, and what a row costs."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from textmill.functions import text as tx
from textmill.functions.tokens import joined_ids, token_hex
from textmill.operators import inspect as ins
from textmill.operators import pack
from textmill.operators.tokenize import byte_vocabulary


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cuts_and_segments_do_not_slice_in_a_lambda(spark):
    rng = random.Random(3)
    rows = [(i, [rng.randrange(257) for _ in range(rng.choice([0, 1, 40, 3000]))]) for i in range(30)]
    df = spark.createDataFrame(rows, "row bigint, input_ids array<int>")
    packed = pack.pack_wrapped(df, 16, ["row"], keep_tail=True)
    assert "slice(" not in plan(packed)
    flat = [t for _, ids in rows for t in ids]
    got = [list(r.input_ids) for r in packed.orderBy("chunk").collect()]
    assert got == [flat[i : i + 16] for i in range(0, len(flat), 16)]
    for made in (ins.render_samples(packed, byte_vocabulary(spark)), ins.token_segments(packed, byte_vocabulary(spark))):
        assert "slice(" not in plan(made)


def test_groups_by_chunk_move_packed_rows_and_no_tokens(spark):
    packed = spark.createDataFrame([(i, [65, 32, 256, i]) for i in range(9)], "chunk bigint, input_ids array<int>")
    tokens = ins.explode_tokens(ins.by_chunk(packed), byte_vocabulary(spark))
    grouped = tokens.groupBy("chunk", "class").agg(F.collect_list("pos"))
    assert plan(grouped).count("hashpartitioning(") == 1
    assert grouped.count() == 27 - sum(1 for i in range(9) if chr(i).isalnum())


def test_token_text_with_nulls_and_wide_ids(spark):
    rows = [(0, [1, None, 65535]), (1, None), (2, []), (3, [65536, -1, 0x12345]), (4, [7])]
    df = spark.createDataFrame(rows, "i int, ids array<int>")
    old = F.array_join(F.transform("ids", lambda x: F.lpad(F.hex(x), 4, "0")), "")
    found = df.select("i", token_hex("ids"), old, joined_ids("ids"), F.array_join(F.col("ids").cast("array<string>"), ","))
    for r in found.collect():
        assert r[1] == r[2] and r[3] == r[4]


def test_nfkc_holds_few_strings_at_a_time(monkeypatch):
    sizes, normal = [], tx._nfkc_slice

    def watched(texts):
        sizes.append(len(texts))
        return normal(texts)

    monkeypatch.setattr(tx, "_nfkc_slice", watched)
    [got] = tx._nfkc.func(iter([pa.array(["ﬁ", None, "a"] * 100)]))
    assert got.to_pylist() == ["fi", None, "a"] * 100 and max(sizes) <= tx.NFKC_ROWS
