"""What moves to pack and to inspect a table: ids once, and compact."""

import hashlib
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textmill.functions import text as tx
from textmill.functions import tokens as tk
from textmill.operators import inspect as ins
from textmill.operators import pack
from textmill.operators.tokenize import byte_vocabulary


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("kind", list(tk.SQUEEZED))
def test_squeezed_lists_are_the_lists(kind):
    rng, top = random.Random(3), 2 ** (8 * int(tk.SQUEEZED[kind][2]) - 1) - 1
    lists = [[rng.choice([0, 1, -1, top, -top - 1, *([None] * (i % 3 == 0))]) for _ in range(n)] for i, n in enumerate([0, 1, 7, 300, 5])]
    array = pa.array([[5], *lists, None], pa.list_({"1": pa.int8(), "2": pa.int16(), "4": pa.int32(), "8": pa.int64()}[tk.SQUEEZED[kind][2]]))[1:]
    got = tk.squeezed(array, kind)
    assert [tk.unsqueezed(x.as_py(), len(own), kind).to_pylist() for x, own in zip(got, lists)] == lists
    assert got[-1].as_py() is None
    text = ("the quick brown fox jumps over the lazy dog " * 30).encode()
    assert len(tk.squeezed(pa.array([list(text)], pa.list_(pa.int32())), "array<int>")[0].as_py()) < 100


def test_pieces_inside_a_bucket_do_not_move_again(spark):
    rows = spark.range(600).select(F.col("id").alias("row"), F.array_repeat(F.col("id").cast("int"), 20).alias("input_ids"))
    found = plan(pack.pack_wrapped(rows, 8, ["row"]))
    assert ", chunk#" not in "".join(line for line in found.splitlines() if "Exchange hashpartitioning(_bucket" in line)
    assert found.count("Exchange hashpartitioning(chunk") == 1  # the joints


@pytest.mark.parametrize("at_once", [1, 50, 10**6])
@pytest.mark.parametrize("bucket_rows", [1, 3, 128])
def test_packing_with_nulls_masks_and_other_lists(spark, monkeypatch, at_once, bucket_rows):
    monkeypatch.setattr(pack, "SLICE_TOKENS", at_once)
    rng = random.Random(11)
    rows = []
    for i in range(60):
        n = rng.choice([0, 1, 3, 9, 70])
        rows.append((i // 25, i * 5, [rng.choice([None, 7, i]) for _ in range(n)], [1] * n, [f"t{k}" for k in range(n)]))
    df = spark.createDataFrame(rows, "file int, row bigint, input_ids array<int>, mask array<tinyint>, names array<string>")
    got = pack.pack_wrapped(df.repartition(3), 8, ["file", "row"], keep_tail=True, columns=("input_ids", "mask", "names"), bucket_rows=bucket_rows)
    assert got.dtypes == [("chunk", "bigint"), ("input_ids", "array<int>"), ("mask", "array<tinyint>"), ("names", "array<string>")]
    got = got.orderBy("chunk").collect()
    for place, c in ((2, "input_ids"), (3, "mask"), (4, "names")):
        flat = [x for r in rows for x in r[place]]
        assert [list(r[c]) for r in got] == [flat[i : i + 8] for i in range(0, len(flat), 8)]
    assert [r.chunk for r in got] == list(range(len(got)))


def test_segments_do_not_move_and_totals_are_those_of_groups(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([0xC3, 0xA9, 32, 33, 65, 256, 0xF0, 0x9F, 300, -1, None]) for _ in range(rng.choice([0, 1, 8, 50]))]) for i in range(200)]
    packed = spark.createDataFrame([*rows, (999, None)], "chunk bigint, input_ids array<int>")
    vocabulary = byte_vocabulary(spark)
    totals = ins.token_segments(ins.by_chunk(packed), vocabulary, ins.segment_totals, ins.TOTALS)
    assert plan(totals).count("Exchange") == 1 and "smallint" in plan(totals)
    held: dict = {}
    for r in ins.token_segments(packed, vocabulary).orderBy("chunk", "segment").collect():
        held.setdefault((r.chunk, r["class"]), []).append(r)
    expected = {
        key: (len(own), sum(r.pos for r in own), sum(r.segment for r in own), sum(len(r.ids) for r in own),
              hashlib.md5("|".join(r.text for r in own).encode()).hexdigest())
        for key, own in held.items()
    }
    assert {tuple(r[:2]): tuple(r[2:]) for r in totals.collect()} == expected


def test_ids_beyond_short_integers_are_dealt_as_they_are(spark):
    rows = [(0, [1 << 20, None]), (1, []), (2, [3])]
    packed = spark.createDataFrame(rows, "chunk bigint, input_ids array<int>")
    for table in (packed, packed.filter("chunk > 0"), packed.filter("chunk > 5")):
        dealt = ins.by_chunk(table)
        assert dealt.dtypes == table.dtypes
        assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, table.collect()))


def test_a_batch_of_texts_becomes_byte_lists_in_parts(monkeypatch):
    monkeypatch.setattr(tx, "BYTES_AT_ONCE", 5)
    texts = [b"abc", None, b"", b"\xc3\xa9", b"0123456789", b"x", b"", None]
    got = list(tx._byte_lists.func(iter([pa.array([b"zz", *texts])[1:], pa.array([], pa.binary())])))
    assert [x for part in got for x in part.to_pylist()] == [None if t is None else list(t) for t in texts]
    assert len(got) > 3 and max(len(part.flatten()) for part in got) <= 10
