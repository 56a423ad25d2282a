import os
import random
import unicodedata

import regex
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from textmill.functions import text as tx
from textmill.operators.clean import clean_text, min_chars

SAMPLE = "I'LL go 한국어  12345　 x\r\n\n!! ok   ſo １２３ ½ tail  "


def values(spark, rows, column, schema="i int, t string"):
    df = spark.createDataFrame(list(enumerate(rows)), schema)
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_whitespace_is_what_python_strips(spark):
    spaces = [chr(c) for c in range(0x110000) if chr(c).isspace()]
    assert sorted(tx.WHITESPACE) == spaces
    rows = [f"{c}a{c}b{c}" for c in spaces] + ["​a​", "﻿a"]
    assert values(spark, rows, tx.strip_ws("t")) == [r.strip() for r in rows]


def test_drop_invalid_utf8_equals_python_ignore(spark):
    rng = random.Random(3)
    parts = [b"A", b"\xff", b"\xe2\x82", b"\xed\xa0\x80", "😀".encode(), b"\xef\xbf\xbd", b"\x01", b"\xc0\xaf"]
    raw = [b"A\xffB", b"\xed\xa0\x80", "😀".encode(), b""]
    raw += [b"".join(rng.choices(parts, k=6)) for _ in range(400)] + [os.urandom(9) for _ in range(200)]
    got = values(
        spark, [bytearray(r) for r in raw], tx.drop_invalid_utf8(F.col("t").cast("string")), "i int, t binary"
    )
    assert got == [r.decode("utf-8", "ignore") for r in raw]


def test_strip_surrogates_keeps_emoji(spark):
    assert values(spark, ["a😀b"], tx.strip_surrogates("t")) == ["a😀b"]


def test_missing_and_non_string_text_is_empty(spark):
    df = spark.createDataFrame([(1, None), (2, "  ")], "n int, text string")
    assert [r.text for r in clean_text(df).collect()] == ["", ""]
    assert [r.n for r in clean_text(df, "n").collect()] == ["", ""]


def test_gate_counts_code_points_after_stripping(spark):
    rows = ["x" * 99, "x" * 100, "x" * 101, "한" * 100, "😀" * 50 + "x" * 50, "  " + "x" * 98 + "    "]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, text string")
    assert sorted(r.i for r in min_chars(clean_text(df)).collect()) == [1, 2, 3, 4]


def test_nfkc(spark):
    rows = ["plain", "ﬁ １２ Å", "＜tool＞", None]
    assert values(spark, rows, tx.nfkc("t")) == [r and unicodedata.normalize("NFKC", r) for r in rows]


def test_pre_split_equals_regex_and_keeps_every_character(spark):
    rows = [SAMPLE, "", " ", "\n\n a", "don't we'RE", "a\u0085b", "İ ſ's"]
    got = values(spark, rows, tx.pre_split("t"))
    assert got == [regex.findall(tx.PRE_SPLIT, r) for r in rows]
    assert ["".join(g) for g in got] == rows


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab'sLL 1½é한\n\t!_-", max_size=40), min_size=20, max_size=40))
def test_bytes_and_pieces_property(spark, rows):
    assert values(spark, rows, tx.to_bytes("t")) == [list(r.encode()) for r in rows]
    assert values(spark, rows, tx.pre_split("t")) == [regex.findall(tx.PRE_SPLIT, r) for r in rows]


def test_token_class_looks_at_the_first_character(spark):
    rows = ["the", " the", "", "½", "_", "́a", "!", "한"]
    got = values(spark, rows, tx.token_class(F.col("t"), F.lit(False)))
    assert got == ["word", "non_word", "non_word", "word", "word", "non_word", "non_word", "word"]
    assert values(spark, ["x"], tx.token_class(F.col("t"), F.lit(True))) == ["special"]


def test_quick_check_for_nfkc(spark):
    """Random neighbours from all code points, from the runs, and from those that compose."""
    import random
    import unicodedata

    from textmill.functions.text import may_change, nfkc, stable_runs

    rng = random.Random(4)
    every = [chr(p) for p in range(0x110000) if not 0xD800 <= p <= 0xDFFF]
    stable = [chr(p) for a, b in stable_runs() for p in range(a, b + 1)]
    composing = [c for c in every if unicodedata.combining(c) or unicodedata.decomposition(c)] + [chr(p) for p in range(0x1100, 0x1200)]
    rows = [("".join(rng.choices(pool, k=rng.randint(1, 4))),) for pool in (every, stable, composing, stable + composing) for _ in range(4000)]
    rows += [("".join(every[i : i + 3]),) for i in range(0, len(every), 3)]
    table = spark.createDataFrame(rows, "text string").repartition(4)
    got = table.select("text", nfkc("text").alias("form"), may_change(F.col("text")).alias("asked")).collect()
    assert all(r.form == unicodedata.normalize("NFKC", r.text) for r in got)
    assert sum(not r.asked for r in got) > len(got) / 2
    korean = spark.createDataFrame([("caf\u00e9 \uc548\ub155 \u4f60\u597d \u043f\u0440\u0438\u0432\u0435\u0442",)], "text string")
    assert not korean.select(may_change(F.col("text"))).first()[0]
