"""Costs a row or a round must not have, with the same results."""

import random
import unicodedata
from collections import Counter

import pyarrow as pa
import regex

from textmill.functions import text as tx
from textmill.operators import bpe
from textmill.operators.tokenize import SHORT_WORD, WordMerger, merge_word


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_words_are_counted_before_they_move(spark):
    texts = ["a b a'S ﬁ ¼ x\x1cy\x85z", "Ω a b", None, "", "ſ'ſ ŉ ªº 12345 \r\n\n ", "日本 a"] * 3
    freq = bpe.word_freq(spark.createDataFrame([(t,) for t in texts], "text string"))
    expected = Counter(w for t in texts for w in regex.findall(tx.PRE_SPLIT, unicodedata.normalize("NFKC", t or "")))
    assert {r.word: r.freq for r in freq.collect()} == expected
    assert "Generate" not in plan(freq)
    batch = pa.RecordBatch.from_arrays([pa.array(["a a a a"] * 50), pa.array([None] * 50, pa.list_(pa.string()))], ["text", "pieces"])
    [rows] = bpe._counted(iter([batch]))
    assert rows.to_pylist() == [{"word": "a", "n": 50}, {"word": " a", "n": 150}]


def test_latin_split_is_the_split():
    rng, split = random.Random(5), tx.python_split()
    every = [chr(p) for p in range(tx.LATIN_END)] + ["Ω", " "]
    for _ in range(5000):
        text = "".join(rng.choice(every if rng.random() < 0.5 else "'sStTRreVEmMlLdD  \r\n\t1.\x1c\x85\xa0ſ") for _ in range(14))
        assert split(text) == regex.findall(tx.PRE_SPLIT, text)


def test_words_merged_together_are_merged_alone(monkeypatch):
    rng = random.Random(7)
    for dense in (1 << 22, 0):
        monkeypatch.setattr("textmill.operators.tokenize.DENSE_CODES", dense)
        made, ranks = 256, {}
        for rank in rng.sample(range(400), 200):
            pair = rng.randrange(97, 100 if rng.random() < 0.6 else made), rng.randrange(97, 100 if rng.random() < 0.6 else made)
            again = rng.random() < 0.2  # a merge that spells a token that is there already
            ranks.setdefault(pair, (rank, rng.randrange(97, made) if again else made))
            made += not again
        byte_ids = list(range(256))
        words = ["".join(rng.choice("abcd é") for _ in range(rng.randrange(0, 2 * SHORT_WORD))) for _ in range(300)] + ["aaaaaaa", ""]
        got = WordMerger(byte_ids, ranks).merge(words)
        assert [memoryview(x).cast("i").tolist() for x in got] == [merge_word(list(w.encode()), ranks) for w in words]
    assert WordMerger(list(range(256)), {}).merge(["ab", ""]) == [b"a\0\0\0b\0\0\0", b""]
