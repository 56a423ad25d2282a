"""Encoding, decoding and the token table."""

from __future__ import annotations

import heapq
import re
import unicodedata
from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from textmill.functions.text import nfkc, python_split, to_bytes, token_class
from textmill.functions.tokens import append_eos, attention_mask, token_type_ids
from textmill.operators.bpe import ADDED_SCHEMA, BOUNDARY, printable_byte
from textmill.sources.tables import Vocabulary

BYTE_EOS = 256
CACHED_WORDS = 200_000
#: Characters of the texts that are split before their new words are merged together.
SLICE_CHARS = 2_000_000
#: Words of up to so many bytes are merged together, longer ones one by one.
SHORT_WORD = 48
#: Pairs of so few different codes are looked up in an array of all codes.
DENSE_CODES = 1 << 22


class Tokenizer(Protocol):
    eos: int | None

    def encode(self, text: Column) -> Column: ...


class ByteTokenizer:
    """One token per UTF-8 byte; the end id is 256. Stays inside the JVM."""

    def __init__(self, eos: int | None = BYTE_EOS):
        self.eos = eos

    def encode(self, text: Column) -> Column:
        return to_bytes(text)


def byte_vocabulary(spark: SparkSession) -> Vocabulary:
    """The vocabulary of :class:`ByteTokenizer`: 256 bytes, no merges, one boundary token."""
    vocab = spark.createDataFrame(
        [(b, bytearray([b]), printable_byte(b)) for b in range(256)],
        "id int, bytes binary, token string",
    )
    added = spark.createDataFrame([(BYTE_EOS, BOUNDARY, True, True, True, True, True)], ADDED_SCHEMA)
    merges = spark.createDataFrame([], "rank int, left int, right int, id int")
    return Vocabulary(vocab.coalesce(1), merges, added.coalesce(1))


def merge_word(ids: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Apply merges to one word, lowest rank first and leftmost first.

    A heap over linked positions keeps long words (text without spaces) near linear.
    """
    end = len(ids)
    ids, after, before = list(ids), list(range(1, end + 1)), list(range(-1, end - 1))
    heap = [
        (ranks[pair][0], i, pair) for i, pair in enumerate(zip(ids, ids[1:])) if pair in ranks
    ]
    heapq.heapify(heap)
    while heap:
        _, i, pair = heapq.heappop(heap)
        j = after[i]
        if j >= end or (ids[i], ids[j]) != pair:
            continue
        ids[i], ids[j], after[i] = ranks[pair][1], -1, after[j]
        if after[i] < end:
            before[after[i]] = i
        for left in (before[i], i):
            if left >= 0 and after[left] < end:
                new = (ids[left], ids[after[left]])
                if new in ranks:
                    heapq.heappush(heap, (ranks[new][0], left, new))
    return [t for t in ids if t >= 0]


class WordMerger:
    """Merges many words at once, each as :func:`merge_word` does: in every pass each word applies the
    leftmost merge of its lowest rank, and words without one are done. Ids are ``int32`` bytes."""

    def __init__(self, byte_ids: list[int], ranks: dict[tuple[int, int], tuple[int, int]]):
        self.byte_ids, self.ranks = byte_ids, ranks
        self.first = np.array(byte_ids, np.int64)
        self.size = 1 + max([*byte_ids, *(i for pair, (_, made) in ranks.items() for i in (*pair, made))])
        codes = np.array([left * self.size + right for left, right in ranks], np.int64)
        values = np.array(list(ranks.values()), np.int64).reshape(-1, 2)
        # places in the order of ranks; the last one, with the largest, is no merge
        order = np.argsort(values[:, 0])
        self.made = np.append(values[order, 1], -1)
        self.none = len(codes)
        self.dense = None
        if self.size * self.size <= DENSE_CODES:
            self.dense = np.full(self.size * self.size, self.none, np.int64)
            self.dense[codes[order]] = np.arange(self.none)
        else:
            self.at = np.argsort(codes)
            self.codes = codes[self.at]
            place = np.empty(self.none, np.int64)
            place[order] = np.arange(self.none)
            self.place = place[self.at]

    def _places(self, codes: np.ndarray) -> np.ndarray:
        if self.dense is not None:
            return self.dense[codes]
        at = np.minimum(np.searchsorted(self.codes, codes), self.none - 1)
        return np.where(self.codes[at] == codes, self.place[at], self.none)

    def merge(self, words: list[str]) -> list[bytes]:
        """The ids of each word."""
        data = [w.encode() for w in words]
        found: list[bytes] = [b""] * len(data)
        for i, w in enumerate(data):
            if len(w) > SHORT_WORD:
                found[i] = np.array(merge_word([self.byte_ids[b] for b in w], self.ranks), np.int32).tobytes()
        own = np.array([i for i, w in enumerate(data) if 0 < len(w) <= SHORT_WORD], np.int64)
        flat = self.first[np.frombuffer(b"".join(data[i] for i in own.tolist()), np.uint8)]
        sizes = np.array([len(data[i]) for i in own.tolist()], np.int64)
        while len(own):
            n, ends = len(flat), np.cumsum(sizes)
            places = np.full(n, self.none, np.int64)
            if self.none:
                places[:-1] = self._places(flat[:-1] * self.size + flat[1:])
                places[ends - 1] = self.none
            best = np.minimum.reduceat(places * n + np.arange(n), ends - sizes)
            more = best < self.none * n
            done = ~more
            if done.any():
                raw = flat[np.repeat(done, sizes)].astype(np.int32).tobytes()
                stops = (4 * np.cumsum(sizes[done])).tolist()
                for i, begin, stop in zip(own[done].tolist(), [0, *stops], stops):
                    found[i] = raw[begin:stop]
            place, at = np.divmod(best[more], n)
            flat[at] = self.made[place]
            kept = np.repeat(more, sizes)
            kept[at + 1] = False
            flat, own, sizes = flat[kept], own[more], sizes[more] - 1
        return found


def _isolating(tokens: list[str]) -> re.Pattern:
    """Pattern whose ``split`` puts the given tokens at odd places."""
    longest_first = sorted(tokens, key=len, reverse=True)
    return re.compile("(" + "|".join(map(re.escape, longest_first)) + ")" if tokens else "((?!))")


class BpeTokenizer:
    """Encodes with a trained vocabulary, one Arrow batch at a time and without a shuffle.

    The merge table is broadcast; it has fewer rows than the vocabulary size asked for. Added
    tokens are cut out first: those marked ``normalized`` from the normalised text, the others from
    the raw text. Each task remembers the words it has met; the new words of some texts are merged together.
    """

    def __init__(self, vocabulary: Vocabulary):
        added = vocabulary.added.collect()
        ends = [r.id for r in added if r.eos]
        self.eos = ends[0] if ends else None
        single = {r.bytes[0]: r.id for r in vocabulary.vocab.filter(F.length("bytes") == 1).collect()}
        ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for r in vocabulary.merges.orderBy("rank").collect():
            ranks.setdefault((r.left, r.right), (r.rank, r.id))
        self.tables = vocabulary.vocab.sparkSession.sparkContext.broadcast(
            {
                "bytes": [single[b] for b in range(256)],
                "ranks": ranks,
                "raw": {r.token: r.id for r in added if not r.normalized},
                "normal": {r.token: r.id for r in added if r.normalized},
            }
        )

    def encode(self, text: Column) -> Column:
        tables = self.tables

        @F.arrow_udf("array<int>")
        def encode_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            known = tables.value
            byte_ids, ranks, raw, normal = (known[k] for k in ("bytes", "ranks", "raw", "normal"))
            cut_raw, cut_normal = _isolating(list(raw)), _isolating(list(normal))
            split, merger = python_split(), WordMerger(byte_ids, ranks)
            words: dict[str, bytes] = {}

            def parts(value: str) -> list[list[str] | bytes]:
                """Pieces of text, and the ids of added tokens between them."""
                cut: list[list[str] | bytes] = []
                for i, part in enumerate(cut_raw.split(value)):
                    if i % 2:
                        cut.append(np.int32(raw[part]).tobytes())
                        continue
                    for k, segment in enumerate(cut_normal.split(unicodedata.normalize("NFKC", part))):
                        cut.append(np.int32(normal[segment]).tobytes() if k % 2 else split(segment))
                return cut

            def encode_some(values: list[str]) -> list[np.ndarray]:
                cut = [parts(v) for v in values]
                if len(words) >= CACHED_WORDS:
                    words.clear()
                new = list({w for text in cut for part in text if type(part) is list for w in part if w not in words})
                words.update(zip(new, merger.merge(new)))
                found = words.__getitem__
                joined = (b"".join(p if type(p) is bytes else b"".join(map(found, p)) for p in text) for text in cut)
                return [np.frombuffer(ids, np.int32) for ids in joined]

            def slices(batch: pa.Array) -> Iterator[list[str]]:
                held, size = [], 0
                for value in batch:
                    held.append(value.as_py() or "")
                    size += len(held[-1])
                    if size >= SLICE_CHARS:
                        yield held
                        held, size = [], 0
                yield held

            for batch in batches:
                encoded = [ids for values in slices(batch) for ids in encode_some(values)]
                offsets = np.zeros(len(encoded) + 1, dtype=np.int32)
                np.cumsum([len(e) for e in encoded], out=offsets[1:])
                values = np.concatenate(encoded) if encoded else np.zeros(0, dtype=np.int32)
                yield pa.ListArray.from_arrays(offsets, values)

        return encode_batches(text)


def encode_bpe(df: DataFrame, vocabulary: Vocabulary, col: str = "text") -> DataFrame:
    """Add ``input_ids``."""
    return df.withColumn("input_ids", BpeTokenizer(vocabulary).encode(F.col(col)))


def tokenize(
    df: DataFrame,
    tokenizer: Tokenizer,
    order: list[str],
    col: str = "text",
    masks: bool = False,
    with_token_types: bool = False,
) -> DataFrame:
    """Replace the input columns by token columns; only the order key stays.

    ``masks`` adds ``attention_mask`` (ones) and ``with_token_types`` adds ``token_type_ids``
    (zeros), both as long as the ids with their end token.
    """
    out = df.select(*order, append_eos(tokenizer.encode(F.col(col)), tokenizer.eos).alias("input_ids"))
    if masks:
        out = out.withColumn("attention_mask", attention_mask("input_ids"))
    if with_token_types:
        out = out.withColumn("token_type_ids", token_type_ids("input_ids"))
    return out


def token_table(vocabulary: Vocabulary) -> DataFrame:
    """``id, hex, text, class`` for every token; at most as many rows as the vocabulary."""
    learned = vocabulary.vocab.select("id", "bytes", F.lit(False).alias("special"))
    added = vocabulary.added.select("id", F.encode("token", "UTF-8").alias("bytes"), "special")
    text = F.make_valid_utf8(F.col("bytes").cast("string"))
    return learned.unionByName(added).select(
        "id",
        F.hex("bytes").alias("hex"),
        text.alias("text"),
        token_class(text, F.col("special")).alias("class"),
    )


class TokenLookup:
    """Token bytes and classes as array literals, so decoding is an expression without a join.

    Their size is that of the vocabulary.
    """

    def __init__(self, vocabulary: Vocabulary):
        rows = {r.id: r for r in token_table(vocabulary).collect()}
        size = max(rows) + 1
        held = [rows[i].hex if i in rows else "" for i in range(size)]
        self.token_bytes = [bytes.fromhex(x) for x in held]
        self.class_names = [rows[i]["class"] if i in rows else "" for i in range(size)]
        self.hex = self._literal(held)
        self.classes = self._literal(self.class_names)

    @staticmethod
    def _literal(values: list[str]) -> Column:
        return F.split(F.lit(",".join(values)), ",")

    def decode(self, ids: Column) -> Column:
        """Text of an id array; broken byte runs become U+FFFD, ids outside the vocabulary nothing."""
        joined = F.array_join(F.transform(ids, lambda i: F.get(self.hex, i)), "")
        return F.make_valid_utf8(F.unhex(joined).cast("string"))

    def class_of(self, token_id: Column) -> Column:
        return F.get(self.classes, token_id)


def decode(
    df: DataFrame, vocabulary: Vocabulary, ids: str = "input_ids", out: str = "text"
) -> DataFrame:
    return df.withColumn(out, TokenLookup(vocabulary).decode(F.col(ids)))


def roundtrip_check(df: DataFrame, vocabulary: Vocabulary, col: str = "text") -> DataFrame:
    """One row: rows, and rows where decode(encode(x)) is not the NFKC form of x.

    Text inside an added token marked as not normalised is kept as it is; every added token is
    ASCII, so NFKC leaves it alone as well.
    """
    back = TokenLookup(vocabulary).decode(BpeTokenizer(vocabulary).encode(F.col(col)))
    return df.select((back != nfkc(F.col(col))).alias("differs")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(F.col("differs"), F.lit(1))).alias("mismatches"),
    )

