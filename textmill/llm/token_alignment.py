"""Alignment of the tokens of two tokenizers by byte ranges.

``A`` is a byte-level vocabulary of the tokenizers library, ``B`` a sentencepiece model that puts a
space before the text. Both see a space and the text. Byte offsets at which tokens of both end cut the
tokens into groups; all tokens of a group are linked with each other.

A text is a sequence of units, each a space and what follows up to the next space behind something
visible: no token of either side crosses such a place. A byte range of a text yields a *fragment*:
tokens are those that end in the range, ``prefix`` are the tokens before its first common end,
``groups`` the closed groups and ``suffix`` the tokens behind its last common end. Fragments form a
monoid: ``(p, g, s) + (q, h, t)`` closes ``s`` and ``q`` as one group and has ``p`` and ``t`` open. Texts of more than ``LONG`` characters become byte ranges that different tasks
turn into fragments; a tree of groups of ``FAN`` neighbours composes them. A unit that crosses a
border is tokenized on both sides, each side keeps the tokens ending in its range; a border inside a
unit longer than a range is left out, since a unit cannot be cut.

How many documents hold a pair of ids linked is counted over all documents. Counts of the most
frequent pairs (at most ``HEAD``) are broadcast, the others are joined.

A text that is null, empty or not given back byte for byte by both sides has no tokens: zeros and an
empty ``groups``. Rows that repeat, ids too, are documents of their own; extra columns do not matter;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from textmill.llm.bounded import frequency_class, least_class
from textmill.llm.public_bpe import _BYTE_SIGNS, _PRINTABLE, KEEP_SPACE, PieceEncoder
from textmill.storage import stage_table

#: Characters of a byte range, and of a text from which on it is cut into ranges.
RANGE, LONG = 200_000, 800_000
#: Neighbouring fragments composed by one task.
FAN = 8
#: Pairs whose counts are broadcast.
HEAD = 131_072
#: Characters of short texts aligned at once.
TOGETHER = 1_000_000
#: Links of a group up to which they are listed; a larger group is counted by distinct ids.
LISTED = 256

_CUT = re.compile("(?<=[^\\s▁])(?= )")
_PAIR = 1 << 32

Ids = tuple[np.ndarray, np.ndarray]  # of A and of B


class _CheckedPieces(PieceEncoder):
    """Compares the bytes of a piece when it is new. As long as no piece has ``others``, those of a text,
    which is its pieces joined, are right."""

    others, table = False, None

    def _encoded(self, piece: str) -> bytes:
        ids = super()._encoded(piece)
        own = b"".join(map(self.table.__getitem__, np.frombuffer(ids, np.int32).tolist()))
        self.others |= own != piece.encode()
        return ids


class Tokenizers:
    """Ids and byte lengths of both sides; ``B`` brings the space in front with it."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self._a = _CheckedPieces(a_path, KEEP_SPACE)
        self._b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self._bytes = _byte_level(self._a._tokenizer), _pieces(self._b)
        self._a.table = self._bytes[0]
        self._lengths = tuple(np.array([len(t) for t in table], np.int64) for table in self._bytes)
        self.sizes = tuple(map(len, self._bytes))
        self._space = self._b.encode("a ")[len(self._b.encode("a")) :]
        # every id with each of the signs that may follow it
        self.written = [f"{i}{sign}" for sign in ",|;" for i in range(max(self.sizes))]

    def tokens(self, spaced: str) -> tuple[Ids, Ids] | None:
        """Ids and byte ends of whole units, of which the first begins with a space; None if the bytes
        of a side are others."""
        b = self._b.encode(spaced[1:]) if len(spaced) > 1 else self._space
        a, data = self._a.encode(spaced), spaced.encode()
        if self._a.others and b"".join(map(self._bytes[0].__getitem__, a.tolist())) != data:
            return None
        if b"".join(map(self._bytes[1].__getitem__, b)) != data:
            return None
        ids = a.astype(np.int64), np.array(b, np.int64)
        return ids, tuple(np.cumsum(length[own]) for own, length in zip(ids, self._lengths))


@lru_cache(maxsize=1)
def tokenizers_at(a_path: str, b_path: str) -> Tokenizers:
    """Loaded once per worker process."""
    return Tokenizers(a_path, b_path)


def _byte_level(tokenizer) -> list[bytes]:
    byte_of = {chr(b): b for b in _PRINTABLE} | {chr(sign): b for b, sign in _BYTE_SIGNS.items()}
    table = [b""] * tokenizer.get_vocab_size()
    for token, i in tokenizer.get_vocab().items():
        if all(c in byte_of for c in token):
            table[i] = bytes(byte_of[c] for c in token)
    return table


def _pieces(model) -> list[bytes]:
    table = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if "▁" in piece.lstrip("▁"):
            raise ValueError("pieces of the model cross words")
        table.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return table


def summed(keys: np.ndarray, times: np.ndarray) -> Ids:
    """Distinct keys, rising, and the sums of their times."""
    if not len(keys):
        return keys, times
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[starts], np.add.reduceat(times, starts)


class Groups:
    """Closed groups of tokens whose ends rise and whose last ends are equal; ``owner`` tells for the
    end of a group which text it belongs to."""

    def __init__(self, ids: Ids, ends: Ids, tokenizers: Tokenizers, owner=None):
        self._ids, self._tables = ids, tokenizers
        common = np.intersect1d(*ends, assume_unique=True)
        self._at = tuple(np.searchsorted(common, e) for e in ends)  # group of a token
        self.sizes = tuple(np.bincount(at, minlength=len(common)) for at in self._at)
        self.owner = np.zeros(len(common), np.int64) if owner is None else owner(common)

    def text(self) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``Tokenizers.written`` in order, and the owner of each."""
        (a, b), (at_a, at_b), (in_a, in_b) = self._ids, self._at, self.sizes
        before_b = np.cumsum(in_b) - in_b
        upto_a = np.cumsum(in_a)
        v = max(self._tables.sizes)
        codes = np.empty(len(a) + len(b), np.int64)
        owner = np.empty(len(codes), np.int64)
        for own, at, place, sign in ((a, at_a, np.arange(len(a)) + before_b[at_a], v), (b, at_b, np.arange(len(b)) + upto_a[at_b], 2 * v)):
            last = np.append(at[1:] != at[:-1], True)
            codes[place] = own + np.where(last, sign, 0)
            owner[place] = self.owner[at]
        return codes, owner

    def numbers(self, texts: int = 1) -> np.ndarray:
        """Per text: tokens of A, of B, groups, links."""
        in_a, in_b = self.sizes
        rows = np.zeros((texts, 4), np.int64)
        for i, n in enumerate((in_a, in_b, np.ones_like(in_a), in_a * in_b)):
            np.add.at(rows[:, i], self.owner, n)
        return rows

    def pairs(self, texts: int = 1) -> list[Ids]:
        """Per text: linked pairs of ids, rising, and how often."""
        (a, b), (at_a, _), (in_a, in_b) = self._ids, self._at, self.sizes
        vb = self._tables.sizes[1]
        span = self._tables.sizes[0] * vb
        before = [np.cumsum(n) - n for n in self.sizes]
        listed = in_a * in_b <= LISTED
        mine = listed[at_a]
        group = at_a[mine]
        times = in_b[group]
        inside = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        partner = b[np.repeat(before[1][group], times) + inside]
        keys = [np.repeat(self.owner[group] * span + a[mine] * vb, times) + partner]
        counts = [np.ones(len(keys[0]), np.int64)]
        for g in np.flatnonzero(~listed):  # as long as the text may be, distinct ids are not
            (x, n), (y, m) = (np.unique(own[first : first + size], return_counts=True)
                              for own, first, size in zip((a, b), (before[0][g], before[1][g]), (in_a[g], in_b[g])))
            keys.append((self.owner[g] * span + x[:, None] * vb + y[None, :]).ravel())
            counts.append(np.outer(n, m).ravel())
        keys, counts = summed(np.concatenate(keys), np.concatenate(counts))
        pair = keys % span
        pair = pair // vb * _PAIR + pair % vb
        borders = np.searchsorted(keys, np.arange(texts + 1) * span)
        return [(pair[p:q], counts[p:q]) for p, q in zip(borders[:-1], borders[1:])]


class Fragment:
    """Open prefix, closed groups and open suffix of a byte range. Without a common end all tokens
    are in ``prefix``. Closed groups are kept as text, numbers and pairs with their times."""

    def __init__(self, prefix: Ids | None = None):
        none = np.zeros(0, np.int64)
        self.prefix, self.suffix = prefix or (none, none), (none, none)
        self.closed = False
        self.groups: list[str] = []
        self.numbers = np.zeros(4, np.int64)  # tokens of A, of B, groups, links
        self.pairs = (none, none)

    @classmethod
    def of(cls, ids: Ids, ends: Ids, tokenizers: Tokenizers) -> Fragment:
        common = np.intersect1d(*ends, assume_unique=True)
        if not len(common):
            return cls(ids)
        first, last = ([int(np.searchsorted(e, c, side="right")) for e in ends] for c in (common[0], common[-1]))
        # what lies before the first common end may have begun further left
        made = cls(tuple(x[:i] for x, i in zip(ids, first)))
        made.closed, made.suffix = True, tuple(x[i:] for x, i in zip(ids, last))
        made._close(*[tuple(x[i:j] for x, i, j in zip(xs, first, last)) for xs in (ids, ends)], tokenizers)
        return made

    def _close(self, ids: Ids, ends: Ids, tokenizers: Tokenizers) -> None:
        if not len(ids[0]):
            return
        groups = Groups(ids, ends, tokenizers)
        codes, _ = groups.text()
        self.groups.append("".join(map(tokenizers.written.__getitem__, codes.tolist()))[:-1])
        self.numbers = self.numbers + groups.numbers()[0]
        self._add(groups.pairs()[0])

    def _seam(self, ids: Ids, tokenizers: Tokenizers) -> None:
        """One group that is closed now; its ends do not matter but for the last."""
        self._close(ids, tuple(np.append(np.arange(len(x) - 1) * 2 + odd, 1 << 40) for odd, x in enumerate(ids)), tokenizers)

    def _add(self, pairs: Ids) -> None:
        self.pairs = summed(*(np.concatenate([x, y]) for x, y in zip(self.pairs, pairs)))

    def plus(self, other: Fragment, tokenizers: Tokenizers) -> Fragment:
        made = Fragment(self.prefix if self.closed else _joined(self.prefix, other.prefix))
        made.closed = self.closed or other.closed
        if other.closed:
            made.suffix = other.suffix
        elif self.closed:
            made.suffix = _joined(self.suffix, other.prefix)
        made.groups += self.groups
        made.numbers = self.numbers + other.numbers
        made._add(self.pairs)
        made._add(other.pairs)
        if self.closed and other.closed:
            made._seam(_joined(self.suffix, other.prefix), tokenizers)
        made.groups += other.groups
        return made

    def finished(self, tokenizers: Tokenizers) -> Fragment:
        """The fragment of a whole text, which begins and ends at common ends."""
        made = Fragment()
        made.closed = True
        made._seam(self.prefix, tokenizers)
        made.groups += self.groups
        made.numbers = made.numbers + self.numbers
        made._add(self.pairs)
        return made


def _joined(one: Ids, two: Ids) -> Ids:
    return tuple(np.concatenate([x, y]) for x, y in zip(one, two))


def aligned(texts: list[str | None], tokenizers: Tokenizers) -> list[tuple | None]:
    """``numbers, groups, pairs, times`` of whole texts; None for one without tokens."""
    found: list[tuple | None] = [None] * len(texts)
    owners, ids, ends, start = [], [], [], [0]
    for i, text in enumerate(texts):
        tokens = tokenizers.tokens(" " + text) if text else None
        if tokens:
            owners.append(i)
            ids.append(tokens[0])
            ends.append(tuple(e + start[-1] for e in tokens[1]))
            start.append(int(ends[-1][0][-1]))
    if not owners:
        return found
    last = np.array(start[1:])
    joined = [tuple(map(np.concatenate, zip(*x))) for x in (ids, ends)]
    groups = Groups(*joined, tokenizers, lambda common: np.searchsorted(last, common))
    codes, owner = groups.text()
    written = list(map(tokenizers.written.__getitem__, codes.tolist()))
    borders = np.searchsorted(owner, np.arange(len(owners) + 1))
    numbers, pairs = groups.numbers(len(owners)), groups.pairs(len(owners))
    for k, i in enumerate(owners):
        found[i] = (numbers[k], "".join(written[borders[k] : borders[k + 1]])[:-1], *pairs[k])
    return found


def ranges(text: str, size: int) -> list[tuple[int, int, int, int]]:
    """``(first, begin, end, last)`` in characters: the range ``[begin, end)`` and the whole units
    ``[first, last)`` around it."""
    cuts = np.array([0, *(m.start() for m in _CUT.finditer(text)), len(text)])
    borders = [0]
    for border in range(size, len(text), size):
        after = cuts[np.searchsorted(cuts, border)]
        before = cuts[np.searchsorted(cuts, border, side="right") - 1]
        if after - before <= size:
            borders.append(border)
    borders.append(len(text))
    return [
        (int(cuts[np.searchsorted(cuts, b, side="right") - 1]), b, e, int(cuts[np.searchsorted(cuts, e)]))
        for b, e in zip(borders[:-1], borders[1:])
    ]


_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")
_RESULT = ", ".join(f"{n} bigint" for n in _NUMBERS) + ", groups_sha256 string, pairs array<bigint>, times array<bigint>"


def _lists(rows: list, kind=pa.int64()) -> pa.Array:
    """A list column; null rows are empty."""
    sizes = [0 if r is None else len(r) for r in rows]
    offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int32)
    full = [r for r in rows if r is not None and len(r)]
    values = np.concatenate(full) if full else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def _aligned(documents: DataFrame, doc_id: str, text: str, a_path: str, b_path: str, size: int, long: int) -> DataFrame:
    """``row, doc_id`` and results of short texts; long ones become rows ``part, skip, keep, range`` with
    the units of a range, the bytes before it and its own bytes."""
    own = {"row": LongType(), "doc_id": documents.schema[doc_id].dataType, "part": IntegerType(), "skip": LongType(), "keep": LongType(), "range": StringType()}
    schema = StructType([StructField(n, t) for n, t in own.items()] + StructType.fromDDL(_RESULT).fields)

    def run(batches):
        tokenizers = tokenizers_at(a_path, b_path)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            id_type = batch.schema.field(0).type
            held: list[tuple] = []
            chars = 0

            def done():
                results = aligned([t for _, _, t in held], tokenizers)
                rows = [(r, own, None, None, None, None, one) for (r, own, _), one in zip(held, results)]
                held.clear()
                return _batch(rows, id_type)

            for own, value in zip(batch.column(0), batch.column(1)):
                value = value.as_py()
                if value is not None and len(value) > long:
                    # ranges are rows of their own, so that no batch grows with the text
                    whole = " " + value
                    for part, (first, begin, end, last) in enumerate(ranges(whole, size)):
                        skip, keep = len(whole[first:begin].encode()), len(whole[begin:end].encode())
                        yield _batch([(row, own, part, skip, keep, whole[first:last], None)], id_type)
                else:
                    held.append((row, own, value))
                    chars += len(value or "")
                row += 1
                if chars > TOGETHER:
                    yield done()
                    chars = 0
            if held:
                yield done()

    def _batch(rows, id_type):
        done = [r[6] for r in rows]
        numbers = [[int(d[0][i]) if d else 0 for d in done] for i in range(4)]
        sums = [hashlib.sha256(d[1].encode()).hexdigest() if d else "" for d in done]
        columns = [
            pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1].as_py() for r in rows], id_type),
            pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.int64()),
            pa.array([r[4] for r in rows], pa.int64()), pa.array([r[5] for r in rows], pa.string()),
            *[pa.array(n, pa.int64()) for n in numbers], pa.array(sums, pa.string()),
            _lists([d and d[2] for d in done]), _lists([d and d[3] for d in done]),
        ]
        return pa.RecordBatch.from_arrays(columns, schema.names)

    rows = documents.select(doc_id, F.col(text).cast("string")).mapInArrow(run, schema)
    return stage_table(rows, "aligned")


_FRAGMENT = (
    "row bigint, part int, ok boolean, closed boolean, prefix array<array<bigint>>, suffix array<array<bigint>>, "
    "groups string, numbers array<bigint>, pairs array<bigint>, times array<bigint>"
)


def _packed(row: int, part: int, fragment: Fragment | None) -> dict:
    """A fragment as a row; None is a range whose bytes are not given back."""
    f = fragment or Fragment()
    return {
        "row": row, "part": part, "ok": fragment is not None, "closed": f.closed,
        "prefix": [x.tolist() for x in f.prefix], "suffix": [x.tolist() for x in f.suffix], "groups": ";".join(f.groups),
        "numbers": f.numbers.tolist(), "pairs": f.pairs[0].tolist(), "times": f.pairs[1].tolist(),
    }


def _unpacked(row) -> Fragment | None:
    if not row.ok:
        return None
    made = Fragment()
    made.prefix, made.suffix = (tuple(np.array(side, np.int64) for side in sides) for sides in (row.prefix, row.suffix))
    made.closed = bool(row.closed)
    made.groups = [row.groups] if row.groups else []
    made.numbers = np.array(row.numbers, np.int64)
    made.pairs = np.array(row.pairs, np.int64), np.array(row.times, np.int64)
    return made


def _composed(chunks: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Results of the long texts, as rows of ``_RESULT`` with ``row``."""

    def run(batches):
        tokenizers = tokenizers_at(a_path, b_path)
        for batch in batches:
            for one in batch.to_pylist():
                tokens = tokenizers.tokens(one["range"])
                fragment = None
                if tokens is not None:
                    # ends count from the range on; a range has the tokens that end in it
                    ends = tuple(e - one["skip"] for e in tokens[1])
                    inside = [(e > 0) & (e <= one["keep"]) for e in ends]
                    ids, ends = (tuple(x[m] for x, m in zip(xs, inside)) for xs in (tokens[0], ends))
                    fragment = Fragment.of(ids, ends, tokenizers)
                yield pa.RecordBatch.from_pylist([_packed(one["row"], one["part"], fragment)], schema=arrow)

    arrow, result_arrow = (to_arrow_schema(StructType.fromDDL(s)) for s in (_FRAGMENT, "row bigint, " + _RESULT))
    most = chunks.agg(F.max("part")).first()[0]
    spread = chunks.select("row", "part", "skip", "keep", "range").repartition("row", "part")
    fragments = stage_table(spread.mapInArrow(run, _FRAGMENT), "fragments")

    def compose(group: pd.DataFrame) -> pd.DataFrame:
        total, ok, tokenizers = None, True, tokenizers_at(a_path, b_path)
        for one in group.sort_values("part").itertuples():
            fragment = _unpacked(one)
            ok = ok and fragment is not None
            if not ok:
                break
            total = fragment if total is None else total.plus(fragment, tokenizers)
        row, part = int(group["row"].iloc[0]), int(group["part"].min()) // FAN
        return pd.DataFrame([_packed(row, part, total if ok else None)])

    while most > 0:
        merged = fragments.groupBy("row", F.floor(F.col("part") / FAN).alias("_up")).applyInPandas(
            lambda group: compose(group), _FRAGMENT
        )
        fragments = stage_table(merged, "fragments")
        most //= FAN

    def finish(batches):
        tokenizers = tokenizers_at(a_path, b_path)
        for batch in batches:
            rows = []
            for one in pd.DataFrame(batch.to_pylist()).itertuples() if batch.num_rows else ():
                whole = _unpacked(one)
                whole = whole and whole.finished(tokenizers)
                rows.append({
                    "row": one.row, **dict(zip(_NUMBERS, whole.numbers.tolist() if whole else [0] * 4)),
                    "groups_sha256": hashlib.sha256(";".join(whole.groups).encode()).hexdigest() if whole else "",
                    "pairs": whole.pairs[0].tolist() if whole else [], "times": whole.pairs[1].tolist() if whole else [],
                })
            yield pa.RecordBatch.from_pylist(rows, schema=result_arrow)

    return stage_table(fragments.mapInArrow(finish, "row bigint, " + _RESULT), "composed")


def pair_counts(held: DataFrame) -> DataFrame:
    """``pair, a, b, documents, best`` of every linked pair of ids; ``best`` marks those with the
    most documents of their ``a``."""
    counts = held.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("documents"))
    counts = stage_table(counts.withColumn("a", F.shiftright("pair", 32)), "pair_counts")
    # one row per id: at most the vocabulary, and at most the other vocabulary share a key
    most = stage_table(counts.groupBy("a").agg(F.max("documents").alias("_most")), "pair_most")
    joined = counts.join(most, "a")
    return stage_table(
        joined.select("pair", "a", F.col("pair").bitwiseAND(_PAIR - 1).alias("b"), "documents", (F.col("documents") == F.col("_most")).alias("best")),
        "pair_best",
    )


def _scored(held: DataFrame, counts: DataFrame, head: int) -> DataFrame:
    """``row, n_best, count_sum`` of every document."""
    least = least_class(counts, "documents", head)
    top = counts.filter(frequency_class("documents") >= least) if least is not None else counts.limit(0)
    top = sorted(top.select("pair", "documents", "best").collect())
    table = held.sparkSession.sparkContext.broadcast((
        np.array([r[0] for r in top], np.int64), np.array([r[1] for r in top], np.int64), np.array([r[2] for r in top], bool),
    ))

    def run(batches):
        for batch in batches:
            keys, documents, best = table.value
            sums, rest = [[], []], [[], []]
            pairs, times = batch.column(1), batch.column(2)
            for i in range(batch.num_rows):
                own, n = pairs[i].values.to_numpy(), times[i].values.to_numpy()
                at = np.searchsorted(keys, own)
                known = at < len(keys)
                known[known] = keys[at[known]] == own[known]
                at, m = at[known], n[known]
                sums[0].append(int(m[best[at]].sum()))
                sums[1].append(int((m * documents[at]).sum()))
                rest[0].append(own[~known])
                rest[1].append(n[~known])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(s, pa.int64()) for s in sums], *map(_lists, rest)],
                ["row", "n_best", "count_sum", "pairs", "times"],
            )

    schema = "row bigint, n_best bigint, count_sum bigint, pairs array<bigint>, times array<bigint>"
    first = stage_table(held.select("row", "pairs", "times").mapInArrow(run, schema), "head_scores")
    tail = first.select("row", F.inline(F.arrays_zip("pairs", "times"))).select("row", F.col("pairs").alias("pair"), F.col("times").alias("n"))
    added = tail.join(counts.select("pair", "documents", "best"), "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("_best"), F.sum(F.col("n") * F.col("documents")).alias("_sum")
    )
    return first.select("row", "n_best", "count_sum").join(added, "row", "left").select(
        "row",
        (F.col("n_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum"),
    )


def align(
    documents: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text",
    size: int = RANGE, long: int = LONG, head: int = HEAD,
) -> tuple[DataFrame, DataFrame]:
    """One row per document, ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``,
    and the table ``pair, a, b, documents, best`` of linked ids."""
    rows = _aligned(documents, doc_id, text, a_path, b_path, size, long)
    chunks = rows.filter("part is not null")
    held = rows.filter("part is null").select("row", "doc_id", *StructType.fromDDL(_RESULT).names)
    if chunks.head(1):
        owners = chunks.filter("part = 0").select("row", "doc_id")
        long_ones = owners.join(_composed(chunks, a_path, b_path), "row")
        held = held.unionByName(long_ones)
    counts = pair_counts(held)
    scores = _scored(held, counts, head)
    joined = held.drop("pairs", "times").join(scores, "row")
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return joined.select(F.col("doc_id").alias(doc_id), *names), counts
