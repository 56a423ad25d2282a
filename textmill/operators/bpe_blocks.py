"""Word tables as blocks of symbol ids, and merges over whole blocks.

A block holds up to one Arrow batch of words: their symbol ids in a row, every word closed by
``CLOSE``, and their frequencies. A pass over the blocks costs a few vector operations for each group
of merges that share no symbol, whatever the number of words that hold them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

CLOSE = -1
#: No symbol and no ``CLOSE``.
_NONE = -2
BLOCK_SCHEMA = "symbols binary, freqs binary"
#: Pairs of so few different codes are counted in an array of all codes.
DENSE_CODES = 1 << 20

Merges = list[tuple[str, str]]


def symbol_char(i: int) -> str:
    """The character that stands for symbol ``i``; surrogates are stepped over."""
    code = i + 0x100
    return chr(code if code < 0xD800 else code + 0x800)


def symbol_id(c: str) -> int:
    return ord(c) - 0x100 - (0x800 if ord(c) >= 0xE000 else 0)


def groups_of(merges: Merges) -> list[Merges]:
    """The merges in order, cut where one shares a symbol with an earlier one of its group."""
    groups: list[Merges] = []
    used: set[str] = set()
    for pair, made in merges:
        if not groups or used & {*pair, made}:
            groups.append([])
            used = set()
        groups[-1].append((pair, made))
        used |= {*pair, made}
    return groups


class Group:
    """Merges that share no symbol, as two tables over the left symbol."""

    def __init__(self, merges: Merges, size: int):
        # one place more: CLOSE reads the last one
        self.partner = np.full(size + 1, _NONE, dtype=np.int32)
        self.made = np.zeros(size + 1, dtype=np.int32)
        for (left, right), made in merges:
            self.partner[symbol_id(left)] = symbol_id(right)
            self.made[symbol_id(left)] = symbol_id(made)

    def hits(self, flat: np.ndarray) -> np.ndarray:
        """Places of the left halves, from left to right without overlap."""
        found = np.flatnonzero(self.partner[flat[:-1]] == flat[1:])
        twin = flat[found] == flat[found + 1]
        if twin.any():  # every other place of a run of one symbol
            places = found[twin]
            at = np.arange(places.size)
            begins = np.concatenate(([True], np.diff(places) != 1))
            first = np.maximum.accumulate(np.where(begins, at, 0))
            found = np.sort(np.concatenate((found[~twin], places[(at - first) % 2 == 0])))
        return found

    def join(self, flat: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols after the merges, and which places are left."""
        kept = np.ones(flat.size, dtype=bool)
        kept[found + 1] = False
        joined = flat.copy()
        joined[found] = self.made[flat[found]]
        return joined[kept], kept


def _replayed(flat: np.ndarray, groups: list[Group]) -> np.ndarray:
    for group in groups:
        found = group.hits(flat)
        if found.size:
            flat = group.join(flat, found)[0]
    return flat


def _read(batches: Iterator[pa.RecordBatch], groups: list[Group]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for symbols, freqs in zip(batch.column(0), batch.column(1)):
            flat = np.frombuffer(symbols.as_buffer(), dtype=np.int32)
            yield _replayed(flat, groups), np.frombuffer(freqs.as_buffer(), dtype=np.int64)


class _Counts:
    """Sums of weights per pair code."""

    def __init__(self, size: int):
        self.size = size
        self.dense = np.zeros(size * size, dtype=np.int64) if size * size <= DENSE_CODES else None
        self.sparse: dict[int, int] = {}

    def add(self, flat: np.ndarray, weights: np.ndarray, sign: int = 1, involved: np.ndarray | None = None) -> None:
        """Count the pairs inside words; ``involved`` marks symbols of which a pair must hold one."""
        left, right = flat[:-1], flat[1:]
        inside = (left >= 0) & (right >= 0)
        if involved is not None:
            inside &= involved[left] | involved[right]
        codes = left[inside].astype(np.int64) * self.size + right[inside]
        weights = weights[:-1][inside]
        if self.dense is not None:
            # sums of a block stay below 2**53
            self.dense += sign * np.bincount(codes, weights, self.size * self.size).astype(np.int64)
            return
        distinct, place = np.unique(codes, return_inverse=True)
        sums = np.bincount(place, weights, distinct.size).astype(np.int64)
        for code, n in zip(distinct.tolist(), sums.tolist()):
            self.sparse[code] = self.sparse.get(code, 0) + sign * n

    def batches(self, name: str) -> Iterator[pa.RecordBatch]:
        if self.dense is not None:
            codes = np.flatnonzero(self.dense)
            found = zip(codes.tolist(), self.dense[codes].tolist())
        else:
            found = ((code, n) for code, n in self.sparse.items() if n)
        rows = [(symbol_char(code // self.size) + symbol_char(code % self.size), n) for code, n in found]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in rows], pa.string()), pa.array([n for _, n in rows], pa.int64())], ["pair", name]
        )


def _lengths(flat: np.ndarray) -> np.ndarray:
    """Places of each word, its ``CLOSE`` counted."""
    return np.diff(np.flatnonzero(flat == CLOSE), prepend=-1)


def to_blocks(words: DataFrame) -> DataFrame:
    """``symbols, freqs``: the words of ``symbols, freq``, a block per Arrow batch."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            text = "".join(f"{w or ''}\x00" for w in batch.column(0).to_pylist())
            points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.int32)
            flat = np.where(points == 0, CLOSE, points - 0x100 - np.where(points >= 0xE000, 0x800, 0))
            freqs = batch.column(1).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x.tobytes()], pa.binary()) for x in (flat.astype(np.int32), freqs)], ["symbols", "freqs"]
            )

    return words.select("symbols", "freq").mapInArrow(pack, BLOCK_SCHEMA)


def _over(blocks: DataFrame, run: Callable, merges: Merges, size: int, schema: str) -> DataFrame:
    groups = groups_of(merges)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(_read(batches, [Group(g, size) for g in groups]))

    return blocks.mapInArrow(work, schema)


def folded(blocks: DataFrame, merges: Merges, size: int) -> DataFrame:
    """The blocks after ``merges``; ``size`` is the number of symbols."""

    def run(found):
        for flat, freqs in found:
            yield pa.RecordBatch.from_arrays(
                [pa.array([x.tobytes()], pa.binary()) for x in (flat, freqs)], ["symbols", "freqs"]
            )

    return _over(blocks, run, merges, size, BLOCK_SCHEMA)


def to_words(blocks: DataFrame, merges: Merges, size: int) -> DataFrame:
    """``symbols, freq``: the words after ``merges``, one character per symbol."""

    def run(found):
        for flat, freqs in found:
            points = np.where(flat == CLOSE, 0, flat + 0x100)
            points = np.where(points >= 0xD800, points + 0x800, points).astype(np.uint32)
            words = points.tobytes().decode("utf-32-le").split("\x00")[:-1]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(freqs)], ["symbols", "freq"])

    return _over(blocks, run, merges, size, "symbols string, freq bigint")


def pair_sums(blocks: DataFrame, merges: Merges, size: int) -> DataFrame:
    """``pair, n``: adjacent pairs after ``merges``, weighted by word frequency."""

    def run(found):
        counts = _Counts(size)
        for flat, freqs in found:
            counts.add(flat, np.repeat(freqs, _lengths(flat)))
        yield from counts.batches("n")

    sums = _over(blocks, run, merges, size, "pair string, n bigint")
    return sums.groupBy("pair").agg(F.sum("n").alias("n"))


def pair_changes(blocks: DataFrame, merges: Merges, batch: Merges, size: int) -> DataFrame:
    """``pair, delta``: what ``batch``, a single group, changes after ``merges``. Only words that hold
    one of its pairs are counted, and in these the pairs with a symbol of the batch."""
    symbols = sorted({symbol_id(c) for pair, made in batch for c in pair + made})

    def run(found):
        group, counts = Group(batch, size), _Counts(size)
        involved = np.zeros(size + 1, dtype=bool)
        involved[symbols] = True
        for flat, freqs in found:
            hits = group.hits(flat)
            if not hits.size:
                continue
            lengths = _lengths(flat)
            changed = np.zeros(lengths.size, dtype=bool)
            changed[np.searchsorted(np.cumsum(lengths), hits, side="right")] = True
            old = flat[np.repeat(changed, lengths)]
            weights = np.repeat(freqs[changed], lengths[changed])
            new, kept = group.join(old, group.hits(old))
            counts.add(old, weights, -1, involved)
            counts.add(new, weights[kept], 1, involved)
        yield from counts.batches("delta")

    changes = _over(blocks, run, merges, size, "pair string, delta bigint")
    return changes.groupBy("pair").agg(F.sum("delta").alias("delta"))
