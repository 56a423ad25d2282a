"""Similarity join of documents by PartEnum signatures.

A document is the set of its distinct word shingles; equal sets are one node. Two sets of sizes m and
n whose Jaccard similarity is at least s differ in at most ``k = (1 - s) / (1 + s) * (m + n)`` shingles.
Sizes are cut into bands; a set takes part in its own band and, if a larger partner may lie there, in
the next one. For every band the shingles' hashes are cut into ``k // 2 + 1`` parts of three cells. Some
part holds at most one of the ``k`` differences, so at least two of its cells are equal: the
signatures of a set are, for every part, the three pairs of cells. **Two sets that link share a
signature**, for certain.

Empty cells would give signatures that many sets share. A set has as many equal parts as above with
each partner, so a set with fewer than that many parts of two empty cells needs no signature of empty
cells; the rule is the same for both partners.

Pass 1 takes the first ``EARLY`` parts of a band only, and from the sets that share a signature there
a minimum spanning forest, ``NEAR`` sets at a time. Pass 2 takes all signatures whose sets
are not in one component yet, and compares every pair between different components, in blocks. Both
leave out pairs by a bound that cannot err: every set has one byte per cell of ``CELLS`` fixed cells, and
sets differ in at least as many shingles as in cells. All pairs that are left are confirmed on full sets.

A null, empty or blank text has no shingles and is linked with nothing; fewer words than a shingle
are one shingle. Rows that repeat, ids too, are rows of one node. A null id never is the smallest; a
component of null ids has a null id. Long texts are taken whole. An empty table gives an empty
result; extra columns do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from textmill.llm.components import components
from textmill.llm.lsh_forest import confirmed, digest, shingles
from textmill.storage import stage_table

#: Size of a band as a multiple of its least size.
GROWTH = 1.25
#: Parts of a band looked at in pass 1.
EARLY = 8
#: Nodes of a signature compared with each other at once: in pass 1, and per block in pass 2.
NEAR, BLOCK = 1024, 256
#: Cells with a byte each, to bound the difference of two sets from below.
CELLS = 256

_MIX = np.uint64(0x9E3779B97F4A7C15)


class Bands:
    """Bands of sizes for one threshold in per cent."""

    def __init__(self, similar: int):
        self.similar = similar
        self._starts = [1]

    def differences(self, total) -> int:
        """Shingles in which two sets of ``total`` shingles together may differ."""
        return (100 - self.similar) * total // (100 + self.similar)

    def _start(self, band: int) -> int:
        while len(self._starts) <= band:
            last = self._starts[-1]
            # a partner of a set lies in its band or the next one
            self._starts.append(max(last + 1, int(last * max(GROWTH, 100 / self.similar))))
        return self._starts[band]

    def of(self, size: int) -> list[tuple[int, int]]:
        """``(band, parts)`` in which a set of ``size`` looks for partners; none if only an equal set
        can be one."""
        band = 0
        while self._start(band + 1) <= size:
            band += 1
        bands = [band]
        if 100 * size >= self.similar * self._start(band + 1):
            bands.append(band + 1)
        return [(b, k // 2 + 1) for b in bands if (k := self.differences(2 * (self._start(b + 1) - 1)))]


def _cells(hashes: np.ndarray, cells: int) -> np.ndarray:
    """A 64-bit sum per cell of sorted hashes; 0 is an empty cell."""
    edges = np.searchsorted(hashes >> np.uint64(32), (np.arange(cells + 1, dtype=np.uint64) << np.uint64(32)) // np.uint64(cells))
    mixed = (hashes ^ (hashes >> np.uint64(31))) * _MIX | np.uint64(1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)])
    return sums[edges[1:]] - sums[edges[:-1]]


def signatures(hashes: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of the first parts of each band, and of the others."""
    early, late = [], []
    for band, parts in bands.of(len(hashes)):
        edge = 2 * (bands._start(band + 1) - 1)
        cells = _cells(hashes, 3 * parts).reshape(parts, 3)
        pairs = cells[:, [0, 0, 1]] * np.uint64(0xD6E8FEB86659FD93) + (cells[:, [1, 2, 2]] ^ (cells[:, [1, 2, 2]] >> np.uint64(29))) * _MIX
        empty = (cells[:, [0, 0, 1]] == 0) & (cells[:, [1, 2, 2]] == 0)
        names = np.arange(3 * parts, dtype=np.uint64).reshape(parts, 3) + np.uint64(band << 40)
        keys = (pairs ^ (pairs >> np.uint64(32))) * _MIX ^ (names * np.uint64(0xC2B2AE3D27D4EB4F))
        # this many parts at least are equal but for one cell, whatever the partner
        equal = parts - bands.differences(edge) // 2
        keep = np.ones_like(empty) if empty.any(axis=1).sum() >= equal else ~empty
        early.append(keys[:EARLY][keep[:EARLY]])
        late.append(keys[EARLY:][keep[EARLY:]])
    none = np.zeros(0, np.uint64)
    return tuple(np.concatenate(x or [none]).view(np.int64) for x in (early, late))


def cell_bytes(hashes: np.ndarray) -> np.ndarray:
    return (_cells(hashes, CELLS) >> np.uint64(56)).astype(np.uint8)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    values = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int64()))


def _described(documents: DataFrame, doc_id: str, text: str, width: int, bands: Bands) -> DataFrame:
    """``doc_id, row, n, digest, cells, early, late`` of every document."""
    id_type = documents.schema[doc_id].dataType.simpleString()

    def run(batches):
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            sizes, digests, cells, early, late = [], [], [], [], []
            for value in batch.column(1):
                own = shingles(value.as_py(), width)
                sizes.append(len(own))
                digests.append(digest(own) if len(own) else None)
                cells.append(cell_bytes(own).tobytes() if len(own) else None)
                for held, new in zip((early, late), signatures(own, bands)):
                    held.append(new)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.arange(row, row + len(sizes))), pa.array(sizes, pa.int64()),
                 pa.array(digests, pa.binary()), pa.array(cells, pa.binary()), _lists(early), _lists(late)],
                ["doc_id", "row", "n", "digest", "cells", "early", "late"],
            )
            row += len(sizes)

    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        run, f"doc_id {id_type}, row bigint, n bigint, digest binary, cells binary, early array<bigint>, late array<bigint>"
    )
    return stage_table(rows, "described")


def _shared(nodes: DataFrame) -> DataFrame:
    """``key, node, early`` of the signatures that several nodes have. A key's rows stream through."""

    def run(batches):
        last = None  # the last row: key, node, early, whether it was given out
        for batch in batches:
            key, node, early = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if not len(key):
                continue
            given = np.zeros(len(key) + 1, bool)
            if last is not None:
                key, node, early = (np.concatenate([[x], c]) for x, c in zip(last[:3], (key, node, early)))
            same = key[1:] == key[:-1]
            given = np.zeros(len(key), bool)
            given[1:] |= same
            given[:-1] |= same
            final = bool(given[-1])
            if last is not None and last[3]:
                given[0] = False
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[given]), pa.array(node[given]), pa.array(early[given].astype(bool))], ["key", "node", "early"]
            )
            last = (key[-1], node[-1], early[-1], final)

    def side(column, early):
        return nodes.select(F.explode(column).alias("key"), "node", F.lit(early).alias("early"))

    rows = side("early", True).unionByName(side("late", False)).repartition("key").sortWithinPartitions("key")
    return stage_table(rows.mapInArrow(run, "key bigint, node bigint, early boolean"), "shared")


def _columns(batch) -> list[np.ndarray]:
    out = []
    for column in batch.columns:
        if pa.types.is_binary(column.type):
            out.append(np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), CELLS))
        else:
            out.append(column.to_numpy(zero_copy_only=False))
    return out


def _grouped(batches, width: int, most: int | None):
    """Sorted batches as (columns, begin, end) of the runs of equal first ``width`` columns. Runs of
    more than ``most`` rows come in portions of that size."""
    held = None

    def portions(columns):
        new = np.zeros(len(columns[0]), bool)
        new[0] = True
        for c in columns[:width]:
            new[1:] |= c[1:] != c[:-1]
        borders = np.append(np.flatnonzero(new), len(new))
        for begin, end in zip(borders[:-1], borders[1:]):
            for at in range(begin, end, most or len(new)):
                yield columns, at, min(at + (most or len(new)), end)

    for batch in batches:
        columns = _columns(batch)
        if not len(columns[0]):
            continue
        held = columns if held is None else [np.concatenate([a, b]) for a, b in zip(held, columns)]
        last = np.logical_and.reduce([c == c[-1] for c in held[:width]])
        cut = 0 if last.all() else len(last) - int(np.argmin(last[::-1]))
        if most and len(last) - cut > most:
            cut += (len(last) - cut) // most * most
        if cut:
            yield from portions([c[:cut] for c in held])
            held = [c[cut:] for c in held]
    if held is not None and len(held[0]):
        yield from portions(held)


def possible(cells, sizes, others, other_sizes, bands: Bands) -> np.ndarray:
    """Cells in which pairs differ; ``CELLS + 1`` where they cannot be similar enough."""
    apart = np.empty((len(cells), len(others)), np.int64)
    for i in range(len(cells)):
        np.sum(cells[i] != others, axis=1, out=apart[i])
    total = np.add.outer(sizes, other_sizes)
    least = np.abs(np.subtract.outer(sizes, other_sizes))
    return np.where(np.maximum(apart, least) <= bands.differences(total), apart, CELLS + 1)


def _forest(apart: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a minimum spanning forest over the pairs that may be similar."""
    left = np.ones(len(apart), bool)
    best, through = np.full(len(apart), CELLS + 1), np.zeros(len(apart), np.int64)
    edges = []
    for _ in range(len(apart)):
        i = int(np.argmin(np.where(left, best, CELLS + 2)))
        left[i] = False
        if best[i] <= CELLS:
            edges.append((int(through[i]), i))
        better = left & (apart[i] < best)
        best[better], through[better] = apart[i][better], i
    return edges


_PAIRS = "a bigint, b bigint"


def _pairs(found: set):
    columns = list(zip(*found)) if found else [(), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])


def _first_pairs(shared: DataFrame, nodes: DataFrame, bands: Bands) -> DataFrame:
    """Pass 1: pairs ``a < b`` of the spanning forests."""

    def run(batches):
        found: set = set()
        for columns, begin, end in _grouped(batches, 1, NEAR):
            _, node, n, cells = columns
            if end - begin == 1:
                continue
            apart = possible(cells[begin:end], n[begin:end], cells[begin:end], n[begin:end], bands)
            np.fill_diagonal(apart, CELLS + 1)
            found.update(tuple(sorted((int(node[begin + i]), int(node[begin + j])))) for i, j in _forest(apart))
            if len(found) > 50_000:
                yield _pairs(found)
                found = set()
        yield _pairs(found)

    rows = shared.filter("early").select("key", "node").join(nodes.select("node", "n", "cells"), "node")
    # a key of very many nodes lies in several tasks, each with portions of its own
    ordered = rows.repartitionByRange("key", "node").sortWithinPartitions("key", F.xxhash64("key", "node"))
    return stage_table(ordered.select("key", "node", "n", "cells").mapInArrow(run, _PAIRS).distinct(), "first_pairs")


def _other_pairs(shared: DataFrame, nodes: DataFrame, roots: DataFrame, bands: Bands) -> DataFrame:
    """Pass 2: all pairs ``a < b`` between different components that share a signature and may link."""
    rooted = shared.select("key", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    parts = rooted.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c"))
    mixed = parts.groupBy("key").agg(F.count(F.lit(1)).alias("parts"), F.sum("c").alias("all"), F.max(F.struct("c", "root")).alias("top"))
    mixed = stage_table(mixed.filter("parts > 1").select(
        "key", F.col("top.root").alias("top"),
        F.ceil((F.col("all") - F.col("top.c")) / BLOCK).cast("int").alias("others"),
        F.ceil(F.col("top.c") / BLOCK).cast("int").alias("tops"),
    ), "mixed")
    members = stage_table(rooted.join(mixed, "key"), "members").withColumn("is_top", F.col("root") == F.col("top"))
    block = F.pmod(F.xxhash64("node"), F.when(F.col("is_top"), F.col("tops")).otherwise(F.col("others"))).cast("int")
    members = members.withColumn("block", block).join(nodes.select("node", "n", "cells"), "node")

    def upto(n):
        return F.sequence(F.lit(0), n - 1)

    # tiles (x, y): x a block outside the largest component; y a block of it, or -1 - a block outside
    with_top = F.transform(upto(F.col("tops")), lambda y: F.struct(F.col("block").alias("x"), y.alias("y")))
    outside = F.transform(upto(F.col("others")), lambda z: F.struct(
        F.least(F.col("block"), z).alias("x"), (-1 - F.greatest(F.col("block"), z)).alias("y")))
    of_top = F.transform(upto(F.col("others")), lambda x: F.struct(x.alias("x"), F.col("block").alias("y")))
    dealt = members.select("key", "node", "root", "n", "cells", F.inline(F.when(F.col("is_top"), of_top).otherwise(F.concat(with_top, outside))))

    def run(batches):
        found: set = set()
        for columns, begin, end in _grouped(batches, 3, None):
            _, _, _, node, root, n, cells = columns
            here = slice(begin, end)
            if (root[here] == root[begin]).all():
                continue
            for i in range(begin, end, BLOCK):
                rows = slice(i, min(i + BLOCK, end))
                apart = possible(cells[rows], n[rows], cells[here], n[here], bands)
                apart[root[rows][:, None] == root[here][None, :]] = CELLS + 1
                one, two = np.nonzero(apart <= CELLS)
                a, b = node[rows][one], node[here][two]
                found.update(zip(a[a < b].tolist(), b[a < b].tolist()))
                if len(found) > 50_000:
                    yield _pairs(found)
                    found = set()
        yield _pairs(found)

    ordered = dealt.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")
    chosen = ordered.select("key", "x", "y", "node", "root", "n", "cells")
    return stage_table(chosen.mapInArrow(run, _PAIRS).distinct(), "other_pairs")


def _texts(ends: DataFrame, nodes: DataFrame, documents: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """``node, text`` of the nodes in ``ends``. Rows of one id may differ: the digest finds the text."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("_id")
    wanted = ends.join(nodes.select("node", key, "digest"), "node")
    rows = documents.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")).alias("_id"), F.col(text).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            same = pa.array([digest(shingles(t.as_py(), width)) == d.as_py() for d, t in zip(batch.column(1), batch.column(2))], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(same), batch.column(2).filter(same)], ["node", "text"])

    found = rows.join(wanted, "_id").select("node", "digest", "text").mapInArrow(run, "node bigint, text string")
    return stage_table(found.groupBy("node").agg(F.min("text").alias("text")), "texts")


def join(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, similar: int = 90) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row; links have a Jaccard similarity of at least
    ``similar`` per cent on shingles of ``width`` words."""
    bands = Bands(similar)
    described = _described(documents, doc_id, text, width, bands)
    sets = described.filter("digest is not null")
    # copies become one row per task here; the node takes the number of its first row
    firsts = stage_table(sets.groupBy("digest").agg(F.min("row").alias("node"), F.min("doc_id").alias("label")), "firsts")
    nodes = sets.join(firsts.select(F.col("node").alias("row")), "row", "left_semi").withColumnRenamed("row", "node")
    nodes = stage_table(nodes, "nodes")
    shared = _shared(nodes)

    def texts_of(ends):
        return _texts(ends, nodes, documents, doc_id, text, width)

    def set_of(value):
        return shingles(value, width)

    early = _first_pairs(shared, nodes, bands)
    links = confirmed(early, texts_of, set_of, similar)
    roots = components(links, "a", "b")
    late = stage_table(_other_pairs(shared, nodes, roots, bands).join(early, ["a", "b"], "left_anti"), "late_pairs")
    if late.head(1):
        more = confirmed(late, texts_of, set_of, similar)
        if more.head(1):
            roots = components(links.unionByName(more), "a", "b")
    labels = stage_table(firsts.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "labels")
    smallest = stage_table(labels.groupBy("root").agg(F.min("label").alias("component_id")), "smallest")
    # staged, with one row per digest: a digest that very many rows share is split by adaptive execution
    by_digest = stage_table(labels.join(smallest, "root").select("digest", "component_id", F.lit(True).alias("_set")), "by_digest")
    found = described.select("doc_id", "n", "digest").join(by_digest, "digest", "left")
    return found.select(
        F.col("doc_id").alias(doc_id), F.col("n").alias("n_shingles"),
        F.when(F.col("_set"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )
