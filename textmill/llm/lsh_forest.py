"""MinHash near-duplicates with an LSH forest.

A document is the set of its distinct word shingles; equal sets are one node. A node's signature,
one byte of each of ``HASHES`` minima, is read as ``TREES`` sequences, each starting at another place.
In every tree nodes are sorted by their sequence; those sharing the first ``DEPTH`` bytes are a
region. Within a
region the neighbours in sorted order, which share the longest prefixes, are compared by a sketch of
the signature: up to ``NEAR`` at a time, so the depth that matters follows the density of the region.

Pass 1 takes from each neighbourhood a maximum spanning forest of the pairs whose sketches agree
enough, confirms those links on the full sets and joins what is linked. Pass 2 goes back to the
regions that pass 1 did not settle and compares every remaining pair between different components,
in blocks that carry the texts, each pair in the first tree it shares: the largest component of a region against all others, and these among each other. So all
pairs of a region are either connected or compared, without listing pairs inside a group.

Two sets of similarity 0.8 miss all regions with probability (1 - 0.8**4)**32 = 5e-8, and the
sketch bound of ``LEAST`` lies five standard deviations below 0.8.

A null, empty or blank text has no shingles and is linked with nothing; fewer words than a shingle
are one shingle. Rows that repeat, ids too, are rows of one node. A null id never is the smallest;
a component of null ids has a null id, and ``kept`` is true where ids are equal or both null. An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from textmill.llm.components import components
from textmill.storage import stage_table

HASHES, TREES, DEPTH = 128, 32, 4
#: Nodes compared with each other at once.
NEAR = 256
#: Share of equal sketch bytes, chance hits removed, below which a pair is not similar enough.
LEAST = 0.62
#: Values after the prefix by which a region is sorted.
ORDERED = 8

_random = np.random.default_rng(3)
_TIMES = _random.integers(1, 2**63, HASHES, dtype=np.uint64) | np.uint64(1)
_PLUS = _random.integers(0, 2**63, HASHES, dtype=np.uint64)


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(width, len(one))
    joined = one[: len(one) - width + 1].copy()
    for i in range(1, width):
        joined = (joined ^ (joined >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + one[i : len(one) - width + 1 + i]
    joined = (joined ^ (joined >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(width)
    return np.unique(joined)


def digest(shingle_set: np.ndarray) -> bytes:
    return hashlib.blake2b(shingle_set.tobytes(), digest_size=16).digest()


def sketch(shingle_set: np.ndarray) -> np.ndarray:
    """One byte of each of ``HASHES`` minima."""
    least = np.full(HASHES, 0xFFFFFFFFFFFFFFFF, np.uint64)
    for i in range(0, len(shingle_set), 2048):
        part = np.multiply.outer(_TIMES, shingle_set[i : i + 2048])
        part += _PLUS[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint8)


def _describe(documents: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """``doc_id, version, row, n, digest, sketch`` of every document."""
    id_type = documents.schema[doc_id].dataType.simpleString()

    def run(batches):
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            held = []
            for value in batch.column(1):
                own = shingles(value.as_py(), width)
                if len(own):
                    held.append((row, len(own), digest(own), sketch(own).tobytes()))
                else:
                    held.append((row, 0, None, None))
                row += 1
            columns = list(zip(*held)) if held else [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
            arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *arrays], ["doc_id", "version", "row", "n", "digest", "sketch"])

    rows = documents.select(doc_id, F.col(text).cast("string").alias("text"), F.xxhash64(text).alias("version")).mapInArrow(
        run, f"doc_id {id_type}, version bigint, row bigint, n bigint, digest binary, sketch binary"
    )
    return stage_table(rows, "shingled")


def _regions(nodes: DataFrame) -> DataFrame:
    """``key, tree, size, suffix, node, n, sketch`` of the nodes that share a prefix with another."""
    keys = F.array(*[
        F.struct(F.xxhash64(F.lit(t), F.substring("sketch", DEPTH * t + 1, DEPTH)).alias("key"), F.lit(t).alias("tree"))
        for t in range(TREES)
    ])
    prefixes = nodes.select("node", F.inline(keys))
    # staged, so adaptive execution can split a prefix with very many nodes in the join back
    dense = stage_table(prefixes.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "dense")
    near = prefixes.join(dense, "key")
    suffix = F.expr(f"substring(concat(sketch, sketch), {DEPTH} * tree + {DEPTH + 1}, {ORDERED})")
    joined = near.join(nodes.select("node", "n", "sketch"), "node")
    return stage_table(joined.select("key", "tree", "size", suffix.alias("suffix"), "node", "n", "sketch"), "regions")


def alike(sketches: np.ndarray, sizes: np.ndarray, others=None, other_sizes=None) -> np.ndarray:
    """Estimated similarity of all pairs; 0 where the sizes alone rule a link out."""
    others = sketches if others is None else others
    other_sizes = sizes if other_sizes is None else other_sizes
    equal = np.empty((len(sketches), len(others)), np.float32)
    for i in range(len(sketches)):
        np.sum(sketches[i] == others, axis=1, out=equal[i])
    near = (equal / sketches.shape[1] - 1 / 256) / (1 - 1 / 256)
    least, most = np.minimum.outer(sizes, other_sizes), np.maximum.outer(sizes, other_sizes)
    return np.where(100 * least >= 80 * most, near, 0)


def _forest(near: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Edges of a maximum spanning forest over the pairs with at least ``least``."""
    left = np.ones(len(near), bool)
    best, through = np.full(len(near), -1.0), np.zeros(len(near), np.int64)
    edges = []
    for _ in range(len(near)):
        i = int(np.argmax(np.where(left, best, -2)))
        left[i] = False
        if best[i] >= least:
            edges.append((int(through[i]), i))
        better = left & (near[i] > best)
        best[better], through[better] = near[i][better], i
    return edges


def _runs(batches, width: int):
    """Rows of sorted batches as arrays, whole runs of the first ``width`` columns at a time, except
    that a run longer than ``NEAR`` comes in portions that overlap by one row."""
    held = None
    for batch in batches:
        columns = [_numpy(c) for c in batch.columns]
        if not len(columns[0]):
            continue
        held = columns if held is None else [np.concatenate([a, b]) for a, b in zip(held, columns)]
        last = np.ones(len(held[0]), bool)
        for c in held[:width]:
            last &= c == c[-1]
        cut = len(last) - int(np.argmin(last[::-1])) if not last.all() else 0
        if cut:
            yield from _portions([c[:cut] for c in held], width)
            held = [c[cut:] for c in held]
        while len(held[0]) > NEAR:
            yield [c[:NEAR] for c in held], np.array([0, NEAR]), True
            held = [c[NEAR - 1 :] for c in held]
    if held is not None:
        yield from _portions(held, width)


def _portions(columns, width):
    """(columns, borders, cut): borders of the runs; long runs alone, in overlapping portions."""
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for c in columns[:width]:
        new[1:] |= c[1:] != c[:-1]
    borders = np.append(np.flatnonzero(new), len(new))
    long = np.flatnonzero(np.diff(borders) > NEAR)
    done = 0
    for run in long:
        if run > done:
            yield columns, borders[done : run + 1], False
        begin, end = borders[run], borders[run + 1]
        while begin < end - 1 or begin == borders[run]:
            stop = min(begin + NEAR, end)
            yield [c[begin:stop] for c in columns], np.array([0, stop - begin]), True
            if stop == end:
                break
            begin = stop - 1
        done = run + 1
    if done < len(borders) - 1:
        yield columns, borders[done:], False


def _numpy(column) -> np.ndarray:
    if pa.types.is_binary(column.type):
        width = len(column[0].as_py()) if len(column) else 0
        return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), width)
    return column.to_numpy(zero_copy_only=False)


_PAIRS = "a bigint, b bigint, key bigint"


def _pairs_batch(pairs: list[tuple[int, int, int]]):
    columns = list(zip(*pairs)) if pairs else [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], ["a", "b", "key"])


def first_links(regions: DataFrame, least: float = LEAST) -> DataFrame:
    """Pass 1: links ``a, b``; and rows with null ``a`` for regions that are not settled."""

    def run(batches):
        for columns, borders, cut in _runs(batches, 1):
            keys, sizes, node, n, sketch = columns
            found = []
            lengths = np.diff(borders)
            # most regions are two nodes: all of them at once
            two = borders[:-1][lengths == 2]
            equal = (sketch[two] == sketch[two + 1]).mean(axis=1)
            fewer, more = np.minimum(n[two], n[two + 1]), np.maximum(n[two], n[two + 1])
            near = (equal - 1 / 256) / (1 - 1 / 256)
            for i in two[(near >= least) & (100 * fewer >= 80 * more)]:
                found.append((int(node[i]), int(node[i + 1]), int(keys[i])))
            for begin, end in zip(borders[:-1], borders[1:]):
                if end - begin > 2:
                    near = alike(sketch[begin:end], n[begin:end])
                    np.fill_diagonal(near, 0)
                    edges = _forest(near, least)
                    found.extend((int(node[begin + i]), int(node[begin + j]), int(keys[begin])) for i, j in edges)
                    if 2 * len(edges) < int((near >= least).sum()):
                        found.append((None, None, int(keys[begin])))
                if cut or end - begin < sizes[begin]:
                    found.append((None, None, int(keys[begin])))
            yield _pairs_batch(found)

    ordered = regions.repartitionByRange("key", "suffix", "node").sortWithinPartitions("key", "suffix", "node")
    return stage_table(ordered.select("key", "size", "node", "n", "sketch").mapInArrow(run, _PAIRS), "links")


def rest(regions: DataFrame, open_keys: DataFrame, roots: DataFrame, texts_of, set_of, similar: int, depth: int = DEPTH, least: float = LEAST) -> DataFrame:
    """Pass 2: confirmed links ``a, b`` between different components in unsettled regions.

    ``texts_of(nodes)`` gives ``node, text``; ``set_of(text)`` the full set. A pair is looked at only
    in the first tree it shares, against the full sets, inside the task that has both blocks."""
    members = regions.join(open_keys, "key", "left_semi").join(roots, "node", "left")
    members = members.withColumn("root", F.coalesce("root", "node"))
    parts = members.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c"))
    mixed = parts.groupBy("key").agg(
        F.count(F.lit(1)).alias("parts"), F.sum("c").alias("all"), F.max(F.struct("c", "root")).alias("top")
    ).filter("parts > 1")
    mixed = stage_table(mixed.select(
        "key", F.col("top.root").alias("top"),
        F.ceil((F.col("all") - F.col("top.c")) / NEAR).cast("int").alias("others"),
        F.ceil(F.col("top.c") / NEAR).cast("int").alias("tops"),
    ), "mixed")
    side = stage_table(members.join(mixed, "key").withColumn("is_top", F.col("root") == F.col("top")), "members")
    side = side.join(texts_of(side.select("node").distinct()), "node")
    block = F.pmod(F.xxhash64("node"), F.when(F.col("is_top"), F.col("tops")).otherwise(F.col("others"))).cast("int")
    side = side.withColumn("block", block)

    def upto(n):
        return F.sequence(F.lit(0), n - 1)

    # groups (x, y): x a block of others; y a block of the largest component, or -1 - a block of others
    to_others = F.transform(upto(F.col("tops")), lambda y: F.struct(F.col("block").alias("x"), y.alias("y")))
    among = F.transform(
        upto(F.col("others")),
        lambda z: F.struct(F.least(F.col("block"), z).alias("x"), (-1 - F.greatest(F.col("block"), z)).alias("y")),
    )
    of_top = F.transform(upto(F.col("others")), lambda x: F.struct(x.alias("x"), F.col("block").alias("y")))
    places = F.when(F.col("is_top"), of_top).otherwise(F.concat(to_others, among))
    dealt = side.select("key", "tree", "node", "root", "n", "sketch", "text", F.inline(places))

    def run(batches):
        for columns, borders in _groups(batches):
            _, _, _, tree, node, root, n, sketch_, text = columns
            found = []
            for begin, end in zip(borders[:-1], borders[1:]):
                here = root[begin:end]
                if (here == here[0]).all():
                    continue
                sets, joined = {}, {}

                def set_at(i):
                    if i not in sets:
                        sets[i] = set_of(text[i])
                    return sets[i]

                def group(x):
                    while joined.get(x, x) != x:
                        x = joined[x]
                    return x

                for i in range(begin, end, NEAR):
                    stop = min(i + NEAR, end)
                    near = alike(sketch_[i:stop], n[i:stop], sketch_[begin:end], n[begin:end])
                    near[root[i:stop, None] == here[None, :]] = 0
                    one, two = np.nonzero(near >= least)
                    one, two = one + i, two + begin
                    one, two = one[one < two], two[one < two]
                    for j in range(0, len(one), 4096):
                        p, q = one[j : j + 4096], two[j : j + 4096]
                        shared = (sketch_[p] == sketch_[q]).reshape(len(p), -1, depth).all(axis=2)
                        first = np.argmax(shared, axis=1) == tree[begin]
                        for x, y in zip(p[first], q[first]):
                            r, s = group(root[x]), group(root[y])
                            if r == s:
                                continue
                            both = np.isin(set_at(x), set_at(y), assume_unique=True).sum()
                            if 100 * both >= similar * (len(set_at(x)) + len(set_at(y)) - both):
                                joined[r] = s
                                found.append((int(node[x]), int(node[y]), int(columns[0][begin])))
            yield _pairs_batch(found)

    ordered = dealt.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")
    chosen = ordered.select("key", "x", "y", "tree", "node", "root", "n", "sketch", "text")
    return stage_table(chosen.mapInArrow(run, _PAIRS).select("a", "b").distinct(), "more_links")


def _groups(batches):
    """Like ``_runs`` over three columns, but a group (two blocks at most) is never cut."""
    held = None
    for batch in batches:
        columns = [_numpy(c) for c in batch.columns]
        if not len(columns[0]):
            continue
        held = columns if held is None else [np.concatenate([a, b]) for a, b in zip(held, columns)]
        last = np.logical_and.reduce([c == c[-1] for c in held[:3]])
        cut = 0 if last.all() else len(last) - int(np.argmin(last[::-1]))
        if cut:
            yield [c[:cut] for c in held], _borders([c[:cut] for c in held[:3]])
            held = [c[cut:] for c in held]
    if held is not None:
        yield held, _borders(held[:3])


def _borders(columns) -> np.ndarray:
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(new), len(new))


def _texts(ends: DataFrame, nodes: DataFrame, documents: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """``node, text`` of some nodes. Rows of one id may differ: the digest finds the node's text."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("_id")
    wanted = ends.join(nodes.select("node", key, "digest"), "node")
    rows = documents.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")).alias("_id"), F.col(text).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            same = pa.array([digest(shingles(t.as_py(), width)) == d.as_py() for d, t in zip(batch.column(1), batch.column(2))], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(same), batch.column(2).filter(same)], ["node", "text"])

    found = rows.join(wanted, "_id").select("node", "digest", "text").mapInArrow(run, "node bigint, text string")
    return stage_table(found.groupBy("node").agg(F.min("text").alias("text")), "texts")


def confirmed(pairs: DataFrame, texts_of, set_of, similar: int) -> DataFrame:
    """The pairs ``a, b`` with ``100 * intersection >= similar * union`` of their full sets."""
    pairs = stage_table(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    texts = texts_of(ends)

    def run(batches):
        for batch in batches:
            a, b = batch.column(0), batch.column(1)
            keep, known, known_of = [], None, None
            for i in range(batch.num_rows):
                if known_of != a[i].as_py():
                    known_of, known = a[i].as_py(), set_of(batch.column(2)[i].as_py())
                two = set_of(batch.column(3)[i].as_py())
                both = int(np.isin(known, two, assume_unique=True).sum())
                keep.append(100 * both >= similar * (len(known) + len(two) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], ["a", "b"])

    full = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("_a")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("_b")), "b"
    )
    return stage_table(full.select("a", "b", "_a", "_b").mapInArrow(run, "a bigint, b bigint"), "confirmed")


def linked(regions: DataFrame, texts_of, set_of, similar: int, depth: int = DEPTH, least: float = LEAST) -> DataFrame:
    """``node, root`` of all nodes of ``regions`` that have a link, after both passes."""
    links = first_links(regions, least)
    first = confirmed(links.filter("a is not null"), texts_of, set_of, similar)
    roots = components(first, "a", "b")
    open_keys = stage_table(links.filter("a is null").select("key").distinct(), "open_keys")
    second = rest(regions, open_keys, roots, texts_of, set_of, similar, depth, least)
    return components(first.unionByName(second), "a", "b") if second.head(1) else roots


def near_duplicates(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, similar: int = 80
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, first, version`` of every row; ``version`` is the hash of
    the text, ``first`` marks the smallest (id, version) of a component. Links have a Jaccard similarity of at
    least ``similar`` per cent (80 or more) on shingles of ``width`` words."""
    _order = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "version")
    described = _describe(documents, doc_id, text, width)
    sets = described.filter("digest is not null")
    # copies become one row per task here; the node takes the number of its first row
    firsts = stage_table(sets.groupBy("digest").agg(F.min("row").alias("node"), F.min("doc_id").alias("label"), F.min(_order).alias("first")), "nodes")
    nodes = sets.join(firsts.select(F.col("node").alias("row")), "row", "left_semi").withColumnRenamed("row", "node")
    nodes = stage_table(nodes, "signatures")
    roots = linked(
        _regions(nodes),
        lambda ends: _texts(ends, nodes, documents, doc_id, text, width),
        lambda value: shingles(value, width),
        similar,
    )
    rooted = firsts.join(roots, "node")
    smallest = stage_table(rooted.groupBy("root").agg(F.min("label").alias("component_id"), F.min("first").alias("_first")), "smallest")
    named = rooted.select("node", "root").join(smallest, "root").drop("root")
    by_digest = firsts.join(named, "node", "left").select(
        "digest", F.coalesce("component_id", "label").alias("component_id"), F.coalesce("_first", "first").alias("_first")
    )
    # a digest with very many rows is split by adaptive execution: the other side has one row each
    found = described.select("doc_id", "version", "n", "digest").join(by_digest, "digest", "left")
    component = F.when(F.col("_first").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select(
        F.col("doc_id").alias(doc_id), F.col("n").alias("n_shingles"), component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
        (F.col("_first").isNull() | _order.eqNullSafe(F.col("_first"))).alias("first"), "version",
    )
