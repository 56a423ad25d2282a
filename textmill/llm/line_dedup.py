"""Line deduplication: exact and fuzzy copies of lines, one line per component stays.

Lines end at ``\\n``. Equal lines (after stripping blanks at both ends) are one node. Nodes of
``SHINGLE`` or more characters have a MinHash signature over their character shingles, one byte per
hash; ``BANDS`` bands of ``ROWS`` bytes propose pairs, which are confirmed by the Jaccard similarity
of the full shingle sets. What is linked forms components by distributed union-find; the line with
the smallest (document, place) of a component stays, all others go. Two lines of similarity 0.8 share
a band with probability 0.998, of 0.9 with 0.999999. Bands with many lines are taken in neighbourhoods
and then in blocks between components, see :mod:`lsh_forest`: no pair of a band is dropped or listed
twice.

Blank lines always stay and are no copies of each other. A null text stays null. Rows with the same
id and text are one document: each gets the same result. Documents with a null id come first. A
document keeps its other columns; one that loses all its lines has an empty text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from textmill.llm.lsh_forest import linked
from textmill.storage import stage_table

SHINGLE = 8
BANDS, ROWS = 16, 5
#: Code points of the lines that are hashed together.
PIECE = 100_000
#: Five standard deviations of the estimate below 0.8.
LEAST = 0.57

_random = np.random.default_rng(8)
_TIMES = _random.integers(1, 2**31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_PRIME = np.array([0x100000001B3], np.uint64)  # an array: its powers wrap around


def line_digest(line: str) -> bytes:
    return hashlib.blake2b(line.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _windows(points: np.ndarray) -> np.ndarray:
    """64-bit hash of every ``SHINGLE`` (a power of two) code points in a row: windows of twice the length each time."""
    mixed, times, size = points.astype(np.uint64), _PRIME, 1
    while size < SHINGLE:
        wide = mixed[:-size] * times
        wide += mixed[size:]
        mixed, times, size = wide, times * times, 2 * size
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    return mixed


def shingle_set(line: str) -> np.ndarray:
    """The shingles of a line of ``SHINGLE`` or more characters; shorter ones have no signature."""
    hashes = _windows(np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32))
    hashes.sort()
    return hashes[np.append(True, hashes[1:] != hashes[:-1])]


def sketches(lines: list[str]) -> np.ndarray:
    """One byte per hash function for each line of ``SHINGLE`` or more characters."""
    out = np.empty((len(lines), BANDS * ROWS), np.uint8)
    begin = 0
    while begin < len(lines):
        end, size = begin, 0
        while end < len(lines) and (end == begin or size < PIECE):  # both arrays of hashes stay in a core's cache
            size += len(lines[end])
            end += 1
        sizes = np.array([len(x) for x in lines[begin:end]])
        points = np.frombuffer("".join(lines[begin:end]).encode("utf-32-le", "surrogatepass"), np.uint32)
        hashes = np.append((_windows(points) >> np.uint64(32)).astype(np.uint32), np.uint32(0))
        first = np.cumsum(sizes) - sizes
        borders = np.stack([first, first + sizes - SHINGLE + 1], 1).ravel()
        mixed, least = np.empty_like(hashes), np.empty((BANDS * ROWS, len(borders)), np.uint32)
        for j, times in enumerate(_TIMES):
            np.multiply(hashes, times, out=mixed)
            np.minimum.reduceat(mixed, borders, out=least[j])
        out[begin:end] = (least[:, ::2] >> np.uint32(3)).astype(np.uint8).T
        begin = end
    return out


def _line_rows(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id, version, place, digest, sketch``: the lines that are not blank."""
    schema = StructType([
        StructField("doc_id", documents.schema[doc_id].dataType), StructField("version", LongType()), StructField("place", LongType())
    ]).add("digest", "binary").add("sketch", "binary")

    def run(batches):
        for batch in batches:
            owner, place, digests, long, at = [], [], [], [], []
            for row, value in enumerate(batch.column(2)):
                for i, line in enumerate((value.as_py() or "").split("\n")):
                    line = line.strip()
                    if line:
                        if len(line) >= SHINGLE:
                            at.append(len(owner))
                            long.append(line)
                        owner.append(row)
                        place.append(i)
                        digests.append(line_digest(line))
            found = [None] * len(owner)
            for i, sketch in zip(at, sketches(long)):
                found[i] = sketch.tobytes()
            rows = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(place, pa.int64()), pa.array(digests, pa.binary()), pa.array(found, pa.binary())],
                schema.names,
            )

    rows = documents.select(doc_id, F.xxhash64(text).alias("version"), F.col(text).cast("string").alias("text"))
    return stage_table(rows.mapInArrow(run, schema), "lines")


def _bands(nodes: DataFrame) -> DataFrame:
    """``key, tree, node`` of the nodes that share a band with another one.

    Rows are sorted by key once; a task sees runs of keys as they pass and holds none of them."""
    # the band in the low bits, the hash of its bytes above
    keys = F.array(*[
        F.shiftleft(F.xxhash64(F.substring("sketch", ROWS * b + 1, ROWS)), 8).bitwiseOR(F.lit(b)) for b in range(BANDS)
    ])
    exploded = nodes.filter("sketch is not null").select("node", F.explode(keys).alias("key"))

    def run(batches):
        last = None  # the row before: key, node, whether it is out already
        for batch in batches:
            key, node = (c.to_numpy() for c in batch.columns)
            if not len(key):
                continue
            if last is not None:
                key, node = np.append(last[0], key), np.append(last[1], node)
            same = np.append(key[1:] == key[:-1], False)
            keep = same | np.append(False, same[:-1])
            if last is not None and last[2]:
                keep[0] = False
            sent = bool(keep[-1]) or (len(key) == 1 and last is not None and last[2])
            last = key[-1], node[-1], sent
            yield pa.RecordBatch.from_arrays([pa.array(key[keep]), pa.array(node[keep])], ["key", "node"])

    ordered = exploded.repartition("key").sortWithinPartitions("key")
    return stage_table(ordered.select("key", "node").mapInArrow(run, "key bigint, node bigint"), "bands")


def _regions(nodes: DataFrame) -> DataFrame:
    dense = _bands(nodes)
    # staged, so adaptive execution can split a band with very many lines in the join back
    sizes = stage_table(dense.groupBy("key").agg(F.count(F.lit(1)).alias("size")), "band_sizes")
    wide = nodes.select("node", F.lit(1).cast("bigint").alias("n"), "sketch")
    joined = dense.join(sizes, "key").join(wide, "node")
    tree = F.pmod("key", F.lit(256)).cast("int").alias("tree")
    return stage_table(joined.select("key", tree, "size", F.col("sketch").alias("suffix"), "node", "n", "sketch"), "line_regions")


def _texts(ends: DataFrame, nodes: DataFrame, documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``node, text``: the lines of some nodes, read again from the first document that has each."""
    first = F.struct(F.col("first.place").alias("place"), "node", "digest")
    key = F.coalesce(F.col("first.doc_id").cast("string"), F.lit("null"))
    wanted = ends.join(nodes.select("node", "digest", "first"), "node").select(key.alias("_id"), F.col("first.version").alias("_version"), first.alias("line"))
    wanted = wanted.groupBy("_id", "_version").agg(F.collect_list("line").alias("lines"))  # lines of one document
    rows = documents.select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("null")).alias("_id"), F.xxhash64(text).alias("_version"), F.col(text).alias("text")
    )

    def pick(batches):
        for batch in batches:
            nodes_, lines_ = [], []
            for value, wanted_ in zip(batch.column(0), batch.column(1).to_pylist()):
                own = value.as_py().split("\n")
                for line in wanted_:
                    chosen = own[line["place"]].strip() if line["place"] < len(own) else ""
                    if line_digest(chosen) == line["digest"]:
                        nodes_.append(line["node"])
                        lines_.append(chosen)
            yield pa.RecordBatch.from_arrays([pa.array(nodes_, pa.int64()), pa.array(lines_, pa.string())], ["node", "line"])

    picked = rows.join(wanted, ["_id", "_version"]).select("text", "lines").mapInArrow(pick, "node bigint, line string")
    return stage_table(picked.groupBy("node").agg(F.min("line").alias("text")), "line_texts")


def copied_lines(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", similar: int = 80) -> DataFrame:
    """``doc_id, version, place`` of every line that goes; ``version`` is ``xxhash64(text)``."""
    lines = _line_rows(documents, doc_id, text)
    # equal lines are one row per task before they move
    position = F.struct("doc_id", "version", "place")
    nodes = lines.groupBy("digest").agg(
        F.min(position).alias("first"), F.max(position).alias("last"), F.min("sketch").alias("sketch")
    )
    nodes = stage_table(nodes.withColumn("node", F.monotonically_increasing_id()), "line_nodes")
    roots = linked(
        _regions(nodes), lambda ends: _texts(ends, nodes, documents, doc_id, text), shingle_set, similar, ROWS, LEAST
    )
    fuzzy = nodes.join(roots, "node").select("digest", "root", "first")
    keepers = stage_table(fuzzy.groupBy("root").agg(F.min("first").alias("keeper")), "keepers")
    fuzzy = fuzzy.join(keepers, "root").select("digest", "keeper")
    # equal lines without a fuzzy partner: the first one stays
    alone = nodes.filter(~F.col("first").eqNullSafe(F.col("last"))).join(roots, "node", "left_anti")
    keep = fuzzy.unionByName(alone.select("digest", F.col("first").alias("keeper")))
    # the join splits a line with very many copies (adaptive execution): the other side has one row
    return lines.select("doc_id", "version", "place", "digest").join(keep, "digest").filter(
        ~F.struct("doc_id", "version", "place").eqNullSafe(F.col("keeper"))
    ).select("doc_id", "version", "place").distinct()


def dedup_lines(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", similar: int = 80) -> DataFrame:
    """``documents`` with the copies of lines taken out of ``text``, plus ``_n_lines`` (not blank)
    and ``_n_removed``, which replace columns of these names."""
    documents = documents.drop("_n_lines", "_n_removed")
    gone = copied_lines(documents, doc_id, text, similar)
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("_line_id")
    gone = gone.groupBy(key, F.col("version").alias("_line_version")).agg(F.collect_list("place").alias("_line_places"))
    names = documents.columns
    keyed = documents.withColumns({"_line_id": F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), "_line_version": F.xxhash64(text)})
    joined = keyed.join(gone, ["_line_id", "_line_version"], "left").select(*[F.col(n) for n in names], "_line_places")
    at = names.index(text)
    schema = StructType([*documents.schema.fields, StructField("_n_lines", LongType()), StructField("_n_removed", LongType())])

    def run(batches):
        for batch in batches:
            texts, counts, removed = [], [], []
            for value, places in zip(batch.column(at), batch.column(batch.num_columns - 1)):
                own, places = value.as_py(), places.as_py() or []
                lines = [] if own is None else own.split("\n")
                counts.append(sum(1 for x in lines if x.strip()))
                removed.append(len(places))
                if places:
                    dropped = set(places)
                    own = "\n".join(x for i, x in enumerate(lines) if i not in dropped)
                texts.append(own)
            columns = list(batch.columns[:-1])
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(removed, pa.int64())], schema.names)

    return joined.mapInArrow(run, schema)
