"""Exact nearest neighbours by cosine as a block matrix join.

Vectors are normalised and kept as int8 with one scale per vector. Tasks write blocks of candidates
and blocks of queries; every pair of blocks is one tile. In a tile an int8 product gives each
cosine up to a proven error: with ``u = s * a + e``, ``|e| <= s / 2`` per component, the error of a
product is at most ``s_q / 2 * |c|_1 + s_c / 2 * |q|_1 + d * s_q * s_c / 4``. A pair whose upper
bound lies below the k-th best lower bound of its query in the tile is out; all others are computed
from the original vectors in double precision, and a heap per query keeps the best ``k``. Heaps of
all tiles are merged per query.

Null and zero vectors, and those with null or non-finite components or of another length than the
query, take no part. Rows with a null id neither. Ids must be unique; a repeated row counts twice as
a candidate. Ties go to the smaller id.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

#: Rows of a block: 4,096 vectors of 64 doubles are 2 MB.
BLOCK_ROWS = 4096
#: Candidate blocks are dealt to so many groups per shuffle partition at most.
GROUPS = 64

_BLOCK = "ids binary, vectors binary, dim int"


def _valid(vector: str) -> Column:
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.col(vector).isNotNull() & ok & F.exists(vector, lambda x: x != 0)


def _blocks(rows: DataFrame) -> DataFrame:
    """(id, vector) rows of one task as blocks of one dimension each."""

    def run(batches):
        held: dict[int, list] = {}
        for batch in batches:
            vectors = batch.column(1)
            sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            begin = np.cumsum(sizes) - sizes
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                matrix = flat[begin[at][:, None] + np.arange(dim)]
                held.setdefault(int(dim), []).append((ids[at], matrix))
                if sum(len(x[0]) for x in held[int(dim)]) >= BLOCK_ROWS:
                    yield from emit(int(dim), held.pop(int(dim)))
        for dim, parts in held.items():
            yield from emit(dim, parts)

    def emit(dim, parts):
        ids, matrix = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        for i in range(0, len(ids), BLOCK_ROWS):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([ids[i : i + BLOCK_ROWS].astype("<i8").tobytes()], pa.binary()),
                    pa.array([matrix[i : i + BLOCK_ROWS].astype("<f8").tobytes()], pa.binary()),
                    pa.array([dim], pa.int32()),
                ],
                ["ids", "vectors", "dim"],
            )

    return rows.mapInArrow(run, _BLOCK)


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Norms, int8 codes of the normalised vectors, their scales and absolute sums."""
    # dividing by the largest component first keeps the squares finite
    largest = np.abs(vectors).max(axis=1)
    scaled = vectors / largest[:, None]
    norms = np.sqrt(np.einsum("ij,ij->i", scaled, scaled))
    unit = scaled / norms[:, None]
    scales = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scales[:, None]).astype(np.int8)
    return unit, codes, scales, np.abs(unit).sum(axis=1)


def tile(queries, query_ids, candidates, ids, k: int):
    """(query row, candidate row, cosine) of the best ``k`` candidates of each query in a tile."""
    unit_q, codes_q, scale_q, sum_q = queries
    unit_c, codes_c, scale_c, sum_c = candidates
    # int8 products add up to less than 2**24 for up to 1,000 dimensions, so float32 is exact there;
    # longer vectors use doubles
    kind = np.float32 if unit_q.shape[1] <= 1000 else np.float64
    right = codes_c.astype(kind).T
    for begin in range(0, len(query_ids), 256):
        part = slice(begin, begin + 256)
        near = (codes_q[part].astype(kind) @ right) * (scale_q[part, None] * scale_c[None, :])
        error = (
            scale_q[part, None] / 2 * sum_c[None, :]
            + scale_c[None, :] / 2 * sum_q[part, None]
            + unit_q.shape[1] / 4 * scale_q[part, None] * scale_c[None, :]
            + 1e-9
        )
        low, high = near - error, near + error
        own = query_ids[part, None] == ids[None, :]
        low[own] = high[own] = -np.inf
        n = min(k, len(ids))
        floor = np.partition(low, len(ids) - n, axis=1)[:, len(ids) - n]
        rows, cols = np.nonzero((high >= floor[:, None]) & ~own)
        if not len(rows):
            continue
        cosine = np.concatenate([
            np.einsum("ij,ij->i", unit_q[part][rows[i : i + 32768]], unit_c[cols[i : i + 32768]])
            for i in range(0, len(rows), 32768)
        ])
        ends = np.searchsorted(rows, np.arange(len(floor) + 1))
        for r in range(len(floor)):
            mine = slice(ends[r], ends[r + 1])
            best = heapq.nsmallest(k, zip(-cosine[mine], ids[cols[mine]], cols[mine]))
            yield from ((begin + r, int(c), -s) for s, _, c in best)


def nearest(
    table: DataFrame, queries: DataFrame, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows of ``table`` for each query."""

    def rows(df: DataFrame) -> DataFrame:
        chosen = df.select(F.col(vec_id).cast("bigint").alias("_id"), F.col(vector).alias("_vector"))
        return chosen.filter(F.col("_id").isNotNull() & _valid("_vector"))

    groups = GROUPS
    left = _blocks(rows(table)).withColumn("_group", F.pmod(F.hash("ids"), F.lit(groups)))
    right = _blocks(rows(queries)).select(
        F.col("ids").alias("query_ids"),
        F.col("vectors").alias("query_vectors"),
        "dim",
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("_group"),
    )
    pairs = left.join(right, ["_group", "dim"]).select("ids", "vectors", "query_ids", "query_vectors", "dim")

    def run(batches):
        kept: dict[bytes, tuple] = {}

        def block(ids, vectors, dim):
            if ids not in kept:
                if len(kept) > 8:
                    kept.clear()
                matrix = np.frombuffer(vectors, "<f8").reshape(-1, dim)
                kept[ids] = (np.frombuffer(ids, "<i8"), quantise(matrix))
            return kept[ids]

        for batch in batches:
            for row in range(batch.num_rows):
                ids, vectors, query_ids, query_vectors, dim = (batch.column(i)[row].as_py() for i in range(5))
                c_ids, c = block(ids, vectors, dim)
                q_ids, q = block(query_ids, query_vectors, dim)
                found = list(tile(q, q_ids, c, c_ids, k))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(q_ids[x[0]]) for x in found], pa.int64()),
                        pa.array([int(c_ids[x[1]]) for x in found], pa.int64()),
                        pa.array([float(x[2]) for x in found], pa.float64()),
                    ],
                    ["query_id", "vec_id", "score"],
                )

    tops = pairs.mapInArrow(run, "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        tops.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
