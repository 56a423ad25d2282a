"""Wrapped packing: one global concatenation in order, cut every ``sequence_len`` tokens."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from textmill.functions.tokens import SQUEEZED, lists_of, squeezed, unsqueezed
from textmill.operators.order import BUCKET, BUCKET_ROWS, with_start
from textmill.storage import stage_table

#: Tokens that are expanded at once, or one row.
SLICE_TOKENS = 2_000_000


def _fragments(placed: DataFrame, size: Column, sequence_len: int, keep: list[str]) -> DataFrame:
    """One row per (input row, chunk) with the global token range ``[lo, hi)`` they share."""
    length = F.lit(sequence_len).cast("bigint")
    begin, end = F.col("start"), F.col("start") + size
    first = F.call_function("div", begin, length)
    last = F.call_function("div", end - 1, length)

    def cut(chunk: Column) -> Column:
        lo, hi = F.greatest(begin, chunk * length), F.least(end, (chunk + 1) * length)
        return F.struct(chunk.alias("chunk"), lo.alias("lo"), hi.alias("hi"))

    return placed.select(*keep, F.inline(F.transform(F.sequence(first, last), cut)))


def _squeezed(rows: DataFrame, order: list[str], columns: dict[str, str]) -> DataFrame:
    """``[*order, _n]`` and the lists of ``columns`` in the form in which they move."""
    kept, types = [*order, "_n"], dict(rows.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in kept)

    def run(batches):
        for batch in batches:
            lists = [squeezed(batch.column(c), kind) if kind in SQUEEZED else batch.column(c) for c, kind in columns.items()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *lists], [*kept, *columns])

    lists = ", ".join(f"`{c}` {'binary' if kind in SQUEEZED else kind}" for c, kind in columns.items())
    return rows.select(*kept, *columns).mapInArrow(run, f"{schema}, {lists}")


def _slices(batches: Iterator[pa.RecordBatch], columns: dict[str, str]):
    """``start, n, base, end`` of some rows, and the values of each of their lists one after another."""
    for batch in batches:
        start, n, base, load = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("start", "_n", "base", "load"))
        at, total = 0, np.cumsum(n)
        while at < len(n):
            done = total[at - 1] if at else 0
            own = slice(at, max(int(np.searchsorted(total, done + SLICE_TOKENS, side="right")), at + 1))
            values = []
            for c, kind in columns.items():
                lists = batch.column(c)[own]
                if kind in SQUEEZED:
                    values.append(pa.concat_arrays([unsqueezed(x.as_py(), size, kind) for x, size in zip(lists, n[own].tolist())]))
                else:
                    values.append(lists_of(lists)[0])
            if any(len(x) != n[own].sum() for x in values):
                raise ValueError("lists of a row differ in length")
            yield start[own], n[own], base[own], (base + load)[own], values
            at = own.stop


def _whole_chunks(placed: DataFrame, sequence_len: int, columns: dict[str, str]) -> DataFrame:
    """``chunk`` and lists of the chunks that lie inside one bucket; rows of a bucket follow each other in order.

    Tokens behind the last border stay until the next rows of the bucket; the values are cut without a copy."""
    fields = "".join(f", `{c}` {kind}" for c, kind in columns.items())

    def run(batches):
        bucket, upto, since, held = None, 0, 0, None  # the open bucket, its end so far, what is held of it
        for start, n, base, _, values in _slices(batches, columns):
            ends = np.append(0, np.cumsum(n))
            cuts = np.flatnonzero(np.append(True, base[1:] != base[:-1]))
            for i, j in zip(cuts.tolist(), [*cuts[1:].tolist(), len(n)]):
                lo, hi = int(start[i]), int(start[j - 1] + n[j - 1])
                if hi - lo != ends[j] - ends[i] or (bucket == base[i] and upto != lo):
                    raise ValueError("rows of a bucket do not follow each other")
                own = [x[ends[i] : ends[j]] for x in values]
                if bucket == base[i] and held is not None:
                    own, lo = [pa.concat_arrays([x, y]) for x, y in zip(held, own)], since
                first = -(-lo // sequence_len)
                count = hi // sequence_len - first
                if count > 0:
                    places = pa.array((first * sequence_len - lo + sequence_len * np.arange(count + 1)).astype(np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(first + np.arange(count)), *(pa.ListArray.from_arrays(places, x) for x in own)], ["chunk", *columns]
                    )
                bucket, upto, since = base[i], hi, (first + max(count, 0)) * sequence_len
                # without its buffers, which hold all tokens of the slice
                held = [pa.concat_arrays([x[since - lo :], x[:0]]) for x in own] if since <= hi else None

    return placed.select("start", "_n", "base", "load", *columns).mapInArrow(run, f"chunk bigint{fields}")


def _joints(placed: DataFrame, sequence_len: int, columns: dict[str, str]) -> DataFrame:
    """``chunk, lo`` and lists: the pieces of the first and last chunk of a bucket that reach beyond it."""
    fields = "".join(f", `{c}` {kind}" for c, kind in columns.items())
    length, end = F.lit(sequence_len).cast("bigint"), F.col("base") + F.col("load")
    head = F.least(F.call_function("div", F.col("base") + (length - 1), length) * length, end)
    tail = F.greatest(F.call_function("div", end, length) * length, head)
    near = placed.filter((F.col("start") < head) | (F.col("start") + F.col("_n") > tail))

    def run(batches):
        for start, n, base, end, values in _slices(batches, columns):
            head = np.minimum(-(-base // sequence_len) * sequence_len, end)
            tail = np.maximum(end // sequence_len * sequence_len, head)
            offset = np.cumsum(n) - n - start
            lo = np.append(start, np.maximum(start, tail))
            hi = np.append(np.minimum(start + n, head), start + n)
            offset, own = np.append(offset, offset), lo < hi
            lo, hi, offset = lo[own], hi[own], offset[own]
            places = np.append(0, np.cumsum(hi - lo))
            at = pa.array(np.repeat(lo + offset - places[:-1], hi - lo) + np.arange(places[-1]))
            lists = [pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), x.take(at)) for x in values]
            yield pa.RecordBatch.from_arrays([pa.array(lo // sequence_len), pa.array(lo), *lists], ["chunk", "lo", *columns])

    return near.select("start", "_n", "base", "load", *columns).mapInArrow(run, f"chunk bigint, lo bigint{fields}")


def pack_plan(
    df: DataFrame,
    sequence_len: int,
    order: list[str],
    tokens: Column | None = None,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """The cut plan without tokens: ``[*order, chunk, row_from, chunk_from, n_tokens]``.

    ``tokens`` is the token count per row (default: size of ``input_ids``). Order keys and counts are
    staged, so the input is read once.
    """
    size = F.size("input_ids") if tokens is None else tokens
    rows = stage_table(df.select(*order, size.cast("bigint").alias("_n")).filter("_n > 0"), "sizes")
    placed = with_start(rows, F.col("_n"), order, bucket_rows=bucket_rows)
    return _fragments(placed, F.col("_n"), sequence_len, [*order, "start"]).select(
        *order,
        "chunk",
        (F.col("lo") - F.col("start")).alias("row_from"),
        (F.col("lo") - F.col("chunk") * sequence_len).alias("chunk_from"),
        (F.col("hi") - F.col("lo")).alias("n_tokens"),
    )


def pack_wrapped(
    df: DataFrame,
    sequence_len: int,
    order: list[str],
    keep_tail: bool = False,
    columns: tuple[str, ...] = ("input_ids",),
    tokens: Column | None = None,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``chunk`` and the packed columns; every list is cut at the same places.

    Rows move once, compressed, to their bucket, and chunks that lie inside one bucket are put together there.
    Only the pieces of the first and last chunk of a bucket move a second time. A group never
    holds more than ``sequence_len`` tokens. The short last chunk is dropped unless ``keep_tail``.
    ``tokens`` is a stored token count; with it the pass that finds positions reads no arrays.
    """
    size = F.col("_n")
    count = F.size(columns[0]) if tokens is None else tokens
    rows = df.select(*order, *columns, count.cast("bigint").alias("_n")).filter("_n > 0")
    types = dict(rows.dtypes)
    lists = {c: types[c] for c in columns}
    placed = with_start(rows, size, order, bucket_rows=bucket_rows, moved=_squeezed(rows, order, lists))
    parts = F.sort_array(F.collect_list(F.struct("lo", *columns))).alias("_parts")
    joints = _joints(placed, sequence_len, lists).groupBy("chunk").agg(parts)
    joints = joints.select("chunk", *[F.flatten(F.col(f"_parts.{c}")).alias(c) for c in columns])
    if not keep_tail:
        joints = joints.filter(F.size(columns[0]) == sequence_len)
    return _whole_chunks(placed, sequence_len, lists).unionByName(joints)
