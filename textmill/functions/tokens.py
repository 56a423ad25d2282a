"""Expressions over token-id arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F, types as T

IGNORED_LABEL = -100
_HEX = np.array([f"{i:04X}".encode() for i in range(1 << 16)], dtype="S4")


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def append_eos(ids, eos: int | None) -> Column:
    """Append the end id; without one the array is unchanged."""
    if eos is None:
        return _col(ids)
    return F.concat(_col(ids), F.array(F.lit(eos).cast("int")))


def attention_mask(ids) -> Column:
    return F.array_repeat(F.lit(1).cast("tinyint"), F.size(_col(ids)))


def token_type_ids(ids) -> Column:
    return F.array_repeat(F.lit(0).cast("tinyint"), F.size(_col(ids)))


def lm_labels(ids, pad: int | None) -> Column:
    """Copy of the ids with pad positions ignored."""
    if pad is None:
        return _col(ids)
    ignored = F.lit(IGNORED_LABEL)
    return F.transform(_col(ids), lambda x: F.when(x == F.lit(pad), ignored).otherwise(x))


def lists_of(array: pa.Array) -> tuple[pa.Array, np.ndarray, pa.Array | None]:
    """Values, offsets that begin at 0, and which lists are null."""
    offsets = array.offsets.to_numpy()
    values = array.values.slice(offsets[0], offsets[-1] - offsets[0])
    return values, offsets - offsets[0], array.is_null() if array.null_count else None


#: Element types of the lists that are squeezed, by the name Spark gives the lists.
SQUEEZED = {"array<tinyint>": "<i1", "array<smallint>": "<i2", "array<int>": "<i4", "array<bigint>": "<i8"}


def squeezed(array: pa.Array, kind: str) -> pa.Array:
    """Lists of whole numbers as bytes, for a shuffle: a byte that says whether any value is null, then,
    compressed, which ones are if any is and the first, second, ... byte of all values."""
    width = np.dtype(SQUEEZED[kind]).itemsize
    values, offsets, missing = lists_of(array)
    holes = values.is_null().to_numpy(zero_copy_only=False) if values.null_count else None
    data = (values if holes is None else values.fill_null(0)).to_numpy(zero_copy_only=False)
    data = data.view(np.uint8).reshape(-1, width)
    out, ends = [], offsets.tolist()
    for lo, hi in zip(ends, ends[1:]):
        raw, head = data[lo:hi].T.tobytes(), b"\0"
        if holes is not None and holes[lo:hi].any():
            raw, head = holes[lo:hi].tobytes() + raw, b"\1"
        out.append(head + pa.compress(raw, "zstd", asbytes=True))
    if missing is not None:
        out = [None if gone else x for x, gone in zip(out, missing.to_pylist())]
    return pa.array(out, pa.binary())


def unsqueezed(data: bytes, size: int, kind: str) -> pa.Array:
    """The ``size`` values of one list."""
    dtype = np.dtype(SQUEEZED[kind])
    planes = dtype.itemsize + data[0]
    raw = np.frombuffer(pa.decompress(data[1:], planes * size, "zstd", asbytes=True), np.uint8).reshape(planes, size)
    values = np.ascontiguousarray(raw[data[0] :].T).view(dtype).ravel()
    return pa.array(values, mask=raw[0].astype(bool)) if data[0] else pa.array(values)


def _hex4(value: int | None) -> bytes:
    return b"" if value is None else f"{value & (1 << 64) - 1:04X}"[:4].encode()


@F.arrow_udf(T.StringType())
def _token_hex(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        values, offsets, missing = lists_of(batch)
        known = values.null_count == 0
        ids = values.to_numpy(zero_copy_only=False) if known else None
        if known and (not ids.size or 0 <= ids.min() and ids.max() < len(_HEX)):
            data, ends = _HEX[ids].tobytes(), offsets.astype(np.int64) * 4
        else:
            parts = [_hex4(v) for v in values.to_pylist()]
            data, ends = b"".join(parts), np.cumsum([0, *map(len, parts)])[offsets]
        nulls = None if missing is None else pc.invert(missing).buffers()[1]
        yield pa.LargeStringArray.from_buffers(len(batch), pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(data), nulls).cast(pa.string())


def token_hex(ids) -> Column:
    """Ids as 4-digit upper-case hex, concatenated; used to compare packed rows by hash."""
    return _token_hex(_col(ids))


@F.arrow_udf(T.StringType())
def _joined(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        values, offsets, missing = lists_of(batch)
        if values.null_count:
            rows = batch.to_pylist()
            yield pa.array([None if r is None else ",".join(str(v) for v in r if v is not None) for r in rows], pa.string())
            continue
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values.cast(pa.string()))
        joined = pc.binary_join(lists, ",")
        yield joined if missing is None else pc.if_else(missing, pa.scalar(None, pa.string()), joined)


def joined_ids(ids) -> Column:
    """Whole numbers as text with commas between; nulls are left out."""
    return _joined(_col(ids))
