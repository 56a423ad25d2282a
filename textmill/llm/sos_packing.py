"""Sum-of-squares packing of token documents into sequences.

Whole sequences are cut from the front of a document; what is left of it (shorter than a sequence)
is placed online. With ``count[h]`` open windows filled up to level ``h``, a piece of ``s`` tokens
goes to the level that makes the sum of ``count[h] ** 2`` smallest; full windows leave the array.
What is still open when a task ends is joined and cut anew into full sequences, and the last rest
into powers of two, so that only cuts remain and nothing is padded.

Each task packs the rows it scans: no row moves, memory holds the open windows alone. When these
hold more than ``OPEN_TOKENS`` they are closed the same way.
A null text counts as empty; every document has its end id, so an empty one has one token. Rows
that repeat are packed as often as they occur; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

from textmill.llm.public_bpe import DROP_SPACE, worker_encoder

#: Tokens in open windows of one task; more are closed. A bound of memory.
OPEN_TOKENS = 8_000_000

#: A piece of a document: (row, first token, ids).
Piece = tuple[int, int, np.ndarray]


class SumOfSquares:
    """Places pieces one after the other; ``closed`` receives every finished window."""

    def __init__(self, capacity: int, closed):
        self.capacity, self._closed = capacity, closed
        self.count = np.zeros(capacity + 1, np.int64)
        self._open: dict[int, list[list[Piece]]] = defaultdict(list)
        self.tokens = 0

    def level_for(self, size: int) -> int:
        """The level to put ``size`` tokens on; 0 opens a window. Ties go to the fullest."""
        count, room = self.count, self.capacity - size
        # count[h] falls and count[h + size] rises by one; level 0 and full windows do not count
        cost = 2 * (count[size:] - count[: room + 1]) + 2
        cost[0] = 2 * count[size] + 1
        cost[room] = 1 - 2 * count[room]
        cost[1:][count[1 : room + 1] == 0] = np.iinfo(np.int64).max
        return room - int(np.argmin(cost[::-1]))

    def place(self, piece: Piece) -> None:
        size = len(piece[2])
        level = self.level_for(size)
        window = self._open[level].pop() if level else []
        self.count[level] -= level > 0
        window.append(piece)
        self.tokens += size
        if level + size == self.capacity:
            self.tokens -= self.capacity
            self._closed(window)
        else:
            self._open[level + size].append(window)
            self.count[level + size] += 1
        if self.tokens > OPEN_TOKENS:
            self.close()

    def close(self) -> None:
        """Join the open windows, fullest first, and cut them without padding."""
        rest = [p for level in sorted(self._open, reverse=True) for w in self._open[level] for p in w]
        left = self.tokens
        self._open.clear()
        self.count[:] = 0
        self.tokens = 0
        window, room = [], self._next(left)
        for row, start, ids in rest:
            while len(ids):
                part = ids[:room]
                window.append((row, start, part))
                ids, start, room, left = ids[len(part) :], start + len(part), room - len(part), left - len(part)
                if room == 0:
                    self._closed(window)
                    window, room = [], self._next(left)

    def _next(self, left: int) -> int:
        return self.capacity if left >= self.capacity else 1 << max(left.bit_length() - 1, 0)


def pack(
    documents: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = 2048, end_id: int = 1
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``tokenizer`` is a file of the tokenizers library, on every executor. ``capacity`` must be a
    power of two if the rest is to end without padding.
    """
    id_field = documents.schema[doc_id]
    names = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    schema = StructType([StructField("doc_id", id_field.dataType)] + [StructField(n, LongType()) for n in names])

    def run(batches):
        encoder = worker_encoder(tokenizer, DROP_SPACE)
        first = TaskContext.get().partitionId() << 36
        done: list[tuple] = []
        owners: dict[int, tuple] = {}  # row -> (doc_id, tokens)

        def closed(window: list[Piece]) -> None:
            nonlocal first
            at = 0
            for row, start, ids in window:
                own, total = owners[row]
                done.append((own, start, len(ids), zlib.crc32(ids.tobytes()), total, first, at))
                at += len(ids)
            first += 1

        packer = SumOfSquares(capacity, closed)
        id_type = None
        row = 0

        def out():
            columns = list(zip(*done)) if done else [()] * 7
            arrays = [pa.array(columns[0], id_type)] + [pa.array(c, pa.int64()) for c in columns[1:]]
            done.clear()
            return pa.RecordBatch.from_arrays(arrays, ["doc_id", *names])

        for batch in batches:
            id_type = batch.schema.field(0).type
            for own, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encoder.encode(value.as_py()), np.int32(end_id)).astype("<u4")
                owners[row] = (own, len(ids))
                whole = len(ids) - len(ids) % capacity
                for start in range(0, whole, capacity):
                    closed([(row, start, ids[start : start + capacity])])
                if whole < len(ids):
                    packer.place((row, whole, ids[whole:].copy()))
                else:
                    del owners[row]
                row += 1
            if len(owners) > 4 * sum(map(len, packer._open.values())) + 10_000:
                held = {p[0] for ws in packer._open.values() for w in ws for p in w}
                owners = {r: owners[r] for r in held}
            yield out()
        packer.close()
        if id_type is not None:
            yield out()

    return documents.select(doc_id, text).mapInArrow(run, schema)
