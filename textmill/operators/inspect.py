"""Packed samples, token by token."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from textmill.functions.tokens import lists_of
from textmill.operators.tokenize import TokenLookup, token_table
from textmill.sources.tables import Vocabulary

# Terminal colours per class.
ANSI = {"special": "\x1b[1;43;30m", "non_word": "\x1b[45;97m", "word": "\x1b[44;97m"}
ANSI_OFF = "\x1b[0m"

#: Packed rows that one task explodes.
CHUNKS_PER_TASK = 1024
#: Packed rows that are cut into segments at once.
SEGMENTED_ROWS = 64

Batches = Iterator[pa.RecordBatch]


def head_samples(packed: DataFrame, n: int = 3) -> DataFrame:
    """The first ``n`` samples in order."""
    return packed.orderBy("chunk").limit(n)


def by_chunk(packed: DataFrame) -> DataFrame:
    """A staged packed table dealt by ``chunk``, ``CHUNKS_PER_TASK`` or so to a task.

    Groups by chunk and other columns need no shuffle after that, as long as no Python function lies between,
    so it is the packed rows that move and not one row per token, and what a task explodes fits in its memory.
    Ids move as short integers if all of them are.
    """
    ids = F.col("input_ids")
    rows, least, most = packed.agg(F.count(F.lit(1)), F.min(F.array_min(ids)), F.max(F.array_max(ids))).first()
    tasks = max(rows // CHUNKS_PER_TASK, packed.sparkSession.sparkContext.defaultParallelism)
    kind = packed.schema["input_ids"].dataType.simpleString()
    if least is None or least < -(1 << 15) or most >= 1 << 15:
        return packed.repartition(tasks, "chunk")
    dealt = packed.withColumn("input_ids", ids.cast("array<smallint>")).repartition(tasks, "chunk")
    return dealt.withColumn("input_ids", ids.cast(kind))


def explode_tokens(packed: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``chunk, pos, id, text, class``, one row per token.

    The token table is broadcast; it is as long as the vocabulary.
    """
    tokens = packed.select("chunk", F.posexplode("input_ids").alias("pos", "id"))
    known = token_table(vocabulary).select("id", "text", "class")
    return tokens.join(F.broadcast(known), "id", "left").select("chunk", "pos", "id", "text", "class")


def _runs(batch: pa.Array, kinds: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Values, offsets, and per segment its first place, its row and the kind of its first token.

    ``kinds`` numbers the class of each token id, 0 is non-word. A segment begins at each token that does
    not continue a run of non-word tokens.
    """
    values, offsets, _ = lists_of(batch)
    ids = values.fill_null(-1).to_numpy(zero_copy_only=False)
    known = (ids >= 0) & (ids < len(kinds))
    kind = np.where(known, kinds[np.where(known, ids, 0)], 0)
    opens = np.ones(len(ids), dtype=bool)
    opens[1:] = (kind[1:] != 0) | (kind[:-1] != 0)
    opens[offsets[:-1][offsets[:-1] < len(ids)]] = True
    places = np.flatnonzero(opens)
    row = np.searchsorted(offsets, places, side="right") - 1
    return values, offsets, places, row, kind[places]


def _kinds(classes: list[str]) -> tuple[list[str], np.ndarray]:
    """Names of the classes, non-word first, and the number of each token's class."""
    names = ["non_word", *sorted({*classes} - {"non_word"})]
    return names, np.array([names.index(c) for c in classes])


class _Texts:
    """Texts of runs of ids, as :meth:`TokenLookup.decode` makes them; runs of ASCII bytes are not touched one by one."""

    def __init__(self, token_bytes: list[bytes]):
        self.data = np.frombuffer(b"".join(token_bytes), np.uint8)
        self.sizes = np.array([len(x) for x in token_bytes] + [0], np.int64)  # the last one for ids that are no token
        self.begins = np.cumsum(self.sizes) - self.sizes

    def decode(self, values: pa.Array, places: np.ndarray) -> pa.Array:
        """``places`` are the borders of the runs."""
        ids = values.fill_null(-1).to_numpy(zero_copy_only=False)
        ids = np.where((ids >= 0) & (ids < len(self.sizes) - 1), ids, len(self.sizes) - 1)
        sizes = self.sizes[ids]
        stops = np.append(0, np.cumsum(sizes))
        data = self.data[np.repeat(self.begins[ids] - stops[:-1], sizes) + np.arange(stops[-1])]
        ends = stops[places]
        beyond = np.append(0, np.cumsum(data >= 128))[ends]
        wide = beyond[1:] > beyond[:-1]
        if wide.any():
            raw, borders = data.tobytes(), ends.tolist()
            texts = [raw[borders[i] : borders[i + 1]].decode("utf-8", "replace") for i in np.flatnonzero(wide).tolist()]
            data = data[~np.repeat(wide, np.diff(ends))]
            ends = np.append(0, np.cumsum(np.where(wide, 0, np.diff(ends))))
        plain = pa.StringArray.from_buffers(len(wide), pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes()))
        return pc.replace_with_mask(plain, pa.array(wide), pa.array(texts, pa.string())) if wide.any() else plain


def token_segments(
    packed: DataFrame, vocabulary: Vocabulary, then: Callable[[Batches], Batches] | None = None, schema: str | None = None
) -> DataFrame:
    """``chunk, segment, pos, class, ids, text``; each run is decoded as a whole.

    Runs of non-word tokens form one segment, every other token stands alone. All of it happens inside the
    row, so a packed table of any size is cut without a shuffle; the segments of a row follow each other.
    ``then`` is a function over batches of these rows, and ``schema`` that of what it gives: it gets them in the
    worker that makes them, as no segment then goes through the JVM.
    """
    lookup = TokenLookup(vocabulary)
    names, kinds = _kinds(lookup.class_names)
    data = lookup.token_bytes
    types = dict(packed.dtypes)

    def run(batches):
        texts = _Texts(data)
        for rows in batches:
            for at in range(0, rows.num_rows, SEGMENTED_ROWS):
                batch = rows.slice(at, SEGMENTED_ROWS)
                values, offsets, places, row, kind = _runs(batch.column(1), kinds)
                borders = np.append(places, len(values))
                first = np.searchsorted(row, np.arange(len(batch)))
                ids = pa.ListArray.from_arrays(pa.array(borders.astype(np.int32)), values)
                columns = [
                    batch.column(0).take(pa.array(row)),
                    pa.array((np.arange(len(row)) - first[row]).astype(np.int32)),
                    pa.array((places - offsets[row]).astype(np.int32)),
                    pa.array(names, pa.string()).take(pa.array(kind)),
                    ids,
                    texts.decode(values, borders),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["chunk", "segment", "pos", "class", "ids", "text"])

    rows = packed.filter(F.size("input_ids") > 0).select("chunk", "input_ids")
    if then is not None:
        return rows.mapInArrow(lambda batches: then(run(batches)), schema)
    return rows.mapInArrow(
        run, f"chunk {types['chunk']}, segment int, pos int, class string, ids {types['input_ids']}, text string"
    )


#: What :func:`segment_totals` gives.
TOTALS = "chunk bigint, class string, n_segments bigint, pos_sum bigint, segment_sum bigint, n_tokens bigint, text_md5 string"


def segment_totals(batches: Batches) -> Batches:
    """Batches of segments to ``TOTALS`` of each chunk and class, the texts in order with ``|`` between. The segments
    of a chunk follow each other in order, as :func:`token_segments` makes them for a table with one row per chunk."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([*held, batch])
        # the last chunk may go on in the next batch
        last = int(np.flatnonzero(_changes(rows.column(0).combine_chunks()))[-1])
        if last:
            yield _totals(rows.slice(0, last))
        held = rows.slice(last).to_batches()
    if held:
        yield _totals(pa.Table.from_batches(held))


def _totals(rows: pa.Table) -> pa.RecordBatch:
    chunk, segment, pos, name, ids, text = (c.combine_chunks() for c in rows.columns)
    classes = name.dictionary_encode()
    code = classes.indices.to_numpy(zero_copy_only=False)
    group = np.cumsum(_changes(chunk)) * len(classes.dictionary) + code
    order = np.argsort(group, kind="stable")
    begins = np.flatnonzero(np.append(True, np.diff(group[order]) != 0))
    first, ends = pa.array(order[begins]), np.append(begins, len(order))
    sums = [np.add.reduceat(x.to_numpy(zero_copy_only=False).astype(np.int64)[order], begins) for x in (pos, segment, pc.list_value_length(ids))]
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), text.take(pa.array(order))), "|")
    digests = [hashlib.md5(x.as_buffer()).hexdigest() for x in joined]
    columns = [chunk.take(first), name.take(first), *(pa.array(x) for x in (np.diff(ends), *sums)), pa.array(digests, pa.string())]
    return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in TOTALS.split(", ")])


def _changes(values: pa.Array) -> np.ndarray:
    """Which values differ from the one before; nulls are equal."""
    codes = values.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    return np.append(True, codes[1:] != codes[:-1])


def render_samples(packed: DataFrame, vocabulary: Vocabulary, ansi: bool = False) -> DataFrame:
    """``chunk, line``: ``text(ids)`` per segment, joined by spaces behind a sample header."""
    lookup = TokenLookup(vocabulary)
    names, kinds = _kinds(lookup.class_names)
    data = lookup.token_bytes

    def paint(text: str, name: str) -> str:
        return f"{ANSI.get(name, '')}{text}{ANSI_OFF}" if ansi else text

    def item(ids: list[int | None], name: str) -> str:
        held = b"".join(data[i] for i in ids if i is not None and 0 <= i < len(data))
        shown = ",".join(str(i) for i in ids if i is not None)
        return f"{paint(held.decode('utf-8', 'replace'), name)}({shown})"

    alone = [item([i], names[k]) for i, k in enumerate(kinds)]

    @F.arrow_udf("string")
    def lines(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            values, offsets, places, row, kind = _runs(batch, kinds)
            ends = np.searchsorted(row, np.arange(len(batch) + 1)).tolist()
            out = []
            for k, (a, b) in enumerate(zip(ends, ends[1:])):
                lo, hi = int(offsets[k]), int(offsets[k + 1])
                ids, begins = values[lo:hi].to_pylist(), [*(places[a:b] - lo).tolist(), hi - lo]
                items = []
                for s, (at, end) in enumerate(zip(begins, begins[1:]), a):
                    first = ids[at]
                    if end - at == 1 and first is not None and 0 <= first < len(alone):
                        items.append(alone[first])
                    else:
                        items.append(item(ids[at:end], names[kind[s]]))
                out.append(" ".join(items))
            yield pa.array(out, pa.string())

    header = F.concat(F.lit("[PACKED SAMPLE "), F.col("chunk").cast("string"), F.lit("]"))
    if ansi:
        header = F.concat(F.lit(ANSI["special"]), header, F.lit(ANSI_OFF))
    return packed.filter(F.size("input_ids") > 0).select(
        "chunk", F.concat(header, F.lit(" "), lines("input_ids")).alias("line")
    )
