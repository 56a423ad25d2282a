"""Token-ID files of a corpus: encode texts with a public tokenizer, write, and read back.

Documents are range-partitioned and sorted by id (null first; equal ids by the hash of their text),
so the files of a folder, in the order of ``part`` and ``file``, hold all ids in ascending order of
documents. A task writes a new file after about ``FILE_IDS`` ids, at the end of a document; its memory
is that of one file. Files are rows ``part, file, n_ids, data`` of a Parquet folder: Spark's
committer makes a retried task replace its own files. See :mod:`range_coder` for ``data``.

A null text counts as empty: its document has the end id only. Rows that repeat are written again.
An empty table gives a folder without files and an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from textmill.llm.public_bpe import KEEP_SPACE, worker_encoder
from textmill.llm.range_coder import decode_file, encode_file

#: Ids after which a file ends with the document at hand.
FILE_IDS = 4_000_000


def write(documents: DataFrame, path: str, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write the ids of ``documents``, each followed by ``end_id``, as token files below ``path``."""
    rows = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))

    def run(batches):
        encoder, part, number = worker_encoder(tokenizer, KEEP_SPACE), TaskContext.get().partitionId(), 0
        names, ids, held = [], [], 0

        def file():
            data = encode_file(names, np.array([len(x) for x in ids], np.int64), np.concatenate(ids))
            columns = [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([held], pa.int64()), pa.array([data], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["part", "file", "n_ids", "data"])

        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.append(encoder.encode(value.as_py()), np.int32(end_id))
                names.append(name)
                ids.append(own)
                held += len(own)
                if held >= FILE_IDS:
                    yield file()
                    number, names, ids, held = number + 1, [], [], 0
        if names:
            yield file()

    ordered.mapInArrow(run, "part int, file int, n_ids bigint, data binary").write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files alone."""
    files = spark.read.parquet(path)

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                part, file, data = (batch.column(i)[row].as_py() for i in range(3))
                names, sizes, ids = decode_file(data)
                ends = np.cumsum(sizes)
                raw = ids.astype("<u4")
                crcs = [zlib.crc32(raw[e - s : e].tobytes()) for s, e in zip(sizes, ends)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * len(names), pa.int32()),
                        pa.array([file] * len(names), pa.int32()),
                        pa.array(names, pa.int64()),
                        pa.array(ends - sizes, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(crcs, pa.int64()),
                    ],
                    ["part", "file", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )

    schema = "part int, file int, doc_id bigint, inside bigint, n_tokens bigint, ids_crc32 bigint"
    documents = files.select("part", "file", "data").mapInArrow(run, schema)
    # one row per part, then one per file of a part: narrow rows, a file holds millions of ids
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start")
    )
    inside = Window.partitionBy("part").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("part", "file", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("file_start"))
    return (
        documents.join(starts.join(parts, "part"), ["part", "file"])
        .select("doc_id", (F.col("part_start") + F.col("file_start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
    )
