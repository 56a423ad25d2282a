"""Corpora: named sources with a split and a text column, joined in order."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from textmill.functions.text import text_or_null
from textmill.operators.order import first_rows, spread
from textmill.sources.quoted_csv import quoted_rows
from textmill.storage import file_system

ROW_ORDER = ["file", "block", "row"]
CORPUS_ORDER = ["src", *ROW_ORDER]
EXTENSIONS = {
    "parquet": "parquet", "orc": "orc", "json": "json", "jsonl": "json", "csv": "csv", "txt": "text",
}
SPLIT = re.compile(r"(\w+)(?:\[:(\d+)\])?")


@dataclass(frozen=True)
class Source:
    """One corpus source. ``schema`` spares the inference pass over JSON and CSV files."""

    path: str
    split: str = "train"
    text_column: str = "text"
    format: str | None = None
    schema: str | None = None
    multi_line: bool | None = None


def _first_match(spark: SparkSession, *patterns: str) -> str | None:
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for pattern in patterns:
        if file_system(spark, pattern).globStatus(path_of(pattern)):
            return pattern
    return None


def _format_in(name: Column) -> Column:
    """The format a file name stands for: its last extension, compression left out; null if unknown."""
    stem = F.regexp_replace(F.lower(name), r"\.(gz|zst|bz2|snappy|lz4)$", "")
    known = F.create_map(*[F.lit(x) for pair in EXTENSIONS.items() for x in pair])
    return known[F.regexp_extract(stem, r"\.([^./]+)$", 1)]


def _format_of(spark: SparkSession, path: str) -> str:
    """The one format of all files below ``path``; hidden files do not count.

    Spark lists the files and only distinct formats come back, however many files there are.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    formats = files.groupBy(_format_in(F.col("path")).alias("format")).agg(F.min("path").alias("path")).collect()
    if not formats:
        return spark.range(1).select(_format_in(F.lit(path.rstrip("/")))).first()[0] or "parquet"
    if len(formats) > 1 or formats[0].format is None:
        example = {r.format: r.path for r in formats}
        raise ValueError(f"{path} has files of mixed or unknown formats ({example}); give format=")
    return formats[0].format


def _other_split(spark: SparkSession, root: str) -> str | None:
    """A folder or file that is named like a split, if there is one."""
    names = ("test", "validation", "valid", "val", "dev", "eval")
    return _first_match(spark, *[f"{root}/{n}{end}" for n in names for end in ("", ".*", "-*")])


def _is_folder(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = file_system(spark, path)
    return fs.exists(at) and fs.getFileStatus(at).isDirectory()


def _first_files(spark: SparkSession, path: str, n: int, read) -> list[str] | None:
    """The first files below ``path``, one and then twice as many, until ``read`` of them has ``n`` rows.

    None where that takes all files. The driver holds the names of these files only; they are in the
    order of rows. Names with pattern characters cannot be given to a reader, so they read everything.
    """
    listing = spark.read.format("binaryFile").load(path).select("path", F.col("_metadata.file_path").alias("file"))
    k = 1
    while True:
        first = [r.path for r in listing.orderBy("file").limit(k + 1).collect()]
        if len(first) <= k or any(re.search(r"[\[\]{}*?\\]", p) for p in first):
            return None
        if read(first[:k]).limit(n).count() >= n:
            return first[:k]
        k *= 2


def _array_file(spark: SparkSession, path: str) -> bool:
    """Whether JSON text begins with an array that goes on after its first line."""
    first = spark.read.text(path).filter(F.trim("value") != "").limit(1).collect()
    line = first[0][0].strip() if first else ""
    return line.startswith("[") and not line.endswith("]")


def read_source(
    spark: SparkSession,
    path: str,
    split: str = "train",
    format: str | None = None,
    text_column: str = "text",
    schema: str | None = None,
    multi_line: bool | None = None,
) -> DataFrame:
    """Read one source as ``file, block, row, text``.

    The split is, in this order: the folder ``path/split``, files ``path/split.*`` or
    ``path/split-*``, or the rows of ``path`` whose ``split`` column has that value. A path without
    any of these is all ``train``; any other split of it is an error, and so is ``train`` beside
    other splits. ``split="train[:10000]"`` keeps the first rows in file order.

    CSV fields may hold line breaks and doubled quotes, and large files are read in parts all the same
    (their lines are staged once). ``multi_line=False`` spares that where no field has a line break,
    ``multi_line=True`` has one task read a file, as lines that end in CR alone need. JSON files are
    lines or arrays (``multi_line`` tells, otherwise the first line does); an array is read by one
    task. Records that cannot be parsed are an error, never null.

    ``row`` is the row index inside a parquet file. Other formats have no row index: ``block`` is
    the byte offset of the file block and ``row`` counts rows in read order, so order inside the
    source is the same, the numbers are not dense. Their slices open a doubling number of files until
    these hold enough rows, not the whole source.
    """
    parsed = SPLIT.fullmatch(split)
    if parsed is None:
        raise ValueError(f"unsupported split: {split}")
    name, limit = parsed.group(1), parsed.group(2)
    root = path.rstrip("/")
    target = _first_match(spark, f"{root}/{name}", f"{root}/{name}.*", f"{root}/{name}-*") or path
    fmt = format or _format_of(spark, target)

    reader = spark.read
    options = {}
    if fmt == "csv":
        whole = multi_line is None or multi_line
        options = {"quote": '"', "escape": '"', "mode": "FAILFAST"}
        reader = reader.options(header="true", multiLine=str(whole).lower(), **options)
    elif fmt == "json":
        whole = _array_file(spark, target) if multi_line is None else multi_line
        reader = reader.options(multiLine=str(whole).lower(), mode="FAILFAST")
    if schema:
        reader = reader.schema(schema)
    df = reader.format(fmt).load(target)
    columns = ["text" if fmt == "text" and c == "value" and text_column == "text" else c for c in df.columns]
    if text_column not in columns:
        raise ValueError(f"no column {text_column!r} in {target}")
    if text_column != "text" and "text" in columns:
        raise ValueError(f"{target} has a column 'text' besides {text_column!r}")
    by_column = target == path and "split" in columns
    if target == path and not by_column and (name != "train" or _other_split(spark, root)):
        raise ValueError(f"{path} has no split {name!r}")

    def in_split(rows: DataFrame) -> DataFrame:
        return rows.filter(F.col("split") == name) if by_column else rows

    if fmt == "parquet":
        place = [F.lit(0).cast("bigint"), F.col("_metadata.row_index")]
    else:
        in_task = (1 << 33) - 1
        place = [F.col("_metadata.file_block_start"), F.monotonically_increasing_id().bitwiseAND(F.lit(in_task))]

    def load(frame: DataFrame, lines: DataFrame | None) -> DataFrame:
        """``file, block, row, text`` of the files of ``frame``, whose lines ``lines`` are."""
        frame = frame.toDF(*columns)
        text = text_or_null(frame, text_column).alias("text")
        if lines is None:
            keys = [F.col("_metadata.file_path"), *place]
        else:
            own = T.StructType([f for f in frame.schema.fields if f.name not in lines.columns[1:]])
            frame = quoted_rows(lines, own, options)
            keys = [F.col("_file"), F.col("_block"), F.col("_row")]
        return in_split(frame).select(*[k.alias(c) for k, c in zip(keys, ROW_ORDER)], text)

    in_parts = fmt == "csv" and multi_line is None
    paths, base = target, {}
    if limit is not None and fmt != "parquet":
        base = {"basePath": target if target == path or _is_folder(spark, target) else root}
        paths = _first_files(
            spark, target, int(limit), lambda files: in_split(reader.options(**base).format(fmt).load(files).toDF(*columns))
        )
        base, paths = (base, paths) if paths else ({}, target)
        if paths != target:
            df = reader.schema(df.schema).options(**base).format(fmt).load(paths)
    lines = spark.read.options(lineSep="\n", **base).text(paths) if in_parts else None
    rows = load(df, lines)
    if limit is not None:
        if fmt == "parquet":  # n rows of the same file stand before the row with index n
            rows = rows.filter(F.col("row") < int(limit))
        rows = slice_rows(rows, int(limit), ROW_ORDER)
    return spread(rows, ROW_ORDER) if fmt == "parquet" else rows


def slice_rows(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first ``n`` rows in ``order``."""
    return first_rows(df, n, order)


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """Concatenate in list order, duplicates kept; ``src`` is the place in the list."""
    if not frames:
        raise ValueError("No datasets to load.")
    tagged = [
        df.select(F.lit(i).cast(T.IntegerType()).alias("src"), *df.columns)
        for i, df in enumerate(frames)
    ]
    return reduce(DataFrame.unionByName, tagged)


def read_corpus(spark: SparkSession, sources: list[Source]) -> DataFrame:
    """All sources as ``src, file, block, row, text``."""
    return union_sources(
        [
            read_source(spark, s.path, s.split, s.format, s.text_column, s.schema, s.multi_line)
            for s in sources
        ]
    )
