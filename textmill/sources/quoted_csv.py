"""CSV files with line breaks inside quoted fields, read in parts.

A part of a file cannot tell by itself whether it begins inside a quoted field. Every line therefore
stands for a function from the state before it (outside or inside a quoted field) to the state after
it. Tasks follow both cases through their parts, a scan over one row per part composes the functions
of the parts of each file, and every line then knows its state. Records of one line, nearly all, stay
where they are; only the lines of longer records are gathered, one record to a group.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from textmill.storage import stage_table

#: A field that begins and ends inside one line: quoted with quotes doubled, plain, or empty. Loops
#: never give back what they took, so long lines need no stack.
FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+|)'
#: Lines that end outside quotes, for one that begins outside and for one that begins inside.
ENDS_FROM_OUTSIDE = rf"\A\x{{FEFF}}?+{FIELD}(?:,{FIELD})*+\z"
ENDS_FROM_INSIDE = rf'\A[^"]*+(?:""[^"]*+)*+"[^,]*+(?:,{FIELD})*+\z'

_FOLLOWED = [
    ("_head_out", pa.int64()), ("_head_in", pa.int64()), ("_after_out", pa.bool_()), ("_after_in", pa.bool_()),
]


def _follow(batches):
    """Add the row of the line each record begins with and the state after each line, for both cases.

    State is kept for one part at a time; lines pass as Arrow batches.
    """
    part = None
    for batch in batches:
        files, blocks, rows, from_out, from_in = (
            batch.column(name).to_pylist() for name in ("_file", "_block", "_row", "_from_out", "_from_in")
        )
        added = [[], [], [], []]
        for file, block, row, out, inside in zip(files, blocks, rows, from_out, from_in):
            if part != (file, block):
                part, states, heads = (file, block), [False, True], [None, None]
            for case in (0, 1):
                if not states[case]:
                    heads[case] = row
                states[case] = inside if states[case] else out
                added[case].append(heads[case])
                added[2 + case].append(states[case])
        kept = [n for n in batch.schema.names if n not in ("_from_out", "_from_in")]
        yield pa.RecordBatch.from_arrays(
            [batch.column(n) for n in kept] + [pa.array(v, t) for v, (_, t) in zip(added, _FOLLOWED)],
            [*kept, *(n for n, _ in _FOLLOWED)],
        )


def _lines(text: DataFrame) -> DataFrame:
    """Lines of the parts with ``_head_*`` and ``_after_*``; ``_row`` rises inside a part."""
    quoted = F.contains(F.col("value"), F.lit('"'))
    lines = text.select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_row"),
        F.col("value").alias("_line"),
        *[F.col(c) for c in text.columns if c != "value"],
        (quoted & ~F.col("value").rlike(ENDS_FROM_OUTSIDE)).alias("_from_out"),
        (~quoted | ~F.col("value").rlike(ENDS_FROM_INSIDE)).alias("_from_in"),
    )
    kept = [f for f in lines.schema.fields if f.name not in ("_from_out", "_from_in")]
    added = [
        T.StructField(n, T.LongType() if t == pa.int64() else T.BooleanType()) for n, t in _FOLLOWED
    ]
    return lines.mapInArrow(_follow, T.StructType(kept + added))


def _blank(line: Column) -> Column:
    return line.isin("", "\r")


def _parts(lines: DataFrame) -> DataFrame:
    """``_file, _block, _inside, _carried, _header``: whether a part begins inside quotes, the place of
    the record that is open there, and the place of the first record of the file."""
    start = {case: F.when((F.col(f"_head_{case}") == F.col("_row")) & ~_blank(F.col("_line")), F.col("_row")) for case in ("out", "in")}
    parts = lines.groupBy("_file", "_block").agg(
        *[F.max_by(f"_after_{case}", "_row").cast("int").alias(f"_{case}") for case in ("out", "in")],
        *[F.max(f"_head_{case}").alias(f"_head_{case}") for case in ("out", "in")],
        *[F.min(start[case]).alias(f"_first_{case}") for case in ("out", "in")],
    )
    upto = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    # a part either sets the state, keeps it or swaps it: the last set and the swaps since then
    swaps = F.sum(((F.col("_out") == 1) & (F.col("_in") == 0)).cast("bigint"))
    parts = parts.withColumn("_swaps", swaps.over(upto)).withColumn(
        "_set", F.when(F.col("_out") == F.col("_in"), F.struct("_out", "_swaps"))
    )
    last_set = F.last("_set", ignorenulls=True).over(before)
    earlier = F.coalesce(F.last("_swaps").over(before), F.lit(0))
    state = F.coalesce(last_set["_out"], F.lit(0)) + earlier - F.coalesce(last_set["_swaps"], F.lit(0))
    parts = parts.withColumn("_inside", state % 2 == 1)

    def place(name: str) -> Column:
        row = F.when(F.col("_inside"), F.col(f"{name}_in")).otherwise(F.col(f"{name}_out"))
        return F.when(row.isNotNull(), F.struct(F.col("_block").alias("block"), row.alias("row")))

    return parts.select(
        "_file",
        "_block",
        "_inside",
        F.last(place("_head"), ignorenulls=True).over(before).alias("_carried"),
        F.min(place("_first")).over(Window.partitionBy("_file")).alias("_header"),
    )


def quoted_rows(text: DataFrame, schema: T.StructType, options: dict) -> DataFrame:
    """``_file, _block, _row``, the fields of ``schema`` and the partition columns of ``text``.

    ``text`` are the lines of CSV files with a header, read with ``lineSep="\\n"``; ``_block`` and
    ``_row`` are the place where a record begins. Empty lines between records are left out. A record
    that does not fit ``schema`` is an error where ``options`` say so. Lines are staged once, so the
    parts are the same in all passes. One file needs one row per part, and one record fits in memory.
    """
    lines = stage_table(_lines(text), "lines")
    parts = stage_table(_parts(lines), "parts")
    extra = [c for c in text.columns if c != "value"]
    case = lambda name: F.when(F.col("_inside"), F.col(f"{name}_in")).otherwise(F.col(f"{name}_out"))
    own = case("_head")
    at = F.struct(
        F.when(own.isNotNull(), F.col("_block")).otherwise(F.col("_carried.block")).alias("block"),
        F.coalesce(own, F.col("_carried.row")).alias("row"),
    )
    data = F.col("_header").isNotNull() & ~at.eqNullSafe(F.col("_header"))
    long = ~own.eqNullSafe(F.col("_row")) | case("_after")
    placed = lines.join(parts, ["_file", "_block"])
    # the condition is part of the value: a filter on fields may move below any filter that stands here
    alone = F.when(data & ~long & ~_blank(F.col("_line")), F.col("_line"))
    short = placed.select("_file", "_block", "_row", *extra, alone.alias("_record")).filter("_record is not null")
    in_order = F.sort_array(F.collect_list(F.struct("_block", "_row", "_line")))
    several = (
        placed.filter(data & long)
        .groupBy("_file", at.alias("_at"), *extra)
        .agg(F.concat_ws("\n", in_order["_line"]).alias("_record"))
        .select("_file", F.col("_at.block").alias("_block"), F.col("_at.row").alias("_row"), *extra, "_record")
    )
    record = F.regexp_replace("_record", r"\r\z", "")
    fields = F.from_csv(record, schema.toDDL(), {**options, "multiLine": "true"})
    rows = short.unionByName(several).withColumn("_fields", fields)
    return rows.select("_file", "_block", "_row", "_fields.*", *extra)
