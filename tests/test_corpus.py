import pytest
from pyspark.sql import functions as F

from textmill.operators.dedup import dedup_first, quality_and_unique
from textmill.operators.filters import select_rows
from textmill.operators import order as ordering
from textmill.operators.order import with_start
from textmill.plans.jobs import prepare_corpus
from textmill.sources import corpus
from textmill.sources.corpus import CORPUS_ORDER, Source, read_corpus, read_source, slice_rows


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("sources")
    spark.createDataFrame([(f"a{i}",) for i in range(5)], "text string").coalesce(1).write.parquet(f"{root}/one/train")
    spark.createDataFrame([], "content string").write.parquet(f"{root}/two/train")
    frame = spark.createDataFrame([(f"c{i}", i) for i in range(12)], "text string, extra int")
    for part in range(3):
        frame.filter(F.col("extra") % 3 == part).coalesce(1).write.mode("append").parquet(f"{root}/three")
    frame.coalesce(1).write.json(f"{root}/four/train")
    frame.coalesce(1).write.option("header", True).csv(f"{root}/five/train")
    return root


def texts(df):
    return [r.text for r in df.orderBy(*[c for c in df.columns if c != "text"]).collect()]


def test_union_keeps_source_order_and_duplicates(spark, sources):
    union = read_corpus(
        spark, [Source(f"{sources}/one"), Source(f"{sources}/two", text_column="content"), Source(f"{sources}/one")]
    )
    assert union.columns == ["src", "file", "block", "row", "text"]
    assert texts(union) == [f"a{i}" for i in range(5)] * 2
    assert {r.src for r in union.collect()} == {0, 2}


def test_slice_over_several_files(spark, sources):
    whole = read_source(spark, f"{sources}/three")
    for n in (0, 1, 4, 7, 12, 50):
        part = read_source(spark, f"{sources}/three", f"train[:{n}]")
        assert texts(part) == texts(whole)[:n]


def test_other_formats_and_text_columns(spark, sources):
    for name in ("four", "five"):
        assert texts(read_source(spark, f"{sources}/{name}")) == [f"c{i}" for i in range(12)]
    # a column that is not text counts as missing text
    assert set(texts(read_source(spark, f"{sources}/three", text_column="text"))) == {f"c{i}" for i in range(12)}
    with pytest.raises(ValueError):
        read_source(spark, f"{sources}/three", text_column="extra")
    with pytest.raises(ValueError):
        read_source(spark, f"{sources}/three", text_column="nothing")
    with pytest.raises(ValueError):
        read_source(spark, f"{sources}/three", split="train[5:]")


def test_split_column(spark, tmp_path):
    spark.createDataFrame([("a", "train"), ("b", "test")], "text string, split string").write.partitionBy(
        "split"
    ).parquet(f"{tmp_path}/s")
    assert texts(read_source(spark, f"{tmp_path}/s", "test")) == ["b"]


def test_no_sources(spark):
    with pytest.raises(ValueError, match="No datasets to load."):
        read_corpus(spark, [])


def test_pruned_scan(spark, sources):
    plan = read_source(spark, f"{sources}/three")._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema: ")[1]
    assert "text:string" in schema and "extra" not in schema


LONG = "x" * 120


def dups(spark):
    rows = [
        (0, 5, LONG), (0, 2, LONG), (1, 0, LONG), (1, 1, LONG.upper()), (1, 2, "é" + LONG),
        (1, 3, "é" + LONG), (2, 0, "short"), (2, 1, "short"),
    ]
    return spark.createDataFrame(rows, "src int, row bigint, text string")


@pytest.mark.parametrize("parts", [1, 3, 7])
@pytest.mark.parametrize("exact", [False, True])
def test_first_occurrence_survives(spark, parts, exact):
    kept = dedup_first(dups(spark).repartition(parts), ["src", "row"], exact=exact)
    got = sorted((r.src, r.row) for r in kept.collect())
    assert got == [(0, 2), (1, 1), (1, 2), (1, 3), (2, 0)]
    again = dedup_first(kept, ["src", "row"])
    assert sorted((r.src, r.row) for r in again.collect()) == got


def test_gate_before_dedup(spark):
    kept = quality_and_unique(dups(spark), ["src", "row"])
    assert sorted((r.src, r.row) for r in kept.collect()) == [(0, 2), (1, 1), (1, 2), (1, 3)]


def test_dedup_moves_no_text_when_copies_are_few(spark):
    plan = dedup_first(dups(spark), ["src", "row"])._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan and "CartesianProduct" not in plan


def test_dedup_of_a_text_that_fills_the_table(spark):
    rows = [(0, i, LONG if i % 3 else f"{i}{LONG}") for i in range(300)] + [(1, 0, None), (1, 1, None)]
    kept = dedup_first(spark.createDataFrame(rows, "src int, row bigint, text string").repartition(5), ["src", "row"])
    got = sorted((r.src, r.row) for r in kept.collect())
    assert got == sorted([(0, 1), *((0, i) for i in range(0, 300, 3)), (1, 0)])


def test_prepare_corpus_across_sources(spark, tmp_path):
    for name, rows in {"p": ["  " + LONG, LONG, None], "q": [LONG, LONG + "y", "tiny"]}.items():
        spark.createDataFrame([(r,) for r in rows], "text string").coalesce(1).write.parquet(f"{tmp_path}/{name}")
    got = prepare_corpus(spark, [Source(f"{tmp_path}/p"), Source(f"{tmp_path}/q")]).orderBy(*CORPUS_ORDER).collect()
    assert [(r.src, r.row, r.text) for r in got] == [(0, 0, LONG), (1, 1, LONG + "y")]


def test_select_rows(spark):
    df = spark.range(10).withColumnRenamed("id", "row")
    assert sorted(r.row for r in select_rows(df, df.filter("row % 4 = 0"), ["row"]).collect()) == [0, 4, 8]


@pytest.mark.parametrize("bucket_rows", [1, 3, 1000])
def test_prefix_sums_with_gaps_and_negative_rows(spark, bucket_rows):
    rows = [(s, r, (r * 7) % 5 + 1) for s in (0, 1) for r in range(-9, 40, 3)]
    df = spark.createDataFrame(rows, "src int, row bigint, n bigint").repartition(5)
    got = {(r.src, r.row): r.start for r in with_start(df, F.col("n"), ["src", "row"], bucket_rows=bucket_rows).collect()}
    total = 0
    for s, r, n in sorted(rows):
        assert got[(s, r)] == total
        total += n
    first = slice_rows(df, 20, ["src", "row"]).collect()
    assert sorted((r.src, r.row) for r in first) == [(s, r) for s, r, _ in sorted(rows)[:20]]


def test_csv_fields_with_line_breaks_and_quotes(spark, tmp_path):
    import csv

    values = ["line one\nline two", 'said "hi" there', "plain", "a,b", ""]
    (tmp_path / "c").mkdir()
    with open(tmp_path / "c/train.csv", "w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(["id", "text"])
        writer.writerows(enumerate(values))
    assert [t or "" for t in texts(read_source(spark, f"{tmp_path}/c"))] == values
    with open(tmp_path / "c/train.csv", "w", newline="") as out:
        csv.writer(out).writerows([["id", "text"], [1, "one"], [2, 'two "2"']])
    assert texts(read_source(spark, f"{tmp_path}/c", multi_line=False)) == ["one", 'two "2"']


def test_json_arrays_and_lines(spark, tmp_path):
    import gzip
    import json

    rows = [{"text": "one\ntwo"}, {"text": 'three "3"'}]
    for name, body in {
        "array": json.dumps(rows, indent=1), "flat": json.dumps(rows), "lines": "\n".join(map(json.dumps, rows)),
    }.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "data.json").write_text(body)
    (tmp_path / "zipped").mkdir()
    with gzip.open(tmp_path / "zipped/data.jsonl.gz", "wt") as out:
        out.write("\n".join(map(json.dumps, rows)))
    for name in ("array", "flat", "lines", "zipped"):
        assert texts(read_source(spark, f"{tmp_path}/{name}")) == [r["text"] for r in rows], name
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken/data.json").write_text('{"text": "a"}\n{"text": ')
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        read_source(spark, f"{tmp_path}/broken", schema="text string").collect()


def test_formats_are_found_among_all_files(spark, tmp_path):
    (tmp_path / "many/part=1").mkdir(parents=True)
    (tmp_path / "many/_hidden.csv").write_text("x")
    for i in range(40):
        (tmp_path / f"many/part=1/f{i:02}.jsonl").write_text(f'{{"text": "t{i}"}}\n')
    assert len(texts(read_source(spark, f"{tmp_path}/many"))) == 40
    (tmp_path / "many/part=1/z.parquet").write_text("x")
    with pytest.raises(ValueError, match="mixed or unknown"):
        read_source(spark, f"{tmp_path}/many")
    (tmp_path / "odd").mkdir()
    (tmp_path / "odd/readme.xyz").write_text("x")
    with pytest.raises(ValueError, match="mixed or unknown"):
        read_source(spark, f"{tmp_path}/odd")


def test_unknown_splits_are_errors(spark, sources, tmp_path):
    with pytest.raises(ValueError, match="no split 'validation'"):
        read_source(spark, f"{sources}/three", split="validation")
    (tmp_path / "t").mkdir()
    (tmp_path / "t/test-0.jsonl").write_text('{"text": "a"}\n')
    with pytest.raises(ValueError, match="no split 'train'"):
        read_source(spark, f"{tmp_path}/t")
    assert texts(read_source(spark, f"{tmp_path}/t", split="test")) == ["a"]


def test_no_local_staging_folder_on_a_cluster():
    from types import SimpleNamespace

    from textmill.storage import shared_folder

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: default), sparkContext=context)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session)


def test_user_filter_runs_before_deduplication(spark, tmp_path):
    from textmill.operators.udf import filter_batches

    rows = [(LONG + "a",), (LONG + "b",), (LONG + "b",)]
    spark.createDataFrame(rows, "text string").coalesce(1).write.parquet(f"{tmp_path}/p")
    source = [Source(f"{tmp_path}/p")]
    keep = lambda df: filter_batches(df, lambda rows: rows["text"].str.endswith("b"), ["text"])
    got = prepare_corpus(spark, source, keep=keep, exact=True).collect()
    assert [(r.row, r.text) for r in got] == [(1, LONG + "b")]


def test_one_odd_file_among_many_numbered_ones_is_found(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for i in range(300):
        (folder / f"shard.{i:05d}.csv").write_text(f"text\nrow {i}\n")
    assert read_source(spark, str(folder)).count() == 300
    (folder / "shard.00150.jsonl").write_text('{"text": "odd"}\n')
    with pytest.raises(ValueError, match="mixed or unknown"):
        read_source(spark, str(folder))
    plain = tmp_path / "plain"
    plain.mkdir()
    (plain / "notes").write_text("no ending")
    with pytest.raises(ValueError, match="mixed or unknown"):
        read_source(spark, str(plain))


def test_names_stand_for_formats(spark):
    names = {"a/B.PARQUET": "parquet", "x.00001.csv": "csv", "x.json.gz": "json", "x.jsonl.zst": "json", "a.csv/part": None, "x.csv.bak": None, "t.txt": "text", ".csv": "csv"}
    table = spark.createDataFrame(list(names.items()), "name string, format string")
    assert {r[0]: r[1] for r in table.select("name", corpus._format_in(table.name)).collect()} == names


@pytest.mark.parametrize("fan", [2, 4, 64, 8192])
def test_prefix_sums_as_a_tree(spark, monkeypatch, fan):
    """Many files of few rows, and sparse row numbers: windows never hold more than ``fan`` sums."""
    monkeypatch.setattr(ordering, "FAN", fan)
    rows = [(f"f{i % 37:03d}", (i * 7919) % 10**9 - 10**8, i % 5) for i in range(200)]
    df = spark.createDataFrame(rows, "file string, row bigint, w int").repartition(3)
    got = {(r.file, r.row): r.start for r in with_start(df, F.col("w"), ["file", "row"], bucket_rows=4).collect()}
    at = 0
    for file, row, w in sorted(rows):
        assert got[file, row] == at
        at += w
    assert len(got) == 200


def test_a_hundred_thousand_files_of_one_row(spark):
    n = 100_000
    df = spark.range(n).select(F.format_string("part-%06d", F.col("id")).alias("file"), F.lit(0).cast("bigint").alias("row"), (F.col("id") % 3).alias("w"))
    placed = with_start(df, F.col("w"), ["file", "row"])
    wrong = placed.withColumn("i", F.substring("file", 6, 6).cast("bigint")).filter(
        F.col("start") != F.call_function("div", F.col("i"), F.lit(3)) * 3 + F.when(F.col("i") % 3 == 2, 1).otherwise(0)
    )
    assert wrong.count() == 0 and placed.count() == n
