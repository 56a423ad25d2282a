import csv
import random

import pytest
from pyspark.sql import functions as F

from textmill.sources import corpus
from textmill.sources.corpus import ROW_ORDER, read_source


def in_order(df):
    return [r.text for r in df.orderBy(*ROW_ORDER).collect()]


@pytest.fixture
def small_parts(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "149")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def random_text(rng):
    pieces = ["a", "bc ", '"', '""', "\n", "\n\n", ",", "é", " ", "x" * rng.randint(0, 90), '",', ',"', '"\n', "\n,"]
    return "".join(rng.choice(pieces) for _ in range(rng.randint(0, 9)))


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", range(2))
def test_parts_of_files_give_the_records_of_whole_files(spark, tmp_path, small_parts, seed, ending):
    rng = random.Random(seed)
    want = []
    for name, n in [("a", 25), ("b", 0), ("c", 4)]:
        rows = [[i, random_text(rng), random_text(rng)] for i in range(n)]
        with open(tmp_path / f"{name}.csv", "w", newline="") as out:
            writer = csv.writer(out, lineterminator=ending)
            writer.writerow(["id", "text", 'odd "name",\nof a column'])
            for row in rows:
                writer.writerow(row)
                if rng.random() < 0.2:
                    out.write(ending)
        want += [r[1] for r in rows]
    parts = read_source(spark, str(tmp_path))
    assert [t or "" for t in in_order(parts)] == want
    if ending == "\n":  # the reader of whole files takes an empty line that ends in CR LF for a record
        assert in_order(parts) == in_order(read_source(spark, str(tmp_path), multi_line=True))
    blocks = parts.select("file", "block").distinct().groupBy("file").count()
    assert blocks.agg(F.max("count")).first()[0] > 5


def test_quotes_inside_plain_fields_open_nothing(spark, tmp_path, small_parts):
    body = 'id,text\n1,5" wide\n2,"a ""b""\nc" \n3,x"y"z\n"4","""\n"""\n5,\n6,""\n'
    (tmp_path / "t.csv").write_text(body)
    assert in_order(read_source(spark, str(tmp_path))) == in_order(read_source(spark, str(tmp_path), multi_line=True))
    assert in_order(read_source(spark, str(tmp_path)))[3] == '"\n"'


def test_long_lines_and_long_records(spark, tmp_path):
    long_line, long_record = '"' * 200_000 + "," * 200_000, "line\n" * 50_000
    with open(tmp_path / "t.csv", "w", newline="") as out:
        csv.writer(out).writerows([["text"], [long_line], [long_record], ["end"]])
    assert in_order(read_source(spark, str(tmp_path))) == [long_line, long_record, "end"]


def test_records_that_do_not_fit_are_errors(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,text\n1,a\n2,b,c,d\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        read_source(spark, str(tmp_path)).collect()


def test_split_columns_and_partitions(spark, tmp_path):
    rows = [("a\nb", "train", 1), ("c", "test", 1), ('d"e', "train", 2)]
    frame = spark.createDataFrame(rows, "text string, split string, part int").coalesce(1)
    frame.write.partitionBy("part").option("header", True).option("escape", '"').csv(f"{tmp_path}/s")
    assert in_order(read_source(spark, f"{tmp_path}/s", "train")) == ["a\nb", 'd"e']
    assert in_order(read_source(spark, f"{tmp_path}/s", "train[:1]")) == ["a\nb"]
    frame.write.partitionBy("split").option("header", True).option("escape", '"').csv(f"{tmp_path}/p")
    assert in_order(read_source(spark, f"{tmp_path}/p", "test")) == ["c"]
    assert in_order(read_source(spark, f"{tmp_path}/p", "train[:1]")) == ["a\nb"]


@pytest.mark.parametrize("fmt", ["csv", "jsonl", "txt", "orc"])
def test_slices_open_few_files(spark, tmp_path, monkeypatch, fmt):
    """Empty files in between, more rows than one file has, and all of the source."""
    counts = [2, 0, 0, 3, 1] + [4] * 7
    want = []
    for i, n in enumerate(counts):
        texts = [f"row {i} {j}" for j in range(n)]
        want += texts
        path = tmp_path / f"f {i:03d}.{fmt}"
        if fmt == "csv":
            path.write_text("\n".join(["text", *texts]) + "\n")
        elif fmt == "jsonl":
            path.write_text("".join(f'{{"text": "{t}"}}\n' for t in texts))
        elif fmt == "txt":
            path.write_text("".join(t + "\n" for t in texts))
        else:
            import pyarrow as pa
            from pyarrow import orc

            orc.write_table(pa.table({"text": pa.array(texts, pa.string())}), str(path))
    opened = []
    first_files = corpus._first_files
    monkeypatch.setattr(corpus, "_first_files", lambda *a: opened.append(first_files(*a)) or opened[-1])
    for n, files in [(2, 1), (6, 8), (1000, None)]:
        assert in_order(read_source(spark, str(tmp_path), f"train[:{n}]", schema="text string")) == want[:n]
        # empty files of some formats are not even listed
        assert opened[-1] is None if files is None else len(opened[-1]) <= files
