import random

import pytest
from pyspark.sql import functions as F

from textmill.functions.tokens import append_eos, lm_labels
from textmill.operators import batches, stats
from textmill.operators.filters import min_tokens
from textmill.operators.pack import pack_plan, pack_wrapped
from textmill.operators.tokenize import ByteTokenizer, tokenize

SCHEMA = "row bigint, input_ids array<int>"


def table(spark, lengths, parts=3):
    ids, rows = iter(range(10**6)), []
    for row, n in enumerate(lengths):
        rows.append((row, [next(ids) for _ in range(n)]))
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


@pytest.mark.parametrize("lengths", [[1, 7, 8, 9, 26, 0], [8, 8, 8], [3], [], [5, 3, 40, 0, 0, 1], [1] * 30])
@pytest.mark.parametrize("bucket_rows", [1, 2, 128])
def test_chunks_are_the_concatenation(spark, lengths, bucket_rows):
    size, total = 8, sum(lengths)
    df = table(spark, lengths)
    got = pack_wrapped(df, size, ["row"], bucket_rows=bucket_rows).orderBy("chunk").collect()
    assert [r.chunk for r in got] == list(range(total // size))
    assert [i for r in got for i in r.input_ids] == list(range(total // size * size))
    kept = pack_wrapped(df, size, ["row"], keep_tail=True, bucket_rows=bucket_rows).orderBy("chunk").collect()
    assert [i for r in kept for i in r.input_ids] == list(range(total))
    assert all(len(r.input_ids) == size for r in kept[:-1])


def test_random_tables_do_not_depend_on_partitioning(spark):
    rng = random.Random(5)
    lengths = [rng.choice([0, 1, 2, 5, 17, 64]) for _ in range(300)]
    for parts in (1, 5):
        got = pack_wrapped(table(spark, lengths, parts), 16, ["row"], bucket_rows=7).orderBy("chunk").collect()
        assert [i for r in got for i in r.input_ids] == list(range(sum(lengths) // 16 * 16))


def test_columns_are_cut_alike_and_plan_agrees(spark):
    df = table(spark, [5, 20, 3]).withColumn("mask", F.transform("input_ids", lambda x: x * 2))
    for r in pack_wrapped(df, 8, ["row"], keep_tail=True, columns=("input_ids", "mask")).collect():
        assert r["mask"] == [2 * i for i in r.input_ids]
    plan = pack_plan(df, 8, ["row"]).orderBy("chunk", "chunk_from").collect()
    assert [(r.row, r.chunk, r.row_from, r.chunk_from, r.n_tokens) for r in plan] == [
        (0, 0, 0, 0, 5), (1, 0, 0, 5, 3), (1, 1, 3, 0, 8), (1, 2, 11, 0, 8), (1, 3, 19, 0, 1), (2, 3, 0, 1, 3),
    ]


def test_chunks_inside_a_bucket_are_not_shuffled_again(spark):
    plan = pack_wrapped(table(spark, [5, 20, 3]), 8, ["row"])._jdf.queryExecution().executedPlan().toString()
    first_branch = plan.split("ObjectHashAggregate(keys=[chunk")[0]
    assert "Exchange hashpartitioning(chunk" not in first_branch
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan


def test_end_token_and_token_gate(spark):
    docs = spark.createDataFrame([(0, "x" * 148), (1, "x" * 149)], "row bigint, text string")
    assert [r.row for r in min_tokens(tokenize(docs, ByteTokenizer(), ["row"])).collect()] == [1]
    assert [r.row for r in min_tokens(tokenize(docs, ByteTokenizer(eos=None), ["row"])).collect()] == []
    row = tokenize(docs, ByteTokenizer(), ["row"], masks=True, with_token_types=True).first()
    assert len(row.attention_mask) == len(row.token_type_ids) == len(row.input_ids) == 149
    assert set(row.attention_mask) == {1} and set(row.token_type_ids) == {0}
    assert docs.select(append_eos(F.array(F.lit(1)), None)).first()[0] == [1]


def test_empty_statistics(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert stats.tail_stats(empty, 8).first().asDict() == {"tokens": 0, "full_chunks": 0, "tail_tokens": 0}
    assert stats.filter_token_stats(empty, 8).first().tokens_dropped == 0
    assert stats.packed_stats(empty).first().packed_rows == 0


def test_length_audit_and_observation(spark):
    packed = table(spark, [8, 7, 8, 9]).withColumnRenamed("row", "chunk")
    audit = stats.length_audit(packed, 8).first()
    assert (audit.n_rows, audit.wrong_rows, audit.first_wrong, audit.last_wrong, audit.all_correct) == (4, 2, 1, 3, False)
    assert sorted(tuple(r) for r in stats.wrong_lengths(packed, 8).collect()) == [(1, 7), (3, 9)]
    assert stats.length_audit(packed.filter("chunk % 2 = 0"), 8).first().all_correct
    watched, seen = stats.observe_rows(packed, "final")
    watched.collect()
    assert seen.get["n_rows"] == 4


def packed_rows(spark, n):
    return spark.range(n).select(F.col("id").alias("chunk"), F.array(F.col("id").cast("int")).alias("input_ids"))


@pytest.mark.parametrize("n, test_rows", [(1, 1), (999, 1), (1000, 1), (1001, 2)])
def test_split_sizes(spark, n, test_rows):
    rows = packed_rows(spark, n)
    split = {r.split: r["count"] for r in batches.train_test_split(rows).groupBy("split").count().collect()}
    assert split.get("test", 0) == test_rows and split.get("train", 0) == n - test_rows
    sizes = batches.split_sizes(rows).first()
    assert (sizes.test_rows, sizes.train_rows) == (test_rows, n - test_rows)


def md5_order(seed, chunks):
    import hashlib

    return sorted(chunks, key=lambda c: (hashlib.md5(f"{seed}-{c}".encode()).hexdigest(), c))


def test_split_takes_the_first_rows_in_shuffle_order(spark):
    split = batches.train_test_split(packed_rows(spark, 300), 0.1, seed=3)
    assert {r.chunk for r in split.filter("split = 'test'").collect()} == set(md5_order(3, range(300))[:30])


def test_labels(spark):
    df = spark.createDataFrame([([9, 1, 9, 2, 9],), ([1, 2],)], "ids array<int>")
    assert [r[0] for r in df.select(lm_labels("ids", 9)).collect()] == [[-100, 1, -100, 2, -100], [1, 2]]


def test_batches_steps_and_flattening(spark):
    rows = table(spark, [3, 1, 2, 2, 1, 4, 0, 2, 1, 1]).withColumnRenamed("row", "chunk")
    grouped = batches.micro_batches(rows, 4, seed=1)
    got = {(r.batch, r.slot): r for r in grouped.collect()}
    order = md5_order(1, range(10))
    assert {k: r.chunk for k, r in got.items()} == {(i // 4, i % 4): c for i, c in enumerate(order[:8])}
    for flat in batches.flatten_batches(grouped).collect():
        members = [got[(flat.batch, s)].input_ids for s in range(4)]
        assert flat.input_ids == [t for m in members for t in m]
        assert flat.labels == [t for m in members for t in ([-100] + m[1:] if m else [])]
        assert flat.position_ids == [p for m in members for p in range(len(m))]
        assert flat.seq_idx == [s for s, m in enumerate(members) for _ in m]
        assert flat.cu_seq_lens == [sum(map(len, members[:k])) for k in range(5)]
        assert flat.max_length == max(map(len, members))
    steps = batches.assign_steps(rows.select("chunk"), 4, accum=2, epochs=2).collect()
    assert len(steps) == 16 and {r.step for r in steps} == {0, 1}
    assert sorted((r.epoch, r.batch, r.slot) for r in steps) == [(e, b, s) for e in (0, 1) for b in (0, 1) for s in range(4)]
    assert all(r.step == r.epoch and r.micro == r.batch for r in steps)
    assert {(r.batch, r.slot, r.chunk) for r in steps if r.epoch == 0} != {(r.batch, r.slot, r.chunk) for r in steps if r.epoch == 1}


def test_batches_sort_no_token_arrays(spark):
    rows = table(spark, [3, 1, 2]).withColumnRenamed("row", "chunk")
    for df in (batches.micro_batches(rows, 2), batches.assign_steps(rows, 1, epochs=2)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
        # the branch of the rows has nothing but its exchange and the scan
        wide = [line for line in plan.splitlines() if "Window" in line or "Sort [" in line]
        assert wide and not any("input_ids" in line for line in wide)
    got = {(r.epoch, r.batch, r.slot): (r.chunk, r.input_ids) for r in batches.assign_steps(rows, 1, epochs=2).collect()}
    assert len(got) == 6 and sorted(got.values()) == sorted([(r.chunk, r.input_ids) for r in rows.collect()] * 2)


def test_a_very_long_row_is_cut_without_repeating_it(spark):
    n, length = 2_000_000, 1000
    rows = spark.range(1).select(F.lit(0).cast("bigint").alias("row"), F.sequence(F.lit(1), F.lit(n)).alias("input_ids"))
    packed = pack_wrapped(rows, length, ["row"])
    found = packed.agg(F.count(F.lit(1)), F.sum(F.aggregate("input_ids", F.lit(0).cast("bigint"), lambda a, x: a + x))).first()
    assert tuple(found) == (n // length, n * (n + 1) // 2)


def test_report_counts_the_rows_of_the_users_cleaner(spark, tmp_path):
    from textmill.operators.tokenize import ByteTokenizer
    from textmill.plans.jobs import preprocess
    from textmill.sources.corpus import Source

    rows = [(f"{i} " + "x" * 200,) for i in range(20)]
    spark.createDataFrame(rows, "text string").coalesce(1).write.parquet(f"{tmp_path}/p")
    clean = lambda df: df.filter(F.col("row") < 11)
    _, report = preprocess(spark, [Source(f"{tmp_path}/p")], ByteTokenizer(), 64, f"{tmp_path}/out", clean=clean)
    counts = {r["stage"]: r["value"] for r in report.filter("metric = 'n_rows'").collect()}
    assert (counts["combined"], counts["cleaned"], counts["final"]) == (20, 11, 11)
    import glob

    from textmill.storage import shared_folder

    folder = shared_folder(spark).removeprefix("file:")
    assert not glob.glob(f"{folder}/tokens-*/*.parquet")
