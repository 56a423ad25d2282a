"""Mixing sources to target token counts by entropy balancing.

Each source has a target number of words. Among all document rates between 0 and ``cap`` the ones
closest to 1 (in relative entropy) that meet the target are tilted exponentially in the document
size: ``rate = cap * e**t / (cap - 1 + e**t)`` with ``t = lambda * size / mean size``. One lambda per
source solves the convex dual; distributed Newton steps find it from sums per source. Rates are then
rounded into whole copies, largest sizes first, carrying the rest on to smaller documents.

Documents of one source and size share a rate, so the steps read counts per (source, size), never
documents. Which documents of such a group get the extra copy follows a hash of the id: reruns agree.

A null text has size 0, an empty one too; such documents are taken once (0 words). A null source is a
source of its own, the last. Rows that repeat count each; those with equal ids get equal copies. An
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from textmill.storage import stage_table

WORD = r"[^\x20\x09-\x0D]+"

#: Newton steps at most, and the relative error at which a source is done.
STEPS, PRECISION = 60, 1e-5

#: Rows ranked by one task when a group shares out its extra copies.
RANKED_ROWS = 50_000


def words(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_key(source: str) -> Column:
    """Never null; sorts by code point with null last."""
    return F.coalesce(F.concat(F.lit("0"), F.col(source).cast("string")), F.lit("1"))


def source_targets(sizes: DataFrame, weights=(5, 2, 1), cap: int = 3) -> DataFrame:
    """``key, source_size, target`` from ``key, size, n``: one row per source.

    Weights repeat in key order. Targets share all words by weight; none exceeds ``cap`` times its
    source, what is cut off is shared again by weight. Sources sorted by the ratio at which they
    reach the cap make the capped ones a prefix, so sums before and after each source decide.
    The windows see one row per source.
    """
    totals = sizes.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).cast("bigint").alias("source_size"))
    place = F.row_number().over(Window.orderBy("key")) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    ranked = totals.withColumn("weight", weight).withColumn("ratio", cap * F.col("source_size") / F.col("weight"))
    by_ratio = Window.orderBy("ratio", "key")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    left = F.sum("source_size").over(everything) - F.coalesce(cap * F.sum("source_size").over(before), F.lit(0))
    level = left / F.sum("weight").over(onward)
    # the first source whose level does not reach its ratio sets the level of all that follow
    ranked = ranked.withColumn("level", F.when(level <= F.col("ratio"), level))
    ranked = ranked.withColumn("level", F.max_by("level", F.when(F.col("level").isNotNull(), -F.col("ratio"))).over(everything))
    target = F.least(cap * F.col("source_size").cast("double"), F.coalesce(F.col("level") * F.col("weight"), F.lit(float("inf"))))
    return ranked.select("key", "source_size", target.cast("double").alias("target"))


def tilted(tilt: Column, cap: int) -> Column:
    grown = F.exp(F.least(F.greatest(tilt, F.lit(-700.0)), F.lit(700.0)))
    return cap * grown / (cap - 1 + grown)


def balance(sizes: DataFrame, targets: DataFrame, cap: int = 3) -> DataFrame:
    """``key, mean, lam``: the multiplier of each source. Sources at their cap get +infinity."""
    means = sizes.groupBy("key").agg(
        F.greatest(F.sum(F.col("size") * F.col("n")) / F.sum("n"), F.lit(1e-9)).alias("mean")
    )
    full = F.col("target") >= cap * F.col("source_size")
    state = targets.join(means, "key").select(
        "key", "mean", "target",
        F.when(full, F.lit(float("inf"))).otherwise(0.0).alias("lam"),
        F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high"),
        full.alias("done"),
    )
    state = stage_table(state, "balance")
    for _ in range(STEPS):
        if not state.filter("not done").head(1):
            break
        z = F.col("size") / F.col("mean")
        rate = tilted(F.col("lam") * z, cap)
        mass = F.col("n") * F.col("size") * rate
        kept = ["key", "mean", "target", "lam", "low", "high"]
        sums = (
            sizes.join(state.filter("not done"), "key")
            .groupBy(*kept)
            .agg(F.sum(mass).alias("now"), F.sum(mass * z * (1 - rate / cap)).alias("slope"))
        )
        gap = F.col("now") - F.col("target")
        low = F.when(gap < 0, F.col("lam")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("lam")).otherwise(F.col("high"))
        newton = F.col("lam") - gap / F.greatest("slope", F.lit(1e-300))
        # a step that leaves the bracket is replaced by its middle, or by one step outward
        middle = (
            F.when(F.col("low_") == float("-inf"), 2 * F.col("lam") - 1)
            .when(F.col("high_") == float("inf"), 2 * F.col("lam") + 1)
            .otherwise((F.col("low_") + F.col("high_")) / 2)
        )
        bounded = (F.col("new") > F.col("low_")) & (F.col("new") < F.col("high_")) & (F.abs(F.col("new") - F.col("lam")) <= 4 + 2 * F.abs("lam"))
        close = F.abs(F.col("now") - F.col("target")) <= PRECISION * F.col("target")
        stepped = sums.withColumns({"low_": low, "high_": high, "new": newton}).select(
            "key", "mean", "target",
            F.when(close, F.col("lam")).when(bounded, F.col("new")).otherwise(middle).alias("lam"),
            F.col("low_").alias("low"), F.col("high_").alias("high"),
            (close | (F.col("high_") - F.col("low_") < 1e-15)).alias("done"),
        )
        state = stage_table(stepped.unionByName(state.filter("done")), "balance")
    return state.select("key", "mean", "lam")


def round_copies(group: pd.DataFrame, cap: int) -> pd.DataFrame:
    """Copies per size of one source, its ``size, n, rate`` rows in any order.

    Every size gets a whole number of copies for all its documents; the words missing or in excess
    are carried to the next smaller size, so the source ends within half of its smallest size that
    still has room."""
    group = group.sort_values("size", ascending=False, kind="stable")
    carry, copies = 0.0, []
    for size, n, rate in zip(group["size"], group["n"], group["rate"]):
        if size == 0:
            copies.append(n)
            continue
        wanted = rate * size * n + carry
        given = min(max(int(np.floor(wanted / size + 0.5)), 0), cap * int(n))
        copies.append(given)
        carry = wanted - given * size
    return group[["key", "size", "n"]].assign(copies=np.array(copies, np.int64))


def mix(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights=(5, 2, 1), cap: int = 3
) -> DataFrame:
    """All columns of ``documents`` with ``_size, _source_size, _target, _copies`` added.

    The row of a document with ``c`` copies stands once; repeat it ``c`` times to build the mix.
    Columns of the input with the added names are replaced.
    """
    u = F.xxhash64(F.col(doc_id).cast("string"), F.lit(20))
    documents = documents.drop("_size", "_source_size", "_target", "_copies")
    keyed = documents.withColumns({"_mix_key": source_key(source), "_size": words(text), "_mix_u": u})
    narrow = stage_table(keyed.select(F.col("_mix_key").alias("key"), F.col("_size").alias("size"), F.col("_mix_u").alias("u")), "sizes")
    sizes = stage_table(narrow.groupBy("key", "size").agg(F.count(F.lit(1)).alias("n")), "size_counts")
    targets = stage_table(source_targets(sizes, weights, cap), "targets")
    lambdas = balance(sizes, targets, cap)
    tilt = F.when(F.col("size") == 0, 0.0).otherwise(F.col("lam") * F.col("size") / F.col("mean"))
    rated = sizes.join(lambdas, "key").withColumn("rate", tilted(tilt, cap))
    copies = rated.groupBy("key").applyInPandas(
        lambda g: round_copies(g, cap), "key string, size bigint, n bigint, copies bigint"
    )
    groups = stage_table(
        copies.select("key", "size", "n", F.call_function("div", F.col("copies"), F.col("n")).alias("each"), (F.col("copies") % F.col("n")).alias("extra")),
        "copies",
    )
    last = stage_table(_last_extra(narrow, groups), "extra")
    plan = groups.join(last, ["key", "size"], "left").join(targets, "key")
    plan = plan.select(
        F.col("key").alias("_mix_key"), F.col("size").alias("_size"), F.col("each").alias("_mix_each"), F.col("last").alias("_mix_last"),
        F.col("source_size").alias("_source_size"), F.col("target").alias("_target"),
    )
    given = F.col("_mix_each") + F.coalesce((F.col("_mix_u") <= F.col("_mix_last")).cast("bigint"), F.lit(0))
    return keyed.join(plan, ["_mix_key", "_size"]).withColumn("_copies", given.cast("bigint")).select(
        *documents.columns, "_size", "_source_size", "_target", "_copies"
    )


def _last_extra(narrow: DataFrame, groups: DataFrame) -> DataFrame:
    """``key, size, last``: the hash up to which documents of a group get an extra copy.

    A large group is ranked in slices of the hash, so no task ranks all its rows.
    """
    slices = F.ceil(F.col("n") / RANKED_ROWS)
    slice_ = F.floor((F.col("u") / 2.0**64 + 0.5) * slices)
    rows = narrow.join(groups.filter("extra > 0"), ["key", "size"]).withColumn("slice", slice_)
    counts = rows.groupBy("key", "size", "slice", "extra").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("key", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    wanted = counts.filter((F.col("before") < F.col("extra")) & (F.col("before") + F.col("rows") >= F.col("extra")))
    inside = rows.select("key", "size", "slice", "u").join(wanted, ["key", "size", "slice"])
    rank = F.row_number().over(Window.partitionBy("key", "size", "slice").orderBy("u"))
    return inside.withColumn("rank", F.col("before") + rank).filter("rank = extra").select(
        "key", "size", F.col("u").alias("last")
    )
