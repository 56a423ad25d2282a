"""Connected components by alternating large and small stars."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from textmill.storage import stage_table


def _state(edges: DataFrame) -> tuple:
    return edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()[:2]


#: Edges a task joins at a time.
LOCAL_EDGES = 500_000


def _contracted(edges: DataFrame) -> DataFrame:
    """Each task joins the edges it reads, up to ``LOCAL_EDGES`` at a time, into stars: same
    components, no more edges, and far fewer rounds to come."""

    def run(batches):
        above: dict = {}

        def root(x):
            top = x
            while above.get(top, top) != top:
                top = above[top]
            while above.get(x, x) != top:
                above[x], x = top, above[x]
            return top

        def stars():
            links = [(x, root(x)) for x in list(above)]
            links = [(x, r) for x, r in links if x != r]
            above.clear()
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], kind) for i in (0, 1)], ["u", "v"])

        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                low, high = sorted((root(u), root(v)))
                above[high] = low
            if len(above) >= LOCAL_EDGES:
                yield stars()
        if above:
            yield stars()

    return edges.mapInArrow(run, edges.schema)


def _least(edges: DataFrame, least) -> DataFrame:
    return stage_table(edges.groupBy("u").agg(least.alias("m")), "components_least")


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` for every node of ``edges`` (two columns of one orderable type, never null):
    the root is the smallest node reachable.

    Each round links nodes to the smallest neighbour they see; the number of edges never grows and
    the depth falls at least by half. A round is written to the shared folder, so a lost executor
    costs one round. The minimum per node is aggregated with partial sums and staged, so in the joins
    back adaptive execution splits a node with very many neighbours (the other side has one row). What is
    left when fewer than ``LOCAL_EDGES`` edges remain is joined by one task.
    """
    pair = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    current = stage_table(_contracted(stage_table(pair, "components")).distinct(), "components")
    before, stars = _state(current), False
    while before[0] >= LOCAL_EDGES and not stars:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both, F.least(F.min("v"), F.col("u")))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage_table(large.distinct(), "components")
        least = _least(large, F.min("v"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        current = stage_table(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "components")
        after = _state(current)
        before, stars = after, after == before
    if before[0] and not stars:
        current = stage_table(_contracted(current.coalesce(1)), "components")
    roots = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
