"""Expressions over one row of logits."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _doubles(logits) -> Column:
    return (logits if isinstance(logits, Column) else F.col(logits)).cast("array<double>")


def _shifted_exp_sum(x: Column) -> Column:
    top = F.array_max(x)
    return F.aggregate(x, F.lit(0.0), lambda acc, v: acc + F.exp(v - top))


def log_sum_exp(logits) -> Column:
    x = _doubles(logits)
    return F.array_max(x) + F.log(_shifted_exp_sum(x))


def token_loss(logits, target, mode: str = "raw") -> Column:
    """``-logits[target]`` on raw scores; ``mode="log_softmax"`` gives cross entropy."""
    score = F.get(_doubles(logits), target if isinstance(target, Column) else F.col(target))
    if mode == "raw":
        return -score
    if mode == "log_softmax":
        return log_sum_exp(logits) - score
    raise ValueError(f"unknown loss mode: {mode}")


def token_entropy(logits) -> Column:
    """Entropy of softmax(logits), natural log: ``log Z - sum(e^v v) / Z`` on shifted scores."""
    x = _doubles(logits)
    top = F.array_max(x)
    zero = F.struct(F.lit(0.0).alias("z"), F.lit(0.0).alias("w"))
    return F.aggregate(
        x,
        zero,
        lambda acc, v: F.struct(
            (acc["z"] + F.exp(v - top)).alias("z"),
            (acc["w"] + F.exp(v - top) * (v - top)).alias("w"),
        ),
        lambda acc: F.log(acc["z"]) - acc["w"] / acc["z"],
    )


def candidates(logits, k: int = 5, descending: bool = False) -> Column:
    """Ids of the ``k`` lowest scores in rising order, ties by id; ``descending`` gives the highest.

    One pass over the scores with ``k`` slots: a score enters if it is lower than the worst slot, so work
    is linear in the scores and nothing of their number is sorted. NaN ranks last, null first.
    """
    x = _doubles(logits)
    if descending:
        x = F.transform(x, lambda v: -v)
    slot = "struct<score:double,id:int>"

    def entered(acc: Column, v: Column) -> Column:
        own = F.array(F.struct(v.alias("score"), acc["i"].alias("id")))
        return F.slice(F.array_sort(F.concat(acc["slots"], own)), 1, k)

    def step(acc: Column, v: Column) -> Column:
        enters = (acc["i"] < k) | v.isNull() | (v < F.get(acc["slots"], F.lit(k - 1))["score"])
        slots = F.when(enters, entered(acc, v)).otherwise(acc["slots"])
        return F.struct((acc["i"] + 1).alias("i"), slots.alias("slots"))

    start = F.struct(F.lit(0).alias("i"), F.array().cast(f"array<{slot}>").alias("slots"))
    return F.aggregate(x, start, step, lambda acc: F.transform(acc["slots"], lambda s: s["id"]))


def shade(value: Column, low: Column, high: Column) -> Column:
    """0 for the highest value of the sequence, 255 for the lowest; a flat sequence is all 255."""
    span = F.when(high > low, high - low).otherwise(F.lit(1.0))
    return F.floor((F.lit(1.0) - (value - low) / span) * F.lit(255)).cast("int")


def token_text(text, start, end) -> Column:
    """Surface form of a token from its character offsets ``[start, end)``."""
    text, start, end = (c if isinstance(c, Column) else F.col(c) for c in (text, start, end))
    return F.substring(text, start + F.lit(1), end - start)
