"""User functions with a declared result schema, run on Arrow batches."""

from __future__ import annotations

import functools
import inspect
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T


def _struct(schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def map_rows(
    df: DataFrame, fn: Callable[[dict], dict], schema: str | T.StructType, columns: list[str] | None = None
) -> DataFrame:
    """Row map: the columns of ``schema`` are added to the row or replace those of the same name.

    ``fn`` gets the row (of ``columns``, all by default) as a dict and returns a dict with the
    declared columns. Only ``columns`` go to Python; name them to keep wide columns out.
    """
    added = _struct(schema)
    call = F.udf(lambda row: fn(row.asDict()), added, useArrow=True)
    kept = [c for c in df.columns if c not in added.names]
    return df.withColumn("_new", call(F.struct(*(columns or df.columns)))).select(*kept, "_new.*")


def map_batches(
    df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str | T.StructType
) -> DataFrame:
    """Batch map that replaces all columns; a batch may return any number of rows."""

    def run(batches):
        for batch in batches:
            yield fn(batch)

    return df.mapInPandas(run, _struct(schema))


_SHARED = "rows run in many tasks, so state is not shared. For first-occurrence filters use dedup_first."


def _check_stateless(fn: Callable, read_only: bool) -> None:
    """Refuse predicates that could collect rows: bound methods and callable objects, mutable
    defaults, and captured mutable objects unless they are declared ``read_only``."""
    while isinstance(fn, functools.partial):
        if not read_only and any(isinstance(v, _MUTABLE) for v in (*fn.args, *fn.keywords.values())):
            raise ValueError(f"the predicate is given a mutable object; {_SHARED}")
        fn = fn.func
    if inspect.isbuiltin(fn):
        return
    if not inspect.isfunction(fn):
        raise ValueError(f"the predicate is a bound method or an object with state; {_SHARED}")
    defaults = (*(fn.__defaults__ or ()), *(fn.__kwdefaults__ or {}).values())
    if any(isinstance(v, _MUTABLE) for v in defaults):
        raise ValueError(f"the predicate has a mutable default; {_SHARED}")
    seen = inspect.getclosurevars(fn)
    for name, value in {**seen.nonlocals, **seen.globals}.items():
        if isinstance(value, _MUTABLE) and not read_only:
            raise ValueError(f"the predicate uses the mutable object {name!r}; {_SHARED}")


_MUTABLE = (set, dict, list, bytearray)


def filter_rows(
    df: DataFrame, fn: Callable[[dict], bool], columns: list[str] | None = None, read_only: bool = False
) -> DataFrame:
    """Keep rows for which ``fn(row)`` is true; ``fn`` sees ``columns`` (all by default).

    Predicates that carry state are refused. ``read_only=True`` declares that captured sets, lists
    and dicts are only looked up; a ``frozenset`` or tuple needs no declaration.
    """
    _check_stateless(fn, read_only)
    keep = F.udf(lambda row: bool(fn(row.asDict())), T.BooleanType(), useArrow=True)
    return df.filter(keep(F.struct(*(columns or df.columns))))


def filter_batches(
    df: DataFrame, fn: Callable[[pd.DataFrame], pd.Series], columns: list[str] | None = None, read_only: bool = False
) -> DataFrame:
    """Keep rows for which ``fn(batch)`` is true; ``fn`` gets ``columns`` as pandas columns and
    returns one truth value per row. The other columns stay in the JVM."""
    _check_stateless(fn, read_only)

    @F.pandas_udf("boolean")
    def keep(batch: pd.DataFrame) -> pd.Series:
        return pd.Series(fn(batch)).astype(bool)

    return df.filter(keep(F.struct(*(columns or df.columns))))
