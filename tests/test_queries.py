"""Every registered query against its SQL, on the smallest data set."""

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import normal

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in SF.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = queries()[name](spark, str(SF))
    rows = df.collect()
    result = duck.execute(oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert normal(rows, df.columns) == normal(result.fetchall(), names)


def test_entry(spark):
    packed = entry(spark)
    assert packed.columns == ["chunk", "input_ids"]
    assert packed.count() == 455
