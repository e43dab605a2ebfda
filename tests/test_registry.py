"""Every registered query against its DuckDB oracle on the driver data (sf0.01),
plus the entry smoke check on sf0.001."""

import os
import sys

import duckdb
import pytest

import __spark_entry__ as E
from vitalis.plans.registry import NO_SQL, QUERIES

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from oracle_check import TABLES, frame_hash  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["sensor_type", "count", "avg_value", "min_value", "max_value"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) | NO_SQL


@pytest.mark.oracle
@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(E.oracle_sql())))
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF).toPandas()
    want = duck.execute(E.oracle_sql()[name]).df()
    a, b = frame_hash(got), frame_hash(want)
    assert a[0] == b[0], f"row count {a[0]} != {b[0]}"
    assert a[1] == b[1], f"columns {a[1]} != {b[1]}"
    assert a[2] == b[2], "values differ"
