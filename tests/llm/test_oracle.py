"""Queries of the subpackage against their DuckDB SQL on the driver data."""

import duckdb
import pytest

from tests.test_registry import SF, frame_hash
from vitalis.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.oracle
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, name):
    assert frame_hash(QUERIES[name](spark, SF).toPandas()) == frame_hash(duck.execute(ORACLE[name]).df())
