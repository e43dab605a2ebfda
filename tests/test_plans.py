"""Physical-plan checks: pushdown, pruning, broadcast only of bounded sides,
no single-partition exchange under trailing windows, top-k without a sort."""

import contextlib
import io

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.01"


def _plan(spark, name):
    df = E.queries()[name](spark, SF)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_sensor_filter_reaches_scan(spark):
    p = _plan(spark, "pulse_stats")
    assert "EqualTo(event_type,click)" in p
    assert "ReadSchema: struct<event_type:string,value:double>" in p


def test_sql_on_parquet_pushdown_and_pruning(spark):
    p = _plan(spark, "sql_on_parquet")
    assert "GreaterThan(value,0.0)" in p
    assert "ReadSchema: struct<event_type:string,value:double>" in p


def test_time_bound_reaches_scan(spark):
    for name in ("window_rows", "retention_24h"):
        p = _plan(spark, name)
        assert "GreaterThan" in p and "(ts," in p, name


def test_range_table_is_broadcast(spark):
    p = _plan(spark, "range_lookup")
    assert "BroadcastHashJoin" in p and "BroadcastExchange" in p


@pytest.mark.parametrize("name", ["global_trailing", "trailing"])
def test_trailing_windows_never_single_partition(spark, name):
    p = _plan(spark, name)
    assert "SinglePartition" not in p
    assert "hashpartitioning(" in p and "_part" in p


def test_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in _plan(spark, "recent_20")


def test_aggregates_are_partial_before_shuffle(spark):
    p = _plan(spark, "sensor_stats")
    assert "partial_count" in p or "partial_sum" in p
