"""Every registered query against its SQL twin, and the plans of the main ones."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from eddyline.plans import analyses, event_queries
from eddyline.plans.stream_queries import STREAM_QUERIES
from tests.oracle import check, connect

QUERIES = {**event_queries.QUERIES, **STREAM_QUERIES}
ORACLES = driver.oracle_sql()
STREAMS = [name for name in QUERIES if name.startswith("stream_")]


@pytest.fixture(scope="module")
def connection(data):
    return connect(data)


@pytest.mark.parametrize("name", [name for name in QUERIES if name not in STREAMS])
def test_query(spark, data, connection, name):
    assert check(QUERIES[name](spark, data), connection, ORACLES[name]) > 0


@pytest.mark.parametrize("name", STREAMS)
def test_stream_query(spark, data, connection, name):
    assert check(QUERIES[name](spark, data), connection, ORACLES[name]) > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLES)


def test_entry(spark):
    result = driver.entry(spark)
    assert result.columns == ["window_end", "user_id", "count", "rank"]
    assert result.count() > 0


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [name for name in QUERIES if name not in STREAMS])
def test_plans_stay_in_the_jvm_and_form_no_products(spark, data, name):
    text = plan(QUERIES[name](spark, data))
    for unwanted in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "RDDScan"):
        assert unwanted not in text


@pytest.mark.parametrize(
    "name, exchanges",
    [
        ("login_success_view", 0), ("parse_login_log", 0), ("filter_empty_key", 0),
        ("domain_traffic", 1), ("tumbling_count", 1), ("order_lifecycle", 1), ("sliding_count", 2),
        ("hot_items", 3),
    ],
)
def test_number_of_shuffles(spark, data, name, exchanges):
    text = plan(QUERIES[name](spark, data))
    assert text.count("Exchange hashpartitioning") == exchanges
    assert text.count("Exchange") == exchanges


def test_patterns_with_short_bounds_shuffle_once(spark, data):
    events = event_queries.events(spark, data)
    failed = event_queries.is_type("error")
    pairs = analyses.login_fail(events, "2 seconds", time="ts", seq=("event_id",), fail=failed)
    assert plan(pairs).count("Exchange") == 1
    orders = analyses.order_timeout_pattern(
        events, "15 minutes", ("user_id",), "ts", ("event_id",),
        event_queries.is_type("signup"), event_queries.is_type("purchase"),
    )
    assert plan(orders).count("Exchange") == 1
    assert "Or(EqualTo(event_type,signup),EqualTo(event_type,purchase))" in plan(orders)


def test_scans_read_what_is_needed(spark, data):
    text = plan(QUERIES["login_success_view"](spark, data))
    assert "EqualTo(event_type,view)" in text
    assert "ReadSchema: struct<event_type:string,props:string>" in text
    text = plan(QUERIES["order_lifecycle"](spark, data))
    assert "Or(EqualTo(event_type,signup),EqualTo(event_type,purchase))" in text
    assert "props" not in text
    text = plan(QUERIES["hot_items"](spark, data))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in text


def test_rankings_are_cut_before_the_shuffle(spark, data):
    text = plan(QUERIES["hot_items"](spark, data))
    assert "row_number(), 5, Partial" in text and "row_number(), 5, Final" in text


@pytest.mark.parametrize("name", ["order_lifecycle_strict", "login_fail", "order_timeout_pattern"])
def test_a_history_is_read_and_shuffled_once(spark, data, name):
    frame = QUERIES[name](spark, data)
    frame.collect()
    final = plan(frame).split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final
