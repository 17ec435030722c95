"""Patterns, lifecycle and reconciliation, on bounded input."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from eddyline.functions.time import to_micros
from eddyline.operators.lifecycle import MESSAGES, lifecycle_strict, lifecycle_summary
from eddyline.operators.patterns import followed_by, strict_next
from eddyline.operators.reconcile import match
from eddyline.operators.slices import slice_micros
from eddyline.plans import analyses
from eddyline.sources.lines import read_lines
from eddyline.sources.parsers import accepted, parse_login, parse_order
from tests.helpers import (
    collected,
    event_table,
    model_followed_by,
    model_lifecycle,
    model_match,
    model_strict_next,
    random_events,
    seconds,
)

# Slices from far narrower than the bounds to wider than the data.
WIDTHS = [None, "1 second", "7 seconds", "30 seconds", "1 hour"]


def kind(name):
    return F.col("kind") == name


def strictly(events, within, width=None):
    found = strict_next(events, ["key"], "ts", kind("f"), kind("f"), within, ["seq"], ["seq"], width)
    return collected(found, "key", "first.seq", "second.seq")


def relaxed(events, within, width=None):
    found = followed_by(events, ["key"], "ts", kind("create"), kind("pay"), within, ["seq"], ["seq"], width)
    return collected(found, "key", "tag", "first.seq", "second.seq")


def outcomes(events, within, width=None):
    found = lifecycle_strict(events, ["key"], "ts", kind("create"), kind("pay"), within, ["seq"], width)
    return collected(found, "key", "tag", seconds("emitted_at"))


def matches(events, within, width=None):
    found = match(
        events.filter(kind("L")), events.filter(kind("R")), ["key"], "ts", within, ["seq"], ["seq"],
        ["seq"], width, keep_replaced=True,
    )
    return collected(found, "key", "tag", "left.seq", "right.seq")


def test_strict_next_by_hand(spark):
    events = event_table(spark, [
        ("broken", 0.0, 0, "f"), ("broken", 0.0, 1, "s"), ("broken", 1.0, 2, "f"),
        ("chain", 0.0, 0, "f"), ("chain", 1.0, 1, "f"), ("chain", 2.0, 2, "f"),
        ("equal", 5.0, 1, "f"), ("equal", 5.0, 0, "f"),
        ("long", 0.0, 0, "f"), ("long", 2.0, 1, "f"),
    ])
    assert strictly(events, "2 seconds") == {
        ("chain", 0, 1): 1, ("chain", 1, 2): 1, ("equal", 0, 1): 1,
    }


def test_followed_by_by_hand(spark):
    events = event_table(spark, [
        ("two", 0.0, 0, "create"), ("two", 1.0, 1, "create"), ("two", 2.0, 2, "x"), ("two", 3.0, 3, "pay"),
        ("edge", 0.0, 0, "create"), ("edge", 900.0, 1, "pay"),
        ("early", 0.0, 0, "pay"), ("early", 1.0, 1, "create"),
    ])
    assert relaxed(events, "15 minutes") == {
        ("two", "matched", 0, 3): 1, ("two", "matched", 1, 3): 1,
        ("edge", "timeout", 0, None): 1, ("early", "timeout", 1, None): 1,
    }


def test_lifecycle_by_hand(spark):
    events = event_table(spark, [
        ("edge", 0.0, 0, "create"), ("edge", 900.0, 1, "pay"),
        ("good", 0.0, 0, "create"), ("good", 5.0, 1, "other"), ("good", 899.0, 2, "pay"),
        ("late", 0.0, 0, "create"), ("late", 901.0, 1, "pay"),
        ("twice", 0.0, 0, "pay"), ("twice", 0.0, 1, "pay"),
        ("swap", 0.0, 0, "pay"), ("swap", 0.0, 1, "create"),
        ("again", 0.0, 0, "create"), ("again", 600.0, 1, "create"), ("again", 1000.0, 2, "pay"),
    ])
    assert outcomes(events, "15 minutes") == {
        ("edge", "late", 900.0): 1, ("good", "payed", 899.0): 1,
        ("late", "timeout", 900.0): 1, ("late", "orphan", 901.0): 1,
        ("twice", "late", 0.0): 1, ("swap", "payed", 0.0): 1, ("again", "payed", 1000.0): 1,
    }
    summary = lifecycle_summary(events, ["key"], "ts", kind("create"), kind("pay"), "15 minutes")
    assert collected(summary, "key", "tag") == {
        ("edge", "late"): 1, ("good", "payed"): 1, ("late", "late"): 1, ("twice", "orphan"): 1,
        ("swap", "payed"): 1, ("again", "late"): 1,
    }
    assert {row.result_msg for row in summary.collect()} <= set(MESSAGES.values())


def test_match_by_hand(spark):
    events = event_table(spark, [
        ("edge", 0.0, 0, "L"), ("edge", 5.0, 1, "R"),
        ("far", 0.0, 0, "L"), ("far", 5.001, 1, "R"),
        ("first", 3.0, 0, "R"), ("first", 1.0, 1, "L"),
        ("two", 0.0, 0, "L"), ("two", 1.0, 1, "L"), ("two", 2.0, 2, "R"), ("two", 3.0, 3, "R"),
    ])
    assert matches(events, "5 seconds") == {
        ("edge", "matched", 0, 1): 1,
        ("far", "unmatchedPays", 0, None): 1, ("far", "unmatchedReceipts", None, 1): 1,
        ("first", "matched", 1, 0): 1,
        ("two", "replaced", 0, None): 1, ("two", "matched", 1, 2): 1,
        ("two", "unmatchedReceipts", None, 3): 1,
    }


@pytest.mark.parametrize("width", WIDTHS)
def test_patterns_against_the_model(spark, width):
    rows = random_events(2, ["f", "f", "s"], span=3000)
    assert strictly(event_table(spark, rows), "8 seconds", width) == model_strict_next(rows, "f", "f", 8)
    rows = random_events(3, ["create", "pay", "other"], span=1500)
    assert relaxed(event_table(spark, rows), "10 seconds", width) == model_followed_by(rows, "create", "pay", 10)


def test_slices_stay_between_a_minute_and_an_hour_unless_the_bound_is_long():
    assert slice_micros(to_micros("2 seconds"), None) == to_micros("1 minute")
    assert slice_micros(to_micros("15 minutes"), None) == to_micros("30 minutes")
    assert slice_micros(to_micros("6 hours"), None) == to_micros("1 hour")
    assert slice_micros(to_micros("240 days"), None) == to_micros("10 days")
    assert slice_micros(to_micros("6 hours"), "5 seconds") == to_micros("5 seconds")


@pytest.mark.parametrize("width", WIDTHS)
@pytest.mark.parametrize("seed, span", [(4, 60), (5, 1500)])
def test_lifecycle_against_the_model(spark, width, seed, span):
    rows = random_events(seed, ["create", "pay", "other"], span=span)
    assert outcomes(event_table(spark, rows), "7 seconds", width) == model_lifecycle(rows, 7)


@pytest.mark.parametrize("width", WIDTHS)
@pytest.mark.parametrize("seed, span", [(6, 60), (7, 1500)])
def test_match_against_the_model(spark, width, seed, span):
    rows = random_events(seed, ["L", "R"], span=span)
    assert matches(event_table(spark, rows), "4 seconds", width) == model_match(rows, 4)


@pytest.mark.parametrize("width", WIDTHS)
def test_a_state_passes_through_many_slices(spark, width):
    """Sides alternate at every second: each row's outcome depends on the first one's."""
    rows = [("a", float(at), at, "LR"[at % 2]) for at in range(101)]
    assert matches(event_table(spark, rows), "4 seconds", width) == model_match(rows, 4)
    rows = [("a", float(at // 2 * 3), at, ("pay", "create")[at % 2]) for at in range(101)]
    rows = [("a", -2.0, -1, "create"), *rows]
    assert outcomes(event_table(spark, rows), "7 seconds", width) == model_lifecycle(rows, 7)


def test_rows_without_key_or_time_are_left_out(spark):
    rows = [("a", None, 0, "L"), (None, 1.0, 1, "R"), ("a", 1.0, 2, "L")]
    assert matches(event_table(spark, rows), "4 seconds") == {("a", "unmatchedPays", 2, None): 1}


def test_several_keys_and_carried_columns(spark):
    events = event_table(spark, [("a", 0.0, 0, "L"), ("a", 1.0, 1, "R")]).withColumn("shop", F.lit(7))
    found = match(
        events.filter(kind("L")), events.filter(kind("R")), ["key", "shop"], "ts", "5 seconds",
        ["seq", "kind"], ["seq"], ["seq"],
    )
    row = found.first()
    assert (row.key, row.shop, row.left.kind, row.right.seq) == ("a", 7, "L", 1)


def test_lines_of_one_second_follow_their_order_in_the_log(spark, tmp_path):
    """Rows of the shipped logs' layout, read and analysed with default arguments."""
    (tmp_path / "logins.csv").write_text(
        "1035,83.149.9.216,fail,1558430843\n1035,83.149.9.216,fail,1558430846\n"
        "1035,83.149.9.216,fail,1558430847\n1035,83.149.9.216,fail,1558430848\n"
        "7,10.0.0.7,fail,1558430850\n7,10.0.0.7,success,1558430850\n7,10.0.0.7,fail,1558430850\n"
    )
    (tmp_path / "orders.csv").write_text(
        "1,create,,1558430900\n1,pay,tx1,1558430900\n34756,create,,1558430913\n34756,pay,tx2,1558431951\n"
        "34768,pay,tx3,1558430950\n"
    )
    logins = accepted(parse_login(read_lines(spark, str(tmp_path / "logins.csv"))))
    found = analyses.login_fail(logins)
    assert collected(found, "user_id", seconds("first_fail_time")) == {
        (1035, 1558430846.0): 1, (1035, 1558430847.0): 1,
    }
    orders = accepted(parse_order(read_lines(spark, str(tmp_path / "orders.csv"))))
    assert collected(analyses.order_timeout_pattern(orders), "order_id", "tag") == {
        (1, "matched"): 1, (34756, "timeout"): 1,
    }
    assert collected(analyses.order_lifecycle(orders, mode="strict"), "order_id", "tag") == {
        (1, "payed"): 1, (34756, "timeout"): 1, (34756, "orphan"): 1, (34768, "orphan"): 1,
    }


def test_summary_leaves_out_rows_without_time_or_key(spark):
    events = event_table(spark, [("a", None, 0, "create"), (None, 1.0, 1, "pay"), ("b", 1.0, 2, "pay")])
    found = lifecycle_summary(events, ["key"], "ts", kind("create"), kind("pay"), "7 seconds")
    assert collected(found, "key", "tag") == {("b", "orphan"): 1}


def test_analyses_on_parsed_records(spark):
    events = event_table(spark, [("1", 10.0, 0, "create"), ("1", 20.0, 1, "pay"), ("2", 30.0, 2, "create")])
    orders = events.select(F.col("key").cast("long").alias("order_id"), F.col("kind").alias("event_type"), F.col("ts").alias("event_time"), "seq")
    pattern = analyses.order_timeout_pattern(orders, seq=("seq",))
    assert collected(pattern, "order_id", "result_msg") == {(1, "成功支付"): 1, (2, "超时支付 30"): 1}
    for mode in ("summary", "strict"):
        ended = analyses.order_lifecycle(orders, seq=("seq",), mode=mode)
        assert collected(ended, "order_id", "result_msg") == {
            (1, "payed successfully"): 1, (2, "order timeout"): 1,
        }
    with pytest.raises(ValueError):
        analyses.order_lifecycle(orders, mode="other")
