from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from eddyline.functions.report import ITEM_REPORT, URL_REPORT, ranking_report
from eddyline.functions.time import LABEL_MINUTES
from eddyline.operators.ranking import top_n
from eddyline.operators.windows import sliding_count, window_count, window_sum
from eddyline.plans import analyses
from tests.helpers import collected, event_table, random_events, seconds


def test_a_row_at_the_end_belongs_to_the_next_window(spark):
    events = event_table(spark, [("a", 59.999999, 0, "x"), ("a", 60.0, 1, "x"), ("a", -0.5, 2, "x")])
    counts = window_count(events, ["key"], "ts", "60 seconds")
    assert collected(counts, seconds("window_end"), "count") == {(60.0, 1): 1, (120.0, 1): 1, (0.0, 1): 1}


@pytest.mark.parametrize("size, slide", [("60 seconds", "5 seconds"), ("10 seconds", "10 seconds"), ("50 seconds", "20 seconds")])
def test_sliding_count_equals_the_plain_windows(spark, size, slide):
    rows = random_events(1, "xy", span=2000, keys="abcd")
    rows += [("a", -seconds_back, 900 + number, "x") for number, seconds_back in enumerate((0.5, 3.0, 61.0))]
    events = event_table(spark, rows)
    columns = (seconds("window_end"), "key", "count")
    expected = collected(window_count(events, ["key"], "ts", size, slide), *columns)
    assert collected(sliding_count(events, ["key"], "ts", size, slide), *columns) == expected


def test_sliding_count_counts_missing_keys_together_and_ignores_missing_times(spark):
    events = event_table(spark, [(None, 1.0, 0, "x"), (None, 2.0, 1, "x"), ("a", None, 2, "x")])
    counts = sliding_count(events, ["key"], "ts", "10 seconds", "10 seconds")
    assert collected(counts, "key", "count") == {(None, 2): 1}


def test_sliding_count_without_rows(spark):
    events = event_table(spark, [])
    assert sliding_count(events, ["key"], "ts", "60 seconds", "5 seconds").count() == 0


def test_window_sum(spark):
    events = event_table(spark, [("a", 1.0, 5, "x"), ("a", 2.0, 7, "x"), ("a", 61.0, 1, "x")])
    totals = window_sum(events, ["key"], "seq", "ts", "60 seconds", name="total")
    assert collected(totals, seconds("window_end"), "total") == {(60.0, 12): 1, (120.0, 1): 1}


def test_top_n_breaks_ties_by_key_and_takes_fewer_when_there_are_fewer(spark):
    scored = spark.createDataFrame(
        [(1, "c", 5), (1, "a", 5), (1, "b", 9), (1, "d", 1), (2, "z", 1)],
        "window_end long, key string, count long",
    )
    assert collected(top_n(scored, 3), "window_end", "rank", "key") == {
        (1, 1, "b"): 1, (1, 2, "a"): 1, (1, 3, "c"): 1, (2, 1, "z"): 1,
    }


def test_reports(spark):
    ranked = spark.createDataFrame(
        [(datetime(2017, 11, 26, 9, 5), 11, 7, 2), (datetime(2017, 11, 26, 9, 5), 10, 9, 1)],
        "window_end timestamp, item long, count long, rank int",
    )
    text = ranking_report(ranked, "item", ITEM_REPORT).first().report
    assert text.split("\n") == [
        "窗口结束时间： 2017-11-26 09:05:00.0",
        "NO1:\t商品ID = 10\t热门度 = 9",
        "NO2:\t商品ID = 11\t热门度 = 7",
        "=======================",
        "",
    ]
    text = ranking_report(ranked, "item", URL_REPORT).first().report
    assert text.split("\n") == [
        "时间: 2017-11-26 09:05:00.0", "NO1: URL= 10访问量= 9", "NO2: URL= 11访问量= 7",
        "==============================",
    ]


def test_hot_items_of_one_behavior(spark):
    events = event_table(spark, [("a", 1.0, 7, "pv"), ("a", 2.0, 7, "buy"), ("a", 3.0, 8, "buy")])
    behaviors = events.select(F.col("seq").alias("item_id"), F.col("kind").alias("behavior"), F.col("ts").alias("event_time"))
    everything = analyses.hot_items(behaviors, n=1)
    assert {(row.item_id, row["count"]) for row in everything.collect()} == {(7, 2)}
    assert everything.count() == 12
    bought = analyses.hot_items(behaviors, n=5, behavior="buy")
    assert {(row.item_id, row["count"], row["rank"]) for row in bought.collect()} == {(7, 1, 1), (8, 1, 2)}


def test_traffic_label_by_the_minute(spark):
    events = event_table(spark, [("a", 1.0, 5, "x")]).select(
        F.col("ts").alias("event_time"), F.col("key").alias("domain"), F.col("seq").alias("traffic"),
    )
    assert analyses.domain_traffic(events).first().time_label == "1970-01-01 00:01:00"
    assert analyses.domain_traffic(events, layout=LABEL_MINUTES).first().time_label == "1970-01-01 00:01"
