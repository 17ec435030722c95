"""Streams whose state and calls must not multiply with windows, slices and keys."""

from __future__ import annotations

import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from eddyline.operators.ranking import top_n
from eddyline.operators.windows import window_count
from eddyline.session import scratch_path
from eddyline.streaming import flows
from eddyline.streaming.eventtime import ascending, watermark
from eddyline.plans.stream_queries import STREAM_QUERIES
from eddyline.streaming.sinks import append_files, run_available, state_partitions
from tests.helpers import collected, event_table, random_events, seconds
from tests.test_streaming import Arrivals, closing


@pytest.fixture
def arrivals(spark, tmp_path):
    return Arrivals(spark, tmp_path)


@pytest.mark.parametrize("size, slide, together", [
    (60, 5, None), (60, 5, 1), (60, 5, 12), (60, 5, 17), (60, 7, None), (10, 10, None), (10, 10, 4), (600, 5, None),
])
def test_windows_counted_side_by_side_are_the_same_windows(spark, size, slide, together):
    events = event_table(spark, random_events(21, ["x"], count=300, span=900))
    found = flows.sliding_count(events, ["key"], "ts", f"{size} seconds", f"{slide} seconds", together)
    plain = window_count(events, ["key"], "ts", f"{size} seconds", f"{slide} seconds")
    expected = collected(plain, seconds("window_end"), "key", "count")
    assert collected(found, seconds("window.end"), "key", "count") == expected
    lengths = found.select((seconds("window.end") - seconds("window.start")).alias("length")).distinct().collect()
    assert [row.length for row in lengths] == [float(size)]


def test_a_row_updates_few_entries_of_state(spark, arrivals):
    """Twelve windows cover a row; it used to cost an entry for each, and one for its pane."""
    rows = [(f"k{number}", float(number % 3000), number, "x") for number in range(2000)]
    arrivals.add(rows)
    base = scratch_path(spark, "entries")
    counts = flows.sliding_count(watermark(arrivals.stream(), "ts", "1 second"), ["key"], "ts", "60 minutes", "5 minutes")
    query = run_available(append_files(counts.select("window.end", "key", "count"), f"{base}/out"), f"{base}/check")
    updated = sum(int(state.numRowsUpdated) for progress in query.recentProgress for state in progress.stateOperators)
    assert 2000 <= updated <= 3 * 2000


def test_windows_reported_together_are_ranked_one_by_one(spark, arrivals):
    rows = random_events(22, ["x"], count=300, span=300, keys="abcdefgh", hot=0.2)
    base = scratch_path(spark, "together")

    def run():
        timed = watermark(arrivals.stream(), "ts", "5 seconds")
        counts = flows.sliding_count(timed, ["key"], "ts", "60 seconds", "10 seconds")
        run_available(append_files(flows.top_windows(counts, 3, "key"), f"{base}/out"), f"{base}/check")

    arrivals.add(sorted(rows, key=lambda row: row[1])[:150])
    arrivals.add(sorted(rows, key=lambda row: row[1])[150:])
    run()
    arrivals.add(closing(["x"]))
    run()
    whole = top_n(window_count(event_table(spark, rows), ["key"], "ts", "60 seconds", "10 seconds"), 3, ties=["key"])
    columns = (seconds("window_end"), "key", "count", "rank")
    found = spark.read.parquet(f"{base}/out").filter("key <> 'closing'")
    assert collected(found, *columns) == collected(whole, *columns)


def test_silence_begins_exactly_at_its_bound(spark):
    """Rows that are the bound apart are two, rows a microsecond closer are one; no call per key."""
    events = event_table(spark, [
        ("a", 1.0, 0, "x"), ("a", 21.0, 1, "x"), ("b", 1.0, 2, "x"), ("b", 20.999999, 3, "x"),
        (None, 1.0, 4, "x"), ("c", None, 5, "x"),
    ])
    found = flows.silence(events, ["key"], "ts", "20 seconds")
    assert collected(found, "key", seconds("last_seen"), seconds("silent_at")) == {
        ("a", 1.0, 21.0): 1, ("a", 21.0, 41.0): 1, ("b", 20.999999, 40.999999): 1,
    }
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("legacy", [False, True])
def test_calls_into_state_go_by_buckets(spark, arrivals, legacy):
    """One entry of state for a bucket of keys, where each key had several."""
    arrivals.add([(f"k{number}", 10.0, number, "create") for number in range(3000)])
    arrivals.add([("k0", 7200.0, 3000, "pay")])
    found = flows.lifecycle(
        ascending(arrivals.stream(), "ts"), ["key"], "ts", F.col("kind") == "create", F.col("kind") == "pay",
        "24 hours", "seq", legacy,
    )
    base = scratch_path(spark, "buckets")
    query = run_available(append_files(found, f"{base}/out"), f"{base}/check")
    operators = query.recentProgress[-1].stateOperators
    python = [state for state in operators if "transformWithState" in state.operatorName]
    assert len(python) == 1 and 0 < int(python[0].numRowsUpdated) <= 2 * flows.KEY_BUCKETS


def test_state_partitions_follow_the_cores_and_not_batch_shuffles(spark, data, tmp_path, monkeypatch):
    """Every micro-batch syncs every state partition, so 200 of them take most of a short stream's time."""
    monkeypatch.setattr("eddyline.plans.stream_queries.scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, "200")
    try:
        assert STREAM_QUERIES["stream_order_lifecycle"](spark, data).count() > 0
        assert spark.conf.get(name) == "200"
    finally:
        spark.conf.set(name, before)
    operators = list((tmp_path / "stream_order_lifecycle/checkpoint/state").glob("[0-9]*"))
    assert len(operators) == 2
    for operator in operators:
        assert len([part for part in operator.iterdir() if part.name.isdigit()]) == 24


def test_a_dozen_cores_share_two_dozen_state_partitions():
    """Three a core were loaded, committed and synced by every micro-batch."""
    class Conf(dict):
        set = dict.__setitem__

    conf = Conf({"spark.sql.shuffle.partitions": "200"})
    session = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(defaultParallelism=12))
    with state_partitions(session):
        assert conf["spark.sql.shuffle.partitions"] == "24"
    assert conf["spark.sql.shuffle.partitions"] == "200"
