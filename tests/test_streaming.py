"""Streams against the bounded operators, over files that arrive one by one."""

from __future__ import annotations

import random
import uuid

import pytest
from pyspark.sql import functions as F

from eddyline.operators.ranking import top_n
from eddyline.operators.relational import project, restrict
from eddyline.operators.windows import window_count
from eddyline.session import scratch_path
from eddyline.sources import parsers
from eddyline.sources.lines import stream_lines
from eddyline.streaming import flows
from eddyline.streaming.eventtime import ascending, watermark
from eddyline.streaming.sinks import (
    append_files,
    checkpoint_path,
    fan_out,
    run_available,
    write_batches,
)
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

FAR = 1e6


def kind(name):
    return F.col("kind") == name


class Arrivals:
    """A folder into which rows arrive file by file."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, str(path / "arrivals")
        (path / "arrivals").mkdir()

    def add(self, rows):
        event_table(self.spark, rows).coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        schema = event_table(self.spark, []).schema
        return self.spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(self.path)


def jittered(rows, bound, files=4, seed=0):
    """The rows in files, out of order by less than `bound` seconds."""
    pick = random.Random(seed)
    arriving = sorted(rows, key=lambda row: row[1] + pick.random() * bound)
    size = -(-len(arriving) // files)
    return [arriving[start:start + size] for start in range(0, len(arriving), size)]


def closing(kinds):
    return [("closing", FAR, 10_000 + number, name) for number, name in enumerate(kinds)]


@pytest.fixture
def arrivals(spark, tmp_path):
    return Arrivals(spark, tmp_path)


def result(spark, build, arrivals, batches, kinds):
    """Run to the end of the data, restart from the checkpoint, and close."""
    base = scratch_path(spark, "stream")
    for rows in batches:
        arrivals.add(rows)
    run_available(append_files(build(arrivals.stream()), f"{base}/out"), f"{base}/check")
    arrivals.add(closing(kinds))
    run_available(append_files(build(arrivals.stream()), f"{base}/out"), f"{base}/check")
    return spark.read.parquet(f"{base}/out").filter("key <> 'closing'")


@pytest.mark.parametrize("split", [True, False])
def test_strict_next(spark, arrivals, split):
    rows = random_events(12, ["f", "f", "s"], count=160, span=300)
    found = result(
        spark,
        lambda events: flows.strict_next(
            watermark(events, "ts", "5 seconds"), ["key"], "ts", kind("f"), kind("f"), "8 seconds",
            "seq", ["seq"], "5 seconds", split,
        ),
        arrivals, jittered(rows, 5), "fs",
    )
    assert collected(found, "key", "first.seq", "second.seq") == model_strict_next(rows, "f", "f", 8)


@pytest.mark.parametrize("split", [True, False])
def test_followed_by(spark, arrivals, split):
    rows = random_events(13, ["create", "pay", "other"], count=160, span=300)
    found = result(
        spark,
        lambda events: flows.followed_by(
            watermark(events, "ts", "5 seconds"), ["key"], "ts", kind("create"), kind("pay"),
            "10 seconds", "seq", ["seq"], "7 seconds", split,
        ),
        arrivals, jittered(rows, 5), ["create", "pay"],
    )
    expected = model_followed_by(rows, "create", "pay", 10)
    assert collected(found, "key", "tag", "first.seq", "second.seq") == expected


@pytest.mark.parametrize("legacy, split", [(False, True), (False, False), (True, True)])
def test_lifecycle(spark, arrivals, legacy, split):
    rows = random_events(14, ["create", "pay", "other"], count=160, span=200)
    found = result(
        spark,
        lambda events: flows.lifecycle(
            watermark(events, "ts", "5 seconds"), ["key"], "ts", kind("create"), kind("pay"),
            "7 seconds", "seq", legacy, "20 seconds", split,
        ),
        arrivals, jittered(rows, 5), ["create", "pay"],
    )
    assert collected(found, "key", "tag", seconds("emitted_at")) == model_lifecycle(rows, 7, legacy)


@pytest.mark.parametrize("split", [True, False])
def test_match(spark, arrivals, split):
    rows = random_events(15, ["L", "R"], count=160, span=200)

    def build(events):
        timed = watermark(events, "ts", "5 seconds")
        return flows.match(
            timed.filter(kind("L")), timed.filter(kind("R")), ["key"], "ts", "4 seconds",
            ["seq"], ["seq"], "seq", keep_replaced=True, width="15 seconds", split=split,
        )

    found = result(spark, build, arrivals, jittered(rows, 5), "LR")
    assert collected(found, "key", "tag", "left.seq", "right.seq") == model_match(rows, 4)


def test_ranked_windows(spark, arrivals):
    """Ties, late rows within the allowance, and windows that end between files."""
    rows = random_events(16, ["x"], count=300, span=300, keys="abcdefgh", hot=0.2)
    batches = jittered(rows, 30)
    base = scratch_path(spark, "ranked")

    def run():
        timed = watermark(arrivals.stream(), "ts", "10 seconds", lateness="20 seconds")
        counts = window_count(timed, ["key"], "ts", "60 seconds", "20 seconds")
        run_available(flows.rank_windows(counts, 3, write_batches(f"{base}/out"), ["key"]), f"{base}/check")

    for rows_of_batch in batches:
        arrivals.add(rows_of_batch)
    run()
    arrivals.add(closing(["x"]))
    run()
    whole = window_count(event_table(spark, rows), ["key"], "ts", "60 seconds", "20 seconds")
    columns = (seconds("window_end"), "key", "count", "rank")
    found = spark.read.parquet(f"{base}/out").filter("key <> 'closing'")
    assert collected(found, *columns) == collected(top_n(whole, 3, ties=["key"]), *columns)


def counts_of(spark, arrivals, batches, mode, lateness="0 seconds"):
    name = f"counts_{uuid.uuid4().hex}"
    timed = watermark(arrivals.stream(), "ts", "1 second", lateness)
    counts = window_count(timed, ["key"], "ts", "10 seconds")
    query = counts.writeStream.outputMode(mode).format("memory").queryName(name).start()
    try:
        for rows in batches:
            arrivals.add(rows)
            query.processAllAvailable()
        dropped = sum(
            int(state.numRowsDroppedByWatermark)
            for progress in query.recentProgress for state in progress.stateOperators
        )
    finally:
        query.stop()
    return collected(spark.table(name), seconds("window_end"), "count"), dropped


LATE = [
    [("a", 1.0, 0, "x"), ("a", 12.0, 1, "x")],
    [("a", 2.0, 2, "x")],
    [("a", 200.0, 3, "x")],
]


def test_rows_beyond_the_lateness_are_dropped_and_counted(spark, arrivals):
    counts, dropped = counts_of(spark, arrivals, LATE, "append")
    assert counts == {(10.0, 1): 1, (20.0, 1): 1}
    assert dropped == 1


def test_rows_within_the_lateness_count(spark, arrivals):
    counts, dropped = counts_of(spark, arrivals, LATE, "append", lateness="60 seconds")
    assert counts == {(10.0, 2): 1, (20.0, 1): 1}
    assert dropped == 0


def test_updates_give_early_results_and_revise_them(spark, arrivals):
    counts, _ = counts_of(spark, arrivals, LATE, "update", lateness="60 seconds")
    assert counts == {(10.0, 1): 1, (10.0, 2): 1, (20.0, 1): 1, (210.0, 1): 1}


def test_ascending_keeps_rows_as_late_as_the_latest(spark, arrivals):
    base = scratch_path(spark, "ascending")
    for rows in ([("a", 100.0, 0, "create")], [("b", 1.0, 1, "other")], [("a", 100.0, 2, "pay")], closing(["pay"])):
        arrivals.add(rows)
    found = flows.lifecycle(
        ascending(arrivals.stream(), "ts"), ["key"], "ts", kind("create"), kind("pay"), "7 seconds", "seq",
    )
    run_available(append_files(found, f"{base}/out", tag="tag"), f"{base}/check")
    assert collected(spark.read.parquet(f"{base}/out"), "key", "tag") == {("a", "payed"): 1}


def test_fan_out_sends_each_tag_to_its_output(spark, arrivals):
    base = scratch_path(spark, "fan")
    rows = random_events(17, ["create", "pay"], count=60, span=60)
    arrivals.add(rows)
    arrivals.add(closing(["create", "pay"]))
    found = flows.lifecycle(
        watermark(arrivals.stream(), "ts", "1 second"), ["key"], "ts", kind("create"), kind("pay"),
        "7 seconds", "seq",
    )
    tags = ["payed", "late", "timeout", "orphan"]
    outputs = {tag: write_batches(f"{base}/{tag}") for tag in tags}
    run_available(fan_out(found, outputs), f"{base}/check")
    expected = model_lifecycle(rows, 7)
    for tag in tags:
        written = spark.read.parquet(f"{base}/{tag}")
        assert "tag" not in written.columns
        got = collected(written, "key", seconds("emitted_at"))
        assert got == {(key, at): n for (key, name, at), n in expected.items() if name == tag}


def test_batches_written_again_replace_themselves(spark, tmp_path):
    write = write_batches(str(tmp_path / "out"), tag="kind")
    batch = event_table(spark, [("a", 1.0, 0, "x"), ("a", 1.0, 1, "y")])
    write(batch, 0)
    write(batch, 0)
    write(batch, 1)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


def test_lines_and_views_as_streams(spark, tmp_path):
    """Parse, project and filter an appending stream; bad lines go to their own output."""
    folder = tmp_path / "lines"
    folder.mkdir()
    (folder / "a.csv").write_text("1,ip1,success,5\n2,ip2,fail,6\nbad\n")
    (folder / "b.csv").write_text("3 , ip3 , success , 7\n")
    base = scratch_path(spark, "views")
    parsed = parsers.parse_login(stream_lines(spark, str(folder), max_files=1))
    view = restrict(project(parsers.accepted(parsed), "event_type, ip"), "event_type = 'success'")
    run_available(append_files(view, f"{base}/good"), f"{base}/check-good")
    run_available(append_files(parsers.quarantined(parsed), f"{base}/bad"), f"{base}/check-bad")
    assert collected(spark.read.parquet(f"{base}/good"), "event_type", "ip") == {
        ("success", "ip1"): 1, ("success", "ip3"): 1,
    }
    assert collected(spark.read.parquet(f"{base}/bad"), "value") == {("bad",): 1}


def test_checkpoints_lie_in_the_folder_the_session_names(spark):
    assert checkpoint_path(spark, "login").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_rows_of_unnamed_tags_do_not_vanish(spark, arrivals):
    base = scratch_path(spark, "fan")
    arrivals.add([("a", 1.0, 0, "x"), ("a", 2.0, 1, "y")])
    only = {"x": write_batches(f"{base}/x")}
    rest = fan_out(arrivals.stream(), only, tag="kind", otherwise=write_batches(f"{base}/rest"))
    run_available(rest, f"{base}/check")
    assert collected(spark.read.parquet(f"{base}/rest"), "kind", "seq") == {("y", 1): 1}
    with pytest.raises(Exception, match="rows with tags other than x"):
        run_available(fan_out(arrivals.stream(), only, tag="kind"), f"{base}/failing")


def test_rows_without_time_or_key_are_left_out_and_carried_times_are_whole(spark, arrivals):
    arrivals.add([
        ("a", 1.123456, 0, "L"), ("a", 2.5, 1, "R"), ("a", None, 2, "L"), (None, 2.0, 3, "L"),
    ])

    def build(events):
        timed = watermark(events.withColumn("also", F.col("ts")), "ts", "5 seconds")
        return flows.match(
            timed.filter(kind("L")), timed.filter(kind("R")), ["key"], "ts", "4 seconds",
            ["also"], ["seq"], "seq", keep_replaced=True,
        )

    found = result(spark, build, arrivals, [], "LR")
    assert collected(found, "key", "tag", seconds("left.also"), "right.seq") == {("a", "matched", 1.123456, 1): 1}
