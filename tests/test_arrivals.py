"""Lines with positions, late and revised rows, silence, and joins of streams."""

from __future__ import annotations

import io
import random

import pytest
from pyspark.sql import functions as F

from eddyline.session import scratch_path
from eddyline.sources.positioned import FILE_BITS, Range, last_line_end, lines_from, stream_positioned_lines
from eddyline.streaming import flows
from eddyline.streaming.eventtime import ascending, watermark
from eddyline.streaming.processors import Row, Silence
from eddyline.streaming.sinks import append_files, read_latest, run_available, write_batches
from tests.helpers import collected, event_table, model_match, seconds
from tests.test_processors import Run, frame
from tests.test_streaming import Arrivals, closing, kind


@pytest.fixture
def arrivals(spark, tmp_path):
    return Arrivals(spark, tmp_path)


# Lines


def positions(text: bytes, size: int, limit: int):
    found = []
    for start in range(0, limit, size):
        part = Range("", 0, start, min(start + size, limit), limit)
        found += lines_from(io.BytesIO(text), part)
    return found


@pytest.mark.parametrize("seed", range(20))
def test_ranges_of_any_size_give_every_line_once(seed):
    pick = random.Random(seed)
    lines = [b"x" * pick.choice([0, 0, 1, 3, 10, 70_000]) for _ in range(pick.randrange(8))]
    text = b"\n".join(lines) + pick.choice([b"", b"\n", b"\n\n"])
    whole = last_line_end(io.BytesIO(text), len(text))
    assert whole == text.rfind(b"\n") + 1
    place, expected = 0, []
    for line in text.split(b"\n"):
        expected.append((place, line))
        place += len(line) + 1
    if expected and not expected[-1][1]:
        expected.pop()
    for size in (1, 2, 5, 64, 65_536, 10 ** 6):
        if size < 64 and len(text) > 2000:
            continue
        assert positions(text, size, len(text)) == expected
        assert positions(text, size, whole) == [row for row in expected if row[0] < whole]


def test_lines_keep_their_order_as_files_grow_and_follow(spark, tmp_path):
    folder, base = tmp_path / "log", scratch_path(spark, "lines")
    folder.mkdir()

    def read(complete=False):
        lines = stream_positioned_lines(spark, str(folder), complete, range_bytes=16)
        run_available(append_files(lines, f"{base}/out"), f"{base}/check")
        rows = spark.read.parquet(f"{base}/out").orderBy("position").collect()
        return [row["value"] for row in rows], [row["position"] for row in rows]

    (folder / "a.log").write_bytes(b"one\r\ntwo is somewhat longer than a range\nthr")
    (folder / "_temporary").write_bytes(b"not read\n")
    assert read()[0] == ["one", "two is somewhat longer than a range"]
    (folder / "a.log").write_bytes(b"one\r\ntwo is somewhat longer than a range\nthree\n")
    (folder / "b.log").write_bytes(b"\nlast, without end")
    values, places = read()
    assert values == ["one", "two is somewhat longer than a range", "three", ""]
    assert places == [0, 5, 41, 1 << FILE_BITS]
    assert read(complete=True)[0][-1] == "last, without end"
    (folder / "aa.log").write_bytes(b"too late\n")
    with pytest.raises(Exception, match="sorts before"):
        read()


# Late rows


def test_updates_written_again_replace_themselves(spark, tmp_path):
    write = write_batches(str(tmp_path / "out"))
    for batch, rows in enumerate([[("a", 1.0, 5, "x"), ("b", 1.0, 1, "y")], [("a", 1.0, 7, "z")], [("a", 1.0, 7, "z")]]):
        write(event_table(spark, rows), min(batch, 1))
    latest = read_latest(spark, str(tmp_path / "out"), ["key"])
    assert collected(latest, "key", "seq", "kind", "revisions") == {("a", 7, "z", 1): 1, ("b", 1, "y", 0): 1}


# Silence


def silent(found):
    return sorted((row.last_t, row.silent_t) for part in found for row in part.itertuples())


class Forgetful(Silence):
    """Leaves superseded timers where they are."""

    def init(self, handle):
        super().init(handle)
        handle.deleteTimer = lambda at: None


def test_a_timer_that_is_not_deleted_reports_a_key_that_is_not_silent():
    batches = [([0], 1_000), ([30], 29_000), ([], 50_000), ([60], 59_000), ([], 200_000)]

    def run(kind):
        one = Run(kind(["key"], 45_000_000), ("a",))
        return silent([
            part for times, mark in batches
            for part in one.feed([frame([Row(time * 1_000_000, 0, 0, None) for time in times])] if times else [], mark)
        ])

    assert run(Silence) == [(60_000_000, 105_000_000)]
    assert run(Forgetful) == [(30_000_000, 75_000_000), (60_000_000, 105_000_000)]


@pytest.mark.parametrize("seed", range(20))
def test_silence_is_reported_whatever_the_batches(seed):
    pick, within = random.Random(seed), 10_000
    times = sorted(pick.randrange(0, 400) * 1000 for _ in range(60))
    expected = [
        (one, one + within) for one, after in zip(times, [*times[1:], 10 ** 9], strict=True) if after - one >= within
    ]
    run, found, mark = Run(Silence(["key"], within), ("a",)), [], 0
    while times:
        size = pick.randrange(1, 12)
        batch, times = times[:size], times[size:]
        found += run.feed([frame([Row(time, 0, 0, None) for time in batch])], mark)
        mark = max(mark, batch[-1] // 1000 - 1)
        found += run.feed([], mark)
    found += run.feed([], 10 ** 7)
    assert silent(found) == expected


def test_silence_on_a_stream(spark, arrivals):
    base = scratch_path(spark, "silence")
    for rows in ([("a", 1.0, 0, "x"), ("a", 50.0, 1, "x"), ("b", 49.0, 2, "x")], [("a", 55.0, 3, "x")], closing(["x"])):
        arrivals.add(rows)
    found = flows.silence(ascending(arrivals.stream(), "ts"), ["key"], "ts", "20 seconds")
    run_available(append_files(found, f"{base}/out"), f"{base}/check")
    written = spark.read.parquet(f"{base}/out")
    assert collected(written, "key", seconds("last_seen"), seconds("silent_at")) == {
        ("a", 1.0, 21.0): 1, ("a", 55.0, 75.0): 1, ("b", 49.0, 69.0): 1,
    }


# Joins


def joined(spark, arrivals, rows, within="4 seconds"):
    base = scratch_path(spark, "join")

    def run():
        timed = watermark(arrivals.stream(), "ts", "5 seconds")
        found = flows.match_join(
            timed.filter(kind("L")), timed.filter(kind("R")), ["key"], "ts", within, ["seq"], ["seq"],
        )
        run_available(append_files(found, f"{base}/out"), f"{base}/check")

    arrivals.add(rows)
    run()
    arrivals.add(closing("LR"))
    run()
    return spark.read.parquet(f"{base}/out").filter("key <> 'closing'")


def test_a_join_matches_keys_that_occur_once_a_side(spark, arrivals):
    pick, rows = random.Random(3), []
    for number in range(60):
        for side in pick.choice(["L", "R", "LR"]):
            rows.append((f"k{number}", float(pick.randrange(1, 20)), 2 * number + (side == "R"), side))
    found = joined(spark, arrivals, rows)
    assert collected(found, "key", "tag", "left.seq", "right.seq") == model_match(rows, 4)


def test_of_repeated_keys_a_join_takes_one_row_a_side(spark, arrivals):
    rows = [("a", 10.0, 0, "L"), ("a", 10.0, 0, "L"), ("a", 11.0, 1, "R"), (None, 10.0, 2, "L"), ("b", None, 3, "R")]
    assert collected(joined(spark, arrivals, rows), "key", "tag", "left.seq", "right.seq") == {("a", "matched", 0, 1): 1}
