"""Sequences taken whole and in slices, and what the processors do to their state."""

from __future__ import annotations

import json
import random
from collections import Counter
from types import SimpleNamespace

import pandas as pd
import pytest

from eddyline.streaming.processors import (
    FIRST,
    SECOND,
    Compose,
    FollowedBy,
    InOrder,
    Lifecycle,
    Match,
    Row,
    Slices,
    StrictNext,
)

SEQUENCES = {
    "strict next": StrictNext(7),
    "followed by": FollowedBy(9),
    "lifecycle": Lifecycle(6),
    "match": Match(4, keep_replaced=True),
}


class Value:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class Rows(Value):
    def get(self):
        return iter(self.value or [])

    def appendList(self, rows):
        self.value = (self.value or []) + rows


class Buckets:
    """A map that counts the rows that go in and out."""

    def __init__(self):
        self.values, self.moved = {}, 0

    def updateValue(self, key, value):
        self.values[key] = value
        self.moved += len(value[0])

    def getValue(self, key):
        self.moved += len(self.values[key][0])
        return self.values[key]

    def removeKey(self, key):
        del self.values[key]


class Handle:
    """State and timers of one key."""

    def __init__(self):
        self.timers, self.states = set(), {}

    def _state(self, name, kind):
        return self.states.setdefault(name, kind())

    def getValueState(self, name, schema):
        return self._state(name, Value)

    def getListState(self, name, schema):
        return self._state(name, Rows)

    def getMapState(self, name, key_schema, schema):
        return self._state(name, Buckets)

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


class Run:
    """One key's processor, fed batch by batch as a stream would."""

    def __init__(self, processor, key):
        self.processor, self.key, self.handle = processor, key, Handle()
        processor.init(self.handle)

    def feed(self, frames, watermark):
        values = SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark)
        out = list(self.processor.handleInputRows(self.key, iter(frames), values)) if frames else []
        for at in sorted(at for at in self.handle.timers if at <= watermark):
            if at in self.handle.timers:
                self.handle.timers.discard(at)
                fired = SimpleNamespace(getExpiryTimeInMs=lambda at=at: at)
                out += self.processor.handleExpiredTimer(self.key, values, fired)
        return out


def whole(sequence, rows):
    held, outcomes = [], []
    for row in sorted(rows, key=sequence.order):
        held, found = sequence.advance(held, row)
        outcomes += found
    return Counter(outcomes + sequence.expire(held, 10 ** 15)[1])


def history(seed, count, gap):
    pick, at, rows = random.Random(seed), 1000, []
    for seq in range(count):
        at += pick.choice([0, 0, 1, 1, 2, gap])
        rows.append(Row(at, seq, pick.choice([0, 1, 1, 2, 3]), None if pick.random() < 0.5 else f"p{seq}"))
    return rows


def of(name, rows):
    """The roles a sequence knows."""
    if name in ("lifecycle", "match"):
        return [row._replace(kind=row.kind % 2) for row in rows]
    return rows


@pytest.mark.parametrize("name", SEQUENCES)
@pytest.mark.parametrize("span", [1, 3, 10, 50, 10_000])
def test_slices_compose_to_the_whole(name, span):
    sequence = SEQUENCES[name]
    for seed in range(40):
        rows = of(name, history(seed, 60, 20))
        held, outcomes, slices = [], [], {}
        for row in sorted(rows, key=sequence.order):
            slices.setdefault(row.t // span, []).append(row)
        for number in sorted(slices):
            summary = sequence.summarise(slices[number])
            way, beside, found = sequence.enter(held, summary.entry)
            outcomes += found + summary.always + summary.found[way]
            held = beside + summary.held[way]
        assert Counter(outcomes + sequence.expire(held, 10 ** 15)[1]) == whole(sequence, rows)


def frame(rows):
    return pd.DataFrame(rows, columns=list(Row._fields))


def milliseconds(rows):
    return [row._replace(t=row.t * 1000) for row in rows]


def arrivals(rows, batches, delay, seed=0):
    """Rows in batches, out of order by up to `delay` ms, and the watermark after each."""
    pick, out, seen = random.Random(seed), [], 0
    ordered = sorted(rows, key=lambda row: row.t / 1000 + pick.random() * delay)
    size = -(-len(ordered) // batches)
    for start in range(0, len(ordered), size):
        part = ordered[start:start + size]
        out.append((part, seen))
        seen = max(seen, max(row.t // 1000 for row in part) - delay - 1)
    return [*out, ([], seen), ([], 10 ** 9), ([], 2 * 10 ** 9)]


def outcomes_of(frames):
    columns = ["tag", "first_t", "first", "second_t", "second"]
    return Counter(
        tuple(None if pd.isna(value) else value for value in row)
        for one in frames for row in one[columns].itertuples(index=False)
    )


def expected(sequence, rows):
    def part(row):
        return (row.t, row.payload) if row else (None, None)

    return Counter((one.tag, *part(one.first), *part(one.second)) for one in whole(sequence, rows).elements())


def scaled(sequence):
    """The same sequence over times a thousand times as large."""
    copy = type(sequence).__new__(type(sequence))
    copy.__dict__.update(sequence.__dict__, within=sequence.within * 1000)
    return copy


@pytest.mark.parametrize("name", [*SEQUENCES, "legacy"])
@pytest.mark.parametrize("bucket", [1, 5_000, 10 ** 9])
def test_rows_in_buckets_are_taken_in_order(name, bucket):
    sequence = scaled(SEQUENCES.get(name) or Lifecycle(6, legacy_timers=True))
    for seed in range(8):
        rows = milliseconds(of("lifecycle" if name == "legacy" else name, history(seed, 80, 20)))
        run = Run(InOrder(["key"], sequence, bucket), ("a",))
        found = [one for part, mark in arrivals(rows, 7, 15, seed) for one in run.feed([frame(part)] if part else [], mark)]
        assert outcomes_of(found) == expected(sequence, rows)
        assert not run.handle.timers and not run.handle.states["waiting"].values
        assert not run.handle.states["progress"].exists() and not run.handle.states["held"].exists()


@pytest.mark.parametrize("name", SEQUENCES)
@pytest.mark.parametrize("span", [1_000, 7_000, 10 ** 6])
def test_processors_of_slices_give_what_the_whole_gives(name, span):
    sequence = scaled(SEQUENCES[name])
    for seed in range(6):
        rows = milliseconds(of(name, history(seed, 80, 20)))
        slices, compose, found = {}, Run(Compose(["key"], sequence, span), ("a",)), []
        for part, mark in arrivals(rows, 7, 15, seed):
            by_slice = {}
            for row in part:
                by_slice.setdefault(row.t // span, []).append(row)
            summaries = []
            for number in sorted({*by_slice, *slices}):
                if number not in slices:
                    slices[number] = Run(Slices(["key", "_slice"], sequence, span), ("a", number))
                summaries += slices[number].feed([frame(by_slice[number])] if number in by_slice else [], mark)
            found += compose.feed(summaries, mark)
            assert len(compose.handle.timers) <= 1
        flat = pd.DataFrame([one for part in found for text in part["outcomes"] for one in json.loads(text)])
        assert (outcomes_of([flat]) if len(flat) else Counter()) == expected(sequence, rows)
        assert not any(run.handle.timers or run.handle.states["rows"].exists() for run in slices.values())
        assert not compose.handle.timers and not compose.handle.states["held"].exists()


@pytest.mark.parametrize("delay", [600, 7_200, 86_400])
def test_state_moved_per_batch_does_not_grow_with_the_delay(delay):
    """One hot key, ten rows a second; the watermark stays `delay` seconds behind."""
    run = Run(InOrder(["key"], StrictNext(2_000_000), 60_000_000), ("a",))
    step, moved = 60, []
    for batch in range(delay // step + 20):
        start = batch * step
        rows = [Row((start * 10 + place) * 100_000, place, FIRST | SECOND, None) for place in range(step * 10)]
        before = run.handle.states["waiting"].moved
        run.feed([frame(rows)], (start - delay) * 1000)
        moved.append(run.handle.states["waiting"].moved - before)
    assert max(moved) <= 4 * step * 10
    assert len(run.handle.timers) == 1
