"""Finished slices of many keys, taken a bucket at a time."""

from __future__ import annotations

import json

import pandas as pd
import pyarrow as pa
import pytest

from eddyline.streaming.processors import (
    OUTPUT_NAMES,
    Buckets,
    FollowedBy,
    Lifecycle,
    Outcome,
    Row,
    Slices,
    _flat,
    _packed,
    _rows_text,
    summaries,
)
from tests.test_processors import SEQUENCES, Run, arrivals, expected, history, milliseconds, of, outcomes_of, scaled

SLICE_TYPE = pa.schema([
    ("bucket", pa.int32()), ("key", pa.string()), ("slice", pa.int64()),
    ("rows", pa.list_(pa.struct([("t", pa.int64()), ("seq", pa.int64()), ("kind", pa.int32()), ("payload", pa.string())]))),
])


def gathered(slices, span, summarised, sequence):
    """Slices of (key, number) as the aggregation hands them on."""
    rows = [
        {"bucket": 0, "key": key, "slice": number, "rows": [row._asdict() for row in part]}
        for (key, number), part in slices
    ]
    if not rows:
        return []
    if not summarised:
        return [pd.DataFrame([{**row, "rows": json.dumps(row["rows"])} for row in rows])]
    batches = summaries(sequence)(iter([pa.RecordBatch.from_pylist(rows, SLICE_TYPE)]))
    return [batch.to_pandas() for batch in batches]


def outcomes(frames, key):
    texts = [text for one in frames for name, text in zip(one["key"], one["outcomes"], strict=True) if name == key]
    flat = pd.DataFrame([one for text in texts for one in json.loads(text)])
    return outcomes_of([flat]) if len(flat) else {}


@pytest.mark.parametrize("name", [*SEQUENCES, "legacy"])
@pytest.mark.parametrize("span", [1_000, 7_000, 10 ** 6])
def test_buckets_give_what_whole_keys_give(name, span):
    sequence = scaled(SEQUENCES.get(name) or Lifecycle(6, legacy_timers=True))
    histories = {
        f"k{seed}": milliseconds(of("lifecycle" if name == "legacy" else name, history(seed, 40, 20)))
        for seed in range(12)
    }
    every = [row._replace(payload=json.dumps([key, row.payload])) for key, rows in histories.items() for row in rows]
    run, waiting, found = Run(Buckets(sequence, span, name != "legacy"), (0,)), {}, []
    for part, mark in arrivals(every, 9, 15):
        for row in part:
            key, payload = json.loads(row.payload)
            waiting.setdefault((key, row.t // span), []).append(row._replace(payload=payload))
        over = [one for one in waiting if (one[1] + 1) * span <= mark * 1000]
        found += run.feed(gathered([(one, waiting.pop(one)) for one in over], span, name != "legacy", sequence), mark)
        assert len(run.handle.timers) <= 1
    for key, rows in histories.items():
        assert outcomes(found, key) == expected(sequence, rows)
    assert not run.handle.timers and not run.handle.states["held"].exists()


class Counted:
    """A value state that counts how often it is called."""

    def __init__(self, state):
        self.state, self.calls = state, 0

    def __getattr__(self, name):
        self.calls += 1
        return getattr(self.state, name)


@pytest.mark.parametrize("keys", [1, 50, 2_000])
def test_calls_to_the_state_store_do_not_grow_with_the_keys(keys):
    """Each key used to cost several calls: what the streams of many keys spent their time on."""
    sequence, hour = FollowedBy(2 * 3_600_000_000), 3_600_000_000
    run = Run(Buckets(sequence, hour), (0,))
    run.processor.held = counted = Counted(run.processor.held)
    slices = [((f"k{key}", 0), [Row(key, 0, 1, None)]) for key in range(keys)]
    run.feed(gathered(slices, hour, True, sequence), 3_600_000)
    assert counted.calls == 2 and len(run.handle.timers) == 1
    assert len(json.loads(counted.state.get()[0])) == keys


def test_what_is_due_in_a_finished_slice_is_reported_with_it():
    """No timer is left to fire after the last batch, as one did that was set behind the watermark."""
    sequence, hour = FollowedBy(10), 3_600_000_000
    run = Run(Buckets(sequence, hour), (0,))
    values = type("Values", (), {"getCurrentWatermarkInMs": lambda self: 10 ** 9})()
    frames = gathered([(("a", 0), [Row(5, 0, 1, None)])], hour, True, sequence)
    found = list(run.processor.handleInputRows((0,), iter(frames), values))
    assert outcomes(found, "a") == {("timeout", 5, None, None, None): 1}
    assert not run.handle.timers


def test_slices_one_by_one_are_summarised_alike():
    sequence, span = scaled(SEQUENCES["lifecycle"]), 7_000
    rows = milliseconds(of("lifecycle", history(3, 30, 2)))
    rows = [row for row in rows if row.t // span == rows[0].t // span]
    run = Run(Slices(["key", "_slice"], sequence, span), ("a", rows[0].t // span))
    single = run.feed([pd.DataFrame(rows, columns=list(Row._fields))], 10 ** 9)[0]
    together = gathered([(("a", rows[0].t // span), rows)], span, True, sequence)[0]
    names = ["slice", "entry", "always", "kept", "cleared", "held_kept", "held_cleared"]
    assert single[names].values.tolist() == together[names].values.tolist()


@pytest.mark.parametrize("payload", [None, "", 'a "quoted" \\ back\nslash', "é\u2028\U0001f600\x00"])
def test_rows_and_outcomes_are_written_as_json_writes_them(payload):
    """They are put together by hand: two calls of the JSON encoder a row took most of a slice's time."""
    row, other = Row(-5, 2 ** 62, 1, payload), Row(7, 0, 0, "{}")
    assert _rows_text([row, other]) == json.dumps([row, other]) and _rows_text([]) == "[]"
    outcomes = [Outcome("a tag", row, other), Outcome("é", row), Outcome("b", None, row)]
    assert _packed(outcomes) == json.dumps([dict(zip(OUTPUT_NAMES, _flat(one), strict=True)) for one in outcomes])
