"""Small event tables and plain-Python models of the operators."""

from __future__ import annotations

import random
from collections import Counter

from pyspark.sql import functions as F

SECOND = 1_000_000


def event_table(spark, rows, kinds="key string, at double, seq long, kind string"):
    """Rows of (key, seconds, seq, kind) as events with a timestamp `ts`."""
    frame = spark.createDataFrame(rows, kinds)
    micros = F.round(F.col("at") * SECOND).cast("long")
    return frame.withColumn("ts", F.timestamp_micros(micros)).drop("at")


def random_events(seed, kinds, count=400, keys="abc", span=200, hot=0.5):
    """Whole seconds, so that times coincide often; one key has most rows."""
    pick = random.Random(seed)
    rows = []
    for seq in range(count):
        key = keys[0] if pick.random() < hot else pick.choice(keys[1:])
        rows.append((key, float(pick.randrange(1, span)), seq, pick.choice(kinds)))
    return rows


def by_key(rows):
    groups = {}
    for key, at, seq, kind in rows:
        groups.setdefault(key, []).append((at, seq, kind))
    return {key: sorted(events) for key, events in groups.items()}


def seconds(column):
    return (F.unix_micros(column) / SECOND).cast("double")


def collected(frame, *columns):
    return Counter(tuple(row) for row in frame.select(*columns).collect())


def model_strict_next(rows, first, second, within):
    found = Counter()
    for key, events in by_key(rows).items():
        for one, other in zip(events, events[1:]):
            if one[2] == first and other[2] == second and other[0] - one[0] < within:
                found[key, one[1], other[1]] += 1
    return found


def model_followed_by(rows, first, second, within):
    found = Counter()
    for key, events in by_key(rows).items():
        for place, one in enumerate(events):
            if one[2] != first:
                continue
            later = next((event for event in events[place + 1:] if event[2] == second), None)
            if later and later[0] - one[0] < within:
                found[key, "matched", one[1], later[1]] += 1
            else:
                found[key, "timeout", one[1], None] += 1
    return found


def model_lifecycle(rows, within, legacy=False):
    """State, deadline and timers of one order at a time."""
    found = Counter()
    for key, events in by_key(rows).items():
        state, deadline, timers = None, None, set()

        def fire(until):
            nonlocal state, deadline
            while timers and min(timers) < until:
                time = min(timers)
                timers.remove(time)
                found[key, "orphan" if state == "paid" else "timeout", time] += 1
                state = deadline = None

        for at, _, kind in events:
            fire(at)
            if kind == "create":
                if state == "paid":
                    found[key, "payed", at] += 1
                    timers.discard(deadline)
                    state = deadline = None
                else:
                    if not legacy:
                        timers.discard(deadline)
                    state, deadline = "created", at + within
                    timers.add(deadline)
            elif kind == "pay":
                if state:
                    found[key, "payed" if deadline > at else "late", at] += 1
                    timers.discard(deadline)
                    state = deadline = None
                else:
                    state, deadline = "paid", at
                    timers.add(at)
        fire(float("inf"))
    return found


def model_match(rows, within):
    """Rows of kind L and R; left comes first on equal times."""
    found = Counter()
    for key, events in by_key(rows).items():
        waiting = None
        for at, seq, kind in sorted(events, key=lambda event: (event[0], event[2], event[1])):
            if waiting and at - waiting[0] > within:
                found[_alone(key, waiting)] += 1
                waiting = None
            if waiting and waiting[2] != kind:
                left, right = (waiting, (at, seq)) if kind == "R" else ((at, seq), waiting)
                found[key, "matched", left[1], right[1]] += 1
                waiting = None
            else:
                if waiting:
                    found[_alone(key, waiting, "replaced")] += 1
                waiting = (at, seq, kind)
        if waiting:
            found[_alone(key, waiting)] += 1
    return found


def _alone(key, row, tag=None):
    if row[2] == "L":
        return key, tag or "unmatchedPays", row[1], None
    return key, tag or "unmatchedReceipts", None, row[1]
