"""Keyed stateful processing with event-time timers.

What an operator does to the rows of a key in event-time order is a `Sequence`: small steps over
the few rows a key holds on to. Two ways run one on a stream, whose rows come in no particular
order.

* `InOrder` keeps a key's rows until the watermark has passed them and then takes the steps. They
  wait in buckets of time, so a step reads and deletes the buckets that are due and leaves the
  others alone, however long rows have to wait.
* `Slices` and `Compose` split a key's history by time. `Slices` runs once per key and slice of
  time, when the slice is over, and takes its steps without knowing what came before. That can
  change only what happens up to a certain point, and in one of two ways, so both are worked
  out. `Compose` sees one summary per slice, lets what the key holds meet the slice's first row,
  and picks the way that follows from it. All rows of a slice but its first go past it unread.

`InOrder`, `Slices` and `Compose` speak to the state store several times per key, which is too
slow for many keys. `Buckets` takes `Compose`'s part for many keys at once: a window aggregation
gathers the rows of a key and slice, `summaries` works out finished slices batch by batch, and
what the keys of one bucket hold is read and written together. That happens when slices end, and
a bucket holds nothing older than the bound, which is at most a few dozen slices.

A key has one timer at a time: a new one that comes earlier replaces it.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Callable, Iterator
from json.encoder import encode_basestring_ascii
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from eddyline.operators.lifecycle import LATE, ORPHAN, PAYED
from eddyline.operators.lifecycle import TIMEOUT as ORDER_TIMEOUT
from eddyline.operators.patterns import MATCHED, TIMEOUT
from eddyline.operators.reconcile import REPLACED, UNMATCHED_PAYS, UNMATCHED_RECEIPTS

ROW_SCHEMA = "t long, seq long, kind int, payload string"
COLUMNS_SCHEMA = "t array<long>, seq array<long>, kind array<int>, payload array<string>"
HELD_SCHEMA = "rows array<struct<t: long, seq: long, kind: int, payload: string>>"
OUTPUT_SCHEMA = "tag string, first_t long, first string, second_t long, second string"
OUTCOMES_SCHEMA = "array<struct<tag: string, first_t: long, first: string, second_t: long, second: string>>"
SUMMARY_SCHEMA = (
    "slice long, closed_at timestamp, entry string, always string, "
    "kept string, cleared string, held_kept string, held_cleared string"
)
BUCKET_SUMMARY_SCHEMA = (
    "bucket int, key string, slice long, "
    "entry string, always string, kept string, cleared string, held_kept string, held_cleared string"
)

FIRST, SECOND = 1, 2


class Row(NamedTuple):
    """One event: time in microseconds, order among equals, role, other columns as JSON."""

    t: int
    seq: int
    kind: int
    payload: str | None


class Outcome(NamedTuple):
    tag: str
    first: Row | None = None
    second: Row | None = None


class Summary(NamedTuple):
    """What a slice of a key's history amounts to.

    `entry` is the row that meets what the key holds. `always` happens in any case; what else
    happens, and what is held at the end, depends on whether anything is held after the entry.
    """

    entry: Row | None
    always: list[Outcome]
    found: dict[bool, list[Outcome]]
    held: dict[bool, list[Row]]


def _wake_at(time: int) -> int:
    """A millisecond at which the watermark has surely passed `time`."""
    return time // 1000 + 1


class Sequence:
    """The steps of an operator over a key's rows in order."""

    def __init__(self, within: int):
        self.within = within

    def order(self, row: Row) -> tuple:
        return row.t, row.seq

    def expire(self, held: list[Row], until: int) -> tuple[list[Row], list[Outcome]]:
        """What becomes of the held rows once no row before `until` can come."""
        raise NotImplementedError

    def step(self, held: list[Row], row: Row) -> tuple[list[Row], list[Outcome]]:
        raise NotImplementedError

    def due(self, held: list[Row]) -> int:
        """Earliest time at which `expire` has something to do."""
        return min(row.t for row in held)

    def advance(self, held: list[Row], row: Row) -> tuple[list[Row], list[Outcome]]:
        held, expired = self.expire(held, row.t)
        held, found = self.step(held, row)
        return held, expired + found

    def summarise(self, rows: list[Row]) -> Summary:
        """The rows of a slice, in order.

        After a row, a key holds that row or nothing, whatever it held before; the step of the
        first row is therefore left to `absorb`, and the others follow from both.
        """
        held = {True: self.step([], rows[0])[0], False: []}
        always: list[Outcome] = []
        found: dict[bool, list[Outcome]] = {True: [], False: []}
        for row in rows[1:]:
            if held[True] == held[False]:
                held[True], more = self.advance(held[True], row)
                held[False] = held[True]
                always += more
            else:
                for way in held:
                    held[way], more = self.advance(held[way], row)
                    found[way] += more
        return Summary(rows[0], always, found, held)

    def enter(self, held: list[Row], entry: Row | None) -> tuple[bool, list[Row], list[Outcome]]:
        """Let the entry meet what is held: which way the slice goes, what is held on to beside
        what the slice leaves, and what happened."""
        held, outcomes = self.advance(held, entry)
        return bool(held), [], outcomes


def _loaded(text: str) -> list[Row]:
    return [Row(*values) for values in json.loads(text)] if text != "[]" else []


def _quoted(text: str | None) -> str:
    return "null" if text is None else encode_basestring_ascii(text)


def _row_text(row: Row) -> str:
    """A row as `json.dumps` writes it, in a fraction of the time."""
    return f"[{row.t}, {row.seq}, {row.kind}, {_quoted(row.payload)}]"


def _rows_text(rows: list[Row]) -> str:
    return f"[{', '.join(map(_row_text, rows))}]"


def _outcome_text(one: Outcome) -> str:
    first, second = (
        f"{row.t}, {name}: {_quoted(row.payload)}" if row else f"null, {name}: null"
        for row, name in ((one.first, '"first"'), (one.second, '"second"'))
    )
    return f'{{"tag": {_quoted(one.tag)}, "first_t": {first}, "second_t": {second}}}'


def _packed(outcomes: list[Outcome]) -> str:
    return f"[{', '.join(map(_outcome_text, outcomes))}]" if outcomes else ""


def _flat(one: Outcome) -> tuple:
    parts = [(row.t, row.payload) if row else (None, None) for row in (one.first, one.second)]
    return one.tag, *parts[0], *parts[1]


OUTPUT_NAMES = ["tag", "first_t", "first", "second_t", "second"]

SUMMARY_NAMES = ["entry", "always", "kept", "cleared", "held_kept", "held_cleared"]


def _summary_texts(summary: Summary) -> tuple:
    """A summary as columns of text."""
    return (
        _row_text(summary.entry) if summary.entry else None, _packed(summary.always),
        _packed(summary.found[True]), _packed(summary.found[False]),
        _rows_text(summary.held[True]), _rows_text(summary.held[False]),
    )


def _rows_of(frame: pd.DataFrame) -> list[tuple]:
    return list(zip(*[frame[name].astype(object).tolist() for name in Row._fields], strict=True))


class InOrder(StatefulProcessor):
    """A sequence over all rows of a key, taken up to the watermark.

    Rows wait in buckets `bucket` microseconds wide. Of a bucket, each micro-batch that brings
    rows for it writes a part of its own.
    """

    def __init__(self, keys: list[str], sequence: Sequence, bucket: int):
        self.keys = keys
        self.sequence = sequence
        self.bucket = bucket

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "bucket long, part long", COLUMNS_SCHEMA)
        self.progress = handle.getValueState(
            "progress", "buckets array<long>, parts array<long>, firsts array<long>, alarm long",
        )
        self.held = handle.getValueState("held", HELD_SCHEMA)

    def close(self) -> None:
        pass

    def _pending(self) -> tuple[dict[int, tuple[int, int]], int | None]:
        """Parts and earliest time of each bucket, and the timer."""
        known = self.progress.get()
        if known is None:
            return {}, None
        buckets, parts, firsts, alarm = known
        return dict(zip(buckets, zip(parts, firsts, strict=True), strict=True)), alarm

    def _remember(self, pending: dict[int, tuple[int, int]], alarm: int | None, held: list[Row], fired: int) -> None:
        """Keep the progress and a timer for whatever is due next; one that no longer counts goes."""
        due = [first for _, first in pending.values()] + ([self.sequence.due(held)] if held else [])
        wanted = _wake_at(min(due)) if due else None
        if alarm is not None and alarm > fired and alarm != wanted:
            self.handle.deleteTimer(alarm)
        if wanted is not None and (alarm != wanted or alarm <= fired):
            self.handle.registerTimer(wanted)
        if wanted is None:
            self.progress.clear()
        else:
            buckets = sorted(pending)
            self.progress.update((
                buckets, [pending[name][0] for name in buckets], [pending[name][1] for name in buckets], wanted,
            ))

    def _put(self, pending: dict[int, tuple[int, int]], bucket: int, rows: list[tuple]) -> None:
        parts, first = pending.get(bucket, (0, None))
        self.waiting.updateValue((bucket, parts), tuple(list(column) for column in zip(*rows, strict=True)))
        least = min(row[0] for row in rows)
        pending[bucket] = parts + 1, least if first is None else min(first, least)

    def _take(self, pending: dict[int, tuple[int, int]], bucket: int) -> list[Row]:
        rows = []
        for part in range(pending.pop(bucket)[0]):
            rows += map(Row, *self.waiting.getValue((bucket, part)))
            self.waiting.removeKey((bucket, part))
        return rows

    def _held(self) -> list[Row]:
        known = self.held.get()
        return [Row(*row) for row in known[0]] if known else []

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pending, alarm = self._pending()
        for frame in rows:
            buckets = frame["t"].to_numpy() // self.bucket
            order = np.argsort(buckets, kind="stable")
            arrived = _rows_of(frame.iloc[order])
            starts = np.flatnonzero(np.diff(buckets[order], prepend=buckets[order[0]] - 1))
            for start, end in zip(starts, [*starts[1:], len(arrived)], strict=True):
                self._put(pending, int(buckets[order[start]]), arrived[start:end])
        self._remember(pending, alarm, self._held(), -1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        pending, alarm = self._pending()
        held, outcomes = self._held(), []
        for bucket in sorted(name for name, (_, first) in pending.items() if first <= passed):
            rows = self._take(pending, bucket)
            later = [row for row in rows if row.t > passed]
            if later:
                self._put(pending, bucket, later)
            for row in sorted([row for row in rows if row.t <= passed], key=self.sequence.order):
                held, found = self.sequence.advance(held, row)
                outcomes += found
        held, expired = self.sequence.expire(held, passed + 1)
        outcomes += expired
        if held:
            self.held.update(([tuple(row) for row in held],))
        else:
            self.held.clear()
        self._remember(pending, alarm, held, expiredTimerInfo.getExpiryTimeInMs())
        if outcomes:
            yield pd.DataFrame(
                [(*key, *_flat(one)) for one in outcomes], columns=[*self.keys, *OUTPUT_NAMES], dtype=object,
            )


class Slices(StatefulProcessor):
    """A sequence's summary of one slice of a key, once the watermark has passed the slice.

    The last of `keys` is the slice's number. Rows are written as they come and read once.
    """

    def __init__(self, keys: list[str], sequence: Sequence, span: int):
        self.keys = keys
        self.sequence = sequence
        self.span = span

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", ROW_SCHEMA)

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if not self.rows.exists():
            self.handle.registerTimer(_wake_at((key[-1] + 1) * self.span))
        for frame in rows:
            self.rows.appendList(_rows_of(frame))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        rows = sorted([Row(*values) for values in self.rows.get()], key=self.sequence.order)
        self.rows.clear()
        summary = _summary_texts(self.sequence.summarise(rows))
        # The watermark reaches the timer only now, so this time is beyond the one before.
        closed = pd.Timestamp(expiredTimerInfo.getExpiryTimeInMs() + 1, unit="ms", tz="UTC")
        yield pd.DataFrame({
            **{name: [value] for name, value in zip(self.keys[:-1], key, strict=False)},
            "slice": [key[-1]], "closed_at": [closed],
            **{name: [text] for name, text in zip(SUMMARY_NAMES, summary, strict=True)},
        })


def _past_slice(sequence: Sequence, held: list[Row], summary) -> tuple[list[Row], list[str]]:
    """What is held after a slice, and the packed outcomes up to its end."""
    entry = Row(*json.loads(summary.entry)) if summary.entry else None
    way, beside, found = sequence.enter(held, entry)
    rest = summary.held_kept if way else summary.held_cleared
    left = [entry] if entry and rest == f"[{summary.entry}]" else _loaded(rest)
    return beside + left, [_packed(found), summary.always, summary.kept if way else summary.cleared]


class Compose(StatefulProcessor):
    """The outcomes of a key from the summaries of its slices, as JSON arrays of outcomes."""

    def __init__(self, keys: list[str], sequence: Sequence, span: int):
        self.keys = keys
        self.sequence = sequence
        self.span = span

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", HELD_SCHEMA)
        self.alarm = handle.getValueState("alarm", "at long, slice long")

    def close(self) -> None:
        pass

    def _known(self) -> list[Row]:
        known = self.held.get()
        return [Row(*row) for row in known[0]] if known else []

    def _keep(self, held: list[Row]) -> None:
        """Held rows expire when the slice in which they are due is over, and its summary here."""
        if not held:
            self.held.clear()
            self.alarm.clear()
            return
        self.held.update(([tuple(row) for row in held],))
        over = self.sequence.due(held) // self.span + 1
        at = _wake_at(over * self.span) + 2
        self.handle.registerTimer(at)
        self.alarm.update((at, over))

    def _frame(self, key, texts: list[str]) -> pd.DataFrame:
        return pd.DataFrame([(*key, text) for text in texts], columns=[*self.keys, "outcomes"], dtype=object)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held, alarm, texts = self._known(), self.alarm.get(), []
        if alarm is not None:
            self.handle.deleteTimer(alarm[0])
        for one in pd.concat(list(rows)).sort_values("slice").itertuples(index=False):
            held, more = _past_slice(self.sequence, held, one)
            texts += more
        self._keep(held)
        texts = [text for text in texts if text]
        if texts:
            yield self._frame(key, texts)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        alarm = self.alarm.get()
        if alarm is None:
            return
        held, expired = self.sequence.expire(self._known(), alarm[1] * self.span)
        self._keep(held)
        if expired:
            yield self._frame(key, [_packed(expired)])


def summaries(sequence: Sequence) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For `mapInArrow`: the summary of each finished slice, whose rows come as the list `rows`."""
    names = ["bucket", "key", "slice"]

    def summarised(batches):
        for batch in batches:
            gathered = batch.column("rows")
            parts = dict(zip([field.name for field in gathered.type.value_type], gathered.flatten().flatten(), strict=True))
            rows = list(map(Row, *[parts[name].to_pylist() for name in Row._fields]))
            texts, start = [], 0
            for size in gathered.value_lengths().to_pylist():
                ordered = rows[start:start + size]
                if size > 1:
                    ordered.sort(key=sequence.order)
                texts.append(_summary_texts(sequence.summarise(ordered)))
                start += size
            if texts:
                columns = [pa.array(column, pa.string()) for column in zip(*texts, strict=True)]
                yield pa.RecordBatch.from_arrays([*map(batch.column, names), *columns], [*names, *SUMMARY_NAMES])

    return summarised


class FinishedSlice(NamedTuple):
    """A slice of a key as `summaries` hands it on."""

    key: str
    slice: int
    entry: str | None
    always: str | None
    kept: str | None
    cleared: str | None
    held_kept: str | None
    held_cleared: str | None


class RowsOfSlice(NamedTuple):
    key: str
    slice: int
    rows: str


class Buckets(StatefulProcessor):
    """The outcomes of a bucket of keys from their finished slices, as JSON arrays of outcomes.

    Slices come as summaries or, unless `summarised`, as JSON arrays of their rows. All slices
    that the watermark has passed come in the micro-batch in which it does, so what is due in
    them expires at once; what is due later waits for a timer at the end of its slice.
    """

    def __init__(self, sequence: Sequence, span: int, summarised: bool = True):
        self.sequence = sequence
        self.span = span
        self.past = self._past_summary if summarised else self._past_rows
        self.slices = FinishedSlice if summarised else RowsOfSlice

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "rows string, alarm long")

    def close(self) -> None:
        pass

    def _past_summary(self, held: list[Row], one) -> tuple[list[Row], list[str]]:
        return _past_slice(self.sequence, held, one)

    def _past_rows(self, held: list[Row], one) -> tuple[list[Row], list[str]]:
        outcomes = []
        for row in sorted([Row(**row) for row in json.loads(one.rows)], key=self.sequence.order):
            held, found = self.sequence.advance(held, row)
            outcomes += found
        return held, [_packed(outcomes)]

    def _known(self) -> tuple[dict[str, list[Row]], int | None]:
        known = self.held.get()
        if known is None:
            return {}, None
        rows, alarm = known
        return {key: [Row(*row) for row in held] for key, held in json.loads(rows).items()}, alarm

    def _settled(
        self, holding: dict[str, list[Row]], alarm: int | None, fired: int | None, watermark: int,
        found: list[tuple[str, str]],
    ) -> Iterator[pd.DataFrame]:
        """Let go what is due in slices that are over, and keep the rest with a timer."""
        until = watermark * 1000 // self.span * self.span
        kept, due = {}, None
        for key, held in holding.items():
            held, expired = self.sequence.expire(held, until)
            if expired:
                found.append((key, _packed(expired)))
            if held:
                kept[key] = held
                first = self.sequence.due(held)
                due = first if due is None else min(due, first)
        wanted = None if due is None else max(_wake_at((due // self.span + 1) * self.span), watermark + 1)
        if alarm is not None and alarm not in (wanted, fired):
            self.handle.deleteTimer(alarm)
        if wanted is None:
            self.held.clear()
        else:
            if wanted != alarm:
                self.handle.registerTimer(wanted)
            self.held.update((json.dumps(kept), wanted))
        if found:
            yield pd.DataFrame(found, columns=["key", "outcomes"], dtype=object)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        holding, alarm = self._known()
        slices: list[NamedTuple] = []
        found: list[tuple[str, str]] = []
        for frame in rows:
            slices += map(self.slices, *[frame[name].tolist() for name in self.slices._fields])
        for one in sorted(slices, key=lambda one: one.slice):
            holding[one.key], texts = self.past(holding.get(one.key, []), one)
            found += [(one.key, text) for text in texts if text]
        yield from self._settled(holding, alarm, None, timerValues.getCurrentWatermarkInMs(), found)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        holding, alarm = self._known()
        fired = expiredTimerInfo.getExpiryTimeInMs()
        yield from self._settled(holding, alarm, fired, timerValues.getCurrentWatermarkInMs(), [])


class Silence(StatefulProcessor):
    """Reports a key after which nothing comes for `within`: its last row and when the time is up.

    A key holds its last row's time, and a timer for when silence would be complete. A further
    row takes the timer away and sets another; a timer that is reached is a report. Rows of a
    key come in order from batch to batch; within a batch they are put in order here.
    """

    def __init__(self, keys: list[str], within: int):
        self.keys = keys
        self.within = within

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "t long")

    def close(self) -> None:
        pass

    def _frame(self, key, times: list[int]) -> pd.DataFrame:
        return pd.DataFrame(
            [(*key, time, time + self.within) for time in times], columns=[*self.keys, "last_t", "silent_t"],
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = self.last.get()
        times = sorted(time for frame in rows for time in frame["t"].tolist())
        if known is not None:
            self.handle.deleteTimer(_wake_at(known[0] + self.within))
            times = sorted([known[0], *times])
        self.last.update((times[-1],))
        self.handle.registerTimer(_wake_at(times[-1] + self.within))
        silent = [time for time, after in zip(times, times[1:]) if after - time >= self.within]
        if silent:
            yield self._frame(key, silent)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        known = self.last.get()
        if known is not None:
            self.last.clear()
            yield self._frame(key, [known[0]])


class StrictNext(Sequence):
    """Holds the last row of the key."""

    def due(self, held):
        return held[0].t + self.within

    def expire(self, held, until):
        return [row for row in held if row.t + self.within > until], []

    def step(self, held, row):
        matches = [
            Outcome(MATCHED, last, row)
            for last in held
            if last.kind & FIRST and row.kind & SECOND
        ]
        return [row], matches


class FollowedBy(Sequence):
    """Holds the first events that have not been followed yet."""

    def due(self, held):
        return min(row.t for row in held) + self.within

    def expire(self, held, until):
        over = [row for row in held if row.t + self.within <= until]
        return [row for row in held if row.t + self.within > until], [
            Outcome(TIMEOUT, row) for row in over
        ]

    def step(self, held, row):
        matches = []
        if row.kind & SECOND:
            matches = [Outcome(MATCHED, one, row) for one in held]
            held = []
        if row.kind & FIRST:
            held = [*held, row]
        return held, matches

    def summarise(self, rows):
        """First events that come from before are settled by the slice's first second event."""
        held: list[Row] = []
        always: list[Outcome] = []
        for row in rows:
            held, found = self.advance(held, row)
            always += found
        entry = next((row for row in rows if row.kind & SECOND), None)
        return Summary(entry, always, {True: [], False: []}, {True: held, False: held})

    def enter(self, held, entry):
        if entry is None:
            return True, held, []
        held, outcomes = self.expire(held, entry.t)
        return True, [], outcomes + [Outcome(MATCHED, one, entry) for one in held]


class Lifecycle(Sequence):
    """Holds the waiting creation or payment, as a row whose time is its deadline.

    With `legacy_timers` the deadline of a repeated creation does not replace
    the earlier one, which stays behind and ends whatever waits when it comes.
    """

    CREATED, PAID, LEFT_BEHIND = 1, 0, 2

    def __init__(self, within: int, legacy_timers: bool = False):
        super().__init__(within)
        self.legacy_timers = legacy_timers

    def _outcome(self, tag: str, time: int) -> Outcome:
        return Outcome(tag, Row(time, 0, 0, None))

    def expire(self, held, until):
        outcomes = []
        for time in sorted({row.t for row in held if row.t < until}):
            paid = any(row.kind == self.PAID for row in held)
            outcomes.append(self._outcome(ORPHAN if paid else ORDER_TIMEOUT, time))
            # The timers left are those to come; whatever waited is settled.
            held = [
                row._replace(kind=self.LEFT_BEHIND) for row in held
                if row.t > time and (self.legacy_timers or row.kind == self.LEFT_BEHIND)
            ]
        return held, outcomes

    def step(self, held, row):
        behind = [one for one in held if one.kind == self.LEFT_BEHIND]
        waiting = next((one for one in held if one.kind != self.LEFT_BEHIND), None)
        if row.kind == self.CREATED:
            if waiting and waiting.kind == self.PAID:
                return self._without(behind, waiting), [self._outcome(PAYED, row.t)]
            if waiting and self.legacy_timers:
                behind = [*behind, waiting._replace(kind=self.LEFT_BEHIND)]
            return [*behind, row._replace(t=row.t + self.within)], []
        if waiting:
            tag = PAYED if waiting.t > row.t else LATE
            return self._without(behind, waiting), [self._outcome(tag, row.t)]
        return [*behind, row], []

    @staticmethod
    def _without(behind: list[Row], waiting: Row) -> list[Row]:
        """Timers are one per time: ending this one ends a coinciding one as well."""
        return [row for row in behind if row.t != waiting.t]


class Match(Sequence):
    """Holds the row that waits for the other side; kind 0 is left, 1 is right."""

    def __init__(self, within: int, keep_replaced: bool = False):
        super().__init__(within)
        self.keep_replaced = keep_replaced

    def order(self, row):
        return row.t, row.kind, row.seq

    def due(self, held):
        return held[0].t + self.within

    def _alone(self, tag: str, row: Row) -> Outcome:
        return Outcome(tag, None, row) if row.kind else Outcome(tag, row)

    def expire(self, held, until):
        if held and held[0].t + self.within < until:
            tag = UNMATCHED_RECEIPTS if held[0].kind else UNMATCHED_PAYS
            return [], [self._alone(tag, held[0])]
        return held, []

    def step(self, held, row):
        if held and held[0].kind != row.kind:
            left, right = (held[0], row) if row.kind else (row, held[0])
            return [], [Outcome(MATCHED, left, right)]
        replaced = [self._alone(REPLACED, one) for one in held if self.keep_replaced]
        return [row], replaced


# Send the classes themselves to the Python workers, which need not have this
# package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
