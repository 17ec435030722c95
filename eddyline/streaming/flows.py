"""Streaming forms of the order-dependent analyses.

Windows, traffic sums and relational views need no form of their own: the batch
functions take streams. Inputs carry a watermark (see `eventtime`). A result
appears when the watermark has passed everything it depends on, hence results
equal those of the batch forms over the same rows.

Keys are split into slices of time, as in batch: the rows of one key are worked
on in as many tasks as it has slices, and only one summary per slice comes
together. A result then waits for the end of its slice as well; `split=False`
works on whole keys and reports as soon as the watermark allows.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.internal import InternalFunction
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from eddyline.functions.report import ReportLayout, report_text
from eddyline.functions.time import Duration, floor_div, from_micros, micros, to_micros
from eddyline.operators.lifecycle import message
from eddyline.operators.ranking import top_n
from eddyline.operators.reconcile import MATCHED, UNMATCHED_PAYS, UNMATCHED_RECEIPTS
from eddyline.operators.slices import slice_micros
from eddyline.streaming.processors import (
    BUCKET_SUMMARY_SCHEMA,
    FIRST,
    OUTCOMES_SCHEMA,
    OUTPUT_SCHEMA,
    SECOND,
    Buckets,
    FollowedBy,
    InOrder,
    Lifecycle,
    Match,
    Sequence,
    StrictNext,
    summaries,
)
from eddyline.streaming.sinks import BatchFunction


#: Counts that a sliding window's state keeps side by side, at most.
_MOST_TOGETHER = 60


def sliding_count(
    events: DataFrame, keys: list[str], time: str, size: Duration, slide: Duration, together: int | None = None,
) -> DataFrame:
    """`windows.sliding_count` on a stream: rows per sliding window and key.

    Windows that start one after the other are counted side by side in one entry of state: a row
    updates two to four entries, not one per window that covers it. They are reported when the
    last of them is over. `together` says how many: by default half of those that cover a row, so
    a window waits for at most half its size; with 1 each is reported by itself.
    `slice` spans the windows of an entry and carries the watermark.
    """
    width, step = to_micros(size), to_micros(slide)
    if together is None:
        together = min(max(width // step // 2, 1), _MOST_TOGETHER)
    span = f"{width + (together - 1) * step} microseconds"
    sliced = events.withColumn("slice", F.window(time, span, f"{together * step} microseconds"))
    start, at = micros("slice.start"), micros(time)
    starts = [start + place * step for place in range(together)]
    inside = [F.sum(((at >= one) & (at < one + width)).cast("long")).alias(f"_{place}") for place, one in enumerate(starts)]
    entries = [
        F.struct(
            F.struct(from_micros(one).alias("start"), from_micros(one + width).alias("end")).alias("window"),
            F.col(f"_{place}").alias("count"),
        )
        for place, one in enumerate(starts)
    ]
    counted = sliced.groupBy("slice", *keys).agg(*inside)
    return counted.select("slice", *keys, F.inline(F.array(*entries))).filter(F.col("count") > 0)


def _by_window(counts: DataFrame, window: str) -> list[str]:
    """What to group finished windows by: of several reported together, `slice` has the watermark."""
    return ["slice", window] if "slice" in counts.columns else [window]


def top_windows(
    counts: DataFrame, n: int, key: str, count: str = "count", window: str = "window", rank: str = "rank",
) -> DataFrame:
    """The n highest counts of each finished window, ties to the smaller key, for any sink.

    `counts` is a windowed aggregate of a stream that still has its `window`. The ranking is an
    aggregation as well: every task keeps n rows per window, and lists of n are merged. Where
    windows are reported together (`sliding_count`), `slice` says which.
    """
    entry = F.struct((-F.col(count)).alias("minus"), F.col(key).alias("key"))
    least = InternalFunction.collect_top_k(entry, n, True)
    ranked = counts.groupBy(*_by_window(counts, window)).agg(least.alias("top"))
    placed = ranked.select(F.col(window)["end"].alias("window_end"), F.posexplode("top").alias("place", "entry"))
    return placed.select(
        "window_end", F.col("entry.key").alias(key), (-F.col("entry.minus")).alias(count),
        (F.col("place") + 1).alias(rank),
    )


def top_reports(
    counts: DataFrame, n: int, key: str, layout: ReportLayout, count: str = "count", window: str = "window",
) -> DataFrame:
    """The report of each finished window's n highest counts, one text per window."""
    entry = F.struct((-F.col(count)).alias("minus"), F.col(key).alias("key"))
    ranked = counts.groupBy(*_by_window(counts, window)).agg(InternalFunction.collect_top_k(entry, n, True).alias("top"))
    entries = F.transform(
        "top",
        lambda one, place: F.struct(
            (place + 1).alias("rank"), one["key"].alias("key"), (-one["minus"]).alias("count"),
        ),
    )
    end = F.col(window)["end"]
    return ranked.select(end.alias("window_end"), report_text(end, entries, layout).alias("report"))


def rank_windows(
    counts: DataFrame, n: int, write: BatchFunction, ties: list[str] | None = None,
) -> DataStreamWriter:
    """Top-N of each finished window.

    An appending windowed count releases all keys of a window in the micro-batch
    in which the watermark passes its end. Ranking each micro-batch is therefore
    exact, and can cut every task's share to n rows before the shuffle; no state
    ever holds a window's whole key set in one place.
    """

    def rank(batch: DataFrame, batch_id: int) -> None:
        write(top_n(batch, n, ties=ties), batch_id)

    return counts.writeStream.outputMode("append").foreachBatch(rank)


# Carried columns travel as JSON; times keep their microseconds.
JSON_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


#: Keys whose held rows lie together in state. More buckets are smaller, but cost more calls.
KEY_BUCKETS = 1024


def _rows(events: DataFrame, keys: list[str], time: str, seq: str | None, kind: Column,
          carry: list[str]) -> DataFrame:
    """Rows with a time and a whole key, as the processors read them; others are left out."""
    order = F.col(seq).cast("bigint") if seq else F.lit(0).cast("bigint")
    for name in [time, *keys]:
        events = events.filter(F.col(name).isNotNull())
    return events.select(
        *keys, time,
        micros(time).alias("t"),
        order.alias("seq"),
        kind.cast("int").alias("kind"),
        F.to_json(F.struct(*carry), JSON_TIMES).alias("payload") if carry else F.lit(None).cast("string").alias("payload"),
    )


def _processed(
    rows: DataFrame, keys: list[str], time: str, sequence: Sequence, split: bool, width: Duration | None,
    summarised: bool = True, buckets: int = KEY_BUCKETS,
) -> DataFrame:
    """The outcomes of a sequence: of whole keys, or composed of slices `width` long.

    The rows of a key and slice are gathered by an aggregation; finished slices then meet what
    their keys hold, a bucket of keys at a time. Unless `summarised`, slices arrive row by row.
    """
    span = slice_micros(sequence.within, width)
    if not split:
        kinds = dict(rows.dtypes)
        named = [f"`{name}` {kinds[name]}" for name in keys]
        return rows.groupBy(*keys).transformWithStateInPandas(
            InOrder(keys, sequence, span), outputStructType=", ".join([*named, OUTPUT_SCHEMA]),
            outputMode="Append", timeMode="EventTime",
        )
    gathered = rows.groupBy(*keys, F.window(time, f"{span} microseconds").alias("_window")).agg(
        F.collect_list(F.struct("t", "seq", "kind", "payload")).alias("rows"),
    ).select(
        F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket"),
        F.to_json(F.struct(*keys), JSON_TIMES).alias("key"),
        floor_div(micros("_window.start"), span).alias("slice"), "rows",
    )
    if summarised:
        parts = gathered.mapInArrow(summaries(sequence), BUCKET_SUMMARY_SCHEMA)
    else:
        parts = gathered.withColumn("rows", F.to_json("rows", {"ignoreNullFields": "false"}))
    packed = parts.groupBy("bucket").transformWithStateInPandas(
        Buckets(sequence, span, summarised), outputStructType="key string, outcomes string",
        outputMode="Append", timeMode="EventTime",
    )
    whole = F.from_json("key", StructType([rows.schema[name] for name in keys]), JSON_TIMES)
    return packed.select(
        *[whole[name].alias(name) for name in keys], F.inline(F.from_json("outcomes", OUTCOMES_SCHEMA)),
    )


def _part(side: str, time: str, events: DataFrame, carry: list[str]) -> Column:
    """A row's time and carried columns, as the batch operators return them."""
    at = from_micros(f"{side}_t").alias(time)
    if not carry:
        return F.when(F.col(f"{side}_t").isNotNull(), F.struct(at))
    schema = StructType([events.schema[name] for name in carry])
    values = F.from_json(side, schema, JSON_TIMES)
    parts = [values[name].alias(name) for name in carry]
    return F.when(F.col(f"{side}_t").isNotNull(), F.struct(at, *parts))


def _flag(condition: Column, bit: int) -> Column:
    return F.when(condition, bit).otherwise(0)


def strict_next(
    events: DataFrame, keys: list[str], time: str, first: Column, second: Column,
    within: Duration, seq: str | None = None, carry: list[str] = (), width: Duration | None = None,
    split: bool = True,
) -> DataFrame:
    """`patterns.strict_next` on a stream."""
    rows = _rows(events, keys, time, seq, _flag(first, FIRST) + _flag(second, SECOND), carry)
    found = _processed(rows, keys, time, StrictNext(to_micros(within)), split, width)
    return found.select(
        *keys,
        _part("first", time, events, carry).alias("first"),
        _part("second", time, events, carry).alias("second"),
    )


def followed_by(
    events: DataFrame, keys: list[str], time: str, first: Column, second: Column,
    within: Duration, seq: str | None = None, carry: list[str] = (), width: Duration | None = None,
    split: bool = True,
) -> DataFrame:
    """`patterns.followed_by` on a stream."""
    relevant = events.filter(first | second)
    rows = _rows(relevant, keys, time, seq, _flag(first, FIRST) + _flag(second, SECOND), carry)
    found = _processed(rows, keys, time, FollowedBy(to_micros(within)), split, width)
    return found.select(
        *keys, "tag",
        _part("first", time, events, carry).alias("first"),
        _part("second", time, events, carry).alias("second"),
    )


def lifecycle(
    events: DataFrame, keys: list[str], time: str, created: Column, paid: Column,
    within: Duration, seq: str | None = None, legacy_timers: bool = False, width: Duration | None = None,
    split: bool = True,
) -> DataFrame:
    """`lifecycle.lifecycle_strict` on a stream.

    With `legacy_timers` slices are not summarised: timers left behind tie a slice to all that
    came within the bound before. A key's rows then come together slice by slice.
    """
    relevant = events.filter(created | paid)
    kind = F.when(created, Lifecycle.CREATED).otherwise(Lifecycle.PAID)
    rows = _rows(relevant, keys, time, seq, kind, [])
    found = _processed(
        rows, keys, time, Lifecycle(to_micros(within), legacy_timers), split, width, summarised=not legacy_timers,
    )
    return found.select(
        *keys, "tag", from_micros("first_t").alias("emitted_at"), message(F.col("tag")).alias("result_msg"),
    )


def match(
    left: DataFrame, right: DataFrame, keys: list[str], time: str, within: Duration,
    left_columns: list[str], right_columns: list[str], seq: str | None = None,
    keep_replaced: bool = False, width: Duration | None = None, split: bool = True,
) -> DataFrame:
    """`reconcile.match` on two streams, exact also when keys repeat.

    Both streams carry a watermark; the slower one counts.
    """
    both = _rows(left, keys, time, seq, F.lit(0), left_columns).unionByName(
        _rows(right, keys, time, seq, F.lit(1), right_columns),
    )
    found = _processed(both, keys, time, Match(to_micros(within), keep_replaced), split, width)
    return found.select(
        *keys, "tag",
        _part("first", time, left, left_columns).alias("left"),
        _part("second", time, right, right_columns).alias("right"),
    )


def match_join(
    left: DataFrame, right: DataFrame, keys: list[str], time: str, within: Duration,
    left_columns: list[str], right_columns: list[str],
    tags: tuple[str, str] = (UNMATCHED_PAYS, UNMATCHED_RECEIPTS),
) -> DataFrame:
    """`match` where every key occurs once a side, as a join of the two streams.

    The rows wait in the join's own state until the watermarks have passed the time bound, and
    nothing leaves the JVM. Of a key that comes again on its side before the watermark forgets
    it, the first row to arrive counts; `match` is for keys that repeat. Both streams carry a
    watermark.
    """

    def side(events: DataFrame, name: str, columns: list[str]) -> DataFrame:
        present = reduce(and_, [F.col(column).isNotNull() for column in [time, *keys]])
        first = events.filter(present).dropDuplicatesWithinWatermark(keys)
        return first.select(
            *[F.col(key).alias(f"{name}_{key}") for key in keys], F.col(time).alias(f"{name}_time"),
            F.struct(time, *columns).alias(name),
        )

    reach = F.expr(f"INTERVAL '{to_micros(within) / 1_000_000:.6f}' SECOND")
    one, other = side(left, "left", left_columns), side(right, "right", right_columns)
    near = (F.col("left_time") <= F.col("right_time") + reach) & (F.col("left_time") >= F.col("right_time") - reach)
    same = reduce(and_, [F.col(f"left_{key}") == F.col(f"right_{key}") for key in keys])
    joined = one.join(other, same & near, "full_outer")
    tag = F.when(F.col("right").isNull(), tags[0]).when(F.col("left").isNull(), tags[1]).otherwise(MATCHED)
    return joined.select(
        *[F.coalesce(f"left_{key}", f"right_{key}").alias(key) for key in keys], tag.alias("tag"), "left", "right",
    )


def silence(events: DataFrame, keys: list[str], time: str, within: Duration) -> DataFrame:
    """Keys after whose row nothing comes for `within`: the keys, `last_seen` and `silent_at`.

    That is a session of the key and its end; `processors.Silence` does the same with a timer a key.
    """
    present = reduce(and_, [F.col(name).isNotNull() for name in [time, *keys]])
    reach = to_micros(within)
    # Spark joins rows that are exactly the gap apart into one session.
    gap = f"{reach - 1} microseconds"
    sessions = events.filter(present).groupBy(*keys, F.session_window(time, gap).alias("_session"))
    last = sessions.agg(F.max(micros(time)).alias("_last"))
    return last.select(
        *keys, from_micros("_last").alias("last_seen"), from_micros(F.col("_last") + reach).alias("silent_at"),
    )
