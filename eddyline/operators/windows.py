"""Windowed counts and sums.

Windows are aligned to the epoch and closed on the left: a row exactly at a
window's end belongs to the next window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eddyline.functions.time import Duration, floor_div, from_micros, micros, to_micros

# Width of a slice in multiples of the window: one pane in as many is in two.
_SLICE_WINDOWS = 8


def window_aggregate(
    events: DataFrame, keys: list[str], aggregates: list[Column],
    time: str, size: Duration, slide: Duration | None = None, window: str | None = None,
) -> DataFrame:
    """Aggregates per window and key, on batch and streaming input.

    Partial aggregation runs before the shuffle, so a key that holds most of
    the rows costs each task one row per window. The result has the window's end, or
    under the name `window` the whole window, which a further aggregation of a stream needs.
    """
    width = f"{to_micros(size)} microseconds"
    step = f"{to_micros(slide)} microseconds" if slide else None
    grouped = events.groupBy(F.window(time, width, step).alias("window"), *keys).agg(*aggregates)
    bounds = F.col("window").alias(window) if window else F.col("window.end").alias("window_end")
    return grouped.select(bounds, *keys, *[name for name in grouped.columns if name not in ("window", *keys)])


def window_count(
    events: DataFrame, keys: list[str], time: str, size: Duration, slide: Duration | None = None,
    window: str | None = None,
) -> DataFrame:
    return window_aggregate(events, keys, [F.count(F.lit(1)).alias("count")], time, size, slide, window)


def window_sum(
    events: DataFrame, keys: list[str], value: str, time: str, size: Duration,
    slide: Duration | None = None, name: str | None = None, window: str | None = None,
) -> DataFrame:
    total = F.sum(value).alias(name or value)
    return window_aggregate(events, keys, [total], time, size, slide, window)


def sliding_count(
    events: DataFrame, keys: list[str], time: str, size: Duration, slide: Duration,
) -> DataFrame:
    """Rows per sliding window and key, for bounded input.

    `window_count` copies each row into every window that covers it. Here rows
    are first counted per pane (one slide wide, combined before the shuffle); a
    pane then adds its count when it enters the windows and takes it away when it
    leaves. A running sum per key gives the count between two such changes, and
    only the finished runs are spread over their windows, so no second
    aggregation is needed. The running sums are split by slices of time as well
    as by key: few keys still make many tasks, and a slice holds at most two
    changes per key and pane, whatever the number of rows.
    """
    step, width = to_micros(slide), to_micros(size)
    if width % step:
        return window_count(events, keys, time, size, slide)
    panes = width // step
    span = _SLICE_WINDOWS * panes
    counted = (
        events.filter(F.col(time).isNotNull())
        .groupBy(*keys, floor_div(micros(time), step).alias("_pane"))
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    enters, leaves = F.col("_pane") + 1, F.col("_pane") + 1 + panes
    sliced = counted.select(
        *keys, "_rows", enters.alias("_enters"), leaves.alias("_leaves"),
        F.explode(F.sequence(floor_div(enters, span), floor_div(leaves - 1, span))).alias("_slice"),
    )
    start = F.col("_slice") * span
    changes = sliced.select(
        *keys, "_slice",
        F.inline(
            F.array(
                F.struct(F.greatest("_enters", start).alias("_at"), F.col("_rows").alias("_change")),
                F.struct(F.least("_leaves", start + span).alias("_at"), (-F.col("_rows")).alias("_change")),
            )
        ),
    )
    # From here on rows multiply by up to `panes`, which the input's size does
    # not show: a fixed number of partitions keeps Spark from merging them.
    tasks = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_key = Window.partitionBy(*keys, "_slice").orderBy("_at")
    runs = changes.repartition(tasks, *keys, "_slice").select(
        *keys, "_at",
        F.sum("_change").over(by_key.rowsBetween(Window.unboundedPreceding, 0)).alias("count"),
        F.lead("_at").over(by_key).alias("_until"),
    ).filter((F.col("count") > 0) & (F.col("_until") > F.col("_at")))
    ends = runs.select(
        *keys, "count", F.explode(F.sequence("_at", F.col("_until") - 1)).alias("_end"),
    )
    return ends.select(from_micros(F.col("_end") * step).alias("window_end"), *keys, "count")
