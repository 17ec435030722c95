"""Watermarks and lateness."""

from __future__ import annotations

from pyspark.sql import DataFrame

from eddyline.functions.time import Duration, to_micros


def watermark(
    events: DataFrame, time: str, bound: Duration, lateness: Duration = "0 seconds",
) -> DataFrame:
    """Expect rows up to `bound` out of order, and keep windows open for `lateness` more.

    A stream that appends reports each window once, complete, after both delays;
    one that updates reports early and again when late rows change a window.
    Later rows are dropped and counted in the query's progress. A stream's first
    watermark is the epoch, so rows from 1970-01-01 00:00:00 or before count as late.
    """
    delay = to_micros(bound) + to_micros(lateness)
    return events.withWatermark(time, f"{delay} microseconds")


def ascending(events: DataFrame, time: str) -> DataFrame:
    """Expect rows in order of time; rows as late as the latest one still count."""
    return events.withWatermark(time, "1 millisecond")
