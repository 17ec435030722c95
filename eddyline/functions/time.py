"""Durations and event-time expressions."""

from __future__ import annotations

import re
from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

Duration = str | timedelta

_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
}

# The shapes a time has in the access log (day/month/year, of four
# or two digits) and the traffic log, and how to rearrange each for a cast.
_ACCESS_LOG_TIME = {
    r"^(\d{1,2})/(\d{1,2})/(\d{4}):(\d{1,2}:\d{1,2}:\d{1,2})$": "$3-$2-$1 $4",
    r"^(\d{1,2})/(\d{1,2})/(\d{2}):(\d{1,2}:\d{1,2}:\d{1,2})$": "20$3-$2-$1 $4",
}
TRAFFIC_LOG_TIME = {
    r"^(\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2})$": "$1",
}

# Layouts of a window's end in the traffic report.
LABEL_SECONDS = "yyyy-MM-dd HH:mm:ss"
LABEL_MINUTES = "yyyy-MM-dd HH:mm"


def access_log_time(pivot: int = 69) -> dict[str, str]:
    """Shapes of an access log's time; years of two digits from `pivot` on are 19xx, others 20xx."""
    shapes = dict(_ACCESS_LOG_TIME)
    if pivot < 100:
        years = "|".join(f"{year:02d}" for year in range(pivot, 100))
        shapes[rf"^(\d{{1,2}})/(\d{{1,2}})/({years}):(\d{{1,2}}:\d{{1,2}}:\d{{1,2}})$"] = "19$3-$2-$1 $4"
    return shapes


def to_micros(duration: Duration) -> int:
    """`'15 minutes'` or a timedelta as whole microseconds."""
    if isinstance(duration, timedelta):
        return duration // timedelta(microseconds=1)
    found = re.fullmatch(r"\s*(\d+)\s+([a-z]+?)s?\s*", duration)
    if not found or found[2] not in _UNIT_MICROS:
        raise ValueError(f"not a duration: {duration!r}")
    return int(found[1]) * _UNIT_MICROS[found[2]]


def micros(time: str | Column) -> Column:
    """Event time as microseconds since the epoch."""
    column = F.col(time) if isinstance(time, str) else time
    return F.unix_micros(column.cast("timestamp"))


def from_micros(column: str | Column) -> Column:
    return F.timestamp_micros(column)


def floor_div(value: Column, width: int) -> Column:
    """Integer division that rounds down, also before the epoch."""
    return F.call_function("div", value - F.pmod(value, F.lit(width)), F.lit(width))


def from_epoch_seconds(column: Column) -> Column:
    return F.timestamp_seconds(column)


def parse_time(text: Column, shapes: dict[str, str]) -> Column:
    """Text to event time by the shape it has; NULL when it has none of them.

    A cast reads many times more texts per second than a pattern-driven parser,
    which also raises and swallows an exception for each text it cannot read.
    """
    time = F.lit(None).cast("timestamp")
    for shape, arranged in shapes.items():
        read = F.regexp_replace(text, shape, arranged).try_cast("timestamp")
        time = F.when(text.rlike(shape), read).otherwise(time)
    return time


def time_label(time: Column, layout: str = LABEL_SECONDS) -> Column:
    return F.date_format(time, layout)
