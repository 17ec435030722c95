"""Typed records from text lines.

Each parser adds the record's columns to a DataFrame with a `value` column and
marks lines that do not fit in `malformed`. `accepted` and `quarantined` split
the result, `strict` fails the job on the first bad line. Everything is a column
expression, so the parsers serve batch and streams alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.functions.text import field, fields, strip, whole_number
from eddyline.functions.time import (
    TRAFFIC_LOG_TIME,
    access_log_time,
    from_epoch_seconds,
    parse_time,
)

MALFORMED = "malformed"
RAW = "value"

_MOST_FIELDS = 7


def _record(
    lines: DataFrame, separator: str, read: Callable[[list[Column]], dict[str, Column]],
    required: list[str] | None = None,
) -> DataFrame:
    """Split each line once, read the record's columns, and mark missing ones.

    The columns come out of a generator of one row, past which Spark moves no
    filter: a test on a parsed column does not parse the line a second time.
    """
    kept = [name for name in lines.columns if name != RAW]
    split = lines.select(RAW, *kept, fields(F.col(RAW), separator).alias("_parts"))
    columns = read([field(F.col("_parts"), index) for index in range(_MOST_FIELDS)])
    record = F.struct(*[column.alias(name) for name, column in columns.items()])
    parsed = split.select(RAW, *kept, F.inline(F.array(record)))
    missing = F.lit(False)
    for name in required or columns:
        missing = missing | F.col(name).isNull()
    return parsed.withColumn(MALFORMED, missing)


def parse_behavior(lines: DataFrame) -> DataFrame:
    """user, item, category, behaviour, epoch seconds; fields are taken untrimmed."""
    return _record(lines, ",", lambda part: {
        "user_id": whole_number(part[0]),
        "item_id": whole_number(part[1]),
        "category_id": whole_number(part[2], "int"),
        "behavior": part[3],
        "event_time": from_epoch_seconds(whole_number(part[4])),
    })


def parse_login(lines: DataFrame) -> DataFrame:
    """user, ip, event type, epoch seconds; every field trimmed."""
    return _record(lines, ",", lambda part: {
        "user_id": whole_number(strip(part[0])),
        "ip": strip(part[1]),
        "event_type": strip(part[2]),
        "event_time": from_epoch_seconds(whole_number(strip(part[3]))),
    })


def parse_order(lines: DataFrame) -> DataFrame:
    """order, event type, transaction (may be empty), epoch seconds; every field trimmed."""
    return _record(lines, ",", lambda part: {
        "order_id": whole_number(strip(part[0])),
        "event_type": strip(part[1]),
        "tx_id": strip(part[2]),
        "event_time": from_epoch_seconds(whole_number(strip(part[3]))),
    })


def parse_receipt(lines: DataFrame) -> DataFrame:
    """transaction, channel, epoch seconds; the time is taken untrimmed."""
    return _record(lines, ",", lambda part: {
        "tx_id": strip(part[0]),
        "pay_channel": strip(part[1]),
        "event_time": from_epoch_seconds(whole_number(part[2])),
    })


def parse_access(lines: DataFrame, pivot: int = 69) -> DataFrame:
    """Space-separated access log: fields 0 ip, 1 user, 3 time, 5 method, 6 url.

    Years of two digits from `pivot` on are 19xx, others 20xx.
    """
    return _record(lines, " ", lambda part: {
        "ip": strip(part[0]),
        "user_id": strip(part[1]),
        "event_time": parse_time(strip(part[3]), access_log_time(pivot)),
        "method": strip(part[5]),
        "url": strip(part[6]),
    })


def parse_traffic(lines: DataFrame) -> DataFrame:
    """Tab-separated traffic log: fields 3 time, 4 ip, 5 domain, 6 traffic.

    A time that cannot be read is no malformed line: it leaves `event_time`
    NULL, for `drop_untimed` to remove.
    """
    return _record(lines, "\t", lambda part: {
        "event_time": parse_time(part[3], TRAFFIC_LOG_TIME),
        "ip": part[4],
        "domain": part[5],
        "traffic": whole_number(part[6]),
    }, ["ip", "domain", "traffic"])


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(~F.col(MALFORMED)).drop(RAW, MALFORMED)


def quarantined(parsed: DataFrame) -> DataFrame:
    return parsed.filter(MALFORMED).select(RAW)


def strict(parsed: DataFrame) -> DataFrame:
    """Fail on the first malformed line instead of setting it aside."""
    complaint = F.raise_error(F.concat(F.lit("malformed line: "), F.col(RAW)))
    checked = parsed.filter(F.when(F.col(MALFORMED), complaint.isNotNull()).otherwise(F.lit(True)))
    return checked.drop(RAW, MALFORMED)


def drop_untimed(records: DataFrame, time: str = "event_time") -> DataFrame:
    return records.filter(F.col(time).isNotNull())


def drop_empty_key(records: DataFrame, key: str = "tx_id") -> DataFrame:
    """Keep rows whose key holds text; drops NULL as well."""
    return records.filter(F.col(key) != "")
