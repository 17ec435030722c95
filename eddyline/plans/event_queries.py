"""The analyses and operators over the `events` table.

`events(event_id, ts, user_id, event_type, value, props)` stands in for the
logs: users play the part of items and orders, `props.k` of URLs, event types of
domains, and signup/purchase/click/error of the log's event types. Events are
sparser than the logs, so most time bounds are wider.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eddyline.functions.report import ITEM_REPORT, URL_REPORT, ranking_report
from eddyline.functions.time import LABEL_MINUTES
from eddyline.operators import patterns, reconcile, windows
from eddyline.operators.relational import query
from eddyline.plans import analyses
from eddyline.session import prepare, scratch_path
from eddyline.sources import parsers
from eddyline.sources.lines import read_lines, read_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def naive_times(frame: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the tables have them."""
    return frame.select(
        *[
            F.col(name).cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(name)
            for name, kind in frame.dtypes
        ]
    )


def registered(build: Query) -> Query:
    @wraps(build)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return naive_times(build(prepare(spark), folder))

    QUERIES[build.__name__] = run
    return run


def events(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def is_type(name: str):
    return F.col("event_type") == name


def with_url(frame: DataFrame) -> DataFrame:
    return frame.withColumn("url", F.get_json_object("props", "$.k"))


def with_cents(frame: DataFrame) -> DataFrame:
    return frame.withColumn("traffic", F.round(F.col("value") * 100).cast("bigint"))


def with_day(frame: DataFrame) -> DataFrame:
    return frame.withColumn("day", F.date_trunc("day", "ts"))


# Windows and rankings


@registered
def hot_items(spark, folder):
    return analyses.hot_items(events(spark, folder), item="user_id", time="ts")


@registered
def hot_urls(spark, folder):
    return analyses.hot_urls(with_url(events(spark, folder)), time="ts")


@registered
def hot_items_by_type(spark, folder):
    """Items again, counting one kind of behaviour, in tumbling hours."""
    behaviors = events(spark, folder).withColumnRenamed("event_type", "behavior")
    return analyses.hot_items(
        behaviors, n=3, slide="60 minutes", item="user_id", time="ts", behavior="view",
    )


@registered
def hot_items_report(spark, folder):
    return ranking_report(hot_items(spark, folder), "user_id", ITEM_REPORT)


@registered
def hot_urls_report(spark, folder):
    ranked = analyses.hot_urls(
        with_url(events(spark, folder)), size="60 minutes", slide="15 minutes", time="ts",
    )
    return ranking_report(ranked, "url", URL_REPORT)


@registered
def sliding_count(spark, folder):
    return windows.sliding_count(events(spark, folder), ["user_id"], "ts", "60 minutes", "5 minutes")


@registered
def uneven_sliding_count(spark, folder):
    """A window that is no multiple of its slide."""
    return windows.sliding_count(events(spark, folder), ["event_type"], "ts", "50 minutes", "20 minutes")


@registered
def tumbling_count(spark, folder):
    return windows.window_count(events(spark, folder), ["event_type"], "ts", "60 seconds")


@registered
def domain_traffic(spark, folder):
    return analyses.domain_traffic(
        with_cents(events(spark, folder)), domain="event_type", time="ts",
    )


# Patterns


@registered
def login_fail(spark, folder):
    return analyses.login_fail(
        events(spark, folder), "6 hours", time="ts", seq=("event_id",), fail=is_type("error"),
    )


@registered
def strict_sequence(spark, folder):
    """Adjacent events of two different types, with both rows' columns."""
    pairs = patterns.strict_next(
        events(spark, folder), ["user_id"], "ts", is_type("view"), is_type("click"),
        "12 hours", ["event_id"], carry=["event_id", "value"],
    )
    return pairs.select(
        "user_id",
        F.col("first.event_id").alias("view_id"), F.col("first.value").alias("view_value"),
        F.col("second.event_id").alias("click_id"), F.col("second.ts").alias("click_ts"),
    )


@registered
def order_timeout_pattern(spark, folder):
    return analyses.order_timeout_pattern(
        events(spark, folder), "24 hours", keys=("user_id",), time="ts", seq=("event_id",),
        create=is_type("signup"), pay=is_type("purchase"),
    )


# Order lifecycle


@registered
def order_lifecycle(spark, folder):
    return analyses.order_lifecycle(
        with_day(events(spark, folder)), "6 hours", keys=("user_id", "day"), time="ts",
        create=is_type("signup"), pay=is_type("purchase"),
    )


@registered
def order_lifecycle_strict(spark, folder):
    return analyses.order_lifecycle(
        events(spark, folder), "24 hours", keys=("user_id",), time="ts", seq=("event_id",),
        create=is_type("signup"), pay=is_type("purchase"), mode="strict",
    )


@registered
def order_lifecycle_coarse(spark, folder):
    """Times rounded to the hour, so that many rows of a key coincide."""
    hourly = events(spark, folder).withColumn("ts", F.date_trunc("hour", "ts"))
    hourly = hourly.withColumn("bucket", F.pmod("user_id", F.lit(10)))
    return analyses.order_lifecycle(
        hourly, "2 hours", keys=("bucket",), time="ts", seq=("event_id",),
        create=is_type("signup"), pay=is_type("purchase"), mode="strict",
    )


# Reconciliation


def _match(spark, folder, within, **options):
    """All purchases and clicks of a user; keys occur many times on both sides."""
    table = events(spark, folder)
    return analyses.tx_match(
        table.filter(is_type("purchase")), table.filter(is_type("click")), within,
        keys=("user_id",), time="ts", seq=("event_id",),
        pay_columns=("event_id",), receipt_columns=("event_id",), **options,
    )


@registered
def tx_match(spark, folder):
    return _match(spark, folder, "2 hours")


@registered
def tx_unmatched_pays(spark, folder):
    unmatched = _match(spark, folder, "2 hours").filter(F.col("tag") == reconcile.UNMATCHED_PAYS)
    return unmatched.select("user_id", "pay_time", "pay_event_id")


@registered
def tx_unmatched_receipts(spark, folder):
    unmatched = _match(spark, folder, "2 hours").filter(F.col("tag") == reconcile.UNMATCHED_RECEIPTS)
    return unmatched.select("user_id", "receipt_time", "receipt_event_id")


@registered
def tx_match_repeated(spark, folder):
    """A longer bound, and the rows that a later one of their side replaces."""
    return _match(spark, folder, "12 hours", keep_replaced=True)


# Relational


@registered
def login_success_view(spark, folder):
    return analyses.login_success_view(
        events(spark, folder), "event_type, props", "event_type = 'view'",
    )


@registered
def sql_view(spark, folder):
    return query(
        spark,
        """
        SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, max(ts) AS last_ts
        FROM {logged} WHERE value > 10 GROUP BY event_type
        """,
        logged=events(spark, folder),
    )


@registered
def filter_empty_key(spark, folder):
    blanked = with_url(events(spark, folder)).select(
        "event_id",
        F.when(F.col("url").cast("int") < 10, "").otherwise(F.col("url")).alias("tx_id"),
    )
    return parsers.drop_empty_key(blanked)


# Parsers: events are written out in a log's layout, some of them damaged, and read back


def _line(table: DataFrame, separator: str, *parts) -> DataFrame:
    return table.select("event_id", F.concat_ws(separator, *parts).alias("value"))


def _text(name: str):
    return F.col(name).cast("string")


def _epoch():
    return F.unix_timestamp("ts").cast("string")


def _access_lines(table: DataFrame) -> DataFrame:
    stamp = F.when(is_type("purchase"), F.date_format("ts", "dd/MM/yy:HH:mm:ss")).otherwise(
        F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"),
    )
    whole = F.concat_ws(
        " ", F.concat(F.lit("10.0.0."), _text("user_id")), _text("user_id"), F.lit("-"), stamp,
        F.lit("+0000"), F.lit("GET"), F.concat(F.lit("/k/"), F.col("url")),
    )
    line = F.when(is_type("error"), F.substring_index(whole, " ", 6)).otherwise(whole)
    return with_url(table).select("event_id", line.alias("value"))


@registered
def parse_access_log(spark, folder):
    return parsers.accepted(parsers.parse_access(_access_lines(events(spark, folder))))


@registered
def quarantine_access_log(spark, folder):
    return parsers.quarantined(parsers.parse_access(_access_lines(events(spark, folder))))


@registered
def parse_traffic_log(spark, folder):
    stamp = F.when(is_type("error"), "yesterday").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    amount = F.when(is_type("signup"), "12x").otherwise(_text("traffic"))
    lines = _line(
        with_cents(events(spark, folder)), "\t", F.lit("vendor"), F.lit("CN"), F.lit("M"), stamp,
        F.concat(F.lit("10.0.0."), _text("user_id")), F.col("event_type"), amount, F.lit(""),
    )
    return parsers.drop_untimed(parsers.accepted(parsers.parse_traffic(lines)))


@registered
def parse_behavior_log(spark, folder):
    user = F.when(is_type("click"), F.concat(F.lit(" "), _text("user_id"))).otherwise(_text("user_id"))
    lines = _line(
        with_url(events(spark, folder)), ",", user, _text("event_id"), F.col("url"),
        F.col("event_type"), _epoch(),
    )
    return parsers.accepted(parsers.parse_behavior(lines))


@registered
def parse_login_log(spark, folder):
    lines = _line(
        events(spark, folder), ",", F.concat(_text("user_id"), F.lit(" ")),
        F.concat(F.lit(" 10.0.0."), _text("user_id")),
        F.concat(F.lit("\t"), F.col("event_type"), F.lit("  ")), F.concat(F.lit(" "), _epoch()),
    )
    return parsers.accepted(parsers.parse_login(lines))


@registered
def parse_order_log(spark, folder):
    tx = F.when(is_type("signup"), "").otherwise(F.concat(F.lit(" tx"), _text("event_id")))
    lines = _line(events(spark, folder), ",", _text("user_id"), F.col("event_type"), tx, _epoch())
    return parsers.accepted(parsers.parse_order(lines))


@registered
def parse_receipt_log(spark, folder):
    stamp = F.when(is_type("click"), F.concat(_epoch(), F.lit(" "))).otherwise(_epoch())
    lines = _line(
        events(spark, folder), ",", F.concat(F.lit(" tx"), _text("event_id")), F.col("event_type"), stamp,
    )
    return parsers.accepted(parsers.parse_receipt(lines))


# Logs: events are written to text files in the order of their numbers, and the analyses start
# from the files' lines


def _write_log(lines: DataFrame, path: str) -> None:
    """Files whose names, and lines within, are in the order of event_id."""
    ordered = lines.repartitionByRange("event_id").sortWithinPartitions("event_id")
    ordered.select("value").write.text(path)


def write_order_log(table: DataFrame, path: str) -> None:
    kind = F.when(is_type("signup"), "create").when(is_type("purchase"), "pay").otherwise(F.col("event_type"))
    tx = F.when(is_type("signup"), "").otherwise(F.concat(F.lit("tx"), _text("event_id")))
    seconds = F.unix_seconds(F.col("ts").cast("timestamp")).cast("string")
    _write_log(_line(table, ",", _text("user_id"), kind, tx, seconds), path)


@registered
def order_log_lifecycle(spark, folder):
    path = scratch_path(spark, "order_log")
    write_order_log(read_table(spark, folder, "events"), path)
    orders = parsers.accepted(parsers.parse_order(read_lines(spark, path)))
    return analyses.order_lifecycle(orders, "24 hours", mode="strict")


@registered
def access_log_hot_urls(spark, folder):
    """Lines that do not fit are set aside; the others are ranked by the minute."""
    path = scratch_path(spark, "access_log")
    _write_log(_access_lines(events(spark, folder)), path)
    accesses = parsers.accepted(parsers.parse_access(read_lines(spark, path, numbered=False)))
    return analyses.hot_urls(accesses, slide="1 minute")


@registered
def domain_traffic_minutes(spark, folder):
    """Labels that stop at the minute."""
    return analyses.domain_traffic(
        with_cents(events(spark, folder)), domain="event_type", time="ts", layout=LABEL_MINUTES,
    )
