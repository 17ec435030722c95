"""The eight analyses, composed from the operators, for bounded input.

Column names, time bounds and event types are parameters; the defaults fit the
records the parsers give. `seq` names columns that order rows of equal time: by default the
position that numbered reading adds (`read_lines`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.functions.time import LABEL_SECONDS, Duration, floor_div, micros, time_label
from eddyline.operators import patterns, reconcile
from eddyline.operators.lifecycle import lifecycle_strict, lifecycle_summary
from eddyline.operators.ranking import top_n
from eddyline.operators.relational import project, restrict
from eddyline.operators.windows import sliding_count, window_sum

# Messages of the pattern analyses.
LOGIN_WARNING = "warning..."
ORDER_PAID = "成功支付"
ORDER_TIMEOUT = "超时支付 "


def hot_items(
    behaviors: DataFrame, n: int = 5, size: Duration = "60 minutes", slide: Duration = "5 minutes",
    item: str = "item_id", time: str = "event_time", behavior: str | None = None,
) -> DataFrame:
    """Most frequent items per sliding window; `behavior` counts one kind only."""
    if behavior is not None:
        behaviors = behaviors.filter(F.col("behavior") == behavior)
    return top_n(sliding_count(behaviors, [item], time, size, slide), n, ties=[item])


def hot_urls(
    accesses: DataFrame, n: int = 5, size: Duration = "10 minutes", slide: Duration = "5 seconds",
    url: str = "url", time: str = "event_time",
) -> DataFrame:
    """Most requested URLs per sliding window."""
    return top_n(sliding_count(accesses, [url], time, size, slide), n, ties=[url])


def domain_traffic(
    traffic: DataFrame, size: Duration = "60 seconds", domain: str = "domain",
    amount: str = "traffic", time: str = "event_time", layout: str = LABEL_SECONDS,
) -> DataFrame:
    """Traffic per domain and tumbling window, on batch and streaming input."""
    totals = window_sum(traffic, [domain], amount, time, size)
    return totals.select(
        "window_end", time_label(F.col("window_end"), layout).alias("time_label"), domain, amount,
    )


def login_fail(
    logins: DataFrame, within: Duration = "2 seconds", keys: tuple[str, ...] = ("user_id",),
    time: str = "event_time", seq: tuple[str, ...] = ("seq",), fail: Column | None = None,
    width: Duration | None = None,
) -> DataFrame:
    """Two failed logins in a row within the bound."""
    failed = F.col("event_type") == "fail" if fail is None else fail
    pairs = patterns.strict_next(logins, list(keys), time, failed, failed, within, list(seq), width=width)
    return pairs.select(
        *keys,
        F.col("first")[time].alias("first_fail_time"),
        F.col("second")[time].alias("last_fail_time"),
        F.lit(LOGIN_WARNING).alias("warning_msg"),
    )


def order_timeout_pattern(
    orders: DataFrame, within: Duration = "15 minutes", keys: tuple[str, ...] = ("order_id",),
    time: str = "event_time", seq: tuple[str, ...] = ("seq",), create: Column | None = None,
    pay: Column | None = None, width: Duration | None = None,
) -> DataFrame:
    """Every creation with the payment that follows it, or as timed out."""
    created = F.col("event_type") == "create" if create is None else create
    paid = F.col("event_type") == "pay" if pay is None else pay
    found = patterns.followed_by(orders, list(keys), time, created, paid, within, list(seq), width=width)
    begin = F.col("first")[time]
    return found.select(
        *keys, "tag",
        begin.alias("created_at"),
        F.col("second")[time].alias("paid_at"),
        order_pattern_message(F.col("tag"), begin).alias("result_msg"),
    )


def order_pattern_message(tag: Column, created_at: Column) -> Column:
    seconds = floor_div(micros(created_at), 1_000_000)
    return F.when(tag == patterns.MATCHED, ORDER_PAID).otherwise(
        F.concat(F.lit(ORDER_TIMEOUT), seconds.cast("string")),
    )


def order_lifecycle(
    orders: DataFrame, within: Duration = "15 minutes", keys: tuple[str, ...] = ("order_id",),
    time: str = "event_time", seq: tuple[str, ...] = ("seq",), create: Column | None = None,
    pay: Column | None = None, mode: str = "summary", width: Duration | None = None,
) -> DataFrame:
    """How each order ended; `strict` gives every outcome as it happens."""
    created = F.col("event_type") == "create" if create is None else create
    paid = F.col("event_type") == "pay" if pay is None else pay
    if mode == "summary":
        return lifecycle_summary(orders, list(keys), time, created, paid, within)
    if mode == "strict":
        return lifecycle_strict(orders, list(keys), time, created, paid, within, list(seq), width)
    raise ValueError(f"unknown mode {mode!r}")


def tx_match(
    pays: DataFrame, receipts: DataFrame, within: Duration = "5 seconds",
    keys: tuple[str, ...] = ("tx_id",), time: str = "event_time", seq: tuple[str, ...] = ("seq",),
    pay_columns: tuple[str, ...] = ("order_id",), receipt_columns: tuple[str, ...] = ("pay_channel",),
    keep_replaced: bool = False, width: Duration | None = None,
) -> DataFrame:
    """Payments matched with receipts; both sides' leftovers are tagged."""
    found = reconcile.match(
        pays, receipts, list(keys), time, within, [time, *pay_columns], [time, *receipt_columns],
        list(seq), width, keep_replaced,
    )
    return found.select(
        *keys, "tag",
        F.col("left")[time].alias("pay_time"),
        *[F.col("left")[name].alias(f"pay_{name}") for name in pay_columns],
        F.col("right")[time].alias("receipt_time"),
        *[F.col("right")[name].alias(f"receipt_{name}") for name in receipt_columns],
    )


def login_success_view(
    logins: DataFrame, columns: str = "event_type, ip", predicate: str = "event_type = 'success'",
) -> DataFrame:
    """Columns of the successful logins, on batch and streaming input."""
    return restrict(project(logins, columns), predicate)
