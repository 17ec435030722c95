"""Order lifecycle: an order is created, then paid before a deadline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.functions.time import Duration, from_micros, micros, to_micros
from eddyline.operators.slices import Rule, alternation

# Tags of the outputs and their messages.
PAYED = "payed"
LATE = "late"
TIMEOUT = "timeout"
ORPHAN = "orphan"
MESSAGES = {
    PAYED: "payed successfully",
    LATE: "payed but already timeout",
    TIMEOUT: "order timeout",
    ORPHAN: "already payed but not found create log",
}


def message(tag: Column) -> Column:
    text = F.lit(None).cast("string")
    for name, wording in MESSAGES.items():
        text = F.when(tag == name, wording).otherwise(text)
    return text


def lifecycle_summary(
    events: DataFrame, keys: list[str], time: str, created: Column, paid: Column,
    within: Duration,
) -> DataFrame:
    """One row per key from its first creation and its first payment.

    A single aggregation with two minima, combined before the shuffle. Rows
    without a time or a key are left out.
    """
    events = events.filter(F.col(time).isNotNull())
    for name in keys:
        events = events.filter(F.col(name).isNotNull())
    firsts = (
        events.filter(created | paid)
        .groupBy(*keys)
        .agg(
            F.min(F.when(created, F.col(time))).alias("created_at"),
            F.min(F.when(paid, F.col(time))).alias("paid_at"),
        )
    )
    in_time = micros("paid_at") - micros("created_at") < to_micros(within)
    tag = (
        F.when(F.col("created_at").isNull(), ORPHAN)
        .when(F.col("paid_at").isNull(), TIMEOUT)
        .when(in_time, PAYED)
        .otherwise(LATE)
    )
    return firsts.select(*keys, tag.alias("tag"), "created_at", "paid_at").withColumn(
        "result_msg", message(F.col("tag")),
    )


def lifecycle_strict(
    events: DataFrame, keys: list[str], time: str, created: Column, paid: Column,
    within: Duration, seq: list[str], width: Duration | None = None,
) -> DataFrame:
    """Every outcome in the order events and deadlines happen.

    A creation waits until its deadline; a payment without a creation waits for
    one of the same time only. A deadline comes before any later row. A payment
    at exactly the deadline is late; one after it gives two rows, the timeout
    and the orphan payment. Rows of equal time follow in the order of `seq`.

    After a row, its key either waits for the other event or does not, which is
    one bit: for a creation 0 means waiting, for a payment 1. A later row always
    finds the same state unless it comes before the earlier row's deadline.
    """
    wait = to_micros(within)
    relevant = events.filter((created | paid) & F.col(time).isNotNull())
    is_creation = F.coalesce(created, F.lit(False))
    row = F.struct(micros(time).alias("t"), *seq, is_creation.alias("created"))

    def deadline(step: Column) -> Column:
        return F.when(step["created"], step["t"] + wait).otherwise(step["t"])

    def restarts(before: Column, step: Column) -> Column:
        return (deadline(before) < step["t"]) | (before["created"] & step["created"])

    rule = Rule(
        start=lambda step: ~step["created"],
        resets=restarts,
        flips=lambda before, step: ~before["created"] & ~step["created"],
    )
    scanned = alternation(relevant, keys, row, rule, within, width)

    step, before, after, state = (F.col(name) for name in ("row", "before", "after", "state"))
    waiting = state == F.when(step["created"], 0).otherwise(1)
    expires = F.coalesce(deadline(step) < after["t"], F.lit(True))
    on_time = step["created"] | (before["created"] & (deadline(before) > step["t"]))
    tag = (
        F.when(waiting & expires, F.when(step["created"], TIMEOUT).otherwise(ORPHAN))
        .when(~waiting, F.when(on_time, PAYED).otherwise(LATE))
    )
    at = F.when(waiting, deadline(step)).otherwise(step["t"])
    outcomes = scanned.select(*keys, tag.alias("tag"), from_micros(at).alias("emitted_at"))
    return outcomes.filter(F.col("tag").isNotNull()).withColumn(
        "result_msg", message(F.col("tag")),
    )
