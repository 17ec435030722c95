"""The analyses as streams over the files of the `events` table.

Each query runs its stream over what the table holds, stops, lets rows arrive
whose time lies far behind the rest, and starts again from the checkpoint: the
watermark then passes everything and the result is complete. The late-comers
themselves stay in state and never reach the result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from eddyline.functions.report import ITEM_REPORT
from eddyline.functions.time import micros, to_micros
from eddyline.operators.ranking import top_n
from eddyline.operators.windows import window_count
from eddyline.operators.reconcile import MATCHED, UNMATCHED_PAYS, UNMATCHED_RECEIPTS
from eddyline.plans import analyses
from eddyline.plans.event_queries import Query, is_type, naive_times, with_cents, with_url, write_order_log
from eddyline.session import prepare, scratch_path
from eddyline.sources import parsers
from eddyline.sources.lines import read_table, stream_table
from eddyline.sources.positioned import stream_positioned_lines
from eddyline.streaming import flows
from eddyline.streaming.eventtime import ascending, watermark
from eddyline.streaming.sinks import (
    DropLedger,
    append_files,
    fan_out,
    read_latest,
    run_available,
    state_partitions,
    write_batches,
)

STREAM_QUERIES: dict[str, Query] = {}

MATCH_TAGS = (MATCHED, UNMATCHED_PAYS, UNMATCHED_RECEIPTS)

Writer = Callable[[DataFrame, str], DataStreamWriter]


def _closing_rows(table: DataFrame) -> DataFrame:
    """One row of every event type, a year after the last event, of no real user."""
    latest = table.groupBy("event_type").agg(F.max("event_id").alias("event_id"), F.max("ts").alias("latest"))
    # As many rows as there are event types.
    end = F.max("latest").over(Window.partitionBy(F.lit(0)))
    closing = latest.select("event_type", "event_id", (end + F.expr("INTERVAL 365 DAYS")).alias("ts"), F.lit(-1).alias("user_id"))
    return closing.filter(F.col("ts").isNotNull()).select(
        *[
            (F.col(name) if name in closing.columns else F.lit(None))
            .cast(table.schema[name].dataType).alias(name)
            for name in table.columns
        ]
    )


def _arriving_one_by_one(table: DataFrame, arrival: Column, base: str) -> Iterator[str]:
    """Put the table's rows into a folder batch by batch, and name the folder after each."""
    spark = table.sparkSession
    arrived = f"{base}/arrived"
    dealt = table.withColumn("arrival", arrival)
    dealt.write.partitionBy("arrival").parquet(f"{base}/dealt")
    numbers = spark.read.parquet(f"{base}/dealt").select("arrival").distinct().orderBy("arrival").collect()
    for (number,) in numbers:
        rows = spark.read.schema(table.schema).parquet(f"{base}/dealt/arrival={number}")
        rows.write.mode("append").parquet(arrived)
        yield arrived


def streamed(
    writer: Writer, reader: Callable[[SparkSession, str], DataFrame] | None = None, closed: bool = True,
    arrival: Callable[[], Column] | None = None, ledger: bool = False,
):
    """Register a stream definition `build(events stream) -> DataFrame` as a query.

    One without state needs no closing rows: `closed` is false. With `arrival`, a batch number,
    the rows arrive batch by batch. The result of a `ledger` is not what the stream wrote but
    how many rows it dropped in each of its runs.
    """

    def register(build: Callable[[DataFrame], DataFrame]) -> Query:
        @wraps(build)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            prepare(spark)
            base = scratch_path(spark, build.__name__)
            table = read_table(spark, folder, "events")
            closing = f"{base}/closing"
            spark.createDataFrame([], table.schema).write.parquet(closing)

            drops = DropLedger()
            dropped: list[tuple[int, int]] = []

            def start(source: str) -> None:
                arriving = stream_table(spark, source, table.schema).unionByName(
                    stream_table(spark, closing, table.schema),
                )
                arriving = arriving.withColumn("ts", F.col("ts").cast("timestamp"))
                with state_partitions(spark):
                    ran = run_available(writer(build(arriving), f"{base}/result"), f"{base}/checkpoint")
                if ledger:
                    dropped.append((len(dropped), sum(drops.settled(ran).values())))

            source = f"{folder}/events.parquet"
            if ledger:
                spark.streams.addListener(drops)
            try:
                for source in _arriving_one_by_one(table, arrival(), base) if arrival is not None else [source]:
                    start(source)
                if closed:
                    _closing_rows(table).write.mode("append").parquet(closing)
                    start(source)
            finally:
                if ledger:
                    spark.streams.removeListener(drops)
            if ledger:
                return spark.createDataFrame(dropped, "run int, dropped long")
            read = reader or (lambda session, path: session.read.parquet(path))
            return naive_times(read(spark, f"{base}/result"))

        STREAM_QUERIES[build.__name__] = run
        return run

    return register


def _rank_items(counts: DataFrame, path: str) -> DataStreamWriter:
    return flows.rank_windows(counts, 5, write_batches(path), ties=["user_id"])


def _without_batch(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch")


def _fan_out_matches(outcomes: DataFrame, path: str) -> DataStreamWriter:
    return fan_out(outcomes, {tag: write_batches(f"{path}/{tag}") for tag in MATCH_TAGS})


def _matches_by_tag(spark: SparkSession, path: str) -> DataFrame:
    outputs = [
        _without_batch(spark, f"{path}/{tag}").withColumn("tag", F.lit(tag)) for tag in MATCH_TAGS
    ]
    return reduce(DataFrame.unionByName, outputs)


def _sliding(events: DataFrame, key: str, size: str, slide: str) -> DataFrame:
    timed = watermark(events, "ts", "1 second", lateness="1 minute")
    return flows.sliding_count(timed, [key], "ts", size, slide)


@streamed(append_files)
def stream_sliding_count(events):
    counts = _sliding(events, "user_id", "60 minutes", "5 minutes")
    return counts.select(F.col("window.end").alias("window_end"), "user_id", "count")


@streamed(_rank_items, _without_batch)
def stream_hot_items(events):
    counts = _sliding(events, "user_id", "60 minutes", "5 minutes")
    return counts.select(F.col("window.end").alias("window_end"), "user_id", "count")


@streamed(append_files)
def stream_hot_urls(events):
    """Ten minutes every five seconds, ranked in the stream itself."""
    return flows.top_windows(_sliding(with_url(events), "url", "10 minutes", "5 seconds"), 5, "url")


@streamed(append_files)
def stream_hot_items_report(events):
    counts = _sliding(events, "user_id", "60 minutes", "5 minutes")
    return flows.top_reports(counts, 5, "user_id", ITEM_REPORT)


@streamed(append_files)
def stream_domain_traffic(events):
    timed = watermark(with_cents(events), "ts", "5 seconds")
    return analyses.domain_traffic(timed, domain="event_type", time="ts")


@streamed(append_files)
def stream_login_fail(events):
    timed = watermark(events, "ts", "5 seconds")
    failed = is_type("error")
    pairs = flows.strict_next(timed, ["user_id"], "ts", failed, failed, "6 hours", seq="event_id")
    return pairs.select(
        "user_id", F.col("first.ts").alias("first_fail_time"),
        F.col("second.ts").alias("last_fail_time"), F.lit(analyses.LOGIN_WARNING).alias("warning_msg"),
    )


@streamed(append_files)
def stream_order_timeout_pattern(events):
    found = flows.followed_by(
        ascending(events, "ts"), ["user_id"], "ts", is_type("signup"), is_type("purchase"),
        "24 hours", seq="event_id",
    )
    begin = F.col("first.ts")
    return found.select(
        "user_id", "tag", begin.alias("created_at"), F.col("second.ts").alias("paid_at"),
        analyses.order_pattern_message(F.col("tag"), begin).alias("result_msg"),
    )


@streamed(lambda outcomes, path: append_files(outcomes, path, tag="tag"))
def stream_order_lifecycle(events):
    return flows.lifecycle(
        ascending(events, "ts"), ["user_id"], "ts", is_type("signup"), is_type("purchase"),
        "24 hours", seq="event_id",
    )


@streamed(lambda outcomes, path: append_files(outcomes, path, tag="tag"))
def stream_tx_match_repeated(events):
    timed = ascending(events, "ts")
    found = flows.match(
        timed.filter(is_type("purchase")), timed.filter(is_type("click")), ["user_id"], "ts",
        "12 hours", ["event_id"], ["event_id"], seq="event_id", keep_replaced=True,
    )
    return found.select(
        "user_id", "tag",
        F.col("left.ts").alias("pay_time"), F.col("left.event_id").alias("pay_event_id"),
        F.col("right.ts").alias("receipt_time"), F.col("right.event_id").alias("receipt_event_id"),
    )


@streamed(_fan_out_matches, _matches_by_tag)
def stream_tx_match(events):
    """A click right after a purchase, by event number, counts as its receipt."""
    timed = ascending(events, "ts")
    pays = timed.filter(is_type("purchase")).withColumn("tx_id", F.col("event_id"))
    receipts = timed.filter(is_type("click")).withColumn("tx_id", F.col("event_id") - 1)
    found = flows.match(pays, receipts, ["tx_id"], "ts", "5 minutes", ["user_id"], ["user_id"])
    return found.select(
        "tx_id", "tag",
        F.col("left.ts").alias("pay_time"), F.col("left.user_id").alias("pay_user"),
        F.col("right.ts").alias("receipt_time"), F.col("right.user_id").alias("receipt_user"),
    )


@streamed(append_files, closed=False)
def stream_login_success_view(events):
    return analyses.login_success_view(events, "event_type, props", "event_type = 'view'")


# Rows that arrive batch by batch, in order or not

def by_time() -> Column:
    """Batches hold the rows of ten days each."""
    return F.floor(micros("ts") / to_micros("10 days")).cast("int")


def disordered() -> Column:
    """As `by_time`, but a row arrives up to two days after its time, depending on its number."""
    delay = F.pmod(F.col("event_id") * 7919, F.lit(1000)) * (to_micros("2 days") // 1000)
    return F.floor((micros("ts") + delay) / to_micros("10 days")).cast("int")


@streamed(append_files, arrival=by_time)
def stream_silent_users(events):
    return flows.silence(ascending(events, "ts"), ["user_id"], "ts", "24 hours")


def _kept_counts(events: DataFrame) -> DataFrame:
    """Rows that come within a day of the latest one, counted; the others are dropped one by one."""
    timely = watermark(events, "ts", "1 day").dropDuplicates(["event_id", "ts"])
    return window_count(timely, ["event_type"], "ts", "6 hours")


@streamed(append_files, arrival=disordered)
def stream_late_counts(events):
    return _kept_counts(events)


@streamed(append_files, arrival=disordered, ledger=True)
def stream_late_ledger(events):
    return _kept_counts(events)


def _update_batches(counts: DataFrame, path: str) -> DataStreamWriter:
    return counts.writeStream.outputMode("update").foreachBatch(write_batches(path))


def _revised_ranking(spark: SparkSession, path: str) -> DataFrame:
    latest = read_latest(spark, path, ["window_end", "user_id"])
    return top_n(latest.filter(F.col("user_id") >= 0), 5, ties=["user_id"])


@streamed(_update_batches, _revised_ranking, arrival=disordered, closed=False)
def stream_revised_hot_items(events):
    """Rankings as soon as rows come, revised by what comes up to a day late."""
    timed = watermark(events, "ts", "1 second", lateness="1 day")
    return window_count(timed, ["user_id"], "ts", "6 hours")


@streamed(append_files)
def stream_tx_join(events):
    """The matching of `stream_tx_match` as a join of the two streams."""
    timed = ascending(events, "ts")
    pays = timed.filter(is_type("purchase")).withColumn("tx_id", F.col("event_id"))
    receipts = timed.filter(is_type("click")).withColumn("tx_id", F.col("event_id") - 1)
    found = flows.match_join(pays, receipts, ["tx_id"], "ts", "5 minutes", ["user_id"], ["user_id"])
    return found.select(
        "tx_id", "tag",
        F.col("left.ts").alias("pay_time"), F.col("left.user_id").alias("pay_user"),
        F.col("right.ts").alias("receipt_time"), F.col("right.user_id").alias("receipt_user"),
    )


@streamed(lambda outcomes, path: append_files(outcomes, path, tag="tag"))
def stream_order_lifecycle_legacy(events):
    """Timers of repeated creations stay behind and end whatever waits when they are reached."""
    return flows.lifecycle(
        ascending(events, "ts"), ["user_id"], "ts", is_type("signup"), is_type("purchase"),
        "24 hours", seq="event_id", legacy_timers=True,
    )


def _registered(run: Query) -> Query:
    STREAM_QUERIES[run.__name__] = run
    return run


@_registered
def stream_two_logs(spark: SparkSession, folder: str) -> DataFrame:
    """Two logs with watermarks of their own; receipts arrive one batch behind the payments.

    The slower log's watermark counts, so no payment is given up while its receipt may come.
    """
    prepare(spark)
    base = scratch_path(spark, "stream_two_logs")
    table = read_table(spark, folder, "events")
    sides = {"pays": ("purchase", 0), "receipts": ("click", 1)}
    for name, (kind, shift) in sides.items():
        side = table.filter(is_type(kind)).withColumn("tx_id", F.col("event_id") - shift)
        side.withColumn("arrival", by_time() + shift).write.partitionBy("arrival").parquet(f"{base}/dealt/{name}")
        side.limit(0).write.parquet(f"{base}/{name}")
    schema = spark.read.parquet(f"{base}/pays").schema

    def arrives(name: str, number: int) -> None:
        dealt = spark.read.parquet(f"{base}/dealt/{name}").filter(F.col("arrival") == number).drop("arrival")
        dealt.write.mode("append").parquet(f"{base}/{name}")

    def log(name: str) -> DataFrame:
        arriving = stream_table(spark, f"{base}/{name}", schema).withColumn("ts", F.col("ts").cast("timestamp"))
        return ascending(arriving, "ts")

    def start() -> None:
        found = flows.match(log("pays"), log("receipts"), ["tx_id"], "ts", "5 minutes", ["user_id"], ["user_id"])
        with state_partitions(spark):
            run_available(append_files(found, f"{base}/result"), f"{base}/checkpoint")

    bounds = [spark.read.parquet(f"{base}/dealt/{name}").agg(F.min("arrival"), F.max("arrival")).first() for name in sides]
    known = [one for one in bounds if one[0] is not None]
    for number in range(min(one[0] for one in known), max(one[1] for one in known) + 1) if known else []:
        for name in sides:
            arrives(name, number)
        start()
    for name, (kind, _) in sides.items():
        closing = _closing_rows(table).filter(is_type(kind)).withColumn("tx_id", F.lit(-1).cast("long"))
        closing.write.mode("append").parquet(f"{base}/{name}")
    start()
    found = spark.read.schema(
        "tx_id long, tag string, left struct<ts: timestamp, user_id: long>, right struct<ts: timestamp, user_id: long>",
    ).parquet(f"{base}/result")
    return naive_times(found.select(
        "tx_id", "tag",
        F.col("left.ts").alias("pay_time"), F.col("left.user_id").alias("pay_user"),
        F.col("right.ts").alias("receipt_time"), F.col("right.user_id").alias("receipt_user"),
    ))


@_registered
def stream_order_log(spark: SparkSession, folder: str) -> DataFrame:
    """From the lines of a log to the outcomes of its orders, ties in the order of the lines."""
    prepare(spark)
    base = scratch_path(spark, "stream_order_log")
    table = read_table(spark, folder, "events")
    write_order_log(table, f"{base}/log")

    def start() -> None:
        lines = stream_positioned_lines(spark, f"{base}/log", complete=True).unionByName(
            stream_positioned_lines(spark, f"{base}/closing", complete=True),
        )
        orders = ascending(parsers.accepted(parsers.parse_order(lines)), "event_time")
        kind = F.col("event_type")
        found = flows.lifecycle(
            orders, ["order_id"], "event_time", kind == "create", kind == "pay", "24 hours", seq="position",
        )
        with state_partitions(spark):
            run_available(append_files(found, f"{base}/result"), f"{base}/checkpoint")

    start()
    write_order_log(_closing_rows(table), f"{base}/closing")
    start()
    return naive_times(spark.read.parquet(f"{base}/result"))
