"""Where streams end: labelled files, fan-out by tag, per-batch tables."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from eddyline.session import shared_folder

BatchFunction = Callable[[DataFrame, int], None]

#: State partitions of a new stream per core of the cluster, and at least.
STATE_PARTITIONS_PER_CORE = 2
LEAST_STATE_PARTITIONS = 24


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """Where the stream of that name keeps its progress; the same on every start."""
    return f"{shared_folder(spark).rstrip('/')}/streams/{name}"


def append_files(stream: DataFrame, path: str, tag: str | None = None) -> DataStreamWriter:
    """Append-only parquet files, one folder per value of `tag`, each row exactly once."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    return writer.partitionBy(tag) if tag else writer


def write_batches(path: str, tag: str | None = None) -> BatchFunction:
    """A batch function that writes each micro-batch to a folder of its own.

    A batch that is run again after a failure replaces its folder, so no row
    comes twice. With `tag`, one pass writes every tagged output.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        writer = batch.write.mode("overwrite")
        if tag:
            writer = writer.partitionBy(tag)
        writer.parquet(f"{path}/batch={batch_id}")

    return write


def read_latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """What a stream that updates has written by `write_batches`: each key's row of the latest batch.

    `revisions` says how often the row was written again. Batches replace themselves when they
    run again, so neither changes.
    """
    written = spark.read.parquet(path)
    rest = [name for name in written.columns if name not in (*keys, "batch")]
    batch = F.col("batch").cast("long")
    latest = written.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), batch).alias("row"), (F.count(F.lit(1)) - 1).alias("revisions"),
    )
    return latest.select(*keys, *[f"row.{name}" for name in rest], "revisions")


class DropLedger(StreamingQueryListener):
    """Counts, per query run and micro-batch, the rows that came after the watermark.

    Spark tells a listener after the fact; `settled` waits until a run's end has been told.
    """

    def __init__(self):
        self.dropped: dict[tuple[str, int], int] = {}
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _end_of(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        rows = sum(int(state.numRowsDroppedByWatermark) for state in progress.stateOperators)
        if rows:
            key = str(progress.runId), int(progress.batchId)
            self.dropped[key] = rows

    def onQueryTerminated(self, event) -> None:
        self._end_of(str(event.runId)).set()

    def settled(self, query: StreamingQuery, seconds: float = 60) -> dict[int, int]:
        """Dropped rows by micro-batch of a run that has ended."""
        run = str(query.runId)
        if not self._end_of(run).wait(seconds):
            raise TimeoutError("the end of the query was not reported")
        return {batch: rows for (of, batch), rows in self.dropped.items() if of == run}


def fan_out(
    stream: DataFrame, outputs: dict[str, BatchFunction], tag: str = "tag",
    otherwise: BatchFunction | None = None,
) -> DataStreamWriter:
    """Send each tag's rows to an output of its own, without the tag column.

    Rows of other tags, or of none, go to `otherwise`, with their tag; without
    it they fail the query.

    The micro-batch is kept while the outputs read it, so the operator above
    runs once however many outputs there are.
    """

    def split(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            rest = batch.filter(F.col(tag).isNull() | ~F.col(tag).isin(list(outputs)))
            if otherwise is not None:
                otherwise(rest, batch_id)
            elif not rest.isEmpty():
                raise ValueError(f"rows with tags other than {', '.join(outputs)}")
            for name, write in outputs.items():
                write(batch.filter(F.col(tag) == name).drop(tag), batch_id)
        finally:
            batch.unpersist()

    return stream.writeStream.outputMode("append").foreachBatch(split)


@contextmanager
def state_partitions(spark: SparkSession) -> Iterator[None]:
    """Streams that start within keep state in a few partitions per core, not in as many as batch shuffles.

    Each micro-batch loads, commits and syncs the state of every partition of every operator,
    however few rows it has. A session that asks for fewer partitions gets these. A stream keeps
    the number it first started with in its checkpoint.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    enough = max(LEAST_STATE_PARTITIONS, spark.sparkContext.defaultParallelism * STATE_PARTITIONS_PER_CORE)
    spark.conf.set(name, str(min(int(before), enough)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def run_available(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Process what the sources hold now, then stop."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
