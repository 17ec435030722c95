"""Arrow batches inside tasks: text buffers, output batches, and slices of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: Bytes of text that one step of numpy work takes at a time; one longer text is taken alone.
SLICE_BYTES = 1 << 20


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Keep batches small: texts differ in length by four orders of magnitude."""
    if int(spark.conf.get(ROWS_PER_BATCH)) > rows:
        spark.conf.set(ROWS_PER_BATCH, str(rows))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows one after the other, and the n + 1 row offsets; null is empty."""
    column = pc.fill_null(column.cast(pa.binary()).cast(pa.large_binary()), b"")
    rows = len(column)
    if rows == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, rows + 1, column.offset * 8)
    if buffers[2] is None:
        return np.zeros(0, np.uint8), np.zeros(rows + 1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def slices(lengths: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose lengths add up to `limit` at most; a longer row is a range of its own."""
    start, total = 0, 0
    for row, length in enumerate(lengths.tolist()):
        if row > start and total + length > limit:
            yield start, row
            start, total = row, 0
        total += length
    if start < len(lengths):
        yield start, len(lengths)


def arrow_schema(kinds: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T.StructType.fromDDL(kinds))


def map_batches(
    frame: DataFrame, kinds: str, work: Callable[..., Iterator[list]], *arguments,
) -> DataFrame:
    """`mapInArrow` of `work(batch, *arguments)`, which yields lists of columns in schema order.

    Columns are Arrow arrays, numpy arrays or lists.
    """

    schema = arrow_schema(kinds)

    def run(batches):
        for batch in batches:
            for columns in work(batch, *arguments):
                yield pa.RecordBatch.from_arrays(
                    [
                        column.cast(field.type) if isinstance(column, pa.Array) else pa.array(column, field.type)
                        for column, field in zip(columns, schema, strict=True)
                    ],
                    schema=schema,
                )

    return frame.mapInArrow(run, kinds)


def binary_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary values that are consecutive slices of one byte buffer."""
    values = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))],
    )
    return values.cast(pa.binary())


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of every range, one range after the other."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def only(frame: DataFrame, **kinds: str) -> DataFrame:
    """The named columns with the given types, whatever else the table carries.

    A missing column raises; of columns with one name in other cases the exact one counts.
    """
    named = {name: place for place, name in reversed(list(enumerate(frame.columns)))}
    missing = [name for name in kinds if name not in named]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} among {frame.columns}")
    unique = frame.toDF(*[f"c{place}" for place in range(len(frame.columns))])
    return unique.select(*[F.col(f"c{named[name]}").cast(kind).alias(name) for name, kind in kinds.items()])


def replaced(documents: DataFrame, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The documents with their `text` changed and `n_chars`, if there is one, following it.

    `change` gets columns `row` (all columns, under unique names) and `text`, and returns both.
    """
    names = documents.columns
    places = {name: place for place, name in reversed(list(enumerate(names)))}
    unique = documents.toDF(*[f"c{place}" for place in range(len(names))])
    text = f"c{places['text']}"
    changed = change(unique.select(F.struct("*").alias("row"), F.col(text).alias("text")))
    columns = {f"c{place}": F.col(f"row.c{place}") for place in range(len(names))}
    columns[text] = F.col("text")
    if "n_chars" in places:
        count = f"c{places['n_chars']}"
        columns[count] = (
            F.when(F.col("text").eqNullSafe(F.col(f"row.{text}")), columns[count])
            .otherwise(F.length("text").cast(unique.schema[count].dataType))
        )
    return changed.select(*[column.alias(name) for name, column in columns.items()]).toDF(*names)
