"""Line-oriented and tabular inputs, bounded and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_lines(spark: SparkSession, path: str | list[str], numbered: bool = True) -> DataFrame:
    """Text files as rows of `value`, with their position in the files as `seq` unless not `numbered`."""
    lines = spark.read.text(path)
    return with_position(lines) if numbered else lines


def stream_lines(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Files arriving in a folder as a stream of `value`.

    Any other line source (a message log, say) fits as well: the parsers only
    need a string column `value`. Spark cannot number a stream's lines; where
    equal times must keep an order, the source has to bring one.
    """
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(folder)


def with_position(lines: DataFrame) -> DataFrame:
    """Order of the lines within their files, for ties in event time.

    A split is read by one task in file order, so (file, split start, row id)
    sorts as the file does, however the splits are spread over tasks.
    """
    return lines.select(
        "value",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("seq"),
    )


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stream_table(
    spark: SparkSession, path: str, schema: StructType, max_files: int | None = None,
) -> DataFrame:
    """A parquet file or folder as a stream of the files in it.

    A stream's source has to be a folder or a pattern, so the path is turned
    into a pattern that only it matches.
    """
    path = path.rstrip("/")
    pattern = f"{path[:-1]}[{path[-1]}]"
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(pattern)
