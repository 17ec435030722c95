"""Relational access to event DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def project(events: DataFrame, columns: str) -> DataFrame:
    """Select by a comma-separated list of columns or expressions."""
    return events.selectExpr(*[name.strip() for name in columns.split(",")])


def restrict(events: DataFrame, predicate: str) -> DataFrame:
    """Filter by an SQL predicate text."""
    return events.filter(predicate)


def register(views: dict[str, DataFrame]) -> None:
    """Make DataFrames available to SQL under the given names."""
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)


def query(spark: SparkSession, text: str, **views: DataFrame) -> DataFrame:
    """Run SQL over the session's views and the DataFrames passed by name.

    DataFrames are named in braces in the text and leave no view behind.
    """
    if not text.strip():
        raise ValueError("the query text is blank")
    return spark.sql(text, **views)
