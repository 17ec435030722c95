"""Sequences of two events of one key within a time bound.

The bound is exclusive: a span equal to it is too long. Matches may overlap.
Rows of equal time follow in the order of `seq`, which must tell them apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.functions.time import Duration, from_micros, micros, to_micros
from eddyline.operators.slices import following

MATCHED = "matched"
TIMEOUT = "timeout"


def _row(
    time: str, seq: list[str], carry: list[str], first: Column, second: Column,
) -> Column:
    return F.struct(
        micros(time).alias("t"), *[F.col(name).alias(f"_seq{place}") for place, name in enumerate(seq)],
        _holds(first).alias("_first"), _holds(second).alias("_second"),
        *[F.col(name).alias(f"_carry{place}") for place, name in enumerate(carry)],
    )


def _shown(events: DataFrame, time: str, carry: list[str], row: str) -> Column:
    """The columns of a row that the result shows."""
    return F.struct(
        from_micros(f"{row}.t").cast(events.schema[time].dataType).alias(time),
        *[F.col(f"{row}._carry{place}").alias(name) for place, name in enumerate(carry)],
    )


def _holds(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def strict_next(
    events: DataFrame, keys: list[str], time: str, first: Column, second: Column,
    within: Duration, seq: list[str], carry: list[str] = (), width: Duration | None = None,
) -> DataFrame:
    """Pairs of rows that follow each other directly, `first` then `second`.

    Any row of the key in between, of whatever type, breaks the pair. Returns
    the keys and the columns `time` and `carry` of both rows as the structs
    `first` and `second`.
    """
    row = _row(time, list(seq), list(carry), first, second)
    timed = events.filter(F.col(time).isNotNull())
    rows = following(timed, keys, row, within, width=width)
    span = F.col("following.t") - F.col("row.t")
    matched = F.col("row._first") & F.col("following._second") & (span < to_micros(within))
    return rows.filter(matched).select(
        *keys,
        _shown(events, time, carry, "row").alias("first"),
        _shown(events, time, carry, "following").alias("second"),
    )


def followed_by(
    events: DataFrame, keys: list[str], time: str, first: Column, second: Column,
    within: Duration, seq: list[str], carry: list[str] = (), width: Duration | None = None,
) -> DataFrame:
    """Each `first` row with the earliest later `second` row of its key, or without one.

    Other rows in between are skipped, and removed before the shuffle. Returns
    one row per `first`: keys, `tag` (matched or timeout) and both rows' columns
    `time` and `carry` as the structs `first` and `second` (NULL on a timeout).
    """
    row = _row(time, list(seq), list(carry), first, second)
    relevant = events.filter(F.col(time).isNotNull() & (first | second))
    rows = following(relevant, keys, row, within, lambda step: step["_second"], width)
    in_time = _holds(F.col("following.t") - F.col("row.t") < to_micros(within))
    return rows.filter("row._first").select(
        *keys,
        F.when(in_time, MATCHED).otherwise(TIMEOUT).alias("tag"),
        _shown(events, time, carry, "row").alias("first"),
        F.when(in_time, _shown(events, time, carry, "following")).alias("second"),
    )
