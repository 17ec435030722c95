"""Matching two event streams one to one by key and time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.functions.time import Duration, micros, to_micros
from eddyline.operators.slices import Rule, alternation

# Tags of the outputs.
MATCHED = "matched"
UNMATCHED_PAYS = "unmatchedPays"
UNMATCHED_RECEIPTS = "unmatchedReceipts"
REPLACED = "replaced"


def _side(
    events: DataFrame, keys: list[str], time: str, seq: list[str], is_right: bool,
    left: Column, right: Column,
) -> DataFrame:
    return events.select(
        *keys,
        micros(time).alias("_t"),
        F.lit(is_right).alias("_is_right"),
        *[F.col(name).alias(f"_seq{place}") for place, name in enumerate(seq)],
        left.alias("_left"),
        right.alias("_right"),
    )


def _absent(events: DataFrame, columns: list[str]) -> Column:
    return F.lit(None).cast(events.select(F.struct(*columns)).schema[0].dataType)


def match(
    left: DataFrame, right: DataFrame, keys: list[str], time: str, within: Duration,
    left_columns: list[str], right_columns: list[str], seq: list[str],
    width: Duration | None = None, keep_replaced: bool = False,
    tags: tuple[str, str] = (UNMATCHED_PAYS, UNMATCHED_RECEIPTS),
) -> DataFrame:
    """Pair rows of both sides that lie at most `within` apart, each at most once.

    In time order, a row takes the other side's waiting row; otherwise it waits
    itself, for `within`, in place of an earlier waiting row of its own side.
    The replaced row has no outcome; `keep_replaced` reports it. On equal times
    the left side comes first, then `seq`.

    Returns the keys, `tag`, and the structs `left` and `right`. Both sides go
    through one shuffle together and no pairs are formed, so repeated keys cost
    no more than their rows.
    """
    seq = list(seq)
    both = _side(
        left, keys, time, seq, False, F.struct(*left_columns), _absent(right, right_columns),
    ).unionByName(
        _side(right, keys, time, seq, True, _absent(left, left_columns), F.struct(*right_columns)),
    )
    limit = to_micros(within)
    row = F.struct(
        F.col("_t").alias("t"), F.col("_is_right").alias("is_right"),
        *[f"_seq{place}" for place in range(len(seq))],
        F.col("_left").alias("left"), F.col("_right").alias("right"),
    )

    def meets(one: Column, next_one: Column) -> Column:
        return (one["is_right"] != next_one["is_right"]) & (next_one["t"] - one["t"] <= limit)

    rule = Rule(
        start=lambda step: F.lit(1),
        resets=lambda before, step: ~meets(before, step),
        flips=lambda before, step: F.lit(True),
    )
    relevant = both.filter(F.col("_t").isNotNull())
    scanned = alternation(relevant, keys, row, rule, within, width)

    step, before, after = F.col("row"), F.col("before"), F.col("after")
    replaced = (after["is_right"] == step["is_right"]) & (after["t"] - step["t"] <= limit)
    taken = meets(step, after)
    tag = (
        F.when(F.col("state") == 0, MATCHED)
        .when(F.coalesce(taken, F.lit(False)), None)
        .when(F.coalesce(replaced, F.lit(False)), REPLACED if keep_replaced else None)
        .otherwise(F.when(step["is_right"], tags[1]).otherwise(tags[0]))
    )
    paired = F.col("tag") == MATCHED
    return scanned.select("*", tag.alias("tag")).filter(F.col("tag").isNotNull()).select(
        *keys, "tag",
        F.when(paired, F.coalesce(step["left"], before["left"])).otherwise(step["left"]).alias("left"),
        F.when(paired, F.coalesce(step["right"], before["right"])).otherwise(step["right"]).alias("right"),
    )
