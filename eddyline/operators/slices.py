"""Splitting a key's history by time, so that no key has to fit in one task.

Operators that look at a key's rows in order would normally need all of them in
one window partition. Here the partition is (key, slice of time), and what one
slice has to know of its neighbours travels separately:

* `following` finds a row's successor within a time bound. Where slices are at
  least as wide as the bound, the rows at a slice's start are also handed to the
  slice before, in the one shuffle there is. Where the bound is so long that such
  slices could themselves outgrow a task, narrower slices each report their first
  row instead, and take the first of a later slice.
* `alternation` is for state that can pass on from row to row without bound. Each
  slice is worked out as if nothing came before it; then the few rows near the
  slices' edges, one or two per slice, correct the assumption.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eddyline.functions.time import Duration, floor_div, to_micros

SLICE = "_slice"
OWN = "_own"

_SHORTEST_SLICE = 60_000_000
_LONGEST_SLICE = 3_600_000_000


def slice_micros(reach: int, width: Duration | None) -> int:
    """Width of a slice: twice the reach, but a minute to an hour, unless given.

    Wider slices pass less between neighbours, narrower ones split a dominating
    key more finely; the result is the same.
    """
    if width:
        return to_micros(width)
    return min(max(2 * reach, _SHORTEST_SLICE), max(reach // 24, _LONGEST_SLICE))


def with_halo(
    events: DataFrame, at: Column, reach: int, span: int, lend: Column | None = None,
) -> DataFrame:
    """Add `_slice` and `_own`; rows within `reach` of a slice's start come twice.

    The second copy belongs to the slice before and has `_own` false. `lend`
    restricts which rows are copied. Works on streams too.
    """
    if span < reach:
        raise ValueError("a slice must be at least as wide as the reach")
    index = floor_div(at, span)
    near = F.pmod(at, F.lit(span)) < reach
    if lend is not None:
        near = near & lend
    copies = F.when(near, F.array(index, index - 1)).otherwise(F.array(index))
    return events.select("*", F.explode(copies).alias(SLICE)).withColumn(OWN, F.col(SLICE) == index)


def _keyed(events: DataFrame, keys: list[str], row: Column) -> DataFrame:
    """The keys, the row, and its time in a column of its own to sort by."""
    present = reduce(and_, [F.col(name).isNotNull() for name in keys])
    rows = events.filter(present).select(*keys, row.alias("row"))
    return rows.select("*", F.col("row.t").alias("_t"))


def _sliced(rows: DataFrame, keys: list[str], span: int) -> DataFrame:
    # Joining slices with what their neighbours report implies that the slice is
    # there, for one side only. Stated for both, they stay the same plan and Spark
    # shuffles the rows once.
    sliced = rows.select("*", floor_div(F.col("_t"), span).alias(SLICE))
    return sliced.filter(F.col(SLICE).isNotNull()).repartition(*keys, SLICE)


def following(
    events: DataFrame, keys: list[str], row: Column, reach: Duration,
    candidate: Callable[[Column], Column] | None = None, width: Duration | None = None,
) -> DataFrame:
    """Rows with the next row of their key, or the next for which `candidate` holds.

    `row` is a struct whose first field `t` is the event time in microseconds
    and whose leading fields order the rows of a key without ties. Returns the
    keys, `row` and `following`, which is right up to `reach` and beyond it may
    be a later row or NULL. Rows without a key are left out.
    """
    ahead = to_micros(reach)
    span = slice_micros(ahead, width)
    rows = _keyed(events, keys, row)
    # Latest row first: what follows a row in time then lies in a growing frame,
    # which Spark extends row by row.
    backwards = Window.partitionBy(*keys, SLICE).orderBy(F.desc("_t"), F.desc("row"))
    if candidate is None:
        lend = None
        nearest, first = F.lag("row").over(backwards), F.col("row")
    else:
        lend = candidate(F.col("row"))
        chosen = F.when(lend, F.col("row"))
        start = Window.unboundedPreceding
        nearest = F.last(chosen, ignorenulls=True).over(backwards.rowsBetween(start, -1))
        first = F.last(chosen, ignorenulls=True).over(backwards.rowsBetween(start, 0))
    if span >= ahead:
        copied = with_halo(rows, F.col("_t"), ahead, span, lend)
        # Shuffled before `chosen`, a second copy of the row, is worked out.
        found = copied.repartition(*keys, SLICE).select(*keys, "row", OWN, nearest.alias("following"))
        return found.filter(OWN).select(*keys, "row", "following")

    found = _sliced(rows, keys, span).select(
        *keys, SLICE, "row", nearest.alias("following"),
        F.when(F.lead("_t").over(backwards).isNull(), F.struct(first.alias("first"))).alias("_slice_start"),
    )
    starts = found.filter(F.col("_slice_start").isNotNull())
    along = Window.partitionBy(*keys).orderBy(F.desc(SLICE)).rowsBetween(Window.unboundedPreceding, -1)
    later = starts.select(
        *keys, SLICE, F.last("_slice_start.first", ignorenulls=True).over(along).alias("_later"),
    )
    return found.join(later, [*keys, SLICE], "left").select(
        *keys, "row", F.coalesce("following", "_later").alias("following"),
    )


@dataclass(frozen=True)
class Rule:
    """How a one-bit state moves from a row to the next one of its key.

    Each function gets the row before and the row itself as structs. Where
    `resets` holds, or there is no row before, the state becomes `start`;
    otherwise it is the previous state, inverted where `flips` holds. Rows
    further apart than the reach must reset.
    """

    start: Callable[[Column], Column]
    resets: Callable[[Column, Column], Column]
    flips: Callable[[Column, Column], Column]


def _xor(*bits: Column) -> Column:
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseXOR(bit)
    return total


def _run(
    frame: DataFrame, over, resets: str, start: str, flips: str, out: str, *others: Column,
) -> DataFrame:
    """State after each row: the last reset's value, inverted once per flip since.

    At a reset the parity of all flips so far is folded into the value, so a
    running sum and a running last are enough. `others` are further columns over
    the same window, worked out in the same pass.
    """
    so_far = over.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parity = F.pmod(F.sum(flips).over(so_far), F.lit(2)).cast("int")
    frame = frame.select("*", parity.alias("_parity"), *others)
    base = F.when(F.col(resets), _xor(F.col(start), F.col("_parity")))
    state = _xor(F.last(base, ignorenulls=True).over(so_far), F.col("_parity"))
    return frame.select("*", state.alias(out))


def alternation(
    events: DataFrame, keys: list[str], row: Column, rule: Rule, reach: Duration,
    width: Duration | None = None,
) -> DataFrame:
    """Rows with the state after them and their neighbours within the key.

    `row` is a struct whose first field `t` is the event time in microseconds
    and whose leading fields order the rows of a key without ties. The result
    has the keys and `row`, `state` (0 or 1), `before` and `after`: the
    neighbouring rows, where a neighbour in another slice only counts within
    the reach. Rows without a key are left out.
    """
    ahead = to_micros(reach)
    span = slice_micros(ahead, width)
    rows = _sliced(_keyed(events, keys, row), keys, span)
    within = Window.partitionBy(*keys, SLICE).orderBy("_t", "row")
    rows = rows.select(
        "*",
        F.lag("row").over(within).alias("before"),
        F.lead("row").over(within).alias("after"),
    )
    head = F.col("before").isNull()
    rows = rows.select(
        "*",
        F.when(head, True).otherwise(rule.resets(F.col("before"), F.col("row"))).alias("_reset"),
        rule.start(F.col("row")).cast("int").alias("_start"),
        F.when(head, 0).otherwise(rule.flips(F.col("before"), F.col("row")).cast("int")).alias("_flip"),
    )
    so_far = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fixed = F.last(F.when(F.col("_reset") & ~head, True), ignorenulls=True).over(so_far)
    rows = _run(
        rows, within, "_reset", "_start", "_flip", "state", fixed.isNull().alias("_open"),
    )

    edges = _edges(rows, keys, rule, ahead, span)
    joined = rows.join(edges, [*keys, SLICE], "left")
    corrected = F.when(
        F.col("_open"), _xor(F.col("state"), F.coalesce("_turn", F.lit(0))),
    ).otherwise(F.col("state"))
    return joined.select(
        *keys, "row", corrected.alias("state"),
        F.coalesce("before", "_tail_before").alias("before"),
        F.coalesce("after", "_head_after").alias("after"),
    )


def _edges(rows: DataFrame, keys: list[str], rule: Rule, ahead: int, span: int) -> DataFrame:
    """Per slice that may touch a neighbour: what the neighbours change in it.

    `_turn` is 1 where the state at the slice's start differs from the one
    assumed; `_tail_before` and `_head_after` are the rows next to the slice.
    """
    offset = F.pmod(F.col("_t"), F.lit(span))
    is_head = F.col("before").isNull() & (offset <= ahead)
    is_tail = F.col("after").isNull() & (span - offset <= ahead)
    edge = F.struct("row", "state", "_open")
    summary = (
        rows.filter(is_head | is_tail)
        .groupBy(*keys, SLICE)
        .agg(
            F.max(F.when(is_head, edge)).alias("head"),
            F.max(F.when(is_tail, edge)).alias("tail"),
        )
    )
    along = Window.partitionBy(*keys).orderBy(SLICE)
    summary = summary.select(
        "*",
        F.lag("tail").over(along).alias("previous"),
        F.lead("head").over(along).alias("following"),
    )
    before, first = F.col("previous.row"), F.col("head.row")
    touching = F.coalesce(first["t"] - before["t"] <= ahead, F.lit(False))
    reaching = F.col("following.row.t") - F.col("tail.row.t") <= ahead
    passes = touching & ~rule.resets(before, first)
    flip = rule.flips(before, first).cast("int")
    # A reset by the neighbour and a slice without one start alike, so only a
    # state that passes in can differ from what the slice assumed.
    carried = passes & F.coalesce(F.col("tail._open"), F.lit(False))
    summary = summary.select(
        "*",
        passes.alias("_passes"),
        F.when(passes, flip).otherwise(0).alias("_enter"),
        (~carried).alias("_reset"),
        F.col("tail.state").alias("_start"),
        F.when(carried, _xor(flip, F.col("head.state"), F.col("tail.state"))).otherwise(0).alias("_flip"),
    )
    summary = _run(summary, along, "_reset", "_start", "_flip", "_end")
    entering = F.lag("_end").over(along)
    return summary.select(
        *keys, SLICE,
        F.when(
            F.col("_passes"), _xor(entering, F.col("_enter"), F.col("head.state")),
        ).otherwise(0).alias("_turn"),
        F.when(touching, before).alias("_tail_before"),
        F.when(reaching, F.col("following.row")).alias("_head_after"),
    )
