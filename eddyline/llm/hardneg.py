"""Hard negatives by slots of scores.

An anchor's positives are its best rows of the same label. Each positive opens a window of
scores, from `low` to `high` hundredths of its own score, and asks for the best rows of other
labels in it. The windows' upper limits fall with the positives, so together they cut the
scores into disjoint slots: slot i lies below the limit of positive i and above that of
positive i + 1. A row counts in one slot only, whatever the number of windows that hold it.
Every task keeps the best rows of each anchor and slot (a combiner), these are merged, and the
windows are answered from the last slot upwards: a window's best rows are those of its own
slot, followed by what the next window had before its lower limit was applied. Scores below
every lower limit that a slot serves never leave a task.

The data stay where they are. Anchors come to them in blocks of at most `BLOCK_BYTES`: one
scan per block finds the positives, another one the slots' best rows.

Rows whose id, label or vector is null, or whose vector holds null or non-finite components,
take no part. Components become floor(scale * x), cut off at 2 ** 200; scores are exact and cut
off at the range of a long. Vectors of differing lengths are compared over the components that
both have. Ties go to the smaller vec_id. Repeated ids are rows of their own; rows of the
anchor's own id are never its positives or negatives, and of several rows with an anchor's id
the least (vector, then label) is the anchor. An anchor without positives, and a window
without rows, has no result; an empty table gives an empty one. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eddyline.llm.batches import arrow_schema, only
from eddyline.llm.products import LEAST, MOST, exact_products
from eddyline.session import scratch_path

#: Bytes of anchor vectors that one scan carries along.
BLOCK_BYTES = 16 << 20

#: Anchors, and data rows, whose scores are held as one matrix.
ANCHORS_AT_ONCE = 1024
ROWS_AT_ONCE = 1024

_LARGEST = 2.0 ** 200
_VECTORS = "vec_id long, label long, vector array<double>"
_FOUND = "anchor_id long, slot int, vec_id long, score long"


def _usable(embeddings: DataFrame, scale: int) -> DataFrame:
    rows = only(embeddings, vec_id="long", label="long", embedding="array<double>")

    def bad(value: Column) -> Column:
        return value.isNull() | F.isnan(value) | (F.abs(value) == float("inf"))

    def whole(value: Column) -> Column:
        scaled = F.greatest(F.lit(-_LARGEST), F.least(F.lit(_LARGEST), value * scale))
        return F.when(F.abs(scaled) < float(1 << 53), F.floor(scaled).cast("double")).otherwise(scaled)

    present = rows.filter("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
    return present.filter(~F.exists("embedding", bad)).select(
        "vec_id", "label", F.transform("embedding", whole).alias("vector"),
    )


def _matrix(vectors: pa.Array | list, width: int) -> np.ndarray:
    matrix = np.zeros((len(vectors), width))
    if isinstance(vectors, pa.Array):
        lengths = np.diff(vectors.offsets.to_numpy())
        if len(lengths) and (lengths == width).all():
            return vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        vectors = vectors.to_pylist()
    for row, values in enumerate(vectors):
        matrix[row, :min(width, len(values))] = values[:width]
    return matrix


class Best:
    """The k best (score, id) of every group: higher scores first, ties to the smaller id."""

    def __init__(self, groups: int, k: int):
        self.k = k
        self.scores = np.full((groups, k), LEAST)
        self.ids = np.full((groups, k), MOST)
        self.held = np.zeros(groups, np.int64)

    def offer(self, groups: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        worst, worst_id = self.scores[groups, -1], self.ids[groups, -1]
        better = (self.held[groups] < self.k) | (scores > worst) | ((scores == worst) & (ids < worst_id))
        groups, scores, ids = groups[better], scores[better], ids[better]
        if not len(groups):
            return
        touched, place = np.unique(groups, return_inverse=True)
        old = np.arange(self.k)[None, :] < self.held[touched][:, None]
        place = np.r_[place, np.nonzero(old)[0]]
        scores, ids = np.r_[scores, self.scores[touched][old]], np.r_[ids, self.ids[touched][old]]
        order = np.lexsort((ids, ~scores, place))
        place, scores, ids = place[order], scores[order], ids[order]
        counts = np.bincount(place, minlength=len(touched))
        rank = np.arange(len(place)) - np.repeat(np.cumsum(counts) - counts, counts)
        first = rank < self.k
        at = touched[place[first]], rank[first]
        self.scores[at], self.ids[at] = scores[first], ids[first]
        self.held[touched] = np.minimum(counts, self.k)

    def least(self) -> np.ndarray:
        """Per group, the score that a further row has to reach."""
        return np.where(self.held == self.k, self.scores[:, -1], LEAST)


class Anchors:
    """A block of anchors, and per anchor the slots' upper limits and least useful scores.

    `limits` fall from slot to slot; a slot without a positive is not `open`. Positives are
    searched in one slot without limits, among rows of the `same` label.
    """

    def __init__(self, ids, labels, matrix, k, limits=None, least=None, opened=None):
        self.ids, self.labels, self.matrix, self.k = ids, labels, matrix, k
        self.same = limits is None
        shape = (len(ids), 1)
        self.limits = np.full(shape, MOST) if limits is None else limits
        self.least = np.full(shape, LEAST) if least is None else least
        self.opened = np.ones(shape, bool) if opened is None else opened

    def search(self, best: Best, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> None:
        """Offer the rows to the slots in which their scores lie."""
        slots = self.limits.shape[1]
        for start in range(0, len(self.ids), ANCHORS_AT_ONCE):
            part = slice(start, start + ANCHORS_AT_ONCE)
            scores = exact_products(rows, self.matrix[part])
            wanted = np.maximum(self.least[part], best.least().reshape(-1, slots)[part])
            wanted = np.where(self.opened[part], wanted, MOST).min(axis=1)
            useful = (labels[:, None] == self.labels[part]) == self.same
            useful &= (scores >= wanted) & (scores <= self.limits[part, 0]) & self.opened[part, 0]
            useful &= ids[:, None] != self.ids[part]
            row, anchor = np.nonzero(useful)
            score, anchor = scores[row, anchor], anchor + start
            slot = ((score[:, None] <= self.limits[anchor]) & self.opened[anchor]).sum(axis=1) - 1
            inside = score >= self.least[anchor, slot]
            best.offer((anchor * slots + slot)[inside], score[inside], ids[row[inside]])


def _scan(vectors: DataFrame, anchors: Anchors) -> DataFrame:
    """anchor_id, slot, vec_id and score: each task's best rows of every anchor and slot."""
    schema, shared = arrow_schema(_FOUND), vectors.sparkSession.sparkContext.broadcast(anchors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = shared.value
        slots, width = anchors.limits.shape[1], anchors.matrix.shape[1]
        best = Best(len(anchors.ids) * slots, anchors.k)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                ids, labels = (part.column(name).to_numpy() for name in ("vec_id", "label"))
                anchors.search(best, ids, labels, _matrix(part.column("vector"), width))
        group, place = np.nonzero(np.arange(best.k)[None, :] < best.held[:, None])
        for start in range(0, len(group), 1 << 16):
            some, rank = group[start:start + (1 << 16)], place[start:start + (1 << 16)]
            columns = [anchors.ids[some // slots], some % slots, best.ids[some, rank], best.scores[some, rank]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, field.type) for column, field in zip(columns, schema, strict=True)], schema=schema,
            )

    return vectors.mapInArrow(run, _FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of every anchor and slot over all tasks, with their `rank`."""
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hundredths(scores: np.ndarray, part: int, upwards: bool) -> np.ndarray:
    """part * score / 100 as whole numbers, rounded down or upwards, without overflow."""
    whole, rest = np.divmod(scores, 100)
    return whole * part + (-(-rest * part // 100) if upwards else rest * part // 100)


def _limited(block: Anchors, positives: np.ndarray, counts: np.ndarray, k: int, low: int, high: int) -> Anchors:
    opened = np.arange(positives.shape[1])[None, :] < counts[:, None]
    least, limits = hundredths(positives, low, True), hundredths(positives, high, False)
    return Anchors(block.ids, block.labels, block.matrix, k, limits, least, opened)


def _windows(positives: DataFrame, slots: DataFrame, count: int, k: int) -> DataFrame:
    """Merge the slots from the last one upwards; a window adds its lower limit."""
    member = F.struct("rank", "vec_id", "score")
    lists = slots.groupBy("anchor_id").agg(
        *[F.array_sort(F.collect_list(F.when(F.col("slot") == slot, member))).alias(f"s{slot}") for slot in range(count)]
    )
    reached = {count: F.array().cast("array<struct<rank: int, vec_id: bigint, score: bigint>>")}
    for slot in range(count - 1, -1, -1):
        reached[slot] = F.slice(F.concat(F.col(f"s{slot}"), reached[slot + 1]), 1, k)
    merged = lists.select("anchor_id", F.array(*[reached[slot] for slot in range(count)]).alias("reached"))
    joined = positives.join(merged, "anchor_id")
    inside = F.filter(F.element_at("reached", F.col("place")), lambda row: row["score"] >= F.col("least"))
    opened = joined.select("anchor_id", "positive_id", "positive_score", F.posexplode(inside).alias("at", "negative"))
    return opened.select(
        "anchor_id", "positive_id", (F.col("at") + 1).alias("rank"),
        F.col("negative.vec_id").alias("negative_id"), "positive_score",
        F.col("negative.score").alias("negative_score"),
    )


def hard_negatives(
    embeddings: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
    scale: int = 256, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    Anchors are the rows with `is_anchor` (on vec_id). A negative fits a positive if
    low * positive_score <= 100 * negative_score <= high * positive_score.
    """
    spark = embeddings.sparkSession
    folder = scratch_path(spark, "hardneg")
    _usable(embeddings, scale).write.parquet(f"{folder}/vectors")
    vectors = spark.read.schema(_VECTORS).parquet(f"{folder}/vectors")
    anchors = vectors.filter(is_anchor).groupBy("vec_id").agg(F.min(F.struct("vector", "label")).alias("row"))
    width = vectors.agg(F.max(F.size("vector"))).first()[0] or 1
    blocks = -(-anchors.count() * width * 8 // block_bytes)
    block = F.pmod(F.xxhash64("vec_id"), F.lit(max(1, blocks))).cast("int")
    anchors.select("vec_id", "row.vector", "row.label", block.alias("block")).write.partitionBy("block").parquet(
        f"{folder}/anchors",
    )
    kinds = "anchor_id long, place int, positive_id long, positive_score long, least long"
    for number in range(blocks):
        rows = spark.read.schema(f"{_VECTORS}, block int").parquet(f"{folder}/anchors").filter(F.col("block") == number)
        rows = rows.select("vec_id", "label", "vector").toArrow().sort_by("vec_id").combine_chunks()
        ids, labels = (rows.column(name).to_numpy() for name in ("vec_id", "label"))
        matrix = _matrix(rows.column("vector").to_pylist(), width)
        plain = Anchors(ids, labels, matrix, positives)
        found = _ranked(_scan(vectors, plain), positives).toArrow().to_pandas()
        found = found.sort_values(["anchor_id", "rank"])
        place, rank = np.searchsorted(ids, found["anchor_id"].to_numpy()), found["rank"].to_numpy() - 1
        scores, counts = np.full((len(ids), positives), LEAST), np.bincount(place, minlength=len(ids))
        scores[place, rank] = found["score"].to_numpy()
        limited = _limited(plain, scores, counts, negatives, low, high)
        found["least"] = limited.least[place, rank]
        spark.createDataFrame(
            found[["anchor_id", "rank", "vec_id", "score", "least"]].itertuples(index=False, name=None), kinds,
        ).write.parquet(f"{folder}/positives/{number}")
        _ranked(_scan(vectors, limited), negatives).write.parquet(f"{folder}/slots/{number}")
    if not blocks:
        return spark.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long",
        )
    chosen = spark.read.schema(kinds).parquet(*[f"{folder}/positives/{number}" for number in range(blocks)])
    slots = spark.read.schema(f"{_FOUND}, rank int").parquet(*[f"{folder}/slots/{number}" for number in range(blocks)])
    return _windows(chosen, slots, positives, negatives)
