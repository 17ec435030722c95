"""Quality by ordinal cumulative-link regression on graded ratings.

A text is a bag of hashed pieces: its words, and the shapes of its chunks between white space
(runs of small letters, capitals and digits shortened, other signs kept), and chunks that repeat
the one before. One weight vector serves all grades; ordered thresholds t0 < t1 < ... give

    P(grade <= k) = sigmoid(t_k - w . x)

and from it the expected grade and the tail probability P(grade >= least) that selects.

Ratings are graded 0 (low quality), 1 (good, but toxic) and 2 (good). Fitting takes at most
`sample` rated documents, the first by hash of doc_id, without those held out by crc32. Null
texts are empty; an empty text has no features and is judged by the thresholds alone. Without
ratings nothing is known, and every text is kept with expected grade 0 and tail 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddyline.llm.batches import map_batches, only, slices, text_bytes
from eddyline.llm.toxicity import labelled_sample
from eddyline.llm.words import mixed, powers, word_bounds, word_hashes

#: Rated documents that fitting takes at most.
SAMPLE = 4000

#: Buckets of shapes and of words.
SHAPES = 1 << 12
WORDS = 1 << 15

#: Weight of the words beside the shapes.
WORD_SCALE = 0.2

GRADES = 3
LEAST_GRADE = 1
KEEP_FROM = 0.5

_BASE = 0xC6A4A7935BD1E995
_INVERSE = pow(_BASE, -1, 1 << 64)


def _classes() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[[9, 10, 11, 12, 13, 32]] = 0
    table[48:58] = 1
    table[65:91] = 2
    table[97:123] = 3
    table[128:] = 3
    return table


_CLASS = _classes()
_STIRRED = mixed(np.arange(1, 257, dtype=np.uint64))


def _range_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_STIRRED[codes] * powers(_BASE, len(codes)), out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * powers(_INVERSE, len(codes) + 1)[starts])


def text_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, bucket and value of the features of consecutive texts, ordered by row."""
    rows = len(offsets) - 1
    # A line feed between texts keeps chunks apart.
    apart = np.full(len(data) + rows, 10, np.uint8)
    apart[np.arange(len(data)) + np.repeat(np.arange(rows), np.diff(offsets))] = data
    begin = offsets[:-1] + np.arange(rows)
    classes = _CLASS[apart]
    inside = np.zeros(len(apart) + 2, np.int8)
    inside[1:-1] = classes != 0
    steps = np.diff(inside)
    starts, ends = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
    owner = np.searchsorted(begin, starts, "right") - 1
    fresh = np.r_[True, classes[1:] != classes[:-1]][:len(classes)] | (classes == 0)
    place = np.r_[0, np.cumsum(fresh)]
    shape = _range_hashes(classes[fresh], place[starts], place[ends])
    whole = _range_hashes(apart, starts, ends)
    again = np.r_[False, (whole[1:] == whole[:-1]) & (owner[1:] == owner[:-1])][:len(whole)]
    shape_bucket = np.where(again, 0, 1 + (shape % np.uint64(SHAPES - 1)).astype(np.int64))
    first, past = word_bounds(apart)
    word_owner = np.searchsorted(begin, first, "right") - 1
    word_bucket = SHAPES + (word_hashes(apart, first, past) % np.uint64(WORDS)).astype(np.int64)
    keys, counts = np.unique(
        np.r_[owner, word_owner].astype(np.int64) * (SHAPES + WORDS) + np.r_[shape_bucket, word_bucket], return_counts=True,
    )
    row, bucket = keys // (SHAPES + WORDS), keys % (SHAPES + WORDS)
    is_word = bucket >= SHAPES
    chunks, words = np.bincount(owner, minlength=rows), np.bincount(word_owner, minlength=rows)
    value = np.where(is_word, WORD_SCALE * counts / np.maximum(words, 1)[row], counts / np.maximum(chunks, 1)[row])
    return row, bucket, value


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def judge(self, sums: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Expected grade and P(grade >= least) for sums w . x."""
        below = 1 / (1 + np.exp(-np.clip(self.thresholds[None, :] - sums[:, None], -30, 30)))
        return (1 - below).sum(axis=1), 1 - below[:, least - 1]


def fit_ordinal(
    row: np.ndarray, bucket: np.ndarray, value: np.ndarray, grades: np.ndarray, count: int = GRADES,
    steps: int = 200, ridge: float = 1e-4,
) -> Model:
    """Weights and ordered thresholds of most likelihood, by Adam over all rows at once."""
    size, rows = SHAPES + WORDS, len(grades)
    shares = np.cumsum(np.bincount(grades, minlength=count) + 0.5)[:-1]
    shares = shares / (rows + 0.5 * count)
    start = np.log(shares / (1 - shares))
    # Thresholds are the first one and the logarithms of the gaps.
    free = np.r_[start[0], np.log(np.maximum(np.diff(start), 1e-3))]
    parameters = np.r_[np.zeros(size), free]
    mean, square = np.zeros(len(parameters)), np.zeros(len(parameters))

    def thresholds() -> np.ndarray:
        tail = parameters[size:]
        return tail[0] + np.r_[0.0, np.cumsum(np.exp(tail[1:]))]

    for step in range(1, steps + 1):
        ordered = thresholds()
        sums = np.bincount(row, value * parameters[:size][bucket], rows)
        edges = np.c_[np.full(rows, -40.0), ordered[None, :] - sums[:, None], np.full(rows, 40.0)]
        chance = 1 / (1 + np.exp(-np.clip(edges, -40, 40)))
        density = chance * (1 - chance)
        index = np.arange(rows)
        likely = np.maximum(chance[index, grades + 1] - chance[index, grades], 1e-12)
        pull = (density[index, grades + 1] - density[index, grades]) / likely / rows
        slope = np.zeros(len(parameters))
        slope[:size] = np.bincount(bucket, value * pull[row], size) + ridge * parameters[:size]
        by_edge = np.zeros(count - 1)
        for edge in range(1, count):
            upper, lower = grades + 1 == edge, grades == edge
            by_edge[edge - 1] = -(density[upper, edge] / likely[upper]).sum() / rows + (density[lower, edge] / likely[lower]).sum() / rows
        gaps = np.exp(parameters[size + 1:])
        slope[size] = by_edge.sum()
        for gap in range(count - 2):
            slope[size + 1 + gap] = by_edge[gap + 1:].sum() * gaps[gap]
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope * slope
        parameters -= 0.3 * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
    return Model(parameters[:size].copy(), thresholds())


def _sparse(batch: pa.RecordBatch) -> Iterator[list]:
    data, offsets = text_bytes(batch.column("text"))
    for start, end in slices(np.diff(offsets)):
        part = offsets[start:end + 1]
        row, bucket, value = text_features(data[part[0]:part[-1]], part - part[0])
        cuts = np.searchsorted(row, np.arange(end - start + 1))
        yield [
            batch.column("label").slice(start, end - start),
            pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(bucket, pa.int32())),
            pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(value)),
        ]


def fit_quality(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """The model for `documents` rated by `labels` (quality and toxic), or None without ratings."""
    frame = only(documents, doc_id="long", text="string")
    marks = only(labels, doc_id="long", quality="int", toxic="int")
    grade = F.when(F.col("quality") == 0, 0).when(F.col("quality") == 1, F.when(F.col("toxic") == 1, 1).otherwise(2))
    rated = labelled_sample(frame, marks, grade, sample)
    rows = map_batches(rated.select("text", "label"), "label int, buckets array<int>, shares array<double>", _sparse).toLocalIterator()
    grades, sizes, buckets, values = [], [], [], []
    for label, bucket, value in rows:  # at most `sample` rows
        grades.append(label)
        sizes.append(len(bucket))
        buckets.append(np.array(bucket, np.int64))
        values.append(np.array(value))
    if not grades:
        return None
    row = np.repeat(np.arange(len(grades)), sizes)
    return fit_ordinal(row, np.concatenate(buckets), np.concatenate(values), np.array(grades))


def judged(batch: pa.RecordBatch, model: Model | None, least: int) -> tuple[np.ndarray, np.ndarray]:
    if model is None:
        return np.zeros(batch.num_rows), np.ones(batch.num_rows)
    data, offsets = text_bytes(batch.column("text"))
    sums = np.zeros(batch.num_rows)
    for start, end in slices(np.diff(offsets)):
        part = offsets[start:end + 1]
        row, bucket, value = text_features(data[part[0]:part[-1]], part - part[0])
        sums[start:end] = np.bincount(row, value * model.weights[bucket], end - start)
    return model.judge(sums, least)


def _judged(batch: pa.RecordBatch, model: Model | None, least: int) -> Iterator[list]:
    yield [*[batch.column(name) for name in batch.schema.names if name != "text"], *judged(batch, model, least)]


def quality_scores(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, expected_grade, tail_probability and selected of every document."""
    model = fit_quality(documents, labels, sample)
    frame = only(documents, doc_id="long", text="string")
    scored = map_batches(frame, "doc_id long, expected_grade double, tail_probability double", _judged, model, LEAST_GRADE)
    return scored.withColumn("selected", F.col("tail_probability") >= KEEP_FROM)


def select_quality(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents, all columns kept, that the classifier selects."""
    model = fit_quality(documents, labels, sample)
    names = documents.columns
    unique = documents.toDF(*[f"c{place}" for place in range(len(names))])
    text = F.col(f"c{names.index('text')}")
    framed = unique.select(F.struct("*").alias("row"), text.alias("text"))

    def select(batch: pa.RecordBatch) -> Iterator[list]:
        kept = pa.array(judged(batch, model, LEAST_GRADE)[1] >= KEEP_FROM)
        yield [batch.column("row").filter(kept)]

    kept = map_batches(framed, f"row {dict(framed.dtypes)['row']}", select)
    return kept.select("row.*").toDF(*names)
