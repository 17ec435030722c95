"""Packing documents into sequences by minimum bin slack.

Documents become pieces of at most `capacity` tokens. What decides is how many pieces there are
of each length, `capacity` numbers whatever the size of the corpus. From them the bins are
filled one after the other: the longest length left is put in, and a subset-sum over the
lengths available, held as the bits of one integer, finds the fullest combination beside it.
The combination is removed and the next bin follows. As long as enough
pieces of each of its lengths are left, the same combination is again the fullest, so it is
taken as often as it fits at once. Each time a length runs short of what the combination takes,
and then fewer than capacity / length of it are left; there are at most some capacity *
log(capacity) combinations, which is what every task gets.

Pieces find their places by rank: tasks number the pieces of each length as they encode, the
numbers become ranks over all by prefix sums over the tasks' counts, and a rank lies in a
certain combination, bin and place. No piece moves for it, and a length that very many pieces
share is a number like any other.

Null and empty texts have their end id alone. Long texts are cut into pieces of `capacity`
tokens; only the last may be shorter. Repeated rows and rows with equal or null doc_id are
documents of their own. An empty table has no pieces. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eddyline.llm.batches import arrow_schema, binary_array, map_batches, only, spread
from eddyline.llm.chunks import encoded_texts, word_table
from eddyline.session import scratch_path

CAPACITY = 2048

_PIECES = "part int, doc_id long, piece int, start long, length int, place long, ids binary"
_PLACED = "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long"


@dataclass(frozen=True)
class Filling:
    """Lengths that share a bin, with how often each occurs in it, and the number of such bins."""

    lengths: tuple[tuple[int, int], ...]
    times: int


def _multiples(bits: int, length: int, most: int, mask: int) -> int:
    """The sums in `bits`, with 0 to `most` times `length` added."""
    step = 1
    while most:
        step = min(step, most)
        bits |= (bits << (step * length)) & mask
        most -= step
        step *= 2
    return bits


#: Which lengths come first where several combinations are as full: keys to sort them by.
PREFERENCES: tuple[Callable[[int], int], ...] = (
    lambda length: -length,
    lambda length: length,
    lambda length: length * 40503 % 65536,
    lambda length: -(length * 40503 % 65536),
)


def fullest(
    counts: dict[int, int], room: int, preference: Callable[[int], int] = PREFERENCES[0],
) -> list[tuple[int, int]]:
    """Lengths, with how often each is taken, whose sum is the largest up to `room`."""
    mask = (1 << (room + 1)) - 1
    bits, steps = 1, []
    for length in sorted(counts, key=preference):
        if length > room or not counts[length]:
            continue
        steps.append((length, bits))
        bits = _multiples(bits, length, min(counts[length], room // length), mask)
        if bits >> room:
            break
    left, taken = bits.bit_length() - 1, []
    for length, before in reversed(steps):
        times = 0
        while not before >> left & 1:
            left -= length
            times += 1
        if times:
            taken.append((length, times))
    return taken[::-1]


def fill_bins(counts: dict[int, int], capacity: int) -> list[Filling]:
    """Minimum bin slack over the number of pieces of each length, 1 to `capacity`.

    Which of several fullest combinations is taken can make a difference of a few bins in the
    end, so unless the first way needs no more bins than the total length does, the others are
    tried as well and the fewest bins count.
    """
    least = -(-sum(length * count for length, count in counts.items()) // capacity)
    best, fewest = [], None
    for preference in PREFERENCES:
        fillings = _fill(counts, capacity, preference)
        bins = sum(filling.times for filling in fillings)
        if fewest is None or bins < fewest:
            best, fewest = fillings, bins
        if fewest == least:
            break
    return best


def _fill(counts: dict[int, int], capacity: int, preference: Callable[[int], int]) -> list[Filling]:
    left = {length: count for length, count in counts.items() if count}
    fillings = []
    while left:
        longest = max(left)
        beside = dict(left)
        beside[longest] -= 1
        taken = dict(fullest(beside, capacity - longest, preference))
        taken[longest] = taken.get(longest, 0) + 1
        times = min(left[length] // used for length, used in taken.items())
        fillings.append(Filling(tuple(sorted(taken.items(), reverse=True)), times))
        for length, used in taken.items():
            left[length] -= used * times
            if not left[length]:
                del left[length]
    return fillings


class Places:
    """Bin and offset of the piece of a given length and rank."""

    def __init__(self, fillings: list[Filling], capacity: int):
        rows, used, sequence = [], {}, 0
        for filling in fillings:
            offset = 0
            for length, each in filling.lengths:
                first = used.get(length, 0)
                rows.append((length, first, sequence, each, offset))
                used[length] = first + each * filling.times
                offset += length * each
            sequence += filling.times
        rows.sort()
        self.lengths, self.first, self.sequence, self.each, self.offset = (
            np.array([row[column] for row in rows], np.int64) for column in range(5)
        )
        self.bounds = np.searchsorted(self.lengths, np.arange(capacity + 2))

    def find(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.zeros(len(lengths), np.int64)
        for length in np.unique(lengths):
            rows, first = lengths == length, self.bounds[length]
            at[rows] = first + np.searchsorted(self.first[first:self.bounds[length + 1]], ranks[rows], "right") - 1
        beyond = ranks - self.first[at]
        return self.sequence[at] + beyond // self.each[at], self.offset[at] + beyond % self.each[at] * lengths


def _cut(counts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of documents with `counts` ids: each piece's document, number and length."""
    pieces = -(-counts // capacity)
    owners = np.repeat(np.arange(len(counts)), pieces)
    numbers = spread(np.zeros(len(counts), np.int64), pieces)
    return owners, numbers, np.minimum(capacity, counts[owners] - numbers * capacity)


def _piece_writer(tokenizer: str, end: int, capacity: int):
    schema = arrow_schema(_PIECES)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part = word_table(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            row = 0
            for ids, counts in encoded_texts(batch.column("text"), words, end):
                owners, numbers, lengths = _cut(counts, capacity)
                order = np.argsort(lengths, kind="stable")
                of_length = np.bincount(lengths, minlength=capacity + 1)
                places = np.empty(len(lengths), np.int64)
                places[order] = spread(seen, of_length)
                seen += of_length
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(lengths), part), pa.int32()),
                        batch.column("doc_id").take(pa.array(owners + row)), pa.array(numbers, pa.int32()),
                        pa.array(numbers * capacity), pa.array(lengths, pa.int32()), pa.array(places),
                        binary_array(ids.astype("<u4").view(np.uint8), np.r_[0, np.cumsum(lengths)] * 4),
                    ],
                    schema=schema,
                )
                row += len(counts)

    return write


def _placed(batch: pa.RecordBatch, places: Places) -> Iterator[list]:
    lengths = batch.column("length").to_numpy().astype(np.int64)
    sequences, offsets = places.find(lengths, batch.column("rank").to_numpy())
    yield [*[batch.column(name) for name in ("doc_id", "piece", "start")], lengths, batch.column("ids"), sequences, offsets]


def pack_documents(documents: DataFrame, tokenizer: str, end: int, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids, sequence_id and offset of every piece.

    A document's ids are those of its text, then `end`; `ids` holds a piece's as little-endian
    32-bit integers. `tokenizer` is the path of a file that every executor has.
    """
    spark = documents.sparkSession
    folder = scratch_path(spark, "packing")
    texts = only(documents, doc_id="long", text="string")
    texts.mapInArrow(_piece_writer(tokenizer, end, capacity), _PIECES).write.parquet(f"{folder}/pieces")
    pieces = spark.read.schema(_PIECES).parquet(f"{folder}/pieces")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    counts.select(
        "length", "part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"),
    ).write.parquet(f"{folder}/bases")
    bases = spark.read.schema("length int, part int, n long, base long").parquet(f"{folder}/bases")
    # One number per length, at most `capacity` of them.
    totals = bases.groupBy("length").agg(F.sum("n")).collect()
    places = Places(fill_bins({length: count for length, count in totals}, capacity), capacity)
    ranked = pieces.join(bases.drop("n"), ["length", "part"]).withColumn("rank", F.col("base") + F.col("place"))
    return map_batches(ranked, _PLACED, _placed, places)


def packed_sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids (little-endian 32-bit integers) and doc_ids of every sequence.

    A sequence has at most `capacity` ids, and as many pieces at most.
    """
    members = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id")))
    return packed.groupBy("sequence_id").agg(members.alias("members")).select(
        "sequence_id",
        F.aggregate("members", F.lit(b""), lambda ids, row: F.concat(ids, row["ids"])).alias("ids"),
        F.col("members.doc_id").alias("doc_ids"),
    )
