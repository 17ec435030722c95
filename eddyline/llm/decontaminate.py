"""Benchmark decontamination with an FM-index per training shard.

A shard is a few megabytes of whole documents inside a task. Words become numbers: those of
the test phrases have their own, all others end a phrase. Only runs of known words that are as
long as the shortest phrase can hold an occurrence; they are the indexed text. Over it stand
the suffix array, its Burrows-Wheeler transform in a wavelet matrix, and every 16th suffix
position. All phrases are searched backwards at once by wavelet ranks, their occurrences are
located by walking to a sampled position, and overlapping occurrences are merged into spans.

Phrases are the windows of ten words of an item, or the whole of an item of fewer words. They
are searched in blocks of bounded size, each broadcast and passed over the documents in turn.

Null texts have no words. An item without words has no phrases; items of one item_id are one
item, and a null item_id is an item called "null". Copies of a document are documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddyline.llm.batches import map_batches, only, replaced, slices, spread, text_bytes
from eddyline.llm.words import word_bounds, words_of

WINDOW = 10

#: Bytes of test items in one block of phrases.
BLOCK_BYTES = 8 << 20

_END, _FOREIGN = 0, 1
_SAMPLING = 16


class Phrases:
    """The distinct windows of a block of test items."""

    def __init__(self, items: list[tuple[object, str | None]], window: int = WINDOW):
        self.numbers: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            words = [self.numbers.setdefault(word, len(self.numbers) + 2) for word in words_of((text or "").encode())]
            size = min(window, len(words))
            for start in range(len(words) - size + 1 if words else 0):
                found.setdefault(tuple(words[start:start + size]), set()).add("null" if item is None else str(item))
        self.lengths = np.array([len(phrase) for phrase in found], np.int64)
        self.words = np.zeros((len(found), max(map(len, found), default=0)), np.int64)
        for row, phrase in enumerate(found):
            self.words[row, :len(phrase)] = phrase
        self.items = [sorted(names) for names in found.values()]

    @property
    def shortest(self) -> int:
        return int(self.lengths.min()) if len(self.lengths) else 0


class WaveletMatrix:
    """Ranks of symbols in a sequence, for many places at once."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.bits = max(1, int(alphabet - 1).bit_length())
        self.ones, self.zeros = [], []
        for bit in range(self.bits - 1, -1, -1):
            high = (symbols >> bit) & 1
            before = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(high, out=before[1:])
            self.ones.append(before)
            self.zeros.append(len(symbols) - int(before[-1]))
            symbols = np.concatenate((symbols[high == 0], symbols[high == 1]))
        self.begin = self._descend(np.arange(alphabet), np.zeros(alphabet, np.int64))

    def _descend(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            high = (symbols >> (self.bits - 1 - level)) & 1
            before = ones[places]
            places = np.where(high == 1, zeros + before, places - before)
        return places

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its place."""
        return self._descend(symbols, places) - self.begin[symbols]


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in order, by doubling the length that is compared."""
    size = len(symbols)
    ranks = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    width = 1
    while True:
        following = np.zeros(size, np.int64)
        following[:-width or None] = ranks[width:] + 1
        keys = ranks * (size + 1) + following
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        fresh = np.zeros(size, np.int64)
        fresh[order[1:]] = np.cumsum(keys[1:] != keys[:-1])
        ranks = fresh
        if size <= 1 or ranks[order[-1]] == size - 1:
            return order
        width *= 2


class FMIndex:
    """Counts and locations of phrases in a sequence of symbols that ends with symbol 0."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        order = suffix_array(symbols)
        self.last = symbols[order - 1]
        self.tree = WaveletMatrix(self.last, alphabet)
        self.before = np.zeros(alphabet + 1, np.int64)
        np.cumsum(np.bincount(symbols, minlength=alphabet), out=self.before[1:])
        self.sampled = np.where(order % _SAMPLING == 0, order, -1)

    def search(self, words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and past-the-end suffix row of every phrase."""
        rows = np.arange(len(lengths))
        last = words[rows, lengths - 1]
        low, high = self.before[last].copy(), self.before[last + 1].copy()
        for step in range(2, int(lengths.max(initial=0)) + 1):
            rows = rows[(lengths[rows] >= step) & (low[rows] < high[rows])]
            if len(rows) == 0:
                break
            word = words[rows, lengths[rows] - step]
            low[rows] = self.before[word] + self.tree.rank(word, low[rows])
            high[rows] = self.before[word] + self.tree.rank(word, high[rows])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffix rows, from the nearest sampled position before each."""
        places = np.full(len(rows), -1, np.int64)
        open_rows, at, walked = np.arange(len(rows)), rows.copy(), 0
        while len(open_rows):
            known = self.sampled[at]
            places[open_rows[known >= 0]] = known[known >= 0] + walked
            open_rows, at = open_rows[known < 0], at[known < 0]
            symbols = self.last[at]
            at = self.before[symbols] + self.tree.rank(symbols, at)
            walked += 1
        return places


def occurrences(numbers: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Places in `numbers` where phrases begin, and which phrase it is."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(phrases.lengths) or not len(numbers):
        return none
    known = np.zeros(len(numbers) + 2, np.int8)
    known[1:-1] = numbers > _FOREIGN
    steps = np.diff(known)
    starts, ends = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
    lasting = ends - starts >= phrases.shortest
    starts, lengths = starts[lasting], (ends - starts)[lasting]
    if not len(starts):
        return none
    places = np.r_[spread(starts, lengths + 1), -1]  # a run, and one place that ends it
    symbols = np.zeros(len(places), np.int64)
    inside = np.ones(len(places), bool)
    inside[np.cumsum(lengths + 1) - 1] = False
    inside[-1] = False
    symbols[inside] = numbers[places[inside]] - _FOREIGN
    symbols[-1] = 0
    # Every number but the last end moves up by one, so that the end is smallest and unique.
    symbols[:-1] += 1
    index = FMIndex(symbols, len(phrases.numbers) + 3)
    low, high = index.search(phrases.words - _FOREIGN + 1, phrases.lengths)
    which = np.repeat(np.arange(len(low)), high - low)
    return places[index.locate(spread(low, high - low))], which


def _words_of_rows(column: pa.Array, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of all rows, each row closed by an end, and the rows' word counts."""
    get = phrases.numbers.get
    parts, counts = [], []
    for text in column.cast(pa.binary()).to_pylist():
        words = words_of(text or b"")
        parts.append(np.fromiter(map(get, words, repeat(_FOREIGN)), np.int64, len(words)))
        parts.append(np.array([_END], np.int64))
        counts.append(len(words))
    return np.concatenate(parts) if parts else np.zeros(0, np.int64), np.array(counts, np.int64)


def _scan(batch: pa.RecordBatch, phrases: Broadcast) -> Iterator[list]:
    phrases = phrases.value
    lengths = np.diff(text_bytes(batch.column("text"))[1])
    for start, end in slices(lengths):
        part = batch.slice(start, end - start)
        numbers, counts = _words_of_rows(part.column("text"), phrases)
        places, which = occurrences(numbers, phrases)
        offsets = np.r_[0, np.cumsum(counts + 1)]
        rows = np.searchsorted(offsets, places, side="right") - 1
        spans, names = part.column("spans").to_pylist(), part.column("items").to_pylist()
        for row in np.unique(rows).tolist():
            mine = rows == row
            covered = np.zeros(counts[row] + 1, np.int64)
            begin = places[mine] - offsets[row]
            np.add.at(covered, begin, 1)
            np.add.at(covered, begin + phrases.lengths[which[mine]], -1)
            inside = np.cumsum(covered[:-1]) > 0
            for span in spans[row]:
                inside[span["first"]:span["last"] + 1] = True
            edges = np.diff(np.r_[0, inside.astype(np.int8), 0])
            spans[row] = [
                {"first": int(first), "last": int(past) - 1}
                for first, past in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), strict=True)
            ]
            names[row] = sorted({*names[row], *(name for phrase in set(which[mine].tolist()) for name in phrases.items[phrase])})
        carried = [part.column(name) for name in part.schema.names if name not in ("n_words", "spans", "items")]
        yield [*carried, counts, spans, names]


SPANS = "array<struct<first: int, last: int>>"


def mark_phrases(frame: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A frame with a column `text`, and with n_words, spans and items beside its columns.

    `spans` are merged runs of words inside occurrences, `items` the item ids as sorted strings.
    """
    spark = frame.sparkSession
    items = only(benchmark, item_id="string", text="string").filter("text IS NOT NULL").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    marked = frame.withColumns({
        "n_words": F.lit(0).cast("long"),
        "spans": F.array().cast(SPANS),
        "items": F.array().cast("array<string>"),
    })
    kinds = ", ".join(f"`{name}` {kind}" for name, kind in marked.dtypes)
    for block in range(blocks):
        ours = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        phrases = spark.sparkContext.broadcast(Phrases([tuple(row) for row in ours.collect()], window))
        marked = map_batches(marked, kinds, _scan, phrases)
    return marked


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every document."""
    marked = mark_phrases(only(documents, doc_id="long", text="string"), benchmark)
    hits = F.aggregate("spans", F.lit(0).cast("long"), lambda total, span: total + span["last"] - span["first"] + 1)
    return marked.select(
        "doc_id", "n_words", hits.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (hits > 0).alias("contaminated"),
    )


def _cut(batch: pa.RecordBatch) -> Iterator[list]:
    texts = batch.column("text").to_pylist()
    for row, spans in enumerate(batch.column("spans").to_pylist()):
        if spans:
            data = texts[row].encode()
            starts, ends = word_bounds(np.frombuffer(data, np.uint8))
            kept, at = [], 0
            for span in spans:
                kept.append(data[at:starts[span["first"]]])
                at = ends[span["last"]]
            texts[row] = b"".join([*kept, data[at:]]).decode()
    yield [texts if name == "text" else batch.column(name) for name in batch.schema.names if name not in ("n_words", "spans", "items")]


def remove_phrases(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, all columns and rows kept, with the spans cut out of their texts.

    `n_chars`, where it is a column, becomes the new length of the texts that were cut.
    """

    def cut(frame: DataFrame) -> DataFrame:
        kinds = ", ".join(f"`{name}` {kind}" for name, kind in frame.dtypes)
        return map_batches(mark_phrases(frame, benchmark), kinds, _cut)

    return replaced(documents, cut)
