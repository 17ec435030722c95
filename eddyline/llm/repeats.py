"""Removal of long strings that occur twice, by merging Burrows-Wheeler transforms of shards.

A byte goes if a string of `length` bytes that also starts anywhere else covers it.

* The suffixes that can matter are dealt into buckets by the least hash among the 32-byte grams
  of their first `length` bytes, their anchor. Equal strings have equal anchors, at one distance,
  so a bucket holds all suffixes that may share a long prefix, and a bucket with one anchor
  holds none. A run of suffixes with one anchor travels as one piece of text.
* In a bucket, each shard (texts by hash) keeps the transform of its suffixes: their order with
  equal ones collapsed to an interval. The transforms are merged by refining their interleave:
  all rows begin as one block per distance from the anchor; each round reads the next symbol, a
  block of an eighth of `length` bytes, and parts the rows of a block that differ in it. Rows
  that stand alone are settled at once, so no suffix is sorted anew. The round in which two rows
  part is their common prefix in symbols; blocks that remain after eight rounds are the repeated
  intervals.
* Pieces that are equal as wholes are counted by digest, in all buckets; those that one text has
  several times travel once. Counts are combined before the shuffle and joined back, so that no
  task holds a hot bucket.
* A bucket with more than `most_anchors` anchors is refined without bringing its rows together. Its
  pieces are cut into parts, each of some neighbouring distances from the anchor. The suffixes of a
  part have a core in common: if it comes once, none of them is repeated. If the whole part comes
  twice, all are. Only the suffixes of other parts become rows, which are counted likewise.

Rows with equal texts are counted first; all bytes of such a text go, if it is long enough.
Null texts are empty, and nothing goes from texts shorter than `length`.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.llm.batches import arrow_schema, map_batches, only, replaced, slices, spread, text_bytes
from eddyline.llm.words import mixed, powers
from eddyline.session import scratch_path

LENGTH = 200
GRAM = 32

#: Anchors up to which a bucket is merged in one task: at most 1.5 MB of text and 700,000 suffixes.
#: Beyond, parts of a piece become rows that are shuffled, which costs more.
MOST_ANCHORS = 4096

#: Symbols of a suffix that are compared one after the other.
SYMBOLS = 8

#: Tasks over which the runs of one anchor are dealt when its count is joined back.
SALTS = 32

_SEGMENT = 1 << 22
_MERGE_BYTES = 1 << 20
_LOW = np.uint64((1 << 24) - 1)
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_OTHER = 0xAF251AF3B0F025B5
_OTHER_INVERSE = pow(_OTHER, -1, 1 << 64)
_SALT = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))

TEXT_KEYS = ("h", "g")


def text_keys(text: Column) -> list[Column]:
    """128 bits that stand for a text."""
    return [F.xxhash64(text).alias("h"), F.xxhash64(F.lit("second"), text).alias("g")]


class Hashes:
    """Hashes of any ranges of a buffer, from prefix sums."""

    def __init__(self, data: np.ndarray, base: int = _BASE, inverse: int = _INVERSE):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_SALT[data] * powers(base, len(data)), out=self.sums[1:])
        self.inverse = powers(inverse, len(data) + 1)

    def of(self, starts: np.ndarray, length: int) -> np.ndarray:
        return mixed((self.sums[starts + length] - self.sums[starts]) * self.inverse[starts])


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every `width` neighbours, from least values within blocks of that width."""
    size = len(values)
    blocks = np.full(-(-size // width) * width, np.iinfo(values.dtype).max, values.dtype)
    blocks[:size] = values
    blocks = blocks.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    count = size - width + 1
    return np.minimum(backward[:count], forward[width - 1:width - 1 + count])


def anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of suffixes of one text that have one anchor: key, anchor, first and last suffix."""
    parts = []
    for start in range(0, len(data) - length + 1, _SEGMENT):
        piece = data[start:start + _SEGMENT + length - 1]
        hashes = Hashes(piece).of(np.arange(len(piece) - gram + 1), gram)
        places = np.arange(len(hashes), dtype=np.uint64)
        least = sliding_least((hashes & ~_LOW) | places, length - gram + 1)
        at = (least & _LOW).astype(np.int64)
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        last = np.r_[first[1:] - 1, len(at) - 1]
        parts.append((mixed(hashes[at[first]]), at[first] + start, first + start, last + start))
    return tuple(np.concatenate(column) for column in zip(*parts, strict=True))


def _unpacked(column: pa.Array) -> pa.Array:
    unpack = zstandard.ZstdDecompressor().decompress
    return pa.array([unpack(packed) for packed in column.to_pylist()], pa.large_binary())


def _anchors(batch: pa.RecordBatch, length: int, gram: int) -> Iterator[list]:
    data, offsets = text_bytes(_unpacked(batch.column("packed")))
    h, g = (batch.column(name).to_numpy() for name in TEXT_KEYS)
    for start, end in slices(np.diff(offsets)):
        owners, found = [], []
        for row in range(start, end):
            text = data[offsets[row]:offsets[row + 1]]
            if len(text) >= length:
                runs = anchors(text, length, gram)
                owners.append(np.full(len(runs[0]), row))
                found.append(runs)
        if found:
            keys, at, first, last = (np.concatenate(column) for column in zip(*found, strict=True))
            owner = np.concatenate(owners)
            place = at << 16 | (at - first) << 8 | (at - last)
            yield [keys.view(np.int64), h[owner], g[owner], place]


def _compressed(batch: pa.RecordBatch) -> Iterator[list]:
    squeeze = zstandard.ZstdCompressor(level=3).compress
    texts = batch.column("text").cast(pa.binary()).to_pylist()
    yield [*[batch.column(name) for name in batch.schema.names if name != "text"], [squeeze(text or b"") for text in texts]]


def _with_texts(frame: DataFrame) -> DataFrame:
    """The frame with its text compressed to `packed`, for shuffles."""
    kinds = ", ".join(f"`{name}` {kind}" for name, kind in frame.dtypes if name != "text")
    return map_batches(frame, f"{kinds}, packed binary", _compressed)


_PIECES = (
    "key long, h long, g long, at long, back int, fore int, weight int, hot boolean, digest binary, piece binary, "
    "ranges array<struct<first: long, last: long>>"
)


def _joined(ranges: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Ranges in ascending order, those that follow each other as one."""
    joined: list[dict[str, int]] = []
    for first, last in ranges:
        if joined and first == joined[-1]["last"] + 1:
            joined[-1]["last"] = last
        else:
            joined.append({"first": first, "last": last})
    return joined


def _cutter(length: int):
    """Function for mapInArrow that cuts the pieces of text around repeated anchors.

    Equal pieces of one text are one row, at the first place, with the `ranges` of all: they are
    repeated. A piece has its text only the first time that the task meets it; equal ones are
    found by digest.
    """
    schema = arrow_schema(_PIECES)

    def cut(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        told: set[bytes] = set()
        for batch in batches:
            out: list[list] = [[] for _ in schema]
            for h, g, copies, marks, packed in zip(
                *[batch.column(name).to_pylist() for name in ("h", "g", "copies", "marks", "packed")], strict=True,
            ):
                text = unpack(packed)
                met: dict[bytes, list] = {}
                for mark in sorted(marks, key=lambda mark: mark["place"]):
                    at, back, fore = mark["place"] >> 16, mark["place"] >> 8 & 255, mark["place"] & 255
                    piece = text[at - back:at - fore + length]
                    digest = hashlib.blake2b(piece, digest_size=16, salt=bytes([back, fore])).digest()
                    if digest in met:
                        met[digest][-1].append((at - back, at - fore))
                    else:
                        met[digest] = [mark, at, back, fore, piece, [(at - back, at - fore)]]
                for digest, (mark, at, back, fore, piece, ranges) in met.items():
                    if digest in told:
                        piece = None
                    elif len(told) < 1 << 20:
                        told.add(digest)
                    several = len(ranges) > 1
                    for column, value in zip(
                        out,
                        (
                            mark["key"], h, g, at, back, fore, 2 if several or copies > 1 else 1, mark["hot"], digest, piece,
                            _joined(ranges) if several else None,
                        ),
                        strict=True,
                    ):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, field.type) for column, field in zip(out, schema, strict=True)], schema=schema,
            )

    return cut


def merge_transforms(
    keys: np.ndarray, shards: np.ndarray, distances: np.ndarray, starts: np.ndarray, weights: np.ndarray,
    data: np.ndarray, length: int,
) -> np.ndarray:
    """Which suffixes of some buckets begin with `length` bytes that occur twice.

    A row is a suffix: the bucket and shard it belongs to, its distance from the anchor, where it
    starts in `data`, and how many places it stands for.
    """
    hashes = Hashes(data)
    steps = np.linspace(0, length, SYMBOLS + 1).astype(np.int64)
    repeated = np.zeros(len(keys), bool)
    rows = np.arange(len(keys))
    _, blocks = np.unique(keys.astype(np.uint64) ^ mixed(distances.astype(np.uint64) + np.uint64(1)), return_inverse=True)

    def unsettled(rows: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose block stands for two places at least."""
        keep = np.bincount(blocks, weights[rows]) >= 2
        kept = keep[blocks]
        return rows[kept], (np.cumsum(keep) - 1)[blocks[kept]]

    # Rows enter the interleave shard by shard, as their transforms follow each other.
    order = np.argsort(shards, kind="stable")
    rows, blocks = unsettled(rows[order], blocks[order])
    for low, high in zip(steps[:-1], steps[1:], strict=True):
        if not len(rows):
            break
        symbols = hashes.of(starts[rows] + low, int(high - low))
        order = np.lexsort((symbols, blocks))
        rows, blocks, symbols = rows[order], blocks[order], symbols[order]
        parted = (blocks[1:] != blocks[:-1]) | (symbols[1:] != symbols[:-1])
        rows, blocks = unsettled(rows, np.r_[0, np.cumsum(parted)])
    repeated[rows] = True
    return repeated


def _merged(table: pa.Table, length: int) -> list:
    """Ranges of repeated suffixes among the pieces of some whole buckets."""
    pieces = table.column("piece").combine_chunks()
    data, offsets = text_bytes(pieces)
    key, h, g, at, back, fore, weight = (
        table.column(name).to_numpy() for name in ("key", "h", "g", "at", "back", "fore", "weight")
    )
    counts = (back - fore + 1).astype(np.int64)
    owners = np.repeat(np.arange(len(counts)), counts)
    inside = spread(np.zeros(len(counts), np.int64), counts)
    repeated = merge_transforms(
        key[owners], (h & 7)[owners], back[owners] - inside, offsets[:-1][owners] + inside, weight[owners], data, length,
    )
    places = (at - back)[owners] + inside
    rows = np.flatnonzero(repeated)
    fresh = np.r_[True, (owners[rows][1:] != owners[rows][:-1]) | (rows[1:] != rows[:-1] + 1)][:len(rows)]
    first = np.flatnonzero(fresh)
    last = np.r_[first[1:] - 1, len(rows) - 1][:len(first)]
    return [h[owners[rows[first]]], g[owners[rows[first]]], places[rows[first]], places[rows[last]]]


_RANGES = "h long, g long, first long, last long"


def _merger(length: int):
    """Function for mapInArrow over pieces sorted by bucket, which takes whole buckets at a time."""
    schema = arrow_schema(_RANGES)

    def merge(batches):
        held: list[pa.RecordBatch] = []
        size = 0

        def finished(table: pa.Table) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(column, pa.int64()) for column in _merged(table, length)], schema=schema,
            )

        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size < _MERGE_BYTES:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            keys = table.column("key").to_numpy()
            whole = int(np.searchsorted(keys, keys[-1]))
            if whole:
                yield finished(table.slice(0, whole))
            rest = table.slice(whole)
            held, size = rest.to_batches(), rest.nbytes
        if held:
            yield finished(pa.Table.from_batches(held).combine_chunks())

    return merge


_PARTS = "h long, g long, at long, back int, low int, high int, weight int, a long, b long, c long, d long"


def _parts(batch: pa.RecordBatch, length: int, width: int) -> Iterator[list]:
    """The parts of pieces: distances `low` to `high`, digests a, b of the core and c, d of the whole.

    Cores are those of aligned parts of `width` distances, also where the piece has fewer.
    """
    data, offsets = text_bytes(batch.column("piece"))
    back, fore = (batch.column(name).to_numpy().astype(np.int64) for name in ("back", "fore"))
    counts = back // width - fore // width + 1
    owners = np.repeat(np.arange(len(counts)), counts)
    part = spread(fore // width, counts)
    low, high = np.maximum(part * width, fore[owners]), np.minimum(part * width + width - 1, back[owners])
    anchor = (offsets[:-1] + back)[owners]
    hashes = Hashes(data), Hashes(data, _OTHER, _OTHER_INVERSE)
    a, b = (one.of(anchor - part * width, length - width + 1) ^ mixed(part.astype(np.uint64) + np.uint64(1)) for one in hashes)
    c, d = (
        one.of(anchor - high, high - low + length) ^ mixed(edge.astype(np.uint64) + np.uint64(1))
        for one, edge in zip(hashes, (low, high), strict=True)
    )
    h, g, at, weight = (batch.column(name).to_numpy()[owners] for name in ("h", "g", "at", "weight"))
    yield [h, g, at, back[owners], low, high, weight, *[one.view(np.int64) for one in (a, b, c, d)]]


def _suffixes(batch: pa.RecordBatch, length: int) -> Iterator[list]:
    """One row for every suffix of the parts that are `asked` of some pieces."""
    data, offsets = text_bytes(batch.column("piece"))
    asked = batch.column("asked")
    owners = np.repeat(np.arange(batch.num_rows), pc.list_value_length(asked).to_numpy())
    low, high, weight = (pc.struct_field(asked.flatten(), name).to_numpy() for name in ("low", "high", "weight"))
    counts = (high - low + 1).astype(np.int64)
    owners, weight = np.repeat(owners, counts), np.repeat(weight, counts)
    distances = spread(low.astype(np.int64), counts)
    starts = offsets[:-1][owners] + batch.column("back").to_numpy()[owners] - distances
    a, b = (one.of(starts, length).view(np.int64) for one in (Hashes(data), Hashes(data, _OTHER, _OTHER_INVERSE)))
    h, g, at = (batch.column(name).to_numpy()[owners] for name in ("h", "g", "at"))
    yield [a, b, h, g, at - distances, weight]


def _salted(frame: DataFrame, *columns: str) -> DataFrame:
    """The frame with a `salt`, by which `_repeated` deals the rows of one key over many tasks."""
    return frame.withColumn("salt", F.pmod(F.xxhash64(*columns), F.lit(SALTS)).cast("int"))


def _repeated(salted: DataFrame, keys: list[str], count: Column) -> DataFrame:
    """The keys that come more than once and their `times`, one row per `salt` their rows have.

    Counting, combined before the shuffle, notes the salts in a bit mask. Joined back by key and
    salt, the rows of a hot key meet their count in many tasks.
    """
    counted = salted.groupBy(*keys).agg(
        count.alias("times"), F.bit_or(F.expr("shiftleft(1L, salt)")).alias("mask"),
    ).filter("times > 1")
    present = F.expr(f"filter(sequence(0, {SALTS - 1}), each -> (mask & shiftleft(1L, each)) != 0)")
    return counted.select(*keys, "times", F.explode(present).alias("salt"))


def _range(first: Column, last: Column) -> Column:
    return F.array(F.struct(first.cast("long").alias("first"), last.cast("long").alias("last"))).alias("ranges")


def _equal_ranges(salted: DataFrame) -> DataFrame:
    """All suffixes of the pieces that are repeated as wholes."""
    equal = _repeated(salted, ["digest"], F.sum("weight")).select("digest", "salt")
    # Pieces that their text has several times need no count, nor do those of texts with copies, which go as wholes.
    asking = salted.filter("weight = 1").join(equal, ["digest", "salt"], "left_semi")
    return salted.filter("ranges IS NOT NULL").select("h", "g", "ranges").unionByName(
        asking.select("h", "g", _range(F.col("at") - F.col("back"), F.col("at") - F.col("fore"))),
    )


def _hot_ranges(hot: DataFrame, folder: str, length: int, gram: int) -> DataFrame:
    """Ranges of repeated suffixes of hot buckets' pieces, by counts that are joined back."""
    piece = ["h", "g", "at", "back"]
    told = hot.filter("piece IS NOT NULL")
    cut = map_batches(
        told.select(*piece, "fore", "weight", "piece"), _PARTS, _parts, length, math.isqrt(length - gram + 1),
    )
    salted = _salted(cut, *piece, "low")
    cores = _repeated(salted, ["a", "b"], F.sum("weight")).select("a", "b", "salt")
    # Parts whose core comes once have no repeated suffix.
    salted.join(cores, ["a", "b", "salt"], "left_semi").drop("a", "b").write.parquet(f"{folder}/parts")
    parts = hot.sparkSession.read.parquet(f"{folder}/parts")
    wholes = _repeated(parts, ["c", "d"], F.sum("weight")).select("c", "d", "salt")
    equal = parts.join(wholes, ["c", "d", "salt"], "left_semi")

    # Equal parts count as one, which asks for its suffixes only if it comes once.
    different = parts.groupBy("c", "d").agg(
        F.min(F.struct(*piece, "low", "high")).alias("one"), F.least(F.sum("weight"), F.lit(2)).cast("int").alias("weight"),
    )
    asked = different.select("one.*", "weight").groupBy(*piece).agg(
        F.collect_list(F.struct("low", "high", "weight")).alias("asked"),
    )
    rows = map_batches(
        told.select(*piece, "piece").join(asked, piece), "a long, b long, h long, g long, place long, weight int",
        _suffixes, length,
    )
    suffixes = _salted(rows, "h", "g", "place")
    twice = _repeated(suffixes, ["a", "b"], F.sum("weight")).select("a", "b", "salt")
    single = suffixes.filter("weight = 1").join(twice, ["a", "b", "salt"], "left_semi")
    return equal.select("h", "g", _range(F.col("at") - F.col("high"), F.col("at") - F.col("low"))).unionByName(
        single.select("h", "g", _range(F.col("place"), F.col("place"))),
    )


def _spans(batch: pa.RecordBatch, length: int) -> Iterator[list]:
    """Merged byte ranges of a text from its ranges of repeated suffixes."""
    spans = []
    for ranges in batch.column("ranges").to_pylist():
        merged: list[dict[str, int]] = []
        for first, last in sorted((each["first"], each["last"]) for each in ranges):
            if merged and first <= merged[-1]["past"]:
                merged[-1]["past"] = max(merged[-1]["past"], last + length)
            else:
                merged.append({"first": first, "past": last + length})
        spans.append(merged)
    yield [batch.column("h"), batch.column("g"), spans]


SPANS = "array<struct<first: long, past: long>>"


_TEXTS = "h long, g long, size int, packed binary, copies long"


def distinct_texts(texts: DataFrame, folder: str) -> DataFrame:
    """Each text of the column `text` once, as h, g, size in bytes, packed and its copies.

    Copies are combined in the tasks that read them, before the shuffle.
    """
    keyed = texts.select("text", *text_keys(F.col("text")), F.octet_length("text").alias("size"))
    distinct = _with_texts(keyed).groupBy(*TEXT_KEYS).agg(
        F.first("size").alias("size"), F.first("packed").alias("packed"), F.count(F.lit(1)).alias("copies"),
    )
    distinct.select("h", "g", "size", "packed", "copies").write.parquet(f"{folder}/texts")
    return texts.sparkSession.read.schema(_TEXTS).parquet(f"{folder}/texts")


def repeated_spans(
    distinct: DataFrame, folder: str, length: int = LENGTH, gram: int = GRAM, most_anchors: int = MOST_ANCHORS,
) -> DataFrame:
    """h, g and the `spans` that go, for those of the `distinct_texts` that have some.

    `gram` must lie between `length` - 255 and `length`.
    """
    spark = distinct.sparkSession
    if not max(1, length - 255) <= gram <= length:
        raise ValueError("the distance from a suffix to its anchor must fit into a byte")
    long = distinct.filter(F.col("size") >= length)
    found = map_batches(long.select("h", "g", "packed"), "key long, h long, g long, place long", _anchors, length, gram)
    runs = _salted(found, "h", "place")
    counted = _repeated(runs, ["key"], F.count(F.lit(1)))
    repeated = runs.join(
        counted.select("key", "salt", (F.col("times") > most_anchors).alias("hot")), ["key", "salt"],
    ).drop("salt")
    marks = repeated.groupBy(*TEXT_KEYS).agg(F.collect_set(F.struct("key", "place", "hot")).alias("marks"))
    marked = long.select("h", "g", "copies", "packed").join(marks, list(TEXT_KEYS))
    marked.select("h", "g", "copies", "marks", "packed").mapInArrow(_cutter(length), _PIECES).write.parquet(f"{folder}/pieces")
    pieces = spark.read.schema(_PIECES).parquet(f"{folder}/pieces")
    salted = _salted(pieces, "h", "g", "at")
    # Equal pieces are settled by their digest; a bucket has each piece once for every task that met it.
    bucketed = (
        pieces.filter("NOT hot AND piece IS NOT NULL").select("key", "h", "g", "at", "back", "fore", "weight", F.col("piece"))
        .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "key").sortWithinPartitions("key")
    )
    merged = bucketed.mapInArrow(_merger(length), _RANGES)
    whole = long.filter("copies > 1").select("h", "g", _range(F.lit(0), F.col("size") - length))
    ranges = (
        merged.select("h", "g", _range(F.col("first"), F.col("last"))).unionByName(_equal_ranges(salted))
        .unionByName(_hot_ranges(pieces.filter("hot"), folder, length, gram)).unionByName(whole)
    )
    gathered = ranges.groupBy(*TEXT_KEYS).agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
    return map_batches(gathered, f"h long, g long, spans {SPANS}", _spans, length)


def _of_texts(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows, which have the keys of their texts, with what was `found` for the texts.

    The rows of a hot text are dealt over salts, and meet a copy of what was found in each.
    """
    # Maps have no hash; as text they have.
    row = F.col("row").cast("string") if "map<" in dict(rows.dtypes)["row"] else F.col("row")
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(row), F.lit(SALTS)).cast("int"))
    present = salted.groupBy(*TEXT_KEYS, "salt").agg(F.count(F.lit(1)).alias("times")).drop("times")
    return salted.join(found.join(present, list(TEXT_KEYS)), [*TEXT_KEYS, "salt"], "left").drop("salt")


def _kept(text: bytes, spans: list[dict[str, int]] | None) -> bytes:
    parts, at = [], 0
    for span in spans or ():
        parts.append(text[at:span["first"]])
        at = span["past"]
    return b"".join([*parts, text[at:]])


def _digests(batch: pa.RecordBatch) -> Iterator[list]:
    unpack = zstandard.ZstdDecompressor().decompress
    sizes, removed, counts, sums = [], [], [], []
    for packed, spans in zip(batch.column("packed").to_pylist(), batch.column("spans").to_pylist(), strict=True):
        text = unpack(packed)
        kept = _kept(text, spans)
        sizes.append(len(text))
        removed.append(len(text) - len(kept))
        counts.append(len(spans or ()))
        sums.append(hashlib.sha256(kept).hexdigest())
    yield [batch.column("h"), batch.column("g"), sizes, removed, counts, sums]


def repeat_digests(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document."""
    folder = scratch_path(documents.sparkSession, "repeats")
    frame = only(documents, doc_id="long", text="string").withColumn("text", F.coalesce("text", F.lit("")))
    distinct = distinct_texts(frame, folder)
    spans = repeated_spans(distinct, folder, length)
    of_texts = distinct.select("h", "g", "packed").join(spans, list(TEXT_KEYS), "left")
    digests = map_batches(
        of_texts, "h long, g long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", _digests,
    )
    rows = frame.select("doc_id", F.struct("doc_id").alias("row"), *text_keys(F.col("text")))
    return _of_texts(rows, digests).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def whole_characters(text: bytes, spans: list[dict[str, int]]) -> list[dict[str, int]]:
    """Spans without the characters that they cover in part."""
    out = []
    for span in spans:
        first, past = span["first"], span["past"]
        while first < past and text[first] & 0xC0 == 0x80:
            first += 1
        while past > first and past < len(text) and text[past] & 0xC0 == 0x80:
            past -= 1
        out.append({"first": first, "past": past})
    return out


def _cut(batch: pa.RecordBatch) -> Iterator[list]:
    texts = batch.column("text").to_pylist()
    for row, spans in enumerate(batch.column("spans").to_pylist()):
        if spans:
            data = texts[row].encode()
            texts[row] = _kept(data, whole_characters(data, spans)).decode()
    yield [batch.column("row"), texts]


def remove_repeats(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents, all columns and rows kept, without the spans; characters that a span covers
    in part stay. `n_chars`, where it is a column, follows the texts that were cut."""

    folder = scratch_path(documents.sparkSession, "repeats")

    def cut(frame: DataFrame) -> DataFrame:
        spans = repeated_spans(distinct_texts(frame.select(F.coalesce("text", F.lit("")).alias("text")), folder), folder, length)
        keyed = frame.select("row", "text", *text_keys(F.coalesce("text", F.lit(""))))
        joined = _of_texts(keyed, spans).select("row", "text", "spans")
        return map_batches(joined, f"row {dict(frame.dtypes)['row']}, text string", _cut)

    return replaced(documents, cut)
