"""Near-duplicates by DartMinHash signatures and banded joining.

A document is its set of hashed shingles of five words (fewer words make one shingle). Each
element has a random stream of darts over rank time, the same in every document: how many fall
into an interval of ranks follows the Poisson law, by hash, and each dart hits one of the
signature's coordinates. A signature keeps the earliest dart of every coordinate. Intervals double,
and a document throws darts only until all coordinates are hit, so the work for a signature
grows with its size, not with its product with the number of elements. An element that weighs w
has w streams.

Bands of the signature are joined by their hashes. A bucket is never expanded into pairs: it
picks a leader at random, and members are linked to the leader if the exact similarity of the
shingle sets reaches the threshold. Where all members link, the bucket is one class and done.
Where some fail, as among documents made from one template, a bucket's pairs are all in doubt.
The nodes of such open buckets are joined exactly, by prefixes: shingles have one order, about
the rarest first, and two sets of similarity t or more share one of their first n - ceil(t n) + 1
shingles. Pairs of one class need no comparing, so in the group of a prefix shingle only the
nodes outside its largest class are held against the others, about `AT_ONCE` of them at a
time, round by round until none is left. A group's other members are dealt over as many blocks
as their sizes ask for, and in a block common shingles are counted for all at once, so no pair
travels; shingles that the same nodes share make one group. Links give classes by spreading the least label.
Every link is verified. A pair of similarity 0.8 shares no band at all with probability 3e-6; one
that shares a bucket is found whatever else is in it.

Equal shingle sets are one node (by a 64-bit hash), and documents without words are one node per
text; so null and empty texts are copies of each other. Rows with equal or null doc_id are rows
of their own. A class is named by its least doc_id; `class_key` tells classes apart that share it
because ids repeat. Texts of any length are read whole; an empty table has no classes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddyline.llm.batches import binary_array, map_batches, only, slices, spread, text_bytes
from eddyline.llm.words import mixed, shingle_hashes, word_bounds, word_hashes
from eddyline.session import scratch_path

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS = 32
BAND_ROWS = 5

#: Nodes of a prefix shingle's group that are held against the others in one round.
AT_ONCE = 256

#: Shingles of a block of members; and of a set from which on it counts as several of `AT_ONCE`.
BLOCK_SHINGLES = 1 << 20
LARGE_SET = 4096

#: Common shingles that are counted in one step.
COUNTED = 1 << 21

#: Counters for the order of shingles, whatever their number.
COUNTERS = 1 << 20

#: The first interval of ranks lasts to 2 ** -6; documents of more elements throw more darts than needed.
_FIRST = -6
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def _poisson_table(mean: float) -> np.ndarray:
    """Cumulated chances of 0, 1, ... darts, up to where they come to one."""
    size = int(mean + 12 * math.sqrt(mean) + 20)
    counts = np.arange(size)
    logs = counts * math.log(mean) - mean - np.r_[0.0, np.cumsum(np.log(np.maximum(counts[1:], 1)))]
    return np.cumsum(np.exp(logs))


_TABLES = {level: _poisson_table(2.0 ** (_FIRST + max(0, level - 1))) for level in range(17)}


def dart_signatures(elements: np.ndarray, owners: np.ndarray, count: int, size: int) -> np.ndarray:
    """`size` coordinates for each of `count` owners of hashed elements; owners without elements keep
    the largest value everywhere. `owners` ascend."""
    best = np.full(count * size, _EMPTY)
    present = np.zeros(count, bool)
    present[owners] = True
    level = 0
    while present.any():
        elements, owners = (elements[present[owners]], owners[present[owners]]) if level else (elements, owners)
        table = _TABLES[min(level, 16)]
        salt = mixed(np.array([level + 1], np.uint64))[0]
        stream = mixed(elements ^ salt)
        chance = (stream >> np.uint64(11)).astype(np.float64) * 2.0 ** -53
        some = np.flatnonzero(chance >= table[0])
        darts = np.searchsorted(table, chance[some], "right")
        at = np.repeat(some, darts)
        number = spread(np.zeros(len(darts), np.int64), darts).astype(np.uint64)
        dart = mixed(stream[at] + (number + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        coordinate = owners[at] * size + (dart % np.uint64(size)).astype(np.int64)
        open_places = best[coordinate] == _EMPTY
        coordinate, dart = coordinate[open_places], mixed(dart[open_places] ^ salt)
        # The rank within the interval in the upper half, the dart's name in the lower.
        np.minimum.at(best, coordinate, dart)
        level += 1
        present = (best.reshape(count, size) == _EMPTY).any(axis=1)
        present &= np.bincount(owners, minlength=count) > 0
    return best.reshape(count, size) & np.uint64(0xFFFFFFFF)


def _described(batch: pa.RecordBatch, weighted: bool) -> Iterator[list]:
    """Node, size, band hashes and shingles (32 bits each, ascending) of every row."""
    data, offsets = text_bytes(batch.column("text"))
    for start, end in slices(np.diff(offsets)):
        bounds = offsets[start:end + 1] - offsets[start]
        part = data[offsets[start]:offsets[end]]
        rows = end - start
        # A blank between texts keeps words apart.
        apart = np.full(len(part) + rows, 32, np.uint8)
        apart[np.arange(len(part)) + np.repeat(np.arange(rows), np.diff(bounds))] = part
        begin = bounds[:-1] + np.arange(rows)
        first, past = word_bounds(apart)
        owner = np.searchsorted(begin, first, "right") - 1
        shingles, owner = shingle_hashes(word_hashes(apart, first, past), owner, SHINGLE_WORDS)
        order = np.lexsort((shingles, owner))
        shingles, owner = shingles[order], owner[order]
        fresh = np.r_[True, (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])][:len(shingles)]
        if weighted:
            # The n-th time that an element comes is an element of its own.
            place = np.arange(len(shingles))
            shingles = mixed(shingles + (place - np.maximum.accumulate(np.where(fresh, place, 0))).astype(np.uint64))
            order = np.lexsort((shingles, owner))
            shingles, owner = shingles[order], owner[order]
        else:
            shingles, owner = shingles[fresh], owner[fresh]
        sizes = np.bincount(owner, minlength=rows)
        nodes = batch.column("text_key").to_numpy()[start:end].astype(np.int64).view(np.uint64).copy()
        filled = np.flatnonzero(sizes)
        cuts = np.r_[0, np.cumsum(sizes)]
        if len(filled):
            nodes[filled] = mixed(np.add.reduceat(mixed(shingles + np.uint64(77)), cuts[filled]) + sizes[filled].astype(np.uint64))
        signatures = dart_signatures(shingles, owner, rows, BANDS * BAND_ROWS).reshape(rows, BANDS, BAND_ROWS)
        factors = mixed(np.arange(1, BAND_ROWS + 1, dtype=np.uint64)) | np.uint64(1)
        bands = mixed((signatures * factors).sum(axis=2, dtype=np.uint64) + mixed(np.arange(1, BANDS + 1, dtype=np.uint64)))
        band_cuts = np.r_[0, np.cumsum(np.where(sizes > 0, BANDS, 0))]
        short = (shingles >> np.uint64(32)).astype("<u4")
        yield [
            batch.column("doc_id").slice(start, rows), batch.column("text_key").slice(start, rows), nodes.view(np.int64), sizes,
            pa.ListArray.from_arrays(pa.array(band_cuts, pa.int32()), pa.array(bands[sizes > 0].ravel().view(np.int64))),
            binary_array(short.view(np.uint8), cuts * 4),
        ]


_ROWS = "doc_id long, text_key long, node long, size long, bands array<long>, shingles binary"


def _similar(batch: pa.RecordBatch, least: float) -> Iterator[list]:
    """Whether the shingle sets of each pair are similar enough."""
    found = []
    for one, other in zip(batch.column("one").to_pylist(), batch.column("other").to_pylist(), strict=True):
        left, right = np.frombuffer(one, "<u4"), np.frombuffer(other, "<u4")
        if min(len(left), len(right)) < least * max(len(left), len(right)):
            found.append(False)
            continue
        both = np.sort(np.concatenate((left, right)))
        shared = int((both[1:] == both[:-1]).sum())
        found.append(shared >= least * (len(both) - shared) - 1e-9)
    yield [batch.column("leader"), batch.column("node"), found]


def _verified(pairs: DataFrame, sets: DataFrame, path: str, least: float) -> DataFrame:
    """leader, node and whether they are `similar`, of distinct pairs leader and node."""
    spark = pairs.sparkSession
    with_member = pairs.join(sets.withColumnRenamed("shingles", "one"), "node")
    both = with_member.join(sets.select(F.col("node").alias("leader"), F.col("shingles").alias("other")), "leader")
    map_batches(
        both.select("leader", "node", "one", "other"), "leader long, node long, similar boolean", _similar, least,
    ).write.parquet(path)
    return spark.read.schema("leader long, node long, similar boolean").parquet(path)


def verified_links(described: DataFrame, folder: str, least: float = SIMILARITY) -> DataFrame:
    """Pairs leader and node of different shingle sets with at least the given similarity."""
    spark = described.sparkSession
    sets = described.filter("size > 0").groupBy("node").agg(F.first("shingles").alias("shingles"))
    waiting = (
        described.select("node", F.explode("bands").alias("band")).groupBy("band", "node").agg(F.count(F.lit(1)).alias("copies"))
        .select("band", "node")
    )
    rank = F.col("node").bitwiseXOR(F.xxhash64("band"))
    leaders = (
        waiting.groupBy("band").agg(F.min(rank).alias("least"), F.count(F.lit(1)).alias("members")).filter("members > 1")
        .select("band", "members", F.col("least").bitwiseXOR(F.xxhash64("band")).alias("leader"))
    )
    waiting.join(leaders, "band").filter("node <> leader").write.parquet(f"{folder}/bands")
    members = spark.read.schema("band long, node long, members long, leader long").parquet(f"{folder}/bands")
    pairs = members.groupBy("leader", "node").agg(F.count(F.lit(1)).alias("bands")).select("leader", "node")
    judged = _verified(pairs, sets, f"{folder}/judged", least)
    links = judged.filter("similar").select("leader", "node")
    # With three members or more, one that failed may belong to another member.
    failed = members.filter("members > 2").join(judged.filter("NOT similar"), ["leader", "node"], "left_semi")
    open_bands = failed.groupBy("band").agg(F.count(F.lit(1)).alias("failed")).select("band")
    nodes = members.join(open_bands, "band").select(F.explode(F.array("node", "leader")).alias("node"))
    nodes.groupBy("node").agg(F.count(F.lit(1)).alias("times")).select("node").write.parquet(f"{folder}/open")
    opened = spark.read.schema("node long").parquet(f"{folder}/open")
    if opened.isEmpty():
        return links.distinct()
    # Filtered before they are combined, so that other sets are not shuffled again.
    of_open = described.filter("size > 0").join(opened, "node", "left_semi")
    of_open = of_open.groupBy("node").agg(F.first("shingles").alias("shingles"))
    return exact_links(of_open, links, f"{folder}/exact", least).distinct()


def _counters(batch: pa.RecordBatch) -> Iterator[list]:
    tokens = np.frombuffer(b"".join(batch.column("shingles").to_pylist()), "<u4")
    counts = np.bincount(tokens % COUNTERS, minlength=COUNTERS)
    some = np.flatnonzero(counts)
    yield [some, counts[some]]


def _prefixes(batch: pa.RecordBatch, counts: np.ndarray, least: float) -> Iterator[list]:
    """The shingles of each set that a similar set shares one of."""
    nodes, sizes, tokens = [], [], []
    for node, packed in zip(batch.column("node").to_pylist(), batch.column("shingles").to_pylist(), strict=True):
        shingles = np.frombuffer(packed, "<u4")
        size = len(shingles)
        length = size - int(np.ceil(least * size - 1e-9)) + 1
        tokens.append(shingles[np.lexsort((shingles, counts[shingles % COUNTERS]))[:length]])
        nodes.append(np.full(len(tokens[-1]), node))
        sizes.append(np.full(len(tokens[-1]), size))
    if tokens:
        yield [np.concatenate(tokens).astype(np.int64), np.concatenate(nodes), np.concatenate(sizes)]


def _block_links(least: float):
    """Function for cogrouped pandas frames: pairs of leaders and members that are similar."""

    def compare(leaders: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        found: list[np.ndarray] = [np.zeros((2, 0), np.int64)]
        if len(leaders) and len(members):
            sets = [np.frombuffer(packed, "<u4") for packed in leaders["shingles"]]
            count, sizes = len(sets), np.fromiter(map(len, sets), np.int64, len(sets))
            tokens = np.concatenate(sets)
            order = np.argsort(tokens, kind="stable")
            tokens, owners = tokens[order], np.repeat(np.arange(count), sizes)[order]
            names, labels = leaders["node"].to_numpy(), leaders["label"].to_numpy()
            for packed, node, label in zip(members["shingles"], members["node"], members["label"], strict=True):
                own = np.frombuffer(packed, "<u4")
                shared = np.zeros(count, np.int64)
                for start in range(0, len(own), max(1, COUNTED // count)):
                    some = own[start:start + max(1, COUNTED // count)]
                    first, past = np.searchsorted(tokens, some), np.searchsorted(tokens, some, "right")
                    shared += np.bincount(owners[spread(first, past - first)], minlength=count)
                near = (shared >= least * (sizes + len(own) - shared) - 1e-9) & (labels != label)
                if near.any():
                    found.append(np.stack([names[near], np.full(int(near.sum()), node)]))
        pairs = np.concatenate(found, axis=1)
        return pd.DataFrame({"leader": pairs[0], "node": pairs[1]})

    return compare


def exact_links(sets: DataFrame, links: DataFrame, folder: str, least: float = SIMILARITY, at_once: int = AT_ONCE) -> DataFrame:
    """The links, and further ones, so that similar `sets` (node and shingles) are of one class."""
    spark = sets.sparkSession
    sets.write.parquet(f"{folder}/sets")
    sets = spark.read.schema("node long, shingles binary").parquet(f"{folder}/sets")
    counted = map_batches(sets, "place long, n long", _counters).groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(COUNTERS, np.int64)  # as many numbers, whatever the input
    counts[counted.column("place").to_numpy()] = counted.column("n").to_numpy()
    kinds = "token long, node long, size long"
    map_batches(sets, kinds, _prefixes, counts, least).write.parquet(f"{folder}/rows0")
    turn, labels = 0, least_labels(links, f"{folder}/turn0")
    while True:
        rows = spark.read.schema(kinds).parquet(f"{folder}/rows{turn}")
        named = rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        names = [F.bit_xor(F.xxhash64(F.lit(seed), "node")).alias(name) for seed, name in enumerate(("one", "two"))]
        of_label = named.groupBy("token", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("shingles"), *names)
        of_token = of_label.groupBy("token").agg(
            F.max_by("label", "n").alias("main"), (F.sum("n") - F.max("n")).alias("outside"), F.sum("n").alias("n"),
            F.ceil(F.sum("shingles") / BLOCK_SHINGLES).cast("int").alias("blocks"),
            F.bit_xor("one").alias("one"), F.bit_xor("two").alias("two"),
        ).filter("outside > 0")
        # Shingles that the same nodes share make one group.
        groups = of_token.groupBy("one", "two", "n").agg(
            F.min(F.struct("token", "main", "outside", "blocks")).alias("group"),
        ).select("group.*")
        turned = F.pmod(F.xxhash64("node", F.lit(turn)), F.col("outside") * F.greatest(F.lit(1), F.ceil(F.col("size") / LARGE_SET)))
        leads = (F.col("label") != F.col("main")) & (turned < at_once)
        marked_kinds = f"{kinds}, label long, main long, outside long, blocks int, leads boolean"
        named.join(groups, "token").withColumn("leads", leads).select(
            "token", "node", "size", "label", "main", "outside", "blocks", "leads",
        ).write.parquet(f"{folder}/marked{turn}")
        marked = spark.read.schema(marked_kinds).parquet(f"{folder}/marked{turn}")
        if marked.isEmpty():
            return links
        whole = marked.join(sets, "node")
        members = whole.withColumn("block", F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks")).cast("int"))
        leading = whole.filter("leads").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        columns = ["token", "block", "node", "label", "shingles"]
        # Columns of their own, since both sides come from the same rows.
        sides = [side.select(*[F.col(name).alias(name) for name in columns]).toDF(*columns) for side in (leading, members)]
        sides[0].groupBy("token", "block").cogroup(sides[1].groupBy("token", "block")).applyInPandas(
            _block_links(least), "leader long, node long",
        ).write.parquet(f"{folder}/found{turn}")
        found = spark.read.schema("leader long, node long").parquet(f"{folder}/found{turn}")
        turn += 1
        if not found.isEmpty():
            links = links.unionByName(found.distinct())
            labels = least_labels(links, f"{folder}/turn{turn}")
        marked.filter("NOT leads").select(*rows.columns).write.parquet(f"{folder}/rows{turn}")


def least_labels(links: DataFrame, folder: str) -> DataFrame:
    """node and the least node of its component, for all nodes that have links."""
    spark = links.sparkSession
    links.write.parquet(f"{folder}/links")
    links = spark.read.schema("leader long, node long").parquet(f"{folder}/links")
    ways = links.unionByName(links.select(F.col("node").alias("leader"), F.col("leader").alias("node")))
    kinds, turn = "node long, label long", 0
    ways.groupBy("node").agg(F.min("leader").alias("near")).select(
        "node", F.least("node", "near").alias("label"),
    ).write.parquet(f"{folder}/labels0")
    while True:
        labels = spark.read.schema(kinds).parquet(f"{folder}/labels{turn}")
        # The least label among neighbours, and then the label of the node it names.
        near = ways.join(labels.select(F.col("node").alias("leader"), F.col("label").alias("theirs")), "leader")
        nearest = near.groupBy("node").agg(F.min("theirs").alias("theirs"))
        met = labels.join(nearest, "node").select("node", "label", F.least("label", "theirs").alias("met"))
        jump = labels.select(F.col("node").alias("met"), F.col("label").alias("beyond"))
        turn += 1
        met.join(jump, "met").select(
            "node", F.least("met", "beyond").alias("label"), (F.least("met", "beyond") < F.col("label")).alias("changed"),
        ).write.parquet(f"{folder}/labels{turn}")
        after = spark.read.schema(f"{kinds}, changed boolean").parquet(f"{folder}/labels{turn}")
        if after.filter("changed").isEmpty():
            return after.select("node", "label")


def duplicate_classes(
    documents: DataFrame, least: float = SIMILARITY, weighted: bool = False,
) -> DataFrame:
    """doc_id, text_key, class_id, class_size and class_key of every row."""
    spark = documents.sparkSession
    folder = scratch_path(spark, "neardup")
    frame = only(documents, doc_id="long", text="string").withColumn("text_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    map_batches(frame, _ROWS, _described, weighted).write.parquet(f"{folder}/rows")
    described = spark.read.schema(_ROWS).parquet(f"{folder}/rows")
    labels = least_labels(verified_links(described, folder, least), folder)
    rows = described.select("doc_id", "text_key", "node")
    labelled = rows.join(labels, "node", "left").select(
        "doc_id", "text_key", F.coalesce("label", "node").alias("label"),
    )
    classes = labelled.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return labelled.join(classes, "label").select("doc_id", "text_key", "class_id", "class_size", F.col("label").alias("class_key"))


def keep_one(documents: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The documents, all columns kept, with one row of every class: that of its least doc_id.

    Rows without id come last. Of several rows with that doc_id the one whose text, and then
    whose other columns, have the least hash stays; of rows equal in all columns, one.
    """
    spark = documents.sparkSession
    names = documents.columns
    place = {name: f"c{number}" for number, name in reversed(list(enumerate(names)))}
    unique = documents.toDF(*[f"c{number}" for number in range(len(names))])
    folder = scratch_path(spark, "keep")
    classes = duplicate_classes(documents, least)
    classes.groupBy("text_key").agg(F.first("class_key").alias("class")).write.parquet(f"{folder}/classes")
    of_text = spark.read.schema("text_key long, class long").parquet(f"{folder}/classes")
    # Maps have no hash; as text they have.
    columns = [F.col(name).cast("string") if "map<" in kind else F.col(name) for name, kind in unique.dtypes]
    keyed = unique.withColumns({
        "id": F.col(place["doc_id"]).cast("long"),
        "text_key": F.xxhash64(F.coalesce(F.col(place["text"]).cast("string"), F.lit(""))),
        "row_key": F.xxhash64(*columns, *[column.isNull() for column in columns]),
    })
    # The least row of every text, and of those the least of every class.
    order = F.struct(F.col("id").isNull().alias("unnamed"), "id", "text_key", "row_key")
    of_class = keyed.groupBy("text_key").agg(F.min(order).alias("row")).join(of_text, "text_key").groupBy("class").agg(
        F.min("row").alias("row"),
    )
    of_class.select("row.*").write.parquet(f"{folder}/kept")
    kept = spark.read.schema("unnamed boolean, id long, text_key long, row_key long").parquet(f"{folder}/kept")
    chosen = kept.select("text_key", "row_key", F.col("id").alias("kept_id"))
    found = keyed.join(
        chosen.withColumnsRenamed({"text_key": "kept_text", "row_key": "kept_row"}),
        (F.col("text_key") == F.col("kept_text")) & (F.col("row_key") == F.col("kept_row")) & F.col("id").eqNullSafe(F.col("kept_id")),
    )
    return found.dropDuplicates(["text_key", "row_key", "id"]).select(*[f"c{number}" for number in range(len(names))]).toDF(*names)
