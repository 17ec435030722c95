"""Spelling variants by a dictionary of trie-node pairs.

All words are put into a trie, and their reversals into another one; nodes are numbered. A
word is then known by the pair (node of its first i letters, node of the letters behind them),
for every i, and two words differ

* by one replaced letter, if they share a pair that skips the same position, and
* by one letter more, if the pair that skips a position of the longer one is a whole pair of
  the shorter one. Of equal adjacent letters only the first is skipped, so that each such
  neighbour is met once.

Nodes stand for strings one to one, so the join of integer pairs gives exact neighbours. Tries
are numbered without building them in one place: words are sorted in ranges, a word takes over
its predecessor's nodes as far as both agree, and takes new numbers for the rest. Between
ranges only the first and the last word of each are compared. No pairs of words are formed:
every group of a pair says how many members it has and which are the best two, and tells its
members so.

A word's form is its most frequent neighbour if that is at least `ratio` times as frequent, and
its root is what the forms lead to in the end. Counts rise along forms, at least doubling for
a ratio of 2, so there are no circles.

Null and empty texts have no words; a null doc_id counts as empty text; a text of any length is
read whole, and so is a word. Repeated rows count again. Ties go to the word that comes first
in code-point order. An empty table has no words. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eddyline.llm.batches import arrow_schema, map_batches, only
from eddyline.session import scratch_path

#: Letters of a run (fixed value).
LETTERS = "A-Za-zÀ-ÿ"

#: Distinct words that a task counts before it hands the counts on.
COUNTED = 200_000

_COUNTS = "word string, n long"


def damaged(run: str, state: int, every: int) -> str:
    """The run without one letter if its checksum, continued from `state`, is a multiple of `every`."""
    check = zlib.crc32(run.encode(), state)
    if every and check % every == 0:
        place = check % len(run)
        return run[:place] + run[place + 1:]
    return run


def _word_counter(least: int, every: int):
    schema = arrow_schema(_COUNTS)
    # Shorter runs cannot become words; a greedy match of `least` or more is a maximal run.
    runs = re.compile(f"[{LETTERS}]{{{least},}}")

    def batch_of(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], schema=schema,
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for number, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if not text:
                    continue
                state = zlib.crc32(b"%s:" % (b"" if number is None else str(number).encode()))
                lowered = text.encode().lower().decode()  # of bytes, only A to Z change
                for run, times in Counter(runs.findall(lowered)).items():
                    word = damaged(run, state, every)
                    if len(word) >= least:
                        counts[word] += times
                if len(counts) > COUNTED:
                    yield batch_of(counts)
                    counts.clear()
        yield batch_of(counts)

    return count


def word_counts(documents: DataFrame, least: int = 5, least_count: int = 3, every: int = 97) -> DataFrame:
    """word and n of the words of at least `least` letters that occur `least_count` times.

    Runs of letters are lower-cased (A to Z only) and lose one letter where `every` divides
    their checksum (0: never).
    """
    texts = only(documents, doc_id="long", text="string")
    counts = texts.mapInArrow(_word_counter(least, every), _COUNTS)
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def shared_letters(one: str, other: str) -> int:
    """Length of the longest common prefix."""
    low, high = 0, min(len(one), len(other))
    while low < high:
        middle = (low + high + 1) // 2
        if one[low:middle] == other[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _number_nodes(batches: Iterator[pa.RecordBatch], key: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Add `part`, `place` (row within the range) and `nodes`: the trie nodes of all prefixes.

    Numbers count from 0 within the range; the first word has the first numbers.
    """
    part, place, fresh = TaskContext.get().partitionId(), 0, 0
    before, path = "", np.zeros(0, np.int64)
    for batch in batches:
        nodes = []
        for word in batch.column(key).to_pylist():
            common = shared_letters(before, word)
            added = len(word) - common
            path = np.r_[path[:common], np.arange(fresh, fresh + added)]
            fresh += added
            before = word
            nodes.append(path)
        rows = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns, pa.array(np.full(rows, part), pa.int32()),
                pa.array(np.arange(place, place + rows), pa.int64()), pa.array(nodes, pa.list_(pa.int64())),
            ],
            schema=schema,
        )
        place += rows


class Ranges:
    """How the numbers of each range become numbers of the whole trie, of which 0 is the root.

    One entry per range of words: the number its nodes start at, the number its rows start at,
    and the nodes that its first word shares with the words before. Nothing else of the words
    comes to the driver.
    """

    def __init__(self, summaries: list):
        self.nodes, self.rows, self.shared = {}, {}, {}
        node, row, before, path = 1, 0, "", np.zeros(0, np.int64)
        for part, first, last, last_nodes, rows, nodes in summaries:
            common = shared_letters(before, first)
            self.nodes[part], self.rows[part], self.shared[part] = node, row, path[:common]
            path = self.whole(part, np.array(last_nodes, np.int64))
            node, row, before = node + nodes, row + rows, last

    def whole(self, part: int, nodes: np.ndarray) -> np.ndarray:
        shared = self.shared[part]
        out = nodes + self.nodes[part]
        taken = nodes < len(shared)
        out[taken] = shared[nodes[taken]]
        return out


def numbered(words: DataFrame, key: str, folder: str) -> tuple[DataFrame, Ranges]:
    """The words, sorted by `key` in ranges, with part, place and nodes, and their `Ranges`.

    Keys are distinct; the result is a written table, so its numbers stay.
    """
    spark = words.sparkSession
    kinds = ", ".join([*[f"`{name}` {kind}" for name, kind in words.dtypes], "part int, place long, nodes array<long>"])
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = arrow_schema(kinds)
    ordered = words.repartitionByRange(parts, key).sortWithinPartitions(key)
    ordered.mapInArrow(lambda batches: _number_nodes(batches, key, schema), kinds).write.parquet(folder)
    written = spark.read.schema(kinds).parquet(folder)
    summaries = written.groupBy("part").agg(
        F.min_by(key, "place").alias("first"), F.max_by(key, "place").alias("last"),
        F.max_by("nodes", "place").alias("last_nodes"), F.count(F.lit(1)).alias("rows"),
        (F.max(F.array_max("nodes")) + 1).alias("fresh"),
    ).orderBy("part")
    return written, Ranges([tuple(row) for row in summaries.collect()])


def _forward(batch: pa.RecordBatch, ranges: Ranges) -> Iterator[list]:
    """id (the word's rank in code-point order), reversed word and prefix nodes."""
    parts, places = batch.column("part").to_numpy(), batch.column("place").to_numpy()
    ids = [ranges.rows[part] + place for part, place in zip(parts.tolist(), places.tolist(), strict=True)]
    nodes = [
        ranges.whole(part, np.array(path, np.int64))
        for part, path in zip(parts.tolist(), batch.column("nodes").to_pylist(), strict=True)
    ]
    yield [ids, batch.column("word"), batch.column("n"), [word[::-1] for word in batch.column("word").to_pylist()], nodes]


#: What a row of the pair dictionary is: a whole pair, or one that skips a letter (the first
#: of equal adjacent ones, or a later one).
WHOLE, SKIPS, SKIPS_AGAIN = 0, 1, 2


def _pairs(batch: pa.RecordBatch, ranges: Ranges) -> Iterator[list]:
    """All pairs of every word."""
    out: list[list[np.ndarray]] = [[], [], [], [], []]
    size = 0
    columns = [batch.column(name).to_pylist() for name in ("id", "n", "reversed", "prefixes", "part", "nodes")]
    for number, n, backwards, prefixes, part, nodes in zip(*columns, strict=True):
        length = len(backwards)
        left = np.r_[0, np.array(prefixes, np.int64)]
        right = np.r_[0, ranges.whole(part, np.array(nodes, np.int64))][::-1]
        letters = np.frombuffer(backwards[::-1].encode("utf-32-le"), "<u4")
        again = np.r_[False, letters[1:] == letters[:-1]][:length]
        total = 2 * length + 1
        for column, values in zip(
            out,
            (
                np.r_[left, left[:-1]], np.r_[right, right[1:]],
                np.r_[np.full(length + 1, WHOLE), np.where(again, SKIPS_AGAIN, SKIPS)],
                np.full(total, number), np.full(total, n),
            ),
            strict=True,
        ):
            column.append(values)
        size += total
        if size > 1 << 18:
            yield [np.concatenate(column) for column in out]
            out, size = [[], [], [], [], []], 0
    if size:
        yield [np.concatenate(column) for column in out]


def _neighbours(pairs: DataFrame) -> DataFrame:
    """id, n_near and best (n and negative id) of every word that has neighbours."""
    strength = F.struct("n", (-F.col("id")).alias("minus"))
    group = Window.partitionBy("prefix", "suffix")
    rows = pairs.withColumn("strength", strength).withColumn("members", F.count(F.lit(1)).over(group))
    rows = rows.filter(F.col("members") > 1)
    skips, opens, is_whole = F.col("kind") != WHOLE, F.col("kind") == SKIPS, F.col("kind") == WHOLE
    ordered = Window.partitionBy("prefix", "suffix").orderBy(F.desc(skips), F.desc("strength"))
    rows = rows.select(
        "id", "kind", "members", "strength",
        F.count_if(skips).over(group).alias("skipping"), F.count_if(opens).over(group).alias("opening"),
        F.max(F.when(skips, F.col("strength"))).over(group).alias("best_skip"),
        F.max(F.when(opens, F.col("strength"))).over(group).alias("best_open"),
        F.max(F.when(is_whole, F.col("strength"))).over(group).alias("whole"),
        F.row_number().over(ordered).alias("rank"),
        F.when(F.lead(skips).over(ordered), F.lead("strength").over(ordered)).alias("next"),
    )
    other = F.when(F.col("rank") == 1, F.col("next")).otherwise(F.col("best_skip"))
    longer = F.when(opens, F.col("whole"))
    found = rows.select(
        "id",
        F.when(is_whole, F.col("opening"))
        .otherwise(F.col("skipping") - 1 + F.when(longer.isNotNull(), 1).otherwise(0)).alias("near"),
        F.when(is_whole, F.col("best_open")).otherwise(F.greatest(other, longer)).alias("best"),
    ).filter(F.col("near") > 0)
    return found.groupBy("id").agg(F.sum("near").alias("n_near"), F.max("best").alias("best"))


def _roots(forms: DataFrame, folder: str) -> DataFrame:
    """id and root of the words that have a form: each round doubles the steps taken."""
    spark = forms.sparkSession
    kinds, number = "id long, root long, moved boolean", 0
    forms.select("id", F.col("form").alias("root"), F.lit(True).alias("moved")).write.parquet(f"{folder}/0")
    while True:
        known = spark.read.schema(kinds).parquet(f"{folder}/{number}")
        if not known.filter("moved").limit(1).count():
            return known.select("id", "root")
        further = known.select(F.col("id").alias("root"), F.col("root").alias("further"))
        stepped = known.select("id", "root").join(further, "root", "left").select(
            "id", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"),
        )
        number += 1
        stepped.write.parquet(f"{folder}/{number}")


def spelling_variants(counts: DataFrame, ratio: int = 2) -> DataFrame:
    """word, form, root, n, n_near and form_n of a table of distinct words and their counts n."""
    spark = counts.sparkSession
    folder = scratch_path(spark, "spelling")
    words, ranges = numbered(only(counts, word="string", n="long"), "word", f"{folder}/forward")
    kinds = "id long, word string, n long, reversed string, prefixes array<long>"
    map_batches(words, kinds, _forward, ranges).write.parquet(f"{folder}/words")
    known = spark.read.schema(kinds).parquet(f"{folder}/words")
    backwards, ranges = numbered(known.select("id", "n", "reversed", "prefixes"), "reversed", f"{folder}/backward")
    pairs = map_batches(backwards, "prefix long, suffix long, kind int, id long, n long", _pairs, ranges)
    _neighbours(pairs).write.parquet(f"{folder}/near")
    near = spark.read.schema("id long, n_near long, best struct<n: bigint, minus: bigint>").parquet(f"{folder}/near")
    table = known.select("id", "word", "n").join(near, "id", "left")
    has_form = F.col("best.n") >= ratio * F.col("n")
    table = table.select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(has_form, -F.col("best.minus")).alias("form"), F.when(has_form, F.col("best.n")).alias("form_n"),
    )
    roots = _roots(table.filter(F.col("form").isNotNull()).select("id", "form"), f"{folder}/roots")
    spelled = known.select("id", "word")
    result = table.join(roots, "id", "left")
    result = result.join(spelled.select(F.col("id").alias("form"), F.col("word").alias("form_word")), "form", "left")
    result = result.join(spelled.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root", "left")
    return result.select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n",
    )
