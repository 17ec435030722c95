"""Minimum bin slack against brute force, and packed documents against the library's ids."""

from __future__ import annotations

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eddyline.llm.chunks import encoded_texts, word_table
from eddyline.llm.packing import PREFERENCES, Places, _fill, fill_bins, fullest, pack_documents, packed_sequences
from eddyline.llm.queries import QUERIES, table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
CAPACITY = 16


@pytest.mark.parametrize("seed", range(30))
def test_fullest_is_the_fullest_of_all_combinations(seed):
    pick = random.Random(seed)
    counts = {pick.randrange(1, 20): pick.randrange(1, 4) for _ in range(5)}
    room = pick.randrange(0, 40)
    taken = fullest(counts, room)
    assert all(0 < times <= counts[length] for length, times in taken)
    best = max(
        total for choice in itertools.product(*[range(count + 1) for count in counts.values()])
        if (total := sum(map(int.__mul__, counts, choice))) <= room
    )
    assert sum(length * times for length, times in taken) == best


def plain_minimum_bin_slack(lengths, capacity):
    """One bin at a time, its fullest combination looked for among the pieces left."""
    left, bins = Counter(lengths), []
    while left:
        longest = max(left)
        left -= Counter([longest])
        content = [longest]
        for length, times in fullest(dict(left), capacity - longest):
            content += [length] * times
            left -= Counter({length: times})
        bins.append(tuple(sorted(content, reverse=True)))
    return Counter(bins)


@pytest.mark.parametrize("seed", range(10))
def test_combinations_taken_at_once_are_those_taken_one_by_one(seed):
    pick = random.Random(seed)
    lengths = [min(64, int(pick.paretovariate(0.8))) for _ in range(600)] + [pick.randrange(1, 65)] * 200
    fillings = _fill(Counter(lengths), 64, PREFERENCES[0])
    bins = Counter()
    for filling in fillings:
        bins[tuple(length for length, used in filling.lengths for _ in range(used))] += filling.times
    assert sum(Counter(length for content in bins.elements() for length in content).values()) == len(lengths)
    assert {sum(content) for content in bins} <= set(range(1, 65))
    expected = plain_minimum_bin_slack(lengths, 64)
    assert sum(bins.values()) == sum(expected.values())
    assert Counter(map(sum, bins.elements())) == Counter(map(sum, expected.elements()))


def best_fit_decreasing(lengths, capacity):
    rooms = Counter()
    for length in sorted(lengths, reverse=True):
        room = min((room for room in rooms if room >= length and rooms[room]), default=capacity)
        if rooms[room]:
            rooms[room] -= 1
        rooms[room - length] += 1
    return sum(rooms.values())


@pytest.mark.parametrize("seed", range(6))
def test_bins_are_few(seed):
    pick = random.Random(seed)
    lengths = [pick.randrange(1, 513) if pick.random() < 0.5 else pick.choice([170, 171, 255, 300]) for _ in range(2000)]
    bins = sum(filling.times for filling in fill_bins(Counter(lengths), 512))
    assert -(-sum(lengths) // 512) <= bins <= best_fit_decreasing(lengths, 512) + 1


def test_combinations_are_few_however_many_pieces_there_are():
    pick = random.Random(1)
    counts = {length: pick.randrange(1, 10 ** 12) for length in range(1, 513)}
    fillings = fill_bins(counts, 512)
    assert len(fillings) < 512 * 8
    total = Counter()
    for filling in fillings:
        for length, used in filling.lengths:
            total[length] += used * filling.times
    assert total == counts


def test_places_fill_every_bin_without_gaps():
    pick = random.Random(3)
    counts = Counter(pick.randrange(1, 65) for _ in range(900))
    places = Places(fill_bins(counts, 64), 64)
    lengths = np.repeat(list(counts), list(counts.values()))
    ranks = np.concatenate([np.arange(count) for count in counts.values()])
    sequences, offsets = places.find(lengths, ranks)
    bins = defaultdict(list)
    for sequence, offset, length in zip(sequences.tolist(), offsets.tolist(), lengths.tolist(), strict=True):
        bins[sequence].append((offset, length))
    for content in bins.values():
        ends = [offset + length for offset, length in sorted(content)]
        assert [offset for offset, _ in sorted(content)] == [0, *ends[:-1]] and ends[-1] <= 64


TEXTS = [
    "the quick brown fox", "", None, "A b", "same text", "same text", "x" * 400, "  spaced \t\n out  ", "naïve café — 'quoted'",
    "don't <|endoftext|> stop", "many words " * 60, "日本語 テキスト", " odd space ", "one",
]


def test_batches_are_encoded_as_the_library_does():
    library = Tokenizer.from_file(WORD_BPE)
    pick = random.Random(5)
    letters = "ab \n\t'é–1日.  "
    texts = TEXTS + ["".join(pick.choices(letters, k=pick.randrange(30))) for _ in range(500)]
    ids, counts = zip(*encoded_texts(pa.array(texts, pa.string()), word_table(WORD_BPE), 0), strict=True)
    ids, counts = np.concatenate(ids), np.concatenate(counts)
    start = 0
    for text, count in zip(texts, counts.tolist(), strict=True):
        assert ids[start:start + count].tolist() == [*library.encode(text or "", add_special_tokens=False).ids, 0]
        start += count
    assert start == len(ids)


def test_documents_are_packed_whole(spark):
    library = Tokenizer.from_file(WORD_BPE)
    rows = [(number % 11 if number != 3 else None, text, "x") for number, text in enumerate(TEXTS * 3)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, TEXT string").repartition(3)
    packed = pack_documents(documents, WORD_BPE, end=0, capacity=CAPACITY)
    found = [row.asDict() for row in packed.collect()]
    wanted = Counter()
    for number, text, _ in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        for piece in range(-(-len(ids) // CAPACITY)):
            cut = ids[piece * CAPACITY:(piece + 1) * CAPACITY]
            wanted[number, piece, piece * CAPACITY, len(cut), np.array(cut, "<u4").tobytes()] += 1
    assert wanted == Counter(
        (row["doc_id"], row["piece"], row["start"], row["length"], bytes(row["ids"])) for row in found
    )
    bins = defaultdict(list)
    for row in found:
        bins[row["sequence_id"]].append((row["offset"], row["length"], bytes(row["ids"])))
    for content in bins.values():
        content.sort()
        ends = [offset + length for offset, length, _ in content]
        assert [offset for offset, *_ in content] == [0, *ends[:-1]] and ends[-1] <= CAPACITY
    whole = {row["sequence_id"]: bytes(row["ids"]) for row in packed_sequences(packed).collect()}
    assert whole == {number: b"".join(ids for *_, ids in content) for number, content in bins.items()}


def test_nothing_is_packed_from_an_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pack_documents(empty, WORD_BPE, end=0).count() == 0


def test_a_length_that_most_pieces_share_is_spread_over_bins(spark):
    documents = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("one two three").alias("text")).repartition(5)
    packed = pack_documents(documents, WORD_BPE, end=0, capacity=CAPACITY)
    sizes = [row["count"] for row in packed.groupBy("sequence_id").count().collect()]
    assert sorted(sizes) == [4] * 75


def test_the_query_packs_every_document(spark, data):
    library = Tokenizer.from_file(WORD_BPE)
    texts = {row["doc_id"]: row["text"] or "" for row in table(spark, data, "documents").collect()}
    documents, sequences = defaultdict(list), defaultdict(list)
    for row in QUERIES["op11_minimum_bin_slack"](spark, data).collect():
        documents[row["doc_id"]].append((row["piece"], row["start"], row["length"], row["ids_crc32"]))
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
    assert set(documents) == set(texts)
    for number, text in texts.items():
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4")
        cuts = [ids[start:start + 2048] for start in range(0, len(ids), 2048)]
        assert sorted(documents[number]) == [
            (piece, piece * 2048, len(cut), zlib.crc32(cut.tobytes())) for piece, cut in enumerate(cuts)
        ]
    for content in sequences.values():
        ends = [offset + length for offset, length in sorted(content)]
        assert [offset for offset, _ in sorted(content)] == [0, *ends[:-1]] and ends[-1] <= 2048
    least = -(-sum(length for content in sequences.values() for _, length in content) // 2048)
    assert least <= len(sequences) <= least + 1
