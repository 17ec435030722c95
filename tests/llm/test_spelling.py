"""Spelling variants against comparison of all words with all words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from eddyline.llm.queries import ORACLES, QUERIES
from eddyline.llm.spelling import numbered, shared_letters, spelling_variants, word_counts
from eddyline.session import scratch_path
from tests.oracle import check, connect


def near(one, other):
    if one == other or abs(len(one) - len(other)) > 1:
        return False
    if len(one) == len(other):
        return sum(map(str.__ne__, one, other)) == 1
    short, long = sorted([one, other], key=len)
    return any(long[:place] + long[place + 1:] == short for place in range(len(long)))


def model(counts, ratio=2):
    forms, out = {}, set()
    for word, n in counts.items():
        others = [other for other in counts if near(word, other)]
        best = min(others, key=lambda other: (-counts[other], other), default=None)
        forms[word] = best if best is not None and counts[best] >= ratio * n else None
        out.add((word, forms[word], n, len(others), counts[forms[word]] if forms[word] is not None else None))
    rows = set()
    for word, form, n, count, form_n in out:
        root = word
        while forms[root] is not None:
            root = forms[root]
        rows.add((word, form, root, n, count, form_n))
    return rows


def variants(spark, counts):
    table = spark.createDataFrame([(word, n, 1) for word, n in counts.items()], "word string, n long, N int")
    return {tuple(row) for row in spelling_variants(table).collect()}


@pytest.mark.parametrize("letters, size", [("ab", 6), ("abé", 5), ("a", 12), ("abcß", 4)])
def test_variants_are_those_of_all_pairs(spark, letters, size):
    pick = random.Random(size)
    words = {"".join(pick.choices(letters, k=pick.randrange(1, size + 1))) for _ in range(120)}
    counts = {word: pick.choice([1, 2, 3, 5, 8, 13, 40, 100]) for word in words}
    assert variants(spark, counts) == model(counts)


def test_long_and_equal_frequent_words(spark):
    long = "ab" * 20_000
    counts = {long: 10, long[1:]: 4, long[:-1]: 5, long + "b": 5, "bread": 9, "brad": 4, "breed": 9, "broad": 4, "": 1, "é": 2}
    assert variants(spark, counts) == model(counts)


def test_an_empty_table_has_no_variants(spark):
    assert variants(spark, {}) == set()


def test_forms_are_followed_to_the_last(spark):
    counts = {"aaaaa" + "b" * step: 2 ** step for step in range(12)}
    found = variants(spark, counts)
    assert found == model(counts)
    assert {row[2] for row in found} == {"aaaaa" + "b" * 11}


def test_shared_letters():
    pick = random.Random(2)
    for _ in range(300):
        one, other = ("".join(pick.choices("ab", k=pick.randrange(9))) for _ in range(2))
        expected = 0
        while expected < min(len(one), len(other)) and one[expected] == other[expected]:
            expected += 1
        assert shared_letters(one, other) == expected


def test_nodes_stand_for_prefixes_one_to_one(spark):
    pick = random.Random(4)
    words = sorted({"".join(pick.choices("abc", k=pick.randrange(1, 9))) for _ in range(400)})
    table = spark.createDataFrame([(word,) for word in words], "word string").repartition(7)
    written, ranges = numbered(table, "word", scratch_path(spark, "nodes"))
    prefixes, ids = {}, []
    for row in written.orderBy("word").collect():
        nodes = ranges.whole(row["part"], np.array(row["nodes"])).tolist()
        ids.append(ranges.rows[row["part"]] + row["place"])
        for length, node in enumerate(nodes, 1):
            assert prefixes.setdefault(row["word"][:length], node) == node
    assert ids == list(range(len(words)))
    assert len(set(prefixes.values())) == len(prefixes) and 0 not in prefixes.values()


def model_counts(rows, least=5, least_count=3):
    counts = Counter()
    for number, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(letter) + 32) if "A" <= letter <= "Z" else letter for letter in run)
            check = zlib.crc32(f"{'' if number is None else number}:{run}".encode())
            if check % 97 == 0:
                run = run[:check % len(run)] + run[check % len(run) + 1:]
            if len(run) >= least:
                counts[run] += 1
    return {word: n for word, n in counts.items() if n >= least_count}


def test_words_are_counted_over_whole_texts(spark):
    pick = random.Random(6)
    vocabulary = ["Straße", "ÉCOLE", "école", "hello", "HELLO", "word", "übermut", "a" * 3000, "naïve×÷ÿ", "x1hello2", "日本hello語"]
    rows = [(number, pick.choice([" ", "", "-"]).join(pick.choices(vocabulary, k=40))) for number in range(300)]
    rows += [(None, "hello there"), (5, None), (6, ""), rows[0], (-7, "hello " * 5000)]
    table = spark.createDataFrame([(*row, "extra") for row in rows], "doc_id long, text string, Text string")
    found = {row["word"]: row["n"] for row in word_counts(table).collect()}
    assert found == model_counts(rows)
    assert word_counts(table.limit(0)).count() == 0


def test_the_query_equals_sql(spark, data):
    assert check(QUERIES["op12_trie_pair_spelling"](spark, data), connect(data), ORACLES["op12_trie_pair_spelling"]) > 1000
