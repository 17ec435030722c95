"""Near-duplicates: no link lost among documents of one template, no document lost with its class."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np

from eddyline.llm import neardup
from eddyline.llm.queries import table
from eddyline.llm.words import shingle_hashes, word_bounds, word_hashes

KINDS = "doc_id long, text string, note string, extra map<string,int>"


def shingles(text):
    data = np.frombuffer((text or "").encode(), np.uint8)
    first, past = word_bounds(data)
    found, _ = shingle_hashes(word_hashes(data, first, past), np.zeros(len(first), np.int64), 5)
    return set(found.tolist())


def pairs_by_brute_force(sets, least=0.8):
    """All pairs at `least` or more, by counting common shingles over an inverted index."""
    holders, shared = {}, Counter()
    for number, one in enumerate(sets):
        for shingle in one:
            holders.setdefault(shingle, []).append(number)
    for held in holders.values():
        for place, one in enumerate(held):
            for other in held[place + 1:]:
                shared[one, other] += 1
    return {
        pair for pair, n in shared.items()
        if n >= least * (len(sets[pair[0]]) + len(sets[pair[1]]) - n) - 1e-9
    }


def template_documents(groups, words=394, own=9, both=4, seed=5):
    """Pairs that share replaced words beyond those of the template: about 0.81 within, 0.78 across."""
    pick = random.Random(seed)
    template = [f"t{number}" for number in range(words)]
    texts = []
    for group in range(groups):
        base = list(template)
        for step in range(both):
            base[pick.randrange(words)] = f"g{group}x{step}"
        for member in range(2):
            text = list(base)
            for step in range(own // 2 + member):
                text[pick.randrange(words)] = f"g{group}m{member}y{step}"
            texts.append(" ".join(text))
    return texts


def class_of(spark, texts):
    rows = [(number, text, None, None) for number, text in enumerate(texts)]
    found = neardup.duplicate_classes(spark.createDataFrame(rows, KINDS).repartition(4))
    return {row["doc_id"]: row["class_key"] for row in found.collect()}


def test_no_pair_is_lost_under_a_template(spark):
    texts = template_documents(150)
    pairs = pairs_by_brute_force([shingles(text) for text in texts])
    assert 50 < len(pairs) < 3000
    classes = class_of(spark, texts)
    assert all(classes[one] == classes[other] for one, other in pairs)
    linked = {frozenset(pair) for pair in pairs}
    # No more classes are joined than the links join.
    parent = list(range(len(texts)))

    def root(number):
        while parent[number] != number:
            parent[number] = parent[parent[number]]
            number = parent[number]
        return number

    for pair in linked:
        one, other = (root(number) for number in pair)
        parent[one] = other
    assert len(set(classes.values())) == len({root(number) for number in range(len(texts))})


def test_groups_larger_than_one_round_are_compared_whole(spark, tmp_path):
    """Twenty sets that all share a prefix shingle; three at a time are held against the others."""
    pick, rows = random.Random(2), []
    common = list(range(1, 9))
    for number in range(20):
        family = [1000 + number // 2 * 100 + step for step in range(40)]
        own = [50_000 + number * 10 + step for step in range(4)]
        rows.append((number, np.sort(np.array(common + family + own, "<u4")).tobytes()))
    pick.shuffle(rows)
    sets = spark.createDataFrame(rows, "node long, shingles binary")
    none = spark.createDataFrame([], "leader long, node long")
    found = neardup.exact_links(sets, none, str(tmp_path / "exact"), at_once=3)
    assert {tuple(sorted(row)) for row in found.collect()} == {(number, number + 1) for number in range(0, 20, 2)}


def test_documents_with_one_id_are_told_apart(spark):
    texts = ["one text of some words that stands alone", "quite another text which has nothing in common with it"]
    near = " ".join(f"w{number}" for number in range(200))
    rows = [
        (4, texts[0], "a", None), (4, texts[1], "a", {"k": 1}), (None, near, "a", None), (None, near + " end", "b", None),
        (9, "equal rows", "x", {"k": 2}), (9, "equal rows", "x", {"k": 2}), (9, "equal rows", "w", None),
    ]
    frame = spark.createDataFrame(rows, KINDS).repartition(3)
    classes = neardup.duplicate_classes(frame).collect()
    assert sorted(Counter(row["class_key"] for row in classes).values()) == [1, 1, 2, 3]
    kept = sorted((row["doc_id"] or -1, row["text"]) for row in neardup.keep_one(frame).collect())
    assert kept[0][0] == -1 and kept[0][1].startswith("w0 ")
    assert kept[1:] == sorted([(4, texts[0]), (4, texts[1]), (9, "equal rows")])


def test_every_near_pair_of_the_documents_is_of_one_class(spark, data):
    rows = [(row["doc_id"], row["text"]) for row in table(spark, data, "documents").collect()]
    pairs = pairs_by_brute_force([shingles(text) for _, text in rows])
    found = {row["doc_id"]: row["class_key"] for row in neardup.duplicate_classes(table(spark, data, "documents")).collect()}
    assert pairs and all(found[rows[one][0]] == found[rows[other][0]] for one, other in pairs)


def test_weighted_signatures_estimate_weighted_similarity():
    """Elements that come w times are w elements; equal coordinates estimate sum min / sum max."""
    draw = np.random.default_rng(3)
    left, right = draw.integers(0, 6, 80), draw.integers(0, 6, 80)

    def signature(weights):
        times = np.repeat(np.arange(80, dtype=np.uint64), weights)
        nth = np.concatenate([np.arange(weight) for weight in weights]).astype(np.uint64)
        elements = np.sort(neardup.mixed(times * np.uint64(1000) + nth))
        return neardup.dart_signatures(elements, np.zeros(len(elements), np.int64), 1, 4096)[0]

    expected = np.minimum(left, right).sum() / np.maximum(left, right).sum()
    assert abs((signature(left) == signature(right)).mean() - expected) < 0.03
