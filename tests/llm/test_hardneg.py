"""Hard negatives, slots and exact products against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eddyline.llm.hardneg import Best, hard_negatives, hundredths
from eddyline.llm.products import LEAST, MOST, exact_products
from eddyline.llm.queries import ORACLES, QUERIES
from tests.oracle import check, connect

KINDS = "vec_id long, embedding array<double>, label int, LABEL string"


def whole(x):
    return math.floor(min(max(x * 256, -2.0 ** 200), 2.0 ** 200))


def model(rows, positives=5, negatives=5, low=80, high=100):
    usable = [
        (number, [whole(x) for x in vector], label) for number, vector, label, _ in rows
        if number is not None and label is not None and vector is not None
        and all(x is not None and math.isfinite(x) for x in vector)
    ]
    anchors = {}
    for number, vector, label in usable:
        if number % 10 == 0:
            anchors[number] = min(anchors.get(number, (vector, label)), (vector, label))
    out = []
    for anchor, (vector, label) in anchors.items():
        scored = sorted(
            (-min(max(sum(map(int.__mul__, vector, other)), LEAST), MOST), number, kind)
            for number, other, kind in usable if number != anchor
        )
        for score, positive, _ in [row for row in scored if row[2] == label][:positives]:
            fitting = [
                (number, -other) for other, number, kind in scored
                if kind != label and low * -score <= 100 * -other <= high * -score
            ]
            out += [(anchor, positive, rank, number, -score, other) for rank, (number, other) in enumerate(fitting[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, parts=3, **options):
    table = spark.createDataFrame(rows, KINDS).repartition(parts)
    found = hard_negatives(table, F.col("vec_id") % 10 == 0, **options)
    return sorted(tuple(row) for row in found.collect())


def vectors(seed, count, width=3, labels=3, step=4):
    pick = random.Random(seed)
    return [
        (number, [pick.randrange(-step, 2 * step) / step for _ in range(width)], pick.randrange(labels), "x")
        for number in range(count)
    ]


@pytest.mark.parametrize("seed", range(4))
def test_negatives_are_those_of_all_pairs(spark, seed):
    """Coarse components, so that scores tie and windows overlap."""
    rows = vectors(seed, 150)
    assert mined(spark, rows) == model(rows)


def test_other_windows_and_numbers(spark):
    rows = vectors(9, 120, step=9)
    assert mined(spark, rows, positives=7, negatives=2, low=50, high=130) == model(rows, 7, 2, 50, 130)


def test_odd_rows(spark):
    rows = vectors(10, 60)
    rows += [
        (None, [1.0, 1.0, 1.0], 1, "x"), (70, None, 1, "x"), (80, [1.0, None, 0.0], 1, "x"), (90, [1.0, float("nan"), 0.0], 2, "x"),
        (100, [float("inf"), 0.0, 0.0], 0, "x"), (110, [1.0, 1.0, 1.0], None, "x"), (120, [], 1, "x"), (130, [1.0], 2, "x"),
        (140, [1e306, 1.0, -1e306], 0, "x"), (141, [1e306, 0.0, 0.0], 0, "x"), (142, [1e300, 0.0, 1e300], 1, "x"),
        (150, [3e7, 1.0, 2.0], 1, "x"), (151, [3e7, -1.0, 2.0], 1, "x"), (152, [2.9e7, 0.0, 0.0], 2, "x"),
        rows[3], rows[3], rows[10], (10, [0.25, 0.25, 0.25], 2, "x"), (-20, [0.5, 0.5, 1.0], 0, "x"),
    ]
    assert mined(spark, rows) == model(rows)


def test_many_equal_vectors_and_small_blocks(spark):
    rows = vectors(11, 80) + [(number, [1.0, 0.5, 0.25], number % 2, "x") for number in range(200, 500)]
    assert mined(spark, rows, block_bytes=200) == model(rows)


def test_empty_tables_and_tables_without_anchors(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 0, "x"), (2, [1.0], 1, "x")]) == []


@pytest.mark.parametrize("seed", range(5))
def test_the_best_of_groups(seed):
    pick = random.Random(seed)
    best, offered = Best(4, 3), [[] for _ in range(4)]
    for _ in range(20):
        rows = [(pick.randrange(4), pick.choice([LEAST, MOST, *range(5)]), pick.randrange(100)) for _ in range(pick.randrange(12))]
        for group, score, number in rows:
            offered[group].append((-score, number))
        best.offer(*(np.array([row[place] for row in rows], np.int64) for place in range(3)))
    for group in range(4):
        held = [(-int(s), int(i)) for s, i in zip(best.scores[group], best.ids[group], strict=True)][:best.held[group]]
        assert held == sorted(offered[group])[:3]


def test_products_are_exact_for_numbers_of_any_size():
    pick = random.Random(7)

    def number():
        return float(int(pick.uniform(-1, 1) * 2 ** pick.choice([1, 8, 20, 30, 31, 33, 52, 64, 130, 200])))

    for width in (1, 3, 40):
        left, right = ([[number() for _ in range(width)] for _ in range(rows)] for rows in (17, 13))
        left[0] = [float(2 ** 63)] * width
        right[0] = [1.0] + [0.0] * (width - 1)
        found = exact_products(np.array(left), np.array(right))
        for row, one in enumerate(left):
            for column, other in enumerate(right):
                exact = sum(int(a) * int(b) for a, b in zip(one, other, strict=True))
                assert found[row, column] == min(max(exact, LEAST), MOST)


def test_hundredths_round_as_asked():
    values = [LEAST // 2, -101, -100, -99, -1, 0, 1, 99, 100, 101, 12345, MOST // 2]
    for part in (50, 80, 100, 130):
        assert hundredths(np.array(values), part, True).tolist() == [-(-value * part // 100) for value in values]
        assert hundredths(np.array(values), part, False).tolist() == [value * part // 100 for value in values]


def test_the_query_equals_sql(spark, data):
    assert check(QUERIES["op13_slot_hard_negatives"](spark, data), connect(data), ORACLES["op13_slot_hard_negatives"]) > 10
