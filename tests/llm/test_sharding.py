"""Shards keep linked documents together as far as their sizes allow."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from eddyline.llm import sharding


def sharded(spark, sizes, singles=0):
    rows, number = [], 0
    for group, size in enumerate(sizes):
        rows += [(number + member, f"text of group {group}", "x") for member in range(size)]
        number += size
    rows += [(number + single, f"single {single}", "x") for single in range(singles)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, Shard string").repartition(6)
    found = sharding.shard_documents(frame)
    places = defaultdict(list)
    for row in found.collect():
        places[row["shard"]].append(row["slot"])
    total = len(rows)
    assert sorted(map(len, places.values())) == sorted(total // 8 + (shard < total % 8) for shard in range(8) if total // 8 or shard < total)
    assert all(sorted(slots) == list(range(len(slots))) for slots in places.values())
    groups = defaultdict(Counter)
    for row in found.collect():
        groups[row["text_crc32"]][row["shard"]] += 1
    divided = sum(len(shards) > 1 for shards in groups.values())
    return divided, sharding.kept_edges(found, F.col("text_crc32"))


def test_groups_that_fill_the_shards_stay_whole(spark):
    """200 groups of 20 in eight shards of 500: 25 whole groups each."""
    divided, (kept, every) = sharded(spark, [20] * 200)
    assert divided == 0 and kept == every == 200 * 190


def test_large_groups_are_divided_as_little_as_possible(spark):
    """Groups of 300 in shards of 525: one whole group each, the others in parts."""
    divided, (kept, every) = sharded(spark, [300] * 14)
    assert divided == 6 and every == 14 * 300 * 299 // 2
    assert kept >= 8 * 300 * 299 // 2 + 6 * 2 * 100 * 99 // 2


def test_a_group_of_a_third_of_all_rows(spark):
    divided, (kept, every) = sharded(spark, [800, 3, 3, 2], singles=1592)
    assert divided == 1
    # Parts are dealt by hash, so a few rows cross over when the counts are evened out.
    assert kept >= 0.98 * (2 * 300 * 299 // 2 + 200 * 199 // 2)


def test_small_groups_come_together(spark):
    """Groups of four among as many single documents, far more than chance leaves whole."""
    divided, (kept, every) = sharded(spark, [4] * 400, singles=1600)
    assert divided <= 20 and kept >= 0.97 * every


@pytest.mark.parametrize("sizes, singles", [([], 3), ([2], 0), ([], 0), ([9], 1)])
def test_few_rows(spark, sizes, singles):
    sharded(spark, sizes, singles)


def test_large_groups_are_placed_whole_where_they_fit():
    room = [10, 10, 7]
    assert sharding.place_large([("a", 9), ("b", 7), ("c", 6), ("d", 3)], room) == [[(0, 9)], [(2, 7)], [(1, 6)], [(1, 3)]]
    room = [4, 6]
    assert sharding.place_large([("a", 9)], room) == [[(1, 6), (0, 3)]] and room == [1, 0]
