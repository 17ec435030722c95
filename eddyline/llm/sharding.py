"""Sharding by balanced label propagation: linked documents to one shard, shards of equal counts.

Documents with equal texts are linked. Groups that are large beside a shard are few, whatever the
number of documents; they are placed first, the largest in front, as wholes where one fits and
otherwise in as few parts as the room allows. The other documents start by hash, in proportion to
the room that is left. In every round each group of linked documents counts its members per shard
(at most one row per group and shard is shuffled, never pairs), the most frequent shard becomes
the group's wish, and the wishes are granted as far as quotas allow: what enters a shard is
bounded by its free places and by what leaves it. Rounds go on while the number of divided groups
falls. At last every shard's documents are ranked, linked ones first, and what stands beyond
the shard's size moves, group by group, to the shards with places left. This gives slots
without gaps and counts that differ by one at most, whatever the rounds have left.

Null texts count as empty ones and are linked; texts of any length are read whole; rows with
equal or null doc_id are rows of their own. An empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.llm.batches import arrow_schema, only
from eddyline.session import scratch_path

SHARDS = 8

#: Rounds after which propagation ends even if groups still come together.
ROUNDS = 12

#: How far a shard may exceed its size between rounds; documents without links even it out.
SLACK = 0.05

#: A group with more than this share of a shard's size is large; all shards hold 800 at most.
LARGE_SHARE = 0.01

_NODE = "doc_id long, size long, text_crc32 long, h long, g long"


def _fraction(*columns: object) -> Column:
    """A number from 0 to below 1 by hash."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) / F.lit(float(1 << 30))


def place_large(groups: list[tuple[int, int]], room: list[int]) -> list[list[tuple[int, int]]]:
    """For groups (name, members), largest first: the shards and how many members go to each.

    A whole group goes where the least room is left over; a group that fits nowhere is divided
    over the shards with most room. `room` is what remains.
    """
    out = []
    for _, members in groups:
        fitting = [shard for shard in range(len(room)) if room[shard] >= members]
        parts, left = [], members
        while left:
            shard = min(fitting, key=room.__getitem__) if fitting else max(range(len(room)), key=room.__getitem__)
            taken = min(left, room[shard])
            room[shard] -= taken
            left -= taken
            parts.append((shard, taken))
        out.append(parts)
    return out


def granted_shares(wished: dict[tuple[int, int], int], sizes: list[int], most: int) -> list[float]:
    """Share of the wishes for each shard that can be granted under the quotas.

    Shares shrink until nothing enters a shard beyond its free places and what leaves it.
    """
    shards = range(len(sizes))
    shares = [1.0] * len(sizes)
    for _ in range(50):
        leaving = [sum(wished.get((shard, to), 0) * shares[to] for to in shards) for shard in shards]
        entering = [sum(wished.get((origin, shard), 0) for origin in shards) for shard in shards]
        shares = [
            min(shares[shard], (max(0, most - sizes[shard]) + leaving[shard]) / entering[shard]) if entering[shard] else 1.0
            for shard in shards
        ]
    return shares


def _pick(values: list[float], by: Column) -> Column:
    """The value at an integer column's place."""
    return F.element_at(F.array(*[F.lit(value) for value in values]), (by + 1).cast("int"))


def _propagate(linked: DataFrame, other_sizes: list[int], most: int, turn: int) -> tuple[DataFrame, int]:
    """One round over the linked documents of small groups, which carry their `shard`; and how
    many groups were divided before it."""
    counts = linked.groupBy("h", "g", "shard").agg(F.count(F.lit(1)).alias("here"))
    wishes = counts.groupBy("h", "g").agg(
        F.max_by("shard", F.struct(F.col("here"), F.xxhash64("h", "g", "shard"))).alias("wish"),
        F.collect_list(F.struct("shard", "here")).alias("places"),
    )
    flows = (
        wishes.select("wish", (F.size("places") > 1).alias("divided"), F.explode("places").alias("place"))
        .groupBy(F.col("place.shard").alias("shard"), "wish").agg(
            F.sum("place.here").alias("count"),
            F.count_if(F.col("divided") & (F.col("wish") == F.col("place.shard"))).alias("divided"),
        ).collect()
    )
    sizes, wished = list(other_sizes), {}
    for shard, wish, count, _ in flows:
        sizes[shard] += count
        if shard != wish:
            wished[shard, wish] = count
    shares = granted_shares(wished, sizes, most)
    luck = _fraction("h", "g", F.lit(turn))
    moved = F.when(luck < _pick(shares, F.col("wish")), F.col("wish")).otherwise(F.col("shard"))
    joined = linked.join(wishes.select("h", "g", "wish"), ["h", "g"])
    return joined.withColumn("shard", moved.cast("int")).drop("wish"), sum(row["divided"] for row in flows)


def _numbered(batches):
    """Rank of each row among the rows of its shard in this partition, which is sorted."""
    part, shard, rank = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        ranks = []
        for value in batch.column("shard").to_pylist():
            if value != shard:
                shard, rank = value, 0
            ranks.append(rank)
            rank += 1
        schema = batch.schema.append(pa.field("part", pa.int32())).append(pa.field("rank", pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([part] * len(ranks), pa.int32()), pa.array(ranks, pa.int64())], schema=schema,
        )


def settle(placed: DataFrame, shards: int, folder: str) -> DataFrame:
    """Shards of equal counts and gapless slots; `placed` has shard, single, h, g and doc_id."""
    spark = placed.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["shard", "single", "h", "g", "doc_id"]
    ordered = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    kinds = ", ".join(f"{name} {kind}" for name, kind in placed.dtypes) + ", part int, rank long"
    ordered.mapInArrow(_numbered, kinds).write.parquet(f"{folder}/ranked")
    ranked = spark.read.schema(kinds).parquet(f"{folder}/ranked")
    totals = ranked.groupBy("shard", "part").count().orderBy("shard", "part").collect()
    sizes, bases = [0] * shards, []
    for shard, part, count in totals:
        bases.append((shard, part, sizes[shard]))
        sizes[shard] += count
    whole, rest = divmod(sum(sizes), shards)
    aims = [whole + (shard < rest) for shard in range(shards)]
    over, free, moved, places = [], [], 0, 0
    for size, aim in zip(sizes, aims, strict=True):
        over.append(moved)
        free.append(places)
        moved += max(0, size - aim)
        places += max(0, aim - size)
    # One row per shard and part: as many as the tasks that ranked the rows.
    based = ranked.join(F.broadcast(spark.createDataFrame(bases, "shard int, part int, base long")), ["shard", "part"])
    slot = F.col("base") + F.col("rank")
    turn = _pick(over, F.col("shard")) + slot - _pick(aims, F.col("shard"))
    stays = slot < _pick(aims, F.col("shard"))
    taker = reduce(
        lambda found, shard: F.when(turn >= free[shard], F.lit(shard)).otherwise(found),
        [shard for shard in range(shards) if sizes[shard] < aims[shard]], F.lit(None).cast("int"),
    )
    moving = based.select("*", slot.alias("own_slot"), stays.alias("stays"), turn.alias("turn"), taker.alias("taker"))
    taken = _pick(sizes, F.col("taker")) + F.col("turn") - _pick(free, F.col("taker"))
    return moving.select(
        *[name for name in placed.columns if name != "shard"],
        F.when(F.col("stays"), F.col("shard")).otherwise(F.col("taker")).cast("int").alias("shard"),
        F.when(F.col("stays"), F.col("own_slot")).otherwise(taken).cast("long").alias("slot"),
    )


def shard_documents(documents: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard (null under this law)."""
    spark = documents.sparkSession
    folder = scratch_path(spark, "sharding")
    text = F.coalesce(F.col("text"), F.lit(""))
    only(documents, doc_id="long", text="string").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.xxhash64(text).alias("h"), F.xxhash64(F.lit("second"), text).alias("g"),
    ).write.parquet(f"{folder}/nodes")
    nodes = spark.read.schema(_NODE).parquet(f"{folder}/nodes")
    total = nodes.count()
    groups = nodes.groupBy("h", "g").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    aims = [total // shards + (shard < total % shards) for shard in range(shards)]
    limit = max(1, int(aims[0] * LARGE_SHARE)) if total else 1
    # At most shards / LARGE_SHARE groups of two numbers.
    large = groups.filter(F.col("members") > limit).orderBy(F.desc("members"), "h", "g").collect()
    room = list(aims)
    placed_large = place_large([((row["h"], row["g"]), row["members"]) for row in large], room)
    parts = [
        (row["h"], row["g"], [(shard, (sum(count for _, count in where[:place + 1])) / row["members"]) for place, (shard, _) in enumerate(where)])
        for row, where in zip(large, placed_large, strict=True)
    ]
    named = spark.createDataFrame(parts, "h long, g long, parts array<struct<shard: int, upto: double>>")
    # As many rows as there are large groups.
    found = nodes.join(F.broadcast(named), ["h", "g"], "left")
    own = _fraction("doc_id", "size", "h")
    part = F.filter("parts", lambda each: own < each["upto"])[0]["shard"]
    in_large = found.filter("parts IS NOT NULL").select(
        *nodes.columns, F.lit(False).alias("single"),
        F.coalesce(part, F.element_at("parts", -1)["shard"]).cast("int").alias("shard"),
    )
    # Other documents start in proportion to the room.
    steps, free = [], max(1, sum(room))
    for shard in range(shards):
        steps.append(sum(room[:shard + 1]) / free)
    first = reduce(
        lambda later, shard: F.when(_fraction("doc_id", "h") < steps[shard], F.lit(shard)).otherwise(later),
        range(shards - 2, -1, -1), F.lit(max(0, shards - 1)),
    )
    small = groups.filter(F.col("members") <= limit)
    kinds = f"{_NODE}, single boolean, shard int"
    rest = found.filter("parts IS NULL").drop("parts").join(small, ["h", "g"], "left")
    rest.select(*nodes.columns, F.col("members").isNull().alias("single"), first.cast("int").alias("shard")).write.parquet(
        f"{folder}/round0",
    )
    start = spark.read.schema(kinds).parquet(f"{folder}/round0")
    other_sizes = [aim - left for aim, left in zip(aims, room, strict=True)]
    for shard, count in start.filter("single").groupBy("shard").count().collect():
        other_sizes[shard] += count
    linked, divided = start.filter("NOT single"), None
    for turn in range(1, rounds + 1):
        moved, before = _propagate(linked, other_sizes, int(-(-total // shards) * (1 + SLACK)), turn)
        if not before or divided is not None and before >= divided:
            break
        divided = before
        moved.select(*start.columns).write.parquet(f"{folder}/round{turn}")
        linked = spark.read.schema(kinds).parquet(f"{folder}/round{turn}")
    placed = start.filter("single").unionByName(linked).unionByName(in_large)
    settled = settle(placed, shards, folder)
    return settled.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def kept_edges(sharded: DataFrame, group: Column) -> tuple[int, int]:
    """Of the pairs of documents with one `group`, those in one shard, and all."""
    counts = sharded.groupBy(group.alias("group"), "shard").agg(F.count(F.lit(1)).alias("here"))
    pairs = counts.groupBy("group").agg(
        F.sum(F.expr("here * (here - 1) / 2")).alias("kept"), F.expr("sum(here) * (sum(here) - 1) / 2").alias("all"),
    )
    kept, total = pairs.agg(F.sum("kept"), F.sum("all")).first()
    return int(kept or 0), int(total or 0)
