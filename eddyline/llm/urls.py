"""URL filter by a cascade of Bloom filters, in DataFrame functions alone.

The keys of a table are what its rules can tell apart: a host with the first characters of
a path. Level 0 of the cascade encodes the listed (blocked) keys. Level 1 encodes the unlisted
keys of the table that level 0 lets through by mistake, level 2 the listed keys that level 1
lets through, and so on until a level lets nothing through by mistake. As the levels are built
over every key of the table, the answer for each of them is exact, and a row is judged by
looking into a few bits, without a join.

A filter is an array of 4 KiB bitmaps that reaches the tasks as a scalar subquery. Its size
follows from the number of keys; where a cascade would exceed `most_bytes`, the keys are
dealt by hash into as many key shards as needed, each with a cascade of its own, and so are the
pages, once; each shard reads its own. The numbers of listed and of other keys say how many
shards the first two levels, the largest, need.

Null urls and urls without "://" have empty host and path and fit no rule. An empty table
gives no rows. A url that no rule fits is allowed, since its key is not listed.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eddyline.llm.batches import only
from eddyline.session import scratch_path

ALLOW, BLOCK = "allow", "block"

#: Bits of one bitmap of Spark's bitmap functions (fixed value).
BITMAP_BITS = 32768

#: Bits a key of the levels behind the first.
FURTHER_BITS = 6

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """A host with its subdomains, the beginning of a path, and what becomes of such urls."""

    verdict: str
    host: str
    path: str

    @classmethod
    def parse(cls, verdict: str, text: str) -> Rule:
        """A rule written as host and path, such as `example.com/en/`."""
        cut = text.index("/")
        return cls(verdict, text[:cut], text[cut:])

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        ours = (host == self.host) | host.endswith("." + self.host)
        return ours & path.startswith(self.path)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, lower-cased in A to Z, and path of a url; both empty without "://"."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    pattern = "^([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(rest, pattern, part), F.lit("")) for part in (1, 2))
    return F.translate(host, _UPPER, _LOWER), path


def fitting_rule(rules: Iterable[Rule], host: Column, path: Column) -> Column:
    """Name of the longest rule that fits, or null."""
    ordered = sorted(rules, key=lambda rule: (-len(rule.name), rule.name))
    return F.coalesce(*[F.when(rule.fits(host, path), F.lit(rule.name)) for rule in ordered], F.lit(None).cast("string"))


@dataclass(frozen=True)
class Level:
    """One Bloom filter: where its bitmaps are stored and how many there are."""

    number: int
    path: str
    bitmaps: int
    hashes: int

    def positions(self, key: Column) -> list[Column]:
        bits = F.lit(self.bitmaps * BITMAP_BITS)
        return [F.pmod(F.xxhash64(key, F.lit(self.number), F.lit(turn)), bits) for turn in range(self.hashes)]

    def holds(self, spark: SparkSession, key: Column) -> Column:
        """Whether all bits of a key are set."""
        stored = spark.read.schema("bitmaps array<binary>").parquet(self.path).select("bitmaps").scalar()

        def bit(position: Column) -> Column:
            bitmap = F.get(stored, (position / BITMAP_BITS).cast("int"))
            within = (position % BITMAP_BITS).cast("int")
            byte = F.conv(F.hex(F.substring(bitmap, F.floor(within / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            return F.getbit(byte, within % 8) == 1

        return reduce(Column.__and__, map(bit, self.positions(key)))


def _write_level(keys: DataFrame, level: Level) -> None:
    """Store the bitmaps of all keys as one array."""
    empty = "\x00" * (BITMAP_BITS // 8)
    bits = keys.select(F.explode(F.array(*level.positions(F.col("key")))).alias("bit"))
    bitmaps = (
        bits.groupBy((F.col("bit") / BITMAP_BITS).cast("int").alias("place"))
        .agg(F.bitmap_construct_agg((F.col("bit") % BITMAP_BITS).cast("long")).alias("bitmap"))
    )
    found = bitmaps.agg(F.map_from_entries(F.collect_list(F.struct("place", "bitmap"))).alias("found"))
    array = F.transform(
        F.sequence(F.lit(0), F.lit(level.bitmaps - 1)),
        lambda place: F.coalesce(F.element_at("found", place), F.lit(empty).cast("binary")),
    )
    found.select(array.alias("bitmaps")).write.parquet(level.path)


@dataclass(frozen=True)
class Cascade:
    """The levels for the keys of one key shard."""

    levels: tuple[Level, ...]

    def listed(self, spark: SparkSession, key: Column) -> Column:
        """Whether a key of the universe is listed: the first level without it decides."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            answer = F.when(~level.holds(spark, key), F.lit(level.number % 2 == 1)).otherwise(answer)
        return answer


def build_cascade(universe: DataFrame, folder: str, first_bits: int = 10, further_bits: int = FURTHER_BITS) -> Cascade:
    """Cascade of a universe with distinct `key` and boolean `listed`.

    Each level has `first_bits` (later `further_bits`) bits a key and ln 2 times as many hashes.
    """
    spark = universe.sparkSession
    levels: list[Level] = []
    waiting = [universe.filter("listed").select("key"), universe.filter("NOT listed").select("key")]
    while True:
        number = len(levels)
        encoded, others = waiting[number % 2], 1 - number % 2
        size = encoded.count()
        if size == 0:
            return Cascade(tuple(levels))
        if number >= 64:
            raise RuntimeError("the cascade does not come to an end")
        bits = further_bits if number else first_bits
        level = Level(number, f"{folder}/level{number}", -(-size * bits // BITMAP_BITS), max(1, round(bits * 0.693)))
        _write_level(encoded, level)
        levels.append(level)
        waiting[others] = waiting[others].filter(level.holds(spark, F.col("key")))


def judge_urls(
    pages: DataFrame, rules: Iterable[Rule], most_bytes: int = 16 << 20, first_bits: int = 10,
) -> DataFrame:
    """page_id, host, path, rule and verdict of every page."""
    spark, rules = pages.sparkSession, list(rules)
    host, path = url_parts(F.col("url"))
    longest = max((len(rule.path) for rule in rules), default=0)
    parts = only(pages, page_id="long", url="string").select("page_id", host.alias("host"), path.alias("path"))
    keyed = parts.withColumn("key", F.concat("host", F.substring("path", 1, longest)))
    rule = fitting_rule(rules, F.col("host"), F.col("path"))
    blocked = [rule.name for rule in rules if rule.verdict == BLOCK]
    folder = scratch_path(spark, "urls")
    (
        keyed.groupBy("key").agg(F.max(F.coalesce(rule.isin(blocked), F.lit(False))).alias("listed"))
        .write.parquet(f"{folder}/universe")
    )
    universe = spark.read.schema("key string, listed boolean").parquet(f"{folder}/universe")
    listed, every = universe.agg(F.count_if("listed"), F.count(F.lit(1))).first()
    # The first level holds the listed keys, the second one the others that pass it by chance;
    # further levels are smaller than the one before the last.
    passing = (every - listed) * 0.5 ** (first_bits * 0.693)
    most_bits = max(listed * first_bits, passing * FURTHER_BITS)
    shards = max(1, math.ceil(most_bits / (8 * most_bytes)))
    number = F.pmod(F.xxhash64("key", F.lit("shard")), F.lit(shards)).cast("int")
    if shards > 1:
        # Dealt once, so that each shard reads its own pages and keys alone.
        keyed.withColumn("shard", number).write.partitionBy("shard").parquet(f"{folder}/pages")
        universe.withColumn("shard", number).write.partitionBy("shard").parquet(f"{folder}/keys")
        keyed = spark.read.schema("page_id long, host string, path string, key string, shard int").parquet(f"{folder}/pages")
        universe = spark.read.schema("key string, listed boolean, shard int").parquet(f"{folder}/keys")
    judged = []
    for shard in range(shards):
        ours = F.col("shard") == shard if shards > 1 else F.lit(True)
        cascade = build_cascade(universe.filter(ours), f"{folder}/shard{shard}", first_bits)
        rows = keyed.filter(ours)
        judged.append(
            rows.select(
                "page_id", "host", "path", rule.alias("rule"),
                F.when(cascade.listed(spark, F.col("key")), BLOCK).otherwise(ALLOW).alias("verdict"),
            )
        )
    return reduce(DataFrame.unionAll, judged)
