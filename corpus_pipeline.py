"""From raw documents to token counts: the training-data operators as stages of one pipeline.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
reread as the next stage's docs. All but the last return the columns of `documents`.

Null and empty texts go through all stages as empty ones; of all of them near-dedup keeps one.
Texts of any length are handled whole. Rows with null or repeated ids are documents of their own,
whatever their ids; of rows equal in all columns one stays. Further columns are kept as they are,
also where their names are those of the operators' own. Empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eddyline.llm import bpe, decontaminate, neardup, quality, repeats
from eddyline.llm.queries import BYTE_BPE, table
from eddyline.session import scratch_path

#: No SQL expresses the stages; a test runs them against brute-force versions.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; without ratings all stay."""
    return quality.select_quality(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays: that of the least doc_id, null last."""
    return neardup.keep_one(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Long strings that occur twice go out of the texts; documents stay, if with less text."""
    return repeats.remove_repeats(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages go out of the texts; documents stay, if with less text."""
    return decontaminate.remove_phrases(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded texts."""
    return bpe.encoding_digests(docs, BYTE_BPE)


STAGES = [
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("suffix-array dedup", drop_repeats),
    ("benchmark decontamination", drop_benchmark),
    ("BPE encoding and decoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to `documents`, one after the other."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch_path(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs
