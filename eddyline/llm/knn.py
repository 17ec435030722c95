"""Exact top-k search by a Voronoi join of queries and data.

Data and queries are grouped by their nearest pivot; pivots are a bounded number of rows by
hash. Summaries of the groups (count, radius, longest vector) bound the inner product of any
query of a group with any vector of a cell:

    q . x  <=  c . p + |c| r + s |p| + s r      and      q . x  >=  c . p - |c| r - s |p| - s r

for centre c and radius s of the query group, centre p and radius r of the cell. Cells whose
lower bounds guarantee k vectors give a group's threshold, and a cell takes part for a group
only if its upper bound reaches the threshold. Only the necessary cells and groups are sent
to each other, in blocks of bounded size that a task solves alone; the blocks' best rows are
merged per query. Where the bounds of several groups exclude so little that the data would
travel more than for one group of all queries, that one is taken.

Equal vectors are told apart only by their id, so of each distinct vector the k + 1 smallest
ids can be answers; the others are left out before the search, which splits a hot vector.

Vectors that are null, or hold nulls or non-finite components, take no part; neither do rows
without id. Vectors of differing lengths are compared over the components that both have.
Repeated ids are rows of their own among the data; a query leaves out the rows of its own id,
and of several rows with one id the least vector is the query. Components
become floor(scale * x), cut off at 2 ** 200; scores are exact integers, cut off at the range of
a long. An empty table, and one without queries, gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eddyline.llm.batches import map_batches, only
from eddyline.llm.products import exact_products
from eddyline.session import scratch_path

SCALE = 1024
K = 10

#: Most pivots of the data and of the queries.
MOST_CELLS = 64
MOST_GROUPS = 16

#: Rows of data and of queries that meet in one block.
CELL_ROWS = 16384
GROUP_ROWS = 4096

_EXACT = float(1 << 53)
_LARGEST = 2.0 ** 200


def _padded(column: pa.Array, width: int) -> np.ndarray:
    matrix = np.zeros((len(column), width))
    for row, values in enumerate(column.to_numpy(zero_copy_only=False)):
        matrix[row, :len(values)] = values
    return matrix


def _assign(batch: pa.RecordBatch, pivots: np.ndarray) -> Iterator[list]:
    vectors = _padded(batch.column("vector"), pivots.shape[1])
    nearness = vectors @ pivots.T - 0.5 * (pivots * pivots).sum(axis=1)
    cells = nearness.argmax(axis=1)
    distances = np.sqrt(((vectors - pivots[cells]) ** 2).sum(axis=1))
    yield [batch.column("vec_id"), batch.column("vector"), cells, distances]


def _usable(embeddings: DataFrame, scale: int) -> DataFrame:
    """vec_id and the integer vector (as doubles) of the rows that take part."""
    vectors = only(embeddings, vec_id="long", embedding="array<double>")

    def bad(value: Column) -> Column:
        return value.isNull() | F.isnan(value) | (F.abs(value) == float("inf"))

    return vectors.filter(
        "vec_id IS NOT NULL AND embedding IS NOT NULL"
    ).filter(~F.exists("embedding", bad)).select(
        "vec_id", F.transform("embedding", lambda value: _floor(value * scale)).alias("vector"),
    )


def _floor(value: Column) -> Column:
    """The floor as a double, within the largest numbers; beyond 2 ** 53 doubles are whole already."""
    value = F.greatest(F.lit(-_LARGEST), F.least(F.lit(_LARGEST), value))
    return F.when(F.abs(value) < _EXACT, F.floor(value).cast("double")).otherwise(value)


def _pivots(frame: DataFrame, most: int, width: int) -> np.ndarray:
    rows = frame.orderBy(F.xxhash64("vec_id", "vector"), "vec_id").limit(most).collect()
    matrix = np.zeros((len(rows), width))
    for place, row in enumerate(rows):
        matrix[place, :len(row["vector"])] = row["vector"]
    return np.unique(matrix, axis=0)


def _grouped(frame: DataFrame, pivots: np.ndarray) -> DataFrame:
    return map_batches(frame, "vec_id long, vector array<double>, cell int, distance double", _assign, pivots)


def _summaries(grouped: DataFrame, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Count and radius of every cell: as many rows as pivots."""
    counts, radii = np.zeros(cells, np.int64), np.zeros(cells)
    for cell, count, radius in grouped.groupBy("cell").agg(F.count(F.lit(1)), F.max("distance")).collect():
        counts[cell], radii[cell] = count, radius
    return counts, radii


def necessary_cells(
    centres: np.ndarray, spreads: np.ndarray, pivots: np.ndarray, radii: np.ndarray, counts: np.ndarray, wanted: int,
) -> np.ndarray:
    """For each query group and cell, whether a vector of the cell may be among the best."""
    middle = centres @ pivots.T
    reach = (
        np.sqrt((centres ** 2).sum(axis=1))[:, None] * radii[None, :]
        + spreads[:, None] * np.sqrt((pivots ** 2).sum(axis=1))[None, :] + spreads[:, None] * radii[None, :]
    )
    slack = 1e-9 * (np.abs(middle) + reach) + 1e-6
    low, high = middle - reach - slack, middle + reach + slack
    order = np.argsort(-low, axis=1)
    held = np.cumsum(counts[order], axis=1) >= wanted
    sure = np.take_along_axis(low, order, axis=1)
    first = held.argmax(axis=1)
    threshold = np.where(held.any(axis=1), sure[np.arange(len(low)), first], -np.inf)
    return (high >= threshold[:, None]) & (counts > 0)[None, :]


def _solver(width: int, k: int):
    columns = ["query_id", "vec_id", "score"]

    def solve(queries: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or data.empty:
            return pd.DataFrame({name: np.zeros(0, np.int64) for name in columns})
        data = data.sort_values("vec_id", kind="stable")
        ids = data["vec_id"].to_numpy()
        matrices = []
        for vectors in (queries["vector"], data["vector"]):
            matrix = np.zeros((len(vectors), width))
            for row, values in enumerate(vectors):
                matrix[row, :len(values)] = values
            matrices.append(matrix)
        parts = []
        for start in range(0, len(queries), 256):
            scores = exact_products(matrices[0][start:start + 256], matrices[1])
            for own, row in zip(queries["vec_id"].to_numpy()[start:start + 256], scores, strict=True):
                others = np.flatnonzero(ids != own)
                if len(others) > k:
                    least = np.partition(row[others], len(others) - k)[len(others) - k]
                    others = others[row[others] >= least]
                # The complement falls as scores rise, for every long.
                best = others[np.argsort(~row[others], kind="stable")[:k]]
                parts.append(np.stack([np.full(len(best), own), ids[best], row[best]]))
        found = np.concatenate(parts, axis=1)
        return pd.DataFrame(dict(zip(columns, found, strict=True)))

    return solve


def top_k(
    embeddings: DataFrame, is_query: Column, k: int = K, scale: int = SCALE,
    cell_rows: int = CELL_ROWS, group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id and score: the k best rows for each row with `is_query` (on vec_id)."""
    spark = embeddings.sparkSession
    folder = scratch_path(spark, "knn")
    kinds = "vec_id long, vector array<double>"
    usable = _usable(embeddings, scale)
    usable.write.parquet(f"{folder}/vectors")
    vectors = spark.read.schema(kinds).parquet(f"{folder}/vectors")
    result = "query_id long, rank int, vec_id long, score long"
    # Of equal vectors only the k + 1 smallest ids can be among k answers.
    copies = Window.partitionBy("digest").orderBy("vec_id")
    digest = F.sha2(F.array_join(F.transform("vector", lambda value: value.cast("string")), ",").cast("binary"), 256)
    ranked = vectors.withColumn("digest", digest).withColumn("copy", F.dense_rank().over(copies))
    data = ranked.filter(F.col("copy") <= k + 1).select("vec_id", "vector")
    queries = vectors.filter(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    width, query_count = vectors.agg(F.max(F.size("vector")), F.count_if(is_query)).first()
    if not width or not query_count:
        return spark.createDataFrame([], result)
    cells = _pivots(vectors, MOST_CELLS, width)
    _grouped(data, cells).write.parquet(f"{folder}/data")
    grouped = f"{kinds}, cell int, distance double"
    data = spark.read.schema(grouped).parquet(f"{folder}/data")
    counts, radii = _summaries(data, len(cells))
    cell_parts = -(-counts // cell_rows)
    choices = []
    for number in sorted({1, max(1, min(MOST_GROUPS, query_count // 128))}):
        centres = _pivots(queries, number, width)
        path = f"{folder}/queries{number}"
        _grouped(queries, centres).write.parquet(path)
        grouped_queries = spark.read.schema(grouped).parquet(path)
        group_counts, spreads = _summaries(grouped_queries, len(centres))
        needed = necessary_cells(centres, spreads, cells, radii, counts, k + 1)
        group_parts = -(-group_counts // group_rows)
        moved = int((needed * counts[None, :] * group_parts[:, None]).sum())
        choices.append((moved, number, grouped_queries, needed, group_parts))
    _, _, queries, needed, group_parts = min(choices, key=lambda choice: choice[:2])

    def routed(frame: DataFrame, parts: np.ndarray, partners: np.ndarray, other_parts: np.ndarray, own: str, other: str) -> DataFrame:
        """The rows once for every block of every partner that needs them, dealt to their own blocks by hash."""
        routes = spark.createDataFrame(
            [
                (place, int(max(1, count)), [(int(one), int(other_parts[one])) for one in np.flatnonzero(partners[place])])
                for place, count in enumerate(parts)
            ],
            f"cell int, parts int, partners array<struct<{other}: int, blocks: int>>",
        )
        # One row per pivot, and in it one entry per pivot of the other side.
        joined = frame.join(F.broadcast(routes), "cell")
        part = F.pmod(F.xxhash64("vec_id", "vector", F.lit(7)), F.col("parts")).cast("int")
        sent = joined.select(
            F.col("cell").alias(own), part.alias(f"{own}_part"), F.explode("partners").alias("partner"), "vec_id", "vector",
        ).filter("partner.blocks > 0")
        return sent.select(
            own, f"{own}_part", f"partner.{other}",
            F.explode(F.sequence(F.lit(0), F.col("partner.blocks") - 1)).alias(f"{other}_part"), "vec_id", "vector",
        )

    block = ["c", "c_part", "g", "g_part"]
    left = routed(queries, group_parts, needed, cell_parts, "g", "c").groupBy(*block)
    right = routed(data, cell_parts, needed.T, group_parts, "c", "g").groupBy(*block)
    found = left.cogroup(right).applyInPandas(_solver(width, k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score",
    )
