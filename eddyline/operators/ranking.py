"""Top-N within groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_n(
    scored: DataFrame, n: int, group: str = "window_end", score: str = "count",
    ties: list[str] | None = None, rank: str = "rank",
) -> DataFrame:
    """The n highest scores per group, or all when there are fewer.

    Equal scores are ordered by `ties` ascending. The bound on the row number
    lets Spark cut each task's share to n rows per group before the shuffle.
    """
    others = [name for name in scored.columns if name not in (group, score)]
    order = [F.desc(score), *[F.asc(name) for name in (ties or others)]]
    numbered = scored.withColumn(
        rank, F.row_number().over(Window.partitionBy(group).orderBy(*order)),
    )
    return numbered.filter(F.col(rank) <= n)
