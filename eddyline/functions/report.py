"""Text reports of ranked windows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ReportLayout:
    header: str
    rank: str
    key: str
    count: str
    rule: str


# Wording of the two reports.
ITEM_REPORT = ReportLayout(
    header="窗口结束时间： ",
    rank=":\t",
    key="商品ID = ",
    count="\t热门度 = ",
    rule="=======================\n",
)
URL_REPORT = ReportLayout(
    header="时间: ",
    rank=": ",
    key="URL= ",
    count="访问量= ",
    rule="==============================",
)


def _line(entry: Column, layout: ReportLayout) -> Column:
    return F.concat(
        F.lit("NO"), entry["rank"].cast("string"), F.lit(layout.rank),
        F.lit(layout.key), entry["key"].cast("string"),
        F.lit(layout.count), entry["count"].cast("string"), F.lit("\n"),
    )


def report_text(window_end: Column, entries: Column, layout: ReportLayout) -> Column:
    """The report of a window from its entries (rank, key, count) in order."""
    body = F.array_join(F.transform(entries, lambda entry: _line(entry, layout)), "")
    header = F.concat(
        F.lit(layout.header), F.date_format(window_end, "yyyy-MM-dd HH:mm:ss.S"), F.lit("\n"),
    )
    return F.concat(header, body, F.lit(layout.rule))


def ranking_report(
    ranked: DataFrame, key: str, layout: ReportLayout,
    window_end: str = "window_end", count: str = "count", rank: str = "rank",
) -> DataFrame:
    """One text per window. `ranked` holds at most n rows per window already."""
    entry = F.struct(
        F.col(rank).alias("rank"), F.col(key).alias("key"), F.col(count).alias("count"),
    )
    listed = ranked.groupBy(window_end).agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    text = report_text(F.col(window_end), F.col("entries"), layout)
    return listed.select(window_end, text.alias("report"))
