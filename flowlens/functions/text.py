"""The multi-line ranking report of the hot-items / hot-URLs jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The report layout printed by the reference jobs.
REPORT_HEADER = "时间： "
REPORT_FOOTER = "-" * 46 + "\n\n"
ITEM_LINE = ("Top", ": 商品ID=", " 访问量=")
URL_LINE = ("No.", ": URL=", " 访问量=")


def ranking_line(rank: Column, key: Column, count: Column, style: str = "items") -> Column:
    prefix, key_label, count_label = ITEM_LINE if style == "items" else URL_LINE
    return F.concat(F.lit(prefix), rank.cast("string"), F.lit(key_label),
                    key.cast("string"), F.lit(count_label), count.cast("string"),
                    F.lit("\n"))


def render_ranking(header_time: Column, ranked_lines: Column) -> Column:
    """``ranked_lines``: array<struct<rank, line>> of one window (at most n)."""
    ordered = F.array_sort(ranked_lines)
    return F.concat(F.lit(REPORT_HEADER), header_time, F.lit("\n"),
                    F.array_join(F.transform(ordered, lambda x: x["line"]), ""),
                    F.lit(REPORT_FOOTER))
