"""Top-n per window; N3: the text report.

``row_number() <= n`` over a window partition is rewritten by Catalyst into a
partial ``WindowGroupLimit`` before the shuffle, so each map task forwards at
most n rows per group — the distributed form of the reference's
buffer-sort-take.  Ties are broken by the key (ascending) so results are
deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import ranking_line, render_ranking
from ..functions.time import java_timestamp_string


def top_n(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column],
          n: int, rank_col: str = "rank") -> DataFrame:
    # beyond this many ranks (1,000 by default) Spark would drop the map-side limit
    conf, key = df.sparkSession.conf, "spark.sql.optimizer.windowGroupLimitThreshold"
    if int(conf.get(key)) <= n:
        conf.set(key, str(n + 1))
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def top_n_per_window(counts: DataFrame, key: str, n: int = 5, count_col: str = "cnt",
                     window_col: str = "window_end") -> DataFrame:
    """Rank keys of each window by count desc, key asc; keep the first n."""
    return top_n(counts, [window_col], [F.col(count_col).desc(), F.col(key).asc()], n)


def top_n_of_runs(runs: DataFrame, key: str, n: int, size: int, count_col: str = "cnt",
                  end_col: str = "_e") -> DataFrame:
    """Top n per window end, from runs ``[_from, _to]`` of constant count.

    A run is cut into aligned intervals of 1, 2, 4, … window ends, at most two
    of each length below ``size`` (its usual greatest length), and the keys are
    ranked per interval.  A window lies in one interval of each length, and in
    an interval the order of its runs is the same for all windows, so the first
    n of a window are among the first n of its intervals: only those are
    expanded to windows and ranked again.
    """
    top = size.bit_length() - 1
    lo, past = F.col("_from"), F.col("_to") + 1

    def bounds(level: int) -> tuple[Column, Column]:
        return F.shiftright(lo + ((1 << level) - 1), level), F.shiftright(past, level)

    def interval(level: int, at: Column) -> Column:
        return F.struct(F.lit(level).alias("_level"), at.alias("_at"))

    cut = []
    for level in range(top):
        a, b = bounds(level)
        cut += [F.when((a < b) & (a.bitwiseAND(1) == 1), interval(level, a)),
                F.when((a < b) & (b.bitwiseAND(1) == 1), interval(level, b - 1))]
    a, b = bounds(top)
    long = F.when(a < b, F.transform(F.sequence(a, F.greatest(a, b - 1)),
                                     lambda at: interval(top, at)))
    rest = F.coalesce(long, F.array().cast("array<struct<_level:int,_at:bigint>>"))
    cells = runs.select(key, count_col, F.explode(
        F.concat(F.array_compact(F.array(*cut)), rest)).alias("_i")) if cut else runs.select(
        key, count_col, F.explode(rest).alias("_i"))
    order = [F.col(count_col).desc(), F.col(key).asc()]
    first = top_n(cells.select(key, count_col, "_i._level", "_i._at"), ["_level", "_at"], order,
                  n, "_rank").drop("_rank")
    width = F.expr("shiftleft(1L, _level)")
    ends = first.select(key, count_col, F.explode(
        F.sequence(F.col("_at") * width, (F.col("_at") + 1) * width - 1)).alias(end_col))
    return top_n(ends, [end_col], order, n)


def format_ranking(ranked: DataFrame, key: str, count_col: str = "cnt",
                   window_col: str = "window_end", rank_col: str = "rank",
                   style: str = "items") -> DataFrame:
    """One report string per window from the output of ``top_n_per_window``.

    Groups hold at most n rows each, so the collect is bounded by n.
    """
    line = ranking_line(F.col(rank_col), F.col(key), F.col(count_col), style)
    per_window = ranked.groupBy(window_col).agg(
        F.collect_list(F.struct(F.col(rank_col).alias("rank"), line.alias("line"))).alias("_lines"))
    return per_window.select(
        window_col,
        render_ranking(java_timestamp_string(F.col(window_col)), F.col("_lines")).alias("report"))
