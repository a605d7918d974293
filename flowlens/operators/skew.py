"""P8 + A9: the skew-safe two-stage count of the repartitioned page-view job.

Rows get a spread key (salt) instead of one constant key; stage 1 counts per
(window, salt), stage 2 sums the partials per window.  Catalyst already does
map-side partial aggregation, so the explicit salt is kept as the operator the
reference exposes (its partials are an output of their own).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .windows import windowed_count


def spread_key(cols: list[Column], n: int) -> Column:
    """Deterministic salt in [0, n) (a task index is not reproducible)."""
    return F.pmod(F.xxhash64(*cols), F.lit(n))


def salted_partials(df: DataFrame, ts: str, size, salt: Column,
                    count_col: str = "cnt") -> DataFrame:
    return windowed_count(df.withColumn("salt", salt), ts, size, keys=["salt"],
                          count_col=count_col)


def salted_count(partials: DataFrame, count_col: str = "cnt") -> DataFrame:
    return partials.groupBy("window_start", "window_end").agg(
        F.sum(count_col).alias(count_col))
