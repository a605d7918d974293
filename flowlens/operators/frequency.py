"""B1: per-key click cap with one warning (the ad blacklist filter).

In arrival order within (keys, day): events 1..N pass, event N+1 yields the
single warning "click over N times today", later ones are dropped.  This is
a first-(N+1)-per-group selection: ``row_number() <= N+1`` is planned with a
partial ``WindowGroupLimit`` before the shuffle, so a key holding a third of
the input sends at most N+1 rows per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import utc_string
from .topn import top_n

# Fixed value: warning text of the blacklist side output.
WARNING_TEMPLATE = ("click over ", " times today")


def _day_column(ts: str, day: str) -> Column | None:
    if day == "event":
        return utc_string(F.col(ts), "yyyy-MM-dd")
    if day == "none":
        return None
    raise ValueError("day must be 'event' or 'none'")


def frequency_cap(df: DataFrame, keys: Sequence[str], order_cols: Sequence[Column],
                  max_count: int, ts: str = "ts", day: str = "event"
                  ) -> tuple[DataFrame, DataFrame]:
    """Returns (passed rows, warnings).  ``day='event'`` resets per UTC event
    day; ``day='none'`` never resets (a replayed file is one processing day)."""
    day_col = _day_column(ts, day)
    x = df.withColumn("day", day_col) if day_col is not None else df
    group = [*keys, "day"] if day_col is not None else list(keys)
    ranked = top_n(x, group, order_cols, max_count + 1, rank_col="_n")
    passed = ranked.filter(F.col("_n") <= max_count).drop("_n")
    msg = F.lit(f"{WARNING_TEMPLATE[0]}{max_count}{WARNING_TEMPLATE[1]}")
    warnings = ranked.filter(F.col("_n") == max_count + 1).select(*group, msg.alias("msg"))
    return passed, warnings
