"""L1–L3: watermark, allowed lateness and the late side output, in batch.

The watermark seen by a row is the largest event time among rows that arrived
before it, minus the out-of-orderness bound (a prefix max over the global
arrival order, computed with the parallel block scan).  With the reference's
millisecond comparisons (a window's last instant is end − 1 ms):

* a (row, window) pair is dropped when  end − 1ms + lateness <= watermark;
* it is *on time* when                   end − 1ms > watermark;
  otherwise it is a late update that re-fires the window with the
  accumulated count;
* a row goes to the late side output when all its windows are dropped, i.e.
  for its latest window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import duration_us, floor_div
from .scan import running_agg
from .windows import count_runs, delta_rows, expand_runs, pane_index, window_geometry

TICK_US = 1_000  # the reference engine's time unit (1 ms)


def with_watermark(df: DataFrame, ts: str, arrival_order: Sequence[Column], bound,
                   arrival_block: Column, outer_blocks: Sequence[Column] = ()) -> DataFrame:
    """Adds ``watermark`` (instant; null before the first arrival).

    ``arrival_block`` (and optional coarser ``outer_blocks``) must grow with
    the arrival order; they bound the per-task share of the global scan."""
    b_us = duration_us(bound)
    out = running_agg(df, [], list(arrival_order), F.unix_micros(F.col(ts)), "_maxprev",
                      block=arrival_block, fn="max", inclusive=False,
                      outer_blocks=outer_blocks)
    return out.withColumn("watermark", F.timestamp_micros(F.col("_maxprev") - b_us)).drop("_maxprev")


def split_late(df: DataFrame, ts: str, size, slide, lateness) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, late side output) of a ``with_watermark`` frame."""
    size_us, slide_us, _ = window_geometry(size, slide)
    late_us = duration_us(lateness)
    latest_end = pane_index(F.col(ts), slide_us) * slide_us + size_us
    is_late = (latest_end - TICK_US + late_us) <= F.unix_micros("watermark")
    is_late = F.coalesce(is_late, F.lit(False))
    return df.filter(~is_late), df.filter(is_late)


def _ranges(accepted: DataFrame, ts: str, keys: Sequence[str], size, slide, lateness,
            with_on_time: bool = True) -> tuple[DataFrame, int, int]:
    """Per accepted row, the window-end index ranges it counts in: kept
    windows [lo_keep, hi] and on-time windows [lo_on, hi] (both suffixes of
    the row's windows), pre-counted per distinct (keys, lo_keep, lo_on, hi)."""
    size_us, slide_us, n = window_geometry(size, slide)
    late_us = duration_us(lateness)
    p = pane_index(F.col(ts), slide_us)
    wm = F.unix_micros("watermark")
    first = p + 1
    keep_min = floor_div(wm + TICK_US - late_us, slide_us) + 1
    on_min = floor_div(wm + TICK_US, slide_us) + 1
    cols = [F.greatest(first, F.coalesce(keep_min, first)).alias("_lo_keep"), (p + n).alias("_hi")]
    if with_on_time:
        cols.append(F.greatest(first, F.coalesce(on_min, first)).alias("_lo_on"))
    r = accepted.select(*keys, *cols)
    group = ["_lo_keep", "_hi"] + (["_lo_on"] if with_on_time else [])
    return r.groupBy(*keys, *group).agg(F.count(F.lit(1)).alias("_c")), slide_us, n


def late_corrections(accepted: DataFrame, ts: str, keys: Sequence[str], size, slide,
                     lateness, count_col: str = "cnt") -> DataFrame:
    """Per (keys, window): count at the on-time firing and final count after
    late updates; only windows that a late row changed."""
    keys = list(keys)
    ranges, slide_us, n = _ranges(accepted, ts, keys, size, slide, lateness)
    fin, on = "final_" + count_col, "on_time_" + count_col
    zero = F.lit(0).cast("long")
    deltas = delta_rows(ranges, keys, [
        (F.col("_lo_keep"), F.col("_hi"), {fin: F.col("_c"), on: zero}),
        (F.col("_lo_on"), F.col("_hi"), {fin: zero, on: F.col("_c")})])
    runs = count_runs(deltas, keys, [fin, on]).filter(F.col(fin) > F.col(on))
    out = expand_runs(runs, keys, slide_us, n, [on, fin])
    return out.select(*keys, "window_start", "window_end", on, fin)


def final_count_runs(accepted: DataFrame, ts: str, keys: Sequence[str], size, slide,
                     lateness, count_col: str = "cnt") -> tuple[DataFrame, int, int]:
    """(runs of the last reported counts, slide in us, windows a row is in)."""
    keys = list(keys)
    ranges, slide_us, n = _ranges(accepted, ts, keys, size, slide, lateness, with_on_time=False)
    deltas = delta_rows(ranges, keys, [(F.col("_lo_keep"), F.col("_hi"),
                                        {count_col: F.col("_c")})])
    return count_runs(deltas, keys, [count_col]), slide_us, n


def final_counts(accepted: DataFrame, ts: str, keys: Sequence[str], size, slide,
                 lateness, count_col: str = "cnt") -> DataFrame:
    """Per (keys, window) the last reported (accumulated) count."""
    keys = list(keys)
    runs, slide_us, n = final_count_runs(accepted, ts, keys, size, slide, lateness, count_col)
    return expand_runs(runs, keys, slide_us, n, [count_col])
