"""Unique visitors per window.

* exact: ``count(DISTINCT user)`` per window — Catalyst plans it as a
  dedupe aggregate on (window, user) followed by a partial/final count, so a
  hot window is spread over its users.
* bitmap (the reference's bounded-memory variant): the user id is hashed to a
  30-bit offset; offsets are set in 32768-bit bitmaps per (window, bucket)
  with ``bitmap_construct_agg`` (OR-mergeable, so partial aggregation applies)
  and bit counts are summed per window.  Equals the distinct count of offsets.
* approx: HyperLogLog++ (``approx_count_distinct``) or a DataSketches HLL.
* running: the count seen so far after every arrival (the reference updates
  its stored count per element) — first-seen flags and a block prefix sum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import DEFAULT_BITS, DEFAULT_SEED, poly_hash
from ..functions.time import floor_div
from .scan import running_agg
from .windows import window_ends


def unique_visitors(df: DataFrame, ts: str, user: str, size="1 hour", slide=None,
                    out_col: str = "uv") -> DataFrame:
    w = window_ends(df.select(ts, user), ts, size, slide)
    return w.groupBy("window_start", "window_end").agg(F.count_distinct(user).alias(out_col))


def bitmap_unique_visitors(df: DataFrame, ts: str, user: str, size="1 hour", slide=None,
                           seed: int = DEFAULT_SEED, bits: int = DEFAULT_BITS,
                           out_col: str = "uv") -> DataFrame:
    w = window_ends(df.select(ts, user), ts, size, slide)
    h = w.select("window_start", "window_end", poly_hash(F.col(user), seed, bits).alias("_h"))
    per_bucket = h.groupBy("window_start", "window_end",
                           F.bitmap_bucket_number("_h").alias("_b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_h")).alias("_bm"))
    return per_bucket.groupBy("window_start", "window_end").agg(
        F.sum(F.bitmap_count("_bm")).alias(out_col))


def approx_unique_visitors(df: DataFrame, ts: str, user: str, size="1 hour", slide=None,
                           out_col: str = "uv", method: str = "hllpp",
                           rsd: float = 0.01) -> DataFrame:
    w = window_ends(df.select(ts, user), ts, size, slide)
    if method == "sketch":
        agg = F.hll_sketch_estimate(F.hll_sketch_agg(F.col(user), 12))
    else:
        agg = F.approx_count_distinct(user, rsd)
    return w.groupBy("window_start", "window_end").agg(agg.alias(out_col))


def running_unique_visitors(df: DataFrame, ts: str, user: str, arrival: str,
                            size="1 hour", block_rows: int = 1 << 16,
                            out_col: str = "uv_so_far") -> DataFrame:
    """After each arrival: distinct users seen so far in its (tumbling) window.

    First-seen flag: an arrival is the first of its (window, user) when it
    equals the minimum arrival of that pair — found with a hash aggregate and
    an equi-join on (window, user, arrival), so a hot user is not one task.
    The running sum is a block prefix scan (``scan.running_agg``).
    """
    w = window_ends(df.select(ts, user, arrival), ts, size)
    firsts = (w.groupBy("window_end", user).agg(F.min(arrival).alias(arrival))
               .withColumn("_first", F.lit(1)))
    flagged = w.join(firsts.select("window_end", user, arrival, "_first"),
                     on=["window_end", user, arrival], how="left")
    out = running_agg(flagged, ["window_end"], [F.col(arrival)],
                      F.coalesce(F.col("_first"), F.lit(0)), out_col,
                      block=floor_div(F.col(arrival), block_rows), fn="sum")
    return out.select("window_start", "window_end", arrival, user, out_col)
