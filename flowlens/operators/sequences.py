"""Login-failure detection.

C1 (strict contiguity, ``fail next fail within w``): per key, ordered by
(time, arrival), the following event(s) must also match and the last must be
less than ``w`` after the first.  Instead of one window partition per key
(a hot key would be one task), rows are split into time buckets of length
B >= w and every row less than w after its bucket start is copied ("halo")
into the previous bucket.  A match starting in bucket b only involves events
before (b+1)·B + w, all present in b's partition, and the halo is a time
prefix of the next bucket, so ``lead`` inside (key, bucket) sees exactly the
true successors that can still complete a match.

C3 (timer-based burst, deterministic event-time rule): the first fail after a
reset anchors a burst at t; fails in the closed interval [t, t+w] join it; a
success inside it cancels the burst; otherwise it is reported when it holds
at least ``min_fails`` fails.  State is clean after every success and after
every gap longer than w, so each key's sequence is cut into independent
segments there (predecessor found with the same halo trick, segment ids via
the block prefix scan).  A segment no longer than w in time is one burst, and
plain aggregates answer it; in a longer one ``chains`` finds the bursts, block
by block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import duration_us, floor_div
from .chains import chain_bursts
from .scan import running_agg

# Messages of the two login jobs.
MATCH_MESSAGE = "Login Fail!"
BURST_MESSAGE = ("Login fail in ", " for ", " times.")


def _bucket_len(within_us: int, bucket) -> int:
    """Time-bucket length: at least ``within``; by default 8 x within (halo
    copies at most 1/8 of the rows) and at least a minute."""
    b = duration_us(bucket) if bucket is not None else max(8 * within_us, duration_us("1 minute"))
    if b < within_us:
        raise ValueError("bucket must be at least as long as 'within'")
    return b


def sequence_match(df: DataFrame, key: str, ts: str, arrival: str, flag: Column,
                   within, steps: int = 2, bucket=None) -> DataFrame:
    """Matches of ``steps`` consecutive flagged events of a key, last one less
    than ``within`` after the first.  Overlapping matches are all reported.
    Output: key, first/last event time and arrival, msg."""
    w_us = duration_us(within)
    b_us = _bucket_len(w_us, bucket)
    us = F.unix_micros(F.col(ts))
    base = df.select(key, ts, arrival, flag.alias("_f"),
                     floor_div(us, b_us).alias("_b"))
    own = base.withColumn("_own", F.lit(True))
    halo = (base.filter(F.unix_micros(F.col(ts)) - F.col("_b") * b_us < w_us)
                .withColumn("_b", F.col("_b") - 1).withColumn("_own", F.lit(False)))
    u = own.unionByName(halo)
    win = Window.partitionBy(key, "_b").orderBy(ts, arrival)
    last = steps - 1
    cond = F.col("_own") & F.col("_f")
    for i in range(1, steps):
        cond = cond & F.coalesce(F.lead("_f", i).over(win), F.lit(False))
    last_ts = F.lead(ts, last).over(win)
    last_arrival = F.lead(arrival, last).over(win)
    x = u.select(key, ts, arrival, cond.alias("_m"), last_ts.alias("_lt"),
                 last_arrival.alias("_la"))
    matched = x.filter(F.col("_m") & (F.unix_micros("_lt") - F.unix_micros(ts) < w_us))
    return matched.select(
        key,
        F.col(ts).alias("first_fail"), F.col("_lt").alias("last_fail"),
        F.col(arrival).alias("first_arrival"), F.col("_la").alias("last_arrival"),
        F.lit(MATCH_MESSAGE).alias("msg"))


def _duration_text(us: int) -> str:
    return f"{us // 1_000_000}s" if us % 1_000_000 == 0 else f"{us / 1_000_000:g}s"


def failure_bursts(df: DataFrame, key: str, ts: str, arrival: str, fail: Column,
                   within="2 seconds", min_fails: int = 2, bucket=None,
                   **chain) -> DataFrame:
    """Output: key, first_fail, last_fail (instants), n_fails, msg.

    ``chain`` (fan, levels) is handed to ``chains.chain_bursts``."""
    w_us = duration_us(within)
    b_us = _bucket_len(w_us, bucket)
    us = F.unix_micros(F.col(ts))
    base = df.select(key, arrival, us.alias("_us"), fail.alias("_fail"),
                     floor_div(us, b_us).alias("_b"))
    # predecessor lookup: rows in the last w of a bucket are copied forward
    own = base.withColumn("_own", F.lit(True))
    halo = (base.filter((F.col("_b") + 1) * b_us - F.col("_us") <= w_us)
                .withColumn("_b", F.col("_b") + 1).withColumn("_own", F.lit(False)))
    win = Window.partitionBy(key, "_b").orderBy("_us", arrival)
    u = own.unionByName(halo).select(
        "*", F.lag("_us").over(win).alias("_pus"), F.lag("_fail").over(win).alias("_pfail"))
    starts = u.filter("_own").withColumn(
        "_start",
        F.col("_pus").isNull() | ~F.col("_pfail") | (F.col("_us") - F.col("_pus") > w_us))
    seg_mark = F.when(F.col("_start"), F.struct(F.col("_us"), F.col(arrival)))
    segs = running_agg(starts, [key], [F.col("_us"), F.col(arrival)], seg_mark, "_seg",
                       block=F.col("_b"), fn="max")
    seg = [key, "_su", "_sa"]
    seg_rows = segs.select(key, "_us", "_fail", F.col("_seg._us").alias("_su"),
                           F.col("_seg").getField(arrival).alias("_sa"))
    spans = seg_rows.groupBy(*seg).agg(
        F.max("_us").alias("_last"), F.count_if("_fail").alias("n_fails"),
        F.count_if(~F.col("_fail")).alias("_bad")).filter(F.col("n_fails") >= min_fails)
    # only a segment's last event can be a success: within w it cancels the burst
    short = spans.filter((F.col("_last") - F.col("_su") <= w_us) & (F.col("_bad") == 0))
    # rows of long segments, matched per time block, not per segment
    block = 64 * w_us
    long_blocks = spans.filter(F.col("_last") - F.col("_su") > w_us).select(
        *seg, F.explode(F.sequence(floor_div(F.col("_su"), block),
                                   floor_div(F.col("_last"), block))).alias("_lb"))
    long_rows = (seg_rows.withColumn("_lb", floor_div(F.col("_us"), block))
                         .join(long_blocks, [*seg, "_lb"], "left_semi").drop("_lb"))
    bursts = short.select(key, F.col("_su").alias("_head"), "_last", "n_fails").unionByName(
        chain_bursts(long_rows, seg, "_su", w_us, min_fails, **chain)
        .select(key, "_head", "_last", "n_fails"))
    a, b, c = BURST_MESSAGE
    return bursts.select(
        key, F.timestamp_micros("_head").alias("first_fail"),
        F.timestamp_micros("_last").alias("last_fail"), "n_fails",
        F.concat(F.lit(a + _duration_text(w_us) + b), F.col("n_fails").cast("string"),
                 F.lit(c)).alias("msg"))
