"""Tumbling and sliding event-time window counts.

Batch sliding windows avoid ``F.window``'s per-row expansion (720 copies of
every event for 1 h / 5 s).  Rows are first counted per (key, pane), a pane
being one slide long (partial + final hash aggregate, so a hot key is spread
over its panes).  A pane contributes to the contiguous range of window ends
[pane+1, pane+size/slide], so the count of a window only changes where a pane
enters or leaves: pane counts become +/- deltas, one sorted running sum per
key turns them into runs of constant count, and individual windows are
materialised from the runs only where the output needs them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import duration_us, floor_div


#: Window ends per block of ``count_runs_split``.
RUN_BLOCK = 4096


def window_geometry(size, slide=None) -> tuple[int, int, int]:
    size_us = duration_us(size)
    slide_us = duration_us(slide) if slide is not None else size_us
    if size_us % slide_us:
        raise ValueError("window size must be a multiple of the slide")
    return size_us, slide_us, size_us // slide_us


def pane_index(ts: Column, slide_us: int) -> Column:
    return floor_div(F.unix_micros(ts), slide_us)


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys or [])


def _bounds(end_idx: Column, slide_us: int, n: int) -> list[Column]:
    return [F.timestamp_micros((end_idx - n) * slide_us).alias("window_start"),
            F.timestamp_micros(end_idx * slide_us).alias("window_end")]


def delta_rows(df: DataFrame, keys: Sequence[str],
               specs: Sequence[tuple[Column, Column, dict[str, Column]]]) -> DataFrame:
    """Each row adds, for every (lo, hi, weights) spec, its weights to every
    window-end index in [lo, hi]: +w at lo and -w at hi + 1 (an empty range
    adds nothing).  All deltas of a row come out of one ``explode``."""
    names = list(specs[0][2])
    entries = []
    for lo, hi, weights in specs:
        live = lo <= hi
        def w(n, sign):
            return F.when(live, weights[n] * sign).otherwise(F.lit(0)).cast("long").alias(n)
        entries.append(F.struct(lo.alias("_pos"), *[w(n, 1) for n in names]))
        entries.append(F.struct((hi + 1).alias("_pos"), *[w(n, -1) for n in names]))
    d = df.select(*keys, F.explode(F.array(*entries)).alias("_d"))
    return d.select(*keys, "_d._pos", *[F.col("_d." + n).alias(n) for n in names])


def count_runs(deltas: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Window-end ranges [_from, _to] of constant totals, per key.

    One sorted pass per key yields the running totals and the next change
    point; of several deltas at one position only the last row of the
    position spans a non-empty range.  A key's pass holds two rows per pane
    (or per distinct late-row range), so its size is bounded by time span /
    slide, not by the number of events; a hot key was already reduced to
    panes by the partial aggregate.
    """
    win = Window.partitionBy(*keys).orderBy("_pos")
    upto = win.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = deltas.select(*keys, F.col("_pos").alias("_from"),
                         (F.lead("_pos").over(win) - 1).alias("_to"),
                         *[F.sum(n).over(upto).alias(n) for n in names])
    return _live_runs(runs, names)


def _live_runs(runs: DataFrame, names: Sequence[str]) -> DataFrame:
    nonzero = F.lit(False)
    for n in names:
        nonzero = nonzero | (F.col(n) != 0)
    return runs.filter(F.col("_to").isNotNull() & (F.col("_to") >= F.col("_from")) & nonzero)


def count_runs_split(deltas: DataFrame, keys: Sequence[str], names: Sequence[str],
                     block: int = RUN_BLOCK) -> DataFrame:
    """``count_runs`` for few keys (or none): the positions of a key are cut
    into blocks of ``block`` window ends.  Running totals and next change
    points are found per (key, block); what precedes and follows a block comes
    from a table with one row per block, so only that table is ever ordered
    per key.  The runs stay spread over (key, block)."""
    at = (deltas.groupBy(*keys, "_pos").agg(*[F.sum(n).alias(n) for n in names])
                .withColumn("_blk", floor_div(F.col("_pos"), block)))
    by_key = Window.partitionBy(*keys).orderBy("_blk")
    before = by_key.rowsBetween(Window.unboundedPreceding, -1)
    offsets = (at.groupBy(*keys, "_blk")
                 .agg(F.min("_pos").alias("_first"), *[F.sum(n).alias(n) for n in names])
                 .select(*[F.col(k).alias("_k_" + k) for k in keys], F.col("_blk").alias("_k_blk"),
                         F.lead("_first").over(by_key).alias("_next"),
                         *[F.sum(n).over(before).alias("_off_" + n) for n in names]))
    in_block = Window.partitionBy(*keys, "_blk").orderBy("_pos")
    upto = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = at.select(*keys, "_blk", F.col("_pos").alias("_from"),
                      F.lead("_pos").over(in_block).alias("_then"),
                      *[F.sum(n).over(upto).alias(n) for n in names])
    same = F.col("_blk") == F.col("_k_blk")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col("_k_" + k))
    # a merge join leaves the runs where they are: the table of blocks comes to them
    runs = local.join(offsets.hint("merge"), same).select(
        *keys, "_from", (F.coalesce("_then", "_next") - 1).alias("_to"),
        *[(F.col(n) + F.coalesce("_off_" + n, F.lit(0))).alias(n) for n in names])
    return _live_runs(runs, names)


def windowed_count(df: DataFrame, ts: str, size, slide=None,
                   keys: Sequence[str] | str = (), count_col: str = "cnt",
                   method: str = "runs", split: bool = False) -> DataFrame:
    """Count rows per (keys, window).  Output: keys, window_start, window_end, cnt.

    Only windows holding at least one row are emitted, as in the reference.
    ``method``: 'runs' (default) — pane counts become +/- deltas at the first
    and one-past-last window that holds the pane, a running sum per key gives
    constant-count runs, and windows are expanded from runs only at the end;
    'fanout' — each pane count is copied to its size/slide windows and summed;
    'direct' — ``F.window`` (per-row expansion), for comparison.
    ``split`` spreads the runs of one key over blocks of time: for jobs with
    few keys or none, whose keys alone would not fill a cluster.
    """
    keys = _keys(keys)
    size_us, slide_us, n = window_geometry(size, slide)
    if method == "direct":
        w = F.window(ts, f"{size_us} microseconds", f"{slide_us} microseconds")
        out = df.groupBy(*keys, w.alias("w")).agg(F.count(F.lit(1)).alias(count_col))
        return out.select(*keys, F.col("w.start").alias("window_start"),
                          F.col("w.end").alias("window_end"), count_col)
    panes = (df.groupBy(*keys, pane_index(F.col(ts), slide_us).alias("_pane"))
               .agg(F.count(F.lit(1)).alias("_c")))
    if n == 1:
        end_idx = F.col("_pane") + 1
        return panes.select(*keys, *_bounds(end_idx, slide_us, 1),
                            F.col("_c").alias(count_col))
    if method == "fanout":
        fanned = panes.select(
            *keys, F.explode(F.sequence(F.col("_pane") + 1, F.col("_pane") + n)).alias("_e"), "_c")
        summed = fanned.groupBy(*keys, "_e").agg(F.sum("_c").alias(count_col))
        return summed.select(*keys, *_bounds(F.col("_e"), slide_us, n), count_col)
    deltas = delta_rows(panes, keys, [(F.col("_pane") + 1, F.col("_pane") + n,
                                       {count_col: F.col("_c")})])
    runs = (count_runs_split if split else count_runs)(deltas, keys, [count_col])
    return expand_runs(runs, keys, slide_us, n, [count_col])


def expand_runs(runs: DataFrame, keys: Sequence[str], slide_us: int, n: int,
                names: Sequence[str]) -> DataFrame:
    e = runs.select(*keys, F.explode(F.sequence("_from", "_to")).alias("_e"), *names)
    return e.select(*keys, *_bounds(F.col("_e"), slide_us, n), *names)


def split_runs(df: DataFrame, ts: str, size, slide=None, keys: Sequence[str] | str = ()
               ) -> DataFrame:
    """Runs (keys, _from, _to, cnt) of constant count over window ends, spread
    over blocks of time; windows are not expanded."""
    keys = _keys(keys)
    _, slide_us, n = window_geometry(size, slide)
    panes = (df.groupBy(*keys, pane_index(F.col(ts), slide_us).alias("_pane"))
               .agg(F.count(F.lit(1)).alias("_c")))
    deltas = delta_rows(panes, keys, [(F.col("_pane") + 1, F.col("_pane") + n,
                                       {"cnt": F.col("_c")})])
    return count_runs_split(deltas, keys, ["cnt"])


def packed_windows(df: DataFrame, ts: str, size, slide, keys: Sequence[str] | str,
                   span, label: Callable[[int], str]) -> DataFrame:
    """Every window of ``split_runs``, those that end in one ``span`` as one
    row: keys, span_start, n_windows and counts, the text ``label=cnt`` of each
    window in order, joined by commas.  ``label`` names a window by its place
    in the span (0, 1, …).

    A run is cut at span borders, and each cut is rendered at once (its labels
    joined by its count), so no row and no sort entry per window exists; a
    span holds at most span / slide cuts of a key."""
    keys = _keys(keys)
    span_us, slide_us, per_span = window_geometry(span, slide)
    runs = split_runs(df, ts, size, slide, keys)
    spans = F.sequence(floor_div(F.col("_from"), per_span), floor_div(F.col("_to"), per_span))
    cut = runs.select(*keys, "cnt", "_from", "_to", F.explode(spans).alias("_span"))
    first = F.greatest(F.col("_from") - F.col("_span") * per_span, F.lit(0)).cast("int")
    last = F.least(F.col("_to") - F.col("_span") * per_span, F.lit(per_span - 1)).cast("int")
    cut = cut.select(*keys, "_span", "cnt", first.alias("_lo"), (last - first + 1).alias("_n"))
    labels = F.split(F.lit(",".join(label(i) for i in range(per_span))), ",")  # folded to a literal
    count = F.concat(F.lit("="), F.col("cnt").cast("string"))
    text = F.concat(F.call_function("array_join", F.slice(labels, F.col("_lo") + 1, F.col("_n")),
                                    F.concat(count, F.lit(","))), count)
    pieces = F.array_sort(F.collect_list(F.struct("_lo", text.alias("text"))))
    return cut.groupBy(*keys, "_span").agg(
        F.sum("_n").cast("long").alias("n_windows"),
        F.array_join(F.transform(pieces, lambda x: x["text"]), ",").alias("counts")).select(
        *keys, F.timestamp_micros(F.col("_span") * span_us).alias("span_start"), "n_windows",
        "counts")


def window_count_profile(df: DataFrame, ts: str, size, slide=None,
                         keys: Sequence[str] | str = ()) -> DataFrame:
    """Per key: number of non-empty windows, largest window count and the sum
    of squared counts — computed from the runs, without expanding windows."""
    keys = _keys(keys)
    runs = split_runs(df, ts, size, slide, keys)
    length = F.col("_to") - F.col("_from") + 1
    return runs.groupBy(*keys).agg(
        F.sum(length).alias("n_windows"), F.max("cnt").alias("max_cnt"),
        F.sum(length * F.col("cnt") * F.col("cnt")).alias("sum_sq_cnt"))


def window_ends(df: DataFrame, ts: str, size, slide=None) -> DataFrame:
    """Row -> one row per window holding it (adds window_start/window_end).

    For operators that must keep rows (distinct counts, late-data status);
    expands ceil(size/slide) times, so use it on tumbling or short windows.
    """
    size_us, slide_us, n = window_geometry(size, slide)
    pane = pane_index(F.col(ts), slide_us)
    if n == 1:
        end_idx = pane + 1
    else:
        end_idx = F.explode(F.sequence(pane + 1, pane + n))
    x = df.withColumn("_e", end_idx)
    return x.select("*", *_bounds(F.col("_e"), slide_us, n)).drop("_e")
