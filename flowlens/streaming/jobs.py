"""Streaming forms of the jobs (Structured Streaming, append mode).

Native where Spark has the operator (event-time windows with watermarks,
chained stateful aggregations); ``transformWithState`` where the semantics
are per-key ordered state (cap, bursts, pattern).  Window results are final
once the watermark passes the window end, like the reference's
event-time firing; the last windows of a bounded input stay open until later
data arrives (flush with a far-future sentinel row, or run the batch form).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from urllib.parse import unquote
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import poly_hash
from ..functions.time import duration_us, epoch_ms, floor_div, java_timestamp_string
from ..operators.skew import spread_key
from ..operators.topn import top_n_per_window
from .processors import (FailureBurstProcessor, FrequencyCapProcessor, RunningVisitorsProcessor,
                         SequenceMatchProcessor, TopNReportProcessor)
from .ring import above_watermark, ring_counts


def _dur(d) -> str:
    return f"{duration_us(d)} microseconds"


def stream_windowed_count(sdf: DataFrame, ts: str, size, slide=None, keys: Sequence[str] = (),
                          delay="0 seconds", count_col: str = "cnt",
                          method: str = "direct", keep: Column | None = None) -> DataFrame:
    """Count per (keys, window); ``delay`` is the out-of-orderness
    bound (0 = ascending timestamps) plus any allowed lateness.

    ``method='panes'`` chains two aggregations: counts per slide-long pane
    (tumbling), then the pane counts — placed at their ``window_time`` — are
    summed into the sliding windows.  The sliding expansion then applies to
    pane counts instead of events, which pays when many events share a pane
    (1 h / 5 s windows copy every input 720 times in the direct form).

    ``method='ring'`` copies nothing: pane counts as above go into a ring per
    key (``ring``), which sums them up to its windows.

    ``keep`` marks the rows that count.  The others still advance the
    watermark, which a filter would keep from them (it is pushed below the
    watermark); they meet in one group without key, which is not returned."""
    keys = list(keys)
    x = sdf.withWatermark(ts, _dur(delay))
    one = F.lit(1).cast("long")
    if keep is not None:
        kept = F.coalesce(keep, F.lit(False))
        one = F.when(kept, 1).otherwise(0).cast("long")
        x = x.select(ts, *[F.when(kept, F.col(k)).alias(k) for k in keys], one.alias("_one"))
        one = F.col("_one")
    if method in ("panes", "ring") and slide:
        panes = (x.groupBy(F.window(ts, _dur(slide)).alias("pane"), *keys)
                  .agg(F.sum(one).alias("_c"))
                  .select(F.window_time("pane").alias("_wt"), *keys, "_c"))
        if method == "ring":
            c = ring_counts(panes, keys, size, slide, ts="_wt", weight="_c", final=True)
            return c.select("window_start", "window_end", *keys, F.col("cnt").alias(count_col))
        w = F.window("_wt", _dur(size), _dur(slide))
        agg = panes.groupBy(w.alias("window"), *keys).agg(F.sum("_c").alias(count_col))
    else:
        w = F.window(ts, _dur(size), _dur(slide) if slide else None)
        agg = x.groupBy(w.alias("window"), *keys).agg(F.sum(one).alias(count_col))
    return agg.filter(F.col(count_col) > 0).select(F.col("window.start").alias("window_start"),
                      F.col("window.end").alias("window_end"), *keys, count_col)


def top_n_writer(n: int, key: str, sink: Callable[[DataFrame, int], None],
                 count_col: str = "cnt") -> Callable[[DataFrame, int], None]:
    """foreachBatch writer ranking finalized window counts.  In append mode all
    counts of a window are released in the same micro-batch (the watermark is
    global), so ranking inside the batch is complete; the batch ranking uses
    the same group-limited ``row_number`` plan as the batch job."""
    def write(batch: DataFrame, batch_id: int) -> None:
        sink(top_n_per_window(batch, key, n, count_col).select(
            "window_end", "rank", key, count_col), batch_id)
    return write


def stream_hot_items(behavior: DataFrame, pv: str = "pv", size="60 minutes",
                     slide="15 minutes") -> DataFrame:
    """J1 (stream): finalized (window, item) counts; rank with ``top_n_writer``."""
    return stream_windowed_count(behavior, "ts", size, slide, keys=["item_id"],
                                 keep=F.col("behavior") == pv)


def stream_page_views(behavior: DataFrame, pv: str = "pv", size="1 hour") -> DataFrame:
    """J3/J4 (stream): Spark's partial aggregation already spreads the single
    'pv' key over all tasks before the shuffle."""
    return stream_windowed_count(behavior, "ts", size, keep=F.col("behavior") == pv).select(
        "window_end", F.lit("pv").alias("key"), "cnt")


def stream_page_view_partials(behavior: DataFrame, pv: str = "pv", size="1 hour",
                              n_salts: int = 4, salt: Column | None = None) -> DataFrame:
    """J4 (stream), first stage: counts per (window, spread key)."""
    salt = salt if salt is not None else spread_key([F.col("user_id"), F.col("ts")], n_salts)
    return stream_windowed_count(behavior.withColumn("salt", salt), "ts", size, keys=["salt"],
                                 keep=F.col("behavior") == pv)


def stream_page_views_salted(behavior: DataFrame, pv: str = "pv", size="1 hour",
                             n_salts: int = 4, salt: Column | None = None) -> DataFrame:
    """J4 (stream), both stages: the partial counts chained into the total."""
    salt = salt if salt is not None else spread_key([F.col("user_id"), F.col("ts")], n_salts)
    views = behavior.withWatermark("ts", "0 seconds").select(
        "ts", salt.alias("salt"), (F.col("behavior") == pv).alias("_pv"))
    partials = views.groupBy(F.window("ts", _dur(size)).alias("window"), "salt").agg(
        F.count_if("_pv").alias("_c"))
    total = partials.groupBy("window").agg(F.sum("_c").alias("cnt")).filter("cnt > 0")
    return total.select(F.col("window.end").alias("window_end"), F.lit("pv").alias("key"), "cnt")


def stream_marketing_by_channel(market: DataFrame, size="1 hour", slide="5 seconds",
                                uninstall: str = "UNINSTALL") -> DataFrame:
    """J7 (stream): counts per (channel, behavior) and sliding window."""
    c = stream_windowed_count(market, "ts", size, slide, keys=["channel", "behavior"],
                              method="ring", keep=F.col("behavior") != uninstall)
    return c.select(java_timestamp_string(F.col("window_start")).alias("window_start"),
                    java_timestamp_string(F.col("window_end")).alias("window_end"),
                    "channel", "behavior", "cnt")


def stream_marketing_total(market: DataFrame, size="1 hour", slide="5 seconds",
                           uninstall: str = "UNINSTALL") -> DataFrame:
    """J8 (stream): all-channel counts per sliding window."""
    c = stream_windowed_count(market, "ts", size, slide, method="ring",
                              keep=F.col("behavior") != uninstall)
    return c.select(epoch_ms(F.col("window_start")).cast("string").alias("window_start"),
                    epoch_ms(F.col("window_end")).cast("string").alias("window_end"),
                    F.lit("total").alias("channel"), F.lit("total").alias("behavior"), "cnt")


def stream_unique_visitors(behavior: DataFrame, pv: str = "pv", size="1 hour") -> DataFrame:
    """J5 (stream): exact distinct users — (window, user) aggregate chained into
    a per-window count (``count_distinct`` is not allowed on streams)."""
    rows = behavior.withWatermark("ts", "0 seconds").select(
        "ts", *_if_view(pv, F.col("user_id").alias("user_id")))
    per_user = rows.groupBy(F.window("ts", _dur(size)).alias("window"), "user_id").agg(
        F.sum("_view").alias("_views"))
    uv = per_user.groupBy("window").agg(F.count("user_id").alias("uv"),
                                        F.sum("_views").alias("_views"))
    return uv.filter("_views > 0").select(F.col("window.end").alias("window_end"), "uv")


def stream_unique_visitors_bitmap(behavior: DataFrame, pv: str = "pv",
                                  size="1 hour") -> DataFrame:
    """J6 (stream): bitmaps per (window, bucket) chained into a per-window sum."""
    per_bucket = _visitor_bitmaps(behavior, pv, size)
    uv = per_bucket.groupBy("window").agg(F.sum(F.bitmap_count("bm")).alias("uv"),
                                          F.sum("_views").alias("_views"))
    return uv.filter("_views > 0").select(F.col("window.end").alias("window_end"), "uv")


def _if_view(pv: str, value: Column) -> list[Column]:
    """``value`` (null in rows that are no page view) and 1 or 0.  Rows that do
    not count still advance the watermark; they meet in the group without value."""
    view = F.coalesce(F.col("behavior") == pv, F.lit(False))
    return [F.when(view, value).alias("user_id"),
            F.when(view, 1).otherwise(0).cast("long").alias("_view")]


def _visitor_bitmaps(behavior: DataFrame, pv: str, size) -> DataFrame:
    """(window, bucket, bm, _views): the bitmaps of hashed visitors."""
    rows = behavior.withWatermark("ts", "0 seconds").select(
        "ts", *_if_view(pv, F.col("user_id")))
    h = rows.select("ts", "_view", poly_hash(F.col("user_id")).alias("h"))
    return h.groupBy(F.window("ts", _dur(size)).alias("window"),
                     F.bitmap_bucket_number("h").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias("bm"),
        F.sum("_view").alias("_views"))


def stream_running_bitmap(behavior: DataFrame, pv: str = "pv", size="1 hour") -> DataFrame:
    """A10 (stream, update mode): set bits of every (window, bucket) that the
    micro-batch changed; ``running_visitors_writer`` adds them up."""
    changed = _visitor_bitmaps(behavior, pv, size).filter("bucket IS NOT NULL")
    return changed.select(F.col("window.end").alias("window_end"), "bucket",
                          F.bitmap_count("bm").alias("bits"))


def running_visitors_writer(table_path: str, sink: Callable[[DataFrame, int], None]
                            ) -> Callable[[DataFrame, int], None]:
    """A10: foreachBatch writer over ``stream_running_bitmap``; hands the new
    visitor count (window_end, uv) of every changed window to ``sink``.  The
    bits per bucket are kept in a table partitioned by window end."""
    def write(batch: DataFrame, batch_id: int) -> None:
        merged = _merge_by_window(batch, table_path, "bucket")
        sink(merged.groupBy("window_end").agg(F.sum("bits").alias("uv")), batch_id)
    return write


def _merge_by_window(batch: DataFrame, table_path: str, key: str) -> DataFrame:
    """Puts the rows of ``batch`` into the table in place of those of the same
    (window_end, key); returns all rows of the windows it touched.  A replayed
    batch writes the same rows again."""
    from ..session import checkpoint_dir, path_exists
    spark = batch.sparkSession
    checkpoint_dir(spark)
    merged = batch
    if path_exists(spark, table_path):
        stored = spark.read.schema(batch.schema).parquet(table_path)
        kept = stored.join(batch.select("window_end", key), ["window_end", key], "left_anti")
        merged = batch.unionByName(
            kept.join(batch.select("window_end").distinct(), "window_end", "left_semi"))
    merged = merged.checkpoint()
    (merged.write.mode("overwrite").partitionBy("window_end")
           .option("partitionOverwriteMode", "dynamic").parquet(table_path))
    return merged


def _previous_max(spark, state_path: str, batch_id: int) -> int | None:
    """Largest event time (us) of the batches before ``batch_id``."""
    from ..session import path_exists
    if not path_exists(spark, state_path):  # first batch
        return None
    return (spark.read.parquet(state_path).filter(F.col("batch_id") < batch_id)
                 .agg(F.max("max_us")).collect()[0][0])


def _store_max(spark, state_path: str, batch_id: int, max_us: int) -> None:
    """Records the running maximum.  The last record before this batch stays,
    for a replay; older ones go."""
    from ..session import drop_subfolder, subfolders
    (spark.createDataFrame([(batch_id, max_us)], "batch_id long, max_us long")
          .write.mode("overwrite").parquet(f"{state_path}/batch={batch_id}"))
    ids = sorted(int(f.split("=")[1]) for f in subfolders(spark, state_path) if f.startswith("batch="))
    for old in [i for i in ids if i < batch_id][:-1]:
        drop_subfolder(spark, state_path, f"batch={old}")


def _expire_windows(spark, table_path: str, before_us: int) -> None:
    """Drops the partitions of windows that ended by ``before_us``."""
    from ..session import drop_subfolder, subfolders
    zone = ZoneInfo(spark.conf.get("spark.sql.session.timeZone"))
    epoch = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    for folder in subfolders(spark, table_path):
        if folder.startswith("window_end="):
            end = dt.datetime.fromisoformat(unquote(folder.split("=", 1)[1])).replace(tzinfo=zone)
            if (end - epoch) // dt.timedelta(microseconds=1) <= before_us:
                drop_subfolder(spark, table_path, folder)


def stream_ad_clicks(clicks: DataFrame, max_count: int = 100, day: str = "event",
                     bound="1 day", clock_offset_ms: int = 0) -> DataFrame:
    """B1 (stream): tagged rows, kind='pass' (clicks that count) or 'warn';
    ``sinks.fan_out`` writes both.  ``bound`` is how late a click may come
    before its day is closed.  ``day='processing'`` resets at the next UTC
    midnight of the wall clock with a processing-time timer (use a
    processing-time trigger with it)."""
    mode = {"event": "EventTime", "processing": "ProcessingTime"}.get(day, "None")
    x = clicks.withWatermark("ts", _dur(bound)) if day == "event" else clicks
    return x.groupBy("user_id", "ad_id").transformWithState(
        FrequencyCapProcessor(max_count, day, clock_offset_ms), FrequencyCapProcessor.OUTPUT, "append", mode,
        eventTimeColumnName="ts" if day == "event" else "")


def stream_ad_clicks_by_province(clicks: DataFrame, max_count: int = 100, size="1 hour",
                                 slide="5 seconds", bound="1 day") -> DataFrame:
    """J9 / B2 (stream): the clicks that pass the cap, counted per province and
    sliding window.  The warnings of the same clicks are the 'warn' rows of
    ``stream_ad_clicks``."""
    passed = stream_ad_clicks(clicks, max_count, "event", bound).filter("kind = 'pass'")
    c = ring_counts(passed, ["province"], size, slide, ts="ts")
    return c.select("province", java_timestamp_string(F.col("window_end")).alias("window_end"), "cnt")


def stream_running_unique_visitors(behavior: DataFrame, pv: str = "pv", size="1 hour",
                                   rsd: float = 0.01) -> DataFrame:
    """A10 (stream, approximate): the per-window visitor count as it grows —
    update mode re-emits each window whose count changed in the micro-batch.
    ``stream_running_bitmap`` counts by the bitmap; the count after every single
    arrival is the batch ``running_unique_visitors``."""
    views = (behavior.filter(F.col("behavior") == pv).select("user_id", "ts")
                     .withWatermark("ts", "0 seconds"))
    agg = views.groupBy(F.window("ts", _dur(size)).alias("window")).agg(
        F.approx_count_distinct("user_id", rsd).alias("uv"))
    return agg.select(F.col("window.end").alias("window_end"), "uv")


def stream_running_visitors(behavior: DataFrame, arrival: str = "event_id", pv: str = "pv",
                            size="1 hour") -> DataFrame:
    """A10 (stream): after every arrival the visitors seen so far in its window
    (window_end, arrival, user_id, uv_so_far), by the bitmap of hashed ids."""
    size_us = duration_us(size)
    end = (floor_div(F.unix_micros("ts"), size_us) + 1) * size_us
    # the event time is shifted by the window, so a row is late once its window is closed
    x = behavior.withColumn("clock", F.timestamp_micros(F.unix_micros("ts") + size_us)).withWatermark(
        "clock", _dur(size_us)).filter(above_watermark(F.col("behavior") == pv, "clock"))
    x = x.select(end.alias("end_us"), "clock", F.col(arrival).cast("long").alias("arrival"),
                 F.col("user_id").cast("long").alias("user_id"), poly_hash(F.col("user_id")).alias("bit"))
    return x.groupBy("end_us").transformWithStateInPandas(
        RunningVisitorsProcessor(), RunningVisitorsProcessor.OUTPUT, "append", "EventTime")


def _login_rows(logins: DataFrame, bound, fail_value: str) -> DataFrame:
    fail = F.coalesce(F.col("event_type") == fail_value, F.lit(False))
    return logins.withWatermark("ts", _dur(bound)).select(
        "user_id", "ts", F.unix_micros("ts").alias("us"), F.col("event_id").cast("long").alias("event_id"),
        fail.alias("is_fail"))


def stream_login_bursts(logins: DataFrame, within="2 seconds", min_fails: int = 2,
                        bound="3 seconds", fail_value: str = "fail") -> DataFrame:
    """J10a (stream): event-time timers per user."""
    return _login_rows(logins, bound, fail_value).groupBy("user_id").transformWithStateInPandas(
        FailureBurstProcessor(duration_us(within) // 1000, min_fails),
        FailureBurstProcessor.OUTPUT, "append", "EventTime")


def stream_login_pattern(logins: DataFrame, within="2 seconds", bound="3 seconds",
                         fail_value: str = "fail", steps: int = 2) -> DataFrame:
    """J10b / C4 (stream): ``steps`` consecutive fails, matched in order per user."""
    return _login_rows(logins, bound, fail_value).groupBy("user_id").transformWithStateInPandas(
        SequenceMatchProcessor(duration_us(within) // 1000, steps),
        SequenceMatchProcessor.OUTPUT, "append", "EventTime")


def _open_url_rows(log: DataFrame, size, lateness, bound, static_mode: str) -> DataFrame:
    """Page rows whose event time is shifted by size + lateness: the watermark
    stays max event time - bound, and a row is late only when every window it
    is in is closed."""
    from ..operators.filters import not_static
    shift = duration_us(size) + duration_us(lateness)
    x = log.withColumn("clock_in", F.timestamp_micros(F.unix_micros("ts") + shift))
    x = x.withWatermark("clock_in", _dur(shift + duration_us(bound)))
    return x.filter(above_watermark(not_static("url", static_mode), "clock_in"))


def stream_hot_urls(log: DataFrame, size="10 minutes", slide="5 seconds", bound="1 second",
                    lateness="60 seconds", static_mode: str = "segment") -> DataFrame:
    """J2 (stream): finalized (window, url) counts from pane rings.  The
    watermark delay is the out-of-orderness bound plus the allowed lateness, so
    every window is released once, with the accumulated count a late re-firing
    would reach; rank with ``top_n_writer`` and store with ``sinks``."""
    rows = _open_url_rows(log, size, 0, duration_us(bound) + duration_us(lateness), static_mode)
    return ring_counts(rows, ["url"], size, slide, ts="ts", event="clock_in").drop("phase")


def stream_hot_url_reports(log: DataFrame, n: int = 5, size="10 minutes", slide="5 seconds",
                           bound="1 second", lateness="60 seconds",
                           static_mode: str = "segment") -> DataFrame:
    """N2 / J2 (stream): every report of every window from state alone
    (window_end, report, rank, url, cnt).  Report 1 is the ranking when the
    watermark passes the window end; each micro-batch with late rows of the
    window, up to the lateness, adds one with the accumulated counts."""
    rows = _open_url_rows(log, size, lateness, bound, static_mode)
    counts = ring_counts(rows, ["url"], size, slide, ts="ts", event="clock_in", lateness=lateness,
                         clock="clock")
    x = counts.select(F.unix_micros("window_end").alias("end_us"), "clock", F.col("url").alias("name"),
                      "cnt", "phase")
    return x.groupBy("end_us").transformWithStateInPandas(
        TopNReportProcessor(n, "url", duration_us(lateness) // 1000),
        TopNReportProcessor.OUTPUT.format(key="url"), "append", "EventTime")


def late_rows_writer(state_path: str, sink: Callable[[DataFrame, int], None], size="10 minutes",
                     slide="5 seconds", bound="1 second", lateness="60 seconds",
                     arrival: Sequence[Column] = (), arrival_block: Column | None = None
                     ) -> Callable[[DataFrame, int], None]:
    """L2 (stream) as a foreachBatch writer: rows whose every window is already
    closed for the watermark of the previous batches (max event time seen
    before this batch minus the bound) go to ``sink``.

    With ``arrival`` (ordering columns) and ``arrival_block`` (grows with that
    order, bounds a task's share) the watermark is that of each row: the
    largest event time of the rows that arrived before it, in this batch or an
    earlier one.  The late rows are then those of ``split_late``, whatever the
    batches, as long as batches follow the arrival order.

    The running max event time is one number per batch, stored under
    ``state_path`` keyed by batch id, so a replayed batch reads the same
    watermark and rewrites the same record.
    """
    from ..operators.lateness import TICK_US, split_late, with_watermark
    from ..operators.windows import pane_index, window_geometry
    size_us, slide_us, _ = window_geometry(size, slide)
    bound_us, late_us = duration_us(bound), duration_us(lateness)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        prev = _previous_max(spark, state_path, batch_id)
        if arrival:
            marked = with_watermark(batch, "ts", arrival, bound, arrival_block)
            if prev is not None:
                marked = marked.withColumn("watermark", F.greatest(
                    "watermark", F.timestamp_micros(F.lit(prev - bound_us))))
            late = split_late(marked, "ts", size, slide, lateness)[1]
            sink(late.select(*batch.columns), batch_id)
        elif prev is not None:
            latest_end = pane_index(F.col("ts"), slide_us) * slide_us + size_us
            late = batch.filter(latest_end - TICK_US + late_us <= F.lit(prev - bound_us))
            sink(late, batch_id)
        cur = batch.agg(F.max(F.unix_micros("ts"))).collect()[0][0]
        seen = [v for v in (prev, cur) if v is not None]
        if seen:
            _store_max(spark, state_path, batch_id, max(seen))
    return write


def stream_url_counts_updates(log: DataFrame, size="10 minutes", slide="5 seconds",
                              bound="1 second", lateness="60 seconds",
                              static_mode: str = "segment") -> DataFrame:
    """J2 counts for update mode: every micro-batch re-emits the (window, url)
    counts it changed, with the group's latest event time (``max_ts``) so the
    report writer can follow event-time progress.  Rows are accepted until the
    window end + bound + lateness has passed, as with allowed lateness.  Static
    URLs advance event time as well: their rows come out with url null, cnt 0."""
    from ..operators.filters import not_static
    rows = log.select(F.when(not_static("url", static_mode), F.col("url")).alias("url"), "ts")
    delay = duration_us(bound) + duration_us(lateness)
    w = F.window("ts", _dur(size), _dur(slide))
    agg = (rows.withWatermark("ts", _dur(delay))
               .groupBy(w.alias("window"), "url")
               .agg(F.count("url").alias("cnt"), F.max("ts").alias("max_ts")))
    return agg.select(F.col("window.end").alias("window_end"), "url", "cnt", "max_ts")


def hot_url_reports_writer(table_path: str, state_path: str,
                           sink: Callable[[DataFrame, int], None], n: int = 5,
                           bound="1 second", lateness="60 seconds"
                           ) -> Callable[[DataFrame, int], None]:
    """N2 (stream): foreachBatch writer over ``stream_url_counts_updates``.

    Keeps the current count of every (window, url) in a table partitioned by
    window end (the reference's per-window map state), and reports a window's
    top n when the watermark (max event time - bound) first passes its end
    (on-time report) and again in every later batch that changes it within
    the allowed lateness (re-ranking after late updates).  A window leaves the
    table when the previous batch's watermark has passed its end and the
    lateness: no later row can change it.  Reports carry window_end and batch
    id, so consumers upsert them.
    """
    from ..operators.lateness import TICK_US
    bound_us, late_us = duration_us(bound), duration_us(lateness)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            report(batch, batch_id)
        finally:
            batch.unpersist()

    def report(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        prev = _previous_max(spark, state_path, batch_id)
        cur_b = batch.agg(F.max(F.unix_micros("max_ts"))).collect()[0][0]
        seen = [v for v in (prev, cur_b) if v is not None]
        if not seen:
            return
        cur = max(seen)
        wm_prev = prev - bound_us if prev is not None else None
        wm_cur = cur - bound_us
        end_us = F.unix_micros("window_end") - TICK_US
        merged = _merge_by_window(batch.filter("url IS NOT NULL").select("window_end", "url", "cnt"),
                                  table_path, "url")
        current = spark.read.schema(merged.schema).parquet(table_path)
        due_now = end_us <= F.lit(wm_cur)
        newly_due = due_now if wm_prev is None else due_now & (end_us > F.lit(wm_prev))
        report_windows = (current.filter(newly_due).select("window_end")
                          .unionByName(merged.filter(due_now).select("window_end")).distinct())
        ranked = top_n_per_window(current.join(report_windows, "window_end", "left_semi"),
                                  "url", n)
        sink(ranked.select("window_end", "rank", "url", "cnt")
                   .withColumn("batch_id", F.lit(batch_id).cast("long")), batch_id)
        _store_max(spark, state_path, batch_id, cur)
        if wm_prev is not None:
            _expire_windows(spark, table_path, wm_prev - late_us + TICK_US)
    return write
