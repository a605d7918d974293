"""The reference jobs as batch DataFrame compositions.

Inputs are record-shaped frames (see ``schemas`` and ``sources``) with an
instant column ``ts``; window bounds come out as instants.  Streaming forms of
the same jobs live in ``flowlens.streaming``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import epoch_ms, floor_div, java_timestamp_string
from ..operators import (behavior_is, behavior_is_not, bitmap_unique_visitors,
                         failure_bursts, format_ranking, frequency_cap, is_fail,
                         late_corrections, not_static, running_unique_visitors,
                         salted_count, salted_partials, sequence_match, split_late,
                         spread_key, top_n_of_runs, top_n_per_window, unique_visitors,
                         windowed_count, with_watermark, final_count_runs)


def hot_items(behavior: DataFrame, n: int = 5, size="60 minutes", slide="15 minutes",
              pv: str = "pv") -> DataFrame:
    """Top-n items by views per sliding window (window_end, rank, item_id, cnt)."""
    views = behavior.filter(behavior_is("behavior", pv)).select("item_id", "ts")
    counts = windowed_count(views, "ts", size, slide, keys=["item_id"])
    return top_n_per_window(counts, "item_id", n).select("window_end", "rank", "item_id", "cnt")


def hot_items_report(ranked: DataFrame) -> DataFrame:
    """N3 over J1's ranking: one text report per window."""
    return format_ranking(ranked, "item_id", style="items")


def hot_urls(log: DataFrame, arrival_us: str, tiebreak: str, n: int = 5, size="10 minutes",
             slide="5 seconds", bound="1 second", lateness="60 seconds",
             static_mode: str = "segment", arrival_block_us: int = 1_000_000,
             arrival_outer_block_us: int = 3_600_000_000
             ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(final top-n per window, late side output, re-fired windows).

    ``arrival_us`` (epoch us, ties by ``tiebreak``) is the order in which rows
    reached the job.  Reports are upserts keyed by window_end: the final
    ranking is the last one emitted for each window.  Every row of the log
    advances the watermark, also those of static files, which are filtered
    after it.
    """
    wm = with_watermark(log, "ts", [F.col(arrival_us), F.col(tiebreak)], bound,
                        floor_div(F.col(arrival_us), arrival_block_us),
                        [floor_div(F.col(arrival_us), arrival_outer_block_us)])
    rows = wm.filter(not_static("url", static_mode))
    accepted, late = split_late(rows, "ts", size, slide, lateness)
    runs, slide_us, per_row = final_count_runs(accepted, "ts", ["url"], size, slide, lateness)
    ranked = top_n_of_runs(runs, "url", n, per_row).select(
        F.timestamp_micros(F.col("_e") * slide_us).alias("window_end"), "rank", "url", "cnt")
    corrections = late_corrections(accepted, "ts", ["url"], size, slide, lateness)
    return ranked, late, corrections


def hot_urls_report(ranked: DataFrame) -> DataFrame:
    """N3 over J2's ranking: one 'No.i: URL=…' text report per window."""
    return format_ranking(ranked, "url", style="urls")


def page_views(behavior: DataFrame, size="1 hour", pv: str = "pv") -> DataFrame:
    """Page views per tumbling window (window_end, key 'pv', cnt)."""
    views = behavior.filter(behavior_is("behavior", pv)).select("ts")
    return windowed_count(views, "ts", size).select(
        "window_end", F.lit("pv").alias("key"), "cnt")


def page_views_salted(behavior: DataFrame, size="1 hour", pv: str = "pv", n_salts: int = 4,
                      salt=None) -> tuple[DataFrame, DataFrame]:
    """(totals, per-salt partials); totals equal J3."""
    views = behavior.filter(behavior_is("behavior", pv))
    salt = salt if salt is not None else spread_key([F.col("user_id"), F.col("ts")], n_salts)
    partials = salted_partials(views.select("ts", salt.alias("_salt_src")), "ts", size,
                               F.col("_salt_src"))
    return salted_count(partials), partials


def unique_visitors_job(behavior: DataFrame, size="1 hour", pv: str = "pv") -> DataFrame:
    """Exact unique visitors per tumbling window."""
    views = behavior.filter(behavior_is("behavior", pv))
    return unique_visitors(views, "ts", "user_id", size)


def unique_visitors_bitmap_job(behavior: DataFrame, size="1 hour", pv: str = "pv") -> DataFrame:
    """One-hash bitmap unique visitors per tumbling window."""
    views = behavior.filter(behavior_is("behavior", pv))
    return bitmap_unique_visitors(views, "ts", "user_id", size)


def running_unique_visitors_job(behavior: DataFrame, arrival: str, size="1 hour",
                                pv: str = "pv") -> DataFrame:
    """J6's per-element count updates (A10)."""
    views = behavior.filter(behavior_is("behavior", pv))
    return running_unique_visitors(views, "ts", "user_id", arrival, size)


def marketing_by_channel(market: DataFrame, size="1 hour", slide="5 seconds",
                         uninstall: str = "UNINSTALL") -> DataFrame:
    """Counts per (channel, behavior) and sliding window, bounds rendered
    like ``java.sql.Timestamp.toString`` (UTC)."""
    rows = market.filter(behavior_is_not("behavior", uninstall)).select("channel", "behavior", "ts")
    c = windowed_count(rows, "ts", size, slide, keys=["channel", "behavior"], split=True)
    return c.select(java_timestamp_string(F.col("window_start")).alias("window_start"),
                    java_timestamp_string(F.col("window_end")).alias("window_end"),
                    "channel", "behavior", "cnt")


def marketing_total(market: DataFrame, size="1 hour", slide="5 seconds",
                    uninstall: str = "UNINSTALL") -> DataFrame:
    """All-channel counts per sliding window; bounds as epoch-ms strings."""
    rows = market.filter(behavior_is_not("behavior", uninstall)).select("ts")
    c = windowed_count(rows, "ts", size, slide, split=True)
    return c.select(epoch_ms(F.col("window_start")).cast("string").alias("window_start"),
                    epoch_ms(F.col("window_end")).cast("string").alias("window_end"),
                    F.lit("total").alias("channel"), F.lit("total").alias("behavior"), "cnt")


def ad_clicks_by_province(clicks: DataFrame, arrival: str, max_count: int = 100,
                          size="1 hour", slide="5 seconds", day: str = "event",
                          ad_key: str = "ad_id", locate: Callable[[DataFrame], DataFrame] | None = None
                          ) -> tuple[DataFrame, DataFrame]:
    """(province counts over clicks that passed the cap, blacklist warnings).

    ``locate`` attaches the province where the clicks lack it; it runs after
    the cap, so only passed clicks are joined."""
    passed, warnings = frequency_cap(clicks, ["user_id", ad_key],
                                     [F.col("ts"), F.col(arrival)], max_count, "ts", day)
    passed = locate(passed) if locate else passed
    counts = windowed_count(passed.select("province", "ts"), "ts", size, slide,
                            keys=["province"], split=True)
    out = counts.select("province", java_timestamp_string(F.col("window_end")).alias("window_end"),
                        "cnt")
    return out, warnings


def login_fail_bursts(logins: DataFrame, arrival: str, within="2 seconds",
                      min_fails: int = 2, fail_value: str = "fail") -> DataFrame:
    """Timer-based burst warnings."""
    return failure_bursts(logins, "user_id", "ts", arrival, is_fail("event_type", fail_value),
                          within, min_fails)


def login_fail_pattern(logins: DataFrame, arrival: str, within="2 seconds",
                       fail_value: str = "fail") -> DataFrame:
    """``fail next fail within`` pattern matches."""
    return sequence_match(logins, "user_id", "ts", arrival, is_fail("event_type", fail_value),
                          within)
