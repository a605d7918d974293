"""Streaming forms equal the batch forms on the windows that closed.

Input is staged as parquet files read with maxFilesPerTrigger=1 and
availableNow; a last file holds one far-future sentinel row so that the
watermark passes every real window (the tail-flush of a bounded input).
"""

import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF001, rows
from flowlens.operators import failure_bursts, sequence_match, windowed_count
from flowlens.plans import adapters as A
from flowlens.plans import jobs as J
from flowlens.sources.tables import load_table
from flowlens.streaming import (stream_hot_items, stream_login_bursts, stream_login_pattern,
                                stream_page_views, stream_unique_visitors,
                                stream_unique_visitors_bitmap, stream_windowed_count)

SENTINEL_S = 4102444800  # 2100-01-01


def _stage(spark, df, sentinel):
    d = tempfile.mkdtemp(prefix="flowlens-stream-")
    df.coalesce(2).write.parquet(d + "/in")
    sentinel.write.mode("append").parquet(d + "/in")
    return d, spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(d + "/in")


def _run(sdf, d, name):
    spark = sdf.sparkSession
    q = (sdf.writeStream.format("memory").queryName(name).outputMode("append")
            .option("checkpointLocation", f"{d}/ck-{name}").trigger(availableNow=True).start())
    q.awaitTermination(600)
    assert q.exception() is None
    return spark.sql(f"select * from {name}")


@pytest.fixture(scope="module")
def behavior(spark):
    return A.behavior(load_table(spark, SF001, "events"))


@pytest.fixture(scope="module")
def staged(spark, behavior):
    sentinel = (behavior.limit(1).withColumn("ts", F.timestamp_seconds(F.lit(SENTINEL_S)))
                        .withColumn("behavior", F.lit(A.PV)))
    return _stage(spark, behavior, sentinel)


def _real(df, col="window_end"):
    return df.filter(F.unix_seconds(col) < SENTINEL_S)


def test_stream_sliding_count_equals_batch(spark, behavior, staged):
    d, sdf = staged
    got = _run(stream_hot_items(sdf, pv=A.PV), d, "hot_items_s")
    views = behavior.filter(F.col("behavior") == A.PV)
    exp = windowed_count(views, "ts", "60 minutes", "15 minutes", keys=["item_id"])
    assert rows(_real(got), "window_end", "item_id", "cnt") == rows(exp, "window_end", "item_id", "cnt")


def test_stream_page_views_and_uv_equal_batch(spark, behavior, staged):
    d, sdf = staged
    pv = _run(stream_page_views(sdf, pv=A.PV), d, "pv_s")
    assert rows(_real(pv)) == rows(J.page_views(behavior, pv=A.PV))
    uv = _run(stream_unique_visitors(sdf, pv=A.PV), d, "uv_s")
    exp = J.unique_visitors_job(behavior, pv=A.PV).select("window_end", "uv")
    assert rows(_real(uv)) == rows(exp)
    bm = _run(stream_unique_visitors_bitmap(sdf, pv=A.PV), d, "uvb_s")
    assert rows(_real(bm)) == rows(exp)


def test_stream_login_processors(spark):
    T0 = 1558430842_000
    data = [(1, 1035, "fail", T0), (2, 1035, "fail", T0 + 1000),
            (3, 1035, "success", T0 + 2000), (4, 1035, "fail", T0 + 3000),
            (5, 7, "fail", T0 + 10_000), (6, 7, "fail", T0 + 11_000), (7, 7, "fail", T0 + 11_500),
            (8, 7, "success", T0 + 30_000)]
    df = (spark.createDataFrame(data, "event_id long, user_id long, event_type string, ms long")
               .select("event_id", "user_id", "event_type", F.timestamp_millis("ms").alias("ts")))
    sentinel = df.limit(1).select(F.lit(99).cast("long").alias("event_id"),
                                  F.lit(1).cast("long").alias("user_id"),
                                  F.lit("success").alias("event_type"),
                                  F.timestamp_seconds(F.lit(SENTINEL_S)).alias("ts"))
    d, sdf = _stage(spark, df, sentinel)
    bursts = _run(stream_login_bursts(sdf), d, "bursts_s").collect()
    assert sorted((r.user_id, r.n_fails) for r in bursts) == [(7, 3)]
    batch = failure_bursts(df, "user_id", "ts", "event_id", F.col("event_type") == "fail",
                           "2 seconds", 2).collect()
    assert sorted((r.user_id, r.n_fails) for r in batch) == [(7, 3)]
    pattern = _run(stream_login_pattern(sdf), d, "pattern_s")
    exp = sequence_match(df, "user_id", "ts", "event_id", F.col("event_type") == "fail",
                         "2 seconds")
    assert rows(pattern, "first_arrival", "last_arrival") == rows(exp, "first_arrival", "last_arrival")
    assert rows(exp, "first_arrival", "last_arrival") == [(1, 2), (5, 6), (6, 7)]


def test_stream_windowed_count_direct(spark, behavior, staged):
    d, sdf = staged
    got = _run(stream_windowed_count(sdf, "ts", "1 hour", keys=["behavior"]), d, "tumble_s")
    exp = windowed_count(behavior, "ts", "1 hour", keys=["behavior"])
    assert rows(_real(got), "window_end", "behavior", "cnt") == rows(exp, "window_end", "behavior", "cnt")


def test_stream_ad_click_cap_equals_batch(spark):
    from flowlens.operators import frequency_cap
    from flowlens.streaming import stream_ad_clicks
    ev = load_table(spark, SF001, "events")
    clicks = A.with_province(A.ad_clicks(ev), load_table(spark, SF001, "customer"),
                             load_table(spark, SF001, "nation"))
    d = tempfile.mkdtemp(prefix="flowlens-stream-")
    clicks.write.parquet(d + "/in")
    sdf = spark.readStream.schema(clicks.schema).option("maxFilesPerTrigger", 1).parquet(d + "/in")
    got = _run(stream_ad_clicks(sdf, 2), d, "clicks_s")
    passed, warn = frequency_cap(clicks, ["user_id", "ad_id"], [F.col("ts"), F.col("event_id")], 2)
    assert rows(got.filter("kind = 'pass'"), "event_id") == rows(passed, "event_id")
    assert (rows(got.filter("kind = 'warn'"), "user_id", "ad_id", "msg")
            == rows(warn, "user_id", "ad_id", "msg"))


def test_stream_running_unique_visitors_final_values(spark, behavior, staged):
    from flowlens.streaming import stream_running_unique_visitors
    d, sdf = staged
    q = (stream_running_unique_visitors(sdf, pv=A.PV).writeStream.format("memory")
            .queryName("ruv_s").outputMode("update")
            .option("checkpointLocation", f"{d}/ck-ruv").trigger(availableNow=True).start())
    q.awaitTermination(600)
    got = {r.window_end: r.uv for r in
           _real(spark.sql("select window_end, max(uv) as uv from ruv_s group by window_end")).collect()}
    exp = {r.window_end: r.uv for r in J.unique_visitors_job(behavior, pv=A.PV).collect()}
    assert got.keys() == exp.keys()
    assert all(abs(got[k] - exp[k]) <= max(1, 0.02 * exp[k]) for k in exp)


def test_stream_pane_chain_equals_batch(spark, behavior, staged):
    d, sdf = staged
    got = _run(stream_windowed_count(sdf, "ts", "1 hour", "15 minutes", keys=["behavior"],
                                     method="panes"), d, "panes_s")
    exp = windowed_count(behavior, "ts", "1 hour", "15 minutes", keys=["behavior"])
    assert (rows(_real(got), "window_end", "behavior", "cnt")
            == rows(exp, "window_end", "behavior", "cnt"))
