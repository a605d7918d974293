"""Stateful streams over four and more micro-batches, with rows out of order
inside the bound and days that interleave, equal their batch forms."""

import tempfile

from pyspark.sql import functions as F

from conftest import SF001, rows
from flowlens.operators import failure_bursts, sequence_match
from flowlens.plans import adapters as A
from flowlens.plans import jobs as J
from flowlens.sinks.sinks import fan_out
from flowlens.sources.tables import load_table
from flowlens.streaming import (stream_ad_clicks, stream_ad_clicks_by_province,
                                stream_login_bursts, stream_login_pattern,
                                stream_marketing_by_channel, stream_marketing_total,
                                stream_page_views_salted)

T0 = 1_558_430_842_000
LATE = 4_102_444_800_000  # 2100-01-01, flushes the stream
DAY0 = 1_558_396_800_000  # 2019-05-21 00:00 UTC


def _batches(spark, frames):
    """A stream that reads each frame as one micro-batch, in turn."""
    d = tempfile.mkdtemp(prefix="flowlens-order-")
    for i, f in enumerate(frames):
        f.coalesce(1).write.mode("append").parquet(f"{d}/in")
        import time
        time.sleep(0.05 * (i + 1))  # files are read by modification time
    return d, (spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", 1)
               .parquet(f"{d}/in"))


def _run(sdf, d, name):
    q = (sdf.writeStream.format("memory").queryName(name).outputMode("append")
            .option("checkpointLocation", f"{d}/ck-{name}").trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert q.exception() is None
    return sdf.sparkSession.sql(f"select * from {name}")


def _logins(spark, data):
    return (spark.createDataFrame(data, "event_id long, user_id long, event_type string, ms long")
                 .select("event_id", "user_id", "event_type", F.timestamp_millis("ms").alias("ts")))


def test_login_streams_with_rows_out_of_order(spark):
    batches = [
        [(1, 1, "success", T0 + 1500), (2, 2, "fail", T0 + 100)],
        [(3, 1, "fail", T0 + 1000), (4, 1, "fail", T0 + 2000), (5, 2, "fail", T0 + 2100)],
        [(6, 1, "fail", T0 + 3900), (7, 2, "fail", T0 + 1100), (8, 3, "fail", T0 + 5000)],
        [(9, 3, "fail", T0 + 3500), (10, 1, "success", T0 + 6500), (11, 2, "fail", T0 + 9000)],
        [(12, 2, "fail", T0 + 8500), (13, 3, "success", T0 + 7100)],
        [(99, 9, "success", LATE)]]
    d, sdf = _batches(spark, [_logins(spark, b) for b in batches])
    df = _logins(spark, [r for b in batches for r in b])
    fail = F.col("event_type") == "fail"
    cols = ("user_id", "first_fail", "last_fail", "n_fails", "msg")
    exp = rows(failure_bursts(df, "user_id", "ts", "event_id", fail, "2 seconds", 2), *cols)
    assert rows(_run(stream_login_bursts(sdf), d, "order_bursts"), *cols) == exp
    assert len(exp) >= 3
    cols = ("user_id", "first_arrival", "last_arrival")
    exp = rows(sequence_match(df, "user_id", "ts", "event_id", fail, "2 seconds"), *cols)
    assert rows(_run(stream_login_pattern(sdf), d, "order_pattern"), *cols) == exp
    assert len(exp) >= 3


def _clicks(spark, days, first_id):
    data = [(first_id + i, 7, "ad", "p", DAY0 + d * 86_400_000 + 1000 * i)
            for i, d in enumerate(days)]
    return (spark.createDataFrame(data, "event_id long, user_id long, ad_id string, "
                                        "province string, ms long")
                 .select("event_id", "user_id", "ad_id", "province",
                         F.timestamp_millis("ms").alias("ts")))


def test_cap_counts_interleaved_days_apart(spark):
    frames = [_clicks(spark, [1, 1, 1], 0), _clicks(spark, [2], 10),
              _clicks(spark, [1, 1, 1], 20), _clicks(spark, [2, 2], 30)]
    d, sdf = _batches(spark, frames)
    got = {}
    for tag in ("pass", "warn"):
        got[tag] = f"{d}/{tag}"
    q = fan_out(stream_ad_clicks(sdf, 2), "kind",
                {t: lambda b, i, p=p: b.write.mode("append").parquet(p) for t, p in got.items()},
                "cap_days", trigger={"availableNow": True}, checkpoint=f"{d}/ck")
    q.awaitTermination(300)
    assert q.exception() is None
    per_day = {t: sorted(r["count"] for r in spark.read.parquet(p).groupBy(
        F.to_date("ts").alias("day")).count().collect()) for t, p in got.items()}
    assert per_day == {"pass": [2, 2], "warn": [1, 1]}


def _events(spark):
    return load_table(spark, SF001, "events").orderBy("ts").limit(400)


def test_province_stream_equals_batch(spark):
    clicks = A.with_province(A.ad_clicks(_events(spark)), load_table(spark, SF001, "customer"),
                             load_table(spark, SF001, "nation")).cache()
    cut = [r[0] for r in clicks.selectExpr("percentile(unix_millis(ts), array(.25,.5,.75))").collect()][0]
    ms = F.unix_millis("ts")
    edges = [None, *cut, None]
    frames = [clicks.filter((F.lit(True) if a is None else ms > a) & (F.lit(True) if b is None else ms <= b))
              for a, b in zip(edges, edges[1:])]
    end = clicks.limit(1).withColumn("ts", F.timestamp_millis(F.lit(LATE)))
    d, sdf = _batches(spark, [*frames, end])
    sdf = sdf.select(clicks.columns)
    got = _run(stream_ad_clicks_by_province(sdf, 2, slide="15 minutes"), d, "province_s")
    exp, _ = J.ad_clicks_by_province(clicks, "event_id", 2, slide="15 minutes")
    assert rows(got.filter("window_end < '2099'")) == rows(exp)


def test_marketing_and_two_stage_streams_equal_batch(spark):
    market = A.marketing(_events(spark)).cache()
    end = market.limit(1).withColumn("ts", F.timestamp_millis(F.lit(LATE)))
    d, sdf = _batches(spark, [market, end])
    got = _run(stream_marketing_by_channel(sdf, slide="15 minutes", uninstall=A.UNINSTALL), d, "j7_s")
    exp = J.marketing_by_channel(market, slide="15 minutes", uninstall=A.UNINSTALL)
    assert rows(got.filter("window_end < '2099'")) == rows(exp)
    got = _run(stream_marketing_total(sdf, slide="15 minutes", uninstall=A.UNINSTALL), d, "j8_s")
    exp = J.marketing_total(market, slide="15 minutes", uninstall=A.UNINSTALL)
    assert rows(got.filter(f"bigint(window_end) < {LATE - 86_400_000}")) == rows(exp)
    behavior = A.behavior(_events(spark)).cache()
    end = behavior.limit(1).withColumn("ts", F.timestamp_millis(F.lit(LATE)))
    d, sdf = _batches(spark, [behavior, end])
    got = _run(stream_page_views_salted(sdf, pv=A.PV), d, "j4_s")
    assert rows(got.filter("window_end < '2099-01-01'")) == rows(J.page_views(behavior, pv=A.PV))
