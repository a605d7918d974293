"""Streaming hot URLs, the late side output writer and the sinks."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF001, rows
from flowlens.plans import adapters as A
from flowlens.plans import jobs as J
from flowlens.sinks import fan_out, upsert_by_window
from flowlens.sources.tables import load_table
from flowlens.streaming import late_rows_writer, stream_hot_urls, top_n_writer

SENTINEL_S = 4102444800
S = 1_000_000
BASE = 1704067200


def _files(spark, parts, schema):
    d = tempfile.mkdtemp(prefix="flowlens-sink-")
    for i, p in enumerate(parts):
        p.coalesce(1).write.parquet(f"{d}/in/part{i:03d}")
    src = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
                .option("recursiveFileLookup", "true").parquet(f"{d}/in"))
    return d, src


def test_stream_hot_urls_ranked_equals_batch(spark):
    ev = load_table(spark, SF001, "events")
    log = A.access_log(ev).select("event_id", "url", "ts", "arrival_us")
    sentinel = log.limit(1).withColumn("ts", F.timestamp_seconds(F.lit(SENTINEL_S))) \
                  .withColumn("url", F.lit("/sentinel"))
    d, src = _files(spark, [log, sentinel], log.schema)
    out = f"{d}/ranked"
    writer = top_n_writer(5, "url", lambda b, i: b.write.mode("append").parquet(out))
    q = (stream_hot_urls(src).writeStream.foreachBatch(writer)
            .option("checkpointLocation", f"{d}/ck").trigger(availableNow=True).start())
    q.awaitTermination(600)
    assert q.exception() is None
    got = spark.read.parquet(out).filter(F.unix_seconds("window_end") < SENTINEL_S)
    exp, _, _ = J.hot_urls(A.access_log(ev), "arrival_us", "event_id")
    assert rows(got, "window_end", "rank", "url", "cnt") == rows(exp, "window_end", "rank", "url", "cnt")


def test_late_rows_writer(spark):
    schema = "event_id long, ts timestamp"
    mk = lambda data: spark.createDataFrame(
        [(i, s) for i, s in data], "event_id long, s long").select(
        "event_id", F.timestamp_seconds(F.col("s") + BASE).alias("ts"))
    b0 = mk([(1, 2000)])
    b1 = mk([(2, 1330), (3, 1340), (4, 2001)])   # watermark 1999 s: 2 is late, 3 is not
    b2 = mk([(5, 1345), (6, 1341)])              # watermark 2000 s: 6 late (end 1940+60-1ms <= 2000)
    d, src = _files(spark, [b0, b1, b2], schema)
    late_path = f"{d}/late"
    writer = late_rows_writer(f"{d}/state", lambda b, i: b.write.mode("append").parquet(late_path))
    q = (src.writeStream.foreachBatch(writer).option("checkpointLocation", f"{d}/ck")
            .trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert q.exception() is None
    assert sorted(r.event_id for r in spark.read.parquet(late_path).collect()) == [2, 6]


def test_upsert_and_fan_out(spark):
    d = tempfile.mkdtemp(prefix="flowlens-upsert-")
    path = f"{d}/table"
    up = upsert_by_window(path, "window_end")
    b1 = spark.createDataFrame([(1, "a", 5), (2, "a", 1)], "window_end long, url string, cnt long")
    b2 = spark.createDataFrame([(2, "a", 3)], "window_end long, url string, cnt long")
    up(b1, 0)
    up(b2, 1)
    up(b2, 1)  # replay is idempotent
    assert rows(spark.read.parquet(path), "window_end", "url", "cnt") == [(1, "a", 5), (2, "a", 3)]
    tagged = spark.createDataFrame([("pass", 1), ("warn", 2), ("pass", 3)], "kind string, v long")
    src_dir = f"{d}/tagged"
    tagged.coalesce(1).write.parquet(src_dir)
    src = spark.readStream.schema(tagged.schema).parquet(src_dir)
    outs = {k: f"{d}/out_{k}" for k in ("pass", "warn")}
    writers = {k: (lambda p: lambda b, i: b.write.mode("append").parquet(p))(p) for k, p in outs.items()}
    q = fan_out(src, "kind", writers, "fan", trigger={"availableNow": True},
                checkpoint=f"{d}/ck")
    q.awaitTermination(300)
    assert q.exception() is None
    assert rows(spark.read.parquet(outs["pass"])) == [(1,), (3,)]
    assert rows(spark.read.parquet(outs["warn"])) == [(2,)]
    assert os.path.isdir(outs["warn"])


def test_hot_url_reports_rerank_after_late_update(spark):
    from flowlens.streaming import hot_url_reports_writer, stream_url_counts_updates
    schema = "url string, ts timestamp"
    mk = lambda data: spark.createDataFrame(
        [(u, s) for u, s in data], "url string, s long").select(
        "url", F.timestamp_seconds(F.col("s") + BASE).alias("ts"))
    batches = [mk([("/a", 0), ("/b", 1), ("/a", 2)]),
               mk([("/d", 640), ("/c", 700)]),
               mk([("/d", 650)])]          # late for the fired windows 655..695
    d, src = _files(spark, batches, schema)
    out = f"{d}/reports"
    writer = hot_url_reports_writer(f"{d}/table", f"{d}/state",
                                    lambda b, i: b.write.mode("append").parquet(out))
    q = (stream_url_counts_updates(src).writeStream.outputMode("update").foreachBatch(writer)
            .option("checkpointLocation", f"{d}/ck").trigger(availableNow=True).start())
    q.awaitTermination(600)
    assert q.exception() is None
    rep = spark.read.parquet(out)
    w695 = BASE + 695
    at = {(r.batch_id, r.url): r.cnt for r in
          rep.filter(F.unix_seconds("window_end") == w695).collect()}
    assert at == {(1, "/d"): 1, (2, "/d"): 2}
    # last report of every reported window = batch ranking of all rows
    last = (rep.groupBy("window_end").agg(F.max("batch_id").alias("batch_id"))
               .join(rep, ["window_end", "batch_id"]))
    allrows = mk([("/a", 0), ("/b", 1), ("/a", 2), ("/d", 640), ("/c", 700), ("/d", 650)])
    from flowlens.operators import top_n_per_window, windowed_count
    exp = top_n_per_window(windowed_count(allrows, "ts", "10 minutes", "5 seconds", keys=["url"]),
                           "url", 5).join(last.select("window_end"), "window_end", "left_semi")
    assert rows(last, "window_end", "rank", "url", "cnt") == rows(exp, "window_end", "rank", "url", "cnt")


def test_bitmap_uv_stream_into_window_upsert(spark):
    """J6 end to end: streaming bitmap unique visitors stored per window end."""
    from flowlens.streaming import stream_unique_visitors_bitmap
    b = A.behavior(load_table(spark, SF001, "events"))
    sentinel = (b.limit(1).withColumn("ts", F.timestamp_seconds(F.lit(SENTINEL_S)))
                 .withColumn("behavior", F.lit(A.PV)))
    d, src = _files(spark, [b, sentinel], b.schema)
    table = f"{d}/uv"
    q = (stream_unique_visitors_bitmap(src, pv=A.PV).writeStream
            .foreachBatch(upsert_by_window(table, "window_end"))
            .option("checkpointLocation", f"{d}/ck").trigger(availableNow=True).start())
    q.awaitTermination(600)
    assert q.exception() is None
    got = spark.read.parquet(table).filter(F.unix_seconds("window_end") < SENTINEL_S)
    exp = J.unique_visitors_bitmap_job(b, pv=A.PV)
    assert rows(got, "window_end", "uv") == rows(exp, "window_end", "uv")


def test_running_bitmap_counts_after_every_batch(spark):
    """A10 as a stream: the count of every changed window after each
    micro-batch; a row that is no page view closes a window all the same."""
    from flowlens.streaming import running_visitors_writer, stream_running_bitmap
    mk = lambda data: spark.createDataFrame(
        data, "user_id long, behavior string, s long").select(
        "user_id", "behavior", F.timestamp_seconds(F.col("s") + BASE).alias("ts"))
    parts = [[(1, "pv", 0), (2, "pv", 5), (1, "pv", 9)],
             [(2, "pv", 20), (3, "pv", 21), (4, "buy", 22)],
             [(9, "buy", 4000), (7, "pv", 3700)],
             [(9, "buy", 4001)],
             # 30 s is late: the buy row at 4000 s closed its window, one batch later
             [(8, "pv", 30), (8, "pv", 4100)]]
    d, src = _files(spark, [mk(p) for p in parts], mk(parts[0]).schema)
    out = f"{d}/uv"
    writer = running_visitors_writer(f"{d}/bits", lambda b, i: b.withColumn(
        "batch", F.lit(i)).write.mode("append").parquet(out))
    q = (stream_running_bitmap(src).writeStream.outputMode("update").foreachBatch(writer)
            .option("checkpointLocation", f"{d}/ck").trigger(availableNow=True).start())
    q.awaitTermination(600)
    assert q.exception() is None
    got = {(r.batch, int(r.s) - BASE): r.uv for r in
           spark.read.parquet(out).withColumn("s", F.unix_seconds("window_end")).collect()}
    assert got == {(0, 3600): 2, (1, 3600): 3, (2, 7200): 1, (4, 7200): 2}


def test_hot_url_table_expires_and_static_rows_advance_time(spark):
    from flowlens.streaming import hot_url_reports_writer, stream_url_counts_updates
    mk = lambda data: spark.createDataFrame(data, "url string, s long").select(
        "url", F.timestamp_seconds(F.col("s") + BASE).alias("ts"))
    batches = [mk([("/x/css", 0)]), mk([("/a", 1), ("/b", 2)]), mk([("/x/js", 2000)]),
               mk([("/c", 2001)]), mk([("/d", 2002)])]
    d, src = _files(spark, batches, batches[0].schema)
    out, table = f"{d}/reports", f"{d}/table"
    writer = hot_url_reports_writer(table, f"{d}/state",
                                    lambda b, i: b.write.mode("append").parquet(out))
    q = (stream_url_counts_updates(src).writeStream.outputMode("update").foreachBatch(writer)
            .option("checkpointLocation", f"{d}/ck").trigger(availableNow=True).start())
    q.awaitTermination(600)
    assert q.exception() is None
    # the static row at 2000 s closes the first windows in its own batch
    reports = spark.read.parquet(out).select("batch_id", F.unix_seconds("window_end").alias("s"), "url")
    assert {(r.batch_id, r.url) for r in reports.filter(F.col("s") < BASE + 700).collect()} == {
        (2, "/a"), (2, "/b")}
    left = spark.read.parquet(table).select(F.min(F.unix_seconds("window_end"))).collect()[0][0]
    assert left > BASE + 2000
    # the last batch's record and the one before, which a replay would read
    assert len([f for f in os.listdir(f"{d}/state") if f.startswith("batch=")]) == 2
