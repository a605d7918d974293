"""Bounded streams without a sentinel, atomic commits, processing-time timers."""

import datetime as dt
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF001, rows
from flowlens.operators import failure_bursts, windowed_count
from flowlens.plans import adapters as A
from flowlens.plans import jobs as J
from flowlens.sinks import ManifestTable, commit_by_window, commit_tagged
from flowlens.sources.tables import load_table
from flowlens.streaming import (BoundedInput, before_end, run_for, run_to_end, stream_ad_clicks,
                                stream_ad_clicks_by_province, stream_hot_items,
                                stream_login_bursts)

BASE = 1704067200


def to_end(spark, df, build, name, out):
    """All results of a stream over two files of ``df``, tail included."""
    d = tempfile.mkdtemp(prefix="flowlens-end-")
    mid = df.agg(F.percentile(F.unix_micros("ts").cast("double"), 0.5)).first()[0]
    df.filter(F.unix_micros("ts") < mid).coalesce(1).write.parquet(f"{d}/in/a")
    df.filter(F.unix_micros("ts") >= mid).coalesce(1).write.parquet(f"{d}/in/b")
    source = BoundedInput(spark, f"{d}/in", df.schema, files_per_batch=1)
    run_to_end(source, lambda s: build(s).writeStream.outputMode("append").format("parquet")
               .option("path", f"{d}/out").option("checkpointLocation", f"{d}/ck"))
    return spark.read.schema(out).parquet(f"{d}/out")


def test_tails_without_a_sentinel(spark):
    ev = load_table(spark, SF001, "events")
    b = A.behavior(ev).filter("user_id % 3 = 0")
    items = to_end(spark, b, lambda s: stream_hot_items(s, pv=A.PV), "end_items",
                   "window_start timestamp, window_end timestamp, item_id long, cnt long")
    exp = windowed_count(b.filter(F.col("behavior") == A.PV), "ts", "60 minutes", "15 minutes",
                         keys=["item_id"])
    got = before_end(items)
    assert rows(got, "window_end", "item_id", "cnt") == rows(exp, "window_end", "item_id", "cnt")

    clicks = A.with_province(A.ad_clicks(ev.filter("user_id % 10 = 0")),
                             load_table(spark, SF001, "customer"), load_table(spark, SF001, "nation"))
    counts = to_end(spark, clicks, lambda s: stream_ad_clicks_by_province(s, 2, slide="5 minutes"),
                    "end_ads", "province string, window_end string, cnt long")
    exp, _ = J.ad_clicks_by_province(clicks, "event_id", 2, slide="5 minutes")
    assert rows(counts.filter("province is not null")) == rows(exp)

    logins = spark.createDataFrame(
        [(1, 7, "fail", 0), (2, 7, "fail", 1), (3, 8, "success", 500), (4, 9, "fail", 900),
         (5, 9, "fail", 901)], "event_id long, user_id long, event_type string, s long").select(
        "event_id", "user_id", "event_type", F.timestamp_seconds(F.col("s") + BASE).alias("ts"))
    bursts = to_end(spark, logins, stream_login_bursts, "end_logins",
                    "user_id long, first_fail timestamp, last_fail timestamp, n_fails long, msg string")
    exp = failure_bursts(logins, "user_id", "ts", "event_id", F.col("event_type") == "fail",
                         "2 seconds", 2)
    assert sorted(r.user_id for r in bursts.collect()) == [7, 9]  # 9 ends the input
    assert rows(bursts, "user_id", "first_fail", "n_fails") == rows(exp, "user_id", "first_fail", "n_fails")


class Broken(Exception):
    pass


def test_commit_is_all_or_nothing(spark, monkeypatch):
    table = ManifestTable(spark, tempfile.mkdtemp(prefix="flowlens-manifest-") + "/t")
    mk = lambda data: spark.createDataFrame(data, "window_end long, url string, cnt long")
    schema = "window_end long, url string, cnt long"
    assert table.read("counts", schema).collect() == []
    write = commit_by_window(table, "counts")
    write(mk([(1, "a", 5), (1, "b", 2), (2, "a", 1)]), 0)
    good = table._swap
    monkeypatch.setattr(table, "_swap", lambda *a: (_ for _ in ()).throw(Broken()))
    with pytest.raises(Broken):  # rows are written, the manifest is not
        write(mk([(2, "a", 3), (3, "c", 9)]), 1)
    assert rows(table.read("counts", schema)) == [(1, "a", 5), (1, "b", 2), (2, "a", 1)]
    monkeypatch.setattr(table, "_swap", good)
    write(mk([(2, "a", 3), (3, "c", 9)]), 1)  # the replay
    write(mk([(2, "a", 3), (3, "c", 9)]), 1)  # and once more: committed, not acknowledged
    assert rows(table.read("counts", schema)) == [(1, "a", 5), (1, "b", 2), (2, "a", 3), (3, "c", 9)]
    write(mk([(1, "b", 7)]), 10)  # batch 10 is after batch 1; the window is replaced whole
    assert rows(table.read("counts", schema)) == [(1, "b", 7), (2, "a", 3), (3, "c", 9)]


def test_labels_are_committed_together(spark, monkeypatch):
    table = ManifestTable(spark, tempfile.mkdtemp(prefix="flowlens-manifest-") + "/t")
    write = commit_tagged(table, "kind", ["pass", "warn"])
    batch = spark.createDataFrame([("pass", 1), ("warn", 2), ("pass", 3)], "kind string, v long")
    parquet = type(batch.write).parquet
    calls = []

    def once(self, path, *a, **k):  # fails between the two writes
        calls.append(path)
        if len(calls) == 2:
            raise Broken()
        return parquet(self, path, *a, **k)

    monkeypatch.setattr(type(batch.write), "parquet", once)
    with pytest.raises(Broken):
        write(batch, 0)
    assert table.read("pass", "v long").collect() == table.read("warn", "v long").collect() == []
    write(batch, 0)  # the replay
    assert rows(table.read("pass", "v long")) == [(1,), (3,)]
    assert rows(table.read("warn", "v long")) == [(2,)]


def test_cap_resets_at_a_midnight_of_the_wall_clock(spark):
    """The clock is set so that midnight comes a while after the first clicks."""
    d = tempfile.mkdtemp(prefix="flowlens-midnight-")
    mk = lambda ids: spark.createDataFrame(
        [(1, 5, "x", i) for i in ids], "user_id long, ad_id long, province string, event_id long"
    ).select("*", F.timestamp_seconds(F.col("event_id") + BASE).alias("ts"))
    mk([1, 2, 3, 4]).coalesce(1).write.parquet(f"{d}/in/a")
    src = spark.readStream.schema(mk([1]).schema).option("recursiveFileLookup", "true").parquet(f"{d}/in")
    now = int(time.time() * 1000)
    wait = 45_000
    offset = (now // 86_400_000 + 1) * 86_400_000 - now - wait  # midnight in 45 s
    out = stream_ad_clicks(src, 2, day="processing", clock_offset_ms=offset)
    q = (out.writeStream.format("memory").queryName("midnight").outputMode("append")
            .option("checkpointLocation", f"{d}/ck").trigger(processingTime="500 milliseconds").start())

    def kinds():
        return sorted((r.kind, r.event_id) for r in spark.sql("select * from midnight").collect())

    try:
        before = [("pass", 1), ("pass", 2), ("warn", 3)]
        assert run_for(q, 40, lambda: len(kinds()) >= 3)
        assert kinds() == before
        assert time.time() * 1000 < now + wait  # still the same day
        time.sleep(max(0.0, (now + wait) / 1000 - time.time()) + 5)
        mk([11, 12, 13]).coalesce(1).write.parquet(f"{d}/in/b")
        assert run_for(q, 40, lambda: len(kinds()) >= 6)
        assert kinds() == before[:2] + [("pass", 11), ("pass", 12), ("warn", 3), ("warn", 13)]
    finally:
        q.stop()


def test_run_for_gives_up(spark):
    d = tempfile.mkdtemp(prefix="flowlens-wait-")
    spark.range(3).write.parquet(f"{d}/in")
    q = (spark.readStream.schema("id long").parquet(f"{d}/in").writeStream.format("memory")
            .queryName("waiting").option("checkpointLocation", f"{d}/ck")
            .trigger(processingTime="500 milliseconds").start())
    try:
        start = dt.datetime.now()
        assert not run_for(q, 1, lambda: False)
        assert dt.datetime.now() - start < dt.timedelta(seconds=10)
    finally:
        q.stop()
