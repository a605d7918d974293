import pytest
from pyspark.sql import functions as F

from conftest import SF001
from flowlens.operators import (final_counts, frequency_cap, late_corrections, split_late,
                                with_watermark)
from flowlens.plans import jobs as J
from flowlens.streaming import late_rows_writer
from flowlens.functions.time import floor_div
from flowlens.plans import adapters as A
from flowlens.sources.tables import load_table

S = 1_000_000
BASE = 1704067200 * S


def _frame(spark, data):
    """data: (event_id, url, event seconds offset, arrival seconds offset)"""
    data = [(i, u, float(e), float(a)) for i, u, e, a in data]
    df = spark.createDataFrame(data, "event_id long, url string, e double, a double")
    return df.select("event_id", "url",
                     F.timestamp_micros((F.col("e") * S).cast("long") + BASE).alias("ts"),
                     ((F.col("a") * S).cast("long") + BASE).alias("arrival_us"))


def _wm(df, block=3600 * S):
    return with_watermark(df, "ts", [F.col("arrival_us"), F.col("event_id")], "1 second",
                          floor_div(F.col("arrival_us"), block))


def test_side_output_boundary(spark):
    # max event time 2000 s; watermark = 1999 s for later arrivals.
    # 10 min / 5 s windows, 60 s lateness: a row is late when its latest window
    # end - 1 ms + 60 s <= 1999 s, i.e. latest end <= 1939.001 s.
    data = [(1, "/a", 2000, 0), (2, "/a", 1334.999, 1), (3, "/a", 1335.0, 2),
            (4, "/a", 1339.999, 3), (5, "/a", 1340.0, 4)]
    accepted, late = split_late(_wm(_frame(spark, data)), "ts", "10 minutes", "5 seconds",
                                "60 seconds")
    assert sorted(r["event_id"] for r in late.collect()) == [2, 3, 4]
    assert sorted(r["event_id"] for r in accepted.collect()) == [1, 5]


def test_corrections_brute_force(spark):
    ev = load_table(spark, SF001, "events")
    log = A.access_log(ev, arrival_delay=True)
    wm = _wm(log, block=6 * 3600 * S)
    accepted, _ = split_late(wm, "ts", "10 minutes", "5 seconds", "60 seconds")
    got_final = {(r["url"], r["e"]): r["cnt"] for r in final_counts(
        accepted, "ts", ["url"], "10 minutes", "5 seconds", "60 seconds").select(
        "url", F.unix_micros("window_end").alias("e"), "cnt").collect()}
    got_corr = {(r["url"], r["e"]): (r["on_time_cnt"], r["final_cnt"]) for r in late_corrections(
        accepted, "ts", ["url"], "10 minutes", "5 seconds", "60 seconds").select(
        "url", F.unix_micros("window_end").alias("e"), "on_time_cnt", "final_cnt").collect()}
    pdf = accepted.select("url", F.unix_micros("ts").alias("us"),
                          F.unix_micros("watermark").alias("wm")).toPandas()
    fin, on = {}, {}
    slide, n = 5 * S, 120
    for r in pdf.itertuples():
        p = r.us // slide
        for e in range(p + 1, p + n + 1):
            end = e * slide
            wm = None if r.wm != r.wm else r.wm  # NaN -> None
            if wm is None or end - 1000 + 60 * S > wm:
                fin[(r.url, end)] = fin.get((r.url, end), 0) + 1
                if wm is None or end - 1000 > wm:
                    on[(r.url, end)] = on.get((r.url, end), 0) + 1
    assert got_final == fin
    assert got_corr == {k: (on.get(k, 0), v) for k, v in fin.items() if v > on.get(k, 0)}


def test_static_rows_advance_the_watermark(spark):
    t0 = 1_700_000_000_000_000
    rows = [(1, "/a", t0), (2, "/static/css", t0 + 900_000_000), (3, "/a", t0 + 1_000_000)]
    log = spark.createDataFrame(rows, "event_id long, url string, us long").select(
        "event_id", "url", F.timestamp_micros("us").alias("ts"),
        (F.col("event_id") * 1_000_000).alias("arrival_us"))
    ranked, late, _ = J.hot_urls(log, "arrival_us", "event_id")
    assert [r["event_id"] for r in late.collect()] == [3]
    assert {r["cnt"] for r in ranked.collect()} == {1}


def test_large_cap_keeps_the_map_side_limit(spark):
    df = spark.range(20_000).select(F.lit("u").alias("user_id"), F.col("id"),
                                F.timestamp_seconds("id").alias("ts"))
    passed, _ = frequency_cap(df, ["user_id"], [F.col("ts"), F.col("id")], 5000)
    assert "WindowGroupLimit" in passed._jdf.queryExecution().optimizedPlan().toString()
    assert passed.count() == 5000


def test_floor_div_is_exact_for_large_ids(spark):
    big = 2 ** 62 + 1
    r = spark.range(1).select(floor_div(F.lit(big), 3).alias("a"), floor_div(F.lit(-7), 3).alias("b"))
    assert tuple(r.first()) == (big // 3, -3)


def test_failing_state_read_fails_the_batch(spark, tmp_path):
    (tmp_path / "state").mkdir()
    (tmp_path / "state" / "part-0.parquet").write_text("not parquet")
    batch = spark.range(1).select(F.timestamp_seconds("id").alias("ts"))
    writer = late_rows_writer(str(tmp_path / "state"), lambda b, i: None)
    with pytest.raises(Exception):
        writer(batch, 1)
    assert [p.name for p in (tmp_path / "state").iterdir()] == ["part-0.parquet"]
