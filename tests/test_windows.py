import datetime

from pyspark.sql import functions as F

from conftest import SF001, rows
from flowlens.operators import windowed_count
from flowlens.operators.windows import packed_windows, window_count_profile
from flowlens.plans import adapters as A
from flowlens.sources.tables import load_table


def _events(spark):
    return A.behavior(load_table(spark, SF001, "events"))


def test_runs_equal_fanout_and_direct_sliding(spark):
    ev = _events(spark)
    for size, slide in (("60 minutes", "15 minutes"), ("1 hour", "5 seconds"),
                        ("10 minutes", "5 seconds")):
        runs = windowed_count(ev, "ts", size, slide, keys=["behavior"])
        fan = windowed_count(ev, "ts", size, slide, keys=["behavior"], method="fanout")
        assert rows(runs) == rows(fan)
    direct = windowed_count(ev, "ts", "60 minutes", "15 minutes", keys=["behavior"], method="direct")
    runs = windowed_count(ev, "ts", "60 minutes", "15 minutes", keys=["behavior"])
    assert rows(runs) == rows(direct)


def test_split_runs_equal_fanout_over_many_blocks(spark):
    ev = _events(spark)
    for keys in ([], ["behavior"]):
        for size, slide in (("60 minutes", "15 minutes"), ("1 hour", "5 seconds")):
            split = windowed_count(ev, "ts", size, slide, keys=keys, split=True)
            fan = windowed_count(ev, "ts", size, slide, keys=keys, method="fanout")
            assert rows(split) == rows(fan)


def test_split_runs_of_no_key_stay_spread(spark):
    """Only the table of blocks is ordered in one partition, not the panes."""
    ev = _events(spark)
    plan = windowed_count(ev, "ts", "1 hour", "5 seconds", split=True)
    text = plan._jdf.queryExecution().sparkPlan().toString()
    single = [w for w in text.splitlines() if "Window " in w and "_blk" not in w]
    assert not single, single
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert plan.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_tumbling_equals_direct(spark):
    ev = _events(spark)
    a = windowed_count(ev, "ts", "1 hour", keys=["item_id"])
    b = windowed_count(ev, "ts", "1 hour", keys=["item_id"], method="direct")
    assert rows(a) == rows(b)


def test_profile_matches_expanded(spark):
    ev = _events(spark)
    prof = window_count_profile(ev, "ts", "1 hour", "5 seconds", keys=["behavior"])
    full = windowed_count(ev, "ts", "1 hour", "5 seconds", keys=["behavior"])
    exp = full.groupBy("behavior").agg(F.count(F.lit(1)).alias("n_windows"),
                                       F.max("cnt").alias("max_cnt"),
                                       F.sum(F.col("cnt") * F.col("cnt")).alias("sum_sq_cnt"))
    assert rows(prof) == rows(exp)


def test_window_is_half_open(spark):
    t = 1704070800  # 2024-01-01 01:00:00 UTC, exactly a window end
    df = spark.createDataFrame([(t,), (t - 1,)], "s long").select(F.timestamp_seconds("s").alias("ts"))
    out = {r["window_end"].timestamp(): r["cnt"] for r in windowed_count(df, "ts", "1 hour").collect()}
    assert out == {t: 1, t + 3600: 1}


def test_packed_windows_hold_every_window(spark):
    """Runs longer than a span, several runs in one span, spans before 1970."""
    base = datetime.datetime(1969, 12, 31, 22, 7, 1)
    rows_in = [("a" if i % 3 else "b", base + datetime.timedelta(seconds=i * i * 7 % 20_000))
               for i in range(60)]
    df = spark.createDataFrame(rows_in, "k string, ts timestamp")
    plain = {}
    for r in windowed_count(df, "ts", "1 hour", "10 minutes", keys=["k"]).selectExpr(
            "k", "cnt", "unix_seconds(window_end) as e").collect():
        plain.setdefault((r["k"], r["e"] // 1800), []).append((r["e"] % 1800 // 600, r["cnt"]))
    got = packed_windows(df, "ts", "1 hour", "10 minutes", "k", "30 minutes", "n{}".format)
    got = got.selectExpr("k", "unix_seconds(span_start) as s", "n_windows", "counts").collect()
    assert {(r["k"], r["s"] // 1800): (r["n_windows"], r["counts"]) for r in got} == {
        k: (len(v), ",".join(f"n{i}={c}" for i, c in sorted(v))) for k, v in plain.items()}
