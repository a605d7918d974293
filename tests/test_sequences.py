from pyspark.sql import functions as F

from conftest import SF001, rows
from flowlens.operators import failure_bursts, sequence_match
from flowlens.plans import adapters as A
from flowlens.sources.tables import load_table

T0 = 1558430842_000  # ms


def _logins(spark, data):
    """data: (event_id, user, type, epoch ms)"""
    df = spark.createDataFrame(data, "event_id long, user_id long, event_type string, ms long")
    return df.withColumn("ts", F.timestamp_millis("ms"))


def _match(df, within="2 seconds", bucket=None):
    return sequence_match(df, "user_id", "ts", "event_id", F.col("event_type") == "fail",
                          within, bucket=bucket)


def _bursts(df, within="2 seconds", bucket=None, min_fails=2):
    return failure_bursts(df, "user_id", "ts", "event_id", F.col("event_type") == "fail",
                          within, min_fails, bucket=bucket)


def test_contrast_pattern_vs_timer(spark):
    # fail, fail 1 s later, success inside the 2 s: the pattern matches once,
    # the timer job is cancelled by the success
    data = [(1, 1035, "fail", T0), (2, 1035, "fail", T0 + 1000),
            (3, 1035, "success", T0 + 2000), (4, 1035, "fail", T0 + 3000),
            (5, 1035, "success", T0 + 4000), (6, 7, "success", T0)]
    df = _logins(spark, data)
    m = _match(df).collect()
    assert [(r["first_arrival"], r["last_arrival"], r["msg"]) for r in m] == [(1, 2, "Login Fail!")]
    assert _bursts(df).count() == 0


def test_gap_exactly_within_is_no_match(spark):
    data = [(1, 1, "fail", T0), (2, 1, "fail", T0 + 2000),
            (3, 2, "fail", T0), (4, 2, "fail", T0 + 1999)]
    got = rows(_match(_logins(spark, data)), "user_id")
    assert got == [(2,)]
    # but the closed interval of the timer rule includes +2 s
    b = _bursts(_logins(spark, data)).collect()
    assert sorted((r["user_id"], r["n_fails"]) for r in b) == [(1, 2), (2, 2)]


def test_overlapping_and_strict_contiguity(spark):
    data = [(1, 1, "fail", T0), (2, 1, "fail", T0 + 500), (3, 1, "fail", T0 + 900),
            (4, 1, "success", T0 + 950), (5, 1, "fail", T0 + 1000)]
    got = rows(_match(_logins(spark, data)), "first_arrival", "last_arrival")
    assert got == [(1, 2), (2, 3)]


def test_burst_greedy_anchors(spark):
    # fails at 0, 1, 2.5, 3, 6 s; w = 2 s: bursts [0,1] and [2.5,3]; 6 alone
    data = [(i, 1, "fail", T0 + int(s * 1000)) for i, s in enumerate([0, 1, 2.5, 3, 6])]
    b = _bursts(_logins(spark, data)).collect()
    assert sorted((r["n_fails"], r["msg"]) for r in b) == [
        (2, "Login fail in 2s for 2 times."), (2, "Login fail in 2s for 2 times.")]


def _brute_match(pdf, within_us):
    out = set()
    for _, g in pdf.sort_values(["user_id", "us", "event_id"]).groupby("user_id"):
        r = g.to_dict("records")
        for a, b in zip(r, r[1:]):
            if a["fail"] and b["fail"] and b["us"] - a["us"] < within_us:
                out.add((a["event_id"], b["event_id"]))
    return out


def _brute_bursts(pdf, w, min_fails):
    out = set()
    for u, g in pdf.sort_values(["user_id", "us", "event_id"]).groupby("user_id"):
        anchor, n, head, last = None, 0, None, None
        for r in g.to_dict("records"):
            if anchor is not None and r["us"] > anchor + w:
                if n >= min_fails:
                    out.add((u, head, last, n))
                anchor, n = None, 0
            if r["fail"]:
                if anchor is None:
                    anchor, head, n = r["us"], r["us"], 0
                n += 1
                last = r["us"]
            else:
                anchor, n = None, 0
        if anchor is not None and n >= min_fails:
            out.add((u, head, last, n))
    return out


def test_against_brute_force_with_small_buckets(spark):
    ev = A.logins(load_table(spark, SF001, "events"))
    pdf = ev.select("user_id", "event_id", F.unix_micros("ts").alias("us"),
                    (F.col("event_type") == "error").alias("fail")).toPandas()
    for within, bucket in (("1 hour", "1 hour"), ("6 hours", "6 hours"), ("1 day", "2 days"),
                           ("1 hour", None)):
        w = {"1 hour": 3600, "6 hours": 21600, "1 day": 86400}[within] * 1_000_000
        m = sequence_match(ev, "user_id", "ts", "event_id", F.col("event_type") == "error",
                           within, bucket=bucket)
        assert set(rows(m, "first_arrival", "last_arrival")) == _brute_match(pdf, w)
        b = failure_bursts(ev, "user_id", "ts", "event_id", F.col("event_type") == "error",
                           within, 2, bucket=bucket)
        got = set((r["user_id"], r["h"], r["l"], r["n_fails"]) for r in b.select(
            "user_id", F.unix_micros("first_fail").alias("h"), F.unix_micros("last_fail").alias("l"),
            "n_fails").collect())
        assert got == _brute_bursts(pdf, w, 2)


def _check(df, fail, within, w, **chain):
    pdf = df.select("user_id", "event_id", F.unix_micros("ts").alias("us"),
                    fail.alias("fail")).toPandas()
    b = failure_bursts(df, "user_id", "ts", "event_id", fail, within, 2, **chain)
    got = sorted((r["user_id"], r["h"], r["l"], r["n_fails"]) for r in b.select(
        "user_id", F.unix_micros("first_fail").alias("h"), F.unix_micros("last_fail").alias("l"),
        "n_fails").collect())
    exp = sorted(_brute_bursts(pdf, w, 2))
    assert got == exp
    return exp


def test_long_segments_equal_brute_force(spark):
    ev = A.logins(load_table(spark, SF001, "events"))
    for within, w in (("1 day", 86400 * 1_000_000), ("3 days", 3 * 86400 * 1_000_000)):
        for chain in ({}, {"fan": 2, "levels": 2}):
            assert _check(ev, F.col("event_type") == "error", within, w, **chain)


def test_dense_run_over_many_blocks(spark):
    # one user failing at uneven steps below w = 2 s, some at the same time,
    # then a success inside the last burst's interval; another user without
    fail = F.col("event_type") == "fail"
    for user_ends in ("success", "fail"):
        data, t = [], T0
        for i in range(600):
            t += (i * 7919) % 1900
            data.append((i, 5, "fail", t))
            data.append((1000 + i, 6, "fail", T0 + 700 * i))
        data.append((5000, 5, user_ends, t + 100))
        df = _logins(spark, data)
        for chain in ({}, {"fan": 2, "levels": 1}, {"fan": 3, "levels": 3}):
            assert len(_check(df, fail, "2 seconds", 2_000_000, **chain)) > 200


def test_building_the_query_starts_no_job(spark):
    df = _logins(spark, [(i, 5, "fail", T0 + 700 * i) for i in range(50)])
    sc = spark.sparkContext
    sc.setJobGroup("burst-plan", "build only")
    try:
        _bursts(df)
        assert not sc.statusTracker().getJobIdsForGroup("burst-plan")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
