import datetime as dt

from flowlens.functions.time import event_time
from flowlens.operators import format_ranking, top_n_per_window


def test_ties_by_key_and_limit(spark):
    end = dt.datetime(2024, 1, 1, 1, 0)
    data = [(end, 7, 3), (end, 5, 3), (end, 9, 4), (end, 1, 1), (end, 2, 1), (end, 3, 1)]
    df = spark.createDataFrame(data, "window_end timestamp_ntz, item_id long, cnt long")
    df = df.withColumn("window_end", event_time(df, "window_end"))
    got = top_n_per_window(df, "item_id", 3).orderBy("rank").collect()
    assert [(r["rank"], r["item_id"]) for r in got] == [(1, 9), (2, 5), (3, 7)]
    report = format_ranking(top_n_per_window(df, "item_id", 2), "item_id").collect()[0]["report"]
    assert report == ("时间： 2024-01-01 01:00:00.0\n"
                      "Top1: 商品ID=9 访问量=4\n"
                      "Top2: 商品ID=5 访问量=3\n"
                      + "-" * 46 + "\n\n")


def test_url_report_layout(spark):
    end = dt.datetime(2024, 1, 1, 0, 10, 5)
    df = spark.createDataFrame([(end, "/a", 2), (end, "/b", 2), (end, "/c", 1)],
                               "window_end timestamp_ntz, url string, cnt long")
    df = df.withColumn("window_end", event_time(df, "window_end"))
    report = format_ranking(top_n_per_window(df, "url", 5), "url", style="urls").collect()[0]["report"]
    assert report == ("时间： 2024-01-01 00:10:05.0\n"
                      "No.1: URL=/a 访问量=2\n"
                      "No.2: URL=/b 访问量=2\n"
                      "No.3: URL=/c 访问量=1\n"
                      + "-" * 46 + "\n\n")


def test_hot_urls_report_job(spark):
    from flowlens.plans import jobs as J
    end = dt.datetime(2024, 1, 1, 0, 10, 5)
    df = spark.createDataFrame([(end, 1, "/a", 2)], "window_end timestamp_ntz, rank int, url string, cnt long")
    df = df.withColumn("window_end", event_time(df, "window_end"))
    r = J.hot_urls_report(df).collect()[0]["report"]
    assert r.startswith("时间： 2024-01-01 00:10:05.0\nNo.1: URL=/a 访问量=2\n")


def test_top_n_of_runs_equals_expanded_ranking(spark):
    """Ranking per aligned interval, then per window, against ranking every
    window; ends below zero and runs longer than ``size`` included."""
    import random

    from flowlens.operators import top_n_of_runs
    rng = random.Random(5)
    data, best = [], {}
    for k in range(25):
        at = rng.randrange(-60, 0)
        for _ in range(rng.randrange(1, 6)):
            to = at + rng.randrange(0, 45)
            cnt = rng.randrange(1, 6)
            data.append((f"/u{k:02d}", at, to, cnt))
            for e in range(at, to + 1):
                best.setdefault(e, []).append((-cnt, f"/u{k:02d}"))
            at = to + rng.randrange(1, 4)
    exp = sorted((e, i + 1, u, -c) for e, v in best.items() for i, (c, u) in enumerate(sorted(v)[:3]))
    runs = spark.createDataFrame(data, "url string, _from long, _to long, cnt long")
    for size in (1, 12, 64):
        got = top_n_of_runs(runs, "url", 3, size)
        assert sorted((r._e, r["rank"], r.url, r.cnt) for r in got.collect()) == exp
