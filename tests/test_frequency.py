from pyspark.sql import functions as F

from conftest import rows
from flowlens.operators import frequency_cap

BASE = 1704067200  # 2024-01-01 00:00:00 UTC


def _clicks(spark, data):
    df = spark.createDataFrame(data, "event_id long, user_id long, ad_id long, s long")
    return df.withColumn("ts", F.timestamp_seconds("s"))


def test_cap_pass_warn_drop(spark):
    data = [(i, 1, 7, BASE + 10 * i) for i in range(6)] + [(100, 2, 7, BASE)]
    passed, warn = frequency_cap(_clicks(spark, data), ["user_id", "ad_id"],
                                 [F.col("ts"), F.col("event_id")], 2, day="none")
    assert rows(passed, "event_id") == [(0,), (1,), (100,)]
    assert rows(warn) == [(1, 7, "click over 2 times today")]


def test_cap_resets_per_event_day(spark):
    # 10 h apart: events 0-2 on Jan 1, 3-4 on Jan 2, 5 on Jan 3
    data = [(i, 1, 7, BASE + 3600 * 10 * i) for i in range(6)]
    passed, warn = frequency_cap(_clicks(spark, data), ["user_id", "ad_id"],
                                 [F.col("ts"), F.col("event_id")], 2)
    assert rows(passed, "event_id") == [(0,), (1,), (3,), (4,), (5,)]
    assert rows(warn, "day") == [("2024-01-01",)]


def test_cap_uses_arrival_for_equal_times(spark):
    data = [(5, 1, 7, BASE), (3, 1, 7, BASE), (4, 1, 7, BASE)]
    passed, warn = frequency_cap(_clicks(spark, data), ["user_id", "ad_id"],
                                 [F.col("ts"), F.col("event_id")], 1, day="none")
    assert rows(passed, "event_id") == [(3,)]
    assert warn.count() == 1


def test_cap_counts_per_group_on_events(spark):
    from conftest import SF01
    from flowlens.plans import adapters as A
    from flowlens.sources.tables import load_table
    clicks = A.ad_clicks(load_table(spark, SF01, "events"))
    n_cap = 3
    passed, warn = frequency_cap(clicks, ["user_id", "ad_id"], [F.col("ts"), F.col("event_id")], n_cap)
    pdf = clicks.select("user_id", "ad_id", F.to_date("ts").cast("string").alias("day")).toPandas()
    sizes = pdf.groupby(["user_id", "ad_id", "day"]).size()
    got_pass = passed.groupBy("user_id", "ad_id", "day").count().toPandas().set_index(
        ["user_id", "ad_id", "day"])["count"]
    assert got_pass.sort_index().to_dict() == sizes.clip(upper=n_cap).sort_index().to_dict()
    got_warn = set(map(tuple, warn.select("user_id", "ad_id", "day").toPandas().values.tolist()))
    assert got_warn == set(sizes[sizes > n_cap].index)
    assert passed.count() + warn.count() <= clicks.count()
