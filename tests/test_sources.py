import os
import tempfile

from pyspark.sql import functions as F

from flowlens.operators import not_static
import pytest

from flowlens.sources import (parse_access_log, parse_ad_click_lines, parse_behavior_lines,
                              parse_login_lines, parse_marketing_lines, read_ad_clicks,
                              read_behavior, read_logins, read_marketing)


def test_parse_behavior_and_access_log(spark):
    lines = spark.createDataFrame([("543462,1715,1464116,pv,1511658000",)], "value string")
    r = parse_behavior_lines(lines).collect()[0]
    assert (r.user_id, r.item_id, r.category_id, r.behavior, r.ts_s) == (543462, 1715, 1464116, "pv", 1511658000)
    assert int(r.ts.timestamp()) == 1511658000
    log = spark.createDataFrame(
        [("83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET /presentations/logstash",)], "value string")
    r = parse_access_log(log).collect()[0]
    assert (r.ip, r.user_id, r.method, r.url) == ("83.149.9.216", "-", "GET", "/presentations/logstash")
    assert int(r.ts.timestamp()) == 1431857103


def test_line_parsers_equal_file_readers(spark):
    lines = {"ad": ['543462,1715,beijing,"a, b",1511658000', "7,8,shanghai,,1511658001"],
             "login": ["5402,83.149.11.115,success,1558430815", "23064,66.249.3.15,fail,1558430826"],
             "market": ['{"user_id": "u1", "behavior": "CLICK", "channel": "wechat", "ts_ms": 1511658000123}']}
    forms = {"ad": (parse_ad_click_lines, read_ad_clicks), "login": (parse_login_lines, read_logins),
             "market": (parse_marketing_lines, read_marketing)}
    for name, (parse, read) in forms.items():
        path = tempfile.mkdtemp()
        with open(os.path.join(path, "part.txt"), "w") as f:
            f.write("\n".join(lines[name]) + "\n")
        got = parse(spark.createDataFrame([(x,) for x in lines[name]], "value string"))
        exp = read(spark, path)
        assert got.columns == exp.columns
        assert sorted(map(repr, got.collect())) == sorted(map(repr, exp.collect()))


def test_bad_number_fails_the_line(spark):
    bad = spark.createDataFrame([("x,1.2.3.4,fail,1558430826",)], "value string")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        parse_login_lines(bad).collect()


def test_static_filter_is_segment_not_extension(spark):
    df = spark.createDataFrame([("/a.css",), ("/css",), ("/x/js",), ("/app.js",), ("/",)], "url string")
    kept = sorted(r.url for r in df.filter(not_static("url")).collect())
    assert kept == ["/", "/a.css", "/app.js"]
    kept = sorted(r.url for r in df.filter(not_static("url", "extension")).collect())
    assert kept == ["/", "/css", "/x/js"]


def test_file_sources(spark):
    d = tempfile.mkdtemp(prefix="flowlens-src-")
    with open(os.path.join(d, "clicks.csv"), "w") as f:
        f.write("937166,1715,beijing,beijing,1511661600\n")
    with open(os.path.join(d, "logins.csv"), "w") as f:
        f.write("1035,83.149.9.216,fail,1558430842\n")
    with open(os.path.join(d, "behavior.csv"), "w") as f:
        f.write("1,2,3,pv,1511658000\n")
    with open(os.path.join(d, "market.json"), "w") as f:
        f.write('{"user_id": "u1", "behavior": "CLICK", "channel": "weibo", "ts_ms": 1511658000123}\n')
    c = read_ad_clicks(spark, os.path.join(d, "clicks.csv")).collect()[0]
    assert (c.user_id, c.ad_id, c.province) == (937166, 1715, "beijing")
    lg = read_logins(spark, os.path.join(d, "logins.csv")).collect()[0]
    assert lg.event_type == "fail" and int(lg.ts.timestamp()) == 1558430842
    assert read_behavior(spark, os.path.join(d, "behavior.csv")).count() == 1
    m = read_marketing(spark, os.path.join(d, "market.json")).select(
        F.unix_millis("ts").alias("ms")).collect()[0]
    assert m.ms == 1511658000123


def test_kafka_source_is_wired_but_needs_the_package(spark):
    """No Kafka package on this image: building the source fails at the data
    source lookup (no connection is attempted)."""
    import pytest
    from flowlens.sources import read_kafka_lines
    with pytest.raises(Exception, match="(?i)kafka"):
        read_kafka_lines(spark, "broker:9092", "behaviour")
