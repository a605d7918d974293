from pyspark.sql import functions as F

from conftest import SF001, SF01, rows
from flowlens.functions.hashing import poly_hash
from flowlens.operators import (bitmap_unique_visitors, running_unique_visitors,
                                unique_visitors)
from flowlens.plans import adapters as A
from flowlens.sources.tables import load_table


def java_hash(s: str, seed: int = 61, cap: int = 1 << 30) -> int:
    """The reference's 32-bit wrapping fold, re-computed independently."""
    h = 0
    for ch in s:
        h = (h * seed + ord(ch)) & 0xFFFFFFFF
    if h >= 1 << 31:
        h -= 1 << 32
    return (cap - 1) & h


def test_poly_hash_matches_wrapping_form(spark):
    words = ["12345", "937166", "1234567890123", "a", "Customer#000000001", "zz" * 40]
    df = spark.createDataFrame([(w,) for w in words], "s string")
    got = {r["s"]: r["h"] for r in df.select("s", poly_hash(F.col("s")).alias("h")).collect()}
    for w in words:
        assert got[w] == java_hash(w)
    assert got["12345"] == 689988255
    assert got["937166"] == 542414600
    assert got["1234567890123"] == 671817843


def test_bitmap_equals_exact_for_short_ids(spark):
    b = A.behavior(load_table(spark, SF01, "events"))
    exact = unique_visitors(b, "ts", "user_id")
    bitmap = bitmap_unique_visitors(b, "ts", "user_id")
    assert rows(exact, "window_end", "uv") == rows(bitmap, "window_end", "uv")


def test_running_unique_visitors_brute_force(spark):
    b = A.behavior(load_table(spark, SF001, "events"))
    got = {r["event_id"]: r["uv_so_far"]
           for r in running_unique_visitors(b, "ts", "user_id", "event_id", block_rows=64).collect()}
    pdf = b.select("event_id", "user_id", F.unix_micros("ts").alias("us")).toPandas()
    pdf["w"] = pdf.us // 3_600_000_000
    seen, expect = {}, {}
    for r in pdf.sort_values("event_id").itertuples():
        s = seen.setdefault(r.w, set())
        s.add(r.user_id)
        expect[r.event_id] = len(s)
    assert got == expect
