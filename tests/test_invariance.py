"""Order-sensitive operators carry an arrival column, so their results do not
depend on how the input is partitioned or ordered."""

from pyspark.sql import functions as F

from conftest import SF001, rows
from flowlens.operators import (failure_bursts, frequency_cap, running_unique_visitors,
                                sequence_match)
from flowlens.plans import adapters as A
from flowlens.sources.tables import load_table


def _both(spark):
    ev = load_table(spark, SF001, "events")
    shuffled = ev.repartition(7, F.rand(11)).sortWithinPartitions(F.rand(3))
    return ev, shuffled


def test_cap_invariant(spark):
    a, b = (A.ad_clicks(x) for x in _both(spark))
    order = [F.col("ts"), F.col("event_id")]
    pa, wa = frequency_cap(a, ["user_id", "ad_id"], order, 2)
    pb, wb = frequency_cap(b, ["user_id", "ad_id"], order, 2)
    assert rows(pa, "event_id") == rows(pb, "event_id")
    assert rows(wa) == rows(wb)


def test_sequences_invariant(spark):
    a, b = (A.logins(x) for x in _both(spark))
    fail = F.col("event_type") == "error"
    ma = sequence_match(a, "user_id", "ts", "event_id", fail, "6 hours")
    mb = sequence_match(b, "user_id", "ts", "event_id", fail, "6 hours")
    assert rows(ma, "first_arrival", "last_arrival") == rows(mb, "first_arrival", "last_arrival")
    ba = failure_bursts(a, "user_id", "ts", "event_id", fail, "6 hours", 2)
    bb = failure_bursts(b, "user_id", "ts", "event_id", fail, "6 hours", 2)
    assert rows(ba, "user_id", "n_fails", "msg") == rows(bb, "user_id", "n_fails", "msg")


def test_running_uv_invariant(spark):
    a, b = (A.behavior(x) for x in _both(spark))
    ra = running_unique_visitors(a, "ts", "user_id", "event_id", block_rows=50)
    rb = running_unique_visitors(b, "ts", "user_id", "event_id", block_rows=50)
    assert rows(ra, "event_id", "uv_so_far") == rows(rb, "event_id", "uv_so_far")
