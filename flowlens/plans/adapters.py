"""The driver's ``events`` table seen as the reference's record streams.

events(event_id, ts, user_id, event_type, value, props) stands in for every
input of the reference: arrival order is ``event_id``; the item is
``props.k``; 'view' is the page-view behaviour; 'signup' stands in for
UNINSTALL; 'error' is a failed login and every other type a success; the
ad key is (user, event_type); the province is the customer's nation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import event_time, utc_string

PV = "view"
UNINSTALL = "signup"
FAIL = "error"


def item_of(props: str = "props") -> Column:
    return F.get_json_object(F.col(props), "$.k").cast("long")


def with_event_time(ev: DataFrame) -> DataFrame:
    return ev.withColumn("ts", event_time(ev, "ts"))


def behavior(ev: DataFrame) -> DataFrame:
    e = with_event_time(ev)
    item = item_of()
    return e.select("event_id", "user_id", item.alias("item_id"),
                    F.floor(item / 10).cast("int").alias("category_id"),
                    F.col("event_type").alias("behavior"), "ts")


def marketing(ev: DataFrame) -> DataFrame:
    e = with_event_time(ev)
    return e.select("event_id", F.col("user_id").cast("string").alias("user_id"),
                    F.col("event_type").alias("behavior"),
                    F.concat(F.lit("ch"), F.pmod("user_id", F.lit(4)).cast("string")).alias("channel"),
                    "ts")


def ad_clicks(ev: DataFrame) -> DataFrame:
    """Clicks keyed by (user, ad); the province is attached separately."""
    return with_event_time(ev).select("event_id", "user_id", F.col("event_type").alias("ad_id"), "ts")


def with_province(clicks: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Adds the customer's nation as province ('unknown' without a customer).
    The dimension join is left to Catalyst/AQE: it broadcasts only below the
    measured size threshold and keeps a shuffle join otherwise."""
    prov = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("user_id"), F.col("n_name").alias("province"))
    return (clicks.join(prov, "user_id", "left")
                  .withColumn("province", F.coalesce("province", F.lit("unknown"))))


def logins(ev: DataFrame) -> DataFrame:
    return with_event_time(ev).select("event_id", "user_id", "event_type", "ts")


def url_of(event_type: Column, item: Column) -> Column:
    k = F.pmod(item, F.lit(25))
    return (F.when(k == 0, F.lit("/static/css"))
             .when(k == 1, F.lit("/static/js"))
             .when(k == 2, F.lit("/static/app.css"))
             .otherwise(F.concat(F.lit("/"), event_type, F.lit("/"), item.cast("string"))))


def access_log_lines(ev: DataFrame) -> DataFrame:
    """Apache-style lines rendered from events (input of the log parser)."""
    e = with_event_time(ev)
    u = F.col("user_id")
    ip = F.concat_ws(".", F.lit("10"), (F.floor(u / 65536) % 256).cast("string"),
                     (F.floor(u / 256) % 256).cast("string"), (u % 256).cast("string"))
    method = F.when(F.col("event_type") == "purchase", F.lit("POST")).otherwise(F.lit("GET"))
    line = F.concat_ws(" ", ip, F.lit("-"), u.cast("string"),
                       utc_string(F.col("ts"), "dd/MM/yyyy:HH:mm:ss"), F.lit("+0000"),
                       method, url_of(F.col("event_type"), item_of()))
    return e.select("event_id", line.alias("value"))


def access_log(ev: DataFrame, arrival_delay: bool = False) -> DataFrame:
    """Access-log events with an arrival clock; with ``arrival_delay`` each
    row reaches the job (event_id*7919 mod 900) seconds after its event time."""
    e = with_event_time(ev)
    us = F.unix_micros("ts")
    delay = F.pmod(F.col("event_id") * 7919, F.lit(900)) * 1_000_000 if arrival_delay else F.lit(0)
    return e.select("event_id", F.col("user_id").cast("string").alias("user_id"),
                    url_of(F.col("event_type"), item_of()).alias("url"), "ts",
                    (us + delay).alias("arrival_us"))


def behavior_lines(ev: DataFrame) -> DataFrame:
    """UserBehavior CSV lines rendered from events (input of the CSV parser)."""
    e = with_event_time(ev)
    item = item_of()
    line = F.concat_ws(",", F.col("user_id").cast("string"), item.cast("string"),
                       F.floor(item / 10).cast("string"), F.col("event_type"),
                       F.unix_seconds("ts").cast("string"))
    return e.select(line.alias("value"))


def ad_click_lines(ev: DataFrame) -> DataFrame:
    """Ad-click CSV lines; the city is quoted, as it holds a comma."""
    line = F.concat_ws(",", "user_id", F.col("event_id") % 1000, "event_type",
                       F.concat(F.lit('"c,'), F.pmod("user_id", F.lit(10)), F.lit('"')),
                       F.unix_seconds("ts"))
    return with_event_time(ev).select(line.alias("value"))


def login_lines(ev: DataFrame) -> DataFrame:
    """Login CSV lines; the address is made from the user."""
    line = F.concat_ws(",", "user_id", F.concat(F.lit("10.0.0."), F.pmod("user_id", F.lit(256))),
                       "event_type", F.unix_seconds("ts"))
    return with_event_time(ev).select(line.alias("value"))


def marketing_lines(ev: DataFrame) -> DataFrame:
    """Marketing records as JSON objects."""
    return marketing(ev).select(F.to_json(F.struct(
        "user_id", "behavior", "channel", F.unix_millis("ts").alias("ts_ms"))).alias("value"))
