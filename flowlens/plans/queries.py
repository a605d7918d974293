"""Driver query catalog: each query is a Spark plan over the given tables and
the equivalent DuckDB SQL (the correctness oracle).

Window bounds are epoch milliseconds (the reference's ``windowEnd: Long``)
unless the reference job renders them as strings.  Parameters are the
reference's, except where its literal thresholds are empty on this data:
login windows are 1 hour instead of 2 seconds, the click cap is 2 instead of
100.  The 1 h / 5 s sliding jobs are registered in full (``_5s_windows``), at a
15 min slide, and as per-key summaries of the 5 s windows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import poly_hash
from ..functions.text import ITEM_LINE, REPORT_FOOTER, REPORT_HEADER, URL_LINE
from ..functions.time import epoch_ms, java_timestamp_string
from ..operators import approx_unique_visitors, frequency_cap, not_static
from ..operators.windows import packed_windows, window_count_profile
from ..sources.files import (parse_access_log, parse_ad_click_lines, parse_behavior_lines,
                             parse_login_lines, parse_marketing_lines)
from ..sources.tables import load_table
from . import adapters as A
from . import jobs as J

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return register


def _t(spark, d, name):
    return load_table(spark, d, name)


def _ev(spark, d):
    return _t(spark, d, "events")


def _ms(c: str) -> F.Column:
    return epoch_ms(F.col(c)).alias(c)


# ---------------------------------------------------------------- SQL pieces
ITEM = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
URL = ("CASE WHEN k % 25 = 0 THEN '/static/css' WHEN k % 25 = 1 THEN '/static/js' "
       "WHEN k % 25 = 2 THEN '/static/app.css' "
       "ELSE '/' || event_type || '/' || CAST(k AS VARCHAR) END")


def _java_ts(us_expr: str) -> str:
    # window bounds are whole seconds: Timestamp.toString ends in '.0'
    return f"strftime(make_timestamp({us_expr}), '%Y-%m-%d %H:%M:%S') || '.0'"


def _sliding_sql(src: str, keys: str, slide_us: int, n: int) -> str:
    """Counts per (keys, window end index e) of a sliding window."""
    k = f"{keys}, " if keys else ""
    return (f"SELECT {k}pane + 1 + i AS e, count(*) AS cnt "
            f"FROM (SELECT {k}epoch_us(ts) // {slide_us} AS pane FROM {src}) p, "
            f"range(0, {n}) r(i) GROUP BY ALL")


# ---------------------------------------------------------------- J1 / N1 / N3
HOT_ITEMS_SQL = f"""
WITH c AS ({_sliding_sql(f"(SELECT {ITEM} AS item_id, ts FROM events WHERE event_type = 'view')",
                         'item_id', 900000000, 4)}),
r AS (SELECT e * 900000 AS window_end, item_id, cnt,
             row_number() OVER (PARTITION BY e ORDER BY cnt DESC, item_id) AS rank FROM c)
"""


@query("hot_items_top5", HOT_ITEMS_SQL + """
SELECT window_end, CAST(rank AS INTEGER) AS rank, item_id, cnt FROM r WHERE rank <= 5""")
def hot_items_top5(spark, d):
    r = J.hot_items(A.behavior(_ev(spark, d)), n=5, pv=A.PV)
    return r.select(_ms("window_end"), "rank", "item_id", "cnt")


@query("ranking_report", HOT_ITEMS_SQL + f"""
SELECT window_end,
       '{REPORT_HEADER}' || {_java_ts('window_end * 1000')} || chr(10)
       || string_agg('{ITEM_LINE[0]}' || rank || '{ITEM_LINE[1]}' || item_id || '{ITEM_LINE[2]}' || cnt || chr(10), ''
                     ORDER BY rank)
       || '{REPORT_FOOTER}' AS report
FROM r WHERE rank <= 5 GROUP BY window_end""")
def ranking_report(spark, d):
    r = J.hot_items(A.behavior(_ev(spark, d)), n=5, pv=A.PV)
    return J.hot_items_report(r).select(_ms("window_end"), "report")


# ---------------------------------------------------------------- J3 / J4
@query("page_views_hourly", """
SELECT (epoch_us(ts) // 3600000000 + 1) * 3600000 AS window_end, 'pv' AS key, count(*) AS cnt
FROM events WHERE event_type = 'view' GROUP BY 1""")
def page_views_hourly(spark, d):
    return J.page_views(A.behavior(_ev(spark, d)), pv=A.PV).select(_ms("window_end"), "key", "cnt")


@query("page_views_salted", """
SELECT (epoch_us(ts) // 3600000000 + 1) * 3600000 AS window_end, count(*) AS cnt
FROM events WHERE event_type = 'view' GROUP BY 1""")
def page_views_salted(spark, d):
    b = A.behavior(_ev(spark, d))
    totals, _ = J.page_views_salted(b, pv=A.PV, salt=F.pmod(F.col("event_id"), F.lit(4)))
    return totals.select(_ms("window_end"), "cnt")


@query("page_views_spread", """
SELECT (epoch_us(ts) // 3600000000 + 1) * 3600000 AS window_end, count(*) AS cnt
FROM events WHERE event_type = 'view' GROUP BY 1""")
def page_views_spread(spark, d):
    """J4 with its own spread key: the totals are J3's."""
    totals, _ = J.page_views_salted(A.behavior(_ev(spark, d)), pv=A.PV)
    return totals.select(_ms("window_end"), "cnt")


@query("pv_partials", """
SELECT (epoch_us(ts) // 3600000000 + 1) * 3600000 AS window_end, event_id % 4 AS salt,
       count(*) AS cnt
FROM events WHERE event_type = 'view' GROUP BY 1, 2""")
def pv_partials(spark, d):
    b = A.behavior(_ev(spark, d))
    _, partials = J.page_views_salted(b, pv=A.PV, salt=F.pmod(F.col("event_id"), F.lit(4)))
    return partials.select(_ms("window_end"), "salt", "cnt")


# ---------------------------------------------------------------- J5 / J6 / A8 / A10
@query("unique_visitors_hourly", """
SELECT (epoch_us(ts) // 3600000000 + 1) * 3600000 AS window_end, count(DISTINCT user_id) AS uv
FROM events WHERE event_type = 'view' GROUP BY 1""")
def unique_visitors_hourly(spark, d):
    return J.unique_visitors_job(A.behavior(_ev(spark, d)), pv=A.PV).select(_ms("window_end"), "uv")


def _poly_sql(expr: str) -> str:
    return (f"list_reduce(list_transform(string_split(CAST({expr} AS VARCHAR), ''), "
            f"lambda ch: CAST(ascii(ch) AS BIGINT)), lambda a, ch: (a * 61 + ch) & 1073741823)")


@query("unique_visitors_bitmap", f"""
SELECT (epoch_us(ts) // 3600000000 + 1) * 3600000 AS window_end,
       count(DISTINCT {_poly_sql('user_id')}) AS uv
FROM events WHERE event_type = 'view' GROUP BY 1""")
def unique_visitors_bitmap(spark, d):
    return J.unique_visitors_bitmap_job(A.behavior(_ev(spark, d)), pv=A.PV).select(
        _ms("window_end"), "uv")


@query("poly_hash", f"""
SELECT c_custkey, c_name, {_poly_sql('c_name')} AS name_hash FROM customer""")
def poly_hash_query(spark, d):
    c = _t(spark, d, "customer")
    return c.select("c_custkey", "c_name", poly_hash(F.col("c_name")).alias("name_hash"))


@query("unique_visitors_approx", """
SELECT (epoch_us(ts) // 3600000000 + 1) * 3600000 AS window_end, count(DISTINCT user_id) AS uv_exact,
       true AS within_bound
FROM events WHERE event_type = 'view' GROUP BY 1""")
def unique_visitors_approx(spark, d):
    """The sketch's count beside the exact one: within 5 % (rsd 1 %), or 1."""
    b = A.behavior(_ev(spark, d)).filter(F.col("behavior") == A.PV)
    approx = approx_unique_visitors(b, "ts", "user_id", "1 hour", out_col="approx")
    exact = J.unique_visitors_job(A.behavior(_ev(spark, d)), pv=A.PV)
    bound = F.greatest(F.lit(1.0), F.col("uv") * 0.05)
    return exact.join(approx.select("window_end", "approx"), "window_end").select(
        _ms("window_end"), F.col("uv").alias("uv_exact"),
        (F.abs(F.col("approx") - F.col("uv")) <= bound).alias("within_bound"))


@query("running_unique_visitors", """
WITH v AS (SELECT event_id, user_id, (epoch_us(ts) // 3600000000 + 1) * 3600000 AS window_end
           FROM events WHERE event_type = 'view'),
f AS (SELECT *, CASE WHEN event_id = min(event_id) OVER (PARTITION BY window_end, user_id)
                     THEN 1 ELSE 0 END AS first_seen FROM v)
SELECT window_end, event_id, user_id,
       CAST(sum(first_seen) OVER (PARTITION BY window_end ORDER BY event_id
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)
         AS uv_so_far
FROM f""")
def running_unique_visitors(spark, d):
    r = J.running_unique_visitors_job(A.behavior(_ev(spark, d)), "event_id", pv=A.PV)
    return r.select(_ms("window_end"), "event_id", "user_id", "uv_so_far")


# ---------------------------------------------------------------- J7 / J8
def _packed(rows: DataFrame, *keys: str) -> DataFrame:
    """All 1 h / 5 s windows, those that end in one hour as one row: without
    loss, and few enough rows for a driver to collect."""
    packed = packed_windows(rows, "ts", "1 hour", "5 seconds", keys, "1 hour",
                            lambda i: f"{i // 12:02d}:{i % 12 * 5:02d}")
    return packed.select(*keys, F.substring(java_timestamp_string(F.col("span_start")), 1, 13)
                         .alias("hour"), "n_windows", "counts")


def _packed_sql(keys: str) -> str:
    return (f"SELECT {keys}, substr(window_end, 1, 13) AS hour, count(*) AS n_windows, "
            "string_agg(substr(window_end, 15, 5) || '=' || CAST(cnt AS VARCHAR), ',' "
            f"ORDER BY window_end) AS counts FROM j GROUP BY {keys}, hour")


_MARKET_SRC = ("(SELECT 'ch' || CAST(user_id % 4 AS VARCHAR) AS channel, event_type AS behavior, ts "
               "FROM events WHERE event_type <> 'signup')")


@query("market_by_channel", f"""
WITH c AS ({_sliding_sql(_MARKET_SRC, 'channel, behavior', 900000000, 4)})
SELECT {_java_ts('(e - 4) * 900000000')} AS window_start, {_java_ts('e * 900000000')} AS window_end,
       channel, behavior, cnt FROM c""")
def market_by_channel(spark, d):
    return J.marketing_by_channel(A.marketing(_ev(spark, d)), slide="15 minutes",
                                  uninstall=A.UNINSTALL)


# J7 at the job's own 1 h / 5 s: every window, the rows of an hour packed as one
@query("market_by_channel_5s_windows", f"""
WITH c AS ({_sliding_sql(_MARKET_SRC, 'channel, behavior', 5000000, 720)}),
j AS (SELECT {_java_ts('(e - 720) * 5000000')} AS window_start,
             {_java_ts('e * 5000000')} AS window_end, channel, behavior, cnt FROM c)
{_packed_sql('channel, behavior')}""")
def market_by_channel_5s_windows(spark, d):
    m = A.marketing(_ev(spark, d)).filter(F.col("behavior") != A.UNINSTALL)
    return _packed(m, "channel", "behavior")


@query("market_total", f"""
WITH c AS ({_sliding_sql(_MARKET_SRC, '', 900000000, 4)})
SELECT CAST((e - 4) * 900000 AS VARCHAR) AS window_start, CAST(e * 900000 AS VARCHAR) AS window_end,
       'total' AS channel, 'total' AS behavior, cnt FROM c""")
def market_total(spark, d):
    return J.marketing_total(A.marketing(_ev(spark, d)), slide="15 minutes", uninstall=A.UNINSTALL)


# J8 at the job's own 1 h / 5 s, every window
@query("market_total_5s_windows", f"""
WITH c AS ({_sliding_sql(_MARKET_SRC, '', 5000000, 720)})
SELECT CAST((e - 720) * 5000 AS VARCHAR) AS window_start, CAST(e * 5000 AS VARCHAR) AS window_end,
       'total' AS channel, 'total' AS behavior, cnt FROM c""")
def market_total_5s_windows(spark, d):
    return J.marketing_total(A.marketing(_ev(spark, d)), uninstall=A.UNINSTALL)


_SUMMARY_SQL = ("count(*) AS n_windows, max(cnt) AS max_cnt, "
                "CAST(sum(cnt * cnt) AS BIGINT) AS sum_sq_cnt")


@query("market_by_channel_5s", f"""
WITH c AS ({_sliding_sql(_MARKET_SRC, 'channel, behavior', 5000000, 720)})
SELECT channel, behavior, {_SUMMARY_SQL} FROM c GROUP BY channel, behavior""")
def market_by_channel_5s(spark, d):
    m = A.marketing(_ev(spark, d)).filter(F.col("behavior") != A.UNINSTALL)
    return window_count_profile(m, "ts", "1 hour", "5 seconds", keys=["channel", "behavior"])


@query("market_total_5s", f"""
WITH c AS ({_sliding_sql(_MARKET_SRC, '', 5000000, 720)})
SELECT {_SUMMARY_SQL} FROM c""")
def market_total_5s(spark, d):
    m = A.marketing(_ev(spark, d)).filter(F.col("behavior") != A.UNINSTALL)
    return window_count_profile(m, "ts", "1 hour", "5 seconds")


# ---------------------------------------------------------------- J9 / B1 / B2
_CAP_SQL = """
r AS (SELECT e.*, strftime(ts, '%Y-%m-%d') AS day,
             row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE)
                                ORDER BY ts, event_id) AS n
      FROM events e)"""


@query("frequency_pass", f"""
WITH {_CAP_SQL}
SELECT event_id, user_id, event_type AS ad_id, day FROM r WHERE n <= 2""")
def frequency_pass(spark, d):
    c = A.ad_clicks(_ev(spark, d))
    passed, _ = frequency_cap(c, ["user_id", "ad_id"], [F.col("ts"), F.col("event_id")], 2)
    return passed.select("event_id", "user_id", "ad_id", "day")


@query("frequency_warn", f"""
WITH {_CAP_SQL}
SELECT user_id, event_type AS ad_id, day, 'click over 2 times today' AS msg FROM r WHERE n = 3""")
def frequency_warn(spark, d):
    c = A.ad_clicks(_ev(spark, d))
    _, warnings = frequency_cap(c, ["user_id", "ad_id"], [F.col("ts"), F.col("event_id")], 2)
    return warnings


_PROV_SQL = f"""
WITH {_CAP_SQL},
prov AS (SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey),
p AS (SELECT coalesce(prov.n_name, 'unknown') AS province, r.ts
      FROM r LEFT JOIN prov ON r.user_id = prov.c_custkey WHERE r.n <= 2)"""


def _located(spark, d):
    """Clicks that pass the cap, with their province."""
    passed, _ = frequency_cap(A.ad_clicks(_ev(spark, d)), ["user_id", "ad_id"],
                              [F.col("ts"), F.col("event_id")], 2)
    located = A.with_province(passed, _t(spark, d, "customer"), _t(spark, d, "nation"))
    return located.select("province", "ts")


@query("ad_counts_by_province", _PROV_SQL + f""",
c AS ({_sliding_sql('p', 'province', 900000000, 4)})
SELECT province, {_java_ts('e * 900000000')} AS window_end, cnt FROM c""")
def ad_counts_by_province(spark, d):
    customer, nation = _t(spark, d, "customer"), _t(spark, d, "nation")
    counts, _ = J.ad_clicks_by_province(
        A.ad_clicks(_ev(spark, d)), "event_id", 2, slide="15 minutes",
        locate=lambda passed: A.with_province(passed, customer, nation))
    return counts


@query("ad_counts_by_province_5s_windows", _PROV_SQL + f""",
c AS ({_sliding_sql('p', 'province', 5000000, 720)}),
j AS (SELECT province, {_java_ts('e * 5000000')} AS window_end, cnt FROM c)
{_packed_sql('province')}""")
def ad_counts_by_province_5s_windows(spark, d):
    return _packed(_located(spark, d), "province")


@query("ad_counts_by_province_5s", _PROV_SQL + f""",
c AS ({_sliding_sql('p', 'province', 5000000, 720)})
SELECT province, {_SUMMARY_SQL} FROM c GROUP BY province""")
def ad_counts_by_province_5s(spark, d):
    return window_count_profile(_located(spark, d), "ts", "1 hour", "5 seconds",
                                keys=["province"])


# ---------------------------------------------------------------- J10 / C1 / C3
@query("login_sequence", """
WITH l AS (SELECT user_id, event_id, ts, event_type = 'error' AS f,
                  lead(event_type = 'error') OVER w AS f2, lead(ts) OVER w AS ts2,
                  lead(event_id) OVER w AS id2
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, epoch_us(ts) // 1000 AS first_fail_ms, epoch_us(ts2) // 1000 AS last_fail_ms,
       event_id AS first_event_id, id2 AS last_event_id, 'Login Fail!' AS msg
FROM l WHERE f AND f2 AND epoch_us(ts2) - epoch_us(ts) < 3600000000""")
def login_sequence(spark, d):
    m = J.login_fail_pattern(A.logins(_ev(spark, d)), "event_id", within="1 hour",
                             fail_value=A.FAIL)
    return m.select("user_id", epoch_ms(F.col("first_fail")).alias("first_fail_ms"),
                    epoch_ms(F.col("last_fail")).alias("last_fail_ms"),
                    F.col("first_arrival").alias("first_event_id"),
                    F.col("last_arrival").alias("last_event_id"), "msg")


_W = 3600000000
_BURSTS_SQL = f"""
WITH RECURSIVE ev AS (
  SELECT user_id, epoch_us(ts) AS us, event_type = 'error' AS f,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM events),
st AS (
  SELECT user_id, rn, CASE WHEN f THEN us END AS anchor, CASE WHEN f THEN 1 ELSE 0 END AS n,
         CASE WHEN f THEN us END AS head, CASE WHEN f THEN us END AS last,
         CAST(NULL AS BIGINT) AS e_head, CAST(NULL AS BIGINT) AS e_last, CAST(NULL AS BIGINT) AS e_n
  FROM ev WHERE rn = 1
  UNION ALL
  SELECT ev.user_id, ev.rn,
         CASE WHEN st.anchor IS NOT NULL AND ev.us <= st.anchor + {_W}
              THEN CASE WHEN ev.f THEN st.anchor END
              ELSE CASE WHEN ev.f THEN ev.us END END,
         CASE WHEN st.anchor IS NOT NULL AND ev.us <= st.anchor + {_W}
              THEN CASE WHEN ev.f THEN st.n + 1 ELSE 0 END
              ELSE CASE WHEN ev.f THEN 1 ELSE 0 END END,
         CASE WHEN st.anchor IS NOT NULL AND ev.us <= st.anchor + {_W}
              THEN CASE WHEN ev.f THEN st.head END
              ELSE CASE WHEN ev.f THEN ev.us END END,
         CASE WHEN ev.f THEN ev.us END,
         CASE WHEN st.anchor IS NOT NULL AND ev.us > st.anchor + {_W} AND st.n >= 2 THEN st.head END,
         CASE WHEN st.anchor IS NOT NULL AND ev.us > st.anchor + {_W} AND st.n >= 2 THEN st.last END,
         CASE WHEN st.anchor IS NOT NULL AND ev.us > st.anchor + {_W} AND st.n >= 2 THEN st.n END
  FROM st JOIN ev ON ev.user_id = st.user_id AND ev.rn = st.rn + 1),
last_rn AS (SELECT user_id, max(rn) AS rn FROM ev GROUP BY user_id),
b AS (SELECT user_id, e_head AS h, e_last AS l, e_n AS n FROM st WHERE e_head IS NOT NULL
      UNION ALL
      SELECT st.user_id, head, last, n FROM st JOIN last_rn USING (user_id, rn)
      WHERE anchor IS NOT NULL AND n >= 2)
SELECT user_id, h // 1000 AS first_fail_ms, l // 1000 AS last_fail_ms, CAST(n AS BIGINT) AS n_fails,
       'Login fail in 3600s for ' || CAST(n AS VARCHAR) || ' times.' AS msg
FROM b"""


@query("login_bursts", _BURSTS_SQL)
def login_bursts(spark, d):
    b = J.login_fail_bursts(A.logins(_ev(spark, d)), "event_id", within="1 hour", min_fails=2,
                            fail_value=A.FAIL)
    return b.select("user_id", epoch_ms(F.col("first_fail")).alias("first_fail_ms"),
                    epoch_ms(F.col("last_fail")).alias("last_fail_ms"), "n_fails", "msg")


# ---------------------------------------------------------------- J2 / P4 / L1–L3
_URL_SRC = f"""
u AS (SELECT event_id, ts, {URL} AS url
      FROM (SELECT *, {ITEM} AS k FROM events) x),
f AS (SELECT * FROM u WHERE NOT regexp_matches(url, '/(css|js)$'))"""


@query("hot_urls_top5", f"""
WITH {_URL_SRC},
c AS ({_sliding_sql('f', 'url', 5000000, 120)}),
r AS (SELECT e * 5000 AS window_end, url, cnt,
             row_number() OVER (PARTITION BY e ORDER BY cnt DESC, url) AS rank FROM c)
SELECT window_end, CAST(rank AS INTEGER) AS rank, url, cnt FROM r WHERE rank <= 5""")
def hot_urls_top5(spark, d):
    ranked, _, _ = J.hot_urls(A.access_log(_ev(spark, d)), "arrival_us", "event_id")
    return ranked.select(_ms("window_end"), "rank", "url", "cnt")


@query("static_filter", f"""
WITH {_URL_SRC}
SELECT event_id, url FROM f""")
def static_filter(spark, d):
    return A.access_log(_ev(spark, d)).filter(not_static("url")).select("event_id", "url")


@query("url_report", f"""
WITH {_URL_SRC},
c AS ({_sliding_sql('f', 'url', 300000000, 2)}),
r AS (SELECT e * 300000 AS window_end, url, cnt,
             row_number() OVER (PARTITION BY e ORDER BY cnt DESC, url) AS rank FROM c)
SELECT window_end,
       '{REPORT_HEADER}' || {_java_ts('window_end * 1000')} || chr(10)
       || string_agg('{URL_LINE[0]}' || rank || '{URL_LINE[1]}' || url || '{URL_LINE[2]}' || cnt || chr(10), ''
                     ORDER BY rank)
       || '{REPORT_FOOTER}' AS report
FROM r WHERE rank <= 5 GROUP BY window_end""")
def url_report(spark, d):
    """N3 in the URL style, at a 5 min slide."""
    ranked, _, _ = J.hot_urls(A.access_log(_ev(spark, d)), "arrival_us", "event_id",
                              slide="5 minutes")
    return J.hot_urls_report(ranked).select(_ms("window_end"), "report")


_LATE_SQL = f"""
WITH {_URL_SRC},
a AS (SELECT event_id, url, epoch_us(ts) AS us,
             epoch_us(ts) + ((event_id * 7919) % 900) * 1000000 AS arr_us FROM u),
w AS (SELECT *, max(us) OVER (ORDER BY arr_us, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1000000 AS wm
      FROM a),
s AS (SELECT *, wm IS NOT NULL AND (us // 5000000) * 5000000 + 600000000 - 1000 + 60000000 <= wm
                AS is_late FROM w WHERE NOT regexp_matches(url, '/(css|js)$'))"""


@query("late_split", _LATE_SQL + """
SELECT event_id, url, us // 1000 AS event_ms, wm // 1000 AS watermark_ms FROM s WHERE is_late""")
def late_split(spark, d):
    _, late, _ = J.hot_urls(A.access_log(_ev(spark, d), arrival_delay=True), "arrival_us",
                            "event_id")
    return late.select("event_id", "url", epoch_ms(F.col("ts")).alias("event_ms"),
                       epoch_ms(F.col("watermark")).alias("watermark_ms"))


@query("late_corrections", _LATE_SQL + """,
x AS (SELECT url, wm, (us // 5000000 + 1 + i) * 5000000 AS end_us
      FROM s, range(0, 120) t(i) WHERE NOT is_late)
SELECT url, end_us // 1000 AS window_end,
       CAST(sum(CASE WHEN wm IS NULL OR end_us - 1000 > wm THEN 1 ELSE 0 END) AS BIGINT) AS on_time_cnt,
       count(*) AS final_cnt
FROM x WHERE wm IS NULL OR end_us - 1000 + 60000000 > wm
GROUP BY 1, 2 HAVING count(*) > sum(CASE WHEN wm IS NULL OR end_us - 1000 > wm THEN 1 ELSE 0 END)""")
def late_corrections(spark, d):
    _, _, corr = J.hot_urls(A.access_log(_ev(spark, d), arrival_delay=True), "arrival_us",
                            "event_id")
    return corr.select("url", _ms("window_end"), "on_time_cnt", "final_cnt")


@query("hot_urls_late_top5", _LATE_SQL + """,
x AS (SELECT url, (us // 5000000 + 1 + i) * 5000000 AS end_us, wm
      FROM s, range(0, 120) t(i) WHERE NOT is_late),
c AS (SELECT url, end_us // 1000 AS window_end, count(*) AS cnt FROM x
      WHERE wm IS NULL OR end_us - 1000 + 60000000 > wm GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, url) AS rank FROM c)
SELECT window_end, CAST(rank AS INTEGER) AS rank, url, cnt FROM r WHERE rank <= 5""")
def hot_urls_late_top5(spark, d):
    ranked, _, _ = J.hot_urls(A.access_log(_ev(spark, d), arrival_delay=True), "arrival_us",
                              "event_id")
    return ranked.select(_ms("window_end"), "rank", "url", "cnt")


# ---------------------------------------------------------------- S1 / S3 parsers
@query("access_log_parse", f"""
SELECT '10.' || CAST((user_id // 65536) % 256 AS VARCHAR) || '.' || CAST((user_id // 256) % 256 AS VARCHAR)
       || '.' || CAST(user_id % 256 AS VARCHAR) AS ip,
       CAST(user_id AS VARCHAR) AS user_id,
       epoch_ms(date_trunc('second', ts)) AS ts_ms,
       CASE WHEN event_type = 'purchase' THEN 'POST' ELSE 'GET' END AS method,
       {URL} AS url
FROM (SELECT *, {ITEM} AS k FROM events) x""")
def access_log_parse(spark, d):
    p = parse_access_log(A.access_log_lines(_ev(spark, d)))
    return p.select("ip", "user_id", epoch_ms(F.col("ts")).alias("ts_ms"), "method", "url")


@query("behavior_parse", f"""
SELECT user_id, {ITEM} AS item_id, CAST({ITEM} // 10 AS INTEGER) AS category_id,
       event_type AS behavior, epoch_us(ts) // 1000000 AS ts_s
FROM events""")
def behavior_parse(spark, d):
    return parse_behavior_lines(A.behavior_lines(_ev(spark, d))).drop("ts")


@query("ad_click_parse", """
SELECT user_id, event_id % 1000 AS ad_id, event_type AS province,
       'c,' || CAST(user_id % 10 AS VARCHAR) AS city, epoch_us(ts) // 1000000 AS ts_s
FROM events""")
def ad_click_parse(spark, d):
    return parse_ad_click_lines(A.ad_click_lines(_ev(spark, d))).drop("ts")


@query("login_parse", """
SELECT user_id, '10.0.0.' || CAST(user_id % 256 AS VARCHAR) AS ip, event_type,
       epoch_us(ts) // 1000000 AS ts_s
FROM events""")
def login_parse(spark, d):
    return parse_login_lines(A.login_lines(_ev(spark, d))).drop("ts")


@query("marketing_parse", """
SELECT CAST(user_id AS VARCHAR) AS user_id, event_type AS behavior,
       'ch' || CAST(user_id % 4 AS VARCHAR) AS channel, epoch_us(ts) // 1000 AS ts_ms
FROM events""")
def marketing_parse(spark, d):
    return parse_marketing_lines(A.marketing_lines(_ev(spark, d))).drop("ts")
