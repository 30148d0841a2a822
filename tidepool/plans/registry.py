"""Registered queries over the driver's tables, each with a DuckDB oracle.

Every query reads the whole ``events`` table through a record view
(``tidepool.sources.views``). Thresholds are scaled to the test data, where
one user's events are hours apart: login 6 h, order limit 12 h, payment
interval -3 h / +5 h, one ad click per day. Windows keep the reference's
sizes. Output times are epoch ms; every computed column has the same alias
in the Spark query and in its SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions import messages as M
from tidepool.functions.messages import COUNT_LABEL, ITEM_LABEL, PAGE_LABEL, REPORT_HEADER, RULE
from tidepool.plans import jobs
from tidepool.functions.timecols import floor_div, ntz_of, pane_end
from tidepool.operators import bloom
from tidepool.sources import readers, sinks, views
from tidepool.operators.accumulate import Count, Mean, TopK, window_aggregate
from tidepool.operators.connected import match_connected
from tidepool.operators.windows import sliding_count

LOGIN_WITHIN = "6 hours"
ORDER_LIMIT = "12 hours"
STREAK_WITHIN, FUNNEL_WITHIN = "12 hours", "72 hours"
TX_LOWER, TX_UPPER = "-3 hours", "5 hours"
AD_LIMIT = 1
H = 3_600_000_000  # one hour in µs

def _ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.events(spark, sf_dir)


def _ub(spark, d):
    """Page-view rows of the user-behaviour view (every job here reads only 'pv')."""
    return views.user_behavior(_ev(spark, d), only="pv")


def _log(spark, d, only_get=True):
    return views.page_log(_ev(spark, d), only_get=only_get)


def _changelog(spark, d):
    ub = _ub(spark, d)
    ev = spark.read.parquet(f"{d}/events.parquet")
    # snapshot cut = one day before the last event, as a scalar subquery (computed first)
    last = ev.select(F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', max(ts))"))
    return jobs.hot_items_changelog(spark, ub, last.scalar() - F.lit(24 * H))


def _late(spark, d, which):
    # the watermark comes from every log line, so no GET filter before the split
    on_time, late = jobs.late_pages(_log(spark, d, only_get=False))
    return late if which == "late" else on_time


def _tx(spark, d):
    ev = _ev(spark, d)
    return jobs.tx_match(views.order_events(ev), views.receipts(ev), TX_LOWER, TX_UPPER)


def _records_parsed(spark, d):
    """Order lines built from the events and parsed back by the reader that files and streams use."""
    lines = sinks.as_lines(views.order_events(_ev(spark, d)).select("order_id", "event_type", "tx_id", floor_div(F.col("ts_us"), 1_000_000).alias("ts")))
    return readers.parse_records(lines, "order").select("order_id", "event_type", "tx_id", "ts_us")


def _weblog_parsed(spark, d):
    """Web log lines built from the events and parsed back."""
    when = F.date_format(ntz_of(F.col("ts_us")), "dd/MM/yyyy:HH:mm:ss")
    lines = _log(spark, d, only_get=False).select(F.concat_ws(" ", "ip", "user_id", F.lit("-"), when, F.lit("+0000"), "method", "url").alias("value"))
    return readers.parse_web_log(lines).select("ip", "user_id", "method", "url", "ts_us")


def _agg_item_counts(spark, d):
    """Hot items' counts by a user-written accumulator in place of the built-in count."""
    return window_aggregate(_ub(spark, d), ["item_id"], Count(), "1 hour", "5 minutes")


def _agg_top_values(spark, d):
    """Of each hour and event type the three events of the greatest value."""
    ev = _ev(spark, d).select("event_type", "event_id", "value", "ts_us")
    top = window_aggregate(ev, ["event_type"], TopK("value", "event_id", 3), "1 hour")
    return top.select("event_type", "window_end", F.array_join(F.col("top").cast("array<string>"), ",").alias("top"))


def _agg_mean(spark, d):
    ev = _ev(spark, d).select("event_type", views.prop_k().cast("double").alias("k"), "ts_us")
    return window_aggregate(ev, ["event_type"], Mean("k", "mean_k"), "1 hour", "5 minutes")


def _uv_bloom(spark, d):
    """Visitors of each hour by a Bloom filter: bits set, and the estimate from the fill."""
    views_ = _ub(spark, d).withColumn("window_end", floor_div(pane_end(F.col("ts_us"), H), 1000))
    return bloom.summary(bloom.build(views_, ["window_end"], "user_id", bits=16), ["window_end"], bits=16).select("window_end", "bits_set", "estimate")


def _uv_returning(spark, d):
    """Views by users that the filter of the hour before may hold."""
    views_ = _ub(spark, d).withColumn("window_end", floor_div(pane_end(F.col("ts_us"), H), 1000))
    before = bloom.build(views_, ["window_end"], "user_id", bits=16).withColumn("window_end", F.col("window_end") + 3_600_000)
    seen = bloom.might_contain(views_.withColumnRenamed("seq", "event_id"), before, ["window_end"], "user_id", ["event_id", "window_end"], bits=16)
    return seen.where("seen").select("event_id", "window_end")


def _connected(spark, d):
    ev = _ev(spark, d)
    pays = views.order_events(ev).where(F.col("event_type") == "pay")
    return match_connected(pays, views.receipts(ev), ["tx_id"], TX_UPPER, TX_LOWER.lstrip("-"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "hot_items": lambda s, d: jobs.hot_items(_ub(s, d)),
        "hot_items_sql": lambda s, d: jobs.hot_items_sql(s, _ub(s, d)),
        "hot_items_report": lambda s, d: jobs.hot_items_report(_ub(s, d)),
        "topn_changelog": _changelog,
        "pv_hourly": lambda s, d: jobs.page_views(_ub(s, d)),
        "pv_hourly_salted": lambda s, d: jobs.page_views_salted(_ub(s, d)),
        "uv_hourly": lambda s, d: jobs.unique_visitors(_ub(s, d), method="exact"),
        "uv_bits": lambda s, d: jobs.unique_visitors(_ub(s, d), method="bits"),
        "uv_bitmap": lambda s, d: jobs.unique_visitors(_ub(s, d), method="bitmap"),
        "uv_hll": lambda s, d: jobs.unique_visitors(_ub(s, d), method="hll"),
        "uv_running": lambda s, d: jobs.unique_visitors_running(_ub(s, d)),
        "uv_bloom": _uv_bloom,
        "uv_returning": _uv_returning,
        "hot_pages": lambda s, d: jobs.hot_pages(_log(s, d)),
        "hot_pages_report": lambda s, d: jobs.hot_pages_report(_log(s, d)),
        # as a streaming run counts them: rows past the allowed lateness are left out
        "hot_pages_on_time": lambda s, d: jobs.hot_pages(_log(s, d, only_get=False), drop_late=True),
        "hot_pages_revisions": lambda s, d: jobs.hot_pages_revisions(_log(s, d, only_get=False)),
        "late_rows": lambda s, d: _late(s, d, "late"),
        "on_time_rows": lambda s, d: _late(s, d, "on_time"),
        "market_by_channel": lambda s, d: jobs.market_by_channel(views.market_events(_ev(s, d)), exclude="signup"),
        "sliding_count_check": lambda s, d: sliding_count(_ev(s, d), ["event_type"], "1 hour", "5 minutes",
                                                          expand=True),
        "ad_province_counts": lambda s, d: jobs.ad_clicks(views.ad_clicks(_ev(s, d)), limit=AD_LIMIT)[0],
        "ad_blacklist": lambda s, d: jobs.ad_blacklist(views.ad_clicks(_ev(s, d)), limit=AD_LIMIT),
        "ad_passed_clicks": lambda s, d: jobs.ad_passed_clicks(views.ad_clicks(_ev(s, d)), limit=AD_LIMIT),
        "login_fail_pattern": lambda s, d: jobs.login_fail_pattern(views.login_events(_ev(s, d)), LOGIN_WITHIN),
        "login_fail_consecutive": lambda s, d: jobs.login_fail_consecutive(views.login_events(_ev(s, d)),
                                                                           LOGIN_WITHIN),
        "login_fail_burst": lambda s, d: jobs.login_fail_burst(views.login_events(_ev(s, d)), LOGIN_WITHIN),
        "login_fail_streak": lambda s, d: jobs.login_fail_streak(views.login_events(_ev(s, d)), 3, STREAK_WITHIN),
        "purchase_funnel": lambda s, d: jobs.purchase_funnel(views.user_behavior(_ev(s, d)), FUNNEL_WITHIN)[0],
        "purchase_funnel_lost": lambda s, d: jobs.purchase_funnel(views.user_behavior(_ev(s, d)), FUNNEL_WITHIN)[1],
        "order_pattern_paid": lambda s, d: jobs.order_timeout_pattern(views.order_events(_ev(s, d)),
                                                                      ORDER_LIMIT)[0],
        "order_pattern_timeout": lambda s, d: jobs.order_timeout_pattern(views.order_events(_ev(s, d)),
                                                                         ORDER_LIMIT)[1],
        "order_pay_status": lambda s, d: jobs.order_pay_status(views.order_events(_ev(s, d)), ORDER_LIMIT),
        "tx_match_join": lambda s, d: jobs.tx_match_join(views.order_events(_ev(s, d)), views.receipts(_ev(s, d)),
                                                         TX_LOWER, TX_UPPER),
        "tx_matched": lambda s, d: _tx(s, d)[0],
        "tx_unmatched_pay": lambda s, d: _tx(s, d)[1],
        "tx_unmatched_receipt": lambda s, d: _tx(s, d)[2],
        "tx_connected": lambda s, d: _connected(s, d)[0],
        "tx_connected_pays": lambda s, d: _connected(s, d)[1],
        "tx_connected_receipts": lambda s, d: _connected(s, d)[2],
        "agg_item_counts": _agg_item_counts,
        "agg_top_values": _agg_top_values,
        "agg_mean": _agg_mean,
        "records_parsed": _records_parsed,
        "weblog_parsed": _weblog_parsed,
    }


# ============================================================================ oracle SQL (DuckDB)
EV = """(SELECT event_id, user_id, event_type, ts, epoch_us(ts) AS ts_us,
        epoch_us(ts) + ((event_id * 7919) % 1200) * 1000000 AS arrival_us,
        CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events)"""


def _hot_items_sql(where: str = "") -> str:
    return f"""
    SELECT item_id, window_end, cnt, row_num FROM (
      SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS row_num FROM (
        SELECT k AS item_id, (ts_us - ts_us % 300000000 + 300000000 * (r.i + 1)) // 1000 AS window_end,
               count(*) AS cnt
        FROM {EV} e, range(12) AS r(i)
        WHERE event_type = 'view' {where}
        GROUP BY ALL))
    WHERE row_num <= 5"""


def _report_sql(top: str, id_col: str, label: str) -> str:
    return f"""
    SELECT window_end,
      '{REPORT_HEADER}' || strftime(make_timestamp(window_end * 1000), '%Y-%m-%d %H:%M:%S') || '.0' || chr(10)
      || string_agg('NO' || rnk || ': ' || chr(9) || '{label}' || {id_col} || chr(9) || '{COUNT_LABEL}'
                    || cnt || chr(10), '' ORDER BY rnk)
      || '{RULE}' || chr(10) || chr(10) AS report
    FROM ({top}) GROUP BY window_end"""


HOT_ITEMS = """
    SELECT window_end, row_num AS rnk, item_id, cnt FROM ({})""".format(_hot_items_sql())

HOT_PAGES = f"""
    SELECT window_end, rnk, url, cnt FROM (
      SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, url) AS rnk FROM (
        SELECT '/p/' || k AS url, (ts_us - ts_us % 5000000 + 5000000 * (r.i + 1)) // 1000 AS window_end,
               count(*) AS cnt
        FROM {EV} e, range(120) AS r(i)
        WHERE event_type = 'view'
        GROUP BY ALL))
    WHERE rnk <= 3"""

HOT_PAGES_ON_TIME = f"""
    WITH v AS (SELECT event_id, event_type, '/p/' || k AS url, ts_us,
                 max(ts_us) OVER (ORDER BY arrival_us, event_id
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1000000 AS wm
               FROM {EV}),
    ok AS (SELECT url, ts_us FROM v WHERE event_type = 'view'
           AND NOT coalesce(ts_us - ts_us % 5000000 + 600000000 - 1000 + 60000000 <= wm, false))
    SELECT window_end, rnk, url, cnt FROM (
      SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, url) AS rnk FROM (
        SELECT url, (ts_us - ts_us % 5000000 + 5000000 * (r.i + 1)) // 1000 AS window_end, count(*) AS cnt
        FROM ok, range(120) AS r(i)
        GROUP BY ALL))
    WHERE rnk <= 3"""

_HOURLY = "(ts_us - ts_us % 3600000000 + 3600000000) // 1000"


def _change_points(src: str, keys: list[str], size_us: int, slide_us: int) -> str:
    """Change points of per-key sliding counts, from a direct range count at
    every candidate end (pane ends and pane ends + size)."""
    k = ", ".join(keys)
    on = " AND ".join(f"e.{c} = p.{c}" for c in keys)
    pk = ", ".join(f"p.{c}" for c in keys)
    return f"""
    WITH e AS (SELECT {k}, ts_us - ts_us % {slide_us} + {slide_us} AS pe FROM ({src})),
    pts AS (SELECT DISTINCT {k}, pe AS pt FROM e UNION SELECT DISTINCT {k}, pe + {size_us} AS pt FROM e),
    c AS (SELECT {pk}, p.pt, count(e.pe) AS cnt FROM pts p LEFT JOIN e
          ON {on} AND e.pe > p.pt - {size_us} AND e.pe <= p.pt GROUP BY ALL),
    d AS (SELECT *, lag(cnt) OVER (PARTITION BY {k} ORDER BY pt) AS prev FROM c),
    kp AS (SELECT {k}, pt, cnt FROM d WHERE cnt <> coalesce(prev, 0)),
    s AS (SELECT *, lead(pt) OVER (PARTITION BY {k} ORDER BY pt) AS nx FROM kp)
    SELECT {k}, pt // 1000 AS end_from, nx // 1000 AS end_to, cnt FROM s WHERE cnt <> 0"""


_BLOOM = "[" + ", ".join(f"list_reduce(string_split(CAST(user_id AS VARCHAR), ''), lambda acc, x: (acc * {s} + ascii(x)) % 65536, 0::BIGINT)"
                         for s in bloom.SEEDS) + "]"
_LOGIN = f"""(SELECT user_id, CASE WHEN event_type = 'error' THEN 'fail' ELSE 'success' END AS t,
              ts_us, arrival_us, event_id AS seq FROM {EV})"""
_ORDERS = f"""(SELECT user_id * 100 + day(ts) // 3 AS order_id,
               CASE WHEN event_type = 'signup' THEN 'create' ELSE 'pay' END AS t, ts_us, event_id AS seq,
               CAST(user_id AS VARCHAR) AS tx_id
               FROM {EV} WHERE event_type IN ('signup', 'purchase'))"""
_PAYS = f"(SELECT tx_id, seq AS pay_event_id, order_id, t AS event_type, ts_us AS pay_us FROM {_ORDERS} WHERE t = 'pay')"
_RECEIPTS = f"""(SELECT CAST(user_id AS VARCHAR) AS tx_id, event_id AS receipt_event_id, ts_us AS receipt_us,
                 CASE WHEN k % 2 = 0 THEN 'wechat' ELSE 'alipay' END AS pay_channel
                 FROM {EV} WHERE event_type = 'click')"""
_TX_COND = "r.tx_id = p.tx_id AND r.receipt_us >= p.pay_us - {lo} AND r.receipt_us <= p.pay_us + {hi}".format(
    lo=3 * H, hi=5 * H)
_PAIRS = f"""
    SELECT p.tx_id, pay_event_id, order_id, event_type, pay_us // 1000 AS pay_ms, receipt_event_id, pay_channel,
           receipt_us // 1000 AS receipt_ms
    FROM {_PAYS} p JOIN {_RECEIPTS} r ON {_TX_COND}"""

_CONNECTED = f"""
    WITH e AS (
      SELECT tx_id, true AS l, p.ts_us AS u, a.arrival_us AS a, p.seq AS s FROM {_ORDERS} p JOIN {EV} a ON a.event_id = p.seq WHERE t = 'pay'
      UNION ALL SELECT tx_id, false, receipt_us, a.arrival_us, receipt_event_id FROM {_RECEIPTS} r JOIN {EV} a ON a.event_id = receipt_event_id),
    m AS (SELECT *, max(u) FILTER (l) OVER w AS xa, max(u) FILTER (NOT l) OVER w AS xb, max(u) FILTER (l) OVER b AS ya, max(u) FILTER (NOT l) OVER b AS yb
          FROM e WINDOW w AS (ORDER BY a, s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), b AS (ORDER BY a, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    c AS (SELECT *, CASE WHEN xa IS NOT NULL AND xb IS NOT NULL THEN least(xa, xb) END AS after, CASE WHEN ya IS NOT NULL AND yb IS NOT NULL THEN least(ya, yb) END AS before FROM m),
    pairs AS (
      SELECT p.tx_id, p.s AS l_seq, p.u AS l_us, r.s AS r_seq, r.u AS r_us, greatest(p.a, r.a) AS emitted_us, CASE WHEN (r.a, r.s) > (p.a, p.s) THEN r.s ELSE p.s END AS emitted_seq
      FROM c p JOIN c r ON p.l AND NOT r.l AND p.tx_id = r.tx_id AND r.u BETWEEN p.u - {3 * H} AND p.u + {5 * H}
      WHERE CASE WHEN (r.a, r.s) > (p.a, p.s) THEN coalesce(r.before < p.u + {5 * H}, true) ELSE coalesce(p.before < r.u + {3 * H}, true) END),
    steps AS (SELECT after AS at, a, s FROM c WHERE after IS NOT NULL AND coalesce(after > before, true))"""


def _alone_sql(name: str, is_left: str, wait: int) -> str:
    return _CONNECTED + f""",
    alone AS (SELECT tx_id, s AS {name}_seq, u AS {name}_us, u + {wait} AS deadline, a AS own FROM c WHERE l = {is_left} AND s NOT IN (SELECT {name}_seq FROM pairs))
    SELECT tx_id, {name}_seq, {name}_us, CASE WHEN (steps.a, steps.s) < (own, {name}_seq) THEN own ELSE steps.a END AS emitted_us,
           CASE WHEN (steps.a, steps.s) < (own, {name}_seq) THEN {name}_seq ELSE steps.s END AS emitted_seq FROM alone ASOF LEFT JOIN steps ON alone.deadline <= steps.at"""


_AD_RANKED = f"""
    (SELECT user_id, k % 5 AS ad_id, CAST(user_id % 7 AS VARCHAR) AS province, ts_us,
            strftime(CAST(ts + INTERVAL 8 HOUR AS DATE), '%Y-%m-%d') AS day,
            row_number() OVER (PARTITION BY user_id, k % 5, CAST(ts + INTERVAL 8 HOUR AS DATE)
                               ORDER BY ts_us, event_id) AS rn
     FROM {EV} WHERE event_type = 'click')"""

_LATE = f"""
    WITH v AS (SELECT event_id, user_id, event_type, '/p/' || k AS url, ts_us,
                 max(ts_us) OVER (ORDER BY arrival_us, event_id
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1000000 AS wm
               FROM {EV})
    SELECT event_id, '10.0.0.' || (user_id % 256) AS ip, CAST(user_id AS VARCHAR) AS user_id, 'GET' AS method, url, ts_us // 1000 AS ts_ms, wm // 1000 AS watermark_ms FROM v
    WHERE event_type = 'view' AND {{neg}} coalesce(ts_us - ts_us % 5000000 + 600000000 - 1000 + 60000000 <= wm, false)"""

_BURST_A, _BURST_B = M.LOGIN_BURST.format(secs=6 * 3600, n="\x00").split("\x00")

_BURST = f"""
    WITH RECURSIVE r AS (
      SELECT user_id, t, ts_us, seq,
             coalesce(sum(CASE WHEN t = 'fail' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts_us, seq
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run_id
      FROM {_LOGIN}),
    f AS (SELECT user_id, run_id, ts_us, seq,
                 row_number() OVER (PARTITION BY user_id, run_id ORDER BY ts_us, seq) AS rk
          FROM r WHERE t = 'fail'),
    nx AS (SELECT a.user_id, a.run_id, a.ts_us, a.rk, min(b.rk) AS nrk
           FROM f a LEFT JOIN f b ON a.user_id = b.user_id AND a.run_id = b.run_id AND b.ts_us > a.ts_us + {6 * H}
           GROUP BY ALL),
    chain AS (SELECT * FROM nx WHERE rk = 1
              UNION ALL
              SELECT n.* FROM chain c JOIN nx n ON n.user_id = c.user_id AND n.run_id = c.run_id AND n.rk = c.nrk),
    runs AS (SELECT user_id, run_id, max(rk) AS lastrk FROM f GROUP BY ALL),
    closers AS (SELECT user_id, run_id, ts_us AS close_u FROM r WHERE t <> 'fail'),
    b AS (SELECT c.user_id, c.ts_us, c.nrk, coalesce(c.nrk, runs.lastrk + 1) - c.rk AS fail_count,
                 lf.ts_us AS last_u, cl.close_u
          FROM chain c JOIN runs ON runs.user_id = c.user_id AND runs.run_id = c.run_id
          JOIN f lf ON lf.user_id = c.user_id AND lf.run_id = c.run_id AND lf.rk = coalesce(c.nrk, runs.lastrk + 1) - 1
          LEFT JOIN closers cl ON cl.user_id = c.user_id AND cl.run_id = c.run_id)
    SELECT user_id, ts_us // 1000 AS first_fail_ms, last_u // 1000 AS last_fail_ms,
           CAST(fail_count AS BIGINT) AS fail_count,
           '{_BURST_A}' || fail_count || '{_BURST_B}' AS msg
    FROM b
    WHERE fail_count >= 2 AND NOT (nrk IS NULL AND close_u IS NOT NULL AND close_u <= ts_us + {6 * H})"""

# Of each row the position of the next row and of the first later view and click, by windows over the whole user; -1 marks a
# funnel that failed at its last step in time.
_FUNNEL = f"""
    WITH e AS (SELECT event_id AS seq, user_id, event_type AS t, ts_us, k FROM {EV}),
    n AS (SELECT *, min(CASE WHEN t = 'view' THEN {{'u': ts_us, 's': seq}} END) OVER w AS v, min(CASE WHEN t = 'click' THEN {{'u': ts_us, 's': seq}} END) OVER w AS c,
                 min({{'u': ts_us, 's': seq}}) OVER w AS nx
          FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts_us, seq ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
    s AS (SELECT a.user_id, a.seq AS s1, a.ts_us AS u1, CASE WHEN v.ts_us < a.ts_us + {72 * H} THEN v.seq END AS s2,
                 CASE WHEN c.ts_us < a.ts_us + {72 * H} THEN c.seq END AS s3, CASE WHEN x.ts_us < a.ts_us + {72 * H} THEN x.seq END AS nx, x.t AS nt, x.ts_us AS u4, x.k AS item
          FROM n a LEFT JOIN n v ON v.seq = a.v.s LEFT JOIN n c ON c.seq = v.c.s LEFT JOIN n x ON x.seq = c.nx.s WHERE a.t = 'signup')"""

_ORDER_MATCH = f"""
    WITH c AS (SELECT * FROM {_ORDERS} WHERE t = 'create'),
    m AS (SELECT c.order_id, c.ts_us, c.seq, min(p.ts_us) AS pay_u
          FROM c LEFT JOIN {_ORDERS} p ON p.order_id = c.order_id AND p.t = 'pay'
               AND (p.ts_us > c.ts_us OR (p.ts_us = c.ts_us AND p.seq > c.seq))
          GROUP BY ALL)"""


def oracle_sql() -> dict[str, str]:
    tx_neg = f"""
        SELECT p.pay_event_id AS event_id, p.order_id, p.event_type, p.tx_id, p.pay_us // 1000 AS ts_ms FROM {_PAYS} p
        WHERE NOT EXISTS (SELECT 1 FROM {_RECEIPTS} r WHERE {_TX_COND})"""
    rx_neg = f"""
        SELECT r.receipt_event_id AS event_id, r.tx_id, r.pay_channel, r.receipt_us // 1000 AS ts_ms FROM {_RECEIPTS} r
        WHERE NOT EXISTS (SELECT 1 FROM {_PAYS} p WHERE {_TX_COND})"""
    uv_bits = ("list_reduce(string_split(CAST(user_id AS VARCHAR), ''), "
               "lambda acc, x: (acc * 61 + ascii(x)) % 536870912, 0::BIGINT)")
    hourly_views = f"FROM {EV} WHERE event_type = 'view' GROUP BY 1"
    last_cut = f"(SELECT max(epoch_us(ts)) FROM events) - {24 * H}"
    return {
        "hot_items": HOT_ITEMS,
        "hot_items_sql": _hot_items_sql(),
        "hot_items_report": _report_sql(HOT_ITEMS, "item_id", ITEM_LABEL),
        "topn_changelog": f"""
            WITH cur AS ({_hot_items_sql()}), prev AS ({_hot_items_sql(f"AND ts_us < {last_cut}")})
            SELECT true AS is_add, * FROM (SELECT * FROM cur EXCEPT ALL SELECT * FROM prev)
            UNION ALL
            SELECT false AS is_add, * FROM (SELECT * FROM prev EXCEPT ALL SELECT * FROM cur)""",
        "pv_hourly": f"SELECT {_HOURLY} AS window_end, count(*) AS pv {hourly_views}",
        "pv_hourly_salted": f"SELECT {_HOURLY} AS window_end, count(*) AS pv {hourly_views}",
        "uv_hourly": f"SELECT {_HOURLY} AS window_end, count(DISTINCT user_id) AS uv {hourly_views}",
        "uv_bits": f"SELECT {_HOURLY} AS window_end, count(DISTINCT {uv_bits}) AS uv {hourly_views}",
        "uv_bitmap": f"SELECT {_HOURLY} AS window_end, count(DISTINCT user_id) AS uv {hourly_views}",
        "uv_hll": f"SELECT {_HOURLY} AS window_end, count(DISTINCT user_id) AS uv {hourly_views}",
        "uv_bloom": f"""
            SELECT window_end, count(DISTINCT p) AS bits_set, round(-65536.0 / 3 * ln(1 - count(DISTINCT p) / 65536.0))::BIGINT AS estimate
            FROM (SELECT window_end, unnest({_BLOOM}) AS p FROM (SELECT *, {_HOURLY} AS window_end FROM {EV} WHERE event_type = 'view')) GROUP BY window_end""",
        "uv_returning": f"""
            WITH v AS (SELECT event_id, {_HOURLY} AS window_end, {_BLOOM} AS p FROM {EV} WHERE event_type = 'view'),
            f AS (SELECT DISTINCT window_end + 3600000 AS window_end, unnest(p) AS p FROM v)
            SELECT event_id, window_end FROM (SELECT event_id, window_end, unnest(list_distinct(p)) AS p, len(list_distinct(p)) AS n FROM v) JOIN f USING (window_end, p)
            GROUP BY event_id, window_end, n HAVING count(*) = n""",
        "uv_running": f"""
            WITH v AS (SELECT event_id, user_id, ts_us, {_HOURLY} AS window_end FROM {EV} WHERE event_type = 'view'),
            f AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY window_end, user_id ORDER BY ts_us, event_id) = 1
                                 THEN 1 ELSE 0 END AS is_new FROM v)
            SELECT event_id, window_end,
                   CAST(sum(is_new) OVER (PARTITION BY window_end ORDER BY ts_us, event_id
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS uv
            FROM f""",
        "hot_pages": HOT_PAGES,
        "hot_pages_report": _report_sql(HOT_PAGES, "url", PAGE_LABEL),
        "hot_pages_on_time": HOT_PAGES_ON_TIME,
        "hot_pages_revisions": """
            WITH v AS (SELECT event_id, event_type, arrival_us, '/p/' || k AS url, ts_us - ts_us % 5000000 + 5000000 AS pane,
                         max(ts_us) OVER (ORDER BY arrival_us, event_id
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1000000 AS wm
                       FROM {ev}),
            w AS (SELECT url, event_id, arrival_us, wm, pane + 5000000 * r.i AS e, coalesce(wm < pane + 5000000 * r.i - 1000, true) AS ok
                  FROM v, range(120) AS r(i) WHERE event_type = 'view'),
            f AS (SELECT url, e, count(*) AS cnt FROM w WHERE ok GROUP BY url, e),
            l AS (SELECT url, e, event_id, row_number() OVER (PARTITION BY url, e ORDER BY arrival_us, event_id) AS nth
                  FROM w WHERE NOT ok AND wm < e - 1000 + 60000000)
            SELECT url, e // 1000 AS window_end, 'first' AS kind, NULL::BIGINT AS event_id, cnt FROM f
            UNION ALL
            SELECT l.url, l.e // 1000 AS window_end, 'revision' AS kind, event_id, coalesce(f.cnt, 0) + nth AS cnt
            FROM l LEFT JOIN f ON f.url = l.url AND f.e = l.e""".replace("{ev}", EV),
        "late_rows": _LATE.format(neg=""),
        "on_time_rows": _LATE.format(neg="NOT"),
        "market_by_channel": _change_points(
            f"SELECT k % 3 AS channel, event_type AS behavior, ts_us FROM {EV} WHERE event_type <> 'signup'",
            ["channel", "behavior"], 24 * H, 5_000_000),
        "sliding_count_check": f"""
            SELECT event_type, (pe + 300000000 * r.i - {H}) // 1000 AS window_start,
                   (pe + 300000000 * r.i) // 1000 AS window_end, count(*) AS cnt
            FROM (SELECT event_type, ts_us - ts_us % 300000000 + 300000000 AS pe FROM {EV}) e, range(12) AS r(i)
            GROUP BY ALL""",
        "ad_province_counts": _change_points(f"SELECT province, ts_us FROM {_AD_RANKED} WHERE rn <= {AD_LIMIT}",
                                             ["province"], 24 * H, 5_000_000),
        "ad_passed_clicks": f"""
            SELECT user_id, ad_id, province, CAST(user_id % 11 AS VARCHAR) AS city, ts_us // 1000 AS ts_ms
            FROM {_AD_RANKED} WHERE rn <= {AD_LIMIT}""",
        "ad_blacklist": f"""
            SELECT user_id, ad_id, day, ts_us // 1000 AS ts_ms, '{M.CLICK_LIMIT.format(limit=AD_LIMIT)}' AS msg
            FROM {_AD_RANKED} WHERE rn = {AD_LIMIT + 1}""",
        "login_fail_pattern": f"""
            WITH n AS (SELECT *, lead(t) OVER w AS nt, lead(ts_us) OVER w AS nu FROM {_LOGIN}
                       WINDOW w AS (PARTITION BY user_id ORDER BY ts_us, seq))
            SELECT user_id, ts_us // 1000 AS first_fail_ms, nu // 1000 AS last_fail_ms, '{M.LOGIN_PATTERN}' AS msg
            FROM n WHERE t = 'fail' AND nt = 'fail' AND nu - ts_us < {6 * H}""",
        "login_fail_consecutive": f"""
            WITH n AS (SELECT *, lag(t) OVER w AS pt, lag(ts_us) OVER w AS pu FROM {_LOGIN}
                       WINDOW w AS (PARTITION BY user_id ORDER BY arrival_us, seq))
            SELECT user_id, pu // 1000 AS first_fail_ms, ts_us // 1000 AS last_fail_ms,
                   '{M.LOGIN_CONSECUTIVE.format(secs=6 * 3600)}' AS msg
            FROM n WHERE t = 'fail' AND pt = 'fail' AND ts_us < pu + {6 * H}""",
        "login_fail_burst": _BURST,
        "login_fail_streak": f"""
            WITH n AS (SELECT *, lead(t) OVER w AS t2, lead(t, 2) OVER w AS t3, lead(ts_us, 2) OVER w AS u3 FROM {_LOGIN}
                       WINDOW w AS (PARTITION BY user_id ORDER BY ts_us, seq))
            SELECT user_id, ts_us // 1000 AS first_fail_ms, u3 // 1000 AS last_fail_ms, 3::BIGINT AS fail_count, '{M.LOGIN_PATTERN}' AS msg
            FROM n WHERE t = 'fail' AND t2 = 'fail' AND t3 = 'fail' AND u3 - ts_us < {12 * H}""",
        "purchase_funnel": _FUNNEL + """
            SELECT user_id, s1 AS signup_id, s2 AS view_id, s3 AS click_id, nx AS purchase_id, item AS item_id,
                   u1 // 1000 AS signup_ms, u4 // 1000 AS purchase_ms FROM s WHERE nx IS NOT NULL AND nt = 'purchase'""",
        "purchase_funnel_lost": _FUNNEL + f"""
            SELECT user_id, s1 AS signup_id, (1 + (s2 IS NOT NULL)::INT + (s3 IS NOT NULL)::INT)::BIGINT AS steps_taken, (u1 + {72 * H}) // 1000 AS timeout_ms
            FROM s WHERE nx IS NULL""",
        "order_pattern_paid": _ORDER_MATCH + f"""
            SELECT order_id, '{M.PAID}' AS result, ts_us // 1000 AS create_ms, pay_u // 1000 AS pay_ms
            FROM m WHERE pay_u IS NOT NULL AND pay_u - ts_us < {12 * H}""",
        "order_pattern_timeout": _ORDER_MATCH + f"""
            SELECT order_id, '{M.PATTERN_TIMEOUT.format(ms="")}' || CAST((ts_us + {12 * H}) // 1000 AS VARCHAR) AS result
            FROM m WHERE NOT (pay_u IS NOT NULL AND pay_u - ts_us < {12 * H})""",
        "order_pay_status": f"""
            WITH g AS (SELECT order_id, min(CASE WHEN t = 'create' THEN ts_us END) AS c,
                              min(CASE WHEN t = 'pay' THEN ts_us END) AS p FROM {_ORDERS} GROUP BY 1)
            SELECT order_id, CASE
                WHEN c IS NOT NULL AND p IS NOT NULL THEN
                    CASE WHEN p < c + {12 * H} THEN '{M.PAID}' ELSE '{M.PAID_LATE}' END
                WHEN p IS NOT NULL THEN '{M.PAY_WITHOUT_CREATE}'
                ELSE '{M.ORDER_TIMEOUT}' END AS result
            FROM g""",
        "tx_match_join": _PAIRS,
        "tx_matched": _PAIRS,
        "tx_unmatched_pay": tx_neg,
        "tx_unmatched_receipt": rx_neg,
        "tx_connected": _CONNECTED + " SELECT * FROM pairs",
        "tx_connected_pays": _alone_sql("l", "true", 5 * H),
        "tx_connected_receipts": _alone_sql("r", "false", 3 * H),
        "agg_item_counts": f"""
            SELECT k AS item_id, (pe + 300000000 * r.i - {H}) // 1000 AS window_start, (pe + 300000000 * r.i) // 1000 AS window_end, count(*) AS cnt
            FROM (SELECT k, ts_us - ts_us % 300000000 + 300000000 AS pe FROM {EV} WHERE event_type = 'view') e, range(12) AS r(i)
            GROUP BY ALL""",
        "agg_top_values": f"""
            SELECT event_type, window_end, string_agg(event_id::VARCHAR, ',' ORDER BY value DESC, event_id) AS top
            FROM (SELECT event_type, {_HOURLY} AS window_end, event_id, value,
                         row_number() OVER (PARTITION BY event_type, {_HOURLY} ORDER BY value DESC, event_id) AS n
                  FROM (SELECT *, epoch_us(ts) AS ts_us FROM events)) WHERE n <= 3 GROUP BY ALL""",
        "agg_mean": f"""
            SELECT event_type, (pe + 300000000 * r.i - {H}) // 1000 AS window_start, (pe + 300000000 * r.i) // 1000 AS window_end,
                   sum(k)::DOUBLE / count(k) AS mean_k
            FROM (SELECT event_type, k, ts_us - ts_us % 300000000 + 300000000 AS pe FROM {EV}) e, range(12) AS r(i)
            GROUP BY ALL""",
        "records_parsed": f"""
            SELECT order_id, t AS event_type, CASE WHEN t = 'pay' THEN tx_id ELSE '' END AS tx_id,
                   ts_us // 1000000 * 1000000 AS ts_us FROM {_ORDERS}""",
        "weblog_parsed": f"""
            SELECT '10.0.0.' || (user_id % 256) AS ip, CAST(user_id AS VARCHAR) AS user_id,
                   CASE WHEN event_type = 'view' THEN 'GET' ELSE 'POST' END AS method, '/p/' || k AS url,
                   ts_us // 1000000 * 1000000 AS ts_us FROM {EV}""",
    }
