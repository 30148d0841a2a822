"""The reference's jobs as functions over typed record DataFrames.

Inputs carry ``ts_us``/``ts``/``seq`` (see ``tidepool.sources``). Thresholds,
window sizes and zones are arguments whose defaults are the reference's
settings. Times in outputs are epoch milliseconds (BIGINT).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions import messages as M
from tidepool.functions.text import ITEM_LABEL, PAGE_LABEL
from tidepool.functions.timecols import floor_div, ms_of, pane_end, parse_duration_us, timestamp_text
from tidepool.operators import aggs, keyed, joins
from tidepool.operators.pattern import Pattern, match_sequence
from tidepool.operators.topn import ranking_report, top_n
from tidepool.operators.windows import pane_window_count, sliding_count, window_count


# ----------------------------------------------------------------------------- hot items
def item_view_counts(ub: DataFrame, size="1 hour", slide="5 minutes", behavior="pv") -> DataFrame:
    """(item_id, window_end, cnt) per sliding window, for one behaviour."""
    views = ub.where(F.col("behavior") == behavior)
    return pane_window_count(views, ["item_id"], size, slide).drop("window_start")


def hot_items(ub: DataFrame, n: int = 5, size="1 hour", slide="5 minutes") -> DataFrame:
    """Top-n items per window end by views: window_end, rnk, item_id, cnt."""
    ranked = top_n(item_view_counts(ub, size, slide), ["window_end"], "cnt", n, tie=["item_id"], rank_col="rnk")
    return ranked.select("window_end", "rnk", "item_id", "cnt")


def hot_items_sql(spark: SparkSession, ub: DataFrame, n: int = 5) -> DataFrame:
    """The Table API + SQL form: aggregate table as a view, ROW_NUMBER top-n in SQL."""
    agg = window_count(ub.where("behavior = 'pv'"), ["item_id"], "1 hour", "5 minutes", count_col="item_id").drop("window_start")
    return spark.sql(f"""
        SELECT item_id, window_end, cnt, CAST(row_num AS BIGINT) AS row_num
        FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS row_num
          FROM {{agg_table}})
        WHERE row_num <= {int(n)}""", agg_table=agg)


def hot_items_report(ub: DataFrame, n: int = 5, zone: str = "UTC") -> DataFrame:
    """One ranking text per window end (window_end, report)."""
    return ranking_report(hot_items(ub, n), "window_end", "rnk", "item_id", "cnt", ITEM_LABEL, zone)


def hot_items_changelog(spark: SparkSession, ub: DataFrame, as_of_us, n: int = 5, size="1 hour",
                        slide="5 minutes") -> DataFrame:
    """Retract stream between the top-n as of event time ``as_of_us`` (a
    BIGINT column expression or number) and the final one: (is_add,
    window_end, item_id, cnt, row_num), false = retract, true = add.

    One pass: each (item, pane) is counted twice (all rows, rows before the
    cut), panes are copied to their windows once, the two snapshots are ranked
    together (partial WindowGroupLimit per snapshot and window), and each
    ranked row nets +1 (now) / -1 (before) in one group-by.
    """
    cut = F.lit(as_of_us) if isinstance(as_of_us, int) else as_of_us
    size_us, slide_us = parse_duration_us(size), parse_duration_us(slide)
    views = ub.where(F.col("behavior") == "pv")
    panes = (views.select("item_id", pane_end(F.col("ts_us"), slide_us).alias("_p"),
                          (F.col("ts_us") < cut).alias("_before"))
                  .groupBy("item_id", "_p")
                  .agg(F.count("item_id").alias("_now"), F.count(F.when(F.col("_before"), F.col("item_id"))).alias("_then")))
    ends = F.explode(F.sequence(F.col("_p"), F.col("_p") + F.lit(size_us - slide_us), F.lit(slide_us)))
    windows = (panes.select("item_id", ends.alias("_e"), "_now", "_then")
                    .groupBy("item_id", "_e").agg(F.sum("_now").alias("_now"), F.sum("_then").alias("_then")))
    snaps = (windows.select("item_id", floor_div(F.col("_e"), 1000).alias("window_end"),
                            F.explode(F.array(F.struct(F.lit(1).alias("sign"), F.col("_now").cast("long").alias("cnt")),
                                              F.struct(F.lit(-1).alias("sign"), F.col("_then").cast("long").alias("cnt"))))
                            .alias("_s"))
                    .select("item_id", "window_end", "_s.sign", "_s.cnt")
                    .where(F.col("cnt") > 0))
    ranked = top_n(snaps, ["sign", "window_end"], "cnt", n, tie=["item_id"], rank_col="row_num")
    net = ranked.groupBy("window_end", "item_id", "cnt", "row_num").agg(F.sum("sign").alias("_net"))
    return net.where(F.col("_net") != 0).select((F.col("_net") > 0).alias("is_add"), "window_end", "item_id", "cnt",
                                                 "row_num")


# ----------------------------------------------------------------------------- page views / visitors
def _views(ub: DataFrame, behavior="pv") -> DataFrame:
    return ub.where(F.col("behavior") == behavior)


def page_views(ub: DataFrame, size="1 hour") -> DataFrame:
    """window_end, pv per tumbling window."""
    return aggs.tumbling_end(_views(ub), size).groupBy("window_end").agg(F.count(F.lit(1)).alias("pv"))


def page_views_salted(ub: DataFrame, buckets: int = 16, size="1 hour") -> DataFrame:
    """The same counts through a salted partial stage and a sum per window."""
    return aggs.salted_count(aggs.tumbling_end(_views(ub), size), ["window_end"], "seq", buckets, out="pv")


def unique_visitors(ub: DataFrame, size="1 hour", method: str = "exact") -> DataFrame:
    """window_end, uv per tumbling window; method exact | bits | bitmap | hll."""
    v = aggs.tumbling_end(_views(ub), size)
    fn = {"exact": aggs.distinct_exact, "bits": aggs.distinct_bits,
          "bitmap": aggs.distinct_bitmap, "hll": aggs.distinct_hll}[method]
    return fn(v, ["window_end"], "user_id", out="uv")


def unique_visitors_running(ub: DataFrame, size="1 hour") -> DataFrame:
    """One row per view: event id, window_end, distinct users of the window so far."""
    v = aggs.tumbling_end(_views(ub), size).select("seq", "user_id", "ts_us", "window_end")
    res = aggs.running_distinct(v, ["window_end"], "user_id", "seq", order=("ts_us", "seq"), out="uv")
    return res.select(F.col("seq").alias("event_id"), "window_end", "uv")


# ----------------------------------------------------------------------------- hot pages
def page_counts(log: DataFrame, size="10 minutes", slide="5 seconds", method="GET") -> DataFrame:
    """url, window_start, window_end, cnt for every non-empty sliding window."""
    return sliding_count(log.where(F.col("method") == method), ["url"], size, slide, expand=True)


def hot_pages(log: DataFrame, n: int = 3, size="10 minutes", slide="5 seconds", drop_late: bool = False,
              lateness="1 minute", delay="1 second") -> DataFrame:
    """Top-n urls per window end: window_end, rnk, url, cnt.

    ``drop_late`` leaves out the rows a streaming run would side-output as
    too late (``late_pages``), as the reference's counts do; by default every
    row is counted, which is what a run without disorder gives.
    """
    if drop_late:
        log, _ = keyed.split_late(log, size, slide, lateness, delay)
    ranked = top_n(page_counts(log, size, slide), ["window_end"], "cnt", n, tie=["url"], rank_col="rnk")
    return ranked.select("window_end", "rnk", "url", "cnt")


def hot_pages_report(log: DataFrame, n: int = 3, zone: str = "UTC", drop_late: bool = False) -> DataFrame:
    return ranking_report(hot_pages(log, n, drop_late=drop_late), "window_end", "rnk", "url", "cnt", PAGE_LABEL, zone)


def late_pages(log: DataFrame, size="10 minutes", slide="5 seconds", lateness="1 minute", delay="1 second",
               method="GET") -> tuple[DataFrame, DataFrame]:
    """(on-time, late) GET rows, whole; the watermark comes from every log line."""
    on_time, late = keyed.split_late(log, size, slide, lateness, delay)
    cols = [F.col("seq").alias("event_id"), *[c for c in ("ip", "user_id", "method") if c in log.columns], "url", ms_of(F.col("ts_us")).alias("ts_ms"),
            ms_of(F.col("watermark_us")).alias("watermark_ms")]
    return (on_time.where(F.col("method") == method).select(*cols),
            late.where(F.col("method") == method).select(*cols))


def hot_pages_revisions(log: DataFrame, size="10 minutes", slide="5 seconds", lateness="1 minute", delay="1 second",
                        method="GET") -> DataFrame:
    """Page counts as they are emitted: at each window's first firing and after each late row
    until end + lateness (url, window_end, kind, event_id, cnt)."""
    return keyed.fired_counts(log, ["url"], size, slide, lateness, delay, where=F.col("method") == method)


# ----------------------------------------------------------------------------- market
def _with_text(df: DataFrame, zone: str | None) -> DataFrame:
    """Window bounds also as timestamp text, in the layout the reference prints."""
    if zone is None:
        return df
    return (df.withColumn("window_start_text", timestamp_text(F.col("window_start") * F.lit(1000), zone))
              .withColumn("window_end_text", timestamp_text(F.col("window_end") * F.lit(1000), zone)))


def market_by_channel(mk: DataFrame, exclude="uninstall", size="1 day", slide="5 seconds",
                      expand: bool = False, text_zone: str | None = None) -> DataFrame:
    """Counts per (channel, behavior) in sliding windows, as change points
    (end_from, end_to, cnt) or, with ``expand``, one row per window (with
    ``text_zone``, bounds also as text in that zone)."""
    counts = sliding_count(mk.where(F.col("behavior") != exclude), ["channel", "behavior"], size, slide,
                           expand=expand)
    return _with_text(counts, text_zone) if expand else counts


def ad_blacklist(clicks: DataFrame, limit: int = 100, zone: str = "Asia/Shanghai") -> DataFrame:
    """Blacklist warnings only: keys, day, ts_ms, msg."""
    return keyed.click_limit(clicks, ["user_id", "ad_id"], limit, zone)[1]


def ad_passed_clicks(clicks: DataFrame, limit: int = 100, zone: str = "Asia/Shanghai") -> DataFrame:
    """The click stream after the blacklist filter: user_id, ad_id, province, city, ts_ms."""
    passed, _ = keyed.click_limit(clicks, ["user_id", "ad_id"], limit, zone)
    return passed.select("user_id", "ad_id", "province", "city", ms_of(F.col("ts_us")).alias("ts_ms"))


def ad_clicks(clicks: DataFrame, limit: int = 100, size="1 day", slide="5 seconds",
              zone: str = "Asia/Shanghai", expand: bool = False,
              text_zone: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(counts per province over passed clicks, blacklist warnings)."""
    passed, warnings = keyed.click_limit(clicks, ["user_id", "ad_id"], limit, zone)
    counts = sliding_count(passed, ["province"], size, slide, expand=expand)
    return (_with_text(counts, text_zone) if expand else counts), warnings


# ----------------------------------------------------------------------------- login
def login_fail_pattern(logins: DataFrame, within="2 seconds") -> DataFrame:
    """begin(fail).next(fail).within(d): user_id, first_fail_ms, last_fail_ms, msg."""
    return login_fail_streak(logins, 2, within).drop("fail_count")


def login_fail_streak(logins: DataFrame, fails: int = 3, within="2 seconds") -> DataFrame:
    """begin(fail).next(fail)... ``fails`` times within d: user_id, first_fail_ms, last_fail_ms, fail_count, msg."""
    fail = F.col("event_type") == "fail"
    p = Pattern.begin("f1", fail)
    for n in range(2, fails + 1):
        p = p.next(f"f{n}", fail)
    matches, _ = match_sequence(logins, ["user_id"], p.within(within))
    return matches.select("user_id", ms_of(F.col("f1.ts_us")).alias("first_fail_ms"), ms_of(F.col(f"f{fails}.ts_us")).alias("last_fail_ms"),
                          F.lit(fails).cast("long").alias("fail_count"), F.lit(M.LOGIN_PATTERN).alias("msg"))


def purchase_funnel(ub: DataFrame, within="15 minutes") -> tuple[DataFrame, DataFrame]:
    """begin(signup).followedBy(pv).followedBy(click).next(purchase).within(d) per user: (purchases, lost).

    A lost one is a sign-up whose pattern was pending when the time had passed: the step reached and when it timed out.
    """
    is_ = lambda kind: F.col("behavior") == kind
    p = (Pattern.begin("signup", is_("signup")).followed_by("view", is_("pv")).followed_by("click", is_("click"))
         .next("purchase", is_("purchase")).within(within))
    bought, lost = match_sequence(ub, ["user_id"], p, payload=["item_id"])
    steps = [s.name for s in p.steps]
    taken = F.array_size(F.array_compact(F.array(*[F.col(f"{s}.seq") for s in steps])))
    return (bought.select("user_id", *[F.col(f"{s}.seq").alias(f"{s}_id") for s in steps], F.col("purchase.item_id").alias("item_id"),
                          ms_of(F.col("signup.ts_us")).alias("signup_ms"), ms_of(F.col("purchase.ts_us")).alias("purchase_ms")),
            lost.select("user_id", F.col("signup.seq").alias("signup_id"), taken.cast("long").alias("steps_taken"), ms_of(F.col("timeout_us")).alias("timeout_ms")))


def login_fail_consecutive(logins: DataFrame, within="2 seconds", order=None) -> DataFrame:
    """A fail right after a fail of the same user, in the order of arrival unless ``order`` is given."""
    return keyed.consecutive_fails(logins, "user_id", parse_duration_us(within), order)


def login_fail_burst(logins: DataFrame, within="2 seconds", fail_times: int = 2) -> DataFrame:
    return keyed.fail_bursts(logins, "user_id", parse_duration_us(within), fail_times)


# ----------------------------------------------------------------------------- orders
def order_timeout_pattern(orders: DataFrame, within="15 minutes") -> tuple[DataFrame, DataFrame]:
    """begin(create).followedBy(pay).within(d) -> (paid, timeouts)."""
    p = Pattern.begin("create", F.col("event_type") == "create").followed_by("pay", F.col("event_type") == "pay").within(within)
    m, t = match_sequence(orders, ["order_id"], p)
    paid = m.select("order_id", F.lit(M.PAID).alias("result"),
                    ms_of(F.col("create.ts_us")).alias("create_ms"), ms_of(F.col("pay.ts_us")).alias("pay_ms"))
    timeouts = t.select("order_id", F.format_string(M.PATTERN_TIMEOUT.format(ms="%d"), ms_of(F.col("timeout_us")))
                        .alias("result"))
    return paid, timeouts


def order_pay_status(orders: DataFrame, limit="15 minutes") -> DataFrame:
    return keyed.order_pay_status(orders, "order_id", parse_duration_us(limit))


# ----------------------------------------------------------------------------- payments
def _pays(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("event_type") == "pay").select(
        "tx_id", F.col("seq").alias("pay_event_id"), "order_id", "event_type", F.col("ts_us").alias("pay_us"))


def _receipts(rc: DataFrame) -> DataFrame:
    return rc.select("tx_id", F.col("seq").alias("receipt_event_id"), "pay_channel", F.col("ts_us").alias("receipt_us"))


def _pairs(df: DataFrame) -> DataFrame:
    return df.select("tx_id", "pay_event_id", "order_id", "event_type", ms_of(F.col("pay_us")).alias("pay_ms"),
                     "receipt_event_id", "pay_channel", ms_of(F.col("receipt_us")).alias("receipt_ms"))


def _lonely_receipts(rc: DataFrame) -> DataFrame:
    return rc.select(F.col("receipt_event_id").alias("event_id"), "tx_id", "pay_channel", ms_of(F.col("receipt_us")).alias("ts_ms"))


def tx_match_join(orders: DataFrame, rc: DataFrame, lower="-3 seconds", upper="5 seconds") -> DataFrame:
    """Interval join: every (pay, receipt) of a tx with receipt in [pay + lower, pay + upper], both records whole."""
    j = joins.interval_join(_pays(orders), _receipts(rc), ["tx_id"], parse_duration_us(lower),
                            parse_duration_us(upper), "inner", "pay_us", "receipt_us")
    return _pairs(j)


def tx_match(orders: DataFrame, rc: DataFrame, lower="-3 seconds", upper="5 seconds"
             ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(matched pairs, unmatched pays, unmatched receipts), all records whole.

    One left outer join gives the first two, told apart by the receipt; one
    anti join gives the third.
    """
    lo, hi = parse_duration_us(lower), parse_duration_us(upper)
    pairs, lonely = joins.match_two_streams(_pays(orders), _receipts(rc), ["tx_id"], lo, hi, "pay_us", "receipt_us")
    alone = F.col("receipt_us").isNull()
    pays = pairs.where(alone).select(F.col("pay_event_id").alias("event_id"), "order_id", "event_type", "tx_id",
                                     ms_of(F.col("pay_us")).alias("ts_ms"))
    return _pairs(pairs.where(~alone)), pays, _lonely_receipts(lonely)
