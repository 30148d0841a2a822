"""Record views of the driver's ``events`` table.

The reference reads six record types (user behaviour, web log, market
events, ad clicks, logins, orders, receipts). The test data has one
``events`` table; these views derive each record type from it with plain
column expressions (they run alike in DuckDB, so every query has an oracle).

Every view carries ``ts_us`` (epoch µs), ``ts`` (instant), ``seq`` (tie-break:
event_id) and ``arrival_us`` (arrival time of a disordered feed: ts plus
(event_id * 7919 mod 1200) seconds; arrival order is (arrival_us, seq)).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions.timecols import MICROS, ntz_of, with_event_time

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = with_event_time(table(spark, sf_dir, "events"), "ts")
    arrival = F.col("ts_us") + F.pmod(F.col("event_id") * F.lit(7919), F.lit(1200)) * F.lit(MICROS)
    return ev.withColumns({"seq": F.col("event_id"), "arrival_us": arrival})


def prop_k(props: str = "props") -> Column:
    """The number inside props ('{"k": n}')."""
    return F.regexp_extract(F.col(props), r"([0-9]+)", 1).cast("long")


_TIME = ("ts", "ts_us", "seq", "arrival_us")


def user_behavior(ev: DataFrame, only: str | None = None) -> DataFrame:
    """UserBehavior: item = k, category = k mod 10, behavior 'pv' for views.

    ``only`` keeps one behaviour, filtering the raw event type so the
    predicate reaches the parquet scan (a filter on the mapped column would not).
    """
    k = prop_k()
    if only is not None:
        ev = ev.where(F.col("event_type") == ("view" if only == "pv" else only))
    return ev.select("user_id", k.alias("item_id"), (k % 10).cast("int").alias("category_id"),
                     F.when(F.col("event_type") == "view", F.lit("pv")).otherwise(F.col("event_type")).alias("behavior"),
                     *_TIME)


def page_log(ev: DataFrame, only_get: bool = False) -> DataFrame:
    """ApacheLogEvent: url '/p/<k>', GET for views, POST otherwise
    (``only_get`` keeps GET lines with a filter the scan can take)."""
    if only_get:
        ev = ev.where(F.col("event_type") == "view")
    return ev.select(F.concat(F.lit("10.0.0."), (F.col("user_id") % 256).cast("string")).alias("ip"),
                     F.col("user_id").cast("string").alias("user_id"),
                     F.when(F.col("event_type") == "view", F.lit("GET")).otherwise(F.lit("POST")).alias("method"),
                     F.concat(F.lit("/p/"), prop_k().cast("string")).alias("url"), *_TIME)


def market_events(ev: DataFrame) -> DataFrame:
    """MarketUserBehavior: behaviour = event_type, channel = k mod 3."""
    return ev.select(F.col("user_id").cast("string").alias("user_id"), F.col("event_type").alias("behavior"),
                     (prop_k() % 3).alias("channel"), *_TIME)


def ad_clicks(ev: DataFrame) -> DataFrame:
    """Ad click records from clicks: ad = k mod 5, province = user_id mod 7."""
    return (ev.where(F.col("event_type") == "click")
              .select("user_id", (prop_k() % 5).alias("ad_id"),
                      (F.col("user_id") % 7).cast("string").alias("province"),
                      (F.col("user_id") % 11).cast("string").alias("city"), *_TIME))


def login_events(ev: DataFrame) -> DataFrame:
    """LoginEvent: 'fail' for errors, 'success' for everything else."""
    return ev.select("user_id", F.concat(F.lit("10.0.0."), (F.col("user_id") % 256).cast("string")).alias("ip"),
                     F.when(F.col("event_type") == "error", F.lit("fail")).otherwise(F.lit("success")).alias("event_type"),
                     *_TIME)


def order_events(ev: DataFrame) -> DataFrame:
    """OrderEvent: create = signup, pay = purchase; order = user_id*100 + day-of-month div 3;
    tx_id = user id text on pays, '' on creates."""
    day = F.dayofmonth(ntz_of(F.col("ts_us")))
    kind = F.when(F.col("event_type") == "signup", F.lit("create")).otherwise(F.lit("pay"))
    return (ev.where(F.col("event_type").isin("signup", "purchase"))
              .select((F.col("user_id") * 100 + F.floor(day / 3)).cast("long").alias("order_id"),
                      kind.alias("event_type"),
                      F.when(kind == "pay", F.col("user_id").cast("string")).otherwise(F.lit("")).alias("tx_id"),
                      *_TIME))


def receipts(ev: DataFrame) -> DataFrame:
    """ReceiptEvent from clicks: tx_id = user id text, channel by k parity."""
    return (ev.where(F.col("event_type") == "click")
              .select(F.col("user_id").cast("string").alias("tx_id"),
                      F.when(prop_k() % 2 == 0, F.lit("wechat")).otherwise(F.lit("alipay")).alias("pay_channel"),
                      *_TIME))
