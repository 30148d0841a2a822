"""Top-N with ties, ranking text and changelogs."""

from pyspark.sql import functions as F

from helpers import frame, tuples
from tidepool.operators.topn import changelog, ranking_report, top_n
from tidepool.plans import jobs

SEC = 1_000_000


def test_top_n_breaks_ties_by_key(spark):
    df = spark.createDataFrame([(1, 10, 5), (1, 11, 5), (1, 12, 7), (1, 13, 1), (2, 10, 1)],
                               "w long, item long, cnt long")
    got = top_n(df, ["w"], "cnt", 2, tie=["item"], rank_col="rnk")
    assert tuples(got, ["w", "rnk", "item"]) == [(1, 1, 12), (1, 2, 10), (2, 1, 10)]


def test_top_n_plans_a_group_limit(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("w"), F.col("id").alias("item"),
                                  (F.col("id") % 13).alias("cnt"))
    plan = top_n(df, ["w"], "cnt", 5, tie=["item"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_report_text(spark):
    top = spark.createDataFrame([(3_600_000, 1, 7, 9), (3_600_000, 2, 3, 4)], "window_end long, rnk long, item_id long, cnt long")
    text = ranking_report(top, "window_end", "rnk", "item_id", "cnt").first()["report"]
    assert text == ("窗口结束时间：1970-01-01 01:00:00.0\n"
                    "NO1: \t商品ID = 7\t热门度 = 9\n"
                    "NO2: \t商品ID = 3\t热门度 = 4\n"
                    "====================================\n\n")


def test_changelog_adds_and_retracts(spark):
    prev = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    cur = spark.createDataFrame([(1, "a"), (2, "c"), (3, "d")], "k long, v string")
    assert tuples(changelog(prev, cur)) == [(False, 2, "b"), (True, 2, "c"), (True, 3, "d")]


def test_hot_items_sql_equals_dataframe_form(spark):
    rows = [(u, i % 4, "pv", (i * 37 % 7200) * SEC, i) for i, u in enumerate(range(300))]
    ub = frame(spark, rows, "user_id long, item_id long, behavior string, ts_us long, seq long")
    a = jobs.hot_items(ub, 3).select("window_end", F.col("rnk").alias("row_num"), "item_id", "cnt")
    b = jobs.hot_items_sql(spark, ub, 3)
    assert tuples(a, ["window_end", "row_num", "item_id", "cnt"]) == tuples(b, ["window_end", "row_num", "item_id", "cnt"])
