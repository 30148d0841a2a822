"""Bloom filters: nothing put in is missed, the rate of error follows the formula, and merging is a union."""

import random

from pyspark.sql import functions as F

from tidepool.operators import bloom


def test_no_false_negative_and_rate_within_the_formula(spark):
    rng = random.Random(1)
    values = rng.sample(range(10 ** 9), 6000)
    df = spark.createDataFrame([(i % 2, v) for i, v in enumerate(values)] + [(1, None)], "k long, v long").repartition(5)
    filters = bloom.build(df, ["k"], "v", bits=16)
    inside = bloom.might_contain(df.where("v IS NOT NULL"), filters, ["k"], "v", ["k", "v"], bits=16)
    assert inside.where("NOT seen").count() == 0 and inside.count() == 6000
    others = spark.createDataFrame([(i % 2, v) for i, v in enumerate(rng.sample(range(10 ** 9, 2 * 10 ** 9), 6000))], "k long, v long")
    wrong = bloom.might_contain(others, filters, ["k"], "v", ["k", "v"], bits=16).where("seen").count() / 6000
    formula = bloom.expected_false_positives(3000, 3, 16)
    assert abs(wrong - formula) < 4 * (formula / 6000) ** 0.5 + 0.25 * formula
    for r in bloom.summary(filters, ["k"], bits=16).collect():
        assert abs(r.estimate - 3000) < 100 and abs(r.false_positive_rate - formula) < 0.2 * formula


def test_merged_filters_hold_both(spark):
    a, b = (spark.range(lo, lo + 500).select(F.lit(p).alias("part"), F.col("id").alias("v")) for p, lo in ((1, 0), (2, 400)))
    both = bloom.merge(bloom.build(a.union(b), ["part"], "v", bits=20).drop("part"), [])
    assert sorted((r.block, bytes(r.block_bits)) for r in both.collect()) == sorted((r.block, bytes(r.block_bits)) for r in bloom.build(a.union(b), [], "v", bits=20).collect())


def test_odd_values(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "x" * 1000), (4, "é日")], "id long, v string")
    filters = bloom.build(df, [], "v")
    got = {r.id: r.seen for r in bloom.might_contain(df, filters, [], "v", ["id"]).collect()}
    assert got == {1: False, 2: True, 3: True, 4: True}
    assert bloom.build(df.where("false"), [], "v").count() == 0
    assert {r.seen for r in bloom.might_contain(df, filters.where("false"), [], "v", ["id"]).collect()} == {False}
