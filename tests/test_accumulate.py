"""User-written accumulators: against plain Python, in any split of the rows, with odd keys and values."""

import random
from collections import defaultdict

import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from tidepool.operators import accumulate as acc

SCHEMA = "k string, v double, id long, ts_us long"
SEC = 1_000_000


def distinct():
    """A class of its own function, so that it is sent by value, as one of a notebook is."""

    class Distinct(acc.Aggregate):
        """Distinct ids as a set, and a window hook that writes the key and its bounds."""

        inputs, output = ("id",), "n long, label string"

        def create(self):
            return set()

        def add(self, a, rows):
            return a | set(pc.unique(rows.column("id")).to_pylist()) - {None}

        def merge(self, a, b):
            return a | b

        def result(self, a):
            return len(a), ""

        def window(self, key, result):
            return result[0], f"{key['k']}@{key['window_end']}" if "window_end" in key else str(key["k"])

    return Distinct()


def data(rng, n):
    return [(rng.choice([None, "a", "b", "hot", "hot"]), rng.choice([None, rng.random(), 1.0]), rng.randrange(40), rng.choice([None, rng.randrange(500 * SEC)])) for _ in range(n)]


@pytest.mark.parametrize("held, files", [(1, 7), (20_000, 3)])
def test_like_python(spark, held, files):
    rows = data(random.Random(held), 600)
    df = spark.createDataFrame(rows, SCHEMA).repartition(files)
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    got = {r.k: r.cnt for r in acc.aggregate(df, ["k"], acc.Count(), held=held).collect()}
    assert got == {k: len(v) for k, v in by.items()}
    means = {r.k: r.mean for r in acc.aggregate(df, ["k"], acc.Mean("v"), held=held).collect()}
    for k, v in by.items():
        values = [x[1] for x in v if x[1] is not None]
        assert abs(means[k] - sum(values) / len(values)) < 1e-9
    tops = {r.k: r.top for r in acc.aggregate(df, ["k"], acc.TopK("v", "id", 4), held=held).collect()}
    assert tops == {k: [x[2] for x in sorted((x for x in v if x[1] is not None), key=lambda x: (-x[1], x[2]))[:4]] for k, v in by.items()}
    assert acc.aggregate(df, [], acc.Count(), held=held).collect()[0].cnt == 600


def test_sliding_windows_and_hook(spark):
    rows = data(random.Random(5), 400)
    got = {(r.k, r.window_end): (r.n, r.label) for r in acc.window_aggregate(spark.createDataFrame(rows, SCHEMA).repartition(5), ["k"], distinct(), "60 seconds", "20 seconds").collect()}
    want = defaultdict(set)
    for k, _, i, ts in rows:
        if ts is not None:
            for e in range(ts // (20 * SEC) * 20 + 20, ts // (20 * SEC) * 20 + 61, 20):
                want[k, e * 1000].add(i)
    assert got == {key: (len(ids), f"{key[0]}@{key[1]}") for key, ids in want.items()}


def test_accumulators_not_rows_are_shuffled(spark):
    """A key with all rows: what crosses the exchange is a row per task and part, and the plan has no other exchange of rows."""
    df = spark.range(200_000, numPartitions=8).select(F.lit("hot").alias("k"), "id")
    parts = acc._accumulators(df, ["k"], acc.Count(), acc.HELD)
    assert parts.count() == 8
    assert acc.aggregate(df, ["k"], acc.Count()).collect()[0].cnt == 200_000


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert acc.aggregate(empty, ["k"], acc.Count()).count() == 0 and acc.window_aggregate(empty, ["k"], acc.Mean("v"), "1 hour", "5 minutes").count() == 0
    nulls = spark.createDataFrame([("a", None, None, 1)], SCHEMA)
    assert acc.aggregate(nulls, ["k"], acc.Mean("v")).collect()[0].mean is None and acc.aggregate(nulls, ["k"], acc.TopK("v", "id", 2)).collect()[0].top == []
