"""Sliding windows: pane + sweep against enumeration and against F.window."""

import random

from pyspark.sql import functions as F

import models
from helpers import frame, tuples
from tidepool.operators.windows import sliding_count, window_count

SCHEMA = "k string, ts_us long, seq long"
SEC = 1_000_000


def _rows(seed, n=300):
    rnd = random.Random(seed)
    base = 1_700_000_000 * SEC
    return [(rnd.choice("aab"), base + rnd.randrange(0, 3 * 3600) * SEC + rnd.randrange(0, SEC), i)
            for i in range(n)]


def test_expanded_equals_enumeration(spark):
    rows = _rows(1)
    got = sliding_count(frame(spark, rows, SCHEMA), ["k"], "10 minutes", "5 seconds", expand=True)
    exp = models.sliding_counts([dict(k=r[0], ts_us=r[1]) for r in rows], ["k"], 600 * SEC, 5 * SEC)
    assert {(r["k"], r["window_end"]): r["cnt"] for r in got.collect()} == exp
    assert got.where(F.col("window_end") - F.col("window_start") != 600_000).count() == 0


def test_change_points_cover_exactly_the_windows(spark):
    rows = _rows(2)
    df = frame(spark, rows, SCHEMA)
    seg = sliding_count(df, ["k"], "1 hour", "5 seconds").collect()
    exp = models.sliding_counts([dict(k=r[0], ts_us=r[1]) for r in rows], ["k"], 3600 * SEC, 5 * SEC)
    got = {}
    for s in seg:
        assert s["end_from"] < s["end_to"] and s["cnt"] > 0
        for e in range(s["end_from"], s["end_to"], 5000):
            got[(s["k"], e)] = s["cnt"]
    assert got == exp
    # adjacent segments of a key never repeat a count (they are maximal)
    by = sorted((s["k"], s["end_from"], s["end_to"], s["cnt"]) for s in seg)
    for a, b in zip(by, by[1:]):
        if a[0] == b[0] and a[2] == b[1]:
            assert a[3] != b[3]


def test_pane_plan_equals_builtin_window(spark):
    rows = _rows(3)
    df = frame(spark, rows, SCHEMA)
    ours = sliding_count(df, ["k"], "1 hour", "5 minutes", expand=True)
    builtin = window_count(df, ["k"], "1 hour", "5 minutes")
    assert tuples(ours, ["k", "window_start", "window_end", "cnt"]) == \
        tuples(builtin, ["k", "window_start", "window_end", "cnt"])


def test_tumbling_window_count(spark):
    rows = [("a", 0, 1), ("a", 3599 * SEC, 2), ("a", 3600 * SEC, 3), ("b", 10, 4)]
    got = window_count(frame(spark, rows, SCHEMA), ["k"], "1 hour")
    assert tuples(got, ["k", "window_end", "cnt"]) == [("a", 3_600_000, 2), ("a", 7_200_000, 1), ("b", 3_600_000, 1)]


def test_empty_input(spark):
    df = frame(spark, [], SCHEMA)
    assert sliding_count(df, ["k"], "1 day", "5 seconds").count() == 0


def test_pane_window_count_equals_builtin(spark):
    from tidepool.operators.windows import pane_window_count
    rows = _rows(4)
    df = frame(spark, rows, SCHEMA)
    cols = ["k", "window_start", "window_end", "cnt"]
    assert tuples(pane_window_count(df, ["k"], "1 hour", "5 minutes"), cols) == \
        tuples(window_count(df, ["k"], "1 hour", "5 minutes"), cols)
