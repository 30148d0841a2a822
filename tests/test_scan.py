"""Chunked ordered scans against a direct per-key computation."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import frame, tuples
from tidepool.operators.scan import add_chunk, nearest, running

SCHEMA = "k long, ts_us long, seq long, v long"


def _rows(seed, n=400, keys=4):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = 0 if rnd.random() < 0.5 else rnd.randrange(1, keys)  # key 0 is hot
        v = rnd.choice([None, rnd.randrange(-5, 20)]) if rnd.random() < 0.3 else rnd.randrange(-5, 20)
        rows.append((k, rnd.randrange(0, 50_000), i, v))  # ties on ts broken by seq
    return rows


def _expected(rows, how, inclusive):
    out = {}
    by = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        by.setdefault(r[0], []).append(r)
    for k, rs in by.items():
        acc = None
        for r in rs:
            before = acc
            if r[3] is not None:
                if how == "sum":
                    acc = (acc or 0) + r[3]
                else:
                    acc = r[3] if acc is None else (max if how == "max" else min)(acc, r[3])
            res = acc if inclusive else before
            if how == "sum" and res is None:
                res = 0
            out[r[2]] = res
    return out


@pytest.mark.parametrize("how,inclusive,width", [("sum", True, 1000), ("sum", False, 7000),
                                                 ("max", False, 1000), ("min", True, 300)])
def test_running_matches_direct(spark, how, inclusive, width):
    rows = _rows(7)
    df = add_chunk(frame(spark, rows, SCHEMA), "ts_us", width)
    got = running(df, ["k"], ["ts_us", "seq"], "v", "out", "_chunk", how=how, inclusive=inclusive)
    exp = _expected(rows, how, inclusive)
    assert {r["seq"]: r["out"] for r in got.collect()} == exp


def test_running_without_key(spark):
    rows = _rows(11)
    df = add_chunk(frame(spark, rows, SCHEMA).withColumn("k0", F.lit(0)), "ts_us", 5000)
    got = running(df, [], ["ts_us", "seq"], "v", "out", "_chunk", how="max", inclusive=False)
    exp = _expected([(0, *r[1:]) for r in rows], "max", False)
    assert {r["seq"]: r["out"] for r in got.collect()} == exp


@pytest.mark.parametrize("direction", ["before", "after"])
def test_nearest_non_null(spark, direction):
    rows = _rows(3)
    df = add_chunk(frame(spark, rows, SCHEMA), "ts_us", 2500)
    got = nearest(df, ["k"], ["ts_us", "seq"], "v", "out", "_chunk", direction=direction)
    by = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        by.setdefault(r[0], []).append(r)
    exp = {}
    for rs in by.values():
        seqs = rs if direction == "before" else list(reversed(rs))
        last = None
        for r in seqs:
            exp[r[2]] = last
            if r[3] is not None:
                last = r[3]
    assert {r["seq"]: r["out"] for r in got.collect()} == exp


def test_nearest_struct_is_lag(spark):
    rows = [(1, 10, 1, 5), (1, 10, 2, 6), (1, 99_000, 3, 7), (2, 5, 4, 8)]
    df = add_chunk(frame(spark, rows, SCHEMA).withColumn("s", F.struct("ts_us", "v")), "ts_us", 1000)
    got = nearest(df, ["k"], ["ts_us", "seq"], "s", "prev", "_chunk")
    res = {r["seq"]: (r["prev"]["v"] if r["prev"] else None) for r in got.collect()}
    assert res == {1: None, 2: 5, 3: 6, 4: None}
    assert tuples(got.select("seq"), ["seq"]) == [(1,), (2,), (3,), (4,)]


def test_null_key_is_its_own_group(spark):
    rows = [(None, 10, 1, 1), (None, 5_000, 2, 2), (None, 9_000, 3, 4), (1, 20, 4, 8)]
    df = add_chunk(frame(spark, rows, SCHEMA), "ts_us", 1000)
    got = running(df, ["k"], ["ts_us", "seq"], "v", "out", "_chunk")
    assert {r["seq"]: r["out"] for r in got.collect()} == {1: 1, 2: 3, 3: 7, 4: 8}
