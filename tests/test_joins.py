"""Interval joins with time buckets against a nested-loop reference."""

import random

import pytest

import models
from helpers import frame, tuples
from tidepool.operators.joins import interval_join, match_two_streams
from tidepool.plans import jobs

SEC = 1_000_000


def _side(seed, n, prefix):
    rnd = random.Random(seed)
    return [(rnd.choice(["hot"] * 5 + ["a", "b", None]), rnd.randrange(0, 120) * SEC + rnd.randrange(3), i)
            for i in range(n)]


@pytest.mark.parametrize("lower,upper", [(-3, 5), (0, 0), (2, 9), (-10, -4)])
def test_interval_join_equals_nested_loop(spark, lower, upper):
    left, right = _side(1, 150, "l"), _side(2, 150, "r")
    L = frame(spark, left, "tx string, l_us long, lid long")
    R = frame(spark, right, "tx string, r_us long, rid long")
    got = interval_join(L, R, ["tx"], lower * SEC, upper * SEC, "inner", "l_us", "r_us")
    exp = models.interval_pairs([dict(tx=a, ts_us=t, id=i) for a, t, i in left],
                                [dict(tx=a, ts_us=t, id=i) for a, t, i in right], "tx", lower * SEC, upper * SEC)
    assert tuples(got, ["lid", "rid"]) == exp


def test_split_outputs_partition_both_sides(spark):
    left, right = _side(3, 120, "l"), _side(4, 120, "r")
    L = frame(spark, left, "tx string, l_us long, lid long")
    R = frame(spark, right, "tx string, r_us long, rid long")
    both, lonely_r = match_two_streams(L, R, ["tx"], -3 * SEC, 5 * SEC, "l_us", "r_us")
    m, lonely_l = both.where("rid IS NOT NULL"), both.where("rid IS NULL")
    pairs = models.interval_pairs([dict(tx=a, ts_us=t, id=i) for a, t, i in left],
                                  [dict(tx=a, ts_us=t, id=i) for a, t, i in right], "tx", -3 * SEC, 5 * SEC)
    assert tuples(m, ["lid", "rid"]) == pairs
    assert {r[0] for r in tuples(lonely_l, ["lid"])} == {i for *_, i in left} - {p[0] for p in pairs}
    assert {r[0] for r in tuples(lonely_r, ["rid"])} == {i for *_, i in right} - {p[1] for p in pairs}


def test_tx_match_edges(spark):
    orders = [(1, "pay", "t1", 100 * SEC, 1), (2, "pay", "t2", 100 * SEC, 2), (3, "pay", "t3", 100 * SEC, 3),
              (4, "pay", "t4", 100 * SEC, 4), (5, "create", "", 90 * SEC, 5)]
    receipts = [("t1", "wechat", 97 * SEC, 11),       # -3 s: edge, matched
                ("t2", "alipay", 105 * SEC, 12),      # +5 s: edge, matched
                ("t3", "alipay", 96 * SEC, 13),       # -4 s: one past
                ("t4", "wechat", 106 * SEC, 14),      # +6 s: one past
                ("t9", "wechat", 100 * SEC, 15)]      # no pay
    O = frame(spark, orders, "order_id long, event_type string, tx_id string, ts_us long, seq long")
    R = frame(spark, receipts, "tx_id string, pay_channel string, ts_us long, seq long")
    m, up, ur = jobs.tx_match(O, R)
    assert tuples(m, ["tx_id", "pay_event_id", "receipt_event_id"]) == [("t1", 1, 11), ("t2", 2, 12)]
    assert tuples(up, ["tx_id"]) == [("t3",), ("t4",)]
    assert tuples(ur, ["tx_id"]) == [("t3",), ("t4",), ("t9",)]
    assert tuples(jobs.tx_match_join(O, R), ["tx_id"]) == [("t1",), ("t2",)]
