"""Stateful rules (login, orders, click limit, late split) against plain-Python models."""

import random

import pytest

import models
from helpers import frame, tuples
from tidepool.operators import keyed
from tidepool.plans import jobs

SEC = 1_000_000
LOGIN = "user_id long, event_type string, ts_us long, seq long"


def _logins(seed, n=250, users=3, gap=3):
    rnd = random.Random(seed)
    rows, t = [], 1_558_430_800 * SEC
    for i in range(n):
        t += rnd.randrange(0, gap) * SEC  # repeated seconds -> ties broken by seq
        rows.append((rnd.choice([1] * 3 + list(range(2, users + 1))),
                     "fail" if rnd.random() < 0.7 else "success", t, i))
    return rows


def _dicts(rows):
    return [dict(user_id=r[0], event_type=r[1], ts_us=r[2], seq=r[3]) for r in rows]


@pytest.mark.parametrize("seed,gap", [(1, 3), (2, 3), (3, 3), (4, 2), (5, 5), (6, 9)])
def test_fail_bursts_match_model(spark, seed, gap):
    rows = _logins(seed, n=500, gap=gap)  # segments short and long, over many bucket borders
    got = keyed.fail_bursts(frame(spark, rows, LOGIN), "user_id", 2 * SEC, 2)
    assert tuples(got, ["user_id", "first_fail_ms", "last_fail_ms", "fail_count"]) == \
        models.fail_bursts(_dicts(rows), 2 * SEC)


def test_fail_bursts_long_chain_needs_many_rounds(spark):
    # one user failing every second for 200 s: 67 bursts of 3 in one run
    rows = [(7, "fail", 1_000 * SEC + i * SEC, i) for i in range(200)] + [(7, "success", 1_199 * SEC, 999)]
    got = keyed.fail_bursts(frame(spark, rows, LOGIN), "user_id", 2 * SEC, 2)
    exp = models.fail_bursts(_dicts(rows), 2 * SEC)
    assert tuples(got, ["user_id", "first_fail_ms", "last_fail_ms", "fail_count"]) == exp
    assert len(exp) == 66  # the last burst (1197..1199) is cancelled by the success at 1199 s


def test_fail_burst_message_and_cancel(spark):
    rows = [(1, "fail", 10 * SEC, 1), (1, "fail", 11 * SEC, 2), (1, "fail", 12 * SEC, 3),   # closes at 12 s
            (2, "fail", 10 * SEC, 4), (2, "fail", 11 * SEC, 5), (2, "success", 12 * SEC, 6),  # cancelled
            (3, "fail", 10 * SEC, 7), (3, "fail", 11 * SEC, 8), (3, "success", 13 * SEC, 9)]  # after deadline
    got = keyed.fail_bursts(frame(spark, rows, LOGIN), "user_id", 2 * SEC, 2)
    assert tuples(got, ["user_id", "fail_count", "msg"]) == [
        (1, 3, "login fail in 2s for 3 times. "), (3, 2, "login fail in 2s for 2 times. ")]


@pytest.mark.parametrize("seed", [4, 5])
def test_consecutive_fails_match_model(spark, seed):
    rows = _logins(seed)
    got = keyed.consecutive_fails(frame(spark, rows, LOGIN), "user_id", 2 * SEC)
    assert tuples(got, ["user_id", "first_fail_ms", "last_fail_ms"]) == \
        models.consecutive_fails(_dicts(rows), 2 * SEC)


def test_consecutive_fails_in_arrival_order(spark):
    # arrival order differs from time order; a negative gap also warns
    rows = [(1, "fail", 20 * SEC, 1, 1), (1, "fail", 15 * SEC, 2, 2), (1, "success", 16 * SEC, 3, 3),
            (1, "fail", 30 * SEC, 4, 4), (1, "fail", 32 * SEC, 5, 5)]
    df = frame(spark, rows, LOGIN + ", arrival_us long")
    got = keyed.consecutive_fails(df, "user_id", 2 * SEC, order=("arrival_us", "seq"))
    assert tuples(got, ["first_fail_ms", "last_fail_ms", "msg"]) == [(20_000, 15_000, "login fail 2 times in 2s")]


@pytest.mark.parametrize("seed", [6, 7])
def test_login_pattern_matches_model(spark, seed):
    rows = _logins(seed)
    got = jobs.login_fail_pattern(frame(spark, rows, LOGIN), "2 seconds")
    assert tuples(got, ["user_id", "first_fail_ms", "last_fail_ms"]) == \
        models.next_fail_pairs(_dicts(rows), 2 * SEC)


ORDER = "order_id long, event_type string, tx_id string, ts_us long, seq long"


def test_order_status_all_outcomes(spark):
    rows = [(1, "create", "", 0, 1), (1, "pay", "a", 899 * SEC, 2),            # paid just in time
            (2, "create", "", 0, 3), (2, "pay", "b", 900 * SEC, 4),            # exactly 15 min -> timeout
            (3, "pay", "c", 5 * SEC, 5),                                       # no create
            (4, "create", "", 0, 6),                                           # no pay
            (5, "pay", "e", 1 * SEC, 7), (5, "create", "", 2 * SEC, 8),        # pay before create
            (6, "create", "", 0, 9), (6, "create", "", 10 * SEC, 10), (6, "pay", "f", 5 * SEC, 11),
            (6, "pay", "f", 5 * SEC, 12)]                                      # duplicates
    df = frame(spark, rows, ORDER)
    got = jobs.order_pay_status(df, "15 minutes")
    exp = models.order_status([dict(order_id=r[0], event_type=r[1], ts_us=r[3], seq=r[4]) for r in rows],
                              900 * SEC)
    assert tuples(got, ["order_id", "result"]) == exp
    assert dict(exp)[2] == "payed but already timeout" and dict(exp)[5] == "payed successfully"


def test_order_pattern_matches_and_timeouts(spark):
    rows = [(1, "create", "", 0, 1), (1, "pay", "a", 899 * SEC, 2),
            (2, "create", "", 0, 3), (2, "pay", "b", 900 * SEC, 4),
            (3, "pay", "c", 5 * SEC, 5),
            (4, "create", "", 0, 6),
            (7, "create", "", 0, 7), (7, "create", "", 60 * SEC, 8), (7, "pay", "g", 120 * SEC, 9),
            (8, "create", "", 10 * SEC, 11), (8, "pay", "h", 10 * SEC, 10)]   # pay sorts before create (seq)
    paid, timeouts = jobs.order_timeout_pattern(frame(spark, rows, ORDER), "15 minutes")
    assert tuples(paid, ["order_id", "create_ms", "pay_ms"]) == [(1, 0, 899_000), (7, 0, 120_000),
                                                                 (7, 60_000, 120_000)]
    assert tuples(timeouts, ["order_id", "result"]) == [(2, "timeout : +900000"), (4, "timeout : +900000"),
                                                        (8, "timeout : +910000")]


CLICK = "user_id long, ad_id long, province string, ts_us long, seq long"


def test_click_limit_per_local_day(spark):
    day = 86_400 * SEC
    # local day in UTC+8 starts at 16:00 UTC
    rows = [(1, 9, "bj", 15 * 3600 * SEC + i, i) for i in range(5)] + \
           [(1, 9, "bj", 16 * 3600 * SEC + i, 10 + i) for i in range(2)] + \
           [(2, 9, "sh", day + i, 20 + i) for i in range(3)]
    passed, warnings = keyed.click_limit(frame(spark, rows, CLICK), ["user_id", "ad_id"], 3, "Asia/Shanghai")
    assert passed.count() == 3 + 2 + 3
    assert tuples(warnings, ["user_id", "day", "msg"]) == [(1, "1970-01-01", "Click ad over 3 times today.")]


def test_split_late_rule(spark):
    cols = "url string, method string, ts_us long, seq long, arrival_us long"
    # arrivals: a far-ahead row pushes the watermark; an old row then is late
    rows = [("/a", "GET", 1000 * SEC, 1, 1), ("/a", "GET", 2000 * SEC, 2, 2),
            ("/a", "GET", 1000 * SEC + 5, 3, 3),          # newest window end 1600 s + 60 s <= 1999 s -> late
            ("/a", "GET", 1400 * SEC, 4, 4)]              # 2000 s - 1 ms + 60 s > 1999 s -> on time
    on_time, late = jobs.late_pages(frame(spark, rows, cols))
    assert tuples(late, ["event_id"]) == [(3,)]
    assert tuples(on_time, ["event_id", "watermark_ms"]) == [(1, None), (2, 999_000), (4, 1_999_000)]


def test_salted_and_plain_page_views_agree(spark):
    rnd = random.Random(9)
    rows = [(1, "pv", rnd.randrange(0, 10 * 3600) * SEC, i) for i in range(500)]
    ub = frame(spark, rows, "user_id long, behavior string, ts_us long, seq long")
    assert tuples(jobs.page_views(ub)) == tuples(jobs.page_views_salted(ub, 7))


def test_fail_bursts_with_identical_records(spark):
    # repeated lines are separate events even with the same tie-break value
    rows = [(1, "fail", 59 * SEC, 0), (1, "fail", 62 * SEC, 0), (1, "fail", 62 * SEC, 0),
            (1, "fail", 63 * SEC, 0), (1, "fail", 64 * SEC, 0), (1, "fail", 65 * SEC, 0)]
    got = keyed.fail_bursts(frame(spark, rows, LOGIN), "user_id", 2 * SEC, 2)
    assert tuples(got, ["first_fail_ms", "last_fail_ms", "fail_count"]) == [(62_000, 64_000, 4)]


def test_hot_pages_can_leave_out_late_rows(spark):
    cols = "url string, method string, ts_us long, seq long, arrival_us long"
    rows = [("/a", "GET", 1000 * SEC, 1, 1), ("/b", "GET", 2000 * SEC, 2, 2),
            ("/a", "GET", 1000 * SEC + 5, 3, 3)]            # late: never counted by a stream
    log = frame(spark, rows, cols)
    every = jobs.hot_pages(log, 3)
    on_time = jobs.hot_pages(log, 3, drop_late=True)
    assert max(r["cnt"] for r in every.where("url = '/a'").collect()) == 2
    assert max(r["cnt"] for r in on_time.where("url = '/a'").collect()) == 1


@pytest.mark.parametrize("tied", [False, True])
def test_hot_minute_is_cut(spark, tied):
    """All rows in one minute, or at one time stamp: no chunk keeps more than a few times the limit, results stay."""
    from pyspark.sql import functions as F
    from tidepool.operators.scan import add_arrival_chunk
    rnd = random.Random(40)
    rows = [("/a", "GET", rnd.randrange(0, 4000) * SEC, i, 60 * SEC + (0 if tied else i * 20_000)) for i in range(2500)]
    df = frame(spark, rows, "url string, method string, ts_us long, seq long, arrival_us long")
    chunked, order = add_arrival_chunk(df, 60 * SEC, limit=100)
    assert order == ["arrival_us", "seq"]
    sizes = [r["count"] for r in chunked.groupBy("_chunk").count().collect()]
    assert len(sizes) > 20 and max(sizes) <= 200
    assert [r.seq for r in chunked.orderBy("_chunk", *order).select("seq").collect()] == [r[3] for r in rows]
    on_time, late = keyed.split_late(df, limit=100)
    plain_on, plain_late = keyed.split_late(df)
    assert tuples(late, ["seq", "watermark_us"]) == tuples(plain_late, ["seq", "watermark_us"]) and late.count() > 100
    assert on_time.count() == plain_on.count()


def test_running_distinct_in_a_hot_hour(spark):
    from tidepool.operators.aggs import running_distinct
    rnd = random.Random(41)
    rows = [(1, rnd.randrange(200), 5 * SEC if i % 2 else rnd.randrange(0, 3600) * SEC, i) for i in range(1500)]
    df = frame(spark, rows, "w long, user_id long, ts_us long, seq long")
    cut = running_distinct(df, ["w"], "user_id", "seq", limit=50)
    seen, expect = set(), []
    for r in sorted(rows, key=lambda r: (r[2], r[3])):
        seen.add(r[1])
        expect.append((r[3], len(seen)))
    assert tuples(cut, ["seq", "uv"]) == sorted(expect)


@pytest.mark.parametrize("gap_us,hits", [(2 * SEC - 1, 1), (2 * SEC, 0)])
@pytest.mark.parametrize("start", [0, 59 * SEC, 60 * SEC - 1, 60 * SEC - 1_500_000, 8 * SEC - 1])
def test_patterns_at_exactly_within_and_over_bucket_borders(spark, gap_us, hits, start):
    rows = [(1, "fail", start, 1), (1, "fail", start + gap_us, 2), (2, "success", start, 3), (2, "fail", start + 1, 4)]
    assert jobs.login_fail_pattern(frame(spark, rows, LOGIN), "2 seconds").count() == hits
    orders = [(1, "create", "", start, 1), (1, "pay", "a", start + gap_us, 2), (1, "pay", "a", start + gap_us + 1, 3)]
    paid, timeouts = jobs.order_timeout_pattern(frame(spark, orders, ORDER), "2 seconds")
    assert (paid.count(), timeouts.count()) == (hits, 1 - hits)


def test_hll_error_bound(spark):
    """Above the size up to which the sketch is exact the estimate stays near the count."""
    from tidepool.operators.aggs import distinct_hll
    df = spark.range(60_000).selectExpr("id % 2 AS w", "id AS user_id")
    for r in distinct_hll(df, ["w"], "user_id").collect():
        assert 0 < abs(r.uv - 30_000) < 0.05 * 30_000 or r.uv == 30_000
