"""Greedy bursts by composed chunk functions against a walk over each key's events."""

import random

import models
import pytest

from helpers import frame, tuples
from tidepool.operators import bursts, keyed

LOGIN = "user_id long, event_type string, ts_us long, seq long"
SEC = 1_000_000


def events(rng, n, users, gap, ok=0.2):
    now, out = {}, []
    for seq in range(n):
        u = rng.choice(users)
        now[u] = now.get(u, 10 * SEC) + rng.choice([0, 0, 1, rng.randrange(gap)])
        out.append((u, "ok" if rng.random() < ok else "fail", now[u], seq))
    return out


def check(spark, rows, within, **how):
    got = keyed.fail_bursts(frame(spark, rows, LOGIN), "user_id", within, 2, **how)
    want = models.fail_bursts([dict(zip(("user_id", "event_type", "ts_us", "seq"), r)) for r in rows], within)
    assert tuples(got, ["user_id", "first_fail_ms", "last_fail_ms", "fail_count"]) == sorted(want)
    return want


@pytest.mark.parametrize("seed", range(6))
def test_like_a_walk(spark, seed):
    rng = random.Random(seed)
    rows = events(rng, 400, [1, 2, 3], rng.choice([SEC, 5 * SEC]), rng.choice([0, 0.05, 0.4]))
    assert check(spark, rows, 2 * SEC)


@pytest.mark.parametrize("seed", range(6))
def test_chunks_shorter_than_a_burst(spark, seed):
    """Chunks of a few rows: deadlines reach over several chunks, cancelling successes come chunks later."""
    rng = random.Random(50 + seed)
    rows = events(rng, 500, [1, 2], rng.choice([SEC // 2, 2 * SEC]), rng.choice([0.02, 0.1, 0.3]))
    check(spark, rows, 5 * SEC, limit=4)


def test_one_user_with_a_third_of_all_rows(spark):
    """An endless run of fails without a gap or a success is cut like any other."""
    rng = random.Random(3)
    hot = [(7, "fail", 100 * SEC + i * 300_000, i) for i in range(3000)]
    rest = events(rng, 3000, list(range(100, 140)), 5 * SEC)
    rows = hot + [(u, k, t, 10_000 + s) for u, k, t, s in rest]
    assert len([w for w in check(spark, rows, 2 * SEC, limit=100) if w[0] == 7]) == 429
    sizes = bursts.add_split_chunk(frame(spark, rows, LOGIN), ["user_id"], "ts_us", "seq", 90 * bursts.DAY_US, limit=100).groupBy("user_id", "_chunk").count()
    assert max(r["count"] for r in sizes.collect()) <= 100


def test_bulk_load_of_one_time_stamp(spark):
    rows = [(1, "fail", 5 * SEC, s) for s in range(1000)] + [(1, "ok", 5 * SEC, 2000), (1, "fail", 6 * SEC, 2001), (1, "fail", 7 * SEC, 2002)]
    check(spark, rows, 2 * SEC, limit=50)


def test_groups_come_whole():
    import pyarrow as pa
    table = pa.table({"k": [1] * 5 + [2] * 30 + [3] + [None] * 4, "c": [{"a": 0}] * 20 + [{"a": 1}] * 20})
    for rows in (1, 7, 100):
        got = list(bursts.whole_groups(iter(table.to_batches(max_chunksize=3)), ["k", "c"], rows))
        assert pa.concat_tables([t for t, _ in got]).combine_chunks().equals(table) and sum(len(s) for _, s in got) == 5
