"""Patterns of several steps against a matcher that walks every begin row, cold and cut into chunks."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import frame
from tidepool.operators.pattern import Pattern, match_sequence

SCHEMA = "user_id long, ts_us long, seq long, kind string"


def model(rows, steps, within):
    """steps: (kinds, strict). Returns (matches, timeouts) as tuples of seqs per begin row."""
    by_key = {}
    for r in rows:
        if r[1] is not None:
            by_key.setdefault(r[0], []).append(r)
    matches, timeouts = [], []
    for key, evs in by_key.items():
        evs.sort(key=lambda r: (r[1], r[2]))
        for i, e in enumerate(evs):
            if e[3] not in steps[0][0]:
                continue
            taken, fate = [e[2]], "pending" if len(steps) > 1 else "match"
            for f in evs[i + 1:]:
                if fate != "pending" or f[1] - e[1] >= within:
                    break
                kinds, strict = steps[len(taken)]
                if f[3] in kinds:
                    taken.append(f[2])
                    fate = "match" if len(taken) == len(steps) else "pending"
                elif strict:
                    fate = "failed"
            if fate == "match":
                matches.append((key, *taken))
            elif fate == "pending":
                timeouts.append((key, *taken, *[None] * (len(steps) - len(taken)), e[1] + within))
    return sorted(matches, key=str), sorted(timeouts, key=str)


def pattern_of(steps, within):
    p = Pattern.begin("s1", F.col("kind").isin(*steps[0][0]))
    for n, (kinds, strict) in enumerate(steps[1:], 2):
        p = (p.next if strict else p.followed_by)(f"s{n}", F.col("kind").isin(*kinds))
    return p.within(f"{within} microseconds")


def got(spark, rows, steps, within, **how):
    matches, timeouts = match_sequence(frame(spark, rows, SCHEMA), ["user_id"], pattern_of(steps, within), **how)
    names = [f"s{n}" for n in range(1, len(steps) + 1)]
    seqs = [F.col(f"{n}.seq").alias(n) for n in names]
    return (sorted(map(tuple, matches.select("user_id", *seqs).collect()), key=str),
            sorted(map(tuple, timeouts.select("user_id", *seqs, "timeout_us").collect()), key=str))


def stream(rng, n, users=3, span=400_000_000, ties=False):
    out = []
    for seq in range(n):
        ts = rng.choice([0, 50_000_000, 240_000_000]) if ties and rng.random() < 0.6 else rng.randrange(span)
        out.append((rng.choice([None, *range(users)]), None if rng.random() < 0.02 else ts, seq, rng.choice(["a", "b", "c", None])))
    return out


PATTERNS = [
    [(("a",), False)],
    [(("a",), False), (("a",), True)],
    [(("a",), False), (("b",), False)],
    [(("a",), False), (("a", "b"), True), (("c",), False)],
    [(("a",), False), (("b",), False), (("b",), True)],
    [(("a", "b"), False), (("b",), False), (("a",), True), (("c",), False)],
    [(("a",), False), (("a",), False), (("a",), False), (("a",), False)],
    [(("c",), False), (("a",), True), (("a", "b"), True), (("c", "b"), True)],
]


@pytest.mark.parametrize("steps", PATTERNS)
def test_like_a_walk(spark, steps):
    rng = random.Random(len(steps))
    rows = stream(rng, 220)
    for within in (1, 9_000_000, 70_000_000):
        assert got(spark, rows, steps, within) == model(rows, steps, within)


@pytest.mark.parametrize("steps", PATTERNS[1:])
def test_hot_buckets_are_cut(spark, steps):
    """A limit of 12 rows: most buckets are cut by time, bulk loads of one time stamp by their order."""
    rng = random.Random(40 + len(steps))
    rows = stream(rng, 260, users=2, ties=True)
    assert got(spark, rows, steps, 70_000_000, limit=12) == model(rows, steps, 70_000_000)
    one_time = [(1, 5_000_000, s, rng.choice("abc")) for s in range(150)] + [(2, 5_000_000 + s, s, rng.choice("abc")) for s in range(1000, 1030)]
    assert got(spark, one_time, steps, 1000, limit=12) == model(one_time, steps, 1000)


def test_no_task_holds_a_hot_key(spark):
    """A third of all rows with one key and a time stamp in common: chunks of bounded length, and the pattern crosses them."""
    rows = [(1, 1_000_000, s, "b") for s in range(3000)] + [(1, 999_999, 5000, "a"), (1, 1_000_001, 5001, "c")] + [(k, 1_000_000 * k, 9000 + k, "a") for k in range(2, 200)]
    steps = [(("a",), False), (("c",), False)]
    assert got(spark, rows, steps, 1000, limit=100)[0] == [(1, 5000, 5001)]


def test_payload_and_several_keys(spark):
    df = frame(spark, [(1, 1_000_000, 1, "a"), (1, 2_000_000, 2, "b")], SCHEMA).withColumn("where", F.lit("x")).withColumn("k2", F.lit(None).cast("string"))
    p = Pattern.begin("one", F.col("kind") == "a").next("two", F.col("kind") == "b").within("5 seconds")
    m, t = match_sequence(df, ["user_id", "k2"], p, payload=["where", "kind"])
    assert [(r.user_id, r.k2, r.one["where"], r.two["kind"], r.two["ts_us"]) for r in m.collect()] == [(1, None, "x", "b", 2_000_000)] and t.count() == 0
    assert match_sequence(df.where("false"), ["user_id"], p)[0].count() == 0


def test_misuse():
    with pytest.raises(ValueError):
        Pattern.begin("a", F.lit(True)).next("a", F.lit(True))
    with pytest.raises(ValueError):
        match_sequence(None, [], Pattern.begin("a", F.lit(True)))
