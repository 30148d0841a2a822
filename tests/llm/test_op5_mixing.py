"""Mixing: targets against a plain loop, and the properties of the cube method."""

import random
from collections import Counter, defaultdict

import pytest

from tidepool.llm import mixing as mx


def slow_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    names = sorted([s for s in sizes if s is not None]) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, stopped, left = dict.fromkeys(names, 0.0), set(), share * sum(sizes.values())
    while left > 1e-9 and len(stopped) < len(names):
        active = sum(w[s] for s in names if s not in stopped)
        give = {s: left * w[s] / active for s in names if s not in stopped}
        left = 0.0
        for s, g in give.items():
            target[s] += g
            if target[s] > cap * sizes[s]:
                left += target[s] - cap * sizes[s]
                target[s] = cap * sizes[s]
                stopped.add(s)
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {s: rng.choice([0, 3, 50, 1000, 100_000]) for s in ["a", "B", "é", "z", "\U0001F600", "￮", None][: 3 + 2 * seed]}
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mx.source_targets(df, per_task=2).collect()}
    for s, t in slow_targets(sizes).items():
        assert got[s] == pytest.approx(t, abs=1e-6)


def test_flight_keeps_totals():
    rng = random.Random(9)
    units = [((0,), rng.getrandbits(63), float(rng.randint(0, 900)), rng.random()) for _ in range(4000)]
    done = dict(mx.flight(iter(units), True, 0))
    assert set(done.values()) == {0.0, 1.0} and len(done) == len(units)
    words = sum(x * u[2] for u, x in zip(units, map(done.get, range(len(units)))))
    assert abs(words - sum(u[2] * u[3] for u in units)) <= 900
    assert abs(sum(done.values()) - sum(u[3] for u in units)) <= 2
    open_ = dict(mx.flight(iter(units), False, 0))
    assert sum(0 < x < 1 for x in open_.values()) <= 2
    assert sum(x * u[2] for u, x in zip(units, map(open_.get, range(len(units))))) == pytest.approx(sum(u[2] * u[3] for u in units))


def test_inclusion_follows_the_fraction():
    taken = Counter()
    for trial in range(300):
        units = [(0, hash((trial, i)) & (2**63 - 1), float(i % 5), 0.3) for i in range(30)]
        for i, x in mx.flight(iter(units), True, trial):
            taken[i] += x
    assert all(45 <= taken[i] <= 140 for i in range(30))


def rows(seed, n):
    rng = random.Random(seed)
    return [(i, None if rng.random() < 0.02 else " ".join(["w"] * rng.choice([0, 1, 5, 40, 200])), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(n)]


@pytest.mark.parametrize("block,fan", [(50_000, 1024), (40, 2)])
def test_mix(spark, block, fan):
    data = rows(3, 600)
    df = spark.createDataFrame([(*r, 1, 2) for r in data], "doc_id long, text string, source string, SIZE int, key int").repartition(5)
    got = mx.mix(df, block=block, fan=fan)
    assert got.columns == ["doc_id", "text", "source", "key", "size", "source_size", "target", "copies", "taken"]
    found = got.collect()
    assert sorted(r.doc_id for r in found) == list(range(600))
    sizes = defaultdict(int)
    for r in found:
        assert r.size == len((r.text or "").split()) and r.taken == r.size * r.copies and 0 <= r.copies <= 2
        sizes[r.source] += r.size
    target = slow_targets(dict(sizes))
    for s in sizes:
        mine = [r for r in found if r.source == s]
        assert all(r.source_size == sizes[s] and r.target == pytest.approx(target[s]) for r in mine)
        assert abs(sum(r.taken for r in mine) - target[s]) <= 200
        assert abs(sum(r.copies for r in mine) - len(mine) * target[s] / sizes[s]) <= 2.01
    again = mx.mix(df.repartition(2), block=block, fan=fan).select("doc_id", "copies").collect()
    assert {r.doc_id: r.copies for r in again} == {r.doc_id: r.copies for r in found}


def test_edge_tables(spark):
    schema = "doc_id long, text string, source string"
    assert mx.mix(spark.createDataFrame([], schema)).collect() == []
    nothing = mx.mix(spark.createDataFrame([(1, None, "a"), (None, "", None)], schema)).collect()
    assert sorted((r.size, r.taken, r.target) for r in nothing) == [(0, 0, 0.0)] * 2
    same = mx.mix(spark.createDataFrame([(1, "w " * 10, "a")] * 40 + [(2, "v " * 3, "b")] * 10, schema)).collect()
    for s, n in (("a", 40), ("b", 10)):
        mine = [r for r in same if r.source == s]
        assert len(mine) == n and abs(sum(r.taken for r in mine) - mine[0].target) <= 10
    long = mx.mix(spark.createDataFrame([(1, "w " * 300_000, "a"), (2, "x", "a")], schema)).collect()
    assert max(r.size for r in long) == 300_000


def test_a_third_of_all_rows_is_one_row(spark):
    """Copies of a repeated row are dealt among its rows, numbered by place and not in one task."""
    data = rows(5, 400) + [(7, "w " * 9, "b")] * 200
    df = spark.createDataFrame(data, "doc_id long, text string, source string").repartition(9)
    found = mx.mix(df).collect()
    assert len(found) == 600
    for s in {r[2] for r in data}:
        mine = [r for r in found if r.source == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 200
    hot = [r.copies for r in found if r.doc_id == 7 and r.source == "b" and r.size == 9]
    assert len(hot) == 200 and max(hot) - min(hot) <= 1
    from tidepool.llm.scratch import cut
    numbered = mx._numbered(cut(df.selectExpr("source AS key", "doc_id"), "numbers"), ["key"], "n").collect()
    for s in {r[2] for r in data if r[2]}:
        assert sorted(r.n for r in numbered if r.key == s) == list(range(1, 1 + sum(r[2] == s for r in data)))
