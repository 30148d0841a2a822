"""Whitening against numpy's eigensolver, exact integer deviations, and odd tables."""

import math

import numpy as np
import pytest

from tidepool.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<double>"


def model(rows, components=32):
    """{(id, component): (n, deviation, |whitened|, explained)} and the eigenvalues, by plain integers and eigh."""
    x = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    n, sums = len(x), [sum(col) for col in zip(*[v for _, v in x])]
    y = np.array([[(n * a - s) / n for a, s in zip(v, sums)] for _, v in x])
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1], u[:, ::-1]
    keep = [k for k in range(min(components, len(e))) if e[k] > e[0] * 1e-12]
    z = y @ u[:, keep] / np.sqrt(e[keep])
    dev = [sum((n * a - s) ** 2 for a, s in zip(v, sums)) for _, v in x]
    return {(i, k + 1): (n, dev[r], abs(z[r, k]), e[k] / e.sum()) for r, (i, _) in enumerate(x) for k in keep}


def check(spark, rows, components=32):
    got = wh.whiten(spark.createDataFrame(rows, SCHEMA), components).collect()
    want = model(rows, components)
    assert len(got) == len(want)
    for r in got:
        n, dev, z, share = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, dev if dev < 2 ** 63 else None)
        assert abs(abs(r.whitened) - z) < 1e-6 and abs(r.explained - share) < 1e-9 and r.identity_error < 1e-9
    return got


def cloud(rng, n, width, fall=0.9):
    return [(i, (rng.normal(size=width) * fall ** np.arange(width) + 3).tolist()) for i in range(n)]


def test_like_eigh(spark):
    rng = np.random.default_rng(1)
    rows = cloud(rng, 300, 40) + [(900, None), (901, [1.0, None] * 20), (902, [float("nan")] * 40), (903, [float("inf")] * 40)]
    got = check(spark, rows)
    z = np.zeros((300, 32))
    for r in got:
        z[r.vec_id, r.component - 1] = r.whitened
    assert np.abs(z.T @ z / 300 - np.eye(32)).max() < 1e-9  # one sign for all rows


def test_constant_and_dependent_dimensions(spark):
    rng = np.random.default_rng(2)
    base = [v for _, v in cloud(rng, 60, 5, 0.5)]
    check(spark, [(i, [math.floor(64 * c) / 64 for c in v] + [2.0, math.floor(64 * v[0]) / 64]) for i, v in enumerate(base)])
    check(spark, [(i, v) for i, v in enumerate(base[:3])])
    assert wh.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 5, SCHEMA)).count() == 0
    check(spark, [(i, [float(i % 7)]) for i in range(20)])


def test_equal_variances(spark):
    """A cluster of equal eigenvalues, more than are asked for: any basis, still whitened."""
    width = 40
    rows = [(2 * k + s, [(1.0 - 2 * s) * (j == k) for j in range(width)]) for k in range(width) for s in (0, 1)]
    got = wh.whiten(spark.createDataFrame(rows, SCHEMA), 32).collect()
    z = np.zeros((len(rows), 32))
    for r in got:
        z[r.vec_id, r.component - 1] = r.whitened
    assert len(got) == 32 * len(rows) and np.abs(z.T @ z / len(rows) - np.eye(32)).max() < 1e-9


def test_odd_tables(spark):
    assert wh.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert wh.whiten(spark.createDataFrame([(1, []), (2, None)], SCHEMA)).count() == 0
    rows = [(None, [1.0, 5.0]), (1, [2.0, 3.0]), (1, [2.0, 3.0]), (2, [0.0, 1.0]), (3, [1.0]), (4, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "2 AS n", "'x' AS component", "3 AS vector")
    got = wh.whiten(df).collect()
    assert sorted(str(r.vec_id) for r in got) == sorted(["None", "1", "1", "2"] * 2) and {r.n for r in got} == {4}


def test_huge_entries_do_not_overflow(spark):
    rows = [(i, [1e30 * (-1) ** i, float(i), 1.0]) for i in range(10)]
    got = wh.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert got and all(r.deviation is None and math.isfinite(r.whitened) for r in got)
    rows = [(i, [3e4 * i, float(i % 3)]) for i in range(50)]
    check(spark, rows)


@pytest.mark.parametrize("seed", range(6))
def test_every_interval_is_complete(seed):
    rng = np.random.default_rng(seed)
    size = int(rng.integers(2, 90))
    values = np.sort(np.abs(rng.choice([rng.normal(size=size), rng.integers(1, 5, size).astype(float), 10.0 ** rng.uniform(-9, 3, size)][int(seed % 3)], size)))[::-1] + 1e-3
    u, _ = np.linalg.qr(rng.normal(size=(size, size)))
    v = (u * values) @ u.T
    v = (v + v.T) / 2
    got = []
    for low, high, count in wh.intervals(v, 32):
        e, x = wh.feast(v, low, high, count)
        assert len(e) == count and np.abs(v @ x - x * e).max() < 1e-12 * values[0] * size
        got += e.tolist()
    want = np.linalg.eigvalsh(v)[::-1]
    assert len(got) >= min(32, size) and np.abs(np.array(got) - want[: len(got)]).max() < 1e-12 * values[0] * size


def test_wide_covariance():
    rng = np.random.default_rng(9)
    a = rng.normal(size=(900, 384)) * np.linspace(3, 0.1, 384)
    v = a.T @ a / 900
    got = [e for low, high, n in wh.intervals(v, 32) for e in wh.feast(v, low, high, n)[0]]
    assert np.abs(np.array(got) - np.linalg.eigvalsh(v)[::-1][: len(got)]).max() < 1e-10


def test_query_over_its_whole_table(spark):
    from tidepool.llm import registry
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding").collect()
    want = model([(r.vec_id, [float(c) for c in r.embedding]) for r in table])
    got = registry.op13_whitening(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(want) and max(r.identity_error for r in got) < 1e-9
    for r in got:
        n, dev, z, share = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, dev) and abs(abs(r.whitened) - z) < 1e-6 and abs(r.explained - share) < 1e-9
