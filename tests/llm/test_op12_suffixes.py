"""Repeated passages against every window of every text in a dictionary."""

import random
from collections import Counter

import numpy as np
import pytest

from tidepool.llm import registry
from tidepool.llm import suffix_dedup as sd


def model(texts, length):
    """(bytes, removed, spans, kept) per text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i: i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - length + 1):
            if seen[d[i: i + length]] > 1:
                gone[i: i + length] = True
        gone[-1] = False
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-1]])[: len(d)]).sum())
        out.append((len(d), int(gone.sum()), spans, bytes(b for b, g in zip(d, gone) if not g)))
    return out


def run(spark, texts, length):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in sd.drop_repeats(df, length).collect()}
    return [got[i] for i in range(len(texts))]


def words(rng, n):
    return "".join(rng.choice("abcdefgh éß日 ") for _ in range(n))


def corpus(rng, length, n=40):
    shared = [words(rng, rng.randrange(length // 2, 3 * length)) for _ in range(6)]
    texts = []
    for _ in range(n):
        t = words(rng, rng.randrange(0, 3 * length))
        for _ in range(rng.randrange(3)):
            s = rng.choice(shared)
            a = rng.randrange(len(s))
            t = t[: rng.randrange(len(t) + 1)] + s[a: a + rng.randrange(1, 2 * length)] + t[rng.randrange(len(t) + 1):]
        texts.append(t)
    for _ in range(n // 3):  # near copies
        t = list(rng.choice(texts))
        for _ in range(rng.randrange(3)):
            if t:
                t[rng.randrange(len(t))] = rng.choice("xyz")
        texts.append("".join(t))
    return [*texts, None, "", "x" * (3 * length), "ab" * (2 * length), "y" * (length + 1), "z" * length, texts[0], texts[0]]


@pytest.mark.parametrize("length, seed", [(20, 1), (50, 2), (100, 3), (400, 4)])
def test_like_all_windows(spark, length, seed):
    texts = corpus(random.Random(seed), length)
    assert run(spark, texts, length) == model(texts, length)


def test_many_tasks_and_frequent_keys(spark, monkeypatch):
    """Splitters, keys that equal them and small pieces give the same rows: the driver side is told of tiny tasks."""
    rng = random.Random(9)
    hot = words(rng, 130)
    texts = corpus(rng, 100, 60) + [words(rng, 40) + hot[rng.randrange(10):] + words(rng, 40) for _ in range(120)]
    monkeypatch.setattr(sd, "PER_TASK", 300)
    assert run(spark, texts, 100) == model(texts, 100)


@pytest.mark.parametrize("length", [20, 50, 100, 400, 1000])
def test_cover_and_depths(length):
    period, depths = sd.plan(length)
    cover = set(sd.COVERS[period])
    assert all(any((a + s) % period in cover and (b + s) % period in cover for s in range(period)) for a in range(period) for b in range(period))
    assert depths[0] == period and depths[-1] <= length - period + 1 < depths[-1] + period
    for a, b in zip(depths, depths[1:]):
        near = sd.triple(a, b)
        assert all(d % period == 0 for d in near) and near[-1] + a == b and max(np.diff(near)) <= a


def test_blocks_hold_every_window_once():
    rng = random.Random(3)
    texts = [t.encode() for t in (words(rng, 900), "", "q" * 1500, words(rng, 99), words(rng, 2000), "ab" * 700)]
    ends = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    start, count, gram, many = sd.blocks(np.frombuffer(b"".join(texts), np.uint8), ends, 100)
    inside = sorted(i for s, n in zip(start.tolist(), count.tolist()) for i in range(s, s + n))
    assert inside == [i for a, z in zip(ends, ends[1:]) for i in range(a, z - 99)]
    assert many.any() and len(gram) == len(start)


def test_long_text_in_pieces(spark):
    rng = random.Random(4)
    base = words(rng, 900_000)
    texts = [base, base[5000:700_000] + "!" + base[700_000:], "nothing shared"]
    got = run(spark, texts, 400)
    kept = [t.encode() for t in texts]
    one, two = len(base[:5000].encode()), len(base[:700_000].encode())
    assert got[0][:3] == (len(kept[0]), len(kept[0]) - one, 1) and got[0][3] == kept[0][:one]
    assert got[1][:3] == (len(kept[1]), len(kept[1]) - 1, 2) and got[1][3] == b"!" and got[2][1:3] == (0, 0)
    assert two > one


def test_odd_tables_and_columns(spark):
    assert sd.drop_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    rows = [(1, "k" * 30), (1, "k" * 30), (None, None), (2, "short")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS k1", "2 AS _k1", "3 AS row", "4 AS start", "5 AS kept", "6 AS gram")
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept), r.k1, r._k1, r.row, r.gram) for r in sd.drop_repeats(df, 25).collect())
    assert got == [("1", 30, 30, 1, b"", 1, 2, 3, 6)] * 2 + [("2", 5, 0, 0, b"short", 1, 2, 3, 6), ("None", 0, 0, 0, b"", 1, 2, 3, 6)]


def test_query_over_its_whole_table(spark):
    import hashlib
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want = {d.doc_id: m for d, m in zip(docs, model([d.text for d in docs], 400))}
    for r in registry.op12_suffix_dedup(spark, "/root/testdata/sf0.001").collect():
        n, removed, spans, kept = want[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (n, removed, spans, hashlib.sha256(kept).hexdigest())


def test_frequent_samples_like_others():
    """Windows before samples of frequent names: alone as the merge by sorting finds them, and in parts once their keys meet."""
    rng = np.random.default_rng(6)
    n, before = 400, 12
    names, near = rng.integers(1, 4, n).astype(np.uint64), rng.integers(0, 2, (n, before + 13)).astype(np.uint8)
    low, high, idx = rng.integers(0, 4, n).astype(np.uint8), rng.integers(3, before + 1, n).astype(np.uint8), np.arange(n) * 7
    least, most = sd._mark(names, near, low, high, before)
    (found, lo, hi), (places, dist, keys) = sd._frequent(idx, names, near, low, high, before)
    assert found.tolist() == idx[most >= 0].tolist() and lo.tolist() == least[most >= 0].tolist() and hi.tolist() == most[most >= 0].tolist()
    met = {}
    for part in (slice(0, 150), slice(150, n)):
        (found, lo, hi), (places, dist, keys) = sd._frequent(idx[part], names[part], near[part], low[part], high[part], before)
        for i, a, z in zip(found.tolist(), lo.tolist(), hi.tolist()):
            met.setdefault(i, set()).update((a, z))
        for p, s, k in zip(places.tolist(), dist.tolist(), map(tuple, keys.tolist())):
            met.setdefault(k, []).append((p, s))
    for key, members in [(k, v) for k, v in met.items() if isinstance(k, tuple) and len(v) > 1]:
        for p, s in members:
            if p != sd.MANY:
                met.setdefault(p, set()).add(s)
    got = {k: (min(v), max(v)) for k, v in met.items() if isinstance(k, int)}
    assert got == {int(i): (int(a), int(z)) for i, a, z in zip(idx, least, most) if z >= 0}
