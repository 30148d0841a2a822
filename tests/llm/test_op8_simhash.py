"""SimHash near-duplicates against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidepool.llm import simhash


def slow_fingerprint(text, shingle=4):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] if len(words) >= shingle else [b" ".join(words)] * bool(words)
    votes = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g, 42)
        for i in range(64):
            votes[i] += (h >> i) & 1
    return sum(1 << i for i in range(64) if 2 * votes[i] > len(grams))


def slow_components(values, max_bits=4):
    """Smallest index reachable for each value."""
    label = list(range(len(values)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= max_bits:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def test_fingerprint_equals_slow_and_spark_hash(spark):
    rng = random.Random(3)
    words = ["The", "ähm", "cat", "SAT", "x" * 40, "Été", "1"]
    texts = ["", " \t\n", "One", "one two THREE", "a b c d", " a b c\vd\fe f"] + [
        rng.choice([" ", "\n", "  "]).join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(60)]
    for t in texts:
        assert simhash.fingerprint(t.encode(), 4) == slow_fingerprint(t)
    got = spark.createDataFrame([("a b c d",)], "s string").select(F.xxhash64("s")).first()[0]
    assert got == signed(xxhash.xxh64_intdigest(b"a b c d", 42))


def test_long_text_in_pieces(monkeypatch):
    rng = random.Random(1)
    text = " ".join("".join(rng.choices("abcd", k=rng.randint(1, 9))) for _ in range(5000)).encode()
    whole = simhash.fingerprint(text, 4)
    pieces = simhash.word_pieces
    monkeypatch.setattr(simhash, "word_pieces", lambda b: pieces(b, 101))
    assert simhash.fingerprint(text, 4) == whole


@pytest.mark.parametrize("segments,keep", [(3, 1), (4, 1), (5, 2), (6, 3), (7, 4)])
def test_choices_of_segments(segments, keep):
    tables = simhash._tables(segments, 4)
    assert len(tables[0]) == keep
    rng = random.Random(segments)
    for _ in range(300):  # any two values of at most 4 differing bits share a key
        a = rng.getrandbits(64)
        b = a
        for i in rng.sample(range(64), rng.randint(0, 4)):
            b ^= 1 << i
        keys = simhash.variant_keys(np.array([a, b], np.uint64), tables)
        assert set(keys[0].tolist()) & set(keys[1].tolist())


def ball(rng, n, spread):
    base = rng.getrandbits(64)
    out = {base}
    while len(out) < n:
        v = base
        for i in rng.sample(range(64), rng.randint(1, spread)):
            v ^= 1 << i
        out.add(v)
    return out


@pytest.mark.parametrize("bucket,cuts", [(4096, [3]), (5, [3, 5]), (2, [3, 7]), (4096, [6])])
def test_links_equal_brute_force(spark, bucket, cuts):
    rng = random.Random(bucket)
    values = sorted(ball(rng, 60, 3) | ball(rng, 40, 8) | {rng.getrandbits(64) for _ in range(100)} | {0, 1, 3})
    expect = slow_components(values)
    fps = spark.createDataFrame([(signed(v),) for v in values], "f long").repartition(3)
    links = simhash.fingerprint_links(fps, 4, bucket, cuts)
    comp = {r["node"]: r["component"] for r in simhash.connected_components(links).collect()}
    label = [comp.get(signed(v), signed(v)) for v in values]
    groups = {}
    for i, c in enumerate(label):
        groups.setdefault(c, []).append(i)
    assert sorted(groups.values()) == sorted(
        [[i for i, e in enumerate(expect) if e == r] for r in set(expect)])


@pytest.mark.parametrize("max_bits,bucket", [(3, 4), (3, 4096), (2, 3), (5, 4096), (1, 2)])
def test_other_distances(spark, max_bits, bucket):
    rng = random.Random(max_bits)
    values = sorted(ball(rng, 30, 3) | {rng.getrandbits(64) for _ in range(40)})
    expect = slow_components(values, max_bits)
    fps = spark.createDataFrame([(signed(v),) for v in values], "f long").repartition(2)
    comp = {r["node"]: r["component"] for r in simhash.connected_components(simhash.fingerprint_links(fps, max_bits, bucket, [5])).collect()}
    groups = {}
    for i, v in enumerate(values):
        groups.setdefault(comp.get(signed(v), signed(v)), []).append(i)
    assert sorted(groups.values()) == sorted([[i for i, e in enumerate(expect) if e == r] for r in set(expect)])


ROWS = [(5, "a b c d e f g h", "en"), (3, "A b c\nd e  f g h", "x"), (9, None, None), (7, "", "q"), (7, "", "q"),
        (None, "a b c d e f g h", "n"), (11, "one two", "y"), (None, "zz yy xx ww vv", "n"), (20, "t " * 9000, "long")]


def test_edge_rows(spark):
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in ROWS],
                               "doc_id long, text string, lang string, _row int, fingerprint int, COMPONENT_ID int")
    got = simhash.near_duplicates(df, bucket=3)
    rows = got.select("doc_id", "lang", "fingerprint", "component_id").collect()
    assert len(rows) == len(ROWS)
    by = {}
    for r in rows:
        by.setdefault((r.doc_id, r.lang), r)
    assert by[(5, "en")].component_id == 3 and by[(3, "x")].component_id == 3
    assert by[(9, None)].fingerprint == 0 and by[(9, None)].component_id == 7 and by[(7, "q")].component_id == 7
    assert sorted(str(r.component_id) for r in rows if r.doc_id is None) == ["3", "None"]
    kept = simhash.keep_one_each(df, bucket=3)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["3", "7", "11", "None", "20"])


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).collect() == []
    assert simhash.keep_one_each(df).collect() == []
