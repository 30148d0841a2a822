"""Histogram sort: law, whole groups, gapless slots and splitters against sorted rows."""

import random
import zlib
from collections import Counter, defaultdict

import pytest

from tidepool.llm import sharding as sh
from tidepool.llm.registry import op6_digest


def build(seed, n, heavy):
    rng = random.Random(seed)
    texts = ["x" * rng.randint(0, 300) + str(rng.random()) for _ in range(n)]
    for share, size in heavy:
        texts += [f"copy{share}" + "y" * size] * int(n * share)
    rng.shuffle(texts)
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("heavy,whole", [([], True), ([(0.08, 150), (0.05, 200)], True), ([(1.0, 150)], False)])
def test_shards(spark, heavy, whole):
    rows = build(len(heavy), 4000, heavy)
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, SHARD int, key int").repartition(6)
    got = sh.histogram_shards(df, 8)
    assert got.columns == ["doc_id", "text", "key", "size", "shard", "slot"]
    found = got.collect()
    assert sorted(r.doc_id for r in found) == [i for i, _ in rows]
    size, slots, shards_of = Counter(), defaultdict(list), defaultdict(set)
    for r in found:
        assert r.size == len(r.text.encode()) + 1
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
        shards_of[r.text].add(r.shard)
    assert set(size) == set(range(8))
    mean = sum(size.values()) / 8
    assert all(abs(s - mean) <= 0.03 * mean for s in size.values()), size
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    if whole:
        assert all(len(s) == 1 for s in shards_of.values())


def test_no_python_on_the_way(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = op6_digest(df)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_splitters_meet_their_goals(spark):
    rng = random.Random(8)
    keys = sorted({rng.getrandbits(64) - (1 << 63) for _ in range(3000)} | {rng.getrandbits(20) for _ in range(2000)})  # many close together
    rows = [(k, rng.randint(1, 50)) for k in keys]
    total = sum(b for _, b in rows)
    light = spark.createDataFrame(rows, "key long, bytes long")
    wanted = [total * f for f in (0.1, 0.0, 0.2, 0.3, 0.15, 0.25)]
    cuts = sh._splitters(light, wanted, 60)
    goal = 0.0
    for want, cut in zip(wanted, cuts):
        goal += want
        assert abs(sum(b for k, b in rows if k < cut) - goal) <= 60


def test_edge_rows(spark):
    schema = "doc_id long, text string"
    assert sh.histogram_shards(spark.createDataFrame([], schema)).collect() == []
    rows = [(1, None), (2, ""), (None, "a"), (3, "a"), (3, "a"), (4, "é" * 50_000)]
    found = op6_digest(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.size, r.text_crc32) for r in found) == sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in rows)
    assert {r.law for r in found} == {"bytes"} and {r.grown_shard for r in found} == {None}
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("from_files", [False, True])
def test_a_third_of_all_rows_is_one_row(spark, from_files, tmp_path):
    """The same row 1,500 times among 2,000: shards stay as equal as without it."""
    rng = random.Random(12)
    rows = [(i, "z" * rng.randint(0, 60) + str(rng.random())) for i in range(2000)] + [(7, "hot " * 12)] * 1500
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    if from_files:
        df.write.parquet(str(tmp_path / "t"))
        df = spark.read.parquet(str(tmp_path / "t"))
    found = sh.histogram_shards(df, 8, from_files=from_files).collect()
    assert Counter((r.doc_id, r.text) for r in found) == Counter(rows)
    size, slots = Counter(), defaultdict(list)
    for r in found:
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
    mean = sum(size.values()) / 8
    assert all(abs(s - mean) <= 0.03 * mean for s in size.values()), size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
