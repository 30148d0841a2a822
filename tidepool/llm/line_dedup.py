"""Drop lines that many documents share, by probing sharded minimal perfect hash tables.

The distinct line keys of the corpus are counted with map-side combining and
dealt to shards by hash. Each shard becomes one row of arrays: a minimal
perfect hash of its keys (bit levels in which every key owns a bit, after
Limasset et al., "Fast and scalable minimal perfect hashing", 2017), and at
each key's slot a 32-bit fingerprint and its count, about 7 bytes a key in
all. Documents send their line hashes to the shards, where a task reads one shard's arrays at
a time and streams the probes past them: line texts are never joined.

A line shared by a third of all documents sends that many probes to one shard.
Shards of more than their part of the probes are copied, and their probes dealt over
the copies; at most ``COPIED`` shards can be that large, so their list is
bounded. Memory per task is one shard's arrays and one batch of probes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.llm.scratch import cut, row_hash
from tidepool.llm.textio import parts, utf8

#: Line hashes sent to a shard, on average: the bound of a shard's distinct keys but for chance.
SHARD = 200_000
#: A shard with more than this share of all probes (1 / COPIED), and over 8 x SHARD, is copied.
COPIED = 4096
#: Counts are kept in 16 bits; higher ones stay at the top.
TOP = 65535
GAMMA = 2


def line_keys(text: bytes) -> list[bytes]:
    """Key of each \\n-split line: stripped of ASCII white space at both ends, A-Z lower-cased."""
    return [line.strip().lower() for line in text.split(b"\n")]


def _hashes(keys: list[bytes]) -> np.ndarray:
    """128-bit hashes as rows (high, low)."""
    digest = xxhash.xxh3_128_digest
    return np.frombuffer(b"".join(map(digest, keys)), ">u8").astype(np.uint64).reshape(-1, 2)


# -- minimal perfect hash -------------------------------------------------------------------------

def _place(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
    """Position of each key among ``size`` bits at a level."""
    x = high + low * np.uint64(2 * level + 1) + np.uint64(level * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)


def build(high: np.ndarray, low: np.ndarray) -> tuple[list[int], np.ndarray]:
    """(bits of each level, all levels' bits packed) of distinct keys."""
    sizes: list[int] = []
    levels: list[np.ndarray] = []
    while len(high):
        size = -(-GAMMA * len(high) // 64) * 64
        at = _place(high, low, len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(alone)
        sizes.append(size)
        rest = ~alone[at]
        high, low = high[rest], low[rest]
    bits = np.concatenate(levels) if levels else np.zeros(0, bool)
    return sizes, np.packbits(bits, bitorder="little")


class Index:
    """One shard's arrays, ready to be probed."""

    def __init__(self, sizes: list[int], packed: bytes, fingerprints: bytes, counts: bytes):
        self.sizes = sizes
        self.bits = np.unpackbits(np.frombuffer(packed, np.uint8), bitorder="little").astype(bool)
        self.rank = np.cumsum(self.bits) - self.bits
        self.fingerprints = np.frombuffer(fingerprints, "<u4")
        self.counts = np.frombuffer(counts, "<u2")

    def slots(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 where no level has its bit; a key not indexed may get any slot."""
        out = np.full(len(high), -1, np.int64)
        left, base = np.arange(len(high)), 0
        for level, size in enumerate(self.sizes):
            at = base + _place(high[left], low[left], level, size)
            here = self.bits[at]
            out[left[here]] = self.rank[at[here]]
            left = left[~here]
            base += size
            if not len(left):
                break
        return out

    def count(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Count of each key; 0 where the fingerprint shows that it is not indexed."""
        slot = self.slots(high, low)
        found = slot >= 0
        out = np.zeros(len(high), np.int64)
        match = self.fingerprints[slot[found]] == (low[found] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        out[found] = np.where(match, self.counts[slot[found]], 0)
        return out


_INDEX = T.StructType([
    T.StructField("shard", T.LongType()), T.StructField("shards", T.LongType()), T.StructField("probes", T.LongType()),
    T.StructField("sizes", T.ArrayType(T.IntegerType())), T.StructField("bits", T.BinaryType()),
    T.StructField("fingerprints", T.BinaryType()), T.StructField("counts", T.BinaryType())])


def _build_shard(table: pa.Table) -> pa.Table:
    high, low = (table.column(c).to_numpy().view(np.uint64) for c in ("high", "low"))
    n = table.column("n").to_numpy()
    sizes, packed = build(high, low)
    slot = Index(sizes, packed.tobytes(), b"", b"").slots(high, low)
    fingerprints, counts = np.zeros(len(n), "<u4"), np.zeros(len(n), "<u2")
    fingerprints[slot] = (low & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    counts[slot] = np.minimum(n, TOP)
    return pa.Table.from_arrays(
        [pa.array([table.column(c)[0].as_py()]) for c in ("shard", "shards")] + [pa.array([int(n.sum())]), pa.array([sizes], pa.list_(pa.int32())),
         pa.array([packed.tobytes()], pa.binary()), pa.array([fingerprints.tobytes()], pa.binary()), pa.array([counts.tobytes()], pa.binary())],
        [f.name for f in _INDEX])


# -- Spark ----------------------------------------------------------------------------------------

_PROBES = T.StructType([T.StructField(c, T.LongType()) for c in ("doc", "high", "low")])


def _probes(docs: DataFrame) -> DataFrame:
    """(doc, high, low): the distinct non-empty line keys of each row of ``docs`` (doc, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            keys = [[k for k in dict.fromkeys(line_keys(t)) if k] for t in utf8(b.column("text"))]
            doc = np.repeat(b.column("doc").to_numpy(), [len(k) for k in keys])
            h = _hashes([k for ks in keys for k in ks]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(h[:, 0]), pa.array(h[:, 1])], ["doc", "high", "low"])

    return docs.mapInArrow(run, _PROBES)


def line_index(probes: DataFrame, shard_size: int = SHARD) -> DataFrame:
    """Arrays of the distinct line hashes (high, low) of ``probes`` and their counts, a row per shard."""
    shards = max(1, -(-probes.count() // shard_size))
    counts = probes.groupBy("high", "low").agg(F.count("*").alias("n")).select(
        F.pmod("high", F.lit(shards).cast("long")).alias("shard"), F.lit(shards).cast("long").alias("shards"), "high", "low", "n")
    return cut(counts.groupBy("shard").applyInArrow(_build_shard, _INDEX), "line-index")


def frequent(probes: DataFrame, index: DataFrame, min_docs: int) -> DataFrame:
    """(doc, high) of the probes whose count in ``index`` is at least ``min_docs``."""
    if not 1 <= min_docs <= TOP:
        raise ValueError(f"min_docs must be 1 to {TOP}")
    shards, total = index.agg(F.max("shards"), F.sum("probes")).first()
    if not shards:
        return probes.select("doc", "high")
    most = max(8 * SHARD, -(-total // COPIED))
    hot = {r["shard"]: -(-r["probes"] // most) for r in index.where(F.col("probes") > most).select("shard", "probes").collect()}  # at most COPIED rows
    copies = F.lit(1)
    if hot:
        table = F.create_map(*[F.lit(x).cast("long") for kv in hot.items() for x in kv])
        copies = F.coalesce(F.element_at(table, F.col("shard")), F.lit(1))
    empty = {"doc": "long", "high": "long", "low": "long"}
    left = index.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1))).select(
        "shard", "copy", F.lit(0).alias("side"), *[F.lit(None).cast(t).alias(c) for c, t in empty.items()], "sizes", "bits", "fingerprints", "counts")
    right = probes.withColumn("shard", F.pmod("high", F.lit(shards))).select(
        "shard", F.pmod(F.xxhash64("doc"), copies).alias("copy"), F.lit(1).alias("side"), "doc", "high", "low",
        *[F.lit(None).cast(index.schema[c].dataType).alias(c) for c in ("sizes", "bits", "fingerprints", "counts")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, arrays = (None, None), None
        for b in batches:
            shard, copy, side = (b.column(c).to_numpy() for c in ("shard", "copy", "side"))
            cuts = np.flatnonzero(np.concatenate(([True], (shard[1:] != shard[:-1]) | (copy[1:] != copy[:-1]) | (side[1:] != side[:-1]))))
            for i, j in zip(cuts, [*cuts[1:], len(shard)]):
                if side[i] == 0:
                    at = (shard[i], copy[i])
                    arrays = Index(*(b.column(c)[int(i)].as_py() for c in ("sizes", "bits", "fingerprints", "counts")))
                    continue
                if at != (shard[i], copy[i]):
                    raise RuntimeError("a shard's arrays must come before its probes")
                part = b.slice(i, j - i)
                high, low = (part.column(c).to_numpy().view(np.uint64) for c in ("high", "low"))
                yield part.select(["doc", "high"]).filter(pa.array(arrays.count(high, low) >= min_docs))

    return left.union(right).repartition("shard", "copy").sortWithinPartitions("shard", "copy", "side").mapInArrow(
        run, T.StructType(_PROBES.fields[:2]))


def drop_frequent_lines(docs: DataFrame, min_docs: int = 10, text: str = "text") -> DataFrame:
    """``docs`` with every line taken out whose key at least ``min_docs`` documents have.

    A line's key is the line without ASCII white space at its ends, A-Z
    lower-cased; empty keys always stay. Each row counts as a document, also a
    repeated one. Returns the columns of ``docs`` with the new text (a null
    text becomes empty: one empty line) and ``n_lines`` (before) and
    ``n_dropped``; columns with those names are replaced. An empty table gives
    no rows.
    """
    names = {"n_lines", "n_dropped"}
    others = [c for c in docs.columns if c != text and c.lower() not in names]
    # rows of equal key share their text, and what is dropped depends on the line alone
    keyed = docs.select(row_hash(docs).alias("doc"),
                        F.col(f"`{text}`").alias("text"), F.struct(*[F.col(f"`{c}`") for c in others], F.lit(0).alias("_")).alias("kept"))
    probes = cut(_probes(keyed.select("doc", "text")), "probes")
    hits = frequent(probes, line_index(probes), min_docs).groupBy("doc").agg(F.collect_set("high").alias("gone"))
    joined = keyed.join(hits, "doc", "left").select("text", "kept", "gone")
    schema = T.StructType([joined.schema["kept"], T.StructField("text", T.StringType()),
                           T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            texts, before, dropped = [], [], []
            for t, gone in zip(utf8(b.column("text")), b.column("gone").to_pylist()):
                lines = t.split(b"\n")
                before.append(len(lines))
                if gone:
                    keys = line_keys(t)
                    high = _hashes(keys)[:, 0].view(np.int64)
                    stays = ~np.isin(high, np.array(gone, np.int64))
                    lines = [line for line, key, s in zip(lines, keys, stays) if s or not key]
                dropped.append(before[-1] - len(lines))
                texts.append(b"\n".join(lines))
            yield pa.RecordBatch.from_arrays(
                [b.column("kept"), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(before, pa.int64()), pa.array(dropped, pa.int64())],
                ["kept", "text", "n_lines", "n_dropped"])

    out = joined.mapInArrow(run, schema)
    return out.select(*[F.col("text").alias(c) if c == text else F.col(f"kept.`{c}`").alias(c) for c in docs.columns if c.lower() not in names],
                      "n_lines", "n_dropped")
