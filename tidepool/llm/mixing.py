"""Mix sources to target weights by cube-method balanced sampling.

Each source gets a share of the words by weight, at most ``cap`` times what it
has. Its documents are then taken whole, floor(r) or floor(r) + 1 times for r =
target / size of the source, with the fractions settled by the cube method
(Deville and Tillé, 2004; the streaming form of Chauvet and Tillé, 2006): of
three undecided documents the fractions move along the direction that leaves
both the words and the number of documents unchanged, until one is decided
and the next document takes its place. So at most two documents stay
undecided in each block of a source. They meet those of other blocks in the
next round, until at most two a source are left for the landing, which rounds
them to the total nearest to the target.

Blocks are dealt by hash, so a source with a third of all documents is spread
like the rest; each task streams its rows and holds three documents. All
choices follow from hashes of the rows: reruns agree.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.llm.scratch import cut, row_hash
from tidepool.llm.textio import parts, utf8, word_pieces

#: Documents of all sources to a block in the first round, and blocks that meet in one of the next round.
BLOCK = 2_000
FAN = 1024
#: Fractions so near to 0 or 1 count as decided.
EPS = 1e-9


# -- targets --------------------------------------------------------------------------------------

def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0,
                   per_task: int = 100_000) -> DataFrame:
    """(source, source_size, target) of (source, size) rows.

    Sources in code-point order, null last, weigh ``weights``, repeating. They
    share ``share`` times all sizes; no target is above ``cap`` times its
    source's size: the excess is shared again by weight until none is above.
    """
    totals = cut(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    parts = max(1, -(-totals.count() // per_task))
    order = F.col("source").asc_nulls_last()
    ranged = cut(totals.repartitionByRange(parts, order).withColumn("part", F.spark_partition_id()), "source-order")
    before, rank = 0, F.lit(None)
    starts = []
    for r in ranged.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect():  # a row per part
        starts += [F.lit(r["part"]), F.lit(before)]
        before += r["n"]
    if not starts:
        return totals.withColumn("target", F.lit(0.0))
    rank = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1 + F.element_at(F.create_map(*starts), F.col("part"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    weighed = cut(ranged.select("source", "source_size", weight.alias("w"), (F.lit(cap) * F.col("source_size")).alias("most")), "source-weights")
    total = share * float(weighed.agg(F.sum("source_size")).first()[0] or 0)
    level, stopped = 0.0, -1
    while True:
        above = F.col("w") * level > F.col("most")
        n, held, free = weighed.agg(F.count_if(above), F.sum(F.when(above, F.col("most")).otherwise(0.0)),
                                    F.sum(F.when(above, 0.0).otherwise(F.col("w")))).first()
        if n == stopped or not free:
            break
        stopped, level = n, (total - held) / free
    return weighed.select("source", "source_size", F.least("most", F.col("w") * level).alias("target"))


# -- cube method ----------------------------------------------------------------------------------

def _uniform(key: int, salt: int) -> float:
    """A number in [0, 1) from a key."""
    x = (key + (salt + 1) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF
    return (x ^ (x >> 31)) / 2.0**64


def move(x: list[float], sizes: list[float], u: float) -> list[float]:
    """One flight step of three fractions: words and documents stay in total, at least one is decided."""
    a, b, c = sizes
    d = [b - c, c - a, a - b]
    top = max(map(abs, d))
    d = [v / top for v in d] if top else [1.0, -1.0, 0.0]
    up = min((1 - v if s > 0 else v) / abs(s) for v, s in zip(x, d) if s)
    down = min((v if s > 0 else 1 - v) / abs(s) for v, s in zip(x, d) if s)
    step = up if u * (up + down) < down else -down
    moved = [v + step * s for v, s in zip(x, d)]
    return [0.0 if v < EPS else 1.0 if v > 1 - EPS else v for v in moved]


def land(x: list[float], sizes: list[float]) -> list[float]:
    """The rounding of a few fractions that changes the words least, then the number of documents."""
    words, docs = sum(v * s for v, s in zip(x, sizes)), sum(x)
    return list(min(itertools.product((0.0, 1.0), repeat=len(x)),
                    key=lambda p: (abs(sum(v * s for v, s in zip(p, sizes)) - words), abs(sum(p) - docs), p)))


def flight(units: Iterator[tuple], last: bool, salt: int) -> Iterator[tuple]:
    """(group, key, size, x) units, group by group, to (index, x); in the last round all are decided."""
    pool: list[list] = []  # index, size, x
    group = None

    def close():
        if last and pool:
            for p, v in zip(pool, land([p[2] for p in pool], [p[1] for p in pool])):
                p[2] = v
        yield from ((p[0], p[2]) for p in pool)
        pool.clear()

    for i, (g, key, size, x) in enumerate(units):
        if g != group:
            yield from close()
            group = g
        if not EPS <= x <= 1 - EPS:
            yield i, float(round(x))
            continue
        pool.append([i, size, x])
        while len(pool) == 3:
            for p, v in zip(pool, move([p[2] for p in pool], [p[1] for p in pool], _uniform(key, salt))):
                p[2] = v
            yield from ((p[0], p[2]) for p in pool if p[2] in (0.0, 1.0))
            pool[:] = [p for p in pool if p[2] not in (0.0, 1.0)]
    yield from close()


def _flight_round(units: DataFrame, blocks: int, salt: int) -> DataFrame:
    """``units`` with x moved on; with one block all are decided."""
    names = units.columns
    block = F.pmod(F.xxhash64(F.lit(salt), "key", "key2"), F.lit(blocks))
    ordered = units.withColumn("block", block).repartition("source", "block").sortWithinPartitions("source", "block", "key", "key2")
    at = names.index("x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, tuple] = {}  # rows read but not yet decided: three at most beside the batch in hand

        def rows():
            n = 0
            for b in batches:
                table = [b.column(c).to_pylist() for c in names]
                for source, bl, key, size, x, *row in zip(b.column("source").to_pylist(), b.column("block").to_pylist(),
                                                          b.column("key").to_pylist(), b.column("size").to_pylist(), b.column("x").to_pylist(), *table):
                    waiting[n] = row
                    n += 1
                    yield (source, bl), key, float(size), x

        out: list[tuple] = []
        for i, x in flight(rows(), blocks == 1, salt):
            row = list(waiting.pop(i))
            row[at] = x
            out.append(row)
            if len(out) >= 10_000:
                yield _batch(out, schema)
                out = []
        if out:
            yield _batch(out, schema)

    schema = units.schema
    return ordered.mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    kinds = {T.LongType(): pa.int64(), T.DoubleType(): pa.float64(), T.StringType(): pa.string()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[f.dataType]) for c, f in zip(zip(*rows), schema)], schema.names)


def balanced_fractions(units: DataFrame, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """``units`` (source, key, key2, size, x, ...) with every x in [0, 1] decided as 0 or 1.

    Of each source the sum of x and of x times size change by at most the
    rounding of the last two undecided units.
    """
    blocks = max(1, -(-units.count() // block))
    decided, salt = [], 0
    while True:
        done = cut(_flight_round(units, blocks, salt), f"flight-{salt}")
        if blocks == 1:
            decided.append(done)
            break
        settled = (F.col("x") == 0) | (F.col("x") == 1)
        decided.append(done.where(settled))
        units = done.where(~settled)
        blocks, salt = -(-blocks // fan), salt + 1
    out = decided[0]
    for more in decided[1:]:
        out = out.union(more)
    return out


def _numbered(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Rows of each key, read from files, numbered from 1: first those of the first partition, then on from the partitions before.

    No task holds all rows of a key, only those of one partition.
    """
    rows = rows.withColumn("_place", F.spark_partition_id())
    counts = rows.groupBy(*keys, "_place").agg(F.count(F.lit(1)).alias("_n"))
    ahead = F.coalesce(F.sum("_n").over(Window.partitionBy(*keys).orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ahead = counts.select(*keys, "_place", ahead.alias("_ahead"))
    here = F.row_number().over(Window.partitionBy(*keys, "_place").orderBy(F.lit(0)))
    local = rows.repartition(*keys, "_place").withColumn("_here", here)
    return local.join(ahead, [*keys, "_place"]).withColumn(name, (F.col("_here") + F.col("_ahead")).cast("int")).drop("_here", "_ahead", "_place")


def mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0,
        text: str = "text", source: str = "source", block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """Columns of ``docs`` with ``size``, ``source_size``, ``target``, ``copies`` and ``taken``.

    ``size`` is the number of words (null or empty text: 0), ``copies`` how
    often the mix takes the document, ``taken`` the words it takes of it.
    Columns with these names are replaced. A null source is a source of its
    own. Rows that are equal in all columns form one unit with that many
    documents, whose whole number of copies is dealt among them. A document
    without words is taken as often as others of its source (0 words). An
    empty table gives no rows.
    """
    names = ["size", "source_size", "target", "copies", "taken"]
    others = [c for c in docs.columns if c.lower() not in names]
    keyed = docs.select(row_hash(docs, 0).alias("key"), row_hash(docs, 1).alias("key2"), F.col(f"`{source}`").cast("string").alias("source"),
                        F.col(f"`{text}`").alias("text"), *[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(others)])

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            n = [sum(map(len, word_pieces(t))) for t in utf8(b.column("text"))]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("source", "key", "key2")], pa.array(n, pa.int64())], ["source", "key", "key2", "size"])

    narrow = T.StructType([T.StructField("source", T.StringType()), *[T.StructField(c, T.LongType()) for c in ("key", "key2", "size")]])
    sized = cut(keyed.select("source", "key", "key2", "text").mapInArrow(sizes, narrow), "sizes")
    targets = source_targets(sized, weights, share, cap)

    rate = F.when(F.col("source_size") > 0, F.least(F.lit(cap), F.col("target") / F.col("source_size"))).otherwise(0.0)
    units = sized.groupBy("source", "key", "key2", "size").agg(F.count("*").alias("rows")).alias("u").join(
        targets.alias("t"), F.col("u.source").eqNullSafe(F.col("t.source"))).select(
        "u.source", "key", "key2", "size", "rows", F.col("source_size").cast("long").alias("source_size"), F.col("target").cast("double").alias("target"), rate.alias("rate"))
    whole = F.floor(F.col("rows") * F.col("rate") + EPS)  # copies of all rows of the unit, but for one
    units = units.select("source", "key", "key2", "size", "rows", "source_size", "target", whole.cast("long").alias("whole"),
                         F.greatest(F.lit(0.0), F.col("rows") * F.col("rate") - whole).alias("x"))
    decided = balanced_fractions(units, block, fan).select(
        "key", "key2", "size", "source_size", "target", "rows", (F.col("whole") + F.col("x").cast("long")).alias("all_copies"))

    # flat columns, so that those the caller drops are not shuffled
    joined = keyed.select("key", "key2", *[f"_{i}" for i in range(len(others))]).join(decided, ["key", "key2"])
    turned = joined.where("rows = 1").withColumn("_turn", F.lit(1))
    if not decided.where("rows > 1").isEmpty():
        turned = turned.unionByName(_numbered(cut(joined.where("rows > 1"), "repeats"), ["key", "key2"], "_turn"))
    copies = F.floor(F.col("all_copies") / F.col("rows")) + F.when(F.col("_turn") <= F.col("all_copies") % F.col("rows"), 1).otherwise(0)
    return turned.withColumn("copies", copies.cast("long")).select(
        *[F.col(f"_{i}").alias(c) for i, c in enumerate(others)], "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))
