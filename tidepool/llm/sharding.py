"""Histogram sort into shards of near equal bytes, with DataFrame functions only.

Rows are ordered by a hash of their text, so equal texts stand together. The
splitters between shards are found by exact histograms: bytes are
counted in the bins of a key prefix across all partitions, the bins in which a splitter
falls are probed again with a longer prefix, and so on until each splitter
is within the tolerance. Then the rows are exchanged once, by shard and bin,
and numbered inside their bins; the exact counts of the bins before give the
first number of each.

Texts that alone hold more than 1 / ``HEAVY`` of a shard are placed first, the
largest into the emptiest shard, and the splitters fill up around them. They
stay whole unless one text has more bytes than a shard's share: then its rows
are dealt in pieces, since near equal sizes come first. Heavy texts are
numbered in pieces as well, so no task gets more than a bin or a piece.

Rows are told apart by their place in the input, also where all their columns are equal, so a
row that is repeated very often is dealt like any other heavy text.

What reaches the driver is bounded whatever the input: ``2 ** STEP`` bins of each splitter a
round, and ``HEAVY`` texts and pieces a shard.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.scratch import cut, row_hash

HEAVY = 64
#: Bytes wanted in a bin, and the most and least bits of a bin's number.
BIN_BYTES = 16 << 20
MIN_BITS, MAX_BITS = 8, 16
#: Bits by which a probe is refined each round.
STEP = 12


def _levels(loads: list[float], light: float) -> list[float]:
    """Light bytes each shard should get so that all end up as equal as can be."""
    order = sorted(loads)
    level = 0.0
    for i, low in enumerate(order, 1):
        level = (light + sum(order[:i])) / i
        if i == len(order) or level <= order[i]:
            break
    return [max(0.0, level - x) for x in loads]


def _splitters(light: DataFrame, wanted: list[float], tolerance: float) -> list[int]:
    """Smallest keys of shards 1 and up: bytes of ``light`` (key, bytes) below them come near the running sums of ``wanted``."""
    goals, run = [], 0.0
    for w in wanted[:-1]:
        run += w
        goals.append(run)
    # a goal's interval: keys of prefix p of so many bits, with the bytes below it
    found: dict[int, int] = {}
    open_: dict[int, tuple[int | None, int, int]] = {i: (None, 0, 0) for i in range(len(goals))}  # prefix, its bits, bytes below
    while open_:
        bits = next(iter(open_.values()))[1]
        to = min(64, bits + STEP)
        rows = light
        if bits:
            rows = rows.where(F.shiftright("key", 64 - bits).isin(sorted({p for p, _, _ in open_.values()})))
        counted = rows.groupBy(F.shiftright("key", 64 - to).alias("bin")).agg(F.sum("bytes").alias("bytes")).orderBy("bin").collect()
        for i, (prefix, _, below) in list(open_.items()):
            inside = [(r["bin"], r["bytes"]) for r in counted if not bits or r["bin"] >> (to - bits) == prefix]
            for n, (b, size) in enumerate(inside):
                if below + size >= goals[i] or n == len(inside) - 1:
                    if size <= tolerance or to == 64 or below + size <= goals[i]:
                        up = goals[i] - below > below + size - goals[i]  # the nearer edge
                        found[i] = _edge(b + up, to)
                        del open_[i]
                    else:
                        open_[i] = (b, to, below)
                    break
                below += size
            else:
                found[i] = _edge(1 << (to - 1), to)  # nothing there: the top
                del open_[i]
    return [found[i] for i in range(len(goals))]


def _edge(prefix: int, bits: int) -> int:
    """Smallest signed 64-bit key of a signed prefix; the top stands for all above."""
    return min(prefix << (64 - bits), (1 << 63) - 1)


def histogram_shards(docs: DataFrame, shards: int = 8, text: str = "text", tolerance: float = 0.001, from_files: bool = False) -> DataFrame:
    """Columns of ``docs`` with ``size`` (UTF-8 bytes of the text plus 1), ``shard`` and ``slot``.

    Shards are as near to equal in bytes as whole groups of equal texts allow
    within ``tolerance`` of a shard and half a heavy text; slots run from 0
    without gaps in each shard. Null and empty texts are one group. Repeated rows
    get slots of their own. Columns named like an output are replaced. An
    empty table gives no rows.

    ``docs`` is read several times, and a row needs the same place each time. ``from_files`` says that it comes
    from files row by row, without a shuffle, join or sort; else it is written to the shared folder first.
    """
    if not from_files:
        docs = cut(docs, "docs-to-shard")
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    size = F.octet_length(body).cast("long") + 1
    key, second = F.xxhash64(body), F.xxhash64(row_hash(docs, 1), F.monotonically_increasing_id())
    groups = cut(docs.select(key.alias("key"), size.alias("size")).groupBy("key").agg(
        F.sum("size").alias("bytes"), F.count("*").alias("n")), "text-groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    fair = total / shards
    names = {"size", "shard", "slot"}
    others = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in names]
    if not total:
        return docs.select(*others, size.alias("size"), F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))

    # Heavy texts: at most HEAVY a shard, in pieces of about fair / HEAVY bytes each.
    heavy = {r["key"]: r["bytes"] for r in groups.where(F.col("bytes") > fair / HEAVY).select("key", "bytes").collect()}
    pieces_of = {k: math.ceil(b * HEAVY / fair) for k, b in heavy.items()}
    pieces: dict[int, list[tuple[int, int]]] = {k: [] for k in heavy}
    if heavy:
        counts = docs.select(key.alias("key"), size.alias("size"), second.alias("second")).where(F.col("key").isin(list(heavy)))
        counts = counts.groupBy("key", F.pmod("second", _lookup(pieces_of, F.col("key"))).alias("piece")).agg(F.sum("size").alias("bytes"))
        for r in counts.collect():  # at most HEAVY + 1 pieces a shard and text
            pieces[r["key"]].append((r["piece"], r["bytes"]))
    units = []  # (bytes, key, pieces) that stay together
    for k, b in heavy.items():
        whole = b <= fair
        units += [(b, k, sorted(p for p, _ in pieces[k]))] if whole else [(size_, k, [p]) for p, size_ in pieces[k]]
    loads, shard_of = [0.0] * shards, {}
    for b, k, ps in sorted(units, reverse=True):
        s = loads.index(min(loads))
        loads[s] += b
        shard_of |= {(k, p): s for p in ps}

    light = groups.where(~F.col("key").isin(list(heavy))) if heavy else groups
    light_bytes = total - sum(heavy.values())
    splitters = _splitters(light.select("key", "bytes"), _levels(loads, light_bytes), tolerance * fair)
    bits = min(MAX_BITS, max(MIN_BITS, math.ceil(math.log2(max(1, light_bytes / BIN_BYTES)))))

    # A row's shard, and its bin: a prefix of its key, or beyond those the piece of a heavy text.
    at, piece = F.col("_key"), F.pmod("_second", _lookup(pieces_of, F.col("_key")))
    shard = sum(((at >= F.lit(s).cast("long")) & F.lit(s < (1 << 63) - 1)).cast("int") for s in splitters) + F.lit(0)
    bin_ = F.shiftright(at, 64 - bits)
    if heavy:
        placed = {k: i for i, k in enumerate(shard_of)}
        code = F.lit(0)
        for name, values in (("shard", shard_of), ("bin", {kp: (1 << MAX_BITS) + i for kp, i in placed.items()})):
            by_key = {k: [values[k, p] if (k, p) in values else 0 for p in range(pieces_of[k])] for k in heavy}
            code = F.element_at(F.element_at(_map(by_key), at), (piece + 1).cast("int"))
            if name == "shard":
                shard = F.when(at.isin(list(heavy)), code).otherwise(shard)
            else:
                bin_ = F.when(at.isin(list(heavy)), code.cast("long")).otherwise(bin_)
    kept = F.struct(*others, F.lit(0).alias("_"))
    rows = docs.select(kept.alias("_kept"), size.alias("_size"), key.alias("_key"), second.alias("_second"))
    rows = rows.withColumn("_shard", shard.cast("int")).withColumn("_bin", bin_.cast("long"))
    counts = rows.groupBy("_shard", "_bin").agg(F.count("*").alias("_n"))
    first = F.coalesce(F.sum("_n").over(Window.partitionBy("_shard").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = cut(counts.select("_shard", "_bin", first.alias("_first")), "bin-starts")  # at most the bins and pieces
    number = F.row_number().over(Window.partitionBy("_shard", "_bin").orderBy("_key", "_second")) - 1
    numbered = rows.withColumn("_number", number).join(F.broadcast(starts), ["_shard", "_bin"])
    return numbered.select(*[F.col(f"_kept.`{c}`").alias(c) for c in docs.columns if c.lower() not in names],
                           F.col("_size").alias("size"), F.col("_shard").alias("shard"), (F.col("_first") + F.col("_number")).cast("long").alias("slot"))


def _map(values: dict):
    kind = "array<int>" if values and isinstance(next(iter(values.values())), list) else "int"
    flat = []
    for k, v in values.items():
        flat += [F.lit(k).cast("long"), F.array(*[F.lit(x) for x in v]) if isinstance(v, list) else F.lit(v)]
    return F.create_map(*flat).cast(f"map<bigint,{kind}>")


def _lookup(values: dict[int, int], column):
    """The value of a key, 1 for a key that has none."""
    return F.coalesce(F.element_at(_map(values), column), F.lit(1)) if values else F.lit(1)
