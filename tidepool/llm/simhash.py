"""SimHash near-duplicates through deletion-variant signatures.

A fingerprint of 64 bits is cut into ``s`` segments, fewer than plain
pigeonholing of ``max_bits`` differences into exact matches would need, so
that some choice of segments differs by at most one bit. With up to 4
differing bits, one of 3 segments differs by at most one; and of 5, 6 or 7
segments, the best 2, 3 or 4 together differ by at most one. Each such choice
is indexed once per bit with that bit wildcarded: two values that differ by at
most one bit share the variant in which that bit is blanked. Rows are joined
on equal variants (a sort-merge by variant) and each candidate is verified
by counting the bits of the XOR of the whole fingerprints.

Links within one bucket are reduced to a spanning star on the spot, so a
bucket of near copies yields as many rows as it has members. A bucket of more
than ``bucket`` distinct fingerprints is not compared there: its members go on
to a finer cut, and from the finest to midpoints (every value within half the
distance of a fingerprint: two fingerprints are linked if and only if they
share one), which need no comparison at all. So no link is lost and no bucket is ever held
whole.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.llm.components import connected_components
from tidepool.llm.scratch import cut
from tidepool.llm.textio import parts, utf8, word_pieces

BITS = 64
#: Bits of a variant's key that hold segments; the others hold the choice of segments and the wildcard.
KEY_BITS = 48
#: Largest bucket of distinct fingerprints that one task compares pairwise.
BUCKET = 4096
#: Distinct fingerprints up to which a cut of so many segments is used first.
SEGMENTS_FOR = ((3, 10**8), (5, 10**10), (7, None))


def fingerprint(text: bytes, shingle: int, seed: int = 42) -> int:
    """64-bit SimHash of a UTF-8 text: a bit is 1 if set in over half of the shingle hashes.

    Words are runs of non-space bytes, A-Z lower-cased; fewer words than
    ``shingle`` make one shingle of them all; no word gives 0.
    """
    ones = np.zeros(BITS, np.int64)
    total = 0
    carry: list[bytes] = []
    digest = xxhash.xxh64_intdigest
    for piece in word_pieces(text.lower()):
        words = carry + piece
        if len(words) >= shingle:
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.concatenate(([0], ends[:-1] + 1))
            hashes = [digest(joined[a:b], seed)
                      for a, b in zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())]
            for i in range(0, len(hashes), 65536):
                block = np.array(hashes[i: i + 65536], np.uint64)
                ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
            total += len(hashes)
        carry = words[-(shingle - 1):] if shingle > 1 else []
    if total == 0:
        if not carry:
            return 0
        return digest(b" ".join(carry), seed)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, shingle: int = 4, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``_row`` (unique), ``_fp`` and the columns ``keep`` of every row, written once.

    Null and empty texts have fingerprint zero.
    """
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    kept = [F.col(f"`{c}`") for c in keep]
    source = docs.select(F.col(f"`{text}`").alias("_text"), F.struct(*kept).alias("_kept"))
    schema = T.StructType([T.StructField("_row", T.LongType()), T.StructField("_fp", T.LongType()), source.schema["_kept"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for b in parts(batches):
            fps = np.array([fingerprint(t, shingle) for t in utf8(b.column("_text"))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + b.num_rows)), pa.array(fps), b.column("_kept")], ["_row", "_fp", "_kept"])
            row += b.num_rows

    return cut(source.mapInArrow(run, schema), "fingerprints")


def _tables(segments: int, max_bits: int) -> list[list[tuple[int, int]]]:
    """The choices of segments, as (low bit, width), of which one differs by at most one bit."""
    edges = [round(i * BITS / segments) for i in range(segments + 1)]
    cuts = [(a, b - a) for a, b in zip(edges, edges[1:])]
    # the largest k such that the k segments with the fewest of max_bits differences have at most one between them, and a key holds them
    widest = sorted((w for _, w in cuts), reverse=True)
    k = max((k for k in range(1, segments) if _least_worst(segments, k, max_bits) <= 1 and sum(widest[:k]) <= KEY_BITS), default=0)
    if not k:
        raise ValueError(f"{segments} segments are too few for {max_bits} bits")
    return [list(c) for c in itertools.combinations(cuts, k)]


def _least_worst(segments: int, k: int, bits: int) -> int:
    """Most differences that the k least different of the segments can have together."""
    worst = 0

    def spread(left: int, n: int, most: int, parts: list[int]) -> None:
        nonlocal worst
        if n == 0:
            if left == 0:
                worst = max(worst, sum(sorted(parts)[:k]))
            return
        for x in range(min(left, most), -1, -1):
            spread(left - x, n - 1, x, [*parts, x])

    spread(bits, segments, bits, [])
    return worst


def variant_keys(fps: np.ndarray, tables: list[list[tuple[int, int]]]) -> np.ndarray:
    """Keys (rows x variants): for each choice of segments, its bits with one of them blanked."""
    out = []
    for t, choice in enumerate(tables):
        value, width = np.zeros_like(fps), 0
        for low, w in choice:
            value = (value << np.uint64(w)) | ((fps >> np.uint64(low)) & np.uint64((1 << w) - 1))
            width += w
        for j in range(width):
            tag = np.uint64(((t << 6) | j) << KEY_BITS)
            out.append(tag | (value & ~np.uint64(1 << j)))
    return np.stack(out, axis=1)


def _stars(members: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (indices into members) as links to the smallest member of each component."""
    values, inverse = np.unique(members, return_inverse=True)
    a, b = inverse[left], inverse[right]
    label = np.arange(len(values))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    linked = np.flatnonzero(label != np.arange(len(values)))
    return values[linked], values[label[linked]]


_LINKS = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _links_of(low: np.ndarray, high: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(low.view(np.int64)), pa.array(high.view(np.int64))], ["a", "b"])


def _compare(max_bits: int, bucket: int):
    """Sorted (key, fp) batches to links; (fp, null) marks a member of an oversize bucket."""

    def close(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        sizes = np.diff(np.concatenate((starts, [len(keys)])))
        size_of = np.repeat(sizes, sizes)
        over = size_of > bucket
        if over.any():
            yield _marks(fps[over])
        keep = (size_of > 1) & ~over
        k, f = keys[keep], fps[keep]
        found: list[tuple[np.ndarray, np.ndarray]] = []
        at, step = np.arange(len(k)), 1
        while len(at):
            at = at[at + step < len(k)]
            at = at[k[at] == k[at + step]]
            hit = at[np.bitwise_count(f[at] ^ f[at + step]) <= max_bits]
            if len(hit):
                found.append((hit, hit + step))
                if sum(len(x) for x, _ in found) > 1 << 20:
                    yield _links_of(*_stars(f, *map(np.concatenate, zip(*found))))
                    found = []
            step += 1
        if found:
            yield _links_of(*_stars(f, *map(np.concatenate, zip(*found))))

    def _marks(fps: np.ndarray) -> pa.RecordBatch:
        f = np.unique(fps).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(f), pa.nulls(len(f), pa.int64())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.empty(0, np.int64), np.empty(0, np.uint64)
        over = None  # the key of an oversize bucket that goes on
        for b in batches:
            keys = np.concatenate((keys, b.column("k").to_numpy()))
            fps = np.concatenate((fps, b.column("f").to_numpy().view(np.uint64)))
            if over is not None:
                n = int(np.searchsorted(keys, over, "right"))
                if n:
                    yield _marks(fps[:n])
                    keys, fps = keys[n:], fps[n:]
                if len(keys) == 0:
                    continue
                over = None
            last = int(np.searchsorted(keys, keys[-1], "left")) if len(keys) else 0  # the last bucket may go on
            if last:
                yield from close(keys[:last], fps[:last])
                keys, fps = keys[last:], fps[last:]
            if len(keys) > bucket:
                over = keys[-1]
                yield _marks(fps)
                keys, fps = keys[:0], fps[:0]
        if len(keys):
            yield from close(keys, fps)

    return run


def _explode(keys_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = b.column("f").to_numpy().view(np.uint64)
            for i in range(0, len(fps), 2048):
                part = fps[i: i + 2048]
                keys = keys_of(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64).ravel()), pa.array(np.repeat(part.view(np.int64), keys.shape[1]))], ["k", "f"])

    return run


def _by_key(fps: DataFrame, keys_of) -> DataFrame:
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("f", T.LongType())])
    return fps.mapInArrow(_explode(keys_of), schema).repartition("k").sortWithinPartitions("k")


def _flips(max_bits: int) -> np.ndarray:
    """Changes of at most half of ``max_bits`` bits, rounded up, fewest bits first."""
    masks = [sum(1 << i for i in c) for n in range((max_bits + 1) // 2 + 1) for c in itertools.combinations(range(BITS), n)]
    return np.array(masks, np.uint64)


_MIDPOINTS = T.StructType([T.StructField("k", T.LongType()), T.StructField("far", T.BooleanType()), T.StructField("f", T.LongType())])


def _midpoint_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links from every fingerprint near a midpoint to the first that is within half of ``max_bits`` (rounded down) of it.

    Two fingerprints differ by at most ``max_bits`` if and only if some value is
    within half of that, rounded down, of the one and rounded up of the
    other. So these links need no check and a run of any length streams by.
    """
    flips = _flips(max_bits)
    far = np.bitwise_count(flips) > max_bits // 2

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = b.column("f").to_numpy().view(np.uint64)
            for i in range(0, len(fps), 256):
                part = fps[i: i + 256]
                keys = part[:, None] ^ flips[None, :]
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64).ravel()), pa.array(np.tile(far, len(part))),
                                                  pa.array(np.repeat(part.view(np.int64), len(flips)))], _MIDPOINTS.names)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, hub = None, None  # of the run that goes on; no hub: no near member
        for b in batches:
            k, f = b.column("k").to_numpy(), b.column("f").to_numpy()
            is_far = b.column("far").to_numpy(zero_copy_only=False)
            if not len(k):
                continue
            starts = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
            hubs, has = f[starts].copy(), ~is_far[starts]  # near members come first
            if key is not None and k[0] == key:
                hubs[0], has[0] = (hub, True) if hub is not None else (hubs[0], has[0])
            sizes = np.diff(np.concatenate((starts, [len(k)])))
            hub_of, linked = np.repeat(hubs, sizes), np.repeat(has, sizes)
            key, hub = k[-1], hub_of[-1] if linked[-1] else None
            linked &= f != hub_of
            links = np.unique(np.stack((f[linked], hub_of[linked]), axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], _LINKS.names)

    return fps.mapInArrow(spread, _MIDPOINTS).repartition("k").sortWithinPartitions("k", "far").mapInArrow(link, _LINKS)


def fingerprint_links(fps: DataFrame, max_bits: int = 4, bucket: int = BUCKET,
                      cuts: list[int] | None = None) -> DataFrame:
    """Links (a, b) that connect every two distinct fingerprints (column f) of at most ``max_bits`` differing bits.

    Every link is between fingerprints joined by a chain of such pairs, and
    every such pair is joined by a chain of links: the components are exact.
    """
    if cuts is None:
        n = fps.count()
        cuts = [s for s, most in SEGMENTS_FOR if most is None or n <= most]
    links = []
    for s in cuts:
        tables = _tables(s, max_bits)
        found = cut(_by_key(fps, lambda f, t=tables: variant_keys(f, t)).mapInArrow(_compare(max_bits, bucket), _LINKS), f"links-{s}")
        links.append(found.where("b is not null"))
        fps = found.where("b is null").select(F.col("a").alias("f")).distinct()
        if fps.isEmpty():
            break
    else:
        links.append(cut(_midpoint_links(fps, max_bits), "links-midpoints"))
    out = links[0]
    for more in links[1:]:
        out = out.union(more)
    return out


def _components(rows: DataFrame, id_col: str, max_bits: int, bucket: int) -> DataFrame:
    """``_fp``, ``_c`` (a fingerprint that names the component) and ``_component`` of the fingerprints of ``rows``."""
    classes = rows.groupBy("_fp").agg(F.min(f"_kept.`{id_col}`").alias("_id"))
    links = fingerprint_links(classes.select(F.col("_fp").alias("f")), max_bits, bucket)
    comps = connected_components(links)
    joined = classes.join(comps, classes["_fp"] == comps["node"], "left").select(
        "_fp", "_id", F.coalesce("component", "_fp").alias("_c"))
    least = joined.groupBy("_c").agg(F.min("_id").alias("_component"))
    return cut(joined.join(least, "_c").select("_fp", "_c", "_component"), "classes")


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, text: str = "text",
                    id_col: str = "doc_id", keep: list[str] | None = None, bucket: int = BUCKET) -> DataFrame:
    """Rows of ``docs`` with ``fingerprint`` (a signed long) and ``component_id``.

    Returns the columns ``keep`` (all but the text unless given; a column with
    the name of an output is left out) and the two outputs. ``component_id``
    is the smallest id reachable through fingerprints of at most ``max_bits``
    differing bits, the row's own included; null ids count only where a
    component has no other. Rows of one fingerprint, repeated rows and empty
    or null texts (fingerprint zero) are linked like any others. An empty
    table gives no rows.
    """
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    rows = with_fingerprints(docs, shingle, text, list(dict.fromkeys([*keep, id_col])))
    rows = rows.join(_components(rows, id_col, max_bits, bucket), "_fp")
    shown = [c for c in keep if c.lower() not in ("fingerprint", "component_id")]
    return rows.select(*[F.col(f"_kept.`{c}`").alias(c) for c in shown],
                       F.col("_fp").alias("fingerprint"), F.col("_component").alias("component_id"))


def keep_one_each(docs: DataFrame, shingle: int = 4, max_bits: int = 4, text: str = "text",
                  id_col: str = "doc_id", bucket: int = BUCKET) -> DataFrame:
    """One row of every near-duplicate component, with the columns of ``docs``.

    The row of the smallest id stays (of several such rows the one read
    first; null ids come last). Components and the choice are made on rows a
    few columns wide; the documents meet them once, on their unique row number.
    """
    rows = with_fingerprints(docs, shingle, text, docs.columns)
    first = F.struct(F.col("_id").isNull().alias("n"), F.col("_id").alias("i"), F.col("_row").alias("r"))
    narrow = rows.select("_row", "_fp", F.col(f"_kept.`{id_col}`").alias("_id")).join(_components(rows, id_col, max_bits, bucket), "_fp")
    best = narrow.groupBy("_c").agg(F.min(first).alias("m")).select(F.col("m.r").alias("_row"))
    return rows.join(best, "_row", "left_semi").select(*[F.col(f"_kept.`{c}`").alias(c) for c in docs.columns])
