"""Repeated passages by a distributed difference-cover suffix sort.

Every byte covered by a string of ``length`` bytes that also starts anywhere else
is found in these steps, each a Spark job over rows or packed arrays of them:

1. *Blocks.* A window of ``length`` bytes is assigned to its leftmost minimiser, the
   shorter substring in it with the least hash. Equal windows have equal minimisers at equal distance, so
   only blocks (runs of windows with one minimiser) whose minimiser occurs twice can hold
   repeats; equal blocks are one class with a weight, and of a class with several members every
   window repeats. Classes that share a minimiser with another class go on, once each.
2. *Sample.* Of their bytes, the positions in a difference cover modulo ``period`` are
   sampled: any two positions have a common distance, shorter than the period, to samples. Their first
   ``period`` bytes are sorted across the cluster and named by rank.
3. *Recursion.* Triples of names, one, two and three depths on, are sorted and named in turn,
   which triples the depth, until it is as long as a window less a period. Samples with a unique name
   are settled and take no further part.
4. *Merge.* Every other suffix stands before a sample: the bytes up to it, its rank and the bytes
   behind the sorted depth order it. For each distance the suffixes are merged by these,
   and those next to each other whose prefixes of ``length`` bytes agree are repeats.

A sort deals keys to tasks by splitters from a sample. A key that equals a splitter is
frequent; it has its name from the splitter and is not sent to a task, and suffixes before such a
sample are merged by hashes of their windows, each sent once by the samples looked at together, so
no task holds all copies of one key.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.llm.scratch import cut

#: Difference covers by period (fixed values: perfect difference sets).
COVERS = {3: (1, 2), 7: (0, 1, 3), 13: (0, 1, 3, 9), 31: (0, 1, 3, 8, 12, 18), 57: (0, 1, 3, 13, 32, 36, 43, 52)}
#: Windows hashed at a time, bytes of a chunk of text, longest piece of one document in it, samples per task of a sort.
SEGMENT, CHUNK, PIECE, PER_TASK = 1 << 18, 2 << 20, 1 << 20, 400_000
_U = np.uint64
_BASE, _MIX = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_OTHER = _U(0xC2B2AE3D27D4EB4F)
#: Samples of frequent names whose windows are hashed at a time, and the place of a window that stands for several.
FREQUENT, MANY = 20_000, 0xFFFFFFFF


def plan(length: int) -> tuple[int, list[int]]:
    """(period, depths of the sorts): the last depth is at most a window less a period."""
    period = max(p for p in COVERS if p == 3 or 7 * p <= length)
    last = (length - period + 1) // period * period
    depths = [period]
    while depths[-1] < last:
        depths.append(min(3 * depths[-1], last))
    return period, depths


def triple(depth: int, deeper: int) -> tuple[int, int, int]:
    """Distances of the three names of ``depth`` that make up one of ``deeper``; they overlap where it isn't three times as deep."""
    return 0, min(depth, deeper - depth), deeper - depth


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    one = np.ones(1, _U)
    return np.cumprod(np.concatenate([one, np.full(n, _BASE)])), np.cumprod(np.concatenate([one, np.full(n, _INVERSE)]))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _MIX
    return h ^ (h >> _U(29))


def _grams(a: np.ndarray, size: int) -> np.ndarray:
    """A hash of each substring of ``size`` bytes."""
    up, down = _powers(1 << len(a).bit_length())
    sums = np.zeros(len(a) + 1, _U)
    np.cumsum((a.astype(_U) + _U(1)) * up[: len(a)], out=sums[1:])
    return _mixed((sums[size:] - sums[:-size]) * down[: len(a) - size + 1])


def _least(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each ``w`` neighbours."""
    n = len(h)
    x = np.concatenate([h, np.full(-n % w, ~_U(0))]).reshape(-1, w)
    ahead, behind = np.minimum.accumulate(x, axis=1).ravel(), np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - w + 1], ahead[w - 1: n])


def blocks(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(start, windows, minimiser's hash, whether it has several places) of the blocks of texts that stand in ``data`` one after the other.

    ``ends`` are the offsets of the texts, the first 0. Windows that reach over an end are left out.
    """
    size = length * 13 // 25
    w, low = length - size + 1, _U((1 << 20) - 1)
    first, places, hashes, last = [], [], [], None
    count = len(data) - length + 1
    for s in range(0, max(count, 0), SEGMENT):
        n = min(SEGMENT, count - s)
        h = _grams(data[s: s + n + length - 1], size)
        place = (_least((h & ~low) | np.arange(len(h), dtype=_U), w) & low).astype(np.int64)
        new = np.flatnonzero(np.concatenate([[last is None or place[0] + s != last], place[1:] != place[:-1]]))
        first.append(new + s)
        places.append(place[new] + s)
        hashes.append(h[place[new]])
        last = place[-1] + s
    if not first:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(_U), none.astype(bool)
    first, places, hashes = map(np.concatenate, (first, places, hashes))
    valid = np.stack([ends[:-1], np.maximum(ends[:-1], ends[1:] - length + 1)], axis=1)
    start = np.union1d(first, valid.ravel())
    start = start[start < count]
    at = np.searchsorted(first, start, "right") - 1
    doc = np.searchsorted(ends, start, "right") - 1
    inside = start < valid[doc, 1]
    stop = np.append(start[1:], count)
    start, stop, at, doc = start[inside], stop[inside], at[inside], doc[inside]
    # neighbouring runs of one hash at several places, as in periodic text, are one block
    more = np.concatenate([[False], (hashes[at[1:]] == hashes[at[:-1]]) & (start[1:] == stop[:-1]) & (doc[1:] == doc[:-1])])[: len(start)]
    head = np.flatnonzero(~more)
    if not len(head):
        return start, start, hashes[:0], more
    moved = more & np.concatenate([[False], places[at[1:]] != places[at[:-1]]])
    tail = np.append(head[1:], len(start)) - 1
    return start[head], stop[tail] - start[head], hashes[at[head]], np.logical_or.reduceat(moved, head)


def _anchors(texts: DataFrame, length: int) -> DataFrame:
    """The blocks of every text: (gram, block, run, again, k1, k2, start)."""
    schema = T._parse_datatype_string("gram long, block long, run long, again boolean, k1 long, k2 long, start long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in (whole.slice(i, 500) for i in range(0, whole.num_rows, 500)):
                texts = b.column("text").cast(pa.binary()).to_pylist()
                buffer = b"".join(texts)
                ends = np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)
                start, count, gram, many = blocks(np.frombuffer(buffer, np.uint8), ends, length)
                if not len(start):
                    continue
                doc, view = np.searchsorted(ends, start, "right") - 1, memoryview(buffer)
                block = np.array([xxhash.xxh3_64_intdigest(view[s:e]) for s, e in zip(start.tolist(), (start + count + length - 1).tolist())], _U)
                rows = pa.array(doc)
                yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(block.view(np.int64)), pa.array(count), pa.array(many),
                                                  b.column("k1").take(rows), b.column("k2").take(rows), pa.array(start - ends[doc])], schema.names)

    return texts.where(F.octet_length("text") >= length).mapInArrow(run, schema)


_CHUNK = "cid long, bytes long, data binary, pieces binary"
#: Columns of a chunk's pieces: their bytes in the chunk, offset of the first in its text, samples that are the piece's own, the text.
_LO, _HI, _AT, _OWN_LO, _OWN_HI, _K1, _K2 = range(7)


def _chunks(wanted: DataFrame, length: int, period: int) -> DataFrame:
    """Chunks of about ``CHUNK`` bytes with the regions that the wanted blocks of each text cover.

    A long region is cut into pieces that overlap by what a window needs; each sample belongs to one piece.
    """
    schema = T._parse_datatype_string(_CHUNK)

    def run(batches):
        part, no, parts, rows, size = TaskContext.get().partitionId(), 0, [], [], 0

        def batch():
            nonlocal no, parts, rows, size
            out = pa.RecordBatch.from_arrays([pa.array([(part << 40) + no]), pa.array([size]), pa.array([b"".join(parts)], pa.binary()),
                                              pa.array([np.array(rows, np.int64).tobytes()], pa.binary())], schema.names)
            no, parts, rows, size = no + 1, [], [], 0
            return out

        for whole in batches:
            for b in (whole.slice(i, 100) for i in range(0, whole.num_rows, 100)):
                for text, k1, k2, places in zip(b.column("text").cast(pa.binary()).to_pylist(), *(b.column(c).to_pylist() for c in ("k1", "k2", "places"))):
                    regions = merged(np.array([(p["start"], p["start"] + p["run"] + length - 1) for p in places], np.int64))
                    for lo, hi in regions.tolist():
                        for own in range(lo, hi, PIECE):
                            own_hi = min(own + PIECE, hi)
                            a, z = max(lo, own - period + 1), min(hi, own_hi + length)
                            parts.append(text[a:z])
                            rows.append((size, size + z - a, a, own, own_hi, k1, k2))
                            size += z - a
                            if size >= CHUNK:
                                yield batch()
        if size:
            yield batch()

    return wanted.mapInArrow(run, schema)


def merged(spans: np.ndarray) -> np.ndarray:
    """Spans (start, end) joined where they touch, in order."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    return np.stack([spans[new, 0], reach[np.append(np.flatnonzero(new)[1:] - 1, len(spans) - 1)]], axis=1)


class _Chunk:
    """A chunk's bytes, its sampled positions and the names they have so far."""

    def __init__(self, data: bytes, pieces: bytes, period: int, named=None):
        self.data, self.pieces = np.frombuffer(data, np.uint8), np.frombuffer(pieces, np.int64).reshape(-1, 7)
        of = np.repeat(np.arange(len(self.pieces)), self.pieces[:, _HI] - self.pieces[:, _LO])
        at = np.arange(len(self.data)) - self.pieces[of, _LO] + self.pieces[of, _AT]
        cover = np.zeros(period, bool)
        cover[list(COVERS[period])] = True
        self.sample = np.flatnonzero(cover[at % period])
        self.piece, self.at = of[self.sample], at[self.sample]
        self.room = self.pieces[self.piece, _HI] - self.sample
        if named is not None:
            self.names = np.zeros(len(self.data), _U)
            for n in named:
                self.names[np.frombuffer(n["idx"], np.uint32)] = np.frombuffer(n["names"], _U)

    def keys(self, depths: list[int], level: int) -> tuple[np.ndarray, np.ndarray]:
        """(positions still to be named, their keys) of a level: bytes, then triples of names."""
        idx = self.sample[self.room >= depths[level]]
        if level == 0:
            return idx, _strings(np.lib.stride_tricks.sliding_window_view(self.data, depths[0])[idx]) if len(idx) else np.zeros(0, f"S{depths[0]}")
        three = np.stack([self.names[idx + d] for d in triple(depths[level - 1], depths[level])], axis=1)
        open_ = ((three != 0) & (three & _U(1) == 0)).all(axis=1)
        return idx[open_], _strings(three[open_].astype(">u8").view(np.uint8).reshape(-1, 24))


def _strings(rows: np.ndarray) -> np.ndarray:
    """Rows of bytes as fixed-width strings, which sort and compare as bytes do."""
    rows = np.ascontiguousarray(rows)
    return rows.view(f"S{rows.shape[1]}").ravel()


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for i in range(b.num_rows):
            yield b.slice(i, 1).to_pylist()[0]


def _splitters(state: DataFrame, period: int, depths: list[int], level: int, tasks: int, samples: int) -> np.ndarray:
    """At most ``tasks`` keys that cut the level's keys into about equal shares: 64 sampled keys a task reach the driver."""
    if tasks == 1:
        return np.zeros(0, "S1")
    share, width = 64 * tasks / samples, 24 if level else depths[0]

    def run(batches):
        for c in _each(batches):
            _, keys = _Chunk(c["data"], c["pieces"], period, c.get("named")).keys(depths, level)
            raw = keys[np.random.default_rng(c["cid"]).random(len(keys)) < share].tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([raw[i: i + width] for i in range(0, len(raw), width)], pa.binary())], ["key"])

    got = sorted(bytes(r.key) for r in state.mapInArrow(run, "key binary").collect())
    return np.array(sorted({got[i] for i in range(64, len(got), 64)}), f"S{width}")


def _named(state: DataFrame, period: int, depths: list[int], level: int, tasks: int, samples: int) -> DataFrame:
    """Names of one level, in order of its keys: (cid, idx, names) in packets. Bit 0 of a name says that its key is unique."""
    cuts = _splitters(state, period, depths, level, tasks, samples)
    width = 24 if level else depths[0]

    def deal(batches):
        for c in _each(batches):
            idx, keys = _Chunk(c["data"], c["pieces"], period, c.get("named")).keys(depths, level)
            task = np.searchsorted(cuts, keys, "left") if len(cuts) else np.zeros(len(keys), np.int64)
            hot = np.append(cuts, b"")[task] == keys if len(cuts) else np.zeros(len(keys), bool)
            hot &= task < len(cuts)
            task = np.where(hot, -1, task)
            order = np.argsort(task, kind="stable")
            out = []
            for rows in np.split(order, np.flatnonzero(np.diff(task[order])) + 1):
                if len(rows):
                    t = int(task[rows[0]])
                    if t < 0:  # the splitter's own name, between those of the tasks beside it
                        own = ((2 * np.searchsorted(cuts, keys[rows], "left") + 1).astype(_U) << _U(41)) | _U(2)
                        out.append((-1 - c["cid"] % tasks, idx[rows], own.tobytes()))
                    else:
                        out.append((t, idx[rows], keys[rows].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([c["cid"]] * len(out), pa.int64()),
                                              pa.array([o[1].astype(np.uint32).tobytes() for o in out], pa.binary()),
                                              pa.array([o[2] for o in out], pa.binary())], ["task", "cid", "idx", "keys"])

    def name(table: pa.Table) -> pa.Table:
        task, packets = table.column("task")[0].as_py(), table.column("keys").to_pylist()
        if task >= 0:
            keys = np.frombuffer(b"".join(packets), f"S{width}")
            order = np.argsort(keys, kind="stable")
            ranked = keys[order]
            rank = np.cumsum(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
            names = np.empty(len(keys), _U)
            names[order] = (_U(2 * task) << _U(41)) | (rank.astype(_U) << _U(1)) | (np.bincount(rank)[rank] == 1)
            packets = [x.tobytes() for x in np.split(names, np.cumsum([len(p) // width for p in packets])[:-1])]
        return pa.table([table.column("cid"), table.column("idx"), pa.array(packets, pa.binary())], names=["cid", "idx", "names"])

    dealt = state.mapInArrow(deal, "task long, cid long, idx binary, keys binary")
    return dealt.groupBy("task").applyInArrow(name, "cid long, idx binary, names binary")


def _windows(names: np.ndarray, near: np.ndarray, before: int, base: np.uint64 = _BASE) -> Iterator[np.ndarray]:
    """For each distance from 0 to ``before``, a hash of the name and the neighbouring columns of ``near`` that stand for the suffix."""
    wide, back = near.shape[1] - before, _U(pow(int(base), -1, 1 << 64))
    up = np.cumprod(np.concatenate([np.ones(1, _U), np.full(wide, base)]))
    h, salt = np.zeros(len(names), _U), _mixed(names * base)
    for k in range(wide):
        h += (near[:, before + k].astype(_U) + _U(1)) * up[wide - 1 - k]
    for s in range(before + 1):
        if s:  # one byte further to the left
            h = (h - near[:, before - s + wide] - _U(1)) * back + (near[:, before - s].astype(_U) + _U(1)) * up[wide - 1]
        yield _mixed(h) ^ salt


def _mark(names: np.ndarray, near: np.ndarray, low: np.ndarray, high: np.ndarray, before: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest distance at which the suffix before each sample repeats (greatest -1: none).

    ``near`` holds the ``before`` bytes before a sample and those behind the depth sorted, as far as a window may
    reach. The suffix ``s`` before a sample is its s bytes, the sample's name and the bytes
    after its depth that are left of a window: neighbouring columns of ``near``.
    """
    wide = near.shape[1] - before
    least, most = np.full(len(names), 255, np.uint8), np.full(len(names), -1, np.int16)
    for s, h in enumerate(_windows(names, near, before)):
        here = np.flatnonzero((low <= s) & (s <= high))
        key = h[here]
        order = np.argsort(key, kind="stable")
        key, order = key[order], here[order]
        twin = np.flatnonzero(key[1:] == key[:-1])
        a, b = order[twin], order[twin + 1]
        span = slice(before - s, before - s + wide)
        same = (names[a] == names[b]) & (near[a, span] == near[b, span]).all(axis=1)
        found = np.union1d(a[same], b[same])
        most[found] = s
        least[found] = np.minimum(least[found], s)
    return least, most


def _frequent(idx: np.ndarray, names: np.ndarray, near: np.ndarray, low: np.ndarray, high: np.ndarray, before: int) -> tuple[tuple, tuple]:
    """Suffixes before samples of frequent names, in two parts: (places, least, most) of those that repeat among
    these samples, and (places, distances, two hashes) of every distinct window, place ``MANY`` if it is one of the former."""
    rows, dist, keys = [], [], []
    for s, (one, two) in enumerate(zip(_windows(names, near, before), _windows(names, near, before, _OTHER))):
        here = np.flatnonzero((low <= s) & (s <= high))
        rows.append(here)
        dist.append(np.full(len(here), s, np.uint8))
        keys.append(np.stack([one[here] + _U(s), two[here]], axis=1))
    rows, dist, keys = map(np.concatenate, (rows, dist, keys))
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    new = np.concatenate([[True], (keys[order[1:]] != keys[order[:-1]]).any(axis=1)])[: len(order)]
    group = np.cumsum(new) - 1
    twice = (np.bincount(group) > 1)[group] if len(group) else np.zeros(0, bool)
    least, most = np.full(len(idx), 255, np.uint8), np.full(len(idx), -1, np.int16)
    np.minimum.at(least, rows[order[twice]], dist[order[twice]])
    np.maximum.at(most, rows[order[twice]], dist[order[twice]].astype(np.int16))
    found, heads = np.flatnonzero(most >= 0), order[new]
    places = np.where(twice[new], MANY, idx[rows[heads]]).astype(np.uint32)
    return (idx[found].astype(np.uint32), least[found], most[found].astype(np.uint8)), (places, dist[heads], keys[heads])


def _repeats(state: DataFrame, length: int, period: int, depths: list[int], tasks: int) -> DataFrame:
    """(cid, idx, least, most) in packets: the samples before which suffixes repeat, and the distances."""
    depth, before, packets = depths[-1], period - 1, "cid long, idx binary, least binary, most binary"

    def rows(c, hot: bool):
        chunk = _Chunk(c["data"], c["pieces"], period, c["named"])
        names = chunk.names[chunk.sample]
        own = (chunk.pieces[chunk.piece, _OWN_LO] <= chunk.at) & (chunk.at < chunk.pieces[chunk.piece, _OWN_HI])
        low = np.maximum(0, length - chunk.room)
        high = np.minimum(period - 1, chunk.sample - chunk.pieces[chunk.piece, _LO])
        keep = own & (names != 0) & (names & _U(1) == 0) & (low <= high) & (((names >> _U(41)) & _U(1) == 1) == hot)
        idx = chunk.sample[keep]
        padded = np.concatenate([np.zeros(period - 1, np.uint8), chunk.data, np.zeros(length, np.uint8)])
        part = lambda at, n: np.lib.stride_tricks.sliding_window_view(padded, n)[at + period - 1]
        return idx, names[keep], np.concatenate([part(idx - period + 1, period - 1), part(idx + depth, length - depth)], axis=1), low[keep], high[keep]

    def deal(batches):
        for c in _each(batches):
            idx, names, near, low, high = rows(c, False)
            task = (_mixed(names) % _U(tasks)).astype(np.int64)
            order = np.argsort(task, kind="stable")
            groups = [g for g in np.split(order, np.flatnonzero(np.diff(task[order])) + 1) if len(g)]
            columns = [(idx.astype(np.uint32)), names, near, low.astype(np.uint8), high.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(task[g[0]]) for g in groups], pa.int64()), pa.array([c["cid"]] * len(groups), pa.int64()),
                 *[pa.array([x[g].tobytes() for g in groups], pa.binary()) for x in columns]], ["task", "cid", "idx", "names", "near", "low", "high"])

    def mark(table: pa.Table) -> pa.Table:
        column = lambda c, kind: np.frombuffer(b"".join(table.column(c).to_pylist()), kind)
        names = column("names", _U)
        least, most = _mark(names, column("near", np.uint8).reshape(len(names), -1), column("low", np.uint8), column("high", np.uint8), before)
        idx, ends = column("idx", np.uint32), np.cumsum([len(x) // 4 for x in table.column("idx").to_pylist()])
        out = []
        for cid, a, z in zip(table.column("cid").to_pylist(), [0, *ends.tolist()], ends.tolist()):
            g = a + np.flatnonzero(most[a:z] >= 0)
            if len(g):
                out.append((cid, idx[g].tobytes(), least[g].tobytes(), most[g].astype(np.uint8).tobytes()))
        return pa.table([pa.array([o[0] for o in out], pa.int64()), *[pa.array([o[k] for o in out], pa.binary()) for k in (1, 2, 3)]], names=["cid", "idx", "least", "most"])

    def deal_frequent(batches):
        for c in _each(batches):
            whole = rows(c, True)
            for i in range(0, len(whole[0]), FREQUENT):
                here, (places, dist, keys) = _frequent(*(x[i: i + FREQUENT] for x in whole), before)
                task = (keys[:, 0] % _U(tasks)).astype(np.int64)
                order = np.argsort(task, kind="stable")
                out = [(int(task[g[0]]), places[g], dist[g], dist[g], keys[g]) for g in np.split(order, np.flatnonzero(np.diff(task[order])) + 1) if len(g)]
                out += [(-1 - c["cid"] % tasks, *here, np.zeros((0, 2), _U))] * bool(len(here[0]))
                yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([c["cid"]] * len(out), pa.int64()),
                                                  *[pa.array([o[k].tobytes() for o in out], pa.binary()) for k in (1, 2, 3, 4)]], ["task", "cid", "idx", "least", "most", "keys"])

    def mark_frequent(table: pa.Table) -> pa.Table:
        """Windows that more than one packet has; packets of a negative task pass."""
        cids, keep = table.column("cid").to_pylist(), ["cid", "idx", "least", "most"]
        if table.column("task")[0].as_py() < 0:
            return table.select(keep)
        keys = np.frombuffer(b"".join(table.column("keys").to_pylist()), _U).reshape(-1, 2)
        places = np.frombuffer(b"".join(table.column("idx").to_pylist()), np.uint32)
        dist = np.frombuffer(b"".join(table.column("least").to_pylist()), np.uint8)
        order = np.lexsort((keys[:, 1], keys[:, 0]))
        same = (keys[order[1:]] == keys[order[:-1]]).all(axis=1)
        hit = np.zeros(len(keys), bool)
        hit[order[1:][same]] = hit[order[:-1][same]] = True
        hit &= places != MANY
        ends = np.cumsum([len(x) // 4 for x in table.column("idx").to_pylist()]).tolist()
        out = [(cid, a + np.flatnonzero(hit[a:z])) for cid, a, z in zip(cids, [0, *ends], ends) if hit[a:z].any()]
        return pa.table([pa.array([o[0] for o in out], pa.int64()), *[pa.array([x[o[1]].tobytes() for o in out], pa.binary()) for x in (places, dist, dist)]], names=keep)

    cold = state.mapInArrow(deal, "task long, cid long, idx binary, names binary, near binary, low binary, high binary").groupBy("task").applyInArrow(mark, packets)
    if tasks == 1:
        return cold
    hot = state.mapInArrow(deal_frequent, "task long, cid long, idx binary, least binary, most binary, keys binary")
    return cold.unionByName(hot.groupBy("task").applyInArrow(mark_frequent, packets))


def _spans(state: DataFrame, repeats: DataFrame, length: int) -> DataFrame:
    """(k1, k2, start, end): what the repeats of each piece cover of its text."""
    schema = T._parse_datatype_string("k1 long, k2 long, start long, end long")

    def run(batches):
        for c in _each(batches):
            pieces = np.frombuffer(c["pieces"], np.int64).reshape(-1, 7)
            join = lambda f, kind: np.concatenate([np.frombuffer(x[f], kind) for x in c["found"]]).astype(np.int64)
            idx, least, most = join("idx", np.uint32), join("least", np.uint8), join("most", np.uint8)
            of = np.searchsorted(pieces[:, _LO], idx, "right") - 1
            at = idx - pieces[of, _LO] + pieces[of, _AT]
            order = np.argsort(of, kind="stable")
            for g in np.split(order, np.flatnonzero(np.diff(of[order])) + 1):
                covered = merged(np.stack([at[g] - most[g], at[g] - least[g] + length], axis=1))
                keys = [np.full(len(covered), pieces[of[g[0]], k]) for k in (_K1, _K2)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*keys, covered[:, 0].copy(), covered[:, 1].copy())], schema.names)

    found = repeats.groupBy("cid").agg(F.collect_list(F.struct("idx", "least", "most")).alias("found"))
    return state.select("cid", "pieces").join(found, "cid").mapInArrow(run, schema)


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.withColumns({"_k1": F.xxhash64(whole), "_k2": F.xxhash64(F.lit(7), whole)})


def repeated_spans(docs: DataFrame, length: int = 400, text: str = "text") -> DataFrame:
    """(k1, k2, start, end): bytes of the texts, by a 128-bit hash of theirs, that some repeated string of ``length`` bytes covers.

    Equal texts have one key and the same spans; spans of a text may touch or overlap.
    """
    period, depths = plan(length)
    texts = _keyed(docs.select(F.col(f"`{text}`").alias("text")).where(F.col("text").isNotNull()), "text").select(
        F.col("_k1").alias("k1"), F.col("_k2").alias("k2"), "text")
    found = cut(_anchors(texts, length), "blocks")
    often = found.groupBy("gram").agg(F.count(F.lit(1)).alias("_n"), F.max("again").alias("_a")).where("_n > 1 or _a").select("gram")
    found = cut(found.join(often, "gram", "left_semi"), "candidates")
    classes = cut(found.groupBy("gram", "block", "run").agg(F.count(F.lit(1)).alias("n"), F.max("again").alias("again"), F.min(F.struct("k1", "k2", "start")).alias("one")), "classes")
    same = classes.where("n > 1").select(*[F.col(c).alias(f"_{c}") for c in ("gram", "block", "run")])
    member = (F.col("gram") == F.col("_gram")) & (F.col("block") == F.col("_block")) & (F.col("run") == F.col("_run"))
    whole = found.join(same, member, "left_semi").select("k1", "k2", "start", (F.col("start") + F.col("run") + length - 1).alias("end")).distinct()
    mixed = classes.groupBy("gram").agg(F.count(F.lit(1)).alias("_n"), F.max("again").alias("_a")).where("_n > 1 or _a").select("gram")
    places = classes.join(mixed, "gram", "left_semi").groupBy("one.k1", "one.k2").agg(F.collect_list(F.struct("one.start", "run")).alias("places"))
    one_each = texts.where(F.octet_length("text") >= length).groupBy("k1", "k2").agg(F.first("text").alias("text"))
    state = chunks = cut(_chunks(one_each.join(places, ["k1", "k2"]), length, period), "chunks")
    size = chunks.agg(F.sum("bytes").alias("s")).first().s
    if not size:
        return whole
    samples = size * len(COVERS[period]) // period + 1
    tasks = -(-samples // PER_TASK)
    for level in range(len(depths)):
        named = cut(_named(state, period, depths, level, tasks, samples), f"names-{level}")
        state = chunks.join(named.groupBy("cid").agg(F.collect_list(F.struct("idx", "names")).alias("named")), "cid")
    spans = _spans(chunks, _repeats(state, length, period, depths, tasks), length)
    return whole.unionByName(spans)


def drop_repeats(docs: DataFrame, length: int = 400, text: str = "text") -> DataFrame:
    """``docs`` with ``kept`` (binary: the text's UTF-8 bytes left), ``n_bytes``, ``n_removed`` and ``n_spans``.

    Each byte covered by a string of ``length`` bytes that starts anywhere else too, in the same text or another, is removed;
    strings are judged on the input. Spans are maximal removed runs. Null texts count as empty; texts
    shorter than ``length`` keep all; repeated rows are texts like others, so long ones lose all;
    texts may be as long as a row may be; an empty table gives no rows. Further columns stay; those
    named like the new ones are replaced.
    """
    kind = {"kept": "binary", "n_bytes": "long", "n_removed": "long", "n_spans": "long"}
    stay = [c for c in docs.columns if c not in kind]
    schema = T.StructType([*[docs.schema[c] for c in stay], *T._parse_datatype_string(", ".join(f"{k} {t}" for k, t in kind.items())).fields])
    by_text = cut(repeated_spans(docs, length, text), "spans").groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "end")).alias("_spans"))
    packed = _keyed(docs.select(F.struct(*[F.col(f"`{c}`") for c in stay]).alias("row"), F.col(f"`{text}`").alias("text")), "text")
    here = packed.join(by_text, (F.col("_k1") == F.col("k1")) & (F.col("_k2") == F.col("k2")), "left").select("row", "_spans")

    def run(batches):
        for whole in batches:
            for b in (whole.slice(i, 200) for i in range(0, whole.num_rows, 200)):
                out, columns = [], b.column("row").flatten()
                for data, spans in zip(columns[stay.index(text)].cast(pa.binary()).to_pylist(), b.column("_spans").to_pylist()):
                    data = data or b""
                    gone = merged(np.array([(s["start"], s["end"]) for s in spans or ()], np.int64)).tolist()
                    left = b"".join(data[a:z] for a, z in zip([0, *[z for _, z in gone]], [*[a for a, _ in gone], len(data)]))
                    out.append((left, len(data), len(data) - len(left), len(gone)))
                columns += [pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.int64(), pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return here.mapInArrow(run, schema)
