"""Greedy bursts of events per key, by functions of chunks that are composed.

A fail opens a burst with a deadline; fails up to it join, the first one after it
opens the next burst, and a success ends what is open. Who opens the next burst depends on
who opened the last, along the whole life of a key. But what a *chunk* of a key's events
does to the deadline it is entered with is a small function: a step function with
a step per fail of the first ``within`` of the chunk, as later ones can't be reached by an earlier
deadline, and most of those lead to the same end. So

1. each chunk (bounded in rows: long ones are cut) gives the table of its function, all chunks of a batch
   at once, with binary searches and pointer doubling over arrays;
2. a stream over the tables, one deadline in memory, gives each chunk the deadline it is entered with;
3. each chunk gives its part of every burst in it, again in arrays, and the parts of a burst that
   crosses chunks are added up.

No task needs more than a chunk of a key.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.operators.scan import HOT_CHUNK, add_split_chunk, stitch

#: Deadline where no burst is open; end of a table for deadlines that outlast the chunk.
NONE, PASS = -(1 << 62), 1 << 62
#: Rows taken at a time; whole chunks, so more where one chunk has more.
BATCH = 100_000
DAY_US = 86_400_000_000


def _codes(column: pa.Array) -> list[np.ndarray]:
    """Integer arrays that change wherever the column's value does."""
    if pa.types.is_struct(column.type):
        return [c for child in column.flatten() for c in _codes(child)]
    return [column.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)]


def _starts(table: pa.Table, part: Sequence[str]) -> np.ndarray:
    """First row of each group of equal ``part`` columns, which are sorted."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for name in part:
        for code in _codes(table.column(name).combine_chunks()):
            new[1:] |= code[1:] != code[:-1]
    return np.flatnonzero(new)


def whole_groups(batches: Iterator[pa.RecordBatch], part: Sequence[str], rows: int = BATCH) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of about ``rows`` sorted rows that hold whole groups, with each group's first row."""
    held, size, want = [], 0, rows
    for b in batches:
        held.append(b)
        size += b.num_rows
        if size < want:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        starts = _starts(table, part)
        if len(starts) == 1:  # one long group so far
            held, want = table.to_batches(), 2 * size
            continue
        cut = int(starts[-1])
        yield table.slice(0, cut).combine_chunks(), starts[:-1]
        held, size, want = table.slice(cut).to_batches(), table.num_rows - cut, rows
    if size:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, _starts(table, part)


class _Fails:
    """The fails of some groups of events in order, and what a burst opened by each leads to within its group."""

    def __init__(self, table: pa.Table, starts: np.ndarray, within: int):
        ts, ok = table.column("ts_us").to_numpy(), table.column("_ok").to_numpy().astype(bool)
        n = table.column("_n").to_numpy()
        ends = np.append(starts[1:], len(ts))
        group = np.repeat(np.arange(len(starts)), ends - starts)
        before = np.cumsum(ok) - ok  # successes ahead of each event
        total = np.append(before, ok.sum())
        self.first_ts, self.base, self.successes = ts[starts], total[starts], total[ends] - total[starts]
        at = np.flatnonzero(~ok)
        self.ts, self.n, self.group, self.run = ts[at], n[at], group[at], before[at]
        self.head, self.tail = np.searchsorted(self.group, np.arange(len(starts))), np.searchsorted(self.group, np.arange(len(starts)), "right")
        self.end = self.tail[self.group]  # behind the last fail of the same group
        spread = int((ts[ends - 1] - ts[starts]).max(initial=0)) + within + 2
        line = self.group * spread + (self.ts - self.first_ts[self.group])
        run = self.run + self.group  # no two groups share a run
        self.next_run = np.minimum(np.searchsorted(run, run, "right"), self.end)
        self.next = np.minimum(np.searchsorted(line, line + within, "right"), self.next_run)
        ok_ts = np.append(ts[ok], PASS)
        closes = self.run < self.base[self.group] + self.successes[self.group]
        self.success_ts = np.where(closes, ok_ts[self.run], PASS)  # of the success after each fail
        last = np.where(self.next < self.end, self.next, np.arange(len(at)))
        while True:
            further = last[last]
            if (further == last).all():
                break
            last = further
        self.out = np.where(closes[last], NONE, self.ts[last] + within)
        self.group_first_success = np.where(self.successes > 0, ok_ts[np.minimum(self.base, len(ok_ts) - 1)], PASS)
        self.after_success = np.minimum(np.searchsorted(run, self.base + np.arange(len(starts)), "right"), self.tail)  # first fail behind the first success


def _tables(within: int, part: Sequence[str], names: list[str]):
    """(part, upper, out, rest) per group: a deadline below upper[i], but not below the one before it, leads to out[i];
    one that none is above leads to ``rest``, or stays as it is if that is ``PASS``."""

    def run(batches):
        for table, starts in whole_groups(batches, part):
            f = _Fails(table, starts, within)
            early = f.run == f.base[f.group]  # no success before
            ahead = np.append(NONE, f.ts[:-1])
            ahead[f.head[f.head < f.tail]] = NONE
            here = np.flatnonzero(early & (ahead < f.first_ts[f.group] + within))
            same = (f.out[here][1:] == f.out[here][:-1]) & (f.group[here][1:] == f.group[here][:-1])
            here = here[np.append(~same, True)[: len(here)]]
            offsets = np.append(np.searchsorted(f.group[here], np.arange(len(starts))), len(here)).astype(np.int32)
            behind = np.append(f.out, NONE)[np.minimum(f.after_success, len(f.out))]
            rest = np.where(f.successes == 0, PASS, np.where(f.after_success < f.tail, behind, NONE))
            lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(x)) for x in (f.ts[here], f.out[here])]
            heads = table.select(list(part)).take(pa.array(starts))
            yield from pa.table([*[heads.column(c) for c in part], *lists, pa.array(rest)], names=names).to_batches()

    return run


def _entered(part: Sequence[str], names: list[str]):
    """Streams the tables of each key in order: the deadline each chunk is entered with, the number of the
    chunk that opened that burst, and its own number."""
    group = part[:-1]

    def run(batches):
        now, deadline, origin, no = None, NONE, 0, 0
        for b in batches:
            out = []
            for *key, upper, after, rest in zip(*(b.column(c).to_pylist() for c in (*group, "upper", "out", "rest"))):
                if key != now:
                    now, deadline, origin, no = key, NONE, 0, 0
                out.append((deadline, origin, no))
                i = bisect_right(upper, deadline)
                if i < len(upper) or rest != PASS:
                    deadline, origin = after[i] if i < len(upper) else rest, no
                no += 1
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in part], *[pa.array(c, pa.int64()) for c in zip(*out)]], names)

    return run


def _parts(within: int, part: Sequence[str], key: str, names: list[str]):
    """(key, first_u, origin, nth, last_u, n, cancelled): each chunk's part of its bursts.

    A burst that may go on in the next chunk has ``nth`` -1; the chunk that opened it tells it from others.
    """

    def run(batches):
        for table, starts in whole_groups(batches, part):
            f = _Fails(table, starts, within)
            deadline, origin, no = (table.column(c).to_numpy()[starts] for c in ("_deadline", "_origin", "_no"))
            late = f.ts > deadline[f.group]
            late |= f.run > f.base[f.group]
            order = np.append(np.flatnonzero(late), len(late))
            first = order[np.searchsorted(order, f.head)]  # the first fail of each group that opens a burst
            opens = np.zeros(len(f.ts), bool)
            now = first[first < f.tail]
            while len(now):
                opens[now] = True
                now = f.next[now][f.next[now] < f.end[now]]
            # fails before it go to the burst open on entry
            joined = f.head < np.minimum(first, f.tail)
            early_end = np.minimum(first, f.tail)
            sums = np.append(0, np.cumsum(f.n))
            cancels = (deadline > NONE) & (f.group_first_success <= deadline)
            some = np.flatnonzero((deadline > NONE) & (joined | cancels))
            last = np.where(joined, np.append(f.ts, 0)[np.maximum(early_end - 1, 0)], deadline - within)
            here = np.flatnonzero(opens)
            stop = np.minimum(np.append(here[1:], len(f.ts)), f.end[here]) if len(here) else here
            rows = np.concatenate([starts[some], starts[f.group[here]]])
            columns = [np.concatenate(x) for x in (
                (deadline[some] - within, f.ts[here]), (origin[some], no[f.group[here]]),
                (np.full(len(some), -1), np.where((f.success_ts[here] == PASS) & (f.next[here] >= f.end[here]), -1, here)), (last[some], f.ts[np.maximum(stop - 1, 0)] if len(here) else f.ts[:0]),
                ((sums[early_end] - sums[f.head])[some], sums[stop] - sums[here]), (cancels[some], f.success_ts[here] <= f.ts[here] + within))]
            yield from pa.table([table.column(key).take(pa.array(rows)), *map(pa.array, columns)], names=names).to_batches()

    return run


def greedy_bursts(df: DataFrame, key: str, within_us: int, chunk_us: int = 90 * DAY_US, limit: int = HOT_CHUNK) -> DataFrame:
    """(key, first_u, last_u, fail_count, cancelled) of each burst of rows whose ``event_type`` is 'fail'.

    Rows are ordered by (ts_us, seq), of equal ones fails first; any other type is a success, which
    cancels the open burst if it comes by its deadline. Rows without a time are left out; a null key is a key.
    """
    events = df.where(F.col("ts_us").isNotNull()).select(key, "ts_us", "seq", (F.coalesce(F.col("event_type") != "fail", F.lit(True))).cast("int").alias("_ok"))
    events = add_split_chunk(events, [key], "ts_us", "seq", chunk_us, limit=limit)
    part = [key, "_chunk"]
    events = events.groupBy(*part, "ts_us", "seq", "_ok").agg(F.count(F.lit(1)).alias("_n"))
    order = [*part, "ts_us", "seq", "_ok"]
    heads = [events.schema[c] for c in part]
    long = T.LongType()
    table = T.StructType([*heads, T.StructField("upper", T.ArrayType(long)), T.StructField("out", T.ArrayType(long)), T.StructField("rest", long)])
    tables = events.repartition(*part).sortWithinPartitions(*order).mapInArrow(_tables(within_us, part, table.names), table)
    entry = T.StructType([*heads, *[T.StructField(c, long) for c in ("_deadline", "_origin", "_no")]])
    entered = tables.repartition(key).sortWithinPartitions(*part).mapInArrow(_entered(part, entry.names), entry)
    found = T.StructType([heads[0], *[T.StructField(c, long) for c in ("first_u", "origin", "nth", "last_u", "n")], T.StructField("cancelled", T.BooleanType())])
    rows = stitch(events, entered, part).repartition(*part).sortWithinPartitions(*order)
    parts = rows.mapInArrow(_parts(within_us, part, key, found.names), found)
    whole = parts.groupBy(key, "first_u", "origin", "nth").agg(F.max("last_u").alias("last_u"), F.sum("n").alias("fail_count"), F.max("cancelled").alias("cancelled"))
    return whole.drop("origin", "nth")
