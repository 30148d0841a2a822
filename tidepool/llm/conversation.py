"""Repair of conversation structure by iterative-deepening A*.

The rows of a conversation are edited, in order, until the initials of their
roles read ``(s?(ua)+)?``: an optional system turn, then user and assistant in
turns. Keep costs 0, Rerole 1, Delete 2 and Insert 5; a truncated row that is not
deleted costs 5 more, and blank or repeated rows must go. The search is
depth-first in ASCII order of the edits' initials (D, I, K, R) under a cost bound that
grows by one until a path is accepted, so the first accepting path is the cheapest
repair and, of those, the one whose initials come first. States that failed
are kept in a transposition table with the budget they failed with.

Long conversations are searched in pieces of ``PIECE`` rows. A piece is
searched for each state it may be entered and left in; two streams over one small row per
piece (costs from the end, then the way from the start) settle the states, and
each piece is searched once more for its own edits. No task holds a
conversation, only a piece of it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.llm.scratch import cut

#: Rows and bytes of text of one piece.
PIECE = 64
PIECE_BYTES = 8 << 20
BLANKS = " \t\n\v\f\r"
NEVER = 1 << 40
START, SYSTEM, USER, ASSISTANT = range(4)
DELETE, INSERT, RETRUNC, REROLE = 2, 5, 5, 1
#: What is still to be inserted behind the last row, by state: nothing, user and assistant, assistant, nothing.
END = (0, 2 * INSERT, INSERT, 0)
CLEAN, BLANK, DUPLICATE, TRUNCATED = range(4)
#: State after the next user or assistant turn, which the state before it decides.
NEXT = (USER, USER, ASSISTANT, USER)
_KEPT = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}


def lower_bounds(initials: str, faults: list[int]) -> list[int]:
    """For each row, a cost that the rows from it on can't stay under.

    Rows to be deleted cost 2, truncated ones at least as much, and roles other
    than system, user and assistant 1. Two clean rows of one role side by side cost 1 between them.
    """
    n = len(initials)
    low = [DELETE if f else int(r == "o") for r, f in zip(initials, faults)]
    rest = [0] * (n + 2)
    for i in range(n - 1, -1, -1):
        rest[i] = low[i] + rest[i + 1]
        if i + 1 < n and initials[i] == initials[i + 1] and not (faults[i] or faults[i + 1]):
            rest[i] = max(rest[i], 1 + rest[i + 2])
    return rest[: n + 1]


def search(initials: str, faults: list[int], entry: int, leave: tuple[int, ...], failed: dict | None = None) -> tuple[int, str, int] | None:
    """(cost, edits, state left in) of the cheapest repair of some rows, or None.

    ``leave`` is the cost still to come for each state the rows may be left
    in. Of equal costs the edits that come first in ASCII order win. ``failed`` may be
    shared by searches of the same rows with the same ``leave``.
    """
    n, failed = len(initials), {} if failed is None else failed
    rest, least = lower_bounds(initials, faults), min(leave)
    if leave[USER] >= NEVER and leave[ASSISTANT] >= NEVER:  # at most a system row stays
        if entry > SYSTEM or (leave[entry] >= NEVER and (entry == SYSTEM or "s" not in initials)):
            return None
        rest = [max(r, DELETE * (n - i - 1)) for i, r in enumerate(rest)]
    bound, most = rest[0] + least, DELETE * n + 2 * INSERT + max(x for x in leave if x < NEVER)

    def options(i: int, state: int, budget: int) -> Iterator[tuple[str, int, int, int]]:
        """Edits in ASCII order: (initial, next row, next state, budget left)."""
        yield "D", i + 1, state, budget - DELETE
        yield "I", i, NEXT[state], budget - INSERT
        if faults[i] in (BLANK, DUPLICATE):
            return
        budget -= RETRUNC * (faults[i] == TRUNCATED)
        kept = _KEPT.get((initials[i], state))
        if kept is not None:
            yield "K", i + 1, kept, budget
        if kept != NEXT[state]:
            yield "R", i + 1, NEXT[state], budget - REROLE

    while bound <= most:
        if bound > failed.get((0, entry), -1):
            path, stack = [], [(0, entry, bound, options(0, entry, bound))]
            while stack:
                i, state, budget, left = stack[-1]
                for edit, j, after, b in left:
                    if b < rest[j] + least:
                        continue
                    if j == n:
                        if b >= leave[after]:
                            return bound - b + leave[after], "".join(path) + edit, after
                    elif b > failed.get((j, after), -1):
                        path.append(edit)
                        stack.append((j, after, b, options(j, after, b)))
                        break
                else:
                    stack.pop()
                    failed[i, state] = max(failed.get((i, state), -1), budget)
                    if path:
                        path.pop()
        bound += 1
    return None


def ways(initials: str, faults: list[int]) -> tuple[list[int], list[int]]:
    """A piece's 16 costs, by state entered and left, and for each state entered the states
    left in the order of their edits."""
    costs, order = [], []
    tables: list[dict] = [{} for _ in range(4)]
    for entry in range(4):
        found = [search(initials, faults, entry, tuple(0 if s == e else NEVER for s in range(4)), tables[e]) for e in range(4)]
        costs += [f[0] if f else NEVER for f in found]
        order += sorted(range(4), key=lambda e: (found[e] is None, found[e] and found[e][1]))
    return costs, order


def apply_edits(edits: str, roles: list[str], texts: list[str], entry: int) -> list[tuple[str, str]]:
    """The rows that ``edits`` leave of ``roles`` and ``texts``, inserted ones included."""
    out, i, state = [], 0, entry
    for edit in edits:
        if edit == "K":
            state = _KEPT[_initial(roles[i]), state]
            out.append((roles[i], texts[i]))
        elif edit in "IR":
            state = NEXT[state]
            out.append(("user" if state == USER else "assistant", texts[i] if edit == "R" else ""))
        i += edit != "I"
    return out


def _initial(role: str) -> str:
    return role[0] if role[:1] in ("s", "u", "a") else "o"


_LINES = "array<struct<role:string,text:string>>"


def _pieces(rows: DataFrame, key: T.StructField, piece: int) -> DataFrame:
    """Sorted rows cut into pieces of one conversation: (conv, part, no, n, initials, faults, roles, texts, illegal)."""
    schema = T.StructType([key, *T._parse_datatype_string(
        "part int, no long, n int, initials string, faults array<int>, roles array<string>, texts array<string>, illegal int").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, no = TaskContext.get().partitionId(), 0
        conv, held, size, waiting = None, [], 0, 0
        done: list[tuple] = []

        def close():
            nonlocal held, size, no, waiting
            if held:
                initials, roles = "".join(_initial(r) for r, _, _ in held), [r for r, _, _ in held]
                illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
                done.append((conv, part, no, len(held), initials, [f for *_, f in held], roles, [t for _, t, _ in held], illegal))
                no, waiting = no + 1, waiting + size
            held, size = [], 0

        def batch():
            nonlocal done, waiting
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), kinds)], schema.names)
            done, waiting = [], 0
            return out

        kinds = None
        for b in batches:
            kinds = kinds or [b.schema.field("conv").type, pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.string()),
                              pa.list_(pa.string()), pa.int32()]
            for c, role, text, fault, again, copies in zip(*(b.column(x).to_pylist() for x in ("conv", "role", "text", "fault", "again", "copies"))):
                if c != conv:
                    close()
                    conv = c
                for k in range(copies):
                    f = DUPLICATE if fault != BLANK and (again or k) else fault
                    held.append((role, "" if f in (BLANK, DUPLICATE) else text, f))
                    size += len(held[-1][1])
                    if len(held) == piece or size >= PIECE_BYTES:
                        close()
                    if len(done) >= 500 or waiting >= PIECE_BYTES:
                        yield batch()
        close()
        if done:
            yield batch()

    return rows.mapInArrow(run, schema)


def _entered(pieces: DataFrame, key: T.StructField) -> DataFrame:
    """(conv, part, no, entry, leave, joint) of the pieces of conversations that have several.

    Each piece is summed up in its 16 costs; one stream from the last piece back gives the cheapest
    cost to the end from every state, one from the first on takes the states. ``joint`` is 1 where
    the piece's first row follows the last row before it against the pattern.
    """
    fields = T._parse_datatype_string
    summed = T.StructType([key, *fields("part int, no long, costs array<long>, rank array<int>, head string, tail string").fields])

    def sum_up(batches):
        for b in batches:
            found = [ways(i, f) for i, f in zip(b.column("initials").to_pylist(), b.column("faults").to_pylist())]
            roles = b.column("roles").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column("conv"), b.column("part"), b.column("no"), pa.array([f[0] for f in found], pa.list_(pa.int64())), pa.array([f[1] for f in found], pa.list_(pa.int32())),
                 pa.array([r[0][:1] for r in roles], pa.string()), pa.array([r[-1][:1] for r in roles], pa.string())], summed.names)

    backed = T.StructType([*summed.fields, *fields("ahead array<long>").fields])

    def back(batches):
        conv, ahead = [], END
        for b in batches:
            out = []
            for c, costs in zip(b.column("conv").to_pylist(), b.column("costs").to_pylist()):
                if [c] != conv:
                    conv, ahead = [c], END
                out.append(list(ahead))
                ahead = tuple(min(costs[4 * s + e] + ahead[e] for e in range(4)) for s in range(4))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.list_(pa.int64()))], backed.names)

    taken = T.StructType([key, *fields("part int, no long, entry int, leave int, joint int").fields])

    def forth(batches):
        conv, state, before = [], START, ""
        for b in batches:
            out = []
            for c, costs, rank, ahead, head, tail in zip(*(b.column(x).to_pylist() for x in ("conv", "costs", "rank", "ahead", "head", "tail"))):
                joint = int([c] == conv and before + head not in ("su", "ua", "au"))
                if [c] != conv:
                    conv, state = [c], START
                total = [costs[4 * state + e] + ahead[e] for e in range(4)]
                to = next(e for e in rank[4 * state: 4 * state + 4] if total[e] == min(total))
                out.append((state, to, joint))
                state, before = to, tail
            yield pa.RecordBatch.from_arrays([b.column("conv"), b.column("part"), b.column("no"), *[pa.array(c, pa.int32()) for c in zip(*out)]], taken.names)

    sums = cut(pieces.mapInArrow(sum_up, summed), "ways")
    down = sums.repartition("conv").sortWithinPartitions("conv", F.desc("part"), F.desc("no")).mapInArrow(back, backed)
    return down.repartition("conv").sortWithinPartitions("conv", "part", "no").mapInArrow(forth, taken)


def _edited(pieces: DataFrame, key: T.StructField) -> DataFrame:
    """Each piece with its cost, audit and repaired turns, given the states it is entered and left in (null: a whole conversation)."""
    schema = T.StructType([key, *T._parse_datatype_string(
        f"part int, no long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, turns {_LINES}").fields])
    line = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

    def run(batches):
        for b in batches:
            out = []
            for initials, faults, roles, texts, illegal, entry, to, joint, last in zip(
                    *(b.column(x).to_pylist() for x in ("initials", "faults", "roles", "texts", "illegal", "entry", "leave", "joint", "last"))):
                entry = START if entry is None else entry
                cost, audit, state = search(initials, faults, entry, END if to is None else tuple(0 if e == to else NEVER for e in range(4)))
                if last:
                    cost += 0 if to is None else END[state]
                    audit += "I" * (END[state] // INSERT)
                turns = apply_edits(audit, roles, texts, entry)
                out.append((faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED), illegal + (joint or 0), cost, audit,
                            [{"role": r, "text": t} for r, t in turns]))
            kinds = [pa.int64()] * 5 + [pa.string(), line]
            yield pa.RecordBatch.from_arrays([b.column("conv"), b.column("part"), b.column("no"), *[pa.array(c, t) for c, t in zip(zip(*out), kinds)]], schema.names)

    return pieces.mapInArrow(run, schema)


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           piece: int = PIECE) -> DataFrame:
    """Repaired conversations in pieces: (``conv``, part, no, blank, duplicate, truncated, illegal, cost, audit, turns).

    The pieces of a conversation in order of (part, no) hold its repaired turns; counts, costs and audits of
    pieces add up. Rows stand in order of turn, nulls first, equal turns by role and then text. A row's first fault
    counts: blank (no character but white space), duplicate (role and text seen earlier in the
    conversation), truncated (last such character not ``.``, ``!`` or ``?``). Null roles and texts read as one
    space; rows whose conversation is null are a conversation of their own; rows equal in all four
    columns are copies, of which the first may stay; further columns are ignored, whatever their names; texts may be
    as long as a row may be; an empty table gives no rows.
    """
    key = T.StructField("conv", rows.schema[conv].dataType)
    d = rows.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
                    F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"))
    d = d.groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    d = d.withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(1), "text")})
    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = d.groupBy(F.col("conv").alias("_c"), F.col("role").alias("_r"), F.col("h1").alias("_h1"), F.col("h2").alias("_h2")).agg(F.min(when).alias("_first"))
    same = F.col("conv").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))
    end = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    fault = F.when(end == "", BLANK).when(~end.isin(".", "!", "?"), TRUNCATED).otherwise(CLEAN)
    d = d.join(first, same, "inner").select("conv", "turn", "role", "text", "copies", (~when.eqNullSafe(F.col("_first"))).alias("again"), fault.alias("fault"))
    d = d.repartitionByRange("conv", "turn", "role", F.substring("text", 1, 100)).sortWithinPartitions("conv", "turn", "role", "text")
    pieces = cut(_pieces(d, key, piece), "pieces")
    ends = pieces.groupBy(F.col("conv").alias("_c")).agg(F.count(F.lit(1)).alias("_n"), F.max(F.struct("part", "no")).alias("_last"))
    told = pieces.join(ends, F.col("conv").eqNullSafe(F.col("_c")))
    told = told.withColumn("last", F.struct("part", "no") == F.col("_last")).drop("_c", "_last")
    none = F.lit(None).cast("int")
    whole = told.where("_n = 1").withColumns({"entry": none, "leave": none, "joint": none})
    long = told.where("_n > 1")
    states = _entered(long, key).select(F.col("part").alias("_p"), F.col("no").alias("_i"), "entry", "leave", "joint")
    long = long.join(states, (F.col("part") == F.col("_p")) & (F.col("no") == F.col("_i"))).select(whole.columns)
    return _edited(whole.unionByName(long), key).withColumnRenamed("conv", conv)


def summary(rows: DataFrame, repaired: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """One row per conversation of ``rows``: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``gaps`` are the turn numbers missing between the least and the greatest. The digest is that of the
    repaired ``role:text`` lines, joined by newlines; the pieces are streamed through it in order.
    """
    key = repaired.schema[conv]
    counts = ("blank", "duplicate", "truncated", "illegal", "cost")
    schema = T.StructType([key, *T._parse_datatype_string(", ".join(f"{c} long" for c in counts) + ", audit string, repaired_sha256 string").fields])

    def run(batches):
        now, sums, audit, digest, begun, kind = [], None, None, None, False, None
        done: list[tuple] = []
        for b in batches:
            kind = b.schema.field(conv).type
            for c, *values, edits, turns in zip(*(b.column(x).to_pylist() for x in (conv, *counts, "audit", "turns"))):
                if [c] != now:
                    if now:
                        done.append((now[0], *sums, "".join(audit), digest.hexdigest()))
                    now, sums, audit, digest, begun = [c], [0] * len(counts), [], hashlib.sha256(), False
                sums = [x + y for x, y in zip(sums, values)]
                audit.append(edits)
                for t in turns:
                    digest.update((("\n" if begun else "") + f"{t['role']}:{t['text']}").encode())
                    begun = True
            if done:
                yield _rows(done, kind)
                done = []
        if now:
            yield _rows([(now[0], *sums, "".join(audit), digest.hexdigest())], kind)

    def _rows(done, kind):
        kinds = [kind, *[pa.int64()] * len(counts), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), kinds)], schema.names)

    ordered = repaired.repartition(F.col(f"`{conv}`")).sortWithinPartitions(f"`{conv}`", "part", "no").mapInArrow(run, schema)
    t = F.col(f"`{turn}`")
    gaps = rows.groupBy(F.col(f"`{conv}`").alias("_c")).agg(F.coalesce(F.max(t) - F.min(t) + 1 - F.countDistinct(t), F.lit(0)).cast("long").alias("gaps"))
    return ordered.join(gaps, F.col(f"`{conv}`").eqNullSafe(F.col("_c"))).select(key.name, "gaps", *counts, "audit", "repaired_sha256")
