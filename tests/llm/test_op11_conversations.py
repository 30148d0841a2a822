"""Conversation repair against Dijkstra over whole edit strings, in whole and in pieces, and odd rows."""

import hashlib
import heapq
import random
import zlib

import pytest

from tidepool.llm import conversation as cv
from tidepool.llm import registry

SCHEMA = "conv_id long, turn long, role string, text string"
EMPTY = hashlib.sha256().hexdigest()


def model(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, digest) of rows in order, by best-first search over (cost, edits)."""
    faults, seen = [], set()
    for _, role, text in rows:
        body = text.strip(" \t\n\v\f\r")
        faults.append("blank" if not body else "dup" if (role, text) in seen else "trunc" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, edits, i, last, out = heapq.heappop(heap)
        if i == len(rows) and last in ("", "a"):
            text = "\n".join(f"{r}:{t}" for r, t in out)
            return (gaps, faults.count("blank"), faults.count("dup"), faults.count("trunc"), illegal, cost, edits, hashlib.sha256(text.encode()).hexdigest())
        if (i, last) in done:
            continue
        done.add((i, last))
        turn = "assistant" if last == "u" else "user"
        heapq.heappush(heap, (cost + 5, edits + "I", i, turn[0], (*out, (turn, ""))))
        if i == len(rows):
            continue
        _, role, text = rows[i]
        heapq.heappush(heap, (cost + 2, edits + "D", i + 1, last, out))
        if faults[i] not in ("blank", "dup"):
            more = 5 if faults[i] else 0
            heapq.heappush(heap, (cost + 1 + more, edits + "R", i + 1, turn[0], (*out, (turn, text))))
            if role[:1] == turn[0] or (role[:1] == "s" and not last):
                heapq.heappush(heap, (cost + more, edits + "K", i + 1, role[:1], (*out, (role, text))))
    raise AssertionError


def ordered(rows):
    fill = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(fill, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2].encode()))


def run(spark, rows, **how):
    df = spark.createDataFrame(rows, SCHEMA)
    got = cv.summary(df, cv.repair(df, **how)).collect()
    return {r.conv_id: tuple(r)[1:] for r in got}


def some_rows(rng, n):
    roles = rng.choice([["user", "assistant"], ["system", "user", "assistant"], ["user", "u2", "assistant", "tool", "", None, "system"]])
    texts = ["Yes.", "No!", "cut", "", " \n", None, "x?\t", "a. b", "é.", "Yes. "] + [f"t{i}." for i in range(12)]
    return [(rng.choice([None, *range(n)]) if rng.random() < 0.1 else i, rng.choice(roles), rng.choice(texts)) for i in range(n)]


def test_search_is_the_cheapest_and_first(spark):
    rng = random.Random(5)
    convs = {k: some_rows(rng, rng.randrange(1, 12)) for k in range(150)} | {1000 + k: some_rows(rng, 40) for k in range(6)} | {None: some_rows(rng, 5)}
    rows = [(k, *r) for k, rs in convs.items() for r in rs]
    want = {k: model(ordered(rs)) for k, rs in convs.items()}
    assert run(spark, rows) == want
    assert run(spark, rows, piece=3) == want
    assert run(spark, rows, piece=1) == want


def test_pieces_sum_up_to_the_whole():
    rng = random.Random(6)
    for _ in range(60):
        n = rng.randrange(1, 7)
        initials, faults = "".join(rng.choice("suao") for _ in range(n)), [rng.randrange(4) for _ in range(n)]
        costs, rank = cv.ways(initials, faults)
        for entry in range(4):
            found = cv.search(initials, faults, entry, cv.END)
            assert found[0] == min(costs[4 * entry + e] + cv.END[e] for e in range(4))
            assert sorted(rank[4 * entry: 4 * entry + 4]) == [0, 1, 2, 3]


def test_long_conversation_in_bounded_pieces(spark):
    """A third of all rows in one conversation, many of them copies of one row."""
    rng = random.Random(7)
    hot = some_rows(rng, 400) + [(7, "user", "Again.")] * 200
    convs = {1: hot} | {k: some_rows(rng, 4) for k in range(2, 300)}
    rows = [(k, *r) for k, rs in convs.items() for r in rs]
    assert run(spark, rows) == {k: model(ordered(rs)) for k, rs in convs.items()}
    df = spark.createDataFrame(rows, SCHEMA)
    assert max(r.n for r in cv.repair(df).selectExpr("length(audit) as n").collect()) < 3 * cv.PIECE


def test_very_long_text_and_clashing_columns(spark):
    rows = [(1, 0, "user", "x" * 3_000_000 + "."), (1, 1, "assistant", "y " * 1_000_000)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS conv", "'a' AS copies", "2 AS part", "3 AS no", "4 AS h1", "5 AS `_c`", "6 AS cost")
    got = cv.summary(df, cv.repair(df)).collect()
    assert [tuple(r)[1:] for r in got] == [model(ordered([r[1:] for r in rows]))]


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert cv.repair(df).count() == 0 and cv.summary(df, cv.repair(df)).count() == 0 and registry.op11_digest(df).count() == 0


def test_query_damages_by_checksum(spark):
    rng = random.Random(8)
    rows = [(k, i, rng.choice(["user", "assistant", None]), rng.choice(["Hm. Yes!", "No.", None])) for k in range(60) for i in [None, *range(rng.randrange(0, 6))]]
    damaged = {k: [] for k, *_ in rows}
    for k, turn, role, text in rows:
        x = zlib.crc32(f"{k}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if x == 1 else "".join(c for c in text if c not in ".!?") if x == 2 else text
        damaged[k] += [(turn, "user" if x == 4 else role, text)] * {0: 0, 3: 2}.get(x, 1)
    got = {r.conv_id: tuple(r)[1:] for r in registry.op11_digest(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {k: model(ordered(rs)) for k, rs in damaged.items()}
    assert (0, 0, 0, 0, 0, 0, "", EMPTY) in got.values()


@pytest.mark.parametrize("faults", [0, cv.TRUNCATED])
def test_search_time_grows_slowly(faults):
    import time
    began = time.time()
    cv.ways("u" * cv.PIECE, [faults] * cv.PIECE)
    cv.search("ua" * 5000, [0] * 10000, 0, cv.END)
    assert time.time() - began < 10
