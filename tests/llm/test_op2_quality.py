"""Quality rules: statistics against plain loops, trees against recursion, monotonic directions, held-out accuracy."""

import random

import numpy as np

from tidepool.llm import quality as q

SF = "/root/testdata/sf0.01"


def slow_counts(text):
    words, w = [], ""
    for c in text + " ":
        if c in " \t\n\v\f\r":
            words += [w] if w else []
            w = ""
        else:
            w += c
    dup, seen = 0, []
    for line in text.split("\n"):
        if line.strip(" \t\n\v\f\r"):
            dup += line in seen
            seen.append(line)
    at = {}
    for i in range(len(words) - 7):
        at.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {p for starts in at.values() if len(starts) > 1 for s in starts for p in range(s, s + 8)}
    return [len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)]


def test_counts_equal_plain_loops():
    rng = random.Random(4)
    vocabulary = ["a", "b", "Ä", "x#", "é|<", "\x85", "\xa0b", "the"]
    texts = ["", " \n", "\x1c", "a\n\na\n \n a", "a " * 9, "a " * 8] + [
        "".join(rng.choice(vocabulary) + rng.choice([" ", "\n", "\t", "  ", "\r\n"]) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    for t in texts:
        assert q.statistics(t.encode())[0] == slow_counts(t), t


def test_repeats_in_pieces(monkeypatch):
    rng = random.Random(5)
    t = " ".join(rng.choices(["aa", "b", "cc"], k=3000))
    whole = q.statistics(t.encode())
    pieces = q.word_pieces
    monkeypatch.setattr(q, "word_pieces", lambda b: pieces(b, 64))
    assert q.statistics(t.encode()) == whole


def walk(trees, x):
    total = trees.bias
    for node in trees.roots:
        for _ in range(trees.depth):
            node = trees.left[node] if x[trees.feature[node]] <= trees.threshold[node] else trees.right[node]
        total += trees.value[node]
    return total


def test_flat_scoring_and_monotonic_directions():
    rng = np.random.default_rng(6)
    x = rng.random((1500, 4))
    y = ((x[:, 0] - x[:, 1] + 0.3 * np.sin(9 * x[:, 2]) + 0.2 * rng.normal(size=1500)) > 0).astype(float)
    trees = q.fit_trees(x, y, [1, -1, 0, 0], n_trees=30)
    assert np.allclose(trees.margin(x[:200]), [walk(trees, r) for r in x[:200]])
    assert ((trees.score(x) > 0.5) == (y > 0.5)).mean() > 0.85
    for f, sign in ((0, 1), (1, -1)):
        for row in x[:100]:
            line = np.repeat(row[None], 41, axis=0)
            line[:, f] = np.linspace(-0.2, 1.2, 41)
            assert (sign * np.diff(trees.margin(line)) >= -1e-12).all()


def test_one_class_or_no_rows():
    assert (q.fit_trees(np.ones((5, 2)), np.ones(5), [0, 0]).score(np.zeros((3, 2))) > 0.5).all()
    assert (q.fit_trees(np.zeros((0, 2)), np.zeros(0), [0, 0]).score(np.zeros((3, 2))) > 0.5).all()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    trees = q.fit(docs, labels.where("doc_id % 2 = 0"))
    held = q.judge(docs, trees).join(labels.where("doc_id % 2 = 1"), "doc_id").select("quality", "score").toPandas()
    assert ((held.score >= 0.5) == (held.quality == 1)).mean() > 0.95
    assert (held.score[held.quality == 1] >= 0.5).mean() > 0.97


def test_edge_rows(spark):
    good = "".join(f"word{i} " for i in range(40))
    rows = [(1, good, 1), (2, None, 1), (3, "", 1), (4, "a " * 50, 1), (4, "a " * 50, 1), (None, good, 1), (5, good * 3000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, KEPT int")
    labels = spark.createDataFrame([(1, 1, 0)] * 20 + [(4, 0, 0)] * 20 + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    got = q.judge(docs, q.fit(docs, labels, max_labels=100))
    assert got.columns == ["doc_id", "text", *q._STATS.names]
    kept = sorted((str(r.doc_id), r.base_failed, r.kept) for r in got.collect())
    assert kept == [("1", False, True), ("2", True, False), ("3", True, False), ("4", True, False), ("4", True, False), ("5", True, False), ("None", False, True)]
    assert q.judge(docs.limit(0), q.fit(docs, labels.limit(0))).collect() == []
