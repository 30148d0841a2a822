"""Quality verdicts: gradient-boosted trees over document statistics.

Statistics are taken from whole texts in one pass. The trees are fitted on the driver
from at most ``MAX_LABELS`` labelled rows (those of the smallest id hash), with
logistic loss and histograms of quantile bins. On chosen statistics they are
monotonic: more symbols, repeats or capitals never raise the score. They are
flattened into node arrays, so that a batch is scored level by level for all
trees at once. Base rules reject a document before the trees are asked.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.llm.textio import parts, utf8, word_pieces

#: Most labelled rows a model is fitted on.
MAX_LABELS = 20_000
WINDOW = 8
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Statistics the trees see, and the direction in which each may move the score (0: either).
FEATURES = {
    "symbols_per_word": -1, "dup_line_share": -1, "repeat_share": -1, "same_as_before_share": -1, "upper_share": -1,
    "bar_share": -1, "exclamations_per_word": -1, "digit_share": 0, "punctuation_share": 0, "distinct_share": 0, "word_length": 0,
    "words_per_line": 0, "log_words": 0, "non_ascii_share": 0,
}
_SPACES = [0x20, *range(0x09, 0x0E)]
_SYMBOLS = list(b"#*$%&|<>")
_PUNCTUATION = list(b".,;:?!'\"()-")


def repeated_window_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Positions inside windows of ``window`` words that occur twice or more."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    mixed = np.zeros(n, np.uint64)
    for j in range(window):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + (ids[j: j + n].astype(np.uint64) + np.uint64(1))
    ordered = np.sort(mixed)
    if not (ordered[1:] == ordered[:-1]).any():
        return 0  # equal windows have equal hashes
    exact = ids.astype(np.int64)
    for j in range(1, window):  # exact numbers of windows of j + 1 words
        pairs = exact[: len(exact) - 1] * (int(ids.max()) + 1) + ids[j:]
        exact = np.unique(pairs, return_inverse=True)[1]
    twice = (np.bincount(exact) > 1)[exact]
    cover = np.zeros(len(ids) + 1, np.int64)
    cover[:n] += twice
    cover[window: window + n] -= twice
    return int((np.cumsum(cover)[:-1] > 0).sum())


def statistics(text: bytes) -> tuple[list[int], list[float]]:
    """(COUNTS, FEATURES) of a UTF-8 text."""
    number: dict[bytes, int] = {}
    parts = [np.fromiter([number.setdefault(w, len(number)) for w in words], np.int64, len(words)) for words in word_pieces(text)]
    ids = parts[0] if len(parts) == 1 else np.concatenate(parts)
    n = len(ids)
    octets = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    spaces = int(octets[_SPACES].sum())
    chars = int(octets[:0x80].sum() + octets[0xC0:].sum()) - spaces
    seen: set[bytes] = set()
    lines = dup = 0
    for line in text.split(b"\n"):
        if line and not line.isspace():
            lines += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    symbols = int(octets[_SYMBOLS].sum())
    repeat = repeated_window_words(ids)
    per_word, per_char = max(n, 1), max(chars, 1)
    features = [
        symbols / per_word, dup / max(lines, 1), repeat / per_word, float((ids[1:] == ids[:-1]).sum()) / per_word,
        float(octets[65:91].sum()) / per_char, float(octets[0x7C]) / per_word, float(octets[0x21]) / per_word,
        float(octets[48:58].sum()) / per_char, float(octets[_PUNCTUATION].sum()) / per_char, len(number) / per_word, chars / per_word,
        n / max(lines, 1), float(np.log1p(n)), float(octets[0xC0:].sum()) / per_char]
    return [n, chars, symbols, dup, repeat], features


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 20 or 100 * n_repeat_words > 30 * n_words


# -- trees ----------------------------------------------------------------------------------------

@dataclass
class Trees:
    """Node arrays of all trees: go left where x[feature] <= threshold; a leaf leads to itself."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    bias: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log odds of good quality for each row of statistics."""
        out = np.full(len(x), self.bias)
        for i in range(0, len(x), 4096):
            rows = x[i: i + 4096]
            node = np.broadcast_to(self.roots, (len(rows), len(self.roots)))
            at = np.arange(len(rows))[:, None]
            for _ in range(self.depth):
                node = np.where(rows[at, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            out[i: i + 4096] += self.value[node].sum(axis=1)
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of good quality for each row of statistics."""
        return 1 / (1 + np.exp(-self.margin(x)))


def fit_trees(x: np.ndarray, y: np.ndarray, directions: list[int], n_trees: int = 60, depth: int = 4,
              rate: float = 0.2, penalty: float = 1.0, bins: int = 64, min_weight: float = 2.0) -> Trees:
    """Boosted trees for 0/1 labels; rows of one class only give a constant."""
    share = float(np.clip(y.mean() if len(y) else 1.0, 1e-4, 1 - 1e-4))
    bias = float(np.log(share / (1 - share)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins)[1:-1])) if len(x) else np.zeros(0) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)], axis=1) if len(x) else x.astype(int)
    nodes: list[list[float]] = []  # feature, threshold, left, right, value
    roots: list[int] = []
    margin = np.full(len(x), bias)

    def leaf(value: float) -> int:
        nodes.append([0, np.inf, len(nodes), len(nodes), rate * value])
        return len(nodes) - 1

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, low: float, high: float, left_depth: int) -> int:
        G, H = g[rows].sum(), h[rows].sum()
        best_value = float(np.clip(-G / (H + penalty), low, high))
        if left_depth == 0 or len(rows) < 2:
            return leaf(best_value)
        cost = lambda G, H, w: G * w + (H + penalty) * w * w / 2
        best = None
        for f, e in enumerate(edges):
            if not len(e):
                continue
            b = binned[rows, f]
            GL = np.bincount(b, g[rows], len(e) + 1).cumsum()[:-1]
            HL = np.bincount(b, h[rows], len(e) + 1).cumsum()[:-1]
            wl = np.clip(-GL / (HL + penalty), low, high)
            wr = np.clip(-(G - GL) / (H - HL + penalty), low, high)
            gain = cost(G, H, best_value) - cost(GL, HL, wl) - cost(G - GL, H - HL, wr)
            gain[(HL < min_weight) | (H - HL < min_weight) | (directions[f] * (wr - wl) < 0)] = -np.inf
            k = int(gain.argmax())
            if gain[k] > 1e-6 and (best is None or gain[k] > best[0]):
                best = (gain[k], f, k, wl[k], wr[k])
        if best is None:
            return leaf(best_value)
        _, f, k, wl, wr = best
        mid = (wl + wr) / 2
        at = len(nodes)
        nodes.append([f, edges[f][k], 0, 0, 0.0])
        goes_left = binned[rows, f] <= k
        bounds = {0: ((low, high), (low, high)), 1: ((low, mid), (mid, high)), -1: ((mid, high), (low, mid))}[directions[f]]
        for slot, (part, limits) in enumerate(zip((rows[goes_left], rows[~goes_left]), bounds)):
            nodes[at][2 + slot] = grow(part, g, h, *limits, left_depth - 1)
        return at

    if len(np.unique(y)) > 1:
        for _ in range(n_trees):
            p = 1 / (1 + np.exp(-margin))
            first = len(nodes)
            roots.append(grow(np.arange(len(x)), p - y, p * (1 - p), -np.inf, np.inf, depth))
            margin += _flatten(nodes, [roots[-1]], depth, 0.0).margin(x)
            if len(nodes) - first == 1:
                break
    return _flatten(nodes or [[0, np.inf, 0, 0, 0.0]], roots or [0], depth, bias)


def _flatten(nodes: list[list[float]], roots: list[int], depth: int, bias: float) -> Trees:
    a = np.array(nodes, float)
    return Trees(np.array(roots), a[:, 0].astype(int), a[:, 1], a[:, 2].astype(int), a[:, 3].astype(int), a[:, 4], depth, bias)


# -- Spark ----------------------------------------------------------------------------------------

_STATS = T.StructType([*[T.StructField(c, T.LongType()) for c in COUNTS], T.StructField("base_failed", T.BooleanType()),
                       T.StructField("score", T.DoubleType()), T.StructField("kept", T.BooleanType())])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality",
        max_labels: int = MAX_LABELS, **options) -> Trees:
    """Trees from the labelled documents; rows without id, label or document are left out.

    At most ``max_labels`` labels are used, those of the smallest hash of their
    id. They are sent to the executors (16 bytes each) and their documents'
    statistics come back; texts do not.
    """
    chosen = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label}`").cast("double").alias("y")).dropna()
    chosen = chosen.orderBy(F.xxhash64("id"), "id", "y").limit(max_labels)
    marked = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text")).join(F.broadcast(chosen), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            x = [statistics(t)[1] for t in utf8(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("y"), pa.array(x, pa.list_(pa.float64()))], ["id", "y", "x"])

    schema = T.StructType([marked.schema["id"], T.StructField("y", T.DoubleType()), T.StructField("x", T.ArrayType(T.DoubleType()))])
    # a repeated id could bring many documents for one label: the bound holds for rows as well
    rows = marked.select("id", "y", "text").mapInArrow(run, schema).orderBy(F.xxhash64("id"), "id", "y", "x").limit(max_labels).collect()
    x = np.array([r["x"] for r in rows], float).reshape(len(rows), len(FEATURES))
    return fit_trees(x, np.array([r["y"] > 0.5 for r in rows], float), list(FEATURES.values()), **options)


def judge(docs: DataFrame, trees: Trees, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """Columns of ``docs`` with COUNTS, ``base_failed``, ``score`` and ``kept`` (columns so named are replaced).

    A null or empty text counts as one without words, which fails the base rules. Repeated rows
    are judged alike, each by itself; texts may be as long as a row may be, their words are taken a piece at a time. An
    empty table gives no rows.
    """
    names = {f.name for f in _STATS}
    others = [c for c in docs.columns if c.lower() not in names]
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in others], F.lit(0).alias("_")).alias("kept_columns"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            stats = [statistics(t) for t in utf8(b.column("text"))]
            counts = np.array([s[0] for s in stats], np.int64).reshape(-1, len(COUNTS))
            score = trees.score(np.array([s[1] for s in stats], float).reshape(-1, len(FEATURES)))
            failed = np.array([base_failed(c[0], c[4]) for c in counts.tolist()], bool)
            arrays = [*[pa.array(counts[:, i]) for i in range(len(COUNTS))], pa.array(failed), pa.array(score), pa.array(~failed & (score >= threshold))]
            yield pa.RecordBatch.from_arrays([b.column("kept_columns"), *arrays], ["kept_columns", *_STATS.names])

    out = source.mapInArrow(run, T.StructType([source.schema["kept_columns"], *_STATS.fields]))
    return out.select(*[F.col(f"kept_columns.`{c}`").alias(c) for c in others], *_STATS.names)
