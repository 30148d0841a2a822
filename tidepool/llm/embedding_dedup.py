"""Near-duplicate vectors by PCA-ordered tiled comparison.

Vectors are scaled to length 1 and turned onto the principal axes of the
table. Two vectors of cosine t or more are at most sqrt(2 - 2t) apart, on
every axis and together. Labels that fit in a tile are one; of larger ones only cells
within that reach along the first axis are compared, tile by tile. A pair of tiles is sorted by the first
axis and cut into blocks, and pairs of blocks whose boxes on the leading axes are too far apart are passed
over. In the others the products of the leading axes
are accumulated first; what the other axes can still add is at most the
product of the suffix norms, and pairs that cannot reach the threshold are given
up. Survivors are verified by the cosine of the original vectors in double
precision.

Equal vectors are compared once, as a class with a weight. A pair of tiles
returns a row per class with its links counted and a link to the first member of its
local component, so no group yields more rows than it has members. Tiles have at
most about ``TILE`` classes, whatever the size of a label.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.llm.components import connected_components
from tidepool.llm.scratch import cut

#: Most vectors of a tile, and most numbers of one where vectors are wide; vectors of a block inside.
TILE, NUMBERS, BLOCK = 8192, 1 << 19, 1024
#: Cells along the first axis to one reach of the threshold, and axes of a block's box.
FINE, BOX = 1, 8
#: Rows of a second-moment matrix sent at a time, and parts in which the tasks' sums are added first.
BAND, SALT = 64, 16
SLACK = 1e-9


def axes(moments: np.ndarray, total: np.ndarray, n: int) -> np.ndarray:
    """Principal axes as columns, the one of most variance first."""
    mean = total / n
    values, vectors = np.linalg.eigh(moments / n - np.outer(mean, mean))
    return vectors[:, np.argsort(-values, kind="stable")]


class _Turned:
    """Vectors with their norms, their places on the axes and what is left of them behind each stop."""

    def __init__(self, x: np.ndarray, turn: np.ndarray):
        self.x, self.norm = x, np.sqrt(np.einsum("ij,ij->i", x, x))
        self.z = (x / self.norm[:, None]) @ turn
        self.rest = np.sqrt(np.maximum(0, np.cumsum((self.z * self.z)[:, ::-1], axis=1)[:, ::-1]))

    def suffix(self, rows: np.ndarray, k: int) -> np.ndarray:
        return self.rest[rows, k] if k < self.z.shape[1] else np.zeros(len(rows))


def close_pairs(a: np.ndarray, b: np.ndarray, turn: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the pairs of rows whose cosine in double precision is at least ``threshold``.

    With ``same`` (a is b) each pair comes once, the first index smaller.
    """
    left = _Turned(a, turn)
    right = left if same else _Turned(b, turn)
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + SLACK
    cut_ = lambda t: np.array_split(np.argsort(t.z[:, 0], kind="stable"), max(1, -(-len(t.z) // BLOCK)))
    blocks_a = cut_(left)
    blocks_b = blocks_a if same else cut_(right)
    box = lambda t, rows: (t.z[rows, :BOX].min(0), t.z[rows, :BOX].max(0))
    boxes_a, boxes_b = [box(left, r) for r in blocks_a if len(r)], [box(right, r) for r in blocks_b if len(r)]
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for p, (low_a, high_a) in enumerate(boxes_a):
        for q, (low_b, high_b) in enumerate(boxes_b):
            if same and q < p:
                continue
            gap = np.maximum(0, np.maximum(low_a - high_b, low_b - high_a))
            if gap @ gap <= reach * reach + SLACK:
                found.append(_close_blocks(left, blocks_a[p], right, blocks_b[q], threshold, same and p == q))
    i, j = (np.concatenate(x) for x in zip(*found))
    return (np.minimum(i, j), np.maximum(i, j)) if same else (i, j)


def _close_blocks(a: _Turned, rows_a: np.ndarray, b: _Turned, rows_b: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    width = a.z.shape[1]
    stops = sorted({min(width, s) for s in (8, 16, 32, 128)} | {width})
    products = a.z[rows_a, : stops[0]] @ b.z[rows_b, : stops[0]].T
    may = products + np.outer(a.suffix(rows_a, stops[0]), b.suffix(rows_b, stops[0])) >= threshold - SLACK
    i, j = np.nonzero(np.triu(may, 1) if same else may)
    so_far, i, j = products[i, j], rows_a[i], rows_b[j]
    for low, high in zip(stops, stops[1:]):
        so_far = so_far + _paired(a.z[:, low:high], b.z[:, low:high], i, j)
        may = so_far + a.suffix(i, high) * b.suffix(j, high) >= threshold - SLACK
        i, j, so_far = i[may], j[may], so_far[may]
    exact = _paired(a.x, b.x, i, j) / (a.norm[i] * b.norm[j])
    return i[exact >= threshold], j[exact >= threshold]


def _paired(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, step: int = 1 << 16) -> np.ndarray:
    out = np.empty(len(i))
    for s in range(0, len(i), step):
        out[s: s + step] = np.einsum("ij,ij->i", a[i[s: s + step]], b[j[s: s + step]])
    return out


def roots_of(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n nodes."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        for at in (i, j, label[i], label[j]):
            np.minimum.at(new, at, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _stack(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _moments(reps: DataFrame) -> dict[int, np.ndarray]:
    """Axes for each vector length with more vectors than a block; for others nothing is gained by turning.

    Tasks send bands of their second-moment matrices, which are added up in ``SALT`` parts and then whole. The driver
    holds width squared numbers of one length after the other.
    """
    counts = {r["width"]: r["n"] for r in reps.groupBy("width").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK).collect()}
    bands = T.StructType([T.StructField("band", T.IntegerType()), T.StructField("salt", T.IntegerType()), T.StructField("sums", T.BinaryType())])

    def batch(found: dict[tuple[int, int], np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k in found], pa.int32()), pa.array([k[1] for k in found], pa.int32()),
                                           pa.array([m.tobytes() for m in found.values()], pa.binary())], bands.names)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            for band, salt, sums in zip(*(b.column(c).to_pylist() for c in bands.names)):
                found[band, salt] = found.get((band, salt), 0) + np.frombuffer(sums)
        if found:
            yield batch(found)

    turns = {}
    for width, n in counts.items():
        def multiply(batches: Iterator[pa.RecordBatch], width: int = width) -> Iterator[pa.RecordBatch]:
            total = np.zeros((width + 1, width))
            for b in batches:
                x = _stack(b.column("vector"), width)
                x /= np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
                total[:width] += x.T @ x
                total[width] += x.sum(0)
            salt = TaskContext.get().partitionId() % SALT
            yield batch({(i, salt): total[i: i + BAND] for i in range(0, width + 1, BAND)})

        parts = reps.where(F.col("width") == width).select("vector").mapInArrow(multiply, bands)
        parts = parts.repartition("band", "salt").mapInArrow(add, bands).withColumn("salt", F.lit(0))
        found = {r["band"]: np.frombuffer(r["sums"]).reshape(-1, width) for r in parts.repartition("band").mapInArrow(add, bands).collect()}
        m = np.concatenate([found[i] for i in range(0, width + 1, BAND)])
        turns[width] = axes(m[:width], m[width], n)
    return turns


def near_duplicate_vectors(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector: str = "embedding",
                           label: str = "label", tile: int = TILE) -> DataFrame:
    """(id, ``n_links``, ``component_id``, ``kept``) for every row of ``vectors``.

    Rows are linked if their labels are equal and not null, their vectors of
    one length and their cosine at least ``threshold``, copies included.
    Vectors that are null, empty or zero or hold null or non-finite numbers
    link with nothing. ``component_id`` is the smallest id reachable, ``kept`` whether
    that is the row's own. Repeated rows are rows like others; further columns
    are ignored; an empty table gives no rows.
    """
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").alias("vector"))
    usable = F.coalesce(finite & F.col("label").isNotNull(), F.lit(False))
    rows = rows.select("id", "label", "vector", usable.alias("usable")).select(
        "id", "usable", F.when(F.col("usable"), F.col("label")).alias("label"), F.when(F.col("usable"), v).alias("vector"),
        F.xxhash64(v).alias("h1"), F.xxhash64(F.lit(1), v).alias("h2"), F.monotonically_increasing_id().alias("row"))
    rows = cut(rows, "vectors")
    key = ["label", "h1", "h2"]
    classes = cut(rows.where("usable").groupBy(*key).agg(F.min("row").alias("node"), F.min("id").alias("first"), F.count("*").alias("weight")), "classes")
    reps = rows.select("row", "label", "vector").join(classes.select("node", "weight"), F.col("row") == F.col("node")).select(
        "node", "label", "weight", "vector", F.size("vector").alias("width"))

    turns = vectors.sparkSession.sparkContext.broadcast(_moments(reps))  # width squared numbers of each length
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + SLACK
    schema = T.StructType([*reps.schema.fields, T.StructField("cell", T.LongType())])

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            widths = b.column("width").to_numpy()
            cell = np.zeros(b.num_rows, np.int64)
            for w in np.unique(widths).tolist():
                x = _stack(b.column("vector").filter(pa.array(widths == w)), w)
                first = (x @ turns.value[w][:, 0] if w in turns.value else x[:, 0]) / np.sqrt(np.einsum("ij,ij->i", x, x))
                cell[widths == w] = np.floor(first / (reach / FINE))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell)], schema.names)

    placed = cut(reps.mapInArrow(cells, schema), "cells")
    at, home = ["label", "width", "cell"], ["label", "width", "home"]
    most = F.least(F.lit(tile), F.greatest(F.lit(BLOCK // 2), F.floor(F.lit(NUMBERS) / F.col("width"))))
    cells_ = placed.groupBy(*at).agg(F.count("*").alias("n"))
    all_ = F.sum("n").over(Window.partitionBy("label", "width"))  # over cells, a few dozen a label
    cells_ = cells_.withColumn("home", F.when(all_ <= most, F.lit(0).cast("long")).otherwise(F.col("cell")))
    tiles = cells_.groupBy(*home).agg(F.ceil(F.sum("n") / F.first(most)).alias("tiles"))
    steps = F.sequence(F.lit(-FINE), F.lit(FINE))
    near = tiles.select("label", "width", "tiles", "home", F.explode(steps).alias("d")).select(
        "label", "width", (F.col("home") - F.col("d")).alias("home"), "d", "tiles").groupBy(*home).agg(
        F.map_from_entries(F.collect_list(F.struct("d", "tiles"))).alias("near"))  # 2 * FINE + 1 entries
    near = cells_.select(*at, "home").join(near, home).select(*at, "home", "near")
    rows_in = placed.join(near, at).drop("cell").withColumnRenamed("home", "cell").withColumn("tile", F.pmod(F.xxhash64("node"), F.element_at("near", F.lit(0))))

    def partners(d):
        n = F.coalesce(F.element_at(F.col("near"), d), F.lit(0))
        others = F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.array().cast("array<bigint>"))
        c, t, c2 = F.col("cell"), F.col("tile"), F.col("cell") + d
        left = lambda j: F.struct(c.alias("c"), t.alias("t"), c2.alias("c2"), j.alias("t2"), F.lit(True).alias("left"))
        right = lambda j: F.struct(c2.alias("c"), j.alias("t"), c.alias("c2"), t.alias("t2"), F.lit(False).alias("left"))
        return F.transform(others, lambda j: F.when((d > 0) | ((d == 0) & (j >= t)), left(j)).otherwise(right(j)))

    pairs = rows_in.withColumn("p", F.explode(F.flatten(F.transform(steps, partners)))).select(
        "label", "width", "p.c", "p.t", "p.c2", "p.t2", "p.left", "node", "weight", "vector")
    out = T.StructType([T.StructField("node", T.LongType()), T.StructField("links", T.LongType()), T.StructField("root", T.LongType())])

    def compare(table: pa.Table) -> pa.Table:
        width = table.column("width")[0].as_py()
        table = table.combine_chunks()
        left = table.column("left").to_numpy(zero_copy_only=False).astype(bool)
        node, weight = table.column("node").to_numpy(), table.column("weight").to_numpy()
        x = _stack(table.column("vector").combine_chunks(), width)
        same = table.column("c")[0] == table.column("c2")[0] and table.column("t")[0] == table.column("t2")[0]
        order = np.argsort(node, kind="stable")
        a = order[left[order]]
        b = a if same else order[~left[order]]
        turn = turns.value[width] if width in turns.value else np.eye(width)
        i, j = close_pairs(x[a], x[b], turn, threshold, same)
        i, j = a[i], b[j]
        links = np.zeros(len(node), np.int64)
        np.add.at(links, i, weight[j])
        np.add.at(links, j, weight[i])
        linked = np.flatnonzero(links)
        rank = np.empty(len(node), np.int64)
        rank[order] = np.arange(len(node))  # by node, so that the root is the smallest
        root = node[order][roots_of(len(node), rank[i], rank[j])][rank]
        return pa.Table.from_arrays([pa.array(node[linked]), pa.array(links[linked]), pa.array(root[linked])], out.names)

    found = cut(pairs.groupBy("label", "width", "c", "t", "c2", "t2").applyInArrow(compare, out), "tile-links")
    comps = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = classes.join(links, "node", "left").join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = joined.groupBy("component").agg(F.min("first").alias("component_id"))
    of_class = cut(joined.join(least, "component").select(
        *key, (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id"), "of-class")
    usable_rows = rows.where("usable").select("id", *key).join(of_class, key).select("id", "n_links", "component_id")
    alone = rows.where("not usable").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return usable_rows.union(alone).select(F.col("id").alias(id_col), "n_links", "component_id",
                                           F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
