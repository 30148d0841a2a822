"""User-written aggregate functions: create, add, merge, result, and a window hook.

An ``Aggregate`` says how an accumulator starts, takes rows, merges with another and
ends. Every task keeps accumulators of the keys it sees and sends them as binary
rows; they are merged in two levels, first in ``FAN_IN`` parts of each key, then whole, each level a
stream over sorted rows with one accumulator in memory. Rows never travel and no task
holds the rows of a key or a window. Sliding windows accumulate panes, whose accumulators are
copied to the windows they belong to and merged there.

Built-in functions of Spark are faster where there is one; this is for those that there aren't.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions.timecols import floor_div, pane_end, parse_duration_us
from tidepool.operators.bursts import _codes

#: Parts in which the accumulators of a key are merged first; accumulators a task keeps before it sends them.
FAN_IN, HELD = 32, 20_000


class Aggregate:
    """Subclass and say how rows are accumulated. Instances are sent to the executors."""

    #: Columns that ``add`` reads, and the result's columns (DDL).
    inputs: Sequence[str] = ()
    output = ""

    def create(self) -> Any:
        raise NotImplementedError

    def add(self, acc: Any, rows: pa.Table) -> Any:
        """``acc`` with some rows of one key (of ``inputs``); called once per key and batch."""
        raise NotImplementedError

    def merge(self, a: Any, b: Any) -> Any:
        raise NotImplementedError

    def result(self, acc: Any) -> tuple:
        raise NotImplementedError

    def window(self, key: dict, result: tuple) -> tuple:
        """What a window function makes of a result, given the key's columns (window bounds among them)."""
        return result

    def dump(self, acc: Any) -> bytes:
        return pickle.dumps(acc, protocol=5)

    def load(self, data: bytes) -> Any:
        return pickle.loads(data)


class Count(Aggregate):
    output = "cnt long"

    def create(self):
        return 0

    def add(self, acc, rows):
        return acc + rows.num_rows

    def merge(self, a, b):
        return a + b

    def result(self, acc):
        return (acc,)


class Mean(Aggregate):
    """Mean of a column's numbers, nulls aside; null without any."""

    def __init__(self, column: str, name: str = "mean"):
        self.inputs, self.output = (column,), f"{name} double"

    def create(self):
        return 0.0, 0

    def add(self, acc, rows):
        column = rows.column(0)
        return acc[0] + (pc.sum(column).as_py() or 0.0), acc[1] + len(column) - column.null_count

    def merge(self, a, b):
        return a[0] + b[0], a[1] + b[1]

    def result(self, acc):
        return (acc[0] / acc[1] if acc[1] else None,)


class TopK(Aggregate):
    """The ``k`` rows of the greatest ``by``, ties by ``of`` ascending, as an array of ``of``; null ``by`` or ``of`` don't count."""

    def __init__(self, by: str, of: str, k: int, kind: str = "long", name: str = "top"):
        self.inputs, self.output, self.k = (by, of), f"{name} array<{kind}>", k

    def create(self):
        return []

    def add(self, acc, rows):
        rows = rows.drop_null()
        if not rows.num_rows:
            return acc
        few = rows.take(pc.select_k_unstable(rows, self.k, [(self.inputs[0], "descending"), (self.inputs[1], "ascending")]))
        return self.merge(acc, list(zip(few.column(0).to_pylist(), few.column(1).to_pylist())))

    def merge(self, a, b):
        return heapq.nsmallest(self.k, [*a, *b], key=lambda x: (-x[0], x[1]))

    def result(self, acc):
        return ([of for _, of in acc],)


def _partial(agg: Aggregate, keys: Sequence[str], names: list[str], held: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        accs: dict[tuple, Any] = {}
        salt, kinds = TaskContext.get().partitionId() % FAN_IN, None

        def flush():
            columns = list(zip(*accs)) or [()] * len(keys)
            out = pa.RecordBatch.from_arrays([*[pa.array(c, k) for c, k in zip(columns, kinds)], pa.array([salt] * len(accs), pa.int32()),
                                              pa.array([agg.dump(a) for a in accs.values()], pa.binary())], names)
            accs.clear()
            return out

        for b in batches:
            if not b.num_rows:
                continue
            kinds = kinds or [b.schema.field(k).type for k in keys]
            codes = [c for k in keys for c in _codes(b.column(k))]
            order = np.lexsort(codes) if codes else np.arange(b.num_rows)
            new = np.zeros(b.num_rows, bool)
            new[0] = True
            for c in codes:
                new[1:] |= c[order][1:] != c[order][:-1]
            starts = np.flatnonzero(new)
            rows = pa.Table.from_batches([b]).take(pa.array(order))
            heads = rows.select(list(keys)).take(pa.array(starts)).to_pydict()
            inputs = rows.select(list(agg.inputs))
            for *key, a, z in zip(*(heads[k] for k in keys), starts.tolist(), [*starts[1:].tolist(), b.num_rows]):
                key = tuple(key)
                part = inputs.slice(a, z - a) if agg.inputs else rows.slice(a, z - a)
                accs[key] = agg.add(accs[key] if key in accs else agg.create(), part)
            if len(accs) >= held:
                yield flush()
        if accs:
            yield flush()

    return run


def _merged(agg: Aggregate, keys: Sequence[str], names: list[str], last: bool):
    """Accumulators of sorted rows merged where the keys are equal; their results if ``last``."""

    def run(batches):
        now, acc, kinds, done = None, None, None, []

        def emit():
            columns = [pa.array([k[i] for k, _ in done], kind) for i, kind in enumerate(kinds)]
            if last:
                results = [agg.window(dict(zip(keys, k)), agg.result(a)) for k, a in done]
                columns += [pa.array(c, t) for c, t in zip(zip(*results), out_kinds)]
            else:
                columns.append(pa.array([agg.dump(a) for _, a in done], pa.binary()))
            done.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        for b in batches:
            kinds = kinds or [b.schema.field(k).type for k in keys]
            for *key, data in zip(*(b.column(k).to_pylist() for k in keys), b.column("_acc").to_pylist()):
                other = agg.load(data)
                if key == now:
                    acc = agg.merge(acc, other)
                    continue
                if now is not None:
                    done.append((now, acc))
                    if len(done) >= 1000:
                        yield emit()
                now, acc = key, other
        if now is not None:
            done.append((now, acc))
            yield emit()

    if last:
        from pyspark.sql.pandas.types import to_arrow_schema
        out_kinds = [f.type for f in to_arrow_schema(T._parse_datatype_string(agg.output))]
    return run


def _finish(parts: DataFrame, keys: Sequence[str], agg: Aggregate) -> DataFrame:
    heads = [parts.schema[k] for k in keys]
    half = T.StructType([*heads, T.StructField("_acc", T.BinaryType())])
    whole = T.StructType([*heads, *T._parse_datatype_string(agg.output).fields])
    few = parts.repartition(*keys, "_salt").sortWithinPartitions(*keys, "_salt").mapInArrow(_merged(agg, keys, half.names, False), half)
    few = few.repartition(*keys) if keys else few.repartition(1)
    return few.sortWithinPartitions(*keys).mapInArrow(_merged(agg, keys, whole.names, True), whole) if keys else few.mapInArrow(_merged(agg, keys, whole.names, True), whole)


def _accumulators(df: DataFrame, keys: Sequence[str], agg: Aggregate, held: int) -> DataFrame:
    schema = T.StructType([*[df.schema[k] for k in keys], T.StructField("_salt", T.IntegerType()), T.StructField("_acc", T.BinaryType())])
    needed = list(dict.fromkeys([*keys, *agg.inputs]))
    return df.select(*needed or [F.lit(1).alias("_one")]).mapInArrow(_partial(agg, list(keys), schema.names, held), schema)


def aggregate(df: DataFrame, keys: Sequence[str], agg: Aggregate, held: int = HELD) -> DataFrame:
    """One row per key: the keys and ``agg``'s result. Null keys are a key; no rows give no keys."""
    return _finish(_accumulators(df, keys, agg, held), list(keys), agg)


def window_aggregate(df: DataFrame, keys: Sequence[str], agg: Aggregate, size, slide=None, ts_col: str = "ts_us", held: int = HELD) -> DataFrame:
    """(keys, window_start, window_end in ms, result) of tumbling, or with ``slide`` sliding, event-time windows.

    Rows are accumulated by pane; a pane's accumulator goes to each window that holds it.
    Rows without a time are in no window.
    """
    size_us, slide_us = parse_duration_us(size), parse_duration_us(slide or size)
    if size_us % slide_us:
        raise ValueError("slide must divide size")
    panes = df.where(F.col(ts_col).isNotNull()).withColumn("_pane", pane_end(F.col(ts_col), slide_us))
    accs = _accumulators(panes, [*keys, "_pane"], agg, held)
    ends = F.explode(F.sequence(F.col("_pane"), F.col("_pane") + F.lit(size_us - slide_us), F.lit(slide_us)))
    if size_us == slide_us:
        ends = F.col("_pane")
    else:  # a pane's accumulators are merged before they are copied
        schema = T.StructType([*[accs.schema[k] for k in (*keys, "_pane")], T.StructField("_acc", T.BinaryType())])
        by_pane = [*keys, "_pane"]
        accs = (accs.repartition(*by_pane, "_salt").sortWithinPartitions(*by_pane, "_salt").mapInArrow(_merged(agg, by_pane, schema.names, False), schema)
                    .withColumn("_salt", F.pmod(F.xxhash64("_pane"), F.lit(FAN_IN)).cast("int")))
    windows = accs.withColumn("_end", ends).select(*keys, floor_div(F.col("_end") - F.lit(size_us), 1000).alias("window_start"),
                                                   floor_div(F.col("_end"), 1000).alias("window_end"), "_salt", "_acc")
    return _finish(windows, [*keys, "window_start", "window_end"], agg)
