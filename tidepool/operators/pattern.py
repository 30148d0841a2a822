"""Event patterns of any number of steps per key: begin, next, followedBy, within.

    p = (Pattern.begin("first", fail).next("second", fail).followed_by("later", login)
         .within("2 hours"))
    matches, timeouts = match_sequence(logins, ["user_id"], p)

Every begin row is judged alone, so overlapping matches come out. From the row that
takes a step the next one is taken by the very next row of the key (``next``) or
by the first later row that fits (``followed_by``), so what follows a step
is a function of the row that took it. All steps' functions are found in one
sort by window functions that run backwards, the last step's first.

A match lies within ``d`` of its begin row, so rows are cut into time buckets with the
rows of the next ``d`` copied to them, and one shuffle on (key, bucket) does. A bucket with very many
rows of a key is cut into chunks instead. What a chunk does to a pattern that enters it
pending at a step is a table with an entry per step: steps taken and where it is
left, or that it failed. A stream over the tables composes them from the last chunk back, and rows left
pending at their chunk's end go on from there. So no task needs all rows of a key or a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions.timecols import floor_div, parse_duration_us
from tidepool.operators.scan import HOT_CHUNK, add_chunk, cut_buckets, hot_buckets, stitch
from tidepool.operators.sequence import ORDER, bucket_width, with_neighbours


class Step(NamedTuple):
    name: str
    where: Column
    strict: bool


class Pattern:
    """Steps in order and the time a match may take, first to last, exclusive."""

    def __init__(self, steps: Sequence[Step], within_us: int | None = None):
        self.steps, self.within_us = tuple(steps), within_us
        if len({s.name for s in steps}) < len(steps):
            raise ValueError("steps need names of their own")

    @classmethod
    def begin(cls, name: str, where: Column) -> Pattern:
        return cls([Step(name, where, False)])

    def next(self, name: str, where: Column) -> Pattern:
        """The very next row of the key has to fit."""
        return Pattern([*self.steps, Step(name, where, True)], self.within_us)

    def followed_by(self, name: str, where: Column) -> Pattern:
        """The first later row that fits; those between are passed over."""
        return Pattern([*self.steps, Step(name, where, False)], self.within_us)

    def within(self, duration) -> Pattern:
        return Pattern(self.steps, parse_duration_us(duration))


def _fate(row: T.DataType, rows=None, stop=None, left=None) -> Column:
    """What becomes of a pattern: rows that take its further steps, time of the row that failed it, step it is left pending at."""
    kind = T.StructType([T.StructField("rows", T.ArrayType(row)), T.StructField("stop", T.LongType()), T.StructField("left", T.IntegerType())])
    return F.struct((F.array() if rows is None else rows).alias("rows"), (F.lit(None) if stop is None else stop).alias("stop"),
                    F.lit(left).alias("left")).cast(kind)


def _on(fate: Column, then: Column) -> Column:
    """``fate`` carried on by ``then``, the fate of what it left pending."""
    return F.struct(F.concat(fate["rows"], then["rows"]).alias("rows"), then["stop"].alias("stop"), then["left"].alias("left"))


def _chains(d: DataFrame, part: Sequence[str], steps: Sequence[Step], row: T.StructType) -> DataFrame:
    """Adds ``_h2`` .. ``_hm``, the fate from each row if it takes that step, and ``_g1``, that of each begin row."""
    me = F.struct(*[F.col(f.name) for f in row.fields])
    back = Window.partitionBy(*part).orderBy(*[F.col(c).desc() for c in ORDER])
    before = back.rowsBetween(Window.unboundedPreceding, -1)
    last = len(steps)
    for k in range(last, 1, -1):  # step k is taken by a row; what it leads to was found for step k before
        follow = F.col(f"_g{k}") if k < last else _fate(row)
        d = d.withColumn(f"_h{k}", F.when(F.col(f"_p{k}"), F.struct(F.concat(F.array(me), follow["rows"]).alias("rows"), follow["stop"].alias("stop"),
                                                                   follow["left"].alias("left"))))
        if steps[k - 1].strict:
            after = F.lag(F.struct(F.col(f"_h{k}").alias("h"), F.col("ts_us").alias("u"))).over(back)
            d = d.withColumn("_after", after)
            g = F.when(F.col("_after").isNull(), _fate(row, left=k - 1)).when(F.col("_after.h").isNotNull(), F.col("_after.h")).otherwise(
                _fate(row, stop=F.col("_after.u")))
            d = d.withColumn(f"_g{k - 1}", g).drop("_after")
        else:
            d = d.withColumn(f"_g{k - 1}", F.coalesce(F.last(f"_h{k}", ignorenulls=True).over(before), _fate(row, left=k - 1)))
    return d.drop(*[f"_g{k}" for k in range(2, last + 1)])


def _tables(d: DataFrame, part: Sequence[str], steps: Sequence[Step], row: T.StructType) -> DataFrame:
    """Each chunk's table: the fate of a pattern that enters it pending at step 1, 2, ..."""
    pos = F.struct(*ORDER)
    entries = []
    for k in range(2, len(steps) + 1):
        if steps[k - 1].strict:
            first = F.min_by(F.struct(F.col(f"_h{k}").alias("h"), F.col("ts_us").alias("u")), pos)
            entries.append(F.when(first["h"].isNotNull(), first["h"]).otherwise(_fate(row, stop=first["u"])))
        else:
            entries.append(F.coalesce(F.min_by(f"_h{k}", F.when(F.col(f"_p{k}"), pos)), _fate(row, left=k - 1)))
    return d.groupBy(*part).agg(F.array(*entries).alias("_table"))


def _carried(tables: DataFrame, group: Sequence[str]) -> DataFrame:
    """For each chunk the composed table of all later chunks of its group, streamed from the last one back."""
    schema = T.StructType([*tables.schema.fields[:-1], T.StructField("_carry", tables.schema["_table"].dataType)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, carry = None, None
        for b in batches:
            out = []
            for *key, table in zip(*(b.column(c).to_pylist() for c in (*group, "_table"))):
                if key != now:
                    now, carry = key, [{"rows": [], "stop": None, "left": k + 1} for k in range(len(table))]
                out.append(carry)
                carry = [t if t["left"] is None else {**carry[t["left"] - 1], "rows": t["rows"] + carry[t["left"] - 1]["rows"]} for t in table]
            kind = b.schema.field("_table").type
            yield pa.RecordBatch.from_arrays([*[b.column(f.name) for f in schema.fields[:-1]], pa.array(out, kind)], schema.names)

    return tables.repartition(*group).sortWithinPartitions(*group, F.desc("_chunk")).mapInArrow(run, schema)


def match_sequence(df: DataFrame, keys: Sequence[str], pattern: Pattern, payload: Sequence[str] = (),
                   limit: int = HOT_CHUNK) -> tuple[DataFrame, DataFrame]:
    """(matches, timeouts) of ``pattern`` over rows ordered per key by (ts_us, seq).

    A match has the keys and a struct (ts_us, seq, payload) named after each step. A begin row whose pattern is still pending
    when ``within`` has passed since it, or at the end of the input, is a timeout: the same columns, null for steps not
    taken, and ``timeout_us``. One whose ``next`` step met another row in time is neither. A step's
    condition that is null does not hold; null keys are a key of their own; rows without a time are left out.

    Whether there are buckets of more than ``limit`` rows is counted when the plan is made, by a job over keys and times. Rows that
    come to the input later don't change what is right, only how even the tasks are.
    """
    steps, keys = pattern.steps, list(keys)
    if pattern.within_us is None:
        raise ValueError("within() is needed")
    d = df.where(F.col("ts_us").isNotNull()).select(*keys, *ORDER, *payload, *[F.coalesce(s.where, F.lit(False)).alias(f"_p{k}") for k, s in enumerate(steps, 1)])
    row = T.StructType([d.schema[c] for c in (*ORDER, *payload)])
    row = T.StructType([T.StructField(f.name, f.dataType) for f in row.fields])
    if not any(s.strict for s in steps):
        any_step = F.lit(False)
        for k in range(1, len(steps) + 1):
            any_step = any_step | F.col(f"_p{k}")
        d = d.where(any_step)
    near = with_neighbours(d, "ts_us", pattern.within_us, after=True).withColumnRenamed("_bucket", "_home")
    group = [*keys, "_home"]
    bucketed = add_chunk(near, "ts_us", bucket_width(pattern.within_us), "_bucket")
    # a bucket has its own rows and at most those of the next
    own = floor_div(F.col("ts_us"), bucket_width(pattern.within_us))
    if d.groupBy(*keys, own.alias("_b")).count().where(F.col("count") > limit // 2).isEmpty():
        return _judged(_ended(_chains(near, group, steps, row), keys, "_g1"), keys, pattern)
    hot = hot_buckets(bucketed, group, "ts_us", "seq", limit)
    marked = F.broadcast(hot.select(*[F.col(c).alias(f"_m_{c}") for c in group]).distinct())
    same = [F.col(c).eqNullSafe(F.col(f"_m_{c}")) for c in group]
    ends = _ended(_chains(near.join(marked, same, "left_anti"), group, steps, row), keys, "_g1")

    part = [*group, "_chunk"]
    chunked = cut_buckets(bucketed.join(marked, same, "left_semi"), hot, group, "ts_us", "seq", near.columns)
    chained = _chains(chunked, part, steps, row)
    if len(steps) > 1:
        carry = _carried(_tables(chained, part, steps, row), group)
        left = F.col("_g1.left")
        on = _on(F.col("_g1"), F.element_at("_carry", left))
        begun = stitch(chained.where("_p1 and _copy = 0"), carry, part)
        chained = begun.withColumn("_g1", F.when(left.isNull(), F.col("_g1")).otherwise(on))
    return _judged(ends.unionByName(_ended(chained, keys, "_g1")), keys, pattern)


def _ended(d: DataFrame, keys: Sequence[str], fate: str) -> DataFrame:
    """Begin rows with their fate."""
    begun = d.where("_p1 and _copy = 0")
    rest = [c for c in d.columns if not c.startswith("_") and c not in keys]
    fates = F.col(fate) if fate in d.columns else F.lit(None)
    return begun.select(*keys, F.struct(*rest).alias("_first"), fates.alias("_fate"))


def _judged(ends: DataFrame, keys: Sequence[str], pattern: Pattern) -> tuple[DataFrame, DataFrame]:
    names, within = [s.name for s in pattern.steps], F.lit(pattern.within_us)
    if len(names) == 1:
        matches = ends.select(*keys, F.col("_first").alias(names[0]))
        return matches, matches.where(F.lit(False)).withColumn("timeout_us", F.lit(None).cast("long"))
    first, rows, stop = F.col("_first.ts_us"), F.col("_fate.rows"), F.col("_fate.stop")
    d = ends.withColumn("_rows", F.filter(rows, lambda r: r["ts_us"] - first < within))
    whole = F.size("_rows") == len(names) - 1
    failed = (F.size("_rows") == F.size(rows)) & F.coalesce(stop - first < within, F.lit(False))
    structs = [F.col("_first").alias(names[0]), *[F.get("_rows", F.lit(i)).alias(n) for i, n in enumerate(names[1:])]]
    return (d.where(whole).select(*keys, *structs),
            d.where(~whole & ~failed).select(*keys, *structs, (first + within).alias("timeout_us")))
