"""Ordered scans per key that never put a whole key into one task.

A window function partitioned by a key sends every row of that key to one
task. When one key holds a third of the data that task is the job. Here the
rows of a key are cut into *chunks*, a function of the order that never
decreases (a time bucket of the ordering timestamp):

1. each chunk is scanned alone: a window over ``(key, chunk)``;
2. a one-row-per-chunk summary carries what earlier chunks contribute
   (an exclusive prefix over chunks: a window over ``key`` on the small
   summary, bounded by the number of chunks, i.e. by time span / width);
3. one equi-join on ``(key, chunk)`` stitches the two.

The summary is an aggregate of the input per (key, chunk): partial
aggregation shrinks it to one row per chunk and task before its shuffle, so
the second branch costs a scan of the few columns it needs and a small
shuffle. The stitch join meets a table with one row per chunk; adaptive
execution broadcasts it when its measured size is small and shuffles it
otherwise.

Work per task is bounded by the rows of one chunk, not of one key. Every
frame used here grows from ``UNBOUNDED PRECEDING``, which Spark evaluates
in one pass; "following" searches run on the reversed order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions.timecols import floor_div

_AGGS = {"sum": F.sum, "max": F.max, "min": F.min}


def _spec(keys: Sequence[str]):
    return Window.partitionBy(*keys) if keys else Window.partitionBy()


def _ordered(order: Sequence[str], descending: bool) -> list[Column]:
    return [F.col(c).desc() if descending else F.col(c).asc() for c in order]


def _pos(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def stitch(local: DataFrame, carry: DataFrame, part: Sequence[str], out: list | None = None) -> DataFrame:
    """Left join of scanned rows with their chunk's carry on ``part``, NULL-safe.

    NULL keys are a group like any other in a window, so they must meet their
    carry too; ``<=>`` also keeps the optimizer from inferring NOT NULL filters
    on one side only, which would stop the two branches sharing one shuffle.
    ``out`` is the final column list (names or expressions over both sides);
    by default the scanned rows' columns plus the carry's.
    """
    names = [c for c in carry.columns if c not in part]
    renamed = carry.select(*[F.col(c).alias(f"_k_{c}") for c in part], *names)
    cond = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in part]
    return local.join(renamed, on=cond, how="left").select(*(out or [*local.columns, *names]))


# Rows of one key and chunk beyond which the chunk is cut further, and how many chunks
# are cut at most: the largest, so any other has at most 1 / MOST_HOT of all rows.
HOT_CHUNK = 200_000
MOST_HOT = 200_000


def add_chunk(df: DataFrame, ts_col: str, width_us: int, name: str = "_chunk") -> DataFrame:
    """Chunk id = epoch-aligned bucket of ``ts_col`` (BIGINT microseconds)."""
    return df.withColumn(name, floor_div(F.col(ts_col), width_us))


def hot_buckets(bucketed: DataFrame, keys: Sequence[str], ts_col: str, tie: str, limit: int = HOT_CHUNK) -> DataFrame:
    """The (keys, ``_bucket``) with more than ``limit`` rows, the ``MOST_HOT`` largest, and how to cut them.

    They are cut into parts of equal time, or, where all rows have one time stamp
    (a bulk load), of equal range of a BIGINT ``tie`` or by input split of a place (file, block, row).
    """
    t, s = F.col(ts_col), _tie_code(bucketed, tie)
    stats = (bucketed.groupBy(*keys, "_bucket")
                     .agg(F.count(F.lit(1)).alias("_n"), F.min(t).alias("_lo"), F.max(t).alias("_hi"),
                          F.min(s).alias("_slo"), F.max(s).alias("_shi")))
    hot = stats.where(F.col("_n") > limit).orderBy(F.col("_n").desc(), *keys, "_bucket").limit(MOST_HOT)
    tied = F.col("_lo") == F.col("_hi")
    low, high = (F.when(tied, F.col(f"_s{x}")).otherwise(F.col(f"_{x}")) for x in ("lo", "hi"))
    step = F.call_function("div", high - low, 2 * (F.call_function("div", F.col("_n"), F.lit(limit)) + 1)) + 1
    return hot.select(*keys, "_bucket", tied.alias("_tied"), low.alias("_from"), step.alias("_step"))


def _tie_code(df: DataFrame, tie: str) -> Column:
    placed = isinstance(df.schema[tie].dataType, T.StructType)
    return F.lit(0).cast("long") if placed else F.shiftright(F.col(tie), 2)  # differences stay within BIGINT


def cut_buckets(bucketed: DataFrame, hot: DataFrame, keys: Sequence[str], ts_col: str, tie: str, columns: Sequence[str], name: str = "_chunk") -> DataFrame:
    """``columns`` and the chunk (bucket, part, split) of each row, given the hot buckets."""
    placed = isinstance(bucketed.schema[tie].dataType, T.StructType)
    part = F.call_function("div", F.when(F.col("_tied"), _tie_code(bucketed, tie)).otherwise(F.col(ts_col)) - F.col("_from"), F.col("_step"))
    split = F.when(F.col("_tied"), F.struct(F.col(tie)["file"], F.col(tie)["block"])) if placed else F.lit(0)
    chunk = F.struct(F.col("_bucket").alias("bucket"), F.coalesce(part, F.lit(0)).alias("part"), split.alias("split"))
    return stitch(bucketed, F.broadcast(hot), [*keys, "_bucket"], [*columns, chunk.alias(name)])


def add_split_chunk(df: DataFrame, keys: Sequence[str], ts_col: str, tie: str, width_us: int,
                    name: str = "_chunk", limit: int = HOT_CHUNK) -> DataFrame:
    """Chunk id = (bucket, part, split) of rows ordered by (``ts_col``, ``tie``).

    A bucket with more than ``limit`` rows of a key is cut further (``hot_buckets``).
    Which buckets are that large comes from an aggregate; the ``MOST_HOT``
    largest of them are broadcast.
    """
    bucketed = add_chunk(df, ts_col, width_us, "_bucket")
    return cut_buckets(bucketed, hot_buckets(bucketed, keys, ts_col, tie, limit), keys, ts_col, tie, df.columns, name)


def add_arrival_chunk(df: DataFrame, width_us: int, keys: Sequence[str] = (), name: str = "_chunk",
                      limit: int = HOT_CHUNK) -> tuple[DataFrame, list[str]]:
    """(``df`` with a chunk of its arrival order, that order).

    Rows with ``arrival_us`` arrive in order of (arrival_us, seq); rows read from
    files in the order of their place ``seq`` (file, block, row), in chunks of
    one split each.
    """
    if "arrival_us" in df.columns:
        return add_split_chunk(df, keys, "arrival_us", "seq", width_us, name, limit), ["arrival_us", "seq"]
    if isinstance(df.schema["seq"].dataType, T.StructType):
        return df.withColumn(name, F.struct("seq.file", "seq.block")), ["seq"]
    raise ValueError("no arrival order: the rows need arrival_us, or seq as (file, block, row)")


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str,
            chunk: str, how: str = "sum", inclusive: bool = True) -> DataFrame:
    """Running ``how`` (sum / max / min) of ``value`` per key in ``order``.

    ``inclusive=False`` gives the value over strictly earlier rows (NULL for
    the first row of a key when ``how`` is max/min, 0 for sum).
    """
    agg = _AGGS[how]
    part = [*keys, chunk]
    w = (_spec(part).orderBy(*_ordered(order, False))
         .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1))
    local = df.withColumn("_loc", agg(F.col(value)).over(w))
    per_chunk = df.groupBy(*part).agg(agg(F.col(value)).alias("_tot"))
    wc = _spec(keys).orderBy(F.col(chunk)).rowsBetween(Window.unboundedPreceding, -1)
    carry = per_chunk.select(*part, agg(F.col("_tot")).over(wc).alias("_carry"))
    if how == "sum":
        res = F.coalesce(F.col("_loc"), F.lit(0)) + F.coalesce(F.col("_carry"), F.lit(0))
    else:
        res = (F.greatest if how == "max" else F.least)(F.col("_loc"), F.col("_carry"))
    return stitch(local, carry, part, [*[c for c in df.columns if c != out], res.alias(out)])


def nearest(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str,
            chunk: str, direction: str = "before") -> DataFrame:
    """Nearest non-NULL ``value`` strictly before (or after) each row of its key.

    ``lag(v)`` is ``nearest(v, 'before')`` when ``v`` is never NULL; "first later
    row that matches p" is ``nearest(when(p, v), 'after')``. ``value`` may be a
    struct column to carry several fields at once.
    """
    after = direction == "after"
    part = [*keys, chunk]
    w = (_spec(part).orderBy(*_ordered(order, after))
         .rowsBetween(Window.unboundedPreceding, -1))
    local = df.withColumn("_near", F.last(F.col(value), ignorenulls=True).over(w))
    # the chunk's edge: its last (or, scanning backwards, first) non-NULL value;
    # rows with a NULL value have a NULL position and are skipped by min_by/max_by
    pos = F.when(F.col(value).isNotNull(), _pos(order))
    per_chunk = df.groupBy(*part).agg((F.min_by if after else F.max_by)(F.col(value), pos).alias("_edge"))
    wc = (_spec(keys).orderBy(F.col(chunk).desc() if after else F.col(chunk).asc())
          .rowsBetween(Window.unboundedPreceding, -1))
    carry = per_chunk.select(*part, F.last(F.col("_edge"), ignorenulls=True).over(wc).alias("_carry"))
    res = F.coalesce(F.col("_near"), F.col("_carry"))
    return stitch(local, carry, part, [*[c for c in df.columns if c != out], res.alias(out)])
