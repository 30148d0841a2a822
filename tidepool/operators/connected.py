"""Two connected streams under the smaller of their watermarks.

Rows of both streams come in one order of arrival. The clock is the smaller of the two running maxima of event
time, less a delay: a stream that falls behind holds it back. A row of either side waits
for partners until the clock reaches its deadline; one that had none by then goes out unmatched,
at the arrival that moved the clock. The clock never runs back, so when it first reaches a
deadline is a search along its steps, one ordered scan over deadlines and steps together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.functions.timecols import parse_duration_us
from tidepool.operators.joins import interval_join
from tidepool.operators.scan import HOT_CHUNK, add_split_chunk, nearest, stitch

ARRIVAL = ("arrival_us", "seq")


def with_clock(rows: DataFrame, side: str, delay="0 seconds", chunk="1 minute", limit: int = HOT_CHUNK) -> DataFrame:
    """``rows`` with ``clock_before`` and ``clock``, the clock before and after each row's arrival (null until both sides have rows).

    ``side`` is a boolean column that tells the two streams apart. Chunks of the order of arrival
    are scanned alone; a small table carries the maxima of earlier ones.
    """
    d = add_split_chunk(rows, [], ARRIVAL[0], ARRIVAL[1], parse_duration_us(chunk), limit=limit)
    of = {"a": F.when(F.col(side), F.col("ts_us")), "b": F.when(~F.col(side), F.col("ts_us"))}
    w = Window.partitionBy("_chunk").orderBy(*ARRIVAL)
    upto, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    local = d.withColumns({**{f"_in_{k}": F.max(v).over(upto) for k, v in of.items()}, **{f"_ex_{k}": F.max(v).over(before) for k, v in of.items()}})
    earlier = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)  # one row per chunk
    totals = d.groupBy("_chunk").agg(*[F.max(v).alias(f"_t_{k}") for k, v in of.items()])
    carry = totals.select("_chunk", *[F.max(f"_t_{k}").over(earlier).alias(f"_c_{k}") for k in of])
    late = F.lit(parse_duration_us(delay))

    def clock(kind: str):
        a, b = (F.greatest(f"_{kind}_{k}", f"_c_{k}") for k in of)
        return F.when(a.isNotNull() & b.isNotNull(), F.least(a, b) - late)

    return stitch(local, carry, ["_chunk"], [*rows.columns, clock("ex").alias("clock_before"), clock("in").alias("clock")])


def first_reached(deadlines: DataFrame, clocked: DataFrame, deadline: str, id_col: str, chunk="1 hour", limit: int = HOT_CHUNK) -> DataFrame:
    """(id_col, ``emitted_us``, ``emitted_seq``): the first arrival after which the clock is at ``deadline`` or later, null if none is."""
    steps = clocked.where(F.col("clock").isNotNull() & (F.col("clock_before").isNull() | (F.col("clock") > F.col("clock_before"))))
    both = deadlines.select(F.col(deadline).alias("ts_us"), F.lit(0).cast("long").alias("seq"), F.col(id_col).alias("_id"), F.lit(None).cast("struct<u:bigint,s:bigint>").alias("_tick"))
    both = both.unionByName(steps.select(F.col("clock").alias("ts_us"), F.lit(4).cast("long").alias("seq"), F.lit(None).cast(deadlines.schema[id_col].dataType).alias("_id"),
                                         F.struct(F.col("arrival_us").alias("u"), F.col("seq").alias("s")).alias("_tick")))
    found = nearest(add_split_chunk(both, [], "ts_us", "seq", parse_duration_us(chunk), limit=limit), [], ["ts_us", "seq"], "_tick", "_at", "_chunk", direction="after")
    return found.where(F.col("_tick").isNull()).select(F.col("_id").alias(id_col), F.col("_at.u").alias("emitted_us"), F.col("_at.s").alias("emitted_seq"))


def match_connected(left: DataFrame, right: DataFrame, keys: Sequence[str], left_wait="5 seconds", right_wait="3 seconds",
                    delay="0 seconds") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(matched, left alone, right alone) of two streams with ``keys``, ts_us, arrival_us and a BIGINT seq that no two rows share.

    A left row at t waits until the clock reaches t + ``left_wait``, a right one until t + ``right_wait``. Two rows of a key
    match if the right one's time is in [left - right_wait, left + left_wait] and the later to arrive comes while the
    other waits. A pair goes out when its later row arrives, a row without any when the clock reaches its
    deadline, or when it comes if that has passed: ``emitted_us`` and ``emitted_seq`` tell at which arrival, null if the input ends before.
    """
    keys = list(keys)
    waits = {True: parse_duration_us(left_wait), False: parse_duration_us(right_wait)}
    columns = [*keys, "ts_us", "arrival_us", "seq"]
    rows = left.select(*columns, F.lit(True).alias("_left")).unionByName(right.select(*columns, F.lit(False).alias("_left")))
    clocked = with_clock(rows.where(F.col("ts_us").isNotNull()), "_left", delay)
    sides = {}
    for is_left, name in ((True, "l"), (False, "r")):
        side = clocked.where(F.col("_left") == F.lit(is_left))
        sides[is_left] = side.select(*keys, F.col("ts_us").alias(f"{name}_us"), F.col("arrival_us").alias(f"{name}_arrival"), F.col("seq").alias(f"{name}_seq"),
                                     F.col("clock_before").alias(f"{name}_clock"))
    near = interval_join(sides[True], sides[False], keys, -waits[False], waits[True], "inner", "l_us", "r_us")
    right_later = F.struct("r_arrival", "r_seq") > F.struct("l_arrival", "l_seq")
    in_time = F.when(right_later, F.coalesce(F.col("r_clock") < F.col("l_us") + F.lit(waits[True]), F.lit(True))).otherwise(
        F.coalesce(F.col("l_clock") < F.col("r_us") + F.lit(waits[False]), F.lit(True)))
    matched = near.where(in_time).select(*keys, "l_seq", "l_us", "r_seq", "r_us", F.greatest("l_arrival", "r_arrival").alias("emitted_us"),
                                         F.when(right_later, F.col("r_seq")).otherwise(F.col("l_seq")).alias("emitted_seq"))
    alone = []
    for is_left, name in ((True, "l"), (False, "r")):
        side = sides[is_left].withColumn("_deadline", F.col(f"{name}_us") + F.lit(waits[is_left]))
        left_over = side.join(matched.select(F.col(f"{name}_seq").alias("_m")).distinct(), F.col(f"{name}_seq") == F.col("_m"), "left_anti")
        when = first_reached(left_over, clocked, "_deadline", f"{name}_seq")
        out = left_over.select(*keys, f"{name}_seq", f"{name}_us", f"{name}_arrival").join(when, f"{name}_seq")
        # a row that comes when its deadline has passed goes out at once
        late = F.struct("emitted_us", "emitted_seq") < F.struct(f"{name}_arrival", f"{name}_seq")
        own = {"emitted_us": F.when(late, F.col(f"{name}_arrival")).otherwise(F.col("emitted_us")), "emitted_seq": F.when(late, F.col(f"{name}_seq")).otherwise(F.col("emitted_seq"))}
        alone.append(out.select(*keys, f"{name}_seq", f"{name}_us", *[F.when(F.col("emitted_us").isNotNull(), c).alias(k) for k, c in own.items()]))
    return matched, *alone
