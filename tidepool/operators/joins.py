"""Interval joins: same key and right.ts in [left.ts + lower, left.ts + upper].

An equi-join on the key alone compares every pair of rows of a key, which
for a hot key is quadratic. Both sides are also cut into time buckets of
width B >= upper - lower: a left row sits in one bucket, a right row is
copied into the (at most two) buckets of left rows it can match, and the
join runs on (key, bucket) with the exact range as residual filter. Each
pair is found once (the left row has one bucket), and only rows less than
about 2B apart are ever compared.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.functions.timecols import floor_div

_HOWS = {"inner", "left_semi", "left_anti", "left_outer"}


def interval_join(left: DataFrame, right: DataFrame, on: Sequence[str], lower_us: int, upper_us: int,
                  how: str = "inner", left_ts: str = "ts_us", right_ts: str = "ts_us",
                  bucket_us: int | None = None) -> DataFrame:
    """Join rows with equal ``on`` keys and right_ts - left_ts in [lower, upper].

    ``how``: inner, left_outer, left_semi or left_anti. Right-side columns
    other than the keys must not clash with left-side names (rename first).
    """
    if how not in _HOWS:
        raise ValueError(f"how must be one of {_HOWS}")
    if upper_us < lower_us:
        raise ValueError("upper < lower")
    width = bucket_us or max(upper_us - lower_us, 1)
    on = list(on)
    lb = left.withColumn("_lb", floor_div(F.col(left_ts), width))
    r = right
    for k in on:
        r = r.withColumnRenamed(k, f"_rk_{k}")
    rts = F.col(right_ts)
    first = floor_div(rts - F.lit(upper_us), width)
    last = floor_div(rts - F.lit(lower_us), width)
    rb = r.withColumn("_rb", F.explode(F.sequence(first, last)))
    cond = [F.col(k) == F.col(f"_rk_{k}") for k in on]
    cond += [F.col("_lb") == F.col("_rb"),
             F.col(right_ts) >= F.col(left_ts) + F.lit(lower_us),
             F.col(right_ts) <= F.col(left_ts) + F.lit(upper_us)]
    joined = lb.join(rb, on=cond, how=how)
    joined = joined.drop("_lb", "_rb")
    if how in ("inner", "left_outer"):
        joined = joined.drop(*[f"_rk_{k}" for k in on])
    return joined


def match_two_streams(left: DataFrame, right: DataFrame, on: Sequence[str], lower_us: int, upper_us: int,
                      left_ts: str = "ts_us", right_ts: str = "ts_us") -> tuple[DataFrame, DataFrame]:
    """(left rows with their partners or, with NULLs, without; right rows without a partner)."""
    pairs = interval_join(left, right, on, lower_us, upper_us, "left_outer", left_ts, right_ts)
    lonely = interval_join(right, left, on, -upper_us, -lower_us, "left_anti", right_ts, left_ts)
    return pairs, lonely
