"""Time buckets with their neighbours' edges, for patterns of rows at most ``d`` apart.

Rows are cut into time buckets at least ``d`` wide and each bucket also
gets copies of the rows in the first ``d`` of the one after: every begin row
finds its match in its own bucket, with one shuffle and no join, and
no key goes whole to one task. ``pattern`` matches in them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.functions.timecols import floor_div

ORDER = ("ts_us", "seq")
# Narrowest bucket: with a short ``d`` few rows lie near a border and are copied.
BUCKET_US = 60_000_000


def bucket_width(reach_us: int) -> int:
    return max(4 * reach_us, BUCKET_US)


def with_neighbours(df: DataFrame, ts_col: str, reach_us: int, before: bool = False, after: bool = False) -> DataFrame:
    """Rows with ``_bucket`` and ``_copy`` (0: the row itself, 1: a copy for a neighbouring bucket).

    With ``after``, a bucket also holds the rows up to ``reach_us`` past its
    end, with ``before`` those up to ``reach_us`` ahead of its start (both
    ends included).
    """
    width = bucket_width(reach_us)
    t = F.col(ts_col)
    own = floor_div(t, width)
    into = t - own * F.lit(width)
    places = [F.struct(own.alias("b"), F.lit(0).alias("c"))]
    none = F.lit(None).cast("struct<b:bigint,c:int>")
    if after:
        places.append(F.when(into <= F.lit(reach_us), F.struct((own - 1).alias("b"), F.lit(1).alias("c"))).otherwise(none))
    if before:
        places.append(F.when(into >= F.lit(width - 1 - reach_us), F.struct((own + 1).alias("b"), F.lit(1).alias("c"))).otherwise(none))
    # a NULL time has no bucket of its own and no neighbours
    place = F.explode(F.array_compact(F.array(*places)))
    return df.withColumn("_place", place).select(*df.columns, F.col("_place.b").alias("_bucket"), F.col("_place.c").alias("_copy"))
