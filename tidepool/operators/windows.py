"""Event-time windows: tumbling and sliding counts.

``window_count`` uses Spark's own ``F.window`` (an ``Expand`` inside whole-stage
codegen, then a partial aggregate before the shuffle): right when a row falls
in few windows (tumbling, 1 h / 5 min = 12).

``sliding_count`` is the plan for fine slides (1 day / 5 s puts a row in
17,280 windows, which ``F.window`` cannot expand): count per pane (one
shuffle, partial aggregation), turn each pane into +n at its end and -n at
its end + size, then a running sum per key gives the count of every window
end. The result is a list of change points ``[end_from, end_to)`` with a
constant count, which is the exact per-window table in compact form;
``expand=True`` unrolls it into one row per window end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.functions.timecols import floor_div, pane_end, parse_duration_us
from tidepool.operators.scan import add_chunk, stitch


def window_count(df: DataFrame, keys: Sequence[str], size: str, slide: str | None = None,
                 out: str = "cnt", count_col: str | None = None) -> DataFrame:
    """Rows per (window, keys) with ``F.window`` on the instant column ``ts``.

    Returns keys, ``window_start``/``window_end`` (epoch ms) and ``out``.
    ``count_col`` counts non-NULL values of that column instead of rows.
    """
    win = F.window("ts", size, slide) if slide else F.window("ts", size)
    cnt = F.count(F.col(count_col)) if count_col else F.count(F.lit(1))
    return (df.groupBy(win.alias("w"), *keys)
              .agg(cnt.alias(out))
              .select(*keys,
                      F.unix_millis(F.col("w.start")).alias("window_start"),
                      F.unix_millis(F.col("w.end")).alias("window_end"),
                      F.col(out)))


def pane_window_count(df: DataFrame, keys: Sequence[str], size, slide, ts_col: str = "ts_us",
                      out: str = "cnt") -> DataFrame:
    """Rows per (keys, sliding window), counted per pane first.

    Each row updates one pane count (partial aggregation, one shuffle); only
    the pane counts are copied into their size/slide windows and summed (a
    second shuffle on (keys, window)). ``F.window`` copies every row into
    every window before aggregating, so this does size/slide times less
    hashing on dense data. Returns keys, window_start, window_end (ms), out.
    """
    size_us, slide_us = parse_duration_us(size), parse_duration_us(slide)
    if size_us % slide_us:
        raise ValueError("slide must divide size")
    keys = list(keys)
    panes = (df.select(*keys, pane_end(F.col(ts_col), slide_us).alias("_p"))
               .groupBy(*keys, "_p").agg(F.count(F.lit(1)).alias("_n")))
    ends = F.explode(F.sequence(F.col("_p"), F.col("_p") + F.lit(size_us - slide_us), F.lit(slide_us)))
    return (panes.select(*keys, ends.alias("_e"), "_n")
                 .groupBy(*keys, "_e").agg(F.sum("_n").cast("long").alias(out))
                 .select(*keys, floor_div(F.col("_e") - F.lit(size_us), 1000).alias("window_start"),
                         floor_div(F.col("_e"), 1000).alias("window_end"), F.col(out)))


def sliding_count(df: DataFrame, keys: Sequence[str], size, slide, expand: bool = False,
                  ts_col: str = "ts_us", out: str = "cnt", chunk="1 day") -> DataFrame:
    """Count of rows per key in every sliding window [end - size, end).

    ``slide`` must divide ``size``. Without ``expand``: keys, ``end_from``,
    ``end_to`` (epoch ms, end_to exclusive) and ``out`` — every window ending
    at a multiple of ``slide`` in [end_from, end_to) holds ``out`` rows, and
    windows not covered are empty. With ``expand``: keys, ``window_start``,
    ``window_end`` (epoch ms) and ``out``, one row per non-empty window.
    """
    size_us, slide_us = parse_duration_us(size), parse_duration_us(slide)
    if size_us % slide_us:
        raise ValueError("slide must divide size")
    keys = list(keys)
    panes = (df.select(*keys, pane_end(F.col(ts_col), slide_us).alias("pane"))
               .groupBy(*keys, "pane").agg(F.count(F.lit(1)).alias("n")))
    segs = changes_from_panes(panes, keys, size_us, slide_us, out, chunk)
    if not expand:
        return segs.select(*keys, floor_div(F.col("_from"), 1000).alias("end_from"),
                           floor_div(F.col("_to"), 1000).alias("end_to"), F.col(out))
    return (expand_segments(segs, keys, slide_us, out)
                .select(*keys, floor_div(F.col("_e") - F.lit(size_us), 1000).alias("window_start"),
                        floor_div(F.col("_e"), 1000).alias("window_end"), F.col(out)))


# Window ends that one segment may hold before it is expanded.
PIECE = 720


def expand_segments(segs: DataFrame, keys: Sequence[str], slide_us: int, out: str = "cnt") -> DataFrame:
    """One row (keys, _e, out) per window end of the segments.

    Segments are first cut into pieces of at most ``PIECE`` ends, so that no row holds a
    long array, and the pieces, which are as even as the rows they make, are
    rebalanced; adaptive execution picks the width from their size.
    """
    step = PIECE * slide_us
    start = F.explode(F.sequence(F.col("_from"), F.col("_to") - F.lit(1), F.lit(step)))
    pieces = segs.select(*keys, out, start.alias("_start"), F.col("_to")).hint("rebalance")
    stop = F.least(F.col("_to") - F.lit(slide_us), F.col("_start") + F.lit(step - slide_us))
    return pieces.select(*keys, F.explode(F.sequence(F.col("_start"), stop, F.lit(slide_us))).alias("_e"), out)


def changes_from_panes(panes: DataFrame, keys: Sequence[str], size_us: int, slide_us: int, out: str = "cnt",
                       chunk="1 day") -> DataFrame:
    """Segments (keys, _from, _to, out) of constant non-zero window count from
    pane counts (keys, pane, n): +n at the pane's end, -n at end + size, then
    one chunked running sum per key. Window ends are in µs, _to exclusive."""
    keys = list(keys)
    enter = panes.select(*keys, F.col("pane").alias("point"), F.col("n").alias("delta"))
    leave = panes.select(*keys, (F.col("pane") + F.lit(size_us)).alias("point"), (-F.col("n")).alias("delta"))
    return changes_from_points(enter.unionByName(leave), keys, out, chunk)


def changes_from_points(points: DataFrame, keys: Sequence[str], out: str = "cnt", chunk="1 day") -> DataFrame:
    """The same segments from (keys, point, delta): the count changes by ``delta`` at window end ``point``."""
    points = (points.groupBy(*keys, "point").agg(F.sum("delta").alias("delta"))
                    .where(F.col("delta") != 0))
    return _sweep(add_chunk(points, "point", parse_duration_us(chunk)), list(keys), out)


def _sweep(points: DataFrame, keys: list[str], out: str) -> DataFrame:
    """Running sum of ``delta`` and the next point, per key in point order,
    as one chunked scan: within (key, chunk) a window gives both; a small
    per-chunk table gives the sum of earlier chunks and the next chunk's
    first point. Returns segments (keys, _from, _to, out) with out != 0."""
    part = [*keys, "_chunk"]
    spec = Window.partitionBy(*part).orderBy("point")
    local = (points.withColumn("_inc", F.sum("delta").over(spec.rowsBetween(Window.unboundedPreceding, 0)))
                   .withColumn("_nx", F.lead("point").over(spec)))
    per_chunk = local.groupBy(*part).agg(F.max_by("_inc", "point").alias("_tot"), F.min("point").alias("_first"))
    cs = Window.partitionBy(*keys) if keys else Window.partitionBy()
    cs = cs.orderBy("_chunk")
    carry = per_chunk.select(*part, F.sum("_tot").over(cs.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
                             F.lead("_first").over(cs).alias("_next_first"))
    cnt = (F.col("_inc") + F.coalesce(F.col("_before"), F.lit(0))).cast("long")
    res = stitch(local, carry, part, [*keys, F.col("point").alias("_from"),
                                      F.coalesce(F.col("_nx"), F.col("_next_first")).alias("_to"), cnt.alias(out)])
    return res.where(F.col(out) != 0)
