"""Top-N per group, ranking text and changelogs between two result snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions.text import ITEM_LABEL, ranking_text
from tidepool.functions.timecols import timestamp_text


# Spark limits a group before the shuffle for ranks below this (windowGroupLimitThreshold).
GROUP_LIMIT = 1000
# Slices in which a group is limited first where Spark would not.
SLICES = 64


def first_rows(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, rank_col: str) -> DataFrame:
    """Rows ranked 1..n per ``group`` in ``order``, with their rank (int).

    For small n ``row_number() <= n`` is planned by Spark as a
    WindowGroupLimit: a partial limit runs before the shuffle, so each task
    sends at most n rows per group. For larger n the group is first ranked
    in slices dealt by hash, so that at most ``SLICES`` times n rows of it meet.
    """
    if n >= GROUP_LIMIT:
        slice_ = F.pmod(F.xxhash64(*[c for c in df.columns if not isinstance(df.schema[c].dataType, T.MapType)]), F.lit(SLICES))
        sliced = df.withColumn("_slice", slice_)
        w = Window.partitionBy(*group, "_slice").orderBy(*order)
        df = sliced.withColumn("_in_slice", F.row_number().over(w)).where(F.col("_in_slice") <= n).drop("_slice", "_in_slice")
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)


def top_n(df: DataFrame, group: Sequence[str], by: str, n: int, tie: Sequence[str] = (),
          rank_col: str = "rank") -> DataFrame:
    """Rows ranked 1..n per ``group`` by ``by`` descending, ties by ``tie`` ascending."""
    ranked = first_rows(df, group, [F.col(by).desc(), *[F.col(c).asc() for c in tie]], n, rank_col)
    return ranked.withColumn(rank_col, F.col(rank_col).cast("long"))


def ranking_report(ranked: DataFrame, end_col: str, rank_col: str, id_col: str, cnt_col: str,
                   id_label: str = ITEM_LABEL, zone: str = "UTC") -> DataFrame:
    """One report string per window end from a top-N table (at most n rows per end).

    ``end_col`` is epoch ms. The group per end holds only the n ranked rows.
    """
    items = F.array_sort(F.collect_list(F.struct(F.col(rank_col).alias("r"), F.col(id_col).alias("id"),
                                                 F.col(cnt_col).alias("n"))))
    return (ranked.groupBy(end_col).agg(items.alias("_items"))
                  .select(F.col(end_col),
                          ranking_text(timestamp_text(F.col(end_col) * F.lit(1000), zone),
                                       F.col("_items"), "id", "n", id_label).alias("report")))


def changelog(prev: DataFrame, cur: DataFrame, flag: str = "is_add") -> DataFrame:
    """Retract-stream form of going from snapshot ``prev`` to ``cur``.

    Rows only in ``cur`` come with ``flag`` = true (add), rows only in ``prev``
    with false (retract); rows in both give nothing. Multiset semantics.
    """
    adds = cur.exceptAll(prev).withColumn(flag, F.lit(True))
    rets = prev.exceptAll(cur).withColumn(flag, F.lit(False))
    return adds.unionByName(rets).select(flag, *cur.columns)
