"""Ranking report text (one string per window)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidepool.functions.messages import COUNT_LABEL, ITEM_LABEL, PAGE_LABEL, REPORT_HEADER, RULE  # noqa: F401


def ranking_text(end_text: Column, ranked: Column, id_field: str, cnt_field: str,
                 id_label: str = ITEM_LABEL) -> Column:
    """Header line, one line per rank ('NO<i>: \\t<label><id>\\t<count label><n>'), rule line.

    ``ranked`` is an array of structs already sorted by rank (1-based order).
    """
    lines = F.transform(
        ranked,
        lambda r, i: F.concat(F.lit("NO"), (i + 1).cast("string"), F.lit(": \t"), F.lit(id_label),
                              r[id_field].cast("string"), F.lit("\t"), F.lit(COUNT_LABEL),
                              r[cnt_field].cast("string"), F.lit("\n")))
    return F.concat(F.lit(REPORT_HEADER), end_text, F.lit("\n"), F.array_join(lines, ""),
                    F.lit(RULE), F.lit("\n\n"))
