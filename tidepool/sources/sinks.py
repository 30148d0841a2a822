"""Sinks: line output (the reference's file-to-topic producer, as a Spark
writer), labelled stream output, and the retract form of a result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def as_lines(df: DataFrame, sep: str = ",") -> DataFrame:
    """One ``value`` string per row: the columns joined by ``sep``."""
    return df.select(F.concat_ws(sep, *[F.col(c).cast("string") for c in df.columns]).alias("value"))


def write_lines(df: DataFrame, path_or_topic: str, fmt: str = "text", options: dict | None = None,
                mode: str = "append") -> None:
    """Write a ``value`` column as lines: ``text`` files, or ``kafka`` with
    ``kafka.bootstrap.servers`` in options (connector jar required)."""
    w = df.select("value").write.format(fmt).mode(mode)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if fmt == "kafka":
        w.option("topic", path_or_topic).save()
    else:
        w.save(path_or_topic)


def start_labelled(df: DataFrame, label: str, output_mode: str = "append", fmt: str = "memory",
                   checkpoint: str | None = None, trigger: dict | None = None,
                   options: dict | None = None) -> StreamingQuery:
    """Start a streaming query whose name is the reference's print label
    ('count result', 'warning', 'timeout', 'matched', ...)."""
    w = df.writeStream.queryName(label.replace(" ", "_")).outputMode(output_mode).format(fmt)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
