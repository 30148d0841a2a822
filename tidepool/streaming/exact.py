"""Streaming forms that are exact at every micro-batch, where ``jobs`` has an estimate or one watermark per batch.

``running_visitors_writer`` keeps each window's visitors as bitmap blocks in map state
(``transformWithStateInPandas``; needs the RocksDB state store, see ``ROCKSDB``), so a
micro-batch reads and writes only the blocks its users fall in. ``late_split_writer`` gives each row the
watermark of all rows that arrived before it, those of the same micro-batch too.

Both hand each micro-batch to a function with its epoch; what they carry from epoch to epoch
is an ``EpochLog`` under a shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidepool.functions.timecols import floor_div, parse_duration_us
from tidepool.operators.keyed import split_late
from tidepool.streaming.epochlog import EpochLog

#: Session setting that state with several variables needs.
ROCKSDB = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
#: Bits of one block of visitors (4 KB), and parts that the visitors of a window are dealt to.
BLOCK_BITS, PARTS = 15, 64


class _Visitors(StatefulProcessor):
    """Distinct ids of a (window, part): bitmap blocks by number, their count, a timer to forget them."""

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.blocks = handle.getMapState("blocks", "block long", "bits binary")
        self.count = handle.getValueState("count", "n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n = self.count.get()[0] if self.count.exists() else 0
        if not n:
            self.handle.registerTimer(int(key[0]) + self.keep_ms)
        before = n
        for frame in rows:
            ids = np.unique(frame["user_id"].to_numpy())
            numbers = ids >> BLOCK_BITS
            for at in np.split(np.arange(len(ids)), np.flatnonzero(np.diff(numbers)) + 1):
                block = (int(numbers[at[0]]),)
                held = self.blocks.getValue(block) if self.blocks.containsKey(block) else None
                bits = np.unpackbits(np.frombuffer(held[0], np.uint8)) if held else np.zeros(1 << BLOCK_BITS, np.uint8)
                place = ids[at] & ((1 << BLOCK_BITS) - 1)
                fresh = int((bits[place] == 0).sum())
                if fresh:
                    bits[place] = 1
                    self.blocks.updateValue(block, (np.packbits(bits).tobytes(),))
                    n += fresh
        if n != before:
            self.count.update((n,))
        yield pd.DataFrame({"window_end": [int(key[0])], "part": [int(key[1])], "uv": [n]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.blocks.clear()
        self.count.clear()
        return iter([])

    def close(self) -> None:
        pass


def running_visitors_writer(ub: DataFrame, write_batch, state_dir: str, size="1 hour", delay="0 seconds"):
    """Exact distinct users of each tumbling window, revised by every micro-batch that has rows of it.

    ``write_batch(df, epoch_id)`` gets (window_end ms, uv) of the windows the micro-batch touched. Users are dealt to ``PARTS``
    parts of a window, each with bitmap blocks of its own, so a window with most of the rows is many groups; state goes when
    the watermark passes the window's end. Rows whose window the watermark has passed are dropped, as Spark does. User ids are integers.
    """
    size_us = parse_duration_us(size)
    schema = "window_end long, part int, uv long"
    log = EpochLog(state_dir, lambda rows: rows.groupBy("window_end", "part").agg(F.max("uv").alias("uv")))  # a part's count only grows
    end = floor_div(floor_div(F.col("ts_us"), size_us) * F.lit(size_us) + F.lit(size_us), 1000)
    dealt = (ub.withWatermark("ts", delay).where(F.col("behavior") == "pv")
               .select("ts", "user_id", end.alias("window_end"), F.pmod(F.xxhash64(F.shiftright("user_id", BLOCK_BITS)), F.lit(PARTS)).cast("int").alias("part")))
    counts = dealt.groupBy("window_end", "part").transformWithStateInPandas(_Visitors(0), schema, "Update", "EventTime")

    def each(batch: DataFrame, epoch_id: int) -> None:
        before, own = log.write(batch.groupBy("window_end", "part").agg(F.max("uv").alias("uv")), epoch_id)
        whole = log.merge(before.unionByName(own)).join(own.select("window_end").distinct(), "window_end", "left_semi")
        write_batch(whole.groupBy("window_end").agg(F.sum("uv").alias("uv")), epoch_id)

    return counts.writeStream.outputMode("update").foreachBatch(each)


def late_split_writer(rows: DataFrame, write_on_time, write_late, state_dir: str, size="10 minutes", slide="5 seconds",
                      lateness="1 minute", delay="1 second"):
    """On-time and late rows of a stream, each row judged by the watermark of all that arrived before it.

    ``rows`` have ``arrival_us`` and a BIGINT ``seq``, or ``place`` (file, block) as ``readers.stream_places`` gives it, from which the
    order of arrival within a micro-batch is taken. The newest time of an epoch is all that is
    carried to the next. Both functions get (df, epoch_id); the rule is that of ``keyed.split_late``.
    """
    log = EpochLog(state_dir, lambda m: m.agg(F.max("newest").alias("newest")))

    def each(batch: DataFrame, epoch_id: int) -> None:
        if "place" in batch.columns:
            batch = batch.withColumn("seq", F.struct("place.file", "place.block", F.monotonically_increasing_id().alias("row"))).drop("place")
        floor = log.before(batch.sparkSession, epoch_id, "newest long").first()
        on_time, late = split_late(batch, size, slide, lateness, delay, floor_us=floor[0] if floor else None)
        write_on_time(on_time, epoch_id)
        write_late(late, epoch_id)
        log.write(batch.agg(F.max("ts_us").alias("newest")), epoch_id)

    return rows.writeStream.outputMode("append").foreachBatch(each)
