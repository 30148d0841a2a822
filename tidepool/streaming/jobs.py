"""Streaming forms of the jobs (Structured Streaming).

Inputs are streaming DataFrames with an instant column ``ts`` (and ``ts_us``,
``seq``), e.g. from ``tidepool.sources.readers.stream_records``. Each function
returns a streaming DataFrame; start it with ``sources.sinks.start_labelled``.

What maps to what:

* windowed and distinct counts: watermark + window aggregation in append mode
  (a window is emitted once the watermark passes its end); distinct is a
  second aggregation chained on the first, top-N a ranking of each
  micro-batch. The watermark is set before any filter, as in the reference.
* allowed lateness: a watermark delay of delay + lateness in update mode,
  so late rows revise counts already emitted.
* payment matching: stream-stream join on tx id with a time-range condition;
  watermarks on both sides bound the join state.
* order status and click limit: ``applyInPandasWithState`` per key with an
  event-time timeout (the watermark plays the reference's timers); bursts and
  patterns buffer rows in state until the watermark passes them, then match in
  event-time order, whatever frames and micro-batches they came in.
* windows too fine for ``F.window`` (1 day / 5 s) and hot pages with lateness:
  Spark's window state counts panes; ``foreachBatch`` appends them to a pane
  table in a shared folder and sweeps or ranks the windows that closed.

A bounded input does not close its last windows (the watermark never passes
them); feed a row far in the future to flush, as the tests do.
"""

from __future__ import annotations

from zoneinfo import ZoneInfo

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from tidepool.functions import messages as M
from tidepool.functions.timecols import floor_div, parse_duration_us
from tidepool.operators.topn import changelog, top_n
from tidepool.operators.windows import changes_from_panes, expand_segments
from tidepool.streaming.epochlog import EpochLog


def _interval(*durations) -> str:
    """The sum of durations as an interval text, to the millisecond."""
    return f"{-(-sum(map(parse_duration_us, durations)) // 1000)} milliseconds"


def _frames(batches) -> pd.DataFrame:
    """All rows of a key in a micro-batch, in (ts_us, seq) order: Spark hands them over in frames of bounded size."""
    frames = list(batches)
    return pd.concat(frames, ignore_index=True).sort_values(["ts_us", "seq"], kind="stable") if frames else pd.DataFrame({"ts_us": [], "seq": [], "event_type": []})


def window_counts(df: DataFrame, keys, size: str, slide: str | None = None, delay: str = "0 seconds",
                  out: str = "cnt", where=None) -> DataFrame:
    """Append-mode count per (keys, window): keys, window_start, window_end (ms), out.

    ``where`` says which rows count; all rows advance the watermark."""
    win = F.window("ts", size, slide) if slide else F.window("ts", size)
    return (df.withWatermark("ts", delay).where(F.lit(True) if where is None else where)
              .groupBy(win.alias("w"), *keys).agg(F.count(F.lit(1)).alias(out))
              .select(*keys, F.unix_millis("w.start").alias("window_start"),
                      F.unix_millis("w.end").alias("window_end"), out))


def hot_items_writer(ub: DataFrame, write_batch, n: int = 5, size="1 hour", slide="5 minutes",
                     delay="0 seconds"):
    """Top-n per window with no per-window state: the append-mode counts of a
    micro-batch are the final counts of the windows that just closed, so each
    micro-batch is ranked as a batch (partial WindowGroupLimit before the
    shuffle) and handed to ``write_batch(df, epoch_id)``. Returns the
    DataStreamWriter; set a checkpoint location and start it."""
    counts = window_counts(ub, ["item_id"], size, slide, delay, where=F.col("behavior") == "pv")

    def each(batch: DataFrame, epoch_id: int) -> None:
        ranked = top_n(batch, ["window_end"], "cnt", n, tie=["item_id"], rank_col="rnk")
        write_batch(ranked.select("window_end", "rnk", "item_id", "cnt"), epoch_id)

    return counts.writeStream.outputMode("append").foreachBatch(each)


def unique_visitors(ub: DataFrame, size="1 hour", delay="0 seconds") -> DataFrame:
    """Exact distinct users per tumbling window: one row per (window, user),
    then a count per window, both in append mode."""
    pairs = (ub.withWatermark("ts", delay).where(F.col("behavior") == "pv")
               .groupBy(F.window("ts", size).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("_n")))
    return (pairs.groupBy("w").agg(F.count(F.lit(1)).alias("uv"))
                 .select(F.unix_millis("w.end").alias("window_end"), "uv"))


def page_counts_with_lateness(log: DataFrame, size="10 minutes", slide="5 seconds", delay="1 second",
                              lateness="1 minute") -> DataFrame:
    """Update-mode counts per (url, window) for GET lines: a row may revise a
    window until the watermark (max ts - delay - lateness) passes its end."""
    return (log.withWatermark("ts", _interval(delay, lateness)).where(F.col("method") == "GET")
               .groupBy(F.window("ts", size, slide).alias("w"), "url").agg(F.count(F.lit(1)).alias("cnt"))
               .select("url", F.unix_millis("w.end").alias("window_end"), "cnt"))


def tx_match(orders: DataFrame, receipts: DataFrame, lower="-3 seconds", upper="5 seconds",
             delay="0 seconds", how: str = "inner") -> DataFrame:
    """Stream-stream interval join of pays and receipts on tx id.

    ``how='full_outer'`` also emits unmatched pays / receipts (with NULLs on
    the other side) once the watermark shows no partner can still arrive.
    """
    lo, hi = (f"INTERVAL '{parse_duration_us(x) / 1_000_000:.6f}' SECOND" for x in (lower, upper))
    pays = (orders.withWatermark("ts", delay).where(F.col("event_type") == "pay")
                  .select(F.col("tx_id").alias("p_tx"), F.col("seq").alias("pay_event_id"), "order_id", "event_type",
                          F.col("ts").alias("pay_ts")))
    rc = (receipts.withWatermark("ts", delay)
                  .select(F.col("tx_id").alias("r_tx"), F.col("seq").alias("receipt_event_id"), "pay_channel",
                          F.col("ts").alias("receipt_ts")))
    cond = F.expr(f"p_tx = r_tx AND receipt_ts >= pay_ts + {lo} AND receipt_ts <= pay_ts + {hi}")
    j = pays.join(rc, cond, how)
    return j.select(F.coalesce("p_tx", "r_tx").alias("tx_id"), "pay_event_id", "order_id", "event_type",
                    F.unix_millis("pay_ts").alias("pay_ms"), "receipt_event_id", "pay_channel",
                    F.unix_millis("receipt_ts").alias("receipt_ms"))


# ----------------------------------------------------------------------------- keyed state
ORDER_OUT = "order_id long, result string"
ORDER_STATE = "create_us long, pay_us long"


def order_pay_status(orders: DataFrame, limit="15 minutes", delay="0 seconds") -> DataFrame:
    """Per order: result as soon as both events are in, or on timeout.

    State keeps the first create and first pay. With only a create, the order
    times out when the watermark passes create + limit ('order timeout');
    with only a pay, when it passes pay + limit ('payed but not found create
    log'). Same rules as the batch form when no row is behind the watermark.
    """
    limit_us = parse_duration_us(limit)

    def step(key, batches, state):
        if state.hasTimedOut:
            c, p = state.get
            state.remove()
            yield pd.DataFrame({"order_id": [key[0]],
                                "result": [M.ORDER_TIMEOUT if p is None else M.PAY_WITHOUT_CREATE]})
            return
        c, p = state.get if state.exists else (None, None)
        for pdf in batches:
            cs = pdf.loc[pdf["event_type"] == "create", "ts_us"]
            ps = pdf.loc[pdf["event_type"] == "pay", "ts_us"]
            if len(cs):
                c = int(cs.min()) if c is None else min(c, int(cs.min()))
            if len(ps):
                p = int(ps.min()) if p is None else min(p, int(ps.min()))
        if c is not None and p is not None:
            state.remove()
            msg = M.PAID if p < c + limit_us else M.PAID_LATE
            yield pd.DataFrame({"order_id": [key[0]], "result": [msg]})
            return
        deadline_ms = ((c if c is not None else p) + limit_us) // 1000
        if deadline_ms <= state.getCurrentWatermarkMs():
            state.remove()
            yield pd.DataFrame({"order_id": [key[0]],
                                "result": [M.ORDER_TIMEOUT if p is None else M.PAY_WITHOUT_CREATE]})
            return
        state.update((c, p))
        state.setTimeoutTimestamp(deadline_ms)

    return (orders.withWatermark("ts", delay)
                  .groupBy("order_id")
                  .applyInPandasWithState(step, ORDER_OUT, ORDER_STATE, "append", GroupStateTimeout.EventTimeTimeout))


# ----------------------------------------------------------------------------- ordered release
def _release(batches, state, buffered):
    """Rows of this key that can no longer be overtaken, in (ts_us, seq) order.

    A pattern engine buffers rows until the watermark passes them: rows older
    than the watermark are dropped by Spark, so every row with ts < watermark
    that is buffered now is final in its order. Returns (released rows,
    rows still pending) as lists of tuples (ts_us, seq, tag).
    """
    rows = list(buffered)
    for pdf in batches:
        rows.extend(zip(pdf["ts_us"].astype("int64"), pdf["seq"].astype("int64"), pdf["event_type"]))
    rows.sort(key=lambda r: (r[0], r[1]))
    wm_us = state.getCurrentWatermarkMs() * 1000
    ready = [r for r in rows if r[0] < wm_us]
    return ready, [r for r in rows if r[0] >= wm_us]


def _pending_timer(state, pending, extra_us=()):
    """Fire again once the watermark passes the oldest pending row (or a deadline)."""
    marks = [p[0] + 1 for p in pending] + [u for u in extra_us]
    if marks:
        state.setTimeoutTimestamp(max(min(marks) // 1000 + 1, state.getCurrentWatermarkMs() + 1))


BURST_OUT = "user_id long, first_fail_ms long, last_fail_ms long, fail_count long, msg string"
BURST_STATE = "pending array<struct<ts_us: long, seq: long, t: string>>, first_us long, last_us long, n long"


def login_fail_bursts(logins: DataFrame, within="2 seconds", min_fails: int = 2,
                      delay="3 seconds") -> DataFrame:
    """Greedy fail bursts per user (same rule as the batch ``fail_bursts``).

    Rows wait in state until the watermark passes them and then join, close or
    cancel the open burst in event-time order; a burst whose deadline the
    watermark has passed closes by timeout."""
    w_us = parse_duration_us(within)
    secs = w_us // 1_000_000

    def step(key, batches, state):
        pending, first, last, n = state.get if state.exists else ([], None, None, 0)
        ready, pending = _release(batches, state, [tuple(p) for p in (pending or [])])
        out = []

        def close():
            if first is not None and n >= min_fails:
                out.append((key[0], first // 1000, last // 1000, n, M.LOGIN_BURST.format(secs=secs, n=n)))

        for t, _seq, kind in ready:
            if first is not None and t > first + w_us:
                close()
                first = None
            if kind != "fail":
                first = None  # a success by the deadline cancels
            elif first is None:
                first, last, n = t, t, 1
            else:
                last, n = t, n + 1
        # rows not yet released are at or past the watermark: behind it nothing can join any more
        if first is not None and first + w_us < state.getCurrentWatermarkMs() * 1000:
            close()
            first = None
        if pending or first is not None:
            state.update((pending, first, last, n))
            _pending_timer(state, pending, [first + w_us + 1] if first is not None else [])
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame(out, columns=["user_id", "first_fail_ms", "last_fail_ms", "fail_count", "msg"])

    return (logins.withWatermark("ts", delay)
                  .groupBy("user_id")
                  .applyInPandasWithState(step, BURST_OUT, BURST_STATE, "append", GroupStateTimeout.EventTimeTimeout))


PAIR_OUT = "user_id long, first_fail_ms long, last_fail_ms long, msg string"
SEQ_STATE = ("pending array<struct<ts_us: long, seq: long, t: string>>, "
             "last_t string, last_us long")


def login_fail_pattern(logins: DataFrame, within="2 seconds", delay="3 seconds") -> DataFrame:
    """begin(fail).next(fail).within(d) per user in event-time order.

    Rows wait in state until the watermark passes them, then are matched in
    order against the previous row of the user (strict contiguity)."""
    w_us = parse_duration_us(within)

    def step(key, batches, state):
        pending, last_t, last_us = state.get if state.exists else ([], None, None)
        ready, pending = _release(batches, state, [tuple(p) for p in (pending or [])])
        out = []
        for ts, _seq, t in ready:
            if t == "fail" and last_t == "fail" and ts - last_us < w_us:
                out.append((key[0], last_us // 1000, ts // 1000, M.LOGIN_PATTERN))
            last_t, last_us = t, ts
        if last_us is not None and last_us + w_us <= state.getCurrentWatermarkMs() * 1000:
            last_t = last_us = None  # no row to come can pair with it
        if pending or last_t == "fail":
            state.update((pending, last_t, last_us))
            _pending_timer(state, pending, [last_us + w_us] if last_t == "fail" else [])
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame(out, columns=["user_id", "first_fail_ms", "last_fail_ms", "msg"])

    return (logins.withWatermark("ts", delay).groupBy("user_id")
                  .applyInPandasWithState(step, PAIR_OUT, SEQ_STATE, "append", GroupStateTimeout.EventTimeTimeout))


def login_fail_consecutive(logins: DataFrame, within="2 seconds", idle="7 days") -> DataFrame:
    """A fail right after a fail of the same user, less than d later, in
    arrival order (rows of a micro-batch in (ts, seq) order); no timers.

    A user's last event is forgotten once the watermark is ``idle`` past it;
    only a fail delayed by more than that could still have paired with it."""
    w_us, idle_us = parse_duration_us(within), parse_duration_us(idle)
    msg = M.LOGIN_CONSECUTIVE.format(secs=w_us // 1_000_000)

    def step(key, batches, state):
        if state.hasTimedOut:
            state.remove()
            return
        last_t, last_us = state.get if state.exists else (None, None)
        rows = _frames(batches)
        before_t, before_us = rows["event_type"].shift(1), rows["ts_us"].shift(1)
        before_t.iloc[0], before_us.iloc[0] = last_t, last_us
        hit = (rows["event_type"] == "fail") & (before_t == "fail") & (rows["ts_us"] < before_us.astype("float64") + w_us)
        state.update((rows["event_type"].iloc[-1], int(rows["ts_us"].iloc[-1])))
        state.setTimeoutTimestamp(max(int(rows["ts_us"].iloc[-1]) + idle_us, (state.getCurrentWatermarkMs() + 1) * 1000) // 1000)
        if hit.any():
            yield pd.DataFrame({"user_id": key[0], "first_fail_ms": before_us[hit].astype("int64") // 1000,
                                "last_fail_ms": rows["ts_us"][hit] // 1000, "msg": msg})

    # rows of any age count here, so the watermark only drives the time-out
    return (logins.withWatermark("ts", _interval(idle)).groupBy("user_id")
                  .applyInPandasWithState(step, PAIR_OUT, "last_t string, last_us long", "append",
                                          GroupStateTimeout.EventTimeTimeout))


ORDER_PATTERN_OUT = "order_id long, result string, create_ms long, pay_ms long"
ORDER_PATTERN_STATE = ("pending array<struct<ts_us: long, seq: long, t: string>>, "
                       "creates array<long>")


def order_timeout_pattern(orders: DataFrame, within="15 minutes", delay="0 seconds") -> DataFrame:
    """begin(create).followedBy(pay).within(d) per order.

    Released rows are matched in event-time order: a pay resolves every
    create waiting before it (paid if less than d later, else timed out); a
    create whose deadline the watermark has passed times out. Output rows:
    ('payed successfully', create_ms, pay_ms) or ('timeout : +<ms>', NULL, NULL).
    """
    w_us = parse_duration_us(within)

    def step(key, batches, state):
        pending, creates = state.get if state.exists else ([], [])
        creates = list(creates or [])
        ready, pending = _release(batches, state, [tuple(p) for p in (pending or [])])
        out = []

        def expire(upto_us):
            keep = []
            for c in creates:
                if c + w_us <= upto_us:
                    out.append((key[0], M.PATTERN_TIMEOUT.format(ms=(c + w_us) // 1000), None, None))
                else:
                    keep.append(c)
            return keep

        for ts, _seq, t in ready:
            creates = expire(ts)
            if t == "create":
                creates.append(ts)
            elif t == "pay":
                out.extend((key[0], M.PAID, c // 1000, ts // 1000) for c in creates)
                creates = []
        creates = expire(state.getCurrentWatermarkMs() * 1000)
        if pending or creates:
            state.update((pending, creates))
            _pending_timer(state, pending, [c + w_us for c in creates])
        elif state.exists:
            state.remove()
        if out:
            df = pd.DataFrame(out, columns=["order_id", "result", "create_ms", "pay_ms"])
            yield df.astype({"create_ms": "Int64", "pay_ms": "Int64"})

    return (orders.withWatermark("ts", delay).groupBy("order_id")
                  .applyInPandasWithState(step, ORDER_PATTERN_OUT, ORDER_PATTERN_STATE, "append",
                                          GroupStateTimeout.EventTimeTimeout))


CLICK_OUT = "kind string, user_id long, ad_id long, province string, city string, ts_ms long, day string, msg string"


def click_limit(clicks: DataFrame, limit: int = 100, zone: str = "Asia/Shanghai", lateness="1 day") -> DataFrame:
    """Per (user, ad): the first ``limit`` clicks of each local day pass
    (kind 'pass'), click limit+1 gives one warning (kind 'warn'), the rest are
    dropped.

    State is a count per day, kept until the watermark is ``lateness`` past
    the day's end: a late click counts for its own day."""
    tz = ZoneInfo(zone)

    def day_end_ms(day: str) -> int:
        return int((pd.Timestamp(day, tz=tz) + pd.DateOffset(days=1)).timestamp() * 1000)

    def step(key, batches, state):
        counts = dict(state.get[0] or []) if state.exists else {}
        wm = state.getCurrentWatermarkMs()
        rows = _frames(batches)
        out = None
        if len(rows):
            days = pd.to_datetime(rows["ts_us"], unit="us", utc=True).dt.tz_convert(tz).dt.strftime("%Y-%m-%d")
            rank = rows.groupby(days).cumcount() + 1 + days.map(counts).fillna(0).astype("int64")
            for day, n in days.value_counts().items():
                counts[day] = counts.get(day, 0) + int(n)
            keep = rank <= limit + 1
            passed = rank <= limit
            out = pd.DataFrame({"kind": passed.map({True: "pass", False: "warn"}), "user_id": key[0], "ad_id": key[1], "province": rows["province"].where(passed),
                                "city": rows["city"].where(passed), "ts_ms": rows["ts_us"] // 1000, "day": days,
                                "msg": passed.map({True: None, False: M.CLICK_LIMIT.format(limit=limit)})})[keep]
        counts = {d: n for d, n in counts.items() if day_end_ms(d) + late_ms > wm}
        if counts:
            state.update((list(counts.items()),))
            state.setTimeoutTimestamp(max(min(map(day_end_ms, counts)) + late_ms, wm + 1))
        elif state.exists:
            state.remove()
        if out is not None and len(out):
            yield out

    late_ms = parse_duration_us(lateness) // 1000
    # the watermark is held back by the lateness, so Spark drops no click that still has its count
    return (clicks.withWatermark("ts", _interval(lateness)).groupBy("user_id", "ad_id")
                  .applyInPandasWithState(step, CLICK_OUT, "counts array<struct<day: string, n: long>>", "append",
                                          GroupStateTimeout.EventTimeTimeout))


def unique_visitors_approx(ub: DataFrame, size="1 hour", delay="0 seconds") -> DataFrame:
    """Update mode: a revised distinct-user estimate per window after every
    micro-batch (the per-element refire of the reference, batched)."""
    return (ub.withWatermark("ts", delay).where(F.col("behavior") == "pv")
              .groupBy(F.window("ts", size).alias("w"))
              .agg(F.approx_count_distinct("user_id").alias("uv"))
              .select(F.unix_millis("w.end").alias("window_end"), "uv"))


# ----------------------------------------------------------------------------- fine sliding windows
def pane_updates(df: DataFrame, keys, size, slide, delay="0 seconds", where=None) -> DataFrame:
    """Update-mode counts per (keys, pane of one slide): keys, pane (its end, µs), n, max_us.

    Spark's window state holds a pane until the watermark is ``size`` past it: so
    long a late row still falls in a window that is open. ``max_us`` is the
    newest time of the pane's rows; rows left out by ``where`` advance it, too,
    and come as panes with n = 0 and NULL keys."""
    counts = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    by = [F.when(counts, F.col(k)).alias(k) for k in keys]
    return (df.withWatermark("ts", _interval(delay, size))
              .select("ts", "ts_us", counts.cast("long").alias("_one"), *by)
              .groupBy(F.window("ts", f"{parse_duration_us(slide)} microseconds").alias("w"), *keys)
              .agg(F.sum("_one").alias("n"), F.max("ts_us").alias("max_us"))
              .select(*keys, F.unix_micros("w.end").alias("pane"), "n", "max_us"))


class _PaneLog:
    """The pane updates of the epochs up to one, kept in an ``EpochLog``.

    Merged panes that no open window can hold are let go, but for the newest time
    of all."""

    def __init__(self, batch: DataFrame, epoch: int, path: str, keys: list[str], size_us: int, slide_us: int, delay_us: int):
        self.keys, self.size_us, self.slide_us, self.delay_us = keys, size_us, slide_us, delay_us
        earlier, self.own = EpochLog(path, self._merge).write(batch, epoch)
        self.rows = earlier.withColumn("own", F.lit(False)).unionByName(self.own.withColumn("own", F.lit(True)))
        newest = self.rows.agg(F.max(F.when(~F.col("own"), F.col("max_us"))), F.max("max_us")).first()
        # the last window end that the watermark (newest time - delay) has passed, before this epoch and with it
        self.closed_before, self.closed = (self._closed(m) if m is not None else None for m in newest)

    def _closed(self, newest_us):
        return (newest_us - self.delay_us) // self.slide_us * self.slide_us

    def _merge(self, rows: DataFrame) -> DataFrame:
        newest = rows.agg(F.max("max_us")).first()[0]
        panes = rows.groupBy(*self.keys, "pane").agg(F.max("n").alias("n"), F.max("max_us").alias("max_us"))  # a pane's count only grows
        if newest is None:
            return panes
        mark = rows.limit(1).select(*[F.lit(None).cast(rows.schema[k].dataType).alias(k) for k in self.keys], F.lit(0).cast("long").alias("pane"),
                                    F.lit(0).cast("long").alias("n"), F.lit(newest).cast("long").alias("max_us"))
        return panes.where((F.col("n") > 0) & (F.col("pane") > F.lit(self._closed(newest) - self.size_us))).unionByName(mark)

    def panes(self, before: bool = False) -> DataFrame:
        """(keys, pane, n) of the panes that windows open before this epoch can hold."""
        rows = self.rows.where(F.col("n") > 0)
        if before:
            rows = rows.where(~F.col("own"))
        if self.closed_before is not None:
            rows = rows.where(F.col("pane") > F.lit(self.closed_before - self.size_us + self.slide_us))
        return rows.groupBy(*self.keys, "pane").agg(F.max("n").alias("n"))


def sliding_count_writer(df: DataFrame, keys, size, slide, state_dir: str, write_batch,
                         delay="0 seconds", where=None):
    """Sliding counts as a stream, for slides too fine for ``F.window``.

    Spark's own window state counts panes of one slide (``pane_updates``); the
    updates of an epoch are a partition of a pane table under ``state_dir``, a
    shared folder. Windows whose end the watermark (max event time - delay)
    has passed are swept into change points (keys, end_from, end_to, cnt) and
    handed to ``write_batch(df, epoch_id)`` exactly once; a replayed epoch calls
    it again with the same rows, so it should write idempotently per epoch.
    A row counts in its windows not yet emitted (``late_rows`` gives those
    that have none left). ``where`` says which rows count.
    """
    keys = list(keys)
    size_us, slide_us, delay_us = parse_duration_us(size), parse_duration_us(slide), parse_duration_us(delay)

    def each(batch: DataFrame, epoch_id: int) -> None:
        log = _PaneLog(batch, epoch_id, state_dir, keys, size_us, slide_us, delay_us)
        if log.closed is None or log.closed == log.closed_before:
            return
        seg = changes_from_panes(log.panes(), keys, size_us, slide_us).where(F.col("_from") <= F.lit(log.closed))
        low = F.col("_from")
        if log.closed_before is not None:
            first = F.lit(log.closed_before + slide_us)
            seg, low = seg.where(F.col("_to") > first), F.greatest(low, first)
        write_batch(seg.select(*keys, floor_div(low, 1000).alias("end_from"),
                               floor_div(F.least(F.col("_to"), F.lit(log.closed + slide_us)), 1000).alias("end_to"), "cnt"), epoch_id)

    return pane_updates(df, keys, size, slide, delay, where).writeStream.outputMode("update").foreachBatch(each)


def hot_pages_writer(log: DataFrame, write_batch, state_dir: str, n: int = 3, size="10 minutes",
                     slide="5 seconds", delay="1 second", lateness="1 minute"):
    """Top-n urls per window as a stream (the reference's hot pages).

    Counts come from ``sliding_count_writer`` with the watermark held back by
    delay + lateness, so each window is ranked once with every row that
    arrived within the allowed lateness; the closed windows of a micro-batch
    are expanded and ranked with the batch top-N (partial limit before the
    shuffle). ``write_batch`` gets (window_end, rnk, url, cnt) frames.
    """
    slide_us = parse_duration_us(slide)

    def rank(segments: DataFrame, epoch_id: int) -> None:
        segs = segments.select("url", "cnt", (F.col("end_from") * 1000).alias("_from"), (F.col("end_to") * 1000).alias("_to"))
        windows = expand_segments(segs, ["url"], slide_us).withColumn("window_end", floor_div(F.col("_e"), 1000))
        ranked = top_n(windows, ["window_end"], "cnt", n, tie=["url"], rank_col="rnk")
        write_batch(ranked.select("window_end", "rnk", "url", "cnt"), epoch_id)

    return sliding_count_writer(log, ["url"], size, slide, state_dir, rank, delay=_interval(delay, lateness),
                                where=F.col("method") == "GET")


def late_rows(rows: DataFrame, size="10 minutes", slide="5 seconds", delay="1 second", lateness="1 minute") -> DataFrame:
    """Rows that come when even their newest window is closed for good (the late side output), whole.

    They are told by the watermark (max event time - delay - lateness) of the
    micro-batches before; nothing is kept in state. ``rows`` are dealt over
    tasks by hash."""
    size_us, slide_us = parse_duration_us(size), parse_duration_us(slide)

    def step(key, batches, state):
        wm_us = state.getCurrentWatermarkMs() * 1000
        for pdf in batches:
            newest_end = pdf["ts_us"] // slide_us * slide_us + size_us
            yield pdf[newest_end - 1000 < wm_us].drop(columns="_deal")

    dealt = rows.withWatermark("ts", _interval(delay, lateness)).withColumn("_deal", F.pmod(F.xxhash64("seq"), F.lit(1024)))
    return dealt.groupBy("_deal").applyInPandasWithState(step, rows.schema, "n long", "append", GroupStateTimeout.NoTimeout)


def passed_clicks(clicks: DataFrame, limit: int = 100, zone: str = "Asia/Shanghai") -> DataFrame:
    """The click stream after the blacklist filter: user_id, ad_id, province, city, ts_us, ts.

    Write it to a table; ``province_counts_writer`` reads that as a stream of its own."""
    return (click_limit(clicks, limit, zone).where(F.col("kind") == "pass")
            .select("user_id", "ad_id", "province", "city", (F.col("ts_ms") * 1000).alias("ts_us"))
            .withColumn("ts", F.timestamp_micros("ts_us")))


def province_counts_writer(passed: DataFrame, write_counts, state_dir: str, size="1 day", slide="5 seconds", delay="0 seconds"):
    """Province counts of the passed clicks in sliding windows, as a stream of change points."""
    return sliding_count_writer(passed, ["province"], size, slide, state_dir, write_counts, delay=delay)


def market_writer(mk: DataFrame, write_counts, state_dir: str, exclude="uninstall", size="1 day",
                  slide="5 seconds", delay="0 seconds"):
    """Counts per (channel, behavior) in sliding windows, as a stream of change points."""
    return sliding_count_writer(mk, ["channel", "behavior"], size, slide, state_dir, write_counts, delay=delay,
                                where=F.col("behavior") != exclude)


# ----------------------------------------------------------------------------- retract stream of the top-N
def top_n_changelog_writer(rows: DataFrame, id_col: str, write_changes, state_dir: str, n: int, size, slide,
                           delay="0 seconds", where=None):
    """Top-n ids per sliding window as a retract stream: after every
    micro-batch, the rows (is_add, window_end ms, id, cnt, row_num) that turn
    the previous top-n of each window into the current one (false = retract,
    true = add). Counts are of the rows ``where`` keeps per ``id_col``.

    Panes are counted and kept as in ``sliding_count_writer``. A micro-batch
    recounts only the windows that its panes fall in, from the pane table with
    and without its own updates. A window whose end the watermark (max event
    time - delay) has passed is final and no longer revised.
    """
    size_us, slide_us, delay_us = parse_duration_us(size), parse_duration_us(slide), parse_duration_us(delay)

    def ends(panes: DataFrame) -> DataFrame:
        end = F.explode(F.sequence(F.col("pane"), F.col("pane") + F.lit(size_us - slide_us), F.lit(slide_us)))
        return panes.withColumn("window_end", end)

    def each(batch: DataFrame, epoch_id: int) -> None:
        log = _PaneLog(batch, epoch_id, state_dir, [id_col], size_us, slide_us, delay_us)
        own = log.own.where(F.col("n") > 0)
        touched = ends(own.select("pane").distinct()).select("window_end").distinct()
        if log.closed_before is not None:
            touched = touched.where(F.col("window_end") > F.lit(log.closed_before))

        def best(panes: DataFrame) -> DataFrame:
            counts = (ends(panes).join(touched, "window_end", "left_semi")
                      .groupBy("window_end", id_col).agg(F.sum("n").cast("long").alias("cnt")))
            return (top_n(counts, ["window_end"], "cnt", n, tie=[id_col], rank_col="row_num")
                    .select("window_end", id_col, "cnt", "row_num"))

        changes = changelog(best(log.panes(before=True)), best(log.panes()))
        write_changes(changes.withColumn("window_end", floor_div(F.col("window_end"), 1000)), epoch_id)

    return pane_updates(rows, [id_col], size, slide, delay, where).writeStream.outputMode("update").foreachBatch(each)


def hot_items_changelog_writer(ub: DataFrame, write_changes, state_dir: str, n: int = 5, size="1 hour",
                               slide="5 minutes", delay="0 seconds"):
    """The reference's SQL top-N as a retract stream (rows: is_add,
    window_end, item_id, cnt, row_num); see ``top_n_changelog_writer``."""
    return top_n_changelog_writer(ub, "item_id", write_changes, state_dir, n, size, slide, delay,
                                  where=F.col("behavior") == "pv")


def hot_pages_changelog_writer(log: DataFrame, write_changes, state_dir: str, n: int = 3, size="10 minutes",
                               slide="5 seconds", delay="1 second", lateness="1 minute"):
    """Hot pages that fire early and revise: after every micro-batch the
    top-n urls of each window it touched are re-ranked and the changes
    emitted, until the watermark passes the window's end plus the allowed
    lateness (rows: is_add, window_end, url, cnt, row_num)."""
    return top_n_changelog_writer(log, "url", write_changes, state_dir, n, size, slide, _interval(delay, lateness),
                                  where=F.col("method") == "GET")
