"""Per-key stateful rules of the reference's process functions, as batch plans.

Each rule is stated on rows ordered per key by (ts_us, seq) - or by arrival
order where the rule depends on it - and written with aggregates, chunked
ordered scans and joins; no key is ever gathered into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepool.functions import messages as M
from tidepool.functions.timecols import day_in_zone, floor_div, ms_of, pane_end, parse_duration_us
from tidepool.operators.bursts import greedy_bursts
from tidepool.operators.scan import HOT_CHUNK, add_arrival_chunk, add_split_chunk, nearest, running
from tidepool.operators.topn import first_rows
from tidepool.operators.windows import changes_from_points, expand_segments

# Chunk width of per-key ordered scans. Wide, so that a key's chunk sums up many
# rows; where one holds very many it is cut (add_split_chunk).
WIDE_CHUNK_US = 86_400_000_000


# --------------------------------------------------------------------------- click limit
def click_limit(df: DataFrame, keys: Sequence[str] = ("user_id", "ad_id"), limit: int = 100,
                zone: str = "Asia/Shanghai") -> tuple[DataFrame, DataFrame]:
    """Per key and local day: pass the first ``limit`` clicks, drop the rest and
    warn once, at click limit+1.

    Returns (passed rows, warnings: keys, day, ts_ms, msg). Only the first
    limit + 1 rows of a key and day get past ``first_rows``' limits, so a key
    with millions of clicks never goes whole to one task.
    """
    keys = list(keys)
    d = df.withColumn("day", day_in_zone(F.col("ts_us"), zone))
    ranked = first_rows(d, [*keys, "day"], [F.col("ts_us"), F.col("seq")], limit + 1, "_rn")
    passed = ranked.where(F.col("_rn") <= limit).drop("_rn", "day")
    warnings = (ranked.where(F.col("_rn") == limit + 1)
                      .select(*keys, "day", ms_of(F.col("ts_us")).alias("ts_ms"),
                              F.lit(M.CLICK_LIMIT.format(limit=limit)).alias("msg")))
    return passed, warnings


# --------------------------------------------------------------------------- order status
def order_pay_status(df: DataFrame, key: str = "order_id", limit_us: int = 900_000_000,
                     kind: str = "event_type") -> DataFrame:
    """One result per order from its first create and first pay.

    pay < create + limit -> 'payed successfully' (a pay before its create too);
    pay >= create + limit -> 'payed but already timeout'; pay only -> 'payed
    but not found create log'; create only -> 'order timeout'.
    """
    first = (df.groupBy(key)
               .agg(F.min(F.when(F.col(kind) == "create", F.col("ts_us"))).alias("_c"),
                    F.min(F.when(F.col(kind) == "pay", F.col("ts_us"))).alias("_p"))
               .where(F.col("_c").isNotNull() | F.col("_p").isNotNull()))
    result = (F.when(F.col("_c").isNotNull() & F.col("_p").isNotNull(),
                     F.when(F.col("_p") < F.col("_c") + F.lit(limit_us), F.lit(M.PAID))
                      .otherwise(F.lit(M.PAID_LATE)))
               .when(F.col("_p").isNotNull(), F.lit(M.PAY_WITHOUT_CREATE))
               .otherwise(F.lit(M.ORDER_TIMEOUT)))
    return first.select(F.col(key), result.alias("result"))


# --------------------------------------------------------------------------- login: consecutive fails
def consecutive_fails(df: DataFrame, key: str = "user_id", within_us: int = 2_000_000,
                      order: Sequence[str] | None = ("ts_us", "seq"), chunk_us: int = WIDE_CHUNK_US) -> DataFrame:
    """A fail whose previous event of the same key (in ``order``; None: in the
    order of arrival) is a fail less than ``within`` earlier (a negative gap
    also counts) -> one warning (key, first_fail_ms, last_fail_ms, msg).

    The gap to the previous event has no bound in arrival order, so this is a
    chunked scan; its chunks are wide enough to summarise a key's rows."""
    d = df.withColumn("_me", F.struct(F.col("event_type").alias("t"), F.col("ts_us").alias("u")))
    if order is None:
        d, order = add_arrival_chunk(d, chunk_us, [key])
    else:
        order = list(order)
        d = add_split_chunk(d, [key], order[0], order[1], chunk_us)
    d = nearest(d, [key], order, "_me", "_prev", "_chunk", direction="before")
    hit = ((F.col("event_type") == "fail") & (F.col("_prev.t") == "fail")
           & (F.col("ts_us") < F.col("_prev.u") + F.lit(within_us)))
    secs = within_us // 1_000_000
    return d.where(hit).select(F.col(key), ms_of(F.col("_prev.u")).alias("first_fail_ms"),
                               ms_of(F.col("ts_us")).alias("last_fail_ms"),
                               F.lit(M.LOGIN_CONSECUTIVE.format(secs=secs)).alias("msg"))


# --------------------------------------------------------------------------- login: bursts
def fail_bursts(df: DataFrame, key: str = "user_id", within_us: int = 2_000_000, min_fails: int = 2,
                limit: int = HOT_CHUNK) -> DataFrame:
    """Greedy fail bursts per key in event-time order.

    A fail opens a burst with deadline ts + within; later fails up to the
    deadline join it; the next fail after the deadline opens a new burst. A
    success cancels the open burst if it comes by its deadline, and fails
    after it start afresh. A burst that closes with >= ``min_fails`` fails
    gives (key, first_fail_ms, last_fail_ms, fail_count, msg). ``bursts`` says how
    a key's life is cut into chunks.
    """
    bursts = greedy_bursts(df, key, within_us, limit=limit)
    secs = within_us // 1_000_000
    out = bursts.where(~F.col("cancelled") & (F.col("fail_count") >= min_fails))
    return out.select(F.col(key), ms_of(F.col("first_u")).alias("first_fail_ms"),
                      ms_of(F.col("last_u")).alias("last_fail_ms"), F.col("fail_count").cast("long"),
                      F.format_string(M.LOGIN_BURST.format(secs=secs, n="%d"), F.col("fail_count")).alias("msg"))


# --------------------------------------------------------------------------- late rows
def with_arrival_watermark(df: DataFrame, delay="1 second", chunk="1 minute",
                           limit: int = HOT_CHUNK, floor_us: int | None = None) -> tuple[DataFrame, list[str]]:
    """(``df`` with ``watermark_us``, its arrival order): the watermark before each row, max(ts of
    earlier arrivals) - delay, NULL before the first. ``floor_us`` is the newest time of
    what arrived before all of ``df``.

    The running maximum over the global arrival order is a chunked scan with
    no key: a task holds one minute of arrivals or a part of it
    (``add_split_chunk``), or one split of the input files, and the carry runs over
    one row per chunk in a single small task.
    """
    d, arrival = add_arrival_chunk(df, parse_duration_us(chunk), limit=limit)
    d = running(d, [], arrival, "ts_us", "_maxprev", "_chunk", how="max", inclusive=False)
    newest = F.col("_maxprev") if floor_us is None else F.greatest("_maxprev", F.lit(floor_us))
    return d.withColumn("watermark_us", newest - F.lit(parse_duration_us(delay))).drop("_maxprev", "_chunk"), arrival


def split_late(df: DataFrame, size="10 minutes", slide="5 seconds", lateness="1 minute",
               delay="1 second", chunk="1 minute", limit: int = HOT_CHUNK, floor_us: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(on-time rows, late rows) of a sliding-window job with bounded disorder.

    A row is late when at its arrival even its newest window [start, start +
    size) is closed for good: start + size - 1 ms + lateness <= watermark.
    Adds ``watermark_us``.
    """
    size_us, slide_us, late_us = parse_duration_us(size), parse_duration_us(slide), parse_duration_us(lateness)
    d, _ = with_arrival_watermark(df, delay, chunk, limit, floor_us)
    newest_end = pane_end(F.col("ts_us"), slide_us) - F.lit(slide_us) + F.lit(size_us)
    is_late = F.coalesce(newest_end - F.lit(1000) + F.lit(late_us) <= F.col("watermark_us"), F.lit(False))
    d = d.withColumn("_late", is_late)
    return d.where(~F.col("_late")).drop("_late"), d.where(F.col("_late")).drop("_late")


def fired_counts(df: DataFrame, keys: Sequence[str], size="10 minutes", slide="5 seconds", lateness="1 minute",
                 delay="1 second", where=None) -> DataFrame:
    """What a sliding-window count emits under bounded disorder and allowed lateness.

    A window fires when the watermark reaches its end - 1 ms, with the rows
    that came before (``kind`` 'first'), and again for each row that comes later
    but before the watermark is ``lateness`` past that ('revision', with the row's
    ``seq`` as ``event_id``). The input is bounded, so every window fires in the end. Rows
    left out by ``where`` only advance the watermark. Returns keys, window_end
    (ms), kind, event_id, cnt.

    The window ends a row is in time for are an interval, so the first counts are
    a sweep like those of ``sliding_count``; only rows behind the watermark
    are copied to the few windows they revise.
    """
    keys = list(keys)
    size_us, slide_us, late_us = parse_duration_us(size), parse_duration_us(slide), parse_duration_us(lateness)
    d, arrival = with_arrival_watermark(df, delay)
    if where is not None:
        d = d.where(where)
    pane, passed = pane_end(F.col("ts_us"), slide_us), F.col("watermark_us") + F.lit(1000)
    d = d.select(*keys, *dict.fromkeys([*arrival, "seq"]), pane.alias("_lo"), (pane + F.lit(size_us)).alias("_stop"),
                 F.coalesce(F.greatest(pane, pane_end(passed, slide_us)), pane).alias("_open"),
                 F.greatest(pane, pane_end(passed - F.lit(late_us), slide_us)).alias("_first_late"),
                 F.least(pane + F.lit(size_us), pane_end(passed, slide_us)).alias("_late_stop"))
    on_time = d.where(F.col("_open") < F.col("_stop"))
    points = (on_time.select(*keys, F.col("_open").alias("point"), F.lit(1).cast("long").alias("delta"))
              .unionByName(on_time.select(*keys, F.col("_stop").alias("point"), F.lit(-1).cast("long").alias("delta"))))
    first = expand_segments(changes_from_points(points, keys), keys, slide_us)
    late = d.where(F.col("_first_late") < F.col("_late_stop")).select(
        *keys, *dict.fromkeys([*arrival, "seq"]),
        F.explode(F.sequence(F.col("_first_late"), F.col("_late_stop") - F.lit(slide_us), F.lit(slide_us))).alias("_e"))
    nth = F.row_number().over(Window.partitionBy(*keys, "_e").orderBy(*arrival))
    late = late.select(*keys, "_e", F.col("seq").alias("event_id"), nth.alias("_nth"))
    base = first.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_e").alias("_e1"), F.col("cnt").alias("_base"))
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys] + [F.col("_e") == F.col("_e1")]
    revised = late.join(base, same, "left").select(
        *keys, "_e", F.lit("revision").alias("kind"), "event_id", (F.coalesce("_base", F.lit(0)) + F.col("_nth")).cast("long").alias("cnt"))
    fired = first.select(*keys, "_e", F.lit("first").alias("kind"), F.lit(None).cast(df.schema["seq"].dataType).alias("event_id"), F.col("cnt").cast("long").alias("cnt"))
    return fired.unionByName(revised).select(*keys, floor_div(F.col("_e"), 1000).alias("window_end"), "kind", "event_id", "cnt")
