"""Event-time columns.

Inside the library event time is ``ts_us``: BIGINT microseconds since the
epoch. It is computed without the session time zone, so a query gives the
same answer whatever zone the session runs in. ``ts`` is kept as an instant
(TIMESTAMP) for ``F.window`` and ``withWatermark``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS = 1_000_000
_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

_UNITS = {
    "us": 1, "microsecond": 1, "ms": 1000, "millisecond": 1000,
    "s": MICROS, "sec": MICROS, "second": MICROS,
    "m": 60 * MICROS, "min": 60 * MICROS, "minute": 60 * MICROS,
    "h": 3600 * MICROS, "hour": 3600 * MICROS,
    "d": 86400 * MICROS, "day": 86400 * MICROS,
}


def parse_duration_us(d) -> int:
    """'5 seconds', '1 hour', '15 min', 300 (seconds) -> microseconds."""
    if isinstance(d, (int, float)):
        return int(d * MICROS)
    total = 0
    for num, unit in re.findall(r"(-?\d+(?:\.\d+)?)\s*([a-zA-Z]+)", d):
        u = unit.lower().rstrip("s") if unit.lower() not in ("s", "ms", "us") else unit.lower()
        if u not in _UNITS:
            raise ValueError(f"unknown time unit in {d!r}")
        total += int(float(num) * _UNITS[u])
    if total == 0 and not re.search(r"\d", d):
        raise ValueError(f"no duration in {d!r}")
    return total


def floor_div(col: Column, n: int) -> Column:
    """Exact floor division of a BIGINT column by a positive constant."""
    return F.call_function("div", col - F.pmod(col, F.lit(n)), F.lit(n))


def pane_end(ts_us: Column, slide_us: int) -> Column:
    """End of the epoch-aligned [start, end) pane of width ``slide_us`` holding ts."""
    return ts_us - F.pmod(ts_us, F.lit(slide_us)) + F.lit(slide_us)


def ms_of(us: Column) -> Column:
    return floor_div(us, 1000)


def epoch_us(df: DataFrame, name: str, unit: str | None = None) -> Column:
    """Zone-free epoch microseconds of column ``name``.

    TIMESTAMP_NTZ is read as a UTC wall clock, TIMESTAMP as an instant;
    numbers need ``unit`` ('s', 'ms' or 'us').
    """
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, {_EPOCH_NTZ}, `{name}`)")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    if unit is None:
        raise ValueError(f"numeric time column {name!r} needs a unit")
    return (c.cast("long") * F.lit({"s": MICROS, "ms": 1000, "us": 1}[unit])).cast("long")


def with_event_time(df: DataFrame, src: str = "ts", unit: str | None = None) -> DataFrame:
    """Add ``ts_us`` and replace ``ts`` by the matching instant."""
    us = epoch_us(df, src, unit)
    return df.withColumns({"ts_us": us, "ts": F.timestamp_micros(us)})


def ntz_of(us: Column) -> Column:
    """UTC wall clock (TIMESTAMP_NTZ) of epoch microseconds; zone-free."""
    return F.timestamp_add("MICROSECOND", us, F.expr(_EPOCH_NTZ))


def day_in_zone(us: Column, zone: str = "UTC") -> Column:
    """Calendar day ('yyyy-MM-dd') of an instant in ``zone``, independent of the session zone."""
    wall = ntz_of(us)
    if zone.upper() != "UTC":
        wall = F.convert_timezone(F.lit("UTC"), F.lit(zone), wall)
    return F.date_format(F.to_date(wall), "yyyy-MM-dd")


def timestamp_text(us: Column, zone: str = "UTC") -> Column:
    """'yyyy-MM-dd HH:mm:ss.S' text of an instant in ``zone`` (the JDBC timestamp
    layout the reference prints), for whole-second instants."""
    wall = ntz_of(us)
    if zone.upper() != "UTC":
        wall = F.convert_timezone(F.lit("UTC"), F.lit(zone), wall)
    return F.concat(F.date_format(wall, "yyyy-MM-dd HH:mm:ss"), F.lit("."),
                    F.substring(F.date_format(wall, "SSS"), 1, 1))
