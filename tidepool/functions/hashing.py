"""Polynomial string hash into a bit range, as a higher-order Spark expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def poly_hash(s: Column, seed: int = 61, bits: int = 29) -> Column:
    """h = h * seed + code(c) over the characters of ``s``, kept to the low ``bits`` bits.

    Masking after every step keeps the same low bits as 32-bit wrap-around
    arithmetic followed by one mask, as long as ``bits`` <= 32.
    """
    mask = (1 << bits) - 1
    chars = F.split(s, "")
    return F.aggregate(chars, F.lit(0).cast("long"),
                       lambda acc, c: (acc * F.lit(seed) + F.ascii(c).cast("long")).bitwiseAND(F.lit(mask)))
