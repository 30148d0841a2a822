"""Bloom filters as tables of bit blocks.

A filter has 2^bits bits. A value sets one bit per seed, at the polynomial hash of its text with
that seed. Bits are kept in blocks of 32,768 (4 KB), a binary row per key and block that has any, so a
filter is built by a partial aggregate, merged by a bitwise or, and probed by a join on the block: it is
never in one place, whatever its size.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.functions.hashing import poly_hash

#: Seeds of the hashes; odd, so that every character counts in the low bits.
SEEDS = (61, 131, 1313)


def _positions(of: str, seeds: Sequence[int], bits: int) -> Column:
    return F.array(*[poly_hash(F.col(of).cast("string"), seed, bits) for seed in seeds])


def build(df: DataFrame, keys: Sequence[str], of: str, seeds: Sequence[int] = SEEDS, bits: int = 29) -> DataFrame:
    """(keys, block, block_bits) of one filter per key over the values of ``of``; nulls are left out."""
    rows = df.where(F.col(of).isNotNull()).select(*keys, F.explode(F.array_distinct(_positions(of, seeds, bits))).alias("_at"))
    return rows.groupBy(*keys, F.bitmap_bucket_number("_at").alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_at")).alias("block_bits"))


def merge(filters: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The filters of all rows with equal ``keys`` in one: blocks merged by a bitwise or."""
    return filters.groupBy(*keys, "block").agg(F.bitmap_or_agg("block_bits").alias("block_bits"))


def might_contain(df: DataFrame, filters: DataFrame, keys: Sequence[str], of: str, id_cols: Sequence[str], seeds: Sequence[int] = SEEDS,
                  bits: int = 29, out: str = "seen") -> DataFrame:
    """(id_cols, out) for rows of ``df``: whether the filter of their keys may hold their ``of``. A value put in is always found.

    ``id_cols`` tell rows apart. Null values are not contained.
    """
    probes = df.select(*dict.fromkeys([*id_cols, *keys]), F.explode_outer(F.when(F.col(of).isNotNull(), F.array_distinct(_positions(of, seeds, bits)))).alias("_at"))
    probes = probes.withColumns({"_block": F.bitmap_bucket_number("_at"), "_bit": F.bitmap_bit_position("_at")})
    right = filters.select(*[F.col(k).alias(f"_f_{k}") for k in keys], F.col("block").alias("_f_block"), "block_bits")
    on = [F.col(k).eqNullSafe(F.col(f"_f_{k}")) for k in keys] + [F.col("_block") == F.col("_f_block")]
    byte = F.conv(F.hex(F.substring(F.col("block_bits"), (F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.call_function("shiftright", byte, (F.col("_bit") % 8).cast("int")).bitwiseAND(F.lit(1)) == 1, F.lit(False))
    return probes.join(right, on, "left").groupBy(*id_cols).agg(F.min(hit).alias(out))


def summary(filters: DataFrame, keys: Sequence[str], seeds: Sequence[int] = SEEDS, bits: int = 29) -> DataFrame:
    """(keys, bits_set, estimate, false_positive_rate): distinct values by the filter's fill, and its rate of error."""
    m, k = float(1 << bits), float(len(seeds))
    fill = F.col("bits_set") / F.lit(m)
    counted = filters.groupBy(*keys).agg(F.sum(F.bitmap_count("block_bits")).cast("long").alias("bits_set"))
    return counted.select(*keys, "bits_set", F.when(fill < 1, F.round(-F.lit(m / k) * F.log1p(-fill))).cast("long").alias("estimate"),
                          F.pow(fill, F.lit(k)).alias("false_positive_rate"))


def expected_false_positives(n: int, seeds: int, bits: int) -> float:
    """The formula for ``n`` values and ideal hashes."""
    return (1 - math.exp(-seeds * n / (1 << bits))) ** seeds
