"""Counting aggregates per window: plain, salted two-stage and distinct (exact,
hashed bits, bitmap, HLL sketch, running)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.functions.hashing import poly_hash
from tidepool.functions.timecols import floor_div, parse_duration_us
from tidepool.operators.scan import HOT_CHUNK, add_split_chunk, running


def tumbling_end(df: DataFrame, size, out: str = "window_end") -> DataFrame:
    """Epoch-ms end of the epoch-aligned tumbling window holding ``ts_us``."""
    s = parse_duration_us(size)
    return df.withColumn(out, floor_div(F.col("ts_us") - F.pmod(F.col("ts_us"), F.lit(s)) + F.lit(s), 1000))


def salted_count(df: DataFrame, keys: Sequence[str], salt_of: str, buckets: int,
                 out: str = "cnt") -> DataFrame:
    """Two-stage count: per (keys, salt) then per keys.

    The salt is a deterministic hash bucket of ``salt_of``, so a rerun (or a
    retried task) puts every row in the same bucket.
    """
    salt = F.pmod(F.xxhash64(F.col(salt_of)), F.lit(buckets))
    part = df.groupBy(*keys, salt.alias("_salt")).agg(F.count(F.lit(1)).alias("_n"))
    return part.groupBy(*keys).agg(F.sum("_n").cast("long").alias(out))


def distinct_exact(df: DataFrame, keys: Sequence[str], of: str, out: str = "uv") -> DataFrame:
    return df.groupBy(*keys).agg(F.countDistinct(of).cast("long").alias(out))


def distinct_bits(df: DataFrame, keys: Sequence[str], of: str, out: str = "uv",
                  seed: int = 61, bits: int = 29) -> DataFrame:
    """Distinct positions in a 2^bits bitmap, position = polynomial hash of the
    value's text. Like a one-hash Bloom filter: collisions can only undercount."""
    pos = poly_hash(F.col(of).cast("string"), seed, bits)
    return df.groupBy(*keys).agg(F.countDistinct(pos).cast("long").alias(out))


def distinct_bitmap(df: DataFrame, keys: Sequence[str], of: str, out: str = "uv") -> DataFrame:
    """Exact distinct count of an integer column with Spark's bitmap aggregates.

    Bitmaps are built per (keys, bucket) - one 4 KB bitmap per 32,768 values -
    then counted and summed, so no single bitmap grows with the data.
    """
    v = F.col(of)
    per_bucket = (df.groupBy(*keys, F.bitmap_bucket_number(v).alias("_b"))
                    .agg(F.bitmap_construct_agg(F.bitmap_bit_position(v)).alias("_bm")))
    return per_bucket.groupBy(*keys).agg(F.sum(F.bitmap_count("_bm")).cast("long").alias(out))


def distinct_hll(df: DataFrame, keys: Sequence[str], of: str, out: str = "uv",
                 lg_k: int = 12) -> DataFrame:
    """HLL sketch per group (mergeable; estimate, exact while the sketch is small)."""
    return (df.groupBy(*keys).agg(F.hll_sketch_agg(F.col(of), lg_k).alias("_sk"))
              .select(*keys, F.hll_sketch_estimate("_sk").cast("long").alias(out)))


def running_distinct(df: DataFrame, keys: Sequence[str], of: str, id_col: str,
                     order: Sequence[str] = ("ts_us", "seq"), out: str = "uv",
                     chunk="1 hour", limit: int = HOT_CHUNK) -> DataFrame:
    """Per row: distinct ``of`` values of its group seen up to and including it.

    The first sighting of each (group, value) comes from an aggregate (a
    partial min, so a hot value costs no sort); each sighting becomes a +1
    marker that sorts just before the row it belongs to. Markers and rows go
    through one chunked running sum (chunks that hold very many rows are cut,
    ties of one time stamp too), read off at the rows. Returns keys,
    ``id_col``, the order columns and ``out``.
    """
    keys, order = list(keys), list(order)
    firsts = (df.groupBy(*keys, of).agg(F.min(F.struct(*[F.col(c) for c in order])).alias("_f"))
                .select(*keys, *[F.col(f"_f.{c}").alias(c) for c in order]))
    ids = [] if id_col in order else [id_col]
    marks = firsts.select(*keys, *order, F.lit(1).alias("_v"), F.lit(0).alias("_kind"),
                          *[F.lit(None).cast(df.schema[c].dataType).alias(c) for c in ids])
    rows = df.select(*keys, *order, F.lit(0).alias("_v"), F.lit(1).alias("_kind"), *ids)
    both = add_split_chunk(marks.unionByName(rows), keys, order[0], order[1], parse_duration_us(chunk), limit=limit)
    res = running(both, keys, [*order, "_kind"], "_v", out, "_chunk")
    return (res.where(F.col("_kind") == 1)
               .select(*keys, *ids, *order, F.col(out).cast("long").alias(out)))
