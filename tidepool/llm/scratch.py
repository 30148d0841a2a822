"""Tables that cut lineage, in the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; only a local session without it gets one of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    made = tempfile.mkdtemp(prefix="tidepool-llm-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/tidepool-llm/{uuid.uuid4().hex}-{label}"


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the files.

    What is read back no longer depends on earlier stages: a lost executor
    costs only the tasks it ran. The folder is the cluster's scratch space and
    is emptied by whoever owns it.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_hash(df: DataFrame, seed: int = 0):
    """A 64-bit hash of a whole row; null and empty fields differ. Maps, which Spark can't hash, are left out."""
    fields = [F.col(f"`{f.name}`") for f in df.schema if not isinstance(f.dataType, T.MapType)]
    return F.xxhash64(F.lit(seed), *[x for c in fields for x in (c, c.isNull())])
