from pyspark.sql import functions as F


def frame(spark, rows, schema):
    """DataFrame from tuples; adds ts (instant) from ts_us and arrival_us = ts_us if absent."""
    df = spark.createDataFrame(rows, schema)
    if "ts_us" in df.columns:
        df = df.withColumn("ts", F.timestamp_micros("ts_us"))
        if "arrival_us" not in df.columns:
            df = df.withColumn("arrival_us", F.col("ts_us"))
    return df


def tuples(df, cols=None):
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())
