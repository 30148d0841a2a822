"""Session construction and sizing."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # let small shuffles keep one partition per core: windows and sweeps expand
    # rows after the shuffle AQE measured, so a 1 MB floor left that work in one
    # task (measured: 18 s vs 21 s for all queries at sf0.1); on a cluster the
    # partitions are far above this floor and it changes nothing
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    # checkpoint files of iterative operators are deleted once unreferenced (they go
    # to the shared folder the cluster names in spark.checkpoint.dir)
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "tidepool",
                shuffle_partitions: int | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def sized_conf(input_bytes: int, total_cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Partition sizing for a cluster run over ``input_bytes`` of input.

    Scan splits and post-shuffle partitions of about ``partition_bytes`` keep a
    task's working set well inside executor memory; the initial shuffle width
    is at least 3 tasks per core and at least input / partition size, and AQE
    coalesces what turns out smaller. Pass the result as ``conf`` to
    ``get_session``.
    """
    parts = max(3 * total_cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(16 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
    }
