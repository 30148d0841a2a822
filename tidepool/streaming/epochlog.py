"""A table of what each micro-batch adds, compacted, under a shared folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class EpochLog:
    """Rows per epoch, and what all epochs before one come to, read from a bounded number of folders.

    ``epoch=N`` holds the rows of epoch N, ``merged=N`` what all epochs before N come to; the
    latter is written with every ``every``-th epoch by ``merge``, which must give the same whether it gets
    rows or what rows came to. A replayed epoch overwrites its own folders and reads only those of earlier ones, so it
    gives the same rows again. Folders that neither a replay nor a later epoch reads are removed.
    A folder that should be there and can't be read raises.
    """

    def __init__(self, path: str, merge: Callable[[DataFrame], DataFrame], every: int = 32):
        self.path, self.merge, self.every = path.rstrip("/"), merge, every

    def folders(self, epoch: int) -> list[str]:
        """Folders that hold all epochs before ``epoch``."""
        base = max(epoch - 1, 0) // self.every * self.every
        return [f"{self.path}/merged={base}"] * (base > 0) + [f"{self.path}/epoch={e}" for e in range(base, epoch)]

    def before(self, spark: SparkSession, epoch: int, schema: T.StructType | str) -> DataFrame:
        """What the epochs before ``epoch`` come to."""
        folders = self.folders(epoch)
        if not folders:
            return spark.createDataFrame([], schema)
        return self.merge(spark.read.schema(schema).parquet(*folders))

    def write(self, rows: DataFrame, epoch: int) -> tuple[DataFrame, DataFrame]:
        """Write an epoch's rows; returns (what all before it come to, its own rows read back)."""
        spark, schema = rows.sparkSession, rows.schema
        rows.write.mode("overwrite").parquet(f"{self.path}/epoch={epoch}")
        before = self.before(spark, epoch, schema)
        if epoch and epoch % self.every == 0:
            before.select(*schema.names).write.mode("overwrite").parquet(f"{self.path}/merged={epoch}")
            self._remove(spark, epoch - self.every)
        return before, spark.read.schema(schema).parquet(f"{self.path}/epoch={epoch}")

    def _remove(self, spark: SparkSession, below: int) -> None:
        """Remove the folders of the ``every`` epochs before ``below``, which ``merged=below`` stands for."""
        jvm = spark._jvm
        old = [f"epoch={e}" for e in range(max(0, below - self.every), below)] + [f"merged={below - self.every}"]
        for name in old:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
