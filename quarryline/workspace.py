"""Shared scratch tables for multi-step jobs.

Intermediate results go to Parquet under ``spark.checkpoint.dir``, the one
folder that the driver and every executor share.  A table there cuts lineage,
survives the loss of executors, and gives the next step real statistics.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_own_roots: dict[str, str] = {}  # of local sessions that set no folder
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_root(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``.  Where it is unset, a local
    session takes a temporary folder and a cluster its warehouse."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if context.master == "local" or context.master.startswith("local["):
        if context.applicationId not in _own_roots:
            _own_roots[context.applicationId] = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        return _own_roots[context.applicationId]
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def modest_batches(spark: SparkSession, rows: int = 512) -> None:
    """Hands whole texts to Python a few at a time, unless the session says how
    many.  Batches count rows and texts may be long, so the default of ten
    thousand would make memory follow the texts."""
    if spark.conf.get(_BATCH, None) is None or spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(rows))


class Workspace:
    """Writes and rereads the scratch tables of one job."""

    def __init__(self, spark: SparkSession, job: str):
        self.spark = spark
        self.path = f"{shared_root(spark)}/quarryline/{job}-{uuid.uuid4().hex}"
        self._paths: dict[int, str] = {}

    def keep(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        """Write ``df`` and return it as read back.  Its shuffle files go as soon
        as it is written, since nothing needs them any more."""
        path = f"{self.path}/{name}-{uuid.uuid4().hex[:8]}"
        before = self.spark.conf.get(_CLEANUP, "false")
        self.spark.conf.set(_CLEANUP, "true")
        try:
            df.write.options(**{"compression": "zstd", **options}).parquet(path)
        finally:
            self.spark.conf.set(_CLEANUP, before)
        back = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(back)] = path
        return back

    def drop(self, df: DataFrame) -> None:
        """Delete a table that ``keep`` returned and nothing reads any more."""
        path = self._paths.pop(id(df), None)
        if path:
            jvm = self.spark._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)
