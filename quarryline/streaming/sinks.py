"""Sinks for ``foreachBatch`` that may be handed a batch twice.

A batch's files stand under its number, so a replay, or a second try after one of
two writes failed, replaces what the first try wrote and adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """The batches that a sink has finished."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(where):
        return []
    done = []
    for status in system.listStatus(where):
        name = status.getPath().getName()
        if name.startswith("batch=") and system.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}/_SUCCESS")):
            done.append(int(name[6:]))
    return sorted(done)


def events_and_runs(path: str, facts: dict[str, Column]) -> Callable[[DataFrame, int], None]:
    """A batch's rows to ``path/events`` and one row of ``facts`` about them to
    ``path/runs``; a batch without rows leaves a run and no events.

    The facts come from the rows as written, so both sinks tell of the same batch.
    A batch counts once its run is there: ``read_events`` leaves out the rest.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        here = f"{path}/events/batch={number}"
        batch.write.mode("overwrite").parquet(here)
        rows = spark.read.schema(batch.schema).parquet(here)
        rows.agg(*[c.alias(n) for n, c in facts.items()]).coalesce(1).write.mode("overwrite").parquet(f"{path}/runs/batch={number}")

    return write


def read_events(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Events and runs of the finished batches, each with its ``batch``."""
    done = _numbers(spark, f"{path}/runs")
    if not done:
        raise FileNotFoundError(f"no finished batch in {path}")
    read = lambda kind: spark.read.option("basePath", f"{path}/{kind}").parquet(*[f"{path}/{kind}/batch={n}" for n in done])
    return read("events"), read("runs")


def series_versions(path: str, keys: list[str], at: str, value: str, span: str | None = None) -> Callable[[DataFrame, int], None]:
    """A series that never goes back: each batch writes the version after the last one
    before it, the union of both by ``keys`` and ``at`` with the batch's value first.

    Of a batch's rows of one key and time the largest value counts.  ``span`` bounds
    a key's series to so long before its newest time.  Versions but the newest two
    may be deleted at any time.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = batch.groupBy(*keys, at).agg(F.max(value).alias(value)).withColumn("_batch", F.lit(1))
        before = [n for n in _numbers(spark, path) if n < number]
        if before:
            old = spark.read.parquet(f"{path}/batch={before[-1]}").select(*keys, at, value).withColumn("_batch", F.lit(0))
            new = old.unionByName(new)
        merged = new.groupBy(*keys, at).agg(F.max_by(value, "_batch").alias(value))
        if span:
            newest = merged.groupBy(*keys).agg(F.max(at).alias("_newest"))
            merged = merged.join(newest, keys).where(F.col(at) >= F.col("_newest") - F.expr(f"interval {span}")).drop("_newest")
        merged.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


def read_series(spark: SparkSession, path: str) -> DataFrame:
    """The newest finished version."""
    return spark.read.parquet(f"{path}/batch={_numbers(spark, path)[-1]}")
