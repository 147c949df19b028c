"""Running values within a key, in order, whatever the number of its rows.

Rows are dealt out by ranges of key and order, so a large key takes several
parts.  A window runs within a part and key only, and what a key's earlier parts
add comes from one row for each part and key.  Only the first key of a part can
have earlier parts, so what is carried over has at most one row a part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarryline.workspace import Workspace


def dealt(rows: DataFrame, keys: list[str], order: list[Column], work: Workspace) -> DataFrame:
    """``rows`` with the ``_part`` of the range that they lie in.  ``order`` is
    ascending and unique within a key; a null key is a key."""
    return work.keep(rows.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id()), "dealt")


def _within(keys: list[str], order: list[Column]):
    return Window.partitionBy("_part", *keys).orderBy(*order)


def _carry(rows: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    from quarryline.operators.ledger import join_on

    return join_on(rows, F.broadcast(facts.where("_carried is not null").select("_part", *keys, "_carried")), ["_part", *keys], "left")


def running_sum(rows: DataFrame, keys: list[str], order: list[Column], amount: Column, name: str) -> DataFrame:
    """Adds the sum of a whole number over the key's rows up to each row."""
    inner = rows.withColumn(name, F.sum(amount).over(_within(keys, order).rowsBetween(Window.unboundedPreceding, 0)))
    totals = rows.groupBy("_part", *keys).agg(F.sum(amount).alias("_total"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    both = _carry(inner, totals.withColumn("_carried", F.sum("_total").over(before)), keys)
    return both.withColumn(name, F.col(name) + F.coalesce("_carried", F.lit(0))).drop("_carried")


def previous_row(rows: DataFrame, keys: list[str], order: list[Column], value: Column, name: str) -> DataFrame:
    """Adds ``value`` of the key's row before each row, as a struct with one field
    ``v``; the struct is null for a key's first row."""
    at = _within(keys, order)
    inner = rows.withColumn(name, F.lag(F.struct(value.alias("v"))).over(at))
    ends = rows.select("_part", *keys, F.struct(value.alias("v")).alias("_v"), F.row_number().over(at).alias("_n"))
    last = ends.groupBy("_part", *keys).agg(F.max_by("_v", "_n").alias("_last"))
    both = _carry(inner, last.withColumn("_carried", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_part"))), keys)
    return both.withColumn(name, F.coalesce(name, "_carried")).drop("_carried")


def last_value(rows: DataFrame, keys: list[str], order: list[Column], value: Column, name: str) -> DataFrame:
    """Adds the key's last ``value`` that isn't null, up to each row."""
    at = _within(keys, order)
    inner = rows.withColumn(name, F.last(value, ignorenulls=True).over(at.rowsBetween(Window.unboundedPreceding, 0)))
    ends = rows.select("_part", *keys, value.alias("_v"), F.row_number().over(at).alias("_n"))
    last = ends.groupBy("_part", *keys).agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col("_n"))).alias("_last"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    both = _carry(inner, last.withColumn("_carried", F.last("_last", ignorenulls=True).over(before)), keys)
    return both.withColumn(name, F.coalesce(name, "_carried")).drop("_carried")
