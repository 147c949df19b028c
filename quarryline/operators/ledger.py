"""Latest rows, ledgers, revisions and series.

Every ranking ends in a unique key, so results don't depend on input order, and
reference times are parameters.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarryline.operators import runs
from quarryline.workspace import Workspace


def best_per_key(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key by ``order``."""
    return top_per_key(rows, keys, 1, *order)


def top_per_key(rows: DataFrame, keys: list[str], n: int, *order: Column, rank: str | None = None) -> DataFrame:
    """The first ``n`` rows of each key by ``order``, with their rank if it is named."""
    name = rank or "_rank"
    ranked = rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= n)
    return ranked if rank else ranked.drop(name)


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """An equi-join on ``keys`` in which nulls are equal."""
    named = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(and_, [left[k].eqNullSafe(named[f"_right_{k}"]) for k in keys])
    return left.join(named, same, how).drop(*[f"_right_{k}" for k in keys])


def flag_latest(rows: DataFrame, keys: list[str], latest: str) -> DataFrame:
    """All rows with ``is_latest`` (the largest ``latest`` of their key, which is
    unique) and the ``copies`` of their key.

    A key's facts are a map-side combined aggregate, joined back, so a key that
    many rows share is no single task.  ``rows`` is read twice.
    """
    facts = rows.groupBy(*keys).agg(F.max(latest).alias("_last"), F.count("*").alias("copies"))
    return join_on(rows, facts, keys).withColumn("is_latest", F.col(latest) == F.col("_last")).drop("_last")


def previous(rows: DataFrame, keys: list[str], at: str, value: str, width: int = 4096) -> DataFrame:
    """``rows`` with ``prior``: ``at`` and ``value`` of the row before it of its key
    (null for the first).  ``at`` is a whole number, unique within a key.

    A key is cut into buckets of ``width``; only the last row of each bucket is
    carried on, so a key of any size is many tasks.
    """
    bucketed = rows.withColumn("_bucket", F.floor(F.col(at) / width))
    within = F.lag(F.struct(at, value)).over(Window.partitionBy(*keys, "_bucket").orderBy(at))
    last = bucketed.groupBy(*keys, "_bucket").agg(F.max(F.struct(at, value)).alias("_last"))
    carried = last.withColumn("_carried", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_bucket"))).drop("_last")
    both = join_on(bucketed.withColumn("_prior", within), carried, [*keys, "_bucket"])
    return both.withColumn("prior", F.coalesce("_prior", "_carried")).drop("_bucket", "_prior", "_carried")


def slice_of(rows: DataFrame, key: str, start: int, n: int) -> DataFrame:
    """The ``n`` rows from rank ``start`` on by a unique ``key``, ranks counted from 0.

    Range partitions are counted, and only those that hold wanted ranks are
    sorted; nothing before them is gathered.
    """
    work = Workspace(rows.sparkSession, "slice")
    dealt = work.keep(rows.repartitionByRange(key).withColumn("_part", F.spark_partition_id()), "dealt")
    at, found = 0, None
    for r in dealt.groupBy("_part").count().orderBy("_part").collect():  # a row a partition
        lo, hi = max(start - at, 0), min(start + n - at, r["count"])
        if lo < hi:
            part = dealt.where(F.col("_part") == r["_part"]).orderBy(key).offset(lo).limit(hi - lo).drop("_part")
            found = part if found is None else found.unionByName(part)
        at += r["count"]
    return rows.limit(0) if found is None else found


def duplicate_rate(rows: DataFrame, key: Column, *by: str) -> DataFrame:
    """``rows``, ``duplicates`` and ``rate`` of a key, by group."""
    counted = rows.groupBy(*by, key.alias("_key")).agg(F.count("*").alias("n"))  # a map-side combined first step
    total = counted.groupBy(*by).agg(F.sum("n").alias("rows"), (F.sum("n") - F.count("*")).alias("duplicates"))
    return total.withColumn("rate", F.round(F.col("duplicates") / F.col("rows"), 4))


def append_new(ledger: DataFrame, candidates: DataFrame, identity: list[str], *order: Column) -> DataFrame:
    """The candidates to append: the first of each identity that the ledger lacks."""
    return best_per_key(candidates, identity, *order).join(ledger.select(*identity).distinct(), identity, "left_anti")


def revisions(rows: DataFrame, keys: list[str], value: str, *order: Column) -> DataFrame:
    """Rows that change their key's value, numbered, with the ``previous`` value.

    The first row of a key is revision 1.  Keys of any size are split (``runs``).
    """
    at = list(order)
    told = runs.previous_row(runs.dealt(rows, keys, at, Workspace(rows.sparkSession, "revisions")), keys, at, F.col(value), "_before")
    changed = (F.col("_before").isNull() | ~F.col("_before.v").eqNullSafe(F.col(value))).cast("int")
    told = told.withColumn("previous", F.col("_before.v")).withColumn("_changed", changed).drop("_before")
    return runs.running_sum(told, keys, at, F.col("_changed"), "revision").where("_changed = 1").drop("_changed", "_part")


def change_events(before: DataFrame, after: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys whose ``change`` is ``discovered`` or ``revised`` between two snapshots of one row a key."""
    old = before.select(*keys, F.col(value).alias("previous"), F.lit(True).alias("_known"))
    both = after.join(old, keys, "left")
    kind = F.when(F.col("_known").isNull(), "discovered").when(~F.col(value).eqNullSafe(F.col("previous")), "revised")
    return both.withColumn("change", kind).where("change is not null").drop("_known")


def new_versions(rows: DataFrame, keys: list[str], value: str, *order: Column) -> DataFrame:
    """The first row of every (key, value): a value that returns is no new version."""
    return best_per_key(rows, [*keys, value], *order)


def merge_series(old: DataFrame, new: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Both series by key; the new value wins where both have one."""
    joined = old.select(*keys, F.col(value).alias("_old")).join(new.select(*keys, F.col(value).alias("_new")), keys, "full_outer")
    return joined.select(*keys, F.coalesce("_new", "_old").alias(value))


def streaks(rows: DataFrame, keys: list[str], failed: Column, *order: Column) -> DataFrame:
    """``streak`` of consecutive failed rows up to each row (0 where it isn't failed).
    Keys of any size are split (``runs``)."""
    at = list(order)
    told = runs.dealt(rows.withColumn("_failed", failed.cast("int")), keys, at, Workspace(rows.sparkSession, "streaks"))
    island = runs.running_sum(told, keys, at, 1 - F.col("_failed"), "_island")
    return runs.running_sum(island, [*keys, "_island"], at, F.col("_failed"), "streak").drop("_failed", "_island", "_part")


def attempts(rows: DataFrame, keys: list[str], at: str, tie: str, stay: str = "120 days") -> DataFrame:
    """A work queue's memory: ``visit``, ``first_seen`` and ``attempt`` of every row.

    A key that isn't seen for longer than ``stay`` is forgotten: its next row is the
    first attempt of a new visit.  Visits and attempts are counted from 1.
    Keys of any size are split (``runs``).
    """
    order = [F.asc(at), F.asc(tie)]
    told = runs.previous_row(runs.dealt(rows, keys, order, Workspace(rows.sparkSession, "attempts")), keys, order, F.col(at), "_before")
    fresh = F.col("_before").isNull() | (F.col(at) > F.col("_before.v") + F.expr(f"interval {stay}"))
    told = runs.running_sum(told.withColumn("_fresh", fresh.cast("int")), keys, order, F.col("_fresh"), "visit")
    each = [*keys, "visit"]
    told = runs.running_sum(told, each, order, F.lit(1), "attempt")
    seen = told.groupBy(*each).agg(F.min(at).alias("first_seen"))
    return join_on(told, seen, each).drop("_before", "_fresh", "_part")


def bounded_history(rows: DataFrame, keys: list[str], value: str, most: int, *order: Column) -> DataFrame:
    """The last ``most`` changes of each key's value, with their ``revision``."""
    found = revisions(rows, keys, value, *order)
    last = found.groupBy(*keys).agg(F.max("revision").alias("_last"))
    return join_on(found, last, keys).where(F.col("revision") > F.col("_last") - most).drop("_last")


def trailing_counts(rows: DataFrame, keys: list[str], ts: str, ref: Column, days: tuple[int, ...] = (7, 30)) -> DataFrame:
    """Rows within so many days before ``ref``, by key."""
    return rows.groupBy(*keys).agg(*[F.count_if(F.col(ts) > ref - F.expr(f"interval {d} days")).alias(f"last_{d}d") for d in days])
