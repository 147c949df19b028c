"""Passes whose result depends on an order, as rounds of joins.

Each gives what a loop over the ordered rows gives, without the loop: a round
settles every row that no open row can change any more.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from quarryline.workspace import Workspace

#: Edges of a stretch of an order that a task passes over.
STRETCH = 1 << 17


def repeats_of_taken(edges: DataFrame, work: Workspace) -> DataFrame:
    """Rows that a greedy pass drops: ``node, by`` with the first taken row like it.

    ``edges`` has ``first, later, at``: ``later`` comes after ``first`` in the order
    and is too like it; ``at`` sorts the rows ``first``.  The pass takes a row
    unless one that it took before is like it, so what it takes is the
    lexicographically first maximal independent set.  Only rows that come first on
    some edge matter for others.  A round cuts their edges into stretches of the
    order of about ``STRETCH`` edges, and a task passes over each in order and
    settles what doesn't wait for a row before its stretch.  So rounds grow with the
    stretches that a chain of waiting rows crosses, not with its rows.
    """
    edges = work.keep(edges.select("first", "later", "at").distinct(), "edges")
    place = edges.select(F.col("first").alias("later"), F.col("at").alias("place")).dropDuplicates(["later"])
    live, dropped = work.keep(edges.select("first", "later").join(place, "later"), "live"), None
    kind = StructType([StructField("node", edges.schema["first"].dataType), StructField("taken", BooleanType())])
    while (left := live.count()) > 0:
        waits = live.select(F.col("later").alias("first")).distinct().withColumn("waits", F.lit(True))
        told = live.join(waits, "first", "left").select("first", "later", "place", F.coalesce("waits", F.lit(False)).alias("waits"))
        dealt = told.repartitionByRange(math.ceil(left / STRETCH), "place", "later").sortWithinPartitions("place", "later")
        new = work.keep(dealt.select("first", "later", "waits").mapInArrow(_settled, kind), "settled")
        gone = new.where("not taken").select("node")
        dropped = gone if dropped is None else dropped.union(gone)
        live = live.join(new.select(F.col("node").alias("later")), "later", "left_anti").join(gone.withColumnRenamed("node", "first"), "first", "left_anti")
        live = work.keep(live.select("first", "later", "place"), "live")
    if dropped is None:
        return edges.groupBy(F.col("later").alias("node")).agg(F.min_by("first", "at").alias("by"))
    taken = edges.join(dropped.select(F.col("node").alias("first")), "first", "left_anti")
    return taken.groupBy(F.col("later").alias("node")).agg(F.min_by("first", "at").alias("by"))


def _settled(batches):
    """``node, taken`` of the rows ``later`` of a stretch, sorted by the order, that are
    decided: dropped after a taken row, taken if every row before them is dropped."""
    known: dict = {}  # what became of the stretch's rows
    row, key, state = None, None, True  # the last row: dropped (False), taken (True) or open (None)
    for b in batches:
        told = [b.column(i).to_pylist() for i in range(3)]
        keys = [list(map(repr, c)) for c in told[:2]] if pa.types.is_struct(b.schema.field(0).type) else told[:2]
        out: list = []
        for at, (first, later, waits) in enumerate(zip(*keys, told[2])):
            if later != key:
                if key is not None:
                    known[key] = state
                    out.append((row, state))
                row, key, state = told[1][at], later, True
            before = known.get(first) if waits else True
            state = False if before or state is False else None if before is None else state
        yield _states(out, b.schema)
    if key is not None:
        yield _states([(row, state)], b.schema)


def _states(found: list, schema: pa.Schema) -> pa.RecordBatch:
    found = [x for x in found if x[1] is not None]
    return pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], schema.field(1).type), pa.array([x[1] for x in found], pa.bool_())], ["node", "taken"])


def first_groups(edges: DataFrame, work: Workspace) -> DataFrame:
    """Greedy grouping: ``node, root`` of the nodes that join a group of another one.

    ``edges`` has ``first < later``.  In ascending order a row joins the earliest
    group that holds a row like it, or founds one; groups never merge, so this isn't
    transitive.  A row's group is the smallest node that descending paths lead to.
    Labels go along edges, and each is replaced by its own label in every round, so
    that paths shorten by doubling.
    """
    edges = work.keep(edges.where("first < later").select("first", "later").distinct(), "edges")
    labels = work.keep(edges.groupBy(F.col("later").alias("node")).agg(F.min("first").alias("root")), "labels")
    while True:
        of_first = edges.join(labels.withColumnRenamed("node", "first"), "first", "left").select(F.col("later").alias("node"), F.coalesce("root", "first").alias("root"))
        of_label = labels.join(labels.select(F.col("node").alias("root"), F.col("root").alias("next")), "root").select("node", F.col("next").alias("root"))
        now = labels.union(of_first).union(of_label).groupBy("node").agg(F.min("root").alias("root"))
        now = work.keep(now, "labels")
        if now.join(labels.withColumnRenamed("root", "before"), "node").where("root <> before").isEmpty():
            return now
        labels = now


def unique_assignment(pairs: DataFrame, left: str, right: str, order: list[Column], work: Workspace) -> DataFrame:
    """Greedy one-to-one assignment over all pairs, best pair first.

    A loop over the pairs in ``order`` (ties to the smaller ``left``, then ``right``)
    takes a pair if neither side is taken yet.  A round takes every pair that is the
    best of both its sides, which are the pairs that the loop is bound to take, and
    drops the pairs of taken sides.  A side's best pair is a map-side combined
    aggregate, so a side of any number of pairs is no single task.  Pairs with a
    null side are left out.
    """
    at = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], F.col(left).alias("l"), F.col(right).alias("r"))
    live = work.keep(pairs.where(F.col(left).isNotNull() & F.col(right).isNotNull()).select(F.col(left).alias("l"), F.col(right).alias("r"), at.alias("at")).distinct(), "pairs")
    found = live.select("l", "r").limit(0)
    while not live.isEmpty():
        of_left = live.groupBy("l").agg(F.min("at").alias("at")).select("l", F.col("at.r").alias("r"))
        of_right = live.groupBy("r").agg(F.min("at").alias("at")).select(F.col("at.l").alias("l"), "r")
        taken = work.keep(of_left.join(of_right, ["l", "r"]), "taken")
        found = found.union(taken)
        after = work.keep(live.join(taken.select("l"), "l", "left_anti").join(taken.select("r"), "r", "left_anti").select("l", "r", "at"), "pairs")
        work.drop(live)
        live = after
    return found.select(F.col("l").alias(left), F.col("r").alias(right))
