"""Records that are one: canonical rows, redirected references, near names, claims said once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.functions import briefs
from quarryline.functions import text as tx
from quarryline.operators.components import connected_components
from quarryline.operators.ordered import repeats_of_taken
from quarryline.workspace import Workspace


def canonical_map(rows: DataFrame, row_id: str, links: DataFrame, order: list[Column], work: Workspace) -> DataFrame:
    """``id, canonical`` of every row that another row stands for.

    Rows that ``links`` (``a, b``) connect are one; the first of them by ``order``
    (ties to the smaller id) stands for all.  Ends of links that are no rows are
    passed over.
    """
    found = connected_components(links, work)
    members = found.union(found.select("root", "root").distinct()).toDF("id", "root")
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], F.col(row_id).alias("id"))
    ranked = work.keep(members.join(rows.select(F.col(row_id).alias("id"), rank.alias("rank")), "id"), "members")
    best = ranked.groupBy("root").agg(F.min("rank")["id"].alias("canonical"))
    return work.keep(ranked.join(best, "root").where("id <> canonical").select("id", "canonical"), "moved")


def redirected(rows: DataFrame, key: str, moved: DataFrame) -> DataFrame:
    """``rows`` with ``key`` replaced by the canonical one, and whether it was
    (``redirected``).  ``moved`` has one row an id, so a key of many rows is a join
    that AQE may split.  Done twice, it changes nothing more."""
    both = rows.join(moved.withColumnsRenamed({"id": "_moved", "canonical": "_canonical"}), F.col(key) == F.col("_moved"), "left")
    return both.withColumn("redirected", F.col("_canonical").isNotNull()).withColumn(key, F.coalesce("_canonical", key)).drop("_moved", "_canonical")


def merged_rows(rows: DataFrame, row_id: str, moved: DataFrame, order: list[Column], fields: list[str]) -> DataFrame:
    """One row for each canonical id: each field's first value by ``order`` that isn't
    null, and how many rows were ``merged`` into it."""
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], F.col(row_id).alias("id"))
    ranked = redirected(rows.withColumn("_rank", rank), row_id, moved)
    first = [F.min_by(f, F.when(F.col(f).isNotNull(), F.col("_rank"))).alias(f) for f in fields]
    return ranked.groupBy(row_id).agg(*first, (F.count("*") - 1).alias("merged"))


def near_names(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``keys, a, b``: pairs of distinct names of a key that are one edit apart (a < b).

    Names within one edit have a variant in common, the name or the name without
    one of its characters, so they meet by an equi-join and no key's names are
    paired up.  A variant has as many names as one character more can make.
    """
    names = rows.where(F.col(name).isNotNull()).select(*keys, F.col(name).alias("name")).distinct()
    cut = F.transform(F.sequence(F.lit(1), F.length("name")), lambda i: F.concat(F.substr("name", F.lit(1), i - 1), F.substr("name", i + 1)))
    variants = F.array_distinct(F.concat(F.array("name"), F.when(F.length("name") > 0, cut).otherwise(F.array().cast("array<string>"))))
    each = names.select(*keys, "name", F.explode(variants).alias("variant"))
    met = each.withColumnRenamed("name", "a").join(each.withColumnRenamed("name", "b"), [*keys, "variant"]).where("a < b")
    return met.select(*keys, "a", "b").distinct().where(F.levenshtein("a", "b") <= 1)


def repeated_claims(claims: DataFrame, entity: str, order: list[str], text: str, work: Workspace, least: float = 0.82, window: int = 24, few: int = 128) -> DataFrame:
    """``claims`` with ``kept``: whether a claim is the first of its kind of its entity.

    In ``order`` (unique within an entity) a claim is kept unless a kept one has the
    same letters and digits, holds it or is held by it (from ``window`` characters
    on), or shares ``least`` of the smaller one's words of two letters and more.
    Claims without letters and digits, or of no entity, are kept.  An entity of at
    most ``few`` claims is folded as one row, to which its claims are shuffled once;
    larger ones are no single task's, and their claims meet in joins.
    """
    named = claims.where(F.col(entity).isNotNull())
    sizes = named.groupBy(F.col(entity).alias("_large")).agg(F.count("*").alias("n"))
    large = work.keep(sizes.where(F.col("n") > few).select("_large"), "large")
    none = claims.where(F.col(entity).isNull()).withColumn("kept", F.lit(True))
    if large.isEmpty():
        return _folded_claims(named, entity, order, text, least, window).union(none)
    small = _folded_claims(named.join(large, F.col(entity) == F.col("_large"), "left_anti"), entity, order, text, least, window)
    met = _met_claims(named.join(large, F.col(entity) == F.col("_large"), "left_semi"), entity, order, text, work, least, window)
    return small.union(met.select(*small.columns)).union(none)


def _folded_claims(claims: DataFrame, entity: str, order: list[str], text: str, least: float, window: int) -> DataFrame:
    """Entities with their claims in order, each compared with those kept before it."""
    row = F.struct(F.struct(*order).alias("order"), F.struct(*claims.columns).alias("row"))
    every = claims.groupBy(F.col(entity).alias("_entity")).agg(F.array_sort(F.collect_list(row)).alias("every"))
    told = F.transform("every", lambda c: briefs.claim(c["order"], c["row"][text]))
    taken = briefs.unique_in_order(told, lambda a, b: briefs.same_claim(a, b, least, window))
    found = every.select("every", F.transform(taken, lambda t: t["item"]).alias("taken"))
    kept = found.select(F.explode("every").alias("c"), "taken")
    return kept.select("c.row.*", F.array_contains("taken", F.col("c.order")).alias("kept"))


def _met_claims(claims: DataFrame, entity: str, order: list[str], text: str, work: Workspace, least: float, window: int) -> DataFrame:
    """Claims that may hold each other meet in the first ``window`` characters of the
    shorter one, the others in one of its rarest words, both as hashes; all that meet
    are checked."""
    node = F.struct(F.col(entity).alias("entity"), *order)
    told = claims.withColumn("_node", node).withColumn("_key", tx.claim_key(F.col(text))).withColumn("_words", F.filter(briefs.words(tx.clean(F.col(text))), lambda w: F.length(w) >= 2))
    told = work.keep(told, "claims")
    # equal letters within an entity are one candidate, the first
    units = told.where("_key <> ''").groupBy(F.col("_node.entity").alias("entity"), F.col("_key").alias("key")).agg(F.min("_node").alias("node"), F.min_by("_words", "_node").alias("words"))
    units = work.keep(units, "units")
    starts = F.transform(F.sequence(F.lit(1), F.length("key") - window + 1), lambda i: F.xxhash64(F.substr("key", i, F.lit(window))))
    long = units.where(F.length("key") >= window)
    windows = long.select("entity", F.col("node").alias("x"), F.explode(F.array_distinct(starts)).alias("at"))
    opening = long.select("entity", F.col("node").alias("y"), F.xxhash64(F.substr("key", F.lit(1), F.lit(window))).alias("at"))
    held = windows.join(opening, ["entity", "at"]).where("x <> y").select("x", "y")
    each = units.select("entity", "node", F.size("words").alias("n"), F.explode(F.transform("words", lambda w: F.xxhash64(w))).alias("word"))
    counts = each.groupBy("entity", "word").agg(F.count("*").alias("times"))
    ranked = each.join(counts, ["entity", "word"]).groupBy("entity", "node", "n").agg(F.array_sort(F.collect_list(F.struct("times", "word"))).alias("w"))
    rare = ranked.select("entity", F.col("node").alias("y"), F.explode(F.slice("w", F.lit(1), F.greatest(F.lit(1), F.col("n") - F.ceil(F.col("n") * least).cast("int") + 1))).alias("w")).select("entity", "y", F.col("w.word").alias("word"))
    shared = each.select("entity", F.col("node").alias("x"), "word").join(rare, ["entity", "word"]).where("x <> y").select("x", "y")
    met = held.union(shared).select(F.least("x", "y").alias("first"), F.greatest("x", "y").alias("later")).distinct()
    facts = lambda side, n: units.select(F.col("node").alias(side), F.col("key").alias(f"key_{n}"), F.col("words").alias(f"words_{n}"))
    both = met.join(facts("first", 1), "first").join(facts("later", 2), "later")
    contains = (F.least(F.length("key_1"), F.length("key_2")) >= window) & (F.contains("key_1", F.col("key_2")) | F.contains("key_2", F.col("key_1")))
    edges = both.where(contains | (tx.overlap(F.col("words_1"), F.col("words_2")) >= least)).select("first", "later", F.col("first").alias("at"))
    dropped = repeats_of_taken(edges, work).select(F.col("node").alias("_node"), F.lit(True).alias("_dropped"))
    copies = told.join(units.select(F.col("node").alias("_node"), F.lit(True).alias("_unit")), "_node", "left").join(dropped, "_node", "left")
    kept = (F.col("_key") == "") | (F.col("_unit").isNotNull() & F.col("_dropped").isNull())
    return copies.withColumn("kept", kept).drop("_node", "_key", "_words", "_unit", "_dropped")
