"""Queries that merge records: canonical customers, people by near names, claims said once."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarryline.operators import merge
from quarryline.operators.components import connected_components
from quarryline.plans.catalogue import query, table
from quarryline.workspace import Workspace

_LINKED = """c AS (SELECT *, floor(c_acctbal / 200) AS b, right(c_name, 3) AS tail FROM customer),
    k AS (SELECT c_custkey AS id, min(c_custkey) OVER (PARTITION BY c_nationkey, c_mktsegment, b) AS x, min(c_custkey) OVER (PARTITION BY c_nationkey, tail) AS y FROM c),
    e AS MATERIALIZED (SELECT id AS a, x AS b FROM k UNION SELECT x, id FROM k UNION SELECT id, y FROM k UNION SELECT y, id FROM k),
    w(id, root) AS (SELECT c_custkey, c_custkey FROM customer UNION SELECT w.id, e.b FROM w JOIN e ON e.a = w.root),
    g AS (SELECT id, min(root) AS root FROM w GROUP BY id),
    m AS (SELECT g.id, first_value(g.id) OVER (PARTITION BY root ORDER BY c_acctbal DESC, g.id) AS canonical FROM g JOIN customer ON c_custkey = g.id)"""


def _moved(spark, sf_dir, work):
    """Customers of a nation that share a segment and a balance to two hundred, or the
    end of their name, are one; the richest stands for them."""
    rows = table(spark, sf_dir, "customer")
    links = None
    for keys in ([F.col("c_nationkey"), F.col("c_mktsegment"), F.floor(F.col("c_acctbal") / 200)], [F.col("c_nationkey"), F.right("c_name", F.lit(3))]):
        keyed = rows.select("c_custkey", F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)]).alias("key"))
        least = keyed.groupBy("key").agg(F.min("c_custkey").alias("a"))
        new = keyed.join(least, "key").where("a <> c_custkey").select("a", F.col("c_custkey").alias("b"))
        links = new if links is None else links.union(new)
    return merge.canonical_map(rows, "c_custkey", links, [-F.col("c_acctbal")], work)


@query(
    f"""WITH RECURSIVE {_LINKED}, o AS (SELECT canonical, count(*) AS orders, count(*) FILTER (m.id <> canonical) AS redirected FROM orders JOIN m ON m.id = o_custkey GROUP BY canonical)
    SELECT m.canonical AS c_custkey, count(*) - 1 AS merged, any_value(r.c_acctbal) AS c_acctbal, coalesce(any_value(o.orders), 0) AS orders, coalesce(any_value(o.redirected), 0) AS redirected
    FROM m JOIN customer r ON r.c_custkey = m.canonical LEFT JOIN o ON o.canonical = m.canonical GROUP BY m.canonical"""
)
def canonical_customers(spark, sf_dir):
    """One row for each group of customers that are one, with their orders redirected to it."""
    work = Workspace(spark, "canonical")
    moved = _moved(spark, sf_dir, work)
    rows = merge.merged_rows(table(spark, sf_dir, "customer"), "c_custkey", moved, [-F.col("c_acctbal")], ["c_acctbal"])
    orders = merge.redirected(table(spark, sf_dir, "orders").select("o_custkey"), "o_custkey", moved)
    counts = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("orders"), F.count_if("redirected").alias("redirected"))
    found = rows.join(counts, "c_custkey", "left")
    return found.select("c_custkey", "merged", "c_acctbal", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("orders", "redirected")])


@query(
    """WITH RECURSIVE n AS (SELECT lang, lower(regexp_replace(left(text, 9), '[^A-Za-z]', '', 'g')) AS name, count(*) AS documents FROM documents WHERE lang IS NOT NULL GROUP BY 1, 2),
    p AS MATERIALIZED (SELECT a.lang, a.name AS a, b.name AS b FROM n a JOIN n b ON a.lang = b.lang AND a.name <> b.name AND levenshtein(a.name, b.name) <= 1 WHERE length(a.name) > 0 AND length(b.name) > 0),
    w(lang, name, root) AS (SELECT lang, name, name FROM n UNION SELECT w.lang, w.name, p.b FROM w JOIN p ON p.lang = w.lang AND p.a = w.root),
    g AS (SELECT lang, name, min(root) AS root FROM w GROUP BY lang, name)
    SELECT g.lang, arg_min(g.name, (-documents, g.name)) AS person, count(*) AS names, CAST(sum(documents) AS BIGINT) AS documents FROM g JOIN n USING (lang, name) GROUP BY g.lang, g.root"""
)
def people_by_near_names(spark, sf_dir):
    """Names that documents of a language begin with, merged where one edit leads from
    one to the next; the commonest name stands for all."""
    work = Workspace(spark, "people")
    name = F.lower(F.regexp_replace(F.left("text", F.lit(9)), "[^A-Za-z]", ""))
    names = work.keep(table(spark, sf_dir, "documents").where("lang is not null").groupBy("lang", name.alias("name")).agg(F.count("*").alias("documents")), "names")
    pairs = merge.near_names(names.where("name <> ''"), ["lang"], "name")
    links = pairs.select(F.struct("lang", F.col("a").alias("name")).alias("a"), F.struct("lang", F.col("b").alias("name")).alias("b"))
    found = connected_components(links, work)
    roots = found.select(F.col("node.lang").alias("lang"), F.col("node.name").alias("name"), F.col("root.name").alias("root"))
    own = names.join(roots, ["lang", "name"], "left").withColumn("root", F.coalesce("root", "name"))
    best = F.min_by("name", F.struct((-F.col("documents")).alias("d"), "name"))
    return own.groupBy("lang", "root").agg(best.alias("person"), F.count("*").alias("names"), F.sum("documents").alias("documents")).drop("root")


_CLAIMS_SQL = r"""l AS (SELECT conv_id, role, turn, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS place FROM conversations),
    c AS MATERIALIZED (SELECT conv_id, CAST(role = 'user' AS INTEGER) AS section, turn, place, regexp_replace(lower(line), '[^\p{L}\p{N}]+', '', 'g') AS x,
      list_distinct(list_filter(string_split(regexp_replace(lower(line), '[^\p{L}\p{N}]+', ' ', 'g'), ' '), lambda t: length(t) >= 2)) AS u,
      row_number() OVER (ORDER BY conv_id, CAST(role = 'user' AS INTEGER), turn, place) AS i FROM l),
    p AS MATERIALIZED (SELECT b.i AS l, list(a.i) AS fs, row_number() OVER (ORDER BY b.i) AS n FROM c a JOIN c b ON a.conv_id = b.conv_id AND a.i < b.i
      AND a.x <> '' AND b.x <> '' AND (a.x = b.x OR (least(length(a.x), length(b.x)) >= 24 AND (contains(a.x, b.x) OR contains(b.x, a.x)))
        OR (len(a.u) > 0 AND len(b.u) > 0 AND len(list_intersect(a.u, b.u)) / least(len(a.u), len(b.u)) >= 0.82)) GROUP BY b.i),
    w(n, dropped) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL
      SELECT p.n, CASE WHEN len(list_filter(p.fs, lambda f: NOT list_contains(w.dropped, f))) > 0 THEN list_append(w.dropped, p.l) ELSE w.dropped END FROM w JOIN p ON p.n = w.n + 1),
    g AS (SELECT unnest(dropped) AS i FROM (SELECT dropped FROM w ORDER BY n DESC LIMIT 1))"""


@query(f"WITH RECURSIVE {_CLAIMS_SQL} SELECT conv_id, turn, CAST(place AS INTEGER) AS place, g.i IS NULL AS kept FROM c LEFT JOIN g USING (i)")
def claims_across_sections(spark, sf_dir):
    """Lines of conversations, answers before questions, and whether a kept line of the
    conversation already says what a line says."""
    c = table(spark, sf_dir, "conversations")
    rows = c.select("conv_id", (F.col("role") == "user").cast("int").alias("section"), "turn", F.posexplode(F.split("text", "\n")).alias("place", "line"))
    found = merge.repeated_claims(rows, "conv_id", ["section", "turn", "place"], "line", Workspace(spark, "claims"))
    return found.select("conv_id", "turn", "place", "kept")
