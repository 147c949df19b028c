"""Queries on feeds, sitemaps and answers that hold JSON, all made from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarryline.functions import values as vl
from quarryline.plans.catalogue import _STREAK_SQL, _streaks, query, table
from quarryline.sources import files
from quarryline.workspace import Workspace


def _escaped(c):
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


@query(
    r"""SELECT CAST(doc_id AS VARCHAR) AS external_id, 'https://example.org/' || source || '/' || doc_id AS url, '2024-01-' || lpad(CAST(1 + doc_id % 28 AS VARCHAR), 2, '0') AS published, CASE WHEN doc_id % 2 = 0 THEN 'item' ELSE 'entry' END AS kind FROM documents"""
)
def feed_items(spark, sf_dir):
    """Documents published as RSS items and as Atom entries, and read back."""
    path = Workspace(spark, "feeds").path
    docs = table(spark, sf_dir, "documents")
    url = F.concat(F.lit("https://example.org/"), "source", F.lit("/"), "doc_id")
    day = F.concat(F.lit("2024-01-"), F.lpad((1 + F.col("doc_id") % 28).cast("string"), 2, "0"))
    tag = lambda name, c: F.concat(F.lit(f"<{name}>"), c, F.lit(f"</{name}>"))
    lead = F.regexp_replace(F.left("text", F.lit(200)), r"\p{Cntrl}", " ")
    made = lambda outer, key, when, text: tag(outer, F.concat(tag("title", _escaped(F.col("source"))), tag("link", url), tag(key, F.col("doc_id").cast("string")), tag(when, day), tag(text, _escaped(lead))))
    files.write_xml(docs.where("doc_id % 2 = 0").select(made("item", "guid", "pubDate", "description")), f"{path}/rss", "rss")
    files.write_xml(docs.where("doc_id % 2 = 1").select(made("entry", "id", "updated", "summary")), f"{path}/atom", "feed")
    rss, atom = files.read_feed(spark, f"{path}/rss", "item"), files.read_feed(spark, f"{path}/atom", "entry")
    both = rss.withColumn("kind", F.lit("item")).unionByName(atom.withColumn("kind", F.lit("entry")))
    return both.select("external_id", "url", "published", "kind")


@query(
    """SELECT 'https://example.org/' || source AS loc, max('2024-01-' || lpad(CAST(1 + doc_id % 28 AS VARCHAR), 2, '0')) AS lastmod FROM documents WHERE doc_id % 10 < 8 GROUP BY source"""
)
def sitemap_urls(spark, sf_dir):
    """URLs of sources from an index of ten sitemaps, of which the first eight are read,
    each with its newest date."""
    path = Workspace(spark, "sitemaps").path
    docs = table(spark, sf_dir, "documents")
    entry = F.concat(F.lit("<url><loc> https://example.org/"), "source", F.lit("</loc><lastmod>2024-01-"), F.lpad((1 + F.col("doc_id") % 28).cast("string"), 2, "0"), F.lit("</lastmod></url>"))
    for i in range(10):
        files.write_xml(docs.where(F.col("doc_id") % 10 == i).select(entry), f"{path}/map{i}", "urlset")
    names = spark.range(10).select(F.concat(F.lit(f"<sitemap><loc>{path}/map"), F.col("id").cast("string"), F.lit("</loc></sitemap>")))
    files.write_xml(names.coalesce(1), f"{path}/index", "sitemapindex")
    return files.read_sitemap_index(spark, f"{path}/index")


@query("""SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM events""")
def repaired_answers(spark, sf_dir):
    """The number in each event's JSON, as an answer gives it: alone, fenced, or in the
    middle of talk; every eleventh is cut off."""
    rows = table(spark, sf_dir, "events")
    fenced = F.concat(F.lit("```json\n"), "props", F.lit("\n```"))
    talk = F.concat(F.lit("Here it is: "), "props", F.lit(" I hope that helps."))
    answer = F.when(F.col("event_id") % 3 == 0, F.col("props")).when(F.col("event_id") % 3 == 1, fenced).otherwise(talk)
    answer = F.when(F.col("event_id") % 11 == 0, F.regexp_replace(answer, r"\}", "")).otherwise(answer)
    return rows.select("event_id", F.from_json(vl.repaired_json(answer), "k long")["k"].alias("k"))


@query(
    _STREAK_SQL
    + """, h AS (SELECT user_id, arg_max(streak, (ts, event_id)) AS streak, count(*) FILTER (value <= 0) AS empty, date_diff('day', max(ts), (SELECT max(ts) FROM events)) AS age FROM s GROUP BY user_id)
    SELECT user_id, streak, empty, age FROM h ORDER BY streak > 0 DESC, empty DESC, age DESC, user_id LIMIT 25"""
)
def breach_order(spark, sf_dir):
    """The 25 streams to look at first: failed ones, then by empty runs, then by age."""
    rows = _streaks(spark, sf_dir)
    newest = rows.agg(F.max("ts").alias("newest"))
    facts = rows.groupBy("user_id").agg(F.max_by("streak", F.struct("ts", "event_id")).alias("streak"), F.count_if(F.expr("value <= 0")).alias("empty"), F.max("ts").alias("last"))
    aged = facts.crossJoin(F.broadcast(newest)).withColumn("age", F.date_diff(F.to_date("newest"), F.to_date("last")).cast("long"))  # one row
    return aged.orderBy(F.desc(F.col("streak") > 0), F.desc("empty"), F.desc("age"), "user_id").limit(25).select("user_id", "streak", "empty", "age")
