"""Queries on what pages and texts say: article bodies, prose, chosen lines, labelled figures."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarryline.functions import briefs, metrics
from quarryline.operators.pages import json_ld_bodies
from quarryline.plans.catalogue import query, table
from quarryline.plans.scalars import _STRIPPED
from quarryline.plans.texts import lines

_BODY = _STRIPPED.replace("html", "b")


@query(
    f"""WITH s AS (SELECT doc_id, 1 AS place, text AS b FROM documents WHERE doc_id % 7 <> 0 UNION ALL
      SELECT doc_id, 2, 'Second. ' || text FROM documents WHERE doc_id % 7 <> 0 AND doc_id % 3 = 2),
    t AS (SELECT doc_id, place, {_BODY} AS body FROM s)
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY place) AS place, sha256(body) AS sha, CAST(length(body) AS INTEGER) AS characters FROM t WHERE length(body) >= 120"""
)
def article_bodies(spark, sf_dir):
    """Bodies from the structured data of pages that are made of the documents: alone,
    in a graph, and in nested arrays and graphs; every seventh page's is cut off.  Places
    count the bodies that are long enough."""
    docs = table(spark, sf_dir, "documents")
    body = F.to_json(F.struct(F.col("text").alias("articleBody")))
    second = F.to_json(F.struct(F.concat(F.lit("Second. "), "text").alias("articleBody")))
    alone = F.concat(F.lit('{"@type":"NewsArticle",'), F.substring(body, 2, 1 << 30))
    graph = F.concat(F.lit('{"@context":"https://schema.org","@graph":[{"@type":"WebPage","articleBody":7},'), body, F.lit(',[{"articleBody":"too short"},null]]}'))
    nested = F.concat(F.lit('[[{"@graph":[["x",'), body, F.lit("],5,null]}],"), second, F.lit("]"))
    made = F.when(F.col("doc_id") % 3 == 0, alone).when(F.col("doc_id") % 3 == 1, graph).otherwise(nested)
    made = F.when(F.col("doc_id") % 7 == 0, F.substring(made, F.lit(1), F.length(made) - 1)).otherwise(made)
    pages = docs.select("doc_id", F.concat(F.lit('<html><head><script defer type="application/ld+json">'), made, F.lit("</script></head></html>")).alias("html"))
    found = json_ld_bodies(pages, "doc_id", "html")
    return found.select("doc_id", "place", F.sha2("body", 256).alias("sha"), F.length("body").alias("characters"))


@query()
def prose_paragraphs(spark, sf_dir):
    """The prose paragraphs of every page, without those that nearly repeat an earlier one."""
    raw = F.regexp_extract_all("html", F.lit(r"(?is)<(p|li|h2|h3)\b[^>]*>(.*?)</\1>"), F.lit(2))
    found = table(spark, sf_dir, "pages").select("page_id", briefs.paragraphs(raw).alias("p"))
    return found.select("page_id", F.size("p").alias("paragraphs"), F.sha2(F.array_join("p", "\n"), 256).alias("sha"))


@query()
def brief_lines(spark, sf_dir):
    """Three lines at most of every document, of different roles and figures, none too
    like another or the first line."""
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", briefs.candidates(F.col("text"), F.element_at(F.split("text", "\n"), 1)).alias("c"))
    chosen = found.select("doc_id", F.posexplode(briefs.pick(F.col("c"))).alias("i", "l"))
    return chosen.select("doc_id", (F.col("i") + 1).alias("place"), "l.role", "l.line")


@query()
def reselected_briefs(spark, sf_dir):
    """Briefs whose lines an older rule chose, by their source's rule, chosen anew; those
    with fewer than two lines are hidden."""
    first = F.element_at(F.split("text", "\n"), 1)
    version = F.regexp_extract("source", "([0-9])$", 1).try_cast("int") % 4
    docs = table(spark, sf_dir, "documents").withColumn("version", version)
    found = docs.select("doc_id", briefs.reselected(F.col("text"), first, F.array(first), F.col("version"), 3, 2).alias("r")).select("doc_id", "r.*")
    return found.select("doc_id", F.size("lines").alias("lines"), F.sha2(F.array_join("lines", "\n"), 256).alias("sha"), "version", "changed", "hidden")


@query()
def unique_claims(spark, sf_dir):
    """The long lines of every document, each claim once, in their order."""
    # a generator's output is computed once, for the filter, the count and the hash
    found = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.array(briefs.unique_claims(lines(F.col("text"), 40)))).alias("c"))
    return found.select("doc_id", F.size("c").alias("claims"), F.sha2(F.array_join("c", "\n"), 256).alias("sha")).where("claims > 0")


@query(
    """WITH t AS (SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS s, sum(CAST(l_quantity AS DECIMAL(18,2))) AS u, max(CAST(l_discount AS DECIMAL(18,2))) AS d FROM lineitem GROUP BY ALL)
    SELECT l_suppkey, year, 'USD ' || CAST(CAST(floor(s) AS BIGINT) AS VARCHAR) || ' million' AS value, '매출 · ' || (year + 30) AS label FROM t
    UNION ALL SELECT l_suppkey, year, CAST(CAST(floor(d * 100) AS BIGINT) AS VARCHAR) || '%', '영업이익률 · ' || (year + 31) FROM t
    UNION ALL SELECT l_suppkey, year, CAST(year + 30 AS VARCHAR), '기준 연도' FROM t
    UNION ALL SELECT l_suppkey, year, CAST(year + 31 AS VARCHAR), '전망 연도' FROM t
    UNION ALL SELECT l_suppkey, year, CAST(CAST(floor(u * 100) AS BIGINT) AS VARCHAR) || ' units', '출하량' FROM t"""
)
def labelled_figures(spark, sf_dir):
    """What the figures measure that a sentence about each supplier's year tells."""
    items = table(spark, sf_dir, "lineitem").select("l_suppkey", F.year("l_shipdate").alias("year"), "l_quantity", "l_extendedprice", "l_discount")
    cents = lambda c: F.sum(F.col(c).cast("decimal(18,2)"))
    told = items.groupBy("l_suppkey", "year").agg(cents("l_extendedprice").alias("sales"), cents("l_quantity").alias("units"), F.max(F.col("l_discount").cast("decimal(18,2)")).alias("most"))
    # years of the data are those of the last century, so they are moved by thirty
    money, share, first, last = F.format_string("USD %s million", F.floor("sales").cast("string")), F.format_string("%s%%", F.floor(F.col("most") * 100).cast("string")), (F.col("year") + 30).cast("string"), (F.col("year") + 31).cast("string")
    shipped = F.floor(F.col("units") * 100).cast("string")  # in hundredths, which look like no year; the line is the longer one, so a year's digits in it don't count
    line = F.concat(F.lit("The supplier's revenue reached "), money, F.lit(" in "), first, F.lit(", while an operating margin of "), share, F.lit(" is projected by "), last, F.lit("."))
    other = F.concat(F.lit("It shipped "), shipped, F.lit(" units to customers of all kinds, in all of its regions and through every one of its channels, which is more than it could have made by hand in so short a time, and less than some had hoped for when it began."))
    values = F.array(money, share, first, last, F.concat(shipped, F.lit(" units")))
    rows = told.select("l_suppkey", "year", F.explode(metrics.labelled(F.array(line, other), values)).alias("m"))
    return rows.select("l_suppkey", "year", "m.value", "m.label")
