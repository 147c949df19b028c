"""The four track streams: companies, market and survey records, value chain, source surveys."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarryline.functions import text as tx
from quarryline.operators import ledger
from quarryline.plans.catalogue import query, table
from quarryline.workspace import Workspace

#: Parameters of the streams: segments that are suppressed, those that name a layer, and the categories that a chain takes.
SUPPRESSED, LAYERS, CATEGORIES = ["HOUSEHOLD"], ["MACHINERY", "FURNITURE"], ["ECONOMY", "PROMO"]
SITE = "https://example.org"

_quoted = lambda names: ", ".join(f"'{n}'" for n in names)
_SLUG = r"trim(regexp_replace(lower({c}), '[^a-z0-9]+', '-', 'g'), '-')"
_TRACKS_SQL = f"""WITH newest AS (SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey, CAST(max(o_orderdate) AS DATE) AS day, CAST(arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS DOUBLE) AS total FROM orders GROUP BY 1),
    shipped AS (SELECT o_custkey, arg_max(p_type, (l_shipdate, l_orderkey, l_linenumber, l_partkey)) AS category, arg_max(l_orderkey, (l_shipdate, l_orderkey, l_linenumber, l_partkey)) AS l_orderkey, CAST(max(l_shipdate) AS DATE) AS day
      FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey GROUP BY 1),
    company AS (SELECT 'company' AS track, c_custkey, c_name, c_mktsegment, 'company:' || {_SLUG.format(c="c_name")} AS stable_key,
      CASE WHEN total >= 1000 THEN '{SITE}/orders/' || o_orderkey WHEN c_acctbal >= 0 THEN '{SITE}/customers/' || c_custkey ELSE '' END AS url,
      CASE WHEN total >= 1000 THEN 'Order' WHEN c_acctbal >= 0 THEN 'Company source' ELSE '' END AS source, day AS published
      FROM customer LEFT JOIN newest ON o_custkey = c_custkey WHERE c_mktsegment NOT IN ({_quoted(SUPPRESSED)})),
    chain AS (SELECT 'value-chain' AS track, 'value-chain:' || {_SLUG.format(c="c_name")} AS stable_key, coalesce('{SITE}/orders/' || l_orderkey, url) AS url, CASE WHEN l_orderkey IS NULL THEN source ELSE 'Shipment' END AS source, coalesce(s.day, published) AS published
      FROM company LEFT JOIN shipped s ON o_custkey = c_custkey WHERE c_mktsegment IN ({_quoted(LAYERS)}) OR category IN ({_quoted(CATEGORIES)})),
    records AS (SELECT CASE WHEN d.doc_id % 4 = 0 THEN 'consumer-survey' ELSE 'market' END AS track, CASE WHEN d.doc_id % 4 = 0 THEN 'survey:' ELSE 'market:' END || sha256(coalesce(text, ''))[1:16] AS stable_key,
      '{SITE}/' || source || '/' || d.doc_id AS url, coalesce(source, '') AS source, NULL::DATE AS published, coalesce(quality, 0) = 1 AND source IS NOT NULL AS backed, d.doc_id AS seen
      FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE coalesce(toxic, 0) = 0),
    surveys AS (SELECT 'consumer-survey' AS track, 'survey:' || sha256(regexp_replace(url, '[?#].*$', ''))[1:16] AS stable_key, url, 'page' AS source, NULL::DATE AS published, true AS backed, page_id AS seen FROM pages WHERE url LIKE 'http%'),
    every AS (SELECT track, stable_key, url, source, published, url <> '' AS backed, c_custkey AS seen FROM company UNION ALL SELECT track, stable_key, url, source, published, url <> '', 0 FROM chain
      UNION ALL SELECT track, stable_key, coalesce(url, ''), source, published, backed, seen FROM records UNION ALL SELECT * FROM surveys)
    SELECT track, stable_key, url, source, published, CASE WHEN backed THEN 'source-backed' ELSE 'reference-only' END AS status FROM every
    QUALIFY row_number() OVER (PARTITION BY track, stable_key ORDER BY 2 * CAST(backed AS INTEGER) + CAST(published IS NOT NULL AS INTEGER) DESC, seen DESC, url, source, published) = 1"""


@query(_TRACKS_SQL)
def track_candidates(spark, sf_dir):
    """The best row of each track and stable key: companies with the evidence of their
    newest order or else their own page, records and surveys that aren't suppressed, the
    value chain by layer or by the category of the last shipment, and surveyed pages.
    What a source backs comes first, then what has a date, then what was seen last.  Of
    lines of one order, number and date the one of the largest part is the last."""
    work = Workspace(spark, "tracks")
    orders, items = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    newest = orders.groupBy("o_custkey").agg(F.max_by(F.struct("o_orderkey", F.col("o_totalprice").alias("total"), F.to_date("o_orderdate").alias("day")), F.struct("o_orderdate", "o_orderkey")).alias("o")).select("o_custkey", "o.*")
    lines = items.join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    last = lines.groupBy("o_custkey").agg(F.max_by(F.struct("l_orderkey", "l_partkey", F.to_date("l_shipdate").alias("shipped")), F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey")).alias("s")).select("o_custkey", "s.*")
    shipped = last.join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("category")), "l_partkey")

    def address(kind, key):
        return F.concat(F.lit(f"{SITE}/{kind}/"), F.col(key).cast("string"))

    slug = F.trim(F.regexp_replace(F.lower("c_name"), "[^a-z0-9]+", "-"), F.lit("-"))
    ordered, own = F.col("total") >= 1000, F.col("c_acctbal") >= 0
    customers = table(spark, sf_dir, "customer").where(~F.col("c_mktsegment").isin(SUPPRESSED))
    company = customers.join(newest.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", "left").select(
        "c_custkey", "c_mktsegment", slug.alias("slug"), F.col("day").alias("published"),
        F.when(ordered, address("orders", "o_orderkey")).when(own, address("customers", "c_custkey")).otherwise("").alias("url"),
        F.when(ordered, "Order").when(own, "Company source").otherwise("").alias("source"),
    )
    company = work.keep(company, "company")
    both = company.join(shipped.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", "left").where(F.col("c_mktsegment").isin(LAYERS) | F.col("category").isin(CATEGORIES))

    def stream(rows, track, key, url, source, published, backed, seen):
        return rows.select(track.alias("track"), key.alias("stable_key"), url.alias("url"), source.alias("source"), published.alias("published"), backed.alias("backed"), seen.cast("long").alias("seen"))

    col, none = F.col, F.lit(None).cast("date")
    companies = stream(company, F.lit("company"), F.concat(F.lit("company:"), "slug"), col("url"), col("source"), col("published"), col("url") != "", col("c_custkey"))
    at = F.when(col("l_orderkey").isNotNull(), address("orders", "l_orderkey")).otherwise(col("url"))
    chain = stream(both, F.lit("value-chain"), F.concat(F.lit("value-chain:"), "slug"), at, F.when(col("l_orderkey").isNotNull(), "Shipment").otherwise(col("source")), F.coalesce("shipped", "published"), at != "", F.lit(0))
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.substring(F.sha2(F.coalesce("text", F.lit("")), 256), 1, 16).alias("key")).join(labels, "doc_id", "left").where(F.coalesce("toxic", F.lit(0)) == 0)
    survey = col("doc_id") % 4 == 0
    place = F.concat(F.lit(f"{SITE}/"), "source", F.lit("/"), col("doc_id").cast("string"))
    records = stream(
        docs, F.when(survey, "consumer-survey").otherwise("market"), F.concat(F.when(survey, "survey:").otherwise("market:"), "key"), F.coalesce(place, F.lit("")), F.coalesce("source", F.lit("")), none,
        (F.coalesce("quality", F.lit(0)) == 1) & col("source").isNotNull(), col("doc_id"),
    )
    pages = table(spark, sf_dir, "pages").select("page_id", "url").where("url like 'http%'")
    asked = stream(pages, F.lit("consumer-survey"), F.concat(F.lit("survey:"), tx.short_hash(16, F.regexp_replace("url", "[?#].*$", ""))), col("url"), F.lit("page"), none, F.lit(True), col("page_id"))
    every = companies.unionByName(chain).unionByName(records).unionByName(asked)
    rank = F.struct((2 * col("backed").cast("int") + col("published").isNotNull().cast("int")).alias("r"), "seen")
    # the best of a key by a combined aggregate; of equal ranks the smaller URL, source and date
    best = every.groupBy("track", "stable_key").agg(F.max(rank).alias("best"))
    top = ledger.join_on(every.withColumn("rank", rank), best, ["track", "stable_key"]).where(col("rank") == col("best"))
    found = top.groupBy("track", "stable_key").agg(F.min(F.struct("url", "source", "published", "backed")).alias("x")).select("track", "stable_key", "x.*")
    return found.select("track", "stable_key", "url", "source", "published", F.when(col("backed"), "source-backed").otherwise("reference-only").alias("status"))
