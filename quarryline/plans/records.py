"""Registered queries on records: boards, registries, queues, upserts, manifests."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarryline.functions import text as tx
from quarryline.functions import url as ur
from quarryline.functions import values as vl
from quarryline.operators import ledger
from quarryline.plans.catalogue import _HOST, money, query, table

# --- entities and registries -----------------------------------------------------

_ROOT = r"""array_to_string(list_filter(string_split(regexp_replace(replace(lower(trim(regexp_replace({c}, '\s+', ' ', 'g'))), '&', ' and '), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' '), lambda w: w <> '' AND NOT list_contains([""" + ", ".join(f"'{w}'" for w in tx.LEGAL_WORDS) + "], w)), '')"
_NAMES = "concat(split_part(p_name, ' ', 2), CASE p_size % 5 WHEN 0 THEN ' Inc' WHEN 1 THEN ' Labs, LLC' WHEN 2 THEN ' & Co' WHEN 3 THEN ' Cloud' ELSE '' END)"


@query(
    f"""WITH n AS (SELECT p_partkey, {_ROOT.format(c=_NAMES)} AS root FROM part), e AS (SELECT *, regexp_replace(root, '(cloud|deepmind|labs|notebook|research|studio|systems|technologies)$', '') AS stem FROM n)
    SELECT CASE WHEN length(stem) >= 5 THEN stem ELSE root END AS entity, count(*) AS records, count(DISTINCT root) AS names, min(p_partkey) AS first FROM e GROUP BY 1"""
)
def entity_groups(spark, sf_dir):
    """Records of one organisation: equal names without legal words, or a name and a
    brand extension of it.  One row a group, so none is listed pair by pair."""
    kind = F.col("p_size") % 5
    name = F.concat(F.element_at(F.split("p_name", " "), 2), F.when(kind == 0, " Inc").when(kind == 1, " Labs, LLC").when(kind == 2, " & Co").when(kind == 3, " Cloud").otherwise(""))
    n = table(spark, sf_dir, "part").select("p_partkey", tx.organization_root(name).alias("root"))
    stem = F.regexp_replace("root", "(" + "|".join(tx.BRAND_EXTENSIONS) + ")$", "")
    entity = F.when(F.length(stem) >= 5, stem).otherwise(F.col("root"))
    return n.groupBy(entity.alias("entity")).agg(F.count("*").alias("records"), F.count_distinct("root").alias("names"), F.min("p_partkey").alias("first"))


@query(f"SELECT {_HOST} AS host, count(*) AS pages, arg_max(page_id, (length(html), -page_id)) AS richest, max(length(html)) AS size FROM pages GROUP BY 1")
def richest_per_domain(spark, sf_dir):
    """One record a host: that with most content, and how many there were."""
    size = F.length("html")
    pages = table(spark, sf_dir, "pages").select("page_id", ur.host(F.col("url")).alias("host"), size.cast("long").alias("size"))
    return pages.groupBy("host").agg(F.count("*").alias("pages"), F.max_by("page_id", F.struct("size", -F.col("page_id"))).alias("richest"), F.max("size").alias("size"))


_LANG = "regexp_extract(html, '<html lang=\"([a-z]+)\"', 1)"


@query(f"""SELECT host, min_by(lang, CASE lang WHEN 'en' THEN 0 WHEN 'de' THEN 1 WHEN 'fr' THEN 2 ELSE 3 END) AS section, count(*) AS pages, count(DISTINCT lang) AS sections FROM (SELECT {_HOST} AS host, {_LANG} AS lang FROM pages) GROUP BY host""")
def claimed_once(spark, sf_dir):
    """Each host belongs to the first section, in their order, that has it."""
    lang = F.regexp_extract("html", '<html lang="([a-z]+)"', 1)
    order = F.when(F.col("lang") == "en", 0).when(F.col("lang") == "de", 1).when(F.col("lang") == "fr", 2).otherwise(3)
    pages = table(spark, sf_dir, "pages").select(ur.host(F.col("url")).alias("host"), lang.alias("lang"))
    return pages.groupBy("host").agg(F.min_by("lang", order).alias("section"), F.count("*").alias("pages"), F.count_distinct("lang").alias("sections"))


OWNERS = [("editorial", r"/(en|de)/"), ("partners", r"[?&]ref="), ("archive", r"[0-9]{3}")]


@query("SELECT CASE " + " ".join(f"WHEN regexp_matches(url, '{p}') THEN '{o}'" for o, p in OWNERS) + " ELSE 'nobody' END AS owner, count(*) AS pages FROM pages GROUP BY 1")
def owner_groups(spark, sf_dir):
    """Pages by the first owner whose pattern their URL has."""
    return table(spark, sf_dir, "pages").groupBy(vl.first_match(F.col("url"), OWNERS, "nobody").alias("owner")).agg(F.count("*").alias("pages"))


@query(
    """SELECT user_id, arg_max(value, (ts, event_id)) FILTER (event_type = 'click') AS click, arg_max(value, (ts, event_id)) FILTER (event_type = 'purchase') AS purchase,
    arg_max(value, (ts, event_id)) FILTER (event_type = 'view' AND value >= 50) AS view, max(event_id) AS newest FROM events GROUP BY user_id"""
)
def fieldwise_upsert(spark, sf_dir):
    """Per user the last present value of each field; fields are told apart one by one."""
    at = F.struct("ts", "event_id")

    def last(kind, keep=None):
        here = F.col("event_type") == kind
        return F.max_by(F.when(here if keep is None else here & keep, F.col("value")), F.when(here if keep is None else here & keep, at))

    events = table(spark, sf_dir, "events")
    return events.groupBy("user_id").agg(last("click").alias("click"), last("purchase").alias("purchase"), last("view", F.col("value") >= 50).alias("view"), F.max("event_id").alias("newest"))


@query(
    """WITH b AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-25')
    SELECT event_id, user_id, 'old' AS ledger FROM events WHERE event_type <> 'error' AND user_id NOT IN (SELECT user_id FROM b)
    UNION ALL SELECT event_id, user_id, 'new' FROM events WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-25'"""
)
def replaced_by_key(spark, sf_dir):
    """A ledger in which a batch replaces all rows of the keys that it brings."""
    events = table(spark, sf_dir, "events")
    batch = events.where((F.col("event_type") == "error") & (F.col("ts") >= F.lit("2024-01-25").cast("timestamp_ntz"))).select("event_id", "user_id")
    old = events.where("event_type <> 'error'").join(batch.select("user_id").distinct(), "user_id", "left_anti").select("event_id", "user_id", F.lit("old").alias("ledger"))
    return old.unionByName(batch.withColumn("ledger", F.lit("new")))


@query(f"SELECT {_HOST} AS host, regexp_replace(regexp_replace(url, '^[^:]+://[^/]+', ''), '[?#].*$', '') AS path, max(page_id) AS page_id, count(*) AS times FROM pages GROUP BY ALL")
def suppression_registry(spark, sf_dir):
    """Suppressed pages by host and path; the newest entry of an identity stays."""
    path = F.regexp_replace(F.regexp_replace("url", "^[^:]+://[^/]+", ""), "[?#].*$", "")
    return table(spark, sf_dir, "pages").groupBy(ur.host(F.col("url")).alias("host"), path.alias("path")).agg(F.max("page_id").alias("page_id"), F.count("*").alias("times"))


@query(
    """WITH r AS (SELECT r_name, n_name, n_nationkey, row_number() OVER (PARTITION BY r_name ORDER BY n_name) - 1 AS place FROM region JOIN nation ON r_regionkey = n_regionkey)
    SELECT r_name AS section, CAST(place AS INTEGER) AS place, n_name AS item FROM r"""
)
def navigation_rows(spark, sf_dir):
    """Nested sections as rows, items in their order."""
    nested = table(spark, sf_dir, "region").join(table(spark, sf_dir, "nation"), F.col("r_regionkey") == F.col("n_regionkey")).groupBy("r_name").agg(F.array_sort(F.collect_list("n_name")).alias("items"))
    return nested.select(F.col("r_name").alias("section"), F.posexplode("items").alias("place", "item"))


# --- boards and scores -------------------------------------------------------------

_BOARD = """WITH l AS (SELECT p_brand, l_suppkey, l_quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS v, l_returnflag, CASE WHEN l_shipdate >= TIMESTAMP '1995-06-17' THEN 1 ELSE 0 END AS late FROM lineitem JOIN part ON p_partkey = l_partkey),
    f AS (SELECT p_brand, count(*) AS n, count(DISTINCT l_suppkey) AS sources, CAST(sum(v) AS DOUBLE) AS value, count(*) FILTER (l_returnflag = 'R') AS returned, count(*) FILTER (late = 1) AS now, count(*) FILTER (late = 0) AS before FROM l GROUP BY 1),
    m AS (SELECT *, least(5, greatest(1, 5.0 * n / max(n) OVER ())) AS a, least(5, greatest(1, 5.0 * sources / max(sources) OVER ())) AS b, least(5, greatest(1, 6 - 10.0 * returned / n)) AS c, least(5, greatest(1, 5 * value / max(value) OVER ())) AS d FROM f),
    s AS (SELECT *, round(least(100, greatest(0, round(30 * a / 5, 2) + round(20 * b / 5, 2) + round(20 * c / 5, 2) + round(30 * d / 5, 2))), 1) AS score FROM m)"""


@query(
    _BOARD + """ SELECT p_brand, score, CASE WHEN sources >= 90 THEN 'high' WHEN sources >= 20 THEN 'medium' ELSE 'low' END AS confidence, CASE WHEN score >= 85 THEN 'now' WHEN score >= 72 THEN 'next' ELSE 'later' END AS horizon,
    CASE WHEN now > before THEN 'up' WHEN now < before THEN 'down' ELSE 'flat' END AS trend, CAST(row_number() OVER (ORDER BY score DESC, n DESC, p_brand) AS INTEGER) AS rank FROM s"""
)
def opportunity_board(spark, sf_dir):
    """Brands as opportunities: four ratings, weighted score, confidence, horizon, trend and rank."""
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey"))
    late = F.col("l_shipdate") >= F.lit("1995-06-17").cast("timestamp_ntz")
    f = lines.groupBy("p_brand").agg(
        F.count("*").alias("n"), F.count_distinct("l_suppkey").alias("sources"), money("l_extendedprice").cast("double").alias("value"),
        F.count_if(F.expr("l_returnflag = 'R'")).alias("returned"), F.count_if(late).alias("now"), F.count_if(~late).alias("before"),
    )
    every = Window.partitionBy()  # a row a brand
    most = lambda c: 5.0 * F.col(c) / F.max(c).over(every)
    rating = [(30, most("n")), (20, most("sources")), (20, 6 - 10.0 * F.col("returned") / F.col("n")), (30, most("value"))]
    points = sum((F.round(w * vl.clamp(r, 1.0, 5.0) / 5, 2) for w, r in rating), F.lit(0.0))
    s = f.withColumn("score", F.round(vl.clamp(points, 0.0, 100.0), 1))
    trend = F.when(F.col("now") > F.col("before"), "up").when(F.col("now") < F.col("before"), "down").otherwise("flat")
    return s.select(
        "p_brand", "score", F.when(F.col("sources") >= 90, "high").when(F.col("sources") >= 20, "medium").otherwise("low").alias("confidence"),
        F.when(F.col("score") >= 85, "now").when(F.col("score") >= 72, "next").otherwise("later").alias("horizon"), trend.alias("trend"),
        F.row_number().over(Window.orderBy(F.desc("score"), F.desc("n"), "p_brand")).alias("rank"),
    )


_DAYS = "date_diff('day', CAST(ts AS DATE), (SELECT CAST(max(ts) AS DATE) FROM events))"


@query(
    f"""WITH b AS (SELECT event_id, user_id, CAST(floor(1000000 * exp(-{_DAYS} / 14.0) * CASE event_type WHEN 'purchase' THEN 1.25 WHEN 'signup' THEN 1.0 ELSE 0.8 END) AS BIGINT) AS base FROM events),
    r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY base DESC, event_id) AS use FROM b)
    SELECT event_id, CAST(base AS BIGINT) AS base, CAST(use AS INTEGER) AS use FROM r ORDER BY base * power(0.25, use - 1) DESC, event_id LIMIT 14"""
)
def briefing(spark, sf_dir):
    """Fourteen events by recency and weight, those of a source used before a quarter as much each time."""
    events = table(spark, sf_dir, "events")
    last = events.agg(F.max("ts")).first()[0]
    weight = F.when(F.col("event_type") == "purchase", 1.25).when(F.col("event_type") == "signup", 1.0).otherwise(0.8)
    base = F.floor(1000000 * vl.recency(F.datediff(F.lit(last), "ts")) * weight).cast("long")
    # a source's fifteenth event can't be among the first fourteen
    best = ledger.top_per_key(events.select("event_id", "user_id", base.alias("base")), ["user_id"], 14, F.desc("base"), F.asc("event_id"), rank="use")
    return best.orderBy(F.desc(F.col("base") * F.pow(F.lit(0.25), F.col("use") - 1)), "event_id").limit(14).select("event_id", "base", "use")


@query(
    """WITH o AS (SELECT o_custkey, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY 1),
    s AS (SELECT c_custkey, c_mktsegment AS vertical, least(5, 1 + coalesce(n, 0) // 5) + least(5, 1 + CAST(coalesce(total, 0) AS BIGINT) // 500000) + CASE WHEN c_acctbal > 5000 THEN 2 ELSE 0 END AS score, coalesce(n, 0) AS n FROM customer LEFT JOIN o ON o_custkey = c_custkey)
    SELECT vertical, c_custkey, CAST(score AS BIGINT) AS score, CASE WHEN score >= 12 THEN 'urgent' WHEN score >= 4 THEN 'watch' ELSE 'default' END AS label, CAST(r AS INTEGER) AS place
    FROM (SELECT *, row_number() OVER (PARTITION BY vertical ORDER BY score DESC, n DESC, c_custkey) AS r FROM s) WHERE r <= 4"""
)
def radar_picks(spark, sf_dir):
    """The four best customers of each vertical by a score of three axes, labelled."""
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), money("o_totalprice").cast("double").alias("total"))
    c = table(spark, sf_dir, "customer").join(o, "c_custkey", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    whole = F.round(F.coalesce("total", F.lit(0.0))).cast("long")
    score = F.least(F.lit(5), F.expr("1 + n div 5")) + F.least(F.lit(5), 1 + F.floor(whole / 500000)) + F.when(F.col("c_acctbal") > 5000, 2).otherwise(0)
    s = c.select("c_custkey", F.col("c_mktsegment").alias("vertical"), "n", score.cast("long").alias("score"))
    best = ledger.top_per_key(s, ["vertical"], 4, F.desc("score"), F.desc("n"), F.asc("c_custkey"), rank="place")
    return best.select("vertical", "c_custkey", "score", F.when(F.col("score") >= 12, "urgent").when(F.col("score") >= 4, "watch").otherwise("default").alias("label"), "place")


@query(
    """WITH u AS (SELECT l_suppkey, l_partkey, max(l_shipdate) AS day, bool_or(l_returnflag = 'A') AS official FROM lineitem GROUP BY ALL)
    SELECT l_suppkey, l_partkey, official, CAST(r AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY day DESC, official DESC, l_partkey) AS r FROM u) WHERE r <= 8"""
)
def company_evidence(spark, sf_dir):
    """The eight newest pieces of evidence of each company, each once; official ones win on one day."""
    u = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.max("l_shipdate").alias("day"), F.bool_or(F.col("l_returnflag") == "A").alias("official"))
    best = ledger.top_per_key(u, ["l_suppkey"], 8, F.desc("day"), F.desc("official"), F.asc("l_partkey"), rank="place")
    return best.select("l_suppkey", "l_partkey", "official", "place")


@query(
    """WITH e AS (SELECT user_id, count(*) AS n, count(*) FILTER (event_type = 'purchase') AS bought, max(ts) AS last FROM events GROUP BY 1), t AS (SELECT count(*) AS companies, max(last) AS m FROM e)
    SELECT CASE WHEN bought = 0 THEN 'none' WHEN last >= m - INTERVAL 2 DAY THEN 'current' ELSE 'older' END AS coverage, count(*) AS companies, CAST(sum(n) AS BIGINT) AS items FROM e, t GROUP BY 1"""
)
def news_coverage(spark, sf_dir):
    """Companies and items by how current their news are."""
    events = table(spark, sf_dir, "events")
    last = events.agg(F.max("ts")).first()[0]
    e = events.groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(F.expr("event_type = 'purchase'")).alias("bought"), F.max("ts").alias("last"))
    coverage = F.when(F.col("bought") == 0, "none").when(F.col("last") >= F.lit(last) - F.expr("interval 2 days"), "current").otherwise("older")
    return e.groupBy(coverage.alias("coverage")).agg(F.count("*").alias("companies"), F.sum("n").alias("items"))


@query("SELECT user_id, count(*) FILTER (r = 1) AS latest, count(*) FILTER (r > 1) AS historical FROM (SELECT user_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) GROUP BY user_id")
def view_counts(spark, sf_dir):
    """Latest and historical observations of each user's public view."""
    by = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return by.groupBy("user_id").agg(F.count("*").alias("latest"), (F.sum("n") - F.count("*")).alias("historical"))


@query(
    """WITH s AS (SELECT s_suppkey, s_acctbal, CASE WHEN abs(s_acctbal) >= 1000 THEN concat('$', CAST(CAST(floor(abs(s_acctbal) / 100) AS BIGINT) // 10 AS VARCHAR), '.', CAST(CAST(floor(abs(s_acctbal) / 100) AS BIGINT) % 10 AS VARCHAR), 'K') ELSE concat('$', CAST(CAST(floor(abs(s_acctbal)) AS BIGINT) AS VARCHAR)) END AS shown FROM supplier)
    SELECT s_suppkey, shown, CASE WHEN suffix(shown, 'K') THEN CAST(floor(abs(s_acctbal) / 100) AS BIGINT) * 100 ELSE CAST(floor(abs(s_acctbal)) AS BIGINT) END AS parsed FROM s"""
)
def display_numbers(spark, sf_dir):
    """Amounts as they are shown, and read back from that."""
    v = F.abs("s_acctbal")
    tens = F.floor(v / 100)
    shown = F.when(v >= 1000, F.concat(F.lit("$"), F.expr("cast(floor(abs(s_acctbal) / 100) as bigint) div 10").cast("string"), F.lit("."), (tens % 10).cast("string"), F.lit("K"))).otherwise(F.concat(F.lit("$"), F.floor(v).cast("string")))
    return table(spark, sf_dir, "supplier").select("s_suppkey", shown.alias("shown")).withColumn("parsed", vl.money(F.col("shown")).cast("long"))


# --- queues ------------------------------------------------------------------------


@query(
    f"""SELECT event_id, CASE WHEN event_type = 'error' THEN 0 WHEN event_type = 'purchase' THEN 1 ELSE 2 END AS priority, CAST({_DAYS} AS INTEGER) AS age FROM events
    ORDER BY 2, 3 DESC, event_id LIMIT 140"""
)
def work_queue(spark, sf_dir):
    """The first 140 of a queue by priority, oldest first."""
    events = table(spark, sf_dir, "events")
    last = events.agg(F.max("ts")).first()[0]
    rows = events.select("event_id", F.when(F.col("event_type") == "error", 0).when(F.col("event_type") == "purchase", 1).otherwise(2).alias("priority"), F.datediff(F.lit(last), "ts").alias("age"))
    return rows.orderBy("priority", F.desc("age"), "event_id").limit(140)


@query(
    """WITH o AS (SELECT o_custkey, max(o_orderdate) AS last, count(*) AS n FROM orders GROUP BY 1)
    SELECT c_custkey, coalesce(n, 0) AS n FROM customer LEFT JOIN o ON o_custkey = c_custkey ORDER BY last IS NOT NULL, last, c_custkey LIMIT 48"""
)
def refresh_queue(spark, sf_dir):
    """What was never checked first, then what was checked longest ago."""
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderdate").alias("last"), F.count("*").alias("n"))
    rows = table(spark, sf_dir, "customer").join(o, "c_custkey", "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n"), "last")
    return rows.orderBy(F.col("last").asc_nulls_first(), "c_custkey").limit(48).select("c_custkey", "n")


@query(
    """SELECT n_name, s_suppkey, CAST(tier AS INTEGER) AS tier FROM (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY tier, s_suppkey) AS r FROM (SELECT s_suppkey, s_nationkey, CASE WHEN s_acctbal >= 8000 THEN 1 WHEN s_acctbal >= 4000 THEN 2 WHEN s_acctbal >= 0 THEN 3 ELSE 4 END AS tier FROM supplier))
    JOIN nation ON n_nationkey = s_nationkey WHERE r <= 12"""
)
def tier_ranks(spark, sf_dir):
    """At most twelve suppliers of each nation by tier."""
    tier = F.when(F.col("s_acctbal") >= 8000, 1).when(F.col("s_acctbal") >= 4000, 2).when(F.col("s_acctbal") >= 0, 3).otherwise(4)
    best = ledger.top_per_key(table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", tier.alias("tier")), ["s_nationkey"], 12, F.asc("tier"), F.asc("s_suppkey"))
    return best.join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("s_nationkey")).select("n_name", "s_suppkey", "tier")


@query("""SELECT conv_id, CASE WHEN n < 2 THEN 'draft' WHEN answers * 2 < n THEN 'verified' WHEN short THEN 'reviewed' ELSE 'published' END AS stage FROM (SELECT conv_id, count(*) AS n, count(*) FILTER (role = 'assistant') AS answers, min(length(text)) < 80 AS short FROM conversations GROUP BY 1)""")
def workflow_stages(spark, sf_dir):
    """Each conversation's stage from what it has: the first condition that isn't met names it."""
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("n"), F.count_if(F.expr("role = 'assistant'")).alias("answers"), (F.min(F.length("text")) < 80).alias("short"))
    return c.select("conv_id", F.when(F.col("n") < 2, "draft").when(F.col("answers") * 2 < F.col("n"), "verified").when(F.col("short"), "reviewed").otherwise("published").alias("stage"))


# --- manifests and archives ----------------------------------------------------------


@query("SELECT source, sha256(text) AS sha, min(doc_id) AS doc_id, count(*) AS writes FROM documents GROUP BY source, text")
def content_archive(spark, sf_dir):
    """One archived object a source and content; what is there already is skipped."""
    return table(spark, sf_dir, "documents").groupBy("source", F.sha2("text", 256).alias("sha")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("writes"))


@query(
    """SELECT source AS dataset, count(*) AS records, CAST(sum(length(text)) AS BIGINT) AS characters, CAST(sum(CAST(concat('0x', substr(sha256(concat(doc_id, ':', text)), 1, 8)) AS BIGINT)) AS BIGINT) AS version,
    CASE WHEN count(*) >= 40 THEN 'ok' ELSE 'small' END AS status FROM documents GROUP BY source"""
)
def dataset_manifest(spark, sf_dir):
    """Records, size and a version that doesn't depend on row order, by dataset."""
    digest = F.conv(F.substring(F.sha2(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("text")), 256), 1, 8), 16, 10).cast("long")
    return table(spark, sf_dir, "documents").groupBy(F.col("source").alias("dataset")).agg(
        F.count("*").alias("records"), F.sum(F.length("text")).alias("characters"), F.sum(digest).alias("version"), F.when(F.count("*") >= 40, "ok").otherwise("small").alias("status")
    )


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, coalesce(nullif(trim(event_type), ''), 'none') AS kind, CASE WHEN value > 0 THEN value END AS value FROM events WHERE CAST(json_extract(props, '$.k') AS BIGINT) >= 50")
def slim_records(spark, sf_dir):
    """Events cut to listed keys: a dotted path, the first that isn't blank, a checked number."""
    kind = F.coalesce(F.nullif(F.trim("event_type"), F.lit("")), F.lit("none"))
    slim = table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), kind.alias("kind"), F.when(F.col("value") > 0, F.col("value")).alias("value"))
    return slim.where("k >= 50")


@query("SELECT c_custkey, replace(c_name, 'Customer', 'Client') AS c_name, replace(c_mktsegment, 'AUTO', 'Auto') AS c_mktsegment FROM customer")
def rewritten_leaves(spark, sf_dir):
    """A rewriting of every string leaf but machine keys; the leaves come from the schema."""
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    rewrite = lambda c: F.replace(F.replace(c, F.lit("Customer"), F.lit("Client")), F.lit("AUTO"), F.lit("Auto"))
    return people.select(*[rewrite(F.col(f.name)).alias(f.name) if f.dataType.simpleString() == "string" else f.name for f in people.schema.fields])
