"""Registered queries on views: filters, projections, orders, audits, ledgers on files."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarryline.functions import url as ur
from quarryline.operators import ledger
from quarryline.plans.catalogue import _HOST, money, query, table
from quarryline.sources import files
from quarryline.workspace import Workspace

# --- filters ---------------------------------------------------------------------


@query("SELECT d.doc_id FROM documents d JOIN labels l ON l.doc_id = d.doc_id WHERE l.quality = 1 AND l.toxic = 0 AND d.lang IS NOT NULL AND length(d.text) >= 200")
def source_backed(spark, sf_dir):
    """Documents that may be shown: vouched for, in a language, with enough text."""
    ok = table(spark, sf_dir, "labels").where("quality = 1 and toxic = 0").select("doc_id")
    return table(spark, sf_dir, "documents").where("lang is not null and length(text) >= 200").join(ok, "doc_id", "left_semi").select("doc_id")


@query("SELECT doc_id FROM documents WHERE regexp_matches(lower(concat_ws(' ', source, lang, text)), 'the |der |les ') AND NOT regexp_matches(lower(concat_ws(' ', source, lang, text)), '[|]|@')")
def in_scope(spark, sf_dir):
    """Documents with a term of the scope and none outside of it, over several fields."""
    fields = F.lower(F.concat_ws(" ", "source", "lang", "text"))
    return table(spark, sf_dir, "documents").where(fields.rlike("the |der |les ") & ~fields.rlike("[|]|@")).select("doc_id")


@query(r"""SELECT page_id, regexp_matches(lower(url), '\.(?:png|jpe?g|gif|svg|css|js|pdf)(?:[?#]|$)') AS asset, regexp_matches(lower(url), '/(?:tag|category|author|search)(?:/|$|[?])') OR regexp_extract(html, '<title>([^<]*)</title>', 1) = '' AS placeholder FROM pages""")
def page_filters(spark, sf_dir):
    """Whether a page is an asset, or a placeholder or tag page."""
    u = F.lower("url")
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    asset, tag = u.rlike(r"\.(?:png|jpe?g|gif|svg|css|js|pdf)(?:[?#]|$)"), u.rlike("/(?:tag|category|author|search)(?:/|$|[?])")
    return table(spark, sf_dir, "pages").select("page_id", asset.alias("asset"), (tag | (title == "")).alias("placeholder"))


@query("SELECT doc_id, CAST(3 * CAST(contains(lower(string_split(text, chr(10))[1]), 'the ') AS INT) + 2 * CAST(contains(lower(substr(text, 1, 400)), 'and ') AS INT) + CAST(lang = 'en' AS INT) AS INTEGER) AS focus FROM documents")
def company_focus(spark, sf_dir):
    """How much a text is about its company: three for the title, two for the lede, one for the tag."""
    title, lede = F.lower(F.element_at(F.split("text", "\n"), 1)), F.lower(F.substring("text", 1, 400))
    focus = 3 * F.contains(title, F.lit("the ")).cast("int") + 2 * F.contains(lede, F.lit("and ")).cast("int") + (F.col("lang") == "en").cast("int")
    return table(spark, sf_dir, "documents").select("doc_id", focus.alias("focus"))


@query(f"""SELECT page_id, regexp_matches(url, '^https?://') AND length(html) >= 120 AND NOT contains({_HOST}, 'gateway') AND regexp_matches(html, '[0-9]') AS verified FROM pages""")
def verified_records(spark, sf_dir):
    """Pages that count as verified: fetched over HTTP from no gateway, with text and figures."""
    u, h = F.col("url"), F.col("html")
    ok = u.rlike("^https?://") & (F.length(h) >= 120) & ~F.contains(ur.host(u), F.lit("gateway")) & h.rlike("[0-9]")
    return table(spark, sf_dir, "pages").select("page_id", ok.alias("verified"))


@query("SELECT doc_id FROM documents WHERE lang = 'en' AND source <> 'src0' AND contains(lower(text), 'the') AND doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def facet_filter(spark, sf_dir):
    """Documents of a language and source that hold a word and aren't deleted."""
    gone = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id")
    return table(spark, sf_dir, "documents").where("lang = 'en' and source <> 'src0' and contains(lower(text), 'the')").join(gone, "doc_id", "left_anti").select("doc_id")


@query("SELECT regexp_matches(text, '[0-9]+(?:[.][0-9]+)?%') OR contains(lower(text), 'survey') AS survey, count(*) AS documents, CAST(sum(n_chars) AS BIGINT) AS characters FROM documents GROUP BY 1")
def scope_split(spark, sf_dir):
    """Survey evidence and the rest."""
    survey = F.col("text").rlike("[0-9]+(?:[.][0-9]+)?%") | F.contains(F.lower("text"), F.lit("survey"))
    return table(spark, sf_dir, "documents").groupBy(survey.alias("survey")).agg(F.count("*").alias("documents"), F.sum("n_chars").alias("characters"))


@query("SELECT c_custkey, CASE WHEN last IS NULL THEN 'missing' WHEN date_diff('day', last, (SELECT max(o_orderdate) FROM orders)) > 90 THEN 'stale' ELSE 'fresh' END AS state FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last FROM orders GROUP BY 1) ON o_custkey = c_custkey")
def needs_refresh(spark, sf_dir):
    """Customers that need a refresh: never seen, or not for ninety days."""
    orders = table(spark, sf_dir, "orders")
    end = orders.agg(F.max("o_orderdate")).first()[0]
    last = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderdate").alias("last"))
    state = F.when(F.col("last").isNull(), "missing").when(F.datediff(F.lit(end), "last") > 90, "stale").otherwise("fresh")
    return table(spark, sf_dir, "customer").join(last, "c_custkey", "left").select("c_custkey", state.alias("state"))


# --- projections -------------------------------------------------------------------


@query("SELECT o_orderkey, c_name AS name, n_name AS place, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS balance, o_orderpriority IS NOT NULL AS matched FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey WHERE o_totalprice > 300000")
def slim_with_match(spark, sf_dir):
    """Listed fields with the matched record's, defaults where a value can't be."""
    people = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    match = people.select(F.col("c_custkey").alias("o_custkey"), F.struct(F.col("c_name").alias("name"), F.col("n_name").alias("place"), F.greatest("c_acctbal", F.lit(0.0)).alias("balance")).alias("m"))
    big = table(spark, sf_dir, "orders").where("o_totalprice > 300000").join(match, "o_custkey")
    return big.select("o_orderkey", "m.name", "m.place", "m.balance", F.col("o_orderpriority").isNotNull().alias("matched"))


@query("SELECT user_id, array_to_string(list_sort(list_filter(list_distinct(list(event_type)), lambda x: x <> 'error')), ',') AS labels, CAST(len(list_filter(list_distinct(list(event_type)), lambda x: x = 'error')) AS BIGINT) AS retired FROM events GROUP BY user_id")
def retired_labels(spark, sf_dir):
    """Each user's labels without the retired ones."""
    every = F.collect_set("event_type")
    kept = F.array_sort(F.filter(every, lambda x: x != "error"))
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.array_join(kept, ",").alias("labels"), F.size(F.filter(every, lambda x: x == "error")).cast("long").alias("retired"))


@query("SELECT p_partkey, concat_ws('/', p_brand, p_type) AS key, CASE WHEN p_size >= 40 THEN 'large' WHEN p_size >= 20 THEN 'middle' ELSE 'small' END AS section, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey) AS INTEGER) AS place FROM part QUALIFY place <= 3")
def compact_sections(spark, sf_dir):
    """The first three of every section, compacted to what the first screen needs."""
    best = ledger.top_per_key(table(spark, sf_dir, "part"), ["p_brand"], 3, F.desc("p_size"), F.asc("p_partkey"), rank="place")
    section = F.when(F.col("p_size") >= 40, "large").when(F.col("p_size") >= 20, "middle").otherwise("small")
    return best.select("p_partkey", F.concat_ws("/", "p_brand", "p_type").alias("key"), section.alias("section"), "place")


# --- orders ------------------------------------------------------------------------


@query("SELECT doc_id, coalesce(l.quality, -1) AS quality FROM documents d LEFT JOIN labels l USING (doc_id) ORDER BY coalesce(l.quality, -1) DESC, CASE d.lang WHEN 'de' THEN 0 WHEN 'fr' THEN 1 WHEN 'en' THEN 2 ELSE 9 END, substr(d.text, 1, 40), doc_id LIMIT 48")
def board_order(spark, sf_dir):
    """A board's order: marked first, then languages as listed with unknown ones last, then titles."""
    place = F.when(F.col("lang") == "de", 0).when(F.col("lang") == "fr", 1).when(F.col("lang") == "en", 2).otherwise(9)
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    rows = rows.select("doc_id", F.coalesce("quality", F.lit(-1)).alias("quality"), place.alias("place"), F.substring("text", 1, 40).alias("title"))
    return rows.orderBy(F.desc("quality"), "place", "title", "doc_id").limit(48).select("doc_id", "quality")


@query("SELECT event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r <= CASE event_type WHEN 'error' THEN 500 WHEN 'view' THEN 365 ELSE 140 END")
def ledger_caps(spark, sf_dir):
    """The newest rows of each ledger, as many as its cap keeps."""
    cap = F.when(F.col("event_type") == "error", 500).when(F.col("event_type") == "view", 365).otherwise(140)
    best = ledger.top_per_key(table(spark, sf_dir, "events"), ["event_type"], 500, F.desc("ts"), F.desc("event_id"), rank="r")
    return best.where(F.col("r") <= cap).select("event_type", "event_id")


@query(
    """WITH b AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events WHERE event_type = 'purchase'),
    n AS (SELECT event_id FROM b ORDER BY ts DESC, event_id DESC LIMIT 12) SELECT event_id, 'newest' AS why FROM n UNION ALL SELECT event_id, 'one of each' FROM b WHERE r = 1 AND event_id NOT IN (SELECT event_id FROM n)"""
)
def overview_selection(spark, sf_dir):
    """The twelve newest, and one more of each key that they leave out."""
    bought = table(spark, sf_dir, "events").where("event_type = 'purchase'")
    newest = bought.orderBy(F.desc("ts"), F.desc("event_id")).limit(12).select("event_id")
    one = ledger.best_per_key(bought, ["user_id"], F.desc("ts"), F.desc("event_id")).select("event_id").join(newest, "event_id", "left_anti")
    return newest.withColumn("why", F.lit("newest")).unionByName(one.withColumn("why", F.lit("one of each")))


# --- audits and ledgers --------------------------------------------------------------


@query(
    """WITH t AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n, count(*) FILTER (event_type = 'error') AS bad FROM events GROUP BY ALL)
    SELECT count(*) AS runs, count(*) FILTER (bad = 0) AS healthy, count(*) FILTER (bad > 0 AND bad < n) AS quiet, count(*) FILTER (bad = n) AS failed, round(count(*) FILTER (bad = 0) / count(*), 4) AS rate FROM t"""
)
def slo_metrics(spark, sf_dir):
    """Runs of a user and day by outcome, and the share of healthy ones."""
    t = table(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"), F.count_if(F.expr("event_type = 'error'")).alias("bad"))
    healthy = F.count_if(F.expr("bad = 0"))
    return t.agg(
        F.count("*").alias("runs"), healthy.alias("healthy"), F.count_if(F.expr("bad > 0 and bad < n")).alias("quiet"), F.count_if(F.expr("bad = n")).alias("failed"),
        F.round(healthy / F.count("*"), 4).alias("rate"),
    )


@query("SELECT lang, quality, toxic, count(*) AS n, count(*) FILTER (quality = toxic) AS conflicting FROM documents JOIN labels USING (doc_id) GROUP BY ALL")
def comparison_audit(spark, sf_dir):
    """Labels against each other, by language."""
    both = table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id")
    return both.groupBy("lang", "quality", "toxic").agg(F.count("*").alias("n"), F.count_if(F.expr("quality = toxic")).alias("conflicting"))


@query(
    """WITH o AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) SELECT n_regionkey AS layer, count(*) AS members, count(*) FILTER (c_acctbal > 0) AS main, CAST(sum(coalesce(n, 0)) AS BIGINT) AS mentions,
    count(DISTINCT n_nationkey) AS groups FROM customer JOIN nation ON n_nationkey = c_nationkey LEFT JOIN o ON o_custkey = c_custkey GROUP BY 1"""
)
def layer_statistics(spark, sf_dir):
    """Members, main members, mentions and groups of every layer."""
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    people = table(spark, sf_dir, "customer").join(o, "c_custkey", "left").join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    return people.groupBy(F.col("n_regionkey").alias("layer")).agg(
        F.count("*").alias("members"), F.count_if(F.expr("c_acctbal > 0")).alias("main"), F.sum(F.coalesce("n", F.lit(0))).alias("mentions"), F.count_distinct("n_nationkey").alias("groups")
    )


@query("SELECT user_id % 7 AS track, count(*) AS discovered, count(DISTINCT value) AS appended, count(*) - count(DISTINCT value) AS repeated, max(event_id) AS last FROM events GROUP BY 1")
def crawl_summary(spark, sf_dir):
    """What each track discovered, appended and saw again."""
    e = table(spark, sf_dir, "events").groupBy((F.col("user_id") % 7).alias("track"))
    return e.agg(F.count("*").alias("discovered"), F.count_distinct("value").alias("appended"), (F.count("*") - F.count_distinct("value")).alias("repeated"), F.max("event_id").alias("last"))


@query("SELECT 'track' || CAST(user_id % 3 AS VARCHAR) AS track, strftime(ts, '%Y-%m') AS month, count(*) AS n, max(event_id) AS last FROM events GROUP BY ALL")
def ledger_round_trip(spark, sf_dir):
    """Events appended to JSON-lines ledgers by track and month, and read back whole."""
    path = Workspace(spark, "ledger").path
    rows = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("track"), (F.col("user_id") % 3).cast("string")).alias("track"), "ts")
    files.append_partitioned(rows.where("event_id % 2 = 0"), path, F.col("ts"), "track")
    files.append_partitioned(rows.where("event_id % 2 = 1"), path, F.col("ts"), "track")
    back = spark.read.schema("event_id long, ts string, track string, month string").json(path)
    return back.groupBy("track", "month").agg(F.count("*").alias("n"), F.max("event_id").alias("last"))


@query(
    """SELECT 1 AS attempt, true AS written, count(*) AS rows, sum(p_size) AS sizes FROM part UNION ALL SELECT 2, false, count(*), sum(p_size) FROM part
    UNION ALL SELECT 3, true, count(*), sum(p_size) FROM part WHERE p_partkey % 5 <> 0 UNION ALL SELECT 4, true, count(*), sum(p_size + 1) FROM part WHERE p_partkey % 5 <> 0"""
)
def unchanged_write(spark, sf_dir):
    """A table written four times: new, the same in another order, with rows removed and
    with a column changed; whether each was written and what the table then holds."""
    path = Workspace(spark, "once").path
    part = table(spark, sf_dir, "part")
    fewer = part.where("p_partkey % 5 <> 0")
    found = None
    for attempt, rows in enumerate([part, part.repartition(3), fewer, fewer.withColumn("p_size", F.col("p_size") + 1)], 1):
        written = files.write_if_changed(rows, path)
        # each state is told before the next attempt may overwrite it
        told = Workspace(spark, "once").keep(spark.read.parquet(path).agg(F.lit(attempt).alias("attempt"), F.lit(written).alias("written"), F.count("*").alias("rows"), F.sum("p_size").alias("sizes")), "state")
        found = told if found is None else found.union(told)
    return found


@query(
    r"""SELECT page_id, CASE WHEN regexp_extract(html, '([0-9]{4}-[0-9]{2}-[0-9]{2})', 1) <> '' THEN 'explicit' WHEN regexp_extract(url, '/(20[0-9]{2})', 1) <> '' THEN 'url' ELSE 'none' END AS how,
    coalesce(nullif(regexp_extract(html, '([0-9]{4}-[0-9]{2}-[0-9]{2})', 1), ''), nullif(regexp_extract(url, '/(20[0-9]{2})', 1), ''), '') AS shown FROM pages"""
)
def display_dates(spark, sf_dir):
    """The date to show for a page: explicit, else that of its URL, else none."""
    explicit, year = F.regexp_extract("html", "([0-9]{4}-[0-9]{2}-[0-9]{2})", 1), F.regexp_extract("url", "/(20[0-9]{2})", 1)
    how = F.when(explicit != "", "explicit").when(year != "", "url").otherwise("none")
    shown = F.coalesce(F.nullif(explicit, F.lit("")), F.nullif(year, F.lit("")), F.lit(""))
    return table(spark, sf_dir, "pages").select("page_id", how.alias("how"), shown.alias("shown"))


@query("SELECT doc_id, coalesce(l.quality = 1, false) AS vouched, CASE WHEN l.doc_id IS NULL THEN 'none' WHEN l.toxic = 1 THEN 'withheld' WHEN l.quality = 1 THEN 'labels' ELSE 'documents' END AS provenance FROM documents d LEFT JOIN labels l USING (doc_id)")
def provenance(spark, sf_dir):
    """Every document with where its evidence comes from."""
    l = table(spark, sf_dir, "labels").withColumn("known", F.lit(True))  # noqa: E741
    both = table(spark, sf_dir, "documents").select("doc_id").join(l, "doc_id", "left")
    origin = F.when(F.col("known").isNull(), "none").when(F.col("toxic") == 1, "withheld").when(F.col("quality") == 1, "labels").otherwise("documents")
    return both.select("doc_id", F.coalesce(F.col("quality") == 1, F.lit(False)).alias("vouched"), origin.alias("provenance"))


@query(
    """WITH l AS (SELECT l_partkey, l_orderkey, l_shipdate, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) AS r FROM lineitem)
    SELECT p_partkey, l_orderkey AS newest, l_partkey IS NOT NULL AS held FROM part LEFT JOIN l ON l_partkey = p_partkey AND r = 1 WHERE p_size <= 10"""
)
def portfolio_news(spark, sf_dir):
    """A portfolio with the newest order that names each of its parts."""
    last = F.max_by("l_orderkey", F.struct("l_shipdate", "l_orderkey", "l_linenumber"))
    news = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(last.alias("newest"))
    return table(spark, sf_dir, "part").where("p_size <= 10").select("p_partkey").join(news, "p_partkey", "left").select("p_partkey", "newest", F.col("newest").isNotNull().alias("held"))


@query(
    """WITH c AS (SELECT c_custkey, n_regionkey AS layer, row_number() OVER (PARTITION BY n_regionkey ORDER BY c_acctbal DESC, c_custkey) AS r FROM customer JOIN nation ON n_nationkey = c_nationkey)
    SELECT layer, c_custkey, CAST(r AS INTEGER) AS round FROM c ORDER BY r, layer LIMIT 48"""
)
def balanced_fill(spark, sf_dir):
    """Forty-eight picks, one of each layer a round, so the least filled is always next."""
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey")).select("c_custkey", F.col("n_regionkey").alias("layer"), "c_acctbal")
    best = ledger.top_per_key(c, ["layer"], 48, F.desc("c_acctbal"), F.asc("c_custkey"), rank="round")
    return best.orderBy("round", "layer").limit(48).select("layer", "c_custkey", "round")


@query(
    """WITH e AS (SELECT l_orderkey, l_suppkey FROM lineitem GROUP BY ALL), n AS (SELECT l_orderkey, count(*) AS n, min(l_suppkey) AS hub FROM e GROUP BY 1)
    SELECT e.l_suppkey AS a, n.hub AS b, count(*) AS orders, CASE WHEN count(*) >= 3 THEN 'partner' ELSE 'peer' END AS kind FROM e JOIN n ON n.l_orderkey = e.l_orderkey WHERE n.n > 1 AND e.l_suppkey <> n.hub GROUP BY ALL"""
)
def relation_graph(spark, sf_dir):
    """Suppliers tied to the first one of an order that they share, with how often."""
    e = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey").distinct()
    hubs = e.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.min("l_suppkey").alias("b")).where("n > 1")
    ties = e.join(hubs, "l_orderkey").where("l_suppkey <> b").groupBy(F.col("l_suppkey").alias("a"), "b").agg(F.count("*").alias("orders"))
    return ties.withColumn("kind", F.when(F.col("orders") >= 3, "partner").otherwise("peer"))


@query("SELECT 'company' AS track, c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT 'market', s_suppkey, s_name FROM supplier UNION ALL SELECT 'chain', p_partkey, p_name FROM part UNION ALL SELECT 'source', n_nationkey, n_name FROM nation")
def track_rows(spark, sf_dir):
    """Four streams of candidates as one."""
    part = lambda t, track, key, name: table(spark, sf_dir, t).select(F.lit(track).alias("track"), F.col(key).cast("long").alias("id"), F.col(name).alias("name"))
    out = part("customer", "company", "c_custkey", "c_name").unionByName(part("supplier", "market", "s_suppkey", "s_name"))
    return out.unionByName(part("part", "chain", "p_partkey", "p_name")).unionByName(part("nation", "source", "n_nationkey", "n_name"))


@query(
    """WITH m AS (SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS month, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS n FROM orders GROUP BY ALL)
    SELECT o_custkey, count(*) AS months, CAST(sum(n) AS BIGINT) AS orders, max(month) AS latest, arg_max(total, month) AS last_total FROM m GROUP BY 1"""
)
def company_ledger(spark, sf_dir):
    """Each company's live ledger: months, orders, the latest month and its total."""
    m = table(spark, sf_dir, "orders").groupBy("o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(money("o_totalprice").cast("double").alias("total"), F.count("*").alias("n"))
    return m.groupBy("o_custkey").agg(F.count("*").alias("months"), F.sum("n").alias("orders"), F.max("month").alias("latest"), F.max_by("total", "month").alias("last_total"))
