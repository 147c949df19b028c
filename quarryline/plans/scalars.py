"""Registered queries on single fields, and scans of files derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarryline.functions import text as tx
from quarryline.functions import url as ur
from quarryline.functions import values as vl
from quarryline.plans.catalogue import _canon, query, table
from quarryline.sources import files
from quarryline.workspace import Workspace

# --- texts -----------------------------------------------------------------------

_STRIPPED = r"""regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '(?s)<[^>]+>', ' ', 'g')"""
for _entity, _sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
    _STRIPPED = f"replace({_STRIPPED}, '{_entity}', '{_sign}')"
_STRIPPED = rf"trim(regexp_replace({_STRIPPED}, '\s+', ' ', 'g'))"


@query(
    rf"""WITH t AS (SELECT page_id, {_STRIPPED} AS t FROM pages)
    SELECT page_id, sha256(t) AS sha, CAST(length(t) AS INTEGER) AS characters, CAST(CASE WHEN t = '' THEN 0 ELSE len(regexp_extract_all(t, '[.!?。！？]\s+')) + 1 END AS INTEGER) AS sentences FROM t"""
)
def page_texts(spark, sf_dir):
    """Text of every page without markup: its hash, characters and sentences."""
    t = table(spark, sf_dir, "pages").select("page_id", tx.strip_html(F.col("html")).alias("t"))
    return t.select("page_id", F.sha2("t", 256).alias("sha"), F.length("t").alias("characters"), F.size(tx.sentences(F.col("t"))).alias("sentences"))


@query(
    r"""SELECT page_id, trim(p) AS lead, CAST(len(ps) AS INTEGER) AS paragraphs FROM (SELECT page_id, ps, regexp_replace(ps[1], '<[^>]+>', '', 'g') AS p FROM
    (SELECT page_id, list_filter(regexp_extract_all(html, '<p>([^\n]*?)(?:<br>|</p>)', 1), lambda x: length(x) BETWEEN 55 AND 1600) AS ps FROM pages) WHERE len(ps) > 0)"""
)
def article_paragraphs(spark, sf_dir):
    """The first paragraph of each page that is long enough to be prose, and how many there are."""
    every = F.regexp_extract_all("html", F.lit(r"<p>([^\n]*?)(?:<br>|</p>)"), F.lit(1))
    p = table(spark, sf_dir, "pages").select("page_id", F.filter(every, lambda x: F.length(x).between(55, 1600)).alias("ps")).where("size(ps) > 0")
    return p.select("page_id", F.trim(F.regexp_replace(F.element_at("ps", 1), "<[^>]+>", "")).alias("lead"), F.size("ps").alias("paragraphs"))


@query(
    f"""SELECT page_id, {_canon('utm_[^=&]*|fbclid|gclid|mc_[^=&]*', False, '')} AS collector, {_canon('utm_source|utm_medium|utm_campaign|utm_term|utm_content', False, '/+$')} AS news FROM pages"""
)
def collector_urls(spark, sf_dir):
    """Canonical forms of every page's URL for collection and for news."""
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", ur.canonical_url(u, "collector").alias("collector"), ur.canonical_url(u, "news").alias("news"))


@query("""SELECT doc_id, sha256(CAST(json_object('doc_id', doc_id, 'lang', lang, 'source', source) AS VARCHAR)) AS row_hash, right(to_base64(encode(text)), 16) AS tail FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL""")
def stable_hashes(spark, sf_dir):
    """A hash of each record with its keys in order, and the end of its text in base 64."""
    docs = table(spark, sf_dir, "documents").where("lang is not null and source is not null")
    return docs.select("doc_id", tx.row_hash("source", "lang", "doc_id").alias("row_hash"), F.right(F.regexp_replace(F.base64(F.encode("text", "UTF-8")), r"\s", ""), F.lit(16)).alias("tail"))


@query(
    r"""WITH p AS (SELECT c.conv_id, c.turn, c.text AS a, n.text AS b FROM conversations c JOIN conversations n ON n.conv_id = c.conv_id AND n.turn = c.turn + 1),
    k AS (SELECT *, regexp_replace(lower(a), '[^\p{L}\p{N}]+', '', 'g') AS x, regexp_replace(lower(b), '[^\p{L}\p{N}]+', '', 'g') AS y,
      list_distinct(list_filter(string_split(regexp_replace(lower(a), '[^\p{L}\p{N}]+', ' ', 'g'), ' '), lambda t: length(t) >= 2)) AS u, list_distinct(list_filter(string_split(regexp_replace(lower(b), '[^\p{L}\p{N}]+', ' ', 'g'), ' '), lambda t: length(t) >= 2)) AS v FROM p)
    SELECT conv_id, turn, x <> '' AND y <> '' AND (x = y OR (least(length(x), length(y)) >= 24 AND (contains(x, y) OR contains(y, x)))
      OR (len(u) > 0 AND len(v) > 0 AND len(list_intersect(u, v)) / least(len(u), len(v)) >= 0.82)) AS near FROM k"""
)
def near_claims(spark, sf_dir):
    """Whether a turn says nearly what the next one says."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    both = c.join(c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("next")), ["conv_id", "turn"])
    return both.select("conv_id", "turn", tx.near_claim(F.col("text"), F.col("next")).alias("near"))


@query(
    """WITH a AS (SELECT doc_id, lower(split_part(split_part(text, chr(10), 1), ' ', 1)) AS alias FROM documents) SELECT min(doc_id) AS doc_id, alias FROM a WHERE length(alias) >= 4 GROUP BY alias HAVING count(*) = 1"""
)
def unique_aliases(spark, sf_dir):
    """First words that one document alone begins with."""
    word = F.lower(F.element_at(F.split(F.element_at(F.split("text", "\n"), 1), " "), 1))
    a = table(spark, sf_dir, "documents").select("doc_id", word.alias("alias")).where("length(alias) >= 4")
    return a.groupBy("alias").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n")).where("n = 1").select("doc_id", "alias")


@query(
    """WITH p AS (SELECT n.conv_id, n.turn, length(n.text) / greatest(length(c.text), 1) AS r, contains(n.text, chr(65533)) OR regexp_matches(n.text, 'Ã|Â') AS broken, regexp_matches(lower(n.text), 'undefined|null|nan ') AS bad
      FROM conversations c JOIN conversations n ON n.conv_id = c.conv_id AND n.turn = c.turn + 1 WHERE c.role = 'user')
    SELECT CASE WHEN broken THEN 'encoding' WHEN bad THEN 'tokens' WHEN r < 0.2 OR r > 20 THEN 'length' ELSE 'valid' END AS verdict, count(*) AS n FROM p GROUP BY 1"""
)
def translation_checks(spark, sf_dir):
    """Answers by the first check that they fail: encoding, tokens, length band."""
    c = table(spark, sf_dir, "conversations")
    asked = c.where("role = 'user'").select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("asked"))
    both = c.join(asked, ["conv_id", "turn"]).withColumn("r", F.length("text") / F.greatest(F.length("asked"), F.lit(1)))
    broken = F.contains("text", F.lit("�")) | F.col("text").rlike("Ã|Â")
    bad = F.lower("text").rlike("undefined|null|nan ")
    verdict = F.when(broken, "encoding").when(bad, "tokens").when((F.col("r") < 0.2) | (F.col("r") > 20), "length").otherwise("valid")
    return both.groupBy(verdict.alias("verdict")).agg(F.count("*").alias("n"))


KINDS = {
    "role": [("implication", "(?:should|could) "), ("change", "(?:new|more) "), ("fact", "[0-9]")],
    "dimension": [("users", "the "), ("trade", "der "), ("place", "les ")],
    "kind": [("survey", "[0-9]%"), ("shipment", " \\| "), ("estimate", "@")],
}


@query("SELECT " + ", ".join("CASE " + " ".join(f"WHEN regexp_matches(text, '{p}') THEN '{v}'" for v, p in rules) + f" ELSE 'other' END AS {name}" for name, rules in KINDS.items()) + ", count(*) AS n FROM documents GROUP BY ALL")
def record_kinds(spark, sf_dir):
    """Documents by role, dimension and kind, each the first of its rules that matches."""
    return table(spark, sf_dir, "documents").groupBy(*[vl.first_match(F.col("text"), rules, "other").alias(name) for name, rules in KINDS.items()]).agg(F.count("*").alias("n"))


@query(
    """WITH d AS (SELECT o_orderkey, date_diff('day', o_orderdate, (SELECT max(o_orderdate) FROM orders)) AS age, o_totalprice FROM orders)
    SELECT o_orderkey, CAST(least(100, greatest(10, 100 - 1.5 * age)) AS DOUBLE) AS recency, CAST(12 * least(3, CAST(floor(o_totalprice / 100000) AS BIGINT)) + 6 * CAST(age <= 30 AS INT) + 2 * least(5, age // 400) AS BIGINT) AS score FROM d WHERE age <= 400"""
)
def evidence_scores(spark, sf_dir):
    """Recency between 10 and 100, and a score of evidence, for the last four hundred days."""
    orders = table(spark, sf_dir, "orders")
    last = orders.agg(F.max("o_orderdate")).first()[0]
    age = vl.age_days(F.col("o_orderdate"), F.lit(last))
    d = orders.select("o_orderkey", "o_totalprice", age.cast("int").alias("age")).where("age <= 400")
    score = 12 * F.least(F.lit(3), F.floor(F.col("o_totalprice") / 100000)) + 6 * (F.col("age") <= 30).cast("int") + 2 * F.least(F.lit(5), F.floor(F.col("age") / 400))
    return d.select("o_orderkey", vl.clamp((100 - 1.5 * F.col("age")).cast("double"), 10.0, 100.0).alias("recency"), score.cast("long").alias("score"))


@query("SELECT doc_id, array_to_string(list_filter(['title', 'figures', 'contact'], lambda s: CASE s WHEN 'title' THEN length(split_part(text, chr(10), 1)) >= 28 WHEN 'figures' THEN regexp_matches(text, '[0-9]') ELSE contains(text, '@') END), ',') AS visible FROM documents")
def publication_profile(spark, sf_dir):
    """The sections of each document that have something to show."""
    ok = vl.issues(title=F.length(F.element_at(F.split("text", "\n"), 1)) < 28, figures=~F.col("text").rlike("[0-9]"), contact=~F.contains("text", F.lit("@")))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(ok, ",").alias("visible"))


@query(
    """WITH t AS (SELECT event_id, concat('+', CASE event_id % 3 WHEN 0 THEN strftime(ts, '%Y-%m-%d') WHEN 1 THEN strftime(ts, '%Y-%m-00') ELSE strftime(ts, '%Y-00-00') END, 'T00:00:00Z') AS raw FROM events)
    SELECT event_id, replace(substr(raw, 2, 10), '-00', '-01') AS day, CASE WHEN suffix(substr(raw, 2, 10), '-00-00') THEN 'year' WHEN suffix(substr(raw, 2, 10), '-00') THEN 'month' ELSE 'day' END AS "precision" FROM t"""
)
def knowledge_dates(spark, sf_dir):
    """Times in which the month or day may be 00, with their precision."""
    m = F.col("event_id") % 3
    raw = F.concat(F.lit("+"), F.when(m == 0, F.date_format("ts", "yyyy-MM-dd")).when(m == 1, F.date_format("ts", "yyyy-MM-'00'")).otherwise(F.date_format("ts", "yyyy-'00-00'")), F.lit("T00:00:00Z"))
    t = table(spark, sf_dir, "events").select("event_id", F.substring(raw, 2, 10).alias("d"))
    precision = F.when(F.endswith("d", F.lit("-00-00")), "year").when(F.endswith("d", F.lit("-00")), "month").otherwise("day")
    return t.select("event_id", F.replace("d", F.lit("-00"), F.lit("-01")).alias("day"), precision.alias("precision"))


# --- groups ----------------------------------------------------------------------


@query("""WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL) SELECT user_id, arg_max(event_type, (n, event_type)) AS main, max(n) AS n, round(max(n) / sum(n), 4) AS share FROM c GROUP BY user_id""")
def primary_mix(spark, sf_dir):
    """Each user's commonest type and its share."""
    c = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return c.groupBy("user_id").agg(F.max_by("event_type", F.struct("n", "event_type")).alias("main"), F.max("n").alias("n"), F.round(F.max("n") / F.sum("n"), 4).alias("share"))


@query("""SELECT user_id, CAST(floor(value) AS BIGINT) AS value, arg_max(event_type, (length(event_type), event_type)) AS label, count(DISTINCT event_type) AS labels FROM events GROUP BY ALL""")
def metric_merge(spark, sf_dir):
    """Metrics of equal value merged under the most specific label."""
    e = table(spark, sf_dir, "events").groupBy("user_id", F.floor("value").alias("value"))
    return e.agg(F.max_by("event_type", F.struct(F.length("event_type"), "event_type")).alias("label"), F.count_distinct("event_type").alias("labels"))


@query(
    """WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, max(value) AS v FROM events GROUP BY ALL) SELECT user_id, day, max(v) OVER (PARTITION BY user_id ORDER BY day) AS level FROM d"""
)
def monotone_series(spark, sf_dir):
    """Each user's daily level, which never goes back."""
    from pyspark.sql import Window

    d = table(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.max("value").alias("v"))
    return d.select("user_id", "day", F.max("v").over(Window.partitionBy("user_id").orderBy("day")).alias("level"))


@query(
    """WITH now AS (SELECT page_id, url, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages), prior AS (SELECT min(page_id) AS id, url FROM now WHERE page_id % 2 = 0 GROUP BY url), titled AS (SELECT min(page_id) AS id, title FROM now WHERE page_id % 5 = 1 GROUP BY title)
    SELECT n.page_id, coalesce(p.id, t.id) AS prior, CASE WHEN p.id IS NOT NULL THEN 'url' WHEN t.id IS NOT NULL THEN 'title' ELSE 'none' END AS matched_by FROM now n LEFT JOIN prior p ON p.url = n.url LEFT JOIN titled t ON t.title = n.title"""
)
def prior_by_url_or_title(spark, sf_dir):
    """Each page's earlier record by its URL, else by its title."""
    now = table(spark, sf_dir, "pages").select("page_id", "url", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))
    prior = now.where("page_id % 2 = 0").groupBy("url").agg(F.min("page_id").alias("p"))
    titled = now.where("page_id % 5 = 1").groupBy("title").agg(F.min("page_id").alias("t"))
    both = now.join(prior, "url", "left").join(titled, "title", "left")
    by = F.when(F.col("p").isNotNull(), "url").when(F.col("t").isNotNull(), "title").otherwise("none")
    return both.select("page_id", F.coalesce("p", "t").alias("prior"), by.alias("matched_by"))


# --- scans of derived files --------------------------------------------------------


@query("SELECT user_id, event_id, value FROM events WHERE event_type = 'purchase'")
def parallel_columns(spark, sf_dir):
    """Series written as JSON with one array a column, and read back as rows."""
    path = Workspace(spark, "arrays").path
    bought = table(spark, sf_dir, "events").where("event_type = 'purchase'")
    rows = F.array_sort(F.collect_list(F.struct("event_id", "value")))
    bought.groupBy("user_id").agg(rows.alias("r")).select("user_id", F.col("r.event_id").alias("event_id"), F.col("r.value").alias("value")).write.json(path)
    return files.zipped_rows(spark.read.schema("user_id long, event_id array<long>, value array<double>").json(path), "event_id", "value")


@query("SELECT user_id, CAST(ts AS DATE) AS day, max(value) AS price FROM events GROUP BY ALL")
def csv_prices(spark, sf_dir):
    """Daily prices written as CSV and read back with their types."""
    path = Workspace(spark, "csv").path
    table(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.max("value").alias("price")).write.option("header", True).csv(path)
    return spark.read.option("header", True).schema("user_id long, day date, price double").csv(path)


@query("SELECT user_id, CASE WHEN count(*) FILTER (event_type = 'purchase') > 3 THEN 'purchases' WHEN count(*) FILTER (event_type = 'click') > 0 THEN 'clicks' ELSE 'views' END AS provider FROM events WHERE event_type IN ('purchase', 'click', 'view') GROUP BY user_id")
def provider_chain(spark, sf_dir):
    """The first source in the chain that has enough for a user."""
    e = table(spark, sf_dir, "events")
    of = lambda kind, name, least: e.where(F.col("event_type") == kind).groupBy("user_id").agg(F.count("*").alias("n")).where(F.col("n") > least).select("user_id", F.lit(name).alias("provider"))
    return files.first_provider(of("purchase", "purchases", 3), of("click", "clicks", 0), of("view", "views", 0), key="user_id")
