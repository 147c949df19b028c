"""The registered queries and, beside each, the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.functions import text as tx
from quarryline.functions import url as ur
from quarryline.functions import values as vl
from quarryline.operators import greedy, joins, ledger
from quarryline.operators.components import connected_components
from quarryline.operators.features import feature_buckets
from quarryline.workspace import Workspace

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(column: str):
    """Sums of doubles as exact decimals, so that they don't depend on order."""
    return F.sum(F.col(column).cast("decimal(18,2)"))


NORM = r"""trim(regexp_replace(regexp_replace(lower(trim(regexp_replace(coalesce({c}, ''), '\s+', ' ', 'g'))), '&(?:nbsp|amp);', ' ', 'g'), '[^a-z0-9가-힣%$€£¥₩₹]+', ' ', 'g'))"""
NORM_TEXT = NORM.format(c="text")
TOKENS_TEXT = f"list_distinct(list_filter(string_split({NORM_TEXT}, ' '), lambda t: length(t) > 2))"

# --- documents: latest, duplicates, suppression -----------------------------


@query(
    f"""SELECT doc_id, sha256({NORM_TEXT}) AS content_key,
    row_number() OVER (PARTITION BY sha256({NORM_TEXT}) ORDER BY doc_id DESC) = 1 AS is_latest,
    count(*) OVER (PARTITION BY sha256({NORM_TEXT})) AS copies FROM documents"""
)
def latest_per_content_key(spark, sf_dir):
    """Every document with its content key, whether it is the newest, and its copies."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2(tx.normalized(F.col("text")), 256).alias("content_key"))
    return ledger.flag_latest(Workspace(spark, "keys").keep(docs, "keys"), ["content_key"], "doc_id")


@query(
    f"""SELECT source, count(*) AS "rows", count(*) - count(DISTINCT sha256({NORM_TEXT})) AS duplicates,
    round((count(*) - count(DISTINCT sha256({NORM_TEXT}))) / count(*), 4) AS rate FROM documents GROUP BY source"""
)
def duplicate_rate_by_source(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return ledger.duplicate_rate(docs, F.sha2(tx.normalized(F.col("text")), 256), "source")


@query(
    f"""WITH d AS (SELECT doc_id, source, sha256({NORM_TEXT}) AS k FROM documents),
    led AS (SELECT DISTINCT k FROM d WHERE doc_id % 2 = 0),
    c AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id) AS r FROM d WHERE doc_id % 2 = 1)
    SELECT doc_id, source, k AS content_key FROM c WHERE r = 1 AND k NOT IN (SELECT k FROM led)"""
)
def append_only_insert(spark, sf_dir):
    """Odd documents that a ledger of the even ones doesn't hold, once each."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.sha2(tx.normalized(F.col("text")), 256).alias("content_key"))
    return ledger.append_new(docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1"), ["content_key"], F.asc("doc_id"))


@query(
    f"""WITH b AS (SELECT DISTINCT sha256({NORM_TEXT}) AS k FROM benchmark)
    SELECT source, count(*) AS kept FROM documents WHERE sha256({NORM_TEXT}) NOT IN (SELECT k FROM b) GROUP BY source"""
)
def suppress_by_key(spark, sf_dir):
    """Documents whose whole text isn't a suppressed one, by source."""
    key = F.sha2(tx.normalized(F.col("text")), 256)
    docs = table(spark, sf_dir, "documents").withColumn("k", key)
    gone = table(spark, sf_dir, "benchmark").select(key.alias("k"))
    return docs.join(gone, "k", "left_anti").groupBy("source").agg(F.count("*").alias("kept"))


@query(
    """SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)"""
)
def mentioned_items(spark, sf_dir):
    """Documents and the benchmark items that they contain."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("item"))
    return joins.mentions(docs, "doc_id", F.col("text"), items, "item_id", "item")


@query(
    """WITH hit AS (SELECT DISTINCT d.doc_id FROM documents d JOIN benchmark b ON contains(d.text, b.text))
    SELECT lang, count(*) AS kept FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM hit) GROUP BY lang"""
)
def suppress_by_mention(spark, sf_dir):
    """Documents without any suppressed passage, by language."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("item"))
    hit = joins.mentions(docs, "doc_id", F.col("text"), items, "item_id", "item").select("doc_id").distinct()
    return docs.join(hit, "doc_id", "left_anti").groupBy("lang").agg(F.count("*").alias("kept"))


AXES = {"english": (["the "], ["and ", "of "]), "german": (["der "], ["und ", "die "]), "french": (["que "], ["les ", "des "]), "spanish": (["los "], ["que ", "las "])}


def _axis_sql() -> str:
    def hits(terms):
        return " + ".join(f"CAST(contains(lower(text), '{t}') AS INT)" for t in terms)

    parts = [f"SELECT doc_id, '{a}' AS axis, {hits(s)} AS strong, {hits(w)} AS weak FROM documents" for a, (s, w) in AXES.items()]
    return "SELECT doc_id, axis, strong, weak FROM (" + " UNION ALL ".join(parts) + ") WHERE strong >= 1 OR strong + weak >= 2"


@query(_axis_sql())
def axis_match(spark, sf_dir):
    """Documents and the axes of which a strong term, or two terms, occur."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.lower("text").alias("text"))
    return joins.match_axes(docs, F.col("text"), AXES).select("doc_id", "axis", "strong", "weak")


PAIR_SQL = f"""WITH d AS (SELECT doc_id, list_sort({TOKENS_TEXT}) AS t FROM documents),
    s AS (SELECT t, min(doc_id) AS id FROM d GROUP BY 1 HAVING len(t) > 0),
    m AS (SELECT s.id AS a, d.doc_id AS b, 1.0 AS similarity FROM d JOIN s USING (t) WHERE d.doc_id <> s.id),
    e AS (SELECT id, len(t) AS n, unnest(t) AS w FROM s),
    p AS (SELECT a.id AS a, b.id AS b, count(*) / (any_value(a.n) + any_value(b.n) - count(*)) AS similarity
          FROM e a JOIN e b ON a.w = b.w AND a.id < b.id GROUP BY a.id, b.id)"""


def _near(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return joins.similar_pairs(docs, "doc_id", tx.tokens(F.col("text")), 0.84)


@query(f"{PAIR_SQL} SELECT a, b, round(similarity, 6) AS similarity FROM p WHERE similarity >= 0.84 UNION ALL SELECT a, b, 1.0 FROM m")
def near_duplicate_pairs(spark, sf_dir):
    """Pairs of different token sets with a Jaccard similarity of .84 or more, each by
    its smallest document, and this document's other copies."""
    return _near(spark, sf_dir).withColumn("similarity", F.round("similarity", 6))


@query(
    f"""{PAIR_SQL}, q AS (SELECT a, b FROM p WHERE similarity >= 0.84 UNION SELECT a, b FROM m),
    n AS (SELECT a AS x, b AS y FROM q UNION SELECT b, a FROM q UNION SELECT a, a FROM q UNION SELECT b, b FROM q),
    r AS (SELECT x, y FROM n), c AS (SELECT * FROM r)
    SELECT node AS doc_id, min(root) AS cluster FROM (
      WITH RECURSIVE w(node, root) AS (SELECT x, y FROM n UNION SELECT w.node, n.y FROM w JOIN n ON w.root = n.x) SELECT * FROM w)
    GROUP BY node"""
)
def content_clusters(spark, sf_dir):
    """Every document that has copies or near-duplicates, and the smallest document of
    its component."""
    found = connected_components(_near(spark, sf_dir), Workspace(spark, "clusters"))
    roots = found.select(F.col("root").alias("node"), "root").distinct()
    return found.union(roots).select(F.col("node").alias("doc_id"), F.col("root").alias("cluster"))


@query(
    """WITH s AS (SELECT d.doc_id, l.quality, len(list_distinct(string_split(lower(text), ' '))) / greatest(len(string_split(lower(text), ' ')), 1) AS score
      FROM documents d JOIN labels l USING (doc_id)),
    t AS (SELECT i, (700 + 5 * i) / 1000.0 AS threshold FROM range(0, 51) r(i)),
    c AS (SELECT threshold, count(*) FILTER (score >= threshold AND quality = 1) AS tp, count(*) FILTER (score >= threshold AND quality = 0) AS fp,
      count(*) FILTER (score < threshold AND quality = 1) AS fn FROM s, t GROUP BY threshold)
    SELECT CAST(threshold AS DOUBLE) AS threshold, tp, fp, fn, round(CASE WHEN tp + fp = 0 THEN 1 ELSE tp / (tp + fp) END, 6) AS "precision",
    round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 6) AS recall FROM c"""
)
def threshold_sweep(spark, sf_dir):
    """Precision and recall of a lexical score at 51 thresholds."""
    words = F.split(F.lower("text"), " ")
    score = F.size(F.array_distinct(words)) / F.greatest(F.size(words), F.lit(1))
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id").select(score.alias("score"), "quality")
    # how many rows reach how many thresholds comes first, so nothing is multiplied by 51
    step = F.when(F.col("score") < 0.7, -1).otherwise(F.size(F.filter(F.sequence(F.lit(0), F.lit(50)), lambda i: F.col("score") >= (700 + 5 * i) / 1000)) - 1)
    counts = rows.groupBy(step.alias("step")).agg(F.count_if(F.expr("quality = 1")).alias("pos"), F.count_if(F.expr("quality = 0")).alias("neg"))
    all_steps = counts.select(F.explode(F.sequence(F.lit(0), F.lit(50))).alias("i"), "step", "pos", "neg")
    reached = F.col("step") >= F.col("i")
    total = lambda keep, what: F.sum(F.when(keep, F.col(what)).otherwise(0))
    c = all_steps.groupBy("i").agg(total(reached, "pos").alias("tp"), total(reached, "neg").alias("fp"), total(~reached, "pos").alias("fn"))
    return c.select(
        ((700 + 5 * F.col("i")) / 1000).alias("threshold"), "tp", "fp", "fn",
        F.round(F.when(F.col("tp") + F.col("fp") == 0, 1.0).otherwise(F.col("tp") / (F.col("tp") + F.col("fp"))), 6).alias("precision"),
        F.round(F.when(F.col("tp") + F.col("fn") == 0, 0.0).otherwise(F.col("tp") / (F.col("tp") + F.col("fn"))), 6).alias("recall"),
    )


RULES = [("contact", r"@[a-z0-9]"), ("figures", r"[0-9]{4}"), ("shouted", r"[A-Z]{4}"), ("listed", r" \| ")]
_RULE_SQL = "CASE " + " ".join(f"WHEN regexp_matches(text, '{p}') THEN '{label}'" for label, p in RULES).replace("\\\\", "\\") + " ELSE 'plain' END"


@query(f"SELECT {_RULE_SQL} AS class, lang, count(*) AS n FROM documents GROUP BY ALL")
def first_match_class(spark, sf_dir):
    """Documents by the first rule that matches."""
    return table(spark, sf_dir, "documents").groupBy(vl.first_match(F.col("text"), RULES, "plain").alias("class"), "lang").agg(F.count("*").alias("n"))


@query(
    "SELECT label, count(*) AS n, max(doc_id) AS latest FROM (SELECT doc_id, unnest([x for x in ["
    + ", ".join(f"CASE WHEN regexp_matches(text, '{p}') THEN '{label}' END" for label, p in RULES)
    + "] if x is not null]) AS label FROM documents) GROUP BY label"
)
def multi_label_counts(spark, sf_dir):
    """Documents by every rule that matches, with the latest example."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.explode(vl.all_matches(F.col("text"), RULES)).alias("label"))
    return docs.groupBy("label").agg(F.count("*").alias("n"), F.max("doc_id").alias("latest"))


LAYERS = {"english": ["the ", "and ", "was "], "german": ["der ", "und ", "sich "], "french": ["que ", "dans ", "les "], "spanish": ["los ", "por ", "con "]}


def _layer_sql() -> str:
    cols = [" + ".join(f"CASE WHEN contains(lower(text), '{t}') THEN 3 ELSE 0 END" for t in ts) for ts in LAYERS.values()]
    structs = ", ".join(f"{{'score': {c}, 'o': {-i}, 'label': '{n}'}}" for i, (n, c) in enumerate(zip(LAYERS, cols)))
    return f"SELECT m.label AS label, m.score AS score, count(*) AS n FROM (SELECT list_max([{structs}]) AS m FROM documents) GROUP BY ALL"


@query(_layer_sql())
def layer_score(spark, sf_dir):
    """Documents by the layer with most points for its terms."""
    best = table(spark, sf_dir, "documents").select(vl.term_scores(F.lower("text"), LAYERS).alias("m"))
    return best.groupBy(F.col("m.label").alias("label"), F.col("m.score").alias("score")).agg(F.count("*").alias("n"))


@query(
    """WITH q AS (SELECT doc_id, len(list_distinct(regexp_extract_all(text, '\\d+(?:[.,]\\d+)*'))) AS numbers, contains(text, '@') AS mail, length(text) AS n FROM documents),
    s AS (SELECT doc_id, CASE WHEN mail THEN 40 ELSE 0 END + CASE WHEN numbers > 0 THEN 30 ELSE 0 END + least(10, n // 1000) AS score FROM q)
    SELECT doc_id, CAST(score AS BIGINT) AS score, CASE WHEN score >= 70 THEN 'P0' WHEN score >= 40 THEN 'P1' ELSE 'P2' END AS priority FROM s WHERE score >= 30"""
)
def reverification_queue(spark, sf_dir):
    """Documents to verify again, scored by what they hold."""
    score = F.when(F.contains("text", F.lit("@")), 40).otherwise(0) + F.when(F.size(vl.numbers(F.col("text"))) > 0, 30).otherwise(0) + F.least(F.lit(10), F.floor(F.length("text") / 1000))
    scored = table(spark, sf_dir, "documents").select("doc_id", score.cast("long").alias("score"))
    return scored.where("score >= 30").withColumn("priority", vl.priority(F.col("score")))


@query(
    """WITH n AS (SELECT doc_id, lag(doc_id) OVER w AS prior, list_distinct(regexp_extract_all(text, '\\d+(?:[.,]\\d+)*')) AS x,
      lag(list_distinct(regexp_extract_all(text, '\\d+(?:[.,]\\d+)*'))) OVER w AS y FROM documents WINDOW w AS (PARTITION BY source ORDER BY doc_id))
    SELECT doc_id, prior, CAST(len(list_filter(x, lambda v: NOT list_contains(y, v))) AS INTEGER) AS unsupported FROM n
    WHERE prior IS NOT NULL AND len(list_filter(x, lambda v: NOT list_contains(y, v))) > 0"""
)
def unsupported_numbers(spark, sf_dir):
    """Numbers of a document that its source's previous one doesn't have."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", vl.numbers(F.col("text")).alias("x"))
    both = ledger.previous(Workspace(spark, "numbers").keep(docs, "numbers"), ["source"], "doc_id", "x").where("prior is not null")
    return both.select("doc_id", F.col("prior.doc_id").alias("prior"), F.size(F.array_except("x", F.col("prior.x"))).alias("unsupported")).where("unsupported > 0")


@query(
    """WITH d AS (SELECT doc_id, lower(text) AS t FROM documents),
    s AS (SELECT doc_id, CASE WHEN contains(t, 'the and') THEN 18 ELSE 0 END + CASE WHEN contains(t, 'the') THEN 3 ELSE 0 END + CASE WHEN contains(t, 'and') THEN 3 ELSE 0 END AS score,
      greatest(1, strpos(t, 'the') - 70) AS a FROM d)
    SELECT s.doc_id, CAST(score AS BIGINT) AS score, substr(text, a, 320) AS excerpt FROM s JOIN documents d ON d.doc_id = s.doc_id
    WHERE score > 0 ORDER BY score DESC, s.doc_id LIMIT 6"""
)
def search(spark, sf_dir):
    """The six best documents for two words."""
    t = F.lower("text")
    score = F.when(F.contains(t, F.lit("the and")), 18).otherwise(0) + F.when(F.contains(t, F.lit("the")), 3).otherwise(0) + F.when(F.contains(t, F.lit("and")), 3).otherwise(0)
    at = F.greatest(F.lit(1), F.instr(t, "the") - 70)
    docs = table(spark, sf_dir, "documents").select("doc_id", score.cast("long").alias("score"), F.substr("text", at, F.lit(320)).alias("excerpt"))
    return docs.where("score > 0").orderBy(F.desc("score"), "doc_id").limit(6)


@query(
    r"""WITH t AS (SELECT doc_id, unnest(string_split(trim(regexp_replace(regexp_replace(lower(text), '[^a-z0-9가-힣\s]', ' ', 'g'), '\s+', ' ', 'g')), ' ')) AS w FROM documents)
    SELECT w AS term, count(*) AS n FROM t WHERE length(w) > 1 GROUP BY w ORDER BY n DESC, w LIMIT 50"""
)
def top_terms(spark, sf_dir):
    """The fifty commonest words."""
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.lower("text"), r"[^a-z0-9가-힣\s]", " "), r"\s+", " "))
    words = table(spark, sf_dir, "documents").select(F.explode(F.split(plain, " ")).alias("term")).where("length(term) > 1")
    return words.groupBy("term").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "term").limit(50)


_FEATURES = r"""list_filter(string_split(trim(regexp_replace(regexp_replace(lower(coalesce({c}, '')), '[^a-z0-9가-힣\s]', ' ', 'g'), '\s+', ' ', 'g')), ' '), lambda w: length(w) > 1)"""
_FNV = """(SELECT f, n, CASE WHEN h >= 2147483648 THEN 4294967296 - h ELSE h END % 384 AS bucket FROM (
    SELECT f, n, list_reduce(list_prepend(CAST(2166136261 AS BIGINT), list_transform(string_split(f, ''), lambda c: CAST(unicode(c) AS BIGINT))), lambda h, c: (xor(h, c) * 16777619) & 4294967295) AS h FROM {t}))"""


def _features_sql(table: str, key: str) -> str:
    """Each row's features with their counts."""
    return f"""w AS (SELECT {key} AS id, {_FEATURES.format(c="text")} AS w FROM {table}),
    u AS (SELECT id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: concat(w[i], '_', w[i + 1])))) AS f FROM w)"""


@query(f"""WITH {_features_sql("documents", "doc_id")}, c AS (SELECT f, count(*) AS n FROM u GROUP BY f) SELECT bucket, CAST(sum(n) AS BIGINT) AS n FROM {_FNV.format(t="c")} GROUP BY bucket""")
def feature_hash_buckets(spark, sf_dir):
    """Counts of hashed word and word-pair features by bucket of 384."""
    return feature_buckets(table(spark, sf_dir, "documents"), "text", 384)


# --- pages ------------------------------------------------------------------

_PATH = r"CASE WHEN regexp_matches(regexp_replace(url, '[?#].*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/]+$') THEN concat(regexp_replace(url, '[?#].*$', ''), '/') ELSE regexp_replace(url, '[?#].*$', '') END"
_KEPT = r"list_filter(string_split(regexp_extract(regexp_replace(url, '#.*$', ''), '\?(.*)$', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(?:{d})(?:=|$)'))"


def _canon(drop: str, sort: bool, slash: str) -> str:
    kept = _KEPT.format(d=drop)
    kept = f"list_sort({kept})" if sort else kept
    made = f"CASE WHEN len({kept}) > 0 THEN concat({_PATH}, '?', array_to_string({kept}, '&')) ELSE {_PATH} END"
    return f"regexp_replace({made}, '{slash}', '')" if slash else made


_HOST = r"regexp_replace(regexp_replace(lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:\s]+)', 1)), '^www\.', ''), '\.$', '')"


@query(
    f"""SELECT page_id, {_HOST} AS host,
    {_canon('utm_[^=&]*|fbclid|gclid|mc_[^=&]*', False, '')} AS tracks,
    {_canon('utm_source|utm_medium|utm_campaign|utm_term|utm_content|gclid|fbclid', False, '/$')} AS market,
    {_canon('utm_source|utm_medium|utm_campaign|utm_term|utm_content|gclid|fbclid', True, '/+$')} AS suppression,
    regexp_replace({_PATH}, '/+$', '') AS no_query,
    regexp_replace(coalesce(list_extract(list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+([^?#]*)', 1), '/'), lambda p: p <> ''), -1), 'official update'), '[-_]+', ' ', 'g') AS title
    FROM pages"""
)
def canonical_urls(spark, sf_dir):
    """Canonical forms of every page's URL."""
    u = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id", ur.host(u).alias("host"), *[ur.canonical_url(u, p).alias(p) for p in ("tracks", "market", "suppression", "no_query")], ur.title_from_url(u).alias("title")
    )


@query(f"SELECT page_id, {_HOST} AS host FROM pages WHERE {_HOST} IN ('example.com', 'example.org') OR suffix({_HOST}, '.example.com') OR suffix({_HOST}, '.example.org')")
def publisher_allowlist(spark, sf_dir):
    """Pages whose host is an allowed domain or below one."""
    pages = table(spark, sf_dir, "pages").select("page_id", ur.host(F.col("url")).alias("host"))
    allowed = spark.createDataFrame([("example.com",), ("example.org",)], "domain string")
    suffixes = pages.withColumn("domain", F.explode(ur.host_suffixes(F.col("host"))))
    return suffixes.join(F.broadcast(allowed), "domain", "left_semi").select("page_id", "host").distinct()


@query(f"SELECT regexp_extract({_HOST}, '[^.]+$') AS zone, count(*) AS pages, count(DISTINCT {_HOST}) AS hosts FROM pages GROUP BY 1")
def independent_sources(spark, sf_dir):
    """Pages and distinct hosts by top-level domain."""
    h = ur.host(F.col("url"))
    return table(spark, sf_dir, "pages").groupBy(F.regexp_extract(h, "[^.]+$", 0).alias("zone")).agg(F.count("*").alias("pages"), F.count_distinct(h).alias("hosts"))


@query("""SELECT page_id, link, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS link FROM pages) GROUP BY ALL""")
def page_links(spark, sf_dir):
    """The links of every page."""
    found = table(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1))).alias("link"))
    return found.groupBy("page_id", "link").agg(F.count("*").alias("n"))


@query(r"""SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, regexp_extract(html, '<html lang="([a-z]+)"', 1) AS lang FROM pages""")
def page_metadata(spark, sf_dir):
    """Title and language of every page."""
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.regexp_extract("html", '<html lang="([a-z]+)"', 1).alias("lang"))


# --- events -----------------------------------------------------------------


def _events(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events")


@query("""SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""")
def latest_observation(spark, sf_dir):
    """The newest event of every user and type."""
    return ledger.best_per_key(_events(spark, sf_dir), ["user_id", "event_type"], F.desc("ts"), F.desc("event_id")).select("user_id", "event_type", "event_id", "value")


@query(
    """WITH c AS (SELECT *, lag(value) OVER w AS p, row_number() OVER w AS r FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id)),
    k AS (SELECT *, CASE WHEN r = 1 OR p IS DISTINCT FROM value THEN 1 ELSE 0 END AS ch FROM c)
    SELECT event_id, user_id, event_type, p AS previous, CAST(sum(ch) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS BIGINT) AS revision FROM k QUALIFY ch = 1"""
)
def observation_revisions(spark, sf_dir):
    """Events that change their key's value, with the revision number."""
    found = ledger.revisions(_events(spark, sf_dir), ["user_id", "event_type"], "value", F.asc("ts"), F.asc("event_id"))
    return found.select("event_id", "user_id", "event_type", "previous", "revision")


@query(
    """WITH a AS (SELECT user_id, event_type, arg_max(value, (ts, event_id)) AS v FROM events WHERE ts < TIMESTAMP '2024-01-15' GROUP BY ALL),
    b AS (SELECT user_id, event_type, arg_max(value, (ts, event_id)) AS v FROM events WHERE ts < TIMESTAMP '2024-01-22' GROUP BY ALL)
    SELECT b.user_id, b.event_type, b.v AS value, a.v AS previous, CASE WHEN a.user_id IS NULL THEN 'discovered' ELSE 'revised' END AS change
    FROM b LEFT JOIN a ON a.user_id = b.user_id AND a.event_type = b.event_type WHERE a.user_id IS NULL OR a.v IS DISTINCT FROM b.v"""
)
def change_events(spark, sf_dir):
    """What was discovered or revised between two snapshots."""
    def snapshot(day):
        rows = _events(spark, sf_dir).where(F.col("ts") < F.lit(day).cast("timestamp_ntz"))
        return rows.groupBy("user_id", "event_type").agg(F.max_by("value", F.struct("ts", "event_id")).alias("value"))

    found = ledger.change_events(snapshot("2024-01-15"), snapshot("2024-01-22"), ["user_id", "event_type"], "value")
    return found.select("user_id", "event_type", "value", "previous", "change")


@query(
    """WITH v AS (SELECT event_id, user_id, event_type, floor(value) AS version, ts FROM events)
    SELECT event_id, user_id, event_type, CAST(version AS BIGINT) AS version FROM v
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type, version ORDER BY ts, event_id) = 1"""
)
def version_set_dedup(spark, sf_dir):
    """The first event of every version; a version that returns isn't new."""
    rows = _events(spark, sf_dir).withColumn("version", F.floor("value"))
    return ledger.new_versions(rows, ["user_id", "event_type"], "version", F.asc("ts"), F.asc("event_id")).select("event_id", "user_id", "event_type", "version")


@query("SELECT 'events' AS track, strftime(ts, '%Y-%m') AS month, count(*) AS n FROM events GROUP BY ALL UNION ALL SELECT 'orders', strftime(o_orderdate, '%Y-%m'), count(*) FROM orders GROUP BY ALL")
def month_partitions(spark, sf_dir):
    """Rows by track and month."""
    month = lambda name, c, t: table(spark, sf_dir, t).groupBy(F.lit(name).alias("track"), F.date_format(c, "yyyy-MM").alias("month")).agg(F.count("*").alias("n"))
    return month("events", "ts", "events").unionByName(month("orders", "o_orderdate", "orders"))


@query("SELECT event_id, user_id FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY")
def retention_window(spark, sf_dir):
    """Events of the last seven days."""
    rows = _events(spark, sf_dir)
    return rows.where(F.col("ts") >= F.lit(_last(rows, "ts")) - F.expr("interval 7 days")).select("event_id", "user_id")


def _last(rows: DataFrame, ts: str):
    """The reference time of a table: one value, so that filters reach the scan."""
    return rows.agg(F.max(ts)).first()[0]


_STREAK_SQL = """WITH f AS (SELECT *, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS bad FROM events),
    i AS (SELECT *, sum(1 - bad) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS isl FROM f),
    s AS (SELECT *, CAST(sum(bad) OVER (PARTITION BY user_id, isl ORDER BY ts, event_id) AS BIGINT) AS streak FROM i)"""


def _streaks(spark, sf_dir):
    return ledger.streaks(_events(spark, sf_dir), ["user_id"], F.col("event_type") == "error", F.asc("ts"), F.asc("event_id"))


@query(_STREAK_SQL + " SELECT user_id, arg_max(streak, (ts, event_id)) AS streak, max(streak) AS longest, count(*) FILTER (bad = 1) AS failed, CASE WHEN arg_max(streak, (ts, event_id)) > 0 THEN 'failed' ELSE 'healthy' END AS state FROM s GROUP BY user_id")
def stream_health(spark, sf_dir):
    """Each stream's state, streak of failures and longest streak."""
    last = F.max_by("streak", F.struct("ts", "event_id"))
    return _streaks(spark, sf_dir).groupBy("user_id").agg(
        last.alias("streak"), F.max("streak").alias("longest"), F.count_if(F.expr("event_type = 'error'")).alias("failed"), F.when(last > 0, "failed").otherwise("healthy").alias("state")
    )


@query(_STREAK_SQL + " SELECT user_id, event_id, streak FROM s WHERE streak >= 3")
def watchdog_breaches(spark, sf_dir):
    """Events at which a stream has failed three times or more in a row."""
    return _streaks(spark, sf_dir).where("streak >= 3").select("user_id", "event_id", "streak")


@query("""SELECT user_id, count(*) FILTER (ts > m - INTERVAL 7 DAY) AS last_7d, count(*) FILTER (ts > m - INTERVAL 30 DAY) AS last_30d FROM events, (SELECT max(ts) AS m FROM events) GROUP BY user_id""")
def trailing_mentions(spark, sf_dir):
    """Events of the last 7 and 30 days by user."""
    rows = _events(spark, sf_dir)
    return ledger.trailing_counts(rows, ["user_id"], "ts", F.lit(_last(rows, "ts")))


_MOVES = """WITH m AS (SELECT *, lag(value) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS p FROM events),
    i AS (SELECT event_id, user_id, event_type, ts, (value / p - 1) * 100 AS pct FROM m WHERE p > 0 AND abs((value / p - 1) * 100) >= 1000)"""


def _moves(spark, sf_dir) -> DataFrame:
    from pyspark.sql import Window

    by = Window.partitionBy("user_id", "event_type").orderBy("ts", "event_id")
    rows = _events(spark, sf_dir).withColumn("p", F.lag("value").over(by)).where("p > 0")
    return rows.withColumn("pct", (F.col("value") / F.col("p") - 1) * 100).where("abs(pct) >= 1000")


@query(_MOVES + " SELECT event_id, user_id, event_type, round(pct, 4) AS pct, CASE WHEN pct > 0 THEN 'up' ELSE 'down' END AS dir FROM i")
def inflections(spark, sf_dir):
    """Changes of a thousand per cent and more."""
    return _moves(spark, sf_dir).select("event_id", "user_id", "event_type", F.round("pct", 4).alias("pct"), F.when(F.col("pct") > 0, "up").otherwise("down").alias("dir"))


@query(
    _MOVES + """, e AS (SELECT event_id AS pid, user_id, ts AS pts FROM events WHERE event_type = 'purchase'),
    j AS (SELECT i.event_id, i.user_id, e.pid, abs(epoch_us(i.ts) - epoch_us(e.pts)) AS distance FROM i JOIN e ON e.user_id = i.user_id AND e.pts BETWEEN i.ts - INTERVAL 3 DAY AND i.ts + INTERVAL 3 DAY)
    SELECT event_id, user_id, pid AS purchase_id, distance FROM j QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY distance, pid) = 1"""
)
def inflection_nearest_event(spark, sf_dir):
    """Each large change's nearest purchase of the user within three days."""
    left = _moves(spark, sf_dir).select("event_id", "user_id", "ts")
    right = _events(spark, sf_dir).where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("pts"))
    return joins.nearest_within(left, right, "user_id", "ts", "pts", 3, "event_id", "purchase_id").select("event_id", "user_id", "purchase_id", "distance")


@query()
def min_gap_inflections(spark, sf_dir):
    """Per user the largest changes over four days apart, at most twelve."""
    rows = _moves(spark, sf_dir).select("event_id", "user_id", F.col("ts").cast("date").alias("day"), F.abs("pct").alias("size"))
    return greedy.min_gap(rows, "user_id", "day", "size", "event_id", 4, 12)


@query("SELECT s.user_id, CAST(s.i AS INTEGER) AS sample, e.value FROM (SELECT user_id, i, a + ((z - a) * i) // 119 AS t FROM (SELECT user_id, min(epoch_us(ts)) AS a, max(epoch_us(ts)) AS z FROM events GROUP BY user_id), range(0, 120) r(i)) s ASOF JOIN (SELECT user_id, epoch_us(ts) AS t, arg_max(value, event_id) AS value FROM events GROUP BY ALL) e ON s.user_id = e.user_id AND s.t >= e.t")
def asof_value(spark, sf_dir):
    """Each user's value at 120 equally spaced times."""
    series = _events(spark, sf_dir).select("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"), "event_id", "value")
    ends = series.groupBy("user_id").agg(F.min("t").alias("a"), F.max("t").alias("z"))
    samples = ends.select("user_id", "a", "z", F.explode(F.sequence(F.lit(0), F.lit(119))).alias("sample"))
    samples = samples.select("user_id", "sample", F.expr("a + ((z - a) * sample) div 119").alias("t"))
    return joins.asof(samples, series, ["user_id"], "t", "value", "event_id").select("user_id", "sample", "value")


@query(
    """WITH d AS (SELECT user_id, event_type, CAST(ts AS DATE) AS d, avg(CAST(value AS DECIMAL(18,2))) AS v FROM events WHERE value > 0 GROUP BY ALL),
    b AS (SELECT *, v / first_value(v) OVER (PARTITION BY user_id, event_type ORDER BY d) * 100 AS x FROM d)
    SELECT event_type, d AS day, count(*) AS members, round(avg(x), 2) AS level FROM b GROUP BY ALL"""
)
def rebased_group_index(spark, sf_dir):
    """Mean of the users' daily values rebased to 100, by type and day."""
    from pyspark.sql import Window

    daily = _events(spark, sf_dir).where("value > 0").groupBy("user_id", "event_type", F.to_date("ts").alias("day")).agg((F.sum(F.col("value").cast("decimal(18,2)")) / F.count("*")).cast("double").alias("v"))
    based = daily.withColumn("x", F.col("v") / F.first("v").over(Window.partitionBy("user_id", "event_type").orderBy("day")) * 100)
    return based.groupBy("event_type", "day").agg(F.count("*").alias("members"), F.round(F.avg("x"), 2).alias("level"))


@query("""SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) % 10 AS k, count(*) AS n FROM events GROUP BY ALL""")
def json_props(spark, sf_dir):
    """Events by type and a number in their JSON."""
    return _events(spark, sf_dir).groupBy("event_type", (F.from_json("props", "k long")["k"] % 10).alias("k")).agg(F.count("*").alias("n"))


@query(
    """WITH b AS (SELECT count(*) FILTER (event_type = 'error') AS p0 FROM events), r AS (SELECT *, row_number() OVER (ORDER BY value DESC, event_id) AS r FROM events WHERE event_type = 'error')
    SELECT event_id, value FROM r, b WHERE r <= CASE WHEN p0 >= 50 THEN 8 WHEN p0 >= 20 THEN 16 ELSE 32 END"""
)
def adaptive_budget(spark, sf_dir):
    """The largest errors, as many as the backlog allows."""
    errors = _events(spark, sf_dir).where("event_type = 'error'")
    backlog = errors.count()
    return errors.orderBy(F.desc("value"), "event_id").limit(8 if backlog >= 50 else 16 if backlog >= 20 else 32).select("event_id", "value")


# --- orders, parts and registry ----------------------------------------------


@query(
    """WITH s AS (SELECT l_partkey, l_suppkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS total, count(*) AS n FROM lineitem GROUP BY ALL)
    SELECT l_partkey, l_suppkey, CAST(total AS DOUBLE) AS total, n, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY total DESC, l_suppkey) AS rank FROM s) WHERE rank <= 3"""
)
def topk_evidence(spark, sf_dir):
    """The three suppliers with most value of each part."""
    sums = table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_suppkey").agg(money("l_extendedprice").alias("total"), F.count("*").alias("n"))
    best = ledger.top_per_key(sums, ["l_partkey"], 3, F.desc("total"), F.asc("l_suppkey"), rank="rank")
    return best.withColumn("total", F.col("total").cast("double"))


WEIGHTS = {"volume": 40, "spread": 35, "returns": 25}


def _points_sql(weight: int, over: str, under: str) -> str:
    return f"(40 * {weight} * least(5 * {under}, greatest({under}, {over})) + {under}) // (2 * {under})"


@query(
    f"""WITH f AS (SELECT l_suppkey, count(*) AS n, count(DISTINCT l_partkey) AS parts, count(*) FILTER (l_returnflag = 'R') AS r FROM lineitem GROUP BY 1),
    s AS (SELECT l_suppkey, {_points_sql(40, "n", "200")} + {_points_sql(35, "parts", "150")} + {_points_sql(25, "(6 * n - 10 * r)", "n")} AS points FROM f)
    SELECT l_suppkey, greatest(0, least(1000, (points + 5) // 10)) / 10 AS score FROM s"""
)
def scorecard(spark, sf_dir):
    """Suppliers by a weighted score of three ratings from 1 to 5.  Points are rounded to
    hundredths and their sum to tenths, halves up and in whole numbers: as doubles,
    sums like 63.85 fall to either side."""
    facts = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n"), F.count_distinct("l_partkey").alias("parts"), F.count_if(F.expr("l_returnflag = 'R'")).alias("r"))
    rating = {"volume": ("n", "200L"), "spread": ("parts", "150L"), "returns": ("(6 * n - 10 * r)", "n")}
    points = " + ".join(f"(40 * {w} * least(5 * {under}, greatest({under}, {over})) + {under}) div (2 * {under})" for w, (over, under) in ((w, rating[k]) for k, w in WEIGHTS.items()))
    tenths = vl.clamp(F.expr(f"({points} + 5) div 10"), 0, 1000)
    return facts.select("l_suppkey", (tenths / 10).alias("score"))


@query(
    """WITH m AS (SELECT o_orderpriority AS priority, strftime(o_orderdate, '%Y-%m') AS month, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY ALL)
    SELECT priority, month, round(total, 2) AS total, round(total - lag(total) OVER w, 2) AS delta, CASE WHEN lag(total) OVER w IS NULL THEN 'new' WHEN total > lag(total) OVER w THEN 'up' WHEN total < lag(total) OVER w THEN 'down' ELSE 'flat' END AS trend FROM m WINDOW w AS (PARTITION BY priority ORDER BY month)"""
)
def score_delta_trend(spark, sf_dir):
    """Monthly totals by priority, with the change from the month before."""
    from pyspark.sql import Window

    m = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("priority"), F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(money("o_totalprice").cast("double").alias("total"))
    before = F.lag("total").over(Window.partitionBy("priority").orderBy("month"))
    trend = F.when(before.isNull(), "new").when(F.col("total") > before, "up").when(F.col("total") < before, "down").otherwise("flat")
    return m.select("priority", "month", F.round("total", 2).alias("total"), F.round(F.col("total") - before, 2).alias("delta"), trend.alias("trend"))


@query("SELECT p_brand, p_type, count(DISTINCT p_partkey) AS parts, count(*) AS lines, count(*) FILTER (l_returnflag = 'R') AS returned FROM part JOIN lineitem ON p_partkey = l_partkey GROUP BY ALL")
def opportunity_matrix(spark, sf_dir):
    """Parts and lines by brand and type."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("lines"), F.count_if(F.expr("l_returnflag = 'R'")).alias("returned"))
    joined = table(spark, sf_dir, "part").join(lines, F.col("p_partkey") == F.col("l_partkey"))
    return joined.groupBy("p_brand", "p_type").agg(F.count_distinct("p_partkey").alias("parts"), F.sum("lines").alias("lines"), F.sum("returned").alias("returned"))


@query(
    """SELECT r_name, n_name, count(o_orderkey) AS orders, CASE WHEN count(o_orderkey) = 0 THEN 'empty' WHEN date_diff('day', max(o_orderdate), (SELECT max(o_orderdate) FROM orders)) > 30 THEN 'stale' ELSE 'current' END AS status
    FROM region JOIN nation ON r_regionkey = n_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ROLLUP (r_name, n_name)"""
)
def rollup_status(spark, sf_dir):
    """Orders and status by region and nation, with totals."""
    orders = table(spark, sf_dir, "orders")
    by_customer = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.max("o_orderdate").alias("last"))
    dims = table(spark, sf_dir, "region").join(table(spark, sf_dir, "nation"), F.col("r_regionkey") == F.col("n_regionkey"))
    people = dims.join(table(spark, sf_dir, "customer"), F.col("c_nationkey") == F.col("n_nationkey"), "left").join(by_customer, "c_custkey", "left")
    total = F.coalesce(F.sum("n"), F.lit(0))
    age = F.datediff(F.lit(_last(orders, "o_orderdate")), F.max("last"))
    status = F.when(total == 0, "empty").when(age > 30, "stale").otherwise("current")
    return people.rollup("r_name", "n_name").agg(total.alias("orders"), status.alias("status"))


@query(
    """SELECT 'documents_duplicates' AS id, CASE WHEN v <= 0.02 THEN 'ok' WHEN v <= 0.1 THEN 'warn' ELSE 'fail' END AS status, v AS value FROM (SELECT round((count(*) - count(DISTINCT text)) / count(*), 4) AS v FROM documents)
    UNION ALL SELECT 'labels_coverage', CASE WHEN v >= 0.9 THEN 'ok' WHEN v >= 0.3 THEN 'warn' ELSE 'fail' END, v FROM (SELECT round((SELECT count(*) FROM labels) / (SELECT count(*) FROM documents), 4) AS v)
    UNION ALL SELECT 'events_errors', CASE WHEN v <= 0.1 THEN 'ok' WHEN v <= 0.3 THEN 'warn' ELSE 'fail' END, v FROM (SELECT round(count(*) FILTER (event_type = 'error') / count(*), 4) AS v FROM events)
    UNION ALL SELECT 'pages_unique', CASE WHEN v >= 0.99 THEN 'ok' WHEN v >= 0.9 THEN 'warn' ELSE 'fail' END, v FROM (SELECT round(count(DISTINCT url) / count(*), 4) AS v FROM pages)"""
)
def quality_checks(spark, sf_dir):
    """One row a check: its value and what the thresholds say."""
    def check(name, frame, value, ok, warn):
        v = frame.agg(F.round(value, 4).alias("value"))
        return v.select(F.lit(name).alias("id"), F.when(ok(F.col("value")), "ok").when(warn(F.col("value")), "warn").otherwise("fail").alias("status"), "value")

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    covered = docs.select(F.lit(0).alias("x")).unionByName(labels.select(F.lit(1).alias("x")))
    checks = [
        check("documents_duplicates", docs, (F.count("*") - F.count_distinct("text")) / F.count("*"), lambda v: v <= 0.02, lambda v: v <= 0.1),
        check("labels_coverage", covered, F.count_if(F.expr("x = 1")) / F.count_if(F.expr("x = 0")), lambda v: v >= 0.9, lambda v: v >= 0.3),
        check("events_errors", _events(spark, sf_dir), F.count_if(F.expr("event_type = 'error'")) / F.count("*"), lambda v: v <= 0.1, lambda v: v <= 0.3),
        check("pages_unique", table(spark, sf_dir, "pages"), F.count_distinct("url") / F.count("*"), lambda v: v >= 0.99, lambda v: v >= 0.9),
    ]
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


@query(
    """SELECT 'lineitem_order' AS contract, count(*) AS violations FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
    UNION ALL SELECT 'order_customer', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
    UNION ALL SELECT 'label_document', count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)
    UNION ALL SELECT 'document_shape', count(*) FROM documents WHERE NOT (length(text) >= 20 AND lang IN ('en', 'de', 'fr', 'es') AND n_chars > 0)"""
)
def contract_violations(spark, sf_dir):
    """Rows that break a contract, by contract."""
    t = lambda name: table(spark, sf_dir, name)
    orphans = lambda name, a, ka, b, kb: a.join(b.select(F.col(kb).alias(ka)).distinct(), ka, "left_anti").agg(F.count("*").alias("violations")).select(F.lit(name).alias("contract"), "violations")
    shape = vl.issues(length=F.length("text") >= 20, lang=F.col("lang").isin("en", "de", "fr", "es"), n_chars=F.col("n_chars") > 0)
    return (
        orphans("lineitem_order", t("lineitem"), "l_orderkey", t("orders"), "o_orderkey")
        .unionByName(orphans("order_customer", t("orders"), "o_custkey", t("customer"), "c_custkey"))
        .unionByName(orphans("label_document", t("labels"), "doc_id", t("documents"), "doc_id"))
        .unionByName(t("documents").where(F.size(shape) > 0).agg(F.count("*").alias("violations")).select(F.lit("document_shape").alias("contract"), "violations"))
    )


@query(
    """WITH s AS (SELECT o_orderpriority AS priority, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY 1)
    SELECT priority, round(total / sum(total) OVER () * 100, 4) AS share, round(total - lead(total) OVER (ORDER BY total DESC, priority), 2) AS gap FROM s"""
)
def share_and_gap(spark, sf_dir):
    """Each priority's share of all orders' value and its lead on the next."""
    from pyspark.sql import Window

    s = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("priority")).agg(money("o_totalprice").cast("double").alias("total"))
    order = Window.orderBy(F.desc("total"), "priority")  # a row a priority
    return s.select("priority", F.round(F.col("total") / F.sum("total").over(Window.partitionBy()) * 100, 4).alias("share"), F.round(F.col("total") - F.lead("total").over(order), 2).alias("gap"))


@query(
    """WITH y AS (SELECT o_orderpriority AS priority, year(o_orderdate) AS y, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS v FROM orders GROUP BY ALL)
    SELECT priority, round((power(arg_max(v, y) / arg_min(v, y), 1.0 / greatest(max(y) - min(y), 1)) - 1) * 100, 4) AS cagr FROM y GROUP BY priority"""
)
def cagr(spark, sf_dir):
    """Compound yearly growth of the orders' value by priority."""
    y = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("priority"), F.year("o_orderdate").alias("y")).agg(money("o_totalprice").cast("double").alias("v"))
    span = F.greatest(F.max("y") - F.min("y"), F.lit(1))
    return y.groupBy("priority").agg(F.round((F.pow(F.max_by("v", "y") / F.min_by("v", "y"), 1.0 / span) - 1) * 100, 4).alias("cagr"))


@query("SELECT CASE WHEN d <= 7 THEN 'fresh' WHEN d <= 30 THEN 'recent' ELSE 'stale' END AS badge, count(*) AS n, round(avg(exp(-d / 14.0)), 6) AS recency FROM (SELECT date_diff('day', o_orderdate, (SELECT max(o_orderdate) FROM orders)) AS d FROM orders) GROUP BY 1")
def freshness_badges(spark, sf_dir):
    """Orders by age before the last one, with their mean recency."""
    orders = table(spark, sf_dir, "orders")
    days = vl.age_days(F.col("o_orderdate"), F.lit(_last(orders, "o_orderdate")))
    return orders.select(days.alias("d")).groupBy(vl.freshness(F.col("d")).alias("badge")).agg(F.count("*").alias("n"), F.round(F.avg(vl.recency(F.col("d"))), 6).alias("recency"))


@query(
    """WITH p AS (SELECT CASE event_id % 6 WHEN 0 THEN strftime(ts, '%Y-%m-%d') WHEN 1 THEN strftime(ts, '%Y-%m') WHEN 2 THEN strftime(ts, '%Y') WHEN 3 THEN '''24.3' WHEN 4 THEN '''71' ELSE 'n/a' END AS raw, event_id FROM events)
    SELECT event_id, CASE event_id % 6 WHEN 0 THEN raw WHEN 1 THEN raw || '-01' WHEN 2 THEN raw || '-01-01' WHEN 3 THEN '2024-03-01' WHEN 4 THEN '1971-01-01' END AS effective_from,
    CASE event_id % 6 WHEN 0 THEN 'day' WHEN 1 THEN 'month' WHEN 2 THEN 'year' WHEN 3 THEN 'month' WHEN 4 THEN 'year' ELSE 'unknown' END AS "precision" FROM p"""
)
def partial_dates(spark, sf_dir):
    """Dates written in six ways, with their precision."""
    m = F.col("event_id") % 6
    raw = F.when(m == 0, F.date_format("ts", "yyyy-MM-dd")).when(m == 1, F.date_format("ts", "yyyy-MM")).when(m == 2, F.date_format("ts", "yyyy")).when(m == 3, "'24.3").when(m == 4, "'71").otherwise("n/a")
    d = _events(spark, sf_dir).select("event_id", vl.partial_date(raw).alias("d"))
    return d.select("event_id", F.col("d.from").alias("effective_from"), F.col("d.precision").alias("precision"))


@query(
    """WITH r AS (SELECT s_suppkey, s_nationkey, s_acctbal, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS r FROM supplier)
    SELECT n_name, s_suppkey, CAST(r AS INTEGER) AS place FROM r JOIN nation ON n_nationkey = s_nationkey WHERE r <= 6"""
)
def quota_selection(spark, sf_dir):
    """At most six suppliers of each nation, the largest balances first."""
    best = ledger.top_per_key(table(spark, sf_dir, "supplier"), ["s_nationkey"], 6, F.desc("s_acctbal"), F.asc("s_suppkey"), rank="place")
    return best.join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("s_nationkey")).select("n_name", "s_suppkey", "place")


@query(
    """SELECT c_custkey, coalesce(n, 0) AS orders, coalesce(last_status, 'none') AS last_status FROM customer LEFT JOIN
    (SELECT o_custkey, count(*) AS n, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS last_status FROM orders GROUP BY 1) ON o_custkey = c_custkey"""
)
def registry_enriched(spark, sf_dir):
    """Customers with their orders and the status of the last one."""
    facts = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("s"))
    return table(spark, sf_dir, "customer").select("c_custkey").join(facts, "c_custkey", "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("orders"), F.coalesce("s", F.lit("none")).alias("last_status"))


@query(
    """SELECT c.conv_id, c.turn, len(c.text) AS asked, len(n.text) AS answered FROM conversations c JOIN conversations n ON n.conv_id = c.conv_id AND n.turn = c.turn + 1 WHERE c.role = 'user' AND n.role = 'assistant'"""
)
def positional_replies(spark, sf_dir):
    """Questions with the answers that directly follow."""
    from pyspark.sql import Window

    by = Window.partitionBy("conv_id").orderBy("turn")
    c = table(spark, sf_dir, "conversations")
    both = c.withColumn("next_turn", F.lead("turn").over(by)).withColumn("next_role", F.lead("role").over(by)).withColumn("reply", F.lead("text").over(by))
    both = both.where("role = 'user' and next_role = 'assistant' and next_turn = turn + 1")
    return both.select("conv_id", "turn", F.length("text").cast("long").alias("asked"), F.length("reply").cast("long").alias("answered"))


@query("""SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL""")
def pricing_summary(spark, sf_dir):
    """Quantities and prices by flag and status."""
    rows = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(money("l_quantity").cast("double").alias("sum_qty"), money("l_extendedprice").cast("double").alias("sum_price"), F.count("*").alias("n"))


from quarryline.plans import feeds, merges, more, ordered, readings, records, scalars, state, texts, tracks, views  # noqa: E402, F401  they register their queries
