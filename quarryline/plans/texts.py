"""Registered queries on texts: quantities, claims, evidence lines, stories, gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarryline.functions import text as tx
from quarryline.functions import values as vl
from quarryline.operators import joins
from quarryline.operators.components import connected_components
from quarryline.operators.features import feature_buckets
from quarryline.plans.catalogue import NORM, _features_sql, _FNV, query, table
from quarryline.workspace import Workspace

# --- lines -------------------------------------------------------------------

_LINES = r"""list_filter(list_transform(string_split({c}, chr(10)), lambda x: trim(x)), lambda x: length(x) >= {n})"""


def lines(text, least: int):
    """Trimmed lines of at least so many characters."""
    return F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: F.length(x) >= least)


@query(
    f"""WITH l AS (SELECT doc_id, source, list_distinct({_LINES.format(c="text", n=20)}) AS l FROM documents), e AS (SELECT doc_id, source, unnest(l) AS line FROM l)
    SELECT sha256(line) AS span, count(*) AS documents, count(DISTINCT source) AS sources, min(doc_id) AS first FROM e GROUP BY line HAVING count(*) > 1"""
)
def evidence_spans(spark, sf_dir):
    """Lines that several documents hold: how many, of how many sources, and the first."""
    docs = table(spark, sf_dir, "documents")
    each = docs.select("doc_id", "source", F.explode(F.array_distinct(lines(F.col("text"), 20))).alias("line"))
    counted = each.groupBy("line").agg(F.count("*").alias("documents"), F.count_distinct("source").alias("sources"), F.min("doc_id").alias("first"))
    return counted.where("documents > 1").select(F.sha2("line", 256).alias("span"), "documents", "sources", "first")


@query(
    f"""WITH s AS (SELECT l.doc_id, l.quality, d.source, {_LINES.format(c="d.text", n=1)} AS l FROM labels l JOIN documents d ON d.doc_id = l.doc_id),
    c AS (SELECT doc_id, quality, unnest([{{'kind': 'fact', 'k': 1}}, {{'kind': 'implication', 'k': 2}}, {{'kind': 'decision', 'k': 3}}], recursive := true), l FROM s),
    x AS (SELECT doc_id, kind, quality, CASE WHEN len(l) >= k THEN sha256(l[k]) END AS span FROM c),
    e AS (SELECT source, sha256(unnest({_LINES.format(c="text", n=1)})) AS span FROM documents), n AS (SELECT span, count(DISTINCT source) AS sources FROM e GROUP BY span)
    SELECT x.doc_id, x.kind, x.span, coalesce(n.sources, 0) AS sources,
      CASE WHEN x.span IS NULL THEN 'missing' WHEN n.sources >= 2 OR x.quality = 1 THEN 'verified' ELSE 'partial' END AS status FROM x LEFT JOIN n ON n.span = x.span"""
)
def claim_graph(spark, sf_dir):
    """Three claims of every labelled document, each citing a line of it: verified
    if the line stands with two independent sources, or the label vouches for it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", lines(F.col("text"), 1).alias("l"))
    kinds = F.array(*[F.struct(F.lit(kind).alias("kind"), F.lit(k).alias("k")) for k, kind in enumerate(("fact", "implication", "decision"), 1)])
    claims = docs.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id").select("doc_id", "quality", "l", F.explode(kinds).alias("c"))
    claims = claims.select("doc_id", "quality", "c.kind", F.sha2(F.when(F.size("l") >= F.col("c.k"), F.element_at("l", F.greatest(F.lit(1), F.least(F.col("c.k"), F.size("l"))))), 256).alias("span"))
    cited = docs.select("source", F.explode("l").alias("line")).select("source", F.sha2("line", 256).alias("span"))
    known = cited.join(claims.select("span").distinct(), "span", "left_semi").groupBy("span").agg(F.count_distinct("source").alias("sources"))
    status = F.when(F.col("span").isNull(), "missing").when((F.col("sources") >= 2) | (F.col("quality") == 1), "verified").otherwise("partial")
    return claims.join(known, "span", "left").select("doc_id", "kind", "span", F.coalesce("sources", F.lit(0)).alias("sources"), status.alias("status"))


_STORY_SQL = f"""l AS (SELECT doc_id AS id, list_sort(list_distinct({_LINES.format(c="text", n=12)})) AS l FROM documents), k AS (SELECT min(id) AS id, l FROM l WHERE len(l) >= 2 GROUP BY l),
    m AS (SELECT k.id AS a, l.id AS b, len(l.l) AS shared FROM l JOIN k USING (l) WHERE l.id <> k.id),
    e AS (SELECT id, len(l) AS n, unnest(l) AS line FROM k),
    p AS (SELECT a.id AS a, b.id AS b, count(*) AS shared, least(any_value(a.n), any_value(b.n)) AS smaller FROM e a JOIN e b ON a.line = b.line AND a.id < b.id GROUP BY a.id, b.id),
    t AS (SELECT doc_id AS id, sha256({NORM.format(c="string_split(text, chr(10))[1]")}) AS title FROM documents WHERE length(string_split(text, chr(10))[1]) >= 28),
    lk AS (SELECT a, b FROM p WHERE shared >= 2 AND shared >= smaller * 0.6 UNION SELECT a, b FROM m UNION SELECT f.id, t.id FROM t JOIN (SELECT title, min(id) AS id FROM t GROUP BY title) f ON f.title = t.title AND f.id < t.id)"""


def _line_links(spark, sf_dir):
    """Links by shared lines between documents of different lines, and of the smallest with its copies."""
    docs = table(spark, sf_dir, "documents")
    return joins.overlapping_links(docs, "doc_id", lines(F.col("text"), 12), 0.6, 2)


@query(
    f"""WITH l AS (SELECT doc_id AS id, list_distinct({_LINES.format(c="text", n=12)}) AS l FROM documents), k AS (SELECT id, l FROM l WHERE len(l) >= 2),
    e AS (SELECT id, len(l) AS n, unnest(l) AS line FROM k),
    p AS (SELECT a.id AS a, b.id AS b, count(*) AS shared, least(any_value(a.n), any_value(b.n)) AS smaller FROM e a JOIN e b ON a.line = b.line AND a.id < b.id GROUP BY a.id, b.id)
    SELECT a, b, shared FROM p WHERE shared >= 2 AND shared >= smaller * 0.6"""
)
def shared_line_pairs(spark, sf_dir):
    """Pairs of documents that share two lines and three fifths of the shorter one's,
    copies among them."""
    docs = table(spark, sf_dir, "documents")
    found = joins.every_overlapping_pair(docs, "doc_id", lines(F.col("text"), 12), 0.6, 2)
    return found.select("a", "b", F.col("shared").cast("long").alias("shared"))


@query(
    f"""WITH RECURSIVE {_STORY_SQL}, g AS (SELECT a AS x, b AS y FROM lk UNION SELECT b, a FROM lk), w(node, root) AS (SELECT x, x FROM g UNION SELECT w.node, g.y FROM w JOIN g ON w.root = g.x),
    s AS (SELECT node, min(root) AS story FROM w GROUP BY node)
    SELECT story, count(*) AS documents, count(DISTINCT source) AS sources, CAST(arg_max(doc_id, (n_chars, -doc_id)) AS BIGINT) AS representative FROM s JOIN documents ON doc_id = node GROUP BY story"""
)
def story_merge(spark, sf_dir):
    """Documents merged into stories by equal long titles or shared lines, with the
    longest document to stand for each."""
    docs = table(spark, sf_dir, "documents").withColumn("title", F.element_at(F.split("text", "\n"), 1))
    titled = docs.where("length(title) >= 28").select("doc_id", F.sha2(tx.normalized(F.col("title")), 256).alias("title"))
    work = Workspace(spark, "stories")
    titled = work.keep(titled, "titles")  # a title may be a whole text, and is read twice
    least = titled.groupBy("title").agg(F.min("doc_id").alias("a"))
    pairs, copies = _line_links(spark, sf_dir)
    links = pairs.union(copies).union(titled.join(least, "title").where("a < doc_id").select("a", F.col("doc_id").alias("b")))
    found = connected_components(links, work)
    members = found.union(found.select(F.col("root").alias("node"), "root").distinct()).select(F.col("node").alias("doc_id"), F.col("root").alias("story"))
    best = F.max_by("doc_id", F.struct("n_chars", -F.col("doc_id")))
    return members.join(docs, "doc_id").groupBy("story").agg(F.count("*").alias("documents"), F.count_distinct("source").alias("sources"), best.alias("representative"))


@query(
    f"""WITH l AS (SELECT doc_id, unnest({_LINES.format(c="text", n=20)}) AS line FROM documents)
    SELECT doc_id, count(DISTINCT line) AS lines, CAST(least(64, count(DISTINCT line)) AS BIGINT) AS kept FROM l WHERE regexp_matches(line, '[0-9]') GROUP BY doc_id"""
)
def retained_lines(spark, sf_dir):
    """Distinct long lines with figures of each document, and how many of them are kept."""
    kept = F.filter(F.array_distinct(lines(F.col("text"), 20)), lambda x: x.rlike("[0-9]"))
    return table(spark, sf_dir, "documents").select("doc_id", F.size(kept).cast("long").alias("lines"), F.least(F.lit(64), F.size(kept)).cast("long").alias("kept")).where("lines > 0")


# --- quantities ----------------------------------------------------------------

_QUANTITIES = "[" + ", ".join("'" + p.replace("'", "''") + "'" for p in vl.QUANTITIES) + "]"


@query(
    "WITH q AS (" + " UNION ALL ".join(f"SELECT doc_id, unnest(regexp_extract_all(text, '{p}')) AS t FROM documents" for p in vl.QUANTITIES) + r""")
    SELECT DISTINCT doc_id, trim(regexp_replace(t, '\s+', ' ', 'g')) AS quantity FROM q"""
)
def quantities(spark, sf_dir):
    """Literal quantities of every document."""
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(vl.quantities(F.col("text"))).alias("quantity"))


@query(
    f"""WITH l AS (SELECT doc_id, unnest(list_distinct({_LINES.format(c="text", n=1)})) AS line FROM documents)
    SELECT doc_id, sha256(line) AS line, CAST(len(list_filter(list_distinct(regexp_extract_all(line, '\\d+(?:[.,]\\d+)*')), lambda x: NOT regexp_matches(x, '^(19|20)[0-9][0-9]$'))) AS BIGINT) AS figures
    FROM l WHERE len(list_filter(regexp_extract_all(line, '\\d+(?:[.,]\\d+)*'), lambda x: NOT regexp_matches(x, '^(19|20)[0-9][0-9]$'))) > 0 AND NOT contains(line, '@')"""
)
def quantified_lines(spark, sf_dir):
    """Lines with figures that aren't years, but for contact lines; each once a document."""
    each = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.array_distinct(lines(F.col("text"), 1))).alias("line"))
    figures = F.size(F.filter(vl.numbers(F.col("line")), lambda x: ~x.rlike("^(19|20)[0-9][0-9]$")))
    return each.where((figures > 0) & ~F.contains("line", F.lit("@"))).select("doc_id", F.sha2("line", 256).alias("line"), figures.cast("long").alias("figures"))


@query(
    """WITH p AS (SELECT c.conv_id, c.turn, list_distinct(regexp_extract_all(c.text, '\\d+(?:[.,]\\d+)*')) AS asked, n.text AS reply FROM conversations c
      JOIN conversations n ON n.conv_id = c.conv_id AND n.turn = c.turn + 1 WHERE c.role = 'user' AND n.role = 'assistant'),
    f AS (SELECT *, CAST(len(asked) AS BIGINT) AS figures, CAST(len(list_filter(asked, lambda x: contains(reply, x))) AS BIGINT) AS found FROM p)
    SELECT conv_id, turn, figures, found, CASE WHEN figures = 0 THEN 'invalid' WHEN found = figures THEN 'verified' WHEN found > 0 THEN 'partial' ELSE 'unverified' END AS status FROM f"""
)
def literal_verification(spark, sf_dir):
    """Figures of each question that its answer holds literally."""
    c = table(spark, sf_dir, "conversations")
    reply = c.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reply"))
    both = c.where("role = 'user'").join(reply, ["conv_id", "turn"]).withColumn("asked", vl.numbers(F.col("text")))
    both = both.withColumn("found", F.size(F.filter("asked", lambda x: F.contains("reply", x))).cast("long")).withColumn("figures", F.size("asked").cast("long"))
    status = F.when(F.col("figures") == 0, "invalid").when(F.col("found") == F.col("figures"), "verified").when(F.col("found") > 0, "partial").otherwise("unverified")
    return both.select("conv_id", "turn", "figures", "found", status.alias("status"))


@query(
    """WITH p AS (SELECT n.conv_id, n.turn, len(n.text) AS size, len(list_filter(list_distinct(regexp_extract_all(n.text, '\\d+(?:[.,]\\d+)*')), lambda x: NOT list_contains(regexp_extract_all(c.text, '\\d+(?:[.,]\\d+)*'), x))) AS loose
      FROM conversations c JOIN conversations n ON n.conv_id = c.conv_id AND n.turn = c.turn + 1 WHERE c.role = 'user' AND n.role = 'assistant')
    SELECT CASE WHEN size < 60 THEN 'short' WHEN loose > 0 THEN 'unsupported' ELSE 'accepted' END AS verdict, count(*) AS n FROM p GROUP BY 1"""
)
def accepted_outputs(spark, sf_dir):
    """Answers that pass the gates: long enough, and no figure that the question lacks."""
    c = table(spark, sf_dir, "conversations")
    asked = c.where("role = 'user'").select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("asked"))
    both = c.where("role = 'assistant'").join(asked, ["conv_id", "turn"])
    loose = F.size(vl.unsupported_numbers(F.col("text"), F.col("asked")))
    verdict = F.when(F.length("text") < 60, "short").when(loose > 0, "unsupported").otherwise("accepted")
    return both.groupBy(verdict.alias("verdict")).agg(F.count("*").alias("n"))


# --- terms and gates -------------------------------------------------------------


@query(
    """WITH t AS (SELECT item_id, array_to_string(string_split(text, ' ')[1:1 + item_id % 3], ' ') AS term FROM benchmark)
    SELECT d.doc_id, t.item_id FROM documents d JOIN t ON contains(d.text, t.term) WHERE t.term <> ''"""
)
def mentioned_names(spark, sf_dir):
    """Documents and the short names, of one to three words, that they contain."""
    names = table(spark, sf_dir, "benchmark").select("item_id", F.array_join(F.slice(F.split("text", " "), F.lit(1), (F.col("item_id") % 3 + 1).cast("int")), " ").alias("name"))
    return joins.mentions(table(spark, sf_dir, "documents"), "doc_id", F.col("text"), names, "item_id", "name")


BANNED = r"(?:worthless|stupid|idiot)"


@query(f"""SELECT doc_id FROM documents WHERE regexp_matches(lower(text), '{BANNED}') OR regexp_matches(lower(lang), '{BANNED}') OR regexp_matches(lower(source), '{BANNED}')""")
def banned_leaves(spark, sf_dir):
    """Rows of which any string leaf has a banned term; the leaves come from the schema."""
    docs = table(spark, sf_dir, "documents")
    leaves = F.array(*[F.lower(f.name) for f in docs.schema.fields if f.dataType.simpleString() == "string"])
    return docs.where(F.exists(leaves, lambda x: F.coalesce(x.rlike(BANNED), F.lit(False)))).select("doc_id")


@query("""SELECT k AS "key", count(*) AS n FROM (SELECT unnest(json_keys(props)) AS k FROM events) WHERE lower(k) IN ('k', 'secret', 'token') GROUP BY 1""")
def forbidden_keys(spark, sf_dir):
    """Forbidden keys that occur in the events' JSON."""
    keys = table(spark, sf_dir, "events").select(F.explode(F.json_object_keys("props")).alias("key"))
    return keys.where(F.lower("key").isin("k", "secret", "token")).groupBy("key").agg(F.count("*").alias("n"))


@query(
    """WITH t AS (SELECT doc_id, string_split(text, chr(10))[1] AS title, lower(string_split(text, chr(10))[1]) AS low FROM documents),
    p AS (SELECT doc_id, strpos(low, 'the ') AS alias, strpos(low, 'and ') AS verb, contains(low, ' or ') AS compared FROM t)
    SELECT doc_id, CAST(alias AS INTEGER) AS alias, CAST(verb AS INTEGER) AS verb FROM p WHERE alias > 0 AND (verb = 0 OR alias < verb) AND NOT compared"""
)
def headline_gate(spark, sf_dir):
    """Headlines in which the alias stands before the first action and nothing is compared."""
    low = F.lower(F.element_at(F.split("text", "\n"), 1))
    p = table(spark, sf_dir, "documents").select("doc_id", F.instr(low, "the ").alias("alias"), F.instr(low, "and ").alias("verb"), F.contains(low, F.lit(" or ")).alias("compared"))
    return p.where("alias > 0 and (verb = 0 or alias < verb) and not compared").select("doc_id", "alias", "verb")


@query(
    r"""WITH n AS (SELECT doc_id, array_to_string(string_split(string_split(text, chr(10))[1], ' ')[1:2], ' ') AS name FROM documents)
    SELECT doc_id, name FROM n WHERE regexp_matches(name, '^[A-Z][a-z]{1,14} [a-z]{2,14}$') AND NOT regexp_matches(lower(name), '^(the|and|of|in) ')"""
)
def plausible_names(spark, sf_dir):
    """First two words of documents that may be a name."""
    name = F.array_join(F.slice(F.split(F.element_at(F.split("text", "\n"), 1), " "), 1, 2), " ")
    n = table(spark, sf_dir, "documents").select("doc_id", name.alias("name"))
    return n.where(F.col("name").rlike("^[A-Z][a-z]{1,14} [a-z]{2,14}$") & ~F.lower("name").rlike("^(the|and|of|in) "))


@query(
    f"""WITH l AS (SELECT d.doc_id, unnest({_LINES.format(c="d.text", n=12)}) AS line FROM documents d), b AS (SELECT item_id, string_split(text, ' ')[1] || ' ' || string_split(text, ' ')[2] AS head FROM benchmark)
    SELECT b.item_id, count(*) AS lines, count(DISTINCT doc_id) AS documents FROM l JOIN b ON starts_with(line, b.head) GROUP BY b.item_id"""
)
def evidence_lines(spark, sf_dir):
    """Lines that begin with an entity's name, by entity."""
    each = table(spark, sf_dir, "documents").select("doc_id", F.explode(lines(F.col("text"), 12)).alias("line"))
    heads = table(spark, sf_dir, "benchmark").select("item_id", F.array_join(F.slice(F.split("text", " "), 1, 2), " ").alias("head"))
    met = each.withColumn("first", F.element_at(F.split("line", " "), 1)).join(heads.withColumn("first", F.element_at(F.split("head", " "), 1)), "first")
    return met.where(F.startswith("line", F.col("head"))).groupBy("item_id").agg(F.count("*").alias("lines"), F.count_distinct("doc_id").alias("documents"))


@query(
    """WITH t AS (SELECT doc_id, lang, lower(text) AS t FROM documents), h AS (SELECT doc_id, CAST(contains(t, 'the ') AS INT) + CAST(contains(t, 'and ') AS INT) + CAST(contains(t, 'of ') AS INT) + CAST(contains(t, 'for ') AS INT) AS found FROM t)
    SELECT doc_id, found, found >= 2 AS verified FROM h"""
)
def half_of_terms(spark, sf_dir):
    """Documents verified by at least half of the required terms."""
    t = F.lower("text")
    found = sum((F.contains(t, F.lit(x)).cast("int") for x in ("the ", "and ", "of ", "for ")), F.lit(0))
    return table(spark, sf_dir, "documents").select("doc_id", found.alias("found"), (found >= 2).alias("verified"))


@query(
    """WITH f AS (SELECT doc_id, text, length(text) AS n, strpos(substr(text, 9), '.') AS p FROM documents)
    SELECT doc_id, CAST(CASE WHEN p = 0 THEN n ELSE p + 8 END AS BIGINT) AS lead, CAST(CASE WHEN p = 0 THEN 0 ELSE n - p - 8 END AS BIGINT) AS detail FROM f"""
)
def lead_and_detail(spark, sf_dir):
    """Characters of each text up to the first full stop after eight, and of the rest."""
    at = F.instr(F.substring("text", 9, 1 << 30), ".")
    n = F.length("text")
    return table(spark, sf_dir, "documents").select("doc_id", F.when(at == 0, n).otherwise(at + 8).cast("long").alias("lead"), F.when(at == 0, 0).otherwise(n - at - 8).cast("long").alias("detail"))


@query(
    """WITH c AS (SELECT doc_id, text, strpos(substr(text, 21), ' | ') AS p FROM documents)
    SELECT doc_id, CAST(CASE WHEN p = 0 THEN length(text) ELSE p + 19 END AS BIGINT) AS kept FROM c"""
)
def residue_cut(spark, sf_dir):
    """Characters of each text that stay when it is cut at the first junk mark after twenty."""
    at = F.instr(F.substring("text", 21, 1 << 30), " | ")
    return table(spark, sf_dir, "documents").select("doc_id", F.when(at == 0, F.length("text")).otherwise(at + 19).cast("long").alias("kept"))


@query(
    """WITH l AS (SELECT doc_id, string_split(text, ' | ') AS f FROM documents)
    SELECT doc_id, CAST(len(f) AS BIGINT) AS fields, f[1] AS first, f[len(f)] AS last FROM l WHERE len(f) >= 5"""
)
def delimited_rows(spark, sf_dir):
    """Delimited records: their fields, the first and the last."""
    f = table(spark, sf_dir, "documents").select("doc_id", F.split("text", r" \| ").alias("f")).where("size(f) >= 5")
    return f.select("doc_id", F.size("f").cast("long").alias("fields"), F.element_at("f", 1).alias("first"), F.element_at("f", -1).alias("last"))


_NORM2 = r"trim(regexp_replace(coalesce({c}, ''), '\s+', ' ', 'g'))"


@query(
    rf"""WITH t AS (SELECT page_id, {_NORM2.format(c="regexp_extract(html, '<title>([^<]*)</title>', 1)")} AS title FROM pages)
    SELECT page_id, substr(regexp_replace(regexp_replace(lower(title), '[^a-z0-9\p{{L}}]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 120) AS slug,
      regexp_replace(lower(title), '[^\p{{L}}\p{{N}}]+', '', 'g') AS claim_key, CASE WHEN length(title) > 40 THEN concat(substr(title, 1, 40), '...') ELSE title END AS clipped,
      substr(sha256(title), 1, 16) AS short_hash FROM t"""
)
def title_keys(spark, sf_dir):
    """Slug, claim key, clipped form and short hash of every page's title."""
    t = table(spark, sf_dir, "pages").select("page_id", tx.clean(F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("title"))
    title = F.col("title")
    return t.select("page_id", tx.slug(title).alias("slug"), tx.claim_key(title).alias("claim_key"), tx.clip(title, 40, "...").alias("clipped"), tx.short_hash(16, title).alias("short_hash"))


@query(
    r"""SELECT page_id, regexp_extract(url, '/([0-9]+)', 1) AS number, regexp_extract(url, '[?&]page=([0-9]+)', 1) AS page,
      CASE WHEN regexp_extract(url, '/([0-9]+)', 1) <> '' THEN concat('path:', regexp_extract(url, '/([0-9]+)', 1)) WHEN regexp_extract(url, '[?&]id=([^&#]+)', 1) <> '' THEN concat('query:', regexp_extract(url, '[?&]id=([^&#]+)', 1)) ELSE '' END AS identity FROM pages"""
)
def store_identity(spark, sf_dir):
    """Identity of a page from its path's number, else from its query."""
    u = F.col("url")
    path, query_id = F.regexp_extract(u, "/([0-9]+)", 1), F.regexp_extract(u, "[?&]id=([^&#]+)", 1)
    identity = F.when(path != "", F.concat(F.lit("path:"), path)).when(query_id != "", F.concat(F.lit("query:"), query_id)).otherwise("")
    return table(spark, sf_dir, "pages").select("page_id", path.alias("number"), F.regexp_extract(u, "[?&]page=([0-9]+)", 1).alias("page"), identity.alias("identity"))


# --- cosines ---------------------------------------------------------------------


@query(
    f"""WITH {_features_sql("benchmark", "item_id")}, c AS (SELECT id, f, count(*) AS n FROM u GROUP BY ALL), d AS (SELECT DISTINCT f, 1 AS n FROM c),
    m AS (SELECT f, bucket FROM {_FNV.format(t="d")}), v AS (SELECT id, bucket, sum(n) AS x FROM c JOIN m USING (f) GROUP BY ALL), z AS (SELECT id, sqrt(sum(x * x)) AS z FROM v GROUP BY id),
    p AS (SELECT a.id AS a, b.id AS b, sum(a.x * b.x) AS dot FROM v a JOIN v b ON a.bucket = b.bucket AND a.id < b.id GROUP BY a.id, b.id)
    SELECT a, b, round(dot / (za.z * zb.z), 6) AS cosine FROM p JOIN z za ON za.id = a JOIN z zb ON zb.id = b WHERE dot / (za.z * zb.z) >= 0.3"""
)
def feature_hash_cosine(spark, sf_dir):
    """Pairs of items whose hashed words and word pairs have a cosine of .3 or more."""
    v = feature_buckets(table(spark, sf_dir, "benchmark"), "text", 384, "item_id").toDF("id", "bucket", "x")
    v = Workspace(spark, "features").keep(v, "vectors")
    z = v.groupBy("id").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("z"))
    other = v.select(F.col("id").alias("b"), "bucket", F.col("x").alias("y"))
    dots = v.withColumnRenamed("id", "a").join(other, "bucket").where("a < b").groupBy("a", "b").agg(F.sum(F.col("x") * F.col("y")).alias("dot"))
    full = dots.join(z.withColumnsRenamed({"id": "a", "z": "za"}), "a").join(z.withColumnsRenamed({"id": "b", "z": "zb"}), "b").withColumn("cosine", F.col("dot") / (F.col("za") * F.col("zb")))
    return full.where("cosine >= 0.3").select("a", "b", F.round("cosine", 6).alias("cosine"))


@query(
    """WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings) SELECT q.vec_id AS query_id, v.vec_id AS id, round(list_cosine_similarity(q.e, v.e), 6) AS cosine
    FROM v q JOIN v ON v.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0 AND list_cosine_similarity(q.e, v.e) >= 0.25"""
)
def embedding_cosine(spark, sf_dir):
    """Vectors within a cosine of .25 of every twentieth one."""
    vectors = table(spark, sf_dir, "embeddings")
    found = joins.similar_vectors(vectors.where("vec_id % 20 = 0"), vectors, "vec_id", "embedding", 0.25)
    return found.select("query_id", "id", F.round("cosine", 6).alias("cosine"))
