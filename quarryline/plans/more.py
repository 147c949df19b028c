"""Further registered queries: series, sets, ranks, budgets and statuses."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarryline.functions import values as vl
from quarryline.operators import ledger
from quarryline.plans.catalogue import money, query, table


@query(
    """WITH o AS (SELECT user_id, CAST(ts AS DATE) AS day, max(value) AS p FROM events WHERE event_id % 3 <> 0 GROUP BY ALL),
    n AS (SELECT user_id, CAST(ts AS DATE) AS day, max(value) AS p FROM events WHERE event_id % 3 = 0 GROUP BY ALL)
    SELECT coalesce(o.user_id, n.user_id) AS user_id, coalesce(o.day, n.day) AS day, coalesce(n.p, o.p) AS p FROM o FULL JOIN n ON o.user_id = n.user_id AND o.day = n.day"""
)
def merged_series(spark, sf_dir):
    """Two daily series of each user; the newer source wins where both have a day."""
    daily = lambda where: table(spark, sf_dir, "events").where(where).groupBy("user_id", F.to_date("ts").alias("day")).agg(F.max("value").alias("p"))
    return ledger.merge_series(daily("event_id % 3 <> 0"), daily("event_id % 3 = 0"), ["user_id", "day"], "p")


@query(
    """SELECT l.doc_id, coalesce(d.source, s.source, 'none') AS origin, CASE WHEN d.doc_id IS NOT NULL THEN 'id' WHEN s.source IS NOT NULL THEN 'fallback' ELSE 'none' END AS matched_by
    FROM labels l LEFT JOIN (SELECT doc_id, source FROM documents WHERE doc_id % 2 = 0) d ON d.doc_id = l.doc_id
    LEFT JOIN (SELECT 'src' || CAST(page_id AS VARCHAR) AS source, page_id FROM pages) s ON s.page_id = l.doc_id % 400"""
)
def fallback_key_join(spark, sf_dir):
    """Labels by document id, else by a second key; the first match wins."""
    labels = table(spark, sf_dir, "labels").select("doc_id", (F.col("doc_id") % 400).alias("page_id"))
    first = table(spark, sf_dir, "documents").where("doc_id % 2 = 0").select("doc_id", F.col("source").alias("a"))
    second = table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("src"), F.col("page_id").cast("string")).alias("b"))
    both = labels.join(first, "doc_id", "left").join(second, "page_id", "left")
    by = F.when(F.col("a").isNotNull(), "id").when(F.col("b").isNotNull(), "fallback").otherwise("none")
    return both.select("doc_id", F.coalesce("a", "b", F.lit("none")).alias("origin"), by.alias("matched_by"))


@query(
    """WITH e AS (SELECT DISTINCT l_suppkey AS a, l_partkey AS b FROM lineitem), core AS (SELECT s_suppkey FROM supplier WHERE s_nationkey = 7),
    t AS (SELECT * FROM e WHERE a IN (SELECT s_suppkey FROM core)) SELECT p_partkey, p_brand FROM part WHERE p_partkey IN (SELECT b FROM t)"""
)
def graph_scope(spark, sf_dir):
    """Parts on an edge with a supplier of one nation: two semi joins."""
    edges = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("s_suppkey"), F.col("l_partkey").alias("p_partkey"))
    core = table(spark, sf_dir, "supplier").where("s_nationkey = 7").select("s_suppkey")
    touching = edges.join(core, "s_suppkey", "left_semi")
    return table(spark, sf_dir, "part").join(touching, "p_partkey", "left_semi").select("p_partkey", "p_brand")


@query(
    """WITH u AS (SELECT user_id, list_sort(list_distinct(list(event_type) FILTER (ts < TIMESTAMP '2024-01-16'))) AS a, list_sort(list_distinct(list(event_type) FILTER (ts >= TIMESTAMP '2024-01-16'))) AS b FROM events GROUP BY user_id)
    SELECT user_id, array_to_string(list_sort(list_intersect(coalesce(a, []), coalesce(b, []))), ',') AS kept, array_to_string(list_sort(list_filter(coalesce(a, []), lambda x: NOT list_contains(coalesce(b, []), x))), ',') AS gone FROM u"""
)
def set_changes(spark, sf_dir):
    """Event types that each user kept and gave up between two half months."""
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    u = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_set(F.when(early, F.col("event_type"))).alias("a"), F.collect_set(F.when(~early, F.col("event_type"))).alias("b"))
    joined = lambda c: F.array_join(F.array_sort(c), ",")
    return u.select("user_id", joined(F.array_intersect("a", "b")).alias("kept"), joined(F.array_except("a", "b")).alias("gone"))


@query(
    """WITH s AS (SELECT p_type AS type, count(*) AS n FROM part GROUP BY 1)
    SELECT type, n, round(sum(n) OVER (ORDER BY n DESC, type) / sum(n) OVER () * 360, 4) AS angle, CAST(round(least(n / max(n) OVER (), 1) * 100) AS BIGINT) AS relative FROM s"""
)
def running_angles(spark, sf_dir):
    """Parts by type with the running share of a circle and the size relative to the largest."""
    s = table(spark, sf_dir, "part").groupBy(F.col("p_type").alias("type")).agg(F.count("*").alias("n"))
    run, whole = Window.orderBy(F.desc("n"), "type").rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy()  # a row a type
    angle = F.round(F.sum("n").over(run) / F.sum("n").over(whole) * 360, 4)
    return s.select("type", "n", angle.alias("angle"), F.round(F.least(F.col("n") / F.max("n").over(whole), F.lit(1)) * 100).cast("long").alias("relative"))


@query(
    """SELECT o_orderkey, CAST(rank AS INTEGER) AS rank FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderpriority, o_orderdate DESC, o_custkey, o_orderkey) AS rank FROM orders) WHERE rank <= 12"""
)
def shortlist(spark, sf_dir):
    """The twelve first orders by five keys, ranked."""
    best = table(spark, sf_dir, "orders").orderBy(F.desc("o_totalprice"), "o_orderpriority", F.desc("o_orderdate"), "o_custkey", "o_orderkey").limit(12)
    order = Window.orderBy(F.desc("o_totalprice"), "o_orderpriority", F.desc("o_orderdate"), "o_custkey", "o_orderkey")  # twelve rows
    return best.select("o_orderkey", F.row_number().over(order).alias("rank"))


@query("SELECT event_id, user_id FROM events WHERE event_type = 'view' ORDER BY ts DESC, event_id DESC LIMIT 30 OFFSET 30")
def feed_page(spark, sf_dir):
    """The second page of thirty rows of a feed, newest first."""
    return table(spark, sf_dir, "events").where("event_type = 'view'").orderBy(F.desc("ts"), F.desc("event_id")).offset(30).limit(30).select("event_id", "user_id")


@query(
    """WITH c AS (SELECT user_id, event_type, count(*) FILTER (event_id % 2 = 0) AS a, count(*) FILTER (event_id % 2 = 1) AS b FROM events GROUP BY ALL)
    SELECT user_id, event_type AS label, a AS before, b AS after, b - a AS change FROM c WHERE a <> b"""
)
def metric_diff(spark, sf_dir):
    """Labels whose metric differs between two snapshots, with the change."""
    e = table(spark, sf_dir, "events").groupBy("user_id", F.col("event_type").alias("label")).agg(F.count_if(F.expr("event_id % 2 = 0")).alias("before"), F.count_if(F.expr("event_id % 2 = 1")).alias("after"))
    return e.where("before <> after").withColumn("change", F.col("after") - F.col("before"))


@query(
    "SELECT user_id, " + ", ".join(f"count(*) FILTER (event_type = '{t}') AS {t}" for t in ("click", "error", "purchase", "signup", "view")) + " FROM events GROUP BY user_id"
)
def type_matrix(spark, sf_dir):
    """Events of each user by type, as columns."""
    kinds = ["click", "error", "purchase", "signup", "view"]
    return table(spark, sf_dir, "events").groupBy("user_id").pivot("event_type", kinds).count().na.fill(0)


@query(
    """SELECT source, CAST(round(avg(100.0 * (CAST(text IS NOT NULL AND length(text) >= 100 AS INT) + CAST(lang IS NOT NULL AS INT) + CAST(regexp_matches(text, '[0-9]') AS INT) + CAST(contains(text, chr(10)) AS INT)) / 4), 2) AS DOUBLE) AS coverage FROM documents GROUP BY source"""
)
def coverage_score(spark, sf_dir):
    """Mean share of a checklist that a source's documents meet, in per cent."""
    missing = vl.issues(length=F.length("text") >= 100, lang=F.col("lang").isNotNull(), number=F.col("text").rlike("[0-9]"), lines=F.contains("text", F.lit("\n")))
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.round(F.avg(100.0 * (4 - F.size(missing)) / 4), 2).alias("coverage"))


@query(
    """WITH s AS (SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus, lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS p,
      row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders)
    SELECT o_custkey, o_orderkey, CASE WHEN r = 1 THEN 'baseline' WHEN p <> o_orderstatus THEN 'changed' ELSE 'unchanged' END AS status FROM s
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""
)
def price_change_status(spark, sf_dir):
    """The last run of each customer and whether it differs from the one before."""
    by = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    rows = table(spark, sf_dir, "orders").withColumn("p", F.lag("o_orderstatus").over(by))
    status = F.when(F.col("p").isNull(), "baseline").when(F.col("p") != F.col("o_orderstatus"), "changed").otherwise("unchanged")
    return ledger.best_per_key(rows.withColumn("status", status), ["o_custkey"], F.desc("o_orderdate"), F.desc("o_orderkey")).select("o_custkey", "o_orderkey", "status")


@query(
    """WITH b AS (SELECT p_brand, p_type, p_size, avg(CAST(p_retailprice AS DECIMAL(18,2))) AS price, count(*) AS n FROM part GROUP BY ALL)
    SELECT x.p_brand AS a, y.p_brand AS b, x.p_type AS type, x.p_size AS size, CASE WHEN y.price = 0 THEN NULL ELSE round(x.price / y.price - 1, 4) END AS delta FROM b x JOIN b y ON x.p_type = y.p_type AND x.p_size = y.p_size AND x.p_brand < y.p_brand"""
)
def comparable_metrics(spark, sf_dir):
    """Price differences of brands, only where type and size are the same."""
    price = F.sum(F.col("p_retailprice").cast("decimal(18,2)")).cast("double") / F.count("*")
    b = table(spark, sf_dir, "part").groupBy("p_brand", "p_type", "p_size").agg(price.alias("price"))
    x, y = b.select("p_type", "p_size", F.col("p_brand").alias("a"), F.col("price").alias("pa")), b.select("p_type", "p_size", F.col("p_brand").alias("b"), F.col("price").alias("pb"))
    delta = F.when(F.col("pb") != 0, F.round(F.col("pa") / F.col("pb") - 1, 4))
    return x.join(y, ["p_type", "p_size"]).where("a < b").select("a", "b", F.col("p_type").alias("type"), F.col("p_size").alias("size"), delta.alias("delta"))


@query(
    """SELECT event_id, last_value(CASE WHEN value >= 50 THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS verified FROM events"""
)
def retained_value(spark, sf_dir):
    """Each user's last value that passed a check, at every event."""
    by = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return table(spark, sf_dir, "events").select("event_id", F.last(F.when(F.col("value") >= 50, F.col("value")), ignorenulls=True).over(by).alias("verified"))


@query(
    """SELECT c.c_custkey FROM (SELECT *, row_number() OVER (ORDER BY c_custkey) - 1 AS i FROM customer) c, (SELECT count(*) AS n FROM customer) t, (SELECT CAST(date_diff('day', DATE '1970-01-01', max(CAST(ts AS DATE))) AS BIGINT) AS d FROM events) e
    WHERE ((i - d * 24) % n + n) % n < 24"""
)
def rotating_slice(spark, sf_dir):
    """Twenty-four of all customers, another slice each day."""
    people = table(spark, sf_dir, "customer").select("c_custkey")
    n = people.count()
    day = table(spark, sf_dir, "events").agg(F.datediff(F.max("ts"), F.lit("1970-01-01").cast("date"))).first()[0]
    start = (day * 24) % n
    first = ledger.slice_of(people, "c_custkey", start, 24)
    return first if start + 24 <= n else first.unionByName(ledger.slice_of(people, "c_custkey", 0, 24 - (n - start)))  # around the end


@query(
    """SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN 'blocked' WHEN s_nationkey % 5 = 0 THEN 'credential-gated' WHEN s_acctbal > 5000 THEN 'executed' ELSE 'scheduled' END AS gate FROM supplier"""
)
def connector_gates(spark, sf_dir):
    """Each source's gate: the first rule that holds."""
    gate = F.when(F.col("s_acctbal") < 0, "blocked").when(F.col("s_nationkey") % 5 == 0, "credential-gated").when(F.col("s_acctbal") > 5000, "executed").otherwise("scheduled")
    return table(spark, sf_dir, "supplier").select("s_suppkey", gate.alias("gate"))


@query("SELECT source, CAST(sum(strlen(text)) AS BIGINT) AS bytes, sum(strlen(text)) > 131072 AS migrate FROM documents GROUP BY source")
def size_trigger(spark, sf_dir):
    """Bytes of each source's texts, and whether they pass a limit."""
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.sum(F.octet_length("text")).alias("bytes"), (F.sum(F.octet_length("text")) > 131072).alias("migrate"))


@query(
    """WITH r AS (SELECT event_type, min(value) AS lo, max(value) AS hi FROM events GROUP BY 1), s AS (SELECT *, (hi - lo) / 5 AS raw FROM r),
    m AS (SELECT *, power(10, floor(log10(raw))) AS mag FROM s)
    SELECT event_type, lo, hi, CASE WHEN raw / mag <= 1 THEN 1 WHEN raw / mag <= 2 THEN 2 WHEN raw / mag <= 5 THEN 5 ELSE 10 END * mag AS step FROM m WHERE raw > 0"""
)
def axis_ticks(spark, sf_dir):
    """Range of each type's values and a round step for five ticks."""
    r = table(spark, sf_dir, "events").groupBy("event_type").agg(F.min("value").alias("lo"), F.max("value").alias("hi")).withColumn("raw", (F.col("hi") - F.col("lo")) / 5).where("raw > 0")
    r = r.withColumn("mag", F.pow(F.lit(10.0), F.floor(F.log10("raw"))))
    q = F.col("raw") / F.col("mag")
    return r.select("event_type", "lo", "hi", (F.when(q <= 1, 1).when(q <= 2, 2).when(q <= 5, 5).otherwise(10) * F.col("mag")).alias("step"))


@query(
    """WITH m AS (SELECT CAST(user_id % 10 AS BIGINT) AS stream, strftime(ts, '%Y-%m-%d') AS part, count(*) AS n FROM events GROUP BY ALL)
    SELECT stream, CAST(sum(n) AS BIGINT) AS cumulative, count(*) AS parts, min(part) AS first, max(part) AS last FROM m GROUP BY stream"""
)
def manifest(spark, sf_dir):
    """Rows and partitions of each stream's ledger."""
    m = table(spark, sf_dir, "events").groupBy((F.col("user_id") % 10).alias("stream"), F.date_format("ts", "yyyy-MM-dd").alias("part")).agg(F.count("*").alias("n"))
    return m.groupBy("stream").agg(F.sum("n").alias("cumulative"), F.count("*").alias("parts"), F.min("part").alias("first"), F.max("part").alias("last"))


@query(
    """WITH t AS (SELECT c_mktsegment AS segment, n_name AS nation, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS total FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL)
    SELECT segment, nation, total, CAST(r AS INTEGER) AS r FROM (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY total DESC, nation) AS r FROM t) WHERE r <= 2"""
)
def top_two_per_group(spark, sf_dir):
    """The two nations with the largest balances of each segment."""
    sums = table(spark, sf_dir, "customer").groupBy("c_mktsegment", "c_nationkey").agg(money("c_acctbal").alias("t"))
    named = sums.join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey")).select(F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("nation"), F.col("t").cast("double").alias("total"))
    return ledger.top_per_key(named, ["segment"], 2, F.desc("total"), F.asc("nation"), rank="r")


@query(
    """WITH e AS (SELECT event_id, user_id, epoch_us(ts) AS t FROM events WHERE event_type = 'signup'), p AS (SELECT event_id AS pid, user_id, epoch_us(ts) AS pt FROM events WHERE event_type = 'view')
    SELECT e.event_id, e.user_id, arg_min(pid, (abs(t - pt), pt, pid)) AS nearest FROM e JOIN p ON p.user_id = e.user_id GROUP BY ALL"""
)
def nearest_point(spark, sf_dir):
    """The view nearest in time to each signup: the last before or the first after."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    rows = table(spark, sf_dir, "events").where("event_type in ('signup', 'view')").withColumn("t", micros)
    # within one time, views stand before signups for the look back and after them for
    # the look ahead; of equal times the smallest id counts
    first = rows.withColumn("id0", F.min(F.when(F.col("event_type") == "view", F.col("event_id"))).over(Window.partitionBy("user_id", "t")))
    point = F.when(F.col("event_type") == "view", F.struct(F.col("t").alias("t"), F.col("id0").alias("id")))
    by = Window.partitionBy("user_id").orderBy("t")
    back = F.last(point, ignorenulls=True).over(by.rangeBetween(Window.unboundedPreceding, 0))
    # the look ahead is a look back in the other order, since that frame only grows
    later = Window.partitionBy("user_id").orderBy(F.desc("t"))
    ahead = F.last(point, ignorenulls=True).over(later.rangeBetween(Window.unboundedPreceding, 0))
    both = first.withColumn("b", back).withColumn("a", ahead).where("event_type = 'signup' and (a is not null or b is not null)")
    nearer = F.when(F.col("a").isNull(), F.col("b.id")).when(F.col("b").isNull(), F.col("a.id")).when(F.col("t") - F.col("b.t") <= F.col("a.t") - F.col("t"), F.col("b.id")).otherwise(F.col("a.id"))
    return both.select("event_id", "user_id", nearer.alias("nearest"))
