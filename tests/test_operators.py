import datetime as dt
import json
import random

from pyspark.sql import functions as F

from quarryline.functions import text as tx
from quarryline.functions import url as ur
from quarryline.functions import values as vl
from quarryline.operators import greedy, joins, ledger
from quarryline.operators.components import connected_components
from quarryline.sources import files
from quarryline.streaming import observations
from quarryline.workspace import Workspace


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_urls(spark):
    u = F.lit(" https://www.Example.com/a-b/c_d/?utm_source=x&b=2&a=1&mc_id=3#top")
    assert one(spark, ur.canonical_url(u, "tracks")) == "https://www.Example.com/a-b/c_d/?b=2&a=1"
    assert one(spark, ur.canonical_url(u, "suppression")) == "https://www.Example.com/a-b/c_d/?a=1&b=2&mc_id=3"
    assert one(spark, ur.canonical_url(u, "no_query")) == "https://www.Example.com/a-b/c_d"
    bad = F.lit("not a url?x#y")
    assert [one(spark, ur.canonical_url(bad, p)) for p in ("tracks", "collector", "suppression")] == ["", "not a url?x#y", "not a url"]
    assert one(spark, ur.canonical_url(F.lit(None).cast("string"), "tracks")) == ""
    assert one(spark, ur.host(u)) == "example.com" and one(spark, ur.host(F.lit("news.bbc.co.uk:80/x"))) == "news.bbc.co.uk"
    assert one(spark, ur.title_from_url(F.trim(u))) == "c d"
    assert one(spark, ur.in_domain(F.lit("a.b.com"), F.lit("b.com"))) and not one(spark, ur.in_domain(F.lit("ab.com"), F.lit("b.com")))
    assert one(spark, ur.host_suffixes(F.lit("a.b.com"))) == ["a.b.com", "b.com", "com"]


def test_texts(spark):
    assert one(spark, tx.normalized(F.lit("  A&amp;B — 12%  of $5 "))) == "a b 12% of $5"
    assert one(spark, tx.slug(F.lit("Hello, Wörld! 42"))) == "hello-wörld-42"
    assert one(spark, tx.clip(F.lit("abcdef"), 3, "…")) == "abc…"
    assert one(spark, tx.strip_html(F.lit("<p>A &amp; B</p><script>x<y</script> C"))) == "A & B C"
    assert one(spark, tx.sentences(F.lit("One. Two! Three"))) == ["One.", "Two!", "Three"]
    assert one(spark, tx.fnv1a(F.lit("ai_agent"))) == 4294967296 - 2608602113
    a, b = F.array(*map(F.lit, "abcd")), F.array(*map(F.lit, "bcde"))
    assert one(spark, tx.jaccard(a, b)) == 0.6 and one(spark, tx.overlap(a, b)) == 0.75
    assert one(spark, tx.jaccard(a, F.array().cast("array<string>"))) == 0.0
    assert one(spark, tx.organization_root(F.lit("Scale AI, Inc."))) == "scale"
    assert not one(spark, tx.compatible_root(F.lit("meitu"), F.lit("meituan")))
    assert one(spark, tx.compatible_root(F.lit("google"), F.lit("googledeepmind")))
    assert one(spark, tx.near_claim(F.lit("Sales rose by ten per cent"), F.lit("sales rose by ten per cent!")))
    assert not one(spark, tx.near_claim(F.lit("Sales rose"), F.lit("")))
    assert one(spark, tx.features(F.lit("AI agent x"))) == ["ai", "agent", "ai_agent"]


def test_values(spark):
    assert one(spark, vl.quantities(F.lit("It grew 18.75% to USD 623.50 million in 2025, 500 users"))) == ["USD 623.50 million", "18.75%", "623.50 million", "2025", "500 users"]
    assert one(spark, vl.unsupported_numbers(F.lit("5 of 12"), F.lit("12"))) == ["5"]
    assert float(one(spark, vl.money(F.lit("$1.2B")))) == 1.2e9 and one(spark, vl.money(F.lit("none"))) is None
    dates = {r: tuple(one(spark, vl.partial_date(F.lit(r)))) for r in ("2024-05-06T1", "2024-05", "2024", "'26.3", "'71", "soon")}
    assert dates == {"2024-05-06T1": ("2024-05-06", "day"), "2024-05": ("2024-05-01", "month"), "2024": ("2024-01-01", "year"), "'26.3": ("2026-03-01", "month"), "'71": ("1971-01-01", "year"), "soon": (None, "unknown")}
    assert one(spark, vl.issues(a=F.lit(True), b=F.lit(False), c=F.lit(None).cast("boolean"))) == ["b", "c"]
    assert one(spark, vl.first_match(F.lit("Paywall"), [("x", "zzz"), ("sub", "(?i)paywall")])) == "sub"
    assert one(spark, vl.ratio(F.lit(1), F.lit(0))) == 0.0 and one(spark, vl.clamp(F.lit(7.0), 1.0, 5.0)) == 5.0


def test_ledger(spark):
    rows = spark.createDataFrame([("k", 1, 5.0), ("k", 2, 5.0), ("k", 3, 6.0), ("k", 4, 5.0), ("m", 1, None), ("m", 2, None)], "key string, t int, v double")
    assert [(r.key, r.t, r.revision) for r in ledger.revisions(rows, ["key"], "v", F.asc("t")).orderBy("key", "t").collect()] == [("k", 1, 1), ("k", 3, 2), ("k", 4, 3), ("m", 1, 1)]
    assert sorted((r.key, r.t) for r in ledger.new_versions(rows, ["key"], "v", F.asc("t")).collect()) == [("k", 1), ("k", 3), ("m", 1)]
    new = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "id string, t int")
    assert [tuple(r) for r in ledger.append_new(new.where("id = 'b'"), new, ["id"], F.asc("t")).collect()] == [("a", 1)]
    runs = spark.createDataFrame([("s", i, f) for i, f in enumerate([0, 1, 1, 0, 1])], "key string, t int, bad int")
    assert [r.streak for r in ledger.streaks(runs, ["key"], F.col("bad") == 1, F.asc("t")).orderBy("t").collect()] == [0, 1, 2, 0, 1]
    old, fresh = spark.createDataFrame([(1, 1.0), (2, 2.0)], "d int, p double"), spark.createDataFrame([(2, 9.0), (3, 3.0)], "d int, p double")
    assert sorted(tuple(r) for r in ledger.merge_series(old, fresh, ["d"], "p").collect()) == [(1, 1.0), (2, 9.0), (3, 3.0)]
    events = {(r.d, r.change) for r in ledger.change_events(old, fresh, ["d"], "p").collect()}
    assert events == {(2, "revised"), (3, "discovered")}


def test_joins(spark):
    left = spark.createDataFrame([("a", 5), ("a", 1), ("b", 9)], "k string, t int")
    right = spark.createDataFrame([("a", 2, 20.0, 1), ("a", 5, 50.0, 1), ("a", 5, 51.0, 2)], "k string, t int, v double, n int")
    assert sorted((r.k, r.t, r.v) for r in joins.asof(left, right, ["k"], "t", "v", "n").collect()) == [("a", 1, None), ("a", 5, 51.0), ("b", 9, None)]
    rows = spark.createDataFrame([(1, ["x", "y"]), (2, ["z"])], "id int, keys array<string>")
    gone = spark.createDataFrame([("y",)], "key string")
    assert [r.id for r in joins.suppress(rows, F.col("keys"), gone, "key", "id").collect()] == [2]


def test_similar_pairs_like_brute_force(spark):
    rng = random.Random(1)
    sets = [sorted(set(rng.choices("abcdefghijkl", k=rng.randint(1, 10)))) for _ in range(80)]
    rows = spark.createDataFrame(list(enumerate(sets)), "id int, tokens array<string>")
    first = {}
    for i, s in enumerate(sets):
        first.setdefault(tuple(s), i)
    for least in (0.5, 0.84, 1.0):
        want = {(min(i, j), max(i, j)) for a, i in first.items() for b, j in first.items() if i != j and len(set(a) & set(b)) / len(set(a) | set(b)) >= least}
        want |= {(first[tuple(s)], i) for i, s in enumerate(sets) if first[tuple(s)] != i}  # copies, with their first
        assert {(r.a, r.b) for r in joins.similar_pairs(rows, "id", F.col("tokens"), least).collect()} == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 100), (7, 7), (200, 200)]
    found = connected_components(spark.createDataFrame(edges, "a int, b int"), Workspace(spark, "t"))
    roots = {r.node: r.root for r in found.collect()}
    assert roots[60] == 0 and roots[30] == 0 and roots[101] == 100 and 200 not in roots
    assert connected_components(spark.createDataFrame([], "a int, b int"), Workspace(spark, "t")).count() == 0


def test_min_gap(spark):
    day = dt.date(2024, 1, 1)
    rows = [(i, "k", day + dt.timedelta(days=d), float(w)) for i, (d, w) in enumerate([(0, 5), (3, 9), (8, 4), (9, 7), (20, 1)])]
    frame = spark.createDataFrame(rows, "id int, key string, day date, w double")
    assert sorted(r.id for r in greedy.min_gap(frame, "key", "day", "w", "id", 4, 12).collect()) == [1, 3, 4]


def test_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"head": 1, "data": {"items": [{"id": 1, "name": "x"}, {"id": 2, "name": "y"}]}}))
    schema = spark.createDataFrame([], "id int, name string").schema
    assert files.read_json_dataset(spark, f"{tmp_path}/a.json", schema, "data.items").count() == 2
    assert files.read_json_dataset(spark, f"{tmp_path}/none.json", schema).count() == 0
    (tmp_path / "l.jsonl").write_text('{"id": 1, "name": "x"}\nnot json\n{"id": 2}\n')
    good, bad = files.read_ledger(spark, f"{tmp_path}/l.jsonl", schema)
    assert sorted(r.id for r in good.collect()) == [1, 2] and [r.value for r in bad.collect()] == ["not json"]
    (tmp_path / "f.xml").write_text("<rss><channel><item><title>T</title><link>http://a.b/c</link><guid>g</guid><description>&lt;p&gt;Hi&lt;/p&gt;</description></item></channel></rss>")
    assert tuple(files.read_feed(spark, f"{tmp_path}/f.xml").first()) == ("T", "http://a.b/c", "g", None, "Hi")
    arrays = spark.createDataFrame([("k", [1, 2], ["a", "b"])], "key string, n array<int>, s array<string>")
    assert [tuple(r) for r in files.zipped_rows(arrays, "n", "s").collect()] == [("k", 1, "a"), ("k", 2, "b")]
    first = files.first_provider(spark.createDataFrame([("a", 1)], "k string, v int"), spark.createDataFrame([("a", 2), ("b", 3)], "k string, v int"), key="k")
    assert sorted(tuple(r) for r in first.collect()) == [("a", 1), ("b", 3)]
    table = spark.createDataFrame([(1, None), (2, "b")], "id int, s string")
    assert files.write_if_changed(table, f"{tmp_path}/t") and not files.write_if_changed(table.orderBy(F.desc("id")), f"{tmp_path}/t")
    assert files.write_if_changed(table.where("id = 1"), f"{tmp_path}/t")
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "x").write_text("1")
    a = files.fingerprint(spark, f"{tmp_path}/d").first()
    assert (a["files"], a["bytes"]) == (1, 1) and len(a["hash"]) == 64


def stream(spark, tmp_path, rows, schema, build):
    source, name = f"{tmp_path}/in", f"out_{abs(hash(str(tmp_path)))}"
    for i in range(0, len(rows), 4):
        spark.createDataFrame(rows[i : i + 4], schema).coalesce(1).write.mode("append").parquet(source)
    opened = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    run = build(opened).writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", f"{tmp_path}/ck").start()
    try:
        run.processAllAvailable()
    finally:
        run.stop()
    return spark.table(name).collect()


def test_streams_end_like_the_batch(spark, tmp_path):
    at = lambda i: dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)
    rows = [("ab"[i % 2], at(i), i, float(v)) for i, v in enumerate([1, 1, 1, 2, 3, 2, 3, 1, 1, 1, 5, 1])]
    schema = "key string, ts timestamp, event_id long, value double"
    got = stream(spark, tmp_path / "r", rows, schema, observations.observation_events)
    batch = ledger.revisions(spark.createDataFrame(rows, schema), ["key"], "value", F.asc("ts"), F.asc("event_id")).collect()
    assert sorted((r.key, r.event_id, r.revision) for r in got) == sorted((r.key, r.event_id, r.revision) for r in batch)
    assert {r.event_type for r in got if r.revision == 1} == {"discovered"}
    runs = [("s", at(i), i, bool(f)) for i, f in enumerate([0, 1, 1, 0, 0, 1, 1, 1])]
    schema = "key string, ts timestamp, event_id long, failed boolean"
    got = stream(spark, tmp_path / "h", runs, schema, observations.health_changes)
    assert [(r.state, r.streak) for r in sorted(got, key=lambda r: r.event_id)] == [("healthy", 0), ("failed", 1), ("failed", 2), ("recovered", 0), ("healthy", 0), ("failed", 1), ("failed", 2), ("failed", 3)]
    once = stream(spark, tmp_path / "d", rows, "key string, ts timestamp, event_id long, value double", lambda s: observations.new_identities(s, ["key", "value"], "ts"))
    assert len(once) == len({(r[0], r[3]) for r in rows})
