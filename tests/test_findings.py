"""Queries against their SQL on small tables made for what the given ones lack."""

import duckdb
import pytest
from pyspark.sql import functions as F

from quarryline.plans.catalogue import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def like_sql(spark, name, folder):
    """The query's rows, which are those of its SQL."""
    db = duckdb.connect()
    for path in folder.glob("*.parquet"):
        db.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}{'/*.parquet' if path.is_dir() else ''}'")
    want = db.sql(ORACLE_SQL[name])
    got = [tuple(r) for r in QUERIES[name](spark, str(folder)).select(*want.columns).collect()]
    assert sorted(got, key=str) == sorted(want.fetchall(), key=str)
    return got


def documents(spark, folder, rows):
    made = spark.createDataFrame(rows, "doc_id long, text string")
    made.select("*", F.lit("en").alias("lang"), F.lit("s1").alias("source"), F.length("text").cast("long").alias("n_chars")).write.parquet(str(folder / "documents.parquet"))


def test_places_of_bodies_count_long_ones(spark, tmp_path):
    """A first body of 115 characters goes, so the second, of 123, is the first that stays."""
    documents(spark, tmp_path, [(2, "x" * 115), (5, "y" * 130), (8, "z" * 20), (1, "v" * 119)])
    assert sorted(r[:2] for r in like_sql(spark, "article_bodies", tmp_path)) == [(2, 1), (5, 1), (5, 2)]


def test_scores_round_whole_hundredths(spark, tmp_path):
    """Sums of hundredths that end in five, and points that do, as exact fractions say."""
    from fractions import Fraction
    from math import floor

    rows, want = [], {}
    for supplier, (n, parts, returned) in enumerate([(596, 448, 149), (401, 262, 101), (400, 300, 101), (625, 500, 120), (203, 151, 20), (80, 7, 9), (640, 13, 171), (1100, 800, 0)] + [(500 + k, 400 - k, 3 * k) for k in range(60)]):
        rows += [(supplier, i % parts, "R" if i < returned else "N") for i in range(n)]
        points = [w * min(Fraction(5), max(Fraction(1), x)) / 5 for w, x in ((40, Fraction(n, 200)), (35, Fraction(parts, 150)), (25, 6 - Fraction(10 * returned, n)))]
        hundredths = sum(floor(p * 100 + Fraction(1, 2)) for p in points)
        want[supplier] = floor(Fraction(hundredths, 10) + Fraction(1, 2)) / 10
    spark.createDataFrame(rows, "l_suppkey long, l_partkey long, l_returnflag string").write.parquet(str(tmp_path / "lineitem.parquet"))
    assert dict(like_sql(spark, "scorecard", tmp_path)) == want


def test_last_line_of_equal_dates_and_numbers(spark, tmp_path):
    """Two lines of one order, number and date: the larger part's category decides, in either order of rows."""
    import datetime

    day = datetime.datetime(2001, 8, 26)
    for name in ("documents", "labels", "pages"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    spark.createDataFrame([(k, f"Customer {k}", 3, -1.0, "AUTOMOBILE") for k in (1, 2, 3)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(str(tmp_path / "customer.parquet"))
    spark.createDataFrame([(7 * k, k, 500.0, day) for k in (1, 2, 3)], "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz").write.parquet(str(tmp_path / "orders.parquet"))
    lines = [(7, 2, 5, day), (7, 2, 9, day), (14, 2, 9, day), (14, 2, 5, day), (21, 2, 9, day), (21, 2, 11, day)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_shipdate timestamp_ntz").coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(5, "ECONOMY"), (9, "SMALL"), (11, "ECONOMY")], "p_partkey long, p_type string").write.parquet(str(tmp_path / "part.parquet"))
    found = like_sql(spark, "track_candidates", tmp_path)
    assert {r[1] for r in found if r[0] == "value-chain"} == {"value-chain:customer-3"}


def test_shared_line_pairs_of_copies(spark, tmp_path):
    """Documents of the same lines, in any order, have their own pairs."""
    x, y, z = ("one line of enough letters", "another line of letters", "a third line of letters")
    texts = [f"{x}\n{y}", f"{y}\n{x}", f"{x}\n{y}\n{z}", f"{x}\n{y}", x]
    documents(spark, tmp_path, list(enumerate(texts)))
    assert {r[:2] for r in like_sql(spark, "shared_line_pairs", tmp_path)} == {(a, b) for a in range(4) for b in range(a + 1, 4)}


@pytest.mark.parametrize("kind", ["pairs", "overlaps"])
def test_pairs_that_cannot_reach_the_share_are_not_compared(spark, kind):
    """Sets that meet on a token with too little behind it bring no rows; items are numbers."""
    import glob
    import random

    from quarryline.operators import joins
    from quarryline.workspace import shared_root

    rng = random.Random(8)
    vocabulary = [f"a longer line of text, number {i}" for i in range(60)]
    sets = [rng.sample(vocabulary, rng.randint(18, 22)) for _ in range(150)]
    sets += [sets[i][1:] for i in range(0, 60, 2)]
    rows = spark.createDataFrame(list(enumerate(sets)), "id long, l array<string>")
    before = set(glob.glob(f"{shared_root(spark)}/quarryline/{kind}-*"))
    found = joins.similar_pairs(rows, "id", F.col("l"), 0.84) if kind == "pairs" else joins.overlapping_pairs(rows, "id", F.col("l"), 0.84, 4)
    got = {(r.a, r.b) for r in found.collect()}
    both = [(a, b, len(set(x) & set(y)), len(x), len(y)) for a, x in enumerate(sets) for b, y in enumerate(sets) if a < b]
    assert got == {(a, b) for a, b, k, x, y in both if (k >= 0.84 * (x + y - k) if kind == "pairs" else k >= 4 and k >= 0.84 * min(x, y))} and len(got) >= 30
    (folder,) = set(glob.glob(f"{shared_root(spark)}/quarryline/{kind}-*")) - before
    told = {p.split("/")[-1].rsplit("-", 1)[0]: spark.read.parquet(p) for p in glob.glob(f"{folder}/*")}
    assert dict(told["sets"].dtypes)["tokens" if kind == "pairs" else "items"] == "array<bigint>"
    assert told["met"].count() < len(both) * (1 / 3 if kind == "pairs" else 3 / 4)


@pytest.mark.parametrize("name", ["reselected_briefs", "prose_paragraphs", "brief_lines"])
def test_lines_are_judged_in_one_place(spark, name):
    """What a fold or a filter uses in many places is computed once."""
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("data is a real-time snapshot") == 1
    assert plan.count("announced") <= 1


def test_cosines_in_small_products(spark, monkeypatch):
    """A worker's products are bounded by ROWS, whatever the batches; every pair is found."""
    import numpy as np

    from quarryline.operators import joins

    monkeypatch.setattr(joins, "ROWS", 5)
    x = np.random.default_rng(3).normal(size=(83, 4))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>").coalesce(1)
    got = {(r.query_id, r.id) for r in joins.similar_vectors(rows.where("id % 2 = 0"), rows, "id", "v", 0.7).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    assert got == {(i, j) for i in range(0, 83, 2) for j in range(83) if i != j and unit[i] @ unit[j] >= 0.7}


def test_buckets_of_features_as_counted_one_by_one(spark):
    """Words of one character, Hangul, long words, blanks, nulls and repeats; by text and
    over all texts, without a shuffle of features."""
    from quarryline.functions import text as tx
    from quarryline.operators.features import feature_buckets

    texts = ["The AI agent x of 대한민국 2 be or not to be", None, "", " \t\n\x0b ", "a b c", "one", "word_word Word-word 한 국어", "z" * 3000 + " tail " + "y" * 70, "é ß naïve ſs İi"] + [f"the {i % 7} row{i} and the {i % 3}{i}" for i in range(150)]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(3)
    each = rows.select("id", F.explode(tx.features(F.col("text"))).alias("f")).select("id", F.pmod(tx.fnv1a(F.col("f")), F.lit(384)).alias("bucket"))
    assert {tuple(r) for r in feature_buckets(rows, "text", 384, "id").collect()} == {tuple(r) for r in each.groupBy("id", "bucket").count().collect()}
    found = feature_buckets(rows, "text", 384)
    assert {tuple(r) for r in found.collect()} == {tuple(r) for r in each.groupBy("bucket").count().collect()}
    assert " f#" not in found._jdf.queryExecution().executedPlan().toString() and feature_buckets(rows.limit(0), "text").count() == 0


def test_unique_claims_are_computed_once(spark, tmp_path):
    """The lines stand once in the plan, not once for each use of the result."""
    documents(spark, tmp_path, [(1, "A line that is long enough to be a claim of its own, here.\n" * 3), (2, "short")])
    found = QUERIES["unique_claims"](spark, str(tmp_path))
    assert [tuple(r)[:2] for r in found.collect()] == [(1, 1)]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("split(text") == 1


def test_claims_of_small_entities_travel_once(spark):
    """Entities that are folded and those that are joined keep the same claims; claims of
    no entity stay; small entities cost one exchange of their rows."""
    import random

    from quarryline.operators import merge
    from quarryline.workspace import Workspace

    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "x", "한국"]
    rows = [(e, s, " ".join(rng.choices(words, k=rng.randint(0, 6))) + rng.choice(["", "!", " indeed"])) for e in range(8) for s in range(30)]
    rows += [(None, 0, "of no entity"), (None, 1, "of no entity"), (9, 0, None), (9, 1, "?"), (9, 2, "?")]
    frame = spark.createDataFrame(rows, "e int, s int, text string").repartition(4)
    run = lambda few: merge.repeated_claims(frame, "e", ["s"], "text", Workspace(spark, "t"), few=few)
    folded, joined = run(30), run(2)
    assert folded.columns == joined.columns == ["e", "s", "text", "kept"]
    assert sorted(map(tuple, folded.collect()), key=str) == sorted(map(tuple, joined.collect()), key=str)
    assert [r.kept for r in folded.where("e is null").collect()] == [True, True]
    plan = folded.where("e is not null")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and 20 < folded.where("kept").count() < 240
