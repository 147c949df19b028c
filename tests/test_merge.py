"""Merged records against loops."""

import random
import re

from pyspark.sql import functions as F

from quarryline.operators import merge
from quarryline.plans.catalogue import QUERIES
from quarryline.workspace import Workspace

SF = "/root/testdata/sf0.001"


def test_references_follow_their_rows(spark):
    rows = spark.createDataFrame([(1, 5, None), (2, 9, "x"), (3, 7, "y"), (4, 1, "z"), (5, 3, None)], "id int, w int, f string")
    links = spark.createDataFrame([(1, 2), (2, 3), (5, 5), (3, 99)], "a int, b int")
    order = [-F.col("w")]
    moved = merge.canonical_map(rows, "id", links, order, Workspace(spark, "t"))
    assert sorted(tuple(r) for r in moved.collect()) == [(1, 2), (3, 2)]
    facts = spark.createDataFrame([(i % 6, i) for i in range(30)] + [(None, 7)], "k int, n int")
    once = merge.redirected(facts, "k", moved)
    assert {r.k for r in once.collect()} == {0, 2, 4, 5, None} and once.where("redirected").count() == 10
    twice = merge.redirected(once.drop("redirected"), "k", moved)
    assert twice.where("redirected").count() == 0 and sorted(map(str, twice.drop("redirected").collect())) == sorted(map(str, once.drop("redirected").collect()))
    merged = merge.merged_rows(rows, "id", moved, order, ["w", "f"])
    assert sorted((r.id, r.w, r.f, r.merged) for r in merged.collect()) == [(2, 9, "x", 2), (4, 1, "z", 0), (5, 3, None, 0)]


def test_no_order_is_left_dangling(spark):
    found = QUERIES["canonical_customers"](spark, SF).collect()
    customers = spark.read.parquet(f"{SF}/customer.parquet").count()
    orders = spark.read.parquet(f"{SF}/orders.parquet").join(spark.read.parquet(f"{SF}/customer.parquet"), F.col("o_custkey") == F.col("c_custkey")).count()
    assert sum(1 + r.merged for r in found) == customers and sum(r.orders for r in found) == orders


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_near_names_are_all_pairs_one_edit_apart(spark):
    rng = random.Random(5)
    rows = [(rng.choice("kl"), "".join(rng.choices("abé", k=rng.randint(0, 5)))) for _ in range(160)] + [(None, "ab"), (None, "abb"), ("k", None), ("k", "ab"), ("k", "ba")]
    names = {r for r in rows if r[1] is not None}
    want = {(k, a, b) for k, a in names for q, b in names if k is not None and k == q and a < b and distance(a, b) <= 1}
    got = {tuple(r) for r in merge.near_names(spark.createDataFrame(rows, "k string, n string"), ["k"], "n").collect()}
    assert got == want and len(want) > 50


def test_claims_are_kept_once(spark):
    rng = random.Random(8)
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa"]
    rows, made = [], []
    for e in range(6):
        for s in range(40):
            text = " ".join(rng.choices(words, k=rng.randint(0, 7)))
            if made and rng.random() < 0.3:
                text = rng.choice([f"{rng.choice(made)} indeed", rng.choice(made).upper() + "!", rng.choice(made)[2:]])
            made.append(text)
            rows.append((e, s, text))
    rows += [(9, i, "one claim that all of them make, again and again") for i in range(200)] + [(10, 0, None), (10, 1, "?!"), (10, 2, "?!")]
    rng.shuffle(rows)
    want, taken = {}, {}
    for e, s, text in sorted(rows, key=lambda r: r[:2]):
        clean = re.sub(r"\s+", " ", text or "").strip().lower()
        key, ws = re.sub(r"[\W_]+", "", clean), {w for w in re.sub(r"[\W_]+", " ", clean).split() if len(w) >= 2}
        same = any(key == k or (min(len(key), len(k)) >= 24 and (k in key or key in k)) or (ws and v and len(ws & v) / min(len(ws), len(v)) >= 0.82) for k, v in taken.get(e, [])) if key else False
        if key and not same:
            taken.setdefault(e, []).append((key, ws))
        want[e, s] = not same
    frame = spark.createDataFrame(rows, "e int, s int, text string").repartition(4)
    found = {(r.e, r.s): r.kept for r in merge.repeated_claims(frame, "e", ["s"], "text", Workspace(spark, "t")).collect()}
    assert found == want and 20 < sum(want.values()) < 200
    assert merge.repeated_claims(frame.limit(0), "e", ["s"], "text", Workspace(spark, "t")).count() == 0
