"""Order-dependent passes against the loops that they stand for."""

import math
import random

import pytest
from pyspark.sql import functions as F

from quarryline.operators import ordered
from quarryline.plans.catalogue import QUERIES
from quarryline.workspace import Workspace


def graph(seed, n, edges):
    rng = random.Random(seed)
    return {tuple(sorted(rng.sample(range(n), 2))) for _ in range(edges)}


@pytest.mark.parametrize("n, k", [(40, 60), (60, 25), (30, 200)])
def test_greedy_removal(spark, n, k):
    pairs = graph(n, n, k)
    taken = []
    for i in range(n):
        if not any((j, i) in pairs for j in taken):
            taken.append(i)
    want = {i: min(j for j in taken if (j, i) in pairs) for i in range(n) if i not in taken}
    edges = spark.createDataFrame([(a, b, a) for a, b in pairs], "first long, later long, at long")
    assert {r.node: r.by for r in ordered.repeats_of_taken(edges, Workspace(spark, "t")).collect()} == want and want


def test_greedy_removal_of_a_chain_and_of_nothing(spark):
    edges = spark.createDataFrame([(i, i + 1, i) for i in range(9)], "first long, later long, at long")
    assert {r.node: r.by for r in ordered.repeats_of_taken(edges, Workspace(spark, "t")).collect()} == {i: i - 1 for i in range(1, 10, 2)}
    assert ordered.repeats_of_taken(edges.limit(0), Workspace(spark, "t")).count() == 0


@pytest.mark.parametrize("stretch", [1 << 17, 40])
def test_greedy_removal_of_a_long_chain_takes_few_rounds(spark, monkeypatch, stretch):
    """A chain of 300 rows that wait for each other, and bands beside it, settle by stretches; nodes may be structs."""
    import glob

    from quarryline.workspace import shared_root

    monkeypatch.setattr(ordered, "STRETCH", stretch)
    rng = random.Random(7)
    pairs = {(i, i + 1) for i in range(300)} | {(1000 + i, 1000 + i + rng.randint(1, 6)) for i in range(200)}
    taken, want = set(), {}
    for i in sorted({x for p in pairs for x in p}):
        before = [j for j in taken if (j, i) in pairs]
        taken |= set() if before else {i}
        want |= {i: min(before)} if before else {}
    edges = spark.createDataFrame(list(pairs), "f long, l long").select(F.struct("f").alias("first"), F.struct(F.col("l").alias("f")).alias("later"), F.struct("f").alias("at"))
    before = set(glob.glob(f"{shared_root(spark)}/quarryline/chain-*"))
    found = ordered.repeats_of_taken(edges.repartition(3), Workspace(spark, "chain"))
    assert {r.node.f: r.by.f for r in found.collect()} == want and len(want) > 200
    (folder,) = set(glob.glob(f"{shared_root(spark)}/quarryline/chain-*")) - before
    assert len(glob.glob(f"{folder}/settled-*")) <= math.ceil(len(pairs) / stretch) + 1


@pytest.mark.parametrize("n, k", [(50, 40), (50, 120)])
def test_first_groups(spark, n, k):
    pairs = graph(n + k, n, k)
    groups = []
    for i in range(n):
        home = next((g for g in groups if any((j, i) in pairs for j in g)), None)
        if home is None:
            groups.append([i])
        else:
            home.append(i)
    want = {i: g[0] for g in groups for i in g[1:]}
    found = ordered.first_groups(spark.createDataFrame(list(pairs), "first long, later long"), Workspace(spark, "t"))
    assert {r.node: r.root for r in found.collect()} == want
    assert ordered.first_groups(found.select(F.col("root").alias("first"), F.col("node").alias("later")).limit(0), Workspace(spark, "t")).count() == 0


def test_unique_assignment(spark):
    rng = random.Random(6)
    rows = [(rng.randrange(25), rng.randrange(40), rng.randrange(12)) for _ in range(300)] + [(None, 3, 99), (3, None, 99)]
    rows += [(50, i, 5) for i in range(60)]  # a hot side
    best = {}
    for a, b, w in rows:
        best[(a, b)] = max(w, best.get((a, b), w))
    used, want = (set(), set()), set()
    for (a, b), w in sorted(((k, w) for k, w in best.items() if None not in k), key=lambda x: (-x[1], x[0])):
        if a not in used[0] and b not in used[1]:
            used[0].add(a)
            used[1].add(b)
            want.add((a, b))
    frame = spark.createDataFrame([(a, b, w) for (a, b), w in best.items()], "a long, b long, w long")
    got = {tuple(r) for r in ordered.unique_assignment(frame, "a", "b", [-F.col("w")], Workspace(spark, "t")).collect()}
    assert got == want and len(want) > 20
    assert ordered.unique_assignment(frame.limit(0), "a", "b", [-F.col("w")], Workspace(spark, "t")).count() == 0


def test_no_taken_news_repeats_another(spark):
    """Of what is taken, no two rows of a language lie within three days with titles that overlap by .84."""
    sf = "/root/testdata/sf0.01"
    found = {r.doc_id: r for r in QUERIES["news_without_repeats"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text").collect()
    words = {}
    for r in docs:
        title = "".join(c if c.isascii() and c.isalnum() or c in "%$" else " " for c in r.text.split("\n")[0].lower())
        words[r.doc_id] = (r.lang, set(title.split()))

    def alike(a, b):
        (x, s), (y, t) = words[a], words[b]
        return x is not None and x == y and abs(a // 100 - b // 100) <= 3 and min(len(s), len(t)) >= 4 and len(s & t) >= max(4, 0.84 * min(len(s), len(t)))

    taken = sorted(i for i, r in found.items() if r.taken)
    assert len(found) == len(docs) and 10 < len(docs) - len(taken)
    assert not any(alike(a, b) for i, a in enumerate(taken) for b in taken[i + 1 :] if b // 100 - a // 100 <= 3)
    assert all(found[r.repeats].taken and alike(r.doc_id, r.repeats) and r.repeats > r.doc_id for r in found.values() if not r.taken)
