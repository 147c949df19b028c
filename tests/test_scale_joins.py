"""Joins and ledgers that avoid hot keys, against plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarryline.operators import joins, ledger
from quarryline.plans.catalogue import QUERIES

VOCABULARY = ["alpha", "beta", "Deleted", "Startup", "startups", "a", "x", "open", "lab", "New", "York", "Times", "Yorkshire"]


@pytest.mark.parametrize("few", [0, 1000])
def test_mentions_of_any_length(spark, monkeypatch, few):
    monkeypatch.setattr(joins, "FEW", few)
    rng = random.Random(1)
    texts = [(i, " ".join(rng.choices(VOCABULARY, k=rng.randint(0, 14)))) for i in range(150)] + [(900, None), (901, "")]
    terms = ["Deleted Startup", "York", "New York", "x", "rtup", "alpha beta a", "ork Tim", "open lab New York Times", "", "  ", None, "eta De"]
    terms += [" ".join(rng.choices(VOCABULARY, k=k)) for k in (2, 3, 4, 5, 6) for _ in range(3)]
    t = spark.createDataFrame(texts, "id long, text string")
    n = spark.createDataFrame(list(enumerate(terms)), "k long, name string")
    got = {tuple(r) for r in joins.mentions(t, "id", F.col("text"), n, "k", "name").collect()}
    want = {(i, k) for i, text in texts for k, term in enumerate(terms) if text and term and term.strip() and term in text}
    assert got == want and len(want) > 100
    assert joins.mentions(t, "id", F.col("text"), n.where("false"), "k", "name").count() == 0


def test_previous_row_over_buckets(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["a", "b", None]), i * i) for i in rng.sample(range(4000), 300)]
    got = {r.id: tuple(r.prior) if r.prior else None for r in ledger.previous(spark.createDataFrame(rows, "id long, k string, v long"), ["k"], "id", "v", width=64).collect()}
    want, last = {}, {}
    for i, k, v in sorted(rows):
        want[i] = last.get(k)
        last[k] = (i, v)
    assert got == want


def test_latest_of_null_keys_too(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None)], "id long, k string")
    got = {r.id: (r.is_latest, r.copies) for r in ledger.flag_latest(rows, ["k"], "id").collect()}
    assert got == {1: (False, 2), 2: (True, 2), 3: (False, 2), 4: (True, 2)}


def test_slices(spark):
    keys = random.Random(3).sample(range(10_000), 500)
    rows = spark.createDataFrame([(k,) for k in keys], "k long").repartition(5)
    for start, n in ((0, 24), (130, 40), (490, 24), (600, 5)):
        assert sorted(r.k for r in ledger.slice_of(rows, "k", start, n).collect()) == sorted(keys)[start : start + n]


def test_overlapping_pairs(spark):
    rng = random.Random(4)
    sets = [(i, rng.sample([f"line {j}" for j in range(12)], rng.randint(0, 6)) + ["shared by all"]) for i in range(60)]
    got = {tuple(r) for r in joins.overlapping_pairs(spark.createDataFrame(sets, "id long, l array<string>"), "id", F.col("l")).collect()}
    want, first = set(), {}
    for a, x in sets:
        first.setdefault(frozenset(x), a)
    for a, x in sets:
        for b, y in sets:
            both = len(set(x) & set(y))
            of_sets = first[frozenset(x)] == a and (first[frozenset(y)] == b or set(x) == set(y))
            if a < b and of_sets and both >= 2 and both >= 0.6 * min(len(x), len(y)):
                want.add((a, b, both))
    assert got == want and want


def test_copies_give_rows_in_proportion(spark):
    rows = [(i, "a hot copy of one text here") for i in range(1000)] + [(2000 + i, f"a hot copy of one text here {i:04d}") for i in range(3)]
    frame = spark.createDataFrame(rows, "id long, text string")
    words = F.array_distinct(F.split("text", " "))
    pairs = [(r.a, r.b) for r in joins.similar_pairs(frame, "id", words, 0.8).collect()]
    assert sorted(p for p in pairs if p[1] < 1000) == [(0, i) for i in range(1, 1000)]
    assert len(pairs) <= 999 + 6 and {p[1] for p in pairs} >= {2000, 2001, 2002}
    lines = [(r.a, r.b, r.shared) for r in joins.overlapping_pairs(frame, "id", words).collect()]
    assert sorted(p for p in lines if p[1] < 1000) == [(0, i, 7) for i in range(1, 1000)] and len(lines) <= 999 + 6


def test_every_pair_of_copies(spark, monkeypatch):
    """Copies are paired with each other and with all rows like them, in parts of a class."""
    monkeypatch.setattr(joins, "PART", 4)
    rng = random.Random(11)
    kinds = [rng.sample([f"line {j}" for j in range(9)], rng.randint(0, 5)) for _ in range(14)]
    sets = [(i, rng.sample(x, len(x)) + x[:1]) for i, x in enumerate(rng.choices(kinds, k=70))] + [(90, None)]
    frame = spark.createDataFrame(sets, "id long, l array<string>").repartition(3)
    got = [tuple(r) for r in joins.every_overlapping_pair(frame, "id", F.col("l")).collect()]
    told = [(i, set(x)) for i, x in sets if x]
    both = [(a, b, len(x & y), min(len(x), len(y))) for a, x in told for b, y in told if a < b]
    assert sorted(got) == sorted((a, b, k) for a, b, k, n in both if k >= 2 and k >= 0.6 * n) and len(got) > 300


def test_links_reach_what_the_pairs_reach(spark):
    """Fewer links than pairs, each of them a pair, with the same components and the same
    smallest row by steps to smaller ones."""

    def reached(pairs, falling):
        """The smallest row that each row reaches."""
        best, last = {i: i for p in pairs for i in p}, None
        while best != last:
            last = dict(best)
            for a, b in pairs:
                best[b] = min(best[b], best[a])
                best[a] = best[a] if falling else min(best[a], best[b])
        return best

    for seed, common, sizes in ((5, 5, (2, 3, 3, 3, 4, 7)), (6, 9, (2, 3, 4, 5, 6)), (7, 4, (3, 3, 3, 5))):
        rng = random.Random(seed)
        made = [rng.sample(range(common), min(common, rng.randint(0, 4))) for _ in range(220)]
        made = [x + [1000 + 50 * i + j for j in range(max(0, rng.choice(sizes) - len(x)))] for i, x in enumerate(made)]
        frame = spark.createDataFrame([(int(k), x) for k, x in zip(rng.sample(range(5000), len(made)), made)], "id long, l array<int>").repartition(3)
        pairs = {(r.a, r.b) for r in joins.overlapping_pairs(frame, "id", F.col("l")).collect()}
        links, copies = ({tuple(r) for r in x.collect()} for x in joins.overlapping_links(frame, "id", F.col("l")))
        assert copies <= pairs and links <= pairs - copies and len(links) < len(pairs - copies)
        for falling in (False, True):
            assert reached(links, falling) == reached(pairs - copies, falling)


def test_similar_pairs_travel_without_their_sets(spark):
    """Pairs of near copies, of chains of them and of sets that only meet are those of all
    pairs; what is kept for comparing them is far smaller than the sets of the pairs."""
    import glob

    from quarryline.workspace import shared_root

    rng = random.Random(21)
    made = []
    for g in range(6):
        last = rng.sample(range(g * 150, g * 150 + 400), 120)
        for _ in range(25):  # each from the first one or the one before, so some are two steps apart
            source = set(last if rng.random() < 0.5 else made[-1] if made and rng.random() < 0.7 else last)
            made.append(sorted(source - set(rng.sample(sorted(source), 4)) | set(rng.sample(range(2000, 9000), rng.randint(0, 6)))))
    made += [sorted(rng.sample(range(300), 90)) for _ in range(60)]  # sets that meet and aren't alike
    frame = spark.createDataFrame(list(enumerate(made)), "id long, l array<int>").repartition(3)
    before = set(glob.glob(f"{shared_root(spark)}/quarryline/pairs-*"))
    got = {(r.a, r.b, round(r.similarity, 9)) for r in joins.similar_pairs(frame, "id", F.col("l"), 0.84).collect()}
    both = [(a, b, len({*x} & {*y}), len(x) + len(y)) for a, x in enumerate(made) for b, y in enumerate(made) if a < b]
    assert got == {(a, b, round(k / (n - k), 9)) for a, b, k, n in both if k >= 0.84 * (n - k)} and len(got) > 300
    (folder,) = set(glob.glob(f"{shared_root(spark)}/quarryline/pairs-*")) - before
    kept = {p.split("/")[-1].rsplit("-", 1)[0]: spark.read.parquet(p) for p in glob.glob(f"{folder}/*")}
    assert kept["near"].count() < 2 * len(got) and kept["told"].where("same").count() > 0 and kept["told"].where("not same").count() > 0
    assert kept["differences"].agg(F.sum(F.size("differ"))).first()[0] < kept["held"].agg(F.sum(F.size("tokens"))).first()[0] / 2


def test_overlapping_pairs_nearby(spark):
    """Pairs of one group within a reach of time, as comparing all pairs gives; rows far
    apart never meet."""
    import glob

    from quarryline.workspace import Workspace, shared_root

    rng = random.Random(12)
    rows = [(i, rng.choice(["en", "de", None]), rng.choice([None, *range(-9, 30)]), rng.sample(range(14), rng.randint(0, 9))) for i in range(260)]
    rows += [(1000 + i, "en", 100 + 40 * i, list(range(6))) for i in range(50)]
    frame = spark.createDataFrame(rows, "id long, g string, t long, l array<long>").repartition(3)
    got = [tuple(r) for r in joins.overlapping_nearby(frame, "id", "l", "g", "t", 3, 0.6, 2, Workspace(spark, "close")).collect()]
    told = [r for r in rows if None not in r]
    both = [(a, b, len({*x} & {*y}), min(len(x), len(y))) for a, g, s, x in told for b, h, t, y in told if a < b and g == h and abs(s - t) <= 3]
    assert sorted(got) == sorted((a, b, k) for a, b, k, n in both if k >= 2 and k >= 0.6 * n) and len(got) > 100
    (met,) = glob.glob(f"{shared_root(spark)}/quarryline/close-*/met-*")
    assert spark.read.parquet(met).count() <= len(both)


def test_similar_vectors(spark):
    x = np.random.default_rng(5).normal(size=(60, 4))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(99, None), (98, [0.0] * 4)], "id long, v array<double>")
    got = {(r.query_id, r.id) for r in joins.similar_vectors(rows.where("id % 3 = 0"), rows, "id", "v", 0.8, block=7).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    assert got == {(i, j) for i in range(0, 60, 3) for j in range(60) if i != j and unit[i] @ unit[j] >= 0.8}


def test_min_gap_against_a_loop(spark):
    found = QUERIES["min_gap_inflections"](spark, "/root/testdata/sf0.001").collect()
    assert len({r.event_id for r in found}) == len(found)
    by = {}
    for r in found:
        by.setdefault(r.user_id, []).append(r.day)
    assert all(len(d) <= 12 and all(abs((a - b).days) > 4 for i, a in enumerate(d) for b in d[:i]) for d in by.values())
