import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from tests.llm.helpers import awkward, empty

from quarryline.llm.simhash import covering_masks, fingerprint, hamming_links, near_duplicate_components, simhash_components, without_near_duplicates
from quarryline.llm.shingles import _met
from quarryline.workspace import Workspace


def slow_fingerprint(text, words=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    tokens, token = [], ""
    for c in low + " ":
        if c in " \t\n\v\f\r":
            tokens += [token] * bool(token)
            token = ""
        else:
            token += c
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i : i + words]) for i in range(len(tokens) - words + 1)] or [" ".join(tokens)]
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(ids, prints, radius):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(find(i), []).append(ids[i])
    return {i: min(g) for g in groups.values() for i in g}


@pytest.mark.parametrize("text", ["", " \n", "One", "One two", "One two three four, ONE TWO three", "É ö x y z w", "a " * 400])
def test_fingerprint(text):
    assert fingerprint(text.encode(), 3, 42) == slow_fingerprint(text)


@pytest.mark.parametrize("radius", [1, 2])
def test_masks_cover_every_pair(radius):
    masks = covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    for i in range(64):
        for j in range(i if radius > 1 else i, i + 1):
            assert any(not m >> i & 1 and not m >> j & 1 for m in masks)
    if radius == 2:
        assert all(any(not m >> i & 1 and not m >> j & 1 for m in masks) for i in range(64) for j in range(64))


def test_links_give_the_components_of_all_pairs(spark):
    rng = random.Random(3)
    prints = set()
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(12):
            prints.add(x)
            for _ in range(rng.randint(1, 3)):
                x ^= 1 << rng.randrange(64)
    prints = sorted(prints)
    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    frame = spark.createDataFrame([(s,) for s in signed], "fp long")
    edges = hamming_links(frame, 2, Workspace(spark, "t")).collect()
    back = dict(zip(signed, prints))
    assert all((back[e.a] ^ back[e.b]).bit_count() <= 2 for e in edges)
    root = {s: s for s in signed}
    for _ in range(len(signed)):
        for e in edges:
            root[e.a] = root[e.b] = min(root[e.a], root[e.b])
    want = components(list(range(len(prints))), prints, 2)
    assert len(set(root.values())) == len(set(want.values()))


def test_awkward_rows(spark):
    rows = simhash_components(awkward(spark), words=3, radius=2).collect()
    assert len(rows) == awkward(spark).count()
    of = {r.id: r for r in rows}
    assert of[20].fp == of[21].fp == of[22].fp == 0 and of[21].component == of[22].component == 20
    assert of[26].component == of[27].component == of[0].component == 0
    assert of[None].component == 1
    assert simhash_components(empty(spark)).count() == 0


def test_one_of_each_group_stays(spark):
    kept = without_near_duplicates(awkward(spark))
    assert kept.columns == awkward(spark).columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert 0 in ids and 26 not in ids and 27 not in ids and 21 not in ids and ids.count(20) == 1
    twice = awkward(spark).where("doc_id = 27")
    assert without_near_duplicates(twice).count() == 1
    assert without_near_duplicates(empty(spark)).count() == 0


def test_near_copies_beyond_the_radius_go(spark):
    rng = random.Random(8)
    vocabulary = [f"word{i}" for i in range(400)]
    rows, made = [], {}
    for g in range(40):
        base = rng.choices(vocabulary, k=rng.randint(90, 300))
        made[len(rows)] = base
        rows.append(base)
        for _ in range(2):
            copy = list(base)
            for at in rng.sample(range(len(copy)), max(1, len(copy) // 60)):
                copy[at] = f"edit{rng.random()}"
            rows.append(copy)
    # one large group, and a line that half of the texts share
    hot = rng.choices(vocabulary, k=200)
    rows += [hot[:i] + [f"hot{i}"] + hot[i + 1 :] for i in range(150)]
    line = rng.choices(vocabulary, k=30)
    rows += [rng.choices(vocabulary, k=70) + line for _ in range(150)]

    sets = [{tuple(r[i : i + 5]) for i in range(len(r) - 4)} for r in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                a, b = root[i], root[j]
                root = [min(a, b) if x in (a, b) else x for x in root]
    prints = [fingerprint(" ".join(r).encode(), 5, 42) for r in rows]
    beyond = [i for i in range(120) if root[i] != i and (prints[i] ^ prints[root[i]]).bit_count() > 2]
    assert len(beyond) > 40
    frame = spark.createDataFrame([(i, " ".join(r)) for i, r in enumerate(rows)], "doc_id long, text string").repartition(3)
    kept = {r.doc_id for r in without_near_duplicates(frame).select("doc_id").collect()}
    assert kept == set(root)


def test_no_planted_pair_is_lost(spark):
    """Pairs beyond two bits, in texts that share nothing else: 4000 groups of two, over many parts."""
    rng = random.Random(12)
    rows = []
    for g in range(4000):
        base = [f"w{rng.getrandbits(40):x}" for _ in range(70)]
        copy = list(base)
        copy[rng.choice((0, 1, 34, 69))] = f"e{g}"
        rows += [(2 * g, " ".join(base)), (2 * g + 1, " ".join(copy))]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = {r.id: r.component for r in near_duplicate_components(frame).collect()}
    assert found == {i: i - i % 2 for i in range(8000)}


def test_shingles_met_across_batches_and_parts():
    rng = random.Random(2)
    for _ in range(200):
        x = sorted(rng.choices(range(40), k=rng.randint(0, 60)))
        cuts = sorted(rng.choices(range(len(x) + 1), k=4))
        parts = [x[a:z] for a, z in zip([0, *cuts], [*cuts, len(x)])]
        kept = []
        for part in parts:
            rows = pa.table({"shingle": pa.array(part, pa.int64()), "set": pa.array(range(len(part)), pa.int64())})
            out = [b.column(0).to_pylist() for b in _met(iter(rows.to_batches(max_chunksize=rng.randint(1, 9))))]
            kept += [v for b in out for v in b]
        want = [v for v in x if x.count(v) > 1]
        assert kept == sorted(kept) and all(kept.count(v) == x.count(v) for v in want)
        assert len(kept) - len(want) <= 2 * sum(bool(p) for p in parts)


def test_many_unlike_texts_of_one_passage(spark):
    """A passage that the order doesn't know: the pivots close without a list of all pairs."""
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join(passage + [f"x{i}_{j}" for j in range(rng.randint(14, 30))])) for i in range(90)]
    rows += [(100 + i, " ".join(passage + [f"x{i}_{j}" for j in range(14)])) for i in range(90)]
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    root = {i: i for i in sets}
    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                low, high = sorted((root[i], root[j]))
                root = {k: low if v == high else v for k, v in root.items()}
    # fingerprints may link more, so groups by sets must be inside those found
    found = {r.id: r.component for r in near_duplicate_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(found[i] == found[root[i]] for i in sets)


def test_all_sets_around_a_pivot_have_one_label(spark):
    """Those with smaller names than the pivot too; two groups stay apart."""
    from quarryline.llm.shingles import _labels

    links = [(min(5, m), max(5, m)) for m in (-3, 1, 2, 4, 6, 9)] + [(20, 21), (20, 22)]
    found = {r.set: r.root for r in _labels(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {m: -3 for m in (-3, 1, 2, 4, 5, 6, 9)} | {20: 20, 21: 20, 22: 20}


def test_rounds_are_few(spark, monkeypatch):
    """180 unlike texts of one passage: every job's plans stay in the driver, which nine rounds of links filled."""
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join(passage + [f"x{i}_{j}" for j in range(rng.randint(14, 30))])) for i in range(180)]
    names, keep = [], Workspace.keep
    monkeypatch.setattr(Workspace, "keep", lambda self, df, name, **options: names.append(name) or keep(self, df, name, **options))
    assert near_duplicate_components(spark.createDataFrame(rows, "doc_id long, text string")).count() == 180
    assert names.count("open") <= 5 and len(names) <= 34


def rows_made(spark, since, node, text):
    """Rows that the operators of this name, whose description holds ``text``, have made in the queries after ``since``."""
    store = spark._jsparkSession.sharedState().statusStore()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    total, runs = 0, store.executionsList()
    for i in range(runs.size()):
        k = runs.apply(i).executionId()
        if k <= since:
            continue
        ids, nodes = set(), store.planGraph(k).allNodes()
        for j in range(nodes.size()):
            x = nodes.apply(j)
            if node in x.name() and text in x.desc():
                metrics = [x.metrics().apply(m) for m in range(x.metrics().size())]
                ids |= {m.accumulatorId() for m in metrics if m.name() == "number of output rows"}
        values = store.executionMetrics(k).iterator() if ids else None
        while values and values.hasNext():
            pair = values.next()
            if pair._1() in ids:
                total += int(pair._2().replace(",", ""))
    return total


def test_rows_of_meetings_and_labels_follow_the_texts(spark, monkeypatch):
    """Unlike texts of one passage make no rows, near copies few; the order of shingles knows neither."""
    import quarryline.llm.shingles as shingles

    monkeypatch.setattr(shingles, "SAMPLE", 0)
    rng = random.Random(7)
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join(passage + [f"x{i}_{j}" for j in range(rng.randint(24, 30))])) for i in range(120)]
    base = [f"b{i}" for i in range(150)]
    for i in range(120):
        copy = list(base)
        for at in rng.sample(range(150), 2):
            copy[at] = f"e{i}_{at}"
        rows.append((1000 + i, " ".join(copy)))
    runs = spark._jsparkSession.sharedState().statusStore().executionsList()
    since = max((runs.apply(i).executionId() for i in range(runs.size())), default=-1)
    found = {r.id: r.component for r in near_duplicate_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(found[1000 + i] == 1000 for i in range(120))
    met = rows_made(spark, since, "Join", "size_b")
    labelled = rows_made(spark, since, "Generate", "beside")
    assert 0 < met < 20 * len(rows)
    assert 0 < labelled < 10 * len(rows)
