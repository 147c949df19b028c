import math

import numpy as np
import pytest

from quarryline.llm import ann


def brute(rows, queries, k):
    out = []
    for q, v in queries:
        near = []
        for i, w in rows:
            if i != q:
                near.append((-sum(a * b for a, b in zip(v, w)) / math.sqrt(sum(a * a for a in v)) / math.sqrt(sum(b * b for b in w)), i))
        out += [(q, r + 1, i, round(-s, 9)) for r, (s, i) in enumerate(sorted((round(s, 12), i) for s, i in near)[:k])]
    return out


def test_small_tables_against_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(-3, 4, 5).astype(float).tolist()) for i in range(120)]
    rows = [(i, v) for i, v in rows if any(v)] + [(500, rows[3][1]), (501, rows[3][1])]
    odd = [(700, None), (701, [0.0] * 5), (702, [1.0, None, 1.0, 1.0, 1.0]), (703, [math.nan, 1.0, 1.0, 1.0, 1.0]), (704, [math.inf, 1.0, 1.0, 1.0, 1.0]), (705, []), (706, [1.0] * 4), (None, [1.0] * 5)]
    t = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    got = ann.nearest(t, t.where("vec_id % 10 = 0"), 5, recall=1.0).collect()
    want = brute(rows, [r for r in rows if r[0] % 10 == 0], 5)
    assert sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in got) == sorted(want)
    assert ann.nearest(t.where("vec_id < 3"), t.where("vec_id = 0"), 5).count() == 2
    assert ann.nearest(t.where("vec_id >= 700"), t.where("vec_id >= 700"), 5).count() == 0
    assert ann.nearest(t.where("false"), t.where("false"), 5).count() == 0


def shaped(shape):
    rng = np.random.default_rng(2)
    if shape == "random":
        return rng.normal(size=(8000, 32))
    centres = rng.normal(size=(60, 16))
    x = centres[rng.integers(0, 60, 8000)] + rng.normal(size=(8000, 16)) * 0.3
    if shape == "copies":
        x[:4000] = x[0]
    if shape == "outliers":  # near copies of one vector, and vectors far from all others
        x[:5000] = x[0] + rng.normal(size=(5000, 16)) * 0.01
        x[5000:] = rng.normal(size=(3000, 16))
    return x


@pytest.mark.parametrize("shape", ["random", "clusters", "copies", "outliers"])
def test_recall_and_hot_cells(spark, monkeypatch, shape):
    monkeypatch.setattr(ann, "CHUNK", 512)
    x = shaped(shape)
    t = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(t, t.where("vec_id % 50 = 0"), 5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = 0
    for q, found in got.items():
        s = unit @ unit[q]
        s[q] = -2
        best = set(np.lexsort((np.arange(len(s)), -np.round(s, 12)))[:5].tolist())
        found.sort()
        assert len(found) == 5 and all(abs(s[v] - c) < 1e-12 for _, v, c in found)
        assert all(a[2] > b[2] or (a[2] == b[2] and a[1] < b[1]) for a, b in zip(found, found[1:]))
        hit += len(best & {v for _, v, _ in found})
    assert len(got) == 160 and hit >= 0.9 * 800


def test_probes_come_in_order_of_cost():
    h = ann.Hashing(8, 3)
    rng = np.random.default_rng(3)
    unit = ann._unit(rng.normal(size=(4, 8)))
    keys = h.probes(unit, 0, 40)
    assert keys.shape == (4, 40) and all(len(set(k)) == 40 for k in keys.tolist())
    assert (keys[:, 0] == h.key(np.floor(h.place(unit, 0)), 0)).all()


def test_probes_reach_the_recall_or_all_are_compared():
    sample = np.random.default_rng(5).normal(size=(3000, 64))
    hashing, most = ann.fit(sample, 10_000_000, 5, 0.97)
    assert 0 < hashing.k < 10 and most <= 2048
    unit = ann._unit(sample)
    near = unit[:100] @ unit.T
    near[np.arange(100), np.arange(100)] = -2
    best = np.argsort(-near, axis=1)[:, :5]
    met = np.zeros(best.shape, bool)
    for t in range(hashing.tables):
        there = hashing.key(np.floor(hashing.place(unit, t)), t)
        for q, keys in enumerate(hashing.probes(unit[:100], t, most)):
            met[q] |= np.isin(there[best[q]], keys)
    assert met.mean() >= 0.97
    hashing, most = ann.fit(sample, 10_000_000, 5, 0.97, most=1)
    assert hashing.k == 0 and most == 1


def test_queries_with_too_few_rows_are_compared_with_all(spark, monkeypatch):
    monkeypatch.setattr(ann, "fit", lambda sample, n, *_: (ann.Hashing(sample.shape[1], 12), 1))
    monkeypatch.setattr(ann, "CHUNK", 7)
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(200)]
    t = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.nearest(t, t.where("vec_id % 10 = 0"), 5).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in got) == sorted(brute(rows, rows[::10], 5))


@pytest.mark.parametrize("k, most", [(3, 40), (5, 300), (0, 1)])
def test_a_part_is_visited_where_the_probes_lead(k, most):
    """The cost of the last probe tells the same cells as the probes' keys do."""
    rng = np.random.default_rng(4)
    hashing = ann.Hashing(16, k, 2 if k else 1)
    x, q = rng.normal(size=(900, 16)), rng.normal(size=(30, 16))
    x[:50] = q[0] + rng.normal(size=(50, 16)) * 0.01
    part = ann._Part([(np.arange(500), np.arange(500), x[:500]), (np.arange(500, 900), np.arange(400), x[500:])], hashing)
    unit, want = ann._unit(x), np.zeros((30, 900), bool)
    limits = np.zeros((30, hashing.tables))
    for t in range(hashing.tables):
        there = hashing.key(np.floor(hashing.place(unit, t)), t)
        limits[:, t] = hashing.visits(ann._unit(q), t, most)[0][:, -1]
        for i, keys in enumerate(hashing.probes(ann._unit(q), t, most)):
            want[i] |= np.isin(there, keys)
    assert (part.visited(q, limits) == want).all() and want.any() and (k == 0 or not want.all())
    assert part.visited(q, np.full(limits.shape, np.inf)).all()


def test_a_query_goes_to_each_part_once(spark, monkeypatch):
    """However many cells a query visits, its rows grow with the parts; nothing is broadcast by its probes."""
    import glob

    from quarryline.workspace import shared_root

    monkeypatch.setattr(ann, "CHUNK", 700)
    monkeypatch.setattr(ann, "PARTS", 2)
    x = np.random.default_rng(6).normal(size=(3000, 24))
    t = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    before = set(glob.glob(f"{shared_root(spark)}/quarryline/nearest-*"))
    assert ann.nearest(t, t.where("vec_id % 50 = 0"), 5).count() == 300
    (folder,) = set(glob.glob(f"{shared_root(spark)}/quarryline/nearest-*")) - before
    (found,) = glob.glob(f"{folder}/found-*")
    assert spark.read.parquet(found).count() <= 60 * 5 * 6
