import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from tests.llm.helpers import awkward, empty

from quarryline.llm import substrings as S


def slow(texts, length):
    strings = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if strings[t[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def compare(spark, texts, length=60):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    want = slow([(t or "").encode() for t in texts], length)
    got = {r.id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.remove_repeats(docs, length).collect()}
    assert [got[i] for i in range(len(texts))] == want


def made(seed, n=40):
    rng = random.Random(seed)
    line = lambda k: "".join(rng.choices("abcdefghé ", k=k))
    shared = [line(rng.randint(40, 200)) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = [line(rng.randint(0, 150)) for _ in range(rng.randint(1, 4))]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randint(0, len(s) // 2)
            parts.insert(rng.randint(0, len(parts)), s[a : rng.randint(a, len(s))])
        texts.append("".join(parts))
    texts += [texts[0], texts[0], texts[1][:-1] + "x", "", None, "ab" * 300, "z" * 500, "z" * 59, "z" * 60]
    return texts


def test_like_brute_force(spark):
    compare(spark, made(1))


def test_large_groups_are_counted_by_hash(spark, monkeypatch):
    monkeypatch.setattr(S, "GROUP", 2)
    compare(spark, made(2))


def test_slices_and_small_sorts(spark, monkeypatch):
    monkeypatch.setattr(S, "SLICE", 97)
    monkeypatch.setattr(S, "SORTED", 500)
    compare(spark, made(3))


def test_awkward_rows(spark):
    docs = awkward(spark)
    rows = S.remove_repeats(docs, 200).collect()
    assert len(rows) == docs.count()
    of = {r.id: r for r in rows}
    assert of[20].n_bytes == 0 and of[26].n_removed == of[26].n_bytes == of[0].n_removed
    assert S.remove_repeats(empty(spark), 200).count() == 0
    with pytest.raises(ValueError):
        S.remove_repeats(docs, 16)


def test_orders():
    rng = np.random.default_rng(5)
    for alphabet in (1, 2, 200):
        rows = rng.integers(0, alphabet, (400, 70)).astype(np.uint8)
        rows[100:200] = rows[:100]
        group = rng.integers(0, 3, 400)
        order, common = S.deep_shallow(rows, group)
        seen = [(group[i], rows[i].tobytes()) for i in order]
        assert seen == sorted(seen)
        for i in range(1, 400):
            want = -1 if seen[i][0] != seen[i - 1][0] else next((k for k in range(70) if seen[i][1][k] != seen[i - 1][1][k]), 70)
            assert common[i] == want
    for width in (1, 7, 60):
        for alphabet in (1, 2, 1 << 40):
            h = rng.integers(0, alphabet, 300).astype(np.uint64)
            assert S._least(h, width).tolist() == [i + int(np.argmin(h[i : i + width])) for i in range(300 - width + 1)]
