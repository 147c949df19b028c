import math
import random

import numpy as np
import pytest
from tests.llm.helpers import awkward, empty

from quarryline.llm import decontaminate as D

VOCABULARY = ["w" + str(i) for i in range(4000)]


def slow_distance(item, text):
    best = [0] * (len(text) + 1)
    for i, x in enumerate(item):
        row = [i + 1]
        for j, y in enumerate(text):
            row.append(min(best[j] + (x != y), best[j + 1] + 1, row[j] + 1))
        best = row
    return min(best)


def test_edit_distance():
    rng = random.Random(5)
    for _ in range(300):
        a = [rng.randrange(4) for _ in range(rng.randint(1, 9))]
        b = [rng.randrange(4) for _ in range(rng.randint(0, 14))]
        cost, start, end = D.edit_distance(np.array(a, np.uint64), np.array(b, np.uint64))
        assert cost == slow_distance(a, b)
        assert start <= end and slow_distance(a, b[start:end]) == cost


def test_words_without_regard_to_case_and_marks(monkeypatch):
    a, starts, ends = D.words("Über ALLES, (naïve)-Test 42!".encode())
    b, _, _ = D.words("über alles naïve test 42".encode())
    assert a.tolist() == b.tolist() and starts[1] == 6 and ends[1] == 11
    text = ("Stone and river. " * 500).encode()
    whole = [x.tolist() for x in D.words(text)]
    monkeypatch.setattr(D, "SLICE", 64)
    assert [x.tolist() for x in D.words(text)] == whole


def edited(rng, words, k):
    words = list(words)
    for _ in range(k):
        at, kind = rng.randrange(len(words)), rng.randrange(3)
        if kind == 0:
            words[at] = "x" + str(rng.getrandbits(40))
        elif kind == 1:
            del words[at]
        else:
            words.insert(at, "y" + str(rng.getrandbits(40)))
    return words


def test_near_copies_are_found_and_clean_texts_stay(spark):
    rng = random.Random(6)
    items = [rng.choices(VOCABULARY, k=rng.randint(12, 60)) for _ in range(60)]
    docs, planted = [], set()
    for i in range(400):
        body = rng.choices(VOCABULARY, k=rng.randint(0, 200))
        if i % 2:
            j = rng.randrange(60)
            at = rng.randint(0, len(body))
            body[at:at] = edited(rng, items[j], rng.randint(0, len(items[j]) // 5))
            planted.add((i, j))
        docs.append((i, " ".join(body)))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(j, " ".join(w)) for j, w in enumerate(items)], "item_id long, text string")
    found = {(r.id, r.item_id) for r in D.contaminated(d, b).collect()}
    assert len(planted - found) <= 0.01 * len(planted) + 1
    assert all(i % 2 for i, _ in found)
    kept = {r.doc_id for r in D.without_contaminated(d, b).collect()}
    assert kept == {i for i, _ in docs} - {i for i, _ in found}


def test_spans_and_awkward_rows(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma delta omega sigma"), (1, None), (2, ""), (3, "?!"), (None, "one of the few and the many others")], "item_id int, text string")
    docs = spark.createDataFrame([(1, "😀 Alpha, beta gamma: delta omega SIGMA end"), (2, None), (3, ""), (1, "one of the few and the many others"), (4, "alpha beta")], "doc_id long, text string")
    rows = {(r.id, r.item_id): r for r in D.contaminated(docs, items).collect()}
    assert set(rows) == {(1, 1), (1, None)}
    hit = rows[1, 1]
    assert hit.edits == 0 and "😀 Alpha, beta gamma: delta omega SIGMA end"[hit.start : hit.end] == "Alpha, beta gamma: delta omega SIGMA"
    kept = D.without_contaminated(awkward(spark), items)
    assert kept.columns == awkward(spark).columns and kept.count() == awkward(spark).count()
    assert D.contaminated(empty(spark), items).count() == 0
    assert D.contaminated(docs, items.where("false")).count() == 0
    assert D.without_contaminated(docs, items.where("false")).count() == 5


def test_items_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_WORDS", 10)
    rng = random.Random(8)
    items = [(j, " ".join(rng.choices(VOCABULARY, k=15))) for j in range(4)]
    docs = spark.createDataFrame([(j, f"some words {t} more words") for j, t in items] + [(9, "nothing here")], "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    assert {(r.id, r.item_id) for r in D.contaminated(docs, b).collect()} == {(j, j) for j in range(4)}
    assert [r.doc_id for r in D.without_contaminated(docs, b).collect()] == [9]


def test_long_items_are_verified_whole():
    rng = random.Random(9)
    for n in (257, 258, 300, 513, 700):
        item = [f"i{n}x{j}" for j in range(n)]
        index = D.Index.of([(n, D.words(" ".join(item).encode())[0])], 0.2, 0.99)
        assert all(len(p) >= 128 for p in index.items)
        other = rng.choices(VOCABULARY, k=150)
        texts = [other + item[-1:] + other, other + item[:200] + other, other + edited(rng, item, n // 10) + other, item, other + edited(rng, item, n // 3) + other]
        found = index.find([D.words(" ".join(t).encode())[0] for t in texts])
        assert not found[0] and not found[1] and not found[4]
        (cost, first, end), *rest = found[2].values()
        assert not rest and 0 < cost <= n // 10 and abs(first - 150) <= 2
        assert list(found[3].values()) == [(0, 0, n)]


def test_against_all_pairs(spark):
    """Every stretch of every text is compared with every item."""
    rng = random.Random(12)
    opening = rng.choices(VOCABULARY, k=6)  # which many items share
    items = [(j, opening + rng.choices(VOCABULARY, k=rng.randint(4, 40))) for j in range(12)]
    items += [(20, ["one"]), (21, ["two", "words"])]
    docs = []
    for i in range(100):
        text = rng.choices(VOCABULARY, k=rng.randint(0, 60))
        if i % 2:
            _, item = rng.choice(items)
            text += edited(rng, item, rng.randint(0, len(item) // 3)) + rng.choices(VOCABULARY, k=10)
        docs.append((i, " ".join(text)))
    want = set()
    for i, t in docs:
        h = D.words(t.encode())[0]
        for j, item in items:
            if len(h):
                cost, first, end = D.edit_distance(D.words(" ".join(item).encode())[0], h)
                if cost <= math.floor(0.2 * len(item) + 1e-9) and end > first:
                    want.add((i, j, cost))
    found = D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(j, " ".join(t)) for j, t in items], "item_id long, text string"))
    got = {(r.id, r.item_id, r.edits) for r in found.collect()}
    assert got <= want and len(got) >= 0.98 * len(want) and len(want) > 25


def test_a_recall_out_of_reach_is_told(monkeypatch):
    monkeypatch.setattr(D, "MOST", 1)
    with pytest.raises(ValueError):
        D.repeats_for(50, 10, 0.999)
