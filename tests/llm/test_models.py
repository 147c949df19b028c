import math
import random
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F
from tests.llm.helpers import awkward, empty

from quarryline.llm import langid, linear, lm, quality


def test_hinge_descent_finds_the_margin():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 3))
    y = np.where(x[:, 0] - 2 * x[:, 1] + 0.3 > 0, 1.0, -1.0)
    rows = [(np.arange(3), v) for v in x]
    w, b = linear.hinge_descent(rows, y, 3, np.full(200, 10.0), epochs=200)
    assert (np.sign(x @ w + b) == y).mean() > 0.98
    best = 0.5 * (w @ w + b * b) + 10 * np.maximum(0, 1 - y * (x @ w + b)).sum()
    for _ in range(50):
        v, c = w + rng.normal(size=3) * 0.05, b + rng.normal() * 0.05
        assert 0.5 * (v @ v + c * c) + 10 * np.maximum(0, 1 - y * (x @ v + c)).sum() > best - 0.5


def test_bounded_sample(spark):
    rows = spark.range(5000).selectExpr("cast(id as string) key", "cast(id % 100 = 0 as int) as label")
    sample = linear.bounded_sample(rows, "label", 60, rows.key).groupBy("label").count().collect()
    assert {r.label: r["count"] for r in sample}[0] <= 60 and {r.label: r["count"] for r in sample}[1] == 50
    assert linear.bounded_sample(rows.where("false"), "label", 5, rows.key).count() == 0


LANGUAGES = {"en": "the of and with this from that have was".split(), "de": "der die und nicht sich auch über von".split(), "fr": "le les des que dans pour avec être".split(), "es": "el los las que por para con ñandú".split(), "xx": "zuk bek tak pok".split()}


def language_docs(spark, n=60):
    rng = random.Random(2)
    rows = []
    for i in range(n * len(LANGUAGES)):
        lang = sorted(LANGUAGES)[i % len(LANGUAGES)]
        rows.append((i, " ".join(rng.choices(LANGUAGES[lang], k=rng.randint(8, 60))).capitalize() + ".", lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_languages(spark):
    docs = language_docs(spark)
    model = langid.train(docs.where("doc_id % 2 = 0"))
    assert model.members["germanic"] == ["de", "en"] and model.members["romance"] == ["es", "fr"] and model.members["xx"] == ["xx"]
    rows = langid.predict(docs.where("doc_id % 2 = 1"), model).collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.lang_score <= 1 for r in rows)
    odd = {r.doc_id: r for r in langid.predict(awkward(spark), model).collect()}
    assert [odd[i].lang_pred for i in (20, 21, 22, 24)] == ["und"] * 4 and odd[28].lang_pred != "und"
    assert langid.predict(empty(spark), model).count() == 0
    nothing = langid.train(docs.where("lang is null"))
    assert {r.lang_pred for r in langid.predict(docs, nothing).collect()} == {"und"}
    one = langid.train(docs.where("lang = 'de'"))
    assert {r.lang_pred for r in langid.predict(docs, one).collect()} == {"de"}


def test_quality(spark):
    rng = random.Random(3)
    vocabulary = ["river", "stone", "cloud", "grass", "paper", "light"]
    rows, labels = [], []
    for i in range(300):
        bad = i % 3 == 0
        words = rng.choices(vocabulary, k=rng.randint(20, 60))
        text = " | ".join(words) if bad and i % 2 else " ".join(w for w in words for _ in range(4 if bad else 1))
        rows.append((i, text))
        labels.append((i, int(not bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    gold = spark.createDataFrame(labels + [(900, None), (901, 7), (None, 1)], "doc_id long, quality int")
    model = quality.train(docs, gold.where("doc_id < 200 or doc_id is null or doc_id >= 900"))
    found = {r.id: r.score for r in quality.score(docs.where("doc_id >= 200"), model).collect()}
    assert sum((s >= 0.5) == (i % 3 != 0) for i, s in found.items()) >= 0.97 * len(found)
    assert all(0 <= s <= 1 for s in found.values())
    assert quality.score(awkward(spark), model).count() == awkward(spark).count()
    assert quality.score(empty(spark), model).count() == 0
    assert quality.train(docs, gold.where("quality = 1")) is None
    assert {r.score for r in quality.score(docs, None).collect()} == {0.5}


def test_base_scores_and_counts(spark):
    docs = awkward(spark).unionByName(language_docs(spark, 20).selectExpr("doc_id + 100 doc_id", "text", "lang", "'s' source", "1L n_chars", "1 id", "'k' key"))
    learn = docs.where("coalesce(doc_id, 0) % 3 <> 1")
    teaches = F.expr("coalesce(doc_id, 0) % 3 <> 1")
    rows = lm.score(docs, teaches).collect()
    counts = Counter()
    for r in learn.collect():
        counts.update((r.text or "").encode().lower().split())
        counts["end"] += 1
    total, distinct = sum(counts.values()), len(counts)
    want = []
    for r in docs.collect():
        tokens = [*(r.text or "").encode().lower().split(), "end"]
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in tokens)
        want.append((r.doc_id or -1, len(tokens), sum(counts[t] > 0 for t in tokens), round(base, 6)))
    assert sorted((r.id or -1, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in rows) == sorted(want)
    assert all(r.train_tokens == total and r.score < 0 for r in rows)
    assert all(r.learns == ((r.id or 0) % 3 != 1) for r in rows)
    assert lm.score(empty(spark)).count() == 0
    assert all(r.n_known == 0 and r.train_tokens == 0 for r in lm.score(docs, F.lit(False)).collect())


def test_scores_do_not_depend_on_the_layout_and_beat_word_counts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    found = []
    for n in (1, 4, 32):
        rows = lm.score(docs.repartition(n, F.xxhash64("doc_id", F.lit(n))), F.expr("doc_id % 5 <> 1")).where("not learns").select("id", "base_score", "score").toPandas().set_index("id").sort_index()
        assert rows.score.sum() > rows.base_score.sum() + 0.05 * 80_000  # .05 log10 a token at least
        found.append(rows)
    for other in found[1:]:
        assert np.allclose(found[0].score, other.score, rtol=1e-6) and np.allclose(found[0].base_score, other.base_score, rtol=1e-9)


def small_vocabulary(n=5, count=4000):
    words = [b"w%d" % i for i in range(n)]
    zeros = np.zeros(lm.CLASSES)
    return lm.Vocabulary(words, np.full(n, float(count)), n * count + 1, n + 1, 1, zeros, zeros)


def test_model_is_normalised_and_learns():
    vocab = small_vocabulary()
    line = np.tile(np.arange(5), 4000)
    context, target = lm.contexts(vocab.symbol_of[line], np.array([len(line)]), vocab.end)
    start = lm.Weights.start(vocab.size)
    trainer = lm.Trainer(start, vocab.size)
    rng = np.random.default_rng(4)
    for _ in range(80):
        part = rng.integers(0, len(target), 2048)
        trainer.step(context[:, part], target[part])
    before, after = start.log10_probs(context, target).mean(), trainer.w.log10_probs(context, target).mean()
    assert before < -0.6 and after > -0.05
    every = trainer.w.log10_probs(np.repeat(context[:, 100:101], lm.SYMBOLS, 1), np.arange(lm.SYMBOLS))
    assert abs((10**every).sum() - 1) < 1e-5
    again = lm.Weights.of(trainer.w.flat())
    assert all(np.allclose(x, y) for x, y in zip(again.parts(), trainer.w.parts()))


def test_noise_contrast_nears_the_data():
    """Frequencies within and between bins come out of noise-contrastive steps alone."""
    vocab = small_vocabulary(300, 50)
    rng = np.random.default_rng(5)
    p = rng.dirichlet(np.full(300, 0.5))
    flat = lm.Weights.start(vocab.size)
    trainer = lm.Trainer(flat, vocab.size, rate=0.05)
    for _ in range(300):
        line = rng.choice(300, 4096, p=p)
        context, target = lm.contexts(vocab.symbol_of[line], np.array([4096]), vocab.end)
        trainer.step(context, target)
    common = np.argsort(-p)[:20]
    context = np.full((lm.CONTEXT, 20), vocab.symbol_of[int(common[0])])
    logs = trainer.w.log10_probs(context, vocab.symbol_of[common])
    assert np.abs(logs - np.log10(p[common])).mean() < 0.15


def test_contexts():
    context, target = lm.contexts(np.array([5, 6, 7]), np.array([2, 2, 3]), 0)
    assert target.tolist() == [5, 6, 0, 0, 7, 0]
    assert context[0].tolist() == [0, 5, 6, 0, 0, 7] and context[1].tolist() == [0, 0, 5, 0, 0, 0]


def test_class_column_is_the_class(spark):
    words = [b"a", b"ab", b"abc", "é".encode(), b"zzzz", b"x" * 50]
    rows = spark.createDataFrame([(w,) for w in words], "word binary").select("word", lm._class_column(F.col("word")).alias("k")).collect()
    assert all(r.k == zlib.crc32(bytes(r.word)[-2:]) % lm.CLASSES for r in rows)
