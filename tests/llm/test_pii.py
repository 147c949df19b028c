import math
import random
import re

from tests.llm.helpers import awkward, empty

from quarryline.llm import pii

PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def good(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        double = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in double) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def slow(text):
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS for m in re.finditer(p, text or "") if good(k, m[0]))


HARD = [
    "a@b.c_d@e.f x@y a.b@c-d.e.f. q@@r.s é@x.y ü.a@b.co",
    "a@b.c@d.e@f.g and 1.2.3.4@h.i",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.0004 1.2.3 0255.1.1.1 99999999999.1.1.1",
    "4111 1111 1111 1111 and 4111-1111-1111-1111-1 then 41111111111111111111111 5500005555555559 4 1 1 1",
    "378282246310005 4111 1111  1111 1111 1-2-3 4111111111111111-",
    "+1 (017) 555-7713 +12 +1234567890123456 +1-2-3-4-5-6-7-8-9. ++49 30 1234567 +1 2 3 4 5 6 7 8 9 (",
    "😀 +49 170 1234567 mail.me@exämple.com me@example.com 10.0.0.1",
    "9" * 20_000,
    "4 " * 20_000,
    "a." * 20_000 + "@b.c",
    "+" * 5_000 + "1" * 12,
]


def test_base_spans_are_those_of_the_plain_patterns(spark):
    docs = spark.createDataFrame(list(enumerate([*HARD, None, ""])), "doc_id int, text string")
    rows = pii.base_spans(docs).select("doc_id", "text", pii.listed(pii.KINDS[:4]).alias("spans")).collect()
    for r in rows:
        assert r.spans == slow(r.text), (r.text or "")[:80]


def test_terms_that_disclose(spark):
    filler = ["river", "stone", "cloud", "grass", "paper", "light", "table", "green"]
    rows = []
    for i in range(40):
        a, b, c = filler[i % 8], filler[(i * 3 + 1) % 8], filler[(i * 5 + 2) % 8]
        rows.append((i, f"The {a} and the {b} near {c} number{i}."))
    for i, word in enumerate(filler[:4]):
        rows.append((100 + i, f"The {word} note{i}: Zanzibarov at zed@mail.example.org, the {filler[i + 2]}."))
    rows.append((200, "Elsewhere ZANZIBAROV walks, zanzibarovs don't."))
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    terms = {r.term for r in pii.disclosing_terms(docs).collect()}
    assert terms == {"zanzibarov"}
    found = {r.doc_id: r for r in pii.find_pii(docs, pii.disclosing_terms(docs)).collect()}
    assert [(s.start, s.end) for s in found[200].term] == [(10, 20)]
    assert [s.value for s in found[101].term] == ["Zanzibarov"] and not found[5].term
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert clean[200] == "Elsewhere [TERM] walks, zanzibarovs don't."
    assert "[EMAIL]" in clean[101] and "zed@" not in clean[101] and clean[5] == rows[5][1]


def test_awkward_rows(spark):
    docs = awkward(spark)
    clean = pii.sanitise(docs)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    text = {r.doc_id: r.text for r in clean.collect()}
    assert text[20] is None and text[21] == "" and text[3] == {r.doc_id: r.text for r in docs.collect()}[3]
    assert pii.sanitise(empty(spark)).count() == 0


def test_disclosure_against_brute_force(spark):
    rng = random.Random(6)
    common, rare = [f"word{chr(97 + i)}" for i in range(12)], [f"rare{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(500)]
    texts = []
    for i in range(300):
        words = rng.choices(common, k=25)
        for _ in range(3):
            words.insert(rng.randrange(25), rng.choice(rare))
        if i % 4 == 0:
            words.insert(rng.randrange(25), f"p{rng.randrange(30)}@mail{i % 3}.example.org")
        texts.append(" ".join(words))
    texts += texts[:40] + [None, ""]  # copies count once
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.term: r.disclosure for r in pii.disclosing_terms(docs, window=20).collect()}

    every = {t or "" for t in texts}
    word = re.compile(r"[^\W_]{3,}")
    contexts = {}
    for t in every:
        for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
            left, right = t[max(0, m.start() - 20) : m.start()], t[m.end() : m.end() + 20]
            if m.start() > 20:
                left = re.sub(r"^[^\W_]+", "", left)
            if len(right) == 20:
                right = re.sub(r"[^\W_]+$", "", right)
            contexts.setdefault(m[0].lower(), set()).add(f"{left} \0 {right}".lower())
    want = {}
    for near in contexts.values():
        for term in {w for c in near for w in word.findall(c)}:
            n_te = sum(term in word.findall(c) for c in near)
            n_t = sum(term in word.findall(t.lower()) for t in every)
            content, left_open = math.log2(len(every) / len(near)), math.log2(max(n_t, n_te) / (n_te - 0.5))
            if content > 0 and left_open <= 1.5 and 1 - left_open / content >= 0.85:
                want[term] = max(want.get(term, 0), 1 - left_open / content)
    assert want and got.keys() == want.keys() and all(abs(got[t] - want[t]) < 1e-9 for t in want)


def test_terms_are_found_on_the_given_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    found = pii.find_pii(docs, pii.disclosing_terms(docs))
    held = found.where("size(term) > 0").collect()
    assert len(held) > 20 and found.count() == docs.count()
    assert all(r.text[s.start : s.end] == s.value for r in held for s in r.term)


def test_redaction_of_overlaps(spark):
    docs = spark.createDataFrame([(1, "call +4111111111111111 or 10.0.0.1, a@b.co!"), (2, "4111111111111111@b.co")], "doc_id int, text string")
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert clean[1] == "call +[CARD] or [IP], [EMAIL]!" and clean[2] == "[CARD]"  # the first span that ends names the stretch


def test_clashing_columns_stay(spark):
    docs = spark.createDataFrame([(1, "to a@b.co", "mine", 7, "x")], "doc_id int, text string, email string, term int, `a.b` string")
    assert tuple(pii.sanitise(docs).first()) == (1, "to [EMAIL]", "mine", 7, "x")


def test_columns_that_look_like_ours_stay(spark):
    docs = spark.createDataFrame([(1, "a@b.example.org", "x", "y")], "doc_id int, text string, _email string, __ip string")
    found = pii.base_spans(docs).first()
    assert found["_email"] == "x" and found["__ip"] == "y" and len(found.email) == 1
    assert pii.find_pii(docs, spark.createDataFrame([], "term string, disclosure double")).first()["_email"] == "x"


def test_terms_in_a_long_text(spark):
    """A text of many words meets its terms once, and copies keep their own rows."""
    long = " ".join(f"w{i}" for i in range(30_000)) + " Zanzibarov"
    docs = spark.createDataFrame([(1, long), (2, long), (2, long), (3, "zanzibarov zanzibarov"), (4, None)], "doc_id int, text string")
    terms = spark.createDataFrame([("zanzibarov", 0.9), ("w7777", 0.9)], "term string, disclosure double")
    found = sorted((r.doc_id, len(r.term)) for r in pii.find_pii(docs, terms).collect())
    assert found == [(1, 2), (2, 2), (2, 2), (3, 2), (4, 0)]
