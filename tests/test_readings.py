"""Chosen lines, claims, paragraphs, labels and article bodies against loops and golden examples."""

import hashlib
import json
import random
import re

from pyspark.sql import functions as F

from quarryline.functions import briefs, metrics
from quarryline.operators.pages import json_ld_bodies
from quarryline.plans.catalogue import QUERIES

SF = "/root/testdata/sf0.001"


def word_set(t):
    return {w for w in re.sub(r"[^\w]+|_", " ", t.lower()).split(" ") if w}


def overlap(a, b):
    return len(a & b) / min(len(a), len(b)) if a and b else 0.0


def chosen(found):
    """The pick as a loop over the candidates."""
    taken = []

    def take(c):
        for t in taken:
            if overlap(set(t["words"]), set(c["words"])) > 0.68:
                return
            if t["role"] == c["role"] == "fact" and set(t["figures"]) & set(c["figures"]):
                return
        taken.append(c)

    for r in briefs.ROLES:
        for c in [c for c in found if c["role"] == r][:1]:
            take(c)
    for c in found:
        if len(taken) < 3:
            take(c)
    return [(c["line"], c["role"]) for c in taken[:3]]


def test_the_three_jobs_of_a_brief(spark):
    text = " ".join(
        [
            "Every vendor claims to be AI-powered, but few will show how their systems work.",
            "Worldwide spending is projected to reach $64 billion in 2026, up 63.4 percent from 2025.",
            "ARM-based rack-scale servers overtook x86 as the leading accelerated computing platform.",
            "This means buyers need to compare cost, performance, and operating efficiency before committing capacity.",
        ]
    )
    row = spark.createDataFrame([(text, "")], "t string, h string").select(briefs.pick(briefs.candidates(F.col("t"), F.col("h"))).alias("p")).first()
    assert [r.role for r in row.p] == ["fact", "change", "implication"] and not any("Every vendor" in r.line for r in row.p)


def test_picks_are_those_of_a_loop(spark):
    rng = random.Random(4)
    parts = ["revenue grew 12% to $3 billion", "the market shifted", "this means cost and risk", "analysts said so", "a plain remark about nothing much", "spending rose 12% in 2026", "launched a device", "according to a survey of people"]
    texts = [" ".join(" ".join(rng.sample(parts, 3)).capitalize() + f" number{rng.randrange(4)}." for _ in range(rng.randint(0, 9))) for _ in range(60)]
    texts += ["", None, "x" * 500 + ".", ". . . !", " ".join(["Revenue grew 12% to three billion in this quarter of the year."] * 5)]
    rows = spark.createDataFrame([(i, t, "revenue grew in the market") for i, t in enumerate(texts)], "id int, t string, h string")
    told = rows.select("id", briefs.candidates(F.col("t"), F.col("h")).alias("c")).select("id", "c", briefs.pick(F.col("c")).alias("p")).collect()
    assert len(told) == len(texts)
    for r in told:
        found = [c.asDict() for c in r.c or []]
        assert [tuple(x) for x in r.p or []] == chosen(found)
        assert [(c["rank"].score, c["rank"].place) for c in found] == sorted((c["rank"].score, c["rank"].place) for c in found)
    assert sum(len(r.p or []) == 3 for r in told) > 20


def test_older_lines_are_chosen_anew(spark):
    """By the registered query: lines of the current rule stay, others are those of the pick."""
    found = {r.doc_id: r for r in QUERIES["reselected_briefs"](spark, SF).collect()}
    picked = {}
    for r in QUERIES["brief_lines"](spark, SF).collect():
        picked.setdefault(r.doc_id, {})[r.place] = r.line
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "text").collect()
    for d in docs:
        version = int(d.source[-1]) % 4 if d.source and d.source[-1].isdigit() else None
        lines, r = [picked.get(d.doc_id, {})[k] for k in sorted(picked.get(d.doc_id, {}))], found[d.doc_id]
        old = (version or 0) < 3
        want = lines if old and len(lines) >= 2 else [d.text.split("\n")[0]]
        assert (r.changed, r.hidden, r.version) == (old, old and len(lines) < 2, 3 if old else version)
        assert r.sha == hashlib.sha256("\n".join(want).encode()).hexdigest() and r.lines == len(want)
    assert len({(r.changed, r.hidden) for r in found.values()}) >= 2


def test_scores_of_lines(spark):
    """Fact 8, change 5, implication 4, attribution 3, two a figure, three a title word, place and role."""
    lines = ["Revenue grew 12% to $3 billion, according to a market survey.", "This shifted because of the cost of the market and of devices."]
    found = spark.createDataFrame([(" ".join(lines), "Market outlook for robots")], "t string, h string").select(F.explode(briefs.candidates(F.col("t"), F.col("h"))).alias("c")).select("c.*").collect()
    assert {r.line: -round(r["rank"].score, 6) for r in found} == {lines[0]: 8 + 3 + 3 + 2 * 3 + 3 + 2, lines[1]: 5 + 4 + 3 + round(3 - 0.16, 6) + 2}


def test_unique_claims_in_order(spark):
    rng = random.Random(7)
    vocabulary = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta"]
    rows = [[" ".join(rng.choices(vocabulary, k=rng.randint(1, 6))) for _ in range(rng.randint(0, 12))] + ["  ", "!!", "!!"] for _ in range(50)] + [[None, "a b", "A, b!"]]

    def loop(claims):
        taken = []
        for c in (re.sub(r"\s+", " ", c or "").strip() for c in claims):
            if not c:
                continue
            key, words = re.sub(r"[\W_]+", "", c.lower()), {w for w in word_set(c) if len(w) >= 2}
            same = False
            for k, ws in ((re.sub(r"[\W_]+", "", t.lower()), {w for w in word_set(t) if len(w) >= 2}) for t in taken):
                inside = min(len(k), len(key)) >= 24 and (k in key or key in k)
                same |= bool(k and key) and (k == key or inside or overlap(ws, words) >= 0.82)
            if not same:
                taken.append(c)
        return taken

    frame = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "id int, c array<string>")
    assert {r.id: r.u for r in frame.select("id", briefs.unique_claims(F.col("c")).alias("u")).collect()} == {i: loop(r) for i, r in enumerate(rows)}


def test_paragraphs_that_repeat_go(spark):
    one = "The river carries stones and sand to the wide plain below the old town in spring."
    raw = [one, "<b>" + one + "</b>", one + " Indeed so.", "too short", "x" * 1700, "Subscribe to our newsletter and read all about the river, the stones and the sand.", "Another paragraph speaks of entirely different things, at a sufficient length for prose."]
    row = spark.createDataFrame([(raw,)], "r array<string>").select(briefs.paragraphs(F.col("r")).alias("p")).first()
    assert row.p == [one, raw[-1]]
    assert QUERIES["prose_paragraphs"](spark, SF).count() == spark.read.parquet(f"{SF}/pages.parquet").count()


def test_every_paragraph_of_a_long_page_stays(spark, tmp_path):
    """A page of seventy different paragraphs, each twice, has seventy."""
    told = [" ".join(f"word{i}x{j}" for j in range(12)) for i in range(70)]
    html = "".join(f"<p>{t}</p><li>{t}</li>" for t in told)
    spark.createDataFrame([(1, html), (2, f"<p>{told[0]}</p>"), (3, "")], "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    found = {r.page_id: (r.paragraphs, r.sha) for r in QUERIES["prose_paragraphs"](spark, str(tmp_path)).collect()}
    assert {k: v[0] for k, v in found.items()} == {1: 70, 2: 1, 3: 0}
    assert found[1][1] == hashlib.sha256("\n".join(told).encode()).hexdigest()


LINE = "The global AI note taking market size was calculated at USD 623.50 million in 2025 and is predicted to increase from USD 740.41 million in 2026 to approximately USD 3476.74 million by 2035, expanding at a CAGR of 18.75% from 2026 to 2035."


def labels(spark, lines, values):
    rows = spark.createDataFrame([(lines, values)], "l array<string>, v array<string>")
    return {r.value: (r.label, r.line) for r in rows.select(F.explode(metrics.labelled(F.col("l"), F.col("v"))).alias("m")).select("m.*").collect()}


def test_figures_of_one_sentence(spark):
    values = ["USD 623.50 million", "USD 740.41 million", "USD 3476.74 million", "18.75%", "2025", "2026", "2035"]
    found = {v: x[0] for v, x in labels(spark, [LINE], values).items()}
    assert [found[v] for v in values[:3]] == ["시장 규모 · 2025", "시장 규모 · 2026", "시장 규모 · 2035"]
    assert found["18.75%"] == "연평균 성장률 · 2026–2035" and found["2025"] == "기준 연도" and found["2035"] == "전망 연도"


def test_figures_of_several_kinds(spark):
    lines = ["We served it for 3 years.", "A survey of 1,200 respondents found that 40% would buy.", "40%", "It has 5 million users and sold 300 units.", "Backlog of $9 billion and $2 billion of capex.", "It weighs 12 tons"]
    found = labels(spark, lines, ["3 years", "1,200 respondents", "40%", "5 million", "300 units", "$9 billion", "$2 billion", "12", "77"])
    assert {v: x[0] for v, x in found.items()} == {
        "3 years": "경력 기간", "1,200 respondents": "응답자 수", "40%": "응답자 수", "5 million": "이용자 수", "300 units": "출하량",
        "$9 billion": "수주잔고", "$2 billion": "설비투자", "12": "시장 물량", "77": "정량 지표",
    }
    assert found["40%"][1] == lines[1] and found["77"][1] == ""


def test_nearest_rule_like_a_loop(spark):
    rng = random.Random(2)
    words = ["revenue", "market", "capex", "backlog", "and", "the", "cost", "of", "valuation", "worth", "spending", "daily revenue", "growth by"]
    rows = []
    for i in range(120):
        parts = [rng.choice(words) for _ in range(rng.randint(0, 9))]
        parts.insert(rng.randint(0, len(parts)), "$5 bn")
        rows.append((i, " ".join(parts), "$5 bn"))
    want = {}
    for i, line, value in rows:
        at = line.lower().index(value)
        best = None
        for priority, (pattern, label) in enumerate(metrics.MONEY_RULES):
            for m in re.finditer(pattern, line, re.I):
                apart = at - m.end() if m.end() <= at else m.start() - at - len(value) if m.start() >= at + len(value) else 0
                if best is None or (apart, priority) < best[:2]:
                    best = (apart, priority, label)
        want[i] = best and best[2]
    frame = spark.createDataFrame(rows, "id int, l string, v string")
    assert {r.id: r.x for r in frame.select("id", metrics.nearest_label(F.col("l"), F.col("v"), metrics.MONEY_RULES).alias("x")).collect()} == want


def test_bodies_of_any_nesting(spark):
    rng = random.Random(3)
    count = iter(range(10**6))

    def node(depth):
        kind = rng.randrange(7) if depth else 0
        if kind == 0:
            return {"articleBody": f"body {next(count)} " + "words " * rng.choice([1, 30])}
        if kind == 1:
            return rng.choice([None, 5, "text", True, {"articleBody": 9}, {"@graph": {"articleBody": "not a list"}}, []])
        if kind < 4:
            return [node(depth - 1) for _ in range(rng.randrange(4))]
        return {"a": 1, "@graph": [node(depth - 1) for _ in range(rng.randrange(4))], **({"articleBody": f"own {next(count)} " + "words " * 30} if kind == 6 else {})}

    def walk(x, out):
        if isinstance(x, list):
            for y in x:
                walk(y, out)
        elif isinstance(x, dict):
            if isinstance(x.get("articleBody"), str):
                out.append(x["articleBody"])
            if isinstance(x.get("@graph"), list):
                for y in x["@graph"]:
                    walk(y, out)

    rows, want = [], []
    for i in range(60):
        scripts, out = [node(4) for _ in range(rng.randrange(3))], []
        for s in scripts:
            walk(s, out)
        html = "<p>x</p>".join(f"<SCRIPT id=a type='application/ld+json' >{json.dumps(s)}</script><script>var x=1</script>" for s in scripts)
        rows.append((i, html + '<script type="application/ld+json">{"articleBody": broken</script>'))
        want += [(i, k + 1, b.strip()) for k, b in enumerate(b for b in out if len(b.strip()) >= 120)]
    rows += [(100, None), (101, "")]
    got = sorted(tuple(r) for r in json_ld_bodies(spark.createDataFrame(rows, "id int, html string"), "id", "html").collect())
    assert got == want and len(want) > 20
    assert json_ld_bodies(spark.createDataFrame([(1, "no script")], "id int, html string"), "id", "html").count() == 0
