"""Personal data: patterns, and information-theoretic sanitisation around them.

Everything here is DataFrame functions.  The base finds e-mail addresses, IP
addresses, card and phone numbers.  Each distinct value is a protected entity
``e``.  A term ``t`` (a word near an occurrence) discloses it by how much of the
entity's information content it gives away,

    PMI(t; e) / IC(e) = 1 - log2(n(t) / n(t, e)) / log2(N / n(e)),

with ``N`` the distinct texts, ``n(t)`` those with the term, and ``n(e)`` and
``n(t, e)`` the distinct contexts of the entity and of the term beside it, less
half a context: what was seen once may be chance.  A term discloses if this share
reaches a threshold and what stays uncertain, ``log2(n(t) / n(t, e))``, is at most
some bits; so one seen beside a single entity must stand nowhere else.  It is then
a span of kind ``term`` wherever it stands: a word with digits is removed, another
generalised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.workspace import Workspace

#: Kinds in the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone", "term")

# Java patterns that give the same matches as the plain ones, in linear time:
# a run is tried from its first character only, and possessively.
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"[0-9](?<![0-9]{2})[0-9]*+(?:\.[0-9]++){3}"
_CARD = r"[0-9](?<![0-9]{2})(?<![0-9][ -][0-9])(?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])"
_PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
_TERM = r"[\p{L}\p{N}]{3,}"

#: Terms that are broadcast; more of them meet the words in a shuffle.
SMALL = 200_000

_SPANS = "array<struct<start:int,end:int,value:string>>"


def _spans(text: Column, pattern: str | Column, matches: Column) -> Column:
    """Starts and ends, in code points, of the matches of a pattern."""
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))
    pairs = F.zip_with(gaps, matches, lambda g, m: F.struct(F.length(g).alias("gap"), m.alias("value")))
    none = F.array().cast(_SPANS)
    walk = F.aggregate(
        pairs,
        F.struct(F.lit(0).alias("at"), none.alias("out")),
        lambda acc, p: F.struct(
            (acc["at"] + p["gap"] + F.length(p["value"])).alias("at"),
            F.array_append(
                acc["out"],
                F.struct(
                    (acc["at"] + p["gap"]).alias("start"),
                    (acc["at"] + p["gap"] + F.length(p["value"])).alias("end"),
                    p["value"].alias("value"),
                ),
            ).alias("out"),
        ),
        lambda acc: acc["out"],
    )
    return F.when(F.size(matches) > 0, walk).otherwise(none)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = F.reverse(F.split(_digits(value), ""))
    each = F.transform(
        F.filter(digits, lambda d: d != ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2) % 10 + (d.cast("int") * 2 / 10).cast("int")),
    )
    return F.aggregate(each, F.lit(0), lambda a, d: a + d) % 10 == 0


def base_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with array columns ``email``, ``ip``, ``card`` and ``phone`` of
    (start, end, value).  Null texts count as empty; every text is read whole.
    Columns of ``docs`` that have a kind's name are replaced, all others stay."""
    mark = "_"
    while any(f"{mark}{k}" in docs.columns for k in KINDS):
        mark += "_"
    text = F.coalesce(F.col(text_col), F.lit(""))
    none = F.array().cast("array<string>")

    def found(pattern: str, sign: str | None = None) -> Column:
        every = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        return F.when(F.contains(text, F.lit(sign)), every).otherwise(none) if sign else every

    hits = docs.withColumns({f"{mark}email": found(_EMAIL, "@"), f"{mark}ip": found(_IP, "."), f"{mark}card": found(_CARD), f"{mark}phone": found(_PHONE, "+")})
    placed = hits.withColumns({k: _spans(text, p, F.col(f"`{mark}{k}`")) for k, p in (("email", _EMAIL), ("ip", _IP), ("card", _CARD), ("phone", _PHONE))})
    byte = lambda part: (F.length(F.regexp_replace(part, "^0+", "")) <= 3) & (F.substring(F.concat(F.lit("000"), part), -3, 3).cast("int") <= 255)
    digits = lambda s: F.length(_digits(s["value"]))
    return placed.withColumns(
        {
            "ip": F.filter("ip", lambda s: F.forall(F.split(s["value"], r"\."), byte)),
            "card": F.filter("card", lambda s: _luhn(s["value"])),
            "phone": F.filter("phone", lambda s: digits(s).between(9, 15)),
        }
    ).drop(*[f"{mark}{k}" for k in KINDS[:4]])


def _contexts(spotted: DataFrame, window: int) -> DataFrame:
    """One row for each distinct context of an entity: ``entity, context, terms``
    and ``doc``, the identity of a text that holds it."""
    def named(kind: str) -> Column:
        plain = F.lower if kind in ("email", "ip") else _digits
        return F.transform(
            kind,
            lambda s: F.struct(F.concat(F.lit(f"{kind}:"), plain(s["value"])).alias("entity"), s["start"].alias("start"), s["end"].alias("end")),
        )

    one = spotted.select("text", "doc", F.explode(F.concat(*map(named, KINDS[:4]))).alias("s"))
    left = F.substring("text", F.greatest(F.col("s.start") + 1 - window, F.lit(1)), F.least(F.col("s.start"), F.lit(window)))
    left = F.when(F.col("s.start") > window, F.regexp_replace(left, r"^[\p{L}\p{N}]+", "")).otherwise(left)
    right = F.substring("text", F.col("s.end") + 1, F.lit(window))
    right = F.when(F.length(right) == window, F.regexp_replace(right, r"[\p{L}\p{N}]+$", "")).otherwise(right)
    near = one.select("doc", F.col("s.entity").alias("entity"), F.lower(F.concat(left, F.lit(" \u0000 "), right)).alias("near"))
    terms = F.array_distinct(F.regexp_extract_all("near", F.lit(_TERM), F.lit(0)))
    return near.groupBy("entity", "near").agg(F.min("doc").alias("doc")).select("entity", "doc", terms.alias("terms"))


def _identity(*columns: str) -> Column:
    """128 bits that tell rows apart by their columns."""
    names = [F.col(f"`{c}`") for c in columns]
    return F.struct(F.xxhash64(*names).alias("a"), F.xxhash64(F.lit(1), *names).alias("b"))


def _words(rows: DataFrame, text: str, terms: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and ``term`` for each of ``terms`` that is a word of the text, once a row."""
    words = rows.select(*keep, F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(_TERM), F.lit(0)))).alias("term"))
    few = terms.select("term").limit(SMALL + 1).count() <= SMALL
    return words.join(F.broadcast(terms.select("term")) if few else terms.select("term"), "term", "left_semi")


def disclosing_terms(docs: DataFrame, window: int = 64, threshold: float = 0.85, bits: float = 1.5, text_col: str = "text") -> DataFrame:
    """``term, disclosure``: the lower-cased terms that disclose some entity.

    Counts are over all texts of ``docs``, copies once; null and empty texts hold no
    entity, and a table without any gives no term, as does an empty one.  Equal
    disclosures don't compete: every term over the threshold is returned, once.
    ``window`` is in code points on each side; ``threshold`` is the least share of an entity's
    information that a term gives away, and ``bits`` the most that may stay open.
    """
    work = Workspace(docs.sparkSession, "pii")
    texts = docs.select(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")).withColumn("doc", _identity("text"))
    content = F.log2(F.lit(texts.select("doc").distinct().count()) / F.col("n_e"))

    def open_bits(n_t: Column) -> Column:
        return F.log2(F.greatest(n_t, F.col("n_te")) / (F.col("n_te") - 0.5))

    def discloses(n_t: Column) -> Column:
        return (content > 0) & (1 - open_bits(n_t) / content >= threshold) & (open_bits(n_t) <= bits)

    spotted = base_spans(texts).where(" or ".join(f"size({k}) > 0" for k in KINDS[:4]))
    near = work.keep(_contexts(spotted, window), "contexts")
    entities = near.groupBy("entity").agg(F.count("*").alias("n_e"))
    beside = near.select("entity", "doc", F.explode("terms").alias("term"))
    pairs = beside.groupBy("entity", "term").agg(F.count("*").alias("n_te")).join(entities, "entity")
    # texts with the term beside any entity are some of those with the term, so
    # what falls short with their number needs no count over all words
    least = beside.groupBy("term").agg(F.count_distinct("doc").alias("n_least"))
    pairs = work.keep(pairs.join(least, "term").where(discloses(F.col("n_least"))), "pairs")
    if pairs.isEmpty():
        return docs.sparkSession.createDataFrame([], "term string, disclosure double")
    held = _words(texts, "text", work.keep(pairs.select("term").distinct(), "candidates"), "doc")
    known = pairs.join(held.distinct().groupBy("term").agg(F.count("*").alias("n_t")), "term")
    told = known.where(discloses(F.col("n_t"))).groupBy("term").agg(F.max(1 - open_bits(F.col("n_t")) / content).alias("disclosure"))
    return work.keep(told, "terms")


def find_pii(docs: DataFrame, terms: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the arrays of :func:`base_spans` and one more, ``term``, of
    the occurrences of ``terms`` outside the base spans.

    Rows are told apart by 128 bits over all their columns; equal rows have equal
    spans, and stay as often as they are there.  Without any term the texts
    aren't searched for them.  Columns of ``docs`` that have a kind's name are
    replaced.  Null texts are empty, and an empty table gives no rows.
    """
    none = F.array().cast(_SPANS)
    if terms.isEmpty():
        return base_spans(docs, text_col).withColumn("term", none)
    work = Workspace(docs.sparkSession, "pii")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    plain = docs.select(_identity(*docs.columns).alias("key"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    # words travel with the keys alone; the texts meet their terms once
    held = _words(plain, "text", terms, "key").groupBy("key").agg(F.sort_array(F.collect_set("term")).alias("terms"))
    rows = docs.select(whole.alias("row"), _identity(*docs.columns).alias("key")).join(work.keep(held, "held"), "key", "left")
    rows = rows.select("row", "terms", F.coalesce(F.col("row").getField(text_col), F.lit("")).alias("text"))

    def spots(term: Column) -> Column:
        pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])\Q"), term, F.lit(r"\E(?![\p{L}\p{N}])"))
        return _spans(F.col("text"), pattern, F.regexp_extract_all("text", pattern, F.lit(0)))

    found = base_spans(rows.withColumn("term", F.array_distinct(F.flatten(F.transform("terms", spots)))))
    others = F.concat(*KINDS[:4])
    apart = F.filter(F.coalesce("term", none), lambda t: ~F.exists(others, lambda b: (t["start"] < b["end"]) & (b["start"] < t["end"])))
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in KINDS]
    return found.select(*kept, *KINDS[:4], F.array_sort(apart).alias("term"))


def listed(kinds: tuple[str, ...] = KINDS) -> Column:
    """``kind:start:end`` of the spans of ``kinds``, joined by commas."""

    def each(kind: str) -> Column:
        return F.transform(kind, lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"]))

    return F.array_join(F.concat(*map(each, kinds)), ",")


def redacted(text: Column) -> Column:
    """The text with its spans replaced; overlapping ones become the first's label.
    Words with digits that disclose are removed, other terms generalised."""
    label = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}

    def struct(s: Column, text: Column) -> Column:
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), text.alias("label"))

    def fixed(kind: str) -> Column:
        return F.transform(kind, lambda s: struct(s, F.lit(label[kind])))

    parts = [*map(fixed, label), F.transform("term", lambda s: struct(s, F.when(s["value"].rlike("[0-9]"), "").otherwise("[TERM]")))]
    spans = F.array_sort(F.concat(*parts))
    made = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.substr(text, acc["at"] + 1, s["start"] - acc["at"]), s["label"])).otherwise(acc["out"]).alias("out"),
        ),
        lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1)),
    )
    return F.when(F.size(spans) > 0, made).otherwise(text)


def sanitise(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the personal data in ``text_col`` replaced; same columns.
    Null texts stay null."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    packed = docs.select(row.alias("_row"), F.col(text_col).alias("_text"))  # so that no column clashes with the spans
    found = find_pii(packed, disclosing_terms(docs, text_col=text_col, **options), "_text")
    clean = redacted(F.col("_text"))
    return found.select(*[clean.alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
