"""Lines chosen from a text so that they don't repeat each other, as columns.

Lines are scored as an array, sorted once, and folded: a line is taken unless it
is too like the lines taken before it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarryline.functions import text as tx

#: Terms of a fact, a change and an implication, of attributed lines,
#: of page furniture and of openings that say nothing.
FACT = (
    r"(?i)(?:\$|€|£|\b\d+(?:\.\d+)?\s*(?:%|percent|per cent|billion|million|trillion|basis points?|bps|years?|months?)\b|"
    r"\b(?:forecast|forecasted|project(?:s|ed|ion)?|estimate(?:s|d)?|expect(?:s|ed)?|reached|total(?:s|ed)?|grew|growth|rose|fell|"
    r"declin(?:e|ed|ing)|increase(?:d)?|decrease(?:d)?|up|down|share|spending|revenue|sales|demand|supply|capacity|capex|investment|adoption|usage)\b)"
)
CHANGE = (
    r"(?i)\b(?:overtook|surpassed|shift(?:ed|ing)?|moved|launched|introduced|expanded|accelerat(?:ed|ing)|transition(?:ed|ing)?|"
    r"displace(?:d|s|ment)|prioriti[sz](?:ed|ing)|tight(?:ened|ness)|eas(?:ed|ing)|recover(?:ed|y)|normaliz(?:ed|ing)|restore(?:d|s|ing)?|rebalance(?:d|s|ing)?)\b"
)
IMPACT = (
    r"(?i)\b(?:therefore|consequently|means?|because|driven by|due to|impact|risk|pressure|benefit|supports?|enables?|requires?|"
    r"need(?:s|ed)?|helps?|competition|cost|margin|efficien(?:cy|t))\b"
)
ATTRIBUTED = r"(?i)\b(?:according to|reported|said|announced|survey|tracker|study|research)\b"
JUNK = [
    "advertisement", "advertising", "affiliate commission", "purchase through links", "subscribe", "sign up", "read more", "cookie",
    "privacy policy", "all rights reserved", "share this article", "follow us", "related articles?", "news tips", "newsletters?",
    "get this delivered to your inbox", "confidential news tip", "data is a real-time snapshot", "global business and financial news",
    "stock quotes and market data", "sorry, an error occurred while processing your request", "request a demo",
]
OPENINGS = ["every vendor claims", "this is what actually happens", "stay ahead in a rapidly evolving market", "thanks for joining", "trading floor"]
IGNORED = ["the", "and", "with", "from", "that", "this", "will", "into", "over", "says", "said", "how", "for"]
NUMERIC = r"(?i)(?:\$|€|£)?\d+(?:\.\d+)?(?:%|percent|per cent|billion|million|trillion|bp|bps)?"
ROLES = ("fact", "change", "implication")


def _any_of(phrases: list[str]) -> str:
    return r"(?i)(?:^|\b)(?:" + "|".join(phrases) + r")(?:\b|$)"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once however often it is used: Spark
    doesn't share what stands in several places of one expression with lambdas."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words(text: Column) -> Column:
    """Distinct words of letters and digits, lower-cased."""
    return F.array_distinct(F.filter(F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != ""))


def unique_in_order(items: Column, repeats: Callable[[Column, Column], Column]) -> Column:
    """The elements of an array without those that ``repeats(taken, element)`` says
    repeat one taken before; the order stays."""

    def take(taken: Column, item: Column) -> Column:
        return F.when(F.exists(taken, lambda t: repeats(t, item)), taken).otherwise(F.array_append(taken, item))

    return bound(items, lambda every: F.aggregate(every, F.slice(every, 1, 0), take))


def unique_claims(claims: Column, least: float = 0.82) -> Column:
    """The claims of an array, each said once: nulls and blanks go, and so does what
    has an earlier one's letters, holds it or is held by it (from 24 characters
    on), or shares enough of the smaller one's words of two letters and more."""
    told = F.transform(F.filter(F.transform(claims, tx.clean), lambda c: c != ""), lambda c: claim(c, c))
    return F.transform(unique_in_order(told, lambda a, b: same_claim(a, b, least)), lambda t: t["item"])


def claim(item: Column, text: Column) -> Column:
    """``item`` with what :func:`same_claim` compares of its text: letters and digits, and
    the distinct words of two and more."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " ")
    told = lambda p: F.struct(
        item.alias("item"), F.replace(p, F.lit(" "), F.lit("")).alias("key"), F.array_distinct(F.filter(F.split(p, " "), lambda w: F.length(w) >= 2)).alias("words")
    )
    return bound(plain, told)


def same_claim(a: Column, b: Column, least: float = 0.82, window: int = 24) -> Column:
    """Whether two claims have the same letters, one holds the other (from ``window``
    characters on), or they share ``least`` of the smaller one's words."""
    x, y = a["key"], b["key"]
    within = (F.least(F.length(x), F.length(y)) >= window) & (F.contains(x, y) | F.contains(y, x))
    return (x != "") & (y != "") & ((x == y) | within | (tx.overlap(a["words"], b["words"]) >= least))


def role(line: Column) -> Column:
    """What a line is for: an implication comes before a change, and that before a fact."""
    return F.when(line.rlike(IMPACT), "implication").when(line.rlike(CHANGE), "change").when(line.rlike(FACT), "fact").otherwise("evidence")


def _score(line: Column, place: Column, kind: Column, about: Column, told: Column) -> Column:
    met = F.least(F.size(F.array_intersect(about, told)), F.lit(4)) * 3
    figures = F.least(F.size(F.regexp_extract_all(line, F.lit(r"(?:\$|€|£|\b\d)"), F.lit(0))), F.lit(4)) * 2
    terms = sum((F.when(line.rlike(p), n).otherwise(0) for p, n in ((FACT, 8), (CHANGE, 5), (IMPACT, 4), (ATTRIBUTED, 3))), F.lit(0))
    return terms + met + figures + F.greatest(F.lit(0.0), F.lit(3.0) - place * F.lit(0.16)) + F.when(kind == "evidence", 0).otherwise(2)


def candidates(text: Column, title: Column) -> Column:
    """The lines of a text that may be chosen, best first: ``rank, line, role, words, figures``.

    A line has 45 to 460 characters, is no page furniture or empty opening, and
    doesn't say what the title says.
    """
    return bound(words(title), lambda t: bound(F.filter(t, lambda w: (F.length(w) >= 4) & ~w.isin(IGNORED)), lambda about: _candidates(text, t, about)))


def _candidates(text: Column, title: Column, about: Column) -> Column:
    # the cheap tests come before the words
    sized = F.filter(F.transform(tx.sentences(text), lambda s, i: F.struct(s.alias("line"), i.alias("place"))), lambda c: F.length(c["line"]).between(45, 460))
    plain = F.filter(sized, lambda c: ~c["line"].rlike(_any_of(JUNK)) & ~c["line"].rlike(_any_of(OPENINGS)))
    placed = F.transform(plain, lambda c: F.struct(c["line"].alias("line"), c["place"].alias("place"), words(c["line"]).alias("words"), role(c["line"]).alias("role")))
    fit = F.filter(placed, lambda c: tx.overlap(c["words"], title) < 0.87)

    def told(c: Column) -> Column:
        figures = F.transform(F.regexp_extract_all(c["line"], F.lit(NUMERIC), F.lit(0)), lambda t: F.regexp_replace(F.lower(t), r"\s+", ""))
        rank = F.struct((-_score(c["line"], c["place"], c["role"], about, c["words"])).alias("score"), c["place"].alias("place"))
        return F.struct(rank.alias("rank"), c["line"].alias("line"), c["role"].alias("role"), c["words"].alias("words"), F.filter(figures, lambda t: ~t.rlike(r"^20[23]\d$")).alias("figures"))

    return F.array_sort(F.transform(fit, told))


def _of_role(name: str, c: Column) -> Column:
    return c["role"] == name


def pick(found: Column, most: int = 3, alike: float = 0.68) -> Column:
    """At most ``most`` of the candidates: the best of each role first, then the best
    of all, none too like one that was taken, and no fact with a taken fact's figures.
    Elements are ``line, role``."""
    return bound(found, lambda f: _picked(f, most, alike))


def _picked(found: Column, most: int, alike: float) -> Column:
    firsts = F.array(*[F.try_element_at(F.filter(found, partial(_of_role, r)), F.lit(1)) for r in ROLES])
    queue = F.concat(F.filter(firsts, lambda c: c.isNotNull()), found)

    def repeats(taken: Column, c: Column) -> Column:
        fact = (taken["role"] == "fact") & (c["role"] == "fact") & F.arrays_overlap(taken["figures"], c["figures"])
        return (tx.overlap(taken["words"], c["words"]) > alike) | F.coalesce(fact, F.lit(False))

    chosen = F.aggregate(
        queue,
        F.slice(found, 1, 0),
        lambda taken, c: F.when((F.size(taken) >= most) | F.exists(taken, lambda t: repeats(t, c)), taken).otherwise(F.array_append(taken, c)),
    )
    return F.transform(chosen, lambda c: F.struct(c["line"].alias("line"), c["role"].alias("role")))


def paragraphs(raw: Column, alike: float = 0.94) -> Column:
    """The paragraphs of a page that are prose: 55 to 1600 characters, no page
    furniture, none that is nearly an earlier one; all of them, however many."""
    told = F.transform(F.transform(raw, tx.strip_html), lambda p: F.struct(p.alias("text"), words(p).alias("words")))
    prose = F.filter(told, lambda p: F.length(p["text"]).between(55, 1600) & ~p["text"].rlike(_any_of(JUNK)))

    def first(prose: Column) -> Column:
        return F.filter(prose, lambda p, i: ~F.exists(F.slice(prose, F.lit(1), i), lambda q: tx.overlap(q["words"], p["words"]) > alike))

    return F.transform(bound(prose, first), lambda p: p["text"])


def reselected(text: Column, title: Column, lines: Column, version: Column, current: int, least: int) -> Column:
    """``lines, version, changed, hidden`` of a row whose lines were chosen by a rule of
    some ``version``: an older rule's lines are chosen anew, and a row is hidden if
    fewer than ``least`` come out.  Rows of the current rule, or without a text, stay."""
    old = text.isNotNull() & (F.coalesce(version, F.lit(0)) < current)

    def told(new: Column) -> Column:
        short = F.size(new) < least
        return F.struct(
            F.when(old & ~short, F.transform(new, lambda c: c["line"])).otherwise(lines).alias("lines"),
            F.when(old, F.lit(current)).otherwise(version).alias("version"),
            old.alias("changed"),
            (old & short).alias("hidden"),
        )

    # only an older rule's rows are looked at
    return bound(F.when(old, pick(candidates(text, title))), told)
