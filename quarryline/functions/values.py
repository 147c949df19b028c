"""Quantities, dates, classes and scores as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Patterns of literal quantities, in the order in which they count.
QUANTITIES = (
    r"(?i)(?:US\$|USD|\$|€|£|¥|₩|₹|R\$)\s?\d[\d,.]*(?:\s?(?:trillion|billion|million|thousand|trn|bn|mn|T|B|M))?",
    r"(?i)\b\d+(?:\.\d+)?\s?%|\b\d+(?:\.\d+)?\s?(?:percent|per cent|basis points?|bps)\b",
    r"(?i)\b\d[\d,.]*(?:\s?(?:trillion|billion|million|thousand|trn|bn|mn|T|B|M|k))\b",
    r"\b20(?:1\d|2\d|3\d)\b",
    r"(?i)\b\d+(?:\.\d+)?\s?(?:years?|months?|days?|hours?|users?|consumers?|respondents?|shipments?|units?|devices?|people|adults?)\b",
)
NUMBER = r"\d+(?:[.,]\d+)*"


def quantities(text: Column) -> Column:
    """Distinct literal quantities of a text, pattern by pattern."""
    found = [F.regexp_extract_all(text, F.lit(p), F.lit(0)) for p in QUANTITIES]
    return F.array_distinct(F.transform(F.concat(*found), lambda t: F.trim(F.regexp_replace(t, r"\s+", " "))))


def repaired_json(text: Column) -> Column:
    """What lies between the outermost braces of an answer, without code fences; null
    if that is no JSON object."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?i)```(?:json)?", " ")
    inner = F.regexp_extract(bare, r"(?s)(\{.*\})", 1)
    # within an array, so that what follows a first object counts too
    whole = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), inner, F.lit("]"))), "$", "array<variant>")
    return F.when(F.size(whole) == 1, inner)


def numbers(text: Column) -> Column:
    """Distinct numeric tokens of a text."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(NUMBER), F.lit(0)))


def unsupported_numbers(claim: Column, evidence: Column) -> Column:
    """Numbers of a claim that its evidence doesn't have."""
    return F.array_except(numbers(claim), numbers(evidence))


def money(text: Column) -> Column:
    """A display amount such as ``$1.2B`` as a decimal; null if it is none."""
    sign = F.lower(F.regexp_extract(text, r"(?i)\d\s?(trillion|billion|million|thousand|trn|bn|mn|t|b|m|k)", 1))
    factor = (
        F.when(sign.isin("trillion", "trn", "t"), 1_000_000_000_000)
        .when(sign.isin("billion", "bn", "b"), 1_000_000_000)
        .when(sign.isin("million", "mn", "m"), 1_000_000)
        .when(sign.isin("thousand", "k"), 1_000)
        .otherwise(1)
    )
    amount = F.regexp_replace(F.regexp_extract(text, r"(\d[\d,]*(?:\.\d+)?)", 1), ",", "")
    return F.when(amount != "", amount.cast("decimal(20,6)") * factor.cast("decimal(15,0)")).cast("decimal(38,6)")


def partial_date(raw: Column) -> Column:
    """``from`` (ISO date or null) and ``precision`` of a full or partial date."""
    v = F.trim(F.coalesce(raw, F.lit("")))
    yy = F.regexp_extract(v, r"^'(\d{2})", 1)
    year = F.concat(F.when(yy >= "70", "19").otherwise("20"), yy)
    month = F.regexp_extract(v, r"^'\d{2}\.(\d{1,2})$", 1)
    day, ym, y = v.rlike(r"^\d{4}-\d{2}-\d{2}"), v.rlike(r"^\d{4}-\d{2}$"), v.rlike(r"^\d{4}$")
    short, short_month = v.rlike(r"^'\d{2}$"), v.rlike(r"^'\d{2}\.\d{1,2}$")
    start = (
        F.when(day, F.substring(v, 1, 10))
        .when(ym, F.concat(v, F.lit("-01")))
        .when(y, F.concat(v, F.lit("-01-01")))
        .when(short, F.concat(year, F.lit("-01-01")))
        .when(short_month, F.concat(year, F.lit("-"), F.lpad(month, 2, "0"), F.lit("-01")))
    )
    precision = F.when(day, "day").when(ym | short_month, "month").when(y | short, "year").otherwise("unknown")
    return F.struct(start.alias("from"), precision.alias("precision"))


def age_days(ts: Column, ref: Column, unknown: float | None = None) -> Column:
    """Whole days from ``ts`` to ``ref``, not under 0; ``unknown`` where there is none."""
    return F.coalesce(F.greatest(F.datediff(ref, ts), F.lit(0)), F.lit(unknown))


def freshness(days: Column, fresh: int = 7, recent: int = 30) -> Column:
    return F.when(days.isNull(), "unknown").when(days <= fresh, "fresh").when(days <= recent, "recent").otherwise("stale")


def recency(days: Column, tau: float = 14.0) -> Column:
    """Exponential decay with an e-folding time of ``tau`` days."""
    return F.exp(-days / tau)


def first_match(text: Column, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    """The label of the first rule whose pattern occurs in the text."""
    return F.coalesce(*[F.when(text.rlike(p), F.lit(label)) for label, p in rules], F.lit(default))


def all_matches(text: Column, rules: list[tuple[str, str]]) -> Column:
    """The labels of all rules whose pattern occurs, in order."""
    return F.array_compact(F.array(*[F.when(text.rlike(p), F.lit(label)) for label, p in rules]))


def term_scores(text: Column, terms: dict[str, list[str]], points: int = 3) -> Column:
    """``label`` and ``score`` of the label with most points; ties go to the first."""
    scored = [F.struct(sum((F.when(F.contains(text, F.lit(t)), points).otherwise(0) for t in words), F.lit(0)).alias("score"), F.lit(-i).alias("order"), F.lit(label).alias("label")) for i, (label, words) in enumerate(terms.items())]
    return F.array_max(F.array(*scored))


def ratio(part: Column, whole: Column, digits: int = 4) -> Column:
    """``part / whole`` rounded, and 0 where there is nothing to divide by."""
    return F.round(F.when(whole > 0, part / whole).otherwise(0.0), digits)


def clamp(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.least(value, F.lit(high)), F.lit(low))


def priority(score: Column, p0: float = 70, p1: float = 40) -> Column:
    return F.when(score >= p0, "P0").when(score >= p1, "P1").otherwise("P2")


def issues(**checks: Column) -> Column:
    """Names of the checks that fail, in order; a null check fails."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in checks.items()]))
