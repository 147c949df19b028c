"""Short labels for the figures of a line, by what stands next to them, as columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarryline.functions import text as tx

YEAR = r"\b20(?:1\d|2\d|3\d)\b"
#: What stands near an amount of money, in the order that settles ties.
MONEY_RULES = [
    (r"\bnegative free cash flow\b", "잉여현금흐름 적자"),
    (r"\bfree cash flow\b", "잉여현금흐름"),
    (r"\b(?:capital expenditures?|capex)\b", "설비투자"),
    (r"\bbacklog\b", "수주잔고"),
    (r"\brevenue\b[^.]{0,30}\b(?:every|per)\s+(?:single\s+)?day\b|\bdaily revenue\b", "일일 매출"),
    (r"\brevenues? guidance\b", "매출 가이던스"),
    (r"\brevenues?\b", "매출"),
    (r"\bvaluation\b", "기업가치"),
    (r"\b(?:funding|raised|raise)\b", "조달액"),
    (r"\binvestment|invested|allocated|earmarks?\b", "투자액"),
    (r"\bpayout|paid out|prize|reward\b", "지급액"),
    (r"\b(?:cost|price|income|yield)\b", "비용·소득 영향액"),
    (r"\b(?:spend|spending|purchases?)\b", "지출·거래액"),
    (r"\b(?:increase|grow|growth)\s+by\b", "시장 증가액"),
    (r"\bsegment\b", "세그먼트 규모"),
    (r"\bmarket(?:\s+size)?\b|\bworth\b|\bvalued\b|\bforecast\b|\bproject", "시장 규모"),
]
#: What stands near a share.
SHARE_RULES = [
    (r"\b(?:cagr|compound annual growth rate)\b", "연평균 성장률"),
    (r"\boperating margins?\b", "영업이익률"),
    (r"\bmargins?\b", "이익률"),
    (r"\breturn rates?\b", "반품률"),
    (r"\blower returns?\b", "반품 감소율"),
    (r"\bpurchase probability|purchase intent|willing(?:ness)? to pay\b", "구매·지불의향"),
    (r"\btried cloud gaming\b", "클라우드 게이밍 경험률"),
    (r"\bpositive experience\b", "긍정 경험 비중"),
    (r"\bregular or heavy users?\b", "정기·고빈도 이용자 비중"),
    (r"\bcreated content\b", "콘텐츠 제작자 비중"),
    (r"\bplaying time\b", "플레이 시간 증가 응답"),
    (r"\bconsuming more\b", "이용 증가 응답"),
    (r"\bnon-compliance risks?|barriers? to adoption\b", "도입 장벽 응답"),
    (r"\badoption|adopted\b", "도입률"),
    (r"\bpenetration\b", "침투율"),
    (r"\brevenue (?:share|mix)|share of (?:global )?revenue\b", "매출 비중"),
    (r"\bmarket share|\bshare of (?:the )?(?:global )?market\b|\baccount(?:ed|ing) for\b|\brepresenting\b", "시장 점유율"),
    (r"\brevenues? (?:surge|growth|jump)|revenues?[^.]{0,30}\bup\b", "매출 성장률"),
    (r"\b(?:growth|grow|increase|higher|lift)\b", "성장·증가율"),
    (r"\bclientele|customers?\b", "고객 범위"),
]
#: Lines about business come before others as a figure's source.
BUSINESS = (
    r"(?i)\b(?:market size|market worth|cagr|forecast|project|growth|revenues?|sales|spend|spending|share|respondents?|survey|users?|shipments?|units?|"
    r"adoption|investment|funding|valuation|backlog|capital expenditures?|capex|cash flow|margin|cost|income|payout|purchase|price)\b"
)
#: Units of a figure and signs in its line, first match counts.
_USERS = [(r"(?i)\bmonthly active\b", "월간 활성 이용자"), (r"(?i)\bpaid subscribers?\b", "유료 가입자"), (r"(?i)\bsurvey|respondents?|poll\b", "조사 인원")]
_SCALED = [
    (r"(?i)\bmonthly active users?\b", "월간 활성 이용자"),
    (r"(?i)\busers?\b", "이용자 수"),
    (r"(?i)\bapps?\b", "앱 수"),
    (r"(?i)\bproduct trials?\b", "제품 체험 수"),
    (r"(?i)\b(?:shipments?|units?|devices?)\b", "출하량"),
]


def places(text: Column, pattern: str) -> Column:
    """``start`` and ``end`` (from 0) of all matches of a pattern, in one pass over the array of its matches."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits)), F.length)
    pairs = F.zip_with(gaps, hits, lambda g, h: F.struct(g.alias("gap"), F.length(h).alias("size")))
    none = F.array().cast("array<struct<start:int,end:int>>")
    walk = F.aggregate(
        pairs,
        none,
        lambda out, p: F.array_append(
            out,
            F.struct(
                (F.coalesce(F.try_element_at(out, F.lit(-1))["end"], F.lit(0)) + p["gap"]).alias("start"),
                (F.coalesce(F.try_element_at(out, F.lit(-1))["end"], F.lit(0)) + p["gap"] + p["size"]).alias("end"),
            ),
        ),
    )
    return F.when(F.size(hits) > 0, walk).otherwise(none)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def nearest_label(line: Column, value: Column, rules: list[tuple[str, str]]) -> Column:
    """The label of the rule with a match nearest to the value, counted in characters
    between them; of equally near ones the earlier rule's.  Null if none matches."""
    at = F.instr(F.lower(line), F.lower(value)) - 1

    def of(spot: Column) -> Column:
        def best(priority: int, pattern: str, label: str) -> Column:
            apart = F.transform(
                places(line, f"(?i){pattern}"),
                lambda m: F.greatest(spot["at"] - m["end"], m["start"] - spot["end"], F.lit(0)),
            )
            return F.when(line.rlike(f"(?i){pattern}"), F.struct(F.array_min(apart).alias("distance"), F.lit(priority).alias("priority"), F.lit(label).alias("label")))

        found = F.filter(F.array(*[best(i, p, name) for i, (p, name) in enumerate(rules)]), lambda r: r.isNotNull())
        return F.array_min(found)["label"]

    return _let(F.struct(at.alias("at"), (at + F.length(value)).alias("end")), of)


def years(line: Column) -> Column:
    """The years of a line, 2010 to 2039, in order."""
    return F.regexp_extract_all(line, F.lit(YEAR), F.lit(0))


def is_forecast(line: Column, year: Column) -> Column:
    """Whether a line speaks of a year as one to come."""
    every = years(line)
    y = F.concat(F.lit(r"\b"), year, F.lit(r"\b"))
    direct = F.rlike(line, F.concat(F.lit(r"(?i)(?:by|through|until)\s+"), y))
    described = F.rlike(line, F.concat(F.lit("(?i)"), y, F.lit(r"[^.]{0,40}\bforecast\b|\b(?:forecast|projected)\b[^.]{0,40}"), y))
    last = (F.size(every) > 1) & (year == F.array_max(every)) & F.rlike(line, F.lit(r"(?i)forecast|project|expected|anticipat|will reach|to grow|increase from"))
    return direct | described | last


def _first(text: Column, rules: list[tuple[str, str]], otherwise: str) -> Column:
    out = None
    for pattern, label in rules:
        out = F.when(text.rlike(pattern), label) if out is None else out.when(text.rlike(pattern), label)
    return out.otherwise(otherwise)


def label(line: Column, value: Column) -> Column:
    """What a figure of a line measures; both with their white space collapsed."""
    return _let(F.struct(line.alias("text"), value.alias("token")), lambda p: _label(p["text"], p["token"]))


def _label(text: Column, token: Column) -> Column:
    compared = F.rlike(text, F.concat(F.lit(r"(?i)\b(?:from|compared with)\s+[^.]{0,40}\b"), token, F.lit(r"\b")))
    forecast = is_forecast(text, token)
    year = F.when(compared & ~forecast, "비교 기준 연도").when(forecast, "전망 연도").otherwise("기준 연도")
    respondents = token.rlike(r"(?i)\brespondents?\b") | text.rlike(r"(?i)\bsurvey of\b[^.]{0,40}\brespondents?\b")
    asked = F.when(text.rlike(r"(?i)\bsurvey|respondents?|gamers?|consumers?\b"), "응답 비중").otherwise("비율")
    return (
        F.when(token.rlike(r"^20(?:1\d|2\d|3\d)$"), year)
        .when(token.rlike(r"(?i)\b(?:years?|months?|days?|hours?)\b"), F.when(text.rlike(r"(?i)\b(?:past|experience|career|writing|worked|served)\b"), "경력 기간").otherwise("기간"))
        .when(respondents, "응답자 수")
        .when(token.rlike(r"(?i)\b(?:users?|consumers?|people|adults?)\b"), _first(text, _USERS, "이용자 수"))
        .when(token.rlike(r"(?i)\b(?:shipments?|units?|devices?)\b"), "출하량")
        .when(text.rlike(r"(?i)\btons?\b") & ~F.contains(token, F.lit("%")), "시장 물량")
        .when(token.rlike(r"(?i)^4k$"), "영상 해상도")
        .when(token.rlike(r"(?i)(?:US\$|USD|\$|€|£|¥|₩|₹|R\$)"), F.coalesce(nearest_label(text, token, MONEY_RULES), F.lit("금액")))
        .when(token.rlike(r"(?i)%|\bpercent\b|\bper cent\b|\bbasis points?\b|\bbps\b"), F.coalesce(nearest_label(text, token, SHARE_RULES), asked))
        .when(token.rlike(r"(?i)\b(?:million|billion|trillion|thousand|trn|bn|mn|k)\b"), _first(text, _SCALED, "정량 지표"))
        .otherwise("정량 지표")
    )


def year_context(line: Column, value: Column, metric: Column) -> Column:
    """The year or years that a figure is about, '' if the line names none: a growth's
    range, else the year that directly qualifies the figure, else the nearest one."""
    every = years(line)
    at = F.instr(F.lower(line), F.lower(value)) - 1
    end = at + F.length(value)
    trailing = F.substring(line, F.greatest(at, F.lit(0)) + 1, F.length(line))
    of = r"(20(?:1\d|2\d|3\d))"
    stated = [rf"(?i)\bfrom\s+{of}\s+to\s+{of}\b", rf"(?i)\b{of}\s*(?:-|–|to)\s*{of}\b"]
    ranges = [F.when(trailing.rlike(p), F.concat(F.regexp_extract(trailing, p, 1), F.lit("–"), F.regexp_extract(trailing, p, 2))) for p in stated]
    distinct = F.array_sort(F.array_distinct(every))
    spread = F.when(F.size(distinct) > 1, F.concat(F.try_element_at(distinct, F.lit(1)), F.lit("–"), F.try_element_at(distinct, F.lit(-1))))
    growth = F.when(metric.isin("연평균 성장률", "시장 증가액"), F.coalesce(*ranges, spread))
    told = F.zip_with(places(line, YEAR), every, lambda p, y: F.struct(p["start"].alias("at"), y.alias("year")))
    between = lambda y: F.substring(line, end + 1, F.greatest(y["at"] - end, F.lit(0)))
    direct = F.try_element_at(F.filter(told, lambda y: (y["at"] >= end) & F.rlike(between(y), F.lit(r"(?i)^[^,.;]{0,28}\b(?:in|by|for|during|as of|through)\s*$"))), F.lit(1))["year"]
    nearest = F.array_min(F.transform(told, lambda y: F.struct(F.abs(y["at"] - at).alias("d"), y["at"].alias("at"), y["year"].alias("year"))))["year"]
    return F.when(F.size(every) == 0, "").otherwise(F.coalesce(growth, direct, nearest))


def labelled(lines: Column, values: Column) -> Column:
    """``label, value, line`` of each value: its source is the shortest of the lines
    that hold it, one about business if there is any."""

    clean = F.transform(lines, tx.clean)

    def source(value: Column) -> Column:
        held = F.filter(clean, lambda x: F.contains(F.lower(x), F.lower(value)))
        # lines about business first, then short ones, then in their order
        placed = F.transform(held, lambda x, i: F.struct((~x.rlike(BUSINESS)).alias("other"), F.length(x).alias("n"), i.alias("i"), x.alias("line")))
        return F.coalesce(F.array_min(placed)["line"], F.lit(""))

    def told(value: Column, line: Column) -> Column:
        def named(metric: Column) -> Column:
            year = F.when(value.rlike(r"^20(?:1\d|2\d|3\d)$"), "").otherwise(year_context(line, value, metric))
            return F.struct(F.concat(metric, F.transform(F.array(year), lambda y: F.when(y != "", F.concat(F.lit(" · "), y)).otherwise(""))[0]).alias("label"), value.alias("value"), line.alias("line"))

        return _let(label(line, value), named)

    return F.transform(F.transform(F.transform(values, tx.clean), lambda v: F.struct(v.alias("v"), source(v).alias("s"))), lambda p: told(p["v"], p["s"]))
