"""URL and host columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tracking parameters that the profiles drop.
UTM = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content")
CLICK_IDS = ("gclid", "fbclid")

#: What each profile does: parameters dropped (a regular expression of names, or
#: all), whether the rest is sorted, how many trailing slashes go, and what an
#: invalid URL becomes.
PROFILES = {
    "tracks": {"drop": "utm_[^=&]*|fbclid|gclid|mc_[^=&]*", "sort": False, "slash": "none", "invalid": "empty"},
    "collector": {"drop": "utm_[^=&]*|fbclid|gclid|mc_[^=&]*", "sort": False, "slash": "none", "invalid": "trim"},
    "market": {"drop": "|".join((*UTM, *CLICK_IDS)), "sort": False, "slash": "one", "invalid": "empty"},
    "suppression": {"drop": "|".join((*UTM, *CLICK_IDS)), "sort": True, "slash": "all", "invalid": "cut"},
    "news": {"drop": "|".join(UTM), "sort": False, "slash": "all", "invalid": "cut"},
    "no_query": {"drop": None, "sort": False, "slash": "all", "invalid": "cut"},
}


def _valid(url: Column) -> Column:
    return url.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#\s]+")


def canonical_url(url: Column, profile: str = "tracks") -> Column:
    """A URL without fragment and tracking parameters, by one of ``PROFILES``.
    Null is the empty string."""
    rule = PROFILES[profile]
    raw = F.trim(F.coalesce(url, F.lit("")))
    bare = F.regexp_replace(raw, r"#.*$", "")
    path = F.regexp_replace(bare, r"\?.*$", "")
    path = F.when(path.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]+$"), F.concat(path, F.lit("/"))).otherwise(path)
    if rule["drop"] is None:
        made = path
    else:
        query = F.regexp_extract(bare, r"\?(.*)$", 1)
        kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^(?:{rule['drop']})(?:=|$)"))
        kept = F.array_sort(kept) if rule["sort"] else kept
        made = F.when(F.size(kept) > 0, F.concat(path, F.lit("?"), F.array_join(kept, "&"))).otherwise(path)
    slash = {"none": "^$", "one": "/$", "all": "/+$"}[rule["slash"]]
    made = F.regexp_replace(made, slash, "") if rule["slash"] != "none" else made
    cut = F.regexp_replace(F.regexp_replace(raw, r"[?#].*$", ""), "/+$", "")
    invalid = {"empty": F.lit(""), "trim": raw, "cut": cut}[rule["invalid"]]
    return F.when(_valid(raw), made).otherwise(invalid)


def host(url: Column) -> Column:
    """Lower-cased host without ``www.``, port and final dot; the scheme may be missing."""
    raw = F.trim(F.coalesce(url, F.lit("")))
    name = F.lower(F.regexp_extract(raw, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:\s]+)", 1))
    return F.regexp_replace(F.regexp_replace(name, r"^www\.", ""), r"\.$", "")


def host_suffixes(name: Column) -> Column:
    """A host and its parent domains, for equi-joins with domain lists."""
    parts = F.split(name, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def in_domain(name: Column, domain: Column) -> Column:
    """Whether a host is a domain or below it."""
    return (name == domain) | name.endswith(F.concat(F.lit("."), domain))


def title_from_url(url: Column) -> Column:
    """The last part of the path as words."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+([^?#]*)", 1)
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    last = F.when(F.size(parts) > 0, F.element_at(parts, -1)).otherwise(F.lit("official update"))
    return F.regexp_replace(last, "[-_]+", " ")
