"""Text normalisation, tokens, similarity and hashes as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that don't tell organisations apart.
LEGAL_WORDS = [
    "ai", "app", "apps", "inc", "incorporated", "llc", "ltd", "limited", "corp", "corporation",
    "company", "co", "opco", "pbc", "plc", "gmbh", "sa", "sas", "platform", "platforms",
    "technology", "technologies", "labs", "lab",
]
#: What a brand may add to a name and stay the same organisation.
BRAND_EXTENSIONS = ["cloud", "deepmind", "labs", "notebook", "research", "studio", "systems", "technologies"]


def clean(text: Column) -> Column:
    """White space collapsed and trimmed; null is empty."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))


def clip(text: Column, n: int, mark: str = "") -> Column:
    """At most ``n`` characters, ``mark`` behind what was cut."""
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n), F.lit(mark))).otherwise(text)


def normalized(text: Column) -> Column:
    """Lower case, with blanks for all but a-z, 0-9, Hangul, per cent and currency signs."""
    plain = F.regexp_replace(F.lower(clean(text)), "&(?:nbsp|amp);", " ")
    return F.trim(F.regexp_replace(plain, "[^a-z0-9가-힣%$€£¥₩₹]+", " "))


def slug(text: Column, most: int = 120) -> Column:
    """Letters and digits of a lower-cased text joined by hyphens."""
    made = F.regexp_replace(F.lower(clean(text)), r"[^a-z0-9\p{L}]+", "-")
    return F.substring(F.regexp_replace(made, "^-+|-+$", ""), 1, most)


def tokens(text: Column, longer_than: int = 2) -> Column:
    """Distinct words of the normalised text with more than so many characters."""
    return F.array_distinct(F.filter(F.split(normalized(text), " "), lambda t: F.length(t) > longer_than))


def strip_html(html: Column) -> Column:
    """Text of HTML without scripts, styles and tags; the common entities decoded."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    bare = F.regexp_replace(bare, r"(?s)<[^>]+>", " ")
    for entity, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(entity), F.lit(sign))
    return clean(bare)


def sentences(text: Column) -> Column:
    """Parts of a text that end in a full stop or the like."""
    return F.filter(F.split(clean(text), r"(?<=[.!?。！？])\s+"), lambda s: s != "")


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all elements of two sets; 0 if one is empty."""
    shared = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), shared / F.size(F.array_union(a, b))).otherwise(0.0)


def overlap(a: Column, b: Column) -> Column:
    """Shared elements over those of the smaller set; 0 if one is empty."""
    shared = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), shared / F.least(F.size(a), F.size(b))).otherwise(0.0)


def claim_key(text: Column) -> Column:
    """Letters and digits only, lower-cased."""
    return F.regexp_replace(F.lower(clean(text)), r"[^\p{L}\p{N}]+", "")


def near_claim(a: Column, b: Column, least: float = 0.82) -> Column:
    """Whether two claims say the same: equal keys, one within the other (from
    24 characters on), or enough shared words."""
    x, y = claim_key(a), claim_key(b)
    words = lambda c: F.array_distinct(F.filter(F.split(F.regexp_replace(F.lower(clean(c)), r"[^\p{L}\p{N}]+", " "), " "), lambda t: F.length(t) >= 2))
    within = (F.least(F.length(x), F.length(y)) >= 24) & (F.contains(x, y) | F.contains(y, x))
    return (x != "") & (y != "") & ((x == y) | within | (overlap(words(a), words(b)) >= least))


def organization_root(name: Column) -> Column:
    """A name without legal words, as one word."""
    plain = F.replace(F.lower(clean(name)), F.lit("&"), F.lit(" and "))
    words = F.split(F.regexp_replace(plain, r"[^\p{L}\p{N}]+", " "), " ")
    return F.array_join(F.filter(words, lambda w: (w != "") & ~w.isin(LEGAL_WORDS)), "")


def compatible_root(a: Column, b: Column) -> Column:
    """Whether two roots are equal, or one is the other and a brand's extension."""
    short = F.when(F.length(a) <= F.length(b), a).otherwise(b)
    long = F.when(F.length(a) <= F.length(b), b).otherwise(a)
    rest = F.substring(long, F.length(short) + 1, F.length(long))
    extended = F.exists(F.array(*map(F.lit, BRAND_EXTENSIONS)), lambda e: F.startswith(rest, e))
    return (a == b) | ((F.length(short) >= 5) & F.startswith(long, short) & extended)


def short_hash(n: int, *columns: Column, sep: str = "|") -> Column:
    """The first ``n`` digits of the SHA-256 of the columns joined by ``sep``."""
    return F.substring(F.sha2(F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]), 256), 1, n)


def row_hash(*names: str) -> Column:
    """SHA-256 of the named columns as JSON with its keys in order."""
    return F.sha2(F.to_json(F.struct(*sorted(names))), 256)


def plain_words(text: Column) -> Column:
    """The words of a-z, 0-9 and Hangul, lower-cased, one blank between them; null is empty."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^a-z0-9가-힣\s]", " "), r"\s+", " "))


def features(text: Column) -> Column:
    """Words of two characters and more, and the pairs of neighbours joined by ``_``."""
    words = F.filter(F.split(plain_words(text), " "), lambda w: F.length(w) > 1)
    pairs = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda x, y: F.concat_ws("_", x, y))
    return F.concat(words, pairs)


def fnv1a(text: Column) -> Column:
    """32-bit FNV-1a over the characters, as a signed number's magnitude."""
    signs = F.filter(F.split(text, ""), lambda c: c != "")
    h = F.aggregate(
        F.transform(signs, lambda c: F.ascii(c).cast("long")),
        F.lit(2166136261).cast("long"),
        lambda h, c: (h.bitwiseXOR(c) * 16777619).bitwiseAND(F.lit(4294967295)),
    )
    return F.when(h >= 2147483648, F.lit(4294967296) - h).otherwise(h)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays of numbers; 0 if a norm is 0."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a) * dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm).otherwise(0.0)
