"""Language identification: the family first, then the language within it.

Texts become relative frequencies of hashed byte trigrams.  A linear support
vector machine for each family says which one a text belongs to; one for every
pair of languages of that family then votes.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from quarryline.llm.linear import bounded_sample, gram_codes, hinge_descent, margins, sigmoid_fit
from quarryline.workspace import modest_batches

#: The families of common languages by ISO 639-1 code.  A
#: language that isn't named is a family of its own.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "fy", "is", "lb", "nl", "no", "nb", "nn", "sv"],
    "romance": ["ca", "es", "fr", "gl", "it", "oc", "pt", "ro"],
    "slavic": ["be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "baltic": ["lt", "lv"],
    "uralic": ["et", "fi", "hu"],
    "turkic": ["az", "kk", "tr", "uz"],
    "indic": ["bn", "gu", "hi", "mr", "ne", "pa", "ur"],
    "semitic": ["ar", "he", "mt"],
}
BITS, SCALE = 15, 20.0
_LETTER = re.compile(r"[^\W\d_]")
_FOLD = np.array([c if chr(c).isalpha() or c >= 128 else 32 for c in range(256)], np.uint8)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(m[0].isalpha() for m in _LETTER.finditer(text))


def codes(text: str) -> np.ndarray:
    """Trigram codes of the whole text, lowered, with blanks for what is no letter."""
    data = _FOLD[np.frombuffer(f" {text.lower()} ".encode(), np.uint8)]
    return gram_codes(data, 3, BITS)


def sparse(text: str) -> tuple[np.ndarray, np.ndarray]:
    c = codes(text)
    at, n = np.unique(c, return_counts=True)
    return at, n * (SCALE / max(1, len(c)))


@dataclass
class Model:
    """``weights`` has a column for each family, then one for each pair."""

    families: list[str]
    members: dict[str, list[str]]
    pairs: list[tuple[str, str]]
    weights: np.ndarray
    bias: np.ndarray
    slope: np.ndarray
    offset: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float | None]:
        if not has_letter(text):
            return "und", 0.0
        if not self.families:
            return "und", None
        m = self.bias.copy()
        c = codes(text)
        for at in range(0, len(c), 1 << 16):
            m += self.weights[c[at : at + (1 << 16)]].sum(axis=0) * (SCALE / len(c))
        p = 1 / (1 + np.exp(-np.clip(self.slope * m + self.offset, -35, 35)))
        k = len(self.families)
        first = int(np.argmax(p[:k]))
        sure = float(p[first] / p[:k].sum()) if k > 1 else 1.0
        names = self.members[self.families[first]]
        if len(names) == 1:
            return names[0], sure
        votes = dict.fromkeys(names, 0.0)
        weight = dict.fromkeys(names, 0.0)
        for (a, b), q in zip(self.pairs, p[k:]):
            if a in votes and b in votes:
                votes[a if q >= 0.5 else b] += 1
                weight[a] += float(q)
                weight[b] += 1 - float(q)
        best = max(names, key=lambda x: (votes[x], weight[x], x))
        return best, sure * weight[best] / (len(names) - 1)


def _two(rows, y, cost):
    weight = np.where(y > 0, len(y) / (2 * max(1, np.sum(y > 0))), len(y) / (2 * max(1, np.sum(y <= 0))))
    w, b = hinge_descent(rows, y, 1 << BITS, cost * weight)
    return w, b, *sigmoid_fit(margins(rows, w, b), y)


def fit(labels: list[str], rows: list[tuple[np.ndarray, np.ndarray]], cost: float = 4.0, families: dict[str, list[str]] = FAMILIES) -> Model:
    """Fit on sparse rows of :func:`sparse`; ``labels`` are their languages."""
    of = {lang: name for name, langs in families.items() for lang in langs}
    langs = sorted(set(labels))
    members: dict[str, list[str]] = {}
    for lang in langs:
        members.setdefault(of.get(lang, lang), []).append(lang)
    names, label = sorted(members), np.array(labels, object)
    pairs, fitted = [], []
    for name in names:
        y = np.where(np.isin(label, members[name]), 1.0, -1.0)
        fitted.append(_two(rows, y, cost) if len(names) > 1 else (np.zeros(1 << BITS), 0.0, 1.0, 0.0))
    for name in names:
        for a, b in combinations(members[name], 2):
            at = np.flatnonzero((label == a) | (label == b))
            pairs.append((a, b))
            fitted.append(_two([rows[i] for i in at], np.where(label[at] == a, 1.0, -1.0), cost))
    if not fitted:
        return Model([], {}, [], np.zeros((1 << BITS, 0), np.float32), *np.zeros((3, 0)))
    w, b, slope, offset = zip(*fitted)
    return Model(names, members, pairs, np.array(w, np.float32).T.copy(), np.array(b), np.array(slope), np.array(offset))


def _features(batches):
    for b in batches:
        rows = [sparse(t) for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([r[0].astype(np.int32) for r in rows], pa.list_(pa.int32())), pa.array([r[1].astype(np.float32) for r in rows], pa.list_(pa.float32()))],
            ["lang", "at", "value"],
        )


def train(docs: DataFrame, most: int = 1000, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on at most ``most`` rows a language of ``docs``, taken over all rows
    by a hash of the id.  Rows without a language or text don't count."""
    modest_batches(docs.sparkSession)
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(id_col).cast("string").alias("key"), F.col(text_col).alias("text")
    )
    sample = bounded_sample(rows, "lang", most, F.coalesce("key", F.lit(""))).select("lang", "text")
    found = sample.mapInArrow(_features, "lang string, at array<int>, value array<float>").toArrow().sort_by("lang")
    parts = [[x.values.to_numpy() for x in found.column(c)] for c in ("at", "value")]  # numbers stay in arrays
    return fit(found.column("lang").to_pylist(), list(zip(*parts)))


def predict(docs: DataFrame, model: Model, text_col: str = "text", names: tuple[str, str] = ("lang_pred", "lang_score")) -> DataFrame:
    """``docs`` with the predicted language and its score added under ``names``.

    ``und`` with score 0 where the text is null, empty or has no letter, and with
    a null score for other texts where no language was learned.  Whole texts are
    read, whatever their length.  Equal texts have equal results; languages with
    equal votes and weights are settled by name.  Columns of ``docs`` that have
    one of the new names are replaced, all others stay, and an empty table has no
    rows.
    """
    modest_batches(docs.sparkSession)
    docs = docs.select(*[f"`{c}`" for c in docs.columns if c.lower() not in [n.lower() for n in names]])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of weights

    def run(batches):
        model = shared.value
        for b in batches:
            found = [model.predict(t) for t in b.column(text_col).to_pylist()]
            added = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*b.columns, *added], [*b.schema.names, *names])

    schema = StructType([*docs.schema.fields, StructField(names[0], StringType()), StructField(names[1], DoubleType())])
    return docs.mapInArrow(run, schema)
