"""Text quality by naive Bayes support vectors.

Indicators of hashed byte n-grams, and of how often a word follows itself, are
scaled by the classes' log-count ratios; a linear hinge-loss model on them is fitted by dual coordinate descent, and a
sigmoid turns its margins into scores.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.llm.linear import bounded_sample, gram_codes, hinge_descent, margins, sigmoid_fit
from quarryline.workspace import modest_batches

#: Codes of n-grams, and behind them those of doubled words.
BITS, ORDERS, DOUBLED = 17, (2, 3, 4), 32
SIZE = (1 << BITS) + DOUBLED


def indicators(text: bytes | None, flags: np.ndarray) -> np.ndarray:
    """Codes of the n-grams that occur in the whole text.  ``flags`` is a
    scratch array of ``SIZE`` zeros."""
    data = np.frombuffer(b" " + (text or b"") + b" ", np.uint8)
    for n in ORDERS:
        for at in range(0, max(1, len(data) - n + 1), 1 << 20):
            flags[gram_codes(data[at : at + (1 << 20) + n - 1], n, BITS)] = True
    words = (text or b"").split()
    doubled = sum(map(eq, words, words[1:]))
    flags[1 << BITS : (1 << BITS) + min(DOUBLED, doubled.bit_length())] = True  # by powers of two
    found = np.flatnonzero(flags)
    flags[found] = False
    return found


@dataclass
class Model:
    ratio: np.ndarray  # log-count ratio of each n-gram
    floor: float  # keeps texts of few n-grams near the bias
    weight: np.ndarray  # of the scaled indicators
    bias: float
    slope: float
    offset: float

    def score(self, found: np.ndarray) -> float:
        r = self.ratio[found]
        m = float(self.weight[found] @ r) / float(np.sqrt(r @ r + self.floor)) + self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * m + self.offset, -35, 35))))


def fit(labels: np.ndarray, found: list[np.ndarray], cost: float = 1.0, smooth: float = 1.0) -> Model | None:
    """Fit on the indicators of each row; ``labels`` are 1 or 0.  None if one of
    the classes is empty."""
    y = np.where(labels == 1, 1.0, -1.0)
    if not len(y) or len(set(y)) < 2:
        return None
    counts = np.full((2, SIZE), smooth)
    for at, sign in zip(found, y):
        counts[int(sign > 0)][at] += 1
    counts /= counts.sum(axis=1, keepdims=True)
    ratio = np.log(counts[1] / counts[0])
    scaled = [ratio[at] for at in found]
    floor = 0.2 * float(np.median([v @ v for v in scaled])) + 1e-9
    rows = [(at, v / np.sqrt(v @ v + floor)) for at, v in zip(found, scaled)]
    balance = np.where(y > 0, len(y) / (2 * np.sum(y > 0)), len(y) / (2 * np.sum(y < 0)))
    w, b = hinge_descent(rows, y, SIZE, cost * balance)
    return Model(ratio.astype(np.float32), floor, w.astype(np.float32), b, *sigmoid_fit(margins(rows, w, b), y))


def _features(batches):
    flags = np.zeros(SIZE, bool)
    for b in batches:
        rows = [indicators(t, flags).astype(np.int32) for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(pa.int32()))], ["label", "at"])


def train(docs: DataFrame, labels: DataFrame, most: int = 1500, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model | None:
    """Fit on at most ``most`` labelled rows of each class, taken over all rows
    of ``labels`` by a hash of the id.  Labels other than 0 and 1 don't count; rows
    that repeat an id count as often as they meet a text."""
    modest_batches(docs.sparkSession)
    rows = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    sample = F.broadcast(bounded_sample(rows, "label", most, F.coalesce(F.col("id").cast("string"), F.lit(""))))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).join(sample, "id").select("label", "text")
    table = texts.mapInArrow(_features, "label int, at array<int>").toArrow()
    found = [np.asarray(x.values) for x in table.column("at")]
    order = sorted(range(len(found)), key=lambda i: (len(found[i]), found[i].tobytes()))  # whatever order the rows came in
    label = table.column("label").to_numpy()
    return fit(label[order], [found[i].astype(np.int64) for i in order])


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, score`` of every row; higher: label 1 is likelier.

    Null and empty texts are scored as texts without n-grams of their own, and
    equal texts have equal scores.
    Without a model all scores are 0.5.  Rows that repeat an id stay, other columns
    are left out, and an empty table has no rows.
    """
    modest_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of weights
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))

    def run(batches):
        model, flags = shared.value, np.zeros(SIZE, bool)
        for b in batches:
            found = [0.5 if model is None else model.score(indicators(t, flags)) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.float64())], ["id", "score"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, score double")
