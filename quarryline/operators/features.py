"""Hashed word and word-pair features, counted by bucket.

A batch's texts are cut, and their words coded, by Arrow; the hash of a pair goes on
from its first word's, so nothing is joined or counted as a string, and only counts
by bucket are shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.functions import text as tx
from quarryline.workspace import modest_batches

_BASIS, _PRIME, _MASK = np.uint64(2166136261), np.uint64(16777619), np.uint64(0xFFFFFFFF)


def _hashed(start: np.ndarray, word: np.ndarray, codes: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """32-bit FNV-1a of each ``word`` (a number) over its characters, going on from ``start``."""
    h, k = start.copy(), 0
    at = np.arange(len(word))
    while len(at := at[length[word[at]] > k]):
        h[at] = ((h[at] ^ codes[first[word[at]] + k]) * _PRIME) & _MASK
        k += 1
    return h


def _counts(plain: pa.Array, buckets: int) -> np.ndarray:
    """Counts by row and bucket of texts whose words stand apart by one blank."""
    cut = pc.split_pattern(plain, " ")
    row, words = pc.list_parent_indices(cut), pc.list_flatten(cut)
    long = pc.greater(pc.utf8_length(words), 1)
    row, words = row.filter(long).to_numpy(), words.filter(long).dictionary_encode()
    if not len(row):
        return np.zeros((len(plain), buckets), np.int64)
    word, known = words.indices.to_numpy(), words.dictionary
    length = pc.utf8_length(known).to_numpy().astype(np.int64)
    codes = np.frombuffer("".join(known.to_pylist()).encode("utf-32-le"), "<u4").astype(np.uint64)
    every = np.arange(len(known))
    one = _hashed(np.full(len(known), _BASIS), every, codes, np.cumsum(length) - length, length)
    beside = np.flatnonzero(row[1:] == row[:-1])
    joined = ((one[word[beside]] ^ np.uint64(ord("_"))) * _PRIME) & _MASK
    pair = _hashed(joined, word[beside + 1], codes, np.cumsum(length) - length, length)
    h = np.concatenate([one[word], pair])
    bucket = np.where(h >= 1 << 31, np.uint64(1 << 32) - h, h) % np.uint64(buckets)
    place = np.concatenate([row, row[beside]]).astype(np.int64) * buckets + bucket.astype(np.int64)
    return np.bincount(place, minlength=len(plain) * buckets).reshape(-1, buckets)


def feature_buckets(rows: DataFrame, text_col: str, buckets: int = 384, key: str | None = None) -> DataFrame:
    """``bucket, n``: how many features of all texts fall into each bucket, or
    ``key, bucket, n`` for the texts of each ``key``.

    Features are those of :func:`quarryline.functions.text.features`, each counted as
    often as it occurs, and buckets are remainders of its ``fnv1a``.  Null texts have
    none; buckets without a feature have no row.
    """
    modest_batches(rows.sparkSession)
    whose = F.lit(0) if key is None else F.col(key)
    texts = rows.select(whose.alias("key"), tx.plain_words(F.col(text_col)).alias("plain"))
    kind = texts.schema["key"].dataType.simpleString()

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                n = _counts(part.column(1), buckets)
                n = n.sum(axis=0, keepdims=True) if key is None else n
                row, bucket = np.nonzero(n)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), pa.array(bucket), pa.array(n[row, bucket])], ["key", "bucket", "n"])

    found = texts.mapInArrow(run, f"key {kind}, bucket bigint, n bigint").groupBy("key", "bucket").agg(F.sum("n").alias("n"))
    return found.drop("key") if key is None else found.withColumnRenamed("key", key)
