"""Tables of awkward rows that every operator must stand."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id int, key string"


def awkward_rows() -> list[tuple]:
    rng = random.Random(4)
    words = ["alpha", "beta", "gamma", "delta", "the", "of", "und", "der", "être", "ñandú"]
    prose = [" ".join(rng.choices(words, k=rng.randint(30, 120))) + "." for _ in range(12)]
    rows = [(i, t, "en" if i % 2 else "fr", "s", len(t), 1, "k") for i, t in enumerate(prose)]
    long = " ".join(rng.choices(words, k=30_000))
    rows += [
        (20, None, None, None, None, None, None),
        (21, "", "en", None, 0, 0, ""),
        (22, "   \n\t ", "en", "s", 6, 0, ""),
        (23, "A.", "en", "s", 2, 0, ""),
        (24, "1234 !!", None, "s", 7, 0, ""),
        (25, long, "fr", "s", len(long), 0, ""),
        (26, prose[0], "en", "s", 1, 1, "k"),
        (27, prose[0], "en", "s", 1, 1, "k"),
        (27, prose[0], "en", "s", 1, 1, "k"),
        (None, prose[1], "en", "s", 1, 1, "k"),
        (28, "日本語 のテキスト 😀 é zero​width", "ja", "s", 1, 1, "k"),
    ]
    return rows


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
