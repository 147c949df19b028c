"""The ten registered queries: columns, types, folds and rows."""

import zlib

import pytest

from quarryline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op2_packing": {c: "bigint" for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")},
    "op3_pii": {"doc_id": "bigint", **{c: "bigint" for c in ("n_email", "n_ip", "n_card", "n_phone")}, "base_sha256": "string", "spans": "string"},
    "op4_decontamination": {"doc_id": "bigint", "item_id": "bigint"},
    "op5_token_files": {c: "bigint" for c in ("doc_id", "start", "n_tokens", "ids_crc32")},
    "op6_lm": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint", "base_score": "double", "score": "double"},
    "op7_quality": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op8_neighbours": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op9_repeats": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
    "op10_language": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
}
FOLDS = {"op6_lm": (5, 1), "op7_quality": (3, 1), "op10_language": (5, 0)}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_contract(spark, name):
    found = QUERIES[name](spark, SF)
    types = dict(found.dtypes)
    assert {c: types.get(c) for c in COLUMNS[name]} == COLUMNS[name]
    rows = found.collect()
    ids = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    if name in FOLDS:
        n, held = FOLDS[name]
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % n == held) for r in rows)
    if name == "op8_neighbours":
        asked = {r.vec_id for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect() if r.vec_id % 50 == 0}
        assert {r.query_id for r in rows} == asked and all(r.query_id != r.vec_id for r in rows)
        assert sorted((r.query_id, r["rank"]) for r in rows) == [(q, k) for q in sorted(asked) for k in range(1, 6)]
    elif name == "op4_decontamination":
        assert {r.doc_id for r in rows} <= ids
    else:
        assert {r.doc_id for r in rows} == ids
        assert name == "op2_packing" or len(rows) == len(ids)
    if name == "op2_packing":
        of, seq = {}, {}
        for r in rows:
            of.setdefault(r.doc_id, []).append((r.start, r.length, r.doc_tokens))
            seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for parts in of.values():
            parts.sort()
            assert parts[0][0] == 0 and sum(p[1] for p in parts) == parts[0][2] and all(a[0] + a[1] == b[0] for a, b in zip(parts, parts[1:]))
        for parts in seq.values():
            parts.sort()
            assert parts[0][0] == 0 and sum(p[1] for p in parts) <= 2048 and all(a[0] + a[1] == b[0] for a, b in zip(parts, parts[1:]))
    if name == "op7_quality":
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def test_conversations_keep_all_three_limits(spark):
    rows = QUERIES["packed_conversations"](spark, "/root/testdata/sf0.01").collect()
    seq, of = {}, {}
    for r in rows:
        seq.setdefault(r.sequence_id, []).append(r)
        of[r.example] = of.get(r.example, 0) + r.length
        assert of[r.example] <= r.doc_tokens
    assert len(of) == spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").where("role = 'assistant'").count()
    assert all(of[r.example] == r.doc_tokens for r in rows)
    sums = [(sum(r.length for r in s), len(s), sum(r.loss_tokens for r in s)) for s in seq.values()]
    assert all(t <= 2048 and n <= 16 and loss <= 1024 for t, n, loss in sums)
    assert sum(loss == 1024 and t < 2048 for t, _, loss in sums) > len(sums) / 2  # the loss limit binds


def test_held_out_accuracy(spark):
    """Against the labels and languages of rows that were not learned from."""
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    told = [(docs[r.doc_id], r.lang_pred) for r in QUERIES["op10_language"](spark, sf).where("held_out").collect() if docs[r.doc_id]]
    assert sum(a == b for a, b in told) >= 0.97 * len(told) > 100
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    marked = [(labels[r.doc_id], r.predicted) for r in QUERIES["op7_quality"](spark, sf).where("held_out").collect() if labels.get(r.doc_id) is not None]
    assert sum(a == b for a, b in marked) >= 0.9 * len(marked) > 50
