"""Rows of registered queries against brute force on the smallest tables."""

import collections
import hashlib
import math
import re
import struct
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from quarryline.llm.queries import QUERIES
from quarryline.llm.tokens import tokenizer_path
from tests.llm.test_simhash import components, slow_fingerprint

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def coded(texts, end):
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    return {i: [*library.encode(t, add_special_tokens=False).ids, end] for i, t in texts.items()}


def crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def test_op1(spark, texts):
    ids = sorted(texts)
    prints = [slow_fingerprint(texts[i]) for i in ids]
    roots = components(ids, prints, 2)
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op1_simhash"](spark, SF).collect()}
    assert {i: f[0] for i, f in found.items()} == {i: f"{p:016x}" for i, p in zip(ids, prints)}
    assert {i: f[1] for i, f in found.items()} == roots


def test_op2(spark, texts):
    ids = coded(texts, 1)
    for r in QUERIES["op2_packing"](spark, SF).collect():
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == crc(ids[r.doc_id][r.start : r.start + r.length])


def luhn(digits):
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def test_op3_base(spark, texts):
    only = lambda s: re.sub("[^0-9]", "", s)
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(only(s)) <= 19 and luhn(only(s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(only(s)) <= 15),
    }
    total = collections.Counter()
    for r in QUERIES["op3_pii"](spark, SF).collect():
        spans = {k: [m.span() for m in re.finditer(p, texts[r.doc_id]) if fits(m.group())] for k, (p, fits) in kinds.items()}
        listed = [f"{k}:{a}:{z}" for k in kinds for a, z in spans[k]]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(len(spans[k]) for k in kinds)
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest() and r.spans.startswith(",".join(listed))
        total.update({k: len(s) for k, s in spans.items()})
    assert all(total[k] for k in ("email", "phone"))


def test_op5(spark, texts):
    ids, start = coded(texts, 2), 0
    found = {r.doc_id: r for r in QUERIES["op5_token_files"](spark, SF).collect()}
    for i in sorted(texts):
        assert (found[i].start, found[i].n_tokens, found[i].ids_crc32) == (start, len(ids[i]), crc(ids[i]))
        start += len(ids[i])


def test_op6_base(spark, texts):
    words = {i: [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)) if w] for i, t in texts.items()}
    learns = {i: zlib.crc32(str(i).encode()) % 5 != 1 for i in texts}
    count = collections.Counter(w for i, ws in words.items() if learns[i] for w in [*ws, None])
    n, v = sum(count.values()), len(count)
    for r in QUERIES["op6_lm"](spark, SF).collect():
        tokens = [*words[r.doc_id], None]
        base = sum(math.log10((count[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (not learns[r.doc_id], len(tokens), sum(count[t] > 0 for t in tokens), n)
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base)) and r.score < 0


def test_op8(spark):
    rows = {r.vec_id: r for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    column = next(c for c in next(iter(rows.values())).asDict() if isinstance(rows[min(rows)][c], list))
    ids = sorted(rows)
    x = np.array([rows[i][column] for i in ids], np.float64)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    found, hits = collections.defaultdict(list), 0
    for r in sorted(QUERIES["op8_neighbours"](spark, SF).collect(), key=lambda r: (r.query_id, r["rank"])):
        a, b = (np.array(rows[i][column], np.float64) for i in (r.query_id, r.vec_id))
        assert abs(r.score - a @ b / math.sqrt(a @ a) / math.sqrt(b @ b)) < 1e-12
        found[r.query_id].append((r.vec_id, r.score))
    assert sorted(found) == [i for i in ids if i % 50 == 0]
    for q, near in found.items():
        assert near == sorted(near, key=lambda t: (-t[1], t[0])) and len(near) == 5
        cosine = unit @ unit[ids.index(q)]
        best = [i for _, i in sorted((-c, i) for c, i in zip(cosine, ids) if i != q)][:5]
        hits += len(set(best) & {i for i, _ in near})
    assert hits >= 0.9 * 5 * len(found)


def test_op9(spark, texts):
    length, raw = 200, {i: t.encode() for i, t in texts.items()}
    count = collections.Counter(t[a : a + length] for t in raw.values() for a in range(len(t) - length + 1))
    for r in QUERIES["op9_repeats"](spark, SF).collect():
        t = raw[r.doc_id]
        gone = np.zeros(len(t) + 1, np.int64)
        for a in range(len(t) - length + 1):
            if count[t[a : a + length]] > 1:
                gone[a] += 1
                gone[a + length] -= 1
        gone = np.cumsum(gone[:-1]) > 0
        spans = int((gone & ~np.append(False, gone[:-1])).sum()) if len(t) else 0
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
