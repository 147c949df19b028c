import random
import struct
import zlib

import numpy as np
import pytest
from tests.llm.helpers import awkward, empty

from quarryline.llm import chunks
from quarryline.llm import tokens as T
from quarryline.llm.packing import Packer, pack_documents
from quarryline.workspace import Workspace

PATH = T.tokenizer_path()
PARTS = ["a", "B", "é", "1", "23", "'s", "'ll", " ", "  ", "   ", "\n", "\r\n", "\t", "\x85", "\xa0", " ", "　", "\x1c", "​", "<|endoftext|>", "!", "?!", "日本", "😀", "̀", ".", "word", "Word."]


def ids_of(text):
    return T.ChunkEncoder.of(PATH).tokenizer.encode(text or "", add_special_tokens=False).ids


def test_chunks_encode_like_the_whole(monkeypatch):
    rng = random.Random(1)
    encoder = T.ChunkEncoder(PATH)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 14))) for _ in range(4000)]
    texts += [" ".join(rng.choices(["a", "b.", "\nC", "\n", "d\te", ""], k=6)) for _ in range(2000)]
    texts += [None, "", " ", "\n", " lead", "trail ", "a\n\nb"]
    for text, code in zip(texts, encoder.encode(texts)):
        assert list(struct.unpack(f"<{len(code) // 4}I", code)) == ids_of(text), repr(text)
    monkeypatch.setattr(T, "SLICE", 1000)
    monkeypatch.setattr(chunks, "SLICE", 1000)
    for long in ("word one  two\t\t three.\n" * 3000, "a" * 5000 + " b\xa0 c" * 500):
        code = next(encoder.encode([long]))
        assert list(struct.unpack(f"<{len(code) // 4}I", code)) == ids_of(long)
    monkeypatch.setattr(T, "REMEMBERED", 1000)
    small = T.ChunkEncoder(PATH)
    assert [len(c) // 4 for c in small.encode(texts)] == [len(ids_of(t)) for t in texts]


def test_table_finds_what_it_holds():
    rng = random.Random(2)
    known = [bytes(rng.choices(b"ab ", k=rng.randint(1, 12))) for _ in range(500)]
    data = np.frombuffer(b"".join(known), np.uint8)
    stop = np.cumsum([len(k) for k in known])
    h, first = chunks.hashes(data, np.append(0, stop[:-1]), stop)
    _, one = np.unique(h, return_index=True)
    assert len(one) == len(set(known))
    table = chunks.Table(600)
    table.add(h[one], first[one])
    number = table.find(h, first)
    assert [known[one[e]] for e in number] == known
    assert (table.find(h, first + np.uint64(1)) == -1).all()


def test_token_files_round_trip(spark):
    docs = awkward(spark)
    path = Workspace(spark, "t").path
    T.write_token_files(docs, path, PATH, end=2)
    files = T.read_token_files(spark, path)
    rows = T.with_global_start(files).orderBy("start").collect()
    want = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in rows] == [w[0] for w in want]
    at = 0
    for r, (_, text) in zip(rows, want):
        assert r.start == at and r.n_tokens == len(r.ids) and list(r.ids) == ids_of(text) + [2]
        at += r.n_tokens
    crc = {r.start: r.ids_crc32 for r in T.with_crc(T.with_global_start(files).select("start", "ids")).collect()}
    assert all(crc[r.start] == zlib.crc32(struct.pack(f"<{len(r.ids)}I", *r.ids)) for r in rows)


def test_empty_token_files(spark):
    path = Workspace(spark, "t").path
    T.write_token_files(empty(spark), path, PATH, end=2)
    assert T.with_crc(T.with_global_start(T.read_token_files(spark, path))).count() == 0


def check_pieces(docs, pieces, tokens, segments, end=1):
    cover, bins = {}, {}
    for p in pieces:
        cover.setdefault((p.doc_id, p.doc_tokens), []).append(p)
        bins.setdefault(p.sequence_id, []).append(p)
    for b in bins.values():
        b.sort(key=lambda p: p.offset)
        assert [p.offset for p in b] == [sum(q.length for q in b[:i]) for i in range(len(b))]
        assert sum(p.length for p in b) <= tokens and len(b) <= segments
    total = sum(len(ids_of(t)) + 1 for _, t in docs)
    assert sum(p.length for p in pieces) == total
    return bins


def test_packing(spark):
    docs = awkward(spark)
    pieces = pack_documents(docs, PATH, end=1, max_tokens=256, max_segments=16).collect()
    text = {r.doc_id: r.text for r in docs.collect()}
    bins = check_pieces([(r.doc_id, r.text) for r in docs.collect()], pieces, 256, 16)
    for p in pieces:
        ids = ids_of(text[p.doc_id]) + [1]
        assert p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(struct.pack(f"<{p.length}I", *ids[p.start : p.start + p.length]))
    for doc in (3, 25):
        own = sorted((p.start, p.length) for p in pieces if p.doc_id == doc)
        assert [s for s, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))]
    short = [sum(p.length for p in b) for b in bins.values()]
    assert sum(256 - n for n in short if n & (n - 1)) == 0
    assert pack_documents(empty(spark), PATH).count() == 0
    with pytest.raises(ValueError):
        pack_documents(docs, PATH, max_tokens=0)


def test_all_three_limits_hold():
    rng = random.Random(2)
    packer = Packer(64, 5, 20, 0)
    sizes = {}
    for i in range(300):
        n = rng.randint(1, 150)
        sizes[i] = (n, rng.randint(0, n))
        packer.add(i, b"\0\0\0\0" * n, sizes[i][1])
    pieces = [*packer.drain(False), *packer.drain(True)]
    bins, cover = {}, {}
    for key, start, length, _, _, loss, sequence, _ in pieces:
        bins.setdefault(sequence, []).append((length, loss))
        cover.setdefault(key, []).append((start, length))
        n, first = sizes[key]
        assert loss == sum(1 for t in range(start, start + length) if t >= first)
    for b in bins.values():
        assert sum(x for x, _ in b) <= 64 and len(b) <= 5 and sum(y for _, y in b) <= 20
    for key, parts in cover.items():
        parts.sort()
        assert sum(n for _, n in parts) == sizes[key][0] and all(parts[i][0] == sum(n for _, n in parts[:i]) for i in range(len(parts)))


def test_loss_column(spark):
    docs = spark.createDataFrame([(1, "one two three", 2), (2, "four", None)], "doc_id long, text string, prompt int")
    rows = {r.doc_id: r for r in pack_documents(docs, PATH, loss_from_col="prompt").groupBy("doc_id").agg({"loss_tokens": "sum", "length": "sum"}).collect()}
    assert rows[1]["sum(loss_tokens)"] == rows[1]["sum(length)"] - 2 and rows[2]["sum(loss_tokens)"] == rows[2]["sum(length)"]
