"""Sentence pieces against the sentencepiece library."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarryline.llm.pieces import PieceEncoder, decode_pieces, encode_pieces, piece_digests
from quarryline.llm.queries import QUERIES
from quarryline.llm.tokens import tokenizer_path
from tests.llm.helpers import awkward, empty

MODEL = tokenizer_path("piece_bpe_32k.model")
ODD = ["", None, " ", "  ", "   two   spaces ", "\n", " \n a\tb\r\n", "▁", "▁▁ a▁b", "日本語のテキスト😀 é́", "\x00\x01 a", "� ​", "a" * 5000, "ab " * 3000, "<s></s><unk><0x0A>", "x" + "é" * 999]


def _ids(texts):
    return [np.frombuffer(c, "<u4").tolist() for c in PieceEncoder.of(MODEL).encode(pa.array(texts, pa.string()))]


def test_awkward_texts_equal_the_library():
    library = PieceEncoder.of(MODEL).library
    assert _ids(ODD) == [library.encode(t or "") for t in ODD]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" ▁\nabcdeéthesing.,'ßñ日"), st.characters(exclude_categories=["Cs"]))), max_size=6))
def test_any_texts_equal_the_library(texts):
    library = PieceEncoder.of(MODEL).library
    assert _ids(texts) == [library.encode(t) for t in texts]


def test_the_agenda_merges_by_score_then_from_the_left():
    encoder = PieceEncoder.of(MODEL)
    for text in ("aaaa", "aaaaa", " the then", "nnnnnnn", "ssss sss", "    x", " " * 40 + "y", "0000000"):
        assert encoder.merged(" " + text) == encoder.library.encode(text)


def test_a_difference_from_the_library_is_an_error():
    encoder = PieceEncoder(MODEL)
    encoder.cost = {k: -v for k, v in encoder.cost.items()}
    with pytest.raises(ValueError, match="in the library"):
        list(encoder.encode(["internationalisation of otherwise unthinkable aaaaa things"]))


def test_rows_stay_and_round_trips(spark):
    docs = awkward(spark)
    library = PieceEncoder.of(MODEL).library
    rows = docs.select("doc_id", "text").collect()
    coded = encode_pieces(docs, MODEL)
    want = sorted((str(r.doc_id), library.encode(r.text or "", add_bos=True, add_eos=True)) for r in rows)
    assert sorted((str(r.id), list(r.ids)) for r in coded.collect()) == want
    assert sorted((str(r.id), r.text) for r in decode_pieces(coded, MODEL).collect()) == sorted((str(r.doc_id), r.text or "") for r in rows)
    assert encode_pieces(empty(spark), MODEL).count() == piece_digests(empty(spark), MODEL).count() == 0


def test_registered_query_equals_the_library(spark):
    sf = "/root/testdata/sf0.001"
    library = PieceEncoder.of(MODEL).library
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = library.encode(r.text or "", add_bos=True, add_eos=True)
        want[r.doc_id] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())
    found = QUERIES["op11_sentencepiece"](spark, sf)
    assert dict(found.dtypes) == {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found.collect()} == want
