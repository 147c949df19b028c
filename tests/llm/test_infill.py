"""Fill-in-the-middle against a plain version on strings, and round trips."""

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from quarryline.llm.infill import Rule, fill_in_middle, restore, rotate, transform
from quarryline.llm.queries import QUERIES
from tests.llm.helpers import awkward, empty


def plain(text, key):
    """The contract, word by word."""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n, drawn = len(units), hashlib.sha256(f"7:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(drawn[i : i + 8], 16) for i in range(0, 32, 8))
    if text == "" or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    if h4 % 100 < 50:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("a\n\ré日<>PSM 😀")), st.integers(-5, 10**12))
def test_rotations_equal_slices_and_are_undone(text, key):
    output, form, n, a, b = transform(text.encode(), str(key))
    want = plain(text, key)
    assert (n, form, output.decode()) == (want[0], want[1], want[4])
    if form != "plain":
        raw = text.encode()
        assert (len(raw[:a].decode()), len(raw[a:b].decode())) == want[2:4]
    assert restore(output, form) == text.encode()


def test_three_reversals_exchange_blocks():
    data = bytearray(b"..abcde++")
    rotate(data, 2, 4, 7)
    assert data == b"..cdeab++"
    rotate(data, 2, 5, 7)
    assert data == b"..abcde++"


def test_shares_are_kept():
    none, half = Rule(transformed=0), Rule(transformed=50, suffix_first=0)
    assert transform(b"a\nb", "1", none)[1] == "plain"
    forms = [transform(b"a\nb", str(i), half)[1] for i in range(2000)]
    assert 900 < forms.count("psm") < 1100 and "spm" not in forms


def test_rows_of_any_kind(spark):
    docs = awkward(spark)
    found = sorted((str(r.id), r.n, r.form, r.output, r.restored) for r in fill_in_middle(docs).collect())
    want = []
    for r in docs.select("doc_id", "text").collect():
        n, form, _, _, output = plain(r.text or "", "" if r.doc_id is None else r.doc_id)
        want.append((str(r.doc_id), n, form, output, r.text or ""))
    assert found == sorted(want)
    assert fill_in_middle(empty(spark)).count() == 0


def test_registered_query_equals_the_plain_version(spark):
    sf = "/root/testdata/sf0.001"
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        *first, output = plain(r.text or "", r.doc_id)
        want[r.doc_id] = (*first, sha(output), sha(r.text or ""))
    found = QUERIES["op12_infill"](spark, sf)
    assert {r.doc_id: (r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256) for r in found.collect()} == want
