"""Fill-in-the-middle: texts rotated in place, and rotated back.

A text is cut into units; two cuts part it into prefix, middle and suffix.  The
marks of the parts are inserted in a ``bytearray``, and blocks change places by
three reversals each.  Reading the output finds the marks and inverts the
rotations, which restores the text exactly.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quarryline.workspace import modest_batches

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"


@dataclass(frozen=True)
class Rule:
    """Shares of texts in hundredths, and the salt of the hash that draws cuts and forms."""

    salt: str = "7"
    transformed: int = 100  # of all texts
    suffix_first: int = 50  # of the transformed ones


def rotate(data: bytearray, start: int, middle: int, stop: int) -> None:
    """Exchanges the blocks ``[start, middle)`` and ``[middle, stop)`` by three reversals."""
    for a, z in ((start, middle), (middle, stop), (start, stop)):
        data[a:z] = data[a:z][::-1]


def line_cuts(text: bytes) -> np.ndarray:
    """Where the lines of a text end, each with its line feed, from 0 for no line."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    whole = len(text) if len(text) and (not len(ends) or ends[-1] < len(text)) else None
    return np.concatenate([[0], ends, [] if whole is None else [whole]]).astype(np.int64)


def transform(text: bytes, key: str, rule: Rule = Rule()) -> tuple[bytes, str, int, int, int]:
    """Output, form, units, and the ends of prefix and middle in bytes (-1 if plain)."""
    cuts = line_cuts(text)
    n = len(cuts) - 1
    drawn = hashlib.sha256(f"{rule.salt}:{key}".encode()).digest()
    h1, h2, h3, h4 = (int.from_bytes(drawn[i : i + 4]) for i in range(0, 16, 4))
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= rule.transformed:
        return text, "plain", n, -1, -1
    a, b = (int(cuts[i]) for i in sorted((h1 % (n + 1), h2 % (n + 1))))
    data = bytearray(text)
    data[b:b] = MIDDLE
    rotated = len(data) - b  # the middle's mark and the suffix
    data[a:a] = SUFFIX
    data[0:0] = PREFIX
    # <P> prefix <S> middle <M> suffix
    start = len(PREFIX) + a + len(SUFFIX)
    stop = start + b - a
    assert len(data) - stop == rotated
    rotate(data, start, stop, len(data))  # <M> suffix middle
    rotate(data, start, start + len(MIDDLE), len(data) - (b - a))  # suffix <M> middle
    if h4 % 100 < rule.suffix_first:
        # <P> prefix and <S> suffix change places
        rotate(data, 0, len(PREFIX) + a, len(data) - (b - a) - len(MIDDLE))
        return bytes(data), "spm", n, a, b
    return bytes(data), "psm", n, a, b


def restore(output: bytes, form: str) -> bytes:
    """The text that ``transform`` made ``output`` of."""
    if form == "plain":
        return output
    data = bytearray(output)
    mark = data.index(MIDDLE)
    if form == "spm":
        rotate(data, 0, data.index(PREFIX), mark)  # <P> prefix <S> suffix
    elif form != "psm":
        raise ValueError(f"no form {form!r}")
    start = data.index(SUFFIX) + len(SUFFIX)
    rotate(data, start, mark, mark + len(MIDDLE))  # <M> suffix middle
    middle = len(data) - mark - len(MIDDLE)
    rotate(data, start, len(data) - middle, len(data))  # middle <M> suffix
    at = start + middle
    del data[at : at + len(MIDDLE)]
    del data[start - len(SUFFIX) : start]
    del data[: len(PREFIX)]
    return bytes(data)


def _chars(text: bytes) -> int:
    """Code points of UTF-8."""
    return int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))


def _rows(batches, rule: Rule, digest: bool, kind: pa.DataType):
    text_kind = pa.string()
    for b in batches:
        columns: list[list] = [[] for _ in range(6)]
        keys = b.column(2).to_pylist()
        for key, value in zip(keys, b.column(1)):
            text = b"" if not value.is_valid else value.as_buffer().to_pybytes()
            output, form, n, x, y = transform(text, key or "", rule)
            row = [n, form, None if x < 0 else _chars(text[:x]), None if x < 0 else _chars(text[x:y])]
            if digest:
                row += [hashlib.sha256(output).hexdigest(), hashlib.sha256(restore(output, form)).hexdigest()]
            else:
                row += [output.decode(), restore(output, form).decode()]
            for column, cell in zip(columns, row):
                column.append(cell)
        kinds = [pa.int64(), text_kind, pa.int64(), pa.int64(), text_kind, text_kind]
        yield pa.RecordBatch.from_arrays([b.column(0).cast(kind), *[pa.array(c, k) for c, k in zip(columns, kinds)]], ["id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"])


def fill_in_middle(docs: DataFrame, rule: Rule = Rule(), digest: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rotates whole texts: ``id``, ``n`` (lines), ``form`` (``plain``, ``psm`` or
    ``spm``), ``prefix_chars`` and ``middle_chars`` (code points; null if plain),
    ``output`` and ``restored``; with ``digest`` the last two as SHA-256.

    Cuts and form are drawn from the id by a hash, so a row's output never depends
    on others: repeated ids with equal texts get equal outputs.  A null text is the
    empty one and stays plain, as does a text that holds one of the marks; a null
    id draws as the empty string.  Other columns are left out, and an empty table
    has no rows.  A task holds one Arrow batch and two copies of one text.
    """
    modest_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(id_col).cast("string").alias("key"))
    name = rows.schema["id"].dataType
    kind = to_arrow_type(name)
    return rows.mapInArrow(lambda it: _rows(it, rule, digest, kind), f"id {name.simpleString()}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string, restored string")
