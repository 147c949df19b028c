"""SentencePiece encoding of merge-type vocabularies, and decoding.

A text is cut where no piece of the vocabulary could reach across, and every
distinct stretch is encoded once a worker: an agenda holds the adjacent pairs
of symbols that form a piece, and the pair of the best score, the leftmost of
equals, is merged until none is left.  Each Arrow batch's new stretches are
checked against the ``sentencepiece`` library.
"""

from __future__ import annotations

import hashlib
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quarryline.llm.chunks import SLICE
from quarryline.llm.tokens import ChunkEncoder
from quarryline.workspace import modest_batches

#: The sign that stands for a space in pieces.
SPACE = "▁"
# Texts handed to the library at a time, in bytes of ids.
_DECODED = 4 << 20


class PieceEncoder(ChunkEncoder):
    """Encodes texts to ids as the library does with a merge-type model.

    Taken are models with byte fallback whose normalizer only turns spaces into
    ``SPACE`` and puts one in front of a text; others raise a ``ValueError``, as
    does a stretch whose ids differ from the library's.  Memory is bounded as in
    ``ChunkEncoder``.
    """

    _of: dict[str, PieceEncoder] = {}

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        self.library = SentencePieceProcessor(model_file=path)
        model = sentencepiece_model_pb2.ModelProto.FromString(self.library.serialized_model_proto())
        norm, trained = model.normalizer_spec, model.trainer_spec
        kinds = model.SentencePiece
        plain = norm.add_dummy_prefix and norm.escape_whitespaces and not norm.remove_extra_whitespaces and not norm.precompiled_charsmap
        if trained.model_type != trained.BPE or not trained.byte_fallback or trained.treat_whitespace_as_suffix or not plain:
            raise ValueError("only merge-type models with byte fallback and a plain normalizer are taken")
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
            raise ValueError("pieces that users defined, or that are not in use, are not taken")
        normal = [(i, p) for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL]
        # A piece stands with spaces for SPACE, as the texts do.
        self.id = {p.piece.replace(SPACE, " "): i for i, p in normal}
        self.cost = {p.piece.replace(SPACE, " "): -p.score for i, p in normal}
        self.byte = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.begin_id, self.end_id = self.library.bos_id(), self.library.eos_id()
        #: Whether a piece joins a character that ends in one byte to one that starts with another.
        self.joins = np.zeros((256, 256), bool)
        self.joins[:, 0x80:0xC0] = True  # bytes of one character
        for piece in self.id:
            for a, b in zip(piece, piece[1:]):
                self.joins[a.encode()[-1], b.encode()[0]] = True
        # No piece goes past this sign, so that the library can be asked for what follows it.
        self.wall = next(c for c in map(chr, [10, *range(1, 128)]) if not any(c in p for p in self.id))
        self.walled = len(self.library.encode(self.wall))
        self._forget()

    def merged(self, text: str) -> list[int]:
        """The ids of a text whose spaces stand already, by the agenda.

        Entries are (cost, place, stamp): the pair that starts at ``place`` and
        makes a piece of ``stamp`` characters.  An entry is stale when a symbol
        of its pair has been merged since, which changes that length.
        """
        piece, cost = list(text), self.cost
        n = len(piece)
        if n == 1 or text in self.id and n == 2:
            return self._of_symbols([text])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [(c, i, 2) for i in range(n - 1) if (c := cost.get(text[i : i + 2])) is not None]
        heapify(agenda)
        while agenda:
            _, i, size = heappop(agenda)
            left = piece[i]
            j = after[i]
            if not left or j >= n or len(left) + len(piece[j]) != size:
                continue
            piece[i] = left = left + piece[j]
            piece[j] = ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                both = left + piece[k]
                if (c := cost.get(both)) is not None:
                    heappush(agenda, (c, i, len(both)))
            h = before[i]
            if h >= 0:
                both = piece[h] + left
                if (c := cost.get(both)) is not None:
                    heappush(agenda, (c, h, len(both)))
        return self._of_symbols([p for p in piece if p])

    def _of_symbols(self, symbols: list[str]) -> list[int]:
        ids: list[int] = []
        for s in symbols:
            known = self.id.get(s)
            if known is None:
                ids += [self.byte[b] for b in s.encode()]
            else:
                ids.append(known)
        return ids

    def _asked(self, chunks: list[bytes]) -> list[list[int]]:
        """The ids of stretches that the table doesn't hold, checked with the library."""
        texts = [c.decode() for c in chunks]
        out = [self.merged(t) for t in texts]
        for text, ids, told in zip(texts, out, self.library.encode([self.wall + t for t in texts], num_threads=1)):
            if ids != told[self.walled :]:
                raise ValueError(f"{text!r} has the ids {told[self.walled:]} in the library, not {ids}")
        return out

    def _starts(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Where no piece reaches across, and where texts start."""
        start = np.zeros(len(data) + 1, bool)
        start[1:-1] = ~self.joins[data[:-1], data[1:]]
        start[bounds] = True
        return np.flatnonzero(start[:-1])

    def _ids_of(self, data: np.ndarray, at: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(at) == 1 and stop[0] - at[0] > SLICE:  # one stretch that isn't worth remembering
            ids = self._asked([data[at[0] : stop[0]].tobytes()])[0]
            return np.array(ids, "<u4"), np.array([len(ids)])
        return self._ids(data[at[0] : stop[-1]], at - at[0], stop - at[0])

    def encode(self, texts, end: bytes = b""):
        """Yields the ids of each text, as bytes, with ``end`` behind them.  Null is the empty text."""
        column = texts if isinstance(texts, (pa.Array, pa.ChunkedArray)) else pa.array(list(texts), pa.string())
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        column = pc.replace_substring(column.fill_null("").cast(pa.large_string()), SPACE, " ")
        spaced = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), column, pa.scalar(" ", pa.large_string()))
        yield from super().encode(pc.if_else(pc.equal(pc.binary_length(column), 0), column, spaced), end)

    def decode(self, codes: list[bytes]) -> list[str]:
        """The texts of little-endian unsigned 32-bit ids, by the library."""
        return self.library.decode([np.frombuffer(c, "<u4").tolist() for c in codes], num_threads=1)


def _decoded(encoder: PieceEncoder, codes):
    """Yields (ids, text), decoding a few megabytes at a time."""
    group: list[bytes] = []
    size = 0
    for code in codes:
        group.append(code)
        size += len(code)
        if size >= _DECODED:
            yield from zip(group, encoder.decode(group))
            group, size = [], 0
    if group:
        yield from zip(group, encoder.decode(group))


def _coded(batches, path: str, ends: bool, kind: pa.DataType):
    encoder = PieceEncoder.of(path)
    begin, end = (np.array([i], "<u4").tobytes() if ends else b"" for i in (encoder.begin_id, encoder.end_id))
    for b in batches:
        ids = [np.frombuffer(begin + code, "<i4") for code in encoder.encode(b.column(1), end)]
        bounds = np.append(0, np.cumsum([len(i) for i in ids])).astype(np.int32)
        flat = np.concatenate([np.zeros(0, "<i4"), *ids])
        yield pa.RecordBatch.from_arrays([b.column(0).cast(kind), pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))], ["id", "ids"])


def encode_pieces(docs: DataFrame, model: str, ends: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ids of whole texts: ``id`` and ``ids`` (array of int), one row a row of ``docs``.

    ``ends`` puts the model's begin and end ids around each text.  A null text is
    the empty one, which has these two alone; null and repeated ids stay; other
    columns are left out, and an empty table has no rows.
    """
    modest_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = to_arrow_type(rows.schema["id"].dataType)
    return rows.mapInArrow(lambda it: _coded(it, model, ends, kind), f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>")


def _texts(batches, path: str, kind: pa.DataType):
    encoder = PieceEncoder.of(path)
    for b in batches:
        ids = b.column(1).combine_chunks() if isinstance(b.column(1), pa.ChunkedArray) else b.column(1)
        codes = (np.array(i or [], "<u4").tobytes() for i in ids.to_pylist())
        yield pa.RecordBatch.from_arrays([b.column(0).cast(kind), pa.array([t for _, t in _decoded(encoder, codes)], pa.string())], ["id", "text"])


def decode_pieces(coded: DataFrame, model: str) -> DataFrame:
    """The texts of rows of ``id`` and ``ids``: ``id`` and ``text``.

    Spaces stand for ``SPACE``, one in front is dropped, and runs of byte ids are
    read as UTF-8, with U+FFFD for what isn't.  Null ids are an empty text.
    """
    modest_batches(coded.sparkSession)
    kind = to_arrow_type(coded.schema["id"].dataType)
    return coded.select("id", "ids").mapInArrow(lambda it: _texts(it, model, kind), f"id {coded.schema['id'].dataType.simpleString()}, text string")


def _digests(batches, path: str, kind: pa.DataType):
    encoder = PieceEncoder.of(path)
    begin, end = (np.array([i], "<u4").tobytes() for i in (encoder.begin_id, encoder.end_id))
    for b in batches:
        n, ids, texts = [], [], []
        for code, text in _decoded(encoder, (begin + code for code in encoder.encode(b.column(1), end))):
            n.append(len(code) // 4)
            ids.append(hashlib.sha256(code).hexdigest())
            texts.append(hashlib.sha256(text.encode()).hexdigest())
        yield pa.RecordBatch.from_arrays([b.column(0).cast(kind), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])


def piece_digests(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes and decodes whole texts in one pass: ``id``, ``n_tokens`` (begin and
    end ids included), ``ids_sha256`` (of little-endian unsigned 32-bit ids) and
    ``decoded_sha256``.  Rows are treated as in ``encode_pieces``."""
    modest_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    name = rows.schema["id"].dataType
    kind = to_arrow_type(name)
    return rows.mapInArrow(lambda it: _digests(it, model, kind), f"id {name.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
