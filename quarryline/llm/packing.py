"""Packing of token sequences by vector bin packing.

A piece of a document is a vector: its tokens, itself as one segment, and its
loss-bearing tokens.  A sequence is filled bin by bin: of the pieces that fit
in all three dimensions, the one with the largest dot product with the room
that is left comes next.  Where none fits, the one with the largest product is
cut to fill the room.  Each Spark partition packs a stream of its documents
within bounded memory and carries what doesn't fill a sequence on; nothing is
shuffled and no group can be hot.
"""

from __future__ import annotations

import struct
import zlib
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quarryline.llm.tokens import ChunkEncoder
from quarryline.workspace import modest_batches

_SCHEMA = (
    "doc_id {id}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "loss_tokens bigint, sequence_id bigint, offset bigint"
)
#: Tokens and documents that a task holds at a time.
WINDOW_TOKENS, WINDOW_DOCS = 1 << 20, 2048


class Packer:
    """Packs a stream of (key, ids, first loss-bearing position)."""

    def __init__(self, tokens: int, segments: int, loss: int, first_sequence: int):
        self.limit = np.array([tokens, segments, loss], np.float64)
        self.tokens, self.segments, self.loss = tokens, segments, loss
        self.sequence = first_sequence
        self.pool: list[tuple] = []  # key, ids, first loss position, start
        self.held = 0

    def add(self, key, ids: bytes, loss_from: int) -> None:
        self.pool.append((key, ids, loss_from, 0))
        self.held += len(ids) // 4

    def _piece(self, item, start: int, length: int, offset: int, room: list):
        key, ids, loss_from, _ = item
        loss = max(0, start + length - max(start, loss_from))
        room[0] -= length
        room[1] -= 1
        room[2] -= loss
        return key, start, length, zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)]), len(ids) // 4, loss, self.sequence, offset

    def _longest(self, item, start: int, room: list) -> int:
        """How many tokens from ``start`` fit in tokens and loss."""
        left = len(item[1]) // 4 - start
        free = max(0, item[2] - start)  # tokens without loss come first
        return int(min(left, room[0], free + room[2]))

    def drain(self, last: bool):
        """Yields the pieces of all sequences that can be filled now; at last
        those of the rest, whose sequences have lengths of powers of two."""
        n = len(self.pool)
        start = np.array([p[3] for p in self.pool], np.int64)
        size = np.array([len(p[1]) // 4 for p in self.pool], np.int64) - start
        free = np.array([p[2] for p in self.pool], np.int64)
        loss = np.minimum(size, np.maximum(0, start + size - free))
        alive = np.ones(n, bool)
        total = int(size.sum())
        while total >= self.tokens or (last and total):
            goal = self.tokens if total >= self.tokens else 1 << (total.bit_length() - 1)
            room, offset = [goal, self.segments, self.loss], 0
            while room[0] > 0 and room[1] > 0 and total:
                share = np.array(room, np.float64) / self.limit
                score = size * (share[0] / self.limit[0]) + share[1] / self.limit[1] + loss * (share[2] / self.limit[2])
                fits = alive & (size <= room[0]) & (loss <= room[2])
                # a whole fit first, unless a piece longer than any sequence can fill it alone
                long = alive & (size >= goal) if offset == 0 else None
                if long is not None and long.any():
                    fits = long
                where = fits if fits.any() else alive
                at = int(np.argmax(np.where(where, score, -1.0)))
                length = self._longest(self.pool[at], int(start[at]), room)
                if length <= 0:  # no room for its loss-bearing tokens
                    break
                yield self._piece(self.pool[at], int(start[at]), length, offset, room)
                offset += length
                total -= length
                start[at] += length
                size[at] -= length
                loss[at] = min(size[at], max(0, start[at] + size[at] - free[at]))
                alive[at] = size[at] > 0
            self.sequence += 1
        self.pool = [(k, ids, f, int(s)) for (k, ids, f, _), s, a in zip(self.pool, start, alive) if a]
        self.held = total


def _pack(batches, tokenizer: str, end: int, limits: tuple[int, int, int], kind: pa.DataType, loss: str | None):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "loss_tokens", "sequence_id", "offset"]
    packer, encoder, mark = Packer(*limits, TaskContext.get().partitionId() << 40), ChunkEncoder.of(tokenizer), struct.pack("<I", end)

    def batch(rows):
        columns = list(zip(*rows)) or [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, kind if i == 0 else pa.int64()) for i, c in enumerate(columns)], names)

    def examples(b):
        keys, ids = b.column(0).to_pylist(), encoder.encode(b.column(1), mark)
        if loss == "prompt":
            for key, prompt, answer in zip(keys, encoder.encode(b.column(2)), ids):
                yield key, prompt + answer, len(prompt) // 4
        else:
            yield from zip(keys, ids, b.column(2).fill_null(0).to_pylist() if loss else repeat(0))

    for b in batches:
        for example in examples(b):
            packer.add(*example)
            if packer.held >= WINDOW_TOKENS or len(packer.pool) >= WINDOW_DOCS:
                yield batch(packer.drain(False))
    yield batch(packer.drain(True))


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end: int = 1,
    max_tokens: int = 2048,
    max_segments: int = 512,
    max_loss: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    loss_from_col: str | None = None,
    prompt_col: str | None = None,
) -> DataFrame:
    """Pack all of ``docs``, whole, into sequences; one row a piece.

    A document's ids are those of its text (null: empty) and then ``end``.
    ``loss_from_col`` names a column with the position of a document's first
    loss-bearing token (null: 0); ``prompt_col`` one with a text whose ids come
    first and bear no loss (null: empty), as before an answer.  Without either all
    tokens bear loss.  No sequence has more than ``max_tokens`` tokens,
    ``max_segments`` pieces or ``max_loss`` (default: no limit of its own)
    loss-bearing tokens.  Every id lies in exactly one piece.  The last
    sequences of a partition have lengths of powers of two.

    Returns ``doc_id, start, length, ids_crc32, doc_tokens, loss_tokens,
    sequence_id, offset``; rows that repeat an id are packed apart, and of pieces
    with equal products the first one read goes first.  An empty
    table gives no rows.
    """
    modest_batches(docs.sparkSession)
    columns = [F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")]
    if loss_from_col:
        columns.append(F.col(loss_from_col).cast("long").alias("loss_from"))
    if prompt_col:
        columns.append(F.col(prompt_col).alias("prompt"))
    if loss_from_col and prompt_col:
        raise ValueError("give one of loss_from_col and prompt_col")
    rows = docs.select(*columns)
    kind = rows.schema["doc_id"].dataType.simpleString()
    arrow = to_arrow_type(rows.schema["doc_id"].dataType)
    limits = (max_tokens, max_segments, max_loss or max_tokens)
    if min(limits) < 1:
        raise ValueError("limits must be positive")
    loss = "prompt" if prompt_col else "position" if loss_from_col else None
    return rows.mapInArrow(lambda it: _pack(it, tokenizer, end, limits, arrow, loss), _SCHEMA.format(id=kind))
