"""Token ids of whole texts, and their Parquet files.

Texts are encoded by the ``tokenizers`` library.  A byte-level BPE never joins
text across the start of a white-space run, so a text is cut there and every
distinct chunk is encoded once a worker; most chunks recur.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from codecs import charmap_decode
from itertools import batched, chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quarryline.llm.chunks import SLICE, Table, buffers, groups, hashes, white
from quarryline.workspace import modest_batches

# Unicode's White_Space characters, as the tokenizer's own pattern takes them.
WHITE = "\t-\r \x85\xa0  -     　"
_CHUNK = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
# ASCII marks but for the apostrophe, which may start a contraction.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_MARKS = MARKS.encode()
# Byte-level tokenizers stand a printable sign for every byte.
_PLAIN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_SIGNS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PLAIN)}
_SIGN_TABLE = "".join(chr(_SIGNS.get(b, b)) for b in range(256))
# White space that isn't ASCII, as bytes.
_WIDE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
#: Chunks that a worker remembers; when they run full it starts anew.
REMEMBERED = 1_500_000


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class ChunkEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids, as bytes.

    Special tokens aren't added; their strings inside a text are taken as the
    tokenizer file says.  Memory is bounded by ``SLICE`` (but for a single chunk
    or text that is longer) and ``REMEMBERED``.
    """

    _of: dict[str, ChunkEncoder] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        rules = json.loads(self.tokenizer.to_str())
        kind = rules["pre_tokenizer"] or {}
        if rules["normalizer"] or kind.get("type") != "ByteLevel" or kind["add_prefix_space"] or not kind["use_regex"]:
            raise ValueError("only plain byte-level tokenizers can be asked chunk by chunk")
        self.model = self.tokenizer.model
        self.pieces: dict[bytes, list[int]] = {}  # ids of marks and line feeds
        self._forget()

    @classmethod
    def of(cls, path: str) -> ChunkEncoder:
        """One encoder a worker process."""
        if path not in cls._of:
            cls._of[path] = cls(path)
        return cls._of[path]

    def _forget(self) -> None:
        self.table = Table(REMEMBERED)
        self.begin, self.length = np.zeros(REMEMBERED, np.int64), np.zeros(REMEMBERED, np.int64)
        self.flat, self.used = np.zeros(1 << 20, "<u4"), 0

    def _merged(self, piece: bytes) -> list[int]:
        """The ids of what the tokenizer would not split before it merges bytes."""
        return [t.id for t in self.model.tokenize(charmap_decode(piece, "strict", _SIGN_TABLE)[0])]

    def _piece(self, piece: bytes) -> list[int]:
        if piece not in self.pieces:
            if len(self.pieces) > 50_000:
                self.pieces.clear()
            self.pieces[piece] = self._merged(piece)
        return self.pieces[piece]

    def _asked(self, chunks: list[bytes]) -> list[list[int]]:
        """The ids of chunks that the table doesn't hold."""
        out: list = [None] * len(chunks)
        other, marked = [], []
        for i, chunk in enumerate(chunks):
            core = chunk[1:].rstrip(_MARKS)
            # a Latin word and the marks behind it are apart in every such tokenizer
            if chunk[:1] not in (b" ", b"\n") or not (core.isalpha() or _latin(core)):
                other.append(i)
            elif chunk[:1] == b"\n":
                out[i] = [*self._piece(b"\n"), *self._merged(core)]
                if len(core) + 1 < len(chunk):
                    out[i] += self._piece(chunk[len(core) + 1 :])
            elif len(core) + 1 == len(chunk):
                out[i] = self._merged(chunk)
            else:
                marked.append((i, chunk[: len(core) + 1], chunk[len(core) + 1 :]))
        if marked:
            cores = np.frombuffer(b"".join(m[1] for m in marked), np.uint8)
            stop = np.cumsum([len(m[1]) for m in marked])
            found = self.table.find(*hashes(cores, np.append(0, stop[:-1]), stop))
            for (i, core, marks), e in zip(marked, found.tolist()):
                ids = self._merged(core) if e < 0 else self.flat[self.begin[e] : self.begin[e] + self.length[e]].tolist()
                out[i] = [*ids, *self._piece(marks)]
        for group in batched(other, 4096):
            for i, code in zip(group, self.tokenizer.encode_batch_fast([chunks[i].decode() for i in group], add_special_tokens=False)):
                out[i] = code.ids
        return out

    def _learn(self, h: np.ndarray, first: np.ndarray, codes: list[list[int]]) -> None:
        size = np.array([len(c) for c in codes], np.int64)
        ids = np.fromiter(chain.from_iterable(codes), "<u4", int(size.sum()))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), "<u4")])
        self.flat[self.used : self.used + len(ids)] = ids
        n, k = self.table.size, len(codes)
        self.begin[n : n + k], self.length[n : n + k] = self.used + np.cumsum(size) - size, size
        self.used += len(ids)
        self.table.add(h, first)

    @staticmethod
    def _starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Where the chunks of texts start: at each text, and at each run of white space."""
        start = np.zeros(len(data) + 1, bool)
        if len(data) and data.max() >= 0x80 and _WIDE.search(data.data):
            for a, z in zip(bounds, bounds[1:]):
                at = int(a)
                for chunk in _CHUNK.findall(data[a:z].tobytes().decode()):
                    start[at] = True
                    at += len(chunk.encode())
        else:
            blank = white(data)
            start[1:-1] = blank[1:] & ~blank[:-1]
        start[bounds] = True
        return np.flatnonzero(start[:-1])

    def _ids(self, data: np.ndarray, at: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of chunks, one after the other, and how many each has."""
        h, first = hashes(data, at, stop)
        entry = self.table.find(h, first)
        while (entry < 0).any():
            miss = np.flatnonzero(entry < 0)
            new = miss[np.unique(h[miss], return_index=True)[1]]
            if self.table.size + len(new) > REMEMBERED:
                self._forget()
                entry[:] = -1
                continue
            raw = data.tobytes()
            self._learn(h[new], first[new], self._asked([raw[a:z] for a, z in zip(at[new].tolist(), stop[new].tolist())]))
            entry[miss] = self.table.find(h[miss], first[miss])
        size = self.length[entry]
        return self.flat[np.arange(size.sum()) + np.repeat(self.begin[entry] - (np.cumsum(size) - size), size)], size

    def encode(self, texts, end: bytes = b""):
        """Yields the ids of each text of an Arrow column or a list, with ``end``
        behind them.  Null is the empty text."""
        data, bounds = buffers(texts if isinstance(texts, (pa.Array, pa.ChunkedArray)) else pa.array(list(texts), pa.string()))
        for i, j in groups(bounds):
            part, here = data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i]
            at = self._starts(part, here)
            stop = np.append(at[1:], len(part)) if len(at) else at
            ids, size = zip(*[self._ids_of(part, at[a:z], stop[a:z]) for a, z in groups(np.append(at, len(part)))] or [(np.zeros(0, "<u4"), np.zeros(0, np.int64))])
            raw = np.concatenate(ids).tobytes()
            ends = 4 * np.append(0, np.cumsum(np.concatenate(size)))[np.searchsorted(at, here)]
            for a, z in zip(ends.tolist(), ends[1:].tolist()):
                yield raw[a:z] + end

    def _ids_of(self, data: np.ndarray, at: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(at) == 1 and stop[0] - at[0] > SLICE:  # one chunk that isn't worth remembering
            ids = self.tokenizer.encode(data[at[0] : stop[0]].tobytes().decode(), add_special_tokens=False).ids
            return np.array(ids, "<u4"), np.array([len(ids)])
        return self._ids(data[at[0] : stop[-1]], at - at[0], stop - at[0])


def _latin(core: bytes) -> bool:
    """Whether a word has Latin letters only."""
    text = core.decode()
    return text.isalpha() and max(text) < "ɐ"


def encoded(batches, path: str, end: int):
    """Yields (id, bytes of the text's ids and the end id) for the rows of
    ``batches`` with columns id and text."""
    encoder, mark = ChunkEncoder.of(path), struct.pack("<I", end)
    for b in batches:
        yield from zip(b.column(0).to_pylist(), encoder.encode(b.column(1), mark))


_FILE_SCHEMA = "shard int, shard_start bigint, doc_id {id}, n_tokens int, ids array<int>"
#: Dictionary pages hold a whole vocabulary, so ids take two bytes or fewer; the
#: v2 writer codes the counters as deltas.  Row groups and pages are small
#: enough to read one range of documents by the page index.
FILE_OPTIONS = {
    "compression": "zstd",
    "parquet.writer.version": "v2",
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#shard_start": "false",
    "parquet.enable.dictionary#n_tokens": "false",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
}


def _token_rows(batches, path: str, end: int, kind: pa.DataType):
    shard, start = TaskContext.get().partitionId(), 0
    rows: list[tuple] = []
    size = 0

    def batch():
        ids = np.frombuffer(b"".join(code for _, code in rows), "<i4")
        lengths = np.array([len(code) // 4 for _, code in rows], np.int64)
        ends = np.cumsum(lengths)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(rows), shard, np.int32)),
                pa.array(start + ends - lengths),
                pa.array([i for i, _ in rows], kind),
                pa.array(lengths.astype(np.int32)),
                pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids)),
            ],
            ["shard", "shard_start", "doc_id", "n_tokens", "ids"],
        )

    for row in encoded(batches, path, end):
        rows.append(row)
        size += len(row[1])
        if size >= 4 << 20:
            yield batch()
            start, rows, size = start + size // 4, [], 0
    if rows:
        yield batch()


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end: int, id_col: str = "doc_id", text_col: str = "text", options: dict | None = None
) -> None:
    """Write ``docs`` as token files in ascending id order.

    One row a document: ``shard`` (its file's rank), ``shard_start`` (ids before
    it in the shard), ``doc_id``, ``n_tokens`` and ``ids``, with the id ``end``
    behind each document.  A null or empty text is the end id alone.  Null ids
    come first; rows that repeat an id stay, side by side.  Other columns are
    left out, and an empty table leaves files without rows.
    """
    modest_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("tie"))
    kind = rows.schema["doc_id"].dataType
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    arrow = to_arrow_type(kind)
    coded = ordered.mapInArrow(lambda it: _token_rows(it, tokenizer, end, arrow), _FILE_SCHEMA.format(id=kind.simpleString()))
    coded.write.options(**FILE_OPTIONS, **(options or {})).parquet(path)


def read_token_files(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """The rows of token files.  Select columns to read no ids, and filter
    ``doc_id`` to read only the pages that hold a range of documents."""
    return spark.read.schema(_FILE_SCHEMA.format(id=id_type)).parquet(path)


def with_global_start(files: DataFrame) -> DataFrame:
    """Adds ``start``: ids of all documents before a row's, over all shards.

    The shard totals, one number a file, are all that the driver sees.
    """
    totals = files.groupBy("shard").agg(F.sum(F.col("n_tokens").cast("long")).alias("n")).orderBy("shard").collect()
    base, rows = 0, []
    for r in totals:
        rows.append((r.shard, base))
        base += r.n
    bases = files.sparkSession.createDataFrame(rows, "shard int, base bigint")
    return files.join(F.broadcast(bases), "shard").withColumn("start", F.col("base") + F.col("shard_start")).drop("base")


def _crcs(batches):
    for b in batches:
        ids = b.column("ids")
        ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
        bounds = ids.offsets.to_numpy()
        values = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), "<u4")).cast("B")
        crc = [zlib.crc32(values[4 * a : 4 * z]) for a, z in zip(bounds, bounds[1:])]
        n = b.schema.get_field_index("ids")
        yield pa.RecordBatch.from_arrays(
            [*(b.column(i) for i in range(n)), pa.array(crc, pa.int64())], [*b.schema.names[:n], "ids_crc32"]
        )


def with_crc(files: DataFrame) -> DataFrame:
    """Replaces ``ids`` by ``ids_crc32``, the unsigned CRC-32 of the ids as
    little-endian unsigned 32-bit integers."""
    others = [c for c in files.columns if c != "ids"]
    types = dict(files.dtypes)
    schema = ", ".join(f"{c} {types[c]}" for c in others) + ", ids_crc32 bigint"
    return files.select(*others, "ids").mapInArrow(_crcs, schema)
