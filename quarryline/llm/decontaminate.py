"""Benchmark decontamination by CGK embeddings and bit-sampling LSH.

Texts and items are sequences of words.  A random walk over a sequence (Chakraborty,
Goldenberg and Koucky) writes the symbol it stands on and, by a random bit of
that symbol and step, moves on or stays; sequences within a small edit distance
give walks within a small Hamming distance.  Each repetition takes its own walk
and samples a few of its steps as a hash key; the number of repetitions follows
from the collision rate that simulated pairs at the largest distance show, so
that the wanted recall is reached.  Windows of an item's size that share a key
with it are verified by the exact edit distance.

Where windows stand is told by a lossless count: a sequence within ``k`` edits of
an item of ``n`` words shares a run of at least ``ceil((n - k) / (k + 1))`` of
its words, and each such run places windows at all shifts that ``k`` edits allow.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quarryline.workspace import modest_batches

SAMPLED = 2  # steps in a key
#: Words of the items that are held, and broadcast, at a time.
BLOCK_WORDS = 1_000_000
#: Every item is found by parts of equal length, of at most so many words, and
#: verified whole: an item within its edits has a part within that part's share.
PART_WORDS = 256
#: Most repetitions of a walk.
MOST = 512
SLICE = 1 << 21

_U = np.uint64
_WORD = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
_PLACE = np.random.default_rng(11).integers(1, 1 << 63, 1024, dtype=np.uint64) * _U(2) + _U(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)


def _some_words(data: np.ndarray):
    wide = np.concatenate([[False], _WORD[data], [False]])
    edge = np.flatnonzero(wide[1:] != wide[:-1])
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, _U), starts, ends
    low = _LOWER[data]
    if (data >= 128).any():  # capitals from À to Þ
        prior = np.concatenate([[0], data[:-1]])
        low = np.where((prior == 0xC3) & (data >= 0x80) & (data <= 0x9E) & (data != 0x97), data + 32, low).astype(np.uint8)
    size = ends - starts
    at = np.flatnonzero(wide[1:-1])
    first = np.cumsum(size) - size
    place = np.arange(len(at)) - np.repeat(first, size)
    part = (low[at].astype(_U) + _U(1)) * _PLACE[place & 1023]
    return _mixed(np.add.reduceat(part, first) + size.astype(_U)), starts, ends


def words(text: bytes):
    """Hashes of a text's words, and their bounds in bytes.  Words are runs of
    letters and digits, without regard to case."""
    data = np.frombuffer(text, np.uint8)
    if len(data) <= SLICE:
        return _some_words(data)
    found, at = [], 0
    while at < len(data):
        stop = min(len(data), at + SLICE)
        while stop < len(data) and _WORD[data[stop]]:
            gap = np.flatnonzero(~_WORD[data[stop : stop + SLICE]])
            stop = stop + int(gap[0]) if len(gap) else min(len(data), stop + SLICE)
        h, a, z = _some_words(data[at:stop])
        found.append((h, a + at, z + at))
        at = stop
    return tuple(np.concatenate(x) for x in zip(*found))


def _runs(h: np.ndarray, q: int) -> np.ndarray:
    """Hashes of all runs of ``q`` words."""
    n = len(h) - q + 1
    if n <= 0:
        return np.zeros(0, _U)
    total = np.zeros(n, _U)
    for i in range(q):
        total = (total ^ h[i : i + n]) * _U(0x9E3779B97F4A7C15)
        total ^= total >> _U(29)
    return total


def edit_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Least edit distance of ``item`` to any stretch of ``text``, and that
    stretch's bounds (the last to end, of the best)."""
    n, m = len(item), len(text)
    cost, start = np.zeros(m + 1, np.int64), np.arange(m + 1)
    steps = np.arange(m + 1)
    for i in range(n):
        swap = cost[:-1] + (text != item[i])
        drop = cost[1:] + 1
        best = np.concatenate([[cost[0] + 1], np.minimum(swap, drop)])
        origin = np.concatenate([[start[0]], np.where(swap <= drop, start[:-1], start[1:])])
        # insertions: the least of best[j] + (here - j) over all j up to here
        slack = best - steps
        low = np.minimum.accumulate(slack)
        keep = np.maximum.accumulate(np.where(slack == low, steps, 0))
        cost, start = low + steps, origin[keep]
    end = int(m - np.argmin(cost[::-1]))
    return int(cost[end]), int(start[end]), end


class Walks:
    """The repeated walks and sampled steps for sequences of ``n`` words."""

    def __init__(self, n: int, repeats: int, seed: int = 5):
        rng = np.random.default_rng([seed, n])
        self.n = n
        self.steps = np.sort(np.stack([rng.choice(2 * n, SAMPLED, replace=False) for _ in range(repeats)]), axis=1)
        self.salt = rng.integers(0, 1 << 63, (2 * n, repeats), dtype=np.uint64)

    def keys(self, rows: np.ndarray) -> np.ndarray:
        """A key for each row of ``n`` words and each repetition."""
        padded = np.concatenate([rows, np.zeros((len(rows), 1), _U)], axis=1)
        at = np.zeros((len(rows), len(self.steps)), np.int64)
        key = np.tile(np.arange(1, len(self.steps) + 1, dtype=_U), (len(rows), 1))
        line = np.arange(len(rows))[:, None]
        for j in range(int(self.steps.max()) + 1):
            symbol = padded[line, at]
            taken = (self.steps == j).any(axis=1)
            if taken.any():
                key[:, taken] = _mixed(key[:, taken] * _U(31) ^ symbol[:, taken])
            move = _mixed(symbol ^ self.salt[j]) >> _U(63)
            at = np.minimum(at + move.astype(np.int64), self.n)
        return key


def repeats_for(n: int, k: int, recall: float, trials: int = 300) -> int:
    """Repetitions after which pairs at ``k`` edits collide with probability
    ``recall``; ``ValueError`` where ``MOST`` aren't enough."""
    rng = np.random.default_rng([3, n, k])
    a, b = [], []
    for _ in range(trials):
        x = rng.integers(1, 1 << 62, n, dtype=np.uint64)
        y = list(x)
        for _ in range(k):
            kind, at = rng.integers(3), int(rng.integers(max(1, len(y))))
            if kind == 0:
                y.insert(at, rng.integers(1, 1 << 62, dtype=np.uint64))
            elif kind == 1 and len(y) > 1:
                del y[at]
            else:
                y[at] = rng.integers(1, 1 << 62, dtype=np.uint64)
        a.append(x)
        b.append(np.array((y + [0] * n)[:n], _U))
    size = min(64, MOST)
    while True:
        walks = Walks(n, size)
        met = np.maximum.accumulate(walks.keys(np.array(a)) == walks.keys(np.array(b)), axis=1).mean(axis=0)
        good = np.flatnonzero(met >= recall)
        if len(good):
            return int(good[0]) + 1
        if size == MOST:
            raise ValueError(f"{MOST} walks over {n} words don't reach a recall of {recall} at {k} edits")
        size = min(2 * size, MOST)


@dataclass
class Index:
    """One block of items."""

    ids: list
    wholes: list = field(default_factory=list)  # of each item: (words, edits)
    items: list[np.ndarray] = field(default_factory=list)  # the parts
    edits: list[int] = field(default_factory=list)
    part_of: list[tuple] = field(default_factory=list)  # of each part: (item, offset)
    seeds: dict[int, np.ndarray] = field(default_factory=dict)  # by run length: sorted hashes
    hits: dict[int, list] = field(default_factory=dict)  # of each: (size of part, offset), once
    masks: dict[int, np.ndarray] = field(default_factory=dict)
    walks: dict[int, Walks] = field(default_factory=dict)
    tables: dict[int, dict] = field(default_factory=dict)  # by size: key -> parts
    known: dict[int, np.ndarray] = field(default_factory=dict)  # by size: sorted keys

    @classmethod
    def of(cls, items: list[tuple], share: float, recall: float) -> Index:
        out = cls([i for i, _ in items])
        for w, (_, h) in enumerate(items):
            out.wholes.append((h, math.floor(share * len(h) + 1e-9)))
            n = math.ceil(len(h) / PART_WORDS)
            bounds = [len(h) * p // n for p in range(n + 1)]
            for a, z in zip(bounds, bounds[1:]):
                out.part_of.append((w, a))
                out.items.append(h[a:z])
                out.edits.append(math.floor(share * (z - a) + 1e-9))
        runs: dict[int, dict] = defaultdict(lambda: defaultdict(set))
        sizes: dict[int, list] = defaultdict(list)
        for j, (h, k) in enumerate(zip(out.items, out.edits)):
            q = max(1, math.ceil((len(h) - k) / (k + 1)))
            q = min(q, 8)  # a part of a shared run is shared as well
            for o, g in enumerate(_runs(h, q)):
                runs[q][int(g)].add((len(h), k, o))  # a run that many items share places its windows once
            sizes[len(h)].append(j)
        for q, of in runs.items():
            out.seeds[q] = np.array(sorted(of), _U)
            out.hits[q] = [sorted(of[g]) for g in sorted(of)]
            mask = np.zeros(1 << 22, bool)
            mask[out.seeds[q] >> _U(42)] = True
            out.masks[q] = mask
        for n, of in sizes.items():
            walks = out.walks[n] = Walks(n, repeats_for(n, max(out.edits[j] for j in of), recall))
            table = out.tables[n] = defaultdict(set)
            for j, row in zip(of, walks.keys(np.array([out.items[j] for j in of]))):
                for key in row:
                    table[int(key)].add(j)
            out.tables[n], out.known[n] = dict(table), np.array(sorted(table), _U)
        return out

    def windows(self, h: np.ndarray):
        """Starts of the windows to embed, by part size."""
        starts: dict[int, set] = defaultdict(set)
        for q, seeds in self.seeds.items():
            g = _runs(h, q)
            for p in np.flatnonzero(self.masks[q][g >> _U(42)]):
                at = int(np.searchsorted(seeds, g[p]))
                if at < len(seeds) and seeds[at] == g[p]:
                    for n, k, o in self.hits[q][at]:
                        starts[n].update(range(max(0, int(p) - o - k), max(1, min(int(p) - o + k, len(h) - 1) + 1)))
        return starts

    def find(self, many: list[np.ndarray]):
        """For each sequence of words: {item: (edits, first word, end word)}.

        The whole of an item is verified wherever a part of it is found.  A match
        of no words is none."""
        out: list[dict] = [{} for _ in many]
        rows: dict[int, list] = defaultdict(list)
        for d, h in enumerate(many):
            for n, starts in self.windows(h).items():
                rows[n] += [(d, s) for s in sorted(starts)]
        asked: dict[tuple, list] = defaultdict(list)
        for n, where in rows.items():
            table, known = self.tables[n], self.known[n]
            for at in range(0, len(where), 2048):
                group = where[at : at + 2048]
                block = np.zeros((len(group), n), _U)
                for r, (d, s) in enumerate(group):
                    part = many[d][s : s + n]
                    block[r, : len(part)] = part
                keys = self.walks[n].keys(block)
                place = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                for r, c in zip(*np.nonzero(known[place] == keys)):
                    for j in table[int(keys[r, c])]:
                        asked[group[r][0], j].append(group[r][1])
        spots: dict[tuple, list] = defaultdict(list)  # by text and item: (part, start of the item)
        for (d, j), starts in asked.items():
            (w, offset), h = self.part_of[j], many[d]
            if len(self.items[j]) == len(self.wholes[w][0]):
                spots[d, w] += [(j, s) for s in set(starts)]
                continue
            part, k = self.items[j], self.edits[j]
            starts = sorted(set(starts))
            for a, z in _joined(starts, len(part) + k, k, len(h)):
                if edit_distance(part, h[a:z])[0] <= k:
                    spots[d, w] += [(j, max(0, s - offset)) for s in starts if a <= s < z]
        for (d, w), where in spots.items():
            (item, k), h = self.wholes[w], many[d]
            alone = len(self.items[where[0][0]]) == len(item)
            slack = k if alone else k + max(self.edits[j] for j, _ in where)
            for a, z in _joined(sorted({s for _, s in where}), len(item) + slack, slack, len(h)):
                cost, first, end = edit_distance(item, h[a:z])
                if cost <= k and end > first and (w not in out[d] or cost < out[d][w][0]):
                    out[d][w] = (cost, a + first, a + end)
        return out


def _joined(starts: list[int], size: int, slack: int, most: int):
    """Stretches that cover the windows from ``starts``, joined where they overlap."""
    a = z = None
    for s in starts:
        lo, hi = max(0, s - slack), min(most, s + size)
        if z is None or lo > z:
            if z is not None:
                yield a, z
            a, z = lo, hi
        else:
            z = max(z, hi)
    if z is not None:
        yield a, z


def _blocks(items: DataFrame, id_col: str, text_col: str):
    """The items' words in blocks of at most about ``BLOCK_WORDS`` words."""
    rows = items.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    block, size = [], 0
    for r in rows.orderBy("id", "text").toLocalIterator():
        h = words(bytes(r.text))[0]
        if len(h):
            block.append((r.id, h))
            size += len(h)
        if size >= BLOCK_WORDS:
            yield block
            block, size = [], 0
    if block:
        yield block


def _sought(batches, index: Index, text_at: int):
    """(batch, matches of each row, word bounds of each row), in small groups."""
    for b in batches:
        texts = b.column(text_at).cast(pa.binary())
        for at in range(0, b.num_rows, 256):
            group = b.slice(at, 256)
            read = [words(t.as_py() or b"") for t in texts.slice(at, 256)]
            yield group, index.find([r[0] for r in read]), read


def contaminated(
    docs: DataFrame, items: DataFrame, share: float = 0.2, recall: float = 0.99, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """One row for each document and item whose words occur in it within
    ``share`` of the item's words in edits.

    Returns ``id, item_id, edits, start, end``: the best stretch, in code points
    of the text, ties to the stretch that is found first.  Null and empty texts or
    items match nothing, rows that repeat an id are searched apart, and whole texts
    are searched.  The items are taken in blocks of bounded size, each a pass over
    ``docs``.  Other columns are left out; without documents or items there are no
    rows.
    """
    spark = docs.sparkSession
    modest_batches(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    id_type, item_type = rows.schema["id"].dataType.simpleString(), items.schema[item_id_col].dataType.simpleString()
    schema = f"id {id_type}, item_id {item_type}, edits int, start bigint, end bigint"
    item_kind = to_arrow_type(items.schema[item_id_col].dataType)
    found = None
    for block in _blocks(items, item_id_col, item_text_col):
        shared = spark.sparkContext.broadcast(Index.of(block, share, recall))

        def run(batches, shared=shared):
            index = shared.value
            for b, matches, read in _sought(batches, index, 1):
                out = []
                for i, (m, (_, a, z)) in enumerate(zip(matches, read)):
                    best: dict = {}
                    for w, (cost, first, end) in m.items():
                        name = index.ids[w]
                        if name not in best or cost < best[name][0]:
                            best[name] = (cost, int(a[first]), int(z[end - 1]))
                    if best:
                        text = np.frombuffer(b.column(1)[i].as_py(), np.uint8)
                        for name, (cost, lo, hi) in best.items():
                            before = int(((text[:lo] & 0xC0) != 0x80).sum())
                            out.append((b.column(0)[i].as_py(), name, cost, before, before + int(((text[lo:hi] & 0xC0) != 0x80).sum())))
                if out:
                    columns = list(zip(*out))
                    kinds = [b.schema.field(0).type, item_kind, pa.int32(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["id", "item_id", "edits", "start", "end"])

        part = rows.mapInArrow(run, schema)
        found = part if found is None else found.union(part)
    return spark.createDataFrame([], schema) if found is None else found


def without_contaminated(docs: DataFrame, items: DataFrame, share: float = 0.2, recall: float = 0.99, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that hold an item, as :func:`contaminated` finds
    it.  Columns may have any names; null and empty texts stay."""
    modest_batches(docs.sparkSession)
    at = docs.columns.index(text_col)
    for block in _blocks(items, item_id_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast(Index.of(block, share, recall))

        def run(batches, shared=shared):
            for b, matches, _ in _sought(batches, shared.value, at):
                yield b.filter(pa.array([not m for m in matches], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
