"""Removal of repeated byte strings by a sparse suffix array.

A byte goes if a string of ``length`` bytes that covers it starts anywhere else.
Every such string is told by its anchor, the leftmost of its ``GRAM``-byte grams
with the least hash: equal strings have equal anchors at equal offsets.  So only
anchors need sorting.  An anchor's record holds the text around it from the first
to the last string it stands for.  Records with a repeated anchor are put in one
order by what follows the anchor and in another by what precedes it, and two
strings at an offset are equal exactly if no neighbours between their records
differ within that offset on either side.

Orders come from deep-shallow sorting: a multikey quicksort, in steps of eight
bytes, to a shallow depth, and then a blind trie for each group that is still
together, which branches on the first differing byte alone.

Equal records are merged before they are sorted, in map-side combined
aggregates; equal texts are merged before anything else.  A group of more than
``GROUP`` different records of one anchor isn't sorted in one task: its strings
are counted one by one, by hash.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.llm.chunks import _INVERSE, _P, mixed, powers
from quarryline.llm.marks import Marks, bitmap
from quarryline.workspace import Workspace, modest_batches

GRAM, SHALLOW, GROUP = 32, 32, 20_000
#: Bytes of a text that are hashed at a time, and of records sorted at a time.
SLICE, SORTED = 1 << 20, 8 << 20
#: Records of which a task remembers that it has given their bytes.
REMEMBERED = 500_000

_U = np.uint64


def window_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of the ``size`` bytes from each position on."""
    n = len(data)
    if n < size:
        return np.zeros(0, _U)
    total = np.zeros(n + 1, _U)
    np.cumsum(powers(_P, n) * (data.astype(_U) + _U(1)), dtype=_U, out=total[1:])
    return mixed((total[size:] - total[: n - size + 1]) * powers(_INVERSE, n)[: n - size + 1])


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost least hash in each window of ``width``."""
    n = len(h)
    m = n - width + 1
    full = -(-n // width) * width
    big = np.concatenate([h, np.full(full - n, np.iinfo(np.uint64).max, _U)]).reshape(-1, width)
    at = np.arange(full).reshape(-1, width)
    ahead = np.minimum.accumulate(big, axis=1)
    first = np.where(big < np.concatenate([np.full((len(big), 1), np.iinfo(np.uint64).max, _U), ahead[:, :-1]], axis=1), at, -1)
    first = np.maximum.accumulate(np.where(np.arange(width) == 0, at, first), axis=1).ravel()
    back = np.minimum.accumulate(big[:, ::-1], axis=1)[:, ::-1]
    last = np.where(big <= np.concatenate([back[:, 1:], np.full((len(big), 1), np.iinfo(np.uint64).max, _U)], axis=1), at, full)
    last = np.minimum.accumulate(np.where(np.arange(width) == width - 1, at, last)[:, ::-1], axis=1)[:, ::-1].ravel()
    left, right = last[:m], first[width - 1 : width - 1 + m]
    return np.where(back.ravel()[:m] <= ahead.ravel()[width - 1 : width - 1 + m], left, right)


def anchors(data: np.ndarray, length: int):
    """Anchors of a text's strings: (anchor, first start, last start, anchor's
    hash, sum of the hashes of all grams of the record), every start belonging to one."""
    out = []
    at = 0
    while at + length <= len(data):
        part = data[at : at + SLICE + length - 1]
        h = window_hashes(part, GRAM)
        place = _least(h, length - GRAM + 1)
        cut = np.flatnonzero(np.diff(place)) + 1
        first = np.concatenate([[0], cut])
        last = np.concatenate([cut, [len(place)]]) - 1
        total = np.zeros(len(h) + 1, _U)
        np.cumsum(h, out=total[1:])
        out.append((place[first] + at, first + at, last + at, h[place[first]], total[last + length - GRAM + 1] - total[first]))
        at += len(place)
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(3)) + (np.zeros(0, _U), np.zeros(0, _U))
    return tuple(np.concatenate(x) for x in zip(*out))


def _blind(keys: list[bytes]) -> tuple[list[int], list[int]]:
    """Order of byte strings and the common prefix of each with the one before.

    A blind trie: inner nodes know the depth at which their branches differ and
    the branch bytes.  A string is led down by its own bytes at these depths; its
    first difference from the leaf found there is where it is hung in.
    """
    root: list | int = 0
    for new in range(1, len(keys)):
        s = keys[new]
        node = root
        while not isinstance(node, int):
            depth, branch = node
            b = s[depth] if depth < len(s) else -1
            node = branch.get(b)
            if node is None:
                node = next(iter(branch.values()))
        t = keys[node]
        n = min(len(s), len(t))
        if s[:n] == t[:n]:
            d = n
        else:
            lo, hi = 0, n  # the first difference, by halving
            while lo + 1 < hi:
                mid = (lo + hi) // 2
                if s[lo:mid] == t[lo:mid]:
                    lo = mid
                else:
                    hi = mid
            d = lo
        a, b = (t[d] if d < len(t) else -1), (s[d] if d < len(s) else -1)
        above, node = None, root
        while not isinstance(node, int) and node[0] < d:
            above, step = node, (s[node[0]] if node[0] < len(s) else -1)
            node = node[1][step]
        if not isinstance(node, int) and node[0] == d:
            if b in node[1]:  # equal strings: a list of them is a branch too
                b = (b, new)
            node[1][b] = new
            continue
        made = [d, {a: node, (b if a != b else (b, new)): new}]
        if above is None:
            root = made
        else:
            above[1][step] = made
    order, common, todo = [], [], [(root, 0)]
    while todo:
        node, shared = todo.pop()
        if isinstance(node, int):
            order.append(node)
            common.append(shared)
            continue
        depth, branch = node
        rank = sorted(branch, key=lambda k: k if isinstance(k, tuple) else (k, -1))
        todo += [(branch[k], shared if i == 0 else depth) for i, k in reversed(list(enumerate(rank)))]
    return order, common


def deep_shallow(rows: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of byte rows within their groups, groups in order, and the common
    prefix of each row with the one before (-1 at the start of a group)."""
    n, width = rows.shape
    wide = -(-width // 8) * 8
    padded = np.zeros((n, wide), np.uint8)
    padded[:, :width] = rows
    words = padded.view(">u8").astype(np.uint64)
    order = np.argsort(group, kind="stable")
    start = np.concatenate([[True], group[order][1:] != group[order][:-1]]) if n else np.zeros(0, bool)
    head = start.copy()  # where a group that is still together starts
    for k in range(min(SHALLOW, wide) // 8):
        run = np.cumsum(head)
        size = np.bincount(run)[run]
        if not (size > 1).any():
            break
        order = order[np.lexsort((words[order, k], run))]
        head[1:] |= words[order[1:], k] != words[order[:-1], k]
    common = np.zeros(n, np.int64)
    bounds = np.append(np.flatnonzero(head), n)
    for a, z in zip(bounds, bounds[1:]):
        if z - a > 1:
            deep, shared = _blind([rows[i].tobytes() for i in order[a:z]])
            order[a:z] = order[a:z][deep]
            common[a + 1 : z] = shared[1:]
    split = np.flatnonzero(head & ~start)
    if len(split):
        differ = rows[order[split]] != rows[order[split - 1]]
        common[split] = np.argmax(differ, axis=1)
    common[start] = -1
    return order, common


def repeated_offsets(parts: list[bytes], before: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """For records of bytes with ``before`` bytes ahead of their anchor, whether
    the string that starts ``o`` bytes ahead of it occurs in another record of
    its group: a row a record, a column an offset ``o``."""
    n, reach = len(parts), length - GRAM
    after, ahead = np.zeros((n, length), np.uint8), np.zeros((n, max(1, reach)), np.uint8)
    have = np.zeros(n, np.int64)
    for i, (p, k) in enumerate(zip(parts, before)):
        x = np.frombuffer(p, np.uint8)
        right, left = x[k : k + length], x[max(0, k - reach) : k][::-1]
        after[i, : len(right)], ahead[i, : len(left)] = right, left
        have[i] = len(right)
    out = np.zeros((n, reach + 1), bool)
    by_right, right_common = deep_shallow(after, group)
    by_left, left_common = deep_shallow(ahead, group)
    right_class, left_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(reach + 1):
        fits = np.flatnonzero((before >= o) & (have >= length - o))
        if len(fits) < 2:
            continue
        right_class[by_right] = np.cumsum(right_common < length - o)
        left_class[by_left] = np.cumsum(left_common < o)
        key = right_class[fits] * (n + 1) + left_class[fits]
        _, which, times = np.unique(key, return_inverse=True, return_counts=True)
        out[fits, o] = times[which] > 1
    return out


def _key(text: bytes) -> bytes:
    return hashlib.blake2b(text, digest_size=16).digest()


def _record_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of stretches of a text, lengths included."""
    out = np.empty(len(start), _U)
    at = 0
    while at < len(start):
        to = at + int(np.searchsorted(start[at:], start[at] + SLICE, "right"))
        lo, hi = int(start[at]), int(end[at:to].max())
        part = data[lo:hi].astype(_U) + _U(1)
        total = np.concatenate([[_U(0)], np.cumsum(powers(_P, len(part)) * part, dtype=_U)])
        a, z = start[at:to] - lo, end[at:to] - lo
        down = powers(_INVERSE, len(part) + 1)
        out[at:to] = mixed((total[z] - total[a]) * down[a] + (z - a).astype(_U) * _U(0x94D049BB133111EB))
        at = to
    return out.view(np.int64)


def _row_facts(batches):
    for b in batches:
        texts = [t.as_py() or b"" for t in b.column(1)]
        yield pa.RecordBatch.from_arrays(
            [
                b.column(0),
                pa.array([_key(t) for t in texts], pa.binary()),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
            ],
            ["id", "key", "n_bytes", "sha"],
        )


def _grams(batches, length: int):
    for b in batches:
        for at in range(0, b.num_rows, 1024):
            found = [anchors(np.frombuffer(t.as_py() or b"", np.uint8), length)[3] for t in b.column(0).slice(at, 1024)]
            gram, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(n)], ["gram", "n"])


def _anchored(text: bytes, length: int, marks: Marks):
    """Anchors of interest of a text: hash, record's hash, first and last start,
    bytes ahead of the anchor in its record.  Records are compared within an
    anchor, so two of 64 bits each tell them apart, the second from two sums."""
    data = np.frombuffer(text, np.uint8)
    place, first, last, gram, total = anchors(data, length)
    if len(place):
        some = marks.has(gram)
        place, first, last, gram, total = (x[some] for x in (place, first, last, gram, total))
    sig = (_record_hashes(data, first, last + length).view(_U) + mixed(total)).view(np.int64) if len(place) else np.zeros(0, np.int64)
    return gram.view(np.int64), sig, first, last, place - first


def _records(batches, length: int, marks: Marks):
    """A row for each anchor of interest."""
    for b in batches:
        for at in range(0, b.num_rows, 512):
            texts = [t.as_py() or b"" for t in b.column(0).slice(at, 512)]
            found = [_anchored(t, length, marks) for t in texts]
            size = [len(f[0]) for f in found]
            if sum(size):
                keys = pa.array([_key(t) for t in texts], pa.binary()).take(pa.array(np.repeat(np.arange(len(texts)), size)))
                gram, sig, first, last, _ = (np.concatenate(x) for x in zip(*found))
                yield pa.RecordBatch.from_arrays([keys, *map(pa.array, (gram, sig, first, last))], ["key", "gram", "sig", "first", "last"])


def _bytes_of(batches, length: int, marks: Marks):
    """The bytes of each anchor's record.  Of equal ones a task gives the first, as
    far as it remembers, so a record that recurs is no hot group."""
    seen: set[int] = set()
    for b in batches:
        for at in range(0, b.num_rows, 512):
            out = []
            for t in b.column(0).slice(at, 512):
                text = t.as_py() or b""
                key = None
                for g, s, first, last, before in zip(*(x.tolist() for x in _anchored(text, length, marks))):
                    if (mark := g * 0x9E3779B1 ^ s) not in seen:
                        seen.add(mark)
                        key = key or _key(text)
                        out.append((g, s, None, before, key, first, text[first : last + length]))
            if len(seen) > REMEMBERED:
                seen.clear()
            if out:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["gram", "sig", "n", "before", "key", "first", "bytes"])


def _runs_of(flags: np.ndarray):
    """First and last positions of the runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edge[::2], edge[1::2] - 1


def _sorted_groups(batches, length: int):
    """Rows come sorted by anchor and record, its count before its bytes; yields
    the repeated starts of the records that occur once."""
    held: list[list[tuple]] = []  # of each anchor: (n, before, key, first, bytes)
    group: list[tuple] = []
    here, size = (None, None), 0
    count = None

    def resolve():
        many = [r for g in held for r in g]
        ids = np.repeat(np.arange(len(held)), [len(g) for g in held])
        offsets = repeated_offsets([r[4] for r in many], np.array([r[1] for r in many], np.int64), ids, length)
        out = []
        for (n, before, key, first, data), flags in zip(many, offsets):
            if n == 1 and flags.any():
                line = np.zeros(len(data) - length + 1, bool)
                line[before - np.flatnonzero(flags)] = True
                out += [(key, first + int(x), first + int(y)) for x, y in zip(*_runs_of(line))]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.binary(), pa.int64(), pa.int64()))], ["key", "a", "z"])

    for b in batches:
        for gram, sig, n, *rest in zip(*(b.column(i).to_pylist() for i in range(7))):
            if gram != here[0] and group:
                if len(group) > 1:
                    held.append(group)
                    size += sum(len(r[4]) for r in group)
                group = []
                if size >= SORTED:
                    yield from resolve()
                    held, size = [], 0
            if n is not None:
                here, count = (gram, sig), n
            elif here == (gram, sig) and count is not None:  # the first bytes of a counted record
                group.append((count, *rest))
                count = None
    if len(group) > 1:
        held.append(group)
    if held:
        yield from resolve()


def _strings(batches, length: int):
    """The hash of every string of each record, with its place."""
    for b in batches:
        for at in range(0, b.num_rows, 512):
            gram, _, n, _, key, first, data = (b.column(i).slice(at, 512).to_pylist() for i in range(7))
            hashes = [window_hashes(np.frombuffer(x, np.uint8), length).view(np.int64) for x in data]
            row = np.repeat(np.arange(len(data)), [len(h) for h in hashes])
            if len(row):
                start = np.concatenate([np.arange(len(h)) + f for h, f in zip(hashes, first)])
                spread = [pa.array(c, k).take(pa.array(row)) for c, k in ((gram, pa.int64()), (n, pa.int64()), (key, pa.binary()))]
                yield pa.RecordBatch.from_arrays([*spread, pa.array(start), pa.array(np.concatenate(hashes))], ["gram", "n", "key", "start", "h"])


def _removed(batches, length: int):
    for b in batches:
        out = []
        for key, text, starts in zip(*(b.column(i).to_pylist() for i in range(3))):
            text = text or b""
            cover = np.zeros(len(text) + 1, np.int64)
            for s in starts:
                cover[s["a"]] += 1
                cover[s["z"] + length] -= 1
            gone = np.cumsum(cover[:-1]) > 0
            a, _ = _runs_of(gone)
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
            out.append((key, int(gone.sum()), len(a), hashlib.sha256(kept).hexdigest()))
        columns = list(zip(*out)) or [[], [], [], []]
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["key", "n_removed", "n_spans", "kept_sha256"])


def _of_interest(batches, marks: Marks):
    for b in batches:
        seen, keep = set(), []
        for t in b.column(0):
            key = _key(t.as_py() or b"")
            new = key not in seen
            seen.add(key)
            keep.append(key if new else None)
        slot = np.array([int.from_bytes(k[:8], "big", signed=True) if k else 0 for k in keep], np.int64)
        some = np.array([k is not None for k in keep], bool) & marks.has(slot)
        at = np.flatnonzero(some)
        yield pa.RecordBatch.from_arrays([pa.array([keep[i] for i in at], pa.binary()), b.column(0).take(pa.array(at))], ["key", "text"])


def remove_repeats(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What stays of each text without the strings of ``length`` bytes that occur
    more than once in the UTF-8 bytes of all texts.

    Returns ``id, n_bytes, n_removed, n_spans, kept_sha256`` for every row.  Null
    texts are empty; a text shorter than ``length`` loses nothing; equal rows
    lose everything (from ``length`` bytes on), whatever their ids.  Strings
    don't cross texts, may overlap and are judged on the input alone.  Ids may be
    null or repeat, columns of any other name are left out, and an empty table has
    no rows.
    """
    if length <= GRAM:
        raise ValueError(f"length must be over {GRAM}")
    modest_batches(docs.sparkSession)
    work = Workspace(docs.sparkSession, "repeats")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    texts = rows.select("text")
    kind = rows.schema["id"].dataType.simpleString()
    facts = work.keep(rows.mapInArrow(_row_facts, f"id {kind}, key binary, n_bytes bigint, sha string"), "facts")

    counted = texts.mapInArrow(lambda it: _grams(it, length), "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    repeated = bitmap(work.keep(counted.where("n > 1").select("gram"), "grams"), "gram")
    found = work.keep(texts.mapInArrow(lambda it: _records(it, length, repeated.value), "key binary, gram bigint, sig bigint, first bigint, last bigint"), "found")
    records = work.keep(found.groupBy("gram", "sig").agg(F.count("*").alias("n")), "records")
    # a record that occurs twice is repeated as a whole; the others need a look
    # at their bytes where their anchor has other records
    groups = records.groupBy("gram").agg(F.count("*").alias("records"), F.min("n").alias("least"))
    contested = groups.where("records > 1 and least = 1").select("gram", "records")
    small = work.keep(contested.where(F.col("records") <= GROUP).select("gram"), "small")
    large = work.keep(contested.where(F.col("records") > GROUP).select("gram"), "large")
    schema = "gram bigint, sig bigint, n bigint, before int, key binary, first bigint, bytes binary"

    def shipped(marks):
        return texts.mapInArrow(lambda it: _bytes_of(it, length, marks.value), schema)

    counts = records.join(small, "gram", "left_semi")
    counts = counts.select("gram", "sig", "n", *[F.lit(None).cast(t).alias(c) for c, t in (("before", "int"), ("key", "binary"), ("first", "bigint"), ("bytes", "binary"))])
    together = shipped(bitmap(small, "gram")).unionByName(counts).repartition("gram").sortWithinPartitions("gram", "sig", F.col("n").asc_nulls_last())
    starts = "key binary, a bigint, z bigint"
    spans = [work.keep(together.mapInArrow(lambda it: _sorted_groups(it, length), starts), "once")]
    if not large.isEmpty():  # these bytes go by record, never by anchor
        known = records.join(large, "gram", "left_semi").select("gram", "sig", F.col("n").alias("times"))
        each = shipped(bitmap(large, "gram")).drop("n").join(known, ["gram", "sig"]).withColumnRenamed("times", "n")
        each = each.dropDuplicates(["gram", "sig"]).select("gram", "sig", "n", "before", "key", "first", "bytes")
        strings = each.mapInArrow(lambda it: _strings(it, length), "gram bigint, n bigint, key binary, start bigint, h bigint")
        twice = strings.groupBy("gram", "h").agg(F.sum("n").alias("times")).where("times > 1").select("gram", "h")
        spans.append(strings.where("n = 1").join(twice, ["gram", "h"]).select("key", F.col("start").alias("a"), F.col("start").alias("z")))
    whole = found.join(records.where("n > 1").select("gram", "sig"), ["gram", "sig"], "left_semi").select("key", F.col("first").alias("a"), F.col("last").alias("z"))
    spans = reduce(DataFrame.unionByName, [whole.distinct(), *spans])
    by_text = work.keep(spans.groupBy("key").agg(F.collect_list(F.struct("a", "z")).alias("starts")), "starts")
    slot = F.conv(F.hex(F.substring("key", 1, 8)), 16, -10).cast("long")
    wanted = bitmap(by_text.select(slot.alias("slot")), "slot")
    held = texts.mapInArrow(lambda it: _of_interest(it, wanted.value), "key binary, text binary")
    left = held.join(by_text, "key").mapInArrow(lambda it: _removed(it, length), "key binary, n_removed bigint, n_spans bigint, kept_sha256 string")
    left = left.groupBy("key").agg(*[F.max(c).alias(c) for c in ("n_removed", "n_spans", "kept_sha256")])
    left = work.keep(left, "left")
    return facts.join(left, "key", "left").select(
        "id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
    )
