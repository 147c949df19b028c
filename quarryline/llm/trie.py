"""Prefix tries of conversations, with totals of every subtree.

Turns become 128-bit prints, and a prefix of a conversation the running sum of
its turns' prints, each times a power that its place gives.  Places and sums
run over range-sorted parts, so no task holds a whole conversation.  Totals of
subtrees come from parallel tree contraction: rounds of joins rake leaves into
their parents and compress chains of only children, and contracted nodes are
expanded again from the last round to the first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.workspace import Workspace, modest_batches

# Ids that one row of a list of members holds.
_LISTED = 4096
_U = np.uint64
# Odd, so that no power is zero modulo 2^64.  Fixed values.
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


class _Running:
    """Sums of terms within a key, modulo 2^64, over the batches of a sorted part."""

    def __init__(self, n: int):
        self.key, self.sums = None, [_U(0)] * n

    def add(self, keys: np.ndarray, terms: list[np.ndarray]) -> list[np.ndarray]:
        start = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        size = np.diff(np.append(start, len(keys)))
        out = []
        for i, x in enumerate(terms):
            total = np.cumsum(x, dtype=_U)
            before = total[start] - x[start]
            if self.key is not None and keys[0] == self.key:
                before[:1] -= self.sums[i]
            out.append(total - np.repeat(before, size))
            self.sums[i] = out[i][-1]
        self.key = keys[-1]
        return out


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view("<i8"))


def _powers(base: int, exponents: np.ndarray) -> np.ndarray:
    """``base`` to each positive exponent, modulo 2^64, by squaring."""
    out, square, left = np.ones(len(exponents), _U), _U(base), exponents.astype(_U)
    while left.any():
        odd = (left & _U(1)).astype(bool)
        out[odd] *= square
        square = square * square
        left = left >> _U(1)
    return out


def _places(batches):
    run, part, seq = _Running(1), TaskContext.get().partitionId(), 0
    for b in batches:
        n = b.num_rows
        if n:
            (place,) = run.add(b.column(0).to_numpy(), [np.ones(n, _U)])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, part, np.int32)), pa.array(np.arange(seq, seq + n)), _signed(place), *b.columns], ["part", "seq", "place", *b.schema.names])
            seq += n


def _prefixes(batches):
    """Columns conv_id, depth, print, bytes: the sums of a prefix, with its last
    turn (k1, k2), and that turn's terms (t1, t2)."""
    run, part, seq = _Running(2), TaskContext.get().partitionId(), 0
    for b in batches:
        n = b.num_rows
        if n:
            prints = np.frombuffer(b"".join(b.column(2).to_pylist()), "<u8").reshape(n, 2)
            with np.errstate(over="ignore"):
                terms = [prints[:, i] * _powers(base, b.column(1).to_numpy()) for i, base in enumerate(_BASES)]
                sums = run.add(b.column(0).to_numpy(), terms)
            names = ["part", "seq", "k1", "k2", "t1", "t2", "conv_id", "depth", "bytes"]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, part, np.int32)), pa.array(np.arange(seq, seq + n)), *map(_signed, [*sums, *terms]), b.column(0), b.column(1), b.column(3)], names)
            seq += n


def _carried(batches, offsets: dict, sums: list[str]):
    """Adds what a part's first key has summed up in the parts before."""
    for b in batches:
        if not b.num_rows:
            continue
        parts, keys = b.column("part").to_numpy(), b.column("conv_id").to_numpy()
        extra = np.zeros((len(sums), b.num_rows), _U)
        for part in np.unique(parts).tolist():
            if part in offsets:
                key, values = offsets[part]
                extra[:, (parts == part) & (keys == key)] = np.array(values, _U)[:, None]
        columns = dict(zip(b.schema.names, b.columns))
        for name, x in zip(sums, extra):
            columns[name] = _signed(columns[name].to_numpy().view(_U) + x)
        yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _running(rows: DataFrame, order: list, step: Callable, schema: str, sums: list[str], work: Workspace, name: str) -> DataFrame:
    """Running sums over ``conv_id`` in the given order, whatever the length of a
    conversation: each part of a range sort sums up its own rows, and what a
    conversation has in earlier parts is added afterwards.  The driver sees one
    row a part."""
    by = ["conv_id", *order]
    kept = work.keep(rows.repartitionByRange(*by).sortWithinPartitions(*by).drop("tie").mapInArrow(step, schema), name)
    ends = kept.groupBy("part").agg(F.min("conv_id").alias("first"), F.max_by(F.struct("conv_id", *sums), "seq").alias("end")).orderBy("part").collect()
    offsets, key, total = {}, None, [0] * len(sums)
    for r in ends:
        if key is not None and r["first"] == key:
            offsets[r.part] = (key, list(total))
        if key is None or r.end.conv_id != key:
            key, total = r.end.conv_id, [0] * len(sums)
        total = [(a + r.end[s]) % (1 << 64) for a, s in zip(total, sums)]
    return kept.mapInArrow(lambda it: _carried(it, offsets, sums), kept.schema).drop("part", "seq")


def placed_turns(turns: DataFrame, work: Workspace) -> DataFrame:
    """Each turn's place in its conversation, from 1: ``conv_id``, ``place``,
    ``print`` (16 bytes of role and text), ``bytes`` of text.  Turns are in the
    order of ``turn``, null first, then of role and text; repeated rows stay.  A
    null role or text is empty.  Rows of no conversation (null) are left out."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        role.alias("role"),
        text.alias("text"),
        F.monotonically_increasing_id().alias("tie"),  # so that equal rows may stand in several parts
    )
    told = F.unhex(F.md5(F.concat(F.octet_length("role"), F.lit(":"), "role", "text")))
    rows = rows.select("conv_id", "turn", "role", "text", "tie", told.alias("print"), F.octet_length("text").cast("long").alias("bytes"))

    def step(batches):
        return _places(b.select(["conv_id", "print", "bytes"]) for b in batches)

    return _running(rows, ["turn", "role", "text", "tie"], step, "part int, seq bigint, place bigint, conv_id bigint, print binary, bytes bigint", ["place"], work, "placed")


def rebuilt_turns(placed: DataFrame, head: Column, base: Column) -> DataFrame:
    """Conversations whose first turns come from another one.

    ``head`` and ``base`` are functions of ``conv_id``: a conversation gets the
    first ``head`` turns of conversation ``base`` (all if it has fewer, none if
    there is none), then its own after its first ``head``.  Returns ``conv_id,
    depth, print, bytes``.
    """
    convs = placed.groupBy("conv_id").agg(F.max("place").alias("turns")).select("conv_id", "turns", head.cast("long").alias("head"), base.cast("long").alias("base"))
    sizes = convs.select(F.col("conv_id").alias("base"), F.col("turns").alias("there"))
    convs = convs.join(sizes, "base", "left").select("conv_id", "head", "base", F.least("head", F.coalesce("there", F.lit(0))).alias("front"))
    own = placed.join(convs, "conv_id").where("place > head").select("conv_id", (F.col("place") - F.col("head") + F.col("front")).alias("depth"), "print", "bytes")
    given = placed.withColumnRenamed("conv_id", "base").join(convs.where("front > 0"), "base").where("place <= front").select("conv_id", F.col("place").alias("depth"), "print", "bytes")
    return own.union(given)


def _listed(batches):
    """Rows (k1, k2, conv_id) of a sorted part, as lists of at most ``_LISTED`` ids of a node."""
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        k1, k2, ids = (b.column(i).to_numpy() for i in range(3))
        edge = np.append(True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]))
        start = np.flatnonzero(edge)
        at = np.arange(n) - np.repeat(start, np.diff(np.append(start, n)))
        cut = np.flatnonzero(at % _LISTED == 0)
        texts = [",".join(map(str, ids[a:z].tolist())) for a, z in zip(cut, np.append(cut[1:], n))]
        yield pa.RecordBatch.from_arrays([pa.array(k1[cut]), pa.array(k2[cut]), pa.array(ids[cut]), pa.array(texts, pa.string())], ["k1", "k2", "first", "ids"])


def _hashed(batches):
    """SHA-256 of each node's lists, which come in order; one list is held at a time."""
    node, digest, out = None, None, []

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[0][i] for r in rows], pa.int64()) for i in (0, 1)] + [pa.array([r[1] for r in rows], pa.string())], ["k1", "k2", "ends_sha256"])

    for b in batches:
        for k1, k2, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            if (k1, k2) != node:
                if node is not None:
                    out.append((node, digest.hexdigest()))
                node, digest = (k1, k2), hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if len(out) >= 4096:
            yield batch(out)
            out = []
    if node is not None:
        yield batch([*out, (node, digest.hexdigest())])


def _ends(ends: DataFrame, work: Workspace) -> DataFrame:
    """``k1, k2, ends_sha256`` of rows ``k1, k2, conv_id``.  A hot node's ids are
    sorted and joined in many parts; only the hash itself, which goes from the
    first byte to the last, is one task's, with a row for 4096 ids."""
    order = ["k1", "k2", "conv_id"]
    lists = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_listed, "k1 bigint, k2 bigint, first bigint, ids string")
    lists = work.keep(lists, "members")
    return lists.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first").select("k1", "k2", "ids").mapInArrow(_hashed, "k1 bigint, k2 bigint, ends_sha256 string")


def _with_children(active: DataFrame) -> DataFrame:
    """Adds the number of children (0 for leaves) and the only child of a node that has one."""
    kids = active.groupBy(F.col("q1").alias("k1"), F.col("q2").alias("k2")).agg(F.count("*").alias("kids"), F.min(F.struct("k1", "k2")).alias("only"))
    return active.drop("kids", "only").join(kids, ["k1", "k2"], "left").withColumn("kids", F.coalesce("kids", F.lit(0)))


def subtree_sums(nodes: DataFrame, values: list[str], work: Workspace) -> DataFrame:
    """Sums of ``values`` (longs) over each node's subtree, the node included.

    ``nodes``: ``k1, k2`` (key), ``q1, q2`` (the parent's key; the one root has
    nulls), ``depth``, ``kids`` and ``only`` as ``_with_children`` adds them, and
    the values.  Returns the key and the sums.

    A round rakes all leaves and splices out only children's parents.  An edge
    carries what was spliced out of it: a leaf gives its parent its own sum and
    what its edge carries.  A node is spliced out if its coin says so, it has one
    child, and that is no leaf and isn't spliced out itself.  Coins are the bits
    of the depth, so that a chain halves in every round, and then hashes.  Rounds
    grow with the logarithm of the number of nodes, and every join is on a key
    that is unique on both sides: a parent of any number of children is a
    combined aggregate.
    """
    key, n = ["k1", "k2"], len(values)
    own, edge, gain = ([f"{p}{i}" for i in range(n)] for p in ("own", "edge", "gain"))
    seen = nodes.select("k1", "k2", "q1", "q2", "depth", "kids", "only", *[F.col(v).cast("long").alias(o) for v, o in zip(values, own)], *[F.lit(0).cast("long").alias(e) for e in edge])
    seen = work.keep(seen, "tree")
    deepest = seen.agg(F.max("depth")).first()[0] or 0
    raked: list[DataFrame] = []
    spliced: list[DataFrame] = []
    while True:
        r = len(raked)
        raked.append(seen.where("kids = 0").select(*key, *own))
        if seen.where("kids > 0").isEmpty():
            break
        coin = F.shiftright("depth", r) if deepest >> r else F.xxhash64("k1", "k2", F.lit(r))
        marked = seen.withColumn("out", (F.col("kids") == 1) & F.col("q1").isNotNull() & (coin.cast("long").bitwiseAND(F.lit(1)) == 1))
        stays = marked.where("kids > 0 and not out").select(F.col("k1").alias("u1"), F.col("k2").alias("u2"), *[F.col(e).alias(f"child_{e}") for e in edge])
        goes = marked.where("out").withColumns({"u1": F.col("only.k1"), "u2": F.col("only.k2")})
        splice = goes.join(stays, ["u1", "u2"]).select(*key, "q1", "q2", "u1", "u2", *[(F.col(o) + F.col(f"child_{e}")).alias(g) for o, e, g in zip(own, edge, gain)], *[(F.col(o) + F.col(e)).alias(e) for o, e in zip(own, edge)])
        splice = work.keep(splice, "spliced")
        spliced.append(splice)
        none = F.lit(None).cast("long")
        zero = [F.lit(0).cast("long")] * n
        leaves = seen.where("kids = 0 and q1 is not null").groupBy("q1", "q2").agg(*[F.sum(F.col(o) + F.col(e)).alias(o) for o, e in zip(own, edge)])
        gone = splice.select(*key, F.lit(True).alias("gone"), none.alias("p1"), none.alias("p2"), *zero, *zero)
        hung = splice.select("u1", "u2", F.lit(False), "q1", "q2", *zero, *edge)
        given = leaves.select("q1", "q2", F.lit(False), none, none, *own, *zero)
        names = [*key, "gone", "p1", "p2", *[f"more_{c}" for c in (*own, *edge)]]
        changes = gone.union(hung).union(given).toDF(*names).groupBy(*key).agg(F.max("gone").alias("gone"), F.max("p1").alias("p1"), F.max("p2").alias("p2"), *[F.sum(c).alias(c) for c in names[5:]])
        active = seen.where("kids > 0").join(changes, key, "left").where("not coalesce(gone, false)")
        active = active.select(*key, F.coalesce("p1", "q1").alias("q1"), F.coalesce("p2", "q2").alias("q2"), "depth", *[(F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in (*own, *edge)])
        active = work.keep(active, "active")
        seen = work.keep(_with_children(active), "tree")
    known: DataFrame = raked[-1]
    for r in range(len(spliced) - 1, -1, -1):
        there = known.select(F.col("k1").alias("u1"), F.col("k2").alias("u2"), *own)
        expanded = spliced[r].join(there, ["u1", "u2"]).select(*key, *[(F.col(o) + F.col(g)).alias(o) for o, g in zip(own, gain)])
        known = known.union(work.keep(expanded, "expanded")).union(raked[r])
    return known.toDF(*key, *values)


def prefix_trie(conversations: DataFrame, head: Column | None = None, base: Column | None = None) -> DataFrame:
    """The trie of whole conversations, one row a node, from the textless root.

    ``conversations`` has ``conv_id`` (integer), ``turn``, ``role`` and ``text``;
    ``head`` and ``base`` as in ``rebuilt_turns`` (left out: conversations stay
    as they are).  Columns, all long but for the last: ``conv_id`` (the smallest
    member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs``
    (members), ``n_children``, ``n_leaves``, ``saved_tokens`` (over the subtree,
    members but one times the bytes of a node's last text), ``ends_sha256`` (of
    the ids that end at the node, ascending, comma-joined).

    Nulls, ties and repeated rows are treated as in ``placed_turns``; extra columns
    are left out.  A conversation without turns ends at the root, and an empty
    table has no node.  Prefixes are told apart by 128 bits.
    """
    spark = conversations.sparkSession
    modest_batches(spark)
    work = Workspace(spark, "trie")
    placed = placed_turns(conversations, work)
    ids = F.col("conv_id")
    rows = rebuilt_turns(placed, F.lit(0) if head is None else head, ids if base is None else base)
    schema = "part int, seq bigint, k1 bigint, k2 bigint, t1 bigint, t2 bigint, conv_id bigint, depth bigint, bytes bigint"

    def parents(batches):
        for b in batches:
            sums = [b.column(c).to_numpy().view(_U) - b.column(t).to_numpy().view(_U) for c, t in (("k1", "t1"), ("k2", "t2"))]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("conv_id", "depth", "bytes", "k1", "k2")), *map(_signed, sums)], ["conv_id", "depth", "bytes", "k1", "k2", "q1", "q2"])

    prefixes = work.keep(
        _running(rows, ["depth"], _prefixes, schema, ["k1", "k2"], work, "sums").mapInArrow(parents, "conv_id bigint, depth bigint, bytes bigint, k1 bigint, k2 bigint, q1 bigint, q2 bigint"),
        "prefixes",
    )
    told = prefixes.groupBy("k1", "k2").agg(F.min("q1").alias("q1"), F.min("q2").alias("q2"), F.min("depth").alias("depth"), F.min("bytes").alias("bytes"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    none, zero = F.lit(None).cast("long"), F.lit(0).cast("long")
    every = conversations.where("conv_id is not null").select(ids.cast("long").alias("conv_id")).distinct()
    root = every.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(zero.alias("k1"), zero.alias("k2"), none.alias("q1"), none.alias("q2"), zero.alias("depth"), zero.alias("bytes"), "conv_id", "n_convs")
    nodes = _with_children(work.keep(told.unionByName(root), "nodes"))
    nodes = nodes.withColumns({"n_leaves": (F.col("kids") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("bytes")})
    nodes = work.keep(nodes, "nodes")
    sums = subtree_sums(nodes, ["n_leaves", "saved_tokens"], work)
    last = prefixes.groupBy("conv_id").agg(F.max_by(F.struct("k1", "k2"), "depth").alias("k"))
    ends = every.join(last, "conv_id", "left").select(F.coalesce("k.k1", zero).alias("k1"), F.coalesce("k.k2", zero).alias("k2"), "conv_id")
    parents_of = nodes.select(F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    found = nodes.drop("n_leaves", "saved_tokens").join(sums, ["k1", "k2"]).join(_ends(ends, work), ["k1", "k2"], "left").join(parents_of, ["q1", "q2"], "left")
    empty = hashlib.sha256(b"").hexdigest()
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", F.col("kids").alias("n_children"), "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"))
