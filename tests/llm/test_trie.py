"""Prefix tries against plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from quarryline.llm.queries import QUERIES
from quarryline.llm.trie import _with_children, placed_turns, prefix_trie, rebuilt_turns, subtree_sums
from quarryline.workspace import Workspace

SCHEMA = "conv_id long, turn long, role string, text string, depth string, k1 long"


def plain_trie(rows, h=lambda c: zlib.crc32(str(c).encode()) % 9, base=lambda c: c - c % 5):
    """rows of (conv_id, turn, role, text); ids are not negative."""
    convs = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            convs[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [x[1:] for x in sorted(t)] for c, t in convs.items()}
    rebuilt = {c: tuple(own.get(base(c), [])[: h(c)] + own[c][h(c) :]) for c in own}
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    kids = defaultdict(list)
    for prefix in members:
        if prefix:
            kids[prefix[:-1]].append(prefix)
    leaves, saved = defaultdict(int), defaultdict(int)
    for prefix, m in members.items():
        for d in range(len(prefix) + 1):
            leaves[prefix[:d]] += not kids[prefix]
            saved[prefix[:d]] += (len(m) - 1) * len(prefix[-1][1].encode()) if prefix else 0
    return sorted(
        (
            min(m),
            len(p),
            min(members[p[:-1]]) if p else -1,
            len(m),
            len(kids[p]),
            leaves[p],
            saved[p],
            hashlib.sha256(",".join(str(c) for c in sorted(m) if len(rebuilt[c]) == len(p)).encode()).hexdigest(),
        )
        for p, m in members.items()
    )


def told(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect())


def test_registered_query_equals_plain_python(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = QUERIES["op13_trie"](spark, sf)
    assert set(found.dtypes) == {*((c, "bigint") for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")), ("ends_sha256", "string")}
    assert told(found) == plain_trie(rows)


def awkward_conversations():
    rng = random.Random(9)
    rows = []
    for c in range(0, 120):
        if c % 11 == 5:
            continue  # some bases are absent
        for t in range(rng.choice([0, 1, 2, 3, 7, 12])):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "b", "", "ü"]), "x", 1))
    rows += [(300, None, None, None, None, None), (300, None, "user", "first", None, None), (300, 4, "user", None, "", 0)]
    rows += [(301, 1, "a", "same", "", 0)] * 3 + [(301, 1, "b", "same", "", 0), (301, 1, "a", "also", "", 0)]
    rows += [(None, 1, "user", "of no conversation", "", 0)]
    rows += [(305, t, "user", f"long {t}", "", 0) for t in range(70)]  # a chain
    rows += [(400 + i, t, "user", f"same {t}", "", 0) for i in range(60) for t in range(5)]  # a hot conversation
    rows += [(7000 + i, 0, "user", "hot first turn", "", 0) for i in range(60)] + [(7000 + i, 1, "user", f"then {i}", "", 0) for i in range(60)]
    rng.shuffle(rows)
    return rows


def test_awkward_conversations(spark):
    rows = awkward_conversations()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    conv = F.col("conv_id")
    head, base = F.crc32(conv.cast("string").cast("binary")) % 9, conv - conv % 5
    assert told(prefix_trie(df, head, base)) == plain_trie(rows)
    assert told(prefix_trie(df)) == plain_trie(rows, h=lambda c: 0, base=lambda c: c)


def test_empty_tables_and_turnless_conversations(spark):
    assert prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    only = prefix_trie(spark.createDataFrame([(6, 0, "user", "x", "", 0)], SCHEMA), F.lit(8), F.col("conv_id") - 1)
    assert told(only) == [(6, 0, -1, 1, 0, 1, 0, hashlib.sha256(b"6").hexdigest())]


def test_a_conversation_over_many_parts(spark):
    """Places and prefixes go on where a part ends within a conversation."""
    rows = [(1, t, "user", f"{t}", "", 0) for t in range(300)] + [(2, t, "user", f"{t}", "", 0) for t in range(140)] + [(0, 0, "user", "0", "", 0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    work = Workspace(spark, "test")
    placed = placed_turns(df, work)
    assert sorted((r.conv_id, r.place) for r in placed.collect()) == sorted((c, t + 1) for c, t, *_ in rows)
    assert rebuilt_turns(placed, F.lit(3), F.lit(1)).where("conv_id = 0").count() == 3
    trie = {(r.conv_id, r.depth): r for r in prefix_trie(df).collect()}
    assert trie[(1, 140)].n_convs == 2 and trie[(1, 141)].n_convs == 1 and trie[(0, 1)].n_convs == 3 and len(trie) == 301
    assert trie[(0, 0)].saved_tokens == sum(len(str(t)) for t in range(140)) + 1


def test_contraction_of_random_trees(spark):
    rng = random.Random(3)
    n = 120
    for bend in (1, 5, n):  # a path, long chains with twigs, a bush
        parent = [None] + [max(0, i - rng.randint(1, bend)) for i in range(1, n)]
        depth, value = [0] * n, [rng.randint(0, 9) for _ in range(n)]
        total = list(value)
        for i in range(1, n):
            depth[i] = depth[parent[i]] + 1
        for i in sorted(range(1, n), key=lambda i: -depth[i]):
            total[parent[i]] += total[i]
        rows = [(i, i * 7, parent[i], None if parent[i] is None else parent[i] * 7, depth[i], value[i]) for i in range(n)]
        nodes = _with_children(spark.createDataFrame(rows, "k1 long, k2 long, q1 long, q2 long, depth long, value long"))
        found = subtree_sums(nodes, ["value"], Workspace(spark, "test"))
        assert {r.k1: r.value for r in found.collect()} == dict(enumerate(total))
