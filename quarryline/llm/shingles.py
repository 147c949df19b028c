"""Exact links between texts whose sets of word shingles are alike.

Prefix filter: in any one order of all shingles, two sets with a Jaccard
similarity of ``least`` or more share one of the first ``n - ceil(least * n) + 1``
of each.  The order puts those behind that a bounded sample of the texts shows to
be common; what the sample doesn't show costs candidates and never a pair.  The
shingles that stand in one prefix only go after one range sort, in which a shingle
of any number of sets may take several parts.  Sets are named by 64-bit hashes of
their sorted shingles, which are 64-bit hashes themselves.

A set also has a sketch: bit ``i`` says whether it holds an odd number of
shingles that hash to ``i``.  Two sketches differ in at most as many bits as the
sets have elements in one only, so a pair whose sketches differ in more bits than
the similarity allows isn't alike, and only the other pairs bring their shingles
together.  A longer sketch folds onto a shorter one.

Equal sets are one class.  Of shingles that stand in the same classes one is kept.
Within a shingle, a pivot is compared with all classes that aren't known to be
linked with it, and then leaves the shingle, having met everyone; a shingle whose
classes are known to be linked is closed.  The order that names pivots is the same
for all shingles.  The first round takes one pivot in a part of the shingles and
links each class with one of those that it meets there at most, so near copies
are linked before each of their shingles brings the same pairs together, and links
don't outnumber classes.  The next round takes one pivot in all shingles, later ones
sixty-four times as many pivots each.  There a pair meets only if its sketches, folded
to ``MEET`` longs, allow it, and in the first of the shingles that both have: each
class brings the first ``FIRST`` of its shingles, in the order of their hashes, and
what these have in common lies behind or at the shingle at hand.  The first of all
that a pair shares is never passed over, so no pair is lost.
So a group of near copies is linked up by few comparisons, what is unlike makes no
rows, and rounds grow with the logarithm of a shingle's classes.  A round is some
ten jobs whose plans stay in the driver for a while, so rounds are few.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.workspace import Workspace

#: Texts that tell the order, and the commonest shingles of them that are broadcast.
SAMPLE, COMMON = 20_000, 200_000
#: In the first rounds, one of so many shingles takes part; later ones take so many times as many pivots each.
PARTS, MORE = (8, 1), 64
#: Shingles of a set that tell whether two sets have met before.
FIRST = 16
#: Longs of the shortest and the longest sketch, and of those that shingles bring along.
SHORT, LONG, MEET = 4, 1024, 8


def tokens_of(text: bytes, words: int) -> list[bytes]:
    """Shingles of UTF-8 ``text``: A-Z lowered, words split at ASCII white space;
    fewer than ``words`` words are one shingle."""
    tokens = text.lower().split()
    if len(tokens) < words:
        return [b" ".join(tokens)] if tokens else []
    return list(map(b" ".join, zip(*(tokens[i:] for i in range(words)))))


def shingle_hashes(text: bytes | None, words: int, seed: int) -> np.ndarray:
    """The unsigned 64-bit hashes of the text's shingles, repeats included."""
    digest = xxhash.xxh64_intdigest
    return np.array([digest(t, seed) for t in tokens_of(text or b"", words)], np.uint64)


def shingle_set(text: bytes | None, words: int, seed: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the text's shingles."""
    return np.unique(shingle_hashes(text, words, seed).view(np.int64))


def class_of(found: np.ndarray) -> int:
    """A long that names the set."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(found.tobytes())).astype(np.int64))


def prefix(found: np.ndarray, common: np.ndarray, count: np.ndarray, least: float) -> np.ndarray:
    """The shingles of which two alike sets share one.  ``common`` is sorted.  Sets
    too small to be like any other but their equals have none."""
    n = len(found)
    if n < math.ceil(least / (1 - least) - 1e-9):
        return found[:0]
    size = n - math.ceil(least * n - 1e-9) + 1
    if len(common):
        at = np.minimum(np.searchsorted(common, found), len(common) - 1)
        seen = np.where(common[at] == found, count[at], 0)
        if seen.any():
            return found[np.argsort(seen, kind="stable")[:size]]
    return found[:size]  # in the order of hashes


def _met(batches):
    """Of a part that is sorted by shingle, the rows whose shingle has another row.
    The part's first and last row stay, since the parts beside it may go on."""
    held, stays = None, True
    for b in batches:
        if not b.num_rows:
            continue
        b = b if held is None else pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
        x = b.column(0).to_numpy()
        same = x[1:] == x[:-1]
        keep = np.append(same, False) | np.append(stays, same)
        # the last row waits for the next batch, which tells whether it is alone
        out = b.slice(0, b.num_rows - 1).filter(pa.array(keep[:-1]))
        held, stays = b.slice(b.num_rows - 1), bool(keep[-1])
        if out.num_rows:
            yield out
    if held is not None:
        yield held


def met_shingles(owners: DataFrame) -> DataFrame:
    """``shingle, set, size`` of all prefixes, but for most shingles that stand in one."""
    each = owners.select(F.explode("prefix").alias("shingle"), "set", "size")
    return each.repartitionByRange("shingle", "set").sortWithinPartitions("shingle", "set").mapInArrow(_met, "shingle bigint, set bigint, size int")


def one_of_same(members: DataFrame) -> DataFrame:
    """``members`` of one of all the shingles that stand in the same sets, two at least.
    Such groups of sets are told apart by their number and 128 bits."""
    prints = [F.bit_xor(F.xxhash64("set", F.lit(i))).alias(f"p{i}") for i in (1, 2)]
    groups = members.groupBy("shingle").agg(F.count("*").alias("n"), *prints).where("n > 1")
    kept = groups.groupBy("n", "p1", "p2").agg(F.min("shingle").alias("shingle"))
    return members.join(kept.select("shingle"), "shingle", "left_semi")


def sketch(found: np.ndarray) -> np.ndarray:
    """The parity sketch of a set, as longs: a power of two of them, one or two bits an element."""
    longs = min(LONG, max(SHORT, 1 << (max(1, len(found) // 64) - 1).bit_length()))
    bit = found.view(np.uint64) & np.uint64(longs * 64 - 1)
    odd = (np.bincount(bit.astype(np.int64), minlength=longs * 64) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view("<i8")


def _folded(s: Column, i: Column, longs: Column) -> Column:
    """The ``i``-th long (from 1) of a sketch that is folded to so many longs."""
    parts = F.sequence(i, F.size(s), longs)
    return F.aggregate(parts, F.lit(0).cast("long"), lambda a, j: a.bitwiseXOR(F.element_at(s, j.cast("int"))))


def sketches_allow(x: Column, y: Column, n: Column, m: Column, least: float) -> Column:
    """Whether sets of ``n`` and ``m`` elements with these sketches may be alike."""
    short = F.least(F.size(x), F.size(y))

    differ = F.aggregate(F.sequence(F.lit(1), short), F.lit(0), lambda a, i: a + F.bit_count(_folded(x, i, short).bitwiseXOR(_folded(y, i, short))))
    return differ <= (n + m) * (1 - least) / (1 + least) + 1e-6


def briefs_allow(least: float) -> Column:
    """:func:`sketches_allow` for ``brief, size`` and ``brief_b, size_b``, sketches of ``SHORT`` or
    ``MEET`` longs.  Without lambdas, so Spark has it in the join: what isn't allowed makes no row."""

    def differ(longs: int) -> Column:
        total = F.lit(0)
        for i in range(longs):
            bits = F.lit(0).cast("long")
            for j in range(i, MEET, longs):
                for x in ("brief", "brief_b"):
                    bits = bits.bitwiseXOR(F.coalesce(F.get(x, F.lit(j)), F.lit(0).cast("long")))
            total = total + F.bit_count(bits)
        return total

    long = (F.size("brief") == MEET) & (F.size("brief_b") == MEET)
    return F.when(long, differ(MEET)).otherwise(differ(SHORT)) <= (F.col("size") + F.col("size_b")) * (1 - least) / (1 + least) + 1e-6


def common_shingles(docs: DataFrame, text_col: str, words: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that recur in a sample of the texts, sorted, and their counts."""
    n = docs.count()
    texts = docs.select(F.col(text_col).cast("binary").alias("text")).where("text is not null")
    h = F.xxhash64("text")
    share = min(1.0, SAMPLE / max(1, n))
    texts = texts.where(F.pmod(h, F.lit(1 << 20)) < math.ceil((1 << 20) * share)).dropDuplicates(["text"])

    def run(batches):
        for b in batches:
            for t in b.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(t, words, seed))], ["shingle"])

    counted = texts.mapInArrow(run, "shingle bigint").groupBy("shingle").agg(F.count("*").alias("n")).where("n > 2")
    top = counted.orderBy(F.desc("n"), "shingle").limit(COMMON).toArrow().sort_by("shingle")
    return top.column(0).to_numpy(), top.column(1).to_numpy()


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    left = sets.select(F.col("set").alias("a"), F.col("found").alias("x"))
    right = sets.select(F.col("set").alias("b"), F.col("found").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    full = pairs.join(left, "a").join(right, "b").withColumn("both", both)
    return full.where(F.col("both") / (F.size("x") + F.size("y") - F.col("both")) >= least - 1e-12).select(*pairs.columns)


def _labels(links: DataFrame) -> DataFrame:
    """``set, root``: for each set the smallest that two links lead to, and then its root.
    All sets around a pivot, smaller or larger than it, have one root.  Sets of one root
    are linked; linked sets may have several, which costs comparisons and no link."""
    ends = F.explode(F.array(F.struct(F.col("a").alias("set"), F.col("b").alias("beside")), F.struct(F.col("b").alias("set"), F.col("a").alias("beside"))))
    beside = links.select(ends.alias("e")).select("e.set", "e.beside")
    step = beside.groupBy("set").agg(F.min("beside").alias("m")).select("set", F.least("set", "m").alias("root"))
    around = beside.join(step.select(F.col("set").alias("beside"), "root"), "beside")
    step = around.groupBy("set").agg(F.min("root").alias("root"))
    return step.join(step.select(F.col("set").alias("root"), F.col("root").alias("next")), "root").select("set", F.col("next").alias("root"))


def _renamed(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """``roots`` after new links ``a, b`` between roots: ``set, root`` for sets whose root is another."""
    named = _labels(links)
    new = named.where("set <> root")
    if roots is not None:
        now = roots.join(named.select(F.col("set").alias("root"), F.col("root").alias("next")), "root", "left")
        new = new.union(now.select("set", F.coalesce("next", "root"))).groupBy("set").agg(F.min("root").alias("root"))
    return new


def alike_links(owners: DataFrame, texts: DataFrame, words: int, least: float, seed: int, work: Workspace) -> DataFrame | None:
    """``a, b`` links of sets, None where there are none.

    ``owners`` has a row a set: ``set, id, size, prefix, sketch``, with the id of
    one of its texts; ``texts`` has ``id, text``, and rows of one id are equal.
    Sets are linked so that the components of the links are those of all pairs of
    sets with a similarity of ``least`` or more; every link is such a pair.
    """
    def again(batches):
        for b in batches:
            for at in range(0, b.num_rows, 64):
                found = [shingle_set(t, words, seed) for t in b.column(1).slice(at, 64).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array([class_of(f) for f in found], pa.int64()), pa.array(found, pa.list_(pa.int64()))], ["set", "found"])

    def sets_of(near: DataFrame, known: DataFrame | None) -> DataFrame:
        """The sets of pairs, each made once."""
        ends = near.select(F.explode(F.array(F.struct(F.col("a").alias("set"), F.col("id_a").alias("id")), F.struct(F.col("b").alias("set"), F.col("id_b").alias("id")))).alias("e")).select("e.*")
        keys = ends.dropDuplicates(["set"]) if known is None else ends.dropDuplicates(["set"]).join(known.select("set"), "set", "left_anti")
        held = texts.join(keys, texts["id"].eqNullSafe(keys["id"]), "left_semi").dropDuplicates(["id"])
        new = work.keep(held.mapInArrow(again, "set bigint, found array<bigint>"), "compared")
        return new if known is None else known.union(new)

    fits = (F.col("size") >= F.col("size_b") * least - 1e-9) & (F.col("size_b") >= F.col("size") * least - 1e-9)
    longs = F.least(F.size("sketch"), F.lit(MEET))
    brief = owners.select("set", F.transform(F.sequence(F.lit(1), longs), lambda i: _folded(F.col("sketch"), i, longs)).alias("brief"))
    place = F.xxhash64("shingle")

    def share_of(name: str) -> Column:
        """In [0, 1), the same for all shingles."""
        return F.shiftrightunsigned(F.xxhash64(name, F.lit(seed)), 11) / F.lit(float(1 << 53))

    share = share_of("set")
    met = work.keep(met_shingles(owners), "met")
    members = work.keep(one_of_same(met), "members")
    work.drop(met)
    first = members.groupBy("set").agg(F.slice(F.array_sort(F.collect_list(place)), 1, FIRST).alias("first"))
    links, roots, sets, r = None, None, None, 0
    while True:
        part = PARTS[min(r, len(PARTS) - 1)]
        pivots = MORE ** max(0, r - len(PARTS) + 1)
        here = members.where(F.pmod(place, F.lit(part)) == 0) if part > 1 else members
        if "pivot" in here.columns:
            here = here.where("not pivot").drop("root", "pivot")
        if roots is None:
            here = here.withColumn("root", F.col("set"))
        else:
            here = here.join(roots, "set", "left").withColumn("root", F.coalesce("root", "set"))
        one = F.min(F.struct(share.alias("h"), "set"))["set"].alias("one")
        open_ = here.groupBy("shingle").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("n"), one).where("lo <> hi").select("shingle", "n", "one")
        pivot = (F.col("set") == F.col("one")) | (share * F.col("n") < pivots - 1)
        here = here.join(open_, "shingle").withColumn("pivot", pivot).drop("n", "one")
        if "brief" not in here.columns:
            here = here.join(brief if part > 1 else brief.join(first, "set"), "set")
        here = work.keep(here, "open")
        if part == 1:  # from now on, what is open is all that is left
            work.drop(members)
            members = here
            if here.isEmpty():
                work.drop(here)
                return links
        meets = fits & (F.col("root") != F.col("root_b")) & briefs_allow(least) & (~F.col("pivot") | (F.col("set") < F.col("set_b")))
        if part == 1:  # but for those that share a shingle before this one
            meets = meets & F.coalesce(F.array_min(F.array_intersect("first", "first_b")) >= place, F.lit(True))
        other = here.where("pivot").drop("pivot").withColumnsRenamed({c: f"{c}_b" for c in ("set", "size", "root", "brief", "first")})
        met = here.join(other, "shingle").where(meets)
        if part > 1:  # one pivot for each set
            ends = [c for x in ("set", "size", "root") for c in (x, f"{x}_b")]
            met = met.groupBy("set").agg(F.min(F.struct(share_of("set_b").alias("h"), *ends[1:])).alias("e")).select("set", *[f"e.{c}" for c in ends[1:]])
        smaller = F.col("set") < F.col("set_b")
        met = met.select(
            F.least("set", "set_b").alias("a"), F.greatest("set", "set_b").alias("b"),
            F.when(smaller, F.col("size")).otherwise(F.col("size_b")).alias("n"), F.when(smaller, F.col("size_b")).otherwise(F.col("size")).alias("m"),
            F.least("root", "root_b").alias("c"), F.greatest("root", "root_b").alias("d"),
        ).distinct()
        left = owners.select(F.col("set").alias("a"), F.col("id").alias("id_a"), F.col("sketch").alias("x"))
        right = owners.select(F.col("set").alias("b"), F.col("id").alias("id_b"), F.col("sketch").alias("y"))
        pairs = work.keep(met, "pairs")
        near = pairs.join(left, "a").join(right, "b").where(sketches_allow(F.col("x"), F.col("y"), F.col("n"), F.col("m"), least))
        near = work.keep(near.select("a", "b", "c", "d", "id_a", "id_b"), "near")
        work.drop(pairs)
        if not near.isEmpty():
            sets = sets_of(near, sets)
            new = work.keep(_verified(near, sets, least), "alike")
            if not new.isEmpty():
                links = new.select("a", "b") if links is None else links.union(new.select("a", "b"))
                roots = work.keep(_renamed(roots, new.select(F.col("c").alias("a"), F.col("d").alias("b")).distinct()), "roots")
        work.drop(near)
        if part > 1:
            work.drop(here)
        r += 1
