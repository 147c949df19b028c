"""SimHash near-duplicates found by covering locality-sensitive hashing.

Fingerprints of 64 bits are linked when they differ in at most ``radius``
bits.  Bit ``i`` gets a random nonzero vector ``m(i)`` of ``radius + 1`` bits;
table ``v`` (one for every nonzero vector) keeps the bits with odd
``<m(i), v>``.  Vectors of the at most ``radius`` bits in which two
fingerprints differ leave some nonzero ``v`` orthogonal to all of them, and in
that table the two share a key: no pair is missed, whatever the data.

A bucket's pairs are never listed.  Two members lie within two flips exactly
if they reach a common word by flipping at most one bit each, so each member
of a shared bucket announces its ball of single flips, and equal words join
their owners to the smallest of them.  A ball holds at most 65 words, hence no
word has more owners than that, however large the bucket.  For radius 1 the
same holds with flips on one side.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.llm.shingles import alike_links, class_of, common_shingles, prefix, shingle_hashes, sketch
from quarryline.operators.components import connected_components
from quarryline.workspace import Workspace, modest_batches

BITS = 64


def fingerprint(text: bytes, words: int, seed: int) -> int:
    """SimHash of UTF-8 ``text``: A-Z lowered, words split at ASCII white space,
    every shingle counted as often as it occurs."""
    return fingerprint_of(shingle_hashes(text, words, seed))


def fingerprint_of(hashes: np.ndarray) -> int:
    """SimHash of the hashes of a text's shingles; 0 if there are none."""
    if not len(hashes):
        return 0
    total = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65536):
        h = hashes[at : at + 65536].astype(">u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(hashes)).tobytes(), "big")


def _fingerprints(batches, words: int, seed: int):
    for b in batches:
        found = [0 if t is None else fingerprint(t, words, seed) for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], ["id", "fp"])


def simhash_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, seed: int = 42) -> DataFrame:
    """``id, fp`` of every row: the 64-bit SimHash as a signed long.

    Null, empty and blank texts have fingerprint 0.  A text of fewer than
    ``words`` words is one shingle.  Whole texts are read whatever their
    length; repeated rows give repeated rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    modest_batches(docs.sparkSession)
    return rows.mapInArrow(lambda it: _fingerprints(it, words, seed), f"id {kind}, fp bigint")


def covering_masks(radius: int, seed: int = 1) -> list[int]:
    """The ``2 ** (radius + 1) - 1`` bit masks, as unsigned 64-bit integers."""
    rng = np.random.default_rng(seed)
    vectors = np.arange(BITS) % (2 ** (radius + 1) - 1) + 1  # balanced, then shuffled
    rng.shuffle(vectors)
    return [sum(1 << i for i in range(BITS) if int(vectors[i] & v).bit_count() % 2) for v in range(1, 2 ** (radius + 1))]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def hamming_links(fingerprints: DataFrame, radius: int, work: Workspace) -> DataFrame:
    """``a, b`` edges that connect exactly the ``fp`` values within ``radius``.

    ``fingerprints`` has distinct values of ``fp``.  The edges have the same
    components as the graph of all pairs within the radius (radius 1 or 2).
    """
    if radius not in (1, 2):
        raise ValueError("radius must be 1 or 2")
    masks = [_signed(m) for m in covering_masks(radius)]
    keys = fingerprints.select(
        "fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in masks])).alias("t", "key")
    )
    shared = keys.groupBy("t", "key").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo <> hi").select("t", "key")
    members = keys.join(shared, ["t", "key"])
    flips = F.array(
        *[
            F.array(*[F.lit(_signed(1 << i)).cast("long") for i in range(BITS) if not (m >> i) & 1], F.lit(0).cast("long"))
            for m in covering_masks(radius)
        ]
    )
    # members of a bucket agree on the kept bits, so only the other bits can be flipped
    ball = members.select("fp", F.explode(F.element_at(flips, F.col("t") + 1)).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("word")).distinct()
    if radius == 1:  # one side flips at most one bit to reach the other
        return ball.where("fp <> word").join(fingerprints.select(F.col("fp").alias("word")), "word", "left_semi").select(F.col("fp").alias("a"), F.col("word").alias("b"))
    owners = ball.groupBy("word").agg(F.collect_set("fp").alias("fps")).where("size(fps) > 1")
    return owners.select(F.explode("fps").alias("a"), F.array_min("fps").alias("b")).where("a <> b").distinct()


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, radius: int = 2, seed: int = 42
) -> DataFrame:
    """``id, fp, component``: near-duplicate groups of all rows of ``docs``.

    Rows with equal fingerprints are one class, links run between classes, and
    ``component`` is the smallest id reachable.  Ids may repeat or be null (a
    null is never a component's name unless all its ids are null).  An empty
    table gives no rows; other columns are ignored.
    """
    work = Workspace(docs.sparkSession, "simhash")
    prints = work.keep(simhash_fingerprints(docs, id_col, text_col, words, seed), "prints")
    classes = work.keep(prints.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    links = hamming_links(classes.select("fp"), radius, work)
    groups = connected_components(links, work).select(F.col("node").alias("fp"), "root")
    rooted = classes.join(groups, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component"))
    names = work.keep(rooted.join(named, "root").select("fp", "component"), "names")
    return prints.join(names, "fp").select("id", "fp", "component")


def _facts(batches, words: int, seed: int, least: float, common):
    for b in batches:
        for at in range(0, b.num_rows, 128):
            here = b.slice(at, 128)
            hashes = [shingle_hashes(t, words, seed) for t in here.column(1).to_pylist()]
            sets = [np.unique(h.view(np.int64)) for h in hashes]
            columns = [
                pa.array(np.array([fingerprint_of(h) for h in hashes], np.uint64).view(np.int64)),
                pa.array([class_of(f) for f in sets], pa.int64()),
                pa.array([len(f) for f in sets], pa.int32()),
                pa.array([prefix(f, *common, least) for f in sets], pa.list_(pa.int64())),
                pa.array([sketch(f) for f in sets], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays([here.column(0), *columns], ["id", "fp", "set", "size", "prefix", "sketch"])


def near_duplicate_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, radius: int = 2, least: float = 0.8, seed: int = 42
) -> DataFrame:
    """``id, component`` of every row: groups by fingerprints within ``radius``
    and by shingle sets with a Jaccard similarity of ``least`` or more.

    Rows with equal ids have to be equal in their texts.  ``component`` is the
    smallest id of the group; a null id is the smallest only of nulls.  Null, empty
    and blank texts have no shingle and fingerprint zero: they are one group.  Texts
    of fewer than ``words`` words are one shingle, so only equals of them are alike
    as sets.  Whole texts are read, however long.  Repeated rows give a row each
    id once, other columns are left out, and an empty table has no rows.
    """
    spark = docs.sparkSession
    modest_batches(spark)
    work = Workspace(spark, "simhash")
    common = spark.sparkContext.broadcast(common_shingles(docs, text_col, words, seed))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, fp bigint, set bigint, size int, prefix array<bigint>, sketch array<bigint>"
    facts = work.keep(rows.mapInArrow(lambda it: _facts(it, words, seed, least, common.value), schema), "facts")
    prints = work.keep(facts.select("id", "fp", "set").distinct(), "prints")
    one = prints.groupBy("set").agg(F.min("id").alias("id"))
    owners = facts.drop("fp").join(one.withColumnRenamed("id", "owner"), "set").where("id <=> owner").drop("owner")
    owners = work.keep(owners.dropDuplicates(["set"]), "owners")
    work.drop(facts)
    alike = alike_links(owners, rows, words, least, seed, work)
    # fingerprint classes and set classes meet in their rows
    of = prints.select("fp", "set").distinct()
    named = work.keep(of.groupBy("fp").agg(F.min("set").alias("b")), "named")
    ends = hamming_links(named.select("fp"), radius, work)
    near = ends.join(named.select(F.col("fp").alias("a"), F.col("b").alias("x")), "a").join(named.select(F.col("fp").alias("b"), F.col("b").alias("y")), "b")
    links = of.join(named, "fp").select(F.col("set").alias("a"), "b").where("a <> b").union(near.select("x", "y"))
    groups = connected_components(links if alike is None else links.union(alike), work).select(F.col("node").alias("set"), "root")
    rooted = work.keep(prints.join(groups, "set", "left").select("id", F.coalesce("root", "set").alias("root")), "rooted")
    return rooted.join(rooted.groupBy("root").agg(F.min("id").alias("component")), "root").select("id", "component")


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, radius: int = 2, seed: int = 42, least: float = 0.8) -> DataFrame:
    """``docs`` with one row, that of the smallest id, of each group of
    :func:`near_duplicate_components`.

    Rows are told apart by their id and a hash of all their columns; of rows that
    are equal in everything, one stays.  Null texts are empty ones, and all
    empty texts are one group.  ``docs`` may have columns of any name.
    """
    at = F.struct(F.col(id_col).isNull().alias("missing"), F.col(id_col).alias("id"), F.xxhash64(*[f"`{c}`" for c in docs.columns]).alias("row"))
    keyed = docs.select(at.alias("key"), F.struct(*[f"`{c}`" for c in docs.columns]).alias("row"))
    texts = keyed.select("key", F.col("row").getField(text_col).alias("text"))
    groups = near_duplicate_components(texts, "key", "text", words, radius, least, seed)
    copies = keyed.groupBy("key").agg(F.count("*").alias("n"))
    kept = groups.where("id <=> component").select(F.col("id").alias("key"))
    kept = Workspace(docs.sparkSession, "simhash").keep(kept.join(copies, "key"), "kept")
    found = keyed.join(kept.where("n = 1").select("key"), "key", "left_semi").select("row.*")
    if kept.where("n > 1").isEmpty():
        return found
    return found.union(keyed.join(kept.where("n > 1").select("key"), "key", "left_semi").dropDuplicates(["key"]).select("row.*"))
