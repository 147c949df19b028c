"""Approximate nearest neighbours by multiprobe p-stable hashing.

Vectors are scaled to length 1, where a larger cosine is a smaller Euclidean
distance.  A table hashes a vector by ``K`` Gaussian projections, each cut into
cells of one width.  A query visits, in every table, the cells with the
smallest sum of squared distances from its projections to the cells' edges,
which is the estimated order of success.  What the tables offer is ranked by
the exact cosine on the original vectors.

``K`` follows the number of vectors, and the number of probes is the least that
reaches the wanted recall on a bounded sample.  The index is dealt out by hash of
the vectors into parts of bounded size, so a cell is spread over all of them and
none is too large for a task.  A query goes to each part once, with the cost of
its last probe: it visits the part's cells that cost no more, and nothing else is
shuffled for its probes, however many they are.

Equal vectors are one class, with one place in the index and one visit as a
query, whatever their number; ranks are given to their rows at the end.  A query
whose cells hold too few rows visits every cell, in the same way.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarryline.workspace import Workspace

#: Vectors of a part of the index, and queries against them at a time.
CHUNK, AT_ONCE = 16_384, 128
#: Parts that a small index has, so that its work is shared out, and a part's fewest vectors.
PARTS, FEWEST = 16, 512
WIDTH, REACH = 1.5, 3


@dataclass
class Hashing:
    """``tables`` tables of ``k`` projections for vectors of ``dims``."""

    dims: int
    k: int
    tables: int = 2
    seed: int = 7

    def __post_init__(self):
        rng = np.random.default_rng(self.seed)
        self.a = rng.standard_normal((self.tables, self.dims, self.k))
        self.b = rng.uniform(0, 1, (self.tables, self.k))
        self.mix = rng.integers(0, 1 << 63, (self.tables, self.k + 1), dtype=np.int64) | 1

    def place(self, unit: np.ndarray, table: int) -> np.ndarray:
        """Projections in cell widths, one row a vector."""
        return unit @ self.a[table] / WIDTH + self.b[table]

    def key(self, cells: np.ndarray, table: int) -> np.ndarray:
        """A long for each cell; last axis of ``cells`` is the projections."""
        with np.errstate(over="ignore"):
            return (cells.astype(np.int64) * self.mix[table, : self.k]).sum(axis=-1) + self.mix[table, self.k]

    def visits(self, unit: np.ndarray, table: int, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Costs and cells of each vector's probes in estimated success order, at most ``most``."""
        f = self.place(unit, table)
        base = np.floor(f)
        u = f - base
        n = len(unit)
        step = np.arange(-REACH, REACH + 1)
        cost, cells = np.zeros((n, 1)), np.zeros((n, 1, 0))
        for i in range(self.k):
            edge = np.where(step > 0, step - u[:, i : i + 1], np.where(step < 0, u[:, i : i + 1] - step - 1, 0.0))
            total = (cost[:, :, None] + edge[:, None, :] ** 2).reshape(n, -1)
            order = np.argsort(total, axis=1, kind="stable")[:, :most]
            cost = np.take_along_axis(total, order, 1)
            before = np.take_along_axis(cells, (order // len(step))[:, :, None], 1)
            cells = np.concatenate([before, (base[:, i : i + 1] + step[order % len(step)])[:, :, None]], axis=2)
        return cost, cells

    def probes(self, unit: np.ndarray, table: int, most: int) -> np.ndarray:
        """Keys of each vector's cells in estimated success order, (rows, at most ``most``)."""
        return self.key(self.visits(unit, table, most)[1], table)

    def costs(self, unit: np.ndarray, table: int, cells: np.ndarray) -> np.ndarray:
        """What each of ``cells`` costs as a probe of each vector, (rows, cells): summed as
        in :meth:`visits`, and infinite out of its reach."""
        f = self.place(unit, table)
        base = np.floor(f)
        u = f - base
        cost = np.zeros((len(unit), len(cells)))
        for i in range(self.k):
            held, at = np.unique(cells[:, i], return_inverse=True)
            step = held - base[:, i : i + 1]
            edge = np.where(step > 0, step - u[:, i : i + 1], np.where(step < 0, u[:, i : i + 1] - step - 1, 0.0))
            cost += np.where(np.abs(step) > REACH, np.inf, edge**2)[:, at]
        return cost


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(column, dims: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def fit(sample: np.ndarray, n: int, neighbours: int, recall: float, tables: int = 2, queries: int = 100, most: int = 2048) -> tuple[Hashing, int]:
    """The hashing for ``n`` vectors, and the least number of probes with which
    ``recall`` of the true neighbours in ``sample`` are found.

    ``k`` falls from what ``n`` suggests until at most ``most`` probes reach the
    recall; with ``k`` 0 all vectors share a cell, and every one is compared."""
    k = max(1, round(math.log2(max(n, 1) / 500) / 1.5)) if n else 1
    hashing = Hashing(sample.shape[1], k, tables)
    if len(sample) < 2:
        return hashing, 1
    unit = _unit(sample)
    asked = unit[: min(queries, len(unit))]
    near = asked @ unit.T
    near[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    best = np.argsort(-near, axis=1)[:, : min(neighbours, len(unit) - 1)]
    for k in range(k, 0, -1):
        hashing = Hashing(sample.shape[1], k, tables)
        rank = np.full(best.shape, most)
        for t in range(hashing.tables):
            there = hashing.key(np.floor(hashing.place(unit, t)), t)
            order = hashing.probes(asked, t, most)
            for q in range(len(asked)):
                at = {key: r for r, key in enumerate(order[q].tolist())}
                rank[q] = np.minimum(rank[q], [at.get(int(there[j]), most) for j in best[q]])
        needed = int(np.quantile(rank, recall, method="higher")) + 1
        if needed <= most:
            return hashing, needed
    return Hashing(sample.shape[1], 0, 1), 1


def _limits(batches, hashing: Hashing, most: int):
    """Each query with the cost of its last probe in every table."""
    for b in batches:
        x = _matrix(b.column(2), hashing.dims)
        for at in range(0, len(x), 512):
            unit = _unit(x[at : at + 512])
            last = np.stack([hashing.visits(unit, t, most)[0][:, -1] for t in range(hashing.tables)], axis=1)
            yield pa.RecordBatch.from_arrays([*(c.slice(at, 512) for c in b.columns), pa.array(last.tolist(), pa.list_(pa.float64()))], ["id", "class", "vec", "limits"])


class _Part:
    """Vectors of a part of the index, with their cells."""

    def __init__(self, parts: list, hashing: Hashing):
        self.ids, self.of, self.x = (np.concatenate(y) for y in zip(*parts))
        self.norm, self.hashing = np.sqrt((self.x * self.x).sum(axis=1)), hashing
        unit = _unit(self.x)
        self.cells = [np.unique(np.floor(hashing.place(unit, t)), axis=0, return_inverse=True) for t in range(hashing.tables)]

    def visited(self, q: np.ndarray, limits: np.ndarray) -> np.ndarray:
        """Which vectors lie in the cells that each query visits."""
        unit, met = _unit(q), np.zeros((len(q), len(self.x)), bool)
        for t, (cells, at) in enumerate(self.cells):
            met |= (self.hashing.costs(unit, t, cells) <= limits[:, t : t + 1])[:, at.ravel()]
        return met

    def best(self, q: np.ndarray, limits: np.ndarray, k: int):
        """Places of the nearest visited vectors, and their scores, for each query: exact
        cosine, ties to smaller ids."""
        q_norm = np.sqrt((q * q).sum(axis=1))
        rough = np.where(self.visited(q, limits), (q @ self.x.T) / q_norm[:, None] / self.norm, -np.inf)
        k = min(k, rough.shape[1])
        edge = np.partition(rough, rough.shape[1] - k, axis=1)[:, rough.shape[1] - k] - 1e-9
        for i in range(len(q)):
            at = np.flatnonzero((rough[i] >= edge[i]) & (rough[i] > -np.inf))
            score = (self.x[at] * q[i]).sum(axis=1) / (self.norm[at] * q_norm[i])
            first = np.lexsort((self.ids[at], -score))[:k]
            yield i, at[first], score[first]


_FOUND = "query_id long, query_class long, id long, class long, score double"


def _rows(parts):
    q, qc, v, vc, s = (np.concatenate(x) for x in zip(*parts))
    return pa.RecordBatch.from_arrays([pa.array(q), pa.array(qc), pa.array(v), pa.array(vc), pa.array(s)], ["query_id", "query_class", "id", "class", "score"])


def _search(batches, hashing: Hashing, k: int):
    """Rows come sorted by part, vectors before queries."""
    here, parts, ready = None, [], None
    for b in batches:
        part, query = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        ids, of, x = b.column(2).to_numpy(), b.column(3).to_numpy(), _matrix(b.column(4), hashing.dims)
        cuts = np.flatnonzero((np.diff(part) != 0) | (np.diff(query) != 0)) + 1
        for a, z in zip([0, *cuts], [*cuts, len(part)]):
            if here != part[a]:
                here, parts, ready = part[a], [], None
            if not query[a]:
                parts.append((ids[a:z], of[a:z], x[a:z]))
                continue
            if not parts:
                continue
            ready = ready or _Part(parts, hashing)
            limits = _matrix(b.column(5).slice(a, z - a), hashing.tables)
            for at in range(a, z, AT_ONCE):
                to, out = min(z, at + AT_ONCE), []
                for r, place, score in ready.best(x[at:to], limits[at - a : to - a], k):
                    n = len(place)
                    out.append((np.full(n, ids[at + r]), np.full(n, of[at + r]), ready.ids[place], ready.of[place], score))
                yield _rows(out)


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id, vec`` of the rows that take part: neither id nor vector null, no
    null or non-finite component, not all zero."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return rows.where(F.col("id").isNotNull() & finite & F.exists("vec", lambda x: x != 0))


def _classes(rows: DataFrame) -> DataFrame:
    """``id, class, g, vec``: a row for each distinct vector, with its smallest id."""
    least = rows.groupBy("class", "g").agg(F.min("id").alias("id"))
    return rows.join(least, ["class", "g", "id"], "left_semi").dropDuplicates(["class", "g"]).select("id", "class", "g", "vec")


def _first(rows: DataFrame, by: list[str], n: int, *order, rank: str = "rank") -> DataFrame:
    return rows.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(rank) <= n)


def nearest(
    vectors: DataFrame, queries: DataFrame, neighbours: int = 5, recall: float = 0.97, sample: int = 10_000, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """The ``neighbours`` rows of ``vectors`` nearest by cosine to each of ``queries``.

    Returns ``query_id, rank, vec_id, score``; ties go to the smaller id, and
    rows that share the query's id are no candidates.  An id stands for one
    vector in each table.  Rows that :func:`usable` leaves out, and vectors whose
    length isn't the commonest one, take no part.  The index holds every other
    row; it is fitted on at most ``sample`` of them, and used at every size.
    """
    spark = vectors.sparkSession
    work = Workspace(spark, "nearest")
    rows, asked = usable(vectors, id_col, vec_col), usable(queries, id_col, vec_col)
    sizes = rows.groupBy(F.size("vec").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims, _ = sizes
    named = ("id", "vec", F.xxhash64("vec").alias("class"), F.xxhash64(F.lit(1), "vec").alias("g"))
    rows = work.keep(rows.where(F.size("vec") == dims).select(*named), "rows")
    asked = work.keep(asked.where(F.size("vec") == dims).select(*named), "asked")
    classes, wanted = work.keep(_classes(rows), "classes"), work.keep(_classes(asked), "wanted")
    n = classes.count()
    spread = F.pmod(F.xxhash64("id"), F.lit(1 << 20))
    drawn = classes.where(spread < math.ceil((1 << 20) * min(1.0, sample / n))).orderBy(F.xxhash64("id", F.lit(3))).limit(sample).select("vec")
    hashing, most = fit(_matrix(drawn.toArrow().column(0), dims), n, neighbours, recall)

    parts = max(math.ceil(n / CHUNK), min(PARTS, math.ceil(n / FEWEST)))
    k = neighbours + 1  # the query's own row may be among them
    none = F.array().cast("array<double>")
    index = classes.select(F.pmod(F.xxhash64("class", F.lit(1)), F.lit(parts)).cast("int").alias("part"), F.lit(0).alias("query"), "id", "class", "vec", none.alias("limits"))

    def searched(queries: DataFrame, name: str) -> DataFrame:
        """The nearest of each part for ``queries`` of ``id, class, vec, limits``."""
        each = queries.select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(1).alias("query"), "id", "class", "vec", "limits")
        together = index.union(each).repartition("part").sortWithinPartitions("part", "query")
        return work.keep(together.mapInArrow(lambda it: _search(it, hashing, k), _FOUND), name)

    limited = wanted.select("id", "class", "vec").mapInArrow(lambda it: _limits(it, hashing, most), "id long, class long, vec array<double>, limits array<double>")
    found = searched(work.keep(limited, "limits"), "found")

    # the rows of a class, as far as they can be among the nearest
    members = _first(rows.select("id", "class", "g").distinct(), ["class", "g"], k, "id", rank="place")
    members = members.join(classes.select(F.col("id").alias("least"), "class", "g"), ["class", "g"]).select(F.col("id").alias("vec_id"), "class", "least")
    askers = asked.select(F.col("id").alias("query_id"), "class", "g").distinct().join(wanted.select(F.col("id").alias("least"), "class", "g"), ["class", "g"])
    askers = askers.select("query_id", F.col("class").alias("query_class"), "least")
    other = F.col("vec_id") != F.col("query_id")

    def ranked(found: DataFrame) -> DataFrame:
        once = found.groupBy("query_id", "query_class", "id", "class").agg(F.max("score").alias("score"))
        once = _first(once, ["query_id", "query_class"], k, F.desc("score"), "id").withColumnsRenamed({"query_id": "least_q", "id": "least"})
        near = _first(once.join(members, ["class", "least"]), ["least_q", "query_class"], k, F.desc("score"), "vec_id")
        near = near.select(F.col("least_q").alias("least"), "query_class", "vec_id", "score")
        mine = askers.join(near, ["least", "query_class"]).where(other)
        mine = mine.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        return _first(mine, ["query_id"], neighbours, F.desc("score"), "vec_id").select("query_id", "rank", "vec_id", "score")

    result = work.keep(ranked(found), "ranked")
    rest = rows.select("id").distinct().count() - 1
    few = result.groupBy("query_id").count().where(F.col("count") >= min(neighbours, rest))
    short = work.keep(askers.join(few, "query_id", "left_anti").select(F.col("least").alias("id"), F.col("query_class").alias("class")).distinct().join(wanted, ["id", "class"]), "short")
    if short.isEmpty():
        return result
    # above every cost, those of cells out of reach too
    every = F.array_repeat(F.lit(float("inf")), F.lit(hashing.tables))
    more = searched(short.select("id", "class", "vec", every.alias("limits")), "more")
    exact = work.keep(ranked(more), "exact")
    return result.join(exact.select("query_id").distinct(), "query_id", "left_anti").union(exact)
