"""Language-model scores by a log-bilinear model trained with noise-contrastive
estimation.

The model predicts symbols: the end of a text, each of the commonest words, or a
class of rarer words told by their last two bytes; a rarer word has its smoothed
share of its class.  ``BINS`` bins hold ``BINS`` symbols of like frequency each.
The vectors of the preceding symbols, scaled per position, add up to a query; its
products with the bins' vectors, and with those of the symbols of one bin, plus
biases, are normalised by a softmax each, so that a token's probability is exact
for two small batches of matrix products instead of one over all symbols.

Training is noise-contrastive on both levels: noise for the bin comes from the
bins' frequencies, noise for the symbol from those within the bin.  It takes every
token of the learning rows.  Texts are cut and coded once, into a table that
training and scoring read.  Learning rows are dealt to rounds and, within a round,
to shards by a hash of their id and codes; a shard trains in a fixed order from
the last round's mean, with a seed of its own, so the model doesn't depend on how
the rows lie in files or partitions.

Counts of words cover all learning rows; the commonest ``HEAD`` words go to the
tasks, and the counts of all others meet the texts that hold them in a join,
after each text has counted its own.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.llm.chunks import Table, buffers, groups, hashes, lowered
from quarryline.llm.chunks import words as word_bounds
from quarryline.workspace import Workspace, modest_batches

#: ``CLASSES`` of the ``BINS * BINS`` symbols are classes of rarer words; ``HEAD``
#: bounds what is broadcast.
BINS, CLASSES, HEAD = 64, 128, 200_000
SYMBOLS = BINS * BINS
WIDTH, CONTEXT, NOISE = 16, 4, 12
#: Most tokens of a step, tokens of a shard, and the rounds of averaging.
BATCH, SHARD, ROUNDS = 16384, 4 << 20, 3
COUNTED = 1 << 20  # words that a task counts before it hands their counts on
FINE = 1 << 20  # steps between 0 and 1 in which shards tell their weights


def _class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % CLASSES


def _class_column(word: Column) -> Column:
    return (F.crc32(F.when(F.length(word) < 2, word).otherwise(F.substring(word, -2, 2))) % CLASSES).cast("int")


def _split(data: np.ndarray, bounds: np.ndarray):
    """The lowered bytes of texts, and starts, ends and hashes of their words."""
    part = lowered(data)
    start, stop = word_bounds(part, bounds)
    return part, start, stop, *hashes(part, start, stop)


def _counted(batches):
    """Counts of words, summed up over as many texts as fit in bounded memory."""
    table, seen, n = Table(COUNTED), [], np.zeros(COUNTED, np.int64)

    def flush():
        return pa.RecordBatch.from_arrays([pa.array(seen, pa.binary()), pa.array(n[: len(seen)])], ["word", "n"])

    for b in batches:
        data, bounds = buffers(b.column(0))
        for i, j in groups(bounds):
            part, start, stop, h, first = _split(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
            raw, at = part.tobytes(), 0
            while at < len(h):
                to = min(len(h), at + COUNTED // 4)
                entry = table.find(h[at:to], first[at:to])
                miss = at + np.flatnonzero(entry < 0)
                new = miss[np.unique(h[miss], return_index=True)[1]]
                if table.size + len(new) > COUNTED:
                    yield flush()
                    table, seen, n = Table(COUNTED), [], np.zeros(COUNTED, np.int64)
                    continue
                table.add(h[new], first[new])
                seen += [raw[x:z] for x, z in zip(start[new].tolist(), stop[new].tolist())]
                entry[miss - at] = table.find(h[miss], first[miss])
                n += np.bincount(entry[entry >= 0], minlength=COUNTED)
                rest = np.flatnonzero(entry < 0)  # another word has the same first hash
                for x, z in zip(start[at + rest].tolist(), stop[at + rest].tolist()):
                    yield pa.RecordBatch.from_arrays([pa.array([raw[x:z]], pa.binary()), pa.array([1])], ["word", "n"])
                at = to
    if seen:
        yield flush()


@dataclass
class Vocabulary:
    """What the corpus says of symbols and common words; of bounded size.

    A common word's code is its rank; the codes from ``len(words)`` on are the
    classes of all other words, and the last one is the end.
    """

    words: list[bytes]  # the commonest words, commonest first
    count: np.ndarray  # of each of them
    tokens: int
    distinct: int
    ends: int
    class_tokens: np.ndarray  # of the words that aren't symbols of their own
    class_words: np.ndarray

    def __post_init__(self):
        n = min(len(self.words), SYMBOLS - CLASSES - 1)
        rare = [n + _class(w) for w in self.words[n:]]
        # by code: the number of a symbol before the symbols are put in bins
        plain = np.array([*range(n), *rare, *range(n, n + CLASSES + 1)], np.int64)
        size = np.zeros(SYMBOLS)
        size[:n], size[n : n + CLASSES], size[n + CLASSES] = self.count[:n], self.class_tokens + 0.5, self.ends + 0.5
        place = np.empty(SYMBOLS, np.int64)
        place[np.argsort(-size, kind="stable")] = np.arange(SYMBOLS)
        self.symbol_of = place[plain]  # bins are runs of BINS symbols
        self.size = np.zeros(SYMBOLS)  # of each symbol; 0 where none is
        self.size[place] = size
        self.end = int(self.symbol_of[-1])
        # what a token of each code has besides its symbol's probability
        share = np.zeros(len(plain))
        within = np.log10(self.class_tokens + 0.5 * (self.class_words + 1))
        share[n : len(self.words)] = np.log10(self.count[n:] + 0.5) - within[plain[n : len(self.words)] - n]
        share[len(self.words) : -1] = -within
        self.share = share

    def table(self) -> Table:
        """Finds the code of a common word."""
        made = Table(max(1, len(self.words)))
        if self.words:
            data = np.frombuffer(b"".join(self.words), np.uint8)
            stop = np.cumsum([len(w) for w in self.words])
            made.add(*hashes(data, np.append(0, stop[:-1]), stop))
        return made


def vocabulary(learn: DataFrame, work: Workspace) -> tuple[Vocabulary, DataFrame]:
    """The vocabulary of the column ``text``, and the table ``word, c`` of all words' counts."""
    counts = work.keep(learn.select("text").mapInArrow(_counted, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("c")), "counts")
    ends = learn.count()
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    # how many words have each count (or power of two) tells from which count on
    # there are at most HEAD words, so no task sends more than it must
    step = F.when(F.col("c") <= 4096, F.col("c")).otherwise(F.pow(F.lit(2), F.floor(F.log2("c"))).cast("long"))
    least, held = None, 0
    for at, n in sorted(((r[0], r[1]) for r in counts.groupBy(step).count().collect()), reverse=True):
        held += n
        if held > HEAD:
            break
        least = at
    common = counts.where(F.col("c") >= least).collect() if least else []
    ranked = sorted(((bytes(r.word), r.c) for r in common), key=lambda x: (-x[1], x[0]))
    tokens, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    for k, c, n in counts.groupBy(_class_column(F.col("word"))).agg(F.sum("c"), F.count("*")).collect():
        tokens[k], kinds[k] = c, n
    for word, c in ranked[: SYMBOLS - CLASSES - 1]:
        tokens[_class(word)] -= c
        kinds[_class(word)] -= 1
    known = np.array([c for _, c in ranked], np.float64)
    return Vocabulary([w for w, _ in ranked], known, total[0] + ends, total[1] + (ends > 0), ends, tokens, kinds), counts


def _coded(batches, vocab: Vocabulary):
    """Codes of each text's words, and the words that aren't common, with their counts."""
    table, other = vocab.table(), len(vocab.words)
    key = TaskContext.get().partitionId() << 40
    for b in batches:
        data, bounds = buffers(b.column(2))
        for i, j in groups(bounds):
            here = bounds[i : j + 1] - bounds[i]
            part, start, stop, h, first = _split(data[bounds[i] : bounds[j]], here)
            code = table.find(h, first)
            rare = np.flatnonzero(code < 0)
            raw = part.tobytes()
            names = [raw[a:z] for a, z in zip(start[rare].tolist(), stop[rare].tolist())]
            code[rare] = [other + _class(w) for w in names]
            ends = np.searchsorted(start, here)
            codes = code.astype("<i4").tobytes()
            cut = np.searchsorted(rare, ends).tolist()
            tails = [Counter(names[a:z]) for a, z in zip(cut, cut[1:])]
            e = ends.tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).slice(i, j - i),
                    b.column(1).slice(i, j - i),
                    pa.array(range(key, key + j - i), pa.int64()),
                    pa.array([codes[4 * a : 4 * z] for a, z in zip(e, e[1:])], pa.binary()),
                    pa.array([list(t) for t in tails], pa.list_(pa.binary())),
                    pa.array([list(t.values()) for t in tails], pa.list_(pa.int32())),
                ],
                ["id", "learns", "key", "codes", "tail", "times"],
            )
            key += j - i


@dataclass
class Weights:
    r: np.ndarray  # symbols as context
    v: np.ndarray  # symbols as targets, within their bin
    u: np.ndarray  # bins as targets
    c: np.ndarray  # scale of each position and dimension
    b: np.ndarray  # biases of symbols
    a: np.ndarray  # and of bins

    SHAPES = ((SYMBOLS, WIDTH), (SYMBOLS, WIDTH), (BINS, WIDTH), (CONTEXT, WIDTH), (SYMBOLS,), (BINS,))

    def parts(self) -> tuple:
        return self.r, self.v, self.u, self.c, self.b, self.a

    @classmethod
    def start(cls, size: np.ndarray) -> Weights:
        rng = np.random.default_rng(17)
        draw = [rng.normal(0, 0.3, s).astype(np.float32) for s in cls.SHAPES[:3]]
        bins = size.reshape(BINS, BINS)
        with np.errstate(divide="ignore", invalid="ignore"):
            b = np.log(np.nan_to_num(bins / bins.sum(axis=1, keepdims=True))).ravel()
            a = np.log(bins.sum(axis=1) / bins.sum())
        return cls(*draw, np.full(cls.SHAPES[3], 0.5, np.float32), *[np.maximum(x, -30).astype(np.float32) for x in (b, a)])

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.parts()])

    @classmethod
    def of(cls, flat: np.ndarray) -> Weights:
        out, at = [], 0
        for s in cls.SHAPES:
            n = int(np.prod(s))
            out.append(flat[at : at + n].reshape(s).astype(np.float32))
            at += n
        return cls(*out)

    def query(self, context: np.ndarray) -> np.ndarray:
        q = np.take(self.r, context[0], axis=0)
        q *= self.c[0]
        for i in range(1, CONTEXT):
            x = np.take(self.r, context[i], axis=0)
            x *= self.c[i]
            q += x
        return q

    def log10_probs(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Normalised log10 probabilities of the targets."""
        out = np.empty(len(target))
        # biases are weights of an input that is always one
        u = np.ascontiguousarray(np.concatenate([self.u, self.a[:, None]], axis=1).T)
        v = np.concatenate([self.v, self.b[:, None]], axis=1).reshape(BINS, BINS, WIDTH + 1).transpose(0, 2, 1).copy()
        for at in range(0, len(target), 1 << 14):
            goal = target[at : at + (1 << 14)]
            order = np.argsort((goal // BINS).astype(np.int16), kind="stable")
            goal = goal[order]
            q = np.ones((len(goal), WIDTH + 1), np.float32)
            q[:, :WIDTH] = self.query(context[:, at : at + (1 << 14)][:, order])
            bins, found = goal // BINS, np.empty(len(goal))
            edge = np.searchsorted(bins, np.arange(BINS + 1))
            for k in np.flatnonzero(np.diff(edge)):
                for x in range(edge[k], edge[k + 1], 1024):
                    z = min(x + 1024, edge[k + 1])
                    found[x:z] = _log_share(q[x:z] @ u, k) + _log_share(q[x:z] @ v[k], goal[x:z] - k * BINS)
            out[at + order] = found
        return out / np.log(10)


_EACH = np.ones(BINS, np.float32)


def _log_share(s: np.ndarray, which) -> np.ndarray:
    """Log softmax of one column a row.  Scores are far below what overflows; where
    one isn't, they are moved first."""
    if s.max() > 60 or s.min() < -60:
        s -= s.max(axis=1, keepdims=True)
    mine = s[np.arange(len(s)), which].astype(np.float64)
    np.exp(s, out=s)
    return mine - np.log((s @ _EACH).astype(np.float64))


def contexts(symbols: np.ndarray, ends: np.ndarray, end: int):
    """Context (a row a position) and target arrays of texts whose words are
    ``symbols``, one after the other; text ``i`` stops before ``ends[i]``."""
    n = len(ends)
    before = np.zeros(len(symbols) + n * (CONTEXT + 1), np.int64)
    before[:] = end
    text = np.repeat(np.arange(n), np.diff(np.append(0, ends)))
    before[np.arange(len(symbols)) + CONTEXT + text * (CONTEXT + 1)] = symbols
    first = np.append(0, ends[:-1]) + np.arange(n) * (CONTEXT + 1) + CONTEXT
    size = np.diff(np.append(0, ends)) + 1
    target = np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)
    return np.stack([before[target - i - 1] for i in range(CONTEXT)]), before[target]


def _sums(wide: np.ndarray, which: np.ndarray, n: int) -> np.ndarray:
    """Sums of the columns of ``wide`` by number, as rows."""
    return np.stack([np.bincount(which, x, n) for x in wide], axis=1).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


#: The biases of symbols and bins start near their place, and take smaller steps.
SLOW = 0.05
_ONE = np.eye(BINS, dtype=np.float32)


class Trainer:
    """Noise-contrastive estimation with adaptive steps.  The noise samples of a
    batch are shared by its tokens, and within a bin by its tokens."""

    def __init__(self, weights: Weights, size: np.ndarray, rate: float = 0.3, seed: int = 0):
        self.w = Weights(*(x.copy() for x in weights.parts()))
        bins = size.reshape(BINS, BINS)
        total = bins.sum(axis=1)
        self.bin_share = total / max(total.sum(), 1e-9)
        self.share = bins / np.maximum(total, 1e-9)[:, None]
        with np.errstate(divide="ignore"):
            self.log_bin = np.log(NOISE * self.bin_share).astype(np.float32)
            self.log_share = np.log(NOISE * self.share).astype(np.float32)
        self.steps = np.cumsum(self.share, axis=1)
        self.rate, self.rng = rate, np.random.default_rng(seed)
        self.sums = [np.full(s, 1e-4, np.float32) for s in Weights.SHAPES]
        self.seen = 0

    @staticmethod
    def _pull(q, goal, bias, fake, fake_bias):
        """Gradients of the log likelihood of real tokens and of their noise."""
        real = np.einsum("ij,ij->i", q, goal)
        real += bias
        made = q @ fake.T
        made += fake_bias
        e, g = _sigmoid(-real), _sigmoid(made)
        np.negative(g, out=g)
        pull = g @ fake
        goal *= e[:, None]
        pull += goal
        return e, g, pull

    def step(self, context: np.ndarray, target: np.ndarray) -> None:
        with np.errstate(over="ignore", invalid="ignore"):
            self._step(context, target)

    def _step(self, context: np.ndarray, target: np.ndarray) -> None:
        w, n = self.w, len(target)
        order = np.argsort((target // BINS).astype(np.int16), kind="stable")
        context, target = context[:, order], target[order]
        edge = np.searchsorted(target // BINS, np.arange(BINS + 1))
        q = w.query(context)
        fake, drawn = self.rng.choice(BINS, NOISE, p=self.bin_share), self.rng.random((BINS, NOISE))
        a, bins, by_bin = w.a - self.log_bin, target // BINS, _ONE[fake].T
        e, g, dq = self._pull(q, np.take(w.u, bins, axis=0), a[bins], w.u[fake], a[fake])
        pull = np.empty(n, np.float32)
        du, da = by_bin @ (g.T @ q), by_bin @ g.sum(axis=0) + np.bincount(bins, e, BINS).astype(np.float32)
        noise_v, noise_b = np.zeros(w.v.shape, np.float32), np.zeros(w.b.shape, np.float32)
        for k in np.flatnonzero(np.diff(edge)):
            x, z = edge[k], edge[k + 1]
            mine = q[x:z]
            du[k] += e[x:z] @ mine
            here = slice(k * BINS, (k + 1) * BINS)
            v, b, goal = w.v[here], w.b[here] - self.log_share[k], target[x:z] - k * BINS
            drop = np.minimum(np.searchsorted(self.steps[k], drawn[k]), BINS - 1)
            pull[x:z], g, more = self._pull(mine, np.take(v, goal, axis=0), b[goal], v[drop], b[drop])
            dq[x:z] += more
            noise_v[here] = _ONE[drop].T @ (g.T @ mine)
            noise_b[here] = _ONE[drop].T @ g.sum(axis=0)
        wide = np.ascontiguousarray(q.T)
        wide *= pull
        dv = _sums(wide, target, SYMBOLS) + noise_v
        db = np.bincount(target, pull, SYMBOLS).astype(np.float32) + noise_b
        wide = np.ascontiguousarray(dq.T)
        dr, dc = np.zeros(w.r.shape, np.float32), np.empty(w.c.shape, np.float32)
        for i in range(CONTEXT):
            met = _sums(wide, context[i], SYMBOLS)
            dc[i] = (met * w.r).sum(axis=0)
            dr += met * w.c[i]
        for x, s, d in zip(w.parts(), self.sums, (dr, dv, du, dc, db, da)):
            d *= np.float32(1 / n)
            s += d * d
            d *= self.rate if d.ndim == 2 else self.rate * SLOW
            x += d / np.sqrt(s)
        self.seen += n


def _trained(batches, start: Weights, vocab: Vocabulary):
    """The weights of each shard; rows come by shard, in their shard's order."""
    shard, trainer, pending, size = None, None, [], 0

    def fit():
        ends = np.cumsum([len(s) for s in pending])
        context, target = contexts(np.concatenate(pending), ends, vocab.end)
        order = trainer.rng.permutation(len(target))
        at = 0
        while at < len(order):
            # small steps first: what a shard has seen tells how many tokens one takes
            n = min(BATCH, max(1024, trainer.seen // 32))
            n = n if len(order) - at >= n + n // 2 else len(order) - at
            trainer.step(context[:, order[at : at + n]], target[order[at : at + n]])
            at += n

    def weights():
        # whole numbers, so that the sums over shards don't depend on their order
        n = max(1, trainer.seen >> 10)
        x = np.round(trainer.w.flat().astype(np.float64) * FINE).astype(np.int64) * n
        return pa.RecordBatch.from_arrays([pa.array(np.arange(len(x), dtype=np.int32)), pa.array(x), pa.array(np.full(len(x), n))], ["i", "x", "n"])

    for b in batches:
        for s, codes in zip(b.column(0).to_pylist(), b.column(1)):
            if s != shard:
                if pending:
                    fit()
                if trainer:
                    yield weights()
                shard, trainer, pending, size = s, Trainer(start, vocab.size, seed=s), [], 0
            pending.append(vocab.symbol_of[np.frombuffer(codes.as_py(), "<i4")])
            size += len(pending[-1]) + 1
            if size >= 16 * BATCH:
                fit()
                pending, size = [], 0
    if pending:
        fit()
    if trainer:
        yield weights()


def train(coded: DataFrame, vocab: Vocabulary) -> Weights:
    """The model's weights from every token of the rows of ``coded`` that learn."""
    weights = Weights.start(vocab.size)
    shards = max(1, round(vocab.tokens / (ROUNDS * SHARD)))
    context = coded.sparkSession.sparkContext
    known = context.broadcast(vocab)
    h = F.xxhash64("id", "codes")
    for i in range(ROUNDS):
        start = context.broadcast(weights)
        rows = coded.where(F.col("learns") & (F.pmod(h, F.lit(ROUNDS)) == i)).select(F.pmod(F.shiftright(h, 8), F.lit(shards)).cast("int").alias("shard"), "codes", h.alias("h"))
        dealt = rows.repartitionById(shards, "shard").sortWithinPartitions("shard", "h").select("shard", "codes")
        parts = dealt.mapInArrow(lambda it, start=start: _trained(it, start.value, known.value), "i int, x bigint, n bigint")
        mean = parts.groupBy("i").agg((F.sum("x") / F.sum("n") / FINE).alias("x")).toArrow()
        if mean.num_rows:
            flat = np.empty(mean.num_rows)
            flat[mean.column("i").to_numpy()] = mean.column("x").to_numpy()
            weights = Weights.of(flat)
    return weights


def _scored(batches, vocab: Vocabulary, weights: Weights):
    known = np.concatenate([vocab.count > 0, np.zeros(CLASSES + 1, bool)])
    log = np.concatenate([np.log10(vocab.count + 0.5), np.zeros(CLASSES + 1)])
    below = np.log10(vocab.tokens + 0.5 * (vocab.distinct + 1))
    end_base, end_known = np.log10(vocab.ends + 0.5) - below, int(vocab.ends > 0)
    for b in batches:
        data, bounds = buffers(b.column(3))
        for i, j in groups(bounds):
            code = data[bounds[i] : bounds[j]].view("<i4") if bounds[j] > bounds[i] else np.zeros(0, np.int32)
            ends = (bounds[i + 1 : j + 1] - bounds[i]) // 4
            first = np.append(0, ends[:-1])
            logs = weights.log10_probs(*contexts(vocab.symbol_of[code], ends, vocab.end))
            lm = np.add.reduceat(logs, first + np.arange(len(first)))

            def per_text(x):
                total = np.append(0, np.cumsum(x))
                return total[ends] - total[first]

            n = ends - first
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).slice(i, j - i),
                    b.column(1).slice(i, j - i),
                    b.column(2).slice(i, j - i),
                    pa.array(n + 1),
                    pa.array(per_text(known[code].astype(np.int64)) + end_known),
                    pa.array(per_text(log[code]) - n * below + end_base),
                    pa.array(lm + per_text(vocab.share[code])),
                ],
                ["id", "learns", "key", "n_tokens", "n_known", "base", "lm"],
            )


def score(docs: DataFrame, learns: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of all ``docs`` by what those rows teach for which ``learns`` holds
    (default: all; null: not).

    Returns ``id, learns, n_tokens, n_known, train_tokens, base_score, score``,
    all log10 and summed over the words and one end of a text.  Null texts are
    empty, rows that repeat an id are scored apart, and a text is read whole,
    whatever its length.  Without learning rows every word is unknown.  Columns of
    any other name are left out, and an empty table has no rows.
    """
    spark = docs.sparkSession
    modest_batches(spark)
    work = Workspace(spark, "lm")
    learns = F.coalesce(F.lit(True) if learns is None else learns, F.lit(False))
    rows = docs.select(F.col(id_col).alias("id"), learns.alias("learns"), F.col(text_col).cast("binary").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    vocab, counts = vocabulary(rows.where("learns"), work)
    shared = spark.sparkContext.broadcast(vocab)
    schema = f"id {kind}, learns boolean, key bigint, codes binary, tail array<binary>, times array<int>"
    coded = work.keep(rows.mapInArrow(lambda it: _coded(it, shared.value), schema), "coded")
    model = spark.sparkContext.broadcast(train(coded, vocab))
    told = coded.select("id", "learns", "key", "codes").mapInArrow(
        lambda it: _scored(it, shared.value, model.value), f"id {kind}, learns boolean, key bigint, n_tokens bigint, n_known bigint, base double, lm double"
    )
    scored = work.keep(told, "scored")
    tails = coded.select("key", F.explode(F.arrays_zip("tail", "times")).alias("t")).select("key", F.col("t.tail").alias("word"), F.col("t.times").alias("n"))
    met = tails.join(counts, "word", "left").groupBy("key").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("more"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("known"),
    )
    more = F.coalesce("more", F.lit(0.0))
    return scored.join(met, "key", "left").select(
        "id",
        "learns",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(int(vocab.tokens)).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"),
        (F.col("lm") + more).alias("score"),
    )
