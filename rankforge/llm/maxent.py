"""Language-model scoring with a hashed maximum-entropy model.

The probability of a word given the two before it is class-factored:

    P(w | h) = P(class | h) * P(bin | class, h) * P(w | bin)

The first two factors are softmaxes over hashed n-gram and skip features (the word before, its class
and bin, the two before, the one before that); a word's share of its bin is its smoothed training count.
Frequent words are clustered into classes by the words they stand next to and cut
into bins by frequency; all others share the last class, an unknown word being one of them, so
the probabilities of all words sum to 1. Every word is a context of its own, rare ones by their hash.

Training, on all training texts: word counts (shuffled), a shared table of word numbers, and
gradient updates. The gradient of a weight is its observed minus its expected count; every
update gathers both from all tasks, sums them as a tree and moves each weight by the log of
their ratio over the number of active features (the gradient as iterative scaling conditions
it). The first update's expectations follow from the counts alone; the others go on until the
likelihood of the training texts settles. Scoring is in numpy batches.

The words with a class and the rows of the feature tables grow with the square root of the
training tokens (as a vocabulary does), up to ``MOST``: these tables go to every task. A word
outside the numbered ones keeps its exact count by a join.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_path
from .frames import cut, map_text, ship, text_buffer
from .words import U, mix, words

#: Words with a number.
NUMBERED = 1 << 20
#: Words with a class and feature rows of a table: the power of two from GROWTH times the root of the
#: training tokens, within these bounds (128 bytes a row go to every task: 256 MB at most).
LEAST, MOST, GROWTH = 1 << 16, 1 << 21, 8
#: One of so many feature rows is for word pairs, so that these never share a row with single words.
PAIRS = 4
#: Classes and bins of a class (the last class holds all other words).
CLASSES, BINS = 16, 16
#: Context words of the clustering; smoothing of a feature's counts; precision of the weights' normal prior.
NEIGHBOURS, ALPHA, PRIOR = 16, 4.0, 2.0
#: Training stops when an update has raised the log10 likelihood of a token by less than TOLERANCE,
#: at the latest after UPDATES updates. Steps are RATE times those of iterative scaling, half as much
#: after one that lowered the likelihood.
TOLERANCE, UPDATES, RATE = 0.01, 8, 2.0
SMOOTH = 0.1
BATCH = 1 << 18
#: Sums of weights whose exponential a 32-bit float holds with all its digits.
SAFE = 60.0
END = U(0x5DEECE66D1234567)
SLICE_BYTES = 16 << 20


# ------------------------------------------------------------------ counts and numbers
def _tokens(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of every text, each followed by the end."""
    hashes, bounds, _ = words(*text_buffer(part.column("text")))
    out = np.insert(hashes, bounds[1:], END)
    return out, bounds + np.arange(len(bounds))


def word_counts(docs: DataFrame) -> DataFrame:
    """``h, c``: the count of every token (words and ends) of ``docs``."""

    def make():
        def one(part: pa.RecordBatch) -> pa.RecordBatch:
            h, n = np.unique(_tokens(part)[0], return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "c"])
        return one

    return (map_text(docs.select("text"), "text", make, "h long, c long", SLICE_BYTES)
            .groupBy("h").agg(F.sum("c").alias("c")))


@dataclass
class Lexicon:
    """The numbered words by falling count, with a place table for their hashes."""

    hashes: np.ndarray
    counts: np.ndarray
    total: int
    types: int

    def __post_init__(self):
        bits = max(4, int(2 * len(self.hashes) + 1).bit_length())
        self.shift = U(64 - bits)
        self.place = np.full(1 << bits, -1, np.int32)
        slots = mix(self.hashes, 1) >> self.shift
        self.place[slots[::-1]] = np.arange(len(self.hashes), dtype=np.int32)[::-1]
        self.order = np.argsort(self.hashes)
        self.sorted = self.hashes[self.order]

    def numbers(self, h: np.ndarray) -> np.ndarray:
        """The number of each hash, ``len(hashes)`` for any other word."""
        none = len(self.hashes)
        if not none:
            return np.zeros(len(h), np.int32)
        got = self.place[mix(h, 1) >> self.shift]
        wrong = np.flatnonzero((got < 0) | (self.hashes[np.maximum(got, 0)] != h))
        at = np.minimum(np.searchsorted(self.sorted, h[wrong]), none - 1)
        got[wrong] = np.where(self.sorted[at] == h[wrong], self.order[at], none)
        return got


def lexicon(counts: DataFrame, numbered: int = NUMBERED) -> Lexicon:
    """The most frequent words, up to ``numbered``, cut where the count falls below a power of
    2 ** (1/16); all other words stay in ``counts``."""
    step = F.floor(F.log2("c") * 16)
    bins = sorted(((r["s"], r["types"], r["n"]) for r in counts.groupBy(step.alias("s")).agg(
        F.count(F.lit(1)).alias("types"), F.sum("c").alias("n")).collect()), reverse=True)
    least, have = None, 0
    for s, types, _ in bins:
        if have + types > numbered:
            break
        least, have = s, have + types
    if least is None:
        return Lexicon(np.zeros(0, U), np.zeros(0, np.int64), sum(b[2] for b in bins), sum(b[1] for b in bins))
    found = counts.where(step >= least).toArrow()
    h, c = found["h"].to_numpy().view(U), found["c"].to_numpy()
    order = np.lexsort((h, -c))
    return Lexicon(h[order], c[order], sum(b[2] for b in bins), sum(b[1] for b in bins))


def encode(docs: DataFrame, lex: Lexicon) -> DataFrame:
    """``doc_id, held_out, row, ids, rest``: every text as word numbers, written once to the
    shared folder; ``rest`` has the hashes of the words without a number."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(lex)

    def make():
        lex_ = shared.value

        def one(part: pa.RecordBatch) -> pa.RecordBatch:
            h, bounds = _tokens(part)
            ids = lex_.numbers(h)
            other = ids == len(lex_.hashes)
            cuts = np.concatenate([[0], np.cumsum(other)])[bounds]
            return pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"),
                 pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids)),
                 pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(h[other].view(np.int64)))],
                ["doc_id", "held_out", "ids", "rest"])
        return one

    path = shared_path(spark, "maxent") + "/encoded"
    (map_text(docs, "text", make, "doc_id long, held_out boolean, ids array<int>, rest array<long>", SLICE_BYTES)
     .withColumn("row", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path))
    return spark.read.parquet(path)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(flat values, bounds) of a list column."""
    off = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy()[off[0]:off[-1]], off - off[0]


def _pieces(batch: pa.RecordBatch, most: int = BATCH):
    """Whole texts of a batch with ``most`` tokens at most, or one text: the arrays made from them
    do not grow with the rows that Spark puts in a batch."""
    size = batch.column("ids").offsets.to_numpy().astype(np.int64)
    a = 0
    while a < batch.num_rows:
        z = max(a + 1, int(np.searchsorted(size, size[a] + most, side="right")) - 1)
        yield batch.slice(a, z - a)
        a = z


def _contexts(ids: np.ndarray, rest: np.ndarray, none: int) -> np.ndarray:
    """What a word is as a context: its number, or its hash if it has none."""
    out = ids.astype(U)
    out[ids == none] = mix(rest.view(U), 9) | U(1 << 63)
    return out


def _tasks(encoded: DataFrame) -> int:
    """Tasks that gather counts: a few for each core, as each sends a whole table."""
    return 2 * max(encoded.sparkSession.sparkContext.defaultParallelism, 1)


def _over(encoded: DataFrame, fold, finish, schema: str) -> DataFrame:
    """``finish`` of what ``fold`` has gathered over all batches of a task."""
    ship(encoded.sparkSession)
    narrow = encoded.select("ids", "rest").coalesce(_tasks(encoded))

    def run(batches):
        state = None
        for b in batches:
            for part in _pieces(b):
                state = fold(state, *_lists(part.column("ids")), _lists(part.column("rest"))[0])
        if state is not None:
            yield from finish(state)

    return narrow.mapInArrow(run, schema)


# ------------------------------------------------------------------ classes
def neighbour_counts(encoded: DataFrame, words_: int) -> np.ndarray:
    """(words, 2 * NEIGHBOURS): how often each clustered word follows and precedes each of the
    most frequent words."""
    wide = 2 * NEIGHBOURS

    def fold(state, ids, bounds, _):
        state = np.zeros(words_ * wide, np.int64) if state is None else state
        first = np.zeros(len(ids), bool)
        first[bounds[:-1][np.diff(bounds) > 0]] = True
        second = np.flatnonzero(~first[1:]) + 1
        before, after = ids[second - 1].astype(np.int64), ids[second].astype(np.int64)
        a = (before < NEIGHBOURS) & (after < words_)
        b = (after < NEIGHBOURS) & (before < words_)
        key = np.concatenate([after[a] * wide + before[a], before[b] * wide + NEIGHBOURS + after[b]])
        at, n = np.unique(key, return_counts=True)
        state[at] += n
        return state

    def finish(state):
        at = np.flatnonzero(state)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(state[at])], ["k", "n"])

    found = _over(encoded, fold, finish, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(words_ * wide, np.float32)
    out[found["k"].to_numpy()] = found["n"].to_numpy()
    return out.reshape(words_, wide)


def cluster(near: np.ndarray, counts: np.ndarray, classes: int, rounds: int = 12) -> np.ndarray:
    """The class of each word: k-means of the square roots of its neighbour shares, weighted by
    the root of its count, from centres far from each other."""
    x = np.sqrt(near / np.maximum(near.sum(axis=1, keepdims=True), 1))
    weight = np.sqrt(counts.astype(np.float64))
    pick, far = [0], None
    some = np.arange(min(len(x), 2048))
    while len(pick) < min(classes, len(some)):
        d = ((x[some] - x[pick[-1]]) ** 2).sum(axis=1)
        far = d if far is None else np.minimum(far, d)
        pick.append(int((far * weight[some]).argmax()))
    centres = x[pick].copy()
    of = np.zeros(len(x), np.int64)
    for _ in range(rounds):
        of = ((centres ** 2).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)
        for c in np.unique(of):
            m = of == c
            centres[c] = (x[m] * weight[m, None]).sum(axis=0) / weight[m].sum()
    return of


@dataclass
class Model:
    """``klass`` and ``bin_`` of each number (the last entry stands for words without one),
    ``share``: log10 of a word's share of its bin, and the two weight tables (a row for each
    hashed feature)."""

    klass: np.ndarray
    bin_: np.ndarray
    share: np.ndarray
    rest: float
    weights: list[np.ndarray]

    def features(self, a: np.ndarray, b: np.ndarray, kind: np.ndarray, klass: np.ndarray) -> list[list[np.ndarray]]:
        """The feature rows of both softmaxes from the contexts one and two before and the class and bin
        (``kind``) of the one before; row 0 (rows 0 to CLASSES - 1) is the bias."""
        pairs = U(len(self.weights[0]) // PAIRS)                 # the last rows
        words_ = U(len(self.weights[0]) - CLASSES) - pairs
        with np.errstate(over="ignore"):
            two = mix(a * U(0x9E3779B97F4A7C15) + b, 2)
            skip = mix(b, 3)
            one = mix(a, 1)
            k = klass.astype(U) << U(3)
            word = lambda h: (U(CLASSES) + (h >> U(20)) % words_).astype(np.int64)
            pair = lambda h: (U(CLASSES) + words_ + (h >> U(20)) % pairs).astype(np.int64)
            near = kind.astype(U)
            return [[np.zeros(len(a), np.int64), word(one), pair(two), word(skip), word(mix(near, 6))],
                    [klass.astype(np.int64), word(mix(one + k, 4)), pair(mix(two + k, 5)), word(mix((near << U(8)) + k, 7))]]

    def batches(self, ids: np.ndarray, bounds: np.ndarray, rest: np.ndarray):
        """(first, last, feature rows, class, bin) of batches of tokens."""
        first = np.zeros(len(ids), bool)
        first[bounds[:-1][np.diff(bounds) > 0]] = True
        before = U(0xFFFFFFFFFFFFFFFF)          # the context before a text
        at = _contexts(ids, rest, len(self.klass) - 1)
        p1 = np.full(len(ids), before)
        p1[1:] = np.where(first[1:], before, at[:-1])
        p2 = np.full(len(ids), before)
        p2[1:] = np.where(first[1:], before, p1[:-1])
        kind = np.full(len(ids), CLASSES * BINS, np.int64)
        kind[1:] = np.where(first[1:], CLASSES * BINS, self.klass[ids[:-1]] * np.int64(BINS) + self.bin_[ids[:-1]])
        for a in range(0, len(ids), BATCH):
            z = slice(a, a + BATCH)
            k = self.klass[ids[z]]
            yield a, min(a + BATCH, len(ids)), self.features(p1[z], p2[z], kind[z], k), k, self.bin_[ids[z]]

    def softmax(self, level: int, rows: list[np.ndarray]) -> np.ndarray:
        s = np.take(self.weights[level], rows[0], axis=0)
        for r in rows[1:]:
            s += np.take(self.weights[level], r, axis=0)
        if len(s) and s.max() < SAFE:
            p = np.exp(s)
            total = np.einsum("ij->i", p)
            if total.min() > math.exp(-SAFE):
                p /= total[:, None]
                return p
        # a sum beyond the exponential's range: from the largest of each row
        s -= s.max(axis=1, keepdims=True)
        np.exp(s, out=s)
        s /= s.sum(axis=1, keepdims=True)
        return s


def width(tokens: int) -> int:
    """Words with a class, and feature rows of a table, for so many training tokens."""
    want = GROWTH * math.isqrt(max(tokens, 1))
    return min(max(1 << (want - 1).bit_length(), LEAST), MOST)


def initial(lex: Lexicon, klass: np.ndarray, rows: int = LEAST) -> Model:
    """The model without context: classes and bins by their share of the counts."""
    words_ = len(klass)
    none = len(lex.hashes)
    last = CLASSES - 1
    of = np.full(none + 1, last, np.int16)
    bins = np.zeros(none + 1, np.int16)
    of[:words_] = klass
    for c in range(last):
        m = np.flatnonzero(klass == c)
        if len(m):
            root = np.sqrt(lex.counts[m].astype(np.float64))
            bins[m] = np.minimum(np.cumsum(root) - root, root.sum() * (1 - 1e-9)) / root.sum() * BINS
    mass = np.append(lex.counts + SMOOTH, 0.0)
    in_bin = np.zeros((CLASSES, BINS))
    np.add.at(in_bin, (of, bins), mass)
    everything = lex.total + SMOOTH * (lex.types + 1)
    # All words outside the classes, the unknown one among them.
    in_bin[last] = 0
    in_bin[last, 0] = everything - in_bin.sum()
    with np.errstate(divide="ignore"):
        share = np.log10(mass) - np.log10(in_bin[of, bins])
        first = np.zeros((rows, CLASSES), np.float32)
        first[0] = np.maximum(np.log(in_bin.sum(axis=1) / everything), -1e9)
        second = np.zeros((rows, BINS), np.float32)
        second[:CLASSES] = np.maximum(np.log(in_bin / np.maximum(in_bin.sum(axis=1, keepdims=True), 1e-300)), -1e9)
    return Model(of, bins, np.where(np.isfinite(share), share, 0.0), math.log10(in_bin[last, 0]), [first, second])


# ------------------------------------------------------------------ training
_PIECE = 1024


def _packed(x: np.ndarray) -> bytes:
    """32-bit floats, byte plane by byte plane: whole numbers and exponents shrink in the shuffle."""
    return x.astype("<f4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).reshape(-1).view("<f4")


def _sum_tree(parts: DataFrame, tasks: int) -> DataFrame:
    """Sums of the arrays of a piece: first within groups of at most 32 tasks, then over the
    groups."""

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(_PIECE)
        for raw in table["data"]:
            total += _unpacked(raw.as_py())
        return pa.table({"piece": table["piece"][:1], "data": pa.array([_packed(total)], pa.binary())})

    schema = "piece long, data binary"
    if tasks > 32:
        groups = F.pmod("task", F.lit(-(-tasks // 32)))
        parts = parts.groupBy("piece", groups.alias("group")).applyInArrow(add, schema)
    return parts.groupBy("piece").applyInArrow(add, schema)


def gather(encoded: DataFrame, model: Model, expected: bool) -> tuple[list[np.ndarray], float]:
    """Observed (or, under the model, expected) counts of every weight, from all tasks; and, with the
    expected ones, the log likelihood of all classes and bins."""
    spark = encoded.sparkSession
    shared = spark.sparkContext.broadcast(model)
    sizes, height = (CLASSES, BINS), len(model.weights[0])

    def fold(state, ids, bounds, rest):
        m = shared.value
        if state is None:                  # one array: all tables and, in the last row, the likelihood
            state = np.zeros((sum(sizes) * height // _PIECE + 1, _PIECE))
        tables = np.split(state[:-1].reshape(-1), [sizes[0] * height])
        for _, _, rows, k, b in m.batches(ids, bounds, rest):
            for level, target in enumerate((k, b)):
                at = rows[level]
                if level:
                    # the last class has one bin
                    on = np.flatnonzero(k < CLASSES - 1)
                    at, target = [r[on] for r in at], target[on]
                if not len(target):
                    continue
                if expected:
                    p = m.softmax(level, at)
                    state[-1, 0] += np.log(np.maximum(p[np.arange(len(target)), target], 1e-30)).sum()
                    for c in range(sizes[level]):
                        column = p[:, c].astype(np.float64)
                        for r in at[1:]:
                            np.add.at(tables[level][c * height:(c + 1) * height], r, column)
                else:
                    for r in at[1:]:
                        np.add.at(tables[level], target.astype(np.int64) * height + r, 1.0)
        return state

    def finish(flat):
        task = TaskContext.get().partitionId()
        some = np.flatnonzero(flat.any(axis=1))
        for a in range(0, len(some), 256):
            at = some[a:a + 256]
            yield pa.RecordBatch.from_arrays(
                [pa.array(at), pa.array(np.full(len(at), task)), pa.array([_packed(flat[i]) for i in at], pa.binary())],
                ["piece", "task", "data"])

    parts = _over(encoded, fold, finish, "piece long, task long, data binary")
    found = _sum_tree(parts, _tasks(encoded)).toArrow()
    out = np.zeros(((CLASSES + BINS) * height // _PIECE + 1, _PIECE), np.float32)
    for i, raw in zip(found["piece"].to_pylist(), found["data"]):
        out[i] = _unpacked(raw.as_py())
    likelihood = float(out[-1, 0])
    out = out[:-1].reshape(CLASSES + BINS, height)
    shared.unpersist()
    return [out[:CLASSES].T, out[CLASSES:].T], likelihood


def _update(model: Model, observed: list[np.ndarray], expected: list[np.ndarray], active: tuple[float, float],
            rate: float = 1.0) -> Model:
    """One step: each weight moves by the log of its smoothed counts' ratio over the number of
    active features. The weight's prior counts on the other side, ``PRIOR`` for each unit of it."""
    new = []
    for w, o, e, n in zip(model.weights, observed, expected, active):
        o, e = o + PRIOR * np.maximum(-w, 0), e + PRIOR * np.maximum(w, 0)
        step = np.log((o + ALPHA * 0.1) / (e + ALPHA * 0.1)) * (o + e) / (o + e + ALPHA) * (rate / n)
        step[:CLASSES] = 0
        new.append(np.ascontiguousarray(w + step.astype(np.float32)))
    return Model(model.klass, model.bin_, model.share, model.rest, new)


def train(encoded: DataFrame, lex: Lexicon, updates: int = UPDATES, trace: list | None = None) -> Model:
    """Fit the model on the texts of ``encoded``: at most ``updates`` updates after the first, which
    end when the likelihood settles. ``trace`` gets the log10 likelihood of a token before each."""
    rows = width(lex.total)
    words_ = min(rows, len(lex.hashes))
    if not words_:
        return initial(lex, np.zeros(0, np.int64))
    klass = cluster(neighbour_counts(encoded, words_), lex.counts[:words_], CLASSES - 1)
    model = initial(lex, klass, rows)
    observed, _ = gather(encoded, model, expected=False)
    # Without context a row's expected counts are its own total times the bias shares; rows
    # of the second table hold one class's events, up to hash collisions.
    prior = [np.exp(model.weights[0][0])[None, :], None]
    total = [o.sum(axis=1, keepdims=True) for o in observed]
    overall = observed[1].sum(axis=0, keepdims=True)
    prior[1] = overall / max(float(overall.sum()), 1.0)
    expected = [t * p for t, p in zip(total, prior)]
    model = _update(model, observed, expected, (3.0, 2.0))
    best, had, rate = None, -math.inf, RATE
    for _ in range(updates):
        expected, likelihood = gather(encoded, model, expected=True)
        now = likelihood / max(lex.total, 1) / math.log(10)
        if trace is not None:
            trace.append(now)
        if now < had:                 # too far: again from the best model, with half the step
            rate /= 2
            model, expected = best
        elif now - had < TOLERANCE:
            break
        else:
            best, had = (model, expected), now
        model = _update(model, observed, expected, (4.0, 3.0), rate)
    return model


# ------------------------------------------------------------------ scoring
def token_log10(model: Model, ids: np.ndarray, bounds: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """log10 P(class, bin | context) of every token; ``rest``: hashes of those without a number."""
    out = np.zeros(len(ids))
    for a, b, rows, k, bin_ in model.batches(ids, bounds, rest):
        p = model.softmax(0, rows[0])
        v = np.log10(np.maximum(p[np.arange(len(k)), k], 1e-30))
        on = np.flatnonzero(k < CLASSES - 1)
        if len(on):
            q = model.softmax(1, [r[on] for r in rows[1]])
            v[on] += np.log10(np.maximum(q[np.arange(len(on)), bin_[on]], 1e-30))
        out[a:b] = v
    return out


def score(encoded: DataFrame, counts: DataFrame, lex: Lexicon, model: Model) -> DataFrame:
    """Every text's tokens, known tokens, base score and score."""
    spark = encoded.sparkSession
    ship(spark)
    floor = math.log10(lex.total + SMOOTH * (lex.types + 1))
    base = np.append(np.log10(lex.counts + SMOOTH) - floor, 0.0)
    shared = spark.sparkContext.broadcast((model, base))

    def run(batches):
        m, base_ = shared.value
        none = len(base_) - 1
        for b in (part for whole in batches for part in _pieces(whole)):
            ids, bounds = _lists(b.column("ids"))
            value = token_log10(m, ids, bounds, _lists(b.column("rest"))[0])
            value += np.where(ids == none, 0.0, m.share[ids])
            sums = [np.add.reduceat(x, bounds[:-1]) for x in (value, base_[ids], (ids < none).astype(np.int64))]
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("doc_id"), b.column("held_out"), pa.array(np.diff(bounds)),
                 pa.array(sums[2]), pa.array(sums[1]), pa.array(sums[0])],
                ["row", "doc_id", "held_out", "n_tokens", "numbered", "base", "model"])

    # a text has at least its end, so no sum is empty
    scored = encoded.select("row", "doc_id", "held_out", "ids", "rest").mapInArrow(
        run, "row long, doc_id long, held_out boolean, n_tokens long, numbered long, base double, model double")
    # Words without a number: their counts by a join, each distinct word of a text once.
    rest = (encoded.where(F.size("rest") > 0).select("row", F.explode("rest").alias("h"))
            .groupBy("row", "h").agg(F.count(F.lit(1)).alias("tf")).join(counts, "h", "left")
            .withColumn("c", F.coalesce("c", F.lit(0))))
    more = rest.groupBy(F.col("row").alias("_row")).agg(
        F.sum(F.col("tf") * F.log10(F.col("c") + SMOOTH)).alias("logs"), F.sum("tf").alias("others"),
        F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("known"))
    zero = F.lit(0)
    logs, others = F.coalesce("logs", F.lit(0.0)), F.coalesce("others", zero)
    return scored.join(more, F.col("row") == F.col("_row"), "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("numbered") + F.coalesce("known", zero)).alias("n_known"),
        F.lit(lex.total).cast("long").alias("train_tokens"),
        (F.col("base") + logs - others * F.lit(floor)).alias("base_score"),
        (F.col("model") + logs - others * F.lit(model.rest)).alias("score"))


def score_documents(docs: DataFrame, held_out: F.Column, *, id_col: str = "doc_id", text_col: str = "text",
                    updates: int = UPDATES) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row,
    learned from the rows that are not held out.

    A null or empty text has one token, its end. Null ids are kept; repeated rows are scored
    alike; other columns are ignored; without training rows every word is the unknown one and
    has probability 1; an empty table gives no rows. Texts are scored whole.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.coalesce(held_out, F.lit(False)).alias("held_out"))
    counts = cut(word_counts(rows.where("NOT held_out")))
    lex = lexicon(counts)
    encoded = encode(rows, lex)
    model = train(encoded.where("NOT held_out"), lex, updates)
    return score(encoded, counts, lex, model)
