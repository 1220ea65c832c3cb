"""Toxicity by classifier chains over hashed word features.

Categories are predicted one after the other; each link is a linear model that sees the text's features and the
probabilities of the categories before it. While fitting, those probabilities are out-of-fold: each row's come from a model
for which neither its label nor its text was used, so that a later link learns from predictions as good as it will meet.

Categories: ``toxic`` (the label), ``severe`` (toxic, and at least SEVERE of the words are strongly toxic) and ``spread``
(toxic in more than one line). There are no labels for the last two: they are derived from labelled texts by
the words that occur in toxic texts far more often than in others, so the later links predict a finer form of what the first does.

Features of a text are the distinct words and word beginnings it holds, hashed. Beginnings
catch words in inflected forms that the sample never held. A link weighs every bucket that a sample text holds, with a ridge that keeps what
says little small (it grows as log-odds fall), and three sums over the buckets' log-odds (the strongest, those clearly and those far above chance).

The sample is bounded by TRAIN_ROWS rows of a class. Its texts stay on the executors, where counts of buckets, inputs and
gradients are summed and turned into steps; what reaches the driver is a few numbers for each sample row and each counted bucket.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import ALNUM, Words, blocks, labelled, lists, mix, packed, present, small_batches, stored, text_of

#: Labelled rows of each class that are fitted on, those with the smallest id hashes.
TRAIN_ROWS = 4000
BUCKETS = 1 << 20
STEMS = (4, 5, 6, 7, 8)
FOLDS = 4
#: Gradient steps on the weights of buckets, and their size.
STEPS, RATE, RIDGE = 4, 0.1, 0.5
#: How fast the ridge grows as a bucket's log-odds fall below CLEAR.
FADE = 8
#: Buckets whose gradients are added up in one place.
BLOCK = 1 << 15
#: Log-odds that are clearly and far above chance.
CLEAR, FAR, STRONG = 1.5, 4.0, 3.0
#: Parts that the sample is dealt into.
PARTS = 6
SEVERE = 0.02
THRESHOLD = 0.5
CATEGORIES = ("toxic", "severe", "spread")


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket) pairs, distinct and sorted by row, and the number of words of each row."""
    rows, buckets, words = [], [], []
    for first, _, data, at in blocks(column):
        w = Words(data, at, ALNUM)
        h = w.hashes()
        words.append(w.count)
        size = w.end - w.start
        parts = [(w.doc, h)]
        for k in STEMS:
            long_ = size > k
            if not long_.any():
                continue
            code = np.zeros(int(long_.sum()), dtype=np.uint64)
            for j in range(k):
                code = (code << np.uint64(8)) | w._b[w.start[long_] + j].astype(np.uint64)
            parts.append((w.doc[long_], mix(code ^ mix(np.full(1, k, dtype=np.uint64)))))
        row = np.concatenate([p[0] for p in parts])
        bucket = np.concatenate([p[1] for p in parts]) % np.uint64(BUCKETS)
        pair = np.unique(row.astype(np.uint64) * np.uint64(BUCKETS) + bucket)
        rows.append((pair // np.uint64(BUCKETS)).astype(np.int64) + first)
        buckets.append((pair % np.uint64(BUCKETS)).astype(np.int64))
    if not rows:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(rows), np.concatenate(buckets), np.concatenate(words)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def sums_of(e: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """For each row the strongest log-odds and the sums of what is clearly and far above chance."""
    top = np.zeros(n)
    np.maximum.at(top, row, e)
    above = lambda least: np.log1p(np.bincount(row, weights=np.maximum(e - least, 0), minlength=n))
    return np.stack([top, above(CLEAR), above(FAR)], axis=1)


@dataclass
class Linear:
    """A link: log-odds and weight of each bucket, weights of (bias, the three sums, earlier probabilities)."""

    evidence: np.ndarray  # float32, one a bucket
    own: np.ndarray  # float32, one a bucket
    weights: np.ndarray

    def __getstate__(self) -> tuple:
        """Only buckets with log-odds travel."""
        at = np.flatnonzero((self.evidence != 0) | (self.own != 0)).astype(np.int32)
        return at, self.evidence[at], self.own[at], self.weights

    def __setstate__(self, state: tuple) -> None:
        at, evidence, own, self.weights = state
        self.evidence, self.own = np.zeros(BUCKETS, np.float32), np.zeros(BUCKETS, np.float32)
        self.evidence[at], self.own[at] = evidence, own

    def probability(self, row: np.ndarray, bucket: np.ndarray, n: int, earlier: np.ndarray) -> np.ndarray:
        x = np.concatenate([np.ones((n, 1)), sums_of(self.evidence[bucket], row, n), earlier], axis=1)
        return sigmoid(x @ self.weights + np.bincount(row, weights=self.own[bucket], minlength=n))


def log_odds(yes: np.ndarray, no: np.ndarray, n_yes: float, n_no: float) -> np.ndarray:
    """Of buckets between the classes by document counts, shrunk where they are few."""
    odds = np.log((yes + 0.25) / (max(n_yes, 1.0) + 0.5)) - np.log((no + 0.25) / (max(n_no, 1.0) + 0.5))
    return (odds * (yes + no) / (yes + no + 4.0)).astype(np.float32)


def _newton(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (weight * (y - p)) - ridge * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-7:
            break
    return w


@dataclass
class Counts:
    """Sample texts of each fold and class (no, yes) that hold each counted bucket, and all texts of each."""

    bucket: np.ndarray
    held: np.ndarray  # buckets x FOLDS x 2
    rows: np.ndarray  # FOLDS x 2
    _made: dict = field(default_factory=dict)

    def part(self, start: int, end: int) -> Counts:
        return Counts(self.bucket[start:end], self.held[start:end], self.rows)

    def without(self, *folds: int) -> np.ndarray:
        """Log-odds of the counted buckets from all folds but these, worked out once."""
        use = tuple(f for f in range(FOLDS) if f not in folds)
        if use not in self._made:
            held, rows = self.held[:, use].sum(axis=1, dtype=np.int64), self.rows[list(use)].sum(axis=0)
            self._made[use] = log_odds(held[:, 1], held[:, 0], float(rows[1]), float(rows[0]))
        return self._made[use]


def _fold(ids: pa.Array) -> np.ndarray:
    """A fold for each id, by its text."""
    return np.array([zlib.crc32(i.encode()) % FOLDS for i in ids.to_pylist()], dtype=np.int64)


def sample_rows(found: DataFrame) -> DataFrame:
    """``doc_id`` (as text), y, fold and x (buckets) of the sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, bucket, _ = features(b.column("_text"))
            x = lists(bucket.astype(np.int32), np.bincount(row, minlength=b.num_rows), pa.int32())
            ids = b.column("doc_id").cast(pa.string())
            yield pa.RecordBatch.from_arrays([ids, b.column("y"), pa.array(_fold(ids).astype(np.int32)), x], names=["doc_id", "y", "fold", "x"])

    return found.mapInArrow(run, "doc_id string, y int, fold int, x array<int>")


def bucket_counts(rows: DataFrame, y: str = "y") -> Counts:
    """Counted by Spark; at most BUCKETS rows reach the driver."""
    cells = [(f, c) for f in range(FOLDS) for c in (0, 1)]
    each = [F.count_if((F.col("fold") == f) & (F.col(y) == c)).cast("int") for f, c in cells]
    held = rows.select("fold", y, F.explode("x").alias("bucket")).groupBy("bucket").agg(*[e.alias(f"c{i}") for i, e in enumerate(each)])
    got = held.toArrow().sort_by("bucket")
    total = rows.agg(*each).first()
    columns = np.stack([got.column(f"c{i}").to_numpy() for i in range(len(cells))], axis=1)
    least = np.min_scalar_type(int(columns.max(initial=0)))  # two bytes for samples of the usual size
    return Counts(got.column("bucket").to_numpy().astype(np.int32), columns.astype(least).reshape(-1, FOLDS, 2), np.array(total, dtype=np.int64).reshape(FOLDS, 2))


def _known(bucket: np.ndarray, all_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the counted ones of these buckets, and which they are."""
    at = np.minimum(np.searchsorted(all_, bucket), max(len(all_) - 1, 0))
    keep = all_[at] == bucket if len(all_) else np.zeros(len(bucket), bool)
    return np.flatnonzero(keep), at[keep]


def _pairs(x: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    size = x.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return np.repeat(np.arange(len(x)), size), x.flatten().to_numpy().astype(np.int64)


def _each_row(rows: DataFrame, work, kind: str) -> pa.Table:
    """``work(batch) -> list of arrays`` beside the id of each sample row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = work(b)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), lists(values.ravel(), np.full(len(values), values.shape[1]), pa.float64())], names=["doc_id", "v"])

    return rows.mapInArrow(run, f"doc_id string, v {kind}").toArrow().sort_by("doc_id")


def _step(table: pa.Table, own: np.ndarray, counts: Counts) -> pa.Table:
    """How far the weights of one block of buckets move: its gradients are added up in the order of the parts that they come from."""
    table = table.sort_by("part")
    block = table.column("block").slice(0, 1)
    start = block[0].as_py() * BLOCK
    models = own.shape[1]
    total = sum(np.frombuffer(x, np.float32) for x in table.column("g").to_pylist())
    g, h = total.reshape(2, -1, models).astype(np.float64)
    mine, own = counts.part(start, start + len(g)), own[start : start + len(g)]
    odds = np.abs(np.stack([mine.without(m) for m in range(models)], axis=1))
    ridge = RIDGE * np.maximum(1.0, CLEAR / np.maximum(odds, 1e-2)) ** FADE
    return pa.table({"block": block, "step": pa.array([(RATE * (g + ridge * own) / (h + 1 + ridge)).astype(np.float32).tobytes()], pa.binary())})


def _stepper(state, held):
    """``_step`` of a table alone, with the broadcast weights and counts."""
    return lambda table: _step(table, state.value, held.value)


def fit_link(rows: DataFrame, goal: np.ndarray, fold: np.ndarray, counts: Counts, earlier: np.ndarray, weight: np.ndarray, ids: list[str]) -> tuple[Linear, np.ndarray]:
    """One model of the chain, fitted on all rows, and the out-of-fold probabilities.

    Models 0 to FOLDS - 1 leave a fold out, the last none. A row's sums for a model come from the log-odds of all folds but its own and
    the one that the model leaves out. ``goal``, ``fold``, ``earlier`` and ``weight`` are in the order of ``ids``.
    """
    sc = rows.sparkSession.sparkContext
    models = FOLDS + 1
    held = sc.broadcast(replace(counts, _made={}))

    def inputs(b: pa.RecordBatch) -> np.ndarray:
        c, own = held.value, b.column("fold").to_numpy()
        row, bucket = _pairs(b.column("x"))
        place, k = _known(bucket, c.bucket)
        row = row[place]
        out = np.zeros((b.num_rows, models, 3))
        for m in range(models):
            for f in np.unique(own):
                mine = own[row] == f
                part = sums_of(c.without(m, int(f))[k[mine]], row[mine], b.num_rows)
                out[own == f, m] = part[own == f]
        return out.reshape(b.num_rows, -1)

    sums = np.stack(_each_row(rows, inputs, "array<double>").column("v").to_numpy()).reshape(-1, models, 3)
    n = len(goal)
    base, dense = np.zeros((n, models)), []
    for m in range(models):
        x = np.concatenate([np.ones((n, 1)), sums[:, m], earlier], axis=1)
        use = fold != m
        dense.append(_newton(x[use], goal[use], weight[use]))
        base[:, m] = x @ dense[m]
    # weights of single buckets, by gradients that the executors sum and turn into steps
    own = np.zeros((len(counts.bucket), models), np.float32)
    given = sc.broadcast((base, goal, fold, weight, {x: i for i, x in enumerate(ids)}))
    for _ in range(STEPS):
        state = sc.broadcast(own)

        def gradient(batches: Iterator[pa.RecordBatch], state=state) -> Iterator[pa.RecordBatch]:
            w, (z, y, f, wt, where), weighed = state.value, given.value, held.value.bucket
            g = np.zeros((2, *w.shape))  # first and second derivatives
            for b in batches:
                i = np.array([where[x] for x in b.column("doc_id").to_pylist()], dtype=np.int64)
                row, bucket = _pairs(b.column("x"))
                place, k = _known(bucket, weighed)
                row = row[place]
                for m in range(models):
                    p = sigmoid(z[i, m] + np.bincount(row, weights=w[k, m], minlength=len(i)))
                    r = wt[i] * (p - y[i]) * (f[i] != m)
                    g[0, :, m] += np.bincount(k, weights=r[row], minlength=len(w))
                    g[1, :, m] += np.bincount(k, weights=(wt[i] * p * (1 - p) * (f[i] != m))[row], minlength=len(w))
            part, starts = TaskContext.get().partitionId(), range(0, len(w), BLOCK)
            parts = [g[:, a : a + BLOCK].astype(np.float32).tobytes() for a in starts]
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(parts), pa.int64()), pa.array(range(len(parts)), pa.int64()), pa.array(parts, pa.binary())], names=["part", "block", "g"])

        added = rows.coalesce(PARTS).mapInArrow(gradient, "part long, block long, g binary").groupBy("block")
        got = added.applyInArrow(_stepper(state, held), "block long, step binary").toArrow()
        state.destroy()
        for block, step in zip(got.column("block").to_pylist(), got.column("step"), strict=True):
            at = own[block * BLOCK : (block + 1) * BLOCK]
            at -= np.frombuffer(step.as_buffer(), np.float32).reshape(at.shape)
        del got
    final = sc.broadcast(own)

    def left_out(b: pa.RecordBatch) -> np.ndarray:
        row, bucket = _pairs(b.column("x"))
        place, k = _known(bucket, held.value.bucket)
        row = row[place]
        return np.bincount(row, weights=final.value[k, b.column("fold").to_numpy()[row]], minlength=b.num_rows)[:, None]

    oof = sigmoid(base[np.arange(n), fold] + np.concatenate(_each_row(rows, left_out, "array<double>").column("v").to_numpy()))
    evidence, mine = np.zeros(BUCKETS, np.float32), np.zeros(BUCKETS, np.float32)
    evidence[counts.bucket], mine[counts.bucket] = counts.without(), own[:, FOLDS]
    for x in (held, given, final):
        x.destroy()
    return Linear(evidence, mine, dense[FOLDS]), oof


@dataclass
class Chain:
    links: list[Linear] = field(default_factory=list)

    def probabilities(self, row: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
        p = np.zeros((n, 0))
        for link in self.links:
            p = np.concatenate([p, link.probability(row, bucket, n, p)[:, None]], axis=1)
        return p


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Chain:
    """The chain, fitted on at most ``rows`` labelled texts of each class.

    ``labels`` with several rows for an id count as toxic if any says so; null labels are left out. Of several texts of
    an id the smallest is taken; a null text counts as empty. Without toxic labels every probability is near 0.
    """
    small_batches(docs.sparkSession)
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))
    known = stored(present(known, docs), "toxic-labels")
    total = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    found = stored(labelled(docs, known, "y", rows).select("doc_id", F.coalesce("text", F.lit("")).alias("_text"), "y"), "toxic-texts")
    sample = stored(sample_rows(found), "toxic-rows")
    seen = sorted(sample.select("doc_id", "y", "fold").collect(), key=lambda r: r["doc_id"])
    ids, y, fold = [r["doc_id"] for r in seen], np.array([float(r["y"]) for r in seen]), np.array([r["fold"] for r in seen], dtype=np.int64)
    n = len(y)
    if not n or y.min() == y.max():
        blank = np.zeros(BUCKETS, np.float32)
        return Chain([Linear(blank, blank, np.array([-6.0 if not n or y.max() == 0 else 6.0] + [0.0] * (3 + i))) for i in range(len(CATEGORIES))])
    counts = bucket_counts(sample)
    goals = _goals(found, counts.bucket[counts.without() > STRONG])
    goals = {r["doc_id"]: (r["severe"], r["spread"]) for r in goals.collect()}
    goals = [y, *[y * np.array([float(goals[i][k]) for i in ids]) for k in (0, 1)]]
    count = {v: (y == v).sum() for v in (0.0, 1.0)}
    weight = np.array([total.get(int(v), 1) / count[v] for v in y])
    weight *= n / weight.sum()
    chain, earlier = Chain(), np.zeros((n, 0))
    for i, goal in enumerate(goals):
        if i:
            of = docs.sparkSession.createDataFrame([(d, int(g)) for d, g in zip(ids, goal, strict=True)], "doc_id string, goal int")
            counts = bucket_counts(sample.join(F.broadcast(of), "doc_id"), "goal")  # a row for each sample row
        link, oof = fit_link(sample, goal, fold, counts, earlier, weight, ids)
        chain.links.append(link)
        earlier = np.concatenate([earlier, oof[:, None]], axis=1)
    return chain


def _goals(found: DataFrame, strong: np.ndarray) -> DataFrame:
    """``doc_id`` (as text), severe, spread: what the strongly toxic buckets say of sample texts, whole and line by line."""
    held = found.sparkSession.sparkContext.broadcast(strong)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, bucket, words = features(b.column("_text"))
            hits = np.bincount(row[np.isin(bucket, held.value)], minlength=b.num_rows)
            lines = pa.array([[x for x in t.split("\n") if x] for t in b.column("_text").to_pylist()], pa.list_(pa.string()))
            flat = lines.flatten()
            row, bucket, _ = features(flat)
            toxic = np.zeros(len(flat), dtype=bool)
            toxic[row[np.isin(bucket, held.value)]] = True
            of = np.repeat(np.arange(b.num_rows), lines.value_lengths().to_numpy(zero_copy_only=False))
            spread = np.bincount(of[toxic], minlength=b.num_rows) > 1
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.string()), pa.array(hits / np.maximum(words, 1) >= SEVERE), pa.array(spread)], names=["doc_id", "severe", "spread"])

    return found.mapInArrow(run, "doc_id string, severe boolean, spread boolean")


def score(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` as ``_row`` with p_<category> for each category and ``toxic`` (0 or 1).

    Null and empty texts have no features; what they score follows from the bias alone. Repeated rows score alike, long texts are read
    whole, a probability at the threshold counts as toxic. An empty table gives an empty result. The input's columns stand in
    ``_row``, so their names cannot clash.
    """
    spark = docs.sparkSession
    small_batches(spark)
    held = spark.sparkContext.broadcast(chain)  # three models of two BUCKETS of float32 each
    rows = packed(docs)
    names = [f"p_{c}" for c in CATEGORIES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, bucket, _ = features(text_of(b))
            p = held.value.probabilities(row, bucket, b.num_rows)
            columns = [b.column("_row"), *[pa.array(p[:, i], pa.float64()) for i in range(len(names))], pa.array((p[:, 0] >= threshold).astype(np.int32), pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["_row", *names, "toxic"])

    return rows.mapInArrow(run, f"_row {rows.schema['_row'].dataType.simpleString()}, {', '.join(f'{c} double' for c in names)}, toxic int")
