"""Quality rules: gradient-boosted trees over document statistics.

Statistics of every whole text feed trees that are flattened into numpy node arrays and
walked for a whole batch at a time. Chosen features are monotonic: more symbols, repeats or
capitals can never raise a score. The trees are fitted here on a bounded labelled sample.
Two fixed base rules come first: too few words, or too much repetition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import SPACED, SPACES, Words, blocks, mix, packed, present, shingles, small_batches, sums_by_doc, text_of

MIN_WORDS, MAX_REPEAT = 50, 50
#: Labelled rows that the trees are fitted on, those with the smallest id hashes.
TRAIN_ROWS = 20_000
THRESHOLD = 0.5
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Feature and the direction in which it may move a score: -1 never up as it grows, 0 free.
FEATURES = (("log_words", 0), ("mean_word", 0), ("symbols_per_word", -1), ("dup_line_share", -1), ("repeat_share", -1), ("upper_share", -1), ("marks_per_word", -1), ("digit_share", -1), ("words_per_line", 0))
_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_MARKS = np.isin(np.arange(256), np.frombuffer(b"!?", np.uint8))
_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_DIGIT = (np.arange(256) >= 48) & (np.arange(256) <= 57)
_SPACE = np.isin(np.arange(256), np.frombuffer(SPACES, np.uint8))
_CASED = SPACED.copy()
_CASED[65:91] = np.arange(65, 91)  # these words keep their case


def _repeat_words(h: np.ndarray, w: Words) -> np.ndarray:
    """Words of each text in 3-word windows that the text holds twice or more."""
    n = len(h)
    if n < 3:
        return np.zeros(len(w.first) - 1, dtype=np.int64)
    s = shingles(h, 3)
    inside = w.doc[2:] == w.doc[:-2]
    key = mix(s ^ mix(w.doc[:-2].astype(np.uint64) + np.uint64(1)))
    at = np.flatnonzero(inside)
    order = at[np.argsort(key[at], kind="stable")]
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(n, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = twice.copy()
    covered[1:] |= twice[:-1]
    covered[2:] |= twice[:-2]
    return sums_by_doc(covered, w.first)


def _dup_lines(data: bytes) -> int:
    seen: set[bytes] = set()
    dup = 0
    for line in data.split(b"\n"):
        if line.strip(SPACES):
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    return dup


def statistics(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(rows x BASE as int64, rows x FEATURES as float64); null counts as empty."""
    base, feats = [], []
    for _, _, data, at in blocks(column):
        w = Words(data, at, _CASED)
        n = w.count.astype(np.int64)
        per = lambda flags, at=at: sums_by_doc(flags, at)
        lead = (data & 0xC0) != 0x80
        chars = per(lead & ~_SPACE[data])
        symbols, marks, upper, digit, breaks = (per(t[data]) for t in (_SYMBOLS, _MARKS, _UPPER, _DIGIT, np.arange(256) == 10))
        raw = data.tobytes()
        dup = np.array([_dup_lines(raw[at[i] : at[i + 1]]) if breaks[i] else 0 for i in range(len(n))], dtype=np.int64)
        repeat = _repeat_words(w.hashes(), w)
        base.append(np.stack([n, chars, symbols, dup, repeat], axis=1))
        one = np.maximum(n, 1)
        feats.append(np.stack([np.log1p(n), chars / one, symbols / one, dup / (breaks + 1), repeat / one, upper / np.maximum(chars, 1), marks / one, digit / np.maximum(chars, 1), n / (breaks + 1)], axis=1))
    if not base:
        return np.empty((0, len(BASE)), np.int64), np.empty((0, len(FEATURES)))
    return np.concatenate(base), np.concatenate(feats)


def base_failed(base: np.ndarray) -> np.ndarray:
    return (base[:, 0] < MIN_WORDS) | (100 * base[:, 4] > MAX_REPEAT * base[:, 0])


# ---------------------------------------------------------------- trees


@dataclass
class Trees:
    """All trees in flat arrays: leaves have feature -1; children of node i are left[i] and left[i] + 1."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    start: float
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                f = self.feature[node]
                inner = f >= 0
                go = x[rows, np.where(inner, f, 0)] > self.cut[node]
                node = np.where(inner, self.left[node] + go, node)
            out += self.value[node]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit_trees(x: np.ndarray, y: np.ndarray, direction: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 64, ridge: float = 1.0, least: int = 10) -> Trees:
    """Histogram boosting on the logistic loss; splits against a feature's direction are refused.

    Leaf bounds are passed down, so that the whole tree, not only each split, is monotonic.
    """
    p = np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99)
    start = float(np.log(p / (1 - p)))
    feature, cut, left, value, roots = [], [], [], [], []
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.empty(0) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    f_now = np.full(len(x), start)

    def leaf(g: float, h: float, lo: float, hi: float) -> float:
        return min(max(g / (h + ridge), lo), hi)

    for _ in range(rounds if len(set(y.tolist())) > 1 else 0):
        prob = 1 / (1 + np.exp(-f_now))
        grad, hess = y - prob, np.maximum(prob * (1 - prob), 1e-9)
        roots.append(len(feature))
        feature.append(-1), cut.append(0.0), left.append(0), value.append(0.0)
        work = [(len(feature) - 1, np.arange(len(x)), 0, -np.inf, np.inf)]
        while work:
            node, rows, level, lo, hi = work.pop()
            g, h = grad[rows].sum(), hess[rows].sum()
            value[node] = rate * leaf(g, h, lo, hi)
            best = (1e-6, None)
            for f in range(x.shape[1]) if level < depth and len(rows) >= 2 * least else ():
                k = len(cuts[f])
                if not k:
                    continue
                b = binned[rows, f]
                gl, hl, nl = (np.cumsum(np.bincount(b, weights=v, minlength=k + 1))[:-1] for v in (grad[rows], hess[rows], np.ones(len(rows))))
                ok = (nl >= least) & (len(rows) - nl >= least)
                wl, wr = np.clip(gl / (hl + ridge), lo, hi), np.clip((g - gl) / (h - hl + ridge), lo, hi)
                if direction[f]:
                    ok &= direction[f] * (wr - wl) >= 0
                gain = np.where(ok, gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge), -1)
                at = int(gain.argmax())
                if gain[at] > best[0]:
                    best = (gain[at], (f, at, wl[at], wr[at]))
            if best[1] is None:
                f_now[rows] += value[node]
                continue
            f, at, wl, wr = best[1]
            mid = (wl + wr) / 2
            feature[node], cut[node], left[node] = f, float(cuts[f][at]), len(feature)
            right = binned[rows, f] > at
            for side, part in ((0, rows[~right]), (1, rows[right])):
                feature.append(-1), cut.append(0.0), left.append(0), value.append(0.0)
                above = direction[f] and (direction[f] > 0) == bool(side)
                bounds = (lo, hi) if not direction[f] else (max(lo, mid), hi) if above else (lo, min(hi, mid))
                work.append((len(feature) - 1, part, level + 1, *bounds))
    return Trees(np.array(feature, np.int32), np.array(cut), np.array(left, np.int32), np.array(value), np.array(roots, np.int64), start, depth)


# ---------------------------------------------------------------- the operator


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Trees:
    """Trees fitted on at most ``rows`` labelled documents that pass the base rules.

    ``labels`` with several rows for an id count as good only if all say so; null labels are left out.
    Without both classes every text gets the share of good labels.
    """
    small_batches(docs.sparkSession)
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").cast("int").alias("q"))
    chosen = present(known, docs).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most ``rows`` ids
    # of several texts of an id the smallest
    found = found.groupBy("doc_id").agg(F.min("text").alias("_text"), F.min("q").alias("q"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            base, x = statistics(b.column("_text"))
            ok = ~base_failed(base)
            kept = b.select(["doc_id", "q"]).filter(pa.array(ok))
            yield pa.RecordBatch.from_arrays([kept.column("doc_id").cast(pa.string()), kept.column("q"), pa.array(list(x[ok]), pa.list_(pa.float64()))], names=["doc_id", "q", "x"])

    got = sorted(found.mapInArrow(run, "doc_id string, q int, x array<double>").collect(), key=lambda r: (r["doc_id"], r["x"]))
    x = np.array([r["x"] for r in got]).reshape(len(got), len(FEATURES))
    return fit_trees(x, np.array([float(r["q"]) for r in got]), np.array([d for _, d in FEATURES]))


def judge(docs: DataFrame, trees: Trees, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` as ``_row`` with the base statistics, base_failed, score and kept.

    A null or empty text has no words and fails the base rules. Repeated rows are judged alike, long texts are read whole, a score at
    the threshold is kept. An empty table gives an empty result. The input's columns stand in ``_row``, so their names cannot clash.
    """
    spark = docs.sparkSession
    small_batches(spark)
    held = spark.sparkContext.broadcast(trees)  # a few thousand nodes
    rows = packed(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            base, x = statistics(text_of(b))
            failed = base_failed(base)
            p = held.value.probability(x)
            columns = [b.column("_row"), *[pa.array(base[:, i], pa.int64()) for i in range(len(BASE))], pa.array(failed), pa.array(p, pa.float64()), pa.array(~failed & (p >= threshold))]
            yield pa.RecordBatch.from_arrays(columns, names=["_row", *BASE, "base_failed", "score", "kept"])

    schema = f"_row {rows.schema['_row'].dataType.simpleString()}, {', '.join(f'{c} long' for c in BASE)}, base_failed boolean, score double, kept boolean"
    return rows.mapInArrow(run, schema)
