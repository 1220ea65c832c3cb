"""Quality classifier by compression with zstandard dictionaries of good and bad text.

Two dictionaries are built from labelled texts, one a class. A text is compressed in pieces with
either; the difference of the compressed sizes per byte says which class it resembles, and a
logistic curve, fitted on labelled texts outside the dictionaries, turns that into a probability. Pieces
keep the difference in proportion to the text: within one long stream the text itself
would soon replace the dictionary.

Besides the text as it stands, its shape is compressed too (letters become ``a``, ``A`` or ``w``, digits ``0``),
with a pair of dictionaries built from shapes: it shows layout junk in any language.
The labelled sample is bounded by TRAIN_ROWS rows, a dictionary by DICT_BYTES that are
filled with slices from all over these texts; whole texts are compressed for the calibration and for scores. Only slices
and the differences of whole texts reach the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import held_out, labelled, packed, present, small_batches, stored, text_of, utf8

#: Labelled rows of each class that are fitted on, those with the smallest id hashes.
TRAIN_ROWS = 3000
#: Bytes compressed at a time.
PIECE = 1024
#: Bytes of a dictionary, and of one slice of a training text in it.
DICT_BYTES, SLICE = 400_000, 128
LEVEL = 3
FOLDS = 4
THRESHOLD = 0.7

_SHAPE = bytearray(range(256))
for _c in range(256):
    if 97 <= _c <= 122:
        _SHAPE[_c] = ord("a")
    elif 65 <= _c <= 90:
        _SHAPE[_c] = ord("A")
    elif 48 <= _c <= 57:
        _SHAPE[_c] = ord("0")
    elif _c >= 128:
        _SHAPE[_c] = ord("w")
_SHAPE = bytes(_SHAPE)


class Model:
    """Dictionaries (text good, text bad, shape good, shape bad) and the calibration."""

    def __init__(self, dicts: list[bytes], weights: np.ndarray | None = None):
        self.dicts, self.weights = dicts, weights
        self._ready: list | None = None

    def __getstate__(self):
        return self.dicts, self.weights

    def __setstate__(self, state):
        self.dicts, self.weights = state
        self._ready = None

    def _compressors(self) -> list:
        if self._ready is None:
            self._ready = []
            for raw in self.dicts:
                d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(level=LEVEL)
                self._ready.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False))
        return self._ready

    def features(self, raw: bytes) -> list[float]:
        """(bad - good) compressed bytes per byte of the text and of its shape, and the repetition within the text."""
        if not raw:
            return [0.0, 0.0, 0.0]
        tg, tb, sg, sb = (c.compress for c in self._compressors())
        d = [0, 0]
        alone = 0
        shape = raw.translate(_SHAPE)
        for at in range(0, len(raw), PIECE):
            x, s = raw[at : at + PIECE], shape[at : at + PIECE]
            good = len(tg(x))
            alone += good
            d[0] += len(tb(x)) - good
            d[1] += len(sb(s)) - len(sg(s))
        n = len(raw)
        return [d[0] / n, d[1] / n, alone / n]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_design(x) @ self.weights, -30, 30)))


def _design(x: np.ndarray) -> np.ndarray:
    """The differences, also outside a middle range, and how well the text compresses."""
    t, s, a = x.T
    return np.stack([np.ones(len(x)), t * 10, s * 10, np.maximum(-t - 0.02, 0) * 20, np.maximum(-s - 0.02, 0) * 20, np.maximum(0.35 - a, 0) * 10], axis=1)


def _fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton's method on the weighted log-likelihood with a small ridge."""
    a = _design(x)
    w = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (weight * (y - p)) - ridge * w
        hess = (a * (weight * p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _shares(sizes: list[int], most: int) -> list[int]:
    """How many bytes of each text fit into ``most``: all of the short ones, equal shares of the others."""
    out, left = [0] * len(sizes), most
    for k, i in enumerate(sorted(range(len(sizes)), key=lambda i: sizes[i])):
        out[i] = min(sizes[i], left // (len(sizes) - k))
        left -= out[i]
    return out


def _slices(text: bytes, size: int) -> list[bytes]:
    """``size`` bytes of a text in slices of about SLICE, one at a drawn place of each of as many equal parts of the text.

    The place is drawn by a hash of the text, so that over many texts no part is left out, and ids do not count.
    """
    if size >= len(text):
        return [text]
    if not size:
        return []
    n = max(1, size // SLICE)
    out, key = [], zlib.crc32(text)
    for i in range(n):
        a, b = len(text) * i // n, len(text) * (i + 1) // n
        take = min(size * (i + 1) // n - size * i // n, b - a)
        at = a + zlib.crc32(f"{key} {i}".encode()) % (b - a - take + 1)
        out.append(text[at : at + take])
    return out


def _dictionaries(rows: list[tuple[int, list[bytes]]]) -> list[bytes]:
    """Of good and bad texts, then of their shapes; rows are (q, slices of a text)."""
    text = [b"\n".join(x for q_, slices in rows if q_ == q for x in slices) or b" \n.," for q in (1, 0)]
    return [*text, *[d.translate(_SHAPE) for d in text]]


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[DataFrame, dict[int, int]]:
    """A stored table (doc_id, text, q) of at most ``rows`` labelled whole texts of each class outside the held-out part, and all labels of such documents by class.

    ``labels`` with several rows for an id count as good only if all say so; null labels are left out. Of several texts of an id the
    smallest is taken.
    """
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), 4, 2)).groupBy("doc_id").agg(F.min("quality").cast("int").alias("q"))
    known = stored(present(known, docs), "quality-labels")
    total = {r["q"]: r["n"] for r in known.groupBy("q").agg(F.count("*").alias("n")).collect()}
    return stored(labelled(docs, known, "q", rows).where(F.col("text").isNotNull()), "quality-texts"), total


def _sliced(texts: DataFrame, share: dict) -> dict:
    """Slices of each text by id, of as many bytes as its share: DICT_BYTES a class in all."""
    held = texts.sparkSession.sparkContext.broadcast(share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("doc_id").to_pylist()
            cut = [[x for x in _slices(t.encode(), held.value[i]) if x] for i, t in zip(ids, b.column("text").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(cut, pa.list_(pa.binary()))], names=["doc_id", "s"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return {r["doc_id"]: [bytes(x) for x in r["s"]] for r in texts.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, s array<binary>").collect()}


def _measured(texts: DataFrame, models: list[Model], fold: dict) -> dict:
    """The features of each whole text by id, with the model of the folds that it is not in."""
    held = texts.sparkSession.sparkContext.broadcast((models, fold))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ms, f = held.value
        for b in batches:
            x = [ms[f[i]].features(t.encode()) for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "x"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return {r["doc_id"]: r["x"] for r in texts.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, x array<double>").collect()}


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Dictionaries from the sample; the calibration from whole texts outside the dictionaries, by folds.

    With a class missing, every text scores the share of good labels (0.5 without labels).
    """
    small_batches(docs.sparkSession)
    texts, total = training_sample(docs, labels, rows)
    sizes = sorted((r["doc_id"], r["q"], r["n"]) for r in texts.select("doc_id", "q", F.octet_length("text").alias("n")).collect())
    share = {}
    for q in (0, 1):
        mine = [(i, n) for i, q_, n in sizes if q_ == q]
        share |= dict(zip([i for i, _ in mine], [max(0, x - 1) for x in _shares([n + 1 for _, n in mine], DICT_BYTES)], strict=True))
    slices = _sliced(texts, share)
    # ordered and dealt by the texts, so that other ids give the same model
    sizes.sort(key=lambda r: (zlib.crc32(b"\n".join(slices[r[0]])), slices[r[0]], r[2], r[1]))
    model = Model(_dictionaries([(q, slices[i]) for i, q, _ in sizes]))
    y = np.array([float(q) for _, q, _ in sizes])
    if len(set(y)) < 2:
        good, all_ = total.get(1, 0), sum(total.values())
        p = (good + 0.5) / (all_ + 1)
        model.weights = np.array([np.log(p / (1 - p)), 0, 0, 0, 0, 0])
        return model
    fold = {i: k % FOLDS for k, (i, _, _) in enumerate(sizes)}
    parts = [Model(_dictionaries([(q, slices[i]) for i, q, _ in sizes if fold[i] != k])) for k in range(FOLDS)]
    x = _measured(texts, parts, fold)
    x = np.array([x[i] for i, _, _ in sizes])
    # each class counts as in all labels, so that the probability is right for them
    counts = {q: (y == q).sum() for q in (0.0, 1.0)}
    weight = np.array([total.get(int(q), 1) / counts[q] for q in y])
    weight *= len(y) / weight.sum()
    model.weights = _fit_logistic(x, y, weight)
    return model


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` as ``_row`` with ``score`` (0 to 1) and ``predicted`` (1 from the threshold on).

    Null and empty texts score as a text without evidence. Repeated rows score alike, long texts are read whole, a score at the
    threshold counts as good. An empty table gives an empty result. The input's columns stand in ``_row``, so their names cannot clash.
    """
    spark = docs.sparkSession
    small_batches(spark)
    held = spark.sparkContext.broadcast(model)  # four dictionaries of at most DICT_BYTES
    rows = packed(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for b in batches:
            data, at = utf8(text_of(b))
            raw = data.tobytes()
            x = np.array([m.features(raw[at[i] : at[i + 1]]) for i in range(b.num_rows)]).reshape(b.num_rows, 3)
            p = m.probability(x)
            yield pa.RecordBatch.from_arrays([b.column("_row"), pa.array(p, pa.float64()), pa.array((p >= threshold).astype(np.int32), pa.int32())], names=["_row", "score", "predicted"])

    return rows.mapInArrow(run, f"_row {rows.schema['_row'].dataType.simpleString()}, score double, predicted int")
