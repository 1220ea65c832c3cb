"""Whitening of embeddings over distinct vectors with multiplicities.

Vectors are taken to fixed point and identical ones are grouped, so a vector that a third of all rows hold is one row with a count. The fit weighs each distinct
vector with one or with its count: exact sums first, then a weighted GEMM of centred vectors, both added up task by task on the executors;
only sums and the covariance matrix, whose size is the dimension's, reach the driver. Each distinct vector is whitened once, and the results are
joined back to the rows: by shuffling, but for the at most HEAVY vectors that one in HEAVY rows or more hold, which are broadcast.

Vectors of each length are a space of their own with a fit of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import lists, small_batches, stored

SCALE, COMPONENTS = 256, 4
#: A vector that one in so many rows holds is joined by broadcast; there are at most as many.
HEAVY = 1000
#: Variance that rounding leaves, as a share of all variance for each dimension; less counts as none.
NOISE = 1e-14
_LONG = 1 << 63


@dataclass
class Fit:
    """Weight, exact sums, projection to whitened components (one column each) and shares of the variance of a space."""

    n: int
    sums: list[int]
    projection: np.ndarray
    explained: list[float]
    error: float = 0.0


def fixed_point(embeddings: DataFrame, keep: tuple[str, ...], vector: str, scale: int) -> DataFrame:
    """``_row, x`` of the rows whose vector is there and holds finite numbers only; entries beyond a long take its ends."""
    number = lambda c: c.cast("double")
    sound = lambda c: c.isNotNull() & ~F.isnan(number(c)) & (F.abs(number(c)) != float("inf"))
    kept = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.struct(F.lit(0).alias("_none"))
    v = F.col(f"`{vector}`")
    rows = embeddings.where(v.isNotNull() & F.forall(v, sound))
    return rows.select(kept.alias("_row"), F.transform(v, lambda c: F.floor(number(c) * scale).cast("long")).alias("x"))


def _spaces(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of each length and their vectors as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    at = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(at)
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        yield rows, values[at[rows][:, None] + np.arange(d)] if d else np.empty((len(rows), 0), dtype=np.int64)


def _largest(x: np.ndarray) -> int:
    return max(int(x.max()), -int(x.min())) if x.size else 0


def _sum_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's exact weighted sums: dim, pos (-1: the weight), total."""
    sums: dict[int, list[int]] = {}
    for batch in batches:
        weights = batch.column(1).to_numpy()
        for rows, x in _spaces(batch.column(0)):
            w = weights[rows]
            have = sums.setdefault(x.shape[1], [0] * (x.shape[1] + 1))
            safe = _largest(x) * int(w.sum()) < _LONG
            add = (x * w[:, None]).sum(axis=0) if safe else (x.astype(object) * w[:, None].astype(object)).sum(axis=0)
            for j, v in enumerate([int(w.sum()), *map(int, add)]):
                have[j] += v
    out = [(d, j - 1, Decimal(v)) for d, s in sums.items() for j, v in enumerate(s)]
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int32(), pa.decimal128(38, 0)), strict=True)], names=["dim", "pos", "total"])


def _product_rows(centres: dict[int, np.ndarray]):
    """A task's weighted products of centred vectors: dim, i, j (i <= j), total."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products: dict[int, np.ndarray] = {}
        for batch in batches:
            weights = batch.column(1).to_numpy()
            for rows, x in _spaces(batch.column(0)):
                d = x.shape[1]
                centred = x - centres[d]
                add = (centred * weights[rows][:, None]).T @ centred
                products[d] = products[d] + add if d in products else add
        for d, p in products.items():
            i, j = np.triu_indices(d)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), d), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(p[i, j])], names=["dim", "i", "j", "total"])

    return run


def fit(distinct: DataFrame, components: int = COMPONENTS) -> dict[int, Fit]:
    """A fit for each length of the vectors ``x`` with weights ``w``.

    Components go by falling variance; each one's largest entry is positive. Those without variance (beyond rounding) project everything to 0.
    """
    weighed = distinct.select("x", "w")
    sums: dict[int, dict[int, int]] = {}
    for r in weighed.mapInArrow(_sum_rows, "dim int, pos int, total decimal(38,0)").groupBy("dim", "pos").agg(F.sum("total").alias("total")).collect():  # dimension + 1 rows a space
        sums.setdefault(r["dim"], {})[r["pos"]] = int(r["total"])
    centres = {d: np.array([s[j] / s[-1] for j in range(d)]) for d, s in sums.items()}
    products = {d: np.zeros((d, d)) for d in sums}
    for r in weighed.mapInArrow(_product_rows(centres), "dim int, i int, j int, total double").groupBy("dim", "i", "j").agg(F.sum("total").alias("total")).collect():  # half the matrix
        products[r["dim"]][r["i"], r["j"]] = products[r["dim"]][r["j"], r["i"]] = r["total"]
    out = {}
    for d, s in sums.items():
        values, vectors = np.linalg.eigh(products[d] / s[-1]) if d else (np.empty(0), np.empty((0, 0)))
        first = np.argsort(-values, kind="stable")[:components]
        values, vectors, whole = values[first], vectors[:, first], max(float(values.sum()), 0.0)
        vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(first))] < 0, -1.0, 1.0) if d else vectors
        real = values > NOISE * d * whole
        scale = np.where(real, 1 / np.sqrt(np.where(real, values, 1.0)), 0.0)
        explained = np.where(real, values / (whole or 1.0), 0.0)
        out[d] = Fit(s[-1], [s[j] for j in range(d)], vectors * scale, explained.tolist())
    return out


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exactly; null where it exceeds a long."""
    bound = _largest(x) * n + max(map(abs, sums), default=0)
    if x.shape[1] * bound * bound < _LONG:
        return ((n * x - np.array(sums, dtype=np.int64)) ** 2).sum(axis=1).tolist()
    exact = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    return [v if v < _LONG else None for v in exact]


def _whiten(fits: dict[int, Fit]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.num_rows
            deviation: list = [None] * size
            counts = np.zeros(size, dtype=np.int64)
            parts: list = [None] * size
            for rows, x in _spaces(batch.column(0)):
                m = fits[x.shape[1]]
                z = (x - np.array([s / m.n for s in m.sums])) @ m.projection
                for r, v, d in zip(rows.tolist(), z, _deviations(x, m.n, m.sums), strict=True):
                    parts[r], deviation[r] = v, d
                counts[rows] = z.shape[1]
            whitened = lists(np.concatenate(parts) if size else np.empty(0), counts, pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(deviation, pa.int64()), whitened], names=["x", "w", "copies", "deviation", "whitened"])

    return run


def _identity_errors(whitened: DataFrame, fits: dict[int, Fit]) -> None:
    """Measure each space's whitened covariance against the identity, over the components that have variance."""
    most = max((len(m.explained) for m in fits.values()), default=0)
    dim, z = F.size("x").alias("dim"), [F.get("whitened", F.lit(i)) for i in range(most)]
    if not most:
        return
    means = whitened.groupBy(dim).agg(*[(F.sum(F.col("w") * z[i]) / F.sum("w")).alias(f"m{i}") for i in range(most)])
    centred = whitened.select(dim, "w", *[c.alias(f"z{i}") for i, c in enumerate(z)]).join(F.broadcast(means), "dim")  # a row a space
    pairs = [(i, j) for i in range(most) for j in range(i, most)]
    product = lambda i, j: F.sum(F.col("w") * (F.col(f"z{i}") - F.col(f"m{i}")) * (F.col(f"z{j}") - F.col(f"m{j}"))) / F.sum("w")
    for r in centred.groupBy("dim").agg(*[product(i, j).alias(f"c{i}_{j}") for i, j in pairs]).collect():  # a row a space
        m = fits[r["dim"]]
        real = [i for i, e in enumerate(m.explained) if e > 0]
        m.error = max((abs(r[f"c{i}_{j}"] - (i == j)) for i, j in pairs if i in real and j in real), default=0.0)


def whiten(embeddings: DataFrame, keep: tuple[str, ...] = ("vec_id",), vector: str = "embedding", scale: int = SCALE, components: int = COMPONENTS, weights: str = "one") -> DataFrame:
    """For each row with a sound vector and each of the first components: kept columns, component, n, deviation, whitened, explained, identity_error.

    ``weights``: ``one`` fits each distinct vector once, ``count`` by its rows. Null vectors and those with null or non-finite entries go; rows that
    repeat stay and get the same values; null ids stay. An empty table, or one of empty vectors, gives an empty result. Where distinct vectors do not vary along a
    component, ``whitened`` and ``explained`` are 0 and ``identity_error`` leaves the component out; a space has no more components than dimensions. ``deviation`` is null
    where it exceeds a long. Kept columns named like a result are replaced.
    """
    if weights not in ("one", "count"):
        raise ValueError("weights: one or count")
    small_batches(embeddings.sparkSession)
    results = ("component", "n", "deviation", "whitened", "explained", "identity_error")
    keep = tuple(c for c in keep if c not in results)
    rows = fixed_point(embeddings, keep, vector, scale)
    weight = F.count("*") if weights == "count" else F.lit(1).cast("long")
    distinct = stored(rows.groupBy("x").agg(weight.alias("w"), F.count("*").alias("copies")), "whiten-distinct")
    fits = fit(distinct, components)
    done = stored(distinct.mapInArrow(_whiten(fits), "x array<bigint>, w bigint, copies bigint, deviation bigint, whitened array<double>"), "whiten-vectors")
    _identity_errors(done, fits)
    total = done.agg(F.sum("copies").alias("n")).first()["n"] or 0
    found = done.select("x", "deviation", "whitened")
    heavy = done.where(F.col("copies") * HEAVY >= total).select("x", "deviation", "whitened")  # at most HEAVY rows
    if heavy.isEmpty():
        joined = rows.join(found, "x")
    else:
        heavy = stored(heavy, "whiten-heavy")
        rest = rows.join(F.broadcast(heavy.select("x")), "x", "left_anti")
        joined = rows.join(F.broadcast(heavy), "x").unionByName(rest.join(done.where(F.col("copies") * HEAVY < total).select("x", "deviation", "whitened"), "x"))
    out = joined.select("_row", F.size("x").alias("_dim"), "deviation", F.posexplode("whitened").alias("_i", "whitened"))
    none = F.create_map().cast("map<int,double>")
    of_space = lambda value, kind: F.element_at(F.create_map(*[x for d, m in fits.items() for x in (F.lit(d), value(m))]) if fits else none, F.col("_dim")).cast(kind)
    share = of_space(lambda m: F.array(*[F.lit(float(e)) for e in m.explained]).cast("array<double>"), "array<double>") if fits else F.array().cast("array<double>")
    return out.select(
        *[F.col(f"_row.`{c}`") for c in keep], (F.col("_i") + 1).cast("int").alias("component"), of_space(lambda m: F.lit(m.n).cast("long"), "long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("_i")).alias("explained"), of_space(lambda m: F.lit(float(m.error)), "double").alias("identity_error"),
    )
