"""Bins of equal frequency, and optimal bins by least weighted variance, for each group of rows."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.shared import kept, small


#: Distinct values of a range that ranks are counted in, about.
RANGE_VALUES = 100_000


def _ranks(df: DataFrame, group: list[str], column: str) -> DataFrame:
    """Distinct values with the first and last index they take in sorted order, and the value after.

    The values are dealt by range; each is ranked within its range, behind the rows of its group in the ranges before. A group, or
    all rows without one, may span any number of ranges.
    """
    counted = kept(df.groupBy(*group, F.col(column).cast("long").alias("v")).agg(F.count("*").alias("c")), "bin-counts")
    parts = max(1, -(-counted.count() // RANGE_VALUES))
    dealt = kept(counted.repartitionByRange(parts, *group, "v").withColumn("_range", F.spark_partition_id()), "bin-ranges")
    # one row a group and range
    held = dealt.groupBy(*group, "_range").agg(F.sum("c").alias("_c"), F.min("v").alias("_least"))
    ranges = Window.partitionBy(*(group or [F.lit(0)]))
    held = held.withColumns({"_before": F.sum("_c").over(ranges.orderBy("_range")) - F.col("_c"), "n": F.sum("_c").over(ranges), "_first": F.lead("_least").over(ranges.orderBy("_range"))})
    held = small(kept(held.drop("_c", "_least"), "bin-offsets"))
    w = Window.partitionBy(*group, "_range").orderBy("v")
    upto = F.col("_before") + F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, 0))
    rows = dealt.join(held, [*group, "_range"]).withColumns({"_to": upto - 1, "_next": F.coalesce(F.lead("v").over(w), "_first")})
    return rows.withColumn("_from", F.col("_to") - F.col("c") + 1).drop("_range", "_before", "_first")


def equal_frequency(df: DataFrame, group: list[str], column: str, bins: int) -> DataFrame:
    """``boundary``: strictly increasing bin boundaries of each group (of all rows without a group); the last is the largest value + 1.

    Boundary i stands at index round(i n / bins). Where equal values lie on both sides of it, it moves to
    the start or behind the end of their run, whichever has its middle nearer.
    """
    r = _ranks(df, group, column)
    index = lambda i: F.least(F.round(i * F.col("n") / F.lit(float(bins))).cast("long"), F.col("n") - 1)
    inner = F.filter(F.sequence(F.lit(1), F.lit(max(bins - 1, 1))), lambda i: (index(i) >= F.col("_from")) & (index(i) <= F.col("_to")) & (i < bins))
    marks = r.select(*group, "v", "n", "_from", "_to", "_next", F.explode(inner).alias("i"))
    inside = (F.col("_from") < index(F.col("i"))) & (F.col("_to") > index(F.col("i")))
    late = (F.col("_from") + F.col("_to")) / 2.0 <= F.col("i") * F.col("n") / F.lit(float(bins))
    marks = marks.select(*group, "i", F.when(inside & late, F.coalesce("_next", F.col("v") + 1)).otherwise(F.col("v")).alias("b"))
    ends = df.groupBy(*group).agg(F.min(F.col(column).cast("long")).alias("lo"), F.max(F.col(column).cast("long")).alias("hi"))
    every = marks.unionByName(ends.select(*group, F.lit(0).alias("i"), F.col("lo").alias("b"))).unionByName(ends.select(*group, F.lit(bins).alias("i"), (F.col("hi") + 1).alias("b")))
    before = F.max("b").over(Window.partitionBy(*(group or [F.lit(0)])).orderBy("i", "b").rowsBetween(Window.unboundedPreceding, -1))
    return every.withColumn("_before", before).where(F.col("_before").isNull() | (F.col("b") > F.col("_before"))).select(*group, F.col("b").alias("boundary"))


def bin_counts(df: DataFrame, boundaries: DataFrame, group: list[str], column: str) -> DataFrame:
    """``low, high, count`` of half-open bins, those without rows included."""
    edges = boundaries.groupBy(*group).agg(F.array_sort(F.collect_list("boundary")).alias("e"))
    values = df.groupBy(*group, F.col(column).cast("long").alias("v")).agg(F.count("*").alias("c"))
    at = F.size(F.filter("e", lambda b: b <= F.col("v"))) - 1
    # without a group the edges are one row
    met = values.join(edges, group) if group else values.join(F.broadcast(edges))
    hit = met.select(*group, at.alias("k"), "c").groupBy(*group, "k").agg(F.sum("c").alias("c"))
    bins = edges.select(*group, "e", F.posexplode(F.slice("e", F.lit(1), F.size("e") - 1)).alias("k", "low")).withColumn("high", F.get("e", F.col("k") + 1))
    return bins.join(hit, [*group, "k"], "left").select(*group, "low", "high", F.coalesce("c", F.lit(0)).alias("count"))


# ---------------------------------------------------------------- optimal bins


def _positions(x: np.ndarray, w: np.ndarray, min_size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted values and weights with each run of equal values split where a best cut may stand in it.

    A bin that ends within a run takes no more of it than ``min_size`` asks for, as each further one costs more;
    it has another value too, so less than ``min_size``. The same holds for one that begins within a run.
    """
    first = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
    x, w = x[first], np.add.reduceat(w, first)
    end = np.minimum(min_size - 1, w // 2).astype(int)
    left = w - 2 * end
    # singles, what is left, singles
    parts = 2 * end + (left > 0)
    out = np.ones(int(parts.sum()))
    begin = np.cumsum(parts) - parts
    out[(begin + end)[left > 0]] = left[left > 0]
    return np.repeat(x, parts), out


def optimal_bins(values: Iterable, max_bins: int, min_size: int, weights: Iterable | None = None) -> list[tuple]:
    """(low, high, size, cost) of the bins of sorted values with the least sum of squared deviations.

    At most ``max_bins``, each of ``min_size`` or more; of equal costs the fewest bins. ``weights``: how often each value occurs.
    Equal values may fall into several bins, as far as ``min_size`` asks for it.
    """
    x = np.asarray(list(values))
    if not len(x):
        raise ValueError("no values")
    if x.dtype.kind == "f" and not np.isfinite(x).all():
        raise ValueError("values must be finite")
    w = np.ones(len(x)) if weights is None else np.asarray(list(weights), dtype=float)
    order = np.argsort(x, kind="stable")
    x, w = x[order], w[order]
    if w.sum() < min_size:
        raise ValueError("fewer values than a bin must have")
    if x[0] == x[-1]:
        return [(x[0], x[0], int(w.sum()), 0.0)]
    most = min(max_bins, int(w.sum() // min_size))
    if most < 1:
        raise ValueError("no valid bins")
    x, w = _positions(x, w, min_size)
    n = len(x)
    centred = x.astype(float) - float(np.average(x.astype(float), weights=w))
    cw, cx, cxx = (np.concatenate([[0.0], np.cumsum(v)]) for v in (w, w * centred, w * centred**2))

    def costs(j: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Of bins that hold values j to i."""
        size = cw[i] - cw[j]
        c = np.maximum(cxx[i] - cxx[j] - (cx[i] - cx[j]) ** 2 / np.maximum(size, 1), 0.0)
        c = np.where(x[np.minimum(j, n - 1)] == x[i - 1], 0.0, c)  # equal values, without rounding
        return np.where(size >= min_size, c, np.inf)

    def level(before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """With one bin more, the least cost up to each i and where its last bin begins.

        That place never moves back as i grows: the middle of a range of i bounds it for both halves,
        and the ranges of one depth have about n places together.
        """
        best, cut = np.full(n + 1, np.inf), np.zeros(n + 1, dtype=int)
        lo, hi = np.array([1]), np.array([n])  # ranges of i, and of the place in them
        start, stop = np.array([0]), np.array([n])
        while len(lo):
            mid = (lo + hi) // 2
            many = np.minimum(stop, mid - 1) - start + 1
            at = np.cumsum(many) - many
            j = np.arange(int(many.sum())) + np.repeat(start - at, many)
            total = before[j] + costs(j, np.repeat(mid, many))
            least = np.minimum.reduceat(total, at)
            hit = np.flatnonzero(total == np.repeat(least, many))
            first = hit[np.searchsorted(hit, at)]
            best[mid], cut[mid] = least, j[first]
            # without a bin that is large enough, nothing is known of the place
            known = np.isfinite(least)
            to, since = np.where(known, j[first], stop), np.where(known, j[first], start)
            lo, hi = np.concatenate([lo, mid + 1]), np.concatenate([mid - 1, hi])
            start, stop = np.concatenate([start, since]), np.concatenate([to, stop])
            some = lo <= hi
            lo, hi, start, stop = lo[some], hi[some], start[some], stop[some]
        return best, cut

    best = [np.where(np.arange(n + 1) == 0, 0.0, np.inf)]
    cuts = [np.zeros(n + 1, dtype=int)]
    for _ in range(most):
        b, c = level(best[-1])
        best.append(b)
        cuts.append(c)
    k = min(range(1, most + 1), key=lambda k: (best[k][n], k))
    if not np.isfinite(best[k][n]):
        raise ValueError("no valid bins")
    out, end = [], n
    while k:
        j = int(cuts[k][end])
        out.append((x[j], x[end - 1], int(cw[end] - cw[j]), float(costs(np.array([j]), np.array([end]))[0])))
        end, k = j, k - 1
    return out[::-1]


def optimal_binning(df: DataFrame, group: list[str], column: str, max_bins: int, min_size: int) -> DataFrame:
    """group columns, bin, low, high, frequency, cost: the optimal bins of each group, groups side by side.

    One rule at every size. A group's distinct values and counts meet in one task. A group that has no valid bins (too few
    values, values that are not finite or null) gets one row with a null bin and the ``reason``, and does not stop the others.
    """
    counted = df.groupBy(*group, F.col(column).cast("double").alias("v")).agg(F.count("*").alias("c"))
    schema = ", ".join([*[f"{f.name} {f.dataType.simpleString()}" for f in df.select(*group).schema], "bin int, low double, high double, frequency long, cost double, reason string"])

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        try:
            rows = [(*key, i, *b, None) for i, b in enumerate(optimal_bins(pdf["v"].to_numpy(), max_bins, min_size, pdf["c"].to_numpy()))]
        except ValueError as e:
            rows = [(*key, None, None, None, None, None, str(e))]
        return pd.DataFrame(rows, columns=[*group, "bin", "low", "high", "frequency", "cost", "reason"])

    return counted.groupBy(*group).applyInPandas(run, schema)


def bin_frequency(df: DataFrame, group: list[str], column: str, edges: tuple[float, ...]) -> DataFrame:
    """group columns, bin, low, high, frequency of the rows between given edges, lower edge included; bins without rows are left out.

    ``low`` and ``high`` are the least and the largest value of the bin; values outside all edges fall into the first and last bin.
    """
    at = reduce(lambda a, b: a + b, [(F.col(column) >= e).cast("int") for e in edges[1:-1]], F.lit(0))
    v = F.col(column).cast("double")
    return df.where(F.col(column).isNotNull()).groupBy(*group, at.alias("bin")).agg(F.min(v).alias("low"), F.max(v).alias("high"), F.count("*").alias("frequency"))


def bin_edges(bins: DataFrame, group: list[str], whole: bool = False) -> DataFrame:
    """``edge``: the least value, the middle between neighbouring bins, the largest; ``whole`` rounds middles towards zero."""
    bins = bins.where(F.col("bin").isNotNull())
    w = Window.partitionBy(*group).orderBy("bin")
    rows = bins.withColumn("_next", F.lead("low").over(w))
    middle = F.when(F.col("_next").isNull(), F.col("high")).otherwise((F.col("high") + F.col("_next")) / 2)
    if whole:
        middle = F.when(middle < 0, F.ceil(middle)).otherwise(F.floor(middle)).cast("double")
    first = bins.groupBy(*group).agg(F.min("low").alias("edge")).withColumn("position", F.lit(0))
    return first.select(*group, "position", "edge").unionByName(rows.select(*group, (F.col("bin") + 1).alias("position"), middle.alias("edge")))


def predict_bin(df: DataFrame, bins: DataFrame, group: list[str], column: str) -> DataFrame:
    """``df`` with ``bin``: the one that holds the value, else the nearest, of equally near ones the first."""
    listed = bins.where(F.col("bin").isNotNull()).groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("bin", "low", "high"))).alias("_bins"))
    v = F.col(column).cast("double")
    apart = lambda b: F.greatest(b["low"] - v, v - b["high"], F.lit(0.0))
    nearest = F.array_min(F.transform("_bins", lambda b: F.struct(apart(b).alias("d"), b["bin"].alias("bin"))))
    return df.join(listed, group, "left").withColumn("bin", F.when(v.isNotNull() & ~F.isnan(v), nearest["bin"])).drop("_bins")
