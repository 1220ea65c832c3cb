"""Mixing sources to target weights by cube-method balanced sampling.

A source with target T and size S is taken T/S times: every document floor(T/S) times
whole, and once more with inclusion probability pi = T/S - floor(T/S). The cube method
chooses who is in: its flight phase moves the vector of probabilities along directions
that leave the totals of documents and of words unchanged until all but two entries
are 0 or 1. Flights run side by side over buckets of a source; what each leaves undecided
flies again in buckets of the next level, until one bucket a source remains, where the
landing rounds the last two or so, with the smallest units beside them, to the nearest word total. The largest documents
fly first, so that those left for the landing are the smallest.
"""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import WORD, stored

WEIGHTS = (1, 2, 3)
#: A source is taken this many times at most, a row of it as many times, rounded up.
MOST = 3
#: Units in one flight. Buckets of a source: its units / this, so groups stay bounded.
BUCKET = 1000
#: Units that the landing decides on.
LANDING = 12
#: Sources whose plan is broadcast (some 60 bytes each); the plan of more is joined.
BROADCAST_SOURCES = 100_000
#: Probabilities this near to 0 or 1 count as certain.
EPS = 1e-9


def level_of(counted: DataFrame, share: float, weights: tuple[float, ...], most: float) -> float:
    """The level at which min(limit, level x weight) adds up to the share of all words.

    ``counted``: n (words of a source) and k (which weight it takes). Each turn sums whole numbers for each weight on
    Spark, so that the order of rows does not matter; the level only rises, and the turns end when no further source is at its limit.
    """
    total = counted.agg(F.sum("n")).first()[0] or 0
    weight = F.array(*[F.lit(float(w)) for w in weights])[F.col("k")]
    level, closed = 0.0, -1
    while True:
        full = most * F.col("n") < F.lit(level) * weight
        got = counted.groupBy("k").agg(F.count_if(full).alias("closed"), F.sum(F.when(full, F.col("n")).otherwise(0)).alias("n"), F.count_if(~full).alias("open")).collect()
        got = sorted(got, key=lambda r: r["k"])
        rest = sum(weights[r["k"]] * r["open"] for r in got)
        if not rest or sum(r["closed"] for r in got) == closed:
            return level
        closed = sum(r["closed"] for r in got)
        level = (share * total - most * sum(r["n"] for r in got)) / rest


def targets(sizes: DataFrame, share: float = 1.0, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """The rows of ``sizes`` (source, n and others) with ``target``: ``share`` of all words by weight, at most ``most`` times n.

    Sources go by code point, null last, and take the weights in turn. The excess over a
    source's limit is shared again by weight until none is above: target = min(limit, level x weight).
    """
    order = [F.col("source").isNull(), F.col("source")]
    dealt = stored(sizes.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "mix-sources")
    parts = dealt.groupBy("_part").agg(F.count("*").alias("_c"))
    before = parts.select("_part", (F.sum("_c").over(Window.orderBy("_part")) - F.col("_c")).alias("_before"))  # a row for each task
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1 + F.col("_before")
    counted = stored(dealt.join(F.broadcast(before), "_part").withColumn("k", F.pmod(place, F.lit(len(weights))).cast("int")).drop("_part", "_before"), "mix-ranks")
    level = level_of(counted, share, weights, most)
    weight = F.array(*[F.lit(float(w)) for w in weights])[F.col("k")]
    return counted.withColumn("target", F.least(F.lit(float(most)) * F.col("n"), F.lit(level) * weight)).drop("k")


def flight(pi: list[float], docs: list[float], words: list[float], rng: random.Random) -> list[float]:
    """Move ``pi`` to the corners of the cube with both totals kept; at most two entries stay between."""
    eps = EPS
    pi = list(pi)
    act: list[int] = []
    waiting = iter(i for i in range(len(pi)) if eps < pi[i] < 1 - eps)
    while True:
        while len(act) < 3 and (i := next(waiting, None)) is not None:
            act.append(i)
        if len(act) < 3:
            break
        a, b, c = act
        # the direction in which both totals stay: the cross product of the constraint rows
        u = (docs[b] * words[c] - docs[c] * words[b], docs[c] * words[a] - docs[a] * words[c], docs[a] * words[b] - docs[b] * words[a])
        if not any(u):  # the rows are parallel: one constraint, any direction that keeps it
            u = (docs[b], -docs[a], 0.0) if docs[a] or docs[b] else (1.0, 0.0, 0.0)
        up = min(((1 - pi[i]) / v if v > 0 else pi[i] / -v) for i, v in zip(act, u, strict=True) if v)
        down = min((pi[i] / v if v > 0 else (1 - pi[i]) / -v) for i, v in zip(act, u, strict=True) if v)
        step = up if rng.random() * (up + down) < down else -down
        for i, v in zip(act, u, strict=True):
            pi[i] += step * v
            if pi[i] < eps or pi[i] > 1 - eps:
                pi[i] = float(round(pi[i]))
        act = [i for i in act if 0.0 < pi[i] < 1.0]
    return pi


def landing(pi: list[float], words: list[float], open_: list[bool] | None = None) -> list[float]:
    """Round the few entries between 0 and 1 so that the word total moves least.

    The smallest few of the units that were open before the flight may change sides too, where that
    brings the total nearer; of equal totals the one with the fewest changes is taken.
    """
    rest = [i for i, p in enumerate(pi) if 0.0 < p < 1.0]
    spare = sorted((i for i, o in enumerate(open_ or []) if o and i not in rest and words[i] > 0), key=lambda i: (words[i], i))
    free = rest + spare[: max(0, LANDING - len(rest))]
    if not free:
        return list(pi)
    choice = np.arange(1 << len(free))[:, None] >> np.arange(len(free)) & 1
    w, now = np.array([words[i] for i in free]), np.array([pi[i] for i in free])
    away = np.abs(choice @ w - (w * now).sum())
    flips = np.abs(choice - now)[:, len(rest) :].sum(axis=1)
    best = choice[np.lexsort((flips, np.round(away, 6)))[0]]
    pi = list(pi)
    for i, c in zip(free, best, strict=True):
        pi[i] = float(c)
    return pi


def mix(docs: DataFrame, share: float = 1.0, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """One row for each distinct (doc_id, source, text) of ``docs``, with its decision.

    Columns: doc_id, source, _text (hash of the text), size, rows (copies in the input), source_size,
    target, taken (words the mix takes of one such row). Rows alike in id, source and text are
    one unit, so that reruns agree whatever the order of rows. A null text has size 0; units of
    size 0 are taken with their source and add nothing. A null source is a source of its own,
    last in order. Texts of any length are counted whole. Other columns of ``docs`` are not read. Empty input gives an empty result.
    """
    spark = docs.sparkSession
    sized = docs.select("doc_id", "source", F.xxhash64("text").alias("_text"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    units = stored(sized.groupBy("doc_id", "source", "_text", "size").agg(F.count("*").alias("rows")), "mix-units")
    totals = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("n"), F.count("*").alias("units"))
    times = F.when(F.col("n") > 0, F.col("target") / F.col("n")).otherwise(0.0)
    whole = F.least(F.floor(times + EPS), F.lit(math.ceil(most))).cast("int")
    pi = F.when(F.col("whole") >= math.ceil(most), 0.0).when(times - F.col("whole") < EPS, 0.0).otherwise(times - F.col("whole"))
    by_source = targets(totals, share, weights, most).withColumn("whole", whole).select(F.col("source").alias("_s"), F.col("n").alias("source_size"), "target", "whole", pi.alias("pi"), F.ceil(F.col("units") / BUCKET).cast("long").alias("buckets"))
    by_source = stored(by_source, "mix-plan")
    n_sources, most_buckets = by_source.agg(F.count("*"), F.max("buckets")).first()
    most_buckets = most_buckets or 0
    plan = F.broadcast(by_source) if n_sources <= BROADCAST_SOURCES else by_source
    level = units.join(plan, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    level = level.withColumn("_h", F.xxhash64("doc_id", "_text", "size"))
    schema = level.schema

    def run(state: DataFrame, last: bool) -> DataFrame:
        def fly(t: pa.Table) -> pa.Table:
            pi, size, n, tie = (t.column(c).to_pylist() for c in ("pi", "size", "rows", "_h"))
            words = [float(s * k) for s, k in zip(size, n, strict=True)]
            order = sorted(range(len(pi)), key=lambda i: (-words[i], tie[i]))
            rng = random.Random(f"{len(pi)} {tie[order[0]]}")
            w = [words[i] for i in order]
            given = [pi[i] for i in order]
            moved = flight(given, [float(n[i]) for i in order], w, rng)
            moved = landing(moved, w, [0.0 < p < 1.0 for p in given]) if last else moved
            for i, p in zip(order, moved, strict=True):
                pi[i] = p
            return t.set_column(t.schema.get_field_index("pi"), "pi", pa.array(pi, pa.float64()))

        # groups: (source, bucket), of BUCKET units on average
        bucketed = state.withColumn("_b", F.pmod(F.col("_h"), F.col("buckets")) if not last else F.lit(0).cast("long"))
        flown = bucketed.groupBy("source", "_b").applyInArrow(lambda t: fly(t), bucketed.schema)
        return flown.select(*schema.names)

    decided, turn = None, 0
    while True:
        last = most_buckets <= 1
        now = stored(run(level, last), f"mix-level{turn}")
        done = now.where("pi = 0 or pi = 1")
        decided = done if decided is None else decided.unionByName(done)
        if last:
            break
        # up to two of a bucket stay undecided; they meet in fewer buckets, by other bits of the hash
        level = now.where("pi > 0 and pi < 1").withColumn("_h", F.xxhash64("_h", F.lit(turn))).withColumn("buckets", F.ceil(F.col("buckets") * 2 / BUCKET).cast("long"))
        most_buckets = 1 if most_buckets == 1 else -(-most_buckets * 2 // BUCKET)
        if most_buckets <= 1:
            level = level.withColumn("buckets", F.lit(1).cast("long"))
        turn += 1
    taken = F.col("size") * (F.col("whole") + F.col("pi")).cast("long")
    return decided.select("doc_id", "source", "_text", "size", "rows", "source_size", "target", taken.alias("taken"))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """A row for each input row: doc_id, size, source_size, target, taken."""
    out = mix(docs, **options).select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("_copy"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def taken_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the mix takes, with size, source_size, target, taken beside their columns.

    Input columns with those names are replaced.
    """
    keys = [F.col("doc_id"), F.col("source"), F.xxhash64("text")]
    chosen = mix(docs, **options).where("taken > 0").select(F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("_text").alias("_t"), "size", "source_size", "target", "taken")
    own = docs.drop("size", "source_size", "target", "taken")
    on = keys[0].eqNullSafe(F.col("_d")) & keys[1].eqNullSafe(F.col("_s")) & (keys[2] == F.col("_t"))
    return own.join(chosen, on).drop("_d", "_s", "_t")


