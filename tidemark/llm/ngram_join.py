"""N-gram Jaccard join by grouped prefixes.

Two texts link when their sets of word shingles have a Jaccard similarity of at least
THRESHOLD. Shingles stand in one global order; sets that similar share COMMON shingles or more
within short prefixes in that order, so only prefixes are joined:

1. Counting. Shingles with long words come first in the order, as these are rare. The shingles in and just
   behind the prefixes are counted, and those found FREQUENT times or more go last instead.
2. Collapsing. Texts with equal sets are one node; nodes with the same prefix and size are one group.
3. Joining. Groups that share rare prefix shingles are paired and the pairs are kept whose number of shared
   ones is enough. A shingle with a long list of groups pairs them with a few hubs of their size only. All pairs
   are filtered by parity bits of whole sets: sets that differ in d bits differ in d shingles or more.
4. Verifying, in two rounds. Each group is compared with its best partner and hubs; the links give
   components. Then every candidate pair whose members are in different components is expanded to members and
   compared, those of the long lists too. Pairs within one component need no comparison: the
   result is components, and no link between different components is left out.

No group is enumerated pairwise while one component covers it, and nothing but counts reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import SPACED, Words, blocks, lists, mix, shingles, small_batches, stored

NGRAM = 5
#: The threshold as a fraction of whole numbers, so that the test is exact.
THRESHOLD = (8, 10)
#: Shingles that linked sets share within their prefixes (fewer where linked sets can be smaller).
COMMON = 4
#: Shingles counted this often go last in the order; at most MAX_FREQUENT of them are broadcast (16 bytes each).
FREQUENT, MAX_FREQUENT = 12, 1_000_000
#: Numbers of 64 parity bits for each set, and hubs for each size class of a long list.
PARITIES, HUBS = 4, 4
#: Lists before one in which a pair is looked for, so that it is not met in both.
EARLIER = 16
#: Longer lists of groups for one shingle are joined through hubs.
LONG_LIST = 16
#: Ids that are broadcast to pick texts; beyond it they are joined.
MAX_IDS = 2_000_000
_LAST = (1 << 63) - 1
#: Parity bits as columns: of a set (or of any set of a group), and those in which the sets of a group differ.
_VALUES, _DIFFERING = [f"v{i}" for i in range(PARITIES)], [f"d{i}" for i in range(PARITIES)]
_BITS = [*_VALUES, *_DIFFERING]


def _tokens(h: np.ndarray, size: np.ndarray, k: int) -> np.ndarray:
    """Shingles of ``k`` words as numbers that sort by their longest word, longest first: 8 bits for it, 56 of hash."""
    s = shingles(h, k)
    longest = size[: len(s)]
    for j in range(1, k):
        longest = np.maximum(longest, size[j : j + len(s)])
    return (s >> np.uint64(8)) | ((255 - np.minimum(longest, 255)).astype(np.uint64) << np.uint64(56))


def text_sets(data: np.ndarray, at: np.ndarray, k: int = NGRAM) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text of a block, in order, and where each text's begin.

    A text of fewer words than ``k`` has one shingle, its whole sequence; one without words has none.
    """
    w = Words(data, at, SPACED)
    h, size, first = w.hashes(), w.end - w.start, w.first
    every = _tokens(h, size, k)
    parts, sizes = [], np.zeros(len(at) - 1, dtype=np.int64)
    for d in range(len(at) - 1):
        a, b = first[d], first[d + 1]
        if b - a >= k:
            s = np.sort(every[a : b - k + 1])
            if len(s) > 1:
                s = s[np.concatenate([[True], s[1:] != s[:-1]])]
        elif b > a:
            s = _tokens(h[a:b], size[a:b], b - a)
        else:
            continue
        parts.append(s)
        sizes[d] = len(s)
    return (np.concatenate(parts) if parts else np.empty(0, np.uint64)), np.concatenate([[0], np.cumsum(sizes)])


def smallest_unequal(threshold: tuple[int, int]) -> int:
    """Sets of fewer shingles link with equal sets only."""
    a, b = threshold
    return -(-a // (b - a))


def common_of(threshold: tuple[int, int]) -> int:
    a, b = threshold
    return max(1, min(COMMON, -(-a * smallest_unequal(threshold) // b)))


def prefix_size(n: int, threshold: tuple[int, int] = THRESHOLD) -> int:
    """Of a set of n: linked sets share ``common_of`` or more shingles within prefixes of this length."""
    a, b = threshold
    return min(n, n - -(-a * n // b) + common_of(threshold))


def fingerprint(s: np.ndarray) -> int:
    """One 64-bit value for a sorted set."""
    with np.errstate(over="ignore"):
        x = mix(s * np.uint64(0x9E3779B97F4A7C15) + np.uint64(len(s)))
        return int(mix(np.array([np.add.reduce(x), np.bitwise_xor.reduce(x)], dtype=np.uint64) * np.array([1, 3], np.uint64)).sum().astype(np.int64))


def parity(s: np.ndarray) -> np.ndarray:
    """Each shingle of a set turns one of 64 * PARITIES bits over."""
    odd = np.bincount((s % np.uint64(64 * PARITIES)).astype(np.int64), minlength=64 * PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


# ---------------------------------------------------------------- counting and prefixes


def frequent_shingles(docs: DataFrame, k: int, threshold: tuple[int, int]) -> DataFrame:
    """``t, c``: shingles found FREQUENT times or more in the first part of sets, half as long again as a prefix."""
    smallest = smallest_unequal(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [np.empty(0, np.uint64)]
            for _, _, data, at in blocks(b.column("text")):
                s, first = text_sets(data, at, k)
                for d in range(len(at) - 1):
                    if (n := first[d + 1] - first[d]) >= smallest:
                        parts.append(s[first[d] : first[d] + min(n, prefix_size(n, threshold) * 3 // 2)])
            t, n = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(t.view(np.int64)), pa.array(n, pa.int64())], names=["t", "c"])

    counted = docs.select("text").mapInArrow(run, "t long, c long").groupBy("t").agg(F.sum("c").alias("c"))
    return counted.where(F.col("c") >= FREQUENT)


def _order_table(counted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles sorted by hash and their counts, at most MAX_FREQUENT."""
    step = F.floor(F.log2("c") * 8).cast("int")
    found = sorted(((r["s"], r["n"]) for r in counted.groupBy(step.alias("s")).agg(F.count("*").alias("n")).collect()), reverse=True)
    low, n = None, 0
    for s, m in found:
        if n + m > MAX_FREQUENT:
            break
        low, n = s, n + m
    got = (counted.where(step >= low) if low is not None else counted.limit(0)).toArrow()
    t, c = got.column("t").to_numpy().view(np.uint64), got.column("c").to_numpy()
    order = np.argsort(t)
    return t[order].copy(), c[order].copy()


def _in_order(s: np.ndarray, t: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The set in the global order, and which of it are frequent."""
    at = np.minimum(np.searchsorted(t, s), max(len(t) - 1, 0))
    often = (t[at] == s) if len(t) else np.zeros(len(s), bool)
    rank = np.where(often, c[at] if len(t) else 0, 0)
    order = np.argsort(rank, kind="stable")
    return s[order], often[order]


def set_table(docs: DataFrame, k: int, threshold: tuple[int, int]) -> DataFrame:
    """A stored row for each row of ``docs``: doc, n, node, grp, prefix, often (flags of prefix shingles), parity bits.

    A column ``h`` of ``docs`` stays. Sets too small to link with a different one have no prefix.
    """
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(_order_table(stored(frequent_shingles(docs, k, threshold), "jaccard-frequent")))
    smallest = smallest_unequal(threshold)
    own = [c for c in ("doc", "h") if c in docs.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, c = held.value
        for batch in batches:
            n_all, node, grp, flat, often, size, bits = [], [], [], [], [], [], []
            for _, _, data, at in blocks(batch.column("text")):
                s_all, first = text_sets(data, at, k)
                for d in range(len(at) - 1):
                    s = s_all[first[d] : first[d + 1]]
                    n = len(s)
                    n_all.append(n)
                    node.append(fingerprint(s) if n else 0)
                    bits.append(parity(s))
                    if n < smallest:
                        grp.append(0)
                        size.append(0)
                        continue
                    s, o = _in_order(s, t, c)
                    p = prefix_size(n, threshold)
                    flat.append(s[:p])
                    often.append(o[:p])
                    size.append(p)
                    grp.append(fingerprint(np.append(s[:p], np.uint64(n))))
            join = lambda x, kind: np.concatenate(x) if x else np.empty(0, kind)
            odd = np.array(bits, np.int64).reshape(-1, PARITIES)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(x) for x in own], pa.array(n_all, pa.int64()), pa.array(node, pa.int64()), pa.array(grp, pa.int64()),
                 lists(join(flat, np.uint64).view(np.int64), size, pa.int64()), lists(join(often, bool), size, pa.bool_()), *[pa.array(odd[:, i]) for i in range(PARITIES)]],
                names=[*own, "n", "node", "grp", "prefix", "often", *_VALUES],
            )

    kinds = ", ".join(f"{x} long" for x in own) + ", n long, node long, grp long, prefix array<long>, often array<boolean>, " + ", ".join(f"{c} long" for c in _VALUES)
    return stored(docs.mapInArrow(run, kinds), "jaccard-sets")


# ---------------------------------------------------------------- candidates


def _may_link(n: Column, i: Column, m: Column, j: Column, threshold: tuple[int, int]) -> Column:
    """Sizes and positions of a shared shingle that do not rule a link out."""
    a, b = threshold
    sizes = (F.least(n, m) * b) >= (F.greatest(n, m) * a)
    most = F.least(i, j) + 1 + F.least(n - i, m - j) - 1
    return sizes & (most * (a + b) >= a * (n + m))


def postings(groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(short, long): ``t, g, n, i`` of the shingles that two groups or more hold in their prefixes; long with ``often``."""
    flat = groups.select("g", "n", F.posexplode(F.arrays_zip("prefix", "often")).alias("i", "x")).select(F.col("x.prefix").alias("t"), "g", "n", F.col("i").cast("long").alias("i"), F.col("x.often").alias("often"))
    # those not known as frequent have bounded lists, but for what the counting left out
    rare = flat.where(~F.col("often")).drop("often")
    held = stored(rare.groupBy("t").agg(F.count("*").alias("c")).where("c > 1"), "jaccard-held")  # counted before the shuffle, however long a list is
    rare = stored(rare.join(held, "t"), "jaccard-rare")
    often = stored(flat.where("often").unionByName(rare.where(F.col("c") > LONG_LIST).drop("c").withColumn("often", F.lit(False))), "jaccard-often")
    size = often.groupBy("t").agg(F.count("*").alias("c")).where("c > 1")
    long_ = stored(often.join(stored(size, "jaccard-lengths"), "t").where(F.col("c") > 1).drop("c"), "jaccard-long")
    return rare.where(F.col("c") <= LONG_LIST).drop("c"), long_


def group_info(groups: DataFrame, long_: DataFrame) -> DataFrame:
    """``g, n, l, s, o`` and parity bits: long lists a group stands in, shingles of its prefix that are neither frequent nor of
    long lists, whether it holds a frequent one.

    A group with a frequent shingle in its prefix has all its others there.
    """
    l = long_.groupBy("g").agg(F.count("*").alias("l"), F.count_if(~F.col("often")).alias("r"))
    rows = groups.join(l, "g", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in "lr"})
    rare = F.size(F.filter("often", lambda x: ~x)) - F.col("r")
    return rows.select("g", "n", "l", rare.alias("s"), F.exists("often", lambda x: x).alias("o"), *_BITS)


def _size_class(n: str, threshold: tuple[int, int]) -> Column:
    """Classes of set sizes: linked sets are in the same one or in neighbours.

    A class is wider than the ratio of linked sizes by more than the error of the logarithm.
    """
    a, b = threshold
    return F.floor(F.log(F.col(n).cast("double")) / float(np.log(b / a) * (1 + 1e-9))).cast("int")


def _room(x: str, y: str, k: Column | int, threshold: tuple[int, int]) -> Column:
    """Whether two groups that share k shingles of short lists can have enough in common.

    The other short ones of x are not in y if y's prefix holds all of y's, and the other way round.
    """
    a, b = threshold
    c = lambda s, name: F.col(f"{s}{name}")
    fits = lambda s: (c(s, "n") - c(s, "s") + k) * (a + b) >= a * (c(x, "n") + c(y, "n"))
    return (~c(y, "o") | fits(x)) & (~c(x, "o") | fits(y))


def _near(x: str, y: str, threshold: tuple[int, int]) -> Column:
    """Whether the parity bits of two sets, or those that all sets of two groups agree in, allow a link."""
    a, b = threshold
    c = lambda s, name: F.col(f"{s}{name}")
    apart = F.lit(0)
    for v, d in zip(_VALUES, _DIFFERING, strict=True):
        apart += F.bit_count(c(x, v).bitwiseXOR(c(y, v)).bitwiseAND(F.bitwise_not(c(x, d).bitwiseOR(c(y, d)))))
    return apart * (a + b) <= (c(x, "n") + c(y, "n")) * (b - a)


def _named(table: DataFrame, side: str, key: str, *columns: str) -> DataFrame:
    """The columns with the side's letter in front; the key as the side itself."""
    return table.select(F.col(key).alias(side), *[F.col(c).alias(f"{side}{c}") for c in columns])


def short_pairs(short: DataFrame, long_: DataFrame, info: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """``a, b, k``: groups that share k shingles with short lists and, with those in long lists, enough."""
    common = common_of(threshold)
    x, y = short.alias("x"), short.alias("y")
    hit = x.join(y, (F.col("x.t") == F.col("y.t")) & (F.col("x.g") < F.col("y.g"))).where(_may_link(F.col("x.n"), F.col("x.i"), F.col("y.n"), F.col("y.i"), threshold))
    pairs = hit.groupBy(F.col("x.g").alias("a"), F.col("y.g").alias("b")).agg(F.count("*").alias("k"))
    for s in ("a", "b"):
        pairs = pairs.join(_named(info, s, "g", *"nlso", *_BITS), s)
    pairs = stored(pairs.where((F.col("k") + F.least("al", "bl") >= common) & _room("a", "b", F.col("k"), threshold) & _near("a", "b", threshold)).select("a", "b", "k"), "jaccard-short")
    sure, open_ = pairs.where(F.col("k") >= common), pairs.where(F.col("k") < common)
    # the others need shingles in long lists that both hold
    more = open_.join(long_.select(F.col("g").alias("a"), "t"), "a").join(long_.select(F.col("g").alias("b"), "t"), ["b", "t"])
    more = more.groupBy("a", "b", "k").agg(F.count("*").alias("l")).where(F.col("k") + F.col("l") >= common)
    return sure.unionByName(more.select("a", "b", "k"))


def hub_pairs(long_: DataFrame, info: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """``a, b``: each group with the hubs of its size class in each long list, and hubs of neighbouring classes.

    Every other hub is one of those with the fewest rare shingles. Pairs that can only link by short lists too are left to ``short_pairs``.
    """
    sized = long_.withColumn("w", _size_class("n", threshold))
    # other hubs in each list, so that a group that stands in many meets many
    draw = lambda j: [F.xxhash64("g", "t", F.lit(j)).alias("h"), F.col("g")]
    least = [F.min(F.struct(*(["s"] if j % 2 == 0 else []), *draw(j)))["g"] for j in range(HUBS)]
    hubs = stored(sized.groupBy("t", "w").agg(F.array_distinct(F.array(*least)).alias("hubs")).withColumn("hub", F.col("hubs")[0]), "jaccard-hubs")
    own = sized.join(hubs, ["t", "w"]).select(F.col("g").alias("a"), F.explode("hubs").alias("b"))
    next_ = hubs.alias("x").join(hubs.alias("y"), (F.col("x.t") == F.col("y.t")) & (F.col("x.w") + 1 == F.col("y.w"))).select(F.col("x.hub").alias("a"), F.col("y.hub").alias("b"))
    both = own.unionByName(next_).where("a <> b")
    both = both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    for s in ("a", "b"):
        both = both.join(_named(info, s, "g", *"nso", *_BITS), s)
    return both.where(_room("a", "b", 0, threshold) & _near("a", "b", threshold)).select("a", "b")


def unlike(entries: DataFrame, bits: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """``a, b``: members that stand together in a list and are not known to be in one component.

    Entries: key, id, n, i, lo, hi, s, o; lo and hi bound the component labels of a member. ``bits`` has id and
    parity bits. Every such pair has a
    side outside the list's most common component, so a list that one component covers costs nothing. A list is joined by
    size class, so that members whose sizes rule a link out do not meet. A pair is met in the first list that
    it shares; where that lies more than EARLIER lists back, it may be met again.
    """
    entries = entries.withColumn("label", F.when(F.col("lo") == F.col("hi"), F.col("lo"))).withColumn("w", _size_class("n", threshold))
    by_label = entries.groupBy("key", "label").agg(F.count("*").alias("m"), F.min("w").alias("from"), F.max("w").alias("to"))
    common = by_label.groupBy("key").agg(F.max(F.struct(F.col("label").isNotNull(), "m", "label")).alias("top"), F.count("*").alias("labels"), F.min("from").alias("from"), F.max("to").alias("to"))
    common = stored(common.where((F.col("labels") > 1) | F.col("top.label").isNull()).select("key", F.col("top.label").alias("top"), "from", "to"), "jaccard-common")
    kept = entries.join(common, "key").withColumn("other", F.col("label").isNull() | ~F.col("label").eqNullSafe(F.col("top"))).drop("top")
    before = Window.partitionBy("id").orderBy("key").rowsBetween(-EARLIER, -1)
    kept = stored(kept.join(bits, "id").withColumn("earlier", F.collect_list("key").over(before)), "jaccard-unlike")
    names = {s: kept.select(*[F.col(c).alias(f"{s}{c}") for c in kept.columns]) for s in ("x", "y")}
    # of two sides outside, the smaller id stands left, so that a pair is met once a list
    once = ~F.col("yother") | (F.col("xid") < F.col("yid"))
    differ = F.coalesce(F.col("xlabel") != F.col("ylabel"), F.lit(True)) & (F.col("xid") != F.col("yid"))
    may = _may_link(F.col("xn"), F.col("xi"), F.col("yn"), F.col("yi"), threshold) & _room("x", "y", 0, threshold) & _near("x", "y", threshold) & ~F.arrays_overlap("xearlier", "yearlier")
    # a side outside looks in its own class and those beside it, as far as the list has them
    beside = F.explode(F.sequence(F.greatest(F.col("xw") - 1, "xfrom"), F.least(F.col("xw") + 1, "xto")))
    hit = names["x"].where("xother").withColumn("xbeside", beside).join(names["y"], (F.col("xkey") == F.col("ykey")) & (F.col("xbeside") == F.col("yw")) & once & differ & may)
    return hit.select(F.least("xid", "yid").alias("a"), F.greatest("xid", "yid").alias("b")).distinct()


# ---------------------------------------------------------------- verifying


def _picked(ids: DataFrame) -> DataFrame:
    """With a broadcast hint while there are few (16 bytes each)."""
    return F.broadcast(ids) if ids.count() <= MAX_IDS else ids


def node_texts(docs: DataFrame, wanted: DataFrame, k: int, repeated: bool) -> DataFrame:
    """``node, n, text``: one text for each wanted node (columns node, doc). ``repeated``: ids may occur twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            want = b.column("node").to_numpy()
            keep, n = np.zeros(b.num_rows, dtype=bool), np.zeros(b.num_rows, dtype=np.int64)
            for row, end, data, at in blocks(b.column("text")):
                s_all, first = text_sets(data, at, k)
                n[row:end] = np.diff(first)
                for d in range(end - row):
                    keep[row + d] = n[row + d] > 0 and fingerprint(s_all[first[d] : first[d + 1]]) == want[row + d]
            out = pa.RecordBatch.from_arrays([b.column("node"), pa.array(n), b.column("text")], names=["node", "n", "text"])
            yield out.filter(pa.array(keep))

    found = docs.join(_picked(wanted), "doc").select("node", "text").mapInArrow(run, "node long, n long, text string")
    return stored(found.dropDuplicates(["node"]) if repeated else found, "jaccard-texts")


def verified(pairs: DataFrame, texts: DataFrame, k: int, threshold: tuple[int, int]) -> DataFrame:
    """The pairs of nodes (a, b) whose sets link. Texts travel, which are smaller than their sets."""
    a_, b_ = threshold

    def sets(column: pa.Array) -> list[np.ndarray]:
        out = []
        for _, _, data, at in blocks(column):
            s_all, first = text_sets(data, at, k)
            out += np.split(s_all, first[1:-1])
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for s, t in zip(sets(batch.column("x")), sets(batch.column("y")), strict=True):
                both = np.sort(np.concatenate([s, t]), kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep.append(b_ * common >= a_ * (len(s) + len(t) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    texts = texts.join(_picked(ends), "node", "left_semi")
    side = lambda s, v: texts.select(F.col("node").alias(s), F.col("n").alias(f"n{s}"), F.col("text").alias(v))
    fit = (F.least("na", "nb") * b_) >= (F.greatest("na", "nb") * a_)
    rows = pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").where(fit).select("a", "b", "x", "y")
    return rows.mapInArrow(run, "a long, b long")


def components(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """Stored ``node, root, low``: for nodes with links the root of their component and its smallest document.

    Labels (smallest document, node) spread along links and jump to their own label's label, so rounds
    grow with the logarithm of the longest chain; every round is written to the shared folder.
    """
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "jaccard-links")
    ends = both.select(F.col("a").alias("node")).distinct()
    labels = stored(ends.join(nodes.groupBy("node").agg(F.min("rep").alias("low")), "node").select("node", F.col("node").alias("root"), "low"), "jaccard-labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), F.struct("low", "root").alias("l")), "b").groupBy("a").agg(F.min("l").alias("l"))
        step = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", F.col("root").alias("was"), F.least(F.struct("low", "root"), F.col("l")).alias("l"))
        step = stored(step.select("node", "was", F.col("l.root").alias("root"), F.col("l.low").alias("low")), "jaccard-step")
        up = step.select(F.col("node").alias("root"), F.struct("low", "root").alias("up"))
        now = stored(step.select("node", "was", "root", "low").join(up, "root").select("node", "was", F.col("up.root").alias("root"), F.col("up.low").alias("low")), "jaccard-labels")
        changed = now.where("root <> was").limit(1).count()
        labels = now.select("node", "root", "low")
        if not changed:
            return labels


def joined(labels: DataFrame, more: DataFrame, nodes: DataFrame) -> DataFrame:
    """The labels after further links. Many links between two components are one, so only pairs of components spread labels."""
    of = lambda s: labels.select(F.col("node").alias(s), F.col("root").alias(f"r{s}"))
    both = more.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    pairs = stored(both.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "jaccard-contracted")
    known = nodes.select("node", "rep").unionByName(labels.select(F.col("root").alias("node"), F.col("low").alias("rep")).distinct())
    top = components(pairs, known)
    up = top.select(F.col("node").alias("root"), F.col("root").alias("top"), F.col("low").alias("least"))
    old = labels.join(up, "root", "left").select("node", F.coalesce("top", "root").alias("root"), F.coalesce("least", "low").alias("low"))
    return stored(old.unionByName(top.join(labels.select("node"), "node", "left_anti").select("node", "root", "low")), "jaccard-labels")


# ---------------------------------------------------------------- the operator


def _doc() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))


def near_duplicates(docs: DataFrame, k: int = NGRAM, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of ``docs``.

    Null, empty and blank texts have an empty set, link with nothing and are their own component. Rows with
    equal sets are linked. A null doc_id stands after all others: its component_id is null unless it
    is linked with a document that has an id. Rows that repeat a doc_id are nodes by their own text. Empty input
    gives an empty result. Long texts are read whole; other columns of ``docs`` are not read, so their names cannot clash. Sets
    are compared by 56-bit shingle hashes and lengths. The id 2^63 - 1 stands for null.
    """
    out = _assigned(docs.select(_doc().alias("doc"), "text"), k, threshold)
    null_last = lambda c: F.when(c != _LAST, c)
    return out.select(null_last(F.col("doc")).alias("doc_id"), F.col("n").alias("n_shingles"), null_last(F.when(F.col("n") > 0, F.col("low")).otherwise(F.col("doc"))).alias("component_id"))


def _assigned(own: DataFrame, k: int = NGRAM, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """doc, h (if given), n and, for rows with shingles, root and low (a component and its smallest doc) for each row of ``own``."""
    small_batches(own.sparkSession)
    sets = set_table(own, k, threshold)
    nodes = stored(sets.where("n > 0").groupBy("node", "grp", "n").agg(F.min("doc").alias("rep"), *[F.any_value(c).alias(c) for c in _VALUES]), "jaccard-nodes")
    grouped = nodes.where("grp <> 0")
    groups = stored(sets.where("grp <> 0").groupBy(F.col("grp").alias("g"), "n").agg(F.any_value("prefix").alias("prefix"), F.any_value("often").alias("often"), *[F.bit_or(c).alias(c) for c in _VALUES], *[F.bit_or(v).bitwiseXOR(F.bit_and(v)).alias(d) for v, d in zip(_VALUES, _DIFFERING, strict=True)]), "jaccard-groups")
    short, long_ = postings(groups)
    info = stored(group_info(groups, long_), "jaccard-info")
    cand = stored(short_pairs(short, long_, info, threshold), "jaccard-pairs")
    # a pair that shares a short list is in cand; one that does not stands in ``common`` long lists or more
    common = common_of(threshold)
    deep = stored(long_.join(info.where(F.col("l") >= common).select("g", "s", "o"), "g"), "jaccard-deep")
    hubs = stored(hub_pairs(deep, info, threshold), "jaccard-stars")
    heads = stored(grouped.groupBy(F.col("grp").alias("g")).agg(F.min("node").alias("head"), F.count("*").alias("members")), "jaccard-heads")

    # a text of every node that can be compared
    in_play = cand.select(F.col("a").alias("g")).union(cand.select("b")).union(deep.select("g")).union(heads.where("members > 1").select("g")).distinct()
    wanted = stored(grouped.join(in_play, grouped["grp"] == in_play["g"], "left_semi").select("node", F.col("rep").alias("doc")), "jaccard-wanted")
    repeated = sets.groupBy("doc").agg(F.count("*").alias("c")).where("c > 1").limit(1).count() > 0
    texts = node_texts(own, wanted, k, repeated)

    # first round: best partners, hubs, and members with the head of their group
    best = cand.groupBy("a").agg(F.max(F.struct("k", "b")).alias("m")).select("a", F.col("m.b").alias("b")).unionByName(cand.groupBy("b").agg(F.max(F.struct("k", "a")).alias("m")).select(F.col("m.a").alias("a"), "b"))
    first = best.unionByName(hubs).distinct()
    for s in ("a", "b"):
        first = first.join(heads.select(F.col("g").alias(s), F.col("head").alias(f"h{s}")), s)
    first = first.select(F.col("ha").alias("a"), F.col("hb").alias("b"))
    inner = grouped.join(heads.where("members > 1"), grouped["grp"] == heads["g"]).where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    links = stored(verified(stored(first.unionByName(inner), "jaccard-first"), texts, k, threshold), "jaccard-links1")
    labels = components(links, nodes)

    # second round: whatever may link across components
    marked = stored(grouped.join(labels.select("node", "root"), "node", "left").select("node", "grp", "n", F.coalesce("root", "node").alias("label"), *_VALUES, *[F.lit(0).cast("long").alias(d) for d in _DIFFERING]), "jaccard-marked")
    spans = stored(marked.groupBy(F.col("grp").alias("g")).agg(F.min("label").alias("lo"), F.max("label").alias("hi")), "jaccard-spans")
    apart = cand
    for s in ("a", "b"):
        apart = apart.join(spans.select(F.col("g").alias(s), F.col("lo").alias(f"lo{s}"), F.col("hi").alias(f"hi{s}")), s)
    apart = apart.where(~((F.col("loa") == F.col("hia")) & (F.col("lob") == F.col("hib")) & (F.col("loa") == F.col("lob")))).select("a", "b")
    listed = deep.join(spans, "g").select(F.col("t").alias("key"), F.col("g").alias("id"), "n", "i", "lo", "hi", "s", "o")
    apart = apart.unionByName(unlike(listed, info.select(F.col("g").alias("id"), *_BITS), threshold)).distinct()
    for s in ("a", "b"):
        apart = apart.join(_named(marked, s, "grp", "node", "label", "n", *_BITS), s)
    apart = apart.where((F.col("alabel") != F.col("blabel")) & _near("a", "b", threshold)).select(F.least("anode", "bnode").alias("a"), F.greatest("anode", "bnode").alias("b"))
    members = marked.join(heads.where("members > 1"), marked["grp"] == heads["g"], "left_semi").select(F.col("grp").alias("key"), F.col("node").alias("id"), "n", F.lit(0).cast("long").alias("i"), F.col("label").alias("lo"), F.col("label").alias("hi"), F.lit(0).alias("s"), F.lit(False).alias("o"))
    second = stored(apart.unionByName(unlike(members, marked.select(F.col("node").alias("id"), *_BITS), threshold)).distinct(), "jaccard-second")
    more = stored(verified(second, texts, k, threshold), "jaccard-links2")
    if more.limit(1).count():
        labels = joined(labels, more, nodes)

    lows = nodes.groupBy("node").agg(F.min("rep").alias("rep"))
    final = stored(lows.join(labels.select("node", "low", "root"), "node", "left").select("node", F.coalesce("low", "rep").alias("low"), F.coalesce("root", "node").alias("root")), "jaccard-final")
    return sets.select(*[c for c in ("doc", "h", "n", "node") if c in sets.columns]).join(final, "node", "left")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One row of each component, with its columns: of those with the smallest id (null last) the one whose text is
    smallest in byte order. Rows without shingles all stay.

    Rows are told apart by id and text hash, so those that share an id are decided on by their own texts.
    Of rows alike in both, the one whose other columns come first as JSON stays.
    """
    own = docs.select(_doc().alias("doc"), F.xxhash64("text").alias("h"), "text")
    found = stored(_assigned(own, **options), "jaccard-rows")
    texts = found.where("n > 0").groupBy("root", "doc", "h").agg(F.count("*").alias("c"))
    first = texts.groupBy("root").agg(F.min("doc").alias("doc"))
    first = stored(texts.join(first, ["root", "doc"]), "jaccard-first-texts")
    low = stored(first.groupBy("root").agg(F.min("doc").alias("doc"), F.min("h").alias("h"), F.count("*").alias("texts"), F.sum("c").alias("c")), "jaccard-low")
    once = low.where("texts = 1 AND c = 1").select("doc", "h").unionByName(found.where("n = 0").select("doc", "h").distinct())
    often = low.where("texts = 1 AND c > 1").select("doc", "h")
    if low.where("texts > 1").limit(1).count():
        several = first.join(low.where("texts > 1").select("root"), "root").select("root", "doc", "h")
        least = own.join(several, ["doc", "h"]).groupBy("root", "doc").agg(F.min("text").alias("text"))
        often = often.unionByName(least.select("doc", F.xxhash64("text").alias("h")))
    named = lambda keep: keep.select(F.col("doc").alias("_id"), F.col("h").alias("_h"))
    keyed = lambda keep: docs.join(named(keep), (_doc() == F.col("_id")) & (F.xxhash64("text") == F.col("_h")))
    out = keyed(once).drop("_id", "_h")
    often = stored(often, "jaccard-often-rows")
    if often.limit(1).count():
        others = F.to_json(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]))
        rows = keyed(often).select("_id", "_h", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), others.alias("_by"))
        out = out.unionByName(rows.groupBy("_id", "_h").agg(F.min_by("_row", "_by").alias("_row")).select("_row.*"))
    return out
