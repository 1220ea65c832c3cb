"""Benchmark decontamination with suffix arrays over the training documents.

Documents are read in shards of a bounded number of words. Each shard gets a suffix array over its
words, sorted by prefix doubling; every suffix of every benchmark item is binary-searched in it, which gives its
longest verbatim match in the shard. A window of an item (WINDOW words, or the whole item if
shorter) occurs where the suffix array has suffixes that start with it, which is one range of
the array; equal windows are looked up once. The places found are searched in the suffix array of the benchmark in turn,
which tells the longest match of each document and where it stands in both. Nothing is shuffled: the benchmark goes to the documents, in
blocks of bounded size.

Words that no benchmark item holds end every match, so suffixes start only at words of the benchmark
and are sorted about as deep as the longest item.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import ALNUM, Words, blocks, mix, packed, powers, small_batches, text_of, utf8

WINDOW = 10
#: Words of documents in one suffix array, one document at least.
SHARD_WORDS = 500_000
#: Text bytes of benchmark items in one suffix array.
BENCH_BYTES = 16 << 20


class Sequence:
    """Word numbers (1 and up) with a 0 after each text, and hashes of all their prefixes.

    ``left`` holds for each place the words up to the next 0. Runs of words are equal when their 64-bit hashes are.
    """

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.words = words
        zero = np.flatnonzero(words == 0)
        self.left = zero[np.searchsorted(zero, np.arange(n))] - np.arange(n)
        self._sums = np.zeros(n + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(mix(words.astype(np.uint64)) * powers(n + 1)[0][:n], out=self._sums[1:])
        self._back = powers(n + 1)[1]

    def hash(self, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self._sums[at + size] - self._sums[at]) * self._back[at]

    def common(self, at: np.ndarray, other: Sequence, place: np.ndarray, most: np.ndarray | None = None) -> np.ndarray:
        """Words that the texts share from these places on, at most ``most``: found by halving, not word by word."""
        room = np.minimum(self.left[at], other.left[place])
        room = room if most is None else np.minimum(room, most)
        out = np.zeros(len(at), dtype=np.int64)
        step = 1 << int(room.max(initial=0)).bit_length()
        while step := step >> 1:
            todo = np.flatnonzero(out + step <= room)
            more = out[todo] + step
            out[todo[self.hash(at[todo], more) == other.hash(place[todo], more)]] += step
        return out


class SuffixArray(Sequence):
    """The suffixes of texts in order; deeper than ``depth`` words they may stand in any."""

    def __init__(self, words: np.ndarray, depth: int):
        super().__init__(words)
        self.at = np.flatnonzero(words)
        rank = np.zeros(len(words) + 1, dtype=np.int64)
        rank[: len(words)] = words
        order = np.argsort(rank[self.at], kind="stable")
        self.at, size = self.at[order], 1
        new = np.ones(len(self.at), dtype=bool)
        new[1:] = words[self.at[1:]] != words[self.at[:-1]]
        # each turn orders by twice as many words, by the ranks of both halves
        while size < depth:
            rows = np.flatnonzero(~(new & np.append(new[1:], True)) & (self.left[self.at] >= size))
            if not len(rows):
                break
            at, group = self.at[rows], np.cumsum(new)[rows]
            second = rank[at + size]
            order = np.lexsort((second, group))
            self.at[rows], second = at[order], second[order]
            new[rows] = np.append(True, (group[1:] != group[:-1]) | (second[1:] != second[:-1]))
            # suffixes that ended before are first in their group and equal to one another
            rank[self.at] = np.cumsum(new)
            size *= 2
        self.first = words[self.at]

    def bound(self, other: Sequence, place: np.ndarray, length: np.ndarray, upper: bool) -> np.ndarray:
        """The first rank whose suffix is not before (upper: is after) the first words of the other's suffixes, by binary search."""
        # the ranks that share the first word
        word = other.words[place]
        lo, hi = np.searchsorted(self.first, word, side="left"), np.searchsorted(self.first, word, side="right")
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            mid = (lo[open_] + hi[open_]) >> 1
            mine, p, n = self.at[mid], place[open_], length[open_]
            k = self.common(mine, other, p, n)
            # the first words that differ; the end of a text is before any word
            a, b = self.words[mine + k], np.where(k < n, other.words[p + np.minimum(k, n - 1)], 0)
            right = np.where(k >= n, upper, a < b)
            lo[open_[right]] = mid[right] + 1
            hi[open_[~right]] = mid[~right]

    def longest(self, other: Sequence, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each of the other's suffixes the length of its longest match here, and the place of one such match."""
        if not len(self.at) or not len(place):
            return np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        rank = self.bound(other, place, other.left[place], upper=False)
        near = [self.at[np.clip(rank + d, 0, len(self.at) - 1)] for d in (-1, 0)]
        size = [self.common(p, other, place) for p in near]
        return np.maximum(*size), np.where(size[1] >= size[0], near[1], near[0])


    def only(self, keep: np.ndarray) -> SuffixArray:
        """The array of a part of the suffixes."""
        out = copy.copy(self)
        out.at, out.first = self.at[keep], self.first[keep]
        return out


class TestSet:
    """A block of benchmark items as word numbers, and their distinct windows."""

    __test__ = False

    def __init__(self, ids: list[str], texts: pa.Array, window: int = WINDOW):
        data, at = utf8(texts)
        w = Words(data, at, ALNUM)
        h, n = w.hashes(), w.count
        order = sorted(range(len(ids)), key=lambda i: ids[i])
        self.ids = [ids[i] for i in order]
        #: Of each item, where its id stands in order.
        self.rank = np.empty(len(ids), np.int64)
        self.rank[order] = np.arange(len(ids))
        self.vocabulary, word = np.unique(h, return_inverse=True)
        item = w.doc
        place = np.arange(len(h)) + item
        words = np.zeros(len(h) + len(n) + 1, dtype=np.int64)
        words[place] = word + 1
        longest = int(n.max()) if len(n) else 0
        self.suffixes = SuffixArray(words, longest)
        self.whole = window
        self.long = self.suffixes.only(self.suffixes.left[self.suffixes.at] >= window)
        self.item = np.zeros(len(words), dtype=np.int64)
        self.item[place] = item
        self.begin = np.concatenate([[0], np.cumsum(n + 1)])[:-1]
        # suffixes that start a window: ``window`` words, or a whole item of fewer; equal windows are one class
        size = np.minimum(n, window)[self.item[self.suffixes.at]] if len(n) else np.empty(0, np.int64)
        keep = self.suffixes.left[self.suffixes.at] >= size
        starts, size = self.suffixes.at[keep], size[keep]
        if len(starts):
            key = self.suffixes.hash(starts, size)
            _, self.window, of = np.unique(np.stack([key, size.astype(np.uint64)]), axis=1, return_index=True, return_inverse=True)
            self.size, self.window = size[self.window], starts[self.window]
        else:
            self.window, self.size, of = starts, size, np.empty(0, np.int64)
        #: (class, rank of an item's id), distinct, by class.
        self.members = np.unique(np.stack([of.reshape(-1), self.rank[self.item[starts]]], axis=1), axis=0)


def _spans(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, and which range each is of."""
    many = hi - lo
    which = np.repeat(np.arange(len(lo)), many)
    return np.repeat(lo - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(int(many.sum())), which


def _search(tests: TestSet, text: pa.Array) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[set[str]], list[tuple]]:
    """For each text of a shard: number of words, hit spans of words, items found, longest match (words, place, item, place in it)."""
    pieces, counts = [], []
    for _, _, data, at in blocks(text):
        w = Words(data, at, ALNUM)
        h = w.hashes()
        n = w.count
        known = np.minimum(np.searchsorted(tests.vocabulary, h), max(len(tests.vocabulary) - 1, 0))
        word = np.where(tests.vocabulary[known] == h, known + 1, 0) if len(tests.vocabulary) else np.zeros(len(h), np.int64)
        out = np.zeros(len(h) + len(n), dtype=np.int64)  # a 0 after each document
        out[np.arange(len(h)) + w.doc] = word
        pieces.append(out)
        counts.append(n)
    n = np.concatenate(counts) if counts else np.empty(0, np.int64)
    words = np.concatenate([*pieces, [0]])
    begin = np.concatenate([[0], np.cumsum(n + 1)])
    spans: list[list[tuple[int, int]]] = [[] for _ in n]
    items: list[set[str]] = [set() for _ in n]
    best: list[tuple] = [NONE for _ in n]
    array = SuffixArray(words, int(tests.suffixes.left.max(initial=0)))
    # every test suffix: how long it occurs in this shard; only windows that do are looked up
    size, _ = array.longest(tests.suffixes, tests.suffixes.at)
    longest = np.zeros(len(tests.suffixes.words), dtype=np.int64)
    longest[tests.suffixes.at] = size
    pick = np.flatnonzero(longest[tests.window] >= tests.size)
    if len(pick):
        q, length = tests.window[pick], tests.size[pick]
        rank, which = _ranges(array.bound(tests.suffixes, q, length, upper=False), array.bound(tests.suffixes, q, length, upper=True))
        place = array.at[rank]
        change = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(change, place, 1)
        np.add.at(change, place + length[which], -1)
        doc = np.searchsorted(begin, place, side="right") - 1
        for start, end in zip(*_spans(np.cumsum(change[:-1]) > 0), strict=True):
            d = int(np.searchsorted(begin, start, side="right") - 1)
            spans[d].append((int(start - begin[d]), int(end - begin[d])))
        found = np.unique(np.stack([doc, pick[which]], 1), axis=0)
        member, row = _ranges(np.searchsorted(tests.members[:, 0], found[:, 1]), np.searchsorted(tests.members[:, 0], found[:, 1], side="right"))
        for d, i in zip(found[row, 0].tolist(), tests.members[member, 1].tolist(), strict=True):
            items[d].add(tests.ids[i])
        for d, x in _longest(tests, array, begin, place, pick[which]):
            best[d] = x
    return n, spans, items, best


#: Without a match: (words, place, item, place in it).
NONE = (0, -1, "", -1)


def _longest(tests: TestSet, array: SuffixArray, begin: np.ndarray, place: np.ndarray, window: np.ndarray) -> Iterator[tuple[int, tuple]]:
    """For each document with occurrences (place, class of the window) its longest match that starts with one.

    Of equally long ones the first in the document, then the smallest item id, then the first place in that item.
    """
    order = np.lexsort((-tests.size[window], place))
    first = order[np.append(True, place[order][1:] != place[order][:-1])]
    place, window = place[first], window[first]
    # an item shorter than a window matches as a whole; others may go on behind it
    size = tests.size[window]
    at = np.flatnonzero(size >= tests.whole)
    size[at] = tests.long.longest(array, place[at])[0]
    doc = np.searchsorted(begin, place, side="right") - 1
    order = np.lexsort((place, -size, doc))
    first = order[np.append(True, doc[order][1:] != doc[order][:-1])]
    place, size, doc, window = place[first], size[first], doc[first], window[first]
    for k in np.flatnonzero(size < tests.whole).tolist():
        member = int(np.searchsorted(tests.members[:, 0], window[k]))
        yield int(doc[k]), (int(size[k]), int(place[k] - begin[doc[k]]), tests.ids[int(tests.members[member, 1])], 0)
    at = np.flatnonzero(size >= tests.whole)
    place, size, doc = place[at], size[at], doc[at]
    rank, which = _ranges(tests.long.bound(array, place, size, upper=False), tests.long.bound(array, place, size, upper=True))
    there = tests.long.at[rank]
    order = np.lexsort((there - tests.begin[tests.item[there]], tests.rank[tests.item[there]], which))
    first = order[np.append(True, which[order][1:] != which[order][:-1])] if len(order) else order
    for k, t in zip(which[first].tolist(), there[first].tolist(), strict=True):
        d, i = int(doc[k]), int(tests.item[t])
        yield d, (int(size[k]), int(place[k] - begin[d]), tests.ids[int(tests.rank[i])], int(t - tests.begin[i]))


_LONGEST = ("longest", "longest_at", "longest_item", "longest_item_at")


class _Last(str):
    """Text in reverse order, so that the greatest is the smallest."""

    def __lt__(self, other: str) -> bool:
        return str.__gt__(self, other)

    def __gt__(self, other: str) -> bool:
        return str.__lt__(self, other)


def _merged(a: list, b: list) -> list:
    out: list = []
    for s, e in sorted([*a, *b]):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


_FOUND = (("n_words", "long"), ("spans", "array<struct<start:bigint,stop:bigint>>"), ("items", "array<string>"), ("longest", "long"), ("longest_at", "long"), ("longest_item", "string"), ("longest_item_at", "long"))


def find_overlaps(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` as ``_row`` with what they share with the benchmark.

    n_words; spans (word ranges inside occurrences of windows, merged, end exclusive); items (ids of
    items with an occurring window, sorted); longest (words of the longest verbatim match that starts with
    a window), longest_at (its first word in the document), longest_item and longest_item_at (where it stands in the
    benchmark): of equally long matches the first in the document, of its sources the smallest id, then the first place (0, -1, '' and -1 without a match).
    Null and empty texts have no words and share nothing; items without words have no window; a
    null item_id is listed as ``null``. Repeated rows are searched each, long texts whole. Items that share an id are
    listed once. An empty benchmark shares nothing, an empty table gives an empty result. The input's columns stand in ``_row``,
    so their names cannot clash.

    The suffixes of the benchmark are sorted once, on the driver, in blocks of BENCH_BYTES, and the arrays are broadcast; a task looks a shard of
    documents up in one block after the other and holds one of them at a time.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = packed(docs)
    schema = f"_row {rows.schema['_row'].dataType.simpleString()}, " + ", ".join(f"{c} {t}" for c, t in _FOUND)
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + F.lit(16))).first()[0] or 0
    n_blocks = max(1, -(-size // BENCH_BYTES))
    held = []
    for k in range(n_blocks):
        # about BENCH_BYTES of items, whatever the size of the benchmark
        block = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks)) == k).toArrow()
        held.append(spark.sparkContext.broadcast(TestSet(block.column("id").to_pylist(), block.column("text").combine_chunks(), window)))
    return rows.mapInArrow(_pass(held), schema)


def _pass(held: list):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        weight = 0
        for b in batches:
            # about one word for each 6 bytes
            size = utf8(text_of(b))[1]
            step = max(1, int(b.num_rows * SHARD_WORDS * 6 / max(1, int(size[-1]))))
            for at in range(0, b.num_rows, step):
                kept.append(part := b.slice(at, step))
                weight += int(size[at + part.num_rows] - size[at])
                if weight >= SHARD_WORDS * 6:
                    yield from _shard(held, kept)
                    kept, weight = [], 0
        if kept:
            yield from _shard(held, kept)

    return run


#: The block that this worker holds: its broadcast and its arrays.
_block: list = []


def _loaded(held: list, k: int) -> TestSet:
    """Block ``k`` of the benchmark; with several blocks the one before is let go."""
    if len(held) == 1:
        return held[0].value
    if not _block or _block[0] is not held[k]:
        _block[:] = []
        _block[:] = [held[k], held[k].value]
        # the broadcast keeps no second reference, so that a worker holds one block
        held[k].__dict__.pop("_value", None)
    return _block[1]


def _shard(held: list, parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    text = pa.concat_arrays([text_of(b) for b in parts])
    n, spans, items, best = _search(_loaded(held, 0), text)
    for k in range(1, len(held)):
        _, more, others, better = _search(_loaded(held, k), text)
        spans, items = [_merged(a, b) for a, b in zip(spans, more, strict=True)], [a | b for a, b in zip(items, others, strict=True)]
        best = [max(a, b, key=lambda m: (m[0], -m[1], _Last(m[2]), -m[3])) for a, b in zip(best, better, strict=True)]
    span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
    new = [
        pa.array(n, pa.int64()),
        pa.array([[{"start": s, "stop": e} for s, e in x] for x in spans], pa.list_(span)),
        pa.array([sorted(x) for x in items], pa.list_(pa.string())),
        *[pa.array([x[i] for x in best], pa.string() if c == "longest_item" else pa.int64()) for i, c in enumerate(_LONGEST)],
    ]
    # batch by batch, so that no second copy of a shard's texts is made
    at = 0
    for b in parts:
        yield pa.RecordBatch.from_arrays([b.column("_row"), *[c.slice(at, b.num_rows) for c in new]], names=["_row", *[c for c, _ in _FOUND]])
        at += b.num_rows


def n_hit() -> Column:
    return F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["stop"] - s["start"])


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from ``find_overlaps``, with the longest match and its places after them."""
    return found.select(
        "_row.doc_id", "n_words", n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"), *_LONGEST,
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that share no window with the benchmark, with their own columns."""
    return find_overlaps(docs, benchmark, window).where(F.size("spans") == 0).select("_row.*")
