"""Line dedup: sharded cuckoo filters backed by an exact reference-count table.

The reference table has one row for each (line key, document); counting it gives the exact
number of documents that hold a key and the one that keeps it (the smallest doc_id). Keys
held by two documents or more are put into cuckoo filters, one a shard of the key space. A
filter answers whether a line may be repeated; what passes is
decided by the exact table, so false positives cost a lookup and never a line. While the filters are small they
are broadcast; larger ones travel to the references of their shard. The keys that most documents hold are
broadcast with their keepers, so that no key brings its documents together in one task. As the table
is exact and cuckoo filters can delete, adding and removing documents is reversible:
``with_documents`` and ``without_documents`` update the references, ``update_filters`` the filters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import SPACES, mix, small_batches, stored, text_of

#: Keys shorter than this many code points are never dropped.
MIN_CHARS = 10
#: Keys in one filter shard, on average.
SHARD_KEYS = 200_000
#: Broadcast filters at most this large; beyond it each shard's references are dealt to its filter.
FILTER_BYTES = 64 << 20
#: Keys held most often, whose keepers are broadcast (24 bytes each).
HEAVY_KEYS = 4096
SLOTS = 4
_LOWER = bytes((c + 32 if 65 <= c <= 90 else c) for c in range(256))
_LAST = (1 << 63) - 1


def line_keys(text: str | None) -> list[bytes]:
    """The key of each line: stripped of ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased."""
    return [x.strip(SPACES) for x in (text or "").encode().translate(_LOWER).split(b"\n")]


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode()) >= least)


def _halves(key: bytes) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(key)
    return int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)


# ---------------------------------------------------------------- cuckoo filter


class CuckooFilter:
    """Fingerprints of 16 bits in buckets of four; insert, delete and vectorised lookup."""

    def __init__(self, buckets: int, cells: np.ndarray | None = None, full: bool = False):
        self.buckets = 1 << max(1, (max(buckets, 1) - 1).bit_length())
        self.cells = np.zeros((self.buckets, SLOTS), dtype=np.uint16) if cells is None else cells.reshape(self.buckets, SLOTS).copy()
        #: Set when an insert found no room: every lookup then says yes.
        self.full = full

    @classmethod
    def of(cls, keys: np.ndarray) -> CuckooFilter:
        out = cls(max(2, int(len(keys) / (SLOTS * 0.7)) + 1))
        for h in keys.tolist():
            out.insert(h)
        return out

    def _places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        u = h.astype(np.int64).view(np.uint64)
        tag = (u >> np.uint64(48)).astype(np.uint16)
        tag[tag == 0] = 1
        one = (mix(u) & np.uint64(self.buckets - 1)).astype(np.int64)
        other = one ^ (mix(tag.astype(np.uint64)) & np.uint64(self.buckets - 1)).astype(np.int64)
        return tag, one, other

    def insert(self, h: int) -> None:
        tag, one, other = (x[0] for x in self._places(np.array([h], dtype=np.int64)))
        at, tag = int(one), int(tag)
        jump = int(one) ^ int(other)
        for place in (int(one), int(other)):
            free = np.flatnonzero(self.cells[place] == 0)
            if len(free):
                self.cells[place, free[0]] = tag
                return
        for turn in range(500):
            slot = (turn * 7 + tag) % SLOTS
            tag, self.cells[at, slot] = int(self.cells[at, slot]), tag
            jump = int(mix(np.array([tag], dtype=np.uint64))[0]) & (self.buckets - 1)
            at ^= jump
            free = np.flatnonzero(self.cells[at] == 0)
            if len(free):
                self.cells[at, free[0]] = tag
                return
        self.full = True

    def delete(self, h: int) -> bool:
        """Remove one copy; only keys that were inserted may be deleted."""
        tag, one, other = (x[0] for x in self._places(np.array([h], dtype=np.int64)))
        for place in (int(one), int(other)):
            hit = np.flatnonzero(self.cells[place] == tag)
            if len(hit):
                self.cells[place, hit[0]] = 0
                return True
        return False

    def may_hold(self, h: np.ndarray) -> np.ndarray:
        if self.full:
            return np.ones(len(h), dtype=bool)
        tag, one, other = self._places(h)
        return (self.cells[one] == tag[:, None]).any(1) | (self.cells[other] == tag[:, None]).any(1)

    def to_bytes(self) -> bytes:
        return (b"\x01" if self.full else b"\x00") + self.cells.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> CuckooFilter:
        cells = np.frombuffer(raw, dtype=np.uint16, offset=1)
        return cls(len(cells) // SLOTS, cells, raw[:1] == b"\x01")


# ---------------------------------------------------------------- reference counts


def _doc(doc_id: Column) -> Column:
    """A null id stands after all others, as one document."""
    return F.coalesce(doc_id.cast("long"), F.lit(_LAST))


def references(docs: DataFrame, least: int = MIN_CHARS, heavy=None) -> DataFrame:
    """``h1, h2, doc``: a row for each distinct long key of each row of ``docs``.

    With ``heavy``, a broadcast (h1, h2, keeper) of keys in order, also ``row`` (a hash of the text) and the keeper of those keys.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h1, h2, at = [], [], []
            for i, t in enumerate(b.column("text").to_pylist()):
                for k in {k for k in line_keys(t) if _long_enough(k, least)}:
                    x, y = _halves(k)
                    h1.append(x)
                    h2.append(y)
                    at.append(i)
            at = pa.array(at, pa.int64())
            out = {"h1": pa.array(h1, pa.int64()), "h2": pa.array(h2, pa.int64()), "doc": b.column("doc").take(at)}
            if heavy is not None:
                out |= {"row": b.column("row").take(at), "keeper": _keepers(np.array(h1, np.int64), np.array(h2, np.int64), *heavy.value)}
            yield pa.RecordBatch.from_pydict(out)

    own = [_doc(F.col("doc_id")).alias("doc"), F.col("text")] + ([F.xxhash64("text").alias("row")] if heavy is not None else [])
    return docs.select(*own).mapInArrow(emit, "h1 long, h2 long, doc long" + (", row long, keeper long" if heavy is not None else ""))


def _keepers(h1: np.ndarray, h2: np.ndarray, k1: np.ndarray, k2: np.ndarray, keeper: np.ndarray) -> pa.Array:
    """The keeper of each key that is one of (k1, k2), which stand in order of k1 without repeats; else null."""
    at = np.minimum(np.searchsorted(k1, h1), max(len(k1) - 1, 0))
    known = (k1[at] == h1) & (k2[at] == h2) if len(k1) else np.zeros(len(h1), bool)
    return pa.array(keeper[at] if len(k1) else np.zeros(len(h1), np.int64), pa.int64(), mask=~known)


def with_documents(refs: DataFrame, docs: DataFrame) -> DataFrame:
    """References after adding documents; adding one that is there already changes nothing."""
    return refs.unionByName(references(docs)).distinct()


def without_documents(refs: DataFrame, doc_ids: DataFrame) -> DataFrame:
    """References after removing the documents in ``doc_ids`` (column doc_id)."""
    return refs.join(doc_ids.select(_doc(F.col("doc_id")).alias("doc")).distinct(), "doc", "left_anti").select("h1", "h2", "doc")


def counts(refs: DataFrame) -> DataFrame:
    """``h1, h2, keeper, rows`` of the keys that two documents or more hold."""
    held = refs.groupBy("h1", "h2").agg(F.min("doc").alias("keeper"), F.max("doc").alias("_last"), F.count("*").alias("rows"))
    return held.where(F.col("keeper") < F.col("_last")).select("h1", "h2", "keeper", "rows")


def filters(repeated: DataFrame, shards: int) -> DataFrame:
    """``shard, cells``: a cuckoo filter for each shard of the repeated keys."""

    def build(t: pa.Table) -> pa.Table:
        shard = t.column("shard")[0].as_py()
        return pa.table({"shard": pa.array([shard], pa.int32()), "cells": pa.array([CuckooFilter.of(t.column("h1").to_numpy()).to_bytes()], pa.binary())})

    at = F.pmod(F.col("h2"), F.lit(shards)).cast("int")
    return repeated.select(at.alias("shard"), "h1").groupBy("shard").applyInArrow(build, "shard int, cells binary")


def update_filters(cells: DataFrame, before: DataFrame, after: DataFrame, shards: int) -> DataFrame:
    """Filters after a change of the repeated keys: new ones are inserted, ended ones deleted."""
    keys = ["h1", "h2"]
    change = before.select(*keys, F.lit(-1).alias("by")).unionByName(after.select(*keys, F.lit(1).alias("by")))
    change = change.groupBy(*keys).agg(F.sum("by").alias("by")).where("by <> 0")
    change = change.select(F.pmod(F.col("h2"), F.lit(shards)).cast("int").alias("shard"), "h1", "by")

    def apply(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        f = CuckooFilter.from_bytes(left.column("cells")[0].as_py()) if left.num_rows else CuckooFilter(max(2, right.num_rows))
        for h, by in zip(right.column("h1").to_pylist(), right.column("by").to_pylist(), strict=True):
            f.insert(h) if by > 0 else f.delete(h)
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "cells": pa.array([f.to_bytes()], pa.binary())})

    return cells.groupBy("shard").cogroup(change.groupBy("shard")).applyInArrow(apply, "shard int, cells binary")


# ---------------------------------------------------------------- the operator


def heaviest(repeated: DataFrame, most: int = HEAVY_KEYS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """h1, h2 and keeper of the keys held most often, in order of h1."""
    top = repeated.orderBy(F.desc("rows"), "h1", "h2").limit(most).toArrow()
    h1, h2, keeper = (top.column(c).to_numpy() for c in ("h1", "h2", "keeper"))
    _, at = np.unique(h1, return_index=True)
    return h1[at], h2[at], keeper[at]


def _kept(b: pa.RecordBatch, known: dict[int, CuckooFilter], shards: int) -> pa.RecordBatch:
    """Of the references those with a known keeper, and those that the filter of their shard may hold."""
    h1, h2 = (b.column(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2"))
    keep = b.column("keeper").is_valid().to_numpy(zero_copy_only=False).copy()
    shard = np.mod(h2, shards)
    for s in np.unique(shard[~keep]):
        if f := known.get(int(s)):
            at = np.flatnonzero((shard == s) & ~keep)
            keep[at] = f.may_hold(h1[at])
    return b.select(["h1", "h2", "doc", "row", "keeper"]).filter(pa.array(keep))


_REFERENCE = "h1 long, h2 long, doc long, row long, keeper long"


def by_broadcast(refs: DataFrame, cells: DataFrame, shards: int) -> DataFrame:
    """The references that may be repeated; all filters go to every task."""
    held = refs.sparkSession.sparkContext.broadcast({r["shard"]: bytes(r["cells"]) for r in cells.collect()})

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {s: CuckooFilter.from_bytes(c) for s, c in held.value.items()}
        for b in batches:
            yield _kept(b, known, shards)

    return refs.mapInArrow(probe, _REFERENCE)


def by_shard(refs: DataFrame, cells: DataFrame, shards: int) -> DataFrame:
    """The same for filters of any number: references are dealt to the task of their shard, where its filter comes first.

    References with a known keeper need no filter and are spread by document. A task holds one filter at a time.
    """
    mine = F.when(F.col("keeper").isNull(), F.pmod(F.col("h2"), F.lit(shards))).otherwise(-1 - F.pmod(F.xxhash64("doc", "row"), F.lit(shards)))
    dealt = refs.select("*", mine.cast("int").alias("shard"), F.lit(None).cast("binary").alias("cells"))
    zero = [F.lit(0).cast("long").alias(c) for c in ("h1", "h2", "doc", "row", "keeper")]
    both = dealt.unionByName(cells.select(*zero, "shard", "cells")).repartition("shard").sortWithinPartitions("shard", F.col("cells").isNull())

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, CuckooFilter] = {}
        for b in batches:
            raw, shard = b.column("cells"), b.column("shard").to_numpy()
            first = np.flatnonzero(raw.is_valid().to_numpy(zero_copy_only=False))
            ends = [*first[1:], b.num_rows] if len(first) else []
            yield _kept(b.slice(0, first[0] if len(first) else b.num_rows), known, shards)
            for a, e in zip(first, ends, strict=True):
                known = {int(shard[a]): CuckooFilter.from_bytes(raw[int(a)].as_py())}
                yield _kept(b.slice(a + 1, e - a - 1), known, shards)

    return both.mapInArrow(probe, _REFERENCE)


def drops(docs: DataFrame, least: int = MIN_CHARS) -> DataFrame:
    """``doc, row, keys``: for each document and text hash the 16-byte keys whose lines it loses."""
    spark = docs.sparkSession
    small_batches(spark)
    repeated = stored(counts(references(docs, least)), "line-counts")
    shards = max(1, -(-repeated.count() // SHARD_KEYS))
    cells = stored(filters(repeated, shards), "line-filters")
    size = cells.agg(F.sum(F.octet_length("cells"))).first()[0] or 0
    refs = references(docs, least, spark.sparkContext.broadcast(heaviest(repeated)))
    likely = (by_broadcast if size <= FILTER_BYTES else by_shard)(refs, cells, shards)
    # references whose keeper is known are spread by document instead of meeting at their key
    spread = F.when(F.col("keeper").isNull(), F.col("h1")).otherwise(F.xxhash64("doc", "row"))
    exact = repeated.select(F.col("h1").alias("_at"), F.col("h2").alias("_h2"), F.col("keeper").alias("_keeper"))
    found = likely.withColumn("_h1", spread).join(exact, F.col("keeper").isNull() & (F.col("_h1") == F.col("_at")) & (F.col("h2") == F.col("_h2")), "left")
    lost = found.where(F.coalesce("keeper", "_keeper") != F.col("doc"))
    key = F.concat(*[F.unhex(F.lpad(F.hex(c), 16, "0")) for c in ("h1", "h2")])
    return lost.groupBy("doc", "row").agg(F.collect_set(key).alias("keys"))


def dedup_lines(docs: DataFrame, least: int = MIN_CHARS) -> DataFrame:
    """The rows of ``docs`` as ``_row``, with ``kept``, ``n_lines`` and ``n_dropped``.

    Lines split at \\n; a null or empty text is one empty line, is kept and loses nothing
    (its ``kept`` is empty). A repeated key stays in every line of the document with the
    smallest id and goes from all others. Rows with the same doc_id count as one
    document; null ids count as one document after all others (as 2^63 - 1 would). Long texts are cut whole. An empty
    table gives an empty result. The input's columns stand in ``_row``, so their names cannot clash.
    """
    small_batches(docs.sparkSession)
    lost = drops(docs.select("doc_id", "text"), least)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), _doc(F.col("doc_id")).alias("doc"), F.xxhash64("text").alias("row")).join(lost, ["doc", "row"], "left")
    rows = rows.select("_row", "keys")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, n, gone = [], [], []
            for t, keys in zip(text_of(b).to_pylist(), b.column("keys").to_pylist(), strict=True):
                t = t or ""
                lines = t.split("\n")
                n.append(len(lines))
                if keys:
                    keys = set(keys)
                    stay = [x for x, k in zip(lines, line_keys(t), strict=True) if not (_long_enough(k, least) and xxhash.xxh3_128_digest(k) in keys)]
                    gone.append(len(lines) - len(stay))
                    t = "\n".join(stay)
                else:
                    gone.append(0)
                kept.append(t)
            sha = [hashlib.sha256(t.encode()).hexdigest() for t in kept]
            yield pa.RecordBatch.from_arrays([b.column("_row"), pa.array(kept, pa.string()), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())], names=["_row", "kept", "n_lines", "n_dropped", "kept_sha256"])

    schema = f"_row {rows.schema['_row'].dataType.simpleString()}, kept string, n_lines long, n_dropped long, kept_sha256 string"
    return rows.mapInArrow(cut, schema)


ORACLE = """
WITH src AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT rid, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM src),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, min(doc_id) AS keeper FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
d AS (SELECT k.*, r.keeper IS NOT NULL AND r.keeper <> k.doc_id AS gone FROM k LEFT JOIN r ON k.key = r.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INT)) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM d GROUP BY rid"""
