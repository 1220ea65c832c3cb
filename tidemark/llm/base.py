"""Shared pieces of the corpus operators: shared-folder tables and vectorised word splitting.

Text work runs in ``mapInArrow`` so that nulls, 64-bit ids and unrelated columns
pass through untouched. Words are found and hashed for a whole block of texts with
numpy; a block holds a bounded number of bytes (one text at least).
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes in an Arrow batch sent to Python, one row at least; they bound a worker's memory for long texts.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20
#: Text bytes that one numpy pass handles; several arrays of 8 bytes for each of them stand in a worker's memory.
BLOCK_BYTES = 512 << 10
#: ``[\x20\x09-\x0D]`` as bytes.
SPACES = b" \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables, with the batch size that the operators assume."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Lower the rows and bytes in an Arrow batch to BATCH_ROWS and BATCH_BYTES when they are more."""
    if not 0 < int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; where none is set, a temporary one for a local master, else an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = f"file://{tempfile.mkdtemp(prefix='tidemark-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and return the written table.

    Cuts the lineage: what reads it needs no recomputation after an executor is lost. The tables of an
    application stand in one folder, which may go when the application has ended.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidemark-{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column, modulus: int, rest: int) -> Column:
    """Whether crc32 of the id as text leaves ``rest``; a null id counts as the text ``''``."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(modulus)) == rest


def present(known: DataFrame, docs: DataFrame) -> DataFrame:
    """The labels of ids that ``docs`` holds."""
    return known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")


def labelled(docs: DataFrame, known: DataFrame, label: str, rows: int) -> DataFrame:
    """``doc_id, text`` and the label of at most ``rows`` ids of either class (0, 1) of ``known``, those with the smallest id hashes.

    ``known`` holds ids of ``docs`` only (see ``present``), so that the bound is one on labelled rows. One row for each id: of several texts the smallest (null only if there is no other), so that
    an id that many rows repeat stays one row and reruns agree.
    """
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [known.where(F.col(label) == y).orderBy(*order).limit(rows) for y in (0, 1)]
    found = docs.select("doc_id", "text").join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")  # at most 2 x rows ids
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.min(label).alias(label))


def packed(docs: DataFrame) -> DataFrame:
    """The row as one struct ``_row``: keeps an operator's own column names from clashing with the input's."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))


def text_of(batch: pa.RecordBatch) -> pa.Array:
    """The texts of a batch of packed rows, which so travel to Python once; null where there is no such column."""
    row = batch.column("_row")
    at = row.type.get_field_index("text")
    return row.field(at) if at >= 0 else pa.nulls(len(row), pa.string())


# ---------------------------------------------------------------- hashing

_M1, _M2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93
_INV = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of uint64 values (the splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        return x ^ (x >> np.uint64(31))


def _power(name: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        out = np.full(max(n + n // 8, BLOCK_BYTES + 4096), base, dtype=np.uint64)
        out[0] = 1
        with np.errstate(over="ignore"):
            have = _powers[name] = np.multiply.accumulate(out)
    return have[:n]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base of rolling hashes, and of its inverse."""
    return _power("p", _BASE, n), _power("i", _INV, n)


def byte_table(separators: bytes | None = None, word_bytes: bytes | None = None) -> np.ndarray:
    """A 256-entry map that lower-cases A-Z and sends separators to 0."""
    keep = set(range(256)) - set(separators) if separators is not None else set(word_bytes)
    return np.array([(c + 32 if 65 <= c <= 90 else c) if c in keep and c else 0 for c in range(256)], dtype=np.uint8)


#: Words ``[^\x20\x09-\x0D]+``; NUL is an ordinary word byte there and gets the code 0xFF, which UTF-8 never holds.
SPACED = byte_table(SPACES)
SPACED[0] = 0xFF
#: Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing: digits, letters and all non-ASCII.
ALNUM = byte_table(word_bytes=b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ" + bytes(range(128, 256)))


class Words:
    """The words of a block of texts, in order.

    ``start``/``end`` are byte positions in ``data``, ``doc`` is the row within the block,
    ``first`` holds for each row the number of its first word (one more entry at the end).
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, codes: np.ndarray):
        self.data, self.offsets = data, offsets
        b = codes[data]
        inside = b != 0
        n = len(data)
        edge = np.zeros(n + 1, dtype=bool)
        edge[offsets] = True
        prev = np.zeros(n + 1, dtype=bool)
        prev[1:] = inside
        begin = inside & (~prev[:n] | edge[:n])
        after = np.zeros(n + 1, dtype=bool)
        after[:n] = inside
        stop = inside & (~after[1:] | edge[1:])
        self.start = np.flatnonzero(begin)
        self.end = np.flatnonzero(stop) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self._b = b

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each (lower-cased) word."""
        n = len(self._b)
        sums = np.zeros(n + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(self._b.astype(np.uint64) * _power("p", _BASE, n), out=sums[1:])
            h = (sums[self.end] - sums[self.start]) * _power("i", _INV, n)[self.start] if n else sums[:0]
            return mix(h + (self.end - self.start).astype(np.uint64) * _GOLD)


_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words in ``h`` (``k`` up to 5)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        s = np.full(n, np.uint64(k), dtype=np.uint64)
        for j in range(k):
            s += h[j : j + n] * _K[j]
        return mix(s)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    at = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[at[0] : at[-1]] if raw is not None and len(at) else np.empty(0, np.uint8)
    return data, at - at[0]


def blocks(column: pa.Array, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of rows of at most ``most`` bytes, one row at least."""
    data, at = utf8(column)
    row, rows = 0, len(at) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(at, at[row] + most, side="right")) - 1)
        yield row, end, data[at[row] : at[end]], at[row : end + 1] - at[row]
        row = end


def sums_by_doc(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of per-word values for each row of a block."""
    c = np.concatenate([[0], np.cumsum(values)])
    return c[first[1:]] - c[first[:-1]]


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the length of each row's list."""
    at = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values, kind))
