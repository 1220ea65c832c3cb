"""Shards by proportional stratified interleaving, with DataFrame functions only.

The rows of a source are shuffled by seeded hashes and ranked. A row's fractional rank, (rank + phase of its source) / rows of
the source, spreads every source evenly over [0, 1); the table sorted by fractional rank is cut into shards of equal row counts, so each
shard holds each source in its share, to within a row at either cut.

Nothing is sorted in one task: hashes and fractional ranks are both uniform, so equal ranges of them (some BUCKET_ROWS rows each, whatever the
source) are counted, and rows are ranked within their range only. A source with a third of all rows is split over its ranges; rows
that repeat are counted before they are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import stored

#: Rows of a range of hashes or of fractional ranks, about.
BUCKET_ROWS = 8192
#: Copies of one row that are written out at once.
COPIES = 10_000
SHARDS, SEED = 8, 0
#: Counts of ranges that are broadcast (24 bytes each); beyond it they are joined.
BROADCAST_RANGES = 500_000


def _bits(rows: int) -> int:
    """Bits that number the ranges of ``rows`` rows."""
    return max(0, -(-rows // BUCKET_ROWS) - 1).bit_length()


def _word(digest: Column) -> Column:
    """The first 32 bits of a hexadecimal digest as a number."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def _expanded(counted: DataFrame) -> DataFrame:
    """A row for each of ``_copies`` copies, numbered ``_copy``; many copies of one row are dealt in portions."""
    whole = counted.withColumn("_portion", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_copies") - 1) / COPIES))))
    if counted.agg(F.max("_copies").alias("m")).first()["m"] > COPIES:
        whole = whole.repartition("_row", "_portion")
    last = F.least(F.col("_copies"), (F.col("_portion") + 1) * COPIES) - 1
    return whole.withColumn("_copy", F.explode(F.sequence(F.col("_portion") * COPIES, last))).drop("_copies", "_portion")


def _before(df: DataFrame, within: list[str], bucket: str, tag: str) -> DataFrame:
    """For each range: rows before it and rows in all, of its source or of the table."""
    counts = stored(df.groupBy(*within, bucket).agg(F.count("*").alias("_c")), tag)
    # a source, or the table, has no more rows here than there are ranges
    every = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    out = counts.withColumns({"_before": F.sum("_c").over(every.orderBy(bucket)) - F.col("_c"), "_n": F.sum("_c").over(every)}).drop("_c")
    return F.broadcast(out) if counts.limit(BROADCAST_RANGES + 1).count() <= BROADCAST_RANGES else out


def shard_rows(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, keep: tuple[str, ...] = ("doc_id",), text: str = "text", source: str = "source") -> DataFrame:
    """One row per input row: kept columns, size, text_crc32, law (``rows``), shard, slot, grown_shard (null).

    Counts of shards differ by one row at most; slots number a shard's rows from 0 in the order of their fractional ranks. Ties of
    fractional ranks go by source, then by hash. Null and empty texts have size 1 and crc 0; a null source is one of its own, apart from the empty one. Rows alike
    in kept columns, source, size and crc are copies: each gets a place of its own, and which of them gets which makes no difference. Places depend on ``seed`` and on
    the rows alone, not on how they are read. Texts are only measured, at any length. An empty table gives an empty
    result. Kept columns must be groupable; those named like an added column are replaced.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    added = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
    keep = tuple(c for c in keep if c not in added)
    raw = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    kept = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.struct(F.lit(0).alias("_none"))
    name = F.coalesce(F.concat(F.lit("="), F.col(f"`{source}`").cast("string")), F.lit(""))
    slim = docs.select(kept.alias("_row"), name.alias("_source"), (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw.cast("binary")).alias("text_crc32"))
    counted = stored(slim.groupBy("_row", "_source", "size", "text_crc32").agg(F.count("*").alias("_copies")), "shard-rows")
    total = counted.agg(F.sum("_copies").alias("n")).first()["n"]
    if not total:
        return _result(counted.withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("long")}), keep)
    bits = _bits(total)
    words = [F.coalesce(F.col(f"_row.`{c}`").cast("string"), F.lit("null")) for c in keep]
    shuffled = F.md5(F.concat_ws(":", F.lit(str(seed)), *words, "text_crc32", "size", "_copy").cast("binary"))
    rows = _expanded(counted).withColumn("_h", shuffled).withColumn("_range", F.shiftright(_word(F.col("_h")), 32 - bits)).drop("_copy")
    # ranks within a source: places within a range of hashes after those before it
    rows = rows.join(_before(rows, ["_source"], "_range", "shard-hash-ranges"), ["_source", "_range"])
    rank = F.col("_before") + F.row_number().over(Window.partitionBy("_source", "_range").orderBy("_h")) - 1
    phase = _word(F.md5(F.concat_ws(":", F.lit(str(seed)), "_source").cast("binary"))) / F.lit(4294967296.0)
    rows = rows.withColumn("_at", (rank + phase) / F.col("_n")).drop("_before", "_n", "_range")
    rows = stored(rows.withColumn("_range", F.least(F.floor(F.col("_at") * (1 << bits)), F.lit((1 << bits) - 1))), "shard-ranks")
    # the same over all sources
    rows = rows.join(_before(rows, [], "_range", "shard-rank-ranges"), ["_range"])
    place = F.col("_before") + F.row_number().over(Window.partitionBy("_range").orderBy("_at", "_source", "_h")) - 1
    rows = rows.withColumn("_place", place.cast("long")).withColumn("shard", F.expr(f"_place * {shards} div {total}").cast("int"))
    return _result(rows.withColumn("slot", F.expr(f"_place - (shard * {total} + {shards - 1}L) div {shards}")), keep)


def _result(rows: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    return rows.select(*[F.col(f"_row.`{c}`") for c in keep], "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard"))


def write_shards(sharded: DataFrame, path: str, rows: int = 1_000_000) -> None:
    """A folder for each shard with its rows in the order of their slots, in files of about ``rows`` rows."""
    part = F.floor(F.col("slot") / rows)
    sharded.withColumn("part", part).repartition("shard", "part").sortWithinPartitions("shard", "part", "slot").write.partitionBy("shard", "part").parquet(path)


_CRC_TABLE = "list_transform(range(256), lambda n: list_reduce([CAST(n AS BIGINT)] || [CAST(0 AS BIGINT) FOR z IN range(8)], lambda c, z: xor(c >> 1, 3988292384 * (c & 1))))"


def crc_sql(digits: str) -> str:
    """crc32 in SQL of the bytes whose hexadecimal digits a column holds, one by one; needs ``crc_table``."""
    codes = f"list_transform(range(0, length({digits}) // 2), lambda i: CAST(('0x' || {digits}[2 * i + 1:2 * i + 2]) AS BIGINT))"
    return f"xor(4294967295, list_reduce([CAST(4294967295 AS BIGINT)] || {codes}, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])))"


CRC_TABLE = f"crc_table AS (SELECT {_CRC_TABLE} AS t)"


def oracle() -> str:
    """Ranks over whole sources and over the whole table."""
    return f"""
WITH {CRC_TABLE},
d AS (SELECT doc_id, coalesce('=' || source, '') AS src, hex(encode(coalesce(text, ''))) AS digits FROM documents),
c AS (SELECT doc_id, src, CAST(length(digits) // 2 + 1 AS BIGINT) AS size, CAST({crc_sql('digits')} AS BIGINT) AS text_crc32 FROM d, crc_table),
k AS (SELECT *, row_number() OVER (PARTITION BY doc_id, src, size, text_crc32) - 1 AS copy FROM c),
h AS (SELECT *, md5(concat_ws(':', '{SEED}', coalesce(CAST(doc_id AS VARCHAR), 'null'), text_crc32, size, copy)) AS h FROM k),
r AS (SELECT *, (row_number() OVER (PARTITION BY src ORDER BY h) - 1 + CAST(('0x' || md5(concat_ws(':', '{SEED}', src))[1:8]) AS BIGINT) / 4294967296.0) / count(*) OVER (PARTITION BY src) AS frac FROM h),
p AS (SELECT *, row_number() OVER (ORDER BY frac, src, h) - 1 AS place, count(*) OVER () AS n FROM r)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(place * {SHARDS} // n AS INTEGER) AS shard,
  CAST(place - ((place * {SHARDS} // n) * n + {SHARDS - 1}) // {SHARDS} AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM p"""
