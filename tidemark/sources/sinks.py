"""Writing flows and metrics. Spark's commit protocol makes every write appear whole or not at all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.select import named_filter, not_older, project, recent_days
from tidemark.shared import kept

#: Rows of a Parquet row group's page buffer, as near as Spark's writer comes to rows a group.
FILE_ROWS = 5_000_000


def _any(df: DataFrame) -> bool:
    return not df.isEmpty()


def write_parquet(df: DataFrame, path: str, compression: str = "snappy", mode: str = "append") -> bool:
    """False, and nothing written, for a table without rows."""
    if not _any(df):
        return False
    df.write.mode(mode).option("compression", compression).option("maxRecordsPerFile", FILE_ROWS).parquet(path)
    return True


def flat(df: DataFrame) -> DataFrame:
    """Lists, maps and structs as JSON text."""
    return df.select(*[F.to_json(c).alias(c) if t.startswith(("array", "map", "struct")) else F.col(c) for c, t in df.dtypes])


def export(flows: DataFrame, path: str, kind: str = "json", fields: str = "*", filter: str = "", mode: str = "append") -> None:
    """CSV with a header, Parquet, or (also for unknown kinds) JSON lines."""
    rows = project(named_filter(flows, filter), fields)
    if kind == "csv":
        flat(rows).write.mode(mode).option("header", True).csv(path)
    elif kind == "parquet":
        rows.write.mode(mode).parquet(path)
    else:
        rows.write.mode(mode).json(path)


def with_partitions(df: DataFrame, time: str = "stime", hour: bool = True) -> DataFrame:
    parts = {"year": F.year(time), "month": F.month(time), "day": F.dayofmonth(time)}
    return df.withColumns(parts | ({"hour": F.hour(time)} if hour else {}))


def store(flows: DataFrame, root: str, hour: bool = True, compression: str = "snappy", filter: str = "") -> None:
    """Append to a partitioned store. Rows of a partition are brought together as far as the advised partition size lets
    them: files stay few, and large partitions are split over tasks."""
    rows = with_partitions(named_filter(flows, filter), hour=hour)
    parts = ["year", "month", "day", *(["hour"] if hour else [])]
    rows.hint("rebalance", *[F.col(p) for p in parts]).write.mode("append").option("compression", compression).partitionBy(*parts).parquet(root)


def store_metrics(metrics: DataFrame, root: str) -> None:
    """Days in ``metrics`` replace those in the store; other days stay."""
    rows = with_partitions(metrics, "bucket", hour=False)
    rows.hint("rebalance", *[F.col(p) for p in ("year", "month", "day")]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("year", "month", "day").parquet(root)


def append_table(flows: DataFrame, table: str, filter: str = "") -> None:
    named_filter(flows, filter).write.mode("append").saveAsTable(table)


def _fs(spark: SparkSession, path: str):
    """The file system of a path and a maker of its paths."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def roll_cache(flows: DataFrame, root: str, as_of: Column, days: int = 0) -> None:
    """Append a batch and drop rows older than ``days`` days (0 keeps all).

    Folders of days before the oldest day that stays are deleted; of that day the rows that stay are written again, and no other day is touched.
    """
    spark = flows.sparkSession
    with_partitions(flows, hour=False).hint("rebalance", *[F.col(p) for p in ("year", "month", "day")]).write.mode("append").partitionBy("year", "month", "day").parquet(root)
    if days <= 0:
        return
    edge = spark.range(1).select((as_of - F.make_dt_interval(F.lit(days))).cast("date").alias("d")).first()["d"]
    day = F.make_date("year", "month", "day")
    table = spark.read.parquet(root)
    old = table.where(day < F.lit(edge)).select("year", "month", "day").distinct().collect()  # a row a day
    # the day is rewritten from a copy, as it cannot be read and replaced at once
    mine = kept(table.where(day == F.lit(edge)), "cache")
    left = kept(not_older(mine, as_of, days), "cache")
    n = left.count()
    if 0 < n < mine.count():
        left.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month", "day").parquet(root)
    gone = [(r["year"], r["month"], r["day"]) for r in old] + ([(edge.year, edge.month, edge.day)] if not n else [])
    fs, path = _fs(spark, root)
    for y, m, d in gone:
        fs.delete(path(f"{root}/year={y}/month={m}/day={d}"), True)


def compact_sample(spark: SparkSession, root: str, as_of: Column, days: int, file_rows: int = FILE_ROWS) -> None:
    """Keep recent days of a sample and rewrite it as few files of about ``file_rows`` rows: one for a small sample, never a large one in one task.

    The new table is written beside the old one and then takes its name; until it has, the old one stays (as ``<root>.old`` at the last).
    """
    fs, path = _fs(spark, root)
    new, old = path(f"{root}.new"), path(f"{root}.old")
    recent = recent_days(spark.read.parquet(root), as_of, days)
    files = max(1, -(-recent.count() // file_rows))
    recent.repartition(files).write.mode("overwrite").parquet(f"{root}.new")
    fs.delete(old, True)
    if not (fs.rename(path(root), old) and fs.rename(new, path(root))):
        raise OSError(f"{root} could not be replaced; the old table is {root} or {root}.old")
    fs.delete(old, True)
    spark.catalog.refreshByPath(root)
