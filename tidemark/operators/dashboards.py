"""Queries over the metrics table that dashboards show."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def over_time(metrics: DataFrame, name: str, key: str | None = None, scale: int = 1) -> DataFrame:
    rows = metrics.where((F.col("name") == name) & (F.lit(True) if key is None else F.col("key") == key))
    return rows.groupBy("bucket").agg((F.sum("value") * scale).alias("total")).orderBy("bucket")


def flow_rate(metrics: DataFrame) -> DataFrame:
    return over_time(metrics, "flow")


def _both(metrics: DataFrame, name: str, keys: tuple[str, str], scale: int) -> DataFrame:
    rows = metrics.where((F.col("name") == name) & F.col("key").isin(*keys))
    return rows.groupBy("bucket", "key").agg((F.sum("value") * scale).alias("total")).orderBy("bucket", "key")


def bits(metrics: DataFrame) -> DataFrame:
    """Bits sent and received a minute."""
    return _both(metrics, "bytes", ("sbytes", "dbytes"), 8)


def packets(metrics: DataFrame) -> DataFrame:
    return _both(metrics, "pkts", ("spkts", "dpkts"), 1)


def by_key(metrics: DataFrame, name: str, limit: int = 10) -> DataFrame:
    """The first ``limit`` rows of a series by minute, key and total."""
    rows = metrics.where(F.col("name") == name).groupBy("bucket", "key").agg(F.sum("value").alias("total"))
    return rows.orderBy("bucket", "key", "total").limit(limit)


def totals(metrics: DataFrame, name: str, limit: int = 100) -> DataFrame:
    return metrics.where(F.col("name") == name).groupBy("key").agg(F.sum("value").alias("total")).orderBy("key", "total").limit(limit)
