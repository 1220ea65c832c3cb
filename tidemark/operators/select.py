"""Projections, filters, splits and concatenation of flow tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schema import FLOW_NAMES


def project(flows: DataFrame, fields: str = "*") -> DataFrame:
    """Comma-separated flow columns, each checked; ``*`` is all."""
    if fields.strip() == "*":
        return flows
    names = [f.strip() for f in fields.split(",")]
    if wrong := [n for n in names if n not in FLOW_NAMES]:
        raise ValueError(f"not flow columns: {', '.join(wrong)}")
    return flows.select(*names)


def named_filter(flows: DataFrame, name: str = "") -> DataFrame:
    """``trigger``: triggered rows; ``severe``: rows of any severity; empty: all rows."""
    if not name:
        return flows
    kinds = {"trigger": F.col("trigger") > 0, "severe": F.col("hbos_severity") > 0}
    if name not in kinds:
        raise ValueError(f"unknown filter: {name}")
    return flows.where(kinds[name])


def without(flows: DataFrame, *columns: str) -> DataFrame:
    """All columns but these; those that are not there do no harm."""
    return flows.drop(*columns)


def starting_with(flows: DataFrame, column: str, prefix: str) -> DataFrame:
    return flows.where(F.col(column).startswith(prefix))


def of_protocols(flows: DataFrame, *protocols: str) -> DataFrame:
    """Rows of any of the protocols; all rows without a list."""
    return flows.where(F.col("proto").isin(*protocols)) if protocols else flows


def split(flows: DataFrame, routes: list[dict]) -> dict[str, DataFrame]:
    """Path to the rows of its protocol, for ``[{"proto", "path"}]``; other rows go nowhere."""
    return {r["path"]: flows.where(F.col("proto") == r["proto"]) for r in routes}


def merge(tables: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def same_stream(flows: DataFrame) -> DataFrame:
    """One row: ``streams``, ``accepted`` (a batch is accepted if it holds one kind of stream)."""
    return flows.agg(F.count_distinct("stream").alias("streams")).withColumn("accepted", F.col("streams") == 1)


def recent_days(flows: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Rows whose day is later than ``days`` days before that of ``as_of``."""
    return flows.where(F.date_trunc("day", "stime").cast("date") > F.date_sub(as_of.cast("date"), days))


def not_older(flows: DataFrame, as_of: Column, days: int = 0) -> DataFrame:
    """Without rows that started more than ``days`` days before ``as_of``; 0 keeps all."""
    return flows.where(F.col("stime") >= as_of - F.make_dt_interval(F.lit(days))) if days > 0 else flows


def baseline_rows(flows: DataFrame) -> DataFrame:
    return flows.where(F.col("hbos_severity") < 4)


def handshake() -> Column:
    """tcp rows need a completed handshake; others pass."""
    return (F.col("proto") != "tcp") | F.col("iflags").startswith("Ss")


def update_from(flows: DataFrame, updates: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Columns from the row of ``updates`` with the same key; rows without one keep theirs. Keys of updates are unique."""
    new = updates.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_found"))
    out = flows.join(new, key, "left")
    return out.withColumns({c: F.when(F.col("_found"), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in columns}).select(*flows.columns)
