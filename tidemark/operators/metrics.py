"""Per-minute metrics of flows.

A series counts or sums flows by minute, observation point and its own key. All series are made in one pass:
each flow yields a small struct for every series it belongs to, and one aggregation adds them up.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TELEMETRY = 300


@dataclass(frozen=True)
class Series:
    """SQL texts of the emitted key, the value to add, the filter, and a grouping column that is not emitted."""

    name: str
    key: str
    value: str = "1"
    where: str = "true"
    beside: str = "''"


#: Query name to series (names and keys are fixed values).
SERIES = {
    "appid": Series("appid", "ndpi_appid"),
    "asn": Series("asn", "concat(cast(dasn AS string), '(', dasnorg, ')')"),
    "sbytes": Series("bytes", "'sbytes'", "sbytes"),
    "dbytes": Series("bytes", "'dbytes'", "dbytes"),
    "scountry": Series("scountry", "scountry"),
    "dcountry": Series("dcountry", "dcountry"),
    "dns": Series("dns", "daddr", where="startswith(ndpi_appid, 'dns')", beside="ndpi_appid"),
    "doh": Series("doh", "daddr", where="startswith(ndpi_appid, 'dns.doh')", beside="ndpi_appid"),
    "flow": Series("flow", "'flow'"),
    "saddr": Series("saddr", "saddr"),
    "daddr": Series("daddr", "daddr"),
    "spkts": Series("pkts", "'spkts'", "spkts"),
    "dpkts": Series("pkts", "'dpkts'", "dpkts"),
    "proto": Series("proto", "proto"),
    "quic": Series("quic", "daddr", where="startswith(ndpi_appid, 'quic')", beside="ndpi_appid"),
    "ssh": Series("ssh", "daddr", where="startswith(ndpi_appid, 'ssh')", beside="ndpi_appid"),
    "vlan": Series("vlan", "cast(dvlan AS string)"),
    "vpn": Series("vpn", "daddr", where="ndpi_category = 'vpn'", beside="ndpi_appid"),
}


def _summed(rows: DataFrame) -> DataFrame:
    """The application id is grouped by but not emitted, so a key may have several rows; readers add them."""
    out = rows.groupBy("bucket", "observe", "name", "beside", "key").agg(F.sum("value").alias("value"))
    return out.select(F.lit(TELEMETRY).cast("long").alias("stream"), "bucket", "observe", "name", "key", "value")


def minute() -> Column:
    return F.date_trunc("minute", "stime").alias("bucket")


def metric(flows: DataFrame, series: str) -> DataFrame:
    """One series: stream, bucket, observe, name, key, value."""
    s = SERIES[series]
    rows = flows.where(s.where).select(minute(), "observe", F.lit(s.name).alias("name"), F.expr(s.beside).alias("beside"), F.expr(s.key).alias("key"), F.expr(s.value).cast("long").alias("value"))
    return _summed(rows)


def series_of(names: tuple[str, ...] = tuple(SERIES)) -> Column:
    """A list with (name, beside, key, value) for each series that a flow belongs to."""
    entry = lambda s: F.when(F.expr(s.where), F.struct(F.lit(s.name).alias("name"), F.expr(s.beside).alias("beside"), F.expr(s.key).alias("key"), F.expr(s.value).cast("long").alias("value")))
    return F.filter(F.array(*[entry(SERIES[n]) for n in names]), lambda x: x.isNotNull())


def metric_rows(flows: DataFrame, names: tuple[str, ...] = tuple(SERIES)) -> DataFrame:
    """bucket, observe, name, beside, key, value of every flow and series, not yet added up."""
    return flows.select(minute(), "observe", F.explode(series_of(names)).alias("x")).select("bucket", "observe", "x.*")


def metrics_all(flows: DataFrame, names: tuple[str, ...] = tuple(SERIES)) -> DataFrame:
    return _summed(metric_rows(flows, names))


def bucket_bounds(metrics: DataFrame) -> DataFrame:
    return metrics.agg(F.min("bucket").alias("first_bucket"), F.max("bucket").alias("last_bucket"))
