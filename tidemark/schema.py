"""Table schemas. Unsigned integers are held in the next wider signed type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType, _parse_datatype_string

#: Column and Spark type of a flow, in table order (fixed values).
FLOW_COLUMNS = """
stream long, id string, observe string, stime timestamp_ntz, etime timestamp_ntz, dur long, rtt long, pcr int,
proto string, saddr string, daddr string, sport int, dport int, iflags string, uflags string, stcpseq long,
dtcpseq long, svlan int, dvlan int, spkts long, dpkts long, sbytes long, dbytes long, sentropy smallint,
dentropy smallint, siat long, diat long, sstdev long, dstdev long, stcpurg long, dtcpurg long,
ssmallpktcnt long, dsmallpktcnt long, slargepktcnt long, dlargepktcnt long, snonemptypktcnt long,
dnonemptypktcnt long, sfirstnonemptycnt int, dfirstnonemptycnt int, smaxpktsize int, dmaxpktsize int,
sstdevpayload int, dstdevpayload int, spd string, reason string, smac string, dmac string, scountry string,
dcountry string, sasn long, dasn long, sasnorg string, dasnorg string, orient string, tag array<string>,
hbos_score double, hbos_severity smallint, hbos_map map<string,double>, ndpi_appid string,
ndpi_category string, ndpi_risk_bits long, ndpi_risk_score long, ndpi_risk_severity smallint,
ndpi_risk_list array<string>, trigger tinyint
"""
METRIC_COLUMNS = "stream long, bucket timestamp_ntz, observe string, name string, key string, value long"
HISTOGRAM_COLUMNS = "observe string, vlan int, proto string, name string, kind string, key string, value long"
HISTOGRAM_SUMMARY_COLUMNS = "observe string, vlan int, proto string, name string, histogram string, count long, hash_size int, bin_count long"

FLOW_NAMES = tuple(c.split()[0] for c in FLOW_COLUMNS.replace("map<string,double>", "map").replace("\n", " ").split(",") if c.strip())
GROUP = ("observe", "dvlan", "proto")


def flow_schema() -> StructType:
    """The schema of a flow table; needs an active session."""
    return _parse_datatype_string(FLOW_COLUMNS.strip())


def signed(df: DataFrame) -> DataFrame:
    """Unsigned 64-bit Parquet columns arrive as decimal(20,0); hold them as long."""
    wide = [f.name for f in df.schema.fields if isinstance(f.dataType, DecimalType) and f.dataType.scale == 0]
    return df.withColumns({c: F.col(c).cast("long") for c in wide})


def upgrade(df: DataFrame) -> DataFrame:
    """Tables from before ``stream`` existed: ``version`` becomes ``stream`` and is set to 100."""
    if "stream" in df.columns or "version" not in df.columns:
        return df
    return df.withColumnRenamed("version", "stream").withColumn("stream", F.lit(100).cast("long"))
