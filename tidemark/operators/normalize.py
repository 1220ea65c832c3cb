"""Decoded flow records to the flow table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.expressions import bit_text, flag_text, ipv4_text, mac_text

#: Names of IP protocols 0 to 144 in order, then 253 and 254 (fixed values).
PROTOCOLS = """
hopopt icmp igmp ggp ipv4 st tcp cbt egp igp bbn-rcc-mon nvp-ii pup argus emcon xnet chaos udp mux dcn-meas
hmp prm xns-idp trunk-1 trunk-2 leaf-1 leaf-2 rdp irtp iso-tp4 netblt mfe-nsp merit-inp dccp 3pc idpr xtp ddp
idpr-cmtp tp++ il ipv6 sdrp ipv6-route ipv6-frag idrp rsvp gre dsp bna esp ah i-nlsp swipe narp mobile tlsp
skip ipv6-icmp ipv6-nonxt ipv6-opts anyhost cftp anylocalnet sat-expak kryptolan rvd ippc anydistribfs sat-mon
visa ipcv cpnx cphb wsn pvp br-sat-mon sun-nd wb-mon wb-expak iso-ip vmtp secure-vmtp vines iptm nsfnet-igp
dgp tcf eigrp ospfigp sprite-rpc larp mtp ax.25 ipip micp scc-sp etherip encap anyencrypt gmtp ifmp pnni pim
aris scps qnx a/n ipcomp snp compaq-peer ipx-in-ip vrrp pgm any0hop l2tp ddx iatp stp srp uti smp sm ptp
isis-ipv4 fire crtp crudp sscopmce iplt sps pipe sctp fc rsvp-e2e-ignore mobility-hdr udplite mpls-in-ip manet
hip shim6 wesp rohc ethernet aggfrag experimental1 experimental2
""".split()

#: Masked end reason and its name (fixed values).
END_MASK = 0x7F
END_REASONS = {1: "idle", 2: "active", 4: "eof", 5: "rsrc", 31: "force"}

#: Raw field, forward and reverse column of a flow, and the type (fixed values).
RENAMED = (
    ("sourceTransportPort", "sport", "int"), ("destinationTransportPort", "dport", "int"),
    ("tcpSequenceNumber", "stcpseq", "long"), ("reverseTcpSequenceNumber", "dtcpseq", "long"),
    ("packetTotalCount", "spkts", "long"), ("reversePacketTotalCount", "dpkts", "long"),
    ("octetTotalCount", "sbytes", "long"), ("reverseOctetTotalCount", "dbytes", "long"),
    ("entropy", "sentropy", "smallint"), ("reverseEntropy", "dentropy", "smallint"),
    ("averageInterarrivalTime", "siat", "long"), ("reverseAverageInterarrivalTime", "diat", "long"),
    ("standardDeviationInterarrivalTime", "sstdev", "long"), ("reverseStandardDeviationInterarrivalTime", "dstdev", "long"),
    ("tcpUrgTotalCount", "stcpurg", "long"), ("reverseTcpUrgTotalCount", "dtcpurg", "long"),
    ("smallPacketCount", "ssmallpktcnt", "long"), ("reverseSmallPacketCount", "dsmallpktcnt", "long"),
    ("largePacketCount", "slargepktcnt", "long"), ("reverseLargePacketCount", "dlargepktcnt", "long"),
    ("nonEmptyPacketCount", "snonemptypktcnt", "long"), ("reverseNonEmptyPacketCount", "dnonemptypktcnt", "long"),
    ("firstNonEmptyPacketSize", "sfirstnonemptycnt", "int"), ("reverseFirstNonEmptyPacketSize", "dfirstnonemptycnt", "int"),
    ("maxPacketSize", "smaxpktsize", "int"), ("reverseMaxPacketSize", "dmaxpktsize", "int"),
    ("standardDeviationPayloadLength", "sstdevpayload", "int"), ("reverseStandardDeviationPayloadLength", "dstdevpayload", "int"),
)


def protocol_table(spark: SparkSession) -> DataFrame:
    """``number, name`` of the known protocols."""
    numbers = [*range(len(PROTOCOLS) - 2), 253, 254]
    return spark.createDataFrame(list(zip(numbers, PROTOCOLS, strict=True)), "number int, name string")


def drop_hop_by_hop(raw: DataFrame) -> DataFrame:
    return raw.where(~((F.col("protocolIdentifier") == 0) & (F.col("destinationIPv4Address") == 0)))


def pcr(sent: Column, received: Column) -> Column:
    """Producer/consumer ratio in tenths, -10 to 10; 0 without payload."""
    total = sent + received
    return F.when(total == 0, F.lit(0)).otherwise(F.round(F.lit(10.0) * (sent - received) / total).cast("int"))


def end_reason(code: Column) -> Column:
    masked = code.bitwiseAND(F.lit(END_MASK))
    out = F.lit(".")
    for number, name in END_REASONS.items():
        out = F.when(masked == number, F.lit(name)).otherwise(out)
    return out


def addresses(raw: DataFrame) -> tuple[Column, Column]:
    v4 = (F.col("sourceIPv4Address") != 0) | (F.col("destinationIPv4Address") != 0)
    pick = lambda side: F.when(v4, ipv4_text(F.col(f"{side}IPv4Address"))).otherwise(F.col(f"{side}IPv6Address"))
    return pick("source"), pick("destination")


def normalize(raw: DataFrame, observe: Column | None = None, stream: int = 100) -> DataFrame:
    """Raw records to flow columns; keeps the raw columns that enrichment needs (v4 numbers, ndpi_*, record)."""
    spark = raw.sparkSession
    saddr, daddr = addresses(raw)
    rows = drop_hop_by_hop(raw).join(F.broadcast(protocol_table(spark)), F.col("protocolIdentifier") == F.col("number"), "left")
    ms = lambda c: F.timestamp_millis(F.col(c)).cast("timestamp_ntz")
    mine = lambda c: F.col(c)
    carried = [c for c in ("record", "sourceIPv4Address", "destinationIPv4Address", "ndpi_master", "ndpi_sub", "ndpi_risk") if c in raw.columns]
    return rows.select(
        F.lit(stream).cast("long").alias("stream"),
        (observe if observe is not None else F.col("observation")).alias("observe"),
        ms("flowStartMilliseconds").alias("stime"), ms("flowEndMilliseconds").alias("etime"),
        (F.col("flowEndMilliseconds") - F.col("flowStartMilliseconds")).alias("dur"),
        F.col("reverseFlowDeltaMilliseconds").cast("long").alias("rtt"),
        pcr(mine("dataByteCount"), mine("reverseDataByteCount")).alias("pcr"),
        F.coalesce("name", F.col("protocolIdentifier").cast("string")).alias("proto"),
        saddr.alias("saddr"), daddr.alias("daddr"),
        flag_text(mine("initialTCPFlags"), mine("reverseInitialTCPFlags")).alias("iflags"),
        flag_text(mine("unionTCPFlags"), mine("reverseUnionTCPFlags")).alias("uflags"),
        F.col("vlanId").cast("int").alias("svlan"),
        F.when(F.col("reverseOctetTotalCount") > 0, F.col("reverseVlanId")).otherwise(0).cast("int").alias("dvlan"),
        *[F.col(a).cast(t).alias(b) for a, b, t in RENAMED],
        bit_text(mine("firstEightNonEmptyPacketDirections")).alias("spd"),
        end_reason(mine("flowEndReason")).alias("reason"),
        mac_text(mine("sourceMacAddress")).alias("smac"), mac_text(mine("destinationMacAddress")).alias("dmac"),
        *carried,
    )


def with_defaults(flows: DataFrame) -> DataFrame:
    """The columns that later stages fill."""
    return flows.withColumns({
        "tag": F.lit(None).cast("array<string>"), "hbos_score": F.lit(0.0), "hbos_severity": F.lit(0).cast("smallint"),
        "hbos_map": F.lit(None).cast("map<string,double>"), "ndpi_risk_list": F.lit(None).cast("array<string>"), "trigger": F.lit(0).cast("tinyint"),
    })


def with_ids(flows: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """A random id; with key columns one that a replay gives again."""
    return flows.withColumn("id", F.sha2(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]), 256) if keys else F.expr("uuid()"))
