"""Flows, raw records and network tables derived from the given ``events`` table.

The SQL runs unchanged in Spark and in the engine that checks the results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

AS_OF = "2024-01-31 00:00:00"

FLOW_SQL = """
SELECT
  CAST(100 AS BIGINT) AS stream,
  concat('f-', lpad(CAST(e AS STRING), 12, '0')) AS id,
  CASE WHEN e % 3 = 0 THEN 'napa' WHEN e % 3 = 1 THEN 'sonoma' ELSE 'marin' END AS observe,
  ts AS stime,
  CAST((e * 7919) % 60000 AS BIGINT) AS dur,
  CAST((e * 31) % 500 AS BIGINT) AS rtt,
  CAST((e * 13) % 21 AS INT) - 10 AS pcr,
  CASE WHEN u % 10 < 6 THEN 'tcp' WHEN u % 10 < 9 THEN 'udp' ELSE 'icmp' END AS proto,
  concat('10.0.', CAST(u % 4 AS STRING), '.', CAST(u % 250 AS STRING)) AS saddr,
  CASE WHEN e % 7 = 0 THEN concat('192.168.1.', CAST(e % 200 AS STRING))
       ELSE concat(CAST(11 + (u * 17 + e % 5) % 210 AS STRING), '.', CAST((u * 29) % 256 AS STRING), '.', CAST(e % 256 AS STRING), '.9') END AS daddr,
  CAST(1024 + (e * 101) % 60000 AS INT) AS sport,
  CAST(CASE t WHEN 'view' THEN 443 WHEN 'click' THEN 80 WHEN 'purchase' THEN 22 WHEN 'signup' THEN 53 ELSE 8080 END AS INT) AS dport,
  CASE WHEN u % 10 < 6 AND e % 4 <> 0 THEN 'Ss..............' WHEN u % 10 < 6 THEN 'S...............' ELSE '................' END AS iflags,
  CASE WHEN u % 10 < 6 AND e % 4 <> 0 THEN 'SsAa..Ff........' WHEN u % 10 < 6 THEN 'S...............' ELSE '................' END AS uflags,
  CAST(CASE WHEN e % 5 = 0 THEN 20 ELSE 10 END AS INT) AS svlan,
  CAST(CASE WHEN e % 5 = 0 THEN 20 ELSE 10 END AS INT) AS dvlan,
  CAST(1 + e % 40 AS BIGINT) AS spkts,
  CAST(1 + (e * 3) % 50 AS BIGINT) AS dpkts,
  CAST(round(v * 100) AS BIGINT) AS sbytes,
  CAST((e * 97) % 100000 AS BIGINT) AS dbytes,
  CAST((e * 11) % 256 AS INT) AS sentropy,
  CAST((e * 23) % 256 AS INT) AS dentropy,
  CAST((e * 41) % 5000 AS BIGINT) AS siat,
  CAST((e * 43) % 5000 AS BIGINT) AS diat,
  CAST((e * 3) % 20 AS BIGINT) AS ssmallpktcnt,
  CAST((e * 5) % 20 AS BIGINT) AS dsmallpktcnt,
  CAST(40 + (e * 59) % 1460 AS INT) AS smaxpktsize,
  CAST(40 + (e * 61) % 1460 AS INT) AS dmaxpktsize,
  CASE e % 4 WHEN 0 THEN '10101010' WHEN 1 THEN '01010101' WHEN 2 THEN '00000000' ELSE '11110000' END AS spd,
  CASE e % 3 WHEN 0 THEN 'idle' WHEN 1 THEN 'active' ELSE 'eof' END AS reason,
  'private' AS scountry,
  CASE WHEN e % 7 = 0 THEN 'private' WHEN u % 3 = 0 THEN 'us' WHEN u % 3 = 1 THEN 'de' ELSE 'na' END AS dcountry,
  CAST(64512 + (u % 4) AS BIGINT) AS sasn,
  CAST(CASE WHEN e % 7 = 0 THEN 64600 ELSE 1000 + u % 40 END AS BIGINT) AS dasn,
  'private' AS sasnorg,
  CASE WHEN e % 7 = 0 THEN 'private' ELSE concat('org', CAST(u % 40 AS STRING)) END AS dasnorg,
  CASE WHEN e % 7 = 0 THEN 'ii' ELSE 'io' END AS orient,
  CASE t WHEN 'view' THEN 'tls.cloudflare' WHEN 'click' THEN 'dns.doh' WHEN 'purchase' THEN 'ssh' WHEN 'signup' THEN 'dns' ELSE 'quic.google' END AS ndpi_appid,
  CASE WHEN e % 50 = 0 THEN 'vpn' ELSE 'web' END AS ndpi_category,
  CASE WHEN e % 11 = 0 THEN CAST(e % 2048 AS BIGINT) ELSE CAST(0 AS BIGINT) END AS ndpi_risk_bits,
  CAST(CASE WHEN e % 11 = 0 THEN (e % 26) * 10 ELSE 0 END AS BIGINT) AS ndpi_risk_score,
  CAST(CASE WHEN e % 11 = 0 THEN e % 7 ELSE 0 END AS INT) AS ndpi_risk_severity,
  CAST(0 AS DOUBLE) AS hbos_score,
  CAST(CASE WHEN e % 13 = 0 THEN e % 5 ELSE 0 END AS INT) AS hbos_severity,
  CAST(CASE WHEN e % 17 = 0 THEN 1 WHEN e % 19 = 0 THEN -1 ELSE 0 END AS INT) AS trigger
FROM (SELECT event_id AS e, ts, user_id AS u, event_type AS t, value AS v FROM {events}) AS base
"""

RAW_SQL = """
SELECT
  e AS record, concat('site', CAST(e % 3 AS STRING)) AS observation,
  1704067200000 + (e * 25920011) % 2592000000 AS flowStartMilliseconds,
  1704067200000 + (e * 25920011) % 2592000000 + (e * 7919) % 60000 AS flowEndMilliseconds,
  CAST((e * 31) % 500 AS INT) AS reverseFlowDeltaMilliseconds,
  (e * 977) % 100000 AS octetTotalCount, CASE WHEN e % 6 = 0 THEN CAST(0 AS BIGINT) ELSE (e * 571) % 90000 END AS reverseOctetTotalCount,
  1 + e % 40 AS packetTotalCount, (e * 3) % 50 AS reversePacketTotalCount,
  CASE WHEN e % 10 = 0 THEN CAST(0 AS BIGINT) ELSE (e * 97) % 4000 END AS dataByteCount,
  CASE WHEN e % 10 = 0 THEN CAST(0 AS BIGINT) ELSE (e * 89) % 5000 END AS reverseDataByteCount,
  CASE WHEN e % 23 = 0 THEN CAST(0 AS BIGINT) WHEN u % 3 = 0 THEN 167772160 + u * 7 WHEN u % 3 = 1 THEN 2886729728 + (u * 70001) % 2097152 ELSE 134744072 + u * 65537 END AS sourceIPv4Address,
  CASE WHEN e % 23 = 0 OR e % 29 = 0 THEN CAST(0 AS BIGINT) WHEN e % 7 = 0 THEN 3232235776 + e % 200 WHEN e % 13 = 0 THEN 3758096384 + e % 99 ELSE ((11 + (u * 17 + e % 5) % 210) * 16777216 + (u * 29 % 256) * 65536 + (e % 256) * 256 + 9) END AS destinationIPv4Address,
  CASE WHEN e % 2 = 0 THEN '2001:db8::1' ELSE 'fe80::7' END AS sourceIPv6Address, '2001:db8::2' AS destinationIPv6Address,
  CAST(CASE WHEN e % 31 = 0 THEN 0 WHEN u % 10 < 6 THEN 6 WHEN u % 10 < 8 THEN 17 WHEN u % 10 = 8 THEN 1 ELSE 200 END AS INT) AS protocolIdentifier,
  CAST(1024 + (e * 101) % 60000 AS INT) AS sourceTransportPort, CAST((e * 37) % 1024 AS INT) AS destinationTransportPort,
  CAST((e * 5) % 256 AS INT) AS initialTCPFlags, CAST((e * 11) % 256 AS INT) AS reverseInitialTCPFlags,
  CAST((e * 17) % 256 AS INT) AS unionTCPFlags, CAST((e * 29) % 256 AS INT) AS reverseUnionTCPFlags,
  (e * 7) % 4294967296 AS tcpSequenceNumber, (e * 13) % 4294967296 AS reverseTcpSequenceNumber,
  CAST(e % 5 * 10 AS INT) AS vlanId, CAST(e % 5 * 10 + 1 AS INT) AS reverseVlanId,
  CAST((e * 11) % 256 AS INT) AS entropy, CAST((e * 23) % 256 AS INT) AS reverseEntropy,
  (e * 41) % 5000 AS averageInterarrivalTime, (e * 43) % 5000 AS reverseAverageInterarrivalTime,
  (e * 47) % 700 AS standardDeviationInterarrivalTime, (e * 53) % 700 AS reverseStandardDeviationInterarrivalTime,
  e % 2 AS tcpUrgTotalCount, e % 3 AS reverseTcpUrgTotalCount, e % 20 AS smallPacketCount, e % 21 AS reverseSmallPacketCount,
  e % 22 AS largePacketCount, e % 24 AS reverseLargePacketCount, e % 25 AS nonEmptyPacketCount, e % 26 AS reverseNonEmptyPacketCount,
  CAST(e % 900 AS INT) AS firstNonEmptyPacketSize, CAST(e % 800 AS INT) AS reverseFirstNonEmptyPacketSize,
  CAST(e % 1460 AS INT) AS maxPacketSize, CAST(e % 1461 AS INT) AS reverseMaxPacketSize,
  CAST(e % 300 AS INT) AS standardDeviationPayloadLength, CAST(e % 301 AS INT) AS reverseStandardDeviationPayloadLength,
  CAST((e * 19) % 256 AS INT) AS firstEightNonEmptyPacketDirections, CAST(CASE WHEN e % 9 = 8 THEN 31 ELSE e % 9 + (e % 2) * 128 END AS INT) AS flowEndReason,
  unhex(lpad(hex((e * 7919) % 281474976710656), 12, '0')) AS sourceMacAddress, unhex(lpad(hex((e * 104729 + u) % 281474976710656), 12, '0')) AS destinationMacAddress,
  CAST(e % 6 AS INT) AS ndpi_master, CAST(u % 4 AS INT) AS ndpi_sub,
  CASE WHEN e % 4 = 0 THEN (e * 2654435761) % 1152921504606846976 ELSE CAST(0 AS BIGINT) END AS ndpi_risk
FROM (SELECT event_id AS e, user_id AS u FROM {events}) AS base
"""

#: One network a first octet, and within every eighth octet 16 narrower ones, so that nesting matters.
NETWORK_SQL = """
SELECT o * 16777216 AS start_ip, o * 16777216 + 16777215 AS end_ip, concat(chr(CAST(65 + o % 26 AS INT)), chr(CAST(65 + (o * 7) % 26 AS INT))) AS iso,
       1000 + o AS asn, concat('Network Operator Number ', CAST(o AS STRING), ' Of The World') AS org
FROM (SELECT DISTINCT event_id % 224 AS o FROM {events}) AS octets
UNION ALL
SELECT o * 16777216 + k * 65536, o * 16777216 + k * 65536 + 65535, concat('Z', chr(CAST(65 + k % 26 AS INT))), 30000 + o * 16 + k, concat('Local ', CAST(k AS STRING))
FROM (SELECT DISTINCT (event_id % 28) * 8 AS o, (event_id * 5) % 256 AS k FROM {events}) AS nested
"""

#: IPv6 networks at full length, so that their texts sort as numbers: wide ones over many blocks, and within them nested narrower ones.
NETWORK6_SQL = """
SELECT concat('20', lpad(lower(hex(o)), 2, '0'), ':0000:0000:0000:0000:0000:0000:0000') AS start_ip, concat('20', lpad(lower(hex(o)), 2, '0'), ':ffff:ffff:ffff:ffff:ffff:ffff:ffff') AS end_ip,
       concat(chr(CAST(65 + o % 26 AS INT)), 'W') AS iso, 50000 + o AS asn, concat('Wide Operator ', CAST(o AS STRING), ' With A Long Name') AS org
FROM (SELECT DISTINCT event_id % 64 AS o FROM {events}) AS wide
UNION ALL
SELECT concat('20', lpad(lower(hex(o)), 2, '0'), ':', lpad(lower(hex(k)), 4, '0'), ':0000:0000:0000:0000:0000:0000'), concat('20', lpad(lower(hex(o)), 2, '0'), ':', lpad(lower(hex(k)), 4, '0'), ':7fff:ffff:ffff:ffff:ffff:ffff'),
       concat('N', chr(CAST(65 + k % 26 AS INT))), 60000 + o * 64 + k, concat('Narrow ', CAST(k AS STRING))
FROM (SELECT DISTINCT event_id % 64 AS o, (event_id * 5) % 40 AS k FROM {events}) AS narrow
UNION ALL
SELECT concat('20', lpad(lower(hex(o)), 2, '0'), ':', lpad(lower(hex(k)), 4, '0'), ':', lpad(lower(hex(j)), 4, '0'), ':0000:0000:0000:0000:0000'), concat('20', lpad(lower(hex(o)), 2, '0'), ':', lpad(lower(hex(k)), 4, '0'), ':', lpad(lower(hex(j)), 4, '0'), ':ffff:ffff:ffff:ffff:ffff'),
       concat('I', chr(CAST(65 + j % 26 AS INT))), 90000 + o * 64 + j, concat('Inner ', CAST(j AS STRING))
FROM (SELECT DISTINCT event_id % 64 AS o, (event_id * 5) % 40 AS k, (event_id * 3) % 7 AS j FROM {events}) AS inner_
"""

#: Both ends of IPv6 flows; a few have an IPv4 source.
FLOW6_SQL = """
SELECT e AS record,
       CASE WHEN e % 10 = 0 THEN concat('10.0.0.', CAST(e % 200 AS STRING)) ELSE concat('20', lpad(lower(hex(e % 70)), 2, '0'), ':', lpad(lower(hex((e * 5) % 45)), 4, '0'), ':', lpad(lower(hex((e * 3) % 9)), 4, '0'), ':0000:0000:0000:00ab:', lpad(lower(hex(e % 65536)), 4, '0')) END AS saddr,
       concat('20', lpad(lower(hex(u % 70)), 2, '0'), ':', lpad(lower(hex((e * 7) % 45)), 4, '0'), ':', lpad(lower(hex(e % 40000)), 4, '0'), ':0000:0000:0000:0000:0001') AS daddr
FROM (SELECT event_id AS e, user_id AS u FROM {events}) AS base
"""

#: Application names by master and sub protocol.
APP_SQL = """
SELECT DISTINCT CAST(event_id % 6 AS INT) AS master, CAST(user_id % 4 AS INT) AS sub,
       concat('App', CAST(event_id % 6 AS STRING), '.Sub', CAST(user_id % 4 AS STRING)) AS appid,
       CASE WHEN (event_id % 6 + user_id % 4) % 5 = 0 THEN 'VPN' ELSE 'Web' END AS category
FROM {events} WHERE (event_id + user_id) % 6 <> 5
"""


def _view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return spark.sql(sql, events=spark.read.parquet(f"{sf_dir}/events.parquet"))


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, FLOW_SQL)


def raw_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, RAW_SQL)


def networks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, NETWORK_SQL)


def networks6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, NETWORK6_SQL)


def flows6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, FLOW6_SQL)


def apps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, APP_SQL)


def cte(*names: str) -> str:
    """``WITH`` for oracle SQL: flow, raw, network, app over the given events table."""
    text = {"flow": FLOW_SQL, "raw": RAW_SQL, "network": NETWORK_SQL, "network6": NETWORK6_SQL, "flow6": FLOW6_SQL, "app": APP_SQL}
    return "WITH " + ", ".join(f"{n} AS ({text[n].replace('{events}', 'events')})" for n in names)
