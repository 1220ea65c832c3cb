"""The registered queries over flows, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixtures as fx
from tidemark.functions.expressions import risk_bits_set
from tidemark.operators import binning, dashboards, enrich, histogram, metrics, model, normalize, rule, sample, score, select, tag
from tidemark.operators.histogram import DEFAULT_FEATURES, FEATURES, NUMERIC, NUMERICAL, STRING, TIME
from tidemark.plans.flow_pipeline import analyse
from tidemark.schema import GROUP
from tidemark.shared import kept
from tidemark.sources.sinks import with_partitions

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _add(name: str, run: Callable[[SparkSession, str], DataFrame], sql: str | None = None) -> None:
    QUERIES[name] = run
    if sql is not None:
        ORACLE[name] = sql


def _flow(name: str, run: Callable[[DataFrame], DataFrame], sql: str | None = None) -> None:
    """A query over the flow view; its SQL starts with SELECT, or with a comma before further WITH parts."""
    _add(name, lambda s, d: run(fx.flows(s, d)), None if sql is None else f"{fx.cte('flow')}{sql if sql.lstrip().startswith(',') else ' ' + sql}")


def _raw(name: str, run: Callable[[DataFrame], DataFrame], sql: str) -> None:
    _add(name, lambda s, d: run(fx.raw_flows(s, d)), f"{fx.cte('raw')}{sql if sql.startswith(',') else ' ' + sql}")


def _as_of():
    return F.lit(fx.AS_OF).cast("timestamp_ntz")


_REST = "'2024-01-31 00:00:00'"

# ---------------------------------------------------------------- scans and gates

_flow("scan_flow", lambda f: f, "SELECT * FROM flow")
_flow("stream_gate", select.same_stream, "SELECT count(DISTINCT stream) AS streams, count(DISTINCT stream) = 1 AS accepted FROM flow")
_flow("merge_union", lambda f: select.merge([f.where("proto = 'tcp'"), f.where("proto = 'udp'")]).select("id", "proto"), "SELECT id, proto FROM flow WHERE proto = 'tcp' UNION ALL SELECT id, proto FROM flow WHERE proto = 'udp'")

# ---------------------------------------------------------------- normalising

_KEPT = "NOT (protocolIdentifier = 0 AND destinationIPv4Address = 0)"
_LOW_PROTOCOLS = ", ".join(f"({i}, '{n}')" for i, n in [*enumerate(normalize.PROTOCOLS[:-2]), (253, "experimental1"), (254, "experimental2")])
_V4 = "concat((({0} >> 24) & 255), '.', (({0} >> 16) & 255), '.', (({0} >> 8) & 255), '.', ({0} & 255))"


def _address_sql(side: str) -> str:
    return f"CASE WHEN sourceIPv4Address <> 0 OR destinationIPv4Address <> 0 THEN {_V4.format(side + 'IPv4Address')} ELSE {side}IPv6Address END"


def _flags_sql(forward: str, reverse: str) -> str:
    letters = [(2, "S"), (16, "A"), (4, "R"), (1, "F"), (128, "C"), (32, "U"), (8, "P"), (64, "E")]
    return " || ".join(f"CASE WHEN {c} & {m} <> 0 THEN '{x}' ELSE '.' END" for m, up in letters for c, x in ((forward, up), (reverse, up.lower())))


_NORMAL_SQL = f"""SELECT record, CAST(100 AS BIGINT) AS stream, observation AS observe, make_timestamp(flowStartMilliseconds * 1000) AS stime,
  make_timestamp(flowEndMilliseconds * 1000) AS etime, flowEndMilliseconds - flowStartMilliseconds AS dur, CAST(reverseFlowDeltaMilliseconds AS BIGINT) AS rtt,
  coalesce(p.name, CAST(protocolIdentifier AS VARCHAR)) AS proto, {_address_sql('source')} AS saddr, {_address_sql('destination')} AS daddr,
  vlanId AS svlan, CASE WHEN reverseOctetTotalCount > 0 THEN reverseVlanId ELSE 0 END AS dvlan, {', '.join(f'{a} AS {b}' for a, b, _ in normalize.RENAMED)}
FROM raw LEFT JOIN (VALUES {_LOW_PROTOCOLS}) p(number, name) ON p.number = protocolIdentifier WHERE {_KEPT}"""
_raw("norm_raw", lambda r: normalize.normalize(r).select("record", "stream", "observe", "stime", "etime", "dur", "rtt", "proto", "saddr", "daddr", "svlan", "dvlan", *[b for _, b, _ in normalize.RENAMED]), _NORMAL_SQL)
_norm = lambda *c: lambda r: normalize.normalize(r).select("record", *c)
_raw("norm_pcr", _norm("pcr"), f"SELECT record, CASE WHEN dataByteCount + reverseDataByteCount = 0 THEN 0 ELSE CAST(round(10.0::DOUBLE * (dataByteCount - reverseDataByteCount) / (dataByteCount + reverseDataByteCount)) AS INT) END AS pcr FROM raw WHERE {_KEPT}")
_raw("norm_proto", _norm("proto"), f"SELECT record, coalesce(p.name, CAST(protocolIdentifier AS VARCHAR)) AS proto FROM raw LEFT JOIN (VALUES {_LOW_PROTOCOLS}) p(number, name) ON p.number = protocolIdentifier WHERE {_KEPT}")
_raw("norm_flags", _norm("iflags", "uflags"), f"SELECT record, {_flags_sql('initialTCPFlags', 'reverseInitialTCPFlags')} AS iflags, {_flags_sql('unionTCPFlags', 'reverseUnionTCPFlags')} AS uflags FROM raw WHERE {_KEPT}")
_raw("norm_spd", _norm("spd"), f"SELECT record, lpad(bin(firstEightNonEmptyPacketDirections), 8, '0') AS spd FROM raw WHERE {_KEPT}")
_raw("norm_reason", _norm("reason"), f"SELECT record, CASE flowEndReason & 127 WHEN 1 THEN 'idle' WHEN 2 THEN 'active' WHEN 4 THEN 'eof' WHEN 5 THEN 'rsrc' WHEN 31 THEN 'force' ELSE '.' END AS reason FROM raw WHERE {_KEPT}")
_mac = lambda c: " || ':' || ".join(f"lower(substr(hex({c}), {i}, 2))" for i in range(1, 12, 2))
_raw("norm_mac", _norm("smac", "dmac"), f"SELECT record, {_mac('sourceMacAddress')} AS smac, {_mac('destinationMacAddress')} AS dmac FROM raw WHERE {_KEPT}")
_raw("address_text", _norm("saddr", "daddr"), f"SELECT record, {_address_sql('source')} AS saddr, {_address_sql('destination')} AS daddr FROM raw WHERE {_KEPT}")
_raw("defaults", lambda r: normalize.with_defaults(normalize.normalize(r)).select("record", "hbos_score", F.col("hbos_severity").cast("int"), F.col("trigger").cast("int"), F.col("tag").isNull().alias("untagged"), F.col("hbos_map").isNull().alias("unexplained"), F.col("ndpi_risk_list").isNull().alias("unlisted")),
     f"SELECT record, CAST(0 AS DOUBLE) AS hbos_score, 0 AS hbos_severity, 0 AS trigger, true AS untagged, true AS unexplained, true AS unlisted FROM raw WHERE {_KEPT}")

# ---------------------------------------------------------------- enriching

_PRIVATE = "({0} LIKE '10.%' OR {0} LIKE '192.168.%' OR regexp_matches({0}, '^172\\.(1[6-9]|2[0-9]|3[01])\\.'))"
_p = _PRIVATE.format
_flow("orient", lambda f: f.select("id", enrich.orientation(F.col("saddr"), F.col("daddr")).alias("orient")), f"SELECT id, CASE WHEN {_p('saddr')} THEN 'i' ELSE 'o' END || CASE WHEN {_p('daddr')} THEN 'i' ELSE 'o' END AS orient FROM flow")


def _enriched(step):
    return lambda s, d: step(normalize.normalize(fx.raw_flows(s, d)), fx.networks(s, d))


_NET = f"{fx.cte('raw', 'network')}, a AS (SELECT record, {_address_sql('source')} AS saddr, {_address_sql('destination')} AS daddr, sourceIPv4Address AS sip, destinationIPv4Address AS dip, sourceIPv4Address <> 0 OR destinationIPv4Address <> 0 AS v4 FROM raw WHERE {_KEPT})"
_best = lambda s: f"{s}n AS (SELECT a.record, arg_min(n.iso, n.end_ip - n.start_ip) AS iso, arg_min(n.asn, n.end_ip - n.start_ip) AS asn, arg_min(n.org, n.end_ip - n.start_ip) AS org FROM a JOIN network n ON a.v4 AND a.{s}ip BETWEEN n.start_ip AND n.end_ip GROUP BY a.record)"
_iso = lambda s: f"CASE WHEN {_p(s + 'addr')} THEN 'private' ELSE coalesce(lower({s}n.iso), 'na') END AS {s}country"
_add("country_lookup", _enriched(lambda f, n: enrich.with_country(f, n).select("record", "scountry", "dcountry")),
     f"{_NET}, {_best('s')}, {_best('d')} SELECT a.record, {_iso('s')}, {_iso('d')} FROM a LEFT JOIN sn ON a.record = sn.record LEFT JOIN dn ON a.record = dn.record")
_loc = lambda s: f"({_p(s + 'addr')} OR (a.v4 AND (a.{s}ip & 3758096384) = 3758096384))"
_asn = lambda s: f"CASE WHEN {_loc(s)} THEN 64512 + ((a.{s}ip >> 8) % 1024) ELSE coalesce({s}n.asn, 0) END AS {s}asn, CASE WHEN {_loc(s)} THEN 'private' ELSE coalesce(lower(substr({s}n.org, 1, 31)), 'na') END AS {s}asnorg"
_add("asn_lookup", _enriched(lambda f, n: enrich.with_asn(f, n).select("record", "sasn", "sasnorg", "dasn", "dasnorg")),
     f"{_NET}, {_best('s')}, {_best('d')} SELECT a.record, {_asn('s')}, {_asn('d')} FROM a LEFT JOIN sn ON a.record = sn.record LEFT JOIN dn ON a.record = dn.record")
_NET6 = f"{fx.cte('flow6', 'network6')}"
#: The narrowest of nested networks starts last and ends first.
_best6 = lambda s: f"{s}n AS (SELECT f.record, arg_max(struct_pack(iso := n.iso, asn := n.asn, org := n.org), n.start_ip || ' ' || translate(n.end_ip, '0123456789abcdef', 'fedcba9876543210')) AS n FROM flow6 f JOIN network6 n ON contains(f.{s}addr, ':') AND f.{s}addr BETWEEN n.start_ip AND n.end_ip GROUP BY f.record)"
_six = lambda work: lambda s, d: work(fx.flows6(s, d), kept(fx.networks(s, d), "networks"), kept(fx.networks6(s, d), "networks6"))
_iso6 = lambda s: f"CASE WHEN {_p('f.' + s + 'addr')} THEN 'private' ELSE coalesce(lower({s}n.n.iso), 'na') END AS {s}country"
_asn6 = lambda s: f"CASE WHEN {_p('f.' + s + 'addr')} THEN 64512 + ((167772160 + f.record % 200) >> 8) % 1024 ELSE coalesce({s}n.n.asn, 0) END AS {s}asn, CASE WHEN {_p('f.' + s + 'addr')} THEN 'private' ELSE coalesce(lower(substr({s}n.n.org, 1, 31)), 'na') END AS {s}asnorg"
_add("country_lookup6", _six(lambda f, n, n6: enrich.with_country(f, n, n6).select("record", "scountry", "dcountry")),
     f"{_NET6}, {_best6('s')}, {_best6('d')} SELECT f.record, {_iso6('s')}, {_iso6('d')} FROM flow6 f LEFT JOIN sn ON f.record = sn.record LEFT JOIN dn ON f.record = dn.record")
_add("asn_lookup6", _six(lambda f, n, n6: enrich.with_asn(f, n, n6).select("record", "sasn", "sasnorg", "dasn", "dasnorg")),
     f"{_NET6}, {_best6('s')}, {_best6('d')} SELECT f.record, {_asn6('s')}, {_asn6('d')} FROM flow6 f LEFT JOIN sn ON f.record = sn.record LEFT JOIN dn ON f.record = dn.record")
_APP = "SELECT record, CASE WHEN lower(category) = 'vpn' THEN {0} ELSE coalesce(lower(appid), 'unknown') END AS ndpi_appid, coalesce(lower(category), 'unspecified') AS ndpi_category FROM raw LEFT JOIN app ON master = ndpi_master AND sub = ndpi_sub WHERE " + _KEPT
for _name, _compat, _form in (("app_lookup", False, "'vpn.' || lower(appid)"), ("app_lookup_compat", True, "lower(appid) || 'vpn.'")):
    _add(_name, lambda s, d, c=_compat: enrich.with_application(normalize.normalize(fx.raw_flows(s, d)), fx.apps(s, d), c).select("record", "ndpi_appid", "ndpi_category"), f"{fx.cte('raw', 'app')} {_APP.format(_form)}")
_WEIGHTS = {i: (10, 50, 100, 250)[i % 4] for i in range(len(enrich.RISK_NAMES))}
_raw("risk_score", lambda r: enrich.with_risk(r, _WEIGHTS).select("record", "ndpi_risk_bits", "ndpi_risk_score", "ndpi_risk_severity"),
     """, w AS (SELECT record, ndpi_risk, CAST(list_sum(list_transform(range(57), lambda i: CASE WHEN (ndpi_risk >> i) & 1 = 1 THEN [10, 50, 100, 250][i % 4 + 1] ELSE 0 END)) AS BIGINT) AS s FROM raw)
SELECT record, ndpi_risk AS ndpi_risk_bits, s AS ndpi_risk_score, CASE WHEN s >= 250 THEN 6 WHEN s >= 200 THEN 5 WHEN s >= 150 THEN 4 WHEN s >= 100 THEN 3 WHEN s >= 50 THEN 2 WHEN s >= 10 THEN 1 ELSE 0 END AS ndpi_risk_severity FROM w""")  # fmt: skip
_NAMES_SQL = "[" + ", ".join(f"'{n}'" for n in enrich.RISK_NAMES) + "]"
_flow("risk_names", lambda f: f.select("id", F.concat_ws(",", enrich.risk_names(F.col("ndpi_risk_bits"))).alias("risks"), F.size(risk_bits_set(F.col("ndpi_risk_bits"))).alias("n")),
      f"SELECT id, array_to_string(list_transform(list_filter(range(63), lambda i: (ndpi_risk_bits >> i) & 1 = 1), lambda i: coalesce({_NAMES_SQL}[i + 1], 'unknown')), ',') AS risks, CAST(bit_count(ndpi_risk_bits) AS INT) AS n FROM flow")

# ---------------------------------------------------------------- selecting

_flow("project_fields", lambda f: select.project(f, "id,proto,saddr,daddr,sbytes"), "SELECT id, proto, saddr, daddr, sbytes FROM flow")
_flow("filter_trigger", lambda f: select.named_filter(f, "trigger").select("id", "trigger"), "SELECT id, trigger FROM flow WHERE trigger > 0")
_flow("filter_severe", lambda f: select.named_filter(f, "severe").select("id", "hbos_severity"), "SELECT id, hbos_severity FROM flow WHERE hbos_severity > 0")
_flow("split_tcp", lambda f: select.split(f, [{"proto": "tcp", "path": "t"}, {"proto": "udp", "path": "u"}])["t"].select("id", "proto"), "SELECT id, proto FROM flow WHERE proto = 'tcp'")
_flow("exclude_columns", lambda f: select.without(f, "stime", "ndpi_risk_bits", "tag"), "SELECT * EXCLUDE (stime, ndpi_risk_bits) FROM flow")
_flow("prefix_match", lambda f: select.starting_with(f, "daddr", "192.168.").select("id", "daddr"), "SELECT id, daddr FROM flow WHERE starts_with(daddr, '192.168.')")
_flow("handshake", lambda f: f.where(select.handshake()).select("id", "proto", "iflags"), "SELECT id, proto, iflags FROM flow WHERE proto <> 'tcp' OR starts_with(iflags, 'Ss')")
_flow("protocol_list", lambda f: select.of_protocols(f, "udp", "tcp").select("id", "proto"), "SELECT id, proto FROM flow WHERE proto IN ('udp', 'tcp')")
_flow("baseline_rows", lambda f: select.baseline_rows(f).select("id", "hbos_severity"), "SELECT id, hbos_severity FROM flow WHERE hbos_severity < 4")
_flow("retention_days", lambda f: select.recent_days(f, _as_of(), 7).select("id", "stime"), f"SELECT id, stime FROM flow WHERE date_trunc('day', stime) > CAST({_REST} AS TIMESTAMP) - INTERVAL 7 DAY")
_flow("retention_age", lambda f: select.not_older(f, _as_of(), 10).select("id", "stime"), f"SELECT id, stime FROM flow WHERE stime >= CAST({_REST} AS TIMESTAMP) - INTERVAL 10 DAY")
_flow("update_join", lambda f: select.update_from(f.select("id", "proto", "hbos_score", "hbos_severity"), f.where("sport % 3 = 0").select("id", (F.col("sport") / 10.0).alias("hbos_score"), F.lit(3).alias("hbos_severity")), "id", ["hbos_score", "hbos_severity"]),
      "SELECT id, proto, CASE WHEN sport % 3 = 0 THEN sport / 10.0::DOUBLE ELSE hbos_score END AS hbos_score, CASE WHEN sport % 3 = 0 THEN 3 ELSE hbos_severity END AS hbos_severity FROM flow")
_flow("store_partition_cols", lambda f: with_partitions(f).select("id", "year", "month", "day", "hour"), "SELECT id, CAST(year(stime) AS INT) AS year, CAST(month(stime) AS INT) AS month, CAST(day(stime) AS INT) AS day, CAST(hour(stime) AS INT) AS hour FROM flow")

# ---------------------------------------------------------------- tags and rules

TAGS = [tag.TagRule("dns", observe="napa", ndpi_appid="dns"), tag.TagRule("cloudflare", proto="tcp", ndpi_appid="tls.cloudflare"), tag.TagRule("internal", orient="ii")]
RULES = [rule.Rule("trigger", hbos_severity=2), rule.Rule("ignore", daddr="192.168."), rule.Rule("trigger", tag="dns")]
_untagged = lambda f: f.withColumn("tag", F.lit(None).cast("array<string>"))
_tags = lambda compat: lambda f: tag.apply_tags(_untagged(f), TAGS, compat).select("id", F.concat_ws(",", "tag").alias("tags"), F.col("tag").isNull().alias("untagged"))
_DNS, _CLOUD, _IN = "starts_with(observe, 'napa') AND starts_with(ndpi_appid, 'dns')", "proto = 'tcp' AND starts_with(ndpi_appid, 'tls.cloudflare')", "starts_with(orient, 'ii')"
_flow("tag_flows", _tags(False), f", t AS (SELECT id, {_DNS} AS a, {_CLOUD} AS b, {_IN} AS c FROM flow) SELECT id, concat_ws(',', CASE WHEN a THEN 'dns' END, CASE WHEN b THEN 'cloudflare' END, CASE WHEN c THEN 'internal' END) AS tags, NOT (a OR b OR c) AS untagged FROM t")
_flow("tag_flows_compat", _tags(True), f", t AS (SELECT id, {_CLOUD} AS b, {_IN} AS c FROM flow) SELECT id, concat_ws(',', 'dns', CASE WHEN b THEN 'cloudflare' END, CASE WHEN c THEN 'internal' END) AS tags, false AS untagged FROM t")
_flow("tagged_rows", lambda f: tag.apply_tags(_untagged(f), TAGS).where(F.array_contains(F.coalesce("tag", F.array().cast("array<string>")), "internal")).select("id"), f"SELECT id FROM flow WHERE {_IN}")
_RULED = f"CASE WHEN {_DNS} THEN 1 WHEN starts_with(daddr, '192.168.') THEN -1 WHEN hbos_severity >= 2 THEN 1 ELSE trigger END"
_flow("apply_rules", lambda f: rule.apply_rules(tag.apply_tags(_untagged(f), TAGS), RULES).select("id", "trigger"), f"SELECT id, {_RULED} AS trigger FROM flow")
#: Rules for one list of thousands, by number; the same in SQL below.
MANY_RULES = 5000


def many_rules(n: int = MANY_RULES) -> list[rule.Rule]:
    """Beginnings of addresses, ports with full addresses, applications with levels, and some wide ones."""
    out = []
    for i in range(n):
        k, j = i % 5, i // 5
        out.append(rule.Rule(
            "trigger" if i % 3 else "ignore",
            daddr=f"{11 + j % 210}.{j * 29 % 256}." if k == 0 else f"{11 + j * 17 % 210}." if k == 3 else "",
            saddr=f"10.0.{j % 4}.{j * 7 % 250}" if k == 1 else "", dport=(443, 80, 22, 53, 8080)[j % 5] if k == 1 else 0,
            sport=1024 + j * 101 % 60000 if k == 2 else 0, proto=("tcp", "udp", "icmp")[j % 3] if k == 4 else "",
            observe=("napa", "sonoma", "marin")[j % 3] if k == 4 else "", appid=("dns", "tls.", "ssh", "quic")[j % 4] if k == 3 else "",
            risk_severity=5 + j % 2 if k == 4 else 0, hbos_severity=1 + j % 4 if k == 3 else 0,
        ))
    return out


_MANY = f"""many AS (SELECT i, CASE WHEN i % 3 = 0 THEN -1 ELSE 1 END AS action,
  CASE WHEN k = 0 THEN concat(11 + j % 210, '.', j * 29 % 256, '.') WHEN k = 3 THEN concat(11 + j * 17 % 210, '.') ELSE '' END AS daddr,
  CASE WHEN k = 1 THEN concat('10.0.', j % 4, '.', j * 7 % 250) ELSE '' END AS saddr, CASE WHEN k = 1 THEN [443, 80, 22, 53, 8080][j % 5 + 1] ELSE 0 END AS dport,
  CASE WHEN k = 2 THEN 1024 + j * 101 % 60000 ELSE 0 END AS sport, CASE WHEN k = 4 THEN ['tcp', 'udp', 'icmp'][j % 3 + 1] ELSE '' END AS proto,
  CASE WHEN k = 4 THEN ['napa', 'sonoma', 'marin'][j % 3 + 1] ELSE '' END AS observe, CASE WHEN k = 3 THEN ['dns', 'tls.', 'ssh', 'quic'][j % 4 + 1] ELSE '' END AS appid,
  CASE WHEN k = 4 THEN 5 + j % 2 ELSE 0 END AS risk, CASE WHEN k = 3 THEN 1 + j % 4 ELSE 0 END AS level FROM (SELECT i, i % 5 AS k, i // 5 AS j FROM range({MANY_RULES}) AS r(i)))"""
_flow("apply_rules_many", lambda f: rule.apply_rules(f, many_rules()).select("id", "trigger"),
      f""", {_MANY}, hit AS (SELECT f.id, arg_max(action, i) AS action FROM flow f JOIN many m ON starts_with(f.daddr, m.daddr) AND starts_with(f.saddr, m.saddr)
  AND (m.dport = 0 OR m.dport = f.dport) AND (m.sport = 0 OR m.sport = f.sport) AND (m.proto = '' OR m.proto = f.proto) AND starts_with(f.observe, m.observe)
  AND starts_with(f.ndpi_appid, m.appid) AND f.ndpi_risk_severity >= m.risk AND f.hbos_severity >= m.level GROUP BY f.id)
SELECT flow.id, coalesce(hit.action, trigger) AS trigger FROM flow LEFT JOIN hit ON hit.id = flow.id""")
_flow("trigger_counts", rule.trigger_counts, "SELECT count(*) AS total, count(*) FILTER (WHERE hbos_severity >= 4) AS severe, count(*) FILTER (WHERE hbos_severity = 3) AS high, count(*) FILTER (WHERE hbos_severity = 2) AS medium, count(*) FILTER (WHERE hbos_severity = 1) AS low FROM flow WHERE trigger > 0")

# ---------------------------------------------------------------- metrics and dashboards


def _series_sql(s: metrics.Series) -> str:
    where, key = s.where.replace("startswith", "starts_with"), s.key.replace("AS string", "AS VARCHAR")
    return f"SELECT CAST(300 AS BIGINT) AS stream, date_trunc('minute', stime) AS bucket, observe, '{s.name}' AS name, {key} AS key, CAST(sum({s.value}) AS BIGINT) AS value FROM flow WHERE {where} GROUP BY bucket, observe, {key}, {s.beside}"


for _name, _s in metrics.SERIES.items():
    _flow(f"metric_{_name}", lambda f, n=_name: metrics.metric(f, n), _series_sql(_s))
_ALL = " UNION ALL ".join(_series_sql(s) for s in metrics.SERIES.values())
_flow("metrics_all", metrics.metrics_all, _ALL)
_flow("bucket_bounds", lambda f: metrics.bucket_bounds(metrics.metric(f, "flow")), "SELECT date_trunc('minute', min(stime)) AS first_bucket, date_trunc('minute', max(stime)) AS last_bucket FROM flow")
#: A dashboard asks only for the series it shows.
_dash = lambda name, run, sql, *series: _flow(name, lambda f: run(metrics.metrics_all(f, series)), f", m AS ({_ALL}) {sql}")
_two = "SELECT bucket, key, CAST(sum(value){2} AS BIGINT) AS total FROM m WHERE name = '{0}' AND key IN {1} GROUP BY bucket, key"
_dash("dash_flow", dashboards.flow_rate, "SELECT bucket, CAST(sum(value) AS BIGINT) AS total FROM m WHERE name = 'flow' GROUP BY bucket", "flow")
_dash("dash_bits", dashboards.bits, _two.format("bytes", "('sbytes', 'dbytes')", " * 8"), "sbytes", "dbytes")
_dash("dash_pkts", dashboards.packets, _two.format("pkts", "('spkts', 'dpkts')", ""), "spkts", "dpkts")
for _k in ("proto", "daddr", "appid"):
    _dash(f"dash_{_k}_top", lambda m, k=_k: dashboards.by_key(m, k), f"SELECT bucket, key, CAST(sum(value) AS BIGINT) AS total FROM m WHERE name = '{_k}' GROUP BY bucket, key ORDER BY bucket, key, total LIMIT 10", _k)
_dash("dash_dns_top", lambda m: dashboards.totals(m, "dns"), "SELECT key, CAST(sum(value) AS BIGINT) AS total FROM m WHERE name = 'dns' GROUP BY key ORDER BY key, total LIMIT 100", "dns")

# ---------------------------------------------------------------- models

_flow("observations", model.observations, "SELECT DISTINCT observe, dvlan, proto FROM flow")
_flow("distinct_days", model.distinct_days, "SELECT DISTINCT CAST(year(stime) AS INT) AS year, CAST(month(stime) AS INT) AS month, CAST(day(stime) AS INT) AS day FROM flow")
_flow("baseline_span", model.baseline_span, "SELECT date_diff('day', min(stime), max(stime)) AS days FROM flow")

NUMBERS = ("dur", "rtt", "sbytes", "dbytes", "spkts", "siat", "ssmallpktcnt", "dmaxpktsize")


def _step_sql(lo: str, hi: str, whole: bool = True) -> str:
    raw = f"(({hi} - {lo}) / 10.0::DOUBLE)"
    k = f"power(10.0::DOUBLE, floor(log10({raw})))"
    flat = f"{hi} = {lo}" + (f" OR {hi} - {lo} < 8" if whole else "")
    return f"CASE WHEN {flat} THEN 1.0::DOUBLE ELSE {k} * CASE WHEN {raw} / {k} < 1.5 THEN 1.0::DOUBLE WHEN {raw} / {k} < 3.0 THEN 2.0::DOUBLE WHEN {raw} / {k} < 7.5 THEN 5.0::DOUBLE ELSE 10.0::DOUBLE END END"


def _key_sql(f: str) -> str:
    kind, m = FEATURES[f]
    if kind == NUMERICAL:
        step = f"step_{f}"
        return f"CAST(CAST(greatest(ceil({f} / {step}), floor(lo_{f} / {step}) + 1) * {step} AS BIGINT) AS VARCHAR)"
    if kind == NUMERIC:
        return f"CAST({f'(({f} % {m}) + {m}) % {m}' if m else f} AS VARCHAR)"
    if kind == STRING:
        return f
    if kind == TIME:
        return f"CAST(hour({f}) AS VARCHAR)"
    first, second = (f"CAST(split_part({f}, '.', {i}) AS BIGINT)" for i in (1, 2))
    return f"CAST(CASE WHEN {first} < 128 THEN {first} ELSE {first} + {second} * 256 END AS VARCHAR)"


def _model_sql(features: tuple[str, ...]) -> str:
    """h: the long histogram; n: its counts; l: the keys of all tcp and udp flows; mr: the rows that are learnt from."""
    numeric = [f for f in features if FEATURES[f][0] == NUMERICAL]
    bounds = "".join(f", min({f})::DOUBLE AS lo_{f}, max({f})::DOUBLE AS hi_{f}" for f in numeric)
    steps = "".join(f", lo_{f}, {_step_sql(f'lo_{f}', f'hi_{f}')} AS step_{f}" for f in numeric)
    melt = " UNION ALL ".join(f"SELECT id, observe, dvlan AS vlan, proto, shaken, hbos_score, '{f}' AS name, '{FEATURES[f][0]}' AS kind, {_key_sql(f)} AS key FROM kf" + (" WHERE ndpi_appid <> 'unknown'" if f == "ndpi_appid" else "") for f in features)
    return f""", mf AS (SELECT *, proto <> 'tcp' OR starts_with(iflags, 'Ss') AS shaken FROM flow WHERE proto IN ('udp', 'tcp')),
b AS (SELECT observe, dvlan, proto{bounds} FROM mf WHERE shaken GROUP BY observe, dvlan, proto),
st AS (SELECT observe, dvlan, proto{steps} FROM b),
kf AS (SELECT * FROM mf JOIN st USING (observe, dvlan, proto)),
l AS ({melt}),
h AS (SELECT observe, vlan, proto, name, kind, key, count(*) AS value FROM l WHERE shaken GROUP BY observe, vlan, proto, name, kind, key),
n AS (SELECT observe, vlan, proto, name, kind, CAST(sum(value) AS BIGINT) AS count, count(*) AS bin_count FROM h GROUP BY observe, vlan, proto, name, kind)"""


_HIST = "SELECT observe, vlan, proto, name, kind, key, value FROM h"
for _name, _fs in (("hist_numeric", NUMBERS), ("hist_mod_port", ("sport", "dport")), ("hist_string", ("spd", "orient", "ndpi_appid")), ("hist_ip", ("saddr", "daddr")), ("hist_hour", ("stime",)), ("model_histogram", DEFAULT_FEATURES)):
    _flow(_name, lambda f, fs=_fs: histogram.histograms(f, fs), f"{_model_sql(_fs)} {_HIST}")
_MODULI = "map {" + ", ".join(f"'{f}': {FEATURES[f][1]}" for f in DEFAULT_FEATURES) + "}"
_flow("model_histogram_days", lambda f: model.from_days(model.day_values(f)).histogram, f"{_model_sql(DEFAULT_FEATURES)} SELECT * FROM h")
_flow("hist_numeric_days", lambda f: model.from_days(model.day_values(f, NUMBERS), NUMBERS).histogram, f"{_model_sql(NUMBERS)} SELECT * FROM h")
_flow("model_summary", lambda f: model.summarize(histogram.histograms(f)), f"{_model_sql(DEFAULT_FEATURES)} SELECT observe, vlan, proto, name, kind AS histogram, count, CAST({_MODULI}[name] AS INT) AS hash_size, bin_count FROM n")


def _built(f: DataFrame, features=DEFAULT_FEATURES) -> model.Model:
    """A model without thresholds, for queries that need none."""
    h = kept(histogram.histograms(f, features), "model-histogram")
    numeric = tuple(x for x in features if FEATURES[x][0] == NUMERICAL)
    return model.Model(h, kept(model.summarize(h, histogram.ranges(histogram.model_rows(f), numeric)), "model-summary"))


_flow("model_features", lambda f: histogram.histograms(f).select("observe", "vlan", "proto", "name", "kind").distinct(), f"{_model_sql(DEFAULT_FEATURES)} SELECT DISTINCT observe, vlan, proto, name, kind FROM h")
_flow("model_browse", lambda f: model.browse(_built(f), "napa", "tcp", NUMERIC), f"{_model_sql(DEFAULT_FEATURES)} SELECT name, key, CAST(sum(value) AS BIGINT) AS value FROM h WHERE observe = 'napa' AND proto = 'tcp' AND kind = 'numeric_category' GROUP BY name, key")


def _probabilities(f: DataFrame) -> DataFrame:
    out = score.probabilities(f, _built(f), DEFAULT_FEATURES).where("_modelled")
    return out.select("id", *[F.round(f"_p_{x}", 6).alias(f"p_{x}") for x in DEFAULT_FEATURES])


_P = "pr AS (SELECT l.*, (coalesce(h.value, 0) + 1)::DOUBLE / (n.count + 1) AS p FROM l JOIN n USING (observe, vlan, proto, name) LEFT JOIN h USING (observe, vlan, proto, name, key))"
_flow("hbos_prob", _probabilities, f"{_model_sql(DEFAULT_FEATURES)}, {_P} SELECT id, {', '.join(f'round(max(p) FILTER (WHERE name = {chr(39)}{x}{chr(39)}), 6) AS p_{x}' for x in DEFAULT_FEATURES)} FROM pr WHERE shaken GROUP BY id")
_SCORED = f"{_model_sql(DEFAULT_FEATURES)}, {_P}, sc AS (SELECT id, observe, vlan, proto, shaken, sum(log10(1.0 / p)) AS s FROM pr GROUP BY id, observe, vlan, proto, shaken)"
_flow("hbos_score", lambda f: score.score(f, _built(f), DEFAULT_FEATURES).select("id", F.round("hbos_score", 6).alias("hbos_score")), f"{_SCORED} SELECT flow.id, round(coalesce(CASE WHEN shaken THEN s END, 0.0), 6) AS hbos_score FROM flow LEFT JOIN sc USING (id)")
_STATS = ("min", "max", "skewness", "avg", "stddev", "mad", "median", "quantile")
_LEVELS = ("low", "medium", "high", "severe")
_top = lambda k: f"CASE WHEN max > min AND (ceil(max / step) - {k}) * step > min THEN (ceil(max / step) - {k}) * step ELSE 0.0 END"
_SUMMARY = f"""{_SCORED}, md AS (SELECT observe, vlan, proto, median(s) AS m FROM sc GROUP BY observe, vlan, proto),
sm AS (SELECT observe, vlan, proto, min(s) AS min, max(s) AS max, skewness(s) AS skewness, avg(s) AS avg, stddev_pop(s) AS stddev, median(abs(s - m)) AS mad, median(s) AS median, quantile_cont(s, 0.99999) AS quantile
  FROM sc JOIN md USING (observe, vlan, proto) GROUP BY observe, vlan, proto),
sp AS (SELECT *, {_step_sql('min', 'max', False)} AS step FROM sm),
th AS (SELECT *, {_top(4)} AS low, {_top(3)} AS medium, {_top(2)} AS high, {_top(1)} AS severe FROM sp)"""


def _summary(f: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    out = model.build(f).thresholds
    return out.select("observe", "vlan", "proto", *[F.round(c, 6).alias(c) for c in columns])


_flow("hbos_summary", lambda f: _summary(f, _STATS), f"{_SUMMARY} SELECT observe, vlan, proto, {', '.join(f'round({c}, 6) AS {c}' for c in _STATS)} FROM th")
_flow("hbos_thresholds", lambda f: _summary(f, _LEVELS), f"{_SUMMARY} SELECT observe, vlan, proto, {', '.join(f'round({c}, 6) AS {c}' for c in _LEVELS)} FROM th")
_GRADED = f"{_SUMMARY}, g AS (SELECT flow.id, flow.ndpi_risk_bits, coalesce(shaken, false) AS scored, CASE WHEN shaken THEN CASE WHEN s >= severe THEN 4 WHEN s >= high THEN 3 WHEN s >= medium THEN 2 WHEN s >= low THEN 1 ELSE 0 END ELSE 0 END AS hbos_severity FROM flow LEFT JOIN sc USING (id) LEFT JOIN th ON sc.observe = th.observe AND sc.vlan = th.vlan AND sc.proto = th.proto)"
_scored_flows = lambda f: score.score_flows(f, model.build(f), DEFAULT_FEATURES)
_flow("hbos_severity", lambda f: _scored_flows(f).select("id", "observe", "proto", F.round("hbos_score", 6).alias("hbos_score"), "hbos_severity"),
      f"{_GRADED} SELECT flow.id, flow.observe, flow.proto, round(CASE WHEN g.scored THEN sc.s ELSE 0.0 END, 6) AS hbos_score, g.hbos_severity FROM flow JOIN g USING (id) LEFT JOIN sc USING (id)")
_flow("hbos_explain", lambda f: _scored_flows(f).where("hbos_map IS NOT NULL").select("id", F.explode("hbos_map").alias("feature", "p")),
      f"{_GRADED} SELECT id, name AS feature, round(p, 3) AS p FROM pr JOIN g USING (id) WHERE scored AND (hbos_severity > 0 OR ndpi_risk_bits > 0)")
_flow("trigger_details", lambda f: score.trigger_details(_scored_flows(f)).select("id", "trigger", F.size("hbos_map").alias("features"), F.concat_ws(",", "ndpi_risk_list").alias("risks")),
      f"{_GRADED} SELECT flow.id, flow.trigger, CASE WHEN g.scored AND (g.hbos_severity > 0 OR g.ndpi_risk_bits > 0) THEN {len(DEFAULT_FEATURES)} END AS features, CASE WHEN g.scored AND (g.hbos_severity > 0 OR g.ndpi_risk_bits > 0) THEN array_to_string(list_transform(list_filter(range(63), lambda i: (flow.ndpi_risk_bits >> i) & 1 = 1), lambda i: coalesce({_NAMES_SQL}[i + 1], 'unknown')), ',') ELSE '' END AS risks FROM flow JOIN g USING (id) WHERE flow.trigger > 0")
_flow("hist_report", lambda f: histogram.histogram_report(f, "dur"), f""", b AS (SELECT min(dur)::DOUBLE AS lo, max(dur)::DOUBLE AS hi FROM flow), s AS (SELECT lo, {_step_sql('lo', 'hi')} AS step FROM b),
c AS (SELECT round(greatest(ceil(dur / step), floor(lo / step) + 1) * step, 6) AS bin, count(*) AS count FROM flow, s GROUP BY bin)
SELECT bin, count, repeat('█', CAST(ceil(40 * count / (SELECT max(count) FROM c)) AS INT)) AS bar FROM c""")  # fmt: skip
_flow("pipeline_analyse", lambda f: analyse(_untagged(f), TAGS, RULES, model.build(f)).select("id", F.concat_ws(",", "tag").alias("tags"), "hbos_severity", "trigger"),
      f"{_GRADED} SELECT flow.id, concat_ws(',', CASE WHEN {_DNS} THEN 'dns' END, CASE WHEN {_CLOUD} THEN 'cloudflare' END, CASE WHEN {_IN} THEN 'internal' END) AS tags, g.hbos_severity, CASE WHEN {_DNS} THEN 1 WHEN starts_with(daddr, '192.168.') THEN -1 WHEN g.hbos_severity >= 2 THEN 1 ELSE trigger END AS trigger FROM flow JOIN g USING (id)")

# ---------------------------------------------------------------- samples and bins

_number = lambda: F.regexp_extract("id", r"(\d+)$", 1).cast("long") * 7919
_flow("sample_strata", lambda f: sample.sample_strata(f, _as_of(), 5, 7, _number()).select("id", "observe", "dvlan", "proto"),
      f"SELECT id, observe, dvlan, proto FROM flow WHERE hbos_severity < 4 AND date_trunc('day', stime) > CAST({_REST} AS TIMESTAMP) - INTERVAL 7 DAY AND CAST(substr(id, 3) AS BIGINT) * 7919 % 10000 < 500")
_G = list(GROUP)
_gs = ", ".join(_G)
BINS = 8
_EF = f""", o AS (SELECT {_gs}, sbytes AS v, row_number() OVER (PARTITION BY {_gs} ORDER BY sbytes) - 1 AS r, count(*) OVER (PARTITION BY {_gs}) AS n FROM flow),
q AS (SELECT {_gs}, v, min(r) AS f, max(r) AS t, n FROM o GROUP BY {_gs}, v, n), w AS (SELECT *, lead(v) OVER (PARTITION BY {_gs} ORDER BY v) AS nx FROM q),
m AS (SELECT {_gs}, i, CASE WHEN f < x AND t > x AND (f + t) / 2.0 <= i * n / {BINS}.0 THEN coalesce(nx, v + 1) ELSE v END AS b
  FROM (SELECT w.*, i, least(CAST(round(i * n / {BINS}.0) AS BIGINT), n - 1) AS x FROM w, range(1, {BINS}) k(i)) WHERE x BETWEEN f AND t),
e AS (SELECT * FROM m UNION ALL SELECT {_gs}, 0, min(v) FROM o GROUP BY {_gs} UNION ALL SELECT {_gs}, {BINS}, max(v) + 1 FROM o GROUP BY {_gs}),
bd AS (SELECT {_gs}, b AS boundary FROM (SELECT *, max(b) OVER (PARTITION BY {_gs} ORDER BY i, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM e) WHERE p IS NULL OR b > p)"""
_flow("equal_freq_bounds", lambda f: binning.equal_frequency(f, _G, "sbytes", BINS), f"{_EF} SELECT * FROM bd")
_flow("equal_freq_bounds_all", lambda f: binning.equal_frequency(f, [], "sbytes", BINS), _EF.replace(f"PARTITION BY {_gs}", "PARTITION BY 1").replace(f"GROUP BY {_gs}, v, n", "GROUP BY v, n").replace(f" FROM o GROUP BY {_gs}", " FROM o").replace(f"{_gs}, ", "") + " SELECT * FROM bd")
_flow("equal_freq_counts", lambda f: binning.bin_counts(f, kept(binning.equal_frequency(f, _G, "sbytes", BINS), "bins"), _G, "sbytes"),
      f"{_EF}, ed AS (SELECT {_gs}, boundary AS low, lead(boundary) OVER (PARTITION BY {_gs} ORDER BY boundary) AS high FROM bd) SELECT {', '.join('ed.' + g for g in _G)}, low, high, count(o.v) AS count FROM ed LEFT JOIN o ON {' AND '.join(f'ed.{g} = o.{g}' for g in _G)} AND o.v >= low AND o.v < high WHERE high IS NOT NULL GROUP BY {', '.join('ed.' + g for g in _G)}, low, high")


def _given_bins(f: DataFrame) -> DataFrame:
    """Four bins a group by quarter of the value range, empty ones left out."""
    return binning.bin_frequency(f, _G, "dur", (0, 15000, 30000, 45000, 60000))


_BINS = f", bn AS (SELECT {_gs}, CAST(floor(dur / 15000.0) AS INT) AS bin, min(dur)::DOUBLE AS low, max(dur)::DOUBLE AS high, count(*) AS frequency FROM flow GROUP BY {_gs}, floor(dur / 15000.0))"
_flow("bin_frequency", _given_bins, f"{_BINS} SELECT * FROM bn")
_flow("bin_edges", lambda f: binning.bin_edges(_given_bins(f), _G), f"{_BINS} SELECT {_gs}, 0 AS position, min(low) AS edge FROM bn GROUP BY {_gs} UNION ALL SELECT {_gs}, bin + 1, coalesce((high + lead(low) OVER (PARTITION BY {_gs} ORDER BY bin)) / 2, high) FROM bn")
_flow("predict_bin", lambda f: binning.predict_bin(f.select("id", *_G, (F.col("dbytes") * 0.7 - 2000).alias("x")), _given_bins(f), _G, "x").select("id", "bin"),
      f"{_BINS} SELECT id, arg_min(bin, (greatest(low - x, x - high, 0.0), bin)) AS bin FROM (SELECT id, {_gs}, dbytes * 0.7::DOUBLE - 2000 AS x FROM flow) JOIN bn USING ({_gs}) GROUP BY id")
_flow("optimal_bins", lambda f: binning.optimal_binning(f, _G, "dport", 3, 2))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
