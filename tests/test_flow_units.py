"""Hand-computed cases, file handling and properties."""

import datetime as dt
import ipaddress
import json
import math
import os
import random
import time
import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark import fixtures, schema
from tidemark.functions import expressions as ex
from tidemark.operators import binning, enrich, histogram, metrics, model, normalize, rule, rule_index, sample, score, select, tag
from tidemark.plans import flow_pipeline
from tidemark.shared import kept
from tidemark.sources import files, sinks
from tidemark.streaming import ledger, stages


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.fixture(scope="module")
def flows(spark, sf_dir):
    return kept(fixtures.flows(spark, sf_dir), "test-flows")


@pytest.fixture(scope="module")
def full(spark, flows):
    """Flows with all 65 columns."""
    missing = [f for f in schema.flow_schema().fields if f.name not in flows.columns]
    out = flows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
    return kept(out.select(*[F.col(f.name).cast(f.dataType) for f in schema.flow_schema().fields]), "test-full")


# ---------------------------------------------------------------- expressions


@pytest.mark.parametrize(("forward", "reverse", "want"), [(0, 0, "." * 16), (2, 18, "Ss.a............"), (0x13, 0x02, "SsA...F........."), (255, 255, "SsAaRrFfCcUuPpEe"), (0x28, 0x40, "..........U.P..e")])
def test_flag_text(spark, forward, reverse, want):
    assert one(spark, ex.flag_text(F.lit(forward), F.lit(reverse))) == want


@pytest.mark.parametrize(("address", "want"), [("10.1.2.3", True), ("100.1.1.1", False), ("172.15.0.1", False), ("172.16.0.1", True), ("172.31.9.9", True), ("172.32.0.1", False), ("192.168.0.1", True), ("192.169.0.1", False), ("127.0.0.1", False), ("fe80::1", False)])
def test_private(spark, address, want):
    assert one(spark, ex.is_private(F.lit(address))) is want


@pytest.mark.parametrize(("address", "want"), [("10.200.3.4", 10), ("127.0.0.1", 127), ("128.1.2.3", 128 + 256), ("192.168.1.1", 192 + 168 * 256), ("250.7.8.9", 250 + 7 * 256), ("2001:db8::1", 0x20 + 256 * 0x01), ("fe80::7", 0xFE + 256 * 0x80)])
def test_network_class(spark, address, want):
    assert one(spark, ex.network_class(F.lit(address))) == want


@pytest.mark.parametrize(("low", "high", "whole", "want"), [(0, 100, True, 10), (0, 7, True, 1), (5, 5, True, 1), (0, 10, True, 1), (0, 20, True, 2), (0, 50, True, 5), (0, 1, False, 0.1), (0, 29, True, 2), (0, 74, True, 5), (0, 76, True, 10)])
def test_nice_step(spark, low, high, whole, want):
    assert one(spark, ex.nice_step(F.lit(float(low)), F.lit(float(high)), whole)) == pytest.approx(want)


def test_risk_names(spark):
    assert one(spark, enrich.risk_names(F.lit(0b101).cast("long"))) == ["none", "possible sql injection"]
    assert one(spark, enrich.risk_names(F.lit((1 << 56) | (1 << 57)).cast("long"))) == ["obfuscated", "unknown"]
    assert one(spark, enrich.risk_names(F.lit(-(1 << 63)).cast("long"))) == ["unknown"]
    assert one(spark, enrich.risk_names(F.lit(0).cast("long"))) == []


def test_pcr(spark):
    got = [one(spark, normalize.pcr(F.lit(a), F.lit(b))) for a, b in ((0, 0), (10, 0), (0, 10), (21, 19), (19, 21), (3, 1))]
    assert got == [0, 10, -10, 1, -1, 5]


# ---------------------------------------------------------------- tags and rules


def test_tags_and_rules(spark):
    f = spark.createDataFrame([("a", None, "dns.x", "tcp", 0, 5), ("b", ["dns"], "dns", "udp", 0, 0), ("c", ["x"], "web", "tcp", 1, 0)], "id string, tag array<string>, ndpi_appid string, proto string, trigger int, hbos_severity int")
    rules = [tag.TagRule("dns", ndpi_appid="dns"), tag.TagRule("udp", proto="udp")]
    assert {r["id"]: r["tag"] for r in tag.apply_tags(f, rules).collect()} == {"a": ["dns"], "b": ["dns", "udp"], "c": ["x"]}
    wild = [tag.TagRule("t", proto="icmp")]
    assert {r["id"]: r["tag"] for r in tag.apply_tags(f, wild, compat=True).collect()} == {"a": ["t"], "b": ["dns"], "c": ["x"]}
    got = rule.apply_rules(f, [rule.Rule("trigger", tag="dns"), rule.Rule("ignore", proto="udp"), rule.Rule("trigger", hbos_severity=5), rule.Rule("ignore")])
    assert {r["id"]: r["trigger"] for r in got.collect()} == {"a": 1, "b": -1, "c": 1}


def test_many_tag_rules_plan_fast(spark, flows):
    rules = [tag.TagRule(f"t{i % 60}", daddr=f"{11 + i % 200}.", proto="tcp" if i % 2 else "") for i in range(100)]
    began = time.time()
    got = tag.apply_tags(flows.withColumn("tag", F.lit(None).cast("array<string>")).select("daddr", "proto", *[c for c in flows.columns if c in ("observe", "saddr", "sport", "dport", "ndpi_appid", "orient")], "tag"), rules).collect()
    assert time.time() - began < 20
    for r in got:
        want = list(dict.fromkeys(x.tag for x in rules if r["daddr"].startswith(x.daddr) and x.proto in ("", r["proto"])))
        assert r["tag"] == (want or None)


def plain_matches(row, r):
    starts = {"observe": "observe", "saddr": "saddr", "daddr": "daddr", "appid": "ndpi_appid", "ndpi_appid": "ndpi_appid", "orient": "orient"}
    asked = [(row[c] is not None and row[c].startswith(v)) for a, c in starts.items() if (v := getattr(r, a, ""))]
    asked += [row[c] == v for c in ("proto", "sport", "dport") if (v := getattr(r, c))]
    asked += [v in (row["tag"] or [])] if isinstance(r, rule.Rule) and (v := r.tag) else []
    asked += [row[c] is not None and row[c] >= v for a, c in (("risk_severity", "ndpi_risk_severity"), ("hbos_severity", "hbos_severity")) if (v := getattr(r, a, 0))]
    return asked


def made_rules(seed, n, kind):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        v = {
            "daddr": f"{rng.randint(11, 220)}.{rng.randint(0, 255)}."[: rng.randint(2, 8)], "saddr": f"10.0.{rng.randint(0, 3)}.{rng.randint(0, 249)}", "sport": rng.randint(1024, 61000),
            "dport": rng.choice([443, 80, 22, 53, 8080]), "proto": rng.choice(["tcp", "udp", "icmp"]), "observe": rng.choice(["napa", "sonoma", "m"]), "orient": rng.choice(["i", "io"]),
            "appid" if kind is rule.Rule else "ndpi_appid": rng.choice(["dns", "dns.doh", "tls.", "q"]),
        }
        if kind is rule.Rule:
            v |= {"tag": f"t{rng.randint(0, 5)}", "risk_severity": rng.randint(1, 6), "hbos_severity": rng.randint(1, 4)}
        asked = {a: v[a] for a in rng.sample(sorted(v), rng.randint(0, 3))}
        out.append(rule.Rule(rng.choice(["trigger", "ignore"]), **asked) if kind is rule.Rule else tag.TagRule(f"t{i % 40}", **asked))
    return out


@pytest.mark.parametrize("n", [5, 60, 5000])
def test_rule_lists_of_any_size(spark, flows, n):
    rules = made_rules(n, n, rule.Rule)
    some = flows.limit(300).withColumn("tag", F.when(F.col("sport") % 3 == 0, F.array(F.concat(F.lit("t"), F.col("sport") % 7))))
    some = some.unionByName(some.limit(3).withColumns({"daddr": F.lit(None).cast("string"), "observe": F.lit(None).cast("string"), "id": F.concat(F.lit("null-"), "id")}))
    some = kept(some, "test-rules")
    began = time.time()
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        got = {r["id"]: r["trigger"] for r in rule.apply_rules(some, rules).collect()}
    assert time.time() - began < 60
    for r in some.collect():
        want = r["trigger"]
        for x in rules:
            if (asked := plain_matches(r, x)) and all(asked):
                want = rule.ACTIONS[x.action]
        assert got[r["id"]] == want


def test_thousands_of_tag_rules(spark, flows):
    rules = made_rules(1, 3000, tag.TagRule)
    some = kept(flows.limit(200).withColumn("tag", F.when(F.col("sport") % 3 == 0, F.array(F.lit("t7")))), "test-tags")
    got = {r["id"]: r["tag"] for r in tag.apply_tags(some, rules).collect()}
    for r in some.collect():
        have = r["tag"] or []
        want = list(dict.fromkeys([*have, *[x.tag for x in rules if all(plain_matches(r, x))]]))
        assert got[r["id"]] == (want or r["tag"])


def test_each_rule_is_filed_once(spark):
    entries = [rule_index.Entry(i, "1", rule.SHAPE.wanted(r)) for i, r in enumerate(made_rules(2, 500, rule.Rule))]
    tables, rest = rule_index.filed(entries, rule.SHAPE)
    assert sorted([e.number for t in tables.values() for es in t.values() for e in es] + [e.number for e in rest]) == list(range(500))
    assert len(tables) <= 3 + 5 * rule_index.LENGTHS


def test_rule_lists():
    assert rule.load_rules('[{"action": "trigger", "proto": "tcp", "note": "x"}]') == [rule.Rule("trigger", proto="tcp")]
    assert tag.load_tags('{"tag": "a"}\n{"tag": "b", "dport": 5}\n') == [tag.TagRule("a"), tag.TagRule("b", dport=5)]
    with pytest.raises(ValueError, match="no rules"):
        rule.checked([])
    with pytest.raises(ValueError, match="unknown actions"):
        rule.checked([rule.Rule("drop")])
    with pytest.warns(UserWarning):
        rule.checked([rule.Rule("ignore")] * 1001)


# ---------------------------------------------------------------- selecting


def test_projection_and_filters(flows):
    assert select.project(flows, "id, proto").columns == ["id", "proto"]
    assert select.project(flows).columns == flows.columns
    for bad in (lambda: select.project(flows, "id,nope"), lambda: select.named_filter(flows, "other")):
        with pytest.raises(ValueError):
            bad()


def test_schema(spark):
    assert len(schema.FLOW_NAMES) == 65 == len(schema.flow_schema())
    old = spark.createDataFrame([(1, 2)], "version int, x int")
    assert schema.upgrade(old).collect() == [(100, 2)]
    assert schema.signed(spark.range(1).select(F.lit(7).cast("decimal(20,0)").alias("n"))).dtypes == [("n", "bigint")]


# ---------------------------------------------------------------- bins


@pytest.mark.parametrize("kind", [int, float])
def test_optimal_bins(kind):
    values = [kind(v) for v in [1, 2, 3, 8, 9, 10, 15, 16, 17, 18]]
    bins = binning.optimal_bins(values, 3, 2)
    assert [(lo, hi, n) for lo, hi, n, _ in bins] == [(1, 3, 3), (8, 10, 3), (15, 18, 4)]
    assert sum(n for *_, n, _ in bins) == len(values)


def test_optimal_bins_edge_cases():
    assert binning.optimal_bins([5] * 5, 3, 2) == [(5, 5, 5, 0.0)]
    assert [b[:3] for b in binning.optimal_bins([1, 2, 3, 10, 11, 12], 2, 2)] == [(1, 3, 3), (10, 12, 3)]
    assert [b[2] for b in binning.optimal_bins([1, 2, 3, 10, 11], 2, 1)] == [3, 2]
    for bad in ([], [1.0, float("nan")], [1.0, float("inf")]):
        with pytest.raises(ValueError):
            binning.optimal_bins(bad, 2, 1)
    with pytest.raises(ValueError):
        binning.optimal_bins([1], 2, 2)


def test_optimal_bins_least_cost():
    rng = np.random.default_rng(0)
    for _ in range(20):
        x = np.sort(rng.integers(0, 30, 9))
        want = min(sum(((p - p.mean()) ** 2).sum() for p in np.split(x, cuts) if len(p)) for a in range(1, 9) for b in range(a, 9) for cuts in [[a, b]] if min(len(p) for p in np.split(x, cuts) if len(p)) >= 2 and a >= 2 and (b == a or b - a >= 2)) if x[0] != x[-1] else 0
        got = sum(b[3] for b in binning.optimal_bins(x, 3, 2))
        assert got <= want + 1e-9


def test_optimal_bins_of_counted_values():
    rng = np.random.default_rng(1)
    for _ in range(200):
        x = np.sort(rng.integers(0, 12, int(rng.integers(8, 40))) ** 2)
        v, c = np.unique(x, return_counts=True)
        most, least = int(rng.integers(1, 5)), int(rng.integers(2, 7))
        # every cut between rows, without weights
        cost = lambda a, b: ((x[a:b] - x[a:b].mean()) ** 2).sum() if b - a >= least else np.inf
        best = [0.0] + [np.inf] * len(x)
        want = np.inf
        for _ in range(most):
            best = [np.inf] + [min(best[j] + cost(j, i) for j in range(i)) for i in range(1, len(x) + 1)]
            want = min(want, best[-1])
        got = binning.optimal_bins(v, most, least, c)
        assert math.isclose(sum(b[3] for b in got), want, rel_tol=1e-9, abs_tol=1e-6)
        assert sum(b[2] for b in got) == len(x) and min(b[2] for b in got) >= least


def test_optimal_binning_by_one_rule_at_every_size(spark):
    df = spark.range(2001 + 5001).selectExpr("id < 2001 AS small", "IF(id IN (0, 7001), 443, 80) AS v")
    got = {(r["small"], r["bin"]): (r["low"], r["high"], r["frequency"]) for r in binning.optimal_binning(df, ["small"], "v", 3, 2).collect()}
    assert got == {(True, 0): (80, 80, 1999), (True, 1): (80, 443, 2), (False, 0): (80, 80, 4999), (False, 1): (80, 443, 2)}


def test_groups_without_valid_bins(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("b", 2.0), ("b", 9.0), ("b", 9.5), ("c", float("nan")), ("c", 1.0)], "g string, v double")
    got = binning.optimal_binning(df, ["g"], "v", 2, 2)
    rows = {(r["g"], r["bin"]): (r["low"], r["high"], r["reason"] is None) for r in got.collect()}
    assert rows == {("a", None): (None, None, False), ("b", 0): (1.0, 2.0, True), ("b", 1): (9.0, 9.5, True), ("c", None): (None, None, False)}
    assert {r["g"]: r["bin"] for r in binning.predict_bin(spark.createDataFrame([("a", 1.0), ("b", 8.0)], "g string, v double"), got, ["g"], "v").collect()} == {"a": None, "b": 1}
    assert binning.bin_edges(got, ["g"]).count() == 3


def test_ipv6_lookup(spark):
    texts = ["2001:db8::1", "2001:db8:0:1::", "2001:DB8:1:2:3:4:5:6", "::1", "::", "fe80::7%eth0", "2a00:1450::8888", "1.2.3.4", "2001:db8", ":::", "1:2:3:4:5:6:7:8:9", "1::2::3", "12345::", None, "2001:db9::1", "2002::5"]
    for t, r in zip(texts, spark.createDataFrame([(t,) for t in texts], "t string").select(ex.ipv6_hex(F.col("t")).alias("x")).collect(), strict=True):
        try:
            want = f"{int(ipaddress.IPv6Address((t or '').split('%')[0])):032x}"
        except ValueError:
            want = None
        assert r["x"] == want, t
    nets = [("2001:db8::/32", "AA"), ("2001:db8:0:1::/64", "BB"), ("2001::/20", "CC"), ("2a00::/12", "DD"), ("2a00:1450::/32", "EE"), ("2001:db8::/48", "FF")]
    nets = [(ipaddress.ip_network(n), c) for n, c in nets]
    table = spark.createDataFrame([(str(n[0]), str(n[-1]), c, 7, "Org") for n, c in nets], "start_ip string, end_ip string, iso string, asn long, org string")
    flows = spark.createDataFrame([(i, t, "8.8.8.8") for i, t in enumerate(texts)], "i int, saddr string, daddr string")
    four = spark.createDataFrame([(0, 2**32 - 1, "XX", 9, "All")], "start_ip long, end_ip long, iso string, asn long, org string")
    got = {r["i"]: r for r in enrich.with_asn(enrich.with_country(flows, four, table), four, table).collect()}
    for i, t in enumerate(texts):
        try:
            a = ipaddress.ip_address((t or "").split("%")[0])
            hit = [x for x in nets if a.version == 6 and a in x[0]]
            want = "xx" if a.version == 4 else max(hit, key=lambda x: x[0].prefixlen)[1].lower() if hit else "na"
        except ValueError:
            want = "na"
        assert got[i]["scountry"] == want, t
        assert got[i]["dcountry"] == "xx" and got[i]["sasn"] == {"xx": 9, "na": 0}.get(want, 7)


def test_numbers_beyond_32_bits_are_in_no_network(spark, sf_dir):
    low = 11 << 24
    raw = fixtures.raw_flows(spark, sf_dir).limit(1).drop("record", "sourceIPv4Address", "destinationIPv4Address", "protocolIdentifier")
    ends = spark.createDataFrame([(0, low, low + 5), (1, (1 << 32) + low, low), (2, low, (7 << 32) + low), (3, (1 << 32) + (10 << 24), low)], "record long, sourceIPv4Address long, destinationIPv4Address long")
    flows = normalize.normalize(raw.crossJoin(ends).withColumn("protocolIdentifier", F.lit(6)))
    nets = spark.createDataFrame([(low, low + 9, "XX", 9, "All")], "start_ip long, end_ip long, iso string, asn long, org string")
    looked = enrich.with_asn(enrich.with_country(flows, nets), nets)
    got = {r["record"]: (r["scountry"], r["dcountry"], r["sasn"], r["dasn"], r["sasnorg"], r["dasnorg"]) for r in looked.collect()}
    none = ("na", 0, "na")
    assert got[0] == ("xx", "xx", 9, 9, "all", "all")
    assert (got[1][0], got[1][2], got[1][4]) == none and got[1][1] == "xx"
    assert (got[2][1], got[2][3], got[2][5]) == none and got[2][0] == "xx"
    assert (got[3][0], got[3][2], got[3][4]) == ("private", 64512, "private")  # by its text, as before
    # a text put in the place of the record's own counts
    assert enrich.with_country(flows.where("record = 1").withColumn("saddr", F.lit("11.0.0.3")), nets).first()["scountry"] == "xx"


def test_swept_networks_against_all(spark):
    rng = random.Random(4)
    for _ in range(100):
        nets = [(a, a + rng.choice([0, 1, 5, 40])) for a in (rng.randint(0, 60) for _ in range(rng.randint(0, 9)))]
        cut = enrich.sweep([a for a, _ in nets], [b for _, b in nets])
        assert [a for a, _ in cut] == sorted({a for a, _ in cut})
        for x in range(-1, 110):
            got = next((i for a, i in reversed(cut) if a <= x), None)
            want = min(((b - a, a, i) for i, (a, b) in enumerate(nets) if a <= x <= b), default=(0, 0, None))[2]
            assert got == want
        base = 7 << 16
        cut = [(base + a, i) for a, i in cut]
        shift, parts = enrich.slots(cut, base, 1)
        for x in range(0, 300):
            part = parts[x >> shift]
            assert next((i for a, i in reversed(part) if a <= base + x), None) == next((i for a, i in reversed(cut) if a <= base + x), None)
    base = 10 * 65536
    nets = [(base + a, base + a + rng.choice([0, 3, 255, 70_000]), f"n{i}") for i, a in enumerate(rng.randint(0, 66_000) for _ in range(300))]
    table = spark.createDataFrame(nets, "start_ip long, end_ip long, iso string")
    asked = spark.createDataFrame([(None,), (0,)] + [(base + rng.randint(-10, 140_000),) for _ in range(500)], "ip long")
    for r in enrich.lookup_network(asked, enrich.network_index(table, "iso"), F.col("ip"), {"iso": "iso"}).collect():
        hit = [(b - a, a, n) for a, b, n in nets if r["ip"] is not None and a <= r["ip"] <= b]
        assert (r["iso"] is None) == (not hit) and (not hit or next(b - a for a, b, n in nets if n == r["iso"]) == min(hit)[0])


def test_predict_and_edges(spark):
    bins = spark.createDataFrame([("g", 0, 1.0, 3.0), ("g", 1, 10.0, 12.0)], "g string, bin int, low double, high double")
    df = spark.createDataFrame([("g", v) for v in (2.0, 11.0, 0.0, 6.0, 7.0, 6.5, 99.0)], "g string, v double")
    assert {r["v"]: r["bin"] for r in binning.predict_bin(df, bins, ["g"], "v").collect()} == {2.0: 0, 11.0: 1, 0.0: 0, 6.0: 0, 7.0: 1, 6.5: 0, 99.0: 1}
    edges = lambda whole: [r["edge"] for r in binning.bin_edges(bins, ["g"], whole).orderBy("position").collect()]
    assert edges(False) == [1.0, 6.5, 12.0] and edges(True) == [1.0, 6.0, 12.0]


# ---------------------------------------------------------------- models


def test_model_properties(spark, flows, tmp_path):
    m = model.build(flows)
    counted = m.histogram.groupBy("observe", "vlan", "proto", "name").agg(F.sum("value").alias("n")).join(m.summary, ["observe", "vlan", "proto", "name"])
    assert counted.where("n <> count").count() == 0 and counted.count() == m.summary.count()
    p = score.probabilities(flows, m, histogram.DEFAULT_FEATURES)
    assert p.where(" OR ".join(f"NOT (_p_{f} > 0 AND _p_{f} <= 1)" for f in histogram.DEFAULT_FEATURES)).count() == 0
    a = score.score(flows, m, histogram.DEFAULT_FEATURES).select("id", "hbos_score")
    b = score.score(flows.orderBy(F.desc("id")).repartition(7), m, histogram.DEFAULT_FEATURES).select("id", F.col("hbos_score").alias("other"))
    assert a.join(b, "id").where("abs(hbos_score - other) > 1e-9").count() == 0
    assert score.score_flows(flows, None, histogram.DEFAULT_FEATURES) is flows
    with pytest.raises(ValueError):
        histogram.checked_features(["daddr", "reason"])

    root = str(tmp_path / "model")
    assert model.latest_version(spark, root) is None and model.read_model(spark, root) is None
    model.write_model(m, root, "2024-01-01")
    model.write_model(m, root, "2024-01-02")
    os.makedirs(f"{root}/version=2024-01-03")  # not finished
    assert model.latest_version(spark, root) == "2024-01-02"
    assert model.read_model(spark, root).histogram.count() == m.histogram.count()


def test_build_policy(flows):
    day = dt.date(2024, 2, 1)
    assert model.build_due(flows, None, day) and model.build_due(flows, day - dt.timedelta(1), day)
    assert not model.build_due(flows, day, day) and model.build_due(flows, day, day, once=True)
    assert not model.build_due(flows.where("date(stime) = '2024-01-05'"), None, day)


def test_without_a_model_for_the_group(flows):
    m = model.build(flows.where("observe = 'napa'"))
    got = score.score_flows(flows, m, histogram.DEFAULT_FEATURES)
    assert got.where("observe <> 'napa' AND (hbos_score <> 0 OR hbos_severity <> 0 OR hbos_map IS NOT NULL)").count() == 0
    assert got.where("observe = 'napa' AND hbos_score > 0").count() > 0


def test_percentiles_are_exact_at_every_size(spark):
    big = spark.range(5_000_001).selectExpr("'a' AS observe", "0 AS dvlan", "'tcp' AS proto", "CAST(id DIV 5000 AS DOUBLE) AS hbos_score")
    few = spark.createDataFrame([("b", 0, "udp", x) for x in (1.0, 2.0, 4.0, 4.0, 4.0, 9.0)] + [("c", 0, "udp", 3.0)], "observe string, dvlan int, proto string, hbos_score double")
    got = {r["observe"]: (r["median"], r["quantile"], r["mad"]) for r in model.score_summary(big.unionByName(few).withColumn("_modelled", F.lit(True))).collect()}
    near = lambda x, y: all(math.isclose(a, b, rel_tol=1e-12) for a, b in zip(x, y, strict=True))
    assert near(got["a"], (500, 999, 250))
    assert near(got["b"], (4, 4 + 5 * (5 * 0.99999 - 4), 1)) and near(got["c"], (3, 3, 0))


def test_percentiles_of_odd_counts(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(f"g{i}", float(v)) for i in range(12) for v in rng.integers(0, 8, int(rng.integers(1, 60))) / 7]
    monkeypatch.setattr(model, "RANGE_ROWS", 7)
    df = spark.createDataFrame(rows, "g string, v double")
    got = model._percentiles(df.groupBy("g", "v").agg(F.count("*").alias("c")), ["g"], {"a": 0.5, "b": 0.99999, "c": 0.0, "d": 1.0}).collect()
    assert len(got) == 12
    for r in got:
        assert np.allclose(r[1:], np.quantile([v for g, v in rows if g == r["g"]], [0.5, 0.99999, 0.0, 1.0]), rtol=1e-12)


def test_percentiles_in_narrowing_brackets(spark, monkeypatch):
    monkeypatch.setattr(model, "RANGE_ROWS", 5)
    monkeypatch.setattr(model, "BINS", 4)
    rng = np.random.default_rng(3)
    # an outlier, a value that most rows hold, tiny differences
    values = {"far": [*rng.normal(size=200).tolist(), 1e300], "most": [2.5] * 300 + rng.normal(size=40).tolist(), "near": (1 + np.arange(150) * 1e-15).tolist(), "one": [7.0]}
    df = spark.createDataFrame([(g, float(v), 1) for g, vs in values.items() for v in vs], "g string, v double, c long")
    for r in model._percentiles(df, ["g"], {"a": 0.5, "b": 0.99999, "c": 0.01}).collect():
        assert np.allclose(r[1:], np.quantile(values[r["g"]], [0.5, 0.99999, 0.01]), rtol=1e-12)


def test_one_join_finds_every_count(spark, flows, capsys):
    features = tuple(f for f in histogram.DEFAULT_FEATURES if histogram.FEATURES[f][0] != histogram.NUMERICAL)
    m = model.build(flows, features)
    scored = score.score(flows, m, features)
    scored.explain()
    plan = capsys.readouterr().out
    assert plan.count("Join") == 1 and "BroadcastHashJoin" in plan
    counts = {(r["observe"], r["vlan"], r["proto"], r["name"], r["key"]): r["value"] for r in m.histogram.collect()}
    total = {}
    for k, v in counts.items():
        total[k[:4]] = total.get(k[:4], 0) + v
    keys = flows.select("id", "observe", "dvlan", "proto", *[histogram.key_of(f).alias(f) for f in features]).collect()
    got = {r["id"]: r for r in score.probabilities(flows, m, features, every_row=True).collect()}
    for r in keys:
        if got[r["id"]]["_modelled"]:
            for f in features:
                k = (r["observe"], r["dvlan"], r["proto"], f)
                assert got[r["id"]][f"_p_{f}"] == pytest.approx((counts.get((*k, r[f]), 0) + 1) / (total.get(k, 0) + 1))


def test_flows_carry_no_large_histogram(spark, flows, monkeypatch):
    m = model.build(flows)
    named = [f"_p_{f}" for f in histogram.DEFAULT_FEATURES]
    rows = lambda: {r["id"]: r for r in score.score(flows, m, histogram.DEFAULT_FEATURES).select("id", "_modelled", "hbos_score", *named).collect()}
    want = rows()
    monkeypatch.setattr(score, "PACKED_KEYS", 1)
    out = score.probabilities(flows, m, histogram.DEFAULT_FEATURES)
    assert "_h_" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert rows() == want and len(want) == flows.count()


def test_large_models_are_joined_by_one_shuffle(spark, flows, monkeypatch):
    m = model.build(flows)
    want = {r["id"]: r["hbos_score"] for r in score.score(flows, m, histogram.DEFAULT_FEATURES).select("id", "hbos_score").collect()}
    monkeypatch.setattr(score, "fits", lambda df: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert {r["id"]: r["hbos_score"] for r in score.score(flows, m, histogram.DEFAULT_FEATURES).select("id", "hbos_score").collect()} == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_models_from_days(spark, flows):
    features = ("sbytes", "dport", "daddr", "stime")
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    days = [model.day_values(flows.where(c), features) for c in ("sport % 2 = 0", "sport % 2 = 1 AND day(stime) < 9", "sport % 2 = 1 AND day(stime) >= 9")]
    table = kept(select.merge(days), "test-days")
    for since in (None, "2024-01-10"):
        some = flows.where(F.to_date("stime") >= since) if since else flows
        want = model.build(some, features)
        got = model.from_days(table, features, since)
        assert rows(got.histogram) == rows(want.histogram.select(*got.histogram.columns))
        assert rows(got.summary) == rows(want.summary.select(*got.summary.columns))


@pytest.mark.parametrize("group", [[], ["g"]])
def test_ranks_over_many_ranges(spark, monkeypatch, group):
    monkeypatch.setattr(binning, "RANGE_VALUES", 7)
    rng = np.random.default_rng(6)
    rows = [(f"g{i % 3}", int(v)) for i, v in enumerate(rng.integers(0, 90, 700))] + [("g9", 4)]
    df = spark.createDataFrame(rows, "g string, v long")
    by = {}
    for g, v in rows:
        by.setdefault((g,) if group else (), []).append(v)
    got = {}
    for r in binning._ranks(df, group, "v").collect():
        got.setdefault(tuple(r[c] for c in group), {})[r["v"]] = (r["_from"], r["_to"], r["_next"], r["n"])
    assert got.keys() == by.keys()
    for k, vs in by.items():
        vs = sorted(vs)
        uniq = sorted(set(vs))
        assert got[k] == {v: (vs.index(v), len(vs) - 1 - vs[::-1].index(v), dict(zip(uniq, [*uniq[1:], None], strict=True))[v], len(vs)) for v in uniq}
    edges = binning.equal_frequency(df, group, "v", 6)
    counts = binning.bin_counts(df, kept(edges, "test-edges"), group, "v")
    assert counts.agg(F.sum("count")).first()[0] == len(rows)


# ---------------------------------------------------------------- samples


def test_sample(flows):
    got = sample.sample_strata(flows, F.lit(fixtures.AS_OF).cast("timestamp_ntz"), percent=50, days=40)
    n, base = got.count(), select.baseline_rows(flows).count()
    assert 0.4 < n / base < 0.6 and got.where("hbos_severity >= 4").count() == 0
    for interval in ("second", "minute"):
        with pytest.raises(ValueError):
            sample.check_interval(interval)
    sample.check_interval("hour")


# ---------------------------------------------------------------- files


def test_sources(spark, full, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    assert sinks.write_parquet(full.limit(10), a) and sinks.write_parquet(full.limit(5), b)
    assert not sinks.write_parquet(full.limit(0), str(tmp_path / "none")) and not os.path.exists(tmp_path / "none")
    assert files.read_flows(spark, a, b, a).count() == 15
    assert files.read_flows(spark, a, strict=True).dtypes == full.dtypes
    assert files.read_directories(spark, [{"input": a}, {"input": b}, {"input": a}]).count() == 15
    (tmp_path / "rules.json").write_text(json.dumps([{"action": "ignore"}]))
    (tmp_path / "lines.json").write_text('{"tag": "a"}\n{"tag": "b"}\n')
    assert files.read_list(spark, str(tmp_path / "rules.json")) == [{"action": "ignore"}]
    assert files.read_list(spark, str(tmp_path / "lines.json")) == [{"tag": "a"}, {"tag": "b"}]
    assert [one(spark, files.observation_of(F.lit(p))) for p in ("/x/napa-2024.yaf", "/a-b/plain", "x-y-z")] == ["napa", None, "x"]


def test_raw_records_and_tables(spark, full, sf_dir, tmp_path):
    raw = fixtures.raw_flows(spark, sf_dir).limit(20)
    raw.drop("sourceMacAddress", "destinationMacAddress").write.json(str(tmp_path / "raw.json"))
    raw.write.parquet(str(tmp_path / "napa-1.parquet"))
    assert files.read_raw(spark, str(tmp_path / "raw.json")).count() == files.read_raw(spark, str(tmp_path / "napa-1.parquet"), raw.schema).count() == 20
    full.limit(3).coalesce(1).write.parquet(str(tmp_path / "plain"))
    assert {r["observation"] for r in files.with_observation(spark.read.parquet(str(tmp_path / "plain")), "here").select("observation").collect()} == {"part"}
    sinks.append_table(full.limit(7), "tidemark_appended")
    sinks.append_table(full.limit(7), "tidemark_appended", "trigger")
    assert spark.table("tidemark_appended").count() == 7 + full.limit(7).where("trigger > 0").count()


def test_bench_names():
    import bench

    names = bench.headline(["op10_x", "optimal_bins", "op2_y", "metrics_all", "pipeline", "other"])
    assert names == ["metrics_all", "op2_y", "op10_x", "pipeline"]


def test_exports_and_stores(spark, full, tmp_path):
    path = lambda n: str(tmp_path / n)
    sinks.export(full, path("csv"), "csv", "id,proto,tag,hbos_map", "trigger")
    assert spark.read.option("header", True).csv(path("csv")).count() == full.where("trigger > 0").count()
    sinks.export(full, path("odd"), "unheard-of", "id,proto")
    assert spark.read.json(path("odd")).count() == full.count()
    sinks.store(full, path("store"))
    got = files.read_store(spark, path("store"), month=1, day=5)
    assert got.count() == full.where("date(stime) = '2024-01-05'").count() > 0
    assert "PartitionFilters: [isnotnull(month" in got._jdf.queryExecution().executedPlan().toString()
    m = metrics.metrics_all(full)
    sinks.store_metrics(m, path("metrics"))
    sinks.store_metrics(m.where("day(bucket) = 5"), path("metrics"))
    assert spark.read.parquet(path("metrics")).count() == m.count()
    as_of = F.lit(fixtures.AS_OF).cast("timestamp_ntz")
    sinks.roll_cache(full, path("cache"), as_of)
    young = os.path.join(path("cache"), "year=2024", "month=1", "day=28")
    before = sorted(os.listdir(young))
    sinks.roll_cache(full.limit(0), path("cache"), as_of - F.expr("INTERVAL 5 HOURS"), 11)
    assert spark.read.parquet(path("cache")).count() == select.not_older(full, as_of - F.expr("INTERVAL 5 HOURS"), 11).count()
    assert sorted(os.listdir(young)) == before  # days that keep all their rows stay as they are
    sinks.roll_cache(full.limit(0), path("cache"), as_of, 10)
    assert spark.read.parquet(path("cache")).count() == select.not_older(full, as_of, 10).count() < full.count()
    sinks.write_parquet(full, path("sample"))
    sinks.compact_sample(spark, path("sample"), as_of, 7)
    assert spark.read.parquet(path("sample")).count() == select.recent_days(full, as_of, 7).count()
    written = lambda: len([f for f in os.listdir(path("sample")) if f.endswith(".parquet")])
    assert written() == 1
    sinks.compact_sample(spark, path("sample"), as_of, 7, file_rows=50)
    rows = select.recent_days(full, as_of, 7).count()
    assert spark.read.parquet(path("sample")).count() == rows and written() == -(-rows // 50)


def test_import_chain(spark, sf_dir):
    raw, nets = fixtures.raw_flows(spark, sf_dir), fixtures.networks(spark, sf_dir)
    out = flow_pipeline.import_flows(raw, nets, nets, fixtures.apps(spark, sf_dir), {0: 10})
    assert set(schema.FLOW_NAMES) - set(out.columns) == set()
    doubled = kept(flow_pipeline.import_flows(raw.union(raw), nets, nets, fixtures.apps(spark, sf_dir), {0: 10}).select("id"), "test-ids")
    assert doubled.distinct().count() == doubled.count() == 2 * out.count()


# ---------------------------------------------------------------- streams


def run(query):
    query.awaitTermination(120)
    assert query.exception() is None


def test_streams(spark, full, tmp_path):
    path = lambda n: str(tmp_path / n)
    for day in (3, 4, 5):
        full.where(f"day(stime) = {day}").coalesce(1).write.mode("append").parquet(path("in"))
    batch = full.where("day(stime) IN (3, 4, 5)")
    source = files.stream_flows(spark, path("in"), files=1)
    run(stages.start(source, stages.partial_metrics(path("partial"), path("refused")), path("cp1")))
    again = ["bucket", "observe", "name", "key"]
    total = lambda df: {tuple(r[:4]): r[4] for r in df.groupBy(*again).agg(F.sum("value")).collect()}
    want = total(metrics.metrics_all(batch))
    assert total(spark.read.parquet(path("partial"))) == want

    windowed = stages.windowed_metrics(files.stream_flows(spark, path("in")), "30 days")
    run(windowed.writeStream.outputMode("append").format("parquet").option("path", path("windows")).option("checkpointLocation", path("cp2")).trigger(availableNow=True).start())
    got = total(spark.read.schema(schema.METRIC_COLUMNS).parquet(path("windows")))
    assert all(want[k] == v for k, v in got.items())  # minutes that the watermark has passed

    run(stages.start(source, stages.split_batches([{"proto": "tcp", "path": path("tcp")}, {"proto": "sctp", "path": path("sctp")}], path("refused")), path("cp3")))
    assert spark.read.parquet(path("tcp")).count() == batch.where("proto = 'tcp'").count() and not os.path.exists(path("sctp"))

    m = model.build(full)
    model.write_model(m, path("model"), "1")
    scored = stages.with_latest_model(path("model"), lambda b, mm: score.score_flows(b, mm, histogram.DEFAULT_FEATURES))
    run(stages.start(source, stages.staged(scored, path("scored"), path("refused")), path("cp4")))
    one_batch = score.score_flows(batch, m, histogram.DEFAULT_FEATURES)
    pick = lambda df: {r["id"]: (round(r["hbos_score"], 6), r["hbos_severity"]) for r in df.collect()}
    assert pick(spark.read.parquet(path("scored"))) == pick(one_batch) and not os.path.exists(path("refused"))


def test_rejected_batches(spark, full, tmp_path):
    path = lambda n: str(tmp_path / n)
    full.limit(4).withColumn("stream", F.col("sport") % 2 + F.monotonically_increasing_id()).coalesce(1).write.parquet(path("in"))
    for i, work in enumerate((lambda r: stages.staged(lambda b: b, path("out"), r), lambda r: stages.partial_metrics(path("out"), r), lambda r: stages.split_batches([{"proto": "tcp", "path": path("out")}, {"proto": "udp", "path": path("out")}], r))):
        run(stages.start(files.stream_flows(spark, path("in")), work(path(f"rejected{i}")), path(f"cp{i}")))
        assert spark.read.parquet(path(f"rejected{i}")).count() == 4 and not os.path.exists(path("out"))


def ledger_total(df):
    return {tuple(r[:4]): r[4] for r in df.groupBy("bucket", "observe", "name", "key").agg(F.sum("value")).collect() if r[4]}


def write_files(df, folder, *conditions):
    for c in conditions:
        df.where(c).coalesce(1).write.mode("append").parquet(folder)


def drain(query):
    query.awaitTermination()
    assert query.exception() is None


def test_repeated_batches_and_new_checkpoints_add_nothing(spark, full, tmp_path):
    path = lambda n: str(tmp_path / n)
    ids = lambda p: sorted(r["id"] for r in spark.read.parquet(p).select("id").collect())
    write_files(full, path("in"), "day(stime) = 3", "day(stime) = 4")
    work = stages.staged(lambda b: b, path("one"), path("bad"))
    source = files.stream_flows(spark, path("in"), files=1)
    drain(stages.start(source, work, path("cp1")))
    want = ids(path("in"))
    assert ids(path("one")) == want
    drain(stages.start(source, work, path("cp2")))  # a new checkpoint starts at batch 0 again
    assert ids(path("one")) == want
    two = stages.staged(lambda b: b.withColumn("trigger", F.lit(1)), path("two"), path("bad"))
    drain(stages.start(files.stream_flows(spark, path("one"), files=1), two, path("cp3")))
    assert ids(path("two")) == want
    batch = spark.read.parquet(path("in")).where("day(stime) = 3").limit(5)
    for _ in range(2):
        stages.staged(lambda b: b, path("three"), path("bad"))(batch, 7)
    assert len(ids(path("three"))) == 5
    write_files(full, path("in"), "day(stime) = 5")
    drain(stages.start(source, work, path("cp2")))
    drain(stages.start(files.stream_flows(spark, path("one"), files=1), two, path("cp3")))
    assert ids(path("two")) == ids(path("in")) and len(ids(path("in"))) > len(want)


@pytest.mark.parametrize("broken_at", ["_enter", "_move"])
def test_a_crash_around_the_entry(spark, full, tmp_path, monkeypatch, broken_at):
    path, batch = str(tmp_path / "out"), kept(full.limit(5), "test-crash")
    real = getattr(ledger.Ledger, broken_at)

    def crash(self, *args):
        raise OSError("cut off")

    monkeypatch.setattr(ledger.Ledger, broken_at, crash)
    work = stages.staged(lambda b: b, path, str(tmp_path / "bad"))
    with pytest.raises(OSError, match="cut off"):
        work(batch, 0)
    assert ledger.Ledger(spark, path).published() == []
    monkeypatch.setattr(ledger.Ledger, broken_at, real)
    work(batch, 0)
    work(batch, 0)
    assert spark.read.parquet(path).count() == 5 and ledger.Ledger(spark, path).read().count() == 5


def test_unreadable_files_are_set_aside(spark, full, tmp_path):
    path = lambda n: str(tmp_path / n)
    write_files(full, path("in"), "day(stime) = 3", "day(stime) = 4", "day(stime) = 5")
    with open(path("in/broken.parquet"), "wb") as f:
        f.write(b"PAR1 not a table PAR1")
    read = lambda p: files.read_flows(spark, *p)
    work = stages.staged_files(lambda b: b, read, path("out"), path("bad"), path("broken"))
    for checkpoint in ("cp1", "cp2"):
        drain(stages.start(ledger.file_names(spark, path("in")), work, path(checkpoint)))
    assert spark.read.parquet(path("out")).count() == full.where("day(stime) IN (3, 4, 5)").count()
    listed = spark.read.parquet(path("broken")).collect()
    assert [os.path.basename(r["path"]) for r in listed] == ["broken.parquet"] and listed[0]["error"]
    write_files(full, path("in"), "day(stime) = 6")
    drain(stages.start(ledger.file_names(spark, path("in")), work, path("cp2")))
    assert spark.read.parquet(path("out")).count() == full.where("day(stime) IN (3, 4, 5, 6)").count() and not os.path.exists(path("bad"))


def test_day_state_equals_the_batch_answer(spark, full, tmp_path):
    path = lambda n: str(tmp_path / n)
    work = stages.day_metrics(path("days"), path("bad"))
    # parts of days, out of order, then all again by another checkpoint
    write_files(full, path("in"), "day(stime) = 4 AND sport % 2 = 0", "day(stime) = 5", "day(stime) = 4 AND sport % 2 = 1 OR day(stime) = 3")
    source = files.stream_flows(spark, path("in"), files=1)
    for checkpoint in ("cp1", "cp1", "cp2"):
        drain(stages.start(source, work, path(checkpoint)))
    whole = full.where("day(stime) IN (3, 4, 5)")
    assert ledger_total(stages.read_day_metrics(spark, path("days"))) == ledger_total(metrics.metrics_all(whole))
    got = stages.read_day_metrics(spark, path("days"))
    assert got.count() == metrics.metrics_all(whole).count()  # one row for each key, as in one batch
    five = next(d for d in stages._versions(ledger.Ledger(spark, path("days"))) if d.endswith("05"))
    entry = stages._versions(ledger.Ledger(spark, path("days")))[five]
    write_files(full, path("in"), "day(stime) = 4 AND sport % 1000 = 7")
    drain(stages.start(source, work, path("cp2")))
    assert stages._versions(ledger.Ledger(spark, path("days")))[five] == entry  # an untouched day is not written again
    assert stages.expire_days(spark, path("days"), five) >= 1
    assert ledger_total(stages.read_day_metrics(spark, path("days"))) == ledger_total(metrics.metrics_all(full.where("day(stime) = 5")))


def test_a_chain_of_stages_equals_one_batch(spark, full, tmp_path):
    path = lambda n: str(tmp_path / n)
    tags = [tag.TagRule("dns", ndpi_appid="dns"), tag.TagRule("web", dport=443)]
    rules = [rule.Rule("trigger", tag="dns"), rule.Rule("ignore", daddr="192.168.")]
    chain = [("tag", lambda b: tag.apply_tags(b, tags)), ("rule", lambda b: rule.apply_rules(b, rules)), ("plain", lambda b: b)]
    write_files(full, path("in"), "day(stime) = 3", "day(stime) = 4")
    pick = lambda df: {r["id"]: (r["tag"] and tuple(r["tag"]), r["trigger"]) for r in df.select("id", "tag", "trigger").collect()}
    for days in ("3, 4", "3, 4, 5"):
        for _ in range(2):
            for q in stages.start_chain(spark, path("in"), chain, path("out"), files=1):
                assert q.exception() is None
        whole = full.where(f"day(stime) IN ({days})")
        got = ledger.Ledger(spark, path("out/plain")).read()
        assert got.count() == whole.count() and pick(got) == pick(rule.apply_rules(tag.apply_tags(whole, tags), rules))
        if days == "3, 4":
            write_files(full, path("in"), "day(stime) = 5")
            with open(path("in/broken.parquet"), "wb") as f:
                f.write(b"PAR1 broken PAR1")
    assert spark.read.parquet(path("out/tag.unreadable")).count() == 1 and not os.path.exists(path("out/rule.unreadable"))


def test_windows_and_late_rows_add_up(spark, full, tmp_path):
    path = lambda n: str(tmp_path / n)
    work = stages.late_metrics(path("m"), path("bad"), "1 hour")
    parts = [full.where("day(stime) = 3"), full.where("day(stime) = 5"), full.where("day(stime) = 4"), full.where("day(stime) = 6")]
    for i, p in enumerate(parts):
        write_files(p, path(f"in{i}"), "true")
        work(spark.read.parquet(path(f"in{i}")), i)
        work(spark.read.parquet(path(f"in{i}")), i)
    read = lambda f: spark.read.parquet(path(f"m/{f}"))
    every = read("windows").unionByName(read("late")).unionByName(read("open"))
    assert ledger_total(every) == ledger_total(metrics.metrics_all(full.where("day(stime) IN (3, 4, 5, 6)")))
    assert {r["d"] for r in read("late").selectExpr("day(bucket) AS d").distinct().collect()} == {4}
    keys = ["bucket", "observe", "name", "beside", "key"]
    assert read("windows").count() == read("windows").select(*keys).distinct().count()  # a minute is final once
    assert read("open").agg(F.min("bucket")).first()[0] > read("windows").agg(F.max("bucket")).first()[0]


def test_triggers():
    assert stages.trigger_of("once") == {"availableNow": True} and stages.trigger_of("hour") == {"processingTime": "1 hour"}
    assert stages.trigger_of("fortnight") == stages.trigger_of("second")
