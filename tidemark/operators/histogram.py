"""Histograms of flow features by observation point, VLAN and protocol."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expressions import bin_number, network_class, nice_step
from tidemark.operators.select import handshake
from tidemark.schema import GROUP
from tidemark.shared import kept, small

NUMERICAL, NUMERIC, STRING, ADDRESS, TIME = "numerical", "numeric_category", "string_category", "ipaddr_category", "time_category"
#: Feature to (kind of histogram, modulus of its values or 0) (fixed values).
FEATURES = {
    **{f: (NUMERICAL, 0) for f in "dur rtt sbytes dbytes spkts dpkts siat diat ssmallpktcnt dsmallpktcnt slargepktcnt dlargepktcnt sfirstnonemptycnt dfirstnonemptycnt smaxpktsize dmaxpktsize sstdevpayload dstdevpayload".split()},
    "pcr": (NUMERIC, 0), "sport": (NUMERIC, 8192), "dport": (NUMERIC, 8192), "dvlan": (NUMERIC, 1024),
    "sentropy": (NUMERIC, 0), "dentropy": (NUMERIC, 0), "sasn": (NUMERIC, 8192), "dasn": (NUMERIC, 8192),
    **{f: (STRING, 0) for f in "proto iflags uflags scountry dcountry spd ndpi_appid orient".split()},
    "saddr": (ADDRESS, 0), "daddr": (ADDRESS, 0), "stime": (TIME, 0),
}
DEFAULT_FEATURES = ("daddr", "dport", "dentropy", "sentropy", "diat", "siat", "spd", "pcr", "orient", "stime")
MODEL_PROTOCOLS = ("udp", "tcp")
#: Application ids that are not learnt.
UNLEARNT = "unknown"


def checked_features(features) -> tuple[str, ...]:
    if wrong := [f for f in features if f not in FEATURES]:
        raise ValueError(f"no histogram for: {', '.join(wrong)}")
    return tuple(features)


def model_rows(flows: DataFrame, protocols: tuple[str, ...] = MODEL_PROTOCOLS) -> DataFrame:
    """The rows that a model learns from: chosen protocols, tcp only after a handshake."""
    return flows.where(F.col("proto").isin(*protocols) & handshake())


def ranges(rows: DataFrame, features: tuple[str, ...]) -> DataFrame:
    """Least and largest value of each numerical feature, ``_lo_x`` and ``_hi_x``, a row for each group."""
    bounds = [a for f in features if FEATURES[f][0] == NUMERICAL for a in (F.min(f).cast("double").alias(f"_lo_{f}"), F.max(f).cast("double").alias(f"_hi_{f}"))]
    return rows.groupBy(*GROUP).agg(F.count("*").alias("_rows"), *bounds)


def with_steps(bounds: DataFrame, features: tuple[str, ...]) -> DataFrame:
    """``_step_x`` of each numerical feature beside its ``_lo_x`` and ``_hi_x``: worked out once a group, not for each flow."""
    return bounds.withColumns({f"_step_{f}": nice_step(F.col(f"_lo_{f}"), F.col(f"_hi_{f}")) for f in features if FEATURES[f][0] == NUMERICAL})


def key_of(feature: str) -> Column:
    """The key of a flow in a feature's histogram, as text; numerical ones need ``_lo_x`` and ``_step_x`` beside."""
    kind, modulus = FEATURES[feature]
    c = F.col(feature)
    if kind == NUMERICAL:
        step = F.col(f"_step_{feature}")
        return (bin_number(c.cast("double"), F.col(f"_lo_{feature}"), step) * step).cast("long").cast("string")
    if kind == NUMERIC:
        return (F.pmod(c.cast("long"), F.lit(modulus)) if modulus else c.cast("long")).cast("string")
    if kind == ADDRESS:
        return network_class(c).cast("string")
    return F.hour(c).cast("string") if kind == TIME else c


def learnt(feature: str) -> Column:
    return F.col(feature) != UNLEARNT if feature == "ndpi_appid" else F.lit(True)


def keyed(rows: DataFrame, features: tuple[str, ...]) -> DataFrame:
    """observe, vlan, proto, at, key: a row for each flow and feature, ``at`` being the feature's place in ``features``."""
    each = [F.when(learnt(f), F.struct(F.lit(i).alias("at"), key_of(f).alias("key"))) for i, f in enumerate(features)]
    present = F.filter(F.array(*each), lambda x: x.isNotNull())
    out = rows.select("observe", F.col("dvlan").alias("vlan"), "proto", F.explode(present).alias("x"))
    return out.select("observe", "vlan", "proto", "x.*")


def histograms(flows: DataFrame, features: tuple[str, ...] = DEFAULT_FEATURES, protocols: tuple[str, ...] = MODEL_PROTOCOLS, bounds: DataFrame | None = None) -> DataFrame:
    """Counts of all features' keys in one aggregation: observe, vlan, proto, name, kind, key, value. ``bounds``: ``ranges`` of the rows, if they are at hand."""
    features = checked_features(features)
    rows = model_rows(flows, protocols)
    if any(FEATURES[f][0] == NUMERICAL for f in features):
        bounds = kept(ranges(rows, features), "histogram-ranges") if bounds is None else bounds
        rows = rows.join(small(with_steps(bounds, features)), list(GROUP))
    # features are named after they are counted, so that no row of a flow carries their names
    counted = keyed(rows, features).groupBy("observe", "vlan", "proto", "at", "key").agg(F.count("*").alias("value"))
    named = F.array(*[F.struct(F.lit(f).alias("name"), F.lit(FEATURES[f][0]).alias("kind")) for f in features])
    return counted.withColumn("x", F.get(named, "at")).select("observe", "vlan", "proto", "x.name", "x.kind", "key", "value")


def histogram_report(df: DataFrame, column: str, whole: bool = True, bar: int = 40) -> DataFrame:
    """``bin`` (upper boundary), ``count`` and a text bar, for any numeric column."""
    bounds = df.agg(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi"))
    rows = df.select(F.col(column).cast("double").alias("v")).join(F.broadcast(bounds))  # one row
    step = nice_step(F.col("lo"), F.col("hi"), whole)
    out = rows.where("v IS NOT NULL").groupBy(F.round(bin_number(F.col("v"), F.col("lo"), step) * step, 6).alias("bin")).agg(F.count("*").alias("count"))
    most = F.broadcast(out.agg(F.max("count").alias("most")))  # one row
    return out.join(most).select("bin", "count", F.expr(f"repeat('█', CAST(ceil({bar} * count / most) AS INT))").alias("bar"))
