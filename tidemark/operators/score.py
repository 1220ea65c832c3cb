"""Scoring flows against a model, without shuffling them while the model can be broadcast."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.enrich import risk_names
from tidemark.operators.histogram import FEATURES, MODEL_PROTOCOLS, NUMERICAL, key_of, with_steps
from tidemark.operators.select import handshake
from tidemark.shared import fits, kept, small

LEVELS = (("severe", 4), ("high", 3), ("medium", 2), ("low", 1))


def _groups(summary: DataFrame, features: tuple[str, ...]) -> DataFrame:
    """A row for each group: counts of all features, ranges of the numerical ones."""
    pick = lambda f, c: F.max(F.when(F.col("name") == f, F.col(c)))
    columns = [pick(f, "count").alias(f"_n_{f}") for f in features]
    columns += [pick(f, c).alias(f"_{a}_{f}") for f in features if FEATURES[f][0] == NUMERICAL for a, c in (("lo", "low"), ("hi", "high"))]
    return with_steps(summary.groupBy("observe", F.col("vlan").alias("dvlan"), "proto").agg(F.lit(True).alias("_model"), *columns), features)


#: Keys of a histogram in one bucket of its packed form, about.
BUCKET_KEYS = 4
#: Keys of a group up to which its packed row is joined by broadcast: a join may copy the whole row for every flow.
PACKED_KEYS = 500


def packed(model, features: tuple[str, ...]) -> DataFrame:
    """One row a group: ``_groups`` with each feature's counts (``_h_x``) as a list of small maps, a key standing in the one that its hash picks.

    A key is found in few steps whatever the histogram's size, by plain column functions.
    """
    g = ["observe", "vlan", "proto"]
    rows = model.histogram.where(F.col("name").isin(*features)).select(*g, "name", "key", "value")
    bits = F.length(F.bin(F.floor((F.count("*") - 1) / BUCKET_KEYS)))  # one bit at least
    size = rows.groupBy(*g, "name").agg(F.pow(F.lit(2), bits).cast("int").alias("_size"))
    held = rows.join(size, [*g, "name"]).select(*g, "name", F.pmod(F.xxhash64("key"), F.col("_size")).cast("int").alias("_at"), F.struct("key", "value").alias("_entry"))
    every = size.select(*g, "name", F.explode(F.sequence(F.lit(0), F.col("_size") - 1)).alias("_at"), F.lit(None).cast(held.schema["_entry"].dataType).alias("_entry"))
    buckets = held.unionByName(every).groupBy(*g, "name", "_at").agg(F.collect_list("_entry").alias("_entries"))
    lists = buckets.groupBy(*g, "name").agg(F.sort_array(F.collect_list(F.struct("_at", "_entries"))).alias("_all"))
    lists = lists.select(*g, "name", F.transform("_all", lambda b: F.map_from_entries(b["_entries"])).alias("_h"))
    wide = lists.groupBy(*g).agg(*[F.first(F.when(F.col("name") == f, F.col("_h")), ignorenulls=True).alias(f"_h_{f}") for f in features])
    return _groups(model.summary, features).join(wide.withColumnRenamed("vlan", "dvlan"), ["observe", "dvlan", "proto"], "left")


def _largest_group(model) -> int:
    """Keys of all features in the group that has most."""
    return model.histogram.groupBy("observe", "vlan", "proto").count().agg(F.max("count")).first()[0] or 0


def probabilities(flows: DataFrame, model, features: tuple[str, ...], every_row: bool = False) -> DataFrame:
    """``flows`` with ``_modelled`` and ``_p_x`` for each feature: (count of its key + 1) / (all + 1).

    Rows of groups without a model, and tcp rows without a handshake unless ``every_row``, have ``_modelled`` false.
    One join with the packed model, by broadcast while no group has more than PACKED_KEYS keys. With larger groups a flow meets its group's row and the
    row of each of its keys by broadcast joins, so it carries numbers only. A model that cannot be broadcast is packed and joined by one shuffle of the
    flows, whose busy groups adaptive execution splits.
    """
    g = ["observe", "dvlan", "proto"]
    may = F.col("_model").isNotNull() & F.col("proto").isin(*MODEL_PROTOCOLS)
    modelled = may if every_row else may & handshake()
    broadcast = fits(model.histogram)
    if broadcast and _largest_group(model) > PACKED_KEYS:
        out = flows.join(F.broadcast(kept(_groups(model.summary, features), "model-groups")), g, "left").withColumn("_modelled", modelled)
        for f in features:
            table = model.histogram.where(F.col("name") == f).select("observe", F.col("vlan").alias("dvlan"), "proto", F.col("key").alias("_key"), F.col("value").alias(f"_c_{f}"))
            out = out.withColumn("_key", key_of(f)).join(F.broadcast(table), [*g, "_key"], "left").drop("_key")
        count = lambda f: F.col(f"_c_{f}")
    else:
        groups = kept(packed(model, features), "model-packed")
        out = flows.join(F.broadcast(groups) if broadcast else groups, g, "left").withColumn("_modelled", modelled)

        def count(f: str) -> Column:
            buckets, key = F.col(f"_h_{f}"), key_of(f)
            return F.element_at(F.get(buckets, F.pmod(F.xxhash64(key), F.size(buckets)).cast("int")), key)

    zero = F.lit(0).cast("long")
    return out.select(*flows.columns, "_modelled", *[((F.coalesce(count(f), zero) + 1) / (F.coalesce(f"_n_{f}", zero) + 1)).alias(f"_p_{f}") for f in features])


def score(flows: DataFrame, model, features: tuple[str, ...], every_row: bool = False) -> DataFrame:
    """``hbos_score``: the sum of log10(1/p) over the features; rows without a model keep 0."""
    out = probabilities(flows, model, features, every_row)
    total = reduce(lambda a, b: a + b, [F.log10(F.lit(1.0) / F.col(f"_p_{f}")) for f in features])
    return out.withColumn("hbos_score", F.when(F.col("_modelled"), total).otherwise(F.lit(0.0)))


def severity(flows: DataFrame, thresholds: DataFrame) -> DataFrame:
    """``hbos_severity`` 0 to 4 by the thresholds of the group."""
    t = thresholds.select("observe", F.col("vlan").alias("dvlan"), "proto", *[F.col(n).alias(f"_t_{n}") for n, _ in LEVELS])
    out = flows.join(small(t), ["observe", "dvlan", "proto"], "left")
    level = F.lit(0)
    for name, value in reversed(LEVELS):
        level = F.when(F.col("hbos_score") >= F.col(f"_t_{name}"), F.lit(value)).otherwise(level)
    return out.withColumn("hbos_severity", F.when(F.col("_modelled"), level).otherwise(F.lit(0)).cast("int")).select(*flows.columns)


def explanation(features: tuple[str, ...]) -> Column:
    """Feature to its probability to three places."""
    return F.map_from_entries(F.array(*[F.struct(F.lit(f), F.round(f"_p_{f}", 3)) for f in features]))


def score_flows(flows: DataFrame, model, features: tuple[str, ...]) -> DataFrame:
    """Score, severity, and for severe or risky rows the explanation map and the names of their risks.

    Without a model (None) the rows come back unchanged.
    """
    if model is None:
        return flows
    out = severity(score(flows, model, features), model.thresholds)
    told = F.col("_modelled") & ((F.col("hbos_severity") > 0) | (F.col("ndpi_risk_bits") > 0))
    out = out.withColumns({"hbos_map": F.when(told, explanation(features)), "ndpi_risk_list": F.when(told, risk_names(F.col("ndpi_risk_bits")))})
    return out.drop("_modelled", *[f"_p_{f}" for f in features])


def trigger_details(scored: DataFrame) -> DataFrame:
    """Triggered rows with their risks and explanation."""
    return scored.where("trigger > 0")
