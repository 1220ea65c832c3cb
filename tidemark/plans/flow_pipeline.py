"""The stages as one chain: normalise, enrich, tag, score, trigger, measure."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators import enrich, normalize
from tidemark.operators.histogram import DEFAULT_FEATURES
from tidemark.operators.metrics import metrics_all
from tidemark.operators.rule import Rule, apply_rules
from tidemark.operators.score import score_flows
from tidemark.operators.tag import TagRule, apply_tags


def import_flows(raw: DataFrame, countries: DataFrame, owners: DataFrame, apps: DataFrame, weights: dict[int, int], countries6: DataFrame | None = None, owners6: DataFrame | None = None) -> DataFrame:
    """Raw records to enriched flows, in one plan. Every flow gets an id of its own. The networks of IPv6 are tables of their own."""
    out = normalize.normalize(raw)
    out = enrich.with_asn(enrich.with_country(enrich.with_orientation(out), countries, countries6), owners, owners6)
    out = normalize.with_defaults(enrich.with_risk(enrich.with_application(out, apps), weights))
    return normalize.with_ids(out).drop("sourceIPv4Address", "destinationIPv4Address", "ndpi_master", "ndpi_sub", "ndpi_risk")


def analyse(flows: DataFrame, tags: list[TagRule], rules: list[Rule], model=None, features: tuple[str, ...] = DEFAULT_FEATURES) -> DataFrame:
    """Tag, score and trigger; without a model the scores stay as they are."""
    return apply_rules(score_flows(apply_tags(flows, tags), model, features), rules)


def measure(flows: DataFrame) -> DataFrame:
    return metrics_all(flows)
