"""Trigger rules: the last one that fits a flow decides."""

from __future__ import annotations

import warnings
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.rule_index import Entry, Shape, matching
from tidemark.operators.tag import load_list

MANY = 1000
ACTIONS = {"trigger": 1, "ignore": -1}
#: What rules ask for.
SHAPE = Shape(
    prefix={"observe": "observe", "saddr": "saddr", "daddr": "daddr", "appid": "ndpi_appid", "orient": "orient"},
    equal={c: c for c in ("proto", "sport", "dport")}, has={"tag": "tag"}, least={"risk_severity": "ndpi_risk_severity", "hbos_severity": "hbos_severity"},
)


@dataclass(frozen=True)
class Rule:
    """Empty text and 0 stand for anything."""

    action: str
    observe: str = ""
    proto: str = ""
    saddr: str = ""
    sport: int = 0
    daddr: str = ""
    dport: int = 0
    appid: str = ""
    orient: str = ""
    tag: str = ""
    risk_severity: int = 0
    hbos_severity: int = 0


def load_rules(text: str) -> list[Rule]:
    known = {f.name for f in fields(Rule)}
    return [Rule(**{k: v for k, v in r.items() if k in known}) for r in load_list(text)]


def checked(rules: list[Rule]) -> list[Rule]:
    if not rules:
        raise ValueError("no rules")
    if bad := sorted({r.action for r in rules} - ACTIONS.keys()):
        raise ValueError(f"unknown actions: {', '.join(bad)}")
    if len(rules) > MANY:
        warnings.warn(f"{len(rules)} rules", stacklevel=2)
    return rules


def apply_rules(flows: DataFrame, rules: list[Rule]) -> DataFrame:
    """``trigger`` becomes 1 or -1 by the last rule that fits; rules without predicates are skipped, as are those that a later one repeats."""
    last = {tuple(wants.items()): Entry(i, str(ACTIONS[r.action]), wants) for i, r in enumerate(checked(rules)) if (wants := SHAPE.wanted(r))}
    if not last:
        return flows
    found = matching(flows, sorted(last.values(), key=lambda e: e.number), SHAPE, "_fit")
    decided = F.array_max("_fit")["label"].cast("int")
    return found.withColumn("trigger", F.coalesce(decided, F.col("trigger").cast("int")).cast(dict(flows.dtypes)["trigger"])).drop("_fit")


def trigger_counts(flows: DataFrame) -> DataFrame:
    """One row: triggered flows in all and by severity."""
    level = F.col("hbos_severity")
    n = lambda c, name: F.count_if(c).alias(name)
    return flows.where("trigger > 0").agg(F.count("*").alias("total"), n(level >= 4, "severe"), n(level == 3, "high"), n(level == 2, "medium"), n(level == 1, "low"))
