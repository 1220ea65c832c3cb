"""Tags: lists of names that rules add to flows."""

from __future__ import annotations

import json
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.rule_index import Entry, Shape, matching


@dataclass(frozen=True)
class TagRule:
    """Empty text and 0 stand for anything."""

    tag: str
    observe: str = ""
    proto: str = ""
    saddr: str = ""
    sport: int = 0
    daddr: str = ""
    dport: int = 0
    ndpi_appid: str = ""
    orient: str = ""


#: Columns that must start with the rule's text, and those that must equal it.
SHAPE = Shape(prefix={c: c for c in ("observe", "saddr", "daddr", "ndpi_appid", "orient")}, equal={c: c for c in ("proto", "sport", "dport")})


def load_list(text: str) -> list[dict]:
    """A JSON array, or one JSON object a line."""
    text = text.strip()
    return json.loads(text) if text.startswith("[") else [json.loads(x) for x in text.splitlines() if x.strip()]


def load_tags(text: str) -> list[TagRule]:
    known = {f.name for f in fields(TagRule)}
    return [TagRule(**{k: v for k, v in r.items() if k in known}) for r in load_list(text)]


def apply_tags(flows: DataFrame, rules: list[TagRule], compat: bool = False) -> DataFrame:
    """Each rule adds its tag where it is not there yet and the rule's predicates hold.

    ``compat``: a flow without a tag list gets the first rule's tag whatever the predicates.
    """
    if not rules:
        return flows
    # every rule is tried on the flow's own columns, and all tags are merged at once
    flows = matching(flows, [Entry(i, r.tag, SHAPE.wanted(r)) for i, r in enumerate(rules)], SHAPE, "_fit")
    found = F.transform("_fit", lambda r: r["label"])
    have = F.coalesce("tag", F.array(*([F.lit(rules[0].tag)] if compat else [])).cast("array<string>"))
    tags = F.concat(have, F.array_except(found, have))
    return flows.withColumn("tag", F.when(F.col("tag").isNotNull() | (F.size(tags) > 0), tags)).drop("_fit")
