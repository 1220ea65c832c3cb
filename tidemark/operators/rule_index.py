"""Thousands of rules against flows: each rule is filed under its rarest value, and a flow meets only what is filed under its own.

A rule gives values for some attributes: beginnings of texts, equal values, members of lists, least levels. It is filed once, under that
equal value or beginning that the fewest rules ask for. Beginnings of an attribute are filed by at most LENGTHS lengths, so the index has a few
small tables (a row for each value, with the rules filed there) and a flow meets one row of each by a broadcast join: flows are neither shuffled nor multiplied, and
the plan grows with the attributes, not with the rules. Rules that only ask for list members or levels are tried on every flow.
"""

from __future__ import annotations

import json
from collections import Counter
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules that are tried one by one, without an index.
FLAT = 24
#: Lengths that beginnings of one attribute are filed by.
LENGTHS = 4


@dataclass(frozen=True)
class Shape:
    """Attributes of rules and the columns that they are held against."""

    prefix: dict[str, str]
    equal: dict[str, str]
    has: dict[str, str] = field(default_factory=dict)
    least: dict[str, str] = field(default_factory=dict)

    def wanted(self, rule) -> dict:
        """The attributes that a rule asks for; empty text and 0 stand for anything."""
        return {a: v for a in (*self.prefix, *self.equal, *self.has, *self.least) if (v := getattr(rule, a))}


@dataclass(frozen=True)
class Entry:
    """A rule by number, with what it says when it fits (``label``) and what it asks for."""

    number: int
    label: str
    wants: dict


def _fits(shape: Shape, used: set[str], value) -> Column:
    """Whether what ``value(attribute)`` asks for holds for a flow; null columns fit nothing that is asked."""
    any_ = lambda a, empty: value(a) == F.lit(empty)
    terms = [any_(a, "") | F.col(c).startswith(value(a)) for a, c in shape.prefix.items() if a in used]
    terms += [any_(a, "") | (F.col(c).cast("string") == value(a)) for a, c in shape.equal.items() if a in used]
    terms += [any_(a, "") | F.array_contains(F.coalesce(c, F.array().cast("array<string>")), value(a)) for a, c in shape.has.items() if a in used]
    terms += [any_(a, 0) | (F.col(c) >= value(a)) for a, c in shape.least.items() if a in used]
    return reduce(lambda a, b: a & b, terms, F.lit(True))


def _direct(shape: Shape, wants: dict) -> Column:
    terms = [F.col(shape.prefix[a]).startswith(v) for a, v in wants.items() if a in shape.prefix]
    terms += [F.col(shape.equal[a]) == v for a, v in wants.items() if a in shape.equal]
    terms += [F.array_contains(F.coalesce(shape.has[a], F.array().cast("array<string>")), v) for a, v in wants.items() if a in shape.has]
    terms += [F.col(shape.least[a]) >= v for a, v in wants.items() if a in shape.least]
    return reduce(lambda a, b: a & b, terms, F.lit(True))


def cuts(entries: list[Entry], shape: Shape) -> dict[str, list[int]]:
    """For each attribute the lengths that beginnings are filed by, the shortest always among them."""
    out = {}
    for a in shape.prefix:
        sizes = sorted({len(e.wants[a]) for e in entries if a in e.wants})
        if len(sizes) > LENGTHS:
            sizes = sorted({sizes[i * (len(sizes) - 1) // (LENGTHS - 1)] for i in range(LENGTHS)})
        out[a] = sizes
    return out


def filed(entries: list[Entry], shape: Shape) -> tuple[dict[tuple[str, int], dict[str, list[Entry]]], list[Entry]]:
    """(attribute, length or 0) to value to the rules filed there, and the rules that cannot be filed."""
    lengths = cuts(entries, shape)

    def keys(e: Entry) -> list[tuple[str, int, str]]:
        out = [(a, 0, str(e.wants[a])) for a in shape.equal if a in e.wants]
        for a in shape.prefix:
            if v := e.wants.get(a):
                n = max(x for x in lengths[a] if x <= len(v))
                out.append((a, n, v[:n]))
        return out

    held = Counter(k for e in entries for k in keys(e))
    tables: dict[tuple[str, int], dict[str, list[Entry]]] = {}
    rest = []
    for e in entries:
        if found := keys(e):
            a, n, v = min(found, key=lambda k: held[k])
            tables.setdefault((a, n), {}).setdefault(v, []).append(e)
        else:
            rest.append(e)
    return tables, rest


def matching(flows: DataFrame, entries: list[Entry], shape: Shape, name: str) -> DataFrame:
    """``flows`` with a list ``name`` of (number, label) of the rules that fit, by number."""
    kind = "struct<number:int,label:string>"
    said = lambda e: F.struct(F.lit(e.number).alias("number"), F.lit(e.label).alias("label"))
    if len(entries) <= FLAT:
        return flows.withColumn(name, F.array_compact(F.array(*[F.when(_direct(shape, e.wants), said(e)) for e in entries])).cast(f"array<{kind}>"))
    used = {a for e in entries for a in e.wants}
    asked = [a for a in (*shape.prefix, *shape.equal, *shape.has, *shape.least) if a in used]
    row = f"struct<number:int,label:string,{','.join(f'{a}:{"int" if a in shape.least else "string"}' for a in asked)}>"
    value = lambda e, a: int(e.wants.get(a, 0)) if a in shape.least else str(e.wants.get(a, ""))
    tables, rest = filed(entries, shape)
    out, lists = flows, []
    for i, ((a, n), table) in enumerate(sorted(tables.items())):
        index = flows.sparkSession.createDataFrame([(v, [(e.number, e.label, *[value(e, x) for x in asked]) for e in es]) for v, es in table.items()], f"_at string, _rules{i} array<{row}>")
        column = F.col(shape.prefix[a] if n else shape.equal[a])
        mine = F.when(F.length(column) >= n, F.substring(column, 1, n)) if n else column.cast("string")
        # as many rows as rules at most
        out = out.join(F.broadcast(index), mine == F.col("_at"), "left").drop("_at")
        lists.append(F.col(f"_rules{i}"))
    if rest:
        text = json.dumps([{"number": e.number, "label": e.label, **{x: value(e, x) for x in asked}} for e in rest])
        lists.append(F.from_json(F.lit(text), f"array<{row}>"))
    fit = lambda r: _fits(shape, used, lambda a: r[a])
    each = [F.coalesce(F.filter(x, fit), F.array().cast(f"array<{row}>")) for x in lists]
    found = F.transform(F.array_sort(F.concat(*each)), lambda r: F.struct(r["number"], r["label"]))
    return out.withColumn(name, found).drop(*[f"_rules{i}" for i in range(len(tables))])
