"""URL filters: pattern rules indexed by their rarest literal token.

A rule is ``verdict``, ``host`` (a domain, fits its subdomains too; ``*`` fits any) and
``path`` (must start the url's path; ``*`` stands for any characters, a leading ``*``
lets the rest stand anywhere in the path). Each rule is filed under one literal token:
of the host labels and the path's runs of letters and digits that any url it fits must hold whole, the one
that occurs in the fewest urls. A url's tokens fetch candidate rules with an equi-join and
only those run as regular expressions. Rules without a literal token are filed under a
token that every url holds.

All of it is DataFrame code. The rule index is broadcast in blocks of at most MAX_RULES rules.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import UPPER

#: Rules in one broadcast block (some 200 bytes each).
MAX_RULES = 50_000


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str
    #: Rules of tier 1 (site rules) go before those of tier 0 (general patterns).
    tier: int = 1

    @property
    def label(self) -> str:
        return self.host + self.path

    @property
    def regex(self) -> str:
        """For ``"." + host + path``."""
        host = r"^[^/]*" if self.host == "*" else r"^[^/]*\." + re.escape(self.host)
        return host + ".*".join(re.escape(p) for p in self.path.split("*"))

    @property
    def tokens(self) -> list[str]:
        labels = [] if self.host == "*" else [f"h:{x}" for x in self.host.split(".") if x]
        # a run is whole when the pattern has another character than a star on both sides of it
        runs = [f"p:{x}" for x in re.findall(r"(?<=[^A-Za-z0-9*])[A-Za-z0-9]+(?=[^A-Za-z0-9*])", self.path)]
        return labels + runs or [""]


#: Site rules of the contract (fixed values).
SITE_RULES = (
    UrlRule("allow", "org", "/"),
    UrlRule("block", "example.org", "/es/"),
    UrlRule("block", "example.org", "/en/1"),
    UrlRule("allow", "com", "/fr/"),
    UrlRule("block", "com", "/de/"),
)
#: General patterns for urls that no site rule fits; the longest that fits decides, else the url is allowed.
GENERAL_RULES = tuple(
    UrlRule("block", "*", p, 0)
    for p in ("*/ads/", "*/adserver/", "*/banner/", "*/cart/", "*/checkout/", "*/login/", "*/signin/", "*/logout/", "*/cgi-bin/", "*/track/", "*/tracking/", "*/wp-admin/", "*/wp-login.php", "*/feed/", "*/share/", "*/trackback/")
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else ''."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; '' without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def filter_urls(pages: DataFrame, rules: tuple[UrlRule, ...] = SITE_RULES + GENERAL_RULES, default: str = "allow", url: str = "url", keys: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """One row per input row: the key columns, host, path, rule, verdict.

    ``rule`` is the label of the fitting site rule (tier 1) that is longest, else null;
    ``verdict`` is that rule's, else that of the longest fitting general rule, else ``default``.
    Of equally long rules the one first in code-point order wins. Null urls and urls without
    ``://`` have empty host and path and fit no site rule. Repeated rows stay repeated; other
    columns are not returned, so their names cannot clash. Empty input gives an empty result.
    """
    spark = pages.sparkSession
    # repeated (key, url) rows travel once and are multiplied again at the end
    ks = [f"_k{i}" for i in range(len(keys))]
    rows = pages.select(*[F.col(f"`{k}`").alias(a) for k, a in zip(keys, ks, strict=True)], host_of(F.col(f"`{url}`")).alias("_host"), path_of(F.col(f"`{url}`")).alias("_path"))
    rows = rows.groupBy(*ks, "_host", "_path").agg(F.count("*").alias("_n"))
    labels = F.transform(F.split("_host", r"\."), lambda x: F.concat(F.lit("h:"), x))
    runs = F.transform(F.split("_path", "[^A-Za-z0-9]+"), lambda x: F.concat(F.lit("p:"), x))
    tokens = F.array_distinct(F.concat(F.array(F.lit("")), labels, runs))
    found = rows.withColumn("_tokens", tokens)

    best = None
    for at in range(0, max(len(rules), 1), MAX_RULES):
        part = rules[at : at + MAX_RULES]
        listed = spark.createDataFrame([(i, r.tier, r.verdict, r.label, r.regex, r.tokens) for i, r in enumerate(part)], "_i int, _tier int, _verdict string, _label string, _regex string, _literals array<string>")
        literal = F.broadcast(listed.select(F.explode("_literals").alias("_t")).distinct())
        # how many urls hold each token that a rule could be filed under: at most one row a token
        often = found.select(F.explode("_tokens").alias("_t")).join(literal, "_t", "left_semi").groupBy("_t").agg(F.count("*").alias("_often"))
        index = (
            listed.select("*", F.explode("_literals").alias("_t")).join(often, "_t", "left")
            .groupBy("_i", "_tier", "_verdict", "_label", "_regex")
            .agg(F.min(F.struct(F.coalesce("_often", F.lit(0)).alias("often"), "_t")).alias("_rarest"))
            .select("_tier", "_verdict", "_label", "_regex", F.col("_rarest._t").alias("_t"))
        )
        whole = F.concat(F.lit("."), F.col("_host"), F.col("_path"))
        fits = F.when(F.rlike(whole, F.col("_regex")), F.struct(F.col("_tier").alias("tier"), F.length("_label").alias("len"), F.col("_label").alias("label"), F.col("_verdict").alias("verdict")))
        hits = found.select(*ks, "_host", "_path", "_n", F.explode("_tokens").alias("_t")).join(F.broadcast(index), "_t", "left").withColumn("_fit", fits)
        best = hits if best is None else best.unionByName(hits)
    # longest first, then the smallest label: min over (-tier, -length, label)
    rank = F.when(F.col("_fit").isNotNull(), F.struct((-F.col("_fit.tier")).alias("t"), (-F.col("_fit.len")).alias("l"), F.col("_fit.label").alias("label"), F.col("_fit.verdict").alias("verdict")))
    out = best.groupBy(*ks, "_host", "_path", "_n").agg(F.min(rank).alias("_best"))
    out = out.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))).alias("_copy"))
    return out.select(
        *[F.col(a).alias(k) for k, a in zip(keys, ks, strict=True)],
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.when(F.col("_best.t") == -1, F.col("_best.label")).alias("rule"),
        F.coalesce(F.col("_best.verdict"), F.lit(default)).alias("verdict"),
    )


def oracle() -> str:
    """The same by brute force in SQL: every rule is tried on every url."""
    rules = [*SITE_RULES, *GENERAL_RULES]
    q = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({r.tier}, {q(r.verdict)}, {q(r.label)}, {q(r.regex)})" for r in rules)
    lower = f"translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{UPPER.lower()}')"
    return f"""
WITH rules(tier, verdict, label, regex) AS (VALUES {values}),
u AS (SELECT row_number() OVER () AS n, page_id, coalesce({lower}, '') AS host,
      coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
hit AS (SELECT u.n, r.*, row_number() OVER (PARTITION BY u.n ORDER BY tier DESC, length(label) DESC, label) AS k
        FROM u JOIN rules r ON regexp_matches('.' || u.host || u.path, r.regex))
SELECT u.page_id, u.host, u.path, CASE WHEN h.tier = 1 THEN h.label END AS rule, coalesce(h.verdict, 'allow') AS verdict
FROM u LEFT JOIN hit h ON h.n = u.n AND h.k = 1"""
