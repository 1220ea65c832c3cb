"""Secret scans by corpus-wide ownership frequency, with DataFrame functions only.

Candidates are found by regular expressions with their code-point positions. The hash of
every candidate's value is counted over distinct repositories and owners: a value that
many owners hold is a copied example, one held by a single owner looks live. Candidates of
the base kinds are always reported, with their ownership; of the further kinds (vendor
tokens, long mixed strings) only those that look live.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import stored

#: (kind, pattern, group with the value, least length of the value, is a base kind); base patterns are fixed values.
KINDS = (
    ("assign", r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6, True),
    ("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    # runs of 24 or more are the maximal runs of [0-9a-f]+ that are long enough
    ("hex", r"[0-9a-f]{24,}", 0, 24, True),
    ("vendor", r"(?:gh[pousr]_|sk_live_|xox[abps]-|glpat-|AIza|eyJ)[A-Za-z0-9_.-]{16,}", 0, 20, False),
    ("mixed", r"[A-Za-z0-9+/_=-]{32,}", 0, 32, False),
)
#: A value looks live when at most so many owners hold it, in at most so many repositories.
MAX_OWNERS, MAX_REPOS = 1, 3
#: A value that one in so many spans holds gets its verdict by broadcast; there are at most as many.
HEAVY = 1000
_PART = "array<struct<gap:bigint,len:bigint,good:boolean,h:bigint>>"


def _parts(text: Column, pattern: str, group: int, least: int, base: bool) -> Column:
    """Leftmost matches of one pattern that do not overlap: the length of the gap before each and its own, whether it counts, the hash of its value."""
    gaps, whole = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    good = lambda v: (F.length(v) >= least) & (F.lit(True) if base else v.rlike("[0-9]") & v.rlike("[a-z]") & v.rlike("[A-Z]"))
    zipped = F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), value.alias("value"))
    # the text behind the last match has no match of its own
    parts = F.transform(zipped, lambda p: F.struct(F.length(p["gap"]).cast("long").alias("gap"), F.length(p["whole"]).cast("long").alias("len"), F.coalesce(good(p["value"]), F.lit(False)).alias("good"), F.xxhash64(p["value"]).alias("h")))
    return F.when(text.rlike(pattern), parts).otherwise(F.array().cast(_PART))


def candidates(docs: DataFrame, repo: str, owner: str, keep: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Two stored tables: a row for each input row (kept columns, ``_id``), and the spans.

    Spans: _id, _repo, _owner, ord (number of the kind), start, stop, base, h. Their places are running sums over the gaps and matches of a text and kind, so the work grows with the
    matches, not with their square.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    owned = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(a) for c, a in ((repo, "_repo"), (owner, "_owner"))]
    by_kind = [_parts(text, *k[1:]).alias(f"_parts{i}") for i, k in enumerate(KINDS)]
    found = stored(docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"), *owned, *by_kind).withColumn("_id", F.monotonically_increasing_id()), "secret-candidates")
    each = [found.select("_id", "_repo", "_owner", F.lit(i).alias("ord"), F.posexplode(f"_parts{i}").alias("i", "p")) for i in range(len(KINDS))]
    flat = reduce(DataFrame.unionByName, each).select("_id", "_repo", "_owner", "ord", "i", "p.*")
    stop = F.sum(F.col("gap") + F.coalesce("len", F.lit(0))).over(Window.partitionBy("_id", "ord").orderBy("i"))
    base = F.col("ord").isin(*[i for i, k in enumerate(KINDS) if k[4]])
    spans = flat.withColumn("stop", stop).where("good").select("_id", "_repo", "_owner", "ord", (F.col("stop") - F.col("len")).alias("start"), "stop", base.alias("base"), "h")
    return found.select("_id", "_row"), stored(spans, "secret-spans")


def ownership(spans: DataFrame) -> DataFrame:
    """``h, owners, repos, n``: in how many distinct owners and repositories each value occurs, and how often.

    Counted in steps, so that a value in a third of all rows spreads over (value, owner, repository).
    """
    once = spans.groupBy("h", "_owner", "_repo").agg(F.count("*").alias("n"))
    by_owner = once.groupBy("h", "_owner").agg(F.count("*").alias("repos"), F.sum("n").alias("n"))
    return by_owner.groupBy("h").agg(F.count("*").alias("owners"), F.sum("repos").alias("repos"), F.sum("n").alias("n"))


def judged(spans: DataFrame, live: Column) -> DataFrame:
    """The spans with ``live``. Verdicts of the values held most often are broadcast, so that no value's spans meet in one task."""
    owned = stored(ownership(spans), "secret-owners")
    total = owned.agg(F.sum("n")).first()[0] or 0
    verdict = owned.select("h", live.alias("live"), (F.col("n") * HEAVY >= total).alias("_heavy"))
    heavy = F.broadcast(verdict.where("_heavy").select("h", F.col("live").alias("_live")))  # at most HEAVY rows
    marked = stored(spans.join(heavy, "h", "left"), "secret-marked")
    done = marked.where("_live IS NOT NULL").withColumnRenamed("_live", "live")
    return done.unionByName(marked.where("_live IS NULL").drop("_live").join(verdict.where("NOT _heavy").select("h", "live"), "h"))


def scan_secrets(docs: DataFrame, repo: str = "doc_id", owner: str = "source", keep: tuple[str, ...] = ("doc_id",), max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> DataFrame:
    """One row per input row: kept columns, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied.

    ``spans`` lists every base span and those further spans whose value looks live and that lie
    outside the base spans, by start, then kind. ``n_live`` and ``n_copied`` split the reported spans
    by ownership. A null text counts as empty: no spans, ``base_sha256`` of the empty string. Null repositories
    and owners count as one each. Repeated rows stay; they add no repository. Long texts are scanned whole, in time that grows with their matches. An empty table gives an
    empty result. Columns that are not kept are not returned, so their names cannot clash; kept ones named like a result are replaced.
    """
    results = ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_live", "n_copied")
    keep = tuple(c for c in keep if c not in results)
    found, spans = candidates(docs, repo, owner, keep)
    all_ = judged(spans, (F.col("owners") <= max_owners) & (F.col("repos") <= max_repos))
    # a span meets a base span that starts no later and ends behind its start, or one that starts within it
    row = Window.partitionBy("_id")
    before = F.max(F.when(F.col("base"), F.col("stop"))).over(row.orderBy("start").rangeBetween(Window.unboundedPreceding, 0))
    after = F.min(F.when(F.col("base"), F.col("start"))).over(row.orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, 0))
    clear = (F.coalesce(before, F.lit(0)) <= F.col("start")) & (F.coalesce(after, F.col("stop")) >= F.col("stop"))
    shown = all_.withColumn("_clear", clear).where("base OR (live AND _clear)")
    kinds = F.array(*[F.lit(k[0]) for k in KINDS])
    entry = F.struct("start", "ord", F.concat_ws(":", F.get(kinds, F.col("ord")), F.col("start").cast("string"), F.col("stop").cast("string")).alias("text"))
    listed = lambda c: F.concat_ws(",", F.transform(F.sort_array(F.collect_list(c)), lambda s: s["text"]))
    n = lambda c, name: F.count_if(c).alias(name)
    by_row = shown.groupBy("_id").agg(
        *[n(F.col("ord") == i, f"n_{k[0]}") for i, k in enumerate(KINDS) if k[4]], listed(F.when(F.col("base"), entry)).alias("_base"), listed(entry).alias("spans"),
        n(F.col("live"), "n_live"), n(~F.col("live"), "n_copied"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return found.join(by_row, "_id", "left").select(
        *[F.col(f"_row.`{c}`") for c in keep], zero("n_assign"), zero("n_access"), zero("n_hex"), F.sha2(F.coalesce("_base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"), zero("n_live"), zero("n_copied"),
    )


def oracle() -> str:
    """The same in SQL: positions from the gaps between matches, ownership by distinct counts."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    parts = []
    for i, (kind, pattern, group, least, base) in enumerate(KINDS):
        mixed = "true" if base else "regexp_matches(v, '[0-9]') AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]')"
        parts.append(f"""SELECT rid, owner, {i} AS ord, '{kind}' AS kind, {str(base).lower()} AS base, v,
  CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(whole[1:i-1], lambda x: length(x))), 0) AS BIGINT) AS start, length(m) AS len
FROM (SELECT rid, owner, gaps, whole, unnest(range(1, len(whole) + 1)) AS i, unnest(whole) AS m, unnest(vals) AS v
  FROM (SELECT rid, owner, string_split_regex(text, {q(pattern)}) AS gaps, regexp_extract_all(text, {q(pattern)}, 0) AS whole, regexp_extract_all(text, {q(pattern)}, {group}) AS vals FROM src
        WHERE regexp_matches(text, {q(pattern)})))
WHERE length(v) >= {least} AND {mixed}""")
    listed = "coalesce(string_agg(kind || ':' || start || ':' || (start + len), ',' ORDER BY start, ord){}, '')"
    return f"""
WITH src AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(CAST(source AS VARCHAR), '') AS owner, coalesce(text, '') AS text FROM documents),
s AS ({' UNION ALL '.join(parts)}),
o AS (SELECT v, count(DISTINCT s.owner) AS owners, count(DISTINCT coalesce(CAST(doc_id AS VARCHAR), '')) AS repos FROM s JOIN src USING (rid) GROUP BY v),
j AS (SELECT s.*, owners <= {MAX_OWNERS} AND repos <= {MAX_REPOS} AS live FROM s JOIN o USING (v)),
shown AS (SELECT * FROM j WHERE base OR (live AND NOT EXISTS (SELECT 1 FROM s b WHERE b.base AND b.rid = j.rid AND b.start < j.start + j.len AND j.start < b.start + b.len)))
SELECT any_value(src.doc_id) AS doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
  count(*) FILTER (WHERE kind = 'hex') AS n_hex, sha256({listed.format(' FILTER (WHERE base)')}) AS base_sha256, {listed.format('')} AS spans,
  count(*) FILTER (WHERE live) AS n_live, count(*) FILTER (WHERE NOT live) AS n_copied
FROM src LEFT JOIN shown ON src.rid = shown.rid GROUP BY src.rid"""
