"""Histogram-based outlier models: building, summarising, keeping."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.expressions import bin_number, nice_step
from tidemark.operators import score
from tidemark.operators.histogram import DEFAULT_FEATURES, FEATURES, MODEL_PROTOCOLS, NUMERICAL, checked_features, histograms, key_of, learnt, model_rows, ranges
from tidemark.shared import kept, small

MINIMUM_DAYS = 1
#: Rows of a bracket of values that are counted through for a percentile, and steps that a larger bracket is cut into.
RANGE_ROWS, BINS = 2000, 1024


@dataclass
class Model:
    """``histogram``: observe, vlan, proto, name, kind, key, value. ``summary``: a row for each group and feature.
    ``thresholds``: a row for each group."""

    histogram: DataFrame
    summary: DataFrame
    thresholds: DataFrame | None = None


def observations(flows: DataFrame, protocols: tuple[str, ...] | None = None) -> DataFrame:
    rows = flows.where(F.col("proto").isin(*protocols)) if protocols else flows
    return rows.select("observe", "dvlan", "proto").distinct()


def distinct_days(flows: DataFrame) -> DataFrame:
    return flows.select(F.year("stime").alias("year"), F.month("stime").alias("month"), F.dayofmonth("stime").alias("day")).distinct()


def baseline_span(flows: DataFrame) -> DataFrame:
    """One row: ``days`` between the first and the last flow by the midnights they cross."""
    return flows.agg(F.datediff(F.max(F.to_date("stime")), F.min(F.to_date("stime"))).cast("long").alias("days"))


def build_due(flows: DataFrame, built: dt.date | None, today: dt.date, once: bool = False) -> bool:
    """Whether to build: not twice a day (unless ``once``), and only over MINIMUM_DAYS or more."""
    if built == today and not once:
        return False
    days = baseline_span(flows).first()["days"]
    return days is not None and days >= MINIMUM_DAYS


def summarize(histogram: DataFrame, bounds: DataFrame | None = None) -> DataFrame:
    """Type, total count, modulus, number of bins and (numerical) range of each histogram."""
    moduli = F.create_map(*[F.lit(x) for f, (_, m) in FEATURES.items() for x in (f, m)])
    out = histogram.groupBy("observe", "vlan", "proto", "name", F.col("kind").alias("histogram")).agg(F.sum("value").alias("count"), F.count("*").alias("bin_count"))
    out = out.withColumn("hash_size", F.element_at(moduli, F.col("name")))
    if bounds is None:
        return out.select("observe", "vlan", "proto", "name", "histogram", "count", "hash_size", "bin_count")
    names = [c[4:] for c in bounds.columns if c.startswith("_lo_")]
    if not names:
        return out.withColumns({"low": F.lit(None).cast("double"), "high": F.lit(None).cast("double")})
    long_ = bounds.select("observe", F.col("dvlan").alias("vlan"), "proto", F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(f"_lo_{n}").alias("low"), F.col(f"_hi_{n}").alias("high")) for n in names])).alias("x")).select("observe", "vlan", "proto", "x.*")
    return out.join(long_, ["observe", "vlan", "proto", "name"], "left")


def build(flows: DataFrame, features: tuple[str, ...] = DEFAULT_FEATURES) -> Model:
    """Histograms, their summary and the score thresholds of each group; the first two are kept as tables."""
    features = checked_features(features)
    numeric = tuple(f for f in features if FEATURES[f][0] == NUMERICAL)
    # one pass for the ranges, one for the histograms
    bounds = kept(ranges(model_rows(flows), numeric), "model-ranges")
    histogram = kept(histograms(flows, features, bounds=bounds), "model-histogram")
    model = Model(histogram, kept(summarize(histogram, bounds), "model-summary"))
    model.thresholds = kept(score_summary(score.score(flows, model, features, every_row=True)), "model-thresholds")
    return model


# ---------------------------------------------------------------- counts by day


def day_values(flows: DataFrame, features: tuple[str, ...] = DEFAULT_FEATURES, protocols: tuple[str, ...] = MODEL_PROTOCOLS) -> DataFrame:
    """day, observe, vlan, proto, name, exact (the value, or the key of other than numerical features), c: counts that add up over batches and days.

    Kept as a table (``streaming.stages.staged(day_values, ...)`` adds each batch's), they are all that histograms, ranges and summaries need, so
    a rebuild reads no flow again and old days drop out.
    """
    features = checked_features(features)
    each = [F.when(learnt(f), F.struct(F.lit(f).alias("name"), (F.col(f).cast("double").cast("string") if FEATURES[f][0] == NUMERICAL else key_of(f)).alias("exact"))) for f in features]
    present = F.filter(F.array(*each), lambda x: x.isNotNull())
    rows = model_rows(flows, protocols).select(F.to_date("stime").alias("day"), "observe", F.col("dvlan").alias("vlan"), "proto", F.explode(present).alias("x"))
    return rows.groupBy("day", "observe", "vlan", "proto", "x.name", "x.exact").agg(F.count("*").alias("c"))


def from_days(values: DataFrame, features: tuple[str, ...] = DEFAULT_FEATURES, since: str | None = None) -> Model:
    """Histograms and summary from the counts of the days from ``since`` on; thresholds need scores (``score_summary``)."""
    features = checked_features(features)
    mine = values.where(F.col("name").isin(*features))
    mine = mine.where(F.col("day") >= F.lit(since).cast("date")) if since else mine
    g = ["observe", "vlan", "proto", "name"]
    total = kept(mine.groupBy(*g, "exact").agg(F.sum("c").alias("c")), "model-values")
    numeric = [f for f in features if FEATURES[f][0] == NUMERICAL]
    number = F.col("exact").cast("double")
    bounds = kept(total.where(F.col("name").isin(*numeric)).groupBy(*g).agg(F.min(number).alias("low"), F.max(number).alias("high")), "model-ranges")
    kinds = F.create_map(*[F.lit(x) for f in features for x in (f, FEATURES[f][0])])
    step = nice_step(F.col("low"), F.col("high"))
    binned = (bin_number(number, F.col("low"), step) * step).cast("long").cast("string")
    # only numerical values have a range
    keyed = total.join(small(bounds), g, "left").select(*g, F.element_at(kinds, F.col("name")).alias("kind"), F.when(F.col("low").isNull(), F.col("exact")).otherwise(binned).alias("key"), "c")
    histogram = kept(keyed.groupBy(*g, "kind", "key").agg(F.sum("c").alias("value")).select("observe", "vlan", "proto", "name", "kind", "key", "value"), "model-histogram")
    return Model(histogram, kept(summarize(histogram).join(small(bounds), g, "left"), "model-summary"))


def _percentiles(counted: DataFrame, g: list[str], shares: dict[str, float]) -> DataFrame:
    """g and a column for each share: exact interpolated percentiles of ``v``, counted ``c`` times, in each group.

    Each wanted rank has a bracket of values, first the whole range of its group. A pass counts the rows of each bracket in BINS equal steps, which
    combine on the map side, and the bracket shrinks to the step that holds the rank, until it holds RANGE_ROWS rows at most or one value. Only the rows
    inside the brackets are then shuffled and counted through.
    """
    ends = counted.groupBy(*g).agg(F.sum("c").alias("_n"), F.min("v").alias("_lo"), F.max("v").alias("_hi"))
    at = {name: (F.col("_n") - 1) * F.lit(q) for name, q in shares.items()}
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(p), F.ceil(p)) for p in at.values()])))
    brackets = kept(ends.select(*g, "_n", F.explode(ranks).alias("_rank"), "_lo", "_hi", F.lit(0).cast("long").alias("_before"), F.col("_n").alias("_in")), "percentile-brackets")
    wide = (F.col("_in") > RANGE_ROWS) & (F.col("_hi") > F.col("_lo"))
    while not (open_ := brackets.where(wide)).isEmpty():
        step = F.least(F.floor((F.col("v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * BINS), F.lit(BINS - 1))
        inside = counted.join(small(open_), g).where("v BETWEEN _lo AND _hi")
        steps = inside.groupBy(*g, "_n", "_rank", "_before", step.alias("_step")).agg(F.sum("c").alias("_in"), F.min("v").alias("_lo"), F.max("v").alias("_hi"))
        # BINS rows at most for each bracket
        before = F.col("_before") + F.sum("_in").over(Window.partitionBy(*g, "_rank").orderBy("_step")) - F.col("_in")
        found = steps.withColumn("_before", before).where((F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_in")))
        brackets = kept(brackets.where(~wide).unionByName(found.select(*brackets.columns)), "percentile-brackets")
    rows = counted.join(small(brackets), g).where("v BETWEEN _lo AND _hi").groupBy(*g, "_n", "_rank", "_before", "v").agg(F.sum("c").alias("c"))
    upto = F.col("_before") + F.sum("c").over(Window.partitionBy(*g, "_rank").orderBy("v"))
    found = rows.withColumn("_to", upto).where((F.col("_rank") < F.col("_to")) & (F.col("_rank") >= F.col("_to") - F.col("c")))

    def value(name: str) -> Column:
        p = at[name]
        low, high = (F.max(F.when(F.col("_rank") == edge, F.col("v"))) for edge in (F.floor(p), F.ceil(p)))
        p = F.max(p)
        return F.when(low == high, low).otherwise((F.ceil(p) - p) * low + (p - F.floor(p)) * high).alias(name)

    return found.groupBy(*g).agg(*[value(name) for name in shares])


def score_summary(scored: DataFrame) -> DataFrame:
    """Statistics and severity thresholds of ``hbos_score`` for each group that has a model."""
    s = kept(scored.where("_modelled").select("observe", F.col("dvlan").alias("vlan"), "proto", F.col("hbos_score").alias("s")), "model-scores")
    g = ["observe", "vlan", "proto"]
    n = F.count("*")
    unbiased = F.when(n > 2, F.skewness("s") * F.sqrt(n * (n - 1)) / (n - 2))
    stats = s.groupBy(*g).agg(F.min("s").alias("min"), F.max("s").alias("max"), unbiased.alias("skewness"), F.avg("s").alias("avg"), F.stddev_pop("s").alias("stddev"))
    each = s.where("s IS NOT NULL").select(*g, F.col("s").alias("v"), F.lit(1).cast("long").alias("c"))
    middle = kept(_percentiles(each, g, {"median": 0.5, "quantile": 0.99999}), "score-percentiles")
    away = each.join(small(middle.select(*g, "median")), g).select(*g, F.abs(F.col("v") - F.col("median")).alias("v"), "c")
    spread = _percentiles(away, g, {"mad": 0.5})
    return stats.join(middle, g, "left").join(spread, g, "left").withColumns(thresholds(F.col("min"), F.col("max")))


def thresholds(low: Column, high: Column) -> dict[str, Column]:
    """The boundaries below the last one of a nice histogram of the scores; 0 where there is none."""
    step = nice_step(low, high, whole=False)
    at = lambda k: F.when(((F.ceil(high / step) - k) * step > low) & (high > low), (F.ceil(high / step) - k) * step).otherwise(F.lit(0.0))
    return {name: at(k) for name, k in (("low", 4), ("medium", 3), ("high", 2), ("severe", 1))}


def browse(model: Model, observe: str, proto: str, histogram: str) -> DataFrame:
    """Keys and counts of all features of one kind, in order."""
    mine = (F.col("observe") == observe) & (F.col("proto") == proto)
    rows = model.histogram.where(mine & (F.col("kind") == histogram))
    return rows.groupBy("name", "key").agg(F.sum("value").alias("value")).orderBy("name", "key")


# ---------------------------------------------------------------- keeping


def write_model(model: Model, root: str, version: str) -> str:
    """Write a new version beside the old ones, which stay as backups; ``version`` sorts by age."""
    for name, table in (("histogram", model.histogram), ("summary", model.summary), ("thresholds", model.thresholds)):
        table.write.mode("overwrite").parquet(f"{root}/version={version}/{name}")
    # the marker comes last: a version without it is not finished
    model.summary.sparkSession.range(1).write.mode("overwrite").parquet(f"{root}/version={version}/done")
    return version


def latest_version(spark: SparkSession, root: str) -> str | None:
    """The newest finished version, by any file system that Spark knows."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return None
    found = [x.getPath() for x in fs.listStatus(path) if x.getPath().getName().startswith("version=")]
    done = [p.getName().split("=", 1)[1] for p in found if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "done/_SUCCESS"))]
    return max(done, default=None)


def read_model(spark: SparkSession, root: str, version: str | None = None) -> Model | None:
    """The given or newest model; None without one."""
    version = version or latest_version(spark, root)
    if version is None:
        return None
    return Model(*[spark.read.parquet(f"{root}/version={version}/{n}") for n in ("histogram", "summary", "thresholds")])
