"""The jobs over streams of flow files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.metrics import SERIES, TELEMETRY, metric_rows, metrics_all, series_of
from tidemark.operators.model import latest_version, read_model
from tidemark.operators.select import merge, same_stream, split
from tidemark.shared import kept
from tidemark.sources.files import BATCH_FILES, read_flows
from tidemark.streaming.ledger import Ledger, file_names, fresh, run_of, unreadable, with_inputs

#: Interval names to trigger arguments; unknown ones count as a second.
INTERVALS = {"once": {"availableNow": True}, "second": {"processingTime": "1 second"}, "minute": {"processingTime": "1 minute"}, "hour": {"processingTime": "1 hour"}, "day": {"processingTime": "1 day"}, "week": {"processingTime": "7 days"}}


def trigger_of(interval: str) -> dict:
    return INTERVALS.get(interval, INTERVALS["second"])


def windowed_metrics(flows: DataFrame, late: str = "10 minutes", names: tuple[str, ...] = tuple(SERIES)) -> DataFrame:
    """Per-minute metrics with a watermark: a minute is emitted once, rows later than ``late`` are left out.

    Watermarks need a zoned time; the session's zone must be UTC.
    """
    timed = flows.withColumn("stime", F.col("stime").cast("timestamp")).withWatermark("stime", late)
    out = _timed_rows(timed, names).groupBy(F.window("stime", "1 minute").alias("w"), "observe", "name", "beside", "key").agg(F.sum("value").alias("value"))
    return out.select(F.lit(TELEMETRY).cast("long").alias("stream"), F.col("w.start").cast("timestamp_ntz").alias("bucket"), "observe", "name", "key", "value")


def _timed_rows(flows: DataFrame, names: tuple[str, ...]) -> DataFrame:
    return flows.select("stime", "observe", F.explode(series_of(names)).alias("x")).select("stime", "observe", "x.*")


def accepted(batch: DataFrame) -> bool:
    return bool(same_stream(batch).first()["accepted"])


#: What a stage makes of a batch: a table for each folder below its root.
Tables = Callable[[DataFrame, Ledger], dict[str, DataFrame]]


def each_batch(work: Tables, root: str, rejected: str, note: Callable[[DataFrame, Ledger], dict] | None = None) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that publishes what ``work`` makes of each batch of one kind of stream; other batches are published in ``rejected``.

    Repeated batches and files that were published before, by this checkpoint or another, add nothing.
    """

    def run(batch: DataFrame, number: int) -> None:
        spark, name = batch.sparkSession, run_of(batch)
        good, bad = Ledger(spark, root), Ledger(spark, rejected)
        good.recover()
        if good.has(name, number) or bad.has(name, number):
            return
        batch = with_inputs(batch).persist()
        try:
            rows, inputs = fresh(good, batch)
            if accepted(rows):
                good.publish(name, number, work(rows, good), inputs, note(rows, good) if note else None)
            elif not rows.isEmpty():
                rows, inputs = fresh(bad, batch)
                if not rows.isEmpty():
                    bad.publish(name, number, {".": rows}, inputs)
        finally:
            batch.unpersist()

    return run


def partial_metrics(root: str, rejected: str) -> Callable[[DataFrame, int], None]:
    """Additive metrics: every batch adds rows of its own, late flows too; readers add them up.

    Batches of mixed streams go to ``rejected``.
    """
    return each_batch(lambda batch, _: {".": metrics_all(batch)}, root, rejected)


def staged(stage: Callable[[DataFrame], DataFrame], output: str, rejected: str) -> Callable[[DataFrame, int], None]:
    """Apply a stage to each batch and publish what it returns: a stream over ``output`` is the next stage's source."""
    return each_batch(lambda batch, _: {".": stage(batch)}, output, rejected)


def staged_files(stage: Callable[[DataFrame], DataFrame], read: Callable[[list[str]], DataFrame], output: str, rejected: str, broken: str) -> Callable[[DataFrame, int], None]:
    """The same over a stream of file names (``ledger.file_names``), which goes on past files that cannot be read.

    When reading fails, the unreadable files are found by halving and listed with their errors in ``broken``; the
    others are published. Batches of mixed streams go to ``rejected``.
    """

    def run(names: DataFrame, number: int) -> None:
        spark, name = names.sparkSession, run_of(names)
        good, bad, set_aside = ledgers = [Ledger(spark, root) for root in (output, rejected, broken)]
        paths = sorted(r["path"] for r in names.collect())  # the files of one batch
        for ledger in ledgers:
            ledger.recover()
            known = ledger.consumed(paths)
            paths = [p for p in paths if p not in known]
        if not paths:
            return
        try:
            rows = kept(read(paths), "stage-batch")
        except Exception:
            if not (wrong := unreadable(read, paths)):
                raise
            set_aside.publish(name, number, {".": spark.createDataFrame(sorted(wrong.items()), "path string, error string")}, sorted(wrong))
            if not (paths := [p for p in paths if p not in wrong]):
                return
            rows = kept(read(paths), "stage-batch")
        if accepted(rows):
            good.publish(name, number, {".": stage(rows)}, paths)
        elif not rows.isEmpty():
            bad.publish(name, number, {".": rows}, paths)

    return run


#: Metrics kept by day: the columns that tell rows apart.
DAY_KEYS = ("bucket", "observe", "name", "beside", "key")


def day_metrics(root: str, rejected: str, names: tuple[str, ...] = tuple(SERIES)) -> Callable[[DataFrame, int], None]:
    """The state of each day's metrics: a batch adds to the days it holds rows of, and only these are written anew.

    Partial, late and repeated batches give what one batch with all rows gives. The new state of a batch's days is published with the batch, and what it
    replaces is deleted afterwards; days that get no more rows are not touched.
    """

    def work(batch: DataFrame, ledger: Ledger) -> dict[str, DataFrame]:
        new = metric_rows(batch, names).groupBy(*DAY_KEYS).agg(F.sum("value").alias("value")).withColumn("day", _day("bucket"))
        if ledger.published("state"):
            new = kept(new, "day-metrics")
            days = [r["day"] for r in new.select("day").distinct().collect()]  # those of one batch
            new = new.unionByName(_newest(ledger).where(F.col("day").isin(*days)))
        return {"state": new.groupBy("day", *DAY_KEYS).agg(F.sum("value").alias("value"))}

    run = each_batch(work, root, rejected, lambda batch, _: {"days": ",".join(r["day"] for r in batch.select(_day("stime").alias("day")).distinct().collect())})

    def then_clean(batch: DataFrame, number: int) -> None:
        run(batch, number)
        ledger = Ledger(batch.sparkSession, root)
        newest = set(_versions(ledger).values())
        ledger.forget("state", [s for s in ledger.published("state") if s not in newest])

    return then_clean


def _day(time: str) -> Column:
    """The day of a time as text; rows without a time have one of their own."""
    return F.coalesce(F.to_date(time).cast("string"), F.lit("none"))


def _versions(ledger: Ledger) -> dict[str, int]:
    """Day to the newest entry that holds it, if its state is there."""
    days = ledger.entries().select("seq", F.explode(F.split(F.element_at("note", "days"), ",")).alias("day"))
    there = set(ledger.published("state"))
    return {r["day"]: r["seq"] for r in days.groupBy("day").agg(F.max("seq").alias("seq")).collect() if r["seq"] in there}  # a row a day


def _newest(ledger: Ledger) -> DataFrame:
    """The newest state of each day."""
    versions = _versions(ledger)
    parts = [ledger.read("state", [s]).where(F.col("day").isin(*[d for d, v in versions.items() if v == s])) for s in sorted(set(versions.values()))]
    return merge(parts)


def read_day_metrics(spark: SparkSession, root: str, *days: str) -> DataFrame:
    """stream, bucket, observe, name, key, value of the state, of all days or some."""
    ledger = Ledger(spark, root)
    ledger.recover()
    rows = _newest(ledger)
    rows = rows.where(F.col("day").isin(*days)) if days else rows
    return rows.select(F.lit(TELEMETRY).cast("long").alias("stream"), "bucket", "observe", "name", "key", "value")


def expire_days(spark: SparkSession, root: str, before: str) -> int:
    """Delete the state of days before a day; how many entries' states went. Later rows of such a day start it anew."""
    ledger = Ledger(spark, root)
    versions = _versions(ledger)
    gone = {s for d, s in versions.items() if d < before} - {s for d, s in versions.items() if d >= before}
    ledger.forget("state", sorted(gone))
    return len(gone)


def late_metrics(root: str, rejected: str, late: str = "10 minutes", names: tuple[str, ...] = tuple(SERIES)) -> Callable[[DataFrame, int], None]:
    """Per-minute metrics that are final when the watermark passes their minute, and a table of what came later.

    The watermark is the latest time of all batches before, less ``late``. A minute is open until then; closed ones are published in ``windows`` once, rows of
    closed minutes add to ``late``. ``windows``, ``late`` and the newest ``open`` add up to the metrics of all rows.
    """

    def before(ledger: Ledger) -> str:
        return ((ledger.last() or {}).get("note") or {}).get("latest", "")

    def latest(batch: DataFrame, ledger: Ledger) -> str:
        return max(before(ledger), batch.agg(F.max("stime").cast("string")).first()[0] or "")

    def over(time: str) -> Column:
        """Whether a minute ends before the watermark that follows from the latest time; one without a time never does."""
        mark = F.lit(time or None).cast("timestamp_ntz") - F.expr(f"INTERVAL {late}")
        return F.coalesce(F.col("bucket") + F.expr("INTERVAL 1 minute") <= mark, F.lit(False))

    def work(batch: DataFrame, ledger: Ledger) -> dict[str, DataFrame]:
        rows = metric_rows(batch, names).groupBy(*DAY_KEYS).agg(F.sum("value").alias("value"))
        rows = kept(rows.withColumn("_late", over(before(ledger))), "late-metrics")
        on_time = rows.where("NOT _late").drop("_late")
        if held := ledger.published("open"):
            on_time = on_time.unionByName(ledger.read("open", held[-1:]).select(*on_time.columns))
        on_time = kept(on_time.groupBy(*DAY_KEYS).agg(F.sum("value").alias("value")), "open-metrics")
        closed = over(latest(batch, ledger))
        return {"open": on_time.where(~closed), "windows": on_time.where(closed), "late": rows.where("_late").drop("_late")}

    run = each_batch(work, root, rejected, lambda batch, ledger: {"latest": latest(batch, ledger)})

    def then_clean(batch: DataFrame, number: int) -> None:
        run(batch, number)
        ledger = Ledger(batch.sparkSession, root)
        ledger.forget("open", ledger.published("open")[:-1])

    return then_clean


def with_latest_model(root: str, stage: Callable[[DataFrame, object], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """A stage that reads the newest model before each batch, again only when there is a newer one."""
    held: dict = {}

    def run(batch: DataFrame) -> DataFrame:
        spark = batch.sparkSession
        version = latest_version(spark, root)
        if version != held.get("version"):
            held.update(version=version, model=read_model(spark, root, version))
        return stage(batch, held.get("model"))

    return run


def split_batches(routes: list[dict], rejected: str) -> Callable[[DataFrame, int], None]:
    """Publish each protocol's rows of a batch in its path; protocols without rows write nothing, batches of mixed streams go to ``rejected``."""

    def run(batch: DataFrame, number: int) -> None:
        batch = with_inputs(batch).persist()
        try:
            rows, name = batch.drop("_input"), run_of(batch)
            if not accepted(rows):
                bad = Ledger(batch.sparkSession, rejected)
                left, inputs = fresh(bad, batch)
                if not left.isEmpty():
                    bad.publish(name, number, {".": left}, inputs)
                return
            for path in split(rows, routes):
                # each path has a ledger of its own, so a batch that was cut off goes on where it stopped
                ledger = Ledger(batch.sparkSession, path)
                left, inputs = fresh(ledger, batch)
                mine = split(left, routes)[path]
                if not mine.isEmpty():
                    ledger.publish(name, number, {".": mine}, inputs)
        finally:
            batch.unpersist()

    return run


def start(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, interval: str = "once"):
    return stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(**trigger_of(interval)).start()


def start_chain(spark: SparkSession, source: str, chain: list[tuple[str, Callable[[DataFrame], DataFrame]]], root: str, interval: str = "once", schema=None, files: int = BATCH_FILES) -> list:
    """Start a stage for each (name, function), each reading what the one before has published.

    The first one reads the files of ``source`` by name, so unreadable ones are set aside (``<root>/<name>.unreadable``); every stage publishes in
    ``<root>/<name>``, keeps its checkpoint in ``<root>/<name>.checkpoint`` and batches of mixed streams in ``<root>/<name>.rejected``. With the interval ``once`` the stages
    run one after the other over what is there; with others all run on, each taking up what the one before publishes.
    """
    out, before = [], source
    for i, (name, stage) in enumerate(chain):
        here = f"{root}/{name}"
        # a stream needs its folder, which a stage without batches has not made yet
        make = spark._jvm.org.apache.hadoop.fs.Path(before)
        make.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(make)
        read = lambda paths: read_flows(spark, *paths) if schema is None else spark.read.schema(schema).parquet(*paths)
        names = file_names(spark, before, files) if i == 0 else file_names(spark, before, files, "part-*.parquet")
        query = start(names, staged_files(stage, read, here, f"{here}.rejected", f"{here}.unreadable"), f"{here}.checkpoint", interval)
        if interval == "once":
            query.awaitTermination()
        out.append(query)
        before = here
    return out
