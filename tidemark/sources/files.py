"""Reading flow tables: batches, partitioned stores, streams of files, raw records, rule lists."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schema import flow_schema, signed, upgrade

#: Files in a micro-batch.
BATCH_FILES = 1024


def read_flows(spark: SparkSession, *paths: str, strict: bool = False) -> DataFrame:
    """One table of one or more Parquet paths; ``strict`` applies the flow schema (for files with UUID ids)."""
    reader = spark.read.schema(flow_schema()) if strict else spark.read.option("mergeSchema", "true")
    return upgrade(signed(reader.parquet(*dict.fromkeys(paths))))


def read_directories(spark: SparkSession, entries: list[dict]) -> DataFrame:
    """``[{"input": folder}]``, repeated ones once."""
    return read_flows(spark, *[e["input"] for e in entries])


def read_store(spark: SparkSession, root: str, **parts: int) -> DataFrame:
    """A partitioned store; year=, month=, day=, hour= prune partitions."""
    df = spark.read.parquet(root)
    for name, value in parts.items():
        df = df.where(F.col(name) == value)
    return df


def stream_flows(spark: SparkSession, path: str, schema=None, archive: str | None = None, delete: bool = False, files: int = BATCH_FILES) -> DataFrame:
    """New files of a folder in micro-batches; used ones are archived, deleted or left. Names with a leading dot are skipped."""
    reader = spark.readStream.schema(schema or flow_schema()).option("maxFilesPerTrigger", files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    elif delete:
        reader = reader.option("cleanSource", "delete")
    return reader.parquet(path)


def read_raw(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Decoded flow records from Parquet or JSON lines."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.json(path) if path.rstrip("/").endswith((".json", ".jsonl")) else reader.parquet(path)


def observation_of(path: Column) -> Column:
    """The text before the first dash of a file's base name; null without a dash."""
    base = F.element_at(F.split(path, "/"), -1)
    return F.when(base.contains("-"), F.regexp_extract(base, r"^([^-]*)-", 1))


def with_observation(df: DataFrame, default: str) -> DataFrame:
    return df.withColumn("observation", F.coalesce(observation_of(F.input_file_name()), F.lit(default)))


def read_list(spark: SparkSession, path: str) -> list[dict]:
    """A rule list: a JSON array or JSON lines, from any file system that Spark knows. Lists are small by nature."""
    text = "\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect()).strip()
    return json.loads(text) if text.startswith("[") else [json.loads(x) for x in text.splitlines() if x.strip()]
