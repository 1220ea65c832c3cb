"""Tables kept in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a table that may be broadcast; beyond it joins shuffle.
BROADCAST_ROWS = 1_000_000


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where it is unset, a temporary folder for a local master, else an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = f"file://{tempfile.mkdtemp(prefix='tidemark-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def kept(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the table: its lineage ends here.

    The tables of an application stand in one folder, which may go when the application has ended.
    """
    path = f"{shared_dir(df.sparkSession)}/tidemark-{df.sparkSession.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``rows`` rows."""
    return df.limit(rows + 1).count() <= rows


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows, else as it is."""
    return F.broadcast(df) if fits(df, rows) else df
