"""A ledger of what a stage has published: each batch's rows appear once, whatever is repeated, cut off or started anew.

A batch writes to a hidden folder of its own. One rename of a small file then enters it into the ledger, with its run (the
stream's checkpoint), number and inputs: that is the moment it counts. Afterwards its folders move to visible names; whoever opens the ledger next
finishes what a crash left between the two. A batch whose number its run has entered is not written again, and inputs that any run has entered are left
out, so a new checkpoint over old files adds nothing. Readers and following streams see visible folders only.

The file system must rename whole folders and files at once, as Hadoop's and local ones do.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRY = "run string, batch bigint, seq bigint, token string, folders array<string>, inputs array<string>, note map<string,string>"
LEDGER, WRITING = "_ledger", "_writing"


class Ledger:
    """The ledger of the folder ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        path = self._path(f"{self.root}/{folder}")
        return sorted(x.getPath().getName() for x in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def _exists(self, name: str) -> bool:
        return self._fs.exists(self._path(f"{self.root}/{name}"))

    @staticmethod
    def _name(run: str, batch: int) -> str:
        return f"{run}-{batch:012d}.json"

    def has(self, run: str, batch: int) -> bool:
        return self._exists(f"{LEDGER}/{self._name(run, batch)}")

    def entries(self) -> DataFrame:
        """One row an entry, read by Spark."""
        if not self._names(LEDGER):
            return self.spark.createDataFrame([], ENTRY)
        return self.spark.read.schema(ENTRY).json(f"{self.root}/{LEDGER}")

    def last(self) -> dict | None:
        """The newest entry."""
        found = self.entries().orderBy(F.desc("seq")).limit(1).collect()
        return found[0].asDict() if found else None

    def consumed(self, inputs: list[str]) -> set[str]:
        """Those of a batch's inputs that an entry names."""
        if not inputs:
            return set()
        mine = self.spark.createDataFrame([(i,) for i in inputs], "input string")  # the files of one batch
        used = self.entries().select(F.explode("inputs").alias("input")).join(F.broadcast(mine), "input").distinct()
        return {r["input"] for r in used.collect()}

    def recover(self) -> None:
        """Finish the moves of entries that a crash left; drop what was never entered."""
        waiting = {n.split(".", 1)[0] for n in self._names(WRITING)}
        if not waiting:
            return
        for e in self.entries().where(F.col("token").isin(*waiting)).collect():
            self._move(e["token"], list(e["folders"]), int(e["seq"]))
        self._fs.delete(self._path(f"{self.root}/{WRITING}"), True)

    def _move(self, token: str, folders: list[str], seq: int) -> None:
        for folder in folders:
            here, there = self._path(f"{self.root}/{WRITING}/{token}/{_inner(folder)}"), self._path(f"{self.root}/{folder}/batch={seq}")
            if self._fs.exists(here):
                self._fs.mkdirs(there.getParent())
                if not self._fs.rename(here, there):
                    raise OSError(f"{here} could not be renamed to {there}")
        self._fs.delete(self._path(f"{self.root}/{WRITING}/{token}"), True)

    def publish(self, run: str, batch: int, tables: dict[str, DataFrame], inputs: list[str] = (), note: dict[str, str] | None = None) -> bool:
        """Write tables (folder below the root, ``.`` for the root itself, to rows) and enter them; False if the run has entered the batch.

        One stage at a time writes to a root.
        """
        self.recover()
        if self.has(run, batch):
            return False
        token = uuid.uuid4().hex
        for folder, rows in tables.items():
            rows.write.parquet(f"{self.root}/{WRITING}/{token}/{_inner(folder)}")
        last = self.last()
        self._enter({"run": run, "batch": batch, "seq": last["seq"] + 1 if last else 0, "token": token, "folders": list(tables), "inputs": list(inputs), "note": note or {}})
        return True

    def _enter(self, entry: dict) -> None:
        written = self._path(f"{self.root}/{WRITING}/{entry['token']}.json")
        out = self._fs.create(written, True)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        self._fs.mkdirs(self._path(f"{self.root}/{LEDGER}"))
        if not self._fs.rename(written, self._path(f"{self.root}/{LEDGER}/{self._name(entry['run'], entry['batch'])}")):
            raise OSError(f"batch {entry['batch']} of {entry['run']} could not be entered")
        self._move(entry["token"], entry["folders"], entry["seq"])

    def forget(self, folder: str, seqs: list[int]) -> None:
        """Delete published folders that newer ones replace; their entries stay."""
        for seq in seqs:
            self._fs.delete(self._path(f"{self.root}/{folder}/batch={seq}"), True)

    def published(self, folder: str = ".") -> list[int]:
        """Numbers of the published folders that are there."""
        return sorted(int(n.split("=", 1)[1]) for n in self._names(folder) if n.startswith("batch="))

    def read(self, folder: str = ".", seqs: list[int] | None = None) -> DataFrame | None:
        """The published rows, or those of some entries; None without any."""
        self.recover()
        found = [s for s in self.published(folder) if seqs is None or s in seqs]
        return self.spark.read.parquet(*[f"{self.root}/{folder}/batch={s}" for s in found]) if found else None


def _inner(folder: str) -> str:
    """Where a table stands while it is written."""
    return "rows" if folder == "." else folder


def run_of(batch: DataFrame) -> str:
    """The id of the stream that a batch is of, which its checkpoint keeps; ``direct`` outside a stream."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"


def with_inputs(batch: DataFrame) -> DataFrame:
    """The batch with the file that each row was read from (empty for other sources)."""
    return batch.withColumn("_input", F.input_file_name())


def fresh(ledger: Ledger, batch: DataFrame) -> tuple[DataFrame, list[str]]:
    """The rows of a batch whose files no entry names, and these files."""
    inputs = sorted(r["_input"] for r in batch.select("_input").distinct().collect() if r["_input"])  # the files of one batch
    known = ledger.consumed(inputs)
    rows = batch.where(~F.col("_input").isin(*known)) if known else batch
    return rows.drop("_input"), [i for i in inputs if i not in known]


# ---------------------------------------------------------------- streams of file names


def file_names(spark: SparkSession, folder: str, files: int = 1024, glob: str = "*.parquet") -> DataFrame:
    """A stream of the names of new files; their content is read by the stage, so that an unreadable one does not end the stream."""
    return spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files).load(folder).select("path")


def _error(read: Callable[[list[str]], DataFrame], paths: list[str]) -> str | None:
    try:
        read(paths).write.format("noop").mode("overwrite").save()
    except Exception as e:  # whatever the reader says of these files is what is reported
        return str(e).strip().splitlines()[0][:500]
    return None


def unreadable(read: Callable[[list[str]], DataFrame], paths: list[str]) -> dict[str, str]:
    """The files that cannot be read, with their errors, found by halving."""
    error = _error(read, paths)
    if error is None:
        return {}
    if len(paths) == 1:
        return {paths[0]: error}
    half = len(paths) // 2
    return unreadable(read, paths[:half]) | unreadable(read, paths[half:])
