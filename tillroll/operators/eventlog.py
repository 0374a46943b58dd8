"""Append-only event tables that are compacted: a checkpoint and a tail.

A table of events lives below one folder::

    events/epoch=<n>/<append>/     one folder per append since checkpoint n
    checkpoints/n=<n>/             everything before, compacted

An append is one Spark write to a folder of its own; readers take it only when
its ``_SUCCESS`` file is there, so an append counts whole or not at all. A
checkpoint is written the same way, and its number names the epoch that later
appends go to: once it is complete, readers need just it and the appends after
it, however long the table's history is. A checkpoint that was cut short is not
seen and is written again. One writer at a time is assumed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Appends after which ``maintain`` writes a checkpoint.
CHECKPOINT_EVERY = 32
_DONE = "_SUCCESS"
_MARK = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "true"}


@dataclass(frozen=True)
class EventLog:
    path: str
    schema: StructType
    # Fewer events with the same meaning (for what the table is used for).
    compact: Callable[[DataFrame], DataFrame]

    def _children(self, spark: SparkSession, folder: str, done: bool = False) -> list[str]:
        """Names of the folders in ``folder``; with ``done`` only complete ones."""
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        found = [s.getPath() for s in fs.listStatus(path) if s.isDirectory()]
        kept = [p for p in found if not done or fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, _DONE))]
        return sorted(p.getName() for p in kept)

    def _is_file(self, spark: SparkSession) -> bool:
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        return fs.exists(path) and fs.getFileStatus(path).isFile()

    def checkpoint_number(self, spark: SparkSession) -> int:
        """The newest complete checkpoint, 0 before the first."""
        return max((int(name[2:]) for name in self._children(spark, "checkpoints", done=True)), default=0)

    def tail(self, spark: SparkSession, n: int | None = None) -> list[str]:
        """Folders of the appends since checkpoint ``n`` (the newest)."""
        n = self.checkpoint_number(spark) if n is None else n
        return [f"{self.path}/events/epoch={n}/{name}" for name in self._children(spark, f"events/epoch={n}", done=True)]

    def read(self, spark: SparkSession) -> DataFrame:
        """Checkpoint and tail; empty before the first append."""
        if self._is_file(spark):
            return spark.read.schema(self.schema).parquet(self.path)  # no event table: let the reader say so
        n = self.checkpoint_number(spark)
        folders = ([f"{self.path}/checkpoints/n={n}"] if n else []) + self.tail(spark, n)
        if not folders:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*folders)

    def append(self, events: DataFrame) -> None:
        spark = events.sparkSession
        folder = f"{self.path}/events/epoch={self.checkpoint_number(spark)}/{uuid.uuid4().hex}"
        events.hint("rebalance").write.options(**_MARK).parquet(folder)

    def checkpoint(self, spark: SparkSession) -> int:
        """Write the next checkpoint; what the one before the last needed goes."""
        n = self.checkpoint_number(spark)
        self.compact(self.read(spark)).hint("rebalance").write.mode("overwrite").options(**_MARK).parquet(
            f"{self.path}/checkpoints/n={n + 1}")
        # Readers that have just listed epoch n still find it.
        for folder, name, number in ([("checkpoints", c, int(c[2:])) for c in self._children(spark, "checkpoints")]
                                     + [("events", e, int(e[6:])) for e in self._children(spark, "events")]):
            if number < n:
                path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}/{name}")
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        return n + 1

    def maintain(self, spark: SparkSession, every: int = CHECKPOINT_EVERY) -> None:
        """A checkpoint once the tail holds ``every`` appends."""
        if len(self.tail(spark)) >= every:
            self.checkpoint(spark)
