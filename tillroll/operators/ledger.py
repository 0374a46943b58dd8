"""Append-only file ledger.

The ledger is a table of events ``(file_name, file_location, modified,
length, status, event_ts, run_id, seq)``. A run appends ``A`` for every file
it takes (open) and ``I`` for each of them once all sinks succeeded (close);
``R`` marks a file that the contract rejected. The state of a file is its
latest event, by ``(event_ts, seq)``; times are instants, so sessions
in different time zones agree. No row is ever updated in place, so the ledger
can live in plain Parquet on any store; its history is compacted into checkpoints
(``eventlog``), so reading it costs one checkpoint and the events since.

The key of a file is its location with its modification time and length: two
drops may share a base name, and a file delivered again under the same name
is a new file.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.eventlog import EventLog
from tillroll.schemas import FILE_LEDGER, STATUS_ACTIVE, STATUS_INACTIVE, STATUS_REJECTED

KEY = ["file_location", "modified", "length"]


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], FILE_LEDGER)


def new_run_id() -> str:
    return uuid.uuid4().hex


def _keyed(files: DataFrame) -> DataFrame:
    """Ledger key columns of a manifest (or of frames that already have them)."""
    have = files.columns
    loc = F.col("file_location") if "file_location" in have else F.col("path")
    modified = F.col("modified") if "modified" in have else F.col("modificationTime") if "modificationTime" in have else F.lit(None)
    length = F.col("length") if "length" in have else F.lit(None)
    name = F.col("file_name") if "file_name" in have else F.element_at(F.split(loc, "/"), -1)
    return files.select("*", name.alias("__name"), loc.alias("__loc"), modified.cast("timestamp").alias("__mod"),
                        length.cast("bigint").alias("__len"))


def events(files: DataFrame, status: str, run_id: str, seq: int, ts: Column | None = None) -> DataFrame:
    """One ledger event per row of ``files`` (``path`` or ``file_location``,
    and where known ``modificationTime``, ``length`` and ``file_name``)."""
    when = (ts if ts is not None else F.current_timestamp()).cast("timestamp")
    return _keyed(files.withColumn("__ts", when)).select(
        F.col("__name").alias("file_name"), F.col("__loc").alias("file_location"), F.col("__mod").alias("modified"),
        F.col("__len").alias("length"), F.lit(status).alias("status"), F.col("__ts").alias("event_ts"),
        F.lit(run_id).alias("run_id"), F.lit(seq).cast("bigint").alias("seq"))


def open_files(files: DataFrame, run_id: str, ts: Column | None = None) -> DataFrame:
    """L1: status ``A`` for every file the run takes."""
    return events(files, STATUS_ACTIVE, run_id, 1, ts)


def close_files(files: DataFrame, run_id: str, ts: Column | None = None) -> DataFrame:
    """L2: status ``I`` once every sink of the run has succeeded."""
    return events(files, STATUS_INACTIVE, run_id, 2, ts)


def reject_files(files: DataFrame, run_id: str, ts: Column | None = None) -> DataFrame:
    """Status ``R`` for a file in quarantine: not taken again until redelivered."""
    return events(files, STATUS_REJECTED, run_id, 2, ts)


def log(ledger_path: str) -> EventLog:
    return EventLog(ledger_path.rstrip("/"), FILE_LEDGER, compact_events)


def append(ledger_events: DataFrame, ledger_path: str) -> None:
    log(ledger_path).append(ledger_events)


def read(spark: SparkSession, ledger_path: str) -> DataFrame:
    """The ledger's events, from its newest checkpoint on, or an empty ledger
    when nothing was written yet."""
    return log(ledger_path).read(spark)


def compact_events(ledger: DataFrame) -> DataFrame:
    """At most three events per file that give the same state: the first
    ``A``, the last ``I`` and the latest event."""
    code = F.array_position(F.array(*map(F.lit, _CODES)), F.col("status"))
    event = F.struct("event_ts", F.pmod("seq", F.lit(16)).alias("place"), code.alias("code"), "status", "run_id", "seq", "file_name")
    per_file = ledger.groupBy(*KEY).agg(
        F.min(F.when(F.col("status") == STATUS_ACTIVE, event)).alias("first"),
        F.max(F.when(F.col("status") == STATUS_INACTIVE, event)).alias("closed"), F.max(event).alias("last"))
    kept = F.array_distinct(F.filter(F.array("first", "closed", "last"), lambda e: e.isNotNull()))
    return per_file.select(*KEY, F.explode(kept).alias("e")).select(
        "e.file_name", *KEY, "e.status", "e.event_ts", "e.run_id", "e.seq").select(*FILE_LEDGER.fieldNames())


# Order of the states in the packed event below.
_CODES = [STATUS_ACTIVE, STATUS_REJECTED, STATUS_INACTIVE]


def current_state(ledger: DataFrame) -> DataFrame:
    """L4: one row per file: latest status, first ``A`` time
    (``created_date``) and last ``I`` time (``updated_date``). The latest
    event is one number (microseconds, seq, status), so the aggregation keeps
    fixed-width values in a hash table and sums up map-side: no sort, and a
    file with many events never gathers them in one place."""
    code = F.array_position(F.array(*map(F.lit, _CODES)), F.col("status")) - 1
    packed = F.unix_micros("event_ts") * 64 + F.pmod(F.col("seq"), F.lit(16)) * 4 + code
    name = F.url_decode(F.replace(F.element_at(F.split("file_location", "/"), -1), F.lit("+"), F.lit("%2B")))
    state = ledger.groupBy(*KEY).agg(
        F.max(packed).alias("__last"),
        F.min(F.when(F.col("status") == STATUS_ACTIVE, F.col("event_ts"))).alias("created_date"),
        F.max(F.when(F.col("status") == STATUS_INACTIVE, F.col("event_ts"))).alias("updated_date"))
    return state.select(*KEY, name.alias("file_name"),
                        F.element_at(F.array(*map(F.lit, _CODES)), (F.pmod("__last", F.lit(4)) + 1).cast("int")).alias("status"),
                        "created_date", "updated_date")


def files_in_state(ledger: DataFrame, manifest: DataFrame, status: str) -> DataFrame:
    """Which of the manifest's files are currently in ``status``
    (distinct names; a semi join, so the manifest is not multiplied)."""
    m = _keyed(manifest).select("__loc", "__mod", "__len")
    state = current_state(ledger).where(F.col("status") == status)
    cond = ((m["__loc"] == state["file_location"]) & m["__mod"].eqNullSafe(state["modified"])
            & m["__len"].eqNullSafe(state["length"]))
    return state.join(m, cond, "left_semi").select("file_name", "file_location").distinct()


def unfinished(ledger: DataFrame, manifest: DataFrame) -> DataFrame:
    """L3: files present again whose state is still ``A``: the run that took
    them died before closing, so they are processed again."""
    return files_in_state(ledger, manifest, STATUS_ACTIVE)


def pending(manifest: DataFrame, ledger: DataFrame) -> DataFrame:
    """L5 (batch form): the manifest minus files already closed (``I``) or
    rejected (``R``). Files in state ``A`` stay in: they are re-run."""
    done = (current_state(ledger).where(F.col("status").isin(STATUS_INACTIVE, STATUS_REJECTED))
            .select("file_location", "modified", F.col("length")))
    out = _keyed(manifest)
    cond = ((out["__loc"] == done["file_location"]) & out["__mod"].eqNullSafe(done["modified"])
            & out["__len"].eqNullSafe(done["length"]))
    return out.join(done, cond, "left_anti").select(*manifest.columns)
