"""What the runs of the batch job have written: the warehouse's own book.

Facts, raw marts and partial totals lie in folders by run and month. The run
events (``schemas.RUN_EVENTS``, an :class:`EventLog`) name these folders, so no
tree is ever listed; one row per run and month, kept few by compaction, reaches
the driver. Events have no order: a state once noted stays.

Besides the states of ``RUN_EVENTS`` a month of a run may be noted with ``R``
(raw mart folders exist), ``T:<keys>`` (partial totals exist for that version of the
dimensions' keys) and ``N:<keys>`` (computed, but every sale was lost in the joins).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import ledger
from tillroll.operators.eventlog import EventLog
from tillroll.schemas import RUN_EVENTS, STATUS_INACTIVE

WRITTEN, COMPACTED, SUPERSEDED, DELETED = "W", "K", "D", "V"
CLOSED, GIVEN_UP, EMPTY, BAD_ROWS, CLEARED, RAW = "C", "X", "E", "B", "Z", "R"


def with_totals(keys: str) -> str:
    return f"T:{keys}"


def without_totals(keys: str) -> str:
    return f"N:{keys}"


def compact(events: DataFrame) -> DataFrame:
    """Events without repeats and without what is deleted."""
    events = events.distinct()
    cleared = events.where(F.col("state") == CLEARED).select(F.col("run_id").alias("__r")).distinct()
    closed = events.where(F.col("state") == CLOSED).select(F.col("run_id").alias("__r")).distinct()
    gone = cleared.join(closed, "__r", "left_anti")
    kept = events.join(gone, F.col("run_id") == F.col("__r"), "left_anti")
    deleted = kept.where(F.col("state") == DELETED).select(F.col("run_id").alias("__r"), F.col("sales_month").alias("__m"))
    of_month = F.col("state").isin(WRITTEN, COMPACTED, SUPERSEDED, DELETED, RAW) | F.col("state").rlike("^[TN]:")
    return kept.join(deleted, of_month & (F.col("run_id") == F.col("__r")) & F.col("sales_month").eqNullSafe(F.col("__m")), "left_anti")


def log(cfg) -> EventLog:
    return EventLog(cfg.path("runs"), RUN_EVENTS, compact)


def note(spark: SparkSession, cfg, book: Book, rows: list[tuple]) -> None:
    """Append events, and enter them in ``book``."""
    if rows:
        log(cfg).append(spark.createDataFrame(rows, RUN_EVENTS).coalesce(1))
        book.enter(rows)


def next_try(run_id: str, tries: list[str]) -> str:
    """The id under which a run writes: its own, or a new one per repetition."""
    return f"{run_id}~{len(tries)}" if tries else run_id


@dataclass
class Book:
    """The run events, by run and month."""
    of_run: dict[str, set] = field(default_factory=dict)      # run -> its own states
    of_month: dict[str, dict] = field(default_factory=dict)   # run -> month -> states
    closed: set = field(default_factory=set)

    def enter(self, rows) -> None:
        for run, month, state in rows:
            if state in (CLOSED, GIVEN_UP, EMPTY, BAD_ROWS, CLEARED):
                self.of_run.setdefault(run, set()).add(state)
            else:
                self.of_month.setdefault(run, {}).setdefault(month, set()).add(state)

    def _counts(self, run: str, this_run: str | None) -> bool:
        return run in self.closed or run == this_run

    def tries(self, run_id: str) -> list[str]:
        """What is noted of a run id: its first try and its repetitions."""
        return [r for r in self.of_run.keys() | self.of_month.keys() if r == run_id or r.startswith(f"{run_id}~")]

    def live(self, this_run: str | None = None) -> list[tuple[str, str | None]]:
        """(run, month) of every folder that counts."""
        out = []
        for run, months in self.of_month.items():
            for month, states in months.items():
                if SUPERSEDED not in states and DELETED not in states and (
                        COMPACTED in states or WRITTEN in states and self._counts(run, this_run)):
                    out.append((run, month))
        return sorted(out, key=str)

    def dead(self, this_run: str | None = None) -> dict[str, set]:
        """Months of every run that died before closing and was not given up."""
        out = {}
        for run in self.of_run.keys() | self.of_month.keys():
            months = {m for m, s in self.of_month.get(run, {}).items() if WRITTEN in s}
            states = self.of_run.get(run, set())
            if (months or EMPTY in states) and not self._counts(run, this_run) and GIVEN_UP not in states:
                out[run] = months
        return out

    def superseded(self) -> list[tuple[str, str | None]]:
        """Folders that a compaction has replaced and that still lie there."""
        return sorted(((run, m) for run, months in self.of_month.items() for m, s in months.items()
                       if SUPERSEDED in s and DELETED not in s), key=str)

    def given_up(self) -> list[str]:
        """Dead runs whose folders still lie there."""
        return sorted(r for r, s in self.of_run.items() if GIVEN_UP in s and CLEARED not in s and r not in self.closed)

    def has(self, run: str, month: str | None, state: str) -> bool:
        return state in self.of_month.get(run, {}).get(month, set())


def load(spark: SparkSession, cfg) -> Book:
    """The book as it stands. A run counts once its files are closed in the
    ledger; only for runs not yet noted as closed is the ledger asked."""
    book = Book()
    book.enter(log(cfg).read(spark).select("run_id", "sales_month", "state").collect())
    book.closed = {r for r, s in book.of_run.items() if CLOSED in s}
    compacted = {r for r, months in book.of_month.items() if any(COMPACTED in s for s in months.values())}
    unsure = (book.of_run.keys() | book.of_month.keys()) - book.closed - compacted
    book.closed |= closed_in_ledger(spark, cfg, sorted(unsure))
    return book


def closed_in_ledger(spark: SparkSession, cfg, runs: list[str]) -> set[str]:
    """Which of ``runs`` have closed files in the ledger."""
    if not runs:
        return set()
    events = ledger.read(spark, cfg.path("ledger")).where((F.col("status") == STATUS_INACTIVE) & F.col("run_id").isin(runs))
    return {r["run_id"] for r in events.select("run_id").distinct().collect()}
