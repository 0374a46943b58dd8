"""Upkeep of a warehouse: few folders per month, nothing left behind.

``compact`` packs the small folders that closed runs have left for a month into
folders of about ``BatchConfig.compacted_bytes``: the fact, the raw marts and
the partial totals of the packed runs are written under a run id of their own.
One append to the run events then makes the new folders count and the old ones
not; before it nothing has changed, after it the old folders are only garbage.
``vacuum`` deletes what a compaction has replaced and what dead runs have left,
except raw-mart folders that a kept snapshot still names, and notes it. Of a run
whose months the next run has yet to correct, it keeps the run events.
Both are safe to repeat after a crash at any step.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from tillroll.operators import ledger
from tillroll.plans import batch, runs
from tillroll.plans.batch import RAW_MARTS, TOTALS, BatchConfig
from tillroll.schemas import SNAPSHOT
from tillroll.sinks import writers


def folder_bytes(spark: SparkSession, folder: str) -> int:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def pack(sizes: dict[str, int], target: int) -> list[list[str]]:
    """Bins of at least two runs and about ``target`` bytes, smallest folders
    first; folders of the target's size stay as they are."""
    bins, open_bin, filled = [], [], 0
    for run, size in sorted(sizes.items(), key=lambda kv: (kv[1], kv[0])):
        if size >= target:
            break
        if open_bin and filled + size > target:
            bins.append(open_bin)
            open_bin, filled = [], 0
        open_bin.append(run)
        filled += size
    return [b for b in [*bins, open_bin] if len(b) > 1]


def plan(spark: SparkSession, cfg: BatchConfig, book: runs.Book) -> dict[int, dict]:
    """Bins of the months with more than ``max_folders`` folders: bin number
    -> month -> runs. Bins of one number share a run id."""
    months: dict = {}
    for run, month in book.live():
        months.setdefault(month, []).append(run)
    out: dict[int, dict] = {}
    for month, members in months.items():
        if len(members) > cfg.max_folders:
            sizes = {r: folder_bytes(spark, batch.fact_folder(cfg, r, month)) for r in members}
            for k, packed in enumerate(pack(sizes, cfg.compacted_bytes)):
                out.setdefault(k, {})[month] = packed
    return out


def _merge(spark: SparkSession, cfg: BatchConfig, run_id: str, packed: dict, book: runs.Book, dims: batch.DimensionKeys) -> list[tuple]:
    """Write the folders of one compaction run; returns its events."""
    keys = dims.version
    pairs = [(r, m) for m, members in packed.items() for r in members]
    rows = batch._fact_rows(spark, cfg, pairs).drop("run_id")
    writers.write_partitioned(rows, f"{cfg.path('fact')}/run_id={run_id}/bad=0", ["sales_month"], dynamic=False)
    raw = [(r, m) for r, m in pairs if book.has(r, m, runs.RAW)]
    for name, cols in RAW_MARTS.items():
        if raw:
            old = batch.raw_mart_rows(spark, cfg, name, raw)
            writers.write_partitioned(old, f"{cfg.path('marts')}/{name}/run_id={run_id}", cols, dynamic=False)
    batch.complete_totals(spark, cfg, pairs, book, dims)
    totals = [(r, m) for r, m in pairs if book.has(r, m, runs.with_totals(keys))]
    for name in TOTALS:
        if totals:
            merged = batch.read_totals(spark, cfg, name, keys, totals)
            writers.write_partitioned(merged, f"{batch.totals_base(cfg, name, keys)}/run_id={run_id}", ["sales_month"], dynamic=False)
    has_raw, has_totals = {m for _, m in raw}, {m for _, m in totals}
    return ([(run_id, m, runs.COMPACTED) for m in packed] + [(run_id, m, runs.RAW) for m in has_raw]
            + [(run_id, m, runs.with_totals(keys) if m in has_totals else runs.without_totals(keys)) for m in packed]
            + [(r, m, runs.SUPERSEDED) for r, m in pairs])


def compact(spark: SparkSession, cfg: BatchConfig) -> int:
    """Pack small folders of closed runs; the number of folders replaced."""
    with batch.writer_of(cfg):
        book = runs.load(spark, cfg)
        bins = plan(spark, cfg, book)
        if not bins:
            return 0
        dims = batch.dimension_keys(cfg)
        events = []
        for k, packed in bins.items():
            events += _merge(spark, cfg, f"compact-{uuid.uuid4().hex}-{k}", packed, book, dims)
        batch._step(cfg, "switch")
        # The one append that makes the new folders count instead of the old.
        runs.note(spark, cfg, book, events)
        batch._step(cfg, "switched")
        if cfg.snapshots:
            months = sorted({m for packed in bins.values() for m in packed}, key=str)
            for name in RAW_MARTS:
                batch.write_snapshot(spark, cfg, name, months, book)
        return sum(state == runs.SUPERSEDED for _, _, state in events)


def vacuum(spark: SparkSession, cfg: BatchConfig) -> int:
    """Delete folders that no longer count; the number of (run, month) or run
    folders done with. A folder that a kept snapshot names waits for its expiry."""
    with batch.writer_of(cfg):
        book = runs.load(spark, cfg)
        named: set = set()
        for name in RAW_MARTS:
            base = cfg.path(f"snapshots/{name}")
            for sid in writers.snapshot_ids(spark, base):
                named |= {(r["run_id"], r["sales_month"]) for r in writers.read_manifest(spark, base, SNAPSHOT, sid).collect()}
        done = []
        for run, month in book.superseded():
            if (run, month) in named:
                continue
            for state in sorted(book.of_month[run][month]):
                if state.startswith("T:"):
                    for name in TOTALS:
                        writers.delete_folder(spark, batch.totals_folder(cfg, name, state[2:], run, month))
            for name in RAW_MARTS:
                writers.delete_folder(spark, batch.raw_folder(cfg, name, run, month))
            writers.delete_folder(spark, batch.fact_folder(cfg, run, month))
            done.append((run, month, runs.DELETED))
        held, given_up = {r for r, _ in named}, book.given_up()
        for run in given_up + sorted(book.dead()):
            keys = {s[2:] for states in book.of_month.get(run, {}).values() for s in states if s.startswith("T:")}
            # No snapshot names its fact and totals, and nothing reads them.
            for folder in ([f"{cfg.path('fact')}/run_id={run}"] + [f"{cfg.path('marts')}/{n}/run_id={run}" for n in RAW_MARTS if run not in held]
                           + [f"{batch.totals_base(cfg, n, k)}/run_id={run}" for n in TOTALS for k in keys]):
                writers.delete_folder(spark, folder)
            if run in given_up and run not in held:
                done.append((run, None, runs.CLEARED))
        batch._step(cfg, "deleted")
        runs.note(spark, cfg, book, done)
        return len(done)


def upkeep(spark: SparkSession, cfg: BatchConfig) -> None:
    """Compaction, vacuum and checkpoints: run it between batch runs."""
    compact(spark, cfg)
    vacuum(spark, cfg)
    with batch.writer_of(cfg):
        ledger.log(cfg.path("ledger")).maintain(spark, cfg.checkpoint_every)
        runs.log(cfg).maintain(spark, cfg.checkpoint_every)
