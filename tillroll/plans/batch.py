"""The batch job: manifest -> contract -> fact -> marts -> ledger close.

Order of a run (each step a Spark job over DataFrames):

1. discover the landing roots (S4; given, or the active ones of a source
   registry, S7) and drop files already closed or rejected in the ledger
   (L5); files still in state ``A`` are taken again (L3);
2. check the contract (S2, S5, V1-V4), quarantine rejected files (V3) and
   note them in the ledger;
3. open the accepted files in the ledger (L1);
4. read, conform and union them (S1, P1-P3, U1) and write this run's part of
   the fact, ``fact/run_id=../bad=../sales_month=..``: good and bad rows from
   one parse; note the run's months;
5. enrich this run's rows (J1-J4) and write, once each, its part of the raw
   marts (K1, K2) and its partial totals per key and month (4 and 5 in slices
   of bounded bytes, so that shuffle files and staged rows do not grow with the run);
6. merge the partial totals of the months that this run, or a run that died
   before closing, has touched, and replace just those months of the marts,
   emptied ones included (A1, A2, K2). The top seller of a month is decided
   anew from the merged totals, so an earlier winner loses the incentive;
7. write the snapshots (K4: a list of the raw marts' folders), the CSV export
   (K5) and the JDBC sink when configured (K3, marked as a snapshot when
   complete), the latter two from the marts just written;
8. close the run and its files (L2) only after every sink succeeded.

No refresh reads another run's rows: what runs have in common is summed from
their totals. Totals belong to a version of the dimensions' keys; when the keys
change, totals of the months that a refresh needs are made again from the fact.
Raw marts hold a run's rows as enriched when the run was loaded.

Everything by run is found through the run events (``runs``), never by listing.
A run that died leaves its files in state ``A``; the next run takes them again
under its own id, refreshes the dead run's months too, and gives it up (X). A
run that is repeated under the same id (a replayed micro-batch) writes as a new
try with folders of its own; an id that has closed files is never used again. One writer at a time works
on a warehouse: runs of one driver wait for each other; across drivers the
scheduler must see to it. ``upkeep`` keeps folders and events few.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor, wait
from contextlib import AbstractContextManager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.errors import NoInputError, RunClosedError, SinkError
from tillroll.functions.columns import month_bucket
from tillroll.operators import contract, enrich, ledger, marts
from tillroll.operators.eventlog import CHECKPOINT_EVERY
from tillroll.operators.sizing import load_profile, raise_on_duplicates, small_sides
from tillroll.plans import runs
from tillroll.schemas import (CUSTOMER_MONTHLY, CUSTOMER_TOTALS, SALE, SALE_COLUMNS, SALES_TEAM_MONTHLY,
                              SELLER_TOTALS, SNAPSHOT)
from tillroll.session import free_shuffles, staged, staged_meanwhile
from tillroll.sinks import writers
from tillroll.sources import files


@dataclass
class BatchConfig:
    landing: list[str] | DataFrame        # roots, or a source registry (S7)
    warehouse: str
    customer: DataFrame
    store: DataFrame
    sales_team: DataFrame
    jdbc: dict | None = None              # {"url", "properties", "customer_table", "sales_team_table"}
    snapshots: bool = True
    csv_export: bool = True
    keep_snapshots: int = 30              # older manifests expire
    max_folders: int = 16                 # of one month, by run; compacted above
    compacted_bytes: int = 1 << 30        # a compacted folder's size, about
    read_bytes: int = 2 << 30             # of accepted files shuffled at a time
    enriched_bytes: int = 256 << 20       # of a run's fact enriched at a time
    checkpoint_every: int = CHECKPOINT_EVERY  # appends to the ledger and to the run events
    # Test hook: called with a step name before that step runs.
    fail_at: Callable[[str], None] | None = field(default=None, repr=False)

    def roots(self) -> list[str]:
        return self.landing if isinstance(self.landing, list) else files.active_roots(self.landing)

    def path(self, name: str) -> str:
        return f"{self.warehouse.rstrip('/')}/{name}"


# Database tables of the marts (the original's names).
JDBC_TABLES = {"customer_monthly": "customers_data_mart", "sales_team_monthly": "sales_team_data_mart"}
FACT_PARTITIONS = ["bad", "sales_month"]
BAD_FIELDS = [T.StructField("source_file", T.StringType()), T.StructField("record", T.StringType()),
              T.StructField("parsed", T.StringType())]
FACT = T.StructType(SALE.fields + BAD_FIELDS + [T.StructField("run_id", T.StringType()), T.StructField("bad", T.IntegerType()),
                                                T.StructField("sales_month", T.StringType())])


def run_concurrently(actions: dict[str, Callable[[], None]]) -> None:
    """Run independent Spark actions as concurrent jobs (one driver thread
    each) and wait for all of them. Any failure is raised as a
    :class:`SinkError` after the others finish, so the run stops before the
    ledger is closed and the next run redoes every sink."""
    with ThreadPoolExecutor(max_workers=max(1, len(actions)), thread_name_prefix="sink") as pool:
        futures = {name: pool.submit(fn) for name, fn in actions.items()}
        wait(futures.values())
    failed = {name: f.exception() for name, f in futures.items() if f.exception() is not None}
    if failed:
        name, err = next(iter(failed.items()))
        raise SinkError(f"sink(s) failed: {', '.join(failed)}") from err


def _step(cfg: BatchConfig, name: str) -> None:
    if cfg.fail_at:
        cfg.fail_at(name)


def month_folder(month: str | None, column: str = "sales_month") -> str:
    return f"{column}={writers.NULL_PARTITION if month is None else month}"


def fact_folder(cfg: BatchConfig, run: str, month: str | None) -> str:
    return f"{cfg.path('fact')}/run_id={run}/bad=0/{month_folder(month)}"


def _fact_rows(spark: SparkSession, cfg: BatchConfig, folders: list[tuple[str, str | None]]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], FACT).drop("record", "parsed", "bad")
    rows = spark.read.schema(FACT).option("basePath", cfg.path("fact")).parquet(*[fact_folder(cfg, r, m) for r, m in folders])
    return rows.drop("record", "parsed", "bad")


def read_fact(spark: SparkSession, cfg: BatchConfig, months: list | None = None, this_run: str | None = None) -> DataFrame:
    """The conformed sales of the runs that count, or of ``months`` only:
    just the folders that hold them are opened."""
    return _fact_rows(spark, cfg, [(r, m) for r, m in runs.load(spark, cfg).live(this_run) if months is None or m in months])


def read_bad_rows(spark: SparkSession, cfg: BatchConfig) -> DataFrame:
    """Rows of accepted files that did not parse: source_file, record, parsed."""
    book = runs.load(spark, cfg)
    folders = [f"{cfg.path('fact')}/run_id={r}/bad=1" for r, s in sorted(book.of_run.items()) if runs.BAD_ROWS in s and r in book.closed]
    if not folders:
        return spark.createDataFrame([], T.StructType(BAD_FIELDS))
    return (spark.read.schema(FACT).option("basePath", cfg.path("fact")).parquet(*folders)
            .select("source_file", "record", "parsed"))


# One writer at a time for a warehouse, within this driver.
_WRITERS: dict[str, threading.Lock] = {}


def writer_of(cfg: BatchConfig) -> threading.Lock:
    return _WRITERS.setdefault(cfg.warehouse.rstrip("/"), threading.Lock())


def process_manifest(spark: SparkSession, manifest: DataFrame, cfg: BatchConfig, run_id: str) -> dict:
    """Steps 2-8 for the files of ``manifest`` (path, location, file_name, ...)."""
    with writer_of(cfg):
        return _process(spark, manifest, cfg, run_id)


def _process(spark: SparkSession, manifest: DataFrame, cfg: BatchConfig, run_id: str) -> dict:
    state = ledger.read(spark, cfg.path("ledger"))
    todo = ledger.pending(manifest, state)
    files.require_input(todo, "new or unfinished file")
    book = runs.load(spark, cfg)
    tries = book.tries(run_id)
    if book.closed.intersection(tries):
        raise RunClosedError(f"run {run_id} has closed its files; other files need a run id of their own")
    quarantine_id, run_id = run_id, runs.next_try(run_id, tries)

    _step(cfg, "contract")
    verdicts = staged(contract.check_contract(todo), "verdicts")
    rejected = verdicts.where(~F.col("accepted"))
    if not rejected.isEmpty():
        contract.quarantine(spark, verdicts, cfg.path("error"), quarantine_id)
        ledger.append(ledger.reject_files(rejected, run_id), cfg.path("ledger"))
    accepted = verdicts.where(F.col("accepted")).select("path", "file_name", "modificationTime", "length")
    if accepted.isEmpty():
        raise NoInputError("no file passed the contract")

    _step(cfg, "open")
    ledger.append(ledger.open_files(accepted, run_id), cfg.path("ledger"))

    _step(cfg, "fact")
    part = write_fact(spark, verdicts, cfg, run_id)
    found = writers.partition_folders(spark, part, 2)
    written = [v["sales_month"] for _, v in found if v["bad"] == "0"]
    runs.note(spark, cfg, book, [(run_id, m, runs.WRITTEN) for m in written] + ([] if written else [(run_id, None, runs.EMPTY)])
              + [(run_id, None, runs.BAD_ROWS)] * any(v["bad"] == "1" for _, v in found))

    _step(cfg, "marts")
    dims = dimension_keys(cfg)
    counts = add_run(spark, cfg, run_id, written, book, dims)
    dead = book.dead(run_id)
    # NULL (no sales date) is a month of its own and sorts first.
    months = sorted(set(written).union(*dead.values()), key=lambda m: (m is not None, m or ""))
    refresh_months(spark, cfg, months, run_id, book, dims)

    _step(cfg, "close")
    # The one write that makes the run count, and its files done.
    ledger.append(ledger.close_files(accepted, run_id), cfg.path("ledger"))
    _step(cfg, "closed")
    book.closed.add(run_id)
    noted = {r for r, s in book.of_run.items() if runs.CLOSED in s}
    runs.note(spark, cfg, book, [(r, None, runs.CLOSED) for r in sorted(book.closed - noted)] + [(r, None, runs.GIVEN_UP) for r in dead])
    ledger.log(cfg.path("ledger")).maintain(spark, cfg.checkpoint_every)
    runs.log(cfg).maintain(spark, cfg.checkpoint_every)
    return {"run_id": run_id, "warehouse": cfg.warehouse, "joins": counts}


def write_fact(spark: SparkSession, verdicts: DataFrame, cfg: BatchConfig, run_id: str) -> str:
    """The run's part of the fact: its folder, made anew. Files are read in
    groups, so that no more than one group's rows lie in shuffle files."""
    part = f"{cfg.path('fact')}/run_id={run_id}"
    writers.delete_folder(spark, part)
    bad = F.col("record").isNotNull()
    for group in contract.by_bytes(verdicts, cfg.read_bytes):
        rows = contract.read_accepted(spark, group).rows
        writers.write_partitioned(
            rows.select(*SALE_COLUMNS, "source_file", "record", "parsed", bad.cast("int").alias("bad"),
                        F.when(~bad, month_bucket("sales_date")).alias("sales_month")),
            part, FACT_PARTITIONS, options=writers.ZSTD, mode="append")
        free_shuffles(spark)
    return part


# --- What a run adds: raw marts and partial totals ---

RAW_MARTS = {"customer_raw": ["sales_date_month"], "sales_team_raw": ["sales_month", "store_id"]}
TOTALS = {"customer": (CUSTOMER_TOTALS, ["customer_id"], marts.customer_totals),
          "seller": (SELLER_TOTALS, ["store_id", "sales_person_id"], marts.seller_totals)}


def _dims(cfg: BatchConfig) -> dict[str, tuple[DataFrame, str]]:
    return {"customer": (cfg.customer, "customer_id"), "store": (cfg.store, "id"), "sales_team": (cfg.sales_team, "id")}


@dataclass(frozen=True)
class DimensionKeys:
    version: str             # of the sets of keys, on which totals depend
    small: dict[str, bool]   # which dimensions may be broadcast


def dimension_keys(cfg: BatchConfig) -> DimensionKeys:
    """The dimensions as this run finds them; duplicate keys are refused."""
    dims = _dims(cfg)
    profile = load_profile(dims)
    raise_on_duplicates(profile, {n: k for n, (_, k) in dims.items()})
    name = "-".join(f"{p[0]:x}.{p.keys & (1 << 64) - 1:x}" for p in (profile[n] for n in dims))
    return DimensionKeys(name, small_sides(profile, cfg.customer))


def raw_folder(cfg: BatchConfig, name: str, run: str, month: str | None) -> str:
    return f"{cfg.path('marts')}/{name}/run_id={run}/{month_folder(month, RAW_MARTS[name][0])}"


def totals_base(cfg: BatchConfig, name: str, keys: str) -> str:
    return f"{cfg.path('totals')}/{name}/dims={keys}"


def totals_folder(cfg: BatchConfig, name: str, keys: str, run: str, month: str | None) -> str:
    return f"{totals_base(cfg, name, keys)}/run_id={run}/{month_folder(month)}"


def raw_rows(enriched: DataFrame, name: str) -> DataFrame:
    if name == "customer_raw":
        return marts.customer_raw_mart(enriched).withColumn("sales_date_month", month_bucket("sales_date"))
    return marts.sales_team_raw_mart(enriched)


def _enriched(cfg: BatchConfig, sale: DataFrame, dims: DimensionKeys, counts: enrich.JoinCounts) -> AbstractContextManager[DataFrame]:
    # Written once to the shared folder; concurrent sinks all read that. It lies
    # clustered by month, so the raw marts take no shuffle of their wide rows.
    rows = enrich.enrich(sale, cfg.customer, cfg.store, cfg.sales_team, counts=counts, small=dims.small)
    return staged_meanwhile(rows.withColumn("sales_month", month_bucket("sales_date")).hint("rebalance", "sales_month"), "enriched")


def fact_slices(spark: SparkSession, cfg: BatchConfig, run_id: str, months: list) -> list[list[str]]:
    """The fact's files of a run's months, month by month, in groups of about
    ``enriched_bytes``: a month may be cut between two files."""
    sizes = [(f"{folder}/{name}", size) for folder in (fact_folder(cfg, run_id, m) for m in months)
             for name, size in writers.files_in(spark, folder)]
    return list(contract.slices(sizes, cfg.enriched_bytes))


def add_parts(spark: SparkSession, cfg: BatchConfig, run_id: str, months: list, dims: DimensionKeys, raw: bool) -> dict:
    """Append totals (and raw rows) of a run's months, slice by slice, so that
    no more than one slice's wide rows are staged and lie in shuffle files;
    totals of a month that was cut add up. Returns what the joins lost."""
    lost = []
    for part in fact_slices(spark, cfg, run_id, months):
        counts = enrich.JoinCounts()
        sale = spark.read.schema(FACT).option("basePath", cfg.path("fact")).parquet(*part).select(*SALE_COLUMNS)
        with _enriched(cfg, sale, dims, counts) as rows:
            enriched = rows.drop("sales_month")
            sinks = {name: lambda name=name, cols=cols: writers.write_partitioned(
                raw_rows(enriched, name), f"{cfg.path('marts')}/{name}/run_id={run_id}", cols, options=writers.ZSTD,
                clustered=True, mode="append") for name, cols in RAW_MARTS.items() if raw}
            for name, (_, _, total) in TOTALS.items():
                sinks[f"{name}_totals"] = lambda name=name, total=total: writers.write_partitioned(
                    total(enriched), f"{totals_base(cfg, name, dims.version)}/run_id={run_id}", ["sales_month"], mode="append")
            run_concurrently(sinks)
            lost.append(counts.result(enriched) or enrich.count_losses(sale, cfg.customer, cfg.store, cfg.sales_team))
    return {k: sum(n[k] for n in lost) for k in lost[0]} if lost else enrich.JoinCounts().result(None)


def months_with_totals(spark: SparkSession, cfg: BatchConfig, run_id: str, keys: str) -> set:
    return {v["sales_month"] for _, v in writers.partition_folders(spark, f"{totals_base(cfg, 'customer', keys)}/run_id={run_id}", 1)}


def add_run(spark: SparkSession, cfg: BatchConfig, run_id: str, months: list, book: runs.Book, dims: DimensionKeys) -> dict:
    """The run's part of the raw marts and of the totals, each written once;
    returns what the joins lost (``JoinCounts``)."""
    if not months:
        return enrich.JoinCounts().result(None)
    for base in [f"{cfg.path('marts')}/{name}" for name in RAW_MARTS] + [totals_base(cfg, name, dims.version) for name in TOTALS]:
        writers.delete_folder(spark, f"{base}/run_id={run_id}")
    lost = add_parts(spark, cfg, run_id, months, dims, raw=True)
    note_parts(spark, cfg, book, run_id, months, months_with_totals(spark, cfg, run_id, dims.version), dims.version, raw=True)
    return lost


def note_parts(spark: SparkSession, cfg: BatchConfig, book: runs.Book, run_id: str, months: list, present: set, keys: str,
               raw: bool) -> None:
    """Note which months have totals (and raw rows): those with enriched sales."""
    rows = [(run_id, m, runs.with_totals(keys) if m in present else runs.without_totals(keys)) for m in months]
    runs.note(spark, cfg, book, rows + [(run_id, m, runs.RAW) for m in months if raw and m in present])


# --- Refresh ---

def complete_totals(spark: SparkSession, cfg: BatchConfig, wanted: list[tuple], book: runs.Book, dims: DimensionKeys) -> None:
    """Totals for every (run, month) of ``wanted``; those made for other
    versions of the dimensions' keys are made again from the fact."""
    keys = dims.version
    missing = [(r, m) for r, m in wanted
               if not book.has(r, m, runs.with_totals(keys)) and not book.has(r, m, runs.without_totals(keys))]
    for run in sorted({r for r, _ in missing}):
        months = [m for r, m in missing if r == run]
        for name in TOTALS:
            writers.drop_partitions(spark, f"{totals_base(cfg, name, keys)}/run_id={run}", "sales_month", months)
        add_parts(spark, cfg, run, months, dims, raw=False)
        note_parts(spark, cfg, book, run, months, months_with_totals(spark, cfg, run, keys), keys, raw=False)


def read_totals(spark: SparkSession, cfg: BatchConfig, name: str, keys: str, folders: list[tuple]) -> DataFrame:
    """Merged totals of (run, month) folders, one row per key and month."""
    schema, by, _ = TOTALS[name]
    if not folders:
        return spark.createDataFrame([], schema).drop("run_id")
    partial = spark.read.schema(schema).option("basePath", totals_base(cfg, name, keys)).parquet(
        *[totals_folder(cfg, name, keys, r, m) for r, m in folders])
    return marts.merge_totals(partial, by)


def refresh_months(spark: SparkSession, cfg: BatchConfig, months: list, this_run: str | None = None,
                   book: runs.Book | None = None, dims: DimensionKeys | None = None) -> None:
    """Both marts for ``months`` from the totals of the runs that count:
    only those month partitions are replaced, one without rows any more is
    removed (R2)."""
    if not months:
        return
    book, dims = book or runs.load(spark, cfg), dims or dimension_keys(cfg)
    keys, small = dims.version, dims.small
    wanted = [(r, m) for r, m in book.live(this_run) if m in months]
    complete_totals(spark, cfg, wanted, book, dims)
    folders = [(r, m) for r, m in wanted if book.has(r, m, runs.with_totals(keys))]
    c_mart = marts.customer_monthly_from_totals(read_totals(spark, cfg, "customer", keys, folders), cfg.customer, small["customer"])
    s_mart = marts.sales_team_monthly_from_totals(read_totals(spark, cfg, "seller", keys, folders), cfg.sales_team, small["sales_team"])
    emptied = [m for m in months if m not in {m for _, m in folders}]

    def replace(df: DataFrame, name: str, cols: list[str], write=writers.write_partitioned) -> None:
        # Emptied months first: a failure after this is repaired by the next run.
        if emptied:
            writers.drop_partitions(spark, cfg.path(name), cols[0], emptied)
        write(df, cfg.path(name), cols)

    run_concurrently({
        "customer_monthly": lambda: replace(c_mart, "marts/customer_monthly", ["sales_date_month"]),
        "sales_team_monthly": lambda: replace(s_mart, "marts/sales_team_monthly", ["sales_month"]),
    })
    free_shuffles(spark)
    sinks = {}
    if cfg.snapshots:
        for raw in RAW_MARTS:
            sinks[f"{raw}_snapshot"] = lambda raw=raw: write_snapshot(spark, cfg, raw, months, book, this_run)
    if cfg.csv_export:
        sinks["csv_export"] = lambda: replace(_mart_months(spark, cfg, "sales_team_monthly", months), "exports/seller_incentives",
                                              ["sales_month", "store_id"], writers.write_csv_export)
    run_concurrently(sinks)
    free_shuffles(spark)
    if cfg.jdbc:
        # Appended under one snapshot id per refresh; read with read_jdbc_mart.
        sid = writers.new_snapshot_id()
        for name in ("customer_monthly", "sales_team_monthly"):
            table, month = _jdbc_table(cfg, name)
            writers.write_jdbc_snapshot(_mart_months(spark, cfg, name, months), cfg.jdbc["url"], table,
                                        cfg.jdbc.get("properties", {}), month, months, sid)


def write_snapshot(spark: SparkSession, cfg: BatchConfig, name: str, months: list, book: runs.Book, this_run: str | None = None) -> int:
    """K4: the raw mart as it now is, as a manifest of its folders: those of
    the last manifest for months not in ``months``, the live ones for these."""
    base = cfg.path(f"snapshots/{name}")
    kept = [(r["sales_month"], r["run_id"]) for r in writers.read_manifest(spark, base, SNAPSHOT).collect() if r["sales_month"] not in months]
    new = [(m, r) for r, m in book.live(this_run) if m in months and book.has(r, m, runs.RAW)]
    return writers.write_manifest(spark, base, kept + new, SNAPSHOT, cfg.keep_snapshots)


def read_raw_mart(spark: SparkSession, cfg: BatchConfig, name: str, snapshot_id: int | None = None) -> DataFrame:
    """A raw mart (``customer_raw``, ``sales_team_raw``) of the runs that
    count, or as a kept snapshot names it: just those folders are opened."""
    if snapshot_id is None:
        book = runs.load(spark, cfg)
        have = [(r, m) for r, m in book.live() if book.has(r, m, runs.RAW)]
    else:
        manifest = writers.read_manifest(spark, cfg.path(f"snapshots/{name}"), SNAPSHOT, snapshot_id)
        have = [(r["run_id"], r["sales_month"]) for r in manifest.collect()]
    return raw_mart_rows(spark, cfg, name, have)


def raw_mart_rows(spark: SparkSession, cfg: BatchConfig, name: str, folders: list[tuple]) -> DataFrame:
    schema = raw_rows(spark.createDataFrame([], enrich.enriched_schema(cfg.customer, cfg.store, cfg.sales_team)), name).schema
    schema = T.StructType(schema.fields + [T.StructField("run_id", T.StringType())])
    if not folders:
        return spark.createDataFrame([], schema).drop("run_id")
    return (spark.read.schema(schema).option("basePath", f"{cfg.path('marts')}/{name}")
            .parquet(*[raw_folder(cfg, name, r, m) for r, m in folders]).drop("run_id"))


def run_batch(spark: SparkSession, cfg: BatchConfig, run_id: str | None = None) -> dict:
    """One batch run over the landing roots (see the module docstring)."""
    manifest = files.discover(spark, cfg.roots())
    files.require_input(manifest, "file")
    return process_manifest(spark, manifest, cfg, run_id or ledger.new_run_id())


def _jdbc_table(cfg: BatchConfig, name: str) -> tuple[str, str]:
    key = {"customer_monthly": "customer_table", "sales_team_monthly": "sales_team_table"}[name]
    month = {"customer_monthly": "sales_date_month", "sales_team_monthly": "sales_month"}[name]
    return (cfg.jdbc or {}).get(key, JDBC_TABLES[name]), month


def read_jdbc_mart(spark: SparkSession, cfg: BatchConfig, name: str) -> DataFrame:
    """A mart as the database holds it: per month, the newest marked snapshot."""
    table, month = _jdbc_table(cfg, name)
    return writers.read_jdbc_snapshot(spark, cfg.jdbc["url"], table, cfg.jdbc.get("properties", {}), month)


MARTS = {"customer_monthly": (CUSTOMER_MONTHLY, "sales_date_month"), "sales_team_monthly": (SALES_TEAM_MONTHLY, "sales_month")}


def read_mart(spark: SparkSession, cfg: BatchConfig, name: str) -> DataFrame:
    schema, _ = MARTS[name]
    return spark.read.schema(schema).parquet(cfg.path(f"marts/{name}")).select(*schema.fieldNames())


def _mart_months(spark: SparkSession, cfg: BatchConfig, name: str, months: list) -> DataFrame:
    """The rows of ``months`` of a mart as written (partitions are pruned)."""
    month = F.col(MARTS[name][1])
    some = month.isin([m for m in months if m is not None])
    return read_mart(spark, cfg, name).where((some | month.isNull()) if None in months else some)
