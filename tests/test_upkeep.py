"""Run identity, totals by run, compaction, vacuum, event logs and snapshots."""

from __future__ import annotations

import os
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from conftest import CSV_HEADER, SALES, as_set, write_file
from test_job import MARCH_APRIL, Boom, config, stage
from tillroll.errors import RunClosedError
from tillroll.operators import enrich, ledger, marts, sizing
from tillroll.operators.eventlog import EventLog
from tillroll.plans import batch, runs, upkeep
from tillroll.sinks import writers
from tillroll.streaming import incremental

LEAN = {"snapshots": False, "csv_export": False}


def drop(root, name, *days, landing="landing", seller=1):
    lines = [f"1,121,Sugar,{day},{seller},1.00,1,1.00" for day in days]
    write_file(os.path.join(root, landing), name, "\n".join([CSV_HEADER, *lines]) + "\n")


def totals(spark, cfg):
    return as_set(batch.read_mart(spark, cfg, "customer_monthly"), ["sales_date_month", "total_sales"])


def full(spark, cfg):
    """Both marts computed from the whole fact, as sets."""
    rows = batch.read_fact(spark, cfg)
    return (as_set(marts.customer_monthly_from_sales(rows, cfg.customer, cfg.store, cfg.sales_team)),
            as_set(marts.sales_team_monthly_from_sales(rows, cfg.customer, cfg.store, cfg.sales_team)))


def held(spark, cfg):
    return as_set(batch.read_mart(spark, cfg, "customer_monthly")), as_set(batch.read_mart(spark, cfg, "sales_team_monthly"))


# --- Run identity (R1) ---

def test_stream_with_a_new_checkpoint_keeps_closed_sales(spark, golden, workdir):
    cfg = config(golden, workdir, **LEAN)
    drop(workdir, "a.csv", "2023-03-03")
    incremental.run_available(spark, cfg, os.path.join(workdir, "first"))
    drop(workdir, "b.csv", "2023-04-03")
    incremental.run_available(spark, cfg, os.path.join(workdir, "second"))
    assert totals(spark, cfg) == {("2023-03", D("1.00")), ("2023-04", D("1.00"))}
    drop(workdir, "c.csv", "2023-03-04")
    incremental.run_available(spark, cfg, os.path.join(workdir, "second"))
    assert totals(spark, cfg) == {("2023-03", D("2.00")), ("2023-04", D("1.00"))}
    assert batch.read_fact(spark, cfg).count() == 3 and held(spark, cfg) == full(spark, cfg)


def test_two_streams_into_one_warehouse(spark, golden, workdir):
    one = config(golden, workdir, **LEAN)
    two = config(golden, workdir, **LEAN)
    two.landing = [os.path.join(workdir, "other")]
    drop(workdir, "a.csv", "2023-03-03")
    drop(workdir, "a.csv", "2023-03-05", "2023-05-05", landing="other")
    queries = [incremental.start_incremental(spark, c, os.path.join(workdir, f"ckpt{k}")) for k, c in enumerate((one, two))]
    for q in queries:
        q.awaitTermination()
        assert q.exception() is None
    drop(workdir, "b.csv", "2023-05-06")
    incremental.run_available(spark, one, os.path.join(workdir, "ckpt0"))
    assert totals(spark, one) == {("2023-03", D("2.00")), ("2023-05", D("2.00"))}
    assert held(spark, one) == full(spark, one)


def test_a_closed_run_is_never_replaced(spark, golden, workdir):
    cfg = config(golden, workdir, **LEAN)
    drop(workdir, "a.csv", "2023-03-03")
    batch.run_batch(spark, cfg, run_id="night")
    drop(workdir, "b.csv", "2023-04-03")
    with pytest.raises(RunClosedError):
        batch.run_batch(spark, cfg, run_id="night")
    batch.run_batch(spark, cfg)
    assert totals(spark, cfg) == {("2023-03", D("1.00")), ("2023-04", D("1.00"))}


# --- Marts from partial totals (R2) ---

def test_refresh_reads_totals_not_other_runs_rows(spark, golden, workdir):
    cfg = config(golden, workdir, **LEAN)
    drop(workdir, "a.csv", "2023-03-03")
    first = batch.run_batch(spark, cfg)["run_id"]
    writers.delete_folder(spark, batch.fact_folder(cfg, first, "2023-03"))    # what a refresh must not need
    drop(workdir, "b.csv", "2023-03-09")
    batch.run_batch(spark, cfg)
    assert totals(spark, cfg) == {("2023-03", D("2.00"))}


def test_an_earlier_top_seller_loses_the_incentive(spark, golden, workdir):
    cfg = config(golden, workdir, **LEAN)
    drop(workdir, "a.csv", "2023-03-03", seller=1)
    batch.run_batch(spark, cfg)
    drop(workdir, "b.csv", "2023-03-03", "2023-03-04", seller=2)
    batch.run_batch(spark, cfg)
    got = as_set(batch.read_mart(spark, cfg, "sales_team_monthly"), ["sales_person_id", "total_sales", "incentive"])
    assert got == {(1, D("1.00"), D("0.00")), (2, D("2.00"), D("0.02"))}


def test_changed_dimension_keys_make_the_totals_anew(spark, golden, workdir):
    cfg = config(golden, workdir, **LEAN)
    stage(workdir, "day1.csv", MARCH_APRIL)
    batch.run_batch(spark, cfg)
    cfg.customer = cfg.customer.where("customer_id <> 2")
    drop(workdir, "b.csv", "2023-03-03", "2023-04-03")
    batch.run_batch(spark, cfg)
    assert held(spark, cfg) == full(spark, cfg)
    assert not [r for r in totals(spark, cfg) if r[1] == D("152.00")]


def test_a_repeated_run_that_holds_less(spark, golden, workdir):
    """The same run id dies, its file is corrected, and it runs again."""
    drop(workdir, "a.csv", "2023-03-03", "2023-04-03")

    def die(step):
        if step == "close":
            raise Boom(step)

    with pytest.raises(Boom):
        batch.run_batch(spark, config(golden, workdir, fail_at=die), run_id="r")
    drop(workdir, "a.csv", "2023-05-03")
    cfg = config(golden, workdir)
    batch.run_batch(spark, cfg, run_id="r")
    assert totals(spark, cfg) == {("2023-05", D("1.00"))} and held(spark, cfg) == full(spark, cfg)
    assert batch.read_raw_mart(spark, cfg, "customer_raw").count() == 1


def test_run_dies_after_closing_its_files(spark, golden, workdir):
    drop(workdir, "a.csv", "2023-03-03")

    def die(step):
        if step == "closed":
            raise Boom(step)

    with pytest.raises(Boom):
        batch.run_batch(spark, config(golden, workdir, fail_at=die, **LEAN))
    cfg = config(golden, workdir, **LEAN)
    assert batch.read_fact(spark, cfg).count() == 1          # the ledger says so
    drop(workdir, "b.csv", "2023-03-04")
    batch.run_batch(spark, cfg)
    assert totals(spark, cfg) == {("2023-03", D("2.00"))}


def test_lost_sales_are_counted_in_the_same_pass(spark, golden, workdir):
    counts = enrich.JoinCounts()
    out = os.path.join(workdir, "enriched")
    enriched = enrich.enrich(golden["sale"], golden["customer"], golden["store"], golden["sales_team"], counts=counts)
    enriched.write.parquet(out)
    got = counts.result(spark.read.parquet(out))
    assert got == {"sales": len(SALES), "lost_customer": 1, "lost_store": 1, "lost_sales_team": 1, "enriched": len(SALES) - 3}
    assert got == enrich.count_losses(golden["sale"], golden["customer"], golden["store"], golden["sales_team"])
    # Without an enriched row, and without any sale.
    drop(workdir, "a.csv", "2023-03-03", seller=77)
    cfg = config(golden, workdir, **LEAN)
    assert batch.run_batch(spark, cfg)["joins"] == {"sales": 1, "lost_customer": 0, "lost_store": 0, "lost_sales_team": 1, "enriched": 0}
    assert totals(spark, cfg) == set() if os.path.exists(cfg.path("marts/customer_monthly/_SUCCESS")) else True


# --- Compaction and vacuum ---

def many_runs(spark, golden, root, n=4, **kw):
    cfg = config(golden, root, max_folders=2, csv_export=False, **kw)
    for k in range(n):
        drop(root, f"d{k}.csv", f"2023-03-0{k + 1}", f"2023-0{4 + k % 2}-01", seller=1 + k % 3)
        batch.run_batch(spark, cfg)
    return cfg


def test_compaction_changes_nothing_but_the_folders(spark, golden, workdir):
    cfg = many_runs(spark, golden, workdir)
    facts = sorted(map(tuple, batch.read_fact(spark, cfg).drop("run_id").collect()), key=str)
    raw = {n: sorted(map(tuple, batch.read_raw_mart(spark, cfg, n).collect()), key=str) for n in batch.RAW_MARTS}
    before = held(spark, cfg)
    assert upkeep.compact(spark, cfg) == 4      # the folders of March
    live = runs.load(spark, cfg).live()
    assert len([1 for _, m in live if m == "2023-03"]) == 1
    assert sorted(map(tuple, batch.read_fact(spark, cfg).drop("run_id").collect()), key=str) == facts
    for n in batch.RAW_MARTS:
        assert sorted(map(tuple, batch.read_raw_mart(spark, cfg, n).collect()), key=str) == raw[n]
    batch.refresh_months(spark, cfg, ["2023-03", "2023-04", "2023-05"])
    assert held(spark, cfg) == before == full(spark, cfg)
    # Folders that a kept snapshot names stay until it expires.
    assert upkeep.vacuum(spark, cfg) == 0
    cfg.keep_snapshots = 1
    batch.refresh_months(spark, cfg, ["2023-03"])
    assert upkeep.vacuum(spark, cfg) == 4
    assert sorted(map(tuple, batch.read_fact(spark, cfg).drop("run_id").collect()), key=str) == facts
    folders = [v for _, v in writers.partition_folders(spark, cfg.path("fact"), 3) if v["sales_month"] == "2023-03"]
    assert len(folders) == 1
    runs.log(cfg).checkpoint(spark)
    drop(workdir, "later.csv", "2023-03-30")
    batch.run_batch(spark, cfg)
    assert held(spark, cfg) == full(spark, cfg)


def test_a_crash_in_upkeep_changes_nothing(spark, golden, workdir):
    """One after another: before the switch, after it, after the deletion."""
    cfg = many_runs(spark, golden, workdir, 3, snapshots=False)
    before = held(spark, cfg)
    facts = sorted(map(tuple, batch.read_fact(spark, cfg).drop("run_id").collect()), key=str)
    for step in ("switch", "switched", "deleted"):
        def die(name, step=step):
            if name == step:
                raise Boom(name)

        cfg.fail_at = die
        with pytest.raises(Boom):
            upkeep.upkeep(spark, cfg)
        cfg.fail_at = None
        assert sorted(map(tuple, batch.read_fact(spark, cfg).drop("run_id").collect()), key=str) == facts
    upkeep.upkeep(spark, cfg)
    assert sorted(map(tuple, batch.read_fact(spark, cfg).drop("run_id").collect()), key=str) == facts
    batch.refresh_months(spark, cfg, ["2023-03", "2023-04", "2023-05"])
    assert held(spark, cfg) == before


def test_a_month_has_few_folders_after_many_runs(spark, golden, workdir):
    cfg = config(golden, workdir, max_folders=2, **LEAN)
    for k in range(4):
        drop(workdir, f"d{k}.csv", f"2023-03-0{k + 1}")
        batch.run_batch(spark, cfg)
        upkeep.upkeep(spark, cfg)
        assert len(runs.load(spark, cfg).live()) <= 2
    assert totals(spark, cfg) == {("2023-03", D("4.00"))}


def test_dead_runs_are_cleared(spark, golden, workdir):
    drop(workdir, "a.csv", "2023-03-03")

    def die(step):
        if step == "close":
            raise Boom(step)

    with pytest.raises(Boom):
        batch.run_batch(spark, config(golden, workdir, fail_at=die, **LEAN), run_id="dead")
    cfg = config(golden, workdir, **LEAN)
    batch.run_batch(spark, cfg)
    assert os.path.exists(cfg.path("fact/run_id=dead"))
    upkeep.vacuum(spark, cfg)
    assert not os.path.exists(cfg.path("fact/run_id=dead"))
    runs.log(cfg).checkpoint(spark)
    assert "dead" not in {r.run_id for r in runs.log(cfg).read(spark).collect()}
    assert totals(spark, cfg) == {("2023-03", D("1.00"))}


def test_packing():
    assert upkeep.pack({"a": 10, "b": 20, "c": 30, "d": 200}, 100) == [["a", "b", "c"]]
    assert upkeep.pack({"a": 60, "b": 60, "c": 50, "d": 40}, 100) == [["d", "c"]]
    assert upkeep.pack({"a": 10}, 100) == []


# --- Event logs (L4) ---

def files(spark, n, start=0):
    return spark.createDataFrame([(f"in/{k}.csv",) for k in range(start, start + n)], "path string")


def test_state_of_many_runs_reads_a_checkpoint_and_the_tail(spark, workdir):
    path = os.path.join(workdir, "ledger")
    plain = None
    for run in range(12):
        ts = F.lit(f"2024-01-01 {run:02d}:00:00").cast("timestamp")
        later = F.lit(f"2024-01-01 {run:02d}:30:00").cast("timestamp")
        events = [ledger.open_files(files(spark, 3, run), f"r{run}", ts)]
        if run % 3:
            events.append(ledger.close_files(files(spark, 2, run), f"r{run}", later))
        for e in events:
            ledger.append(e, path)
            plain = e if plain is None else plain.unionByName(e)
        ledger.log(path).maintain(spark, every=4)
    log = ledger.log(path)
    assert log.checkpoint_number(spark) >= 4 and len(log.tail(spark)) < 4
    assert len(os.listdir(os.path.join(path, "checkpoints"))) <= 2 and len(os.listdir(os.path.join(path, "events"))) <= 2
    assert as_set(ledger.current_state(log.read(spark))) == as_set(ledger.current_state(plain))
    here = files(spark, 20)
    assert as_set(ledger.unfinished(log.read(spark), here)) == as_set(ledger.unfinished(plain, here))
    assert as_set(ledger.pending(here, log.read(spark))) == as_set(ledger.pending(here, plain))


def test_an_append_or_checkpoint_cut_short_is_not_seen(spark, workdir):
    path = os.path.join(workdir, "ledger")
    log = ledger.log(path)
    log.append(ledger.open_files(files(spark, 2), "r1"))
    log.append(ledger.close_files(files(spark, 2), "r1"))
    os.remove(os.path.join(path, "events", "epoch=0", sorted(os.listdir(os.path.join(path, "events", "epoch=0")))[0], "_SUCCESS"))
    assert log.read(spark).count() == 2
    log.checkpoint(spark)
    os.remove(os.path.join(path, "checkpoints", "n=1", "_SUCCESS"))
    assert log.checkpoint_number(spark) == 0 and log.read(spark).count() == 2
    assert log.checkpoint(spark) == 1 and log.read(spark).count() == 2


def test_an_event_log_without_appends(spark, workdir):
    log = EventLog(os.path.join(workdir, "none"), ledger.FILE_LEDGER, ledger.compact_events)
    assert log.read(spark).isEmpty() and log.checkpoint_number(spark) == 0 and log.tail(spark) == []


# --- Snapshots (K4) and profiles ---

def test_snapshots_expire_and_old_ones_can_be_read(spark, golden, workdir):
    cfg = config(golden, workdir, keep_snapshots=2, csv_export=False)
    for k in range(3):
        drop(workdir, f"d{k}.csv", f"2023-03-0{k + 1}")
        batch.run_batch(spark, cfg)
    ids = writers.snapshot_ids(spark, cfg.path("snapshots/customer_raw"))
    assert len(ids) == 2
    assert [batch.read_raw_mart(spark, cfg, "customer_raw", i).count() for i in ids] == [2, 3]
    # Each run's rows were written once.
    assert spark.read.parquet(cfg.path("marts/customer_raw")).count() == 3


def test_a_profile_is_taken_once_per_table_version(spark, golden, workdir, monkeypatch):
    path = os.path.join(workdir, "customer")
    golden["customer"].write.parquet(path)
    seen = []
    real = sizing.key_profile
    monkeypatch.setattr(sizing, "key_profile", lambda tables: seen.append(sorted(tables)) or real(tables))

    def load():
        return sizing.load_profile({"customer": (spark.read.parquet(path), "customer_id")})["customer"]

    first = load()
    assert load() == first and seen == [["customer"]]
    golden["customer"].where("customer_id > 1").write.mode("overwrite").parquet(path)
    assert load()[0] == first[0] - 1 and len(seen) == 2
    golden["customer"].unionByName(golden["customer"]).write.mode("overwrite").parquet(path)
    assert load()[1] == 2                                     # duplicates are seen again
    local = {"customer": (golden["customer"], "customer_id")}   # no file: nothing tells a change
    sizing.load_profile(local)
    sizing.load_profile(local)
    assert len(seen) == 5
