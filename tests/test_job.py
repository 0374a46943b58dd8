"""The batch job end to end, recovery after a failure at every step, and the
incremental file stream (run_batch, L1-L5, R1, R2) on the golden set."""

from __future__ import annotations

import os
from decimal import Decimal as D

import pytest

from conftest import (CSV_HEADER, GOLDEN_CUSTOMER_MONTHLY, GOLDEN_SALES_TEAM_MONTHLY, SALES,
                      as_set, sales_csv_lines, write_file)
from tillroll import schemas
from tillroll.errors import NoInputError
from tillroll.operators import ledger
from tillroll.plans import batch
from tillroll.sinks import writers
from tillroll.streaming import incremental

MARCH_APRIL = [s for s in SALES if not s[2].startswith("2023-05")]
MAY = [s for s in SALES if s[2].startswith("2023-05")]


class Boom(RuntimeError):
    pass


def config(golden, root, **kw):
    kw.setdefault("snapshots", True)
    kw.setdefault("csv_export", True)
    return batch.BatchConfig(landing=[os.path.join(root, "landing")], warehouse=os.path.join(root, "wh"),
                             customer=golden["customer"], store=golden["store"],
                             sales_team=golden["sales_team"], **kw)


def stage(root, name, rows, extra_rejected=False):
    land = os.path.join(root, "landing")
    write_file(land, name, "\n".join([CSV_HEADER] + sales_csv_lines(rows)) + "\n")
    if extra_rejected:
        write_file(land, "notes.txt", "hello\n")


def marts_of(spark, cfg):
    c = as_set(batch.read_mart(spark, cfg, "customer_monthly"),
               ["customer_id", "full_name", "sales_date_month", "total_sales"])
    s = as_set(batch.read_mart(spark, cfg, "sales_team_monthly"),
               ["store_id", "sales_person_id", "sales_month", "total_sales", "incentive"])
    return c, s


def test_batch_golden_and_rerun_is_a_no_op(spark, golden, workdir):
    stage(workdir, "day1.csv", MARCH_APRIL, extra_rejected=True)
    stage(workdir, "day2.csv", MAY)
    cfg = config(golden, workdir)
    batch.run_batch(spark, cfg)
    assert marts_of(spark, cfg) == (GOLDEN_CUSTOMER_MONTHLY, GOLDEN_SALES_TEAM_MONTHLY)
    state = ledger.current_state(ledger.read(spark, cfg.path("ledger"))).collect()
    assert sorted((r.file_name, r.status) for r in state) == [("day1.csv", "I"), ("day2.csv", "I"), ("notes.txt", "R")]
    # Quarantined, not processed.
    assert {r.file_name for r in spark.read.parquet(cfg.path("error/rejects")).collect()} == {"notes.txt"}
    # A second run finds nothing new (notes.txt is not taken again) and leaves the marts alone.
    with pytest.raises(NoInputError):
        batch.run_batch(spark, cfg)
    assert spark.read.parquet(cfg.path("error/rejects")).count() == 1
    for name, rows in (("customer_raw", 8), ("sales_team_raw", 8)):
        assert batch.read_raw_mart(spark, cfg, name).count() == rows
        (sid,) = writers.snapshot_ids(spark, cfg.path(f"snapshots/{name}"))
        assert batch.read_raw_mart(spark, cfg, name, sid).count() == rows
    assert marts_of(spark, cfg) == (GOLDEN_CUSTOMER_MONTHLY, GOLDEN_SALES_TEAM_MONTHLY)
    raw = spark.read.parquet(cfg.path("marts/sales_team_raw"))
    assert raw.count() == 8
    assert spark.read.option("header", "true").csv(cfg.path("exports/seller_incentives")).count() == 7


@pytest.mark.parametrize("step", ["contract", "open", "fact", "marts", "close"])
def test_failure_at_any_step_then_rerun_gives_one_clean_run(spark, golden, workdir, step):
    stage(workdir, "day1.csv", MARCH_APRIL)
    stage(workdir, "day2.csv", MAY)

    def fail(name):
        if name == step:
            raise Boom(name)

    with pytest.raises(Boom):
        batch.run_batch(spark, config(golden, workdir, fail_at=fail, csv_export=False))
    cfg = config(golden, workdir, csv_export=False)
    batch.run_batch(spark, cfg)
    assert marts_of(spark, cfg) == (GOLDEN_CUSTOMER_MONTHLY, GOLDEN_SALES_TEAM_MONTHLY)
    assert batch.read_fact(spark, cfg).count() == len(SALES)


def test_new_file_refreshes_only_its_month(spark, golden, workdir):
    stage(workdir, "day1.csv", MARCH_APRIL)
    cfg = config(golden, workdir, snapshots=False, csv_export=False)
    batch.run_batch(spark, cfg)
    march = os.path.join(cfg.path("marts/customer_monthly"), "sales_date_month=2023-03")
    before = sorted(os.listdir(march))
    stage(workdir, "day2.csv", MAY)
    batch.run_batch(spark, cfg)
    assert sorted(os.listdir(march)) == before          # March untouched
    assert marts_of(spark, cfg) == (GOLDEN_CUSTOMER_MONTHLY, GOLDEN_SALES_TEAM_MONTHLY)


def test_incremental_stream_sees_each_file_once(spark, golden, workdir):
    cfg = config(golden, workdir, snapshots=False, csv_export=False)
    ckpt = os.path.join(workdir, "checkpoint")
    stage(workdir, "day1.csv", MARCH_APRIL)
    incremental.run_available(spark, cfg, ckpt)
    first = batch.read_fact(spark, cfg).count()
    assert first == len(MARCH_APRIL)
    incremental.run_available(spark, cfg, ckpt)           # nothing new
    assert batch.read_fact(spark, cfg).count() == first
    stage(workdir, "day2.csv", MAY, extra_rejected=True)
    incremental.run_available(spark, cfg, ckpt)
    assert batch.read_fact(spark, cfg).count() == len(SALES)
    assert marts_of(spark, cfg) == (GOLDEN_CUSTOMER_MONTHLY, GOLDEN_SALES_TEAM_MONTHLY)


def test_sale_without_date_lands_in_a_null_month(spark, golden, workdir):
    land = os.path.join(workdir, "landing")
    write_file(land, "nodate.csv", CSV_HEADER + "\n1,121,Sugar,,1,7.00,1,7.00\n2,121,Sugar,2023-03-15,2,100.00,1,100.00\n")
    cfg = config(golden, workdir, snapshots=False, csv_export=False)
    batch.run_batch(spark, cfg)
    c, s = marts_of(spark, cfg)
    assert (1, "Ana Roy", None, D("7.00")) in c
    assert (121, 1, None, D("7.00"), D("0.07")) in s
    assert (2, "Ben Das", "2023-03", D("100.00")) in c


def test_jdbc_marts_are_safe_to_repeat(spark, golden, workdir):
    import uuid

    from tillroll.sources.tables import read_jdbc

    stage(workdir, "day1.csv", MARCH_APRIL)
    stage(workdir, "day2.csv", MAY)
    jdbc = {"url": f"jdbc:derby:memory:marts_{uuid.uuid4().hex[:8]};create=true",
            "properties": {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}}

    def die_before_close(name):
        if name == "close":
            raise Boom(name)

    with pytest.raises(Boom):
        batch.run_batch(spark, config(golden, workdir, jdbc=jdbc, fail_at=die_before_close, csv_export=False))
    cfg = config(golden, workdir, jdbc=jdbc, csv_export=False)
    batch.run_batch(spark, cfg)
    c = as_set(batch.read_jdbc_mart(spark, cfg, "customer_monthly"),
               ["customer_id", "full_name", "sales_date_month", "total_sales"])
    s = as_set(batch.read_jdbc_mart(spark, cfg, "sales_team_monthly"),
               ["store_id", "sales_person_id", "sales_month", "total_sales", "incentive"])
    assert (c, s) == (GOLDEN_CUSTOMER_MONTHLY, GOLDEN_SALES_TEAM_MONTHLY)
    appended = read_jdbc(spark, jdbc["url"], batch.JDBC_TABLES["sales_team_monthly"], jdbc["properties"])
    assert appended.count() == 2 * len(GOLDEN_SALES_TEAM_MONTHLY)     # both runs' rows are kept


def test_stream_archives_processed_files(spark, golden, workdir):
    cfg = config(golden, workdir, snapshots=False, csv_export=False)
    ckpt, archive = os.path.join(workdir, "checkpoint"), os.path.join(workdir, "archive")
    stage(workdir, "day1.csv", MARCH_APRIL)
    incremental.run_available(spark, cfg, ckpt, archive_dir=archive)
    stage(workdir, "day2.csv", MAY)
    incremental.run_available(spark, cfg, ckpt, archive_dir=archive)
    # Spark archives a finished file while a later batch runs, under its full path.
    archived = [f for _, _, fs in os.walk(archive) for f in fs if f.endswith(".csv")]
    assert "day1.csv" in archived
    assert not os.path.exists(os.path.join(workdir, "landing", "day1.csv"))
    assert batch.read_fact(spark, cfg).count() == len(SALES)
    assert marts_of(spark, cfg) == (GOLDEN_CUSTOMER_MONTHLY, GOLDEN_SALES_TEAM_MONTHLY)


def test_bad_rows_are_kept_per_file_and_not_duplicated(spark, golden, workdir):
    land = os.path.join(workdir, "landing")
    write_file(land, "bad.csv", CSV_HEADER + "\n1,121,Oil,2023-04-01,1,5,x,5\n2,121,Oil,2023-03-15,2,100.00,1,100.00\n")

    def die_before_close(name):
        if name == "close":
            raise Boom(name)

    with pytest.raises(Boom):
        batch.run_batch(spark, config(golden, workdir, fail_at=die_before_close, snapshots=False, csv_export=False))
    cfg = config(golden, workdir, snapshots=False, csv_export=False)
    batch.run_batch(spark, cfg)
    bad = batch.read_bad_rows(spark, cfg).collect()
    assert len(bad) == 1 and bad[0].record.startswith("1,121,Oil")
    assert batch.read_fact(spark, cfg).count() == 1


def test_stream_replays_a_failed_micro_batch(spark, golden, workdir):
    ckpt = os.path.join(workdir, "checkpoint")
    stage(workdir, "day1.csv", MARCH_APRIL)
    stage(workdir, "day2.csv", MAY)

    def die_in_marts(name):
        if name == "marts":
            raise Boom(name)

    with pytest.raises(Exception):
        incremental.run_available(spark, config(golden, workdir, fail_at=die_in_marts, snapshots=False,
                                                csv_export=False), ckpt)
    cfg = config(golden, workdir, snapshots=False, csv_export=False)
    incremental.run_available(spark, cfg, ckpt)      # same checkpoint: the failed batch runs again
    assert batch.read_fact(spark, cfg).count() == len(SALES)
    assert marts_of(spark, cfg) == (GOLDEN_CUSTOMER_MONTHLY, GOLDEN_SALES_TEAM_MONTHLY)
    state = ledger.current_state(ledger.read(spark, cfg.path("ledger"))).collect()
    assert {r.status for r in state} == {"I"}


def test_concurrent_sinks_report_a_failure_after_all_finish(spark, workdir):
    from tillroll.errors import SinkError

    done = []
    out = os.path.join(workdir, "ok")

    def good():
        spark.range(10).write.parquet(out)
        done.append("good")

    def bad():
        raise RuntimeError("database down")

    with pytest.raises(SinkError, match="bad"):
        batch.run_concurrently({"good": good, "bad": bad})
    assert done == ["good"] and spark.read.parquet(out).count() == 10


def test_months_of_a_dead_run_are_corrected(spark, golden, workdir):
    """A run dies before closing, the file is corrected from March to April, the next run takes it again."""
    land = os.path.join(workdir, "landing")
    row = "\n1,121,Sugar,{},1,100.00,1,100.00\n"
    write_file(land, "d.csv", CSV_HEADER + row.format("2023-03-03"))

    def die(name):
        if name == "close":
            raise Boom(name)

    with pytest.raises(Boom):
        batch.run_batch(spark, config(golden, workdir, fail_at=die))
    write_file(land, "d.csv", CSV_HEADER + row.format("2023-04-03"))
    cfg = config(golden, workdir)
    batch.run_batch(spark, cfg)
    assert batch.read_fact(spark, cfg).count() == 1
    assert marts_of(spark, cfg) == ({(1, "Ana Roy", "2023-04", D("100.00"))}, {(121, 1, "2023-04", D("100.00"), D("1.00"))})
    for name in ("marts/customer_monthly", "marts/sales_team_monthly", "exports/seller_incentives"):
        assert [v for _, v in writers.partition_folders(spark, cfg.path(name), 1)] in (
            [{"sales_date_month": "2023-04"}], [{"sales_month": "2023-04"}])
    for name, month in (("customer_raw", "sales_date_month"), ("sales_team_raw", "sales_month")):
        newest = writers.snapshot_ids(spark, cfg.path(f"snapshots/{name}"))[-1]
        assert [r[month] for r in batch.read_raw_mart(spark, cfg, name, newest).collect()] == ["2023-04"]
        assert [r[month] for r in batch.read_raw_mart(spark, cfg, name).collect()] == ["2023-04"]


def test_redelivered_name_is_processed(spark, golden, workdir):
    cfg = config(golden, workdir, snapshots=False, csv_export=False)
    stage(workdir, "d.csv", MARCH_APRIL)
    batch.run_batch(spark, cfg)
    stage(workdir, "d.csv", MAY)            # the same name, other rows
    batch.run_batch(spark, cfg)
    assert batch.read_fact(spark, cfg).count() == len(SALES)
    assert marts_of(spark, cfg) == (GOLDEN_CUSTOMER_MONTHLY, GOLDEN_SALES_TEAM_MONTHLY)


def test_roots_come_from_the_registry(spark, golden, workdir):
    stage(workdir, "day1.csv", MARCH_APRIL)
    write_file(os.path.join(workdir, "other"), "day2.csv", "\n".join([CSV_HEADER] + sales_csv_lines(MAY)) + "\n")
    rows = [("b", os.path.join(workdir, "landing"), None, None, "Active"), ("b", os.path.join(workdir, "other"), None, None, "off")]
    cfg = config(golden, workdir, snapshots=False, csv_export=False)
    cfg.landing = spark.createDataFrame(rows, schemas.SOURCE_REGISTRY)
    batch.run_batch(spark, cfg)
    assert batch.read_fact(spark, cfg).count() == len(MARCH_APRIL)


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    from tillroll import session
    from tillroll.errors import ConfigError

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext, conf = Context(), {}

    with pytest.raises(ConfigError):
        session.ensure_checkpoint_dir(Session())


def test_two_arrivals_derive_their_sales_once(spark, monkeypatch):
    from tillroll.plans import job_queries, landing

    staged, write = [], landing.scratch_dir
    monkeypatch.setattr(landing, "scratch_dir", lambda s, name: staged.append(name) or write(s, name))
    arrived = []
    monkeypatch.setattr(incremental, "run_available", lambda s, cfg, checkpoint: arrived.append(
        {r.location.rsplit("/", 2)[1] for r in s.read.format("binaryFile").option("recursiveFileLookup", "true").load(cfg.roots())
         .selectExpr("path AS location").collect()}))
    job_queries._two_arrivals(spark, "/root/testdata/sf0.001", "once")
    assert staged == ["drops"]
    assert arrived[0] == {landing.drop_name(d) for d in ("1-URGENT", "2-HIGH")}
    assert arrived[1] == {landing.drop_name(d) for d in landing.LAYOUTS}
