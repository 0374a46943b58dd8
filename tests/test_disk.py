"""What a run takes on disk: staged rows and shuffle files go as soon as they
are used, slices bound them, and a dead run's rows go before its files are taken again."""

from __future__ import annotations

import os

import pytest
from conftest import GOLDEN_CUSTOMER_MONTHLY, GOLDEN_SALES_TEAM_MONTHLY, SALES, as_set
from test_job import MARCH_APRIL, MAY, Boom, config, marts_of, stage
from tillroll import session
from tillroll.operators import contract
from tillroll.plans import batch, job_queries, runs, upkeep
from tillroll.sinks import writers


def scratch(spark, *names):
    base = session.ensure_checkpoint_dir(spark).removeprefix("file:")
    return {f for f in os.listdir(base) if f.startswith(tuple(f"tillroll-{n}-" for n in names))}


def test_slices_keep_order_and_size():
    sizes = [("a", 5), ("b", 5), ("c", 1), ("d", 30), ("e", 2)]
    assert list(contract.slices(sizes, 10)) == [["a", "b"], ["c"], ["d"], ["e"]]
    assert list(contract.slices(sizes, 1)) == [[x] for x, _ in sizes] and list(contract.slices([], 1)) == []


def test_a_run_in_slices_gives_the_same_and_keeps_one_slice_staged(spark, golden, workdir, monkeypatch):
    whole, cut = os.path.join(workdir, "whole"), os.path.join(workdir, "cut")
    for root in (whole, cut):
        stage(root, "day1.csv", MARCH_APRIL[:4], extra_rejected=True)
        stage(root, "day2 [b].csv", MARCH_APRIL[4:])    # March lies in two files of the fact
        stage(root, "tag3.csv", MAY)
    before, most, at_once = scratch(spark, "enriched"), [], batch.run_concurrently

    def counted(actions):
        most.append(len(scratch(spark, "enriched") - before))
        at_once(actions)

    monkeypatch.setattr(batch, "run_concurrently", counted)
    a, b = config(golden, whole), config(golden, cut, read_bytes=1, enriched_bytes=1)
    want = batch.run_batch(spark, a)["joins"]
    slices, most[:] = len(most), []
    got = batch.run_batch(spark, b, run_id="cut")["joins"]
    assert got == want and len(most) > slices and max(most) == 1
    assert scratch(spark, "enriched") == before
    assert marts_of(spark, b) == (GOLDEN_CUSTOMER_MONTHLY, GOLDEN_SALES_TEAM_MONTHLY) == marts_of(spark, a)
    assert len(writers.files_in(spark, batch.fact_folder(b, "cut", "2023-03"))) == 2
    for rows in (lambda c: batch.read_fact(spark, c).drop("run_id", "source_file"), lambda c: batch.read_raw_mart(spark, c, "customer_raw"),
                 lambda c: batch.read_raw_mart(spark, c, "sales_team_raw")):
        assert sorted(map(tuple, rows(a).collect()), key=str) == sorted(map(tuple, rows(b).collect()), key=str)
    # Totals made again for other keys of the dimensions, in slices too.
    b.customer = golden["customer"].where("customer_id <> 3")
    batch.refresh_months(spark, b, ["2023-03", "2023-04", "2023-05"])
    assert marts_of(spark, b)[0] == {r for r in GOLDEN_CUSTOMER_MONTHLY if r[0] != 3}


def test_a_repeated_run_replaces_what_was_cut_short(spark, golden, workdir):
    """Died within the fact, before anything was noted: the same id again."""
    stage(workdir, "day1.csv", MARCH_APRIL)
    stage(workdir, "day2.csv", MAY)
    cfg = config(golden, workdir, read_bytes=1)
    real, n = writers.write_partitioned, []

    def die(*args, **kw):
        n.append(1)
        if len(n) == 2:
            raise Boom("fact")
        real(*args, **kw)

    writers.write_partitioned = die
    try:
        with pytest.raises(Boom):
            batch.run_batch(spark, cfg, run_id="r")
    finally:
        writers.write_partitioned = real
    batch.run_batch(spark, cfg, run_id="r")
    assert batch.read_fact(spark, cfg).count() == len(SALES)
    assert marts_of(spark, cfg) == (GOLDEN_CUSTOMER_MONTHLY, GOLDEN_SALES_TEAM_MONTHLY)


def test_a_dead_runs_rows_go_before_its_files_are_taken_again(spark, golden, workdir):
    stage(workdir, "day1.csv", SALES)

    def die(step):
        if step == "close":
            raise Boom(step)

    with pytest.raises(Boom):
        batch.run_batch(spark, config(golden, workdir, fail_at=die), run_id="dead")
    cfg = config(golden, workdir)
    upkeep.vacuum(spark, cfg)
    keys = batch.dimension_keys(cfg).version
    assert not os.path.exists(cfg.path("fact/run_id=dead"))
    assert not any(os.path.exists(f"{batch.totals_base(cfg, n, keys)}/run_id=dead") for n in batch.TOTALS)
    # The dead run's snapshot still names its raw rows; its months are still to be corrected.
    sid = writers.snapshot_ids(spark, cfg.path("snapshots/customer_raw"))[0]
    assert batch.read_raw_mart(spark, cfg, "customer_raw", sid).count() == len(SALES) - 3
    assert runs.load(spark, cfg).dead() == {"dead": {"2023-03", "2023-04", "2023-05"}}
    stage(workdir, "day1.csv", MAY)                     # delivered again, with less in it
    batch.run_batch(spark, cfg)
    assert {m for _, _, m, _ in marts_of(spark, cfg)[0]} == {"2023-05"}
    assert batch.read_raw_mart(spark, cfg, "customer_raw", sid).count() == len(SALES) - 3
    cfg.keep_snapshots = 1
    batch.refresh_months(spark, cfg, ["2023-05"])
    upkeep.vacuum(spark, cfg)
    assert not os.path.exists(cfg.path("marts/customer_raw/run_id=dead"))


def test_batch_recovery_leaves_no_staged_rows(spark):
    before, roots = scratch(spark, "drops", "enriched"), scratch(spark, "recovery")
    got = as_set(job_queries.q_batch_recovery(spark, "/root/testdata/sf0.001"))
    assert got and scratch(spark, "drops", "enriched") == before
    (root,) = scratch(spark, "recovery") - roots
    base = session.ensure_checkpoint_dir(spark).removeprefix("file:")
    assert len([f for f in os.listdir(f"{base}/{root}/warehouse/fact") if f.startswith("run_id=")]) == 1
