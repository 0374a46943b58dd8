"""Registered queries that run the whole job: batch, recovery after a
failed run, and the incremental file stream (R1, R2, L1-L5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.plans import batch, driver, landing, upkeep
from tillroll.plans.oracle import ACCEPTED_SALE, sql
from tillroll.plans.registry import register
from tillroll.schemas import SALE_COLUMNS, SOURCE_REGISTRY
from tillroll.session import scratch_dir
from tillroll.streaming import incremental

_UNION_SQL = sql(ACCEPTED_SALE.strip(), "sale_extras")
_SELLER_SQL = sql("SELECT * FROM sales_team_monthly", "sales_team_monthly", sale=ACCEPTED_SALE)
_CUSTOMER_SQL = sql("SELECT * FROM customer_monthly", "customer_monthly", sale=ACCEPTED_SALE)


class InjectedFailure(RuntimeError):
    """Raised by the failure hook to stop a run between two steps."""


def job_config(spark: SparkSession, sf_dir: str, root: str, **kw) -> batch.BatchConfig:
    d = driver.dims(spark, sf_dir)
    kw.setdefault("landing", [f"{root}/landing"])
    return batch.BatchConfig(warehouse=f"{root}/warehouse",
                             customer=d["customer"], store=d["store"], sales_team=d["sales_team"], **kw)


@register("batch_marts", "run_batch: S4..L2 end to end, seller mart read back", _SELLER_SQL)
def q_batch_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "batch")
    landing.stage_sales(driver.sale_with_extras(spark, sf_dir), f"{root}/landing")
    cfg = job_config(spark, sf_dir, root)
    batch.run_batch(spark, cfg)
    return batch.read_mart(spark, cfg, "sales_team_monthly")


@register("batch_recovery", "L3: a run dies before closing; the next run redoes its files", _CUSTOMER_SQL)
def q_batch_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "recovery")
    landing.stage_sales(driver.sale_with_extras(spark, sf_dir), f"{root}/landing")

    def die_before_close(step: str) -> None:
        if step == "close":
            raise InjectedFailure("run died before closing its files")

    try:
        batch.run_batch(spark, job_config(spark, sf_dir, root, fail_at=die_before_close))
    except InjectedFailure:
        pass
    cfg = job_config(spark, sf_dir, root)
    upkeep.vacuum(spark, cfg)            # what the dead run left and nothing names
    batch.run_batch(spark, cfg)          # files still in state A: taken again
    return batch.read_mart(spark, cfg, "customer_monthly")


def _two_arrivals(spark: SparkSession, sf_dir: str, name: str) -> batch.BatchConfig:
    """Two availableNow runs of the file stream: the first sees the desks
    1 and 2, the second only the files that arrived after it."""
    root = scratch_dir(spark, name)
    cfg = job_config(spark, sf_dir, root)
    checkpoint = f"{root}/checkpoint"
    with landing.desks_of(driver.sale_with_extras(spark, sf_dir)) as source:
        landing.stage_landing(source, f"{root}/landing", desks=["1-URGENT", "2-HIGH"])
        incremental.run_available(spark, cfg, checkpoint)
        landing.stage_landing(source, f"{root}/landing", desks=["3-MEDIUM", "4-NOT SPECIFIED", "4-RETURNED", "5-LOW"])
    incremental.run_available(spark, cfg, checkpoint)
    return cfg


@register("incremental_ingest", "R1, L5: new files exactly once, fact read back", _UNION_SQL)
def q_incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = _two_arrivals(spark, sf_dir, "stream")
    return batch.read_fact(spark, cfg).select(*SALE_COLUMNS)


@register("month_refresh", "R2: marts refreshed for the months each batch touched", _SELLER_SQL)
def q_month_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg = _two_arrivals(spark, sf_dir, "refresh")
    return batch.read_mart(spark, cfg, "sales_team_monthly")


@register("registry_batch", "S7 wired: the batch takes its roots from the active rows of the source registry",
          sql("""SELECT customer_id, store_id, product_name, sales_date, sales_person_id, price, quantity, total_cost,
       CAST(NULL AS VARCHAR) AS additional_column
FROM sale_extras WHERE desk IN ('1-URGENT', '2-HIGH')""", "sale_extras"))
def q_registry_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "registry")
    folders = landing.stage_sales(driver.sale_with_extras(spark, sf_dir), f"{root}/landing")
    state = {"1-URGENT": "Active", "2-HIGH": " ACTIVE ", "3-MEDIUM": "inactive"}
    registry = spark.createDataFrame([(desk, folder, None, None, state.get(desk, "inactive"))
                                      for desk, folder in folders.items()], SOURCE_REGISTRY)
    cfg = job_config(spark, sf_dir, root, landing=registry)
    batch.run_batch(spark, cfg)
    return batch.read_fact(spark, cfg).select(*SALE_COLUMNS)
