"""Registered queries for discovery, contract, quarantine, union and sinks
(S1, S2, S4-S6, V1-V4, U1, U2, K1, K2, K4, K5).

Each query stages its own inputs under a fresh folder below the session's
checkpoint folder (the shared folder named by ``spark.checkpoint.dir``), so
runs never collide and nothing lands on a machine-local path on a cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.columns import month_bucket
from tillroll.operators import contract, marts
from tillroll.plans import driver, landing
from tillroll.plans.mart_queries import enriched_frame
from tillroll.plans.oracle import sql
from tillroll.plans.registry import register
from tillroll.schemas import CUSTOMER_MONTHLY, SALE_COLUMNS, SALES_TEAM_MONTHLY
from tillroll.session import scratch_dir, staged
from tillroll.sinks import writers
from tillroll.sources import files

_DROP_SQL = "CASE desk " + " ".join(f"WHEN '{d}' THEN '{landing.drop_name(d)}'" for d in landing.LAYOUTS) + " END"
_ACCEPTED_SQL = "('1-URGENT', '2-HIGH', '3-MEDIUM')"


def staged_landing(spark: SparkSession, sf_dir: str, name: str) -> str:
    root = scratch_dir(spark, name)
    landing.stage_sales(driver.sale_with_extras(spark, sf_dir), f"{root}/landing")
    return root


def drop_of():
    """The drop's folder name, from the plain form of a file's path."""
    return F.element_at(F.split(F.col("location"), "/"), -2)


@register("header_contract", "S2, S4, S5, V1, V2, V4, U2",
          sql(f"""SELECT DISTINCT {_DROP_SQL} AS drop_name,
       desk IN {_ACCEPTED_SQL} AS accepted,
       CASE desk WHEN '4-NOT SPECIFIED' THEN 'missing_columns' WHEN '4-RETURNED' THEN 'repeated_columns'
                 WHEN '5-LOW' THEN 'not_csv' END AS reason,
       CASE desk WHEN '4-NOT SPECIFIED' THEN 'store_id' WHEN '5-LOW' THEN NULL ELSE '' END AS missing,
       CASE desk WHEN '3-MEDIUM' THEN 'payment_mode,coupon' WHEN '4-NOT SPECIFIED' THEN 'payment_mode'
                 WHEN '4-RETURNED' THEN 'payment_mode' WHEN '5-LOW' THEN NULL ELSE '' END AS extras
FROM sale_extras""", "sale_extras"))
def q_header_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = staged_landing(spark, sf_dir, "contract")
    manifest = files.discover(spark, f"{root}/landing")
    files.require_input(manifest, "file")
    v = contract.check_contract(manifest)
    return v.select(drop_of().alias("drop_name"), "accepted", "reason",
                    F.array_join("missing", ",").alias("missing"),
                    F.array_join("extras", ",").alias("extras")).distinct()


@register("quarantine", "V3, S5, S6",
          sql(f"""SELECT {_DROP_SQL} AS drop_name,
       CASE desk WHEN '4-NOT SPECIFIED' THEN 'missing_columns' WHEN '4-RETURNED' THEN 'repeated_columns'
                 ELSE 'not_csv' END AS reason,
       count(*) AS n_lines
FROM sale_extras WHERE desk NOT IN {_ACCEPTED_SQL}
GROUP BY ALL""", "sale_extras"))
def q_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = staged_landing(spark, sf_dir, "quarantine")
    v = contract.check_contract(files.discover(spark, f"{root}/landing"))
    copies = contract.quarantine(spark, v, f"{root}/error")
    # What the error area holds: line ends of each copied file, less its header.
    names = v.where(~F.col("accepted")).select("path", drop_of().alias("drop_name"))
    header = (F.col("reason") != contract.REASON_NOT_CSV).cast("int")
    return (contract.line_ends(copies).join(names, "path")
            .groupBy("drop_name", "reason").agg(F.sum(F.col("n_ends") - header).cast("bigint").alias("n_lines"))
            .where("n_lines > 0"))


@register("union_files", "U1, S1, P1-P3 over the accepted drops",
          sql(f"""SELECT customer_id, store_id, product_name, sales_date, sales_person_id, price, quantity,
       total_cost, CASE WHEN desk = '3-MEDIUM' THEN concat_ws(', ', payment_mode, coupon) END AS additional_column
FROM sale_extras WHERE desk IN {_ACCEPTED_SQL}""", "sale_extras"))
def q_union_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = staged_landing(spark, sf_dir, "union")
    manifest = files.discover(spark, f"{root}/landing")
    batch = contract.read_accepted(spark, contract.check_contract(manifest))
    return batch.sale.select(*SALE_COLUMNS)


@register("csv_roundtrip", "K1 (CSV), S1",
          sql("SELECT * FROM customer_monthly", "customer_monthly"))
def q_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "csv") + "/customer_monthly"
    mart = marts.customer_monthly(marts.customer_raw_mart(enriched_frame(spark, sf_dir)))
    writers.write_table(mart, path, fmt="csv", options={"header": "true"})
    return (spark.read.schema(CUSTOMER_MONTHLY).option("header", "true").option("enforceSchema", "false")
            .csv(path))


@register("parquet_roundtrip", "K1",
          sql("SELECT * FROM sales_team_monthly", "sales_team_monthly"))
def q_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "parquet") + "/sales_team_monthly"
    writers.write_table(marts.sales_team_monthly(marts.sales_team_raw_mart(enriched_frame(spark, sf_dir))), path)
    return spark.read.parquet(path)


@register("partitioned_roundtrip", "K2",
          sql("SELECT * FROM sales_team_raw", "sales_team_raw"))
def q_partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "partitioned") + "/sales_team_raw"
    raw = marts.sales_team_raw_mart(enriched_frame(spark, sf_dir))
    writers.write_partitioned(raw, path, ["sales_month", "store_id"])
    back = spark.read.schema(raw.schema).parquet(path)
    return back.select(*raw.columns)


@register("csv_export", "K5",
          sql("SELECT * FROM sales_team_monthly", "sales_team_monthly"))
def q_csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "export") + "/seller_incentives"
    mart = marts.sales_team_monthly(marts.sales_team_raw_mart(enriched_frame(spark, sf_dir)))
    writers.write_csv_export(mart, path, ["sales_month", "store_id"])
    part = ["sales_month", "store_id"]
    data_fields = [f for f in SALES_TEAM_MONTHLY.fields if f.name not in part]
    part_fields = [SALES_TEAM_MONTHLY[c] for c in part]
    from pyspark.sql import types as T
    schema = T.StructType(data_fields + part_fields)
    back = spark.read.schema(schema).option("header", "true").csv(path)
    return back.select(*SALES_TEAM_MONTHLY.fieldNames())


@register("snapshot_latest", "K4",
          sql("""SELECT * FROM customer_monthly""", "customer_monthly"))
def q_snapshot_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Three refreshes of different months: all, then the even months again
    # (from rows of which half had come), then the even months in full.
    base = scratch_dir(spark, "snapshots") + "/customer_raw"
    raw = marts.customer_raw_mart(enriched_frame(spark, sf_dir)).withColumn("sales_date_month", month_bucket("sales_date"))
    raw = staged(raw, "snapshot-rows")
    even = F.coalesce(F.substring("sales_date_month", 7, 1).cast("int") % 2 == 0, F.lit(False))
    months = {r[0] for r in raw.select("sales_date_month").distinct().collect()}
    evens = sorted(m for m in months if m is not None and int(m[-1]) % 2 == 0)
    writers.write_month_snapshot(raw, base, "sales_date_month", list(months), snapshot_id=1)
    writers.write_month_snapshot(raw.where(even & (F.dayofmonth("sales_date") < 15)), base, "sales_date_month", evens, snapshot_id=2)
    writers.write_month_snapshot(raw.where(even), base, "sales_date_month", evens, snapshot_id=3)
    return marts.customer_monthly(writers.read_latest_snapshot(spark, base, raw.schema, "sales_date_month"))
