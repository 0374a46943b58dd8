"""Registered queries for projections, joins, windows and marts (P, J, W, A, D, O)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.columns import full_name, month_bucket
from tillroll.operators import conform, enrich, marts
from tillroll.plans import driver
from tillroll.plans.oracle import sql
from tillroll.plans.registry import register


def enriched_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = driver.dims(spark, sf_dir)
    return enrich.enrich(driver.sale(spark, sf_dir), d["customer"], d["store"], d["sales_team"])


@register("sales_team_monthly", "A2, P10-P14, W3 (as group max), J1-J3 (aggregate first)",
          sql("SELECT * FROM sales_team_monthly", "sales_team_monthly"))
def q_sales_team_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = driver.dims(spark, sf_dir)
    return marts.sales_team_monthly_from_sales(driver.sale(spark, sf_dir), d["customer"], d["store"],
                                               d["sales_team"])


@register("customer_monthly", "A1, D1, P6, P7, J1-J3 (aggregate first)",
          sql("SELECT * FROM customer_monthly", "customer_monthly"))
def q_customer_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = driver.dims(spark, sf_dir)
    return marts.customer_monthly_from_sales(driver.sale(spark, sf_dir), d["customer"], d["store"],
                                             d["sales_team"])


@register("sale_canonical", "P2, P3, P7, S3 (table scan)",
          sql("SELECT *, substring(CAST(sales_date AS VARCHAR), 1, 7) AS sales_month FROM sale_product",
              "sale_product"))
def q_sale_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = driver.sale(spark, sf_dir, with_product=True)
    return s.select(*s.columns, month_bucket("sales_date").alias("sales_month"))


@register("extra_columns_folded", "P1, V2, P3",
          sql("""SELECT customer_id, store_id, product_name, sales_date, sales_person_id, price, quantity,
       total_cost, concat_ws(', ', payment_mode, coupon) AS additional_column
FROM sale_extras""", "sale_extras"))
def q_extra_columns_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = driver.sale_with_extras(spark, sf_dir).drop("desk")
    return conform.conform_frame(src, src.columns)


@register("full_name_concat", "P6",
          sql("SELECT customer_id, first_name || ' ' || last_name AS full_name FROM customer_dim",
              "customer_dim"))
def q_full_name_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = driver.customer_dim(spark, sf_dir)
    return c.select("customer_id", full_name("first_name", "last_name").alias("full_name"))


@register("month_bucket", "P7",
          "SELECT o_orderkey, substring(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), 1, 7) AS sales_month FROM orders")
def q_month_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = driver.table(spark, sf_dir, "orders")
    return o.select("o_orderkey", month_bucket("o_orderdate").alias("sales_month"))


@register("join_customer", "J1, P16",
          sql("""SELECT f.customer_id, f.sales_person_id, f.sales_date, f.total_cost, c.first_name, c.last_name
FROM sale f JOIN customer_dim c ON f.customer_id = c.customer_id""", "sale", "customer_dim"))
def q_join_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = enrich.join_customer(driver.sale(spark, sf_dir), driver.customer_dim(spark, sf_dir))
    return j.select(F.col("s.customer_id").alias("customer_id"), "sales_person_id", "sales_date",
                    "total_cost", "first_name", "last_name")


@register("join_store", "J2, P4",
          sql("""SELECT f.customer_id, f.store_id, f.sales_date, f.total_cost,
       st.address AS store_address, st.store_manager_name
FROM sale f JOIN store_dim st ON f.store_id = st.id""", "sale", "store_dim"))
def q_join_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = enrich.join_store(driver.sale(spark, sf_dir), driver.store_dim(spark, sf_dir))
    return j.select("customer_id", "store_id", "sales_date", "total_cost", "store_address", "store_manager_name")


@register("join_sales_team", "J3, P5",
          sql("""SELECT f.store_id, f.sales_person_id, f.sales_date, f.total_cost,
       t.first_name AS sales_person_first_name, t.last_name AS sales_person_last_name,
       t.address AS sales_person_address, t.pincode AS sales_person_pincode
FROM sale f JOIN sales_team_dim t ON f.sales_person_id = t.id""", "sale", "sales_team_dim"))
def q_join_sales_team(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = enrich.join_sales_team(driver.sale(spark, sf_dir), driver.sales_team_dim(spark, sf_dir))
    return j.select("store_id", "sales_person_id", "sales_date", "total_cost", "sales_person_first_name",
                    "sales_person_last_name", "sales_person_address", "sales_person_pincode")


@register("enriched_sales", "J4, P4, P5, P16", sql("SELECT * FROM enriched", "enriched"))
def q_enriched_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched_frame(spark, sf_dir)


@register("customer_raw_mart", "P8", sql("SELECT * FROM customer_raw", "customer_raw"))
def q_customer_raw_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.customer_raw_mart(enriched_frame(spark, sf_dir))


@register("sales_team_raw_mart", "P9, P7", sql("SELECT * FROM sales_team_raw", "sales_team_raw"))
def q_sales_team_raw_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.sales_team_raw_mart(enriched_frame(spark, sf_dir))


@register("window_total_customer", "W1, D1",
          sql("""SELECT DISTINCT customer_id, first_name || ' ' || last_name AS full_name, address, phone_number,
       substring(CAST(sales_date AS VARCHAR), 1, 7) AS sales_date_month,
       CAST(sum(total_cost) OVER (PARTITION BY customer_id, substring(CAST(sales_date AS VARCHAR), 1, 7))
            AS DECIMAL(18,2)) AS total_sales
FROM customer_raw""", "customer_raw"))
def q_window_total_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.window_total_customer(marts.customer_raw_mart(enriched_frame(spark, sf_dir)))


@register("window_total_seller", "W2, D1",
          sql("""SELECT DISTINCT store_id, sales_person_id,
       sales_person_first_name || ' ' || sales_person_last_name AS full_name, sales_month,
       CAST(sum(total_cost) OVER (PARTITION BY store_id, sales_person_id, sales_month) AS DECIMAL(18,2))
            AS total_sales
FROM sales_team_raw""", "sales_team_raw"))
def q_window_total_seller(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.window_total_seller(marts.sales_team_raw_mart(enriched_frame(spark, sf_dir)))


@register("rank_sellers", "W3, O1", sql("SELECT * FROM seller_ranked", "seller_ranked"))
def q_rank_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = marts.sales_team_raw_mart(enriched_frame(spark, sf_dir))
    return marts.rank_sellers(marts.seller_month_totals(raw))


@register("sales_team_monthly_ranked", "A2 via the rank window (W3)",
          sql("SELECT * FROM sales_team_monthly", "sales_team_monthly"))
def q_sales_team_monthly_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.sales_team_monthly_ranked(marts.sales_team_raw_mart(enriched_frame(spark, sf_dir)))


@register("distinct_rows", "D1",
          sql("SELECT DISTINCT store_id, sales_person_id, sales_month FROM sales_team_raw", "sales_team_raw"))
def q_distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = marts.sales_team_raw_mart(enriched_frame(spark, sf_dir))
    return marts.distinct_rows(raw.select("store_id", "sales_person_id", "sales_month"))


@register("preview", "O2 (order, then the first 20 rows)",
          sql("SELECT * FROM customer_monthly ORDER BY customer_id, sales_date_month LIMIT 20",
              "customer_monthly"))
def q_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = marts.customer_monthly(marts.customer_raw_mart(enriched_frame(spark, sf_dir)))
    return m.orderBy("customer_id", "sales_date_month").limit(20)
