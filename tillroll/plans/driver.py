"""The sales model over the benchmark tables.

The engine's inputs (sales fact, customer, store, sales team, product) are
derived here, with Spark, from the TPC-H-like tables so every query's work
grows with the scale factor:

========================  ==================================================
sale.customer_id          orders.o_custkey (via lineitem ⋈ orders)
sale.store_id             supplier.s_nationkey (the seller's store)
sale.sales_person_id      lineitem.l_suppkey
sale.product_name/price   part.p_name / p_retailprice (NULL where not asked for)
sale.sales_date           orders.o_orderdate as DATE
sale.quantity/total_cost  lineitem.l_quantity / l_extendedprice
customer                  customer
store                     nation ⋈ region (manager = region name)
sales_team                supplier
product                   part
========================  ==================================================

Names split at ``#``: ``Customer#000000007`` -> first ``Customer``, last
``000000007``. ``tillroll.plans.oracle`` holds the same model in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.columns import line_money
from tillroll.operators.sizing import broadcast_if_small, broadcast_small

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _split(col: str, part: int):
    return F.split_part(F.col(col), F.lit("#"), F.lit(part))


def _pad(col, width: int):
    return F.lpad(col.cast("string"), width, "0")


def customer_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("bigint").alias("customer_id"),
        _split("c_name", 1).alias("first_name"),
        _split("c_name", 2).alias("last_name"),
        F.concat(F.col("c_mktsegment"), F.lit(" district "), F.col("c_nationkey").cast("string")).alias("address"),
        _pad(F.col("c_nationkey"), 6).alias("pincode"),
        _pad(F.col("c_custkey"), 10).alias("phone_number"),
        F.lit(None).cast("date").alias("customer_joining_date"))


def store_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = broadcast_if_small(table(spark, sf_dir, "region"))
    return n.join(r, n["n_regionkey"] == r["r_regionkey"], "inner").select(
        F.col("n_nationkey").cast("bigint").alias("id"),
        F.col("n_name").alias("address"),
        _pad(F.col("n_regionkey"), 6).alias("store_pincode"),
        F.col("r_name").alias("store_manager_name"),
        F.lit(None).cast("date").alias("store_opening_date"),
        F.lit(None).cast("string").alias("reviews"))


def sales_team_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").cast("bigint").alias("id"),
        _split("s_name", 1).alias("first_name"),
        _split("s_name", 2).alias("last_name"),
        F.col("s_nationkey").cast("bigint").alias("manager_id"),
        F.lit("N").alias("is_manager"),
        F.concat(F.lit("Zone "), F.col("s_nationkey").cast("string")).alias("address"),
        _pad(F.col("s_nationkey"), 6).alias("pincode"),
        F.lit(None).cast("date").alias("joining_date"))


def product_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("bigint").alias("id"), F.col("p_name").alias("name"),
        line_money("p_retailprice").alias("current_price"),
        F.lit(None).cast("decimal(10,2)").alias("old_price"),
        F.lit(None).cast("timestamp").alias("created_date"),
        F.lit(None).cast("timestamp").alias("updated_date"),
        F.lit(None).cast("date").alias("expiry_date"))


def sale_lines(spark: SparkSession, sf_dir: str, with_product: bool = False) -> DataFrame:
    """lineitem ⋈ orders ⋈ supplier (⋈ part) with the source columns the sale
    and its surplus columns are built from.

    The orders join is on the order key. The supplier join comes last, on
    the seller key, so the result is hash-partitioned on ``l_suppkey`` when
    the join shuffles; the sales-team join of the enrichment then reuses
    that partitioning instead of shuffling the fact again.
    """
    li_cols = ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
               "l_returnflag", "l_discount"]
    li = table(spark, sf_dir, "lineitem").select(*li_cols)
    sides = [table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"),
             table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")]
    if with_product:
        sides.append(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice"))
    o, s, *rest = broadcast_small(sides)      # one bounded-count job for all sides
    df = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
    if with_product:
        p = rest[0]
        df = df.join(p, df["l_partkey"] == p["p_partkey"], "inner")
    df = df.join(s, df["l_suppkey"] == s["s_suppkey"], "inner")
    return df


def sale_columns(with_product: bool = False) -> list:
    """Canonical sale projection over :func:`sale_lines`."""
    return [
        F.col("o_custkey").cast("bigint").alias("customer_id"),
        F.col("s_nationkey").cast("bigint").alias("store_id"),
        (F.col("p_name") if with_product else F.lit(None).cast("string")).alias("product_name"),
        F.col("o_orderdate").cast("date").alias("sales_date"),
        F.col("l_suppkey").cast("bigint").alias("sales_person_id"),
        (line_money("p_retailprice") if with_product else F.lit(None).cast("decimal(10,2)")).alias("price"),
        F.col("l_quantity").cast("int").alias("quantity"),
        line_money("l_extendedprice").alias("total_cost"),
    ]


def sale(spark: SparkSession, sf_dir: str, with_product: bool = False) -> DataFrame:
    """The conformed sales fact (9 canonical columns, no surplus columns)."""
    return sale_lines(spark, sf_dir, with_product).select(
        *sale_columns(with_product), F.lit(None).cast("string").alias("additional_column"))


def sale_with_extras(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales rows as a source system would send them: the eight mandatory
    columns plus two surplus ones, ``payment_mode`` (the order priority) and
    ``coupon`` (return flag, NULL when it is ``N``), and the ``desk`` the
    file comes from (the order priority, with the fourth one's returned lines
    apart; used to split drops)."""
    returned = (F.col("o_orderpriority") == "4-NOT SPECIFIED") & (F.col("l_returnflag") == "R")
    return sale_lines(spark, sf_dir, True).select(
        *sale_columns(True),
        F.col("o_orderpriority").alias("payment_mode"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("coupon"),
        F.when(returned, F.lit("4-RETURNED")).otherwise(F.col("o_orderpriority")).alias("desk"))


def dims(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"customer": customer_dim(spark, sf_dir), "store": store_dim(spark, sf_dir),
            "sales_team": sales_team_dim(spark, sf_dir)}
