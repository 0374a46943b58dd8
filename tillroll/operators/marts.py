"""Monthly marts (A1, A2) and their building blocks.

The marts are pure DataFrame -> DataFrame functions; writing is the sinks'
job. A1 and A2 are ``groupBy`` aggregations, so Spark sums map-side before
the shuffle and a hot customer or seller collapses to one row per task
early. The window forms (W1, W2 + D1) are kept as separate operators for
parity with the original job's shape (a partition total on every row, then
distinct rows); they are not used on the production path.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.columns import full_name, incentive, month_bucket, total_money
from tillroll.operators.sizing import load_profile, raise_on_duplicates, small_sides
from tillroll.session import staged

# The raw marts' columns.
CUSTOMER_RAW_COLUMNS = ["customer_id", "first_name", "last_name", "address", "pincode",
                        "phone_number", "sales_date", "total_cost"]
SALES_TEAM_RAW_COLUMNS = ["store_id", "sales_person_id", "sales_person_first_name",
                          "sales_person_last_name", "store_manager_name", "manager_id",
                          "is_manager", "sales_person_address", "sales_person_pincode",
                          "sales_date", "total_cost"]


def customer_raw_mart(enriched: DataFrame) -> DataFrame:
    """The customer-facing slice of the enriched fact."""
    return enriched.select(*CUSTOMER_RAW_COLUMNS)


def sales_team_raw_mart(enriched: DataFrame) -> DataFrame:
    """The seller-facing slice plus the month bucket ``sales_month``."""
    return enriched.select(*SALES_TEAM_RAW_COLUMNS, month_bucket("sales_date").alias("sales_month"))


def partition_total(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """``sum(value) OVER (PARTITION BY keys)`` with the whole
    partition as frame, on every row of ``df``.

    Computed as a ``groupBy`` (partial sums map-side) joined back on the
    keys with NULL-safe equality, rather than as a window: a window sorts
    every row of a partition in one task, so a key holding a third of all
    rows would be a third of the job in one task. Here the per-key totals
    are one row per key, and a hot key on the fact side of the join is split
    by AQE's skew-join handling. ``df`` is written once to the shared folder:
    both sides read those rows, so what made them runs once.
    """
    df = staged(df, "partition-total")
    totals = df.groupBy(*keys).agg(F.sum(value).alias(name))
    tk = [f"__k{i}" for i in range(len(keys))]
    totals = totals.select(*[F.col(k).alias(t) for k, t in zip(keys, tk)], name)
    cond = reduce(lambda a, b: a & b, [df[k].eqNullSafe(totals[t]) for k, t in zip(keys, tk)])
    return df.join(totals, cond, "inner").drop(*tk)


def window_total_customer(raw: DataFrame) -> DataFrame:
    """W1 + D1: partition sum over (customer, month) on every row, then
    distinct rows. Same result as :func:`customer_monthly` when the customer
    attributes depend on the key; kept for parity, not for production."""
    rows = raw.select("customer_id", "first_name", "last_name", "address", "phone_number", "total_cost",
                      month_bucket("sales_date").alias("sales_date_month"))
    return (partition_total(rows, ["customer_id", "sales_date_month"], "total_cost", "window_total")
            .select("customer_id", full_name("first_name", "last_name").alias("full_name"),
                    "address", "phone_number", "sales_date_month",
                    total_money("window_total").alias("total_sales"))
            .distinct())


def window_total_seller(raw: DataFrame) -> DataFrame:
    """W2 + D1: partition sum over (store, seller, month), then distinct."""
    rows = raw.select("store_id", "sales_person_id", "sales_person_first_name", "sales_person_last_name", "total_cost",
                      month_bucket("sales_date").alias("sales_month"))
    keys = ["store_id", "sales_person_id", "sales_month"]
    return (partition_total(rows, keys, "total_cost", "window_total")
            .select("store_id", "sales_person_id",
                    full_name("sales_person_first_name", "sales_person_last_name").alias("full_name"),
                    "sales_month", total_money("window_total").alias("total_sales"))
            .distinct())


def customer_monthly(raw: DataFrame) -> DataFrame:
    """A1: spend per customer and month, with full name, address, phone."""
    return (raw.groupBy("customer_id",
                        full_name("first_name", "last_name").alias("full_name"),
                        "address", "phone_number",
                        month_bucket("sales_date").alias("sales_date_month"))
            .agg(total_money(F.sum("total_cost")).alias("total_sales")))


def seller_month_totals(raw: DataFrame) -> DataFrame:
    """Total per (store, seller, month) with the seller's full name."""
    return (raw.groupBy("store_id", "sales_person_id",
                        full_name("sales_person_first_name", "sales_person_last_name").alias("full_name"),
                        month_bucket("sales_date").alias("sales_month"))
            .agg(total_money(F.sum("total_cost")).alias("total_sales")))


def rank_sellers(totals: DataFrame) -> DataFrame:
    """``rank()`` of sellers per (store, month) by total, descending,
    NULL totals last; ties share a rank and the next rank skips. Computed by
    :func:`rank_desc`, so a store-month with a huge number of sellers is not
    sorted in one task."""
    return rank_desc(totals, ["store_id", "sales_month"], "total_sales", "rnk")


def mark_top_sellers(totals: DataFrame) -> DataFrame:
    """Adds ``is_top``: the row would get rank 1 in :func:`rank_sellers`.

    Rank 1 with descending order and NULLs last means "total equals the
    group maximum", or "every total of the group is NULL". The maximum is a
    ``groupBy`` (partial aggregation, so a store-month that holds a third of
    all rows is still summed map-side) joined back on the group key; the
    join is broadcast by AQE when the per-group table is small and split by
    AQE's skew handling when it is not. No single task ever has to hold a
    whole hot group, unlike a window partitioned by (store, month). The
    totals feed both sides; their shuffle appears once in the final adaptive
    plan (a ``ReusedExchange``), so the fact is scanned and aggregated once.
    """
    tops = (totals.groupBy("store_id", "sales_month")
            .agg(F.max("total_sales").alias("top_total"))
            .withColumnRenamed("store_id", "t_store_id")
            .withColumnRenamed("sales_month", "t_sales_month"))
    cond = (totals["store_id"].eqNullSafe(tops["t_store_id"])
            & totals["sales_month"].eqNullSafe(tops["t_sales_month"]))
    joined = totals.join(tops, cond, "inner")
    is_top = F.coalesce(F.col("total_sales") == F.col("top_total"), F.lit(False)) | F.col("top_total").isNull()
    return joined.select(*totals.columns, is_top.alias("is_top"))


def sales_team_monthly(raw: DataFrame) -> DataFrame:
    """A2: per store, seller and month the total and the incentive: 1 % of
    the total, rounded HALF_UP to 2 digits, for every seller tied at rank 1;
    0 for the others; NULL when the group's only totals are NULL."""
    marked = mark_top_sellers(seller_month_totals(raw))
    return marked.select("store_id", "sales_person_id", "full_name", "sales_month", "total_sales",
                         incentive("total_sales", F.col("is_top")).alias("incentive"))


def sales_team_monthly_ranked(raw: DataFrame) -> DataFrame:
    """A2 written with the rank window (W3), as the original states it.
    Used to cross-check :func:`sales_team_monthly` in tests and the bench."""
    ranked = rank_sellers(seller_month_totals(raw))
    return ranked.select("store_id", "sales_person_id", "full_name", "sales_month", "total_sales",
                         incentive("total_sales", F.col("rnk") == 1).alias("incentive"))


def distinct_rows(df: DataFrame) -> DataFrame:
    """D1 on its own."""
    return df.distinct()


# --- Marts straight from the sales fact: filter, aggregate, then join names ---

def _checked_dims(sale: DataFrame, customer: DataFrame, store: DataFrame,
                  sales_team: DataFrame) -> dict[str, bool]:
    """Key uniqueness of the three dimensions (a duplicate key raises) and,
    from the same row counts, which are small enough to broadcast: one job per
    version of the tables."""
    keys = {"customer": "customer_id", "store": "id", "sales_team": "id"}
    frames = {"customer": customer, "store": store, "sales_team": sales_team}
    profile = load_profile({n: (frames[n], keys[n]) for n in keys})
    raise_on_duplicates(profile, keys)
    return small_sides(profile, sale)


def _semi(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str, small: bool) -> DataFrame:
    """Fact rows whose key exists in the dimension (an inner join's filter,
    without its columns). Only the key column of the dimension is read."""
    keys = dim.select(F.col(dim_key).alias("__key"))
    keys = F.broadcast(keys) if small else keys
    return fact.join(keys, fact[fact_key] == keys["__key"], "left_semi")


def customer_monthly_from_sales(sale: DataFrame, customer: DataFrame, store: DataFrame,
                                sales_team: DataFrame) -> DataFrame:
    """A1 straight from the conformed sales: the same rows as
    ``customer_monthly(customer_raw_mart(enrich(...)))``.

    Dimension keys are unique (checked), so the inner joins with store and
    sales team only filter rows, and the customer attributes depend on the
    customer key. The plan therefore filters the fact by semi joins on key
    columns, sums per (customer, month) with partial aggregation before the
    shuffle, and joins the customer attributes to the aggregated rows: the
    shuffle carries ids and sums instead of names and addresses, and a large
    customer table is joined with one row per customer and month rather than
    with every sale.
    """
    small = _checked_dims(sale, customer, store, sales_team)
    f = sale.select("customer_id", "store_id", "sales_person_id", "sales_date", "total_cost")
    f = _semi(f, "store_id", store, "id", small["store"])
    f = _semi(f, "sales_person_id", sales_team, "id", small["sales_team"])
    totals = (f.groupBy("customer_id", month_bucket("sales_date").alias("sales_month"))
              .agg(F.sum("total_cost").alias("total")))
    return customer_monthly_from_totals(totals, customer, small["customer"])


def customer_monthly_from_totals(totals: DataFrame, customer: DataFrame, small: bool) -> DataFrame:
    """A1 from (customer_id, sales_month, total): one row each, names joined last."""
    c = customer.select(F.col("customer_id").alias("__ck"),
                        full_name("first_name", "last_name").alias("full_name"), "address", "phone_number")
    c = F.broadcast(c) if small else c
    return (totals.join(c, totals["customer_id"] == c["__ck"], "inner")
            .select("customer_id", "full_name", "address", "phone_number", F.col("sales_month").alias("sales_date_month"),
                    total_money("total").alias("total_sales")))


def sales_team_monthly_from_sales(sale: DataFrame, customer: DataFrame, store: DataFrame,
                                  sales_team: DataFrame) -> DataFrame:
    """A2 straight from the conformed sales, the same rows as
    ``sales_team_monthly(sales_team_raw_mart(enrich(...)))``: semi joins on
    customer and store keys, totals per (store, seller, month), then the
    seller's name joined to the totals, then the incentive."""
    small = _checked_dims(sale, customer, store, sales_team)
    f = sale.select("customer_id", "store_id", "sales_person_id", "sales_date", "total_cost")
    f = _semi(f, "customer_id", customer, "customer_id", small["customer"])
    f = _semi(f, "store_id", store, "id", small["store"])
    totals = (f.groupBy("store_id", "sales_person_id", month_bucket("sales_date").alias("sales_month"))
              .agg(F.sum("total_cost").alias("total")))
    return sales_team_monthly_from_totals(totals, sales_team, small["sales_team"])


def sales_team_monthly_from_totals(totals: DataFrame, sales_team: DataFrame, small: bool) -> DataFrame:
    """A2 from (store_id, sales_person_id, sales_month, total), one row each:
    names, then the top sellers of every store and month and their incentive."""
    t = sales_team.select(F.col("id").alias("__sk"),
                          full_name("first_name", "last_name").alias("full_name"))
    t = F.broadcast(t) if small else t
    seller_totals = (totals.join(t, totals["sales_person_id"] == t["__sk"], "inner")
                     .select("store_id", "sales_person_id", "full_name", "sales_month",
                             total_money("total").alias("total_sales")))
    marked = mark_top_sellers(seller_totals)
    return marked.select("store_id", "sales_person_id", "full_name", "sales_month", "total_sales",
                         incentive("total_sales", F.col("is_top")).alias("incentive"))


# --- Partial totals of a run, merged by the month's refresh ---

def customer_totals(enriched: DataFrame) -> DataFrame:
    """(customer_id, total, sales_month) of enriched sales: sums that add up
    over runs (NULL while no sale has an amount)."""
    return enriched.groupBy("customer_id", month_bucket("sales_date").alias("sales_month")).agg(
        F.sum("total_cost").cast("decimal(28,2)").alias("total"))


def seller_totals(enriched: DataFrame) -> DataFrame:
    """(store_id, sales_person_id, total, sales_month) of enriched sales."""
    return enriched.groupBy("store_id", "sales_person_id", month_bucket("sales_date").alias("sales_month")).agg(
        F.sum("total_cost").cast("decimal(28,2)").alias("total"))


def merge_totals(partial: DataFrame, keys: list[str]) -> DataFrame:
    """Totals of several runs to one per key and month."""
    return partial.groupBy(*keys, "sales_month").agg(F.sum("total").cast("decimal(28,2)").alias("total"))


# --- rank() without a window over the whole group ---

def _same(left: DataFrame, right: DataFrame, left_cols: list[str], right_cols: list[str]):
    """NULL-safe equality of column lists (a NULL group is a group)."""
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in zip(left_cols, right_cols)])


def rank_desc(df: DataFrame, group_cols: list[str], value_col: str, rank_col: str = "rnk") -> DataFrame:
    """``rank() OVER (PARTITION BY group_cols ORDER BY value_col DESC NULLS
    LAST)`` on every row of ``df``, exact, without sorting a whole group in
    one task.

    rank = 1 + the number of rows of the group with a strictly greater
    value (NULLs count as smallest). Rows are first collapsed to one row per
    distinct (group, value) with its count, so ties cost nothing. These rows
    are range-partitioned by (group, value): a group takes as many partitions
    as its share of the rows asks for, at any size. Written with their
    partition number, they are summed within each (group, partition), and a
    group's partition totals (at most one row per partition) give the offset.
    ``df`` itself is read from one staged copy, so what made it runs once.
    """
    df = staged(df, "rank-rows")
    g, v = [F.col(c) for c in group_cols], F.col(value_col)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(*g, v).agg(F.count(F.lit(1)).alias("__n"))
    ranged = staged(counts.repartitionByRange(n, *[c.asc_nulls_last() for c in g], v.desc_nulls_last())
                    .withColumn("__p", F.spark_partition_id()), "rank-ranges")
    above = Window.partitionBy(*g).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    off_keys = [f"__o{i}" for i in range(len(group_cols))]
    offsets = ranged.groupBy(*g, "__p").agg(F.sum("__n").alias("__pn")).select(
        *[F.col(c).alias(k) for c, k in zip(group_cols, off_keys)], F.col("__p").alias("__op"),
        F.coalesce(F.sum("__pn").over(above), F.lit(0)).alias("__off"))
    greater = (Window.partitionBy(*g, "__p").orderBy(v.desc_nulls_last())
               .rowsBetween(Window.unboundedPreceding, -1))
    within = ranged.select(*g, v, "__p", F.coalesce(F.sum("__n").over(greater), F.lit(0)).alias("__in"))
    keys = [f"__c{i}" for i in range(len(group_cols))]
    ranks = (within.join(offsets, _same(within, offsets, group_cols, off_keys) & (within["__p"] == offsets["__op"]))
             .select(*[F.col(c).alias(k) for c, k in zip(group_cols, keys)], v.alias("__v"),
                     (F.lit(1) + F.col("__off") + F.col("__in")).cast("int").alias(rank_col)))
    on_rows = _same(df, ranks, group_cols, keys) & df[value_col].eqNullSafe(ranks["__v"])
    return df.join(ranks, on_rows, "inner").select(*df.columns, rank_col)
