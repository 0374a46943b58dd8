"""Enrichment and marts on the golden set."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import (CUSTOMERS, GOLDEN_CUSTOMER_MONTHLY, GOLDEN_RANKS,
                      GOLDEN_SALES_TEAM_MONTHLY, as_set)
from tillroll import schemas
from tillroll.errors import DuplicateKeyError
from tillroll.functions import fold_extras, full_name, incentive, month_bucket
from tillroll.operators import enrich, marts


def enriched(g):
    return enrich.enrich(g["sale"], g["customer"], g["store"], g["sales_team"])


def test_enrich_drops_unmatched_and_names_are_unique(golden):
    e = enriched(golden)
    assert e.count() == 8
    assert len(set(e.columns)) == len(e.columns) == len(enrich.ENRICHED_COLUMNS)
    assert {r["customer_id"] for r in e.collect()} == {1, 2, 3, 4}


def test_single_joins(golden):
    s = golden["sale"]
    assert enrich.join_customer(s, golden["customer"]).count() == 10   # customer 99 gone
    assert enrich.join_store(s, golden["store"]).count() == 10         # store 999 gone
    assert enrich.join_sales_team(s, golden["sales_team"]).count() == 10  # seller 77 gone


def test_duplicate_dimension_key_is_refused(spark, golden):
    dup = golden["customer"].unionByName(spark.createDataFrame(CUSTOMERS[:1], schemas.CUSTOMER))
    with pytest.raises(DuplicateKeyError):
        enrich.enrich(golden["sale"], dup, golden["store"], golden["sales_team"])


def test_customer_monthly_golden(golden):
    m = marts.customer_monthly(marts.customer_raw_mart(enriched(golden)))
    assert m.columns == schemas.CUSTOMER_MONTHLY.fieldNames()
    assert as_set(m, ["customer_id", "full_name", "sales_date_month", "total_sales"]) == GOLDEN_CUSTOMER_MONTHLY
    assert m.schema["total_sales"].dataType == schemas.TOTAL_MONEY


def test_window_form_matches_group_by(golden):
    raw = marts.customer_raw_mart(enriched(golden))
    assert as_set(marts.window_total_customer(raw)) == as_set(marts.customer_monthly(raw))
    sraw = marts.sales_team_raw_mart(enriched(golden))
    assert as_set(marts.window_total_seller(sraw)) == as_set(marts.seller_month_totals(sraw))


def test_sales_team_monthly_golden(golden):
    m = marts.sales_team_monthly(marts.sales_team_raw_mart(enriched(golden)))
    assert m.columns == schemas.SALES_TEAM_MONTHLY.fieldNames()
    got = as_set(m, ["store_id", "sales_person_id", "sales_month", "total_sales", "incentive"])
    assert got == GOLDEN_SALES_TEAM_MONTHLY
    assert m.schema["incentive"].dataType == schemas.TOTAL_MONEY


def test_rank_window_and_group_max_agree(golden):
    raw = marts.sales_team_raw_mart(enriched(golden))
    assert as_set(marts.sales_team_monthly_ranked(raw)) == as_set(marts.sales_team_monthly(raw))
    ranked = marts.rank_sellers(marts.seller_month_totals(raw))
    assert {(r.store_id, r.sales_person_id, r.sales_month): r.rnk for r in ranked.collect()} == GOLDEN_RANKS


def test_rank_skips_after_tie(spark):
    rows = [(1, 1, "A", "2024-01", Decimal("5.00")), (1, 2, "B", "2024-01", Decimal("5.00")),
            (1, 3, "C", "2024-01", Decimal("4.00")), (1, 4, "D", "2024-01", None)]
    t = spark.createDataFrame(rows, "store_id long, sales_person_id long, full_name string, "
                                    "sales_month string, total_sales decimal(18,2)")
    ranks = {r.sales_person_id: r.rnk for r in marts.rank_sellers(t).collect()}
    assert ranks == {1: 1, 2: 1, 3: 3, 4: 4}
    tops = {r.sales_person_id: r.is_top for r in marts.mark_top_sellers(t).collect()}
    assert tops == {1: True, 2: True, 3: False, 4: False}


def test_column_functions(spark):
    df = spark.createDataFrame([("a", "b", None, "2023-07-31"), ("x", None, None, "2024-12-01")],
                               "f string, l string, n string, d string")
    r = df.select(full_name("f", "l").alias("fn"), fold_extras(["f", "l"]).alias("fx"),
                  fold_extras(["n"]).alias("empty"), fold_extras([]).alias("none"),
                  month_bucket(F.col("d").cast("date")).alias("m")).collect()
    assert [x.fn for x in r] == ["a b", None]
    assert [x.fx for x in r] == ["a, b", "x"]
    assert [x.empty for x in r] == ["", ""]
    assert [x.none for x in r] == [None, None]
    assert [x.m for x in r] == ["2023-07", "2024-12"]


def test_incentive_half_up_and_decimal(spark):
    df = spark.createDataFrame([(Decimal("104.50"),), (Decimal("0.50"),)], "t decimal(18,2)")
    r = df.select(incentive("t", F.lit(True)).alias("i"), incentive("t", F.lit(False)).alias("o")).collect()
    assert [x.i for x in r] == [Decimal("1.05"), Decimal("0.01")]
    assert [x.o for x in r] == [Decimal("0.00"), Decimal("0.00")]


def test_totals_are_conserved(golden):
    e = enriched(golden)
    total = e.agg(F.sum("total_cost")).first()[0]
    m = marts.customer_monthly(marts.customer_raw_mart(e)).agg(F.sum("total_sales")).first()[0]
    s = marts.sales_team_monthly(marts.sales_team_raw_mart(e)).agg(F.sum("total_sales")).first()[0]
    assert total == m == s == Decimal("556.50")


def test_marts_from_sales_equal_the_enriched_path(golden):
    g = golden
    direct_c = marts.customer_monthly_from_sales(g["sale"], g["customer"], g["store"], g["sales_team"])
    direct_s = marts.sales_team_monthly_from_sales(g["sale"], g["customer"], g["store"], g["sales_team"])
    assert direct_c.columns == schemas.CUSTOMER_MONTHLY.fieldNames()
    assert direct_s.columns == schemas.SALES_TEAM_MONTHLY.fieldNames()
    assert as_set(direct_c) == as_set(marts.customer_monthly(marts.customer_raw_mart(enriched(g))))
    assert as_set(direct_s) == as_set(marts.sales_team_monthly(marts.sales_team_raw_mart(enriched(g))))
    assert as_set(direct_s, ["store_id", "sales_person_id", "sales_month", "total_sales", "incentive"]) \
        == GOLDEN_SALES_TEAM_MONTHLY


def test_marts_from_sales_refuse_duplicate_keys(spark, golden):
    dup = golden["sales_team"].unionByName(golden["sales_team"].limit(1))
    with pytest.raises(DuplicateKeyError):
        marts.sales_team_monthly_from_sales(golden["sale"], golden["customer"], golden["store"], dup)


@pytest.mark.parametrize("partitions", ["8", "60"])
def test_rank_desc_equals_window_rank(spark, partitions):
    import random

    from pyspark.sql import Window
    rnd = random.Random(7)
    rows = []
    for store in (1, 2, None):
        for month in ("2024-01", None):
            for seller in range(rnd.randint(1, 40)):
                total = None if rnd.random() < 0.1 else Decimal(rnd.choice([5, 5, 7, 9, 12, 12, 12, 30])) \
                    + Decimal(rnd.randint(0, 3))
                rows.append((store, seller, month, total))
    df = spark.createDataFrame(rows, "store_id long, sales_person_id long, sales_month string, "
                                     "total_sales decimal(18,2)")
    w = Window.partitionBy("store_id", "sales_month").orderBy(F.col("total_sales").desc_nulls_last())
    expected = as_set(df.withColumn("rnk", F.rank().over(w)))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)      # 60: groups run over several ranges
    try:
        got = as_set(marts.rank_desc(df, ["store_id", "sales_month"], "total_sales"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == expected


def test_window_totals_read_the_fact_once(spark, golden):
    from tillroll.operators import enrich

    raw = marts.customer_raw_mart(enrich.enrich(golden["sale"], golden["customer"], golden["store"], golden["sales_team"]))
    plan = marts.window_total_customer(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" not in plan and "ExistingRDD" not in plan     # only the staged rows are read
