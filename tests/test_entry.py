"""The driver contract: entry(), queries() and oracle_sql(), checked against
DuckDB on the smallest benchmark tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
# Quick, SQL-checked queries covering marts, joins, windows and the ledger.
FAST = ["sales_team_monthly", "customer_monthly", "rank_sellers", "window_total_customer",
        "enriched_sales", "extra_columns_folded", "ledger_state", "ledger_unfinished",
        "source_registry_active", "preview", "sale_canonical", "join_store", "join_sales_team",
        "distinct_rows", "ledger_pending", "window_total_seller", "full_name_concat", "month_bucket"]

needs_data = pytest.mark.skipif(not os.path.exists(SF), reason="benchmark tables not present")


def test_every_query_has_an_oracle():
    from tillroll.plans.catalog import REGISTRY

    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(REGISTRY) <= set(E.oracle_sql())


@needs_data
def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["store_id", "sales_person_id", "full_name", "sales_month", "total_sales", "incentive"]
    assert df.count() > 0


@needs_data
@pytest.mark.parametrize("name", FAST)
def test_query_matches_duckdb(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    got = sorted(tuple(str(r[c]) for c in sorted(df.columns)) for r in df.collect())
    idx = [ocols.index(c) for c in sorted(ocols)]
    exp = sorted(tuple(str(row[i]) for i in idx) for row in cur.fetchall())
    assert got == exp
