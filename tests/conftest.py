"""Shared fixtures: one local session and the golden set of FIXTURES.md."""

from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillroll import schemas  # noqa: E402
from tillroll.session import local_session  # noqa: E402

D = Decimal


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app_name="tillroll-tests")
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    # Each test gets its own folder; nothing is cleared between runs.
    return tempfile.mkdtemp(prefix="tillroll-test-")


# Golden dimensions (invented rows, FIXTURES.md "Golden set").
CUSTOMERS = [
    (1, "Ana", "Roy", "12 Hill Rd", "560001", "9000000001", dt.date(2022, 1, 5)),
    (2, "Ben", "Das", "4 Lake St", "560002", "9000000002", dt.date(2022, 2, 6)),
    (3, "Cy", "Lal", "9 Fort Ln", "560003", "9000000003", dt.date(2022, 3, 7)),
    (4, "Di", None, "1 Park Ave", "560004", "9000000004", dt.date(2022, 4, 8)),
    (5, "Ed", "Sen", "7 Mill Rd", "560005", "9000000005", dt.date(2022, 5, 9)),
]
STORES = [
    (121, "Delhi", "110001", "Asha", dt.date(2020, 1, 1), "good"),
    (122, "Pune", "411001", "Biju", dt.date(2020, 2, 1), "fine"),
    (123, "Agra", "282001", "Chet", dt.date(2020, 3, 1), None),
]
SELLERS = [
    (1, "Raj", "Ray", 10, "N", "a1", "p1", dt.date(2021, 1, 1)),
    (2, "Sam", "Sur", 10, "N", "a2", "p2", dt.date(2021, 1, 1)),
    (3, "Tia", "Tan", 10, "N", "a3", "p3", dt.date(2021, 1, 1)),
    (4, "Uma", "Urs", 10, "N", "a4", "p4", dt.date(2021, 1, 1)),
    (5, "Vik", "Ved", 10, "N", "a5", "p5", dt.date(2021, 1, 1)),
    (6, "Wes", "Wu", 10, "N", "a6", "p6", dt.date(2021, 1, 1)),
    (10, "Zed", "Zak", None, "Y", "a10", "p10", dt.date(2019, 1, 1)),
]

# (customer, store, date, seller, total_cost); the last three do not match a dimension.
SALES = [
    (1, 121, "2023-03-03", 1, "100.00"), (1, 121, "2023-03-10", 1, "4.50"),
    (2, 121, "2023-03-15", 2, "100.00"), (2, 121, "2023-04-01", 2, "52.00"),
    (1, 122, "2023-03-20", 4, "100.00"), (3, 122, "2023-03-21", 5, "100.00"),
    (2, 121, "2023-04-02", 3, "100.00"), (4, 121, "2023-05-02", 6, None),
    (99, 121, "2023-03-05", 1, "50.00"), (1, 999, "2023-03-06", 1, "50.00"),
    (1, 121, "2023-03-07", 77, "50.00"),
]

GOLDEN_CUSTOMER_MONTHLY = {
    (1, "Ana Roy", "2023-03", D("204.50")), (2, "Ben Das", "2023-03", D("100.00")),
    (2, "Ben Das", "2023-04", D("152.00")), (3, "Cy Lal", "2023-03", D("100.00")),
    (4, None, "2023-05", None),
}
# (store, seller, month, total, incentive)
GOLDEN_SALES_TEAM_MONTHLY = {
    (121, 1, "2023-03", D("104.50"), D("1.05")),
    (121, 2, "2023-03", D("100.00"), D("0.00")),
    (121, 2, "2023-04", D("52.00"), D("0.00")),
    (121, 3, "2023-04", D("100.00"), D("1.00")),
    (121, 6, "2023-05", None, None),
    (122, 4, "2023-03", D("100.00"), D("1.00")),
    (122, 5, "2023-03", D("100.00"), D("1.00")),
}
GOLDEN_RANKS = {(121, 1, "2023-03"): 1, (121, 2, "2023-03"): 2, (121, 2, "2023-04"): 2,
                (121, 3, "2023-04"): 1, (121, 6, "2023-05"): 1, (122, 4, "2023-03"): 1,
                (122, 5, "2023-03"): 1}


def sale_rows():
    out = []
    for cust, store, day, seller, total in SALES:
        out.append((cust, store, "Sugar", dt.date.fromisoformat(day), seller, None, 1,
                    None if total is None else D(total), None))
    return out


@pytest.fixture()
def golden(spark):
    return {
        "sale": spark.createDataFrame(sale_rows(), schemas.SALE),
        "customer": spark.createDataFrame(CUSTOMERS, schemas.CUSTOMER),
        "store": spark.createDataFrame(STORES, schemas.STORE),
        "sales_team": spark.createDataFrame(SELLERS, schemas.SALES_TEAM),
    }


# CSV text of the golden sales, in the contract's column order.
CSV_HEADER = "customer_id,store_id,product_name,sales_date,sales_person_id,price,quantity,total_cost"


def sales_csv_lines(rows=SALES) -> list[str]:
    lines = []
    for cust, store, day, seller, total in rows:
        t = "" if total is None else total
        lines.append(f"{cust},{store},Sugar,{day},{seller},{t},1,{t}")
    return lines


def write_file(folder: str, name: str, text: str) -> str:
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def as_set(df, cols=None):
    cols = cols or df.columns
    return {tuple(r[c] for c in cols) for r in df.collect()}
