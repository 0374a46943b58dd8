"""Declared schemas. Nothing is inferred at run time.

Identifiers are BIGINT rather than the INT of the original DDL: at cluster
scale customer and seller keys pass 2^31, and a narrowing cast fails under
ANSI mode. Money is DECIMAL: (10,2) per line, (18,2) for totals.
"""

from __future__ import annotations

from pyspark.sql import types as T

LINE_MONEY = T.DecimalType(10, 2)
TOTAL_MONEY = T.DecimalType(18, 2)

# The file contract. These eight names must all be present in a
# sales file header; the ninth canonical column holds any surplus columns.
MANDATORY_COLUMNS = ["customer_id", "store_id", "product_name", "sales_date",
                     "sales_person_id", "price", "quantity", "total_cost"]
ADDITIONAL_COLUMN = "additional_column"
SALE_COLUMNS = MANDATORY_COLUMNS + [ADDITIONAL_COLUMN]

SALE = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("store_id", T.LongType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("sales_date", T.DateType()),
    T.StructField("sales_person_id", T.LongType()),
    T.StructField("price", LINE_MONEY),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("total_cost", LINE_MONEY),
    T.StructField("additional_column", T.StringType()),
])

# Types of the mandatory columns as read from CSV text.
MANDATORY_TYPES = {f.name: f.dataType for f in SALE.fields if f.name in MANDATORY_COLUMNS}

# Names of the dimensions' and marts' columns.
CUSTOMER = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("address", T.StringType()),
    T.StructField("pincode", T.StringType()),
    T.StructField("phone_number", T.StringType()),
    T.StructField("customer_joining_date", T.DateType()),
])

STORE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("address", T.StringType()),
    T.StructField("store_pincode", T.StringType()),
    T.StructField("store_manager_name", T.StringType()),
    T.StructField("store_opening_date", T.DateType()),
    T.StructField("reviews", T.StringType()),
])

PRODUCT = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("current_price", LINE_MONEY),
    T.StructField("old_price", LINE_MONEY),
    T.StructField("created_date", T.TimestampType()),
    T.StructField("updated_date", T.TimestampType()),
    T.StructField("expiry_date", T.DateType()),
])

SALES_TEAM = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("manager_id", T.LongType()),
    T.StructField("is_manager", T.StringType()),
    T.StructField("address", T.StringType()),
    T.StructField("pincode", T.StringType()),
    T.StructField("joining_date", T.DateType()),
])

# Append-only file ledger: one event row per state change of a file.
FILE_LEDGER = T.StructType([
    T.StructField("file_name", T.StringType()),
    T.StructField("file_location", T.StringType()),
    T.StructField("modified", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("event_ts", T.TimestampType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("seq", T.LongType()),
])

SOURCE_REGISTRY = T.StructType([
    T.StructField("bucket_name", T.StringType()),
    T.StructField("file_location", T.StringType()),
    T.StructField("created_date", T.TimestampType()),
    T.StructField("updated_date", T.TimestampType()),
    T.StructField("status", T.StringType()),
])

CUSTOMER_MONTHLY = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("full_name", T.StringType()),
    T.StructField("address", T.StringType()),
    T.StructField("phone_number", T.StringType()),
    T.StructField("sales_date_month", T.StringType()),
    T.StructField("total_sales", TOTAL_MONEY),
])

SALES_TEAM_MONTHLY = T.StructType([
    T.StructField("store_id", T.LongType()),
    T.StructField("sales_person_id", T.LongType()),
    T.StructField("full_name", T.StringType()),
    T.StructField("sales_month", T.StringType()),
    T.StructField("total_sales", TOTAL_MONEY),
    T.StructField("incentive", TOTAL_MONEY),
])

# Ledger states (fixed values): a file is Active while a run works on it,
# Inactive once every sink has been written, Rejected when in quarantine.
STATUS_ACTIVE = "A"
STATUS_INACTIVE = "I"
STATUS_REJECTED = "R"

# Runs of the batch job, one event per row. States of a run: C closed its files,
# X died and was given up, E wrote no sale, B holds rows that did not parse, Z its
# folders are deleted. States of a run's month: W written, K written by compaction
# (counts at once), D superseded by a compaction, V its folders are deleted.
RUN_EVENTS = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("sales_month", T.StringType()),
    T.StructField("state", T.StringType()),
])

# Partial totals of a run: per key and month the sum of the enriched sales
# (NULL when no sale has an amount).
CUSTOMER_TOTALS = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("total", T.DecimalType(28, 2)),
    T.StructField("run_id", T.StringType()),
    T.StructField("sales_month", T.StringType()),
])

SELLER_TOTALS = T.StructType([
    T.StructField("store_id", T.LongType()),
    T.StructField("sales_person_id", T.LongType()),
    T.StructField("total", T.DecimalType(28, 2)),
    T.StructField("run_id", T.StringType()),
    T.StructField("sales_month", T.StringType()),
])

# A snapshot of a mart kept by run: which runs hold each month's rows.
SNAPSHOT = T.StructType([
    T.StructField("sales_month", T.StringType()),
    T.StructField("run_id", T.StringType()),
])
