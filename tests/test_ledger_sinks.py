"""File ledger (L1-L5, P15) and sinks (K1-K5, S3/K3 over embedded Derby)."""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import functions as F

from conftest import as_set
from tillroll.operators import ledger
from tillroll.sinks import writers
from tillroll.sources.tables import load_table, read_jdbc


def ts(h: int):
    return F.lit(f"2024-01-01 {h:02d}:00:00").cast("timestamp")


def test_ledger_state_unfinished_pending(spark):
    files = spark.createDataFrame([("in/a.csv",), ("in/b.csv",), ("in/c.csv",)], "path string")
    a_b = files.where(F.col("path") != "in/c.csv")
    ev = (ledger.open_files(files, "r1", ts(1))
          .unionByName(ledger.close_files(a_b, "r1", ts(2)))
          .unionByName(ledger.open_files(files.where(F.col("path") == "in/a.csv"), "r2", ts(3))))
    state = {r.file_location: r for r in ledger.current_state(ev).collect()}
    assert {k: v.status for k, v in state.items()} == {"in/a.csv": "A", "in/b.csv": "I", "in/c.csv": "A"}
    times = ledger.current_state(ev).where("file_location = 'in/b.csv'").select(
        F.col("created_date").cast("string"), F.col("updated_date").cast("string")).first()
    assert tuple(times) == ("2024-01-01 01:00:00", "2024-01-01 02:00:00")
    assert state["in/a.csv"].file_name == "a.csv"
    present = spark.createDataFrame([("in/a.csv",), ("in/b.csv",), ("in/d.csv",)], "path string")
    assert as_set(ledger.unfinished(ev, present), ["file_location"]) == {("in/a.csv",)}
    assert as_set(ledger.pending(present, ev), ["path"]) == {("in/a.csv",), ("in/d.csv",)}


def test_same_timestamp_is_ordered_by_seq(spark):
    files = spark.createDataFrame([("in/x.csv",)], "path string")
    ev = ledger.close_files(files, "r", ts(5)).unionByName(ledger.open_files(files, "r", ts(5)))
    assert ledger.current_state(ev).first().status == "I"


def test_ledger_roundtrip_and_missing_path(spark, workdir):
    path = os.path.join(workdir, "ledger")
    assert ledger.read(spark, path).isEmpty()
    files = spark.createDataFrame([("in/a.csv",)], "path string")
    ledger.append(ledger.open_files(files, "r1"), path)
    ledger.append(ledger.close_files(files, "r1"), path)
    assert ledger.current_state(ledger.read(spark, path)).first().status == "I"


def test_state_does_not_depend_on_the_time_zone(spark, workdir):
    path = os.path.join(workdir, "ledger")
    files = spark.createDataFrame([("in/a.csv",)], "path string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        ledger.append(ledger.open_files(files, "r1"), path)
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        ledger.append(ledger.close_files(files, "r1"), path)
        assert ledger.current_state(ledger.read(spark, path)).first().status == "I"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert ledger.current_state(ledger.read(spark, path)).first().status == "I"


def test_redelivered_file_is_a_new_file(spark):
    schema = "path string, modificationTime timestamp, length long"
    first = spark.createDataFrame([("in/d.csv", dt.datetime(2024, 1, 1), 10)], schema)
    later = spark.createDataFrame([("in/d.csv", dt.datetime(2024, 1, 2), 10)], schema)
    ev = ledger.open_files(first, "r").unionByName(ledger.close_files(first, "r"))
    assert ledger.pending(first, ev).isEmpty() and ledger.pending(later, ev).count() == 1
    rejected = ledger.reject_files(first, "r")
    assert ledger.pending(first, rejected).isEmpty() and ledger.pending(later, rejected).count() == 1


def test_only_a_missing_ledger_is_a_first_run(spark, workdir):
    import pytest

    path = write_text(workdir, "ledger", "this is no Parquet file")
    with pytest.raises(Exception):
        ledger.read(spark, path).collect()


def write_text(root, name, text):
    path = os.path.join(root, name)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_latest_snapshot_is_the_newest_of_every_month(spark, workdir):
    base = os.path.join(workdir, "snap")
    schema = "v int, m string"
    writers.write_month_snapshot(spark.createDataFrame([(1, "2023-01"), (2, "2023-02"), (3, None), (4, "2023-04")], schema),
                                 base, "m", ["2023-01", "2023-02", None, "2023-04"], snapshot_id=10)
    writers.write_month_snapshot(spark.createDataFrame([(5, "2023-02")], schema), base, "m", ["2023-02", "2023-04"], snapshot_id=20)
    got = writers.read_latest_snapshot(spark, base, spark.createDataFrame([], schema).schema, "m")
    assert as_set(got) == {(1, "2023-01"), (5, "2023-02"), (3, None)}      # 2023-04 has become empty


def test_dynamic_partition_overwrite_keeps_other_months(spark, workdir):
    path = os.path.join(workdir, "mart")
    df = spark.createDataFrame([("2023-03", 1, 1), ("2023-04", 1, 2)], "m string, s int, v int")
    writers.write_partitioned(df, path, ["m", "s"])
    writers.write_partitioned(spark.createDataFrame([("2023-04", 1, 9)], "m string, s int, v int"),
                              path, ["m", "s"])
    back = spark.read.parquet(path)
    assert as_set(back, ["m", "s", "v"]) == {("2023-03", 1, 1), ("2023-04", 1, 9)}
    assert dict((f.name, f.dataType.simpleString()) for f in back.schema.fields)["s"] == "int"


def test_snapshots_keep_history_and_latest_wins(spark, workdir):
    base = os.path.join(workdir, "snap")
    writers.write_snapshot(spark.createDataFrame([(1,)], "v int"), base, snapshot_id=10)
    writers.write_snapshot(spark.createDataFrame([(2,), (3,)], "v int"), base, snapshot_id=20)
    assert as_set(writers.read_latest_snapshot(spark, base)) == {(2,), (3,)}
    assert spark.read.parquet(base).count() == 3


def test_csv_export_has_header_and_folders(spark, workdir):
    path = os.path.join(workdir, "export")
    df = spark.createDataFrame([("A B", 7, "2023-03", 121, "1.05")],
                               "full_name string, sales_person_id int, sales_month string, store_id int, incentive string")
    writers.write_csv_export(df, path, ["sales_month", "store_id"])
    folder = os.path.join(path, "sales_month=2023-03", "store_id=121")
    part = [f for f in os.listdir(folder) if f.endswith(".csv")][0]
    with open(os.path.join(folder, part)) as f:
        assert f.readline().strip() == "full_name,sales_person_id,incentive"


def test_jdbc_roundtrip_partitioned(spark):
    url = f"jdbc:derby:memory:t_{uuid.uuid4().hex[:8]};create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df = spark.range(1, 101).select(F.col("id").alias("customer_id"), (F.col("id") * 2).alias("v"))
    writers.write_jdbc(df, url, "mart", props)
    writers.write_jdbc(df.limit(0), url, "mart", props)
    back = read_jdbc(spark, url, "mart", props, partition_column="customer_id", num_partitions=4)
    assert back.rdd.getNumPartitions() == 4
    assert back.count() == 100 and back.agg(F.sum("v")).first()[0] == 10100
    one = load_table(spark, "mart", jdbc={"url": url, "properties": props})
    assert one.count() == 100


def test_load_table_parquet_with_declared_schema(spark, workdir):
    from tillroll import schemas

    path = os.path.join(workdir, "store")
    spark.createDataFrame([(121, "Delhi", "110001", "Asha", "2020-01-01", "good")],
                          "ID int, ADDRESS string, store_pincode string, store_manager_name string, "
                          "store_opening_date string, reviews string").write.parquet(path)
    df = load_table(spark, path, schema=schemas.STORE)
    assert df.schema == schemas.STORE        # names matched case-insensitively, types cast
    r = df.first()
    assert (r.id, r.address, r.store_opening_date) == (121, "Delhi", dt.date(2020, 1, 1))
