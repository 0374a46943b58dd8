"""What the job must not do again with every row: shuffle wide rows twice,
parse plain values as CSV, sample and shuffle the drops, handle lines in Python."""

from __future__ import annotations

import os

import pyarrow as pa
import pytest
from conftest import CSV_HEADER, as_set, sales_csv_lines, write_file
from pyspark.sql import functions as F

from tillroll.operators import conform, contract
from tillroll.plans import batch, landing
from tillroll.session import staged
from tillroll.sinks import writers
from tillroll.sources import copies, files
from tillroll.sources import csv as csv_source


def test_raw_marts_are_written_without_a_second_shuffle(spark, golden, workdir, monkeypatch):
    write_file(os.path.join(workdir, "landing"), "a.csv", "\n".join([CSV_HEADER, *sales_csv_lines()]) + "\n")
    plans, real = {}, writers.write_partitioned

    def write(df, path, cols, **kw):
        plans[os.path.basename(path.split("/run_id=")[0])] = (df._jdf.queryExecution().toString(), kw)
        real(df, path, cols, **kw)

    monkeypatch.setattr(writers, "write_partitioned", write)
    cfg = batch.BatchConfig(landing=[os.path.join(workdir, "landing")], warehouse=os.path.join(workdir, "w"),
                            **{n: golden[n] for n in ("customer", "store", "sales_team")})
    batch.run_batch(spark, cfg)
    for name in batch.RAW_MARTS:
        plan, kw = plans[name]
        assert kw["clustered"] and "Exchange" not in plan and "Join" not in plan
        assert batch.read_raw_mart(spark, cfg, name).count() == 8
    assert as_set(batch.read_raw_mart(spark, cfg, "sales_team_raw"), ["sales_month", "store_id"]) == {
        ("2023-03", 121), ("2023-03", 122), ("2023-04", 121), ("2023-05", 121)}


def test_plain_values_are_not_parsed_as_csv(spark, workdir, monkeypatch):
    lines = ["1,121,Oil,2023-04-01,1,5,1,5", "-2,121,,1999-12-31,1,5.5,-1,12345678.90", "3,,,,,,,"]
    write_file(workdir, "a.csv", CSV_HEADER + "\n" + "\n".join(lines) + "\n")
    v = staged(contract.check_contract(files.discover(spark, workdir)), "v")
    want = as_set(csv_source.scan_csv(spark, [os.path.join(workdir, "a.csv")], CSV_HEADER.split(",")), CSV_HEADER.split(","))
    schema = conform.F.from_csv
    monkeypatch.setattr(conform.F, "from_csv", lambda col, ddl, options: F.when(
        F.raise_error(F.lit("parsed as CSV")).isNull(), schema(col, ddl, options)))
    assert as_set(contract.read_accepted(spark, v).sale, CSV_HEADER.split(",")) == want


ODD = {"customer_id": ["007", "-0", "+5", " 5", "5 ", "1e3", "1.0", "99999999999999999999", "999999999999999999", "9223372036854775807",
                       "١٢", "0x1", '"5"', '"5\n"', "NaN", "-", '""'],
       "quantity": ["2147483647", "2147483648", "999999999", "-999999999", "1000000000", "00000000012"],
       "price": ["1.005", ".5", "5.", "1e3", "12345678.99", "123456789.00", "123456789", "-0.00", "+1.00", "1,5", '"1,000.25"', "1.5 "],
       "sales_date": ["2023-02-30", "2024-02-29", "1599-01-01", "0001-01-01", "2023-1-1", "2023-04-01 ", "10000-01-01", "2023-04-01T00:00:00", "9999-12-31", "2023-13-01"]}


@pytest.mark.parametrize("column", list(ODD))
def test_odd_values_are_what_the_csv_reader_makes_of_them(spark, workdir, column):
    names, lines = CSV_HEADER.split(","), []
    for value in ODD[column]:
        row = dict(zip(names, ["1", "121", "Oil", "2023-04-01", "1", "5", "1", "5"])) | {column: value, "product_name": f"row {len(lines)}"}
        lines.append(",".join(row.values()))
    write_file(workdir, "a.csv", CSV_HEADER + "\n" + "\n".join(lines) + "\n")
    v = staged(contract.check_contract(files.discover(spark, workdir)), "v")
    typed = csv_source.scan_csv(spark, [os.path.join(workdir, "a.csv")], names)
    good = as_set(typed.where("_corrupt_record IS NULL"), names)
    got = contract.read_accepted(spark, v)
    assert as_set(got.sale, names) == good
    assert got.bad_rows.count() == typed.cache().where("_corrupt_record IS NOT NULL").count()


def test_drops_are_read_once_and_not_shuffled(spark, workdir, monkeypatch):
    rows = [(i, 1, "p", None, 1, None, 1, None, "UPI", None, desk) for i, desk in enumerate([*landing.LAYOUTS] * 20)]
    source = spark.createDataFrame(rows, "customer_id long, store_id long, product_name string, sales_date date, sales_person_id long, price "
                                   "decimal(10,2), quantity int, total_cost decimal(10,2), payment_mode string, coupon string, desk string")
    monkeypatch.setattr(type(source), "repartitionByRange", None)
    folders = landing.stage_landing(landing.by_desk(source), os.path.join(workdir, "landing"))
    assert [f.rsplit("/", 1)[1] for f in folders.values()] == [landing.drop_name(d) for d in landing.LAYOUTS]
    for k, (desk, folder) in enumerate(folders.items()):
        lines = [r.value for r in spark.read.text(csv_source.literal_path(folder)).collect()]
        ids = {f"{i}" for i, r in enumerate(rows) if r[-1] == desk}
        place = landing.LAYOUTS[desk][1].index("customer_id")
        assert {x.split(",")[place] for x in lines if not x.startswith(("customer_id", "total_cost"))} == ids


def test_splits_without_a_first_line_start_no_python(spark, workdir, monkeypatch):
    for k in range(3):
        write_file(workdir, f"f{k}.csv", f"a{k},b\n" + "1,2\n" * 5000)
    manifest = files.discover(spark, workdir)
    probe, seen, real = spark.newSession(), [], type(manifest).mapInArrow
    probe.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    monkeypatch.setattr(spark, "newSession", lambda: probe)
    monkeypatch.setattr(csv_source, "SMALL_FILE", 8)
    monkeypatch.setattr(type(manifest), "mapInArrow", lambda df, f, schema: seen.append(df.rdd.getNumPartitions()) or real(df, f, schema))
    assert {r.header_line for r in csv_source.probe_headers(manifest).collect()} == {"a0,b", "a1,b", "a2,b"}
    assert len(seen) == 1 and seen[0] <= 8


@pytest.mark.parametrize("size", [1, 5, 6, 7, 1000])
def test_lines_are_packed_as_they_lie(size):
    data = [("p", 0, [b"ab\n", b"\n", b"cdef\n"]), ("p", 0, [b"g\n"]), ("p", 9, [b"hi\n", b"j\n"]), ("q", 9, [b"\n"])]
    batches = [pa.RecordBatch.from_arrays([pa.array([p] * len(x)), pa.array([s] * len(x), pa.int64()), pa.array(x, pa.binary())],
                                          names=["path", "start", "line"]) for p, s, x in data]
    whole = pa.Table.from_batches(batches).combine_chunks().to_batches()
    sliced = [b.slice(i, 2) for b in whole for i in range(0, b.num_rows, 2)]
    outs = [[r for b in copies._pack_lines(size)(iter(x)) for r in b.to_pylist()] for x in (batches, whole, sliced)]
    assert outs[0] == outs[1] == outs[2]
    joined = {}
    for r in outs[0]:
        key = (r["path"], r["start"])
        assert r["seq"] == len(joined.setdefault(key, []))
        joined[key].append(r)
    assert {k: b"".join(r["content"] for r in v) for k, v in joined.items()} == {
        ("p", 0): b"ab\n\ncdef\ng\n", ("p", 9): b"hi\nj\n", ("q", 9): b"\n"}
    assert all([r["ends_split"] for r in v] == [False] * (len(v) - 1) + [True] for v in joined.values())
    if size == 1:
        assert len(outs[0]) == 7
