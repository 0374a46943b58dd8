"""Discovery, header contract, quarantine and the conformed batch
(S1, S2, S4-S6, V1-V4, P1-P3, U1) on the file cases of FIXTURES.md."""

from __future__ import annotations

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import CSV_HEADER, sales_csv_lines, write_file
from tillroll.errors import NoInputError
from tillroll.operators import contract
from tillroll.schemas import SALE_COLUMNS
from tillroll.session import staged
from tillroll.sources import files

BASE = [(1, 121, "2023-03-03", 1, "100.00"), (2, 121, "2023-03-15", 2, "100.00")]


def landing_with_all_cases(root: str) -> str:
    land = os.path.join(root, "landing")
    write_file(land, "base.csv", "\n".join([CSV_HEADER] + sales_csv_lines(BASE)) + "\n")
    rev = list(reversed(CSV_HEADER.split(",")))
    write_file(land, "permuted.csv", ",".join(rev) + "\n" + "4.50,1,4.50,1,2023-03-10,Salt,121,1\n")
    write_file(land, "sub/extra.csv",
               CSV_HEADER + ",payment_mode,coupon\n"
               "3,122,Rice,2023-03-21,5,100,1,100,UPI,X1\n"
               "3,122,Rice,2023-03-22,5,10,1,10,cash,\n"
               "3,122,Rice,2023-03-23,5,10,1,10,,\n")
    write_file(land, "missing.csv",
               "customer_id,product_name,sales_date,sales_person_id,price,quantity,total_cost,payment_mode\n"
               "1,Rice,2023-03-01,\"[1, 2]\",10,1,10,cash\n")
    write_file(land, "empty.csv", "")
    write_file(land, "header_only.csv", CSV_HEADER + "\n")
    write_file(land, "badtype.csv", CSV_HEADER + "\n1,121,Oil,2023-04-01,1,5,x,5\n2,121,Oil,2023-04-02,2,5,1,5\n")
    write_file(land, "fraction.csv", CSV_HEADER + "\n4,121,Salt,2023-05-01,6,1.5,3,4.5\n")
    write_file(land, "notes.txt", "not a sales file\n")
    return land


def verdict_map(v):
    return {r.file_name: r for r in v.collect()}


def test_contract_verdicts(spark, workdir):
    land = landing_with_all_cases(workdir)
    manifest = files.discover(spark, land)
    # Spark's file listing skips zero-byte files: empty.csv is never seen.
    assert manifest.count() == 8
    v = verdict_map(contract.check_contract(manifest))
    assert "empty.csv" not in v
    accepted = {n for n, r in v.items() if r.accepted}
    assert accepted == {"base.csv", "permuted.csv", "extra.csv", "header_only.csv", "badtype.csv",
                        "fraction.csv"}
    assert v["missing.csv"].reason == contract.REASON_MISSING
    assert v["missing.csv"].missing == ["store_id"]
    assert v["missing.csv"].extras == ["payment_mode"]
    assert v["notes.txt"].reason == contract.REASON_NOT_CSV
    assert v["extra.csv"].extras == ["payment_mode", "coupon"]
    assert v["base.csv"].missing == [] and v["base.csv"].extras == []


def test_read_accepted_binds_by_name_and_folds_extras(spark, workdir):
    land = landing_with_all_cases(workdir)
    batch = contract.read_accepted(spark, contract.check_contract(files.discover(spark, land)))
    sale = batch.sale
    assert sale.columns[:9] == SALE_COLUMNS
    rows = sale.collect()
    by_file = {}
    for r in rows:
        by_file.setdefault(os.path.basename(r.source_file), []).append(r)
    assert len(rows) == 2 + 1 + 3 + 0 + 1 + 1
    (perm,) = by_file["permuted.csv"]
    assert (perm.customer_id, perm.store_id, perm.product_name, perm.total_cost) == (1, 121, "Salt", Decimal("4.50"))
    assert perm.additional_column is None
    assert sorted(r.additional_column for r in by_file["extra.csv"]) == ["", "UPI, X1", "cash"]
    assert all(r.additional_column is None for r in by_file["base.csv"])
    (frac,) = by_file["fraction.csv"]
    assert frac.price == Decimal("1.50") and frac.total_cost == Decimal("4.50")
    assert "header_only.csv" not in by_file
    (good,) = by_file["badtype.csv"]
    assert good.customer_id == 2
    bad = batch.bad_rows.collect()
    assert len(bad) == 1 and bad[0].record.startswith("1,121,Oil")


def test_quarantine_copies_rejected_files_as_they_are(spark, workdir):
    land = landing_with_all_cases(workdir)
    with open(os.path.join(land, "book.xlsx"), "wb") as f:
        f.write(bytes(range(256)) * 4)
    write_file(land, "a/notes.txt", "second\r\nfirst\n\nlast without end")
    error = os.path.join(workdir, "error")
    for _ in range(2):          # a run repeated replaces its copies
        v = contract.check_contract(files.discover(spark, land))
        contract.quarantine(spark, v, error, "r1")
    rejects = spark.read.parquet(os.path.join(error, "rejects"))
    assert sorted(r.file_name for r in rejects.collect()) == ["book.xlsx", "missing.csv", "notes.txt", "notes.txt"]
    copies = copied(spark, error)
    assert len(copies) == 4
    for r in v.where("not accepted").collect():
        with open(r.location.removeprefix("file:"), "rb") as f:
            assert copies[r.path] == f.read()


def copied(spark, error):
    """Bytes of the copied files: their chunks in order."""
    rows = sorted(spark.read.parquet(os.path.join(error, "files")).collect(), key=lambda r: (r.path, r.start, r.seq))
    out = {}
    for r in rows:
        out[r.path] = out.get(r.path, b"") + bytes(r.content)
    return out


def test_files_above_the_split_size_are_copied_byte_for_byte(spark, workdir, monkeypatch):
    import random

    rng = random.Random(5)
    binary = bytes(rng.randrange(256) for _ in range(200_000))
    cases = {"binary.bin": binary, "feeds.bin": b"\n" * 50_000, "zeros.bin": bytes(70_000), "text.txt": b"line of text\r\n" * 9_000,
             "open.txt": b"abc\n" * 20_000 + b"last", "mark.txt": b"\xef\xbb\xbf" + b"x\ny" * 30_000, "mark2.txt": b"\xef\xbb\xbfa\n",
             "onlymark.txt": b"\xef\xbb\xbf", "one.txt": b"\n", "two.txt": b"\r\n", "x.dat": b"x", "packed.gz": binary, "marks.txt": b"\xef\xbb\xbf\xef\xbb\xbf\n",
             "inner.txt": b"a\xef\xbb\xbf\n\xef\xbb\xbfb"}
    land = os.path.join(workdir, "landing")
    for name, data in cases.items():
        with open(write_file(land, name, ""), "wb") as f:
            f.write(data)
    v = contract.check_contract(files.discover(spark, land))
    from tillroll.sources import copies
    monkeypatch.setattr(copies, "CHUNK_BYTES", 5_000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
        chunks = contract.quarantine(spark, v, os.path.join(workdir, "error"), "r")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = {os.path.basename(p): b for p, b in copied(spark, os.path.join(workdir, "error")).items()}
    assert got == cases
    assert chunks.where("file_name = 'binary.bin'").select("start").distinct().count() > 5
    assert {r.file_name: r.n_ends for r in contract.line_ends(chunks).collect()} == {n: d.count(b"\n") for n, d in cases.items()}


def test_many_headers_are_one_scan(spark, workdir):
    import random

    rng, land, want = random.Random(2), os.path.join(workdir, "landing"), set()
    columns = CSV_HEADER.split(",") + ["mode", "note"]
    for k in range(500):
        row = dict(zip(columns, [str(k), "121", f'Oil, "{k}"', "2023-04-02", "2", "5.5", "1", "5.50", "UPI", ""]))
        names = rng.sample(columns, len(columns))
        quoted = ['"' + row[c].replace('"', '""') + '"' if c == "product_name" else row[c] for c in names]
        write_file(land, f"f{k}.csv", ",".join(names) + "\n" + ",".join(quoted).replace('""', '\\"') + "\n")
        want.add((k, f'Oil, "{k}"', Decimal("5.50"), "UPI"))
    v = staged(contract.check_contract(files.discover(spark, land)), "v")
    rows = contract.read_accepted(spark, v).rows
    plan = rows._jdf.queryExecution().toString()
    assert plan.count("FileScan csv") == 1
    assert {(r.customer_id, r.product_name, r.total_cost, r.additional_column) for r in rows.collect()} == want
    assert {r.additional_column for r in rows.collect()} == {"UPI"}


def test_bad_rows_and_values_as_the_csv_reader_sees_them(spark, workdir):
    land = os.path.join(workdir, "landing")
    lines = ["1,121,Oil,2023-04-01,1,5,1,5", "x,121,Oil,2023-04-01,1,5,1,5", "3,121,Oil,2023-4-1,1,5,1,5", "4,121,Oil,2023-04-01,1,5,1",
             "5,121,Oil,2023-04-01,1,5,1,5,9", '6,121,"a ""b"" c",2023-04-01,1,"1,000.25",1,5', "7,121,,,,,,", " 8,121,Oil,2023-04-01,1,5,1,5",
             '9,121,"x,y",2023-04-01,1,bad,1,5', CSV_HEADER]
    write_file(land, "a.csv", CSV_HEADER + "\n" + "\n".join(lines) + "\n")
    v = contract.check_contract(files.discover(spark, land))
    rows = contract.read_accepted(spark, v).rows.collect()
    # The typed, header-bound scan of the same file.
    from tillroll.sources.csv import scan_csv
    typed = {i: r for i, r in enumerate(scan_csv(spark, [os.path.join(land, "a.csv")], CSV_HEADER.split(",")).collect())}
    assert len(rows) == len(lines)
    for i, r in enumerate(rows):
        assert (r.record is None) == (typed[i]["_corrupt_record"] is None), lines[i]
        assert [r[c] for c in CSV_HEADER.split(",")] == [typed[i][c] for c in CSV_HEADER.split(",")] or r.record
        assert r.record in (None, lines[i])


def test_small_files_are_probed_many_to_a_task(spark, workdir, monkeypatch):
    from tillroll.sources import csv as csv_source

    land = os.path.join(workdir, "landing")
    for k in range(300):
        write_file(land, f"f{k}.csv", ("\ufeff" if k % 7 == 0 else "") + f"a{k},b" + ("\r\n", "\n", "\r", "")[k % 4] + ("1,2\n" if k % 4 != 3 else ""))
    manifest = files.discover(spark, land)
    locations = [r.location for r in manifest.collect()]
    assert csv_source.first_lines(spark, locations, packed=True).rdd.getNumPartitions() < 60
    small = {r.path: (r.header_line, tuple(r.header)) for r in csv_source.probe_headers(manifest).collect()}
    monkeypatch.setattr(csv_source, "SMALL_FILE", 8)          # the other way to the same lines
    assert {r.path: (r.header_line, tuple(r.header)) for r in csv_source.probe_headers(manifest).collect()} == small
    assert {v[0] for v in small.values()} == {f"a{k},b" for k in range(300)}


def test_lines_of_data_do_not_reach_python_in_the_probe(spark, workdir):
    from tillroll.sources import csv as csv_source

    land = os.path.join(workdir, "landing")
    for k in range(3):
        write_file(land, f"f{k}.csv", f"a{k},b\n" + "1,2\n" * 200_000)
    locations = [r.location for r in files.discover(spark, land).collect()]
    for packed in (True, False):
        lines = csv_source.first_lines(spark, locations, packed)
        assert sorted(r.line for r in lines.collect()) == ["a0,b", "a1,b", "a2,b"]
        assert "MapInArrow" not in lines._jdf.queryExecution().toString()


def test_header_of_a_file_in_many_splits(spark, workdir, monkeypatch):
    from tillroll.sources import csv as csv_source

    land = os.path.join(workdir, "landing")
    for k in range(3):
        write_file(land, f"f{k}.csv", f"a{k},b" + ("\n", "\r\n", "\r")[k] + "1,2\n" * 5000)
    locations = [r.location for r in files.discover(spark, land).collect()]
    split = "spark.sql.files.maxPartitionBytes"
    probe = spark.newSession()
    probe.conf.set(split, "1024")
    monkeypatch.setattr(spark, "newSession", lambda: probe)
    lines = csv_source.first_lines(spark, locations, packed=False)
    assert lines.rdd.getNumPartitions() > 30
    assert sorted(r.line for r in lines.collect()) == ["a0,b", "a1,b", "a2,b"]


ODD_NAMES = ["day 1.csv", "a#b.csv", "a%20b.csv", "verkäufe.csv", "x[1]{2}.csv", "what?*.csv", "sub dir/ü ü.CSV", "plus+&=.csv"]


def test_odd_file_names(spark, workdir):
    land = os.path.join(workdir, "landing")
    for k, name in enumerate(ODD_NAMES):
        write_file(land, name, CSV_HEADER + f"\n{k},121,Oil,2023-04-02,2,5,1,5\n")
    write_file(land, "bad file#1%.txt", "kept\n")
    v = contract.check_contract(files.discover(spark, land))
    assert {r.file_name for r in v.where("accepted").collect()} == {os.path.basename(n) for n in ODD_NAMES}
    sale = contract.read_accepted(spark, v).sale.collect()
    assert sorted(r.customer_id for r in sale) == list(range(len(ODD_NAMES)))
    # One spelling of a file everywhere: the scan reports the manifest's paths.
    assert {r.source_file for r in sale} == {r.path for r in v.where("accepted").collect()}
    contract.quarantine(spark, v, os.path.join(workdir, "error"), "r1")
    (copy,) = spark.read.parquet(os.path.join(workdir, "error", "files")).collect()
    assert (copy.file_name, bytes(copy.content)) == ("bad file#1%.txt", b"kept\n")


def test_header_of_any_length(spark, workdir):
    land = os.path.join(workdir, "landing")
    names = [f"surplus column number {i}" for i in range(80_000)]
    line = CSV_HEADER + "," + ",".join(names)
    assert len(line) > 2_000_000
    write_file(land, "wide.csv", line)
    (r,) = contract.check_contract(files.discover(spark, land)).collect()
    assert r.accepted and r.header_line == line and r.extras[-1] == names[-1] and len(r.extras) == len(names)


def test_repeated_columns_reject_only_their_file(spark, workdir):
    land = os.path.join(workdir, "landing")
    write_file(land, "good.csv", CSV_HEADER + "\n1,121,Oil,2023-04-02,2,5,1,5\n")
    write_file(land, "twice.csv", CSV_HEADER + ",mode,coupon, Mode\n1,121,Oil,2023-04-02,2,5,1,5,a,b,c\n")
    write_file(land, "bom.csv", "\ufeff" + CSV_HEADER + "\n2,121,Oil,2023-04-02,2,5,1,5\n")
    v = contract.check_contract(files.discover(spark, land))
    got = verdict_map(v)
    assert got["twice.csv"].reason == contract.REASON_REPEATED and not got["twice.csv"].accepted
    assert got["good.csv"].accepted and got["bom.csv"].accepted
    assert 1 in {r.customer_id for r in contract.read_accepted(spark, v).sale.collect()}


def test_no_input_is_an_error(spark, workdir):
    os.makedirs(os.path.join(workdir, "empty_landing"))
    with pytest.raises(NoInputError):
        files.require_input(files.discover(spark, os.path.join(workdir, "empty_landing")), "file")


def test_only_rejected_files_is_an_error(spark, workdir):
    land = os.path.join(workdir, "landing")
    write_file(land, "notes.txt", "x\n")
    v = contract.check_contract(files.discover(spark, land))
    with pytest.raises(NoInputError):
        contract.read_accepted(spark, v)


def test_active_sources(spark):
    reg = spark.createDataFrame([("b1", "s3a://b1/in/", "Active"), ("b2", "s3a://b2/in/", "inactive"),
                                 ("b3", "s3a://b3/in/", " ACTIVE ")],
                                "bucket_name string, file_location string, status string")
    assert sorted(files.active_roots(reg)) == ["s3a://b1/in/", "s3a://b3/in/"]
    assert files.active_sources(reg).where(F.col("bucket_name") == "b2").isEmpty()
