"""CSV header probe (S2) and the CSV scans.

The probe reads headers through Spark's own text reader, so it sees what the
scan sees: any file system, any file name, any header length. Small files are
packed, many to a task; large ones are cut into splits, one to a task, of which
only a file's first line is kept. The JVM does both, so only headers, never the
lines of data, go on to Python.

``scan_positions`` reads files with the same number of columns in one scan, as
text values by position, which the files' layouts then name (``conform``).
``scan_csv`` reads files that share one header with typed columns,
``enforceSchema=false``, so Spark checks every file's header against it.

A file has two spellings: ``path`` (``_metadata.file_path``) is its identity
everywhere, ``location`` is the plain form that readers take.
"""

from __future__ import annotations

import csv
import io
import re
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.schemas import MANDATORY_TYPES
from tillroll.session import scratch_dir

CORRUPT_COLUMN = "_corrupt_record"
ONE_SPLIT_PER_TASK = str(1 << 40)
# Files up to this size are probed many to a task; each counts as PACKED_COST bytes more.
SMALL_FILE = 4 << 20
PACKED_COST = 256 << 10

# Options of every parse of sales data.
CSV_OPTIONS = {"mode": "PERMISSIVE", "dateFormat": "yyyy-MM-dd"}

FIRST_LINES = "path string, line string"
PROBED_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("header_line", T.StringType()),
    T.StructField("raw_header", T.ArrayType(T.StringType())),
    T.StructField("header", T.ArrayType(T.StringType())),
])


def literal_path(location: str) -> str:
    """A plain path with the characters escaped that readers take for globs."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", location)


def _parse_header(line: str) -> list[str]:
    # A header may hold more or longer names than the csv module's default allows.
    csv.field_size_limit(max(csv.field_size_limit(), len(line) + 1))
    return next(csv.reader(io.StringIO(line)), [])


def _parse_headers(batches):
    import pyarrow as pa

    for batch in batches:
        lines = [(line or "").removeprefix("\ufeff") for line in batch.column("line").to_pylist()]
        raw = [_parse_header(line) for line in lines]
        yield pa.RecordBatch.from_arrays(
            [batch.column("path"), pa.array(lines, pa.string()), pa.array(raw, pa.list_(pa.string())),
             pa.array([[c.strip() for c in r] for r in raw], pa.list_(pa.string()))],
            names=["path", "header_line", "raw_header", "header"])


def probe_headers(csv_files: DataFrame) -> DataFrame:
    """(path, header_line, raw_header, header) for every file that has a line.

    ``header`` has the names trimmed; ``raw_header`` keeps them as written.
    The locations are taken to the driver because Spark's file readers take
    paths there, as their file index does.
    """
    spark = csv_files.sparkSession
    small, large = [], []
    for r in csv_files.select("location", "length").toLocalIterator():
        (small if r["length"] <= SMALL_FILE else large).append(literal_path(r["location"]))
    if not small and not large:
        return spark.createDataFrame([], PROBED_SCHEMA)
    _ship_by_value()
    # The lines are written before they are parsed: a split without a first
    # line, as most of a large file's are, starts no Python worker.
    lines, out = scratch_dir(spark, "first-lines"), scratch_dir(spark, "headers")
    for files, packed in ((small, True), (large, False)):
        if files:
            first_lines(spark, files, packed).write.mode("append").parquet(lines)
    spark.read.schema(FIRST_LINES).parquet(lines).mapInArrow(_parse_headers, PROBED_SCHEMA).write.parquet(out)
    return spark.read.schema(PROBED_SCHEMA).parquet(out)


def first_lines(spark: SparkSession, locations: list[str], packed: bool) -> DataFrame:
    """(path, line): the first line of each file."""
    # Settings of the probe's scan alone, in a session of its own.
    probe = spark.newSession()
    if packed:
        probe.conf.set("spark.sql.files.openCostInBytes", str(PACKED_COST))
        text = probe.read.text(locations, wholetext=True)
        return text.select(F.col("_metadata.file_path").alias("path"), F.regexp_extract("value", r"^([^\r\n]*)", 1).alias("line"))
    probe.conf.set("spark.sql.files.openCostInBytes", ONE_SPLIT_PER_TASK)
    # Rows are numbered within their partition, which is one split; the line of
    # number 0 in a file's first split is the file's first.
    lines = probe.read.text(locations).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"),
        F.col("_metadata.file_block_start").alias("start"), (F.monotonically_increasing_id() % (1 << 33)).alias("n"))
    return lines.where("start = 0 AND n = 0").select("path", "line")


def _ship_by_value() -> None:
    """Serialize this module's functions with the task instead of by
    import path, so the Python workers need only pyarrow, not this package."""
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])


def read_schema(raw_header: list[str], with_corrupt: bool = True) -> T.StructType:
    """Read schema in the file's column order: mandatory columns typed,
    surplus columns as strings, plus the corrupt-record column."""
    fields = []
    for raw in raw_header:
        name = raw.strip()
        fields.append(T.StructField(raw, MANDATORY_TYPES.get(name, T.StringType()), True))
    if with_corrupt:
        fields.append(T.StructField(CORRUPT_COLUMN, T.StringType(), True))
    return T.StructType(fields)


def scan_csv(spark: SparkSession, locations: list[str], raw_header: list[str]) -> DataFrame:
    """Read files sharing ``raw_header`` with declared types.

    PERMISSIVE mode keeps a row whose value does not parse and puts its text
    in ``_corrupt_record`` (the caller routes those rows to the rejects).
    Columns come out renamed to trimmed names, plus ``source_file``.
    """
    df = (spark.read.schema(read_schema(raw_header))
          .option("header", "true").option("enforceSchema", "false")
          .options(**CSV_OPTIONS).option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
          .csv([literal_path(p) for p in locations]))
    renamed = [F.col(f"`{raw}`").alias(raw.strip()) for raw in raw_header]
    return df.select(*renamed, F.col(CORRUPT_COLUMN), F.col("_metadata.file_path").alias("source_file"))


def scan_positions(spark: SparkSession, locations: list[str], width: int) -> DataFrame:
    """S1 by position: ``__values``, a row's ``width`` texts (NULL where
    empty), ``__line``, its line if it has another number of values, and
    ``source_file``. Header lines are left out, unchecked: the probe has read them."""
    names = [f"_c{i}" for i in range(width)]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, CORRUPT_COLUMN]])
    df = (spark.read.schema(schema).option("header", "true").options(**CSV_OPTIONS)
          .option("columnNameOfCorruptRecord", CORRUPT_COLUMN).option("maxColumns", str(max(20480, width + 1)))
          .csv([literal_path(p) for p in locations]))
    return df.select(F.array(*names).alias("__values"), F.col(CORRUPT_COLUMN).alias("__line"),
                     F.col("_metadata.file_path").alias("source_file"))
