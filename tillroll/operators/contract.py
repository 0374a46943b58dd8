"""File contract, quarantine and the conformed batch.

``check_contract`` turns a manifest into one verdict row per file;
``read_accepted`` reads the accepted files (one scan per number of columns,
however many headers there are) into the canonical sale rows and the rows that
did not parse; ``quarantine`` copies the rejected files, byte for byte, to the
error area.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.errors import NoInputError
from tillroll.operators.conform import bind_positions, layouts, union_all
from tillroll.operators.sizing import broadcast_if_small
from tillroll.schemas import MANDATORY_COLUMNS
from tillroll.sinks.writers import ZSTD
from tillroll.sources.copies import chunks_of
from tillroll.sources.csv import probe_headers, scan_positions
from tillroll.sources.files import split_by_format

# Rejection reasons.
REASON_NOT_CSV = "not_csv"
REASON_EMPTY = "empty_file"
REASON_MISSING = "missing_columns"
REASON_REPEATED = "repeated_columns"

VERDICT_COLUMNS = ["path", "location", "file_name", "modificationTime", "length", "header_line", "raw_header",
                   "header", "missing", "extras", "accepted", "reason"]


def check_contract(manifest: DataFrame) -> DataFrame:
    """V1, V2, V4 (and S5): one verdict row per file of the manifest.

    ``missing`` = mandatory names absent from the header (a non-empty set
    rejects the file); ``extras`` = header names that are not mandatory, in
    header order. Non-CSV files, files without a line and headers that name a
    column twice (in any case of letters) are rejected too; one file's
    verdict never depends on another's.
    """
    csv_files, others = split_by_format(manifest)
    probed = probe_headers(csv_files)
    mandatory = F.array(*[F.lit(c) for c in MANDATORY_COLUMNS])
    hdr = F.col("header")
    lowered = F.transform(hdr, F.lower)
    repeated = F.size(F.array_distinct(lowered)) < F.size(hdr)
    checked = (csv_files.join(probed, "path", "left")
               .withColumn("missing", F.when(hdr.isNull(), mandatory).otherwise(F.array_except(mandatory, hdr)))
               .withColumn("extras", F.when(hdr.isNull(), F.array().cast("array<string>"))
                           .otherwise(F.array_except(hdr, mandatory)))
               .withColumn("reason", F.when(hdr.isNull(), F.lit(REASON_EMPTY))
                           .when(F.size("missing") > 0, F.lit(REASON_MISSING))
                           .when(repeated, F.lit(REASON_REPEATED)))
               .withColumn("accepted", F.col("reason").isNull()))
    none = F.lit(None).cast("array<string>")
    rejected_other = others.select(
        "*", F.lit(None).cast("string").alias("header_line"), none.alias("raw_header"), none.alias("header"),
        none.alias("missing"), none.alias("extras"), F.lit(False).alias("accepted"),
        F.lit(REASON_NOT_CSV).alias("reason"))
    return checked.select(*VERDICT_COLUMNS).unionByName(rejected_other.select(*VERDICT_COLUMNS))


@dataclass
class Batch:
    rows: DataFrame        # canonical 9 columns, source_file, record, parsed
    verdicts: DataFrame    # check_contract output

    @property
    def sale(self) -> DataFrame:
        """Rows that parsed: canonical columns + source_file."""
        return self.rows.where(F.col("record").isNull()).drop("record", "parsed")

    @property
    def bad_rows(self) -> DataFrame:
        """Rows that did not: source_file, their text, what could be parsed."""
        return self.rows.where(F.col("record").isNotNull()).select("source_file", "record", "parsed")


def read_accepted(spark: SparkSession, verdicts: DataFrame) -> Batch:
    """U1 over S1: the accepted files, conformed. Files with the same number
    of columns are one scan, whatever their headers say: values are read by
    position and bound by each file's layout, one row per file, joined on the
    path. Good and bad rows come from the same parse and are told apart by
    ``record``: the line of a row with too few or too many values, and else,
    when a value does not parse, the row's values written as CSV.

    The accepted files' locations, one row each, go to the driver because
    Spark's file readers take their paths there.
    """
    accepted = verdicts.where(F.col("accepted"))
    by_width: dict[int, list[str]] = {}
    for r in accepted.select(F.size("raw_header").alias("width"), "location").toLocalIterator():
        by_width.setdefault(r["width"], []).append(r["location"])
    if not by_width:
        raise NoInputError("no file passed the contract")
    raw = union_all([scan_positions(spark, locations, width) for width, locations in sorted(by_width.items())])
    return Batch(bind_positions(raw, broadcast_if_small(layouts(accepted))), verdicts)


def slices(sizes: Iterable[tuple], target: int) -> Iterator[list]:
    """Items of ``sizes`` (item, bytes), in their order, in runs of at most
    ``target`` bytes; a larger item is a run of its own."""
    held, n = [], 0
    for item, size in sizes:
        if held and n + size > target:
            yield held
            held, n = [], 0
        held.append(item)
        n += size
    if held:
        yield held


def by_bytes(verdicts: DataFrame, target: int) -> list[DataFrame]:
    """The accepted files of ``verdicts`` in groups of about ``target``
    bytes, by ranges of their paths (a file is never split)."""
    accepted = verdicts.where(F.col("accepted"))
    # Spark orders strings by their bytes, as Python does by code points.
    sizes = sorted((r["path"], r["length"]) for r in accepted.select("path", "length").toLocalIterator())
    return [accepted.where(F.col("path").between(run[0], run[-1])) for run in slices(sizes, target)]


def quarantine(spark: SparkSession, verdicts: DataFrame, error_dir: str, run_id: str = "0") -> DataFrame:
    """V3: every rejected file as it is, and its verdict, under the run.

    ``error_dir/files/run_id=..`` holds the files in chunks of bytes
    (``content``) by their place (``start``, ``seq``), so order, line ends and
    binary formats survive whatever a file's size; tasks copy ranges of it.
    ``error_dir/rejects/run_id=..`` holds the verdicts. A run's folders are
    replaced when it is repeated. The files themselves stay where they are;
    the ledger keeps them from being taken again. Returns the chunks as written.
    """
    rejected = verdicts.where(~F.col("accepted")).select("path", "location", "file_name", "length", "reason", "missing",
                                                         file_id().alias("file_id"))
    base = error_dir.rstrip("/")
    rejected.drop("location").write.mode("overwrite").parquet(f"{base}/rejects/run_id={run_id}")
    target = f"{base}/files/run_id={run_id}"
    about = broadcast_if_small(rejected.select(F.col("path").alias("__path"), "file_name", "file_id", "reason"))
    (chunks_of(spark, rejected).join(about, F.col("path") == F.col("__path"))
     .select("path", "file_name", "file_id", "reason", "start", "seq", "content")
     .write.mode("overwrite").options(**ZSTD).parquet(target))
    return spark.read.parquet(target)


def file_id(path_col: str = "path"):
    """Stable id of a file from its identity (two drops may share a base name)."""
    return F.xxhash64(F.col(path_col))


def line_ends(copies: DataFrame) -> DataFrame:
    """One row per copied file (``quarantine``): path, file_name, file_id,
    reason and ``n_ends``, the line feeds in it."""
    feeds = F.regexp_count(F.col("content").cast("string"), F.lit("\n"))
    return copies.groupBy("path", "file_name", "file_id", "reason").agg(F.sum(feeds).cast("long").alias("n_ends"))
