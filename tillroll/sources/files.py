"""Landing-folder discovery and the file manifest.

The manifest is a DataFrame, one row per file: ``path`` (its identity, the
``_metadata.file_path`` that every scan reports), ``location`` (the plain form
that readers take), ``file_name``, ``modificationTime``, ``length``, ``is_csv``. Everything downstream (header
probe, contract, scan, ledger, archive) is driven by it, so no step acts on
"everything under a prefix".
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.errors import NoInputError

# binaryFile's fixed schema; a file stream over it needs it stated.
BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modificationTime", T.TimestampType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("content", T.BinaryType(), True),
])

# Fixed value: the accepted file suffix (case-insensitive).
CSV_SUFFIX = ".csv"


def with_manifest_columns(files: DataFrame) -> DataFrame:
    """Adds ``file_name`` and S5's ``is_csv`` to a frame with ``location``."""
    return (files.withColumn("file_name", F.element_at(F.split(F.col("location"), "/"), -1))
            .withColumn("is_csv", F.lower(F.col("location")).endswith(CSV_SUFFIX)))


def file_columns() -> list:
    """The columns of a ``binaryFile`` scan (batch or stream) that a manifest keeps."""
    return [F.col("_metadata.file_path").alias("path"), F.col("path").alias("location"), "modificationTime", "length"]


def discover(spark: SparkSession, roots: str | list[str]) -> DataFrame:
    """Every file under the roots, recursively, without reading content.

    ``binaryFile`` lists through the Hadoop file system (any URI, no page
    limit); selecting only path, time and length keeps the content unread.
    Hidden files (``_``/``.`` prefixes) and zero-byte files are skipped by
    Spark's listing; a zero-byte file holds neither header nor row, so it is
    neither processed nor quarantined.
    """
    paths = [roots] if isinstance(roots, str) else list(roots)
    if not paths:
        none = spark.createDataFrame([], BINARY_FILE_SCHEMA)
        return with_manifest_columns(none.select("path", F.col("path").alias("location"), "modificationTime", "length"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    return with_manifest_columns(files.select(*file_columns()))


def split_by_format(manifest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(csv files, other files)."""
    return manifest.where(F.col("is_csv")), manifest.where(~F.col("is_csv"))


def require_input(df: DataFrame, what: str) -> None:
    """Raise :class:`NoInputError` when ``df`` has no row."""
    if df.isEmpty():
        raise NoInputError(f"no {what} to process")


def active_sources(registry: DataFrame) -> DataFrame:
    """The registry rows whose status is active (any case)."""
    return registry.where(F.lower(F.trim(F.col("status"))) == "active")


def active_roots(registry: DataFrame) -> list[str]:
    """Roots to discover. The registry is configuration (a handful of rows),
    so its file locations are the one thing taken to the driver."""
    return [r["file_location"] for r in active_sources(registry).select("file_location").distinct().collect()]
