"""Intermediate tables in the cluster's shared folder.

A staged table cuts lineage: it is written as Parquet below
``spark.checkpoint.dir`` (``tillroll.session.scratch_dir``) and read back, so
a lost executor costs a re-read and not a recomputation.
"""

from __future__ import annotations

import contextlib
import pickle

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillroll.session import scratch_dir

# For writes made here: shuffle files are dropped when the write that made them
# ends, and Python tasks get batches of at most this many bytes.
WHILE_STAGING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


@contextlib.contextmanager
def early_cleanup(spark: SparkSession):
    """The settings of WHILE_STAGING for what is written inside the block."""
    before = {k: spark.conf.get(k, None) for k in WHILE_STAGING}
    try:
        for k, v in WHILE_STAGING.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder and return it as read back."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    with early_cleanup(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_table(spark: SparkSession, df: DataFrame) -> None:
    """Delete a staged table that nothing will read again."""
    jvm = spark._jvm
    for folder in sorted({f.rsplit("/", 1)[0] for f in df.inputFiles()}):
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def share(spark: SparkSession, value):
    """Broadcast ``value`` for Python tasks; call the result to get it there.
    It travels by value like the functions, so executors need no package."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(sent.value)


def lowest(df: DataFrame, hash_col: str, n: int) -> DataFrame:
    """The ``n`` rows of smallest 64-bit hash. A first cut at the hash below
    which about 1.5 n rows are expected keeps what tasks send for the final
    order near n rows in all, not n from each task."""
    rows = df.count()
    if rows > max(4 * n, 1.5 * n + 1000):
        df = df.where(F.col(hash_col) < int(-2**63 + 2**64 * (1.5 * n + 1000) / rows))
    return df.orderBy(hash_col).limit(n)
