"""Session helpers.

The library never builds its own cluster session: every public function takes
the caller's ``SparkSession``. ``local_session`` exists for tests and the
bench only. ``scratch_dir`` gives the shared folder that jobs use to cut
lineage or stage intermediate tables; on a cluster it is the folder named by
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tillroll.errors import ConfigError

# Settings the engine's results depend on (time zone, ANSI) or that keep the
# plans adaptive. Applied to local sessions; on a cluster they belong in the
# job's spark-defaults.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only what is proven small: a side hinted after a bounded row
    # count (tillroll.operators.sizing), or one that AQE measured at run
    # time. No broadcast from static size estimates (for Parquet that is the
    # compressed file size, not the in-memory size).
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    # Checkpoint files (rank_desc) are removed once their DataFrame is gone.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Local mode only: on a few MB of test data AQE's default 1 MB minimum
# coalesces a shuffle into 2-3 tasks, which leaves most cores idle when a
# partitioned write emits thousands of small files. At cluster scale every
# partition is far above either size, so this changes nothing there.
LOCAL_CONF = {
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256KB",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "tillroll", extra: dict | None = None) -> SparkSession:
    """A local-mode session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("TILLROLL_DRIVER_MEMORY", "8g")))
    for k, v in {**RECOMMENDED_CONF, **LOCAL_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# Seconds between two collections for the sake of shuffle files.
FREE_EVERY_S = 5
_freed_at = float("-inf")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    The cluster names it in ``spark.checkpoint.dir``; only in local mode, when
    that is unset (tests), is a fresh folder made here. On a cluster a folder
    of the driver's machine would be invisible to the executors, so an unset
    folder is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ConfigError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="tillroll-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tillroll-{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to a new scratch folder and read back: cuts
    lineage and lets several readers share one computation, without keeping
    anything on an executor's own disk."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged_meanwhile(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """As :func:`staged`, for the length of a block: its folder is deleted
    when the block ends, and the shuffle files of the jobs in it are freed."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    try:
        df.write.option("compression", "zstd").parquet(path)
        free_shuffles(spark)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete_folder(spark, path)
        free_shuffles(spark)


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Have the shuffle files of finished jobs deleted. Spark does that once
    the driver's JVM has collected the frames they were made for, which a
    driver with free memory puts off for up to ``spark.cleaner.periodicGC.interval``.
    What the first collection lets go of still holds on to them, so there are two.
    Within ``FREE_EVERY_S`` of the last time nothing is done: little was written."""
    global _freed_at
    if time.monotonic() - _freed_at < FREE_EVERY_S:
        return
    gc.collect()
    spark._jvm.System.gc()
    time.sleep(0.2)
    spark._jvm.System.gc()
    _freed_at = time.monotonic()
