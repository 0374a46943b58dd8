"""Stage a landing folder of CSV drops derived from the benchmark tables.

Each order-priority desk sends its own drop (a folder of part files) in its
own layout, so one batch holds every case of the file contract:

=================  =============================================  ==========
desk               layout                                         verdict
=================  =============================================  ==========
1-URGENT           the 8 mandatory columns in contract order      accepted
2-HIGH             the same columns in reverse order              accepted
3-MEDIUM           mandatory + ``payment_mode`` + ``coupon``      accepted
4-NOT SPECIFIED    no ``store_id``, + ``payment_mode``            rejected
4-RETURNED         ``payment_mode`` named twice                   rejected
5-LOW              contract order, but written as ``.txt``        rejected
=================  =============================================  ==========

The drops' folder names hold a blank, ``#``, ``%``, brackets and an umlaut, as
real ones do.

All rows of the source land in exactly one drop; nothing is sampled. A file
may hold sales of any dates; the job itself sorts them into months.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.schemas import MANDATORY_COLUMNS
from tillroll.session import delete_folder, free_shuffles, scratch_dir

# Desk -> (folder, layout columns, file format).
LAYOUTS: dict[str, tuple[str, list[str], str]] = {
    "1-URGENT": ("desk 1 urgent", MANDATORY_COLUMNS, "csv"),
    "2-HIGH": ("desk#2%20high", list(reversed(MANDATORY_COLUMNS)), "csv"),
    "3-MEDIUM": ("desk_3_größe", MANDATORY_COLUMNS + ["payment_mode", "coupon"], "csv"),
    "4-NOT SPECIFIED": ("desk [4]", [c for c in MANDATORY_COLUMNS if c != "store_id"] + ["payment_mode"], "csv"),
    "4-RETURNED": ("desk {4,r}", MANDATORY_COLUMNS + ["payment_mode", " payment_mode"], "csv"),
    "5-LOW": ("desk_5%", MANDATORY_COLUMNS, "txt"),
}
ACCEPTED_DESKS = ["1-URGENT", "2-HIGH", "3-MEDIUM"]


def drop_name(desk: str) -> str:
    return LAYOUTS[desk][0]


def write_drop(df: DataFrame, folder: str, columns: list[str], fmt: str) -> None:
    """Files as the rows lie in the shared folder, read once and not shuffled;
    their number follows from the bytes (``spark.sql.files.maxPartitionBytes``)."""
    out = df.select(*[F.col(c.strip()).alias(c) for c in columns])
    if fmt == "csv":
        (out.write.mode("overwrite").option("header", "true").option("ignoreLeadingWhiteSpace", "false").csv(folder))
    else:
        out.select(F.to_csv(F.struct(*columns)).alias("value")).write.mode("overwrite").text(folder)


def by_desk(source: DataFrame) -> DataFrame:
    """``source`` written once to the shared folder, a folder per desk, so
    that each drop reads only its desk's rows. The folders go by the desk's
    number, by which Spark's writer sorts faster than by its name."""
    return _by_desk(source, scratch_dir(source.sparkSession, "drops"))


@contextmanager
def desks_of(source: DataFrame) -> Iterator[DataFrame]:
    """:func:`by_desk` for the length of a block, after which the folder goes."""
    path = scratch_dir(source.sparkSession, "drops")
    try:
        rows = _by_desk(source, path)
        free_shuffles(source.sparkSession)
        yield rows
    finally:
        delete_folder(source.sparkSession, path)


def stage_sales(source: DataFrame, root: str) -> dict[str, str]:
    """All of ``source`` as drops under ``root``; returns desk -> folder."""
    with desks_of(source) as rows:
        return stage_landing(rows, root)


def _by_desk(source: DataFrame, path: str) -> DataFrame:
    number = F.array_position(F.array(*[F.lit(desk) for desk in LAYOUTS]), F.col("desk")).cast("int")
    numbered = source.withColumn("desk_no", number)
    numbered.write.partitionBy("desk_no").parquet(path)
    return source.sparkSession.read.schema(numbered.schema).parquet(path)


def stage_landing(source: DataFrame, root: str, desks: list[str] | None = None) -> dict[str, str]:
    """Write one drop per desk under ``root``, as concurrent jobs; returns
    desk -> folder. ``source`` is :func:`by_desk`'s."""
    folders = {desk: f"{root.rstrip('/')}/{drop_name(desk)}" for desk in desks or list(LAYOUTS)}
    with ThreadPoolExecutor(max_workers=len(folders), thread_name_prefix="drop") as pool:
        jobs = [pool.submit(write_drop, source.where(F.col("desk_no") == list(LAYOUTS).index(desk) + 1), folder, *LAYOUTS[desk][1:])
                for desk, folder in folders.items()]
    for job in jobs:
        job.result()
    return folders
