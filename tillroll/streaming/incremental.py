"""Incremental ingestion as a file stream.

The daily "list, fetch, process, archive" loop becomes a Structured
Streaming query over the landing folder: the ``binaryFile`` source lists new
files exactly once (its checkpoint remembers what it has seen), only path,
time and length are selected so no content is read, and ``foreachBatch``
runs the batch job's steps on each micro-batch's manifest. Marts are
refreshed for the months the batch touched, by dynamic partition overwrite;
``rank``-style logic runs inside the batch function, where it is allowed.

``trigger(availableNow=True)`` processes everything new and stops, so a
scheduler can run it daily; the same query also runs continuously with a
processing-time trigger. ``cleanSource=archive`` moves files that earlier
batches finished to an archive folder (Spark does this while a later batch
runs; the checkpoint and the ledger, not the archive, are the record).
"""

from __future__ import annotations

from concurrent.futures import Future

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tillroll.errors import NoInputError
from tillroll.plans.batch import BatchConfig, process_manifest
from tillroll.sources.files import BINARY_FILE_SCHEMA, file_columns, with_manifest_columns


# A first run over a long history is cut into micro-batches of so many files.
MAX_FILES_PER_TRIGGER = 10_000


def landing_stream(spark: SparkSession, landing: str, archive_dir: str | None = None,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of (path, location, modificationTime, length) for new files."""
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
              .option("recursiveFileLookup", "true"))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(landing).select(*file_columns())


def start_incremental(spark: SparkSession, cfg: BatchConfig, checkpoint: str,
                      available_now: bool = True, archive_dir: str | None = None,
                      processing_time: str | None = None,
                      max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER) -> StreamingQuery:
    """R1 + R2: start the stream; each micro-batch runs the batch steps on
    its files. The run id is made of the streaming query's id, which its
    checkpoint keeps, and the micro-batch's number: Spark replays a failed batch
    with the same files, and it supersedes its first try, while a
    stream with a new checkpoint, or another stream into the same warehouse,
    has run ids of its own. The files that it lists again are known to the
    ledger."""
    roots = cfg.roots()
    if len(roots) != 1:
        raise ValueError("a file stream watches one landing root")

    query_id: Future[str] = Future()

    def on_batch(batch_df: DataFrame, batch_id: int) -> None:
        manifest = with_manifest_columns(batch_df)
        if manifest.isEmpty():
            return
        try:
            process_manifest(batch_df.sparkSession, manifest, cfg, run_id=f"stream-{query_id.result()}-{batch_id}")
        except NoInputError:
            # Only rejected or already-closed files in this batch: nothing to publish.
            return

    writer = (landing_stream(spark, roots[0], archive_dir, max_files_per_trigger).writeStream
              .foreachBatch(on_batch).option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    query = writer.start()
    query_id.set_result(query.id)
    return query


def run_available(spark: SparkSession, cfg: BatchConfig, checkpoint: str,
                  archive_dir: str | None = None,
                  max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER) -> None:
    """Process every file that arrived since the last run, then return."""
    q = start_incremental(spark, cfg, checkpoint, available_now=True, archive_dir=archive_dir,
                          max_files_per_trigger=max_files_per_trigger)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
