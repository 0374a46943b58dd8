"""Files as rows of bytes, copied by tasks in ranges (V3).

Spark's text reader hands out a file in splits, line by line, each line with
the start of its split. A task packs the lines of a split into chunks; a chunk's
place is (``start``, ``seq``). The reader leaves out a byte order mark and does not
say whether the last line has an end; both follow from the file's size, as every
byte of it is a mark's, a line's or a line end's, and are put back. So files of
any content and size are copied byte for byte; only a line (bytes up to the next
line feed) must fit into a task's memory.

Two kinds of files are read whole: those whose name makes the text reader
decompress them, and those too short to hold more than a mark.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.errors import SinkError
from tillroll.operators.sizing import broadcast_if_small
from tillroll.session import staged
from tillroll.sources.csv import literal_path

# Names that Spark's text reader decompresses; the UTF-8 byte order mark.
COMPRESSED_SUFFIXES = (".bz2", ".deflate", ".gz", ".lz4", ".passthrough", ".snappy", ".zst")
MARK = b"\xef\xbb\xbf"
CHUNK_BYTES = 1 << 20
_CHUNK = "path string, start long, seq long, ends_split boolean, content binary"


def _runs(batch):
    """(path, start, first row, row after) of a batch's runs of rows of one split."""
    import numpy as np
    import pyarrow.compute as pc

    ends = {batch.num_rows}
    for name in ("path", "start"):
        ends.update(np.asarray(pc.run_end_encode(batch.column(name)).run_ends).tolist())
    first = 0
    for end in sorted(ends - {0}):
        yield batch.column("path")[first].as_py(), batch.column("start")[first].as_py(), first, end
        first = end


def _pack_lines(size: int):
    def rows(key, seq, last, held):
        import pyarrow as pa

        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]]), pa.array([key[1]], pa.int64()), pa.array([seq], pa.int64()), pa.array([last]),
             pa.array([b"".join(held)], pa.binary())],
            names=["path", "start", "seq", "ends_split", "content"])

    def run(batches):
        import numpy as np
        import pyarrow as pa

        key, seq, held, n = None, 0, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            # The lines, with their ends, lie one after the other in the column's buffer.
            lines = batch.column("line")
            width = np.int64 if pa.types.is_large_binary(lines.type) else np.int32
            at = np.frombuffer(lines.buffers()[1], width)[lines.offset:lines.offset + len(lines) + 1]
            data = memoryview(lines.buffers()[2])
            for path, start, i, end in _runs(batch):
                if (path, start) != key:
                    if held:
                        yield rows(key, seq, True, held)
                    key, seq, held, n = (path, start), 0, [], 0
                while i < end:
                    if n >= size:
                        yield rows(key, seq, False, held)
                        seq, held, n = seq + 1, [], 0
                    # Up to the line with which the chunk reaches its size.
                    to = min(i + int(np.searchsorted(at[i:end + 1], int(at[i]) + size - n)), end)
                    held.append(bytes(data[at[i]:at[to]]))
                    n += int(at[to]) - int(at[i])
                    i = to
        if held:
            yield rows(key, seq, True, held)
    return run


def _by_lines(spark: SparkSession, locations: list[str]) -> DataFrame:
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    lines = (spark.read.option("lineSep", "\n").text([literal_path(p) for p in locations])
             .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
                     F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("line")))
    # One row per file: what the lines lack of its size, and where its last line lies.
    info = staged(lines.groupBy(F.col("path").alias("of")).agg(
        (F.max("size") - F.sum(F.octet_length("line") + 1)).alias("lack"), F.max("start").alias("last_start")), "copy-info")
    odd = info.where(~F.col("lack").isin(0, -1, len(MARK), len(MARK) - 1)).first()
    if odd:
        raise SinkError(f"{odd['of']} was changed while it was read")
    ended = lines.select("path", "start", F.concat("line", F.lit(b"\n")).alias("line"))
    chunks = ended.mapInArrow(_pack_lines(CHUNK_BYTES), _CHUNK)
    first = (F.col("start") == 0) & (F.col("seq") == 0) & (F.col("lack") >= len(MARK) - 1)
    open_end = F.col("ends_split") & (F.col("start") == F.col("last_start")) & F.col("lack").isin(-1, len(MARK) - 1)
    content = F.when(open_end, F.expr("substring(content, 1, octet_length(content) - 1)")).otherwise(F.col("content"))
    content = F.when(first, F.concat(F.lit(MARK), content)).otherwise(content)
    return chunks.join(broadcast_if_small(info), F.col("path") == F.col("of")).select("path", "start", "seq", content.alias("content"))


def chunks_of(spark: SparkSession, files: DataFrame) -> DataFrame:
    """(path, start, seq, content) of the files of a manifest (location,
    length): their bytes, in order of (start, seq). The locations go to the
    driver, where Spark's readers take their paths."""
    by_lines, whole = [], []
    for r in files.select("location", "length").toLocalIterator():
        short = r["length"] <= len(MARK) or r["location"].lower().endswith(COMPRESSED_SUFFIXES)
        (whole if short else by_lines).append(r["location"])
    out = spark.createDataFrame([], "path string, start long, seq long, content binary")
    if by_lines:
        out = _by_lines(spark, by_lines)
    if whole:
        zero = F.lit(0).cast("long")
        read = spark.read.format("binaryFile").load([literal_path(p) for p in whole]).select(
            F.col("_metadata.file_path").alias("path"), zero.alias("start"), zero.alias("seq"), "content")
        out = out.unionByName(read) if by_lines else read
    return out
