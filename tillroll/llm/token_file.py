"""Token-id files: ids ranked by frequency, in byte-aligned variable-length
coding with control bytes apart from the data, in ascending document order.

Three written steps, each of which a lost executor only repeats in part:

1. documents are range-partitioned by (id, text hash), sorted within the
   partitions, encoded (bpe.py) and staged as blocks of many documents, raw
   ids in 2 or 4 bytes;
2. ids are counted over all blocks (one sum per id and task is shuffled), and
   the ids, most frequent first, are broadcast as a rank table; its size is
   the vocabulary's, whatever the corpus;
3. blocks are rewritten with ranks: 4 ids share a control byte of 2 bits each
   (bytes of the id less one), the bytes of all ids follow in a second array.

The file format is a Parquet folder ``blocks`` with one row per block (part,
block, document ids, tokens per document, control, data) and a folder
``ranks`` with (rank, token id). ``decode`` reads blocks back with table
lookups: a control byte gives four lengths at once, their running sum the
places of all ids in ``data``. A text above ``bpe.SEGMENT`` characters is encoded
segment by segment, and ids are coded ``RUN`` at a time.

Order: ascending id, null first; rows with one id by the hash of their text,
so a hot id is spread over partitions; rows alike in both are alike.
Defined results: null and empty texts are the end id alone; an empty table
gives an empty file; extra columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tillroll.llm import bpe
from tillroll.llm.staging import drop_table, early_cleanup, share, stage
from tillroll.llm.token_count import blocks
from tillroll.session import scratch_dir

END_ID = 1
RUN = 1 << 18  # ids coded at once, a multiple of four
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1  # of the four ids of a control byte


def encode_texts(texts: list[str], vocabulary: bpe.Vocabulary, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """All ids of some texts, an end id after each, and the number per text."""
    codes = bpe.Codes(texts, vocabulary)
    start, end = bpe.pieces(codes)
    unique, first, which = (np.unique(codes.piece_hash(start, end), return_index=True, return_inverse=True)
                            if len(start) else (start, start, start))
    ids, counts = vocabulary.encode_pieces(codes.codes, start[first], end[first]) if len(first) else (start, start)
    offsets = np.cumsum(counts) - counts
    # Pieces, special tokens and end ids in text order.
    lengths, begin = counts[which], offsets[which]
    extra_at = [codes.bounds[s] for s, _ in codes.special]
    extra_id = [t for _, t in codes.special]
    last = np.searchsorted(codes.doc, np.arange(codes.n_texts), "right")
    extra_at = np.concatenate([np.array(extra_at, np.int64), codes.bounds[last]])
    extra_id = np.concatenate([np.array(extra_id, np.int64), np.full(codes.n_texts, end_id)])
    pool = np.concatenate([ids, extra_id]).astype(np.int64)
    at = np.concatenate([start, extra_at])
    kind = np.concatenate([np.ones(len(start), np.int8), np.zeros(len(codes.special), np.int8) + 1,
                           np.zeros(codes.n_texts, np.int8)])  # an end id goes before what starts at its place
    order = np.lexsort([kind, at])
    begin = np.concatenate([begin, len(ids) + np.arange(len(extra_id))])[order]
    lengths = np.concatenate([lengths, np.ones(len(extra_id), np.int64)])[order]
    out = pool[bpe.ragged(begin, lengths)]
    ends = np.cumsum(lengths)[np.flatnonzero(order >= len(start) + len(codes.special))]
    return out, np.diff(np.concatenate([[0], ends]))


def encode_block(texts: list[str], vocabulary: bpe.Vocabulary, end_id: int, kind) -> tuple[np.ndarray, np.ndarray]:
    """The same as numbers of type ``kind``, for a block of texts or for one long
    text, which is encoded segment by segment."""
    if len(texts) != 1 or len(texts[0]) <= bpe.SEGMENT:
        tokens, counts = encode_texts(texts, vocabulary, end_id)
        return tokens.astype(kind), counts
    runs = [encode_texts([t], vocabulary, end_id)[0][:-1].astype(kind) for t in bpe.text_segments(texts[0])]
    tokens = np.concatenate([*runs, np.array([end_id], kind)])
    return tokens, np.array([len(tokens)])


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of numbers below 2**32."""
    runs = [_pack_run(values[a:a + RUN].astype(np.int64)) for a in range(0, len(values), RUN)]
    return b"".join(c for c, _ in runs), b"".join(d for _, d in runs)


def _pack_run(values: np.ndarray) -> tuple[bytes, bytes]:
    size = 1 + (values > 0xFF).astype(np.int64) + (values > 0xFFFF) + (values > 0xFFFFFF)
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    codes[:len(values)] = size - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    ends = np.cumsum(size)
    data = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    begin = ends - size
    for byte in range(4):
        has = np.flatnonzero(size > byte) if byte else slice(None)
        data[begin[has] + byte] = values[has] >> 8 * byte & 0xFF
    return control.astype(np.uint8).tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    codes, raw = np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8)
    out, at = np.zeros(n, np.uint32), 0
    for a in range(0, n, RUN):
        size = LENGTHS[codes[a // 4:(a + RUN) // 4]].reshape(-1)[:n - a]
        ends = at + np.cumsum(size)
        begin, run, at = ends - size, out[a:a + RUN], int(ends[-1])
        run[:] = raw[begin]
        for byte in range(1, 4):
            has = np.flatnonzero(size > byte)
            if not len(has):
                break
            run[has] |= raw[begin[has] + byte].astype(np.uint32) << np.uint32(8 * byte)
    return out


def _block_type(id_type: T.DataType, payload: list[str]) -> T.StructType:
    fields = [("part", T.IntegerType()), ("block", T.IntegerType()), ("n_ids", T.LongType()),
              ("ids", T.ArrayType(id_type)), ("counts", T.ArrayType(T.LongType()))]
    return T.StructType([T.StructField(n, t) for n, t in fields + [(p, T.BinaryType()) for p in payload]])


def _encoder(shared, end_id: int):
    def run(batches):
        vocabulary, block = shared(), 0
        kind = np.uint16 if vocabulary.size <= 1 << 16 else np.uint32
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
            for a, b in blocks(sizes):
                tokens, counts = encode_block(texts[a:b].to_pylist(), vocabulary, end_id, kind)
                ids = batch.column(0)[a:b]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([block], pa.int32()),
                     pa.array([len(tokens)], pa.int64()), pa.ListArray.from_arrays([0, len(ids)], ids),
                     pa.ListArray.from_arrays([0, len(counts)], pa.array(counts, pa.int64())),
                     pa.array([tokens.tobytes()], pa.binary())],
                    names=["part", "block", "n_ids", "ids", "counts", "raw"])
                block += 1
    return run


def _raw(value: bytes, n: int) -> np.ndarray:
    return np.frombuffer(value, np.uint16 if len(value) == 2 * n else np.uint32)


def _counter(batches):
    total = np.zeros(0, np.int64)
    for batch in batches:
        for n, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for a in range(0, n, RUN):
                counts = np.bincount(_raw(raw, n)[a:a + RUN], minlength=len(total))
                counts[:len(total)] += total
                total = counts
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["id", "n"])


def _packer(shared):
    def run(batches):
        rank = shared()
        for batch in batches:
            pairs = [pack(rank[_raw(raw, n)]) for n, raw in
                     zip(batch.column("n_ids").to_pylist(), batch.column("raw").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("part", "block", "n_ids", "ids", "counts")]
                + [pa.array([c for c, _ in pairs], pa.binary()), pa.array([d for _, d in pairs], pa.binary())],
                names=["part", "block", "n_ids", "ids", "counts", "control", "data"])
    return run


def write(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
          end_id: int = END_ID) -> None:
    """Encode every document into token files below ``path``."""
    spark = docs.sparkSession
    vocabulary = bpe.compile_file(tokenizer)
    size = max(vocabulary.size, end_id + 1)
    id_type = docs.schema[id_col].dataType
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                           F.xxhash64(text_col).alias("hash"))
               .repartitionByRange(n_parts, "id", "hash").sortWithinPartitions("id", "hash", "text")
               .select("id", "text"))
    raw = stage(ordered.mapInArrow(_encoder(share(spark, vocabulary), end_id), 
                                   _block_type(id_type, ["raw"])), "token-ids")
    counts = (raw.select("n_ids", "raw").mapInArrow(_counter, "id long, n long")
              .groupBy("id").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "id").select("id").collect())
    ids = np.array([r["id"] for r in counts], np.int64)  # at most the vocabulary's size
    rank = np.zeros(size, np.uint32)
    rank[ids] = np.arange(len(ids))
    packed = raw.mapInArrow(_packer(share(spark, rank)), _block_type(id_type, ["control", "data"]))
    with early_cleanup(spark):
        packed.write.option("compression", "none").parquet(f"{path}/blocks")
        (spark.createDataFrame([(k, int(i)) for k, i in enumerate(ids)], "rank long, token_id long").coalesce(1)
         .write.parquet(f"{path}/ranks"))
    drop_table(spark, raw)


def _decoder(shared, digest: bool):
    def run(batches):
        token_of = shared()
        for batch in batches:
            for row in range(batch.num_rows):
                n, counts = batch.column("n_ids")[row].as_py(), batch.column("counts")[row].values.to_numpy()
                ids = token_of[unpack(batch.column("control")[row].as_py(), batch.column("data")[row].as_py(), n)]
                ends = np.cumsum(counts)
                cut = [ids[a:b] for a, b in zip(ends - counts, ends)]
                payload = (pa.array([zlib.crc32(x) for x in cut], pa.int64()) if digest
                           else pa.array([x.astype(np.int64) for x in cut], pa.list_(pa.int64())))
                doc = batch.column("ids")[row].values
                yield pa.RecordBatch.from_arrays(
                    [batch.column("part")[row:row + 1].take(pa.array(np.zeros(len(doc), np.int64))),
                     batch.column("block")[row:row + 1].take(pa.array(np.zeros(len(doc), np.int64))),
                     pa.array(np.arange(len(doc))), doc, pa.array(ends - counts), pa.array(counts), payload],
                    names=["part", "block", "place", "id", "before", "n_tokens", "payload"])
    return run


def read(spark: SparkSession, path: str, id_col: str = "doc_id", digest: bool = False) -> DataFrame:
    """Documents of token files: id, start, n_tokens and token_ids, or with
    ``digest`` the ids' unsigned crc32 as ids_crc32."""
    files = spark.read.parquet(f"{path}/blocks")
    token_of = np.array([r["token_id"] for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()], "<u4")
    id_type = files.schema["ids"].dataType.elementType
    payload = T.LongType() if digest else T.ArrayType(T.LongType())
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("block", T.IntegerType()),
                           T.StructField("place", T.LongType()), T.StructField("id", id_type),
                           T.StructField("before", T.LongType()), T.StructField("n_tokens", T.LongType()),
                           T.StructField("payload", payload)])
    docs = files.mapInArrow(_decoder(share(spark, token_of), digest), schema)
    # Ids before each block: by part over one row per part, then within the part.
    sizes = files.select("part", "block", "n_ids")
    in_part = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    over_parts = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(over_parts), F.lit(0)).alias("part_start"))
    starts = (sizes.select("part", "block", F.coalesce(F.sum("n_ids").over(in_part), F.lit(0)).alias("block_start"))
              .join(parts, "part"))
    return (docs.join(starts, ["part", "block"])
            .select(F.col("id").alias(id_col),
                    (F.col("part_start") + F.col("block_start") + F.col("before")).cast("long").alias("start"),
                    "n_tokens", F.col("payload").alias("ids_crc32" if digest else "token_ids")))


def round_trip(docs: DataFrame, tokenizer: str, path: str | None = None) -> DataFrame:
    """Write token files and give the contract's digest of what is read back."""
    spark = docs.sparkSession
    path = path or scratch_dir(spark, "token-files")
    write(docs, path, tokenizer)
    return read(spark, path, digest=True)
