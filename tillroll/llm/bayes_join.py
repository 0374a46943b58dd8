"""Similarity join of documents on word n-grams with Bayesian candidate pruning.

Documents are sets of hashed runs of five words (runs of digits, a-z and
non-ASCII characters after lower-casing A-Z); a document of fewer words is one
run. Two documents are linked if the Jaccard similarity of their sets is at
least 0.8, counted exactly.

1. sketch: one map over whole texts gives each document its set's 128-bit hash
   and ``HASHES`` MinHash values of 16 bits;
2. classes: documents of equal sets are one class from here on;
3. bands of ``ROWS`` values put classes into buckets; a pair of similarity 0.8
   shares no bucket with probability (1 - 0.8**4)**32 < 5e-8;
4. pruning: pairs of a bucket are compared ``STEP`` MinHash values at a time; a
   pair is dropped once the posterior probability (uniform prior) that its
   similarity reaches the threshold is below ``TOLERANCE``. What is left is
   turned into clusters;
5. verification: within each cluster all pairs are counted exactly over their
   whole sets, so a pair that pruning lost is found again if its documents
   meet through others.

A bucket or cluster above a fixed block size is cut into blocks and every pair
of blocks becomes a task group of its own, so no group is ever gathered in one
task, and pairs never become rows: a group's output is at most one row per
member, with its number of links and one edge to its component's first member.

Defined results: documents without words (null, empty) have no links and stay
alone; equal ids are different documents, but are not told apart by ``keep``
if their sets are equal too; the class id is the smallest id of the component
(null only if all its ids are null); extra columns are not read by ``link``
and pass through ``keep`` untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tillroll.llm import textscan as ts
from tillroll.llm.components import components, star_edges
from tillroll.llm.grouped import groups
from tillroll.llm.staging import early_cleanup, stage

WORDS = 5
THRESHOLD = 0.8
HASHES, ROWS, STEP = 128, 4, 32
TOLERANCE = 1e-6
BUCKET_BLOCK = 512  # classes
CLUSTER_BLOCK = 1 << 17  # shingles
PAIR_ROWS = 1 << 18
SLICE = 1 << 17  # shingles handled at once

MULTIPLIERS = ts.mix(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)


def shingles(data: np.ndarray, offsets: np.ndarray, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each text of a chunk, sorted within the text,
    and their bounds per text."""
    if ts.is_long(offsets):
        values = long_shingles(data, n)
        return values, np.array([0, len(values)])
    _, _, hashes, first = ts.words(data, offsets)
    grams = ts.ngram_hash(hashes, n)
    doc = np.searchsorted(first, np.arange(len(grams)), "right") - 1
    whole = np.arange(len(grams)) + n <= first[doc + 1] if len(grams) else np.zeros(0, bool)
    value, doc = grams[whole], doc[whole]
    short = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < n))
    if len(short):
        one = [ts.ngram_hash(hashes[first[d]:first[d + 1]], int(first[d + 1] - first[d]))[0] for d in short]
        value, doc = np.concatenate([value, np.array(one, np.uint64)]), np.concatenate([doc, short])
    order = np.lexsort([value, doc])
    value, doc = value[order], doc[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    return value[new], np.searchsorted(doc[new], np.arange(len(offsets)))


def long_shingles(data: np.ndarray, n: int = WORDS) -> np.ndarray:
    """The same of one long text, segment by segment."""
    parts, tail = [np.zeros(0, np.uint64)], np.zeros(0, np.uint64)
    for _, _, hashes in ts.word_stream(data):
        tail = np.concatenate([tail, hashes])
        if len(tail) >= n:
            parts.append(np.unique(ts.ngram_hash(tail, n)))
            tail = tail[len(tail) - n + 1:]
    if len(parts) == 1 and len(tail):
        return ts.ngram_hash(tail, len(tail))
    values = np.concatenate(parts)
    del parts
    values.sort()
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return values[new]


def minhashes(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """16-bit MinHash values (texts, HASHES); texts without shingles get 0."""
    out = np.zeros((len(bounds) - 1, HASHES), np.uint16)
    full = np.flatnonzero(np.diff(bounds))
    if len(bounds) == 2 and len(values) > SLICE:
        least = np.full(HASHES, np.iinfo(np.uint64).max)
        for a in range(0, len(values), SLICE):
            for k, factor in enumerate(MULTIPLIERS):
                least[k] = min(least[k], (values[a:a + SLICE] * factor >> np.uint64(24)).min())
        out[0] = ts.mix(least) & np.uint64(0xFFFF)
    elif len(full):
        for k, factor in enumerate(MULTIPLIERS):
            least = np.minimum.reduceat(values * factor >> np.uint64(24), bounds[full])
            out[full, k] = ts.mix(least) & np.uint64(0xFFFF)
    return out


def set_hashes(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two order-free 64-bit hashes of each set."""
    sums = []
    for seed in (0x243F6A8885A308D3, 0x13198A2E03707344):
        total = np.zeros(len(values) + 1, np.uint64)
        for a in range(0, len(values), SLICE):
            part = np.cumsum(ts.mix(values[a:a + SLICE] ^ np.uint64(seed)))
            total[a + 1:a + 1 + len(part)] = part + total[a]
        sums.append((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64))
    return sums[0], sums[1]


def _sketcher(n: int):
    def run(batches):
        for batch in batches:
            texts, columns = ts.text_array(batch.column(1)), []
            for _, _, data, offsets in ts.chunks(texts):
                values, bounds = shingles(data, offsets, n)
                columns.append((*set_hashes(values, bounds), np.diff(bounds), minhashes(values, bounds)))
            if not columns:
                continue
            h1, h2, size, hashes = (np.concatenate(c) for c in zip(*columns))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(h1), pa.array(h2), pa.array(size.astype(np.int64)),
                 pa.array([h.tobytes() for h in hashes], pa.binary())], names=["id", "text_hash", "h1", "h2", "n", "hashes"])
    return run


def _bands(batches):
    """(bucket, cid) of every band of a class."""
    for batch in batches:
        hashes = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, HASHES // ROWS, ROWS)
        words = np.ascontiguousarray(hashes).view(np.uint64)[:, :, 0]
        band = np.arange(words.shape[1], dtype=np.uint64)[None] * np.uint64(0x9E3779B97F4A7C15)
        bucket = ts.mix(ts.mix(words) + band)
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket.reshape(-1).view(np.int64)),
             pa.array(np.repeat(batch.column(0).to_numpy(), words.shape[1]))], names=["bucket", "cid"])


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """For each number of values compared, the fewest matches with which the
    posterior probability of reaching the threshold is not below tolerance."""
    grid = (np.arange(20_000) + 0.5) / 20_000
    out = {}
    for n in range(STEP, HASHES + 1, STEP):
        for m in range(n + 1):
            logs = m * np.log(grid) + (n - m) * np.log1p(-grid)
            weight = np.exp(logs - logs.max())
            if weight[grid >= threshold].sum() >= tolerance * weight.sum():
                out[n] = m
                break
    return out


def survivors(left: np.ndarray, right: np.ndarray, least: dict[int, int]) -> np.ndarray:
    """Which of the paired rows of MinHash values pass every step."""
    alive, found = np.arange(len(left)), np.zeros(len(left), np.int64)
    for n in range(STEP, HASHES + 1, STEP):
        found[alive] += (left[alive, n - STEP:n] == right[alive, n - STEP:n]).sum(axis=1)
        alive = alive[found[alive] >= least[n]]
    out = np.zeros(len(left), bool)
    out[alive] = True
    return out


def _linker(least: dict[int, int]):
    """Edges of the pairs that survive, per (bucket, i, j) group."""
    def run(batches):
        for table, bounds in groups(batches, 3):
            hashes = np.frombuffer(b"".join(table.column("hashes").to_pylist()), np.uint16).reshape(-1, HASHES)
            cid, block = table.column("cid").to_numpy(), table.column("block").to_numpy()
            i, j = table.column("i").to_numpy(), table.column("j").to_numpy()
            sizes, edges = np.diff(bounds), []
            for size in np.unique(sizes[sizes > 1]):
                start = bounds[:-1][sizes == size]
                if size <= 4:  # all groups of a size at once
                    for a in range(size):
                        for b in range(a + 1, size):
                            ok = survivors(hashes[start + a], hashes[start + b], least)
                            edges.append((cid[start + a][ok], cid[start + b][ok]))
                    continue
                for s in start:
                    rows = np.arange(s, s + size)
                    if i[s] == j[s]:
                        x, y = np.triu_indices(size, 1)
                    else:
                        x, y = (v.ravel() for v in np.meshgrid(np.flatnonzero(block[rows] == i[s]),
                                                              np.flatnonzero(block[rows] == j[s])))
                    linked = np.zeros((size, size), bool)
                    for k in range(0, len(x), PAIR_ROWS):
                        p, q = x[k:k + PAIR_ROWS], y[k:k + PAIR_ROWS]
                        ok = survivors(hashes[rows[p]], hashes[rows[q]], least)
                        linked[p[ok], q[ok]] = linked[q[ok], p[ok]] = True
                    a, b = star_edges(linked)
                    edges.append((cid[rows[a]], cid[rows[b]]))
            if edges:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(e)) for e in zip(*edges)], names=["a", "b"])
    return run


def _shingler(n: int):
    """(cid, cluster, shingles) of the texts whose set is the class's."""
    def run(batches):
        for batch in batches:
            texts, sets, h1, h2 = ts.text_array(batch.column(4)), [], [], []
            for _, _, data, offsets in ts.chunks(texts):
                values, bounds = shingles(data, offsets, n)
                sets += [values[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]
                for out, part in zip((h1, h2), set_hashes(values, bounds)):
                    out.append(part)
            if not sets:
                continue
            right = pa.array((np.concatenate(h1) == batch.column(2).to_numpy())
                             & (np.concatenate(h2) == batch.column(3).to_numpy()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sets, pa.binary())],
                                             names=["cid", "cluster", "shingles"]).filter(right)
    return run


def shared_counts(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of all pairwise intersections of sorted sets, exactly: products of
    0/1 matrices over ranges of the shingles."""
    sizes = np.array([len(s) for s in sets])
    total = np.zeros((len(sets), len(sets)))
    ranges = int(-(-sizes.sum() // (4 * SLICE)))
    edges = [np.searchsorted(s, np.array([k * 2**64 // ranges for k in range(1, ranges)], np.uint64)) for s in sets]
    for k in range(ranges):
        part = [s[e[k - 1] if k else 0:e[k] if k < ranges - 1 else len(s)] for s, e in zip(sets, edges)]
        _, column = np.unique(np.concatenate(part), return_inverse=True)
        row = np.repeat(np.arange(len(sets)), [len(p) for p in part])
        common = np.bincount(column)[column] > 1 if len(column) else np.zeros(0, bool)  # else it counts for no pair
        kept, column = np.unique(column[common], return_inverse=True)
        row = row[common]
        order = np.argsort(column, kind="stable")
        column, row = column[order], row[order]
        for begin in range(0, len(kept), width):
            a, b = np.searchsorted(column, [begin, begin + width])
            held = np.zeros((len(sets), min(width, len(kept) - begin)), np.float32)
            held[row[a:b], column[a:b] - begin] = 1
            total += held @ held.T
    total[np.arange(len(sets)), np.arange(len(sets))] = sizes
    return total


def _verifier(threshold: float):
    """Links (weighted by class size) and component edges per (cluster, i, j)."""
    def run(batches):
        for table, bounds in groups(batches, 3):
            cid, members = table.column("cid").to_numpy(), table.column("members").to_numpy()
            block, i, j = (table.column(c).to_numpy() for c in ("block", "i", "j"))
            raw = table.column("shingles").to_pylist()
            out = []
            for s, e in zip(bounds, bounds[1:]):
                if e - s < 2:
                    continue
                sets = [np.frombuffer(r, np.uint64) for r in raw[s:e]]
                both = shared_counts(sets)
                sizes = np.diag(both)
                linked = both >= threshold * (sizes[:, None] + sizes[None] - both) - 1e-9
                np.fill_diagonal(linked, False)
                if i[s] != j[s]:
                    linked &= block[s:e][:, None] != block[s:e][None]
                label = np.arange(e - s)
                at, to = star_edges(linked)
                label[at] = to
                out.append((cid[s:e], linked @ members[s:e], cid[s:e][label]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["cid", "links", "to"])
    return run


def _in_blocks(rows: DataFrame, key: str, blocks: str) -> DataFrame:
    """Every row once for each pair of blocks (i <= j) that holds its block."""
    return (rows.withColumn("block", F.pmod(F.xxhash64("cid", F.lit(7)), F.col(blocks)).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col(blocks).cast("int") - 1)))
            .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
            .drop("other", blocks))


def _sorted_groups(rows: DataFrame, key: str) -> DataFrame:
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, key, "i", "j").sortWithinPartitions(key, "i", "j")


def classes_and_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                      threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """``(sketches, classes)``: (id, h1, h2, n) per document and (h1, h2, n,
    members, rep, component, class_id, links) per class of equal sets."""
    with early_cleanup(docs.sparkSession):
        return _join(docs, id_col, text_col, words, threshold)


def _join(docs, id_col, text_col, words, threshold):
    id_type = docs.schema[id_col].dataType
    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash"))
    sketches = stage(read.mapInArrow(_sketcher(words), T.StructType(
        [T.StructField("id", id_type), *(T.StructField(c, T.LongType()) for c in ("text_hash", "h1", "h2", "n")),
         T.StructField("hashes", T.BinaryType())])), "sketches")
    classes = stage(sketches.where("n > 0").groupBy("h1", "h2", "n")
                    .agg(F.min(F.struct(F.col("id").isNull().alias("no"), "id", "text_hash")).alias("first"),
                         F.count(F.lit(1)).alias("members"), F.min("hashes").alias("hashes"))
                    .select("h1", "h2", "n", F.col("first.id").alias("rep"), "first.text_hash", "members", "hashes")
                    .withColumn("cid", F.monotonically_increasing_id()), "classes")
    bands = classes.select("cid", "hashes").mapInArrow(_bands, "bucket long, cid long")
    full = (bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("in_bucket")).where("in_bucket > 1")
            .withColumn("blocks", F.ceil(F.col("in_bucket") / BUCKET_BLOCK)))
    in_bucket = bands.join(full.select("bucket", "blocks"), "bucket")
    members = stage(in_bucket, "buckets").join(classes.select("cid", "hashes"), "cid")
    edges = stage(_sorted_groups(_in_blocks(members, "bucket", "blocks")
                                 .select("bucket", "i", "j", "block", "cid", "hashes"), "bucket")
                  .mapInArrow(_linker(least_matches(threshold)), "a long, b long"), "candidates")
    clusters = stage(components(edges).withColumnRenamed("node", "cid").withColumnRenamed("component", "cluster"),
                     "clusters")
    # The texts of one document per class in a cluster, as whole shingle sets.
    wanted = clusters.join(classes.select("cid", "rep", "text_hash", "h1", "h2"), "cid")
    sets = stage(_rep_sets(read, wanted, words), "sets")
    load = (sets.groupBy("cluster").agg(F.sum("size").alias("load"), F.count(F.lit(1)).alias("n"))
            .select("cluster", F.greatest(F.least(F.ceil(F.col("load") / CLUSTER_BLOCK), F.col("n")),
                                          F.ceil(F.col("n") / BUCKET_BLOCK)).alias("blocks")))
    blocked = _in_blocks(sets.join(load, "cluster").join(classes.select("cid", "members"), "cid"), "cluster", "blocks")
    links = stage(_sorted_groups(blocked.select("cluster", "i", "j", "block", "cid", "members", "shingles"), "cluster")
                  .mapInArrow(_verifier(threshold), "cid long, links long, to long"), "links")
    parts = components(links.select(F.col("cid").alias("a"), F.col("to").alias("b")))
    found = (classes.select("cid", "h1", "h2", "n", "rep", "members")
             .join(links.groupBy("cid").agg(F.sum("links").alias("links")), "cid", "left")
             .join(parts.withColumnRenamed("node", "cid"), "cid", "left")
             .withColumn("component", F.coalesce("component", "cid"))
             .withColumn("links", F.coalesce("links", F.lit(0)) + F.col("members") - 1))
    named = found.groupBy("component").agg(F.min("rep").alias("class_id"))
    return sketches.select("id", "h1", "h2", "n"), stage(found.join(named, "component"), "joined")


def _rep_sets(read: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(cid, cluster, shingles, size): the set of one document of each wanted
    class. Found by id and text, so rows that share an id (or have none) meet
    only their own class."""
    keyed = wanted.select("cid", "cluster", "h1", "h2", "rep", F.col("text_hash").alias("rep_hash"))
    texts = (read.join(keyed, (F.col("text_hash") == F.col("rep_hash")) & F.col("id").eqNullSafe(F.col("rep")))
             .select("cid", "cluster", "h1", "h2", "text"))
    made = texts.mapInArrow(_shingler(words), "cid long, cluster long, shingles binary")
    return made.dropDuplicates(["cid"]).withColumn("size", (F.octet_length("shingles") / 8).cast("long"))


def link(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: id, class_id, n_links (other documents linked
    directly, equal sets included), n_shingles."""
    sketches, classes = classes_and_links(docs, id_col, text_col, **options)
    found = classes.select("h1", "h2", "n", "class_id", "links")
    return sketches.join(found, ["h1", "h2", "n"], "left").select(
        F.col("id").alias(id_col), F.when(F.col("links").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("links", F.lit(0)).alias("n_links"), F.col("n").alias("n_shingles"))


def _hasher(n: int):
    def run(batches):
        for batch in batches:
            texts, columns = ts.text_array(batch.column(2)), []
            for _, _, data, offsets in ts.chunks(texts):
                values, bounds = shingles(data, offsets, n)
                columns.append((*set_hashes(values, bounds), np.diff(bounds).astype(np.int64)))
            if columns:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1),
                                                  *(pa.array(np.concatenate(c)) for c in zip(*columns))],
                                                 names=["row", "id", "h1", "h2", "n"])
    return run


def keep(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, **options) -> DataFrame:
    """One row of each component of linked documents (smallest id, null last)
    and every row without links, unchanged."""
    _, classes = classes_and_links(docs, id_col, text_col, words=words, **options)
    linked = classes.where("links > 0")
    first = F.struct(F.col("rep").isNull().alias("no"), "rep", "h1", "h2")
    best = linked.groupBy("component").agg(F.min(first).alias("best"))
    chosen = linked.join(best, "component").select(
        "h1", "h2", "n", "rep", ((F.col("best.h1") == F.col("h1")) & (F.col("best.h2") == F.col("h2"))).alias("stays"))
    schema = T.StructType([T.StructField("row", docs.schema), T.StructField("id", docs.schema[id_col].dataType),
                           *(T.StructField(c, T.LongType()) for c in ("h1", "h2", "n"))])
    rows = (docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("id"),
                        F.col(text_col).alias("text")).mapInArrow(_hasher(words), schema)
            .join(chosen, ["h1", "h2", "n"], "left"))
    # Written once: both halves below read it.
    left = stage(rows.where(F.col("stays").isNull() | (F.col("stays") & F.col("id").eqNullSafe(F.col("rep"))))
                 .select("row", "h1", "h2", "n", "stays"), "kept")
    alone = left.where("stays is null").select("row")
    # Rows alike in id and set: one of them.
    reps = left.where("stays").groupBy("h1", "h2", "n").agg(F.first("row").alias("row")).select("row")
    return alone.union(reps).select("row.*")
