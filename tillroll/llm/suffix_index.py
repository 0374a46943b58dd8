"""Removal of repeated long strings with a logarithmic family of suffix arrays.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts
earlier (smaller id, or the same document, earlier start). The suffix arrays
are sparse: every window of LENGTH bytes names one of its 32-byte strings as
its anchor (the smallest fingerprint, the rightmost of equals), which depends
on the window's bytes alone, so equal windows have equal anchors at equal
offsets, and only about one suffix in 35 is indexed. An entry is an anchor
with its context, the union of the windows that name it; entries are in the
order of the fingerprint of the suffix's first 32 bytes, then of the context.

Batches are ranges of ids in ascending order. Each new batch gets its suffix
array and is merge-scanned, range of fingerprints by range, against all
existing levels: entries whose context is there, or earlier in the batch, are
repeats as a whole; the others form the batch's array, level 0. Before the
next batch comes, equal-sized levels merge, so a level holds 2**k batches and
an entry is rewritten at most log2(batches) times.

What is left are entries of equal anchors but different contexts, at the edges
of copies. Their contexts are fetched once at the end, and all their windows
are compared: by range of fingerprints, or, for anchors with more than ``HOT``
different contexts (a passage in very many documents), by range of the hash of
the window, so no anchor is gathered in one task. Repeats within a task are
settled before the shuffle, so a passage copied any number of times is sent
once a task. Equality is that of 128 bits of hash for contexts, 64 for
windows of equal anchors.

Entries travel as packed arrays, one row per (task, range); ``n`` ranges are
the session's shuffle partitions. Texts are scanned in chunks with whole-text
results (texts above ``SEGMENT`` bytes in overlapping segments).

Defined results: null is the empty text; texts under LENGTH bytes lose
nothing; ids must be whole numbers; null or repeated ids make the documents be
numbered first by (id, null first, hash of the text), rows alike in both in
any order; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tillroll.llm import textscan as ts
from tillroll.llm.bpe import ragged
from tillroll.llm.staging import early_cleanup, stage

LENGTH, GRAM = 100, 32
REACH = LENGTH - GRAM + 1  # grams in a window
BATCHES = 4
HOT = 2048
SEGMENT = 16 << 20
FLUSH = 200_000  # entries
WINDOWS = 300_000

PLACE = np.uint64((1 << 26) - 1)
COLUMNS = (("fp", np.uint64), ("ctx", np.uint64), ("doc", np.int64), ("pos", np.int64), ("lo", np.uint8), ("hi", np.uint8))
ENTRY, REPEAT, EDGE = 0, 1, 2
BLOCK_SCHEMA = "bucket int, kind int, fp binary, ctx binary, doc binary, pos binary, lo binary, hi binary"


def window_anchors(data: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(prefix, first, last, anchor)``: the hash prefix of the bytes, and
    the runs [first, last] of valid window starts that share an anchor."""
    prefix = ts.prefix_hash(data)
    n = len(data) - GRAM + 1
    start = np.arange(n)
    least = ts.range_hash(prefix, start, start + GRAM) & ~PLACE | PLACE - start.astype(np.uint64)
    width = 1
    while 2 * width <= REACH:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < REACH:
        least = np.minimum(least[:len(least) - (REACH - width)], least[REACH - width:])
    anchor = (PLACE - (least & PLACE)).astype(np.int64)
    at = np.flatnonzero(valid[:len(anchor)])
    if not len(at):
        none = np.zeros(0, np.int64)
        return prefix, none, none, none
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (anchor[at[1:]] != anchor[at[:-1]])
    first = at[new]
    last = at[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)]
    return prefix, first, last, anchor[first]


def entries(data: np.ndarray, offsets: np.ndarray, docs: np.ndarray, base: int = 0) -> dict[str, np.ndarray]:
    """Entries of the texts of a chunk (a zero byte after each); ``base`` is
    added to positions."""
    if len(data) <= LENGTH:
        return {c: np.zeros(0, t) for c, t in COLUMNS}
    edge = np.zeros(len(data) + 1, np.int32)
    long_ = np.diff(offsets) - 1 >= LENGTH
    np.add.at(edge, offsets[:-1][long_], 1)
    np.add.at(edge, offsets[1:][long_] - LENGTH, -1)  # windows start up to the text's end less LENGTH
    prefix, first, last, anchor = window_anchors(data, np.cumsum(edge) > 0)
    which = np.searchsorted(offsets, first, "right") - 1
    lo, hi = anchor - last, anchor - first
    ctx = ts.mix(ts.range_hash(prefix, first, last + LENGTH) + lo.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    # Anchors have the smallest hashes of their windows; mixed again, their fingerprints are even.
    return {"fp": ts.mix(ts.range_hash(prefix, anchor, anchor + GRAM) + np.uint64(GRAM)), "ctx": ctx, "doc": docs[which],
            "pos": anchor - offsets[which] + base, "lo": lo.astype(np.uint8), "hi": hi.astype(np.uint8)}


def text_entries(texts: pa.Array, docs: np.ndarray):
    """Entries of whole texts, chunk by chunk."""
    for begin, stop, data, offsets in ts.chunks(texts):
        if len(data) <= SEGMENT:
            yield entries(data, offsets, docs[begin:stop])
            continue
        for at in range(0, len(data) - 1, SEGMENT):  # one long text
            piece = np.append(data[at:min(at + SEGMENT + LENGTH - 1, len(data) - 1)], np.uint8(0))
            yield entries(piece, np.array([0, len(piece)]), docs[begin:stop], at)


def join_entries(parts: list[dict]) -> dict[str, np.ndarray]:
    return {c: np.concatenate([p[c] for p in parts]) if parts else np.zeros(0, t) for c, t in COLUMNS}


def take(e: dict, at) -> dict[str, np.ndarray]:
    return {c: v[at] for c, v in e.items()}


def first_of_context(e: dict) -> tuple[np.ndarray, np.ndarray]:
    """Order by (fp, ctx, doc, pos), and which entries of it begin a context."""
    order = np.lexsort([e["ctx"], e["fp"]])
    fp, ctx = e["fp"][order], e["ctx"][order]
    new = np.ones(len(order), bool)
    new[1:] = (fp[1:] != fp[:-1]) | (ctx[1:] != ctx[:-1])
    group = np.cumsum(new) - 1
    many = np.flatnonzero((np.bincount(group, minlength=1) > 1)[group]) if len(order) else np.zeros(0, int)
    if len(many):
        inner = order[many]
        order[many] = inner[np.lexsort([e["pos"][inner], e["doc"][inner], group[many]])]
    return order, new


def bucket_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """Range of a hash: 0 to n - 1, rising with it."""
    return ((hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def pack(e: dict, kind: int, buckets: np.ndarray) -> pa.RecordBatch:
    """One row per bucket; ``e`` must be sorted by bucket."""
    cut = np.flatnonzero(np.diff(buckets, prepend=-1)) if len(buckets) else np.zeros(0, int)
    ends = np.append(cut[1:], len(buckets)) if len(cut) else cut
    columns = [pa.array(buckets[cut], pa.int32()), pa.array(np.full(len(cut), kind), pa.int32())]
    for c, t in COLUMNS:
        values = np.ascontiguousarray(e[c].astype(t))
        columns.append(pa.array([values[a:b].tobytes() for a, b in zip(cut, ends)], pa.binary()))
    return pa.RecordBatch.from_arrays(columns, names=["bucket", "kind"] + [c for c, _ in COLUMNS])


def unpack(batch) -> list[tuple[int, dict]]:
    kinds, raw = batch.column("kind").to_pylist(), {c: batch.column(c).to_pylist() for c, _ in COLUMNS}
    return [(k, {c: np.frombuffer(raw[c][i], t) for c, t in COLUMNS}) for i, k in enumerate(kinds)]


def _indexer(n: int):
    """Entries of a batch of documents, those of one task without its own repeats."""
    def flush(parts):
        e = join_entries(parts)
        order, new = first_of_context(e)
        again = take(e, order[~new])
        own = take(e, order[new])
        yield pack(own, ENTRY, bucket_of(own["fp"], n))
        if len(again["fp"]):
            yield pack(again, REPEAT, bucket_of(again["fp"], n))

    def run(batches):
        held, count = [], 0
        for batch in batches:
            for part in text_entries(ts.text_array(batch.column(1)), batch.column(0).to_numpy()):
                held.append(part)
                count += len(part["fp"])
                if count >= FLUSH:
                    yield from flush(held)
                    held, count = [], 0
        if count:
            yield from flush(held)
    return run


def scan(levels: dict, batch: dict) -> tuple[dict, dict, dict]:
    """Merge-scan of a batch with the levels: (new entries in order, repeats,
    entries of anchors with several contexts, of the levels too)."""
    e = join_entries([levels, batch])
    old = np.arange(len(e["fp"])) < len(levels["fp"])
    order = np.lexsort([~old, e["ctx"], e["fp"]])
    fp, ctx = e["fp"][order], e["ctx"][order]
    new = np.ones(len(order), bool)
    new[1:] = (fp[1:] != fp[:-1]) | (ctx[1:] != ctx[:-1])
    group = np.cumsum(new) - 1
    # Within a context without an older entry: the earliest of the batch.
    known = np.zeros(int(group[-1]) + 1 if len(group) else 0, bool)
    known[group[old[order]]] = True
    size = np.bincount(group, minlength=len(known))
    mixed = np.flatnonzero(((size > 1) & ~known)[group]) if len(group) else np.zeros(0, int)
    if len(mixed):
        inner = order[mixed]
        order[mixed] = inner[np.lexsort([e["pos"][inner], e["doc"][inner], group[mixed]])]
    is_old = old[order]
    fresh = new & ~is_old
    repeat = ~new & ~is_old
    # Anchors with several contexts, of which at least one is new.
    heads = np.flatnonzero(new)
    anchor = np.ones(len(heads), bool)
    anchor[1:] = fp[heads[1:]] != fp[heads[:-1]]
    number = np.cumsum(anchor) - 1
    several = np.bincount(number, minlength=1) > 1
    has_new = np.bincount(number, weights=fresh[heads], minlength=1) > 0
    edge = heads[(several & has_new)[number]] if len(heads) else heads
    return take(e, order[fresh]), take(e, order[repeat]), take(e, order[edge])


def _scanner(n: int):
    def run(batches):
        levels, batch, bucket = [], [], None
        for rows in batches:
            for (kind, e), level, at in zip(unpack(rows), rows.column("level").to_pylist(), rows.column("bucket").to_pylist()):
                bucket = at
                if kind == REPEAT:
                    yield pack(e, REPEAT, np.full(len(e["fp"]), at))
                else:
                    (levels if level else batch).append(e)
        if bucket is None or not batch:
            return
        fresh, repeats, edges = scan(join_entries(levels), join_entries(batch))
        for kind, e in ((ENTRY, fresh), (REPEAT, repeats), (EDGE, edges)):
            if len(e["fp"]):
                yield pack(e, kind, np.full(len(e["fp"]), bucket))
    return run


def _merger(batches):
    parts, bucket = [], 0
    for rows in batches:
        for (_, e), at in zip(unpack(rows), rows.column("bucket").to_pylist()):
            parts.append(e)
            bucket = at
    if parts:
        e = join_entries(parts)
        e = take(e, np.lexsort([e["ctx"], e["fp"]]))
        yield pack(e, ENTRY, np.full(len(e["fp"]), bucket))


class SuffixIndex:
    """Levels of 2**k batches each, newest last; and what scanning has found."""

    def __init__(self, n: int):
        self.n, self.levels, self.found = n, [], []

    def _union(self, frames: list[DataFrame]) -> DataFrame:
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out

    def add(self, docs: DataFrame) -> None:
        """Scan a batch (doc long, text) whose ids are above all earlier ones, and index it."""
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (size, a), (_, b) = self.levels[-2:]
            rows = self._union([a, b]).where(F.col("kind") == ENTRY)
            merged = stage(rows.repartitionById(self.n, "bucket").mapInArrow(_merger, BLOCK_SCHEMA), "suffix-level")
            self.levels[-2:] = [(2 * size, merged)]
        fresh = docs.select("doc", "text").mapInArrow(_indexer(self.n), BLOCK_SCHEMA).withColumn("level", F.lit(0))
        known = [f.where(F.col("kind") == ENTRY).withColumn("level", F.lit(1)) for _, f in self.levels]
        rows = self._union([fresh, *known]).repartitionById(self.n, "bucket")
        scanned = stage(rows.mapInArrow(_scanner(self.n), BLOCK_SCHEMA), "suffix-batch")
        self.levels.append((1, scanned))
        self.found.append(scanned)


def merged_spans(doc: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of spans: disjoint, not touching, in order of (doc, begin)."""
    order = np.lexsort([begin, doc])
    doc, begin, end = doc[order], begin[order], end[order]
    if not len(doc):
        return doc, begin, end
    number = np.concatenate([[0], np.cumsum(doc[1:] != doc[:-1])])
    room = int(end.max()) + 2
    reach = np.maximum.accumulate(end + number * room)
    new = np.ones(len(doc), bool)
    new[1:] = begin[1:] + number[1:] * room > reach[:-1]
    at = np.flatnonzero(new)
    return doc[at], begin[at], np.maximum.reduceat(end, at)


def _span_rows(batches):
    """Repeats as spans, joined within each row batch."""
    for rows in batches:
        e = join_entries([x for _, x in unpack(rows)])
        doc, begin, end = merged_spans(e["doc"], e["pos"] - e["hi"], e["pos"] - e["lo"] + LENGTH)
        yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(begin), pa.array(end)], names=["doc", "begin", "end"])


def _edge_rows(batches):
    for rows in batches:
        e = join_entries([x for _, x in unpack(rows)])
        yield pa.RecordBatch.from_arrays([pa.array(e["fp"].view(np.int64)), pa.array(e["doc"]), pa.array(e["pos"]),
                                          pa.array(e["lo"].astype(np.int32)), pa.array(e["hi"].astype(np.int32))],
                                         names=["fp", "doc", "pos", "lo", "hi"])


CONTEXT_SCHEMA = "bucket int, hot int, fp binary, doc binary, pos binary, lo binary, hi binary, bytes binary"


def _context_pack(kind: int, bucket: np.ndarray, fp, doc, pos, lo, hi, sizes, data) -> pa.RecordBatch:
    """Rows per bucket of contexts (or of windows, without bytes), sorted by bucket."""
    cut = np.flatnonzero(np.diff(bucket, prepend=-1))
    ends = np.append(cut[1:], len(bucket))
    at = np.concatenate([[0], np.cumsum(sizes)])
    pieces = [[np.ascontiguousarray(v[a:b]).tobytes() for a, b in zip(cut, ends)] for v in (fp, doc, pos, lo, hi)]
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[cut], pa.int32()), pa.array(np.full(len(cut), kind), pa.int32()),
         *(pa.array(p, pa.binary()) for p in pieces),
         pa.array([data[at[a]:at[b]].tobytes() for a, b in zip(cut, ends)], pa.binary())],
        names=["bucket", "hot", "fp", "doc", "pos", "lo", "hi", "bytes"])


def windows_of(pos, lo, hi, data) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry, start, hash) of all windows of contexts laid end to end."""
    sizes = hi.astype(np.int64) - lo + LENGTH
    count = sizes - LENGTH + 1
    at = np.cumsum(sizes) - sizes
    where = ragged(at, count)
    entry = np.repeat(np.arange(len(pos)), count)
    prefix = ts.prefix_hash(data)
    return entry, (pos - hi)[entry] + where - at[entry], ts.range_hash(prefix, where, where + LENGTH)


def _later(hashes, doc, start) -> np.ndarray:
    """Which windows are not the earliest of their hash."""
    order = np.lexsort([start, doc, hashes])
    out = np.zeros(len(hashes), bool)
    out[order[1:]] = hashes[order[1:]] == hashes[order[:-1]]
    return out


def _contexts(n: int):
    """Contexts of edge entries cut from their texts; hot ones as windows."""
    def flush(cold, hot):
        if cold:
            fp, doc, pos, lo, hi, data = (np.concatenate(c) for c in zip(*cold))
            sizes = hi.astype(np.int64) - lo + LENGTH
            order = np.argsort(fp, kind="stable")
            spread = data[ragged((np.cumsum(sizes) - sizes)[order], sizes[order])]
            yield _context_pack(0, bucket_of(fp[order], n), fp[order], doc[order], pos[order], lo[order], hi[order],
                                sizes[order], spread)
        if hot:
            _, doc, pos, lo, hi, data = (np.concatenate(c) for c in zip(*hot))
            entry, start, hashes = windows_of(pos, lo, hi, data)
            again = _later(hashes, doc[entry], start)
            for kind, chosen in ((1, ~again), (2, again)):  # 2: settled here
                order = np.flatnonzero(chosen)[np.argsort(hashes[chosen], kind="stable")]
                if len(order):
                    zero = np.zeros(len(order), np.int32)
                    yield _context_pack(kind, bucket_of(hashes[order], n), hashes[order], doc[entry][order], start[order],
                                        zero, zero, zero, data[:0])

    def run(batches):
        cold, hot, count = [], [], 0
        for batch in batches:
            docs, texts, found = batch.column(0).to_numpy(), ts.text_array(batch.column(1)), batch.column(2)
            off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
            data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
            bounds, flat = found.offsets.to_numpy(), found.flatten()
            fp, pos, lo, hi, is_hot = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("fp", "pos", "lo", "hi", "hot"))
            bounds = bounds - bounds[0]
            for d in range(len(docs)):
                for want, store in ((False, cold), (True, hot)):
                    at = bounds[d] + np.flatnonzero(is_hot[bounds[d]:bounds[d + 1]] == want)
                    if not len(at):
                        continue
                    sizes = hi[at].astype(np.int64) - lo[at] + LENGTH
                    begin = off[d] + pos[at] - hi[at]
                    store.append((fp[at].view(np.uint64), np.full(len(at), docs[d]), pos[at], lo[at].astype(np.int32),
                                  hi[at].astype(np.int32), data[ragged(begin, sizes)]))
                    count += int(sizes.sum())
                if count >= 4 * ts.CHUNK:
                    yield from flush(cold, hot)
                    cold, hot, count = [], [], 0
        yield from flush(cold, hot)
    return run


def _resolver(batches):
    """Spans of windows that start earlier elsewhere, per range of hashes."""
    def spans(doc, start):
        return merged_spans(doc, start, start + LENGTH)

    cold, hot = [], []
    out = lambda s: pa.RecordBatch.from_arrays([pa.array(v.astype(np.int64)) for v in s], names=["doc", "begin", "end"])
    for batch in batches:
        raw = {c: batch.column(c).to_pylist() for c in ("hot", "fp", "doc", "pos", "lo", "hi", "bytes")}
        for i, kind in enumerate(raw["hot"]):
            row = [np.frombuffer(raw["fp"][i], np.uint64), np.frombuffer(raw["doc"][i], np.int64),
                   np.frombuffer(raw["pos"][i], np.int64), np.frombuffer(raw["lo"][i], np.int32),
                   np.frombuffer(raw["hi"][i], np.int32), np.frombuffer(raw["bytes"][i], np.uint8)]
            if kind == 2:
                yield out(spans(row[1], row[2]))
            else:
                (hot if kind else cold).append(row)
    if hot:
        hashes, doc, start = (np.concatenate([r[k] for r in hot]) for k in range(3))
        again = _later(hashes, doc, start)
        yield out(spans(doc[again], start[again]))
    if cold:
        fp, doc, pos, lo, hi, data = (np.concatenate(c) for c in zip(*cold))
        sizes = hi.astype(np.int64) - lo + LENGTH
        at = np.cumsum(sizes) - sizes
        order = np.argsort(fp, kind="stable")
        total = np.cumsum((sizes - LENGTH + 1)[order])
        same = np.flatnonzero(np.append(fp[order][1:] != fp[order][:-1], True)) + 1  # ends of anchors
        first = 0
        while first < len(order):
            done = total[first - 1] if first else 0
            stop = int(same[min(np.searchsorted(same, np.searchsorted(total, done + WINDOWS, "right"), "left"), len(same) - 1)])
            own = order[first:stop]
            entry, start, hashes = windows_of(pos[own], lo[own], hi[own], data[ragged(at[own], sizes[own])])
            again = _later(hashes, doc[own][entry], start)
            yield out(spans(doc[own][entry][again], start[again]))
            first = stop


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, id, text) with unique ``doc`` in the order of the documents."""
    plain = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counts = (plain.groupBy("doc").agg(F.count(F.lit(1)).alias("n"))
              .agg(F.max("n").alias("most"), F.sum(F.col("doc").isNull().cast("int")).alias("nulls")).first())
    if (counts["most"] or 0) <= 1 and not counts["nulls"]:
        return plain
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (plain.withColumn("hash", F.xxhash64("text")).repartitionByRange(n, "doc", "hash")
               .sortWithinPartitions("doc", "hash"))
    return stage(ordered.select(F.monotonically_increasing_id().alias("doc"), "id", "text"), "numbered")


def repeated_spans(numbered: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(doc, begin, end): byte spans to remove, possibly overlapping, of
    documents (doc unique long, text)."""
    n = int(numbered.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = numbered.agg(F.percentile_approx("doc", [k / batches for k in range(1, batches)], 1000).alias("c")).first()["c"]
    cuts = sorted(set(cuts or []))
    index = SuffixIndex(n)
    for k in range(len(cuts) + 1):
        part = numbered if not cuts else numbered.where(
            (F.col("doc") > cuts[k - 1] if k else F.lit(True)) & (F.col("doc") <= cuts[k] if k < len(cuts) else F.lit(True)))
        index.add(part)
    found = index._union(index.found)
    spans = found.where(F.col("kind") == REPEAT).mapInArrow(_span_rows, "doc long, begin long, end long")
    edges = stage(found.where(F.col("kind") == EDGE).mapInArrow(_edge_rows, "fp long, doc long, pos long, lo int, hi int")
                  .dropDuplicates(["fp", "doc", "pos"]), "edges")
    hot = edges.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT).select("fp", F.lit(True).alias("hot"))
    by_doc = (edges.join(hot, "fp", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
              .groupBy("doc").agg(F.collect_list(F.struct("fp", "pos", "lo", "hi", "hot")).alias("edges")))
    resolved = (numbered.select("doc", "text").join(by_doc, "doc").select("doc", "text", "edges")
                .mapInArrow(_contexts(n), CONTEXT_SCHEMA).repartitionById(n, "bucket")
                .mapInArrow(_resolver, "doc long, begin long, end long"))
    return stage(spans.unionByName(resolved), "spans")


def _cutter(keep_text: bool):
    def run(batches):
        for batch in batches:
            ids, raw = batch.column(0), batch.column(1).cast(pa.large_binary()).to_pylist()
            size, gone, runs, sha, kept = [], [], [], [], []
            for text, spans in zip(raw, batch.column(2).to_pylist()):
                text = text or b""
                spans = np.array([(s["begin"], s["end"]) for s in spans or []], np.int64).reshape(-1, 2)
                _, begin, end = merged_spans(np.zeros(len(spans), np.int64), spans[:, 0], spans[:, 1])
                rest = b"".join(text[a:b] for a, b in zip([0, *end.tolist()], [*begin.tolist(), len(text)]))
                size.append(len(text))
                gone.append(len(text) - len(rest))
                runs.append(len(begin))
                sha.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest if keep_text else None)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()),
                 pa.array(sha, pa.string()), pa.array(kept, pa.binary())],
                names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
    return run


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_bytes: bool = False,
         batches: int = BATCHES) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256, and
    with ``keep_bytes`` the bytes left, as ``kept``."""
    with early_cleanup(docs.sparkSession):
        numbered = _numbered(docs, id_col, text_col)
        spans = repeated_spans(numbered, batches).groupBy("doc").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType),
                           *(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")),
                           T.StructField("kept_sha256", T.StringType()), T.StructField("kept", T.BinaryType())])
    out = (numbered.join(spans, "doc", "left").select("id", "text", "spans").mapInArrow(_cutter(keep_bytes), schema)
           .withColumnRenamed("id", id_col))
    return out if keep_bytes else out.drop("kept")
