"""Benchmark decontamination by a broadcast set of test n-grams.

Words are the maximal runs of digits, a-z and non-ASCII characters after A-Z
is lower-cased. Every benchmark item gives its windows of ``n`` consecutive
words; an item of fewer words, but not none, is one window of that length.
The windows are broadcast as a sorted hash table, each task scans whole texts
with rolling word-n-gram hashes, and a hash hit counts only after the words
themselves compare equal.

Size of the broadcast: at most ``MAX_WINDOWS`` windows at a time, counted
before they are fetched. An item of more windows is first cut, in its task, into
pieces of at most so many, which keep its id and overlap by ``n`` - 1 words. A
benchmark of more parts is scanned part by part over a staged table, which adds
each part's hits to those before it: same result, no larger broadcast. Items
that share an id are one item.

Defined results: a null or empty text has no words, is not contaminated and
is kept; a null item text gives no window and a null item id is named "";
repeated rows are judged one by one; an empty benchmark contaminates nothing.
``find`` returns only the id and the columns it names, ``remove`` only the
columns of its input, so other columns, whatever their names, never clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tillroll.llm import textscan as ts
from tillroll.llm.staging import share, stage

WINDOW = 10
MAX_WINDOWS = 1_000_000


class WindowSet:
    """Windows of some benchmark items: per window length the sorted hashes,
    the words joined by blanks, and the items that hold the window."""

    def __init__(self, items: list[tuple[str, str | None]], n: int):
        self.item_ids = [i for i, _ in items]
        by_length: dict[int, dict[bytes, set[int]]] = {}
        for k, (_, text) in enumerate(items):
            words = item_words(text)
            size = min(n, len(words))
            for j in range(len(words) - size + 1 if size else 0):
                by_length.setdefault(size, {}).setdefault(b" ".join(words[j:j + size]), set()).add(k)
        self.lengths = {}
        for size, windows in by_length.items():
            pairs = sorted((int(window_hash(w, size)), w) for w in windows)
            self.lengths[size] = (np.array([h for h, _ in pairs], np.uint64), [w for _, w in pairs],
                                  [sorted(windows[w]) for _, w in pairs])


def item_words(text: str | None) -> list[bytes]:
    data = ts.LOWER[np.frombuffer((text or "").encode(), np.uint8)]
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(*ts.word_bounds(data))]


def window_hash(joined: bytes, size: int) -> np.uint64:
    data = np.frombuffer(joined, np.uint8)
    return ts.ngram_hash(ts.range_hash(ts.prefix_hash(data), *ts.word_bounds(data)), size)[0]


def occurrences(hashes: np.ndarray, windows: WindowSet, word, wanted):
    """Yield ``(place, size, items)`` of the windows that occur among the words of
    these hashes; ``word(p)`` gives a word's bytes, ``wanted(places, size)``
    says which places count."""
    for size, (known, texts, owners) in windows.lengths.items():
        grams = ts.ngram_hash(hashes, size)
        if not len(grams):
            continue
        slot = np.searchsorted(known, grams)
        slot[slot == len(known)] = 0
        at = np.flatnonzero(known[slot] == grams)
        for p in at[wanted(at, size)].tolist():
            found = b" ".join(word(p + j) for j in range(size))
            i = int(slot[p])
            while i < len(known) and known[i] == grams[p]:
                if texts[i] == found:
                    yield p, size, owners[i]
                i += 1


def scan_chunk(data: np.ndarray, offsets: np.ndarray, windows: WindowSet):
    """``(start, end, first, spans, items)`` of a chunk: byte bounds of its
    words, words before each text, hit windows as word ranges, and per text
    the set of items that occur."""
    start, end, hashes, first = ts.words(data, offsets)
    lowered, spans, items = ts.LOWER[data], [], {}
    within = lambda at, size: at + size <= first[np.searchsorted(first, at, "right")]
    for p, size, owners in occurrences(hashes, windows, lambda k: lowered[start[k]:end[k]].tobytes(), within):
        spans.append((p, p + size))
        items.setdefault(int(np.searchsorted(first, p, "right")) - 1, set()).update(owners)
    return start, end, first, spans, items


def scan_long(data: np.ndarray, windows: WindowSet) -> dict:
    """What is found in one long text, segment by segment: each is scanned with
    the last words before it, so no window is missed at a border."""
    lead = max(windows.lengths, default=1) - 1
    start, end, hashes = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    n_words, spans, items = 0, [], set()
    for new in ts.word_stream(data):
        held = min(lead, len(start))
        start, end, hashes = (np.concatenate([old[len(old) - held:], n]) for old, n in zip((start, end, hashes), new))
        base = n_words - held
        n_words += len(new[0])
        found = []
        for p, size, owners in occurrences(hashes, windows, lambda k: ts.LOWER[data[start[k]:end[k]]].tobytes(),
                                           lambda at, size: at + size > held):
            found.append((base + p, base + p + size, int(start[p]), int(end[p + size - 1])))
            items.update(owners)
        while spans and spans[-1][1] >= base:
            found.append(spans.pop())
        spans += _merged(found)
    return {"n_words": n_words, "words": [[a, b] for a, b, _, _ in spans], "bytes": [[c, d] for _, _, c, d in spans],
            "items": sorted({windows.item_ids[k] for k in items})}


def _merged(spans: list[tuple]) -> list[tuple]:
    """Word ranges (first, end) that touch made one; with them their byte ranges."""
    out: list[tuple] = []
    for a, b, *at in sorted(spans):
        if out and a <= out[-1][1]:
            old = out[-1]
            out[-1] = (old[0], max(b, old[1]), *((old[2], max(at[1], old[3])) if at else ()))
        else:
            out.append((a, b, *at))
    return out


FOUND = pa.struct([("n_words", pa.int64()), ("words", pa.list_(pa.list_(pa.int64()))),
                   ("bytes", pa.list_(pa.list_(pa.int64()))), ("items", pa.list_(pa.string()))])


def _judged(texts: pa.Array, windows: WindowSet) -> list[dict]:
    out: list[dict] = []
    for begin, stop, data, offsets in ts.chunks(texts):
        if ts.is_long(offsets):
            out.append(scan_long(data, windows))
            continue
        start, end, first, spans, items = scan_chunk(data, offsets, windows)
        by_doc: dict[int, list] = {}
        for a, b in spans:
            by_doc.setdefault(int(np.searchsorted(first, a, "right")) - 1, []).append((a, b))
        for d in range(stop - begin):
            own = _merged(by_doc.get(d, []))
            out.append({
                "n_words": int(first[d + 1] - first[d]),
                "words": [[int(a - first[d]), int(b - first[d])] for a, b in own],
                "bytes": [[int(start[a] - offsets[d]), int(end[b - 1] - offsets[d])] for a, b in own],
                "items": sorted({windows.item_ids[k] for k in items.get(d, ())}),
            })
    return out


def _add(old: dict, new: dict) -> dict:
    """The hits of two parts of the benchmark in one text."""
    join = lambda k: [list(x) for x in _merged([tuple(s) for s in old[k] + new[k]])]
    return {"n_words": new["n_words"], "words": join("words"), "bytes": join("bytes"),
            "items": sorted(set(old["items"]) | set(new["items"]))}


def _finder(shared, more: bool):
    def run(batches):
        windows = shared()
        for batch in batches:
            found = _judged(ts.text_array(batch.column(1)), windows)
            if more:
                found = [_add(a, b) for a, b in zip(batch.column(2).to_pylist(), found)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, FOUND)],
                                             names=["id", "text", "found"])
    return run


def _filter(shared, text_at: int):
    def run(batches):
        windows = shared()
        for batch in batches:
            found = _judged(ts.text_array(batch.column(text_at)), windows)
            yield batch.filter(pa.array([not f["words"] for f in found], pa.bool_()))
    return run


def _pieces(n: int, limit: int):
    """Item texts with their number of windows, cut at ``limit`` windows."""
    def run(batches):
        for batch in batches:
            out = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = (text or "").encode()
                start, end = ts.word_bounds(np.frombuffer(raw, np.uint8))
                if len(start):
                    count = max(1, len(start) - n + 1)
                    for a in range(0, count, limit):
                        b = min(a + limit, count)
                        last = min(b + n - 1, len(start)) - 1
                        out.append((item, raw[start[a]:end[last]].decode(), b - a))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.string()),
                                              pa.array([o[2] for o in out], pa.int64())], names=["item", "text", "windows"])
    return run


def window_parts(benchmark: DataFrame, item_col: str, text_col: str, n: int, limit: int):
    """Yield a WindowSet for each part of at most ``limit`` windows."""
    items = stage(benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                                   F.col(text_col).cast("string").alias("text"))
                  .mapInArrow(_pieces(n, limit), "item string, text string, windows long"), "benchmark-windows")
    whole = (items.agg(F.sum("windows").alias("all")).first()["all"] or 0) <= limit
    part, held = [], 0
    for row in items.collect() if whole else items.orderBy("item").toLocalIterator():
        if part and held + row["windows"] > limit:
            yield WindowSet(part, n)
            part, held = [], 0
        part.append((row["item"], row["text"]))
        held += row["windows"]
    yield WindowSet(part, n)


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", n: int = WINDOW,
         max_windows: int = MAX_WINDOWS) -> DataFrame:
    """One row per document: ``id_col``, n_words, n_hit, words (hit ranges of
    word numbers), bytes (hit byte ranges of the UTF-8 text), items."""
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", id_type), T.StructField("text", T.StringType()),
                           T.StructField("found", T.StructType([
                               T.StructField("n_words", T.LongType()),
                               T.StructField("words", T.ArrayType(T.ArrayType(T.LongType()))),
                               T.StructField("bytes", T.ArrayType(T.ArrayType(T.LongType()))),
                               T.StructField("items", T.ArrayType(T.StringType()))]))])
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    for k, windows in enumerate(window_parts(benchmark, item_col, item_text_col, n, max_windows)):
        if k:
            out = stage(out, "decontaminate")
        out = out.mapInArrow(_finder(share(spark, windows), k > 0), schema)
    hit = F.aggregate("found.words", F.lit(0).cast("long"), lambda a, s: a + s[1] - s[0])
    return out.select(F.col("id").alias(id_col), "found.n_words", hit.alias("n_hit"), "found.words",
                      "found.bytes", "found.items")


def remove(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", n: int = WINDOW, max_windows: int = MAX_WINDOWS) -> DataFrame:
    """The rows of ``docs`` that hold no window of the benchmark, unchanged."""
    spark, at = docs.sparkSession, docs.columns.index(text_col)
    out = docs
    for k, windows in enumerate(window_parts(benchmark, item_col, item_text_col, n, max_windows)):
        if k:
            out = stage(out, "decontaminate")
        out = out.mapInArrow(_filter(share(spark, windows), at), docs.schema)
    return out


def remove_spans(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 **options) -> DataFrame:
    """``id_col`` and the text without its hit byte ranges; null stays null."""
    def cut(batches):
        for batch in batches:
            kept = []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                raw = (text or "").encode()
                for a, b in reversed(spans or []):
                    raw = raw[:a] + raw[b:]
                kept.append(None if text is None else raw.decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.string())], names=["id", "text"])

    both = docs.select(F.struct(F.col(id_col).alias("i"), F.col(text_col).alias("t")).alias("key"),
                       F.col(text_col).alias(text_col))
    found = find(both, benchmark, "key", text_col, **options)
    return (found.select(F.col("key.i").alias("id"), F.col("key.t").alias("text"), "bytes")
            .mapInArrow(cut, T.StructType([T.StructField("id", docs.schema[id_col].dataType),
                                           T.StructField("text", T.StringType())]))
            .toDF(id_col, text_col))


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The contract's digest of ``find``: counts, the items' hash, a verdict."""
    ids = F.array_sort("items")
    return find(docs, benchmark, **options).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
