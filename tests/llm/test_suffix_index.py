"""Repeated strings against brute force over all windows; edge cases."""

import hashlib
import random

import numpy as np
import pytest

from tillroll.llm import suffix_index as si


def brute(rows):
    """rows in document order -> (id, n_bytes, n_removed, n_spans, sha)."""
    seen, out = set(), []
    for doc, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, np.int8)
        for i in range(len(raw) - 99):
            window = raw[i:i + 100]
            if window in seen:
                gone[i:i + 100] = 1
            seen.add(window)
        rest = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((doc, len(raw), int(gone.sum()), int((np.diff(gone, prepend=0) == 1).sum()), hashlib.sha256(rest).hexdigest()))
    return out


def case(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgé ") for _ in range(r.randint(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, line = text(60), text(25)
    rows = []
    for _ in range(70):
        t = text(r.randint(0, 120))
        kind = r.randrange(7)
        if kind == 0 and rows:
            t = rows[r.randrange(len(rows))][1] or ""
        if kind == 1 and rows:
            t = list(rows[r.randrange(len(rows))][1] or "")
            for _ in range(r.randint(1, 4)):
                if t:
                    t[r.randrange(len(t))] = "#"
            t = "".join(t)
        if kind == 2:
            t = t[:r.randrange(len(t) + 1)] + passage + t
        if kind == 3:
            t = line + t + line + t[:150]
        if kind == 4:
            t = t[:30] + r.choice(["a", "ab", "word "]) * r.randint(30, 90) + t
        rows.append((len(rows) * 3 - 60, t))
    rows += [(1000, None), (1001, ""), (1002, "x" * 99), (1003, "x" * 100), (1004, "x" * 101), (1005, passage[:100]),
             (1006, passage[1:101] + "!"), (1007, "é" * 400)]
    return rows


@pytest.mark.parametrize("seed,hot", [(1, si.HOT), (2, 1)])
def test_equals_brute_force(spark, monkeypatch, seed, hot):
    monkeypatch.setattr(si, "HOT", hot)
    monkeypatch.setattr(si, "WINDOWS", 500)
    rows = case(seed)
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, doc int, n_bytes int").repartition(7)
    assert sorted(map(tuple, si.find(docs).collect())) == sorted(brute(rows))


@pytest.mark.parametrize("segment,chunk", [(si.SEGMENT, 300), (250, 100), (1 << 20, 1 << 20)])
def test_chunks_and_segments_change_no_window(monkeypatch, segment, chunk):
    """Every valid window is named by exactly one entry, whatever the cut."""
    import pyarrow as pa
    from tillroll.llm import textscan as ts

    monkeypatch.setattr(si, "SEGMENT", segment)
    monkeypatch.setattr(ts, "CHUNK", chunk)
    monkeypatch.setattr(ts.chunks, "__defaults__", (chunk,))
    texts = [(t or "").encode() for _, t in case(5)]
    starts = {d: [] for d in range(len(texts))}
    for e in si.text_entries(pa.array(texts, pa.large_binary()), np.arange(len(texts))):
        for d, p, lo, hi in zip(e["doc"], e["pos"], e["lo"], e["hi"]):
            starts[d] += range(int(p) - int(hi), int(p) - int(lo) + 1)
    assert all(sorted(starts[d]) == list(range(max(0, len(t) - 99))) for d, t in enumerate(texts))


def test_repeated_and_null_ids(spark):
    rows = case(3)[:30]
    long_text = "some words that are long enough " * 8
    rows = [(i, t) for i, t in rows] + [(5, long_text), (5, long_text), (5, "other " + long_text), (None, rows[4][1]), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = si.find(docs, keep_bytes=True).collect()
    assert len(got) == len(rows) and all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)
    # The order among rows of one id is fixed by the text's hash; of the same text all but the first go.
    same = sorted(r.n_removed for r in got if r.doc_id == 5 and r.n_bytes == len(long_text))
    assert same[1] == len(long_text)
    total = {x[2] for x in brute(sorted(((i if i is not None else -10**9, t) for i, t in rows), key=lambda x: x[0]))}
    assert total and si.find(docs.limit(0)).count() == 0


def test_levels_merge_geometrically(spark):
    index = si.SuffixIndex(4)
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(case(9))], "doc long, text string")
    sizes = []
    for k in range(7):
        index.add(docs.where(f"doc div 12 = {k}"))
        sizes.append([s for s, _ in index.levels])
    assert sizes == [[1], [1, 1], [2, 1], [2, 1, 1], [4, 1], [4, 1, 1], [4, 2, 1]]


def test_entries_spread_evenly_over_the_ranges():
    import pyarrow as pa

    r = random.Random(8)
    texts = [" ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(4000)).encode() for _ in range(6)]
    fp = si.join_entries(list(si.text_entries(pa.array(texts, pa.large_binary()), np.arange(6))))["fp"]
    sizes = np.bincount(si.bucket_of(fp, 8), minlength=8)
    assert sizes.max() < 1.3 * sizes.mean()
