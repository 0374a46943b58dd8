"""Components, embedding join and document join against brute force; edge cases."""

import itertools
import math
import random

import numpy as np
import pyarrow as pa
import pytest

from llm.brute import brute_docs, reach
from tillroll.llm import bayes_join as bj, grid_join as gj, textscan as ts
from tillroll.llm.components import components, star_edges
from tillroll.llm.grouped import groups


def test_components_of_paths_stars_and_cliques(spark):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, k) for k in range(1000, 1080)] + list(
        itertools.combinations(range(200, 208), 2)) + [(7, 7), (300, 301), (301, 300)]
    edges += [(r.randrange(2000, 2090), r.randrange(2000, 2090)) for _ in range(60)]
    got = {x.node: x.component for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    used = {v for a, b in edges if a != b for v in (a, b)}
    want = reach(used, [e for e in edges if e[0] != e[1]])
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_star_edges():
    linked = np.zeros((6, 6), bool)
    for a, b in ((4, 2), (2, 5), (1, 3)):
        linked[a, b] = linked[b, a] = True
    at, to = star_edges(linked)
    assert dict(zip(at.tolist(), to.tolist())) == {4: 2, 5: 2, 3: 1}


@pytest.mark.parametrize("size", [1, 2, 3, 7, 100])
def test_groups_over_batches(size):
    keys = sorted(random.Random(size).randrange(6) for _ in range(40))
    table = pa.table({"k": keys, "j": [0] * 40, "v": range(40)})
    got = []
    for run, bounds in groups(iter(table.to_batches(max_chunksize=size)), 2):
        k = run.column("k").to_pylist()
        got += [(k[a], run.column("v").to_pylist()[a:b]) for a, b in zip(bounds, bounds[1:])]
    assert got == [(k, [v for v, x in enumerate(keys) if x == k]) for k in sorted(set(keys))]


def vectors(seed=4):
    r = np.random.default_rng(seed)
    out, vid = [], 0
    for label in (0, 1, 2):
        for _ in range(60):
            base = r.normal(size=12)
            for _ in range(int(r.integers(1, 4))):
                noisy = base + r.normal(size=12) * r.choice([0, 0.02, 0.1, 0.2])
                out.append((vid, [float(x) for x in noisy.astype(np.float32)], label))
                vid += 1
    hot = r.normal(size=12)
    out += [(vid + k, [float(x) for x in (hot + r.normal(size=12) * 0.01)], 9) for k in range(700)]
    vid += 700
    odd = [None, [], [0.0] * 12, [None] + [1.0] * 11, [float("nan")] * 12, [float("inf")] * 12, [1.0] * 5, [1.0] * 5]
    out += [(vid + k, e, 0) for k, e in enumerate(odd)] + [(vid + 50, [1.0] * 12, None), (None, out[0][1], 0)]
    return out + [out[3], out[3]]


def brute(rows):
    def cos(a, b):
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(x * x for x in b))

    def fine(e, label):
        return label is not None and e and all(x is not None and math.isfinite(x) for x in e) and any(e)

    good = [i for i, (_, e, label) in enumerate(rows) if fine(e, label)]
    links = [(i, j) for i, j in itertools.combinations(good, 2) if rows[i][2] == rows[j][2]
             and len(rows[i][1]) == len(rows[j][1]) and cos(rows[i][1], rows[j][1]) >= 0.93]
    label = reach(range(len(rows)), links)
    n = [0] * len(rows)
    for a, b in links:
        n[a], n[b] = n[a] + 1, n[b] + 1
    members = {}
    for i, c in label.items():
        members.setdefault(c, []).append(rows[i][0])
    least = {c: min((m for m in ms if m is not None), default=None) for c, ms in members.items()}
    return sorted(((r[0], n[i], least[label[i]], r[0] == least[label[i]]) for i, r in enumerate(rows)), key=str)


def test_embedding_join_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(gj, "BLOCK", 64)
    monkeypatch.setattr(gj, "LEAF", 8)
    rows = vectors()
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5)
    got = sorted(map(tuple, gj.near_duplicates(table).collect()), key=str)
    rows32 = [(v, None if e is None else [None if x is None else float(np.float32(x)) for x in e], lab) for v, e, lab in rows]
    assert got == brute(rows32)
    assert gj.near_duplicates(table.limit(0)).count() == 0


def test_pruning_skips_distant_blocks():
    left, right = np.eye(4)[:1].repeat(300, 0), np.eye(4)[1:2].repeat(300, 0)
    x, _ = gj.near_pairs(left, right, left, right, False, 0.93, math.sqrt(0.14))
    assert not len(x)
    x, y = gj.near_pairs(left, left, left, left, True, 0.93, math.sqrt(0.14))
    assert len(x) == 300 * 299 // 2 and (x < y).all()


def documents():
    r = random.Random(11)
    word = lambda: "".join(r.choice("abcdé9") for _ in range(r.randint(2, 6)))
    rows, texts = [], []
    for _ in range(60):
        texts.append([word() for _ in range(r.randint(6, 160))])
    for base in texts:
        rows.append(" ".join(base))
        for _ in range(r.randint(0, 3)):
            new = list(base)
            for _ in range(r.randint(0, 1 + len(base) // 20)):
                new[r.randrange(len(new))] = word()
            rows.append(" ".join(new))
    hot = [word() for _ in range(200)]
    for _ in range(90):
        new = list(hot)
        for _ in range(r.randint(0, 8)):
            new[r.randrange(200)] = word()
        rows.append(" ".join(new))
    rows += [None, "", "...", "one", "One!", "one two three four", "ONE two, three four", "a b c d e"] + [rows[0].upper()] * 4
    return [(i, t) for i, t in enumerate(rows)] + [(0, rows[0]), (None, rows[0]), (2, "other text with the same id here"),
                                                   (5, "w " * 40000)]


def test_document_join_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(bj, "BUCKET_BLOCK", 16)
    monkeypatch.setattr(bj, "CLUSTER_BLOCK", 4000)
    rows = documents()
    docs = spark.createDataFrame([(i, t, 1, 2.0) for i, t in rows], "doc_id long, text string, n int, h1 double").repartition(4)
    got = sorted(map(tuple, bj.link(docs).collect()), key=str)
    assert got == sorted(brute_docs(rows), key=str)
    kept = bj.keep(docs)
    assert kept.columns == docs.columns
    texts = [(r.doc_id, r.text) for r in kept.collect()]
    want = [(i, t) for (i, t), (_, least, n, size) in zip(rows, brute_docs(rows)) if not n or i == least]
    assert len(texts) < len(rows)
    # One row of each linked component; documents of id 0 occur twice with one set.
    groups_kept = {least for (_, least, n, _) in brute_docs(rows) if n}
    alone = sum(not n for (_, _, n, _) in brute_docs(rows))
    assert len(texts) == len(groups_kept) + alone and {i for i, _ in texts} <= {i for i, _ in want}
    assert bj.link(docs.limit(0)).count() == 0 and bj.keep(docs.limit(0)).count() == 0


def test_minhash_estimates_and_pruning():
    r = np.random.default_rng(0)
    a, b = r.integers(0, 2**63, 900).astype(np.uint64), r.integers(0, 2**63, 100).astype(np.uint64)
    sets = [np.unique(a), np.unique(np.concatenate([a[:800], b]))]
    bounds = np.cumsum([0] + [len(s) for s in sets])
    h = bj.minhashes(np.concatenate(sets), bounds)
    assert abs((h[0] == h[1]).mean() - 0.8) < 0.12
    least = bj.least_matches()
    assert bj.survivors(h[:1], h[1:], least).all()
    assert not bj.survivors(h[:1], bj.minhashes(b, np.array([0, 100])), least).any()
    assert bj.shared_counts(sets, width=64)[0, 1] == len(np.intersect1d(*sets))


def test_shingles_do_not_cross_texts():
    (_, _, data, offsets), = ts.chunks(pa.array([b"a b c d e f", b"", b"g h", b"A-B c.d E"], pa.large_binary()))
    values, bounds = bj.shingles(data, offsets)
    assert np.diff(bounds).tolist() == [2, 0, 1, 1]
    assert values[3] in values[:2]


def test_rows_without_an_id_meet_only_their_own_class(spark):
    rows = []
    for i in range(1500):
        words = [f"w{i}x{k}" for k in range(80)]
        rows += [(None, " ".join(words)), (None, " ".join(words[:-1] + ["other"]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = bj.link(docs).collect()
    assert len(got) == 3000 and {(r.doc_id, r.class_id, r.n_links) for r in got} == {(None, None, 1)}
    assert bj.keep(docs).count() == 1500
