"""Mixing: targets, budgets, epochs, ties, nulls, empty tables, clashing names."""

import pytest

from tillroll.llm import mix

SCHEMA = "doc_id long, source string, text string"


def filled(sizes: dict, share=1.5, most=2.0):
    """Targets by giving out shares round after round."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, free, rest = {}, set(names), share * sum(sizes.values())
    while free:
        level = rest / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > most * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in free}
        for s in over:
            target[s] = most * sizes[s]
            rest -= target[s]
        free -= over
    return target


def rows(n=400):
    out = []
    for i in range(n):
        source = None if i % 17 == 0 else ("hot" if i % 3 == 0 else f"s{i % 5}" if i % 2 else "Zé")
        out.append((i, source, None if i % 29 == 0 else " ".join(["w"] * (1 + i * 7 % 31))))
    return out


def test_targets_and_budgets(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    got = mix.mixture(docs).collect()
    sizes, taken, largest = {}, {}, {}
    source = {r[0]: r[1] for r in rows()}
    for r in got:
        s = source[r.doc_id]
        sizes[s] = sizes.get(s, 0) + r["size"]
        taken[s] = taken.get(s, 0) + r.taken
        largest[s] = max(largest.get(s, 0), r["size"])
        assert r.taken in (0, r["size"], 2 * r["size"])
    want = filled(sizes)
    for r in got:
        assert r.source_size == sizes[source[r.doc_id]]
        assert r.target == pytest.approx(want[source[r.doc_id]])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s]
    assert {(r.doc_id, r.taken) for r in got} == {(r.doc_id, r.taken) for r in mix.mixture(docs).collect()}


def test_whole_epochs_come_first(spark):
    got = mix.mixture(spark.createDataFrame(rows(), SCHEMA)).collect()
    source = {r[0]: r[1] for r in rows()}
    for s in set(source.values()):
        own = [r for r in got if source[r.doc_id] == s and r["size"]]
        if own[0].target >= own[0].source_size:
            assert all(r.taken >= r["size"] for r in own)


def test_quality_raises_the_odds(spark):
    good = [(i, "a", "plain words here") for i in range(2000)]
    bad = [(i + 2000, "a", "x| y$ z%") for i in range(2000)]
    fill = [(i + 5000, "b", "w " * 3) for i in range(12000)]
    got = mix.sample(spark.createDataFrame(good + bad + fill, SCHEMA), share=0.25).where("row.source = 'a'").collect()
    first = sum(r.copies for r in got if r.row.doc_id < 2000)
    second = sum(r.copies for r in got if r.row.doc_id >= 2000)
    assert first > second


def test_edge_cases(spark):
    assert mix.mixture(spark.createDataFrame([], SCHEMA)).count() == 0
    zero = mix.mixture(spark.createDataFrame([(1, "a", None), (None, None, "")], SCHEMA)).collect()
    assert [(r["size"], r.target, r.taken) for r in zero] == [(0, 0.0, 0)] * 2
    same = spark.createDataFrame([(7, "a", "x y")] * 6 + [(8, "b", "x")], SCHEMA)
    assert mix.mixture(same).count() == 7
    clash = spark.createDataFrame([(1, "a", "x y", "c", 3.0)], "doc_id long, source string, text string, key string, size double")
    out = mix.mixed(clash)
    assert out.columns == clash.columns and out.collect()[0]["size"] == 3.0
