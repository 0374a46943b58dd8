"""Decontamination against brute force; parts of a large benchmark; edge cases."""

import random

import pytest
from pyspark.sql import functions as F

from llm.brute import brute_windows
from tillroll.llm import decontaminate as dc


def case():
    r = random.Random(3)
    word = lambda: r.choice(["ab", "cd", "Ef", "é", "x1", "gh"])
    items = [(i, " ".join(word() for _ in range(r.choice([0, 1, 3, 9, 10, 11, 25])))) for i in range(12)]
    items += [(100, None), (101, "..."), (None, "zz yy"), (12, items[4][1])]
    docs = [(i, " ".join(word() for _ in range(r.randint(0, 60)))) for i in range(40)]
    docs += [(50 + k, "q " * k + (t or "").upper() + "; w") for k, (_, t) in enumerate(items)]
    return docs + [(None, None), (90, ""), (91, "zz, YY"), (91, "zz, YY"), (92, "v " * 100000 + "zz yy")], items


@pytest.mark.parametrize("limit", [dc.MAX_WINDOWS, 20])
def test_find_equals_brute_force(spark, limit):
    docs, items = case()
    table = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, found int").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = dc.find(table, bench, max_windows=limit).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got), key=str) == brute_windows(docs, items)
    clean = {d for d, _, hit, _ in brute_windows(docs, items) if not hit}
    kept = dc.remove(table, bench, max_windows=limit)
    assert kept.columns == table.columns and {r.doc_id for r in kept.collect()} == clean


def test_spans_are_cut(spark):
    docs = spark.createDataFrame([(1, "Keep é this. ZZ, yy! And this"), (2, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "zz yy")], "item_id long, text string")
    got = {r.doc_id: r.text for r in dc.remove_spans(docs, bench).collect()}
    assert got == {1: "Keep é this. ! And this", 2: None}


def test_empty_tables(spark):
    docs, items = case()
    table = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert dc.contamination(table.limit(0), bench).count() == 0
    assert dc.contamination(table, bench.limit(0)).where(F.col("contaminated")).count() == 0


@pytest.mark.parametrize("limit", [3, 11, 60, dc.MAX_WINDOWS])
def test_repeated_ids_and_one_very_long_item_in_any_number_of_parts(spark, limit):
    docs, _ = case()
    r = random.Random(8)
    long = " ".join(r.choice(["ab", "cd", "Ef", "é", "x1", "gh", "qq"]) for _ in range(150))
    words = long.split()
    items = [("q1", "zz yy"), ("q1", "q q q zz yy ab"), ("q1", "zz yy"), ("long", long), (None, "ab cd"), ("", "ab cd"), ("q2", None)]
    docs = docs + [(200 + k, "v " + " ".join(words[a:a + size]) + " v") for k, (a, size) in
                   enumerate([(0, 10), (5, 9), (2, 10), (9, 25), (140, 10), (0, 150), (58, 14)])]
    bench = spark.createDataFrame(items, "item_id string, text string").repartition(2)
    table = spark.createDataFrame(docs, "doc_id long, text string")
    got = dc.find(table, bench, max_windows=limit).collect()
    want = [(d, n, h, sorted(set(i))) for d, n, h, i in brute_windows(docs, [("" if i is None else i, t) for i, t in items])]
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got), key=str) == sorted(want, key=str)
    assert any(r["items"].count("q1") == 1 for r in got) and all(len(set(r["items"])) == len(r["items"]) for r in got)
