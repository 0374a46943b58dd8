"""Line CRF: marginals against brute force, held-out accuracy, edge cases."""

import itertools

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillroll.llm import line_crf as crf
from tillroll.llm.staging import read_table

SF = "/root/testdata/sf0.01"


def test_marginals_equal_enumeration():
    r = np.random.default_rng(5)
    first = np.array([0, 1, 6, 9])
    x = r.normal(size=(9, 4))
    model = {"w": r.normal(size=4), "move": r.normal(size=(2, 2)), "begin": r.normal(size=2)}
    got, want = crf.marginals(x, first, model), []
    for a, b in zip(first, first[1:]):
        total, good = 0, np.zeros(b - a)
        for path in itertools.product((0, 1), repeat=b - a):
            s = model["begin"][path[0]] + sum(model["move"][i, j] for i, j in zip(path, path[1:]))
            p = np.exp(s + sum((x[a + k] @ model["w"]) * y for k, y in enumerate(path)))
            total += p
            good += p * np.array(path)
        want += (good / total).tolist()
    assert got == pytest.approx(want)


def test_lines_and_neighbours_stay_in_their_text():
    texts = pa.array([b"one two\n\nthree", b"", b"x\n"], pa.large_binary())
    from tillroll.llm import textscan as ts
    (_, _, data, offsets), = ts.chunks(texts)
    features, weight, first = crf.line_features(data, offsets)
    assert first.tolist() == [0, 3, 4, 6] and weight.tolist() == [8, 1, 6, 1, 2, 1]
    x = crf.with_neighbours(features, first)
    n = features.shape[1]
    assert not x[0, 1 + n:1 + 2 * n].any() and not x[2, 1 + 2 * n:].any() and not x[3, 1 + n:].any()


def test_chunking_changes_nothing():
    r = np.random.default_rng(1)
    texts = pa.array([bytes(r.integers(0, 128, k * 7).astype(np.uint8)) for k in range(40)], pa.large_binary())
    n = 22
    model = {"w": r.normal(size=3 * n + 1) / 5, "move": np.eye(2), "begin": np.zeros(2),
             "centre": np.zeros(n), "scale": np.ones(n)}
    one = np.concatenate([crf.score_texts(texts[i:i + 1], model) for i in range(40)])
    assert crf.score_texts(texts, model) == pytest.approx(one)


def test_held_out_accuracy(spark):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    got = crf.score(docs, crf.train(docs, labels)).where("held_out").join(labels, "doc_id").collect()
    assert len(got) > 40 and sum(r.predicted == r.quality for r in got) >= 0.95 * len(got)


def test_edge_cases(spark):
    schema = "doc_id long, text string, label int, score double"
    rows = [(i, "A plain line of words.\nAnother one here." if i % 2 else "x|| y|| z||\na| b|", 9, 1.0) for i in range(60)]
    docs = spark.createDataFrame(rows + [(None, None, 0, 0.0), (70, "", 0, 0.0), (3, rows[3][1], 0, 0.0),
                                         (71, "word " * 60000, 0, 0.0)], schema)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (1, None)], "doc_id long, quality int")
    model = crf.train(docs, labels)
    got = crf.score(docs, model).collect()
    assert len(got) == 64 and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == r.doc_id % 2 for r in got if r.doc_id is not None and r.doc_id < 60)
    assert [r.held_out for r in got if r.doc_id is None] == [True]
    assert len({r.score for r in got if r.doc_id == 3}) == 1
    kept = crf.keep(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {1, 3, 5}
    assert crf.score(docs.limit(0), model).count() == 0
    assert crf.train(docs, labels.limit(0)) is None
    assert {r.score for r in crf.score(docs, None).collect()} == {0.5}


def test_text_above_the_line_bound_is_passed_over(spark):
    rows = [(i, "A plain line of words.\nAnother one here." if i % 2 else "x|| y|| z||\na| b|") for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = labels.where(~crf.held_out(F.col("doc_id")))
    first = known.orderBy(F.xxhash64(F.col("doc_id").cast("string"))).first().doc_id
    long = docs.withColumn("text", F.when(F.col("doc_id") == first, F.repeat(F.lit("line\n"), 500)).otherwise(F.col("text")))
    model = crf.train(long, labels, sample_lines=400)
    want = crf.train(docs.where(F.col("doc_id") != first), labels, sample_lines=400)
    assert model is not None and all(np.allclose(model[k], want[k]) for k in want)
    got = crf.score(docs, model).collect()
    assert all(r.predicted == r.doc_id % 2 for r in got)
