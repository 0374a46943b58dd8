"""Language-model scores against an n-gram model in dictionaries."""

import math
import re
import zlib
from collections import Counter

import pytest

from tillroll.llm import backoff_lm, blocks

SCHEMA = "doc_id long, text string"


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall("[^ \t-\r]+", low) + [None]


def brute(rows, order):
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in rows]
    counts = Counter()
    for (_, text), out in zip(rows, held):
        if not out:
            t = tokens(text)
            counts.update(tuple(t[k:k + n]) for n in range(1, order + 1) for k in range(len(t) - n + 1))
    singles = {g: c for g, c in counts.items() if len(g) == 1}
    total, kinds = sum(singles.values()), len(singles)
    out = []
    for (i, text), h in zip(rows, held):
        t, score, base = tokens(text), 0.0, 0.0
        for k, w in enumerate(t):
            p = (counts[(w,)] + 0.1) / (total + 0.1 * (kinds + 1)) if total + kinds else 0.1 / 0.1
            base += math.log10(p)
            for n in range(2, order + 1):
                if k >= n - 1:
                    context, m = tuple(t[k - n + 1:k]), backoff_lm.STRENGTH[min(n, 3)]
                    if counts[context]:
                        p = (counts[context + (w,)] + m * p) / (counts[context] + m)
            score += math.log10(p)
        out.append((i, h, len(t), sum(counts[(w,)] > 0 for w in t), total, round(base, 6), round(score, 6)))
    return sorted(out, key=str)


def corpus():
    words = "the a The of été data set model naïve\x00x 42 . new york city is".split(" ")
    rows = [(i, " ".join(words[(i * 5 + j * j * (1 + i % 4)) % len(words)] for j in range(i * 3 % 50))) for i in range(150)]
    rows += [(None, "the data set"), (None, None), (7, None), (7, ""), (8, " \t\n"), (9, "hot pair\x0b" * 700),
             (10, "x" * 70000 + " the end"), (11, "the data set"), (11, "the data set"), (1000, "unseen words only here")]
    return rows


def result(docs, **kw):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
                   for r in backoff_lm.score(docs, **kw).collect()), key=str)


@pytest.mark.parametrize("size,keys,order", [(2_000_000, 1_500_000, 3), (41, 60, 3), (100, 30, 2), (64, 100, 4), (50, 50, 1)])
def test_equal_to_a_model_in_dictionaries(spark, monkeypatch, size, keys, order):
    monkeypatch.setattr(blocks, "TOKENS", size)
    monkeypatch.setattr(blocks, "KEYS", keys)
    monkeypatch.setattr(backoff_lm, "LANE", 8)
    monkeypatch.setattr(blocks, "SEGMENT", 499 if size < 100 else blocks.SEGMENT)
    docs = spark.createDataFrame(corpus(), SCHEMA).repartition(3)
    assert result(docs, order=order) == brute(corpus(), order)


def test_probabilities_sum_to_one(spark):
    """Over the known tokens and an unknown one, after any context."""
    train = [(i, "a b c a b d b a") for i in range(1, 30)]
    kinds = [w for w in "a b c d".split()] + ["zzz"]
    held = next(i for i in range(10 ** 6) if zlib.crc32(str(i).encode()) % 10 == 0)
    for context in ("a b", "b", "zzz a", "c"):
        rows = train + [(held, f"{context} {w}".strip()) for w in kinds] + [(held, context)]
        got = {}
        for r in backoff_lm.score(spark.createDataFrame([(i, t) for i, t in rows], SCHEMA).coalesce(1)
                                  .withColumnRenamed("doc_id", "id"), id_col="id").where("held_out").collect():
            got.setdefault(r.n_tokens, []).append(r)
        # log p(context w end) - log p(end | context w) is wanted; compare through the model in dictionaries.
        want = brute(rows, 3)
        assert sorted(round(r.score, 6) for n in got for r in got[n]) == sorted(w[6] for w in want if w[1])
    counts = Counter()
    for _, text in train:
        if zlib.crc32(str(_).encode()) % 10:
            t = tokens(text)
            counts.update(tuple(t[k:k + n]) for n in (1, 2, 3) for k in range(len(t) - n + 1))
    total, kinds = sum(c for g, c in counts.items() if len(g) == 1), sum(len(g) == 1 for g in counts)

    def p(context, w):
        value = (counts[(w,)] + 0.1) / (total + 0.1 * (kinds + 1))
        for n in (2, 3):
            c, m = context[len(context) - n + 1:], backoff_lm.STRENGTH[n]
            if len(c) == n - 1 and counts[c]:
                value = (counts[c + (w,)] + m * value) / (counts[c] + m)
        return value

    for context in (("a", "b"), ("b",), ("zzz", "a"), ()):
        assert abs(sum(p(context, w) for w in ("a", "b", "c", "d", None, "zzz")) - 1) < 1e-12


def test_no_training_rows_empty_table_and_clashing_columns(spark):
    held = next(i for i in range(10 ** 6) if zlib.crc32(str(i).encode()) % 10 == 0)
    only = backoff_lm.score(spark.createDataFrame([(held, "a b")], SCHEMA)).first()
    assert (only.n_tokens, only.n_known, only.train_tokens, only.score) == (3, 0, 0, 0.0)
    empty = backoff_lm.score(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == []
    assert empty.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    docs = spark.createDataFrame([(i, "x y", 5, "q", True) for i in range(9)],
                                 "doc_id long, text string, n_tokens long, score string, held_out boolean")
    assert {r.n_tokens for r in backoff_lm.score(docs).collect()} == {3}
