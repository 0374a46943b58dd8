"""Collocations by level-wise mining against counting every phrase."""

import re
from collections import Counter

import pytest

from tillroll.llm import blocks, collocations

SCHEMA = "doc_id long, lang string, text string"


def brute(rows, least, top=2000, most=3, absorbed=50):
    f, n = Counter(), Counter()
    for _, lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = tuple(re.findall("[^ \t]+", piece))
            n[lang] += len(words)
            for k in range(1, most + 1):
                f.update((lang, words[i:i + k]) for i in range(len(words) - k + 1))
    found = {g: a for g, a in f.items() if a >= least and len(g[1]) > 1}
    out = {}
    for (lang, g), a in found.items():
        if any(l2 == lang and len(h) > len(g) and 100 * b >= absorbed * a
               and any(h[i:i + len(g)] == g for i in range(len(h) - len(g) + 1)) for (l2, h), b in found.items()):
            continue
        cuts = [(1000000 * a * a // (f[lang, g[:k]] * f[lang, g[k:]]), k) for k in range(1, len(g))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(g).encode(), a, f[lang, g[:k]], f[lang, g[k:]], score))
    return {(lang, i + 1, p.decode(), a, l, r, n[lang], s) for lang, lines in out.items()
            for i, (_, _, p, a, l, r, s) in enumerate(sorted(lines)[:top])}


def corpus():
    words = "the The of a été ÉTÉ data, Data set. model\x0bnew york new york city\tis # 42 naïve\x00x".split(" ")
    rows = []
    for i in range(120):
        text = " ".join(words[(i * 7 + j * j * (1 + i % 5)) % len(words)] for j in range(i % 40))
        rows.append((i, [None, "en", "und", "", "fr"][i % 5], text + (" of the new york city" if i % 3 else "")))
    rows += [(None, "en", None), (3, "en", ""), (3, "en", ",.;"), (5, "en", "   "), (5, "en", "hot pair " * 400),
             (6, "en", "no-break " + "x" * 70000 + " end")] + [(7, "en", "a b c a b c. a b")] * 30
    return rows


def result(docs, **kw):
    return {tuple(r) for r in collocations.collocations(docs, **kw).collect()}


@pytest.mark.parametrize("tokens,keys,least", [(2_000_000, 1_500_000, 3), (37, 50, 3), (200, 30, 10)])
def test_equal_to_counting_all_phrases(spark, monkeypatch, tokens, keys, least):
    monkeypatch.setattr(blocks, "TOKENS", tokens)
    monkeypatch.setattr(blocks, "KEYS", keys)
    monkeypatch.setattr(blocks, "SEGMENT", 997 if tokens < 100 else blocks.SEGMENT)
    docs = spark.createDataFrame(corpus(), SCHEMA).repartition(3)
    assert result(docs, least=least) == brute(corpus(), least)


def test_longer_phrases_and_top(spark, monkeypatch):
    monkeypatch.setattr(blocks, "TOKENS", 100)
    docs = spark.createDataFrame(corpus(), SCHEMA)
    assert result(docs, least=4, most_words=5) == brute(corpus(), 4, most=5)
    assert result(docs, least=4, top=3) == brute(corpus(), 4, top=3)


def test_scores_past_64_bits(spark):
    """1000000 a a is above 2**63 from a = 3.1 million on."""
    found = spark.createDataFrame([("en", "a b", [], [10 ** 12, 10 ** 12 + 7, 3 * 10 ** 12 + 1])],
                                  "lang string, phrase string, inner array<string>, nums array<long>")
    langs = spark.createDataFrame([("en", 10 ** 13)], "lang string, n long")

    def given(*_):
        return found, langs

    old, collocations.candidates = collocations.candidates, given
    try:
        row = collocations.collocations(found).first()
    finally:
        collocations.candidates = old
    assert row["score"] == 10 ** 6 * 10 ** 24 // ((10 ** 12 + 7) * (3 * 10 ** 12 + 1))


def test_empty_table_and_clashing_columns(spark):
    empty = collocations.collocations(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == [] and empty.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    docs = spark.createDataFrame([(i, "x y", "en", 1, 2, "z") for i in range(12)],
                                 "doc_id long, text string, lang string, n long, score long, phrase string")
    assert [tuple(r) for r in collocations.collocations(docs).collect()] == [("en", 1, "x y", 12, 12, 12, 24, 1000000)]
