"""URL filter: parsing, rules, Viterbi against all cuts, naive Bayes by hand."""

import itertools
import math

import pytest

from tillroll.llm import url_filter as uf


@pytest.mark.parametrize("url,want", [
    ("http://WWW.Example.com/En/a?b#c", ("www.example.com", "/En/a")), (None, ("", "")), ("no scheme/x", ("", "")),
    ("http://h", ("h", "")), ("http://h?x=/a", ("h", "")), ("x://a.b:80/p#q", ("a.b:80", "/p")), ("", ("", "")),
    ("a://b://c/d", ("b:", "//c/d")), ("http://É.com/\nx", ("É.com", "/\nx")), ("://", ("", "")),
])
def test_split(url, want):
    assert uf.split_url(url) == want


@pytest.mark.parametrize("host,path,want", [
    ("example.com", "/en/1", ("example.com/en/", "block")), ("www.example.com", "/en/", ("www.example.com/en/", "allow")),
    ("a.www.example.com", "/en/x", ("www.example.com/en/", "allow")), ("myexample.com", "/en/", ("com/", "allow")),
    ("x.net", "/es/a", ("net/es/", "block")), ("x.net", "/es", (None, None)), ("com", "", (None, None)),
    ("com", "/", ("com/", "allow")), ("x.org", "/en/", (None, None)), ("", "", (None, None)),
])
def test_rules(host, path, want):
    assert uf.Rules(uf.RULES).find(host, path) == want


def test_viterbi_is_the_best_of_all_cuts():
    seg = uf.Segmenter({"casino": 50, "win": 40, "cas": 5, "ino": 5, "in": 90, "a": 3, "nowin": 1})
    price = lambda w: seg.cost.get(w, seg.unknown + seg.letter * len(w))
    for run in ("casinowin", "winwin", "xyzwin", "casin", "a"):
        cuts = [[run[a:b] for a, b in zip((0, *c), (*c, len(run)))]
                for k in range(len(run)) for c in itertools.combinations(range(1, len(run)), k)]
        assert sum(map(price, seg.words(run))) == pytest.approx(min(sum(map(price, c)) for c in cuts))
    assert seg.words("casinowin") == ["casino", "win"] and seg.words("") == []


def test_bayes_by_hand():
    b = 1 << 10
    rows = [(0, -1, 6), (1, -1, 2), (0, uf.bucket("p:good", b), 5), (1, uf.bucket("p:bad", b), 3)]
    model = uf.Model(rows, b)
    odds = math.log(2 / 6) + math.log((4 / 5) / (1 / 7))
    assert model.blocks(["p:bad"]) == (odds > 0)
    assert not model.blocks(["p:good"]) and not model.blocks([])
    assert not uf.Model([], b).blocks(["p:bad"])


def test_query(spark):
    schema = "page_id long, url string, html string, host string"
    rows = [(1, "http://x.com/de/shop", "<title>casino win shop</title>", "c"),
            (2, "http://casinowin.net/es/casino", "<title>Casino win win casino</title>", "c"),
            (3, "http://casinowin.org/casino", None, "c"), (4, "http://x.org/shop", "", "c"), (None, None, None, None),
            (4, "http://x.org/shop", "", "c"), (6, "http://" + "ab" * 5000 + ".org/" + "z/" * 5000, "<title>", "c")]
    pages = spark.createDataFrame(rows, schema)
    trained = uf.train(pages)
    got = uf.judge(pages, trained).collect()
    by_id = {r.page_id: r for r in got}
    assert len(got) == 7 and by_id[1].rule == "com/" and by_id[2].verdict == "block" and by_id[2].rule == "net/es/"
    assert by_id[3].verdict == "block" and by_id[3].rule is None and "h:casino" in by_id[3].words
    assert by_id[4].verdict == "allow" and (by_id[None].host, by_id[None].path) == ("", "")
    kept = uf.allowed(pages, trained)
    assert kept.columns == pages.columns and kept.count() == sum(r.verdict == "allow" for r in got)
    assert uf.judge(pages.limit(0), uf.train(pages.limit(0))).count() == 0


@pytest.mark.parametrize("times", [lambda k: 1 + 300 // (k + 1), lambda k: 1, lambda k: 200 + k % 3])
def test_lexicon_holds_exactly_the_most_frequent_words(spark, times):
    words = [a + b for a in "bcdfgh" for b in "aeiouxyz"]
    counts = {w: times(k) for k, w in enumerate(words)}
    pages = spark.createDataFrame([(f"http://h/{' '.join([w] * n)}", None) for w, n in counts.items()],
                                  "url string, html string").repartition(4)
    for size in (1, 7, 20, 47, 48, 100):
        got = uf.lexicon(pages, "url", "html", size)
        assert sorted(got.values(), reverse=True) == sorted(counts.values(), reverse=True)[:size]
        assert all(counts[w] == n for w, n in got.items())
