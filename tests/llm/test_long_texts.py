"""Long texts are scanned segment by segment: same results as in one piece."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm.brute import brute_windows, shingle_set
from tillroll.llm import bayes_join as bj, bpe, decontaminate as dc, line_crf as crf, textscan as ts, token_count, token_file
from tillroll.llm.queries import tokenizer_path

tokenizers = pytest.importorskip("tokenizers")


def texts():
    r = random.Random(21)
    words = ["ab", "Cd", "é", "x1", "日本語", "q" * 70, "!!", "\n", "\n\n", "\x00", "\r\n", "I'll", "<|endoftext|>", "y。z"]
    out = [" ".join(r.choice(words) for _ in range(r.randint(30, 400))) for _ in range(25)]
    same = "one line of text\n" * 30
    return out + ["a" * 300, "\n" * 200, "." * 200, same, same.replace("\n", "\n\n"), "w" * 64 + " " + "w" * 64 + "\n" + "v" * 128,
                  ("l " * 90 + "\n") * 4 + "end", "日本" * 100 + "。" + "語" * 150]


def chunk(text):
    (_, _, data, offsets), = ts.chunks(pa.array([text.encode()], pa.large_binary()))
    return data, offsets


@pytest.fixture
def short_segments(monkeypatch):
    def cut(size):
        monkeypatch.setattr(ts, "SEGMENT", size)
        monkeypatch.setattr(bpe, "SEGMENT", size)
        monkeypatch.setattr(bj, "SLICE", size)
        monkeypatch.setattr(crf, "LINES", max(2, size // 8))
        monkeypatch.setattr(token_file, "RUN", 4 * max(1, size // 16))
    return cut


@pytest.mark.parametrize("size", [16, 64, 100])
def test_words_and_shingles(short_segments, size):
    plain = [(ts.words(*chunk(t))[:3], bj.shingles(*chunk(t))) for t in texts()]
    whole = [(bj.set_hashes(*s), bj.minhashes(*s)) for _, s in plain]
    short_segments(size)
    for t, (words, (values, bounds)), (h, m) in zip(texts(), plain, whole):
        data, offsets = chunk(t)
        assert ts.is_long(offsets)
        got = [np.concatenate(c) for c in zip(*ts.word_stream(data))]
        assert all(np.array_equal(a, b) for a, b in zip(got, words))
        new, new_bounds = bj.shingles(data, offsets)
        assert np.array_equal(new, values) and new_bounds.tolist() == bounds.tolist()
        assert len(new) == len(shingle_set(t))
        assert np.array_equal(bj.minhashes(new, new_bounds), m)
        assert all(np.array_equal(a, b) for a, b in zip(bj.set_hashes(new, new_bounds), h))


@pytest.mark.parametrize("size", [4, 50, 1 << 17])
def test_intersections(short_segments, size):
    short_segments(size)
    r = np.random.default_rng(4)
    pool = np.sort(r.integers(0, 2**64, 300, np.uint64))
    sets = [np.sort(r.choice(pool, k, replace=False)) for k in (1, 5, 200, 250, 300)] + [np.array([pool[3]])]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    assert bj.shared_counts(sets).tolist() == want


@pytest.mark.parametrize("size", [16, 64, 100])
def test_windows(short_segments, size):
    items = [(1, "ab Cd é"), (2, texts()[0][:200]), (3, texts()[1][100:400]), (4, "é"), (5, "l " * 12), (6, "y z"), (7, "v" * 128)]
    windows = dc.WindowSet([(str(i), t) for i, t in items], 10)
    plain = [dc._judged(pa.array([t.encode()], pa.large_binary()), windows)[0] for t in texts()]
    short_segments(size)
    got = [dc._judged(pa.array([t.encode()], pa.large_binary()), windows)[0] for t in texts()]
    assert got == plain
    want = brute_windows(list(enumerate(texts())), items)
    assert sorted(((i, f["n_words"], sum(b - a for a, b in f["words"]), f["items"]) for i, f in enumerate(got)), key=str) == want
    assert any(f["items"] for f in got) and any(not f["items"] for f in got)


@pytest.mark.parametrize("size", [16, 64, 300])
def test_line_scores(short_segments, size):
    r = np.random.default_rng(2)
    model = {"w": r.normal(size=67) / 5, "move": r.normal(size=(2, 2)), "begin": r.normal(size=2),
             "centre": r.normal(size=22), "scale": np.ones(22)}
    plain = [(crf.line_features(*chunk(t)), crf.score_texts(pa.array([t.encode()], pa.large_binary()), model)[0]) for t in texts()]
    short_segments(size)
    for t, ((features, weight, _), score) in zip(texts(), plain):
        parts = list(crf.long_text_features(chunk(t)[0]))
        assert np.concatenate([f for f, _ in parts]) == pytest.approx(features)
        assert np.concatenate([w for _, w in parts]).tolist() == weight.tolist()
        assert crf.score_texts(pa.array([t.encode()], pa.large_binary()), model)[0] == pytest.approx(score)


def test_a_line_is_not_compared_with_another_text():
    both = pa.array([b"same line", b"same line"], pa.large_binary())
    (_, _, data, offsets), = ts.chunks(both)
    features, _, _ = crf.line_features(data, offsets)
    assert np.array_equal(features[0], features[1])


@pytest.mark.parametrize("size", [16, 64, 100])
def test_tokens(short_segments, size):
    library, vocabulary = tokenizers.Tokenizer.from_file(tokenizer_path()), bpe.compile_file(tokenizer_path())
    short_segments(size)
    cut = 0
    for t in texts():
        want = library.encode(t, add_special_tokens=False).ids
        ids, counts = token_file.encode_block([t], vocabulary, 1, np.uint16)
        assert ids.tolist() == want + [1] and counts.tolist() == [len(want) + 1]
        assert token_count.count_block([t], vocabulary, token_count.transitions()) == len(want)
        assert token_file.unpack(*token_file.pack(ids), len(ids)).tolist() == ids.tolist()
        parts = list(bpe.text_segments(t))
        assert "".join(parts) == t
        cut += len(parts) > 1
    assert cut > 20


def test_long_texts_through_spark(spark):
    r = random.Random(5)
    word = lambda: r.choice(["tree", "House", "é", "river", "x1", "stone", "\n"])
    base = [word() for _ in range(500_000)]
    near = base[:-40] + [word() for _ in range(40)]
    docs = [(1, " ".join(base)), (2, " ".join(near)), (3, "z" * 3_000_000), (4, "short text of five words"), (5, None)]
    assert all(len(t) > ts.SEGMENT for _, t in docs[:3])
    table = spark.createDataFrame(docs, "doc_id long, text string")
    links = {x.doc_id: (x.class_id, x.n_links, x.n_shingles) for x in bj.link(table).collect()}
    sets = {i: shingle_set(t) for i, t in docs}
    assert len(sets[1] & sets[2]) >= 0.8 * len(sets[1] | sets[2])
    assert links == {i: (1 if i == 2 else i, int(i < 3), len(sets[i])) for i, _ in docs}
    bench = spark.createDataFrame([("q", " ".join(base[400_000:400_100])), ("z", "z" * 3_000_000)], "item_id string, text string")
    found = {x.doc_id: x["items"] for x in dc.find(table, bench).collect()}
    assert "q" in found[1] and "q" in found[2] and found[3] == ["z"] and not found[4] and not found[5]
    library = tokenizers.Tokenizer.from_file(tokenizer_path())
    want = {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in docs if i != 3}
    small = table.where("doc_id <> 3")
    assert {x.doc_id: x.n_tokens for x in token_count.count_tokens(small, tokenizer_path()).collect()} == want
    assert {x.doc_id: x.n_tokens - 1 for x in token_file.round_trip(small, tokenizer_path()).collect()} == want
    scores = crf.score(table, {"w": np.ones(67) / 9, "move": np.eye(2), "begin": np.zeros(2), "centre": np.zeros(22),
                               "scale": np.ones(22)})
    assert scores.where(F.col("score").between(0, 1)).count() == 5
