"""Token counts and token files against the tokenizers library."""

import random
import tempfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import bpe, token_count, token_file
from tillroll.llm.queries import tokenizer_path

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.compile_file(tokenizer_path())


def texts():
    r = random.Random(7)
    out = ["", "'s", "it's we'll THEY'RE x'rx 'r 'l 'v a'ly ''s !'s 12's don't'", "aaaa aaaaaaa",
           "<|startoftext|>hi<|endoftext|> it's<|endoftext|>", "日本語 ñandú İstanbul ΣΑΣ é x\u0085y 1²½Ⅷ",
           "\x1c\x1da\x00b 😀👍🏽 ﬁ ǅ", "word " * 3000, "x" * 5000, "\n\n \t"]
    out += ["".join(r.choice("'srtvlemd aA1!é\n<|$") for _ in range(r.randint(0, 60))) for _ in range(300)]
    return out


def test_counts_equal_the_library(library, vocabulary):
    got = token_count.count_texts(texts(), vocabulary, token_count.transitions())
    assert got.tolist() == [len(e.ids) for e in library.encode_batch(texts(), add_special_tokens=False)]


def test_transducer_and_plain_cut_agree(vocabulary):
    codes = bpe.Codes(texts(), vocabulary)
    for a, b in zip(bpe.pieces(codes), token_count.piece_bounds(codes, token_count.transitions())):
        assert np.array_equal(a, b)


def test_scan_equals_a_plain_walk():
    table, r = token_count.transitions(), np.random.default_rng(3)
    classes = r.integers(0, 10, 3 * token_count.STEPS + 17).astype(np.uint8)
    state, want = 0, []
    for c in classes.tolist():
        want.append(int(table[state * 16 + c]))
        state = want[-1] & 15
    assert token_count.scan(classes, table).tolist() == want


def test_count_query(spark, library):
    rows = [(i, t, 1) for i, t in enumerate(texts())] + [(None, None, 2), (5, "twice", 3), (5, "twice", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted(map(tuple, token_count.count_tokens(docs, tokenizer_path(), limit=3).collect()), key=str)
    want = []
    for i, t, _ in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 3))
    assert got == sorted(want, key=str)
    assert token_count.count_tokens(docs.limit(0), tokenizer_path()).count() == 0


@pytest.mark.parametrize("top", [0, 3, 300, 70_000, 2**31])
def test_pack_round_trip(top):
    values = np.random.default_rng(top).integers(0, top + 1, 1001)
    for n in (0, 1, 3, 4, 1001):
        assert token_file.unpack(*token_file.pack(values[:n]), n).tolist() == values[:n].tolist()


def test_file_round_trip(spark, library):
    rows = [(i * 3, t) for i, t in enumerate(texts())] + [(4, None), (None, "no id"), (9, "twice"), (9, "twice")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("hash", F.lit(1)).repartition(5)
    path = tempfile.mkdtemp(prefix="tillroll-test-") + "/tokens"
    token_file.write(docs, path, tokenizer_path())
    got = token_file.read(spark, path).collect()
    digest = {r.start: r for r in token_file.read(spark, path, digest=True).collect()}
    want = sorted(((-1 if i is None else i), t or "") for i, t in rows)
    by_id = sorted(got, key=lambda r: r.start)
    assert [-1 if r.doc_id is None else r.doc_id for r in by_id] == [i for i, _ in want]
    assert sorted(map(str, ((-1 if r.doc_id is None else r.doc_id, r.token_ids) for r in got))) == sorted(
        str((i, library.encode(t, add_special_tokens=False).ids + [1])) for i, t in want)
    at = 0
    for r in by_id:
        assert (r.start, r.n_tokens) == (at, len(r.token_ids))
        assert digest[at].ids_crc32 == zlib.crc32(np.array(r.token_ids, "<u4").tobytes())
        at += r.n_tokens
    empty = token_file.round_trip(docs.limit(0), tokenizer_path())
    assert empty.count() == 0 and empty.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
