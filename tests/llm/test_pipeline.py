"""The pipeline, stage by stage, against plain Python on the smallest tables."""

import os

import pytest

import corpus_pipeline as cp
from llm.brute import brute_docs, brute_windows
from tillroll.llm import line_crf, mix, token_file
from tillroll.llm.staging import read_table, stage

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="benchmark tables not present")


def test_stages(spark):
    docs = read_table(spark, SF, "documents")
    outs = []
    for name, step in cp.STAGES:
        before = [tuple(r) for r in docs.collect()]
        out = stage(step(spark, docs, SF), name)
        outs.append(([*docs.columns], before, out.columns, [tuple(r) for r in out.collect()], docs))
        docs = out
    for columns, _, after, _, _ in outs[:-1]:
        assert after == columns
    # Quality: exactly the rows that score at least 0.3; labelled clean ones stay.
    _, before, _, rows, table = outs[0]
    scores = line_crf.score(table, line_crf.train(table, read_table(spark, SF, "labels"))).collect()
    assert sorted(r[0] for r in rows) == sorted(r.doc_id for r in scores if r.predicted)
    good = {r.doc_id for r in read_table(spark, SF, "labels").where("quality = 1").collect()}
    assert {r[0] for r in before} & good <= {r[0] for r in rows}
    # Near duplicates: the smallest id of each class.
    _, before, _, rows, _ = outs[1]
    want = [i for i, least, _, _ in brute_docs([(r[0], r[1]) for r in before]) if i == least]
    assert sorted(r[0] for r in rows) == sorted(want)
    # Decontamination: no row with a benchmark window, all others.
    _, before, _, rows, _ = outs[2]
    bench = [(r.item_id, r.text) for r in read_table(spark, SF, "benchmark").collect()]
    clean = [d for d, _, hit, _ in brute_windows([(r[0], r[1]) for r in before], bench) if not hit]
    assert sorted(r[0] for r in rows) == sorted(clean)
    # Mixing: as many copies as the mix takes.
    _, before, _, rows, table = outs[3]
    taken = {r.row.doc_id: r.copies for r in mix.sample(table).collect()}
    assert sorted(r[0] for r in rows) == sorted(i for i, n in taken.items() for _ in range(n))
    # Token output: one row per document in id order, counts of the tokenizer.
    _, before, after, rows, _ = outs[4]
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(cp.tokenizer_path())
    want = sorted((r[0], len(library.encode(r[1] or "", add_special_tokens=False).ids) + 1) for r in before)
    rows = sorted(rows, key=lambda r: r[after.index("start")])
    assert [(r[0], r[after.index("n_tokens")]) for r in rows] == want
    assert [r[after.index("start")] for r in rows] == [sum(n for _, n in want[:k]) for k in range(len(want))]


def test_run_gives_the_last_stage(spark):
    assert cp.run(spark, SF).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert cp.ORACLE_SQL is None and 4 <= len(cp.STAGES) <= 5 and token_file.END_ID == 1
