"""Language-model scores by a weighted backoff automaton.

The n-grams of the training texts, up to ``order`` tokens, are counted over the
whole corpus (``blocks.totals``: every block sends its distinct n-grams and gets
their totals back, so no model is ever gathered in one place). For the texts of
a block they make an automaton. States are the contexts seen in training; an arc
carries the log-probability of a token seen after its context and leads to the
longest context that then is known. Where a state has no arc for a token, its
failure arc leads, at the price of its backoff weight, to the context without
its first token, at last to the empty one, which takes every token. One
traversal from left to right carries the state and adds up the weights. Texts
are cut into lanes that run side by side; a lane first reads the ``order`` - 1
tokens before its own, after which its state is that of the whole text's run.

Probabilities: the empty context has p(w) = (c + 0.1) / (N + 0.1 (V + 1)); a
context h of total c(h) has p(w | h) = (c(hw) + m p(w | h')) / (c(h) + m), h' being
h without its first token and m the strength for its length (``STRENGTH``): this sums to 1
over the V known tokens and an unknown one. Two n-grams share their counts if
the first 56 bits of their hashes are equal.

Tokens: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, then one end. A null text
is empty (one token), a null id counts as the empty text in the fold's hash and
is held out. Repeated ids are scored row by row and are in the same fold. With
no training row, N = V = 0 and every token is unknown. An empty table gives no row.
Other columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tillroll.llm import blocks
from tillroll.llm.blocks import Builder, each_block, numbered, pack, scan, unpack, with_answers
from tillroll.llm.staging import drop_table, stage
from tillroll.llm.textscan import mix, text_array

ORDER = 3
STRENGTH = {2: 1000.0, 3: 2.0}    # m by the n-gram's length (longer ones: as 3)
ADD = 0.1                        # fixed value of the base
LANE = 256                       # tokens of a lane
WORD_BYTE = np.ones(256, bool)
WORD_BYTE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
END = np.uint64(0x5BD1E9955BD1E995)   # hash of the end token
_TABLE = "part int, block long, payload binary, n_keys long, train_tokens long"
_SCORES = ("uid long, whole boolean, doc_id long, held_out boolean, n_tokens long, n_known long, "
           "base_score double, score double")


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def _tokens(order: int):
    """Documents to token blocks; a token's piece is its text."""
    def cut(builder, rows):
        got = builder.cut()
        if got is None:
            return
        block, x, _ = got
        base, lead = int(x["base"][0]), int(x["lead"][0])
        last = base + int(x["piece"][-1])
        while rows and rows[0][0] < base:
            rows.pop(0)
        mine = [r for chunk in rows for r in _clip(chunk, base, last)]
        ids = np.concatenate([r[0] for r in mine])
        held = np.concatenate([r[1] for r in mine])
        null = np.concatenate([r[2] for r in mine])
        train = ~held[x["piece"]]
        starts = not lead or x["piece"][lead - 1] != x["piece"][lead]   # the first own token starts a text
        ends = x["dict"][x["ids"][-1]] == END
        grams = len(x["dict"]) + (order - 1) * len(x["ids"])     # at most
        payload = pack(dict=x["dict"], ids=x["ids"], piece=x["piece"].astype(np.int32), lead=x["lead"], doc=ids, held=held,
                       null=null, uid=np.array([(builder.first << 20) + base]), edge=np.array([starts, ends]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1], pa.int32()), pa.array([block]), pa.array([payload], pa.binary()), pa.array([grams]),
             pa.array([int(train[lead:].sum())])], names=["part", "block", "payload", "n_keys", "train_tokens"])

    def run(batches):
        builder, rows, texts = Builder(max(1, order - 1)), [], 0
        for batch in batches:
            ids = batch.column("doc_id")
            rows.append((texts + batch.num_rows - 1, texts, ids.fill_null(0).to_numpy(zero_copy_only=False),
                         batch.column("held_out").to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False)))
            for first, low, start, end, ends in scan(text_array(batch.column("text")), WORD_BYTE):
                at = np.concatenate([start, ends])
                order_of = np.argsort(at, kind="stable")
                hashes = np.concatenate([blocks.word_hashes(low, start, end), np.full(len(ends), END)])[order_of]
                piece = texts + first + np.searchsorted(ends, at[order_of])
                builder.add(hashes, piece, np.zeros(len(at), np.uint8))
                if builder.full():
                    yield from cut(builder, rows)
            texts += batch.num_rows
        yield from cut(builder, rows)
    return run


def _clip(chunk, base, last):
    stop, start, ids, held, null = chunk
    a, b = max(base, start) - start, min(last, stop) + 1 - start
    if a < b:
        yield ids[a:b], held[a:b], null[a:b]


def _grams(x: dict, order: int) -> list[dict]:
    """The block's distinct n-grams by length: ``at`` each token the one that
    ends there (-1: none), their first n - 1 tokens and last n - 1 tokens as
    n-grams of the length before, keys, and counts of own training tokens."""
    ids, piece = x["ids"].astype(np.int64), x["piece"]
    own = np.arange(len(ids)) >= x["lead"][0]
    learn = own & ~x["held"][piece]
    m = len(x["dict"])
    raw = mix(x["dict"] + np.uint64(0x632BE59BD9B4E019))
    levels = [{"at": ids, "raw": raw, "count": np.bincount(ids[learn], minlength=m)}]
    for n in range(2, order + 1):
        low = levels[-1]
        pos = np.flatnonzero(piece[n - 1:] == piece[:-(n - 1)]) + n - 1
        number, codes, first = numbered(low["at"][pos - 1] * m + ids[pos])
        at = np.full(len(ids), -1, np.int64)
        at[pos] = number
        head = codes // m
        levels.append({"at": at, "head": head, "tail": low["at"][pos[first]],
                       "raw": mix(low["raw"][head] * np.uint64(0xD6E8FEB86659FD93) + x["dict"][codes % m]),
                       "count": np.bincount(number[learn[pos]], minlength=len(codes))})
    return levels


def _keys(levels: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all lengths (the hashes' first 56 bits) and their order; the
    last bit marks single tokens."""
    cut = ~np.uint64(0xFF)
    keys = np.concatenate([levels[0]["raw"] & cut | np.uint64(1)] + [v["raw"] & cut for v in levels[1:]])
    return keys, np.argsort(keys)


def _ask(order: int, parts: int):
    def run(batches):
        for batch in batches:
            for block, payload in zip(batch.column("block").to_pylist(), batch.column("payload")):
                levels = _grams(unpack(payload.as_py()), order)
                keys, by = _keys(levels)
                yield blocks.requests(block, keys[by], np.concatenate([v["count"] for v in levels])[by], parts)
    return run


def _traverse(levels: list[dict], x: dict, n_train: int, n_known: int) -> tuple[np.ndarray, np.ndarray]:
    """Log-probability and base log-probability (log10) of every own token."""
    order, ids, piece, lead = len(levels), x["ids"], x["piece"], int(x["lead"][0])
    p = (levels[0]["count"] + ADD) / (n_train + ADD * (n_known + 1))
    base = np.log10(p)
    # Arcs: weights of the n-grams seen in training; backoff: of the contexts.
    arc, backoff, seen = [base], [], [levels[0]["count"] > 0]
    for n in range(2, order + 1):
        low, v = levels[n - 2], levels[n - 1]
        m = STRENGTH[min(n, 3)]
        p = (v["count"] + m * p[v["tail"]]) / (low["count"][v["head"]] + m)
        arc.append(np.log10(p))
        seen.append(v["count"] > 0)
        backoff.append(np.log10(m / (low["count"] + m)))
    # Lanes of own tokens of one text, and the tokens they read before.
    own = np.arange(lead, len(ids))
    opens = np.concatenate([[True], piece[own[1:]] != piece[own[:-1]]])
    place = own - own[opens][np.cumsum(opens) - 1]
    start = own[place % LANE == 0]
    stop = np.append(start[1:], len(ids))
    text_start = np.searchsorted(piece, piece[start])
    warm = np.maximum(text_start, start - (order - 1))
    by = np.argsort(warm - stop, kind="stable")           # longest lane first
    start, stop, warm = start[by], stop[by], warm[by]
    out = np.zeros(len(ids))
    length = np.zeros(len(start), np.int64)               # of the context that the state stands for
    ends = stop - warm
    for t in range(int(ends.max()) if len(ends) else 0):
        k = int(np.searchsorted(-ends, -t))               # lanes that still have a token
        pos, have = warm[:k] + t, length[:k].copy()
        weight = np.zeros(k)
        open_ = np.ones(k, bool)
        for n in range(order, 0, -1):
            # Lanes whose state is a context of n - 1 tokens: follow the arc if there is one.
            at = np.flatnonzero(open_ & (have == n - 1))
            if not len(at):
                continue
            gram = levels[n - 1]["at"][pos[at]]
            takes = seen[n - 1][gram] if n > 1 else np.ones(len(at), bool)
            hit = at[takes]
            weight[hit] += arc[n - 1][gram[takes]]
            open_[hit] = False
            length[hit] = np.where(seen[n - 1][gram[takes]], min(n, order - 1), 0)
            if n > 1:
                miss = at[~takes]                          # failure arc
                weight[miss] += backoff[n - 2][levels[n - 2]["at"][pos[miss] - 1]]
                have[miss] = n - 2
        mine = pos >= start[:k]
        out[pos[mine]] = weight[mine]
    return out[lead:], base[ids[lead:]]


def _score(order: int, n_train: int, n_known: int):
    def run(batches):
        for _, x, total, _ in each_block(batches):
            levels = _grams(x, order)
            keys, by = _keys(levels)
            counts = np.empty(len(keys), np.int64)
            counts[by] = total
            done = 0
            for v in levels:
                v["count"] = counts[done:done + len(v["raw"])]
                done += len(v["raw"])
            score, base = _traverse(levels, x, n_train, n_known)
            lead = int(x["lead"][0])
            piece = x["piece"][lead:]
            opens = np.flatnonzero(np.concatenate([[True], piece[1:] != piece[:-1]]))
            docs = piece[opens]
            known = (levels[0]["count"] > 0)[x["ids"][lead:]].astype(np.int64)
            whole = np.ones(len(docs), bool)
            whole[0] &= bool(x["edge"][0])
            whole[-1] &= bool(x["edge"][1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(x["uid"][0] + docs.astype(np.int64)), pa.array(whole), pa.array(x["doc"][docs], mask=x["null"][docs]),
                 pa.array(x["held"][docs]), pa.array(np.diff(np.append(opens, len(piece)))), pa.array(np.add.reduceat(known, opens)),
                 pa.array(np.add.reduceat(base, opens)), pa.array(np.add.reduceat(score, opens))],
                names=["uid", "whole", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])
    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """Train on the rows that are not held out and score every row: id,
    held_out, n_tokens, n_known, train_tokens, base_score, score."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), held_out(F.col(id_col)).alias("held_out"))
    own = stage(rows.mapInArrow(_tokens(order), _TABLE), "lm-blocks")
    size = own.agg(F.count(F.lit(1)).alias("blocks"), F.sum("n_keys").alias("keys"), F.sum("train_tokens").alias("train")).first()
    parts = blocks.ranges(size["keys"] or 0)
    answers = blocks.totals(own.mapInArrow(_ask(order, parts), "part int, block long, payload binary"), parts, "lm-counts")
    n_known = answers.agg(F.sum("singles").alias("n")).first()["n"] or 0
    scored = stage(with_answers(own, answers, size["blocks"]).mapInArrow(_score(order, size["train"] or 0, n_known), _SCORES), "lm-scores")
    drop_table(docs.sparkSession, answers)
    whole = scored.where("whole")
    # Texts that lie in several blocks.
    parted = scored.where("NOT whole").groupBy("uid", "doc_id", "held_out").agg(
        *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
    columns = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]
    return (whole.select(*columns).unionByName(parted.select(*columns))
            .select(F.col("doc_id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(size["train"] or 0).cast("long").alias("train_tokens"),
                    "base_score", "score"))
