"""Phrase collocations by set-oriented mining (SETM).

The occurrences of words are kept as relations sorted by piece and position
(token blocks, ``blocks.py``). Level by level, the relation of the frequent
phrases of k words is merge-joined with itself at the next position of the same
piece, which gives the phrases of k + 1 words; these are counted by group in the
block and summed over all blocks; occurrences of groups below ``least`` are left
out by a semi-join before the next level. The blocks are written after every
level. Both parts of a frequent phrase are frequent, so a block that holds a
phrase knows every count that its score needs, and the first such block gives
the phrase with its counts as a row; what follows is DataFrame work.

Texts: A-Z lower-cased; ``[.,;:!?\\x0A-\\x0D]`` ends a piece, words are
``[^\\x20\\x09]+``. Null texts are empty, a null language is ``und`` (one
with documents marked so). Repeated rows count each time. An empty table
gives no row. Other columns of the input play no part.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tillroll.llm import blocks
from tillroll.llm.blocks import Builder, each_block, ngram_key, numbered, pack, scan, steps, unpack, with_answers
from tillroll.llm.staging import drop_table, stage
from tillroll.llm.textscan import mix, text_array

# Bytes that end a piece, and all that separate words.
PIECE_END = np.zeros(256, bool)
PIECE_END[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
WORD_BYTE = ~PIECE_END
WORD_BYTE[[0x20, 0x09]] = False

SALTS = 64
# Rows of the staged tables: blocks (part -1), words per language (-2), phrases (-3).
_TABLE = "part int, block long, payload binary, lang string, phrase string, inner array<string>, nums array<long>"
_BLOCK, _LANG, _PHRASE = -1, -2, -3


def _rows(part: int, block: int, payload=None, lang=None, phrase=None, inner=None, nums=None) -> pa.RecordBatch:
    n = len(nums)
    return pa.RecordBatch.from_arrays(
        [pa.array([part] * n, pa.int32()), pa.array([block] * n, pa.int64()), pa.array(payload or [None] * n, pa.binary()),
         pa.array(lang or [None] * n, pa.string()), pa.array(phrase or [None] * n, pa.string()),
         pa.array(inner or [None] * n, pa.list_(pa.string())), pa.array(nums, pa.list_(pa.int64()))],
        names=["part", "block", "payload", "lang", "phrase", "inner", "nums"])


def _occurrences(lead: int):
    """Documents to blocks: level 1, the occurrences of words."""
    def cut(builder, langs):
        got = builder.cut()
        if got is None:
            return
        block, x, words = got
        own = x["ids"][x["lead"][0]:]
        counts = np.bincount(own, minlength=len(x["dict"]))
        names = list(langs)
        used, where = np.unique(x["codes"], return_inverse=True)
        per_lang = np.bincount(x["codes"][own], minlength=len(names))
        offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
        text = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        payload = pack(hash=steps(x["dict"]), counts=counts, gram=x["ids"], piece=steps(x["piece"]).astype(np.int32),
                       lead=x["lead"], code=where.astype(np.int32), size=np.diff(offsets).astype(np.int32), text=text,
                       langs=np.frombuffer(json.dumps([names[k] for k in used]).encode(), np.uint8))
        yield _rows(_BLOCK, block, [payload], nums=[[len(own), len(counts)]])
        some = np.flatnonzero(per_lang)
        yield _rows(_LANG, block, lang=[names[k] for k in some], nums=[[int(per_lang[k])] for k in some])

    def run(batches):
        builder, langs, salts, pieces = Builder(lead, texts=True), {}, [], 0
        for batch in batches:
            marks = batch.column("lang").to_pylist()
            for m in marks:
                if m not in langs:
                    langs[m] = len(langs)
                    salts.append(int.from_bytes(hashlib.blake2b(m.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little"))
            code_of = np.array([langs[m] for m in marks], np.int32)
            salt_of = np.array(salts, np.uint64)
            for first, low, start, end, ends in scan(text_array(batch.column("text")), WORD_BYTE):
                closes = PIECE_END[low]
                closes[ends] = True
                piece = np.cumsum(closes)
                code = code_of[first + np.searchsorted(ends, start)]
                hashes = mix(blocks.word_hashes(low, start, end) ^ salt_of[code])
                builder.add(hashes, pieces + piece[start], code, (low, start, end))
                pieces += int(piece[-1])
                if builder.full():
                    yield from cut(builder, langs)
        yield from cut(builder, langs)
    return run


def _keys(x: dict, k: int) -> np.ndarray:
    """Keys of the block's phrases of k words, from the words' hashes."""
    if k == 1:
        return x["hash"]
    every = np.arange(len(x[f"head{k}"]))
    return ngram_key([x["hash"][_part(x, k, every, i, 1)] for i in range(k)], k)


def _ask(k: int, parts: int):
    def run(batches):
        for batch in batches:
            for block, payload in zip(batch.column("block").to_pylist(), batch.column("payload")):
                x = unpack(payload.as_py())
                x["hash"] = np.cumsum(x["hash"], dtype=np.uint64)
                yield blocks.requests(block, _keys(x, k), x["counts"], parts)
    return run


def _part(x: dict, k: int, gram: np.ndarray, first: int, n: int) -> np.ndarray:
    """The phrases of n words from word ``first`` on of phrases of k words."""
    for level in range(k, n, -1):
        if first:
            gram, first = x[f"tail{level}"][gram], first - 1
        else:
            gram = x[f"head{level}"][gram]
    return gram


def _level(k: int, last: int):
    """Blocks with the counts of their phrases of k words to rows of these
    phrases and, below ``last``, blocks with the phrases of k + 1 words."""
    def run(batches):
        for block, x, total, owner in each_block(batches):
            frequent = total > 0
            x["hash"] = np.cumsum(x["hash"], dtype=np.uint64)
            if k > 1 and (owner & frequent).any():
                yield _phrases(block, x, k, np.flatnonzero(owner & frequent), total)
            if k == last:
                continue
            # Semi-join: only occurrences of frequent phrases stay.
            at = np.cumsum(x["at"], dtype=np.int64) if k > 1 else np.arange(len(x["gram"]))
            stay = frequent[x["gram"]]
            number = np.cumsum(frequent) - 1
            at, gram = at[stay], number[x["gram"][stay]]
            x[f"count{k}"] = total[frequent]
            if k == 1:
                _keep_words(x, frequent)
                piece = np.cumsum(x.pop("piece"), dtype=np.int64)[stay]
                joined = (np.diff(at) == 1) & (np.diff(piece) == 0)
            else:
                x[f"head{k}"], x[f"tail{k}"] = x[f"head{k}"][frequent], x[f"tail{k}"][frequent]
                joined = np.diff(at) == 1       # they share k - 1 words, so they lie in one piece
            # Merge-join with the occurrence at the next position.
            n = int(frequent.sum())
            ids, pairs, _ = numbered(gram[:-1][joined].astype(np.int64) * max(n, 1) + gram[1:][joined])
            at = at[1:][joined]
            x[f"head{k + 1}"], x[f"tail{k + 1}"] = (pairs // max(n, 1)).astype(np.int32), (pairs % max(n, 1)).astype(np.int32)
            every = np.arange(len(pairs))
            counts = np.bincount(ids[at >= x["lead"][0]], minlength=len(pairs))
            order = np.argsort(_keys(x, k + 1))
            place = np.empty(len(order), np.int32)
            place[order] = every
            x[f"head{k + 1}"], x[f"tail{k + 1}"] = x[f"head{k + 1}"][order], x[f"tail{k + 1}"][order]
            x["hash"], x["counts"], x["at"], x["gram"] = steps(x["hash"]), counts[order], steps(at).astype(np.int32), place[ids]
            yield _rows(_BLOCK, block, [pack(**x)], nums=[[len(at), len(pairs)]])
    return run


def _keep_words(x: dict, keep: np.ndarray) -> None:
    bytes_kept = np.repeat(keep, x["size"])
    x["hash"], x["code"], x["size"], x["text"] = x["hash"][keep], x["code"][keep], x["size"][keep], x["text"][bytes_kept]


def _phrases(block: int, x: dict, k: int, mine: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
    ends = np.cumsum(x["size"])
    text, langs = x["text"].tobytes(), json.loads(x["langs"].tobytes())
    words = [_part(x, k, mine, i, 1) for i in range(k)]
    spelled = {int(w): text[ends[w] - x["size"][w]:ends[w]].decode("utf-8", "surrogatepass") for w in np.unique(np.concatenate(words))}
    lines = [[spelled[w] for w in row] for row in np.stack(words, axis=1).tolist()]
    nums = [count[mine]]
    for cut in range(1, k):
        nums += [x[f"count{cut}"][_part(x, k, mine, 0, cut)], x[f"count{k - cut}"][_part(x, k, mine, cut, k - cut)]]
    inner = [[" ".join(line[i:i + n]) for n in range(2, k) for i in range(k - n + 1)] for line in lines]
    return _rows(_PHRASE, block, lang=[langs[c] for c in x["code"][words[0]]], phrase=[" ".join(line) for line in lines],
                 inner=inner, nums=np.stack(nums, axis=1).tolist())


def candidates(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 10,
               most_words: int = 3) -> tuple[DataFrame, DataFrame]:
    """``(phrases, words per language)``: every phrase of 2 to ``most_words``
    words with at least ``least`` occurrences as lang, phrase, ``inner`` (the
    shorter phrases in it) and ``nums`` (its count, then per cut the counts of
    the first part and of the rest)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(text_col).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"))
    level = stage(rows.mapInArrow(_occurrences(most_words - 1), _TABLE), "setm-1")
    langs = level.where(F.col("part") == _LANG).groupBy("lang").agg(F.sum(F.col("nums")[0]).alias("n"))
    langs = stage(langs, "setm-langs")
    found = None
    for k in range(1, most_words + 1):
        own = level.where(F.col("part") == _BLOCK)
        size = own.agg(F.count(F.lit(1)).alias("blocks"), F.sum(F.col("nums")[1]).alias("keys")).first()
        parts = blocks.ranges(size["keys"] or 0)
        answers = blocks.totals(own.select("block", "payload").mapInArrow(_ask(k, parts), "part int, block long, payload binary"),
                                parts, f"setm-counts-{k}", least)
        done = level
        level = stage(with_answers(own, answers, size["blocks"]).mapInArrow(_level(k, most_words), _TABLE), f"setm-{k + 1}")
        drop_table(spark, answers)
        if k == 1:
            drop_table(spark, done)
        new = level.where(F.col("part") == _PHRASE).select("lang", "phrase", "inner", "nums")
        found = new if found is None else found.unionByName(new)
    return found, langs


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 10, most_words: int = 3,
                 top: int = 2000, absorbed: int = 50) -> DataFrame:
    """The ``top`` phrases of every language: lang, rank, phrase, a, l, r, n, score.

    Score: floor(1000000 a a / (l r)) of the lowest cut (first of equal ones),
    in decimals of 38 digits, exact up to a = 10**16. A candidate is dropped if a longer
    one that holds it has at least ``absorbed`` per cent of its count.
    """
    found, langs = candidates(docs, text_col, lang_col, least, most_words)
    longer = (found.select("lang", F.explode(F.array_distinct("inner")).alias("phrase"), F.col("nums")[0].alias("f"))
              .groupBy("lang", "phrase").agg(F.max("f").alias("held")))
    whole = "CAST(nums[0] AS DECIMAL(19,0))"
    cuts = f"""array_min(transform(sequence(1, (size(nums) - 1) div 2), k -> struct(
        (CAST(1000000 AS DECIMAL(7,0)) * ({whole} * {whole})) div
        (CAST(nums[2 * k - 1] AS DECIMAL(19,0)) * CAST(nums[2 * k] AS DECIMAL(19,0))) AS score,
        k, nums[2 * k - 1] AS l, nums[2 * k] AS r)))"""
    a = F.col("nums")[0]
    scored = (found.join(longer, ["lang", "phrase"], "left").where(F.col("held").isNull() | (100 * F.col("held") < absorbed * a))
              .select("lang", "phrase", a.alias("a"), F.expr(cuts).alias("cut"))
              .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First within salts of a language, so one task orders at most SALTS * top rows of it.
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    best = scored.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return (ranked.where(F.col("rank") <= top).join(langs, "lang")
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
