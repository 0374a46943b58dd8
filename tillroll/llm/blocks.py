"""Token blocks, and corpus-wide totals of what the blocks hold.

A block is a run of about ``TOKENS`` consecutive tokens of a task's texts, with
the distinct tokens' 64-bit hashes in order (``dict``), the tokens as places in
it (``ids``) and the number of the piece that each token lies in (``piece``).
A text may go on in the next block: that block repeats the last ``lead`` tokens,
so every n-gram of up to ``lead`` + 1 tokens that *ends* in a block lies in it.

``totals`` sums counts of 64-bit keys over all blocks: each block sends its
distinct keys once, already counted, in ranges of the key; a task merges one
range of all blocks and answers every block with the totals in the order asked.
A key that is everywhere costs one entry a block, whatever its count. Two
different n-grams share a key with probability 2**-64.
"""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tillroll.llm.grouped import groups
from tillroll.llm.staging import stage
from tillroll.llm.textscan import BYTE_VALUES, LOWER, chunks, mix, powers

TOKENS = 1_000_000
KEYS = 1_500_000     # keys that one range of a merge holds, about
SEGMENT = (1 << 21) - 1  # bytes of text scanned at once
LONG_WORD = 1 << 16  # longer words are hashed by blake2b
_BLOCK = "part int, block long, payload binary"


# --- arrays as bytes ---

def pack(**arrays: np.ndarray) -> bytes:
    """Arrays byte plane by byte plane, compressed."""
    out = {}
    for name, a in arrays.items():
        a = np.ascontiguousarray(a)
        planes = a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() if len(a) else b""
        out[name] = (a.dtype.str, len(a), pa.compress(planes, codec="zstd", asbytes=True) if planes else b"")
    return pickle.dumps(out)


def unpack(data: bytes) -> dict[str, np.ndarray]:
    out = {}
    for name, (dtype, n, packed) in pickle.loads(data).items():
        dt = np.dtype(dtype)
        planes = pa.decompress(packed, n * dt.itemsize, codec="zstd", asbytes=True) if n else b""
        raw = np.frombuffer(planes, np.uint8).reshape(dt.itemsize, n).T
        out[name] = np.ascontiguousarray(raw).view(dt).reshape(n)
    return out


def steps(ordered: np.ndarray) -> np.ndarray:
    """Differences of ordered values: what np.cumsum turns back."""
    return np.diff(ordered, prepend=ordered.dtype.type(0))


def block_rows(part, block, payload) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(block, pa.int64()), pa.array(payload, pa.binary())],
                                      names=["part", "block", "payload"])


# --- texts to tokens ---

def segments(data: np.ndarray, word_byte: np.ndarray, ends: np.ndarray):
    """Yield ``(lo, hi, inside)``: data[lo:hi] cut between words, and which of
    its bytes belong to words. A word longer than a segment comes alone. The
    bytes at ``ends`` close the texts and belong to no word."""
    def word_bytes_of(lo, hi):
        inside = word_byte[data[lo:hi]]
        inside[ends[np.searchsorted(ends, lo):np.searchsorted(ends, hi)] - lo] = False
        return inside

    lo, n = 0, len(data)
    while lo < n:
        hi = min(lo + SEGMENT, n)
        inside = word_bytes_of(lo, hi)
        if hi < n and inside[-1]:
            if inside.all():
                while hi < n:
                    more = word_bytes_of(hi, min(hi + SEGMENT, n))
                    hi += len(more) if more.all() else int(np.argmin(more))
                    if not more.all():
                        break
                inside = np.ones(hi - lo, bool)
            else:
                hi = lo + int(np.flatnonzero(~inside)[-1]) + 1
                inside = inside[:hi - lo]
        yield lo, hi, inside
        lo = hi


def word_hashes(lowered: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of lowered[start:end]; words above LONG_WORD bytes by blake2b."""
    long = np.flatnonzero(end - start > LONG_WORD)
    if len(long) == len(start):
        out = np.zeros(len(start), np.uint64)
    else:
        up, down = powers(len(lowered) + 1)
        sums = np.zeros(len(lowered) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[lowered] * up[:-1], out=sums[1:])
        out = mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    for i in long:
        out[i] = int.from_bytes(hashlib.blake2b(lowered[start[i]:end[i]], digest_size=8).digest(), "little")
    return out


def ngram_key(parts: list[np.ndarray], order: int) -> np.ndarray:
    """Key of the n-grams whose words have these hashes; ``order`` tells lengths apart."""
    out = np.full(len(parts[0]), order * 0x9E3779B97F4A7C15 % 2**64, np.uint64)
    for h in parts:
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + h)
    return out


def numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(number of each value, distinct values, a place of each)``, numbered by first occurrence."""
    coded = pa.array(values).dictionary_encode()
    ids = coded.indices.to_numpy()
    at = np.empty(len(coded.dictionary), np.int64)
    at[ids[::-1]] = np.arange(len(ids) - 1, -1, -1)
    return ids, coded.dictionary.to_numpy(), at


class Builder:
    """Collects the tokens of one task and cuts them into blocks."""

    def __init__(self, lead: int, texts: bool = False):
        self.lead, self.texts, self.blocks = lead, texts, 0
        context = TaskContext.get()
        self.first = (context.partitionId() if context else 0) << 24
        self._start([])

    def _start(self, kept):
        self.parts, self.n, self.n_lead = list(kept), sum(len(p[0]) for p in kept), sum(len(p[0]) for p in kept)

    def add(self, hashes: np.ndarray, piece: np.ndarray, codes: np.ndarray, words: tuple | None = None) -> None:
        """Tokens of a segment; ``codes`` goes with a token's hash (its
        language, say), ``words`` (bytes, starts, ends) spells them, if the block keeps that."""
        if len(hashes):
            ids, u, at = numbered(hashes)
            spelled = word_bytes(words[0], words[1][at], words[2][at]) if self.texts else None
            self.parts.append((ids, piece, u, codes[at], spelled))
            self.n += len(hashes)

    def full(self) -> bool:
        return self.n - self.n_lead >= TOKENS

    def cut(self) -> tuple[int, dict, pa.Array | None] | None:
        """The block's id, arrays and distinct words, or None if no token is new."""
        if self.n == self.n_lead:
            return None
        u, at = np.unique(np.concatenate([p[2] for p in self.parts]), return_index=True)
        ids = np.concatenate([np.searchsorted(u, p[2]).astype(np.int32)[p[0]] for p in self.parts])
        piece = np.concatenate([p[1] for p in self.parts])
        codes = np.concatenate([p[3] for p in self.parts])[at]
        words = pa.concat_arrays([p[4] for p in self.parts]).take(pa.array(at)) if self.texts else None
        arrays = {"dict": u, "ids": ids, "piece": piece - piece[0], "codes": codes, "lead": np.array([self.n_lead]),
                  "base": piece[:1].copy()}
        block, self.blocks = self.first + self.blocks, self.blocks + 1
        k = min(self.lead, len(ids))
        if k:
            last, back = np.unique(ids[-k:], return_inverse=True)
            kept = [(back.astype(np.int32), piece[-k:], u[last], codes[last], words.take(pa.array(last)) if self.texts else None)]
        self._start(kept if k else [])
        return block, arrays, words


def word_bytes(lowered: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """lowered[start:end] of every word as an Arrow array."""
    size = end - start
    off = np.zeros(len(start) + 1, np.int64)
    np.cumsum(size, out=off[1:])
    take = np.repeat(start - off[:-1], size) + np.arange(off[-1])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(off), pa.py_buffer(lowered[take])])


def scan(texts: pa.LargeBinaryArray, word_byte: np.ndarray):
    """Yield ``(first, lowered, start, end, ends)`` over segments of texts:
    lower-cased bytes, its words' bounds, and where texts end in it (the text
    that ends at ends[k] is number first + k of the array)."""
    for first, _, data, off in chunks(texts, SEGMENT):
        ends = off[1:] - 1
        for lo, hi, inside in segments(data, word_byte, ends):
            edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
            a, b = np.searchsorted(ends, lo), np.searchsorted(ends, hi)
            yield first + int(a), LOWER[data[lo:hi]], np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), ends[a:b] - lo


# --- totals over all blocks ---

def requests(block: int, keys: np.ndarray, counts: np.ndarray, parts: int):
    """One row per range of keys: ordered distinct ``keys`` and their counts."""
    edges = np.array([k * 2**64 // parts for k in range(1, parts)], np.uint64)
    cut = np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])
    some = np.flatnonzero(np.diff(cut))
    return block_rows(some.astype(np.int32), np.full(len(some), block),
                      [pack(keys=steps(keys[cut[p]:cut[p + 1]]), counts=counts[cut[p]:cut[p + 1]].astype(np.uint32)) for p in some])


def _merge(least: int):
    def run(batches):
        for table, bounds in groups(batches, 1):
            for a, b in zip(bounds[:-1], bounds[1:]):
                asked = [unpack(table.column("payload")[i].as_py()) for i in range(a, b)]
                keys = [np.cumsum(x["keys"], dtype=np.uint64) for x in asked]
                every = np.concatenate(keys)
                order = np.argsort(every, kind="stable")
                ordered = every[order]
                new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
                group = np.cumsum(new) - 1
                total = np.add.reduceat(np.concatenate([x["counts"] for x in asked])[order].astype(np.int64), np.flatnonzero(new))
                total[total < least] = 0
                answer, owner = np.zeros(len(every), np.int64), np.zeros(len(every), np.uint8)
                answer[order], owner[order[new]] = total[group], 1   # stable: the first block that asks owns the key
                ends = np.cumsum([len(k) for k in keys])
                single = np.add.reduceat(owner & (answer > 0) & (every & np.uint64(1)).astype(bool), ends - [len(k) for k in keys], dtype=np.int64)
                rows = block_rows(np.full(b - a, table.column("part")[a].as_py()), table.column("block").to_numpy()[a:b],
                                  [pack(total=answer[e - len(k):e], owner=np.packbits(owner[e - len(k):e]),
                                        n=np.array([len(k)])) for e, k in zip(ends, keys)])
                yield rows.append_column("singles", pa.array(single))
    return run


def totals(asked: DataFrame, parts: int, name: str, least: int = 1) -> DataFrame:
    """Answers to the blocks' ``requests`` (totals below ``least`` as 0),
    staged; ``singles`` counts the odd keys in use, each at its first block."""
    by_range = asked.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "block")
    return stage(by_range.mapInArrow(_merge(least), _BLOCK + ", singles long"), name)


def ranges(keys: int) -> int:
    """Ranges for that many keys, counted once per block that sends them."""
    return max(1, -(-keys // KEYS))


def with_answers(blocks: DataFrame, answers: DataFrame, n_blocks: int) -> DataFrame:
    """Blocks and their answers, together in one task and in order (read them with ``each_block``)."""
    own = blocks.select(F.lit(-1).alias("part"), "block", "payload")
    return (own.unionByName(answers.drop("singles")).select("block", "part", "payload")
            .repartition(max(1, 2 * n_blocks), "block").sortWithinPartitions("block", "part"))


def each_block(batches):
    """Yield ``(block, arrays, total, owner)``: what a block's rows hold, and
    the totals and ownership of its keys in their order."""
    for table, bounds in groups(batches, 1):
        payload = table.column("payload")
        for a, b in zip(bounds[:-1], bounds[1:]):
            answers = [unpack(payload[i].as_py()) for i in range(a + 1, b)]
            total = np.concatenate([x["total"] for x in answers] or [np.zeros(0, np.int64)])
            owner = np.concatenate([np.unpackbits(x["owner"])[:x["n"][0]] for x in answers] or [np.zeros(0, np.uint8)])
            yield table.column("block")[a].as_py(), unpack(payload[a].as_py()), total, owner.astype(bool)
