"""Byte-pair encoding of many pieces at once, for tokenizers-library files of
the kind of word_bpe_49k.json: NFC, white space to a blank, lower case; pieces
of letters, single numbers, other characters and English contractions; then
byte-level merges whose last symbol carries the end-of-word suffix.

``compile_file`` reads the vocabulary once on the driver and refuses a file
whose settings differ, so nothing is silently counted by other rules. Merges
run in rounds over flat arrays: each round joins, in every piece, all places
of its best-ranked pair. That equals merging one at a time because a pair that
holds a merged symbol always ranks after the merge that made it (checked).
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np

from tillroll.llm import textscan as ts

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
# White space of the file's normalizer pattern (Unicode White_Space).
SPACES = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# The file's pattern for pieces.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NONE = np.int32(2**31 - 1)


def char_classes() -> np.ndarray:
    """Class of every code point."""
    kind = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    out[SPACES] = SPACE
    return out


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shifted = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(shifted)) for b in range(256)]


class Vocabulary:
    """Compiled tables: byte ids, the pair hash table, classes, special tokens."""

    def __init__(self, spec: dict):
        model, names = spec["model"], [n["type"] for n in spec["normalizer"]["normalizers"]]
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        if (names != ["NFC", "Replace", "Lowercase"] or split["pattern"].get("Regex") != PATTERN
                or model["type"] != "BPE" or model.get("dropout") or model.get("byte_fallback")
                or model.get("ignore_merges")):
            raise ValueError("the tokenizer file has other rules than those compiled here")
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        self.size = max(vocab.values()) + 1
        if any(CUT.search(t["content"]) for t in spec["added_tokens"]):
            raise ValueError("a special token holds a place where texts are cut")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max(self.size, *(i + 1 for i in self.special.values())) if self.special else self.size
        self.inner = np.array([vocab[c] for c in byte_symbols()], np.int32)
        self.final = np.array([vocab[c + suffix] for c in byte_symbols()], np.int32)
        self.classes = char_classes()
        made: dict[int, int] = {}
        pairs, results = [], []
        for rank, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, (list, tuple)) else merge.split(" ")
            out = vocab[a + b]
            made[out] = rank
            pairs.append(vocab[a] << 20 | vocab[b])
            results.append(out)
        for rank, pair in enumerate(pairs):
            if max(made.get(pair >> 20, -1), made.get(pair & 0xFFFFF, -1)) >= rank:
                raise ValueError("merges are not in an order that allows joining in rounds")
        self._table(np.array(pairs, np.int64), np.array(results, np.int32))

    def _table(self, pairs: np.ndarray, results: np.ndarray) -> None:
        bits = max(8, int(len(pairs) * 8 - 1).bit_length())
        self.shift = np.uint64(64 - bits)
        self.keys = np.full((1 << bits) + 64, -1, np.int64)
        self.ranks = np.full(len(self.keys), NONE, np.int32)
        self.results = results
        slots = self._slot(pairs)
        for rank in range(len(pairs)):
            at = int(slots[rank])
            while self.keys[at] >= 0:
                at += 1
            self.keys[at], self.ranks[at] = pairs[rank], rank
        used = self.keys >= 0
        run = longest = 0
        for u in used.tolist():
            run = run + 1 if u else 0
            longest = max(longest, run)
        self.probes = longest + 1

    def _slot(self, pairs: np.ndarray) -> np.ndarray:
        return (pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, NONE where there is none."""
        pairs = left.astype(np.int64) << 20 | right
        slot = self._slot(pairs)
        found = self.keys[slot]
        out = np.where(found == pairs, self.ranks[slot], NONE)
        open_ = np.flatnonzero((found != pairs) & (found >= 0))
        for _ in range(self.probes):
            if not len(open_):
                break
            slot[open_] += 1
            found = self.keys[slot[open_]]
            hit = found == pairs[open_]
            out[open_[hit]] = self.ranks[slot[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out

    def normal(self, text: str) -> str:
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            text = text.replace("Σ", "σ")  # each capital sigma by itself, never as a final one
        return text.lower()

    def segments(self, text: str) -> list[tuple[str | None, int]]:
        """Cut at special tokens, which the library finds in the raw text:
        (normalized text, -1) or (None, id)."""
        if not any(s in text for s in self.special):
            return [(self.normal(text), -1)]
        cut = re.split("(" + "|".join(sorted(map(re.escape, self.special), key=len, reverse=True)) + ")", text)
        return [(None, self.special[c]) if c in self.special else (self.normal(c), -1) for c in cut if c]

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of pieces given as concatenated symbols: (ids, counts)."""
        n = len(lengths)
        counts = np.ones(n, np.int64)
        piece = np.arange(n)
        done_ids, done_piece, done_len = [], [], []
        while len(piece):
            ends = np.cumsum(lengths)
            starts = ends - lengths
            ranks = np.full(len(symbols), NONE, np.int32)
            if len(symbols) > 1:
                ranks[:-1] = self.rank(symbols[:-1], symbols[1:])
            ranks[ends - 1] = NONE
            best = np.minimum.reduceat(ranks, starts)
            finished = best == NONE
            if finished.any():
                keep = np.repeat(~finished, lengths)
                done_ids.append(symbols[~keep])
                done_piece.append(piece[finished])
                done_len.append(lengths[finished])
                symbols, ranks = symbols[keep], ranks[keep]
                piece, lengths, best = piece[~finished], lengths[~finished], best[~finished]
                if not len(piece):
                    break
                ends = np.cumsum(lengths)
                starts = ends - lengths
            at = ranks == np.repeat(best, lengths)
            # Of overlapping places (a a a) every second one, from the left.
            where = np.flatnonzero(at)
            fresh = np.ones(len(where), bool)
            fresh[1:] = where[1:] != where[:-1] + 1
            run_start = np.maximum.accumulate(np.where(fresh, np.arange(len(where)), 0))
            where = where[(np.arange(len(where)) - run_start) % 2 == 0]
            symbols[where] = self.results[ranks[where]]
            keep = np.ones(len(symbols), bool)
            keep[where + 1] = False
            gone = np.bincount(np.searchsorted(ends, where, "right"), minlength=len(piece))
            symbols = symbols[keep]
            lengths = lengths - gone
        if not done_piece:
            return np.zeros(0, np.int32), np.zeros(n, np.int64)
        order_piece, order_len = np.concatenate(done_piece), np.concatenate(done_len)
        counts[order_piece] = order_len
        return spread(np.concatenate(done_ids), order_len, order_piece, counts), counts

    def encode_pieces(self, codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and counts of pieces given as ranges of code points."""
        lengths = end - start
        flat = codes[ragged(start, lengths)]
        utf8 = np.frombuffer(flat.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
                             .encode("utf-8", "surrogatepass"), np.uint8)
        width = 1 + (flat > 0x7F).astype(np.int64) + (flat > 0x7FF) + (flat > 0xFFFF)
        sizes = np.add.reduceat(width, np.cumsum(lengths) - lengths) if len(lengths) else lengths
        symbols = self.inner[utf8]
        last = np.cumsum(sizes) - 1
        symbols[last] = self.final[utf8[last]]
        return self.merge(symbols, sizes)


def ragged(start: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start[0].. (lengths[0] of them), start[1].., and so on."""
    shift = start - (np.cumsum(lengths) - lengths)
    return np.repeat(shift, lengths) + np.arange(int(lengths.sum()))


def spread(values: np.ndarray, lengths: np.ndarray, order: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenated runs of ``values`` put into the order 0, 1, 2, ... of their numbers."""
    first = np.cumsum(lengths) - lengths
    by_number = np.empty(len(counts), np.int64)
    by_number[order] = first
    return values[ragged(by_number, counts)]


def compile_file(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as f:
        return Vocabulary(json.load(f))


CODE_VALUES = ts.mix(np.arange(1, 0x110001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Codes:
    """Some texts as one array of normalized code points, a blank after each."""

    def __init__(self, texts: list[str], vocabulary: Vocabulary):
        parts, doc, self.special = [], [], []
        for d, text in enumerate(texts):
            for normal, token in vocabulary.segments(text):
                if normal is None:
                    self.special.append((len(parts), token))
                parts.append(normal or "")
                doc.append(d)
        joined = "\n".join(parts) + "\n"
        self.codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.bounds = np.cumsum([0] + [len(p) + 1 for p in parts])  # of segments
        self.doc = np.array(doc, np.int64)
        self.n_texts = len(texts)
        self.classes = vocabulary.classes[self.codes]

    def piece_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        prefix = np.zeros(len(self.codes) + 1, np.uint64)
        np.cumsum(CODE_VALUES[self.codes] * ts.powers(len(self.codes))[0], out=prefix[1:])
        return ts.range_hash(prefix, start, end)


# A long text may be cut before a blank or line feed, and between a full-width
# mark and a letter or number: no piece, no special token and no composition of
# characters goes over such a place.
CUT = re.compile(r"[ \n]|(?<=[\u3001\u3002\uff01\uff0c\uff1a\uff1b\uff1f])(?=[^\W_])")
SEGMENT = 1 << 20  # characters


def text_segments(text: str):
    """Runs of a long text, each of about ``SEGMENT`` characters (more only where
    there is no place to cut), whose tokens one after the other are the text's."""
    lo = 0
    while len(text) - lo > SEGMENT:
        place = CUT.search(text, lo + SEGMENT)
        hi = place.start() if place else len(text)
        yield text[lo:hi]
        lo = hi
    if lo < len(text) or not lo:
        yield text[lo:]


def pieces(codes: Codes) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the pieces of all texts."""
    kind, c = codes.classes, codes.codes
    new = np.empty(len(kind), bool)
    new[0] = True
    new[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
    # A lone apostrophe takes s, t, m, d, re, ve or ll from the letters after it.
    lone = np.flatnonzero((c[:-3] == 39) & new[:-3] & (kind[1:-2] == LETTER)) if len(c) > 3 else np.zeros(0, int)
    one, two = c[lone + 1], c[lone + 2] if len(lone) else c[:0]
    short = np.isin(one, [115, 116, 109, 100])
    long_ = ((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)
    taken = lone + np.where(short, 2, 3)
    new[lone[short | long_] + 1] = False
    taken = taken[short | long_]
    new[taken] = True
    start = np.flatnonzero(new)
    end = np.append(start[1:], len(kind))
    keep = kind[start] != SPACE
    return start[keep], end[keep]
