"""Numpy scans over Arrow text columns, used inside Spark's Python workers.

A batch is cut into chunks of about ``CHUNK`` bytes (never inside a text). A text
above ``SEGMENT`` bytes comes alone (``is_long``); its scans go over it segment by
segment (``word_stream``), with the same results, so the memory of a scan is a
fixed amount beside the text itself and what is asked of it.
All hashes are 64-bit polynomial sums modulo 2**64 over random byte values.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 19
SEGMENT = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 5  # odd, 5 mod 8: powers repeat only after 2**62
_MASK = (1 << 64) - 1
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse."""
    if not _powers or len(_powers[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        steps = np.ones((2, size), np.uint64)
        steps[0, 1:], steps[1, 1:] = _BASE & _MASK, pow(_BASE, -1, 1 << 64)
        _powers[:] = np.cumprod(steps, axis=1, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64 output bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def text_array(column: pa.Array) -> pa.LargeBinaryArray:
    """A text column as UTF-8 bytes, null as the empty text."""
    return pc.fill_null(column.cast(pa.large_binary()), b"")


def chunks(texts: pa.LargeBinaryArray, limit: int = CHUNK):
    """Yield ``(first, stop, bytes, offsets)``: rows [first, stop) and their text
    as one byte array with ``stop - first + 1`` offsets. A zero byte follows
    every text, so nothing runs from one text into the next."""
    joined = pc.binary_join_element_wise(texts, pa.scalar(b"", pa.large_binary()),
                                         pa.scalar(b"\x00", pa.large_binary()))
    n = len(joined)
    if not n:
        return
    off = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset:joined.offset + n + 1]
    data = np.frombuffer(joined.buffers()[2] or b"", np.uint8)
    first = 0
    while first < n:
        stop = int(np.searchsorted(off, off[first] + limit, "right")) - 1
        stop = min(n, max(first + 1, stop))
        yield first, stop, data[off[first]:off[stop]], off[first:stop + 1] - off[first]
        first = stop


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """H with H[j] - H[i] = hash of data[i:j] times base**i (see range_hash)."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * powers(len(data))[0], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for arrays of bounds; equal for equal bytes."""
    inverse = powers(len(prefix))[1]
    return mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(np.uint64))


# Bytes of words after lower-casing A-Z: digits, a-z and all non-ASCII bytes.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[48:58] = WORD_BYTE[97:123] = WORD_BYTE[65:91] = WORD_BYTE[128:] = True


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every maximal run of word bytes."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = WORD_BYTE[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(start, end, hash, first)`` of the lower-cased words of a chunk;
    ``first[d]`` is the number of words before text ``d``."""
    start, end = word_bounds(data)
    hashes = range_hash(prefix_hash(LOWER[data]), start, end)
    return start, end, hashes, np.searchsorted(start, offsets)


def is_long(offsets: np.ndarray) -> bool:
    """Whether a chunk is one text to be scanned segment by segment."""
    return len(offsets) == 2 and offsets[1] - offsets[0] > SEGMENT


def word_stream(data: np.ndarray):
    """Yield ``(start, end, hash)`` as ``words`` gives them for one long text, for
    the words that end in each segment. A word that goes on into the next
    segment, however long, is carried as its start and its hash sum."""
    opened, held = None, np.uint64(0)
    for lo in range(0, len(data), SEGMENT):
        part = LOWER[data[lo:lo + SEGMENT]]
        start, end = word_bounds(part)
        prefix = prefix_hash(part)
        sums = (prefix[end] - prefix[start]) * powers(len(prefix))[1][start]
        start, end = start + lo, end + lo
        if opened is not None:
            if len(start) and start[0] == lo:
                sums[:1] = sums[:1] * np.uint64(pow(_BASE & _MASK, int(lo - opened), 1 << 64)) + held
                start[0] = opened
            else:
                start, end, sums = np.r_[opened, start], np.r_[lo, end], np.r_[held, sums]
            opened = None
        if len(end) and end[-1] == lo + len(part) < len(data):
            opened, held = start[-1], sums[-1]
            start, end, sums = start[:-1], end[:-1], sums[:-1]
        yield start, end, mix(sums + (end - start).astype(np.uint64))


def ngram_hash(hashes: np.ndarray, n: int) -> np.ndarray:
    """Order-dependent hash of every run of ``n`` word hashes (length - n + 1)."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    factor = 1
    for j in range(n):
        factor = factor * 0xD6E8FEB86659FD93 & _MASK
        out += hashes[j:j + m] * np.uint64(factor)
    return mix(out)


def segment_ids(first: np.ndarray) -> np.ndarray:
    """Text number of every item, from the ``first`` bounds."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))
