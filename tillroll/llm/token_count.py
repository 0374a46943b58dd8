"""Token counts by a compiled finite-state tokenizer.

The rules that cut a text into pieces are compiled into a deterministic
transducer over character classes: nine states, and every transition says
whether a piece begins at this character or began at the one before. A text
array is cut into chunks of ``STEPS`` characters; each chunk's map from every
entry state to its exit state is computed, the maps are composed by a parallel
prefix scan, and a second sweep, now with known entry states, writes the
transitions' output. The second transducer spells a piece and emits, with its
last transition, the piece's number of tokens: its paths are the distinct
pieces of a block of text, compiled from the vocabulary's merges (bpe.py), and
looked up by a 64-bit path hash. A text's count is the sum of what its
transitions emit, special tokens emit one.

Texts are handled in blocks of about ``BLOCK`` bytes. A longer text is counted
segment by segment (``bpe.text_segments``), between which no token can lie.
Defined results: null and empty texts have 0 tokens; repeated rows are
counted one by one; only the id and result columns are returned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from tillroll.llm import bpe
from tillroll.llm.staging import share

STEPS = 128
BLOCK = 4 << 20
LIMIT = 2048

# States: between pieces, letters, number, others, lone apostrophe, apostrophe
# with r, v or l still to be decided, finished contraction.
GAP, LETTERS, NUM, OTHERS, QUOTE, QUOTE_R, QUOTE_V, QUOTE_L, SHORT = range(9)
# Input classes: blank, other letter, number, other, apostrophe, s/t/m/d, r, v, l, e.
BLANK, X, N, O, Q, S1, R, V, L, E = range(10)
BEGINS, BEGAN = 16, 32  # output bits beside the next state


def transitions() -> np.ndarray:
    """table[state * 16 + class] = next state, with output bits."""
    letters = {X, S1, R, V, L, E}
    table = np.zeros(9 * 16, np.uint8)
    for state in range(9):
        for cls in range(10):
            late = 0
            came_from = state
            if state in (QUOTE_R, QUOTE_V, QUOTE_L):
                if cls == (L if state == QUOTE_L else E):
                    table[state * 16 + cls] = SHORT
                    continue
                late, came_from = BEGAN, LETTERS  # no contraction: the letter before began a piece
            if cls == BLANK:
                step = GAP
            elif cls in letters:
                if came_from == QUOTE:
                    step = {S1: SHORT, R: QUOTE_R, V: QUOTE_V, L: QUOTE_L}.get(cls, LETTERS | BEGINS)
                else:
                    step = LETTERS | (0 if came_from == LETTERS else BEGINS)
            elif cls == N:
                step = NUM | BEGINS
            elif came_from in (OTHERS, QUOTE):
                step = OTHERS
            else:
                step = (QUOTE if cls == Q else OTHERS) | BEGINS
            table[state * 16 + cls] = step | late
    return table


def input_classes(codes: bpe.Codes) -> np.ndarray:
    out = np.array([BLANK, X, N, O], np.uint8)[codes.classes]
    small = np.full(128, 255, np.uint8)
    small[[39, *map(ord, "stmdrvle")]] = [Q, S1, S1, S1, S1, R, V, L, E]
    plain = np.flatnonzero(codes.codes < 128)
    special = small[codes.codes[plain]]
    out[plain[special < 255]] = special[special < 255]
    return out


def scan(classes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Next state and output bits of every character, entering at GAP."""
    n = len(classes)
    chunks = -(-n // STEPS)
    grid = np.zeros(chunks * STEPS, np.uint8)
    grid[:n] = classes
    grid = np.ascontiguousarray(grid.reshape(chunks, STEPS).T)
    maps = np.repeat(np.arange(9, dtype=np.uint8)[:, None], chunks, axis=1)
    for row in grid:
        maps = table[(maps << 4) + row] & 15
    # Composition of all earlier chunks' maps, by doubling.
    reach = 1
    while reach < chunks:
        maps[:, reach:] = np.take_along_axis(maps[:, reach:], maps[:, :-reach].copy(), axis=0)
        reach *= 2
    state = np.concatenate([[GAP], maps[GAP, :-1]]).astype(np.uint8)
    out = np.empty_like(grid)
    for k, row in enumerate(grid):
        out[k] = table[(state << 4) + row]
        state = out[k] & 15
    return out.T.reshape(-1)[:n]


def piece_bounds(codes: bpe.Codes, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    out = scan(input_classes(codes), table)
    begins = (out & BEGINS) > 0
    begins[:-1] |= (out[1:] & BEGAN) > 0
    blank = codes.classes == bpe.SPACE
    marks = np.flatnonzero(begins | blank)
    ends = np.append(marks[1:], len(blank))
    real = ~blank[marks]
    return marks[real], ends[real]


def count_texts(texts: list[str], vocabulary: bpe.Vocabulary, table: np.ndarray) -> np.ndarray:
    if not texts:
        return np.zeros(0, np.int64)
    codes = bpe.Codes(texts, vocabulary)
    start, end = piece_bounds(codes, table)
    per_segment = np.zeros(len(codes.doc), np.int64)
    if len(start):
        _, first, which = np.unique(codes.piece_hash(start, end), return_index=True, return_inverse=True)
        _, emitted = vocabulary.encode_pieces(codes.codes, start[first], end[first])
        segment = np.searchsorted(codes.bounds, start, "right") - 1
        per_segment += np.bincount(segment, weights=emitted[which], minlength=len(per_segment)).astype(np.int64)
    for segment, _ in codes.special:
        per_segment[segment] += 1
    return np.bincount(codes.doc, weights=per_segment, minlength=len(texts)).astype(np.int64)


def count_block(texts: list[str], vocabulary: bpe.Vocabulary, table: np.ndarray) -> np.ndarray:
    """The same for a block of texts or for one long text."""
    if len(texts) == 1 and len(texts[0]) > bpe.SEGMENT:
        return sum(count_texts([t], vocabulary, table) for t in bpe.text_segments(texts[0]))
    return count_texts(texts, vocabulary, table)


def blocks(sizes: np.ndarray, limit: int = BLOCK):
    """Row ranges of at most ``limit`` bytes, or one longer text."""
    ends, first = np.cumsum(sizes), 0
    while first < len(sizes):
        stop = int(np.searchsorted(ends, (ends[first - 1] if first else 0) + limit, "right"))
        stop = max(first + 1, stop)
        yield first, stop
        first = stop


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """One row per document: id, n_bytes, n_tokens, over_limit."""
    shared = share(docs.sparkSession, bpe.compile_file(path))

    def run(batches):
        vocabulary, table = shared(), transitions()
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
            counts = [count_block(texts[a:b].to_pylist(), vocabulary, table) for a, b in blocks(sizes)]
            tokens = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), pa.array(tokens)],
                                             names=["id", "n_bytes", "n_tokens"])

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType),
                           T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    counted = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens",
                          (F.col("n_tokens") > limit).alias("over_limit"))
