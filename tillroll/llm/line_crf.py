"""Document quality from a linear-chain conditional random field over lines.

Every line (text between line feeds) is labelled good or bad. The features of
a line are those of itself and of the lines before and after it: length, case,
digits, kinds of symbols, repeated words, word lengths, line ends. Training
takes documents with a label, and gives it to each of their lines; transition
weights tie neighbouring lines together. A document's score is the mean of its
lines' forward-backward marginals for "good", weighted by line length.

Forward and backward messages are products of 2 x 2 matrices, taken by
doubling over all lines of a chunk at once; a long text is scored in blocks of
lines with both kinds of messages carried between them. The matrix of a text's first line
has equal rows, so nothing is carried from one text into the next.

The model is fitted on the driver from at most ``SAMPLE_DOCS`` labelled
documents (those with the smallest hash of their id, none of the held-out
fifth) and of these, in hash order, as many as have ``SAMPLE_LINES`` lines
together; only their line features are fetched. Scoring reads every line of
every text and needs no shuffle. Labels, language, source and id are not
features.

Defined results: a null or empty text is one empty line and gets that line's
score; a null id is held out; labels of one id that differ count as bad;
without any usable label every score is 0.5; repeated rows are scored alike;
only id and result columns are returned, ``keep`` returns its input's columns.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tillroll.llm import textscan as ts
from tillroll.llm.staging import lowest, share, stage

SAMPLE_DOCS = 4000
SAMPLE_LINES = 200_000
THRESHOLD = 0.3
ROUNDS = 150


def _kinds() -> np.ndarray:
    """Class of each byte, for counting per line."""
    kind = np.full(256, 9)
    kind[32] = kind[9] = 0
    kind[65:91], kind[97:123], kind[48:58], kind[128:] = 1, 2, 3, 2
    for name, symbols in ((4, b"|"), (5, b"#$%&*"), (6, b"!"), (7, b".,;:?'\"-()"), (8, b"@/<>{}[]=\\_+^~`")):
        kind[list(symbols)] = name
    return kind


KIND = _kinds()
SAME = 17  # place of "same as the line before" among the features
LINES = 1 << 14  # lines of a long text whose messages are taken at once


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(features, weight, first)``: one row and one length per line of a
    chunk, and the number of lines before each text."""
    stop = data == 10
    stop[offsets[1:] - 1] = True  # the zero byte after each text
    end = np.flatnonzero(stop)
    start = np.concatenate([[0], end[:-1] + 1])
    first = np.searchsorted(end, offsets[1:] - 1) + 1
    first = np.concatenate([[0], first])
    n_lines, line = len(end), np.repeat(np.arange(len(end)), end - start + 1)
    length = (end - start).astype(float)
    inside = ~stop
    counts = np.bincount(line[inside] * 10 + KIND[data[inside]], minlength=n_lines * 10).reshape(-1, 10).astype(float)

    w_start, w_end, hashes, _ = ts.words(data, offsets)
    w_line, size = line[w_start], w_end - w_start
    n_words = np.bincount(w_line, minlength=n_lines).astype(float)
    per = lambda weights: np.bincount(w_line, weights=weights, minlength=n_lines)
    again = np.zeros(len(hashes))
    if len(hashes) > 1:
        again[1:] = (hashes[1:] == hashes[:-1]) & (w_line[1:] == w_line[:-1])
    order = np.lexsort([hashes, w_line])
    new = np.ones(len(order))
    if len(order) > 1:
        new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (w_line[order][1:] != w_line[order][:-1])
    distinct = np.bincount(w_line[order], weights=new, minlength=n_lines)
    prefix = ts.prefix_hash(data)
    whole = ts.range_hash(prefix, start, end)
    same = np.zeros(n_lines)
    same[1:] = (whole[1:] == whole[:-1]) & (length[1:] > 0)
    same[first[:-1]] = 0  # the line before is another text's
    last = np.where(length > 0, data[np.maximum(end - 1, 0)], 0)
    features = _describe(length, counts, n_words, per(again), distinct, per(size), per(size <= 3), per(size >= 12),
                         same, last)
    return features, length + 1, first


def _describe(length, counts, n_words, again, distinct, size, small, large, same, last) -> np.ndarray:
    """Features of lines from their bytes by kind (``counts``), their words, repeated
    neighbours and distinct ones, the sum of word sizes, short and long words,
    whether the line before is the same, and the last byte."""
    letters, words, chars = counts[:, 1] + counts[:, 2], np.maximum(n_words, 1), np.maximum(length, 1)
    return np.stack([
        np.log1p(length), np.log1p(n_words), length == 0, counts[:, 1] / np.maximum(letters, 1),
        counts[:, 3] / chars, np.sqrt(counts[:, 4] / words), np.sqrt(counts[:, 5] / words),
        np.sqrt(counts[:, 6] / words), counts[:, 7] / words, np.sqrt(counts[:, 8] / chars),
        np.sqrt(counts[:, 9] / chars), letters / chars, np.sqrt(again / words), distinct / words,
        size / words / 10, small / words, large / words, same,
        np.isin(last, list(b".?!\"'")), counts[:, 0] / words,
        (distinct / words < 0.5) & (n_words >= 6), (counts[:, 1] > counts[:, 2]) & (letters >= 4),
    ], axis=1)


def _long_line(data: np.ndarray, same: bool) -> np.ndarray:
    """Features of one line above ``ts.SEGMENT`` bytes."""
    counts, parts, before = np.zeros(10), [np.zeros(0, np.uint64)], np.zeros(0, np.uint64)
    n_words = again = size = small = large = 0.0
    for a in range(0, len(data), ts.SEGMENT):
        counts += np.bincount(KIND[data[a:a + ts.SEGMENT]], minlength=10)
    for start, end, hashes in ts.word_stream(data):
        run = np.concatenate([before, hashes])
        again += (run[1:] == run[:-1]).sum()
        before = run[-1:]
        n_words, size = n_words + len(hashes), size + (end - start).sum()
        small, large = small + (end - start <= 3).sum(), large + (end - start >= 12).sum()
        parts.append(np.unique(hashes))
    distinct = float(len(np.unique(np.concatenate(parts))))
    one = lambda x: np.array([x], float)
    return _describe(one(len(data)), counts[None], one(n_words), one(again), one(distinct), one(size), one(small),
                     one(large), one(same), one(data[-1]))


def long_text_features(data: np.ndarray):
    """Yield ``(features, weight)`` of the lines of one long text (which ends in a
    zero byte), by segments cut between lines."""
    lo, n, before = 0, len(data), (0, 0)
    while lo < n:
        hi = min(n, lo + ts.SEGMENT)
        if hi < n:
            cut = np.flatnonzero(data[lo:hi] == 10)
            if len(cut):
                hi = lo + int(cut[-1]) + 1
            else:  # a long line: up to its end
                while hi < n:
                    cut = np.flatnonzero(data[hi:hi + ts.SEGMENT] == 10)
                    hi = hi + int(cut[0]) + 1 if len(cut) else min(n, hi + ts.SEGMENT)
                    if len(cut):
                        break
        part = data[lo:hi]
        feeds = np.flatnonzero(part[:-1] == 10)
        stop = int(feeds[0]) if len(feeds) else len(part) - 1
        same = bool(stop > 0 and lo and before[1] - before[0] == stop and _equal(data, before[0], lo, stop))
        if len(part) - 1 > ts.SEGMENT:  # the loop above ends at the first line feed
            yield _long_line(part[:-1], same), np.array([len(part)], float)
        else:
            features, weight, _ = line_features(part, np.array([0, len(part)]))
            features[0, SAME] = same
            yield features, weight
        before = (lo + (int(feeds[-1]) + 1 if len(feeds) else 0), hi - 1)
        lo = hi


def _equal(data: np.ndarray, a: int, b: int, size: int) -> bool:
    return all(np.array_equal(data[a + k:a + min(k + ts.SEGMENT, size)], data[b + k:b + min(k + ts.SEGMENT, size)])
               for k in range(0, size, ts.SEGMENT))


def with_neighbours(features: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A constant, each line's features, and those of its two neighbours."""
    zero = np.zeros((1, features.shape[1]))
    before, after = np.vstack([zero, features[:-1]]), np.vstack([features[1:], zero])
    before[first[:-1]] = 0
    after[first[1:] - 1] = 0
    return np.hstack([np.ones((len(features), 1)), features, before, after])


def _matrices(x: np.ndarray, first: np.ndarray, model: dict) -> np.ndarray:
    """m[i, j, t]: transition from i to j (0 bad, 1 good) with the emission of
    line t; rows alike where a text begins. Scaled to at most 1."""
    emit = np.zeros((2, len(x)))
    emit[1] = x @ model["w"]
    scores = model["move"][:, :, None] + emit[None]
    scores[:, :, first[:-1]] = model["begin"][None, :, None] + emit[None][:, :, first[:-1]]
    return np.exp(scores - scores.max(axis=(0, 1)))


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of two rows of 2 x 2 matrices, scaled to at most 1."""
    out = np.stack([np.stack([a[i, 0] * b[0, j] + a[i, 1] * b[1, j] for j in (0, 1)]) for i in (0, 1)])
    return out / np.maximum(out.max(axis=(0, 1)), 1e-300)


def _products(matrices: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Products of the matrices up to each line and from each line on, up to scale."""
    ahead, back, reach, n = matrices, matrices, 1, matrices.shape[2]
    while reach <= longest and reach < n:
        ahead = np.concatenate([ahead[:, :, :reach], _product(ahead[:, :, :-reach], ahead[:, :, reach:])], axis=2)
        back = np.concatenate([_product(back[:, :, :-reach], back[:, :, reach:]), back[:, :, -reach:]], axis=2)
        reach *= 2
    return ahead, back


def messages(matrices: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward messages (state, line), up to scale."""
    (ahead, back), n = _products(matrices, longest), matrices.shape[2]
    alpha, beta = ahead[0], np.ones((2, n))
    beta[:, :-1] = back[:, :, 1:].sum(axis=1)
    return alpha / alpha.sum(0), beta / beta.sum(0)


def marginals(x: np.ndarray, first: np.ndarray, model: dict) -> np.ndarray:
    """Probability that each line is good."""
    alpha, beta = messages(_matrices(x, first, model), int(np.diff(first).max()))
    both = alpha * beta
    return both[1] / np.maximum(both.sum(0), 1e-300)


def score_long(data: np.ndarray, model: dict) -> float:
    """Score of one long text. Only the emissions of its lines are held; the
    messages are taken ``LINES`` lines at a time, forward ones carried from one
    block into the next, backward ones the other way."""
    width = len(model["centre"])
    w, before, after = model["w"][1:1 + width], model["w"][1 + width:1 + 2 * width], model["w"][1 + 2 * width:]
    parts, weights = [], []
    for features, weight in long_text_features(data):
        features = (features - model["centre"]) / model["scale"]
        parts.append(np.stack([features @ w, features @ before, features @ after]))
        weights.append(weight)
    parts, weights = np.concatenate(parts, axis=1), np.concatenate(weights)
    emit, n = parts[0] + model["w"][0], parts.shape[1]
    emit[1:] += parts[1, :-1]
    emit[:-1] += parts[2, 1:]

    def block(a):
        scores = np.repeat(model["move"][:, :, None], len(emit[a:a + LINES]), axis=2)
        scores[:, 1] += emit[a:a + LINES]
        if a == 0:
            scores[:, :, 0] = model["begin"][None, :] + np.array([0, emit[0]])
        matrices = np.exp(scores - scores.max(axis=(0, 1)))
        return matrices, *_products(matrices, len(matrices[0, 0]))

    carried = [np.array([0.5, 0.5])]
    for a in range(0, n, LINES):
        last = carried[-1] @ block(a)[1][:, :, -1]
        carried.append(last / last.sum())
    beta_next, total = np.ones(2), 0.0
    for k in range((n - 1) // LINES, -1, -1):
        _, ahead, back = block(k * LINES)
        alpha = np.einsum("i,ijt->jt", carried[k], ahead)
        suffix = np.einsum("ijt,j->it", back, beta_next)
        beta = np.concatenate([suffix[:, 1:], beta_next[:, None]], axis=1)
        both = alpha / alpha.sum(0) * (beta / beta.sum(0))
        total += float((both[1] / np.maximum(both.sum(0), 1e-300) * weights[k * LINES:(k + 1) * LINES]).sum())
        beta_next = suffix[:, 0] / suffix[:, 0].sum()
    return total / float(weights.sum())


def fit(features: np.ndarray, first: np.ndarray, labels: np.ndarray, rounds: int = ROUNDS,
        ridge: float = 1e-3, rate: float = 0.08) -> dict:
    """Maximum likelihood by Adam; every document weighs 1, whatever its length."""
    centre, scale = features.mean(0), features.std(0) + 1e-6
    x = with_neighbours((features - centre) / scale, first)
    size = np.diff(first)
    doc = np.repeat(np.arange(len(size)), size)
    y, weight, longest = labels[doc], 1 / size[doc] / len(size), int(size.max())
    is_first = np.zeros(len(x), bool)
    is_first[first[:-1]] = True
    n = x.shape[1]
    theta, m, v = np.zeros(n + 6), np.zeros(n + 6), np.zeros(n + 6)
    pair = np.zeros((2, 2, len(x)))
    pair[np.concatenate([[0], y[:-1]]), y, np.arange(len(x))] = 1
    for step in range(1, rounds + 1):
        model = {"w": theta[:n], "move": theta[n:n + 4].reshape(2, 2), "begin": theta[n + 4:]}
        matrices = _matrices(x, first, model)
        alpha, beta = messages(matrices, longest)
        both = alpha * beta
        good = both[1] / np.maximum(both.sum(0), 1e-300)
        joint = np.zeros_like(pair)
        joint[:, :, 1:] = alpha[:, None, :-1] * matrices[:, :, 1:] * beta[None, :, 1:]
        joint /= np.maximum(joint.sum(axis=(0, 1)), 1e-300)
        grad_move = ((pair - joint) * weight)[:, :, ~is_first].sum(2)
        start = np.stack([1 - y, y], 1)[is_first] - np.stack([1 - good, good], 1)[is_first]
        grad = np.concatenate([((y - good) * weight) @ x, grad_move.ravel(),
                               (start * weight[is_first][:, None]).sum(0)])
        grad -= ridge * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return {"w": theta[:n], "move": theta[n:n + 4].reshape(2, 2), "begin": theta[n + 4:],
            "centre": centre, "scale": scale}


def score_texts(texts: pa.Array, model: dict | None) -> np.ndarray:
    if model is None:
        return np.full(len(texts), 0.5)
    out = []
    for _, _, data, offsets in ts.chunks(texts):
        if ts.is_long(offsets):
            out.append(np.array([score_long(data, model)]))
            continue
        features, weight, first = line_features(data, offsets)
        good = marginals(with_neighbours((features - model["centre"]) / model["scale"], first), first, model)
        out.append(np.add.reduceat(good * weight, first[:-1]) / np.add.reduceat(weight, first[:-1]))
    return np.clip(np.concatenate(out), 0, 1) if out else np.zeros(0)


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the ids that training never sees."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _featurizer(most: int):
    """Features of texts of at most ``most`` lines; of longer ones their number."""
    def run(batches):
        for batch in batches:
            texts, labels = ts.text_array(batch.column(0)), batch.column(1)
            hashes, rows, sizes = batch.column(2), [], []
            for _, _, data, offsets in ts.chunks(texts):
                if ts.is_long(offsets):
                    held, n = [], 0
                    for features, _ in long_text_features(data):
                        n += len(features)
                        held = [*held, features.astype(np.float32).tobytes()] if n <= most else []
                    rows.append(b"".join(held) if n <= most else None)
                    sizes.append(n)
                    continue
                features, _, first = line_features(data, offsets)
                rows += [features[a:b].astype(np.float32).tobytes() if b - a <= most else None
                         for a, b in zip(first, first[1:])]
                sizes += np.diff(first).tolist()
            yield pa.RecordBatch.from_arrays([hashes, labels, pa.array(sizes, pa.int64()), pa.array(rows, pa.binary())],
                                             names=["h", "label", "n", "features"])
    return run


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample_docs: int = SAMPLE_DOCS, sample_lines: int = SAMPLE_LINES) -> dict | None:
    """Fit the model from a bounded sample of labelled documents that are not held out."""
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).dropna()
             .where(~held_out(F.col("id"))).groupBy("id").agg(F.min("label").alias("label"))
             .select("id", "label", F.xxhash64(F.col("id").cast("string")).alias("h")))
    chosen = lowest(known, "h", sample_docs)  # at most sample_docs rows
    found = stage(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
                  .join(F.broadcast(chosen), "id").select("text", "label", "h")
                  .mapInArrow(_featurizer(sample_lines), "h long, label int, n long, features binary"), "crf-sample")
    # Repeated rows of an id count once; then the ids in hash order, passing
    # over those that don't fit what is left of the bound on lines.
    order = found.groupBy("h").agg(F.min("n").alias("n"), F.min("features").alias("features"),
                                   F.min("label").alias("label"))
    fits, left = [], sample_lines
    for h, n in sorted((r["h"], r["n"]) for r in order.select("h", "n").collect()):
        if n <= left:
            fits.append(h)
            left -= n
    rows = sorted(order.where(F.col("h").isin(fits)).collect(), key=lambda r: r["h"]) if fits else []
    if len({r["label"] for r in rows}) < 2:
        return None
    width = len(np.frombuffer(rows[0]["features"], np.float32)) // rows[0]["n"]
    features = np.concatenate([np.frombuffer(r["features"], np.float32).reshape(-1, width) for r in rows]).astype(float)
    first = np.concatenate([[0], np.cumsum([r["n"] for r in rows])])
    return fit(features, first, np.array([int(r["label"] > 0) for r in rows]))


def score(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: id, held_out, score, predicted."""
    shared = share(docs.sparkSession, model)

    def run(batches):
        model = shared()
        for batch in batches:
            values = score_texts(ts.text_array(batch.column(1)), model)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.float64())], names=["id", "score"])

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("score", T.DoubleType())])
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
            .select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))


def keep(docs: DataFrame, model: dict | None, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, unchanged."""
    shared, at = share(docs.sparkSession, model), docs.columns.index(text_col)

    def run(batches):
        model = shared()
        for batch in batches:
            yield batch.filter(pa.array(score_texts(ts.text_array(batch.column(at)), model) >= threshold))

    return docs.mapInArrow(run, docs.schema)
