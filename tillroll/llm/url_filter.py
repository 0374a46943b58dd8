"""URL filter: host and path rules, and for the rest a naive Bayes verdict over
segmented words.

Three passes over the pages, each a map with small partial sums:

1. words of page titles and URL paths are counted over all pages; the
   ``LEXICON`` most frequent make the unigram model (that size is the model's,
   so what is broadcast is bounded whatever the corpus);
2. hosts are split at dots and hyphens, and every run of letters is cut into
   words by unigram Viterbi (an unknown word, of any length, pays for each letter); host and
   path words of the pages that a rule decides are counted per verdict in
   ``BUCKETS`` hashed counters;
3. every URL gets its rule's verdict, or the more probable class of the
   multinomial naive Bayes model over those counters (ties: allow).

Hosts are segmented once per batch of rows, not once per row, and rows of a
hot host are never brought together.

Defined results: a null URL or one without "://" has an empty host and path,
fits no rule and is judged by the class priors; a table whose rules decide no
row allows the rest; repeated rows are judged alike; only the id and result
columns are returned, ``allowed`` returns its input's columns.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tillroll.llm.staging import lowest, share, stage

LEXICON = 50_000
BUCKETS = 1 << 18
# The rules of the registered query, longest match wins.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))

_URL = re.compile(r"://([^/?#]*)([^?#]*)", re.S)
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: str | None) -> tuple[str, str]:
    found = _URL.search(url or "")
    return (found[1].translate(_LOWER), found[2]) if found else ("", "")


class Rules:
    """Verdicts by host (and its subdomains) and path prefix."""

    def __init__(self, rules):
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for verdict, text in rules:
            host, _, path = text.partition("/")
            self.by_host.setdefault(host, []).append(("/" + path, text, verdict))

    def find(self, host: str, path: str) -> tuple[str | None, str | None]:
        best, labels = (None, None), host.split(".")
        for k in range(len(labels)):
            for prefix, text, verdict in self.by_host.get(".".join(labels[k:]), ()):
                if path.startswith(prefix) and (best[0] is None or len(text) > len(best[0])):
                    best = (text, verdict)
        return best


class Segmenter:
    """Unigram Viterbi over a word-count lexicon."""

    def __init__(self, counts: dict[str, int]):
        total = sum(counts.values()) + 1
        self.cost = {w: math.log(total / n) for w, n in counts.items()}
        self.unknown = math.log(total * 10)
        self.letter = math.log(26)
        self.sizes = sorted({len(w) for w in counts})

    def words(self, run: str) -> list[str]:
        best, back = [0.0], [0]
        cheapest, opener = math.inf, 0      # where an unknown word, of any length, starts best
        for end in range(1, len(run) + 1):
            if best[end - 1] - self.letter * (end - 1) < cheapest:
                cheapest, opener = best[end - 1] - self.letter * (end - 1), end - 1
            options = [(cheapest + self.unknown + self.letter * end, opener)]
            for size in self.sizes:
                known = self.cost.get(run[end - size:end]) if size <= end else None
                if known is not None:
                    options.append((best[end - size] + known, end - size))
            cost, begin = min(options)
            best.append(cost)
            back.append(begin)
        out, end = [], len(run)
        while end:
            out.append(run[back[end]:end])
            end = back[end]
        return out[::-1]

    def host_tokens(self, host: str) -> list[str]:
        out = []
        for run in re.findall(r"[^\W\d_]+|\d+", host):
            out += ["h:#"] if run[0].isdigit() else ["h:" + w for w in self.words(run)]
        return out


def path_tokens(path: str) -> list[str]:
    return ["p:#" if t[0].isdigit() else "p:" + t for t in re.findall(r"[^\W\d_]+|\d+", path.lower())]


def bucket(token: str, buckets: int) -> int:
    return zlib.crc32(token.encode("utf-8", "surrogatepass")) % buckets


def lexicon(pages: DataFrame, url_col: str, html_col: str, size: int) -> dict[str, int]:
    """The ``size`` most frequent words of all titles and URL paths, or all if
    there are fewer; of those with the last count that has a place, the ones
    of lowest hash.

    The place of the cut is found from the numbers of words by classes of
    counts of about 1 % width and then by the counts of one class, so tasks
    send those numbers and little more than the chosen words."""
    title = F.regexp_extract(html_col, r"(?is)<title[^>]*>(.*?)</title", 1)
    path = F.regexp_extract(url_col, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    found = F.regexp_extract_all(F.lower(F.concat_ws(" ", title, path)), F.lit(r"(\p{L}{2,})"), 1)
    counts = stage(pages.select(F.explode(found).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
                   .withColumn("class", F.floor(F.ln("n") * 100).cast("int")), "lexicon")
    edge, held = _crossing(counts, "class", size)
    if edge is None:
        rows = counts.collect()
    else:
        level, held = _crossing(counts.where(F.col("class") == edge), "n", size, held)
        last = counts.where(F.col("n") == level).withColumn("h", F.xxhash64("word"))
        rows = counts.where(F.col("n") > level).collect() + lowest(last, "h", size - held).collect()
    return {r["word"]: r["n"] for r in rows}


def _crossing(counts: DataFrame, by: str, size: int, held: int = 0) -> tuple[int | None, int]:
    """The highest value of ``by`` whose words don't all fit in ``size``, and
    how many words there are above it, ``held`` included."""
    for r in counts.groupBy(by).agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc(by)).collect():
        if held + r["words"] > size:
            return r[by], held
        held += r["words"]
    return None, held


def _tokens(urls: list, segmenter: Segmenter) -> list[tuple[str, str, list[str]]]:
    hosts: dict[str, list[str]] = {}
    out = []
    for url in urls:
        host, path = split_url(url)
        if host not in hosts:
            hosts[host] = segmenter.host_tokens(host)
        out.append((host, path, hosts[host] + path_tokens(path)))
    return out


def _counter(shared):
    def run(batches):
        rules, segmenter, buckets = shared()
        for batch in batches:
            sums: dict[tuple[int, int], int] = {}
            for host, path, tokens in _tokens(batch.column(0).to_pylist(), segmenter):
                verdict = rules.find(host, path)[1]
                if verdict:
                    kind = int(verdict == "block")
                    for at in [-1] + [bucket(t, buckets) for t in tokens]:
                        sums[kind, at] = sums.get((kind, at), 0) + 1
            keys = list(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in keys], pa.int32()), pa.array([a for _, a in keys], pa.int32()),
                 pa.array([sums[k] for k in keys], pa.int64())], names=["kind", "bucket", "n"])
    return run


class Model:
    """Log odds of block per hashed word, and of the class priors."""

    def __init__(self, rows, buckets: int):
        counts, rows_of = np.ones((2, buckets)), np.zeros(2)
        for kind, at, n in rows:
            if at < 0:
                rows_of[kind] = n
            else:
                counts[kind, at] += n
        used = (counts.sum(0) > 2).sum()
        total = (counts - 1).sum(1) + max(1, used)
        self.prior = math.log(rows_of[1] / rows_of[0]) if rows_of.all() else (-math.inf if not rows_of[1] else math.inf)
        odds = np.log(counts[1] / total[1]) - np.log(counts[0] / total[0])
        self.odds, self.buckets = odds.astype(np.float32), buckets

    def blocks(self, tokens: list[str]) -> bool:
        return self.prior + sum(float(self.odds[bucket(t, self.buckets)]) for t in tokens) > 0


def train(pages: DataFrame, rules=RULES, url_col: str = "url", html_col: str = "html",
          lexicon_size: int = LEXICON, buckets: int = BUCKETS) -> tuple[Rules, Segmenter, Model]:
    rules = Rules(rules)
    segmenter = Segmenter(lexicon(pages, url_col, html_col, lexicon_size))
    shared = share(pages.sparkSession, (rules, segmenter, buckets))
    counts = (pages.select(F.col(url_col).alias("url")).mapInArrow(_counter(shared), "kind int, bucket int, n long")
              .groupBy("kind", "bucket").agg(F.sum("n").alias("n")).collect())  # at most 2 x buckets rows
    return rules, segmenter, Model(counts, buckets)


def judge(pages: DataFrame, trained: tuple, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: id, host, path, rule, verdict, words (host and path words)."""
    shared = share(pages.sparkSession, trained)

    def run(batches):
        rules, segmenter, model = shared()
        for batch in batches:
            rows = _tokens(batch.column(1).to_pylist(), segmenter)
            found = [rules.find(host, path) for host, path, _ in rows]
            verdicts = [v or ("block" if model.blocks(t) else "allow") for (_, v), (_, _, t) in zip(found, rows)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.string()) for c in (
                    [h for h, _, _ in rows], [p for _, p, _ in rows], [r for r, _ in found], verdicts)),
                 pa.array([t for _, _, t in rows], pa.list_(pa.string()))],
                names=["id", "host", "path", "rule", "verdict", "words"])

    schema = T.StructType([T.StructField("id", pages.schema[id_col].dataType),
                           *[T.StructField(c, T.StringType()) for c in ("host", "path", "rule", "verdict")],
                           T.StructField("words", T.ArrayType(T.StringType()))])
    return (pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")).mapInArrow(run, schema)
            .withColumnRenamed("id", id_col))


def allowed(pages: DataFrame, trained: tuple, url_col: str = "url") -> DataFrame:
    """The rows of ``pages`` whose verdict is allow, unchanged."""
    shared, at = share(pages.sparkSession, trained), pages.columns.index(url_col)

    def run(batches):
        rules, segmenter, model = shared()
        for batch in batches:
            keep = [(rules.find(h, p)[1] or ("block" if model.blocks(t) else "allow")) == "allow"
                    for h, p, t in _tokens(batch.column(at).to_pylist(), segmenter)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return pages.mapInArrow(run, pages.schema)
