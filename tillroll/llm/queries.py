"""The operators' registered queries over the benchmark tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillroll.llm import backoff_lm, bayes_join, collocations, decontaminate, grid_join, line_crf, mix, style_tree, suffix_index
from tillroll.llm import token_count, token_file, url_filter, whitening
from tillroll.llm.staging import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return register


WORDS_SQL = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP4_SQL = f"""
WITH d AS (SELECT doc_id, coalesce({WORDS_SQL.format('text')}, []) AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {WORDS_SQL.format('text')} AS w FROM benchmark),
win AS (SELECT item, least(len(w), 10) AS n,
               unnest(list_transform(generate_series(1, greatest(len(w) - 9, 1)),
                      lambda i: list_slice(w, i, i + least(len(w), 10) - 1))) AS g
        FROM b WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (SELECT doc_id, n, unnest(generate_series(1, len(w) - n + 1)) AS p, w FROM d, sizes WHERE len(w) >= n),
hit AS (SELECT dw.doc_id, dw.p, dw.n, win.item FROM dw JOIN win
        ON dw.n = win.n AND list_slice(dw.w, dw.p, dw.p + dw.n - 1) = win.g),
pos AS (SELECT doc_id, count(DISTINCT q) AS n_hit
        FROM (SELECT doc_id, unnest(generate_series(p, p + n - 1)) AS q FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
        FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)"""


@query("op4_decontamination", OP4_SQL)
def op4(spark, sf_dir):
    return decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


OP7_SQL = r"""
WITH d AS (SELECT doc_id, source,
       CAST(len(coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), [])) AS BIGINT) AS size,
       -ln((CAST(('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13)) AS BIGINT) + 1.0::DOUBLE)
           / 4503599627370497.0::DOUBLE)
       / (0.25::DOUBLE + 0.75::DOUBLE * coalesce(CAST(length(translate(text, '|!#$%&*', '')) AS DOUBLE)
                                                 / greatest(length(text), 1), 0.0::DOUBLE)) AS k
       FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS ss FROM d GROUP BY source),
p AS (SELECT *, row_number() OVER (ORDER BY encode(source) ASC NULLS LAST) - 1 AS place FROM s),
w AS (SELECT *, list_extract([3, 1, 2], CAST(place % 3 + 1 AS INTEGER)) AS w, 2 * ss AS cap FROM p),
r AS (SELECT *, CAST(cap AS DOUBLE) / w AS ratio FROM w),
l AS (SELECT *, (CAST(sum(ss) OVER () AS DOUBLE) * 1.5::DOUBLE - CAST(coalesce(sum(cap) OVER b, 0) AS DOUBLE))
             / CAST(sum(w) OVER () - coalesce(sum(w) OVER b, 0) AS DOUBLE) AS level FROM r
      WINDOW b AS (ORDER BY ratio, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT *, least(CAST(cap AS DOUBLE), (max(level) OVER ()) * w) AS target FROM l),
e AS (SELECT source, ss, target, CASE WHEN ss = 0 THEN 0 ELSE least(2, CAST(floor(target / ss) AS BIGINT)) END AS ep FROM t),
x AS (SELECT d.doc_id, d.size, e.ss, e.target, e.ep, e.target - e.ep * e.ss AS rest,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, ss AS source_size, target,
       CAST(size * least(2, ep + CASE WHEN upto <= rest OR (upto - size < rest AND upto - rest <= rest - (upto - size))
                                      THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM x"""


@query("op7_mixing", OP7_SQL)
def op7(spark, sf_dir):
    return mix.mixture(read_table(spark, sf_dir, "documents"))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op6_token_counts")
def op6(spark, sf_dir):
    return token_count.count_tokens(read_table(spark, sf_dir, "documents"), tokenizer_path())


@query("op10_token_file")
def op10(spark, sf_dir):
    return token_file.round_trip(read_table(spark, sf_dir, "documents"), tokenizer_path())


@query("op5_quality")
def op5(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return line_crf.score(docs, line_crf.train(docs, read_table(spark, sf_dir, "labels")))


@query("op9_url_filter")
def op9(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages")
    return url_filter.judge(pages, url_filter.train(pages)).drop("words")


OP8_SQL = f"""
WITH w AS (SELECT doc_id, coalesce({WORDS_SQL.format('text')}, []) AS w FROM documents),
s AS (SELECT doc_id, list_sort(list_distinct(list_transform(generate_series(1, greatest(len(w) - 4, 1)),
             lambda i: array_to_string(list_slice(w, i, i + 4), ' ')))) AS s FROM w WHERE len(w) > 0),
c AS (SELECT s, min(doc_id) AS rep, count(*) AS members FROM s GROUP BY s),
x AS (SELECT rep, len(s) AS n, unnest(s) AS g FROM c),
common AS (SELECT a.rep AS p, b.rep AS q, a.n AS an, b.n AS bn, count(*) AS k
           FROM x a JOIN x b ON a.g = b.g AND a.rep < b.rep
                AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n) GROUP BY ALL),
e AS (SELECT p, q FROM common WHERE 5 * k >= 4 * (an + bn - k)),
pairs AS (SELECT p, q FROM e UNION ALL SELECT q, p FROM e),
r AS (WITH RECURSIVE reach(a, b) AS (SELECT rep, rep FROM c UNION SELECT reach.a, pairs.q FROM reach JOIN pairs ON reach.b = pairs.p)
      SELECT a AS rep, min(b) AS class_id FROM reach GROUP BY a),
l AS (SELECT pairs.p AS rep, sum(c.members) AS links FROM pairs JOIN c ON c.rep = pairs.q GROUP BY pairs.p)
SELECT w.doc_id, coalesce(r.class_id, w.doc_id) AS class_id,
       CAST(coalesce(l.links, 0) + coalesce(c.members - 1, 0) AS BIGINT) AS n_links,
       CAST(coalesce(len(c.s), 0) AS BIGINT) AS n_shingles
FROM w LEFT JOIN s USING (doc_id) LEFT JOIN c ON c.s = s.s LEFT JOIN r ON r.rep = c.rep LEFT JOIN l ON l.rep = c.rep"""


@query("op8_ngram_jaccard_join", OP8_SQL)
def op8(spark, sf_dir):
    return bayes_join.link(read_table(spark, sf_dir, "documents"))


OP1_SQL = """
WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
       AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
       AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS p, b.vec_id AS q FROM ok a JOIN ok b
      ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      AND list_cosine_similarity(a.e, b.e) >= 0.93::DOUBLE),
r AS (WITH RECURSIVE reach(a, b) AS (SELECT vec_id, vec_id FROM v
      UNION SELECT reach.a, l.q FROM reach JOIN l ON reach.b = l.p) SELECT a, min(b) AS c FROM reach GROUP BY a),
n AS (SELECT p, count(*) AS n FROM l GROUP BY p)
SELECT v.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, r.c AS component_id, v.vec_id = r.c AS kept
FROM v LEFT JOIN n ON n.p = v.vec_id JOIN r ON r.a = v.vec_id"""


@query("op1_embedding_near_dup", OP1_SQL)
def op1(spark, sf_dir):
    return grid_join.near_duplicates(read_table(spark, sf_dir, "embeddings"))


@query("op3_main_text")
def op3(spark, sf_dir):
    return style_tree.main_text(read_table(spark, sf_dir, "pages"))


@query("op2_suffix_dedup")
def op2(spark, sf_dir):
    return suffix_index.find(read_table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang,
       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
o AS (SELECT lang, id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM w),
o3 AS (SELECT lang, x, lead(x) OVER z AS y, lead(x, 2) OVER z AS z FROM o WINDOW z AS (PARTITION BY id ORDER BY i)),
f1 AS (SELECT lang, x, count(*) AS f FROM o3 GROUP BY ALL),
f2 AS (SELECT lang, x, y, count(*) AS f FROM o3 WHERE y IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
f3 AS (SELECT lang, x, y, z, count(*) AS f FROM o3 WHERE z IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, sum(f) AS n FROM f1 GROUP BY lang),
c AS (SELECT f2.lang, f2.x || ' ' || f2.y AS phrase, 1 AS cut, f2.f AS a, p.f AS l, q.f AS r
      FROM f2 JOIN f1 p ON p.lang = f2.lang AND p.x = f2.x JOIN f1 q ON q.lang = f2.lang AND q.x = f2.y
      WHERE NOT EXISTS (SELECT 1 FROM f3 WHERE f3.lang = f2.lang AND f3.x = f2.x AND f3.y = f2.y AND 100 * f3.f >= 50 * f2.f)
        AND NOT EXISTS (SELECT 1 FROM f3 WHERE f3.lang = f2.lang AND f3.y = f2.x AND f3.z = f2.y AND 100 * f3.f >= 50 * f2.f)
      UNION ALL
      SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z, 1, f3.f, p.f, q.f
      FROM f3 JOIN f1 p ON p.lang = f3.lang AND p.x = f3.x JOIN f2 q ON q.lang = f3.lang AND q.x = f3.y AND q.y = f3.z
      UNION ALL
      SELECT f3.lang, f3.x || ' ' || f3.y || ' ' || f3.z, 2, f3.f, p.f, q.f
      FROM f3 JOIN f2 p ON p.lang = f3.lang AND p.x = f3.x AND p.y = f3.y JOIN f1 q ON q.lang = f3.lang AND q.x = f3.z),
s AS (SELECT *, (1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS score FROM c),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM best)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000"""


@query("op11_collocations", OP11_SQL)
def op11(spark, sf_dir):
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


@query("op12_lm_scoring")
def op12(spark, sf_dir):
    return backoff_lm.score(read_table(spark, sf_dir, "documents"))


@query("op13_whitening")
def op13(spark, sf_dir):
    rows = whitening.whiten(read_table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.col("deviation").cast("long"))
