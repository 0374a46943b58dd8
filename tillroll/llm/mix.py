"""Mix sources to target weights by Efraimidis-Spirakis sampling, in built-in
DataFrame functions only.

Targets: the sources, ordered by code point with null last, get ``WEIGHTS``
in turn and share ``share`` times the size of everything; no target passes
``max_epochs`` times its source's size, and what is cut off goes to the
others by weight until none is above. In closed form: with the sources sorted
by cap / weight, the share per weight is the highest of the levels that are
left when the first 0, 1, 2, ... sources stop at their caps.

Sampling: a document of size s and quality weight w has the exponential key
-ln(u) / w, u a uniform number hashed from its id and a seed, so reruns agree.
A source first gives as many whole epochs as its target holds; of the rest it
gives documents in key order while their sizes sum up to what is left, and the
document that crosses the line only if that comes closer.

No source is ever sorted in one task. Keys are cut into about sqrt(rows)
ordered buckets per source, sizes are summed per bucket (partial sums before
the shuffle), the buckets are prefix-summed, and only the one bucket that
holds a source's line is sorted row by row. The per-source table is broadcast
if it has at most ``BROADCAST_SOURCES`` rows and its names at most that many
times 64 bytes; otherwise it is joined by shuffle, where adaptive execution
splits hot sources.

Defined results: null text has size 0; null and empty sources are sources;
equal keys are ordered by id, then size; rows that tie in all are alike, and
any of them may be taken; an empty table gives no rows. Extra columns pass
through ``sample`` in one struct, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillroll.llm.staging import stage

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = "mix-1"
BROADCAST_SOURCES = 10_000
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "|!#$%&*"


def size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """0.25 to 1: the share of characters that are no junk symbols, scaled."""
    share = F.length(F.translate(text, SYMBOLS, "")) / F.greatest(F.length(text), F.lit(1))
    return F.lit(0.25) + F.lit(0.75) * F.coalesce(share, F.lit(0.0))


def sampling_key(doc_id: Column, weight: Column, seed: str = SEED) -> Column:
    """Exponential key: ascending order draws in proportion to ``weight``."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double")
    return -F.ln((bits + 1.0) / 4503599627370497.0) / weight


def targets(sources: DataFrame, share: float = SHARE, max_epochs: int = MAX_EPOCHS,
            weights: tuple = WEIGHTS) -> DataFrame:
    """Add ``target`` to rows of (source, source_size); one row per source, so
    the windows over all rows see names and sums only."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    every = Window.partitionBy()
    rising = Window.orderBy("cap_ratio", "place")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    level = ((F.sum("source_size").over(every) * F.lit(share) - F.coalesce(F.sum("cap").over(before), zero))
             / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), zero)))
    return (sources.withColumn("place", place)
            .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights)) + 1)
                        .cast("long"))
            .withColumn("cap", F.col("source_size") * max_epochs)
            .withColumn("cap_ratio", F.col("cap") / F.col("weight"))
            .withColumn("level", level)
            .withColumn("shared", F.max("level").over(every))
            .withColumn("target", F.least(F.col("cap").cast("double"), F.col("shared") * F.col("weight")))
            .select("source", "source_size", "n_docs", "target"))


def _bucket(key: Column, n_docs: Column) -> Column:
    """Number of the key's bucket: rises with the key, about sqrt(rows) of them."""
    return F.floor((F.lit(1.0) - F.exp(-key)) * F.ceil(F.sqrt(n_docs))).cast("long")


def sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           share: float = SHARE, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """Rows (row, size, source_size, target, copies): ``row`` is the whole
    input row, ``copies`` how often the mix takes it."""
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("id"),
        F.col(source_col).alias("source"), size(F.col(text_col)).alias("size"),
        sampling_key(F.col(id_col), quality_weight(F.col(text_col)), seed).alias("key"))
    slim = stage(keyed.select("source", "size", "key"), "mix-keys")
    sources = targets(slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")),
                      share, max_epochs)
    sources = stage(sources.withColumn("epochs", F.least(F.lit(max_epochs), F.coalesce(
        F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0))).cast("long"))
        .withColumn("left", F.col("target") - F.col("epochs") * F.col("source_size")), "mix-targets")
    held = sources.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("source")).alias("b")).first()
    small = held["n"] <= BROADCAST_SOURCES and (held["b"] or 0) <= 64 * BROADCAST_SOURCES

    def with_source(rows: DataFrame, table: DataFrame) -> DataFrame:
        right = table.withColumnRenamed("source", "of")
        return rows.join(F.broadcast(right) if small else right, F.col("source").eqNullSafe(F.col("of"))).drop("of")

    # The bucket of each source in which its running sum reaches what is left.
    sums = (with_source(slim, sources.select("source", "n_docs"))
            .groupBy("source", _bucket(F.col("key"), F.col("n_docs")).alias("bucket"))
            .agg(F.sum("size").alias("bucket_size")))
    running = Window.partitionBy("source").orderBy("bucket")
    edge = (with_source(sums, sources.select("source", "left"))
            .withColumn("upto", F.sum("bucket_size").over(running))
            .where(F.col("upto") > F.col("left"))
            .groupBy("source").agg(F.min("bucket").alias("edge"),
                                   F.min(F.col("upto") - F.col("bucket_size")).alias("before")))
    lines = stage(sources.join(edge.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")), "left")
                  .select("source", "source_size", "target", "epochs", "left", "n_docs", "edge", "before"), "mix-lines")

    placed = with_source(keyed, lines).withColumn("bucket", _bucket(F.col("key"), F.col("n_docs")))
    on_edge = F.coalesce(F.col("bucket") == F.col("edge"), F.lit(False))
    in_order = Window.partitionBy("source").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("before") + F.sum("size").over(in_order)
    chosen = ((upto <= F.col("left"))
              | ((upto - F.col("size") < F.col("left"))
                 & (upto - F.col("left") <= F.col("left") - (upto - F.col("size")))))
    columns = ["row", "size", "source_size", "target", "epochs", "extra"]
    # With no edge the whole source fits into what is left (only sizes of 0 do).
    sure = (placed.where(~on_edge).withColumn("extra", F.coalesce(F.col("bucket") < F.col("edge"), F.lit(False)))
            .select(columns))
    edge_rows = placed.where(on_edge).withColumn("extra", chosen).select(columns)
    copies = F.least(F.lit(max_epochs), F.col("epochs") + F.col("extra").cast("long")).cast("long")
    return sure.unionByName(edge_rows).select("row", "size", "source_size", "target", copies.alias("copies"))


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The contract's digest of ``sample``."""
    return sample(docs.select("doc_id", "source", "text"), **options).select(
        "row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken."""
    return (sample(docs, **options).where("copies > 0")
            .select(F.explode(F.array_repeat("row", F.col("copies").cast("int"))).alias("row")).select("row.*"))
