"""Embedding near-duplicates by an epsilon grid order join.

Vectors of one label are compared, by cosine in double precision. For unit
vectors cosine >= t is a distance of at most eps = sqrt(2 - 2 t), and an
orthonormal projection never lengthens a distance. So the vectors are
projected on their ``AXES`` leading principal directions, cut into a grid of
cell length eps, and put into the order of their cells (label, then cell by
cell). The sequence is range-partitioned and cut into intervals of at most
``BLOCK`` vectors.

Intervals are joined recursively: a tree with ``FAN`` children a node stands
over the blocks of each label; starting from the root with itself, pairs of
nodes whose bounding boxes are farther apart than eps are dropped, the others
are replaced by the pairs of their children. Surviving block pairs are task
groups of at most 2 x ``BLOCK`` vectors, within which the same recursion goes
on by halves down to ``LEAF`` vectors, where cosines are computed. A group
returns one row per vector (its links, and one edge to its component's first
vector), never pairs. A hot label or vector only means more blocks.

The principal directions come from at most ``SAMPLE`` vectors (smallest hash
of their row number), centred by label. They affect only what is skipped,
never the result: every vector is in the sequence, every pair not provably
distant is computed.

Defined results: null, empty or zero vectors, vectors with null or non-finite
components, and null labels link with nothing; vectors of different lengths
are not compared; repeated rows link with each other; a null id counts as a
vector, its component is the smallest other id, or null; other columns are
not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tillroll.llm.components import components
from tillroll.llm.grouped import groups
from tillroll.llm.staging import early_cleanup, lowest, share, stage

THRESHOLD = 0.93
AXES = 8
BLOCK, LEAF, FAN = 1024, 128, 4
SAMPLE = 4096
SLACK = 1e-9


def unit_rows(column: pa.Array, dim: int) -> np.ndarray:
    """Unit vectors of a list column whose lists all have ``dim`` numbers."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True))


def principal_axes(units: np.ndarray, labels: np.ndarray, n: int = AXES) -> np.ndarray:
    """Leading directions (dim, n) of vectors centred by label."""
    _, which = np.unique(labels, return_inverse=True)
    sums = np.zeros((which.max() + 1, units.shape[1]))
    np.add.at(sums, which, units)
    centred = units - (sums / np.bincount(which)[:, None])[which]
    return np.linalg.eigh(centred.T @ centred)[1][:, ::-1][:, :n]


def _projected(units: np.ndarray, axes: dict[int, np.ndarray]) -> np.ndarray:
    dim = units.shape[1]
    turned = units @ axes[dim] if dim in axes else units[:, :AXES]
    return np.pad(turned, ((0, 0), (0, AXES - turned.shape[1])))


def _placer(shared, eps: float):
    """Projections and cells of vectors, by runs of equal length."""
    def run(batches):
        axes = shared()
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                rows = batch.filter(pa.array(dims == dim))
                near = _projected(unit_rows(rows.column("vector"), int(dim)), axes)
                cells = np.floor(near / eps).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in ("uid", "label", "dim", "vector")),
                     *(pa.array(near[:, k]) for k in range(AXES)), *(pa.array(cells[:, k]) for k in range(AXES))],
                    names=["uid", "label", "dim", "vector"] + [f"p{k}" for k in range(AXES)] + [f"c{k}" for k in range(AXES)])
    return run


def _blocker(size: int):
    """Number the intervals of a sorted partition: at most ``size`` vectors of one label and length."""
    def run(batches):
        from pyspark import TaskContext

        block, filled, last = TaskContext.get().partitionId() << 32, 0, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            label, dim = batch.column("label"), batch.column("dim")
            change = np.ones(n, bool)
            change[1:] = pc.or_(pc.not_equal(label[1:], label[:-1]), pc.not_equal(dim[1:], dim[:-1])).to_numpy(
                zero_copy_only=False)
            change[0] = last is None or last != (label[0].as_py(), dim[0].as_py())
            bid, pos = np.empty(n, np.int64), np.empty(n, np.int32)
            for a, b in zip(np.flatnonzero(np.r_[True, change[1:]]), np.r_[np.flatnonzero(change[1:]) + 1, n]):
                if change[a] and filled:
                    block, filled = block + 1, 0
                at = filled + np.arange(b - a)
                bid[a:b], pos[a:b] = block + at // size, at % size
                block, filled = int(bid[b - 1]), int(pos[b - 1]) + 1
            last = (label[n - 1].as_py(), dim[n - 1].as_py())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bid), pa.array(pos)],
                                             names=[*batch.schema.names, "bid", "pos"])
    return run


def _close(x: str, y: str, eps: float):
    """Whether the boxes of two joined nodes come within eps of each other."""
    gap = F.lit(0.0)
    for k in range(AXES):
        apart = F.greatest(F.lit(0.0), F.col(f"{x}.lo{k}") - F.col(f"{y}.hi{k}"), F.col(f"{y}.lo{k}") - F.col(f"{x}.hi{k}"))
        gap = gap + apart * apart
    return gap <= eps * eps + SLACK


def _block_pairs(blocks: DataFrame, eps: float) -> DataFrame:
    """(first, second) ids of all block pairs that are not provably distant."""
    least = [F.min(f"lo{k}").alias(f"lo{k}") for k in range(AXES)] + [F.max(f"hi{k}").alias(f"hi{k}") for k in range(AXES)]
    last = blocks.agg(F.max("node").alias("n")).first()["n"]
    levels = 0 if not last else math.floor(math.log(last, FAN) + 1e-9) + 1
    pairs = blocks.groupBy("label", "dim").agg(F.lit(0).cast("long").alias("x")).withColumn("y", F.col("x"))
    for level in range(levels, -1, -1):
        boxes = (blocks.withColumn("node", F.floor(F.col("node") / FAN**level).cast("long"))
                 .groupBy("label", "dim", "node").agg(*least, F.min("bid").alias("bid")))
        if level < levels:
            kids = lambda c: F.explode(F.sequence(F.col(c) * FAN, F.col(c) * FAN + FAN - 1))
            pairs = pairs.withColumn("x", kids("x")).withColumn("y", kids("y")).where("x <= y")
        on = lambda side: [F.col(f"q.{c}") == F.col(f"{side}.{c}") for c in ("label", "dim")]
        pairs = (pairs.alias("q").join(boxes.alias("a"), [*on("a"), F.col("q.x") == F.col("a.node")])
                 .join(boxes.alias("b"), [*on("b"), F.col("q.y") == F.col("b.node")])
                 .where(_close("a", "b", eps))
                 .select("q.label", "q.dim", "x", "y", F.col("a.bid").alias("first"), F.col("b.bid").alias("second")))
    return pairs.select("first", "second")


def near_pairs(left: np.ndarray, right: np.ndarray, near_left: np.ndarray, near_right: np.ndarray, same: bool,
               threshold: float, eps: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs with cosine >= threshold of two intervals in grid order, or
    of one with itself (first index below the second), by halving."""
    found_x, found_y = [], []

    def join(a: int, b: int, c: int, d: int) -> None:
        if same and a >= d:
            return
        p, q = near_left[a:b], near_right[c:d]
        gap = np.maximum(0, np.maximum(p.min(0) - q.max(0), q.min(0) - p.max(0)))
        if (gap * gap).sum() > eps * eps + SLACK:
            return
        if b - a <= LEAF and d - c <= LEAF:
            x, y = np.nonzero(left[a:b] @ right[c:d].T >= threshold)
            keep = x + a < y + c if same else slice(None)
            found_x.append(x[keep] + a)
            found_y.append(y[keep] + c)
        elif b - a >= d - c:
            join(a, (a + b) // 2, c, d)
            join((a + b) // 2, b, c, d)
        else:
            join(a, b, c, (c + d) // 2)
            join(a, b, (c + d) // 2, d)

    if len(left) and len(right):
        join(0, len(left), 0, len(right))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found_x]), np.concatenate([none, *found_y])


def smallest_reachable(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Smallest index that each of 0..n-1 reaches over the links x - y."""
    label = np.arange(n)
    while True:
        best = label.copy()
        np.minimum.at(best, x, label[y])
        np.minimum.at(best, y, label[x])
        best = best[best]
        if np.array_equal(best, label):
            return label
        label = best


def _joiner(shared, threshold: float, eps: float):
    def run(batches):
        axes = shared()
        for table, bounds in groups(batches, 2):
            first, second, bid = (table.column(c).to_numpy() for c in ("first", "second", "bid"))
            uid, dims = table.column("uid").to_numpy(), table.column("dim").to_numpy()
            vectors, out = table.column("vector").combine_chunks(), []
            for s, e in zip(bounds, bounds[1:]):
                if e - s < 2:
                    continue
                units = unit_rows(vectors.slice(s, e - s), int(dims[s]))
                near = _projected(units, axes)
                if first[s] == second[s]:
                    x, y = near_pairs(units, units, near, near, True, threshold, eps)
                else:
                    cut = int((bid[s:e] == first[s]).sum())  # rows are sorted by block
                    x, y = near_pairs(units[:cut], units[cut:], near[:cut], near[cut:], False, threshold, eps)
                    y = y + cut
                links = np.bincount(x, minlength=e - s) + np.bincount(y, minlength=e - s)
                hit = np.flatnonzero(links)
                to = smallest_reachable(e - s, x, y)
                out.append((uid[s:e][hit], links[hit], uid[s:e][to[hit]]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out)],
                                                 names=["uid", "links", "to"])
    return run


def _axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Principal directions of the commonest length, from the bounded sample."""
    common = vectors.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").first()
    if common is None or common["dim"] <= 1:
        return {}
    bound = max(64, min(SAMPLE, (16 << 20) // (8 * common["dim"])))
    rows = lowest(vectors.where(F.col("dim") == common["dim"]).select("label", "vector", F.xxhash64("uid").alias("h")),
                  "h", bound).toArrow()
    units = unit_rows(rows.column("vector").combine_chunks(), common["dim"])
    return {common["dim"]: principal_axes(units, rows.column("label").to_numpy())}


def near_duplicates(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept."""
    with early_cleanup(table.sparkSession):
        return _near_duplicates(table, id_col, vector_col, label_col, threshold)


def _near_duplicates(table, id_col, vector_col, label_col, threshold):
    spark, eps = table.sparkSession, math.sqrt(max(0.0, 2 - 2 * threshold))
    doubles = F.col(vector_col).cast("array<double>")
    finite = F.forall(doubles, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    valid = F.col(label_col).isNotNull() & finite & F.exists(doubles, lambda v: v != 0)
    rows = stage(table.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"),
                              F.col(label_col).alias("label"),
                              F.when(F.coalesce(valid, F.lit(False)), doubles).alias("vector")), "vectors")
    label_type = rows.schema["label"].dataType
    vectors = rows.where("vector is not null").select("uid", "label", F.size("vector").alias("dim"), "vector")
    shared = share(spark, _axes(vectors))
    fields = [T.StructField("uid", T.LongType()), T.StructField("label", label_type), T.StructField("dim", T.IntegerType()),
              T.StructField("vector", T.ArrayType(T.DoubleType())),
              *(T.StructField(f"p{k}", T.DoubleType()) for k in range(AXES)),
              *(T.StructField(f"c{k}", T.IntegerType()) for k in range(AXES))]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["label", "dim", *(f"c{k}" for k in range(AXES)), "uid"]
    placed = vectors.mapInArrow(_placer(shared, eps), T.StructType(fields))
    numbered = T.StructType([*fields, T.StructField("bid", T.LongType()), T.StructField("pos", T.IntegerType())])
    sequence = stage(placed.repartitionByRange(n, *order).sortWithinPartitions(*order)
                     .mapInArrow(_blocker(BLOCK), numbered), "sequence")
    boxes = sequence.groupBy("label", "dim", "bid").agg(
        *(F.min(f"p{k}").alias(f"lo{k}") for k in range(AXES)), *(F.max(f"p{k}").alias(f"hi{k}") for k in range(AXES)))
    blocks = stage(boxes.withColumn("node", (F.row_number().over(Window.partitionBy("label", "dim").orderBy("bid")) - 1)
                                    .cast("long")), "blocks")
    pairs = stage(_block_pairs(blocks, eps), "block-pairs")
    sides = pairs.withColumn("bid", F.col("first")).union(
        pairs.where("first <> second").withColumn("bid", F.col("second")))
    grouped = (sequence.select("bid", "pos", "uid", "dim", "vector").join(sides, "bid")
               .select("first", "second", "bid", "pos", "uid", "dim", "vector")
               .repartition(n, "first", "second").sortWithinPartitions("first", "second", "bid", "pos"))
    links = stage(grouped.mapInArrow(_joiner(shared, threshold, eps), "uid long, links long, to long"), "links")
    parts = components(links.select(F.col("uid").alias("a"), F.col("to").alias("b")))
    found = (rows.select("uid", "id").join(links.groupBy("uid").agg(F.sum("links").alias("links")), "uid", "left")
             .join(parts.withColumnRenamed("node", "uid"), "uid", "left"))
    inside = stage(found, "found")
    named = (inside.where("component is not null").groupBy("component").agg(F.min("id").alias("least")))
    component = F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("least"))
    return (inside.join(named, "component", "left")
            .select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                    component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept")))
