"""Nearest neighbours of vectors without spatial structure: random-projection trees, then neighbours of neighbours,
every candidate ranked by its exact distance.

The pivot search of ``resample.minority_neighbours`` is exact, but where no cell can be ruled out it compares all pairs.
Here each of ``trees`` trees cuts the rows at medians along random directions into leaves of about ``leaf`` rows and
compares the rows of a leaf, so candidate pairs are n * trees * leaf; ``rounds`` rounds then compare each row with the
neighbours of its ``wide`` best so far, n * wide^2 pairs each.  Both grow with n, not with its square; what is lost is
recall (measured in the tests, 0.9 and more with the defaults), never a distance.

Directions are one per tree and level, and a node's median comes from a bounded sample of rows, so what is broadcast
(``trees`` * (levels * dimensions + 2^levels) numbers, levels bounded by the sample) does not grow with the rows.  Leaves
above ``MAX_LEAF`` rows, as equal vectors make, are cut by a hash of the id."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..util import col_of, kept_table

SAMPLE = 16_384          # rows that the medians are taken from
MAX_LEAF = 4_096


def _fit_trees(sample: np.ndarray, trees: int, levels: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions (trees, levels, dimensions) and medians (trees, 2^levels) by node number, the root's being 1."""
    rng = np.random.default_rng(seed)
    direction = rng.normal(size=(trees, max(levels, 1), sample.shape[1]))
    median = np.zeros((trees, 1 << levels))
    for t in range(trees):
        node = np.ones(len(sample), np.int64)
        for level in range(levels):
            x = sample @ direction[t, level]
            for at in range(1 << level, 2 << level):
                mine = x[node == at]
                median[t, at] = np.median(mine) if len(mine) else 0.0
            node = 2 * node + (x > median[t, node])
    return direction, median


def _leaves(x: np.ndarray, direction: np.ndarray, median: np.ndarray, levels: int) -> np.ndarray:
    """Leaf of each row in each tree."""
    out = np.ones((len(direction), len(x)), np.int64)
    for t in range(len(direction)):
        for level in range(levels):
            out[t] = 2 * out[t] + (x @ direction[t, level] > median[t, out[t]])
    return out


def _vectors(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def _nearest_in(ids: np.ndarray, x: np.ndarray, k: int) -> pa.RecordBatch:
    """The k nearest other rows of each row of a block."""
    sq = (x * x).sum(1)
    d2 = np.maximum(sq[:, None] + sq[None, :] - 2.0 * (x @ x.T), 0.0)
    d2[ids[:, None] == ids[None, :]] = np.inf
    m = min(k, len(ids) - 1)
    near = np.argpartition(d2, m - 1, axis=1)[:, :m] if m > 0 else np.zeros((len(ids), 0), np.int64)
    a, b = np.repeat(np.arange(len(ids)), near.shape[1]), near.ravel()
    ok = np.isfinite(d2[a, b])
    a, b = a[ok], b[ok]
    dist = np.sqrt(((x[a] - x[b]) ** 2).sum(1))
    return pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b]), pa.array(dist)], names=["id", "nb_id", "dist"])


def _best(pairs: DataFrame, k: int) -> DataFrame:
    """The k nearest distinct neighbours of each row (ties by id)."""
    one = pairs.groupBy("id", "nb_id").agg(F.min("dist").alias("dist"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy("dist", "nb_id"))
    return one.withColumn("nb_rank", rank).where(F.col("nb_rank") <= k)


def projected_neighbours(rows: DataFrame, id_col: str, vec: str, k: int = 5, trees: int = 12, leaf: int = 128,
                         wide: int | None = None, rounds: int = 2, seed: int = 7) -> DataFrame:
    """(id, nb_id, dist, nb_rank): about the k nearest other rows (Euclidean) of each row, with exact distances."""
    v = kept_table(rows.select(col_of(id_col).cast("string").alias("id"), F.col(vec).cast("array<double>").alias("x")), "nn-rows")
    n, schema = v.count(), "id string, nb_id string, dist double"
    if n < 2:
        return v.sparkSession.createDataFrame([], f"{schema}, nb_rank int")
    wide = max(k, wide or 3 * k)
    sample = np.array([r["x"] for r in v.orderBy(F.md5("id"), "id").limit(SAMPLE).collect()], np.float64)
    levels = min(max(0, math.ceil(math.log2(n / leaf))), int(math.log2(len(sample))))
    held = v.sparkSession.sparkContext.broadcast(_fit_trees(sample, trees if levels else 1, levels, seed))

    def deal(batches):
        direction, median = held.value
        for b in batches:
            if b.num_rows:
                found = _leaves(_vectors(b.column("x")), direction, median, levels)
                for t in range(len(found)):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(b.num_rows, t, np.int32)), pa.array(found[t]), b.column("id"), b.column("x")],
                                                     names=["tree", "leaf", "id", "x"])

    dealt = v.mapInArrow(deal, "tree int, leaf long, id string, x array<double>")
    sizes = kept_table(dealt.groupBy("tree", "leaf").agg(F.ceil(F.count(F.lit(1)) / MAX_LEAF).alias("parts")), "nn-leaves")
    dealt = dealt.join(sizes, ["tree", "leaf"]).withColumn("part", F.pmod(F.xxhash64("id", "tree"), F.col("parts")))

    def compare(t: pa.Table) -> pa.Table:
        ids = np.array(t.column("id").to_pylist(), object)
        return pa.Table.from_batches([_nearest_in(ids, _vectors(t.column("x").combine_chunks()), wide)]).cast(
            pa.schema([("id", pa.string()), ("nb_id", pa.string()), ("dist", pa.float64())]))

    near = kept_table(_best(dealt.groupBy("tree", "leaf", "part").applyInArrow(compare, schema), wide), "nn-trees")
    for _ in range(rounds if levels else 0):
        both = near.select("id", "nb_id").unionByName(near.select(F.col("nb_id").alias("id"), F.col("id").alias("nb_id")))
        # rows that many others point to keep only as many back links as they have neighbours
        rank = F.row_number().over(Window.partitionBy("id").orderBy(F.xxhash64("id", "nb_id"), "nb_id"))
        links = kept_table(both.distinct().withColumn("r", rank).where(F.col("r") <= 2 * wide).drop("r"), "nn-links")
        pairs = (links.alias("a").join(links.alias("b"), F.col("a.id") == F.col("b.id"))
                 .select(F.col("a.nb_id").alias("id"), F.col("b.nb_id").alias("nb_id")).where("id <> nb_id").distinct())
        pairs = pairs.join(near.select("id", "nb_id"), ["id", "nb_id"], "left_anti")
        left, right = v.select("id", F.col("x").alias("a")), v.select(F.col("id").alias("nb_id"), F.col("x").alias("b"))
        dist = F.sqrt(F.aggregate(F.zip_with("a", "b", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, e: s + e))
        more = pairs.join(left, "id").join(right, "nb_id").select("id", "nb_id", dist.alias("dist"))
        near = kept_table(_best(near.select("id", "nb_id", "dist").unionByName(more), wide), "nn-round")
    return near.where(F.col("nb_rank") <= k)
