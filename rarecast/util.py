"""Shared building blocks: deterministic hashing, reading what may not exist yet,
one-row aggregates attached as scalar subqueries and a distributed prefix sum."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_key(*cols, seed: int | str = 0) -> Column:
    """md5 hex digest of ``col1|col2|...|seed`` - identical in Spark and DuckDB
    (``md5(concat(...))``), so draws and orders are reproducible anywhere."""
    parts = []
    for c in cols:
        parts += [col_of(c).cast("string"), F.lit("|")]
    parts.append(F.lit(str(seed)))
    return F.md5(F.concat(*parts))


def hash_uniform(*cols, seed: int | str = 0) -> Column:
    """Deterministic uniform [0, 1) from the first 32 bits of the md5 digest."""
    h = hash_key(*cols, seed=seed)
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def epoch_seconds(ts) -> Column:
    """Seconds since epoch (fractional) of a TIMESTAMP / TIMESTAMP_NTZ column.
    NTZ values are read as UTC wall time; the session zone must be UTC."""
    return F.unix_micros(col_of(ts).cast("timestamp")) / F.lit(1e6)


def read_if_exists(spark, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table at ``path``, or None where nothing has been written yet.  Any other
    error (unreadable files, no access) is raised."""
    from pyspark.errors import AnalysisException
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def attach_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a single-row aggregate (a global ``agg``: exactly
    one row) to every row as one scalar subquery over a struct of them - no
    join; with AQE the subquery reuses the exchanges it shares with ``df``."""
    cols = one_row.columns
    packed = one_row.select(F.struct(*cols).alias("__one")).scalar()
    return df.withColumn("__one", packed).select(
        *[F.col(f"`{c}`") for c in df.columns], *[F.col("__one").getField(c).alias(c) for c in cols])


def union_all(frames) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def kept_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared work folder and read back: what is computed once is not recomputed by each use, also
    after an executor is lost, and the planner knows its size."""
    from .session import fresh_path
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dense_number(df: DataFrame, keys: list[str], out: str, name: str) -> DataFrame:
    """Rows with ``out``, their place (from 0) in the order of ``keys``, without sorting them in one task: they are
    range-partitioned, sorted and written with their place inside the partition; the partitions' sizes (a row for
    each) then give the offsets.  The table lies in the shared work folder."""
    from .session import fresh_path
    path = fresh_path(df.sparkSession, name)
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__at", F.monotonically_increasing_id()).write.parquet(path)
    t = df.sparkSession.read.parquet(path)
    part = F.shiftright("__at", 33)           # the upper bits are the partition, the lower 33 the row in it
    sizes = t.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("__part", F.coalesce(before, F.lit(0)).alias("__before"))
    return (t.withColumn("__part", part).join(F.broadcast(offsets), "__part")      # a row for each partition
            .withColumn(out, F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("__part", "__before", "__at"))


def prefix_sum_by_range(df: DataFrame, key: str, sums: dict[str, str],
                        descending: bool = False, tiebreak: list | None = None,
                        n_buckets: int | None = None, inclusive: bool = True, kept: bool = False) -> DataFrame:
    """Running sums over a global order without a single-partition window.

    ``key`` is the numeric order column, ``tiebreak`` more order columns,
    ``sums`` maps output name -> input column; ``n_buckets`` defaults to the
    shuffle partition count.  Steps:
    1. the rows (as a rule aggregated to one per key) are written once, so that what they come from is read once
       (``kept``: the caller has done so),
    2. range bounds from approximate quantiles of the keys (``n_buckets`` numbers),
    3. a row finds its bucket by binary search (``Bucketizer``: the bounds go out with the tasks, no row carries them),
    4. per-bucket totals (``n_buckets`` rows) -> offsets by a window over that
       tiny table, broadcast back (size bounded by ``n_buckets``),
    5. running sum inside each bucket (a window partitioned by bucket).
    Rows with equal keys land in the same bucket, so ties stay exact.  Feed it
    data aggregated to one row per key when keys repeat heavily."""
    tiebreak = tiebreak or []
    if n_buckets is None:   # one bucket per shuffle partition
        n_buckets = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    df = df if kept else kept_table(df, "prefix-rows")
    probs = [i / n_buckets for i in range(1, n_buckets)]
    x = F.col(key).cast("double")
    found = df.select(x.alias("__x")).approxQuantile("__x", probs, 1 / (4 * n_buckets))       # nulls and NaN are left out
    bounds = sorted({b for b in found if math.isfinite(b)})
    d = df
    if bounds:
        near = Bucketizer(splits=[-math.inf, *bounds, math.inf], inputCol="__key", outputCol="__near", handleInvalid="keep")
        d = near.transform(df.withColumn("__key", x)).drop("__key")
    # nulls before the first bucket, NaN (kept by the bucketizer as one more) after the last, as a sort has them
    below = F.when(x.isNull(), F.lit(-1)).otherwise(F.col("__near").cast("int") if bounds else F.lit(0))
    d = d.withColumn("__bucket", -below if descending else below).drop("__near")
    totals = d.groupBy("__bucket").agg(*[F.sum(v).alias(f"__t_{k}") for k, v in sums.items()])
    wb = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "__bucket", *[F.coalesce(F.sum(f"__t_{k}").over(wb), F.lit(0)).alias(f"__o_{k}") for k in sums])
    d = d.join(F.broadcast(offsets), "__bucket", "left")
    order = [F.col(key).desc() if descending else F.col(key).asc()] + [col_of(c) for c in tiebreak]
    w = Window.partitionBy("__bucket").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1)
    for k, v in sums.items():
        d = d.withColumn(k, F.col(f"__o_{k}") + F.coalesce(F.sum(v).over(w), F.lit(0)))
    return d.drop("__bucket", *[f"__o_{k}" for k in sums])
