"""Connected components of a link table, without ever holding a component in one place.

Alternating large-star and small-star steps: every link is replaced by one to the smallest
neighbour met, until nothing changes.  A step is a partial minimum per node and one join, so a
hub with any number of neighbours is summed before the shuffle.  Each round is written to the
shared work folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").union(e.select(F.col("v"), F.col("u")).toDF("u", "v"))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    """Links point from the larger node ``u`` to the smaller ``v``."""
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    return (e.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                                    F.col("m").alias("v")).filter("u <> v").distinct())


def components(links: DataFrame) -> DataFrame:
    """(u, v) links -> stored (node, component) of every linked node; the component is its smallest node."""
    e = stored(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
               .filter("u <> v").distinct(), "links")
    mark = None
    while True:
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark or not now[0]:
            break
        mark = now
        e = stored(_small_star(_large_star(e)), "links")
    roots = e.select(F.col("v").alias("node")).distinct()
    return stored(e.select(F.col("u").alias("node"), F.col("v").alias("component"))
                  .union(roots.select("node", F.col("node").alias("component"))), "components")
