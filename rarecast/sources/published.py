"""A table that each batch changes by one atomic step.

A batch writes its accepted rows (by tag), its rejected rows and its ledger into folders of an attempt of its own
and then one manifest file that names them.  Readers follow the manifests, so a batch is either all there or not at
all, whenever its writer was cut short; a replayed batch that has a manifest does nothing, one that has none makes a
new attempt, and the old one is never read.

    <root>/data/attempt=<batch>-<random>/<tag column>=<tag>/...    <root>/manifests/batch=<batch>
    <root>/rejected/attempt=...    <root>/ledger/attempt=...

One writer at a time (one stream) is assumed, as for any streaming sink."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..util import read_if_exists
from .table import first_per_key

_MANIFEST = T.StructType([T.StructField("attempt", T.StringType()), T.StructField("tags", T.ArrayType(T.StringType())),
                          T.StructField("n_rows", T.LongType())])


class PublishedTable:
    """``schema`` holds the row's columns, ``tag`` (which partitions the data) among them."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, tag: str):
        self.spark, self.root, self.tag = spark, root.rstrip("/"), tag
        self.schema = T.StructType([f for f in schema.fields if f.name != tag] + [f for f in schema.fields if f.name == tag])

    def manifests(self) -> DataFrame:
        """(attempt, tags, n_rows, batch) for each published batch."""
        m = read_if_exists(self.spark, f"{self.root}/manifests", "text")
        if m is None:
            return self.spark.createDataFrame([], T.StructType([*_MANIFEST.fields, T.StructField("batch", T.LongType())]))
        return m.select(F.from_json("value", _MANIFEST).alias("m"), F.col("batch").cast("long").alias("batch")).select("m.*", "batch")

    def _published(self, part: str, schema: T.StructType, attempts: list[str]) -> DataFrame:
        if not attempts:
            return self.spark.createDataFrame([], schema)
        read = self.spark.read.option("basePath", f"{self.root}/{part}").schema(schema)
        return read.parquet(*[f"{self.root}/{part}/attempt={a}" for a in attempts]).select(*schema.names)

    def rows(self, tags: list[str] | None = None) -> DataFrame:
        """The table, or its rows of some tags: only manifests that name one of them are followed, and only those
        partitions are read."""
        m = self.manifests().where("n_rows > 0")
        if tags is not None:
            m = m.where(F.arrays_overlap("tags", F.array(*[F.lit(t) for t in tags]).cast("array<string>")))
        found = self._published("data", self.schema, [r[0] for r in m.select("attempt").collect()])     # a row for each batch
        return found if tags is None else found.where(F.col(self.tag).isin(list(tags)))

    def new_rows(self, batch: DataFrame, key: str, order: list) -> DataFrame:
        """First row per key of the batch, minus the keys the table has.  A key belongs to one tag, so only the batch's
        tags are read; of these only keys of the batch (a semi-join, which is broadcast while the batch is small)
        reach the anti-join."""
        first = first_per_key(batch, key, order)
        tags = [r[0] for r in batch.select(self.tag).distinct().collect()]        # as many as staged files in the batch
        held = self.rows(tags).select(key).join(first.select(key), key, "left_semi")
        return first.join(held, key, "left_anti")

    def publish(self, batch_id: int, batch: DataFrame, key: str, order: list, ledger: DataFrame | None = None,
                rejected: DataFrame | None = None, fail_after: str | None = None) -> bool:
        """Publishes a batch once; False when it had been published.  ``fail_after`` (for tests) stops
        after that step."""
        if self.manifests().where(F.col("batch") == batch_id).head(1):
            return False
        attempt = f"{batch_id}-{uuid.uuid4().hex[:12]}"

        def step(name: str) -> None:
            if fail_after == name:
                raise RuntimeError(f"stopped after {name}")

        rows = self.new_rows(batch, key, order).select(*self.schema.names)
        rows.write.partitionBy(self.tag).parquet(f"{self.root}/data/attempt={attempt}")
        step("data")
        if rejected is not None:
            rejected.write.parquet(f"{self.root}/rejected/attempt={attempt}")
            step("rejected")
        if ledger is not None:
            ledger.write.parquet(f"{self.root}/ledger/attempt={attempt}")
            step("ledger")
        written = (self.spark.read.schema(self.schema).option("basePath", f"{self.root}/data")
                   .parquet(f"{self.root}/data/attempt={attempt}"))
        row = written.agg(F.collect_set(self.tag).alias("tags"), F.count(F.lit(1)).alias("n")).first()
        line = json.dumps({"attempt": attempt, "tags": sorted(row["tags"]), "n_rows": row["n"]})
        # one file, which appears whole when its writer commits; what a cut-short writer left is replaced
        self.spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(
            f"{self.root}/manifests/batch={batch_id}")
        return True

    def side_rows(self, part: str, schema: T.StructType) -> DataFrame:
        """Published rows of ``rejected`` or ``ledger``."""
        return self._published(part, schema, [r[0] for r in self.manifests().select("attempt").collect()])


def move_files(spark: SparkSession, ledger: DataFrame, file_col: str, completed: str, error: str) -> int:
    """Moves the ledger's staged files to ``completed`` or ``error`` by their status; files that are gone (moved
    before) are left.  The ledger of a batch has a row for each of its files."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    moved = 0
    for r in ledger.select(file_col, "status").distinct().collect():
        src, folder = path(r[0]), path(completed if r["status"] == "completed" else error)
        fs = src.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(src):
            fs.mkdirs(folder)
            moved += bool(fs.rename(src, path(folder, src.getName())))
    return moved
