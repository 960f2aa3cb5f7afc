"""Helpers shared by the text operators: reading, intermediate tables, ASCII folding."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path

# The separator class and the ASCII letters that are folded.
WHITESPACE = " \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared work folder and read it back: later steps start from files
    that every executor can read, and losing an executor does not recompute what is above."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold_ascii(text: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` on pure ASCII rows (cheap), ``translate`` elsewhere."""
    return (F.when(F.octet_length(text) == F.char_length(text), F.lower(text))
            .otherwise(F.translate(text, UPPER, LOWER)))


def crc_mod(id_col: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n`` (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % n


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, training: Column, rows: int,
                    seed: int = 17, extra: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, label, text, *extra columns) of at most ``rows`` labelled documents, chosen by the hash of the id among
    those for which ``training`` (on doc_id) holds.  An id labelled twice takes the larger label; ids
    or labels that are null are left out; of documents that share an id one is taken."""
    picked = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(target).cast("int").alias("label"))
              .filter(training & F.col("doc_id").isNotNull() & F.col("label").isNotNull())
              .groupBy("doc_id").agg(F.max("label").alias("label"))
              .orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(rows))
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *extra)
            .join(F.broadcast(picked), "doc_id")       # at most ``rows`` ids
            .dropDuplicates(["doc_id"]).select("doc_id", "label", "text", *extra))


def logistic_1d(x, y, steps: int = 50):
    """Slope and intercept of a one-variable logistic fit with a weak prior (Newton steps)."""
    a = np.array([0.0, 1.0])
    z = np.stack([np.ones(len(x)), x], 1)
    ridge = np.diag([1e-6, 1e-3])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ a, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge + 1e-9 * np.eye(2), z.T @ (y - p) - ridge @ a)
        a = a + np.clip(step, -4, 4)
    return a


def most_frequent(table: DataFrame, token: str, count: str, limit: int):
    """Sorted hashes and counts of the most frequent tokens: all above the lowest count, on a fine
    logarithmic scale, that keeps them within ``limit`` rows."""
    step = F.floor(F.log2(count) * 16).cast("int")
    low, room = 0, limit
    for s, n in sorted(table.groupBy(step).count().collect(), reverse=True):
        if n > room:
            low = s + 1
            break
        room -= n
    t = table.filter(step >= low).select(token, count).toArrow()       # ``limit`` rows at most
    key = t[token].to_numpy().view(np.uint64)
    order = np.argsort(key)
    return key[order], t[count].to_numpy()[order].astype(np.int64)


class IdFilter:
    """Bitmap of hashed ids, ``max_bits`` at most: says of any id "maybe" or "certainly not" among ``ids``.
    Rows it rules out need no shuffle; what it lets through besides has to be told apart by a join."""

    def __init__(self, ids: DataFrame, max_bits: int = 1 << 27):
        (name,) = ids.columns
        ids = ids.distinct()
        self.bits = min(max_bits, max(1 << 15, 1 << (8 * ids.count()).bit_length()))
        slot = self.slot(name)
        flags = np.zeros(self.bits // 8, np.uint8)
        for r in (ids.groupBy(F.floor(slot / (1 << 15)).alias("part"))
                  .agg(F.bitmap_construct_agg(slot % (1 << 15)).alias("bits")).collect()):
            if r["part"] is not None:
                flags[r["part"] * 4096:(r["part"] + 1) * 4096] = np.frombuffer(r["bits"], np.uint8)
        self.held = ids.sparkSession.sparkContext.broadcast(flags)

    def slot(self, name: str) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(self.bits))

    def column(self, name: str) -> Column:
        """Whether the id may be among those of the bitmap."""
        held = self.held

        @F.pandas_udf("boolean")
        def maybe(s: pd.Series) -> pd.Series:
            x = s.to_numpy()
            return pd.Series((held.value[x >> 3] >> (x & 7).astype("uint8")) & 1 == 1)

        return maybe(self.slot(name))
