"""Corpus pipeline: toxicity, line dedup, near-duplicate removal, benchmark decontamination, mixing.

Each stage reads what its predecessor wrote and returns whole documents.  All but the last return the
columns of ``documents``; the mix adds ``copy``, the number of each emitted repetition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rarecast.llm import decontaminate, line_dedup, mixing, ngram_join, toxicity
from rarecast.llm.common import WHITESPACE, crc_mod, read_table, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the cutoff; learned without the held-out fold."""
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"), crc_mod(F.col("doc_id"), 4) != 2)
    return toxicity.drop_toxic(docs, model)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents stay in the first of them only; a document that this leaves without any
    text goes, one that had none before stays."""
    columns = docs.columns
    d = line_dedup.dedup_lines(docs, min_docs=10, keep_first=True)
    emptied = (F.col("n_dropped") > 0) & (F.btrim(F.col("text"), F.lit(WHITESPACE)) == "")
    changed = F.when(F.col("n_dropped") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
    return d.filter(~emptied).withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType)).select(*columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of links at five-word Jaccard 0.8 or more."""
    return ngram_join.keep_one_per_component(docs, width=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target takes it."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("source mixing", mix_sources),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
