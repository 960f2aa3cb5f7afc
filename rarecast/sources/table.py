"""The posts table: conform to a declared schema, route whole files to
completed/error, append first-wins by key, read back by scrape tag.

Routing is all-or-nothing per file: the rules are evaluated for every row
before anything is written, and the list of failing files (one row each) is
joined back.  ``append_first_wins`` keeps the first
row per key inside the batch and drops keys already in the target (left-anti
join), so replaying a batch is a no-op."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..util import col_of, union_all


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order, each ``try_cast`` to its type;
    columns missing from ``df`` become NULL; extra columns are dropped."""
    have = set(df.columns)
    out = []
    for f in schema.fields:
        if f.name in have:
            out.append(F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*out)


VERDICT = "array<struct<column: string, rule: string, value: string>>"


def with_verdicts(df: DataFrame, schema: T.StructType, key: str | None = None, max_length: dict[str, int] | None = None,
                  out: str = "verdicts", keep: list[str] = ()) -> DataFrame:
    """``conform`` that tells what it refused: the typed columns, ``keep`` columns as they are, and ``out``, an array
    of (column, rule, raw value) in the order of the columns: ``cast`` for a value that its type cannot hold
    (NULL in the typed row), ``length`` for text above ``max_length``, ``null_key`` for a missing or uncastable key."""
    have, limits, typed, found = set(df.columns), dict(max_length or {}), [], []

    def say(when: Column, name: str, rule: str, value: Column) -> Column:
        return F.when(when, F.struct(F.lit(name).alias("column"), F.lit(rule).alias("rule"), value.cast("string").alias("value")))

    for f in schema.fields:
        raw = F.col(f"`{f.name}`") if f.name in have else F.lit(None)
        value = raw.try_cast(f.dataType) if f.name in have else raw.cast(f.dataType)
        typed.append(value.alias(f.name))
        found.append(say(raw.isNotNull() & value.isNull(), f.name, "cast", raw))
        if f.name in limits:
            found.append(say(F.char_length(value) > limits[f.name], f.name, "length", raw))
        if f.name == key:
            found.append(say(value.isNull(), f.name, "null_key", raw))
    return df.select(*keep, *typed, F.array_compact(F.array(*found)).cast(VERDICT).alias(out))


def route_files(df: DataFrame, file_col: str, bad_row: Column) -> DataFrame:
    """Adds ``row_bad`` and ``route`` ('completed' / 'error'): a file with any
    failing row goes to error as a whole.  ``bad_row`` is a boolean rule; a
    null verdict counts as failing."""
    d = df.withColumn("row_bad", F.coalesce(bad_row, F.lit(True)))
    failed = d.where("row_bad").select(file_col).distinct().withColumn("__file_bad", F.lit(True))
    return (d.join(failed, file_col, "left")
            .withColumn("route", F.when(F.col("__file_bad"), F.lit("error")).otherwise(F.lit("completed")))
            .drop("__file_bad"))


def split_routes(routed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows) of a ``route_files`` result."""
    return (routed.where(F.col("route") == "completed"), routed.where(F.col("route") == "error"))


def load_ledger(routed: DataFrame, file_col: str) -> DataFrame:
    """One row per file: status, rows, failing rows."""
    return routed.groupBy(file_col).agg(
        F.first("route").alias("status"),
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col("row_bad").cast("long")).alias("n_bad_rows"))


def first_per_key(batch: DataFrame, key: str | list, order: list) -> DataFrame:
    """First row per key inside a batch by ascending ``order`` (column names;
    the remaining columns break ties, so the pick is deterministic).

    An aggregate (``min_by`` over a struct of the row), not a window: partial
    aggregation keeps one row per key on each map task, so a key holding a
    large share of the batch is reduced before the shuffle."""
    keys = [key] if isinstance(key, str) else list(key)
    cols = [c for c in batch.columns if c not in keys]
    orderable = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    rest = [f.name for f in batch.schema.fields
            if f.name in cols and f.name not in order and isinstance(f.dataType, orderable)]
    row = F.struct(*[F.col(f"`{c}`") for c in cols])
    rank = F.struct(*[col_of(c) for c in order], *[F.col(f"`{c}`") for c in rest])
    first = batch.groupBy(*keys).agg(F.min_by(row, rank).alias("__row"))
    return first.select(*keys, *[F.col(f"__row.`{c}`").alias(c) for c in cols]).select(*batch.columns)


def new_rows(target: DataFrame, batch: DataFrame, key: str | list, order: list) -> DataFrame:
    """Rows of ``batch`` to insert: first per key, keys absent from target."""
    keys = [key] if isinstance(key, str) else list(key)
    first = first_per_key(batch, keys, order)
    return first.join(target.select(*keys).distinct(), keys, "left_anti")


def append_first_wins(target: DataFrame, batch: DataFrame, key: str | list, order: list) -> DataFrame:
    """``INSERT ... ON CONFLICT (key) DO NOTHING`` as a DataFrame: the target
    plus new keys of the batch."""
    return target.unionByName(new_rows(target, batch, key, order).select(*target.columns))


def scrape_tags(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Distinct snapshot labels (the part of the id after ``_``)."""
    return df.select(F.regexp_extract(F.col(id_col), r"_(.*)$", 1).alias("scrape_tag")).distinct()


def read_by_tags(df: DataFrame, tags, cols: list[str] | None = None,
                 tag_col: str = "scrape_tag") -> DataFrame:
    """Rows whose tag is in ``tags`` (a Python list -> ``isin``, which prunes
    partitions when the table is partitioned by the tag; or a DataFrame of
    tags -> left-semi join)."""
    sel = df.select(*(cols or df.columns), *([tag_col] if cols and tag_col not in cols else []))
    if isinstance(tags, DataFrame):
        return sel.join(tags.select(tag_col).distinct(), tag_col, "left_semi")
    return sel.where(F.col(tag_col).isin(list(tags)))


def union_blocks(frames: list[DataFrame]) -> DataFrame:
    """Bag union (no de-duplication) of per-block reads."""
    return union_all(frames)


def materialise_snapshot(df: DataFrame, path: str, day: str, fmt: str = "parquet") -> DataFrame:
    """Write ``df`` once under ``path/day=<day>`` and return the stored copy.  A copy
    whose writer finished (it left ``_SUCCESS``) is kept; one that was cut short is
    written anew.  Also cuts the lineage of an expensive extract."""
    spark = df.sparkSession
    target = f"{path.rstrip('/')}/day={day}"
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        df.write.mode("overwrite").format(fmt).save(target)
    return spark.read.format(fmt).load(target)
