"""Preparation: constant-column detection, drops, group exclusion and the
``Prep`` estimator that adds label and calendar features.

``constant_columns`` is one aggregate over all columns (min, max, non-null
count, row count per column) - a single pass with map-side partial
aggregation, cheaper than ``count_distinct`` per column."""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.normalise import label_positive, scrape_hhmm

_ORDERABLE = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType,
              T.TimestampNTZType, T.BinaryType)

# Columns the source always drops before modelling (fixed values).
DEFAULT_DROPS = ["created_utc", "gold_awarded", "platinum_awarded", "scrape_time"]


def constant_column_flags(df: DataFrame, exclude: list[str] | None = None) -> DataFrame:
    """One row per column: ``column``, ``is_constant``.  A column is constant
    when it holds exactly one distinct value, null counting as a value:
    (min == max and no nulls) or all null.  Columns of unorderable types
    (arrays, maps, vectors) are skipped, as in the source."""
    exclude = set(exclude or [])
    cols = [f.name for f in df.schema.fields
            if f.name not in exclude and isinstance(f.dataType, _ORDERABLE)]
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`")
        aggs += [F.min(x).cast("string").alias(f"mn{i}"), F.max(x).cast("string").alias(f"mx{i}"),
                 F.count(x).alias(f"nn{i}")]
    row = df.agg(*aggs)
    flags = [
        F.struct(F.lit(c).alias("column"),
                 (((F.col(f"mn{i}") == F.col(f"mx{i}")) & (F.col(f"nn{i}") == F.col("__n")))
                  | (F.col(f"nn{i}") == 0)).alias("is_constant"))
        for i, c in enumerate(cols)]
    return row.select(F.explode(F.array(*flags)).alias("f")).select("f.column", "f.is_constant")


def constant_columns(df: DataFrame, exclude: list[str] | None = None) -> list[str]:
    """Names of constant columns (a list with one entry per column: small)."""
    return [r["column"] for r in constant_column_flags(df, exclude).where("is_constant").collect()]


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop the listed columns; names that are not there are ignored."""
    return df.drop(*cols)


def exclude_groups(df: DataFrame, col: str, values: list) -> DataFrame:
    """Remove rows whose ``col`` is one of ``values``; null rows are kept."""
    return df.where(~F.coalesce(F.col(col).isin(list(values)), F.lit(False)))


class Prep(Estimator):
    """fit: learn the columns to drop (defaults + ``drop_feats`` + constant
    columns, never the label).  transform: add ``gilded`` (gold + platinum >
    0), ``weekday`` (Mon=0), ``post_hour`` (UTC) and ``scrape_time`` (last
    four characters of the id), drop the learned columns and the rows of
    ``drop_groups``.  ``drop_feats=False`` disables all column drops."""

    def __init__(self, drop_feats: list[str] | bool = (), drop_groups: list[str] | None = ("blog",),
                 group_col: str = "subreddit", created: str = "created_utc", id_col: str = "id",
                 gold: str = "gold_awarded", platinum: str = "platinum_awarded", label: str = "gilded"):
        super().__init__()
        self.drop_disabled = drop_feats is False
        self.drop_feats = [] if self.drop_disabled else list(drop_feats)
        self.drop_groups = list(drop_groups or [])
        self.group_col, self.created, self.id_col = group_col, created, id_col
        self.gold, self.platinum, self.label = gold, platinum, label

    def _add(self, df: DataFrame) -> DataFrame:
        ts = F.col(self.created)
        if isinstance(df.schema[self.created].dataType, T.NumericType):
            ts = F.timestamp_seconds(ts)
        return df.withColumns({
            self.label: label_positive(self.gold, self.platinum),
            "weekday": F.weekday(ts),
            "post_hour": F.hour(ts),
            "scrape_time": scrape_hhmm(self.id_col),
        })

    def _fit(self, df: DataFrame) -> "PrepModel":
        drops: list[str] = []
        if not self.drop_disabled:
            drops = DEFAULT_DROPS + self.drop_feats
            drops += [c for c in constant_columns(self._add(df), exclude=[self.label]) if c not in drops]
        return PrepModel(drops, self)


class PrepModel(Model):
    def __init__(self, drops: list[str], prep: Prep):
        super().__init__()
        self.drops = drops
        self.prep = prep

    def _transform(self, df: DataFrame) -> DataFrame:
        out = self.prep._add(df)
        if self.prep.drop_groups and self.prep.group_col in out.columns:
            out = exclude_groups(out, self.prep.group_col, self.prep.drop_groups)
        return drop_columns(out, self.drops)
