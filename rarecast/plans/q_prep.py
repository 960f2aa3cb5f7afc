"""Registered queries: preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.normalise import scrape_tag
from ..operators import prep as PR
from ..util import epoch_seconds
from .fixtures import POSTS_SQL, docs_labeled, posts, round_doubles, table
from .registry import register

_LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate", "flag", "empty"]
_LI_SQL = "(SELECT *, 'x' AS flag, CAST(NULL AS VARCHAR) AS empty FROM lineitem)"


def _const_sql() -> str:
    parts = [f"SELECT '{c}' AS column_name, count(DISTINCT {c}) + CAST(count(*) > count({c}) AS INTEGER) AS k "
             f"FROM {_LI_SQL}" for c in _LI_COLS]
    return "SELECT column_name FROM (" + " UNION ALL ".join(parts) + ") WHERE k = 1"


@register("constant_columns", _const_sql())
def constant_columns(spark, sf):
    li = table(spark, sf, "lineitem").withColumns({"flag": F.lit("x"), "empty": F.lit(None).cast("string")})
    return PR.constant_column_flags(li).where("is_constant").select(F.col("column").alias("column_name"))


@register("drop_columns", "SELECT l_orderkey, l_partkey, l_linenumber, l_quantity FROM lineitem")
def drop_columns(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
                                             "l_tax", "l_discount")
    return round_doubles(PR.drop_columns(li, ["l_tax", "l_discount", "l_comment"]))


@register("exclude_groups", """
SELECT doc_id, source FROM (SELECT doc_id, nullif(source, 'src1') AS source FROM documents)
WHERE source IS NULL OR source <> 'src0'""")
def exclude_groups(spark, sf):
    d = table(spark, sf, "documents").select(
        "doc_id", F.when(F.col("source") != "src1", F.col("source")).alias("source"))
    return PR.exclude_groups(d, "source", ["src0"])


def selected_posts(spark, sf):
    """orders shaped like the model stage's selected frame."""
    p = posts(spark, sf)
    return p.select(
        "post_id", "community", "how", "ups",
        epoch_seconds("created").alias("created_utc"),
        F.concat(F.col("post_id").cast("string"), F.lit("_"), scrape_tag("how", "created")).alias("id"),
        F.col("gold").alias("gold_awarded"), F.col("platinum").alias("platinum_awarded"),
        F.lit(False).alias("contest_mode"),
    )


@register("prep", f"""
SELECT post_id, community, how, CAST(post_id AS VARCHAR) || '_' || how || strftime(created, '%m%d%H%M') AS id,
  gold + platinum > 0 AS gilded, CAST(isodow(created) - 1 AS INTEGER) AS weekday
FROM {POSTS_SQL} WHERE community <> '5-LOW'""")
def prep(spark, sf):
    df = selected_posts(spark, sf)
    model = PR.Prep(drop_feats=["ups"], drop_groups=["5-LOW"], group_col="community").fit(df)
    return model.transform(df)
