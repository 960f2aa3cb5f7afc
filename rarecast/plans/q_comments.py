"""Registered queries: comment aggregation (orders = posts, lineitems = comments)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.normalise import label_positive
from ..operators import comments as C
from ..operators.profile import ratio_by
from .fixtures import (ASOF_SQL, COMMENT_ORDER_SQL, COMMENTS_SQL, POSTS_SQL, asof_lit,
                       comment_order, posts, raw_comments, round_doubles)
from .registry import register

N_TOP = 3  # lineitems per order are 1..7, so n=3 makes the cut matter


def _comments(spark, sf):
    return C.comment_defaults(raw_comments(spark, sf))


def _features(spark, sf):
    return C.comment_features(_comments(spark, sf), "post_id", "created", asof_lit(), N_TOP,
                              order=comment_order())


_TOP_SQL = f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY {COMMENT_ORDER_SQL}) AS rn
  FROM {COMMENTS_SQL}) WHERE rn <= {N_TOP})"""
_AGE_SQL = f"(epoch({ASOF_SQL}) - epoch(created))"
_FEATS_SQL = f"""(SELECT post_id,
  avg(ups / {_AGE_SQL}) AS avg_up_rate, var_pop(ups / {_AGE_SQL}) AS var_up_rate,
  avg(CAST(gilded AS DOUBLE)) AS gild_rate, avg(CAST(distinguished AS DOUBLE)) AS distinguished_rate,
  avg(CAST(is_submitter AS DOUBLE)) AS op_comment_rate, avg(CAST(author_premium AS DOUBLE)) AS premium_auth_rate,
  count(*) AS n_comments
  FROM {_TOP_SQL} GROUP BY post_id)"""


def comment_feature_report(spark, sf):
    """Flagship: top-n comments -> six features -> zero-filled posts -> label ->
    positive share and mean features per community."""
    p = posts(spark, sf).withColumn("label", label_positive("gold", "platinum"))
    feats = C.fill_zero(p, _features(spark, sf), "post_id")
    # Report columns are counts and means of integers: the same in any engine
    # and summation order (means of per-post ratios can sit on a rounding tie).
    rep = ratio_by(feats, "community", "label", extra=[
        F.avg("n_comments").alias("mean_n_comments"),
        F.sum((F.col("gild_rate") > 0).cast("long")).alias("n_gilded_posts"),
        F.sum((F.col("distinguished_rate") > 0).cast("long")).alias("n_official_posts"),
        F.sum((F.col("n_comments") == 0).cast("long")).alias("n_zero_comment"),
    ])
    return round_doubles(rep)


register("comment_feature_report", f"""
SELECT community, CAST(count(*) AS BIGINT) AS n_posts,
  CAST(sum(CAST(label AS INTEGER)) AS BIGINT) AS n_positive,
  round(avg(CAST(label AS DOUBLE)), 6) AS positive_ratio,
  round(avg(coalesce(f.n_comments, 0)), 6) AS mean_n_comments,
  CAST(sum(CASE WHEN f.gild_rate > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_gilded_posts,
  CAST(sum(CASE WHEN f.distinguished_rate > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_official_posts,
  CAST(sum(CASE WHEN f.post_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_zero_comment
FROM (SELECT *, gold + platinum > 0 AS label FROM {POSTS_SQL}) p LEFT JOIN {_FEATS_SQL} f USING (post_id)
GROUP BY community""")(comment_feature_report)


@register("top_n_comments", f"""
SELECT post_id, CAST(rn AS INTEGER) AS rn, CAST(ups AS INTEGER) AS ups, l_partkey, l_linenumber FROM {_TOP_SQL}""")
def top_n_comments(spark, sf):
    c = C.top_n(_comments(spark, sf), "post_id", comment_order(), N_TOP, rank_col="rn")
    return round_doubles(c.select("post_id", "rn", "ups", "l_partkey", "l_linenumber"))


@register("comment_defaults", f"""
SELECT post_id, l_partkey, l_linenumber, CAST(ups AS INTEGER) AS ups, CAST(gilded AS INTEGER) AS gilded,
  distinguished, is_submitter, author_premium FROM {COMMENTS_SQL}""")
def comment_defaults(spark, sf):
    c = _comments(spark, sf)
    return c.select("post_id", "l_partkey", "l_linenumber", "ups", "gilded", "distinguished",
                    "is_submitter", "author_premium")


@register("comment_age_seconds", f"""
SELECT post_id, l_partkey, l_linenumber, round({_AGE_SQL}, 6) AS age_s FROM {COMMENTS_SQL}""")
def comment_age_seconds(spark, sf):
    from ..functions.normalise import age_seconds
    c = raw_comments(spark, sf)
    return round_doubles(c.select("post_id", "l_partkey", "l_linenumber",
                                  age_seconds("created", asof_lit()).alias("age_s")))


@register("comment_rate_stats", f"""
SELECT post_id, round(avg_up_rate, 6) AS avg_up_rate, round(var_up_rate, 6) AS var_up_rate,
  round(var_up_rate, 6) AS std_up_rate FROM {_FEATS_SQL}""")
def comment_rate_stats(spark, sf):
    f = _features(spark, sf)
    # The source names the population variance "std"; both names are given.
    return round_doubles(f.select("post_id", "avg_up_rate", "var_up_rate",
                                  F.col("var_up_rate").alias("std_up_rate")))


@register("comment_share_stats", f"""
SELECT post_id, round(gild_rate, 6) AS gild_rate, round(distinguished_rate, 6) AS distinguished_rate,
  round(op_comment_rate, 6) AS op_comment_rate, round(premium_auth_rate, 6) AS premium_auth_rate
FROM {_FEATS_SQL}""")
def comment_share_stats(spark, sf):
    f = _features(spark, sf)
    return round_doubles(f.select("post_id", "gild_rate", "distinguished_rate", "op_comment_rate",
                                  "premium_auth_rate"))


_FILLED_SQL = f"""
SELECT p.post_id, p.community,
  round(coalesce(f.avg_up_rate, 0), 6) AS avg_up_rate, round(coalesce(f.var_up_rate, 0), 6) AS var_up_rate,
  round(coalesce(f.gild_rate, 0), 6) AS gild_rate, round(coalesce(f.distinguished_rate, 0), 6) AS distinguished_rate,
  round(coalesce(f.op_comment_rate, 0), 6) AS op_comment_rate,
  round(coalesce(f.premium_auth_rate, 0), 6) AS premium_auth_rate,
  CAST(coalesce(f.n_comments, 0) AS BIGINT) AS n_comments
FROM {POSTS_SQL} p LEFT JOIN {_FEATS_SQL} f USING (post_id)"""


@register("zero_comment_posts", _FILLED_SQL)
def zero_comment_posts(spark, sf):
    p = posts(spark, sf).select("post_id", "community")
    return round_doubles(C.fill_zero(p, _features(spark, sf), "post_id"))


@register("merge_post_comment_feats", f"""
SELECT p.post_id, p.community, p.ups, round(f.avg_up_rate, 6) AS avg_up_rate, round(f.gild_rate, 6) AS gild_rate
FROM {POSTS_SQL} p JOIN {_FEATS_SQL} f USING (post_id)""")
def merge_post_comment_feats(spark, sf):
    p = posts(spark, sf).select("post_id", "community", "ups")
    f = _features(spark, sf).select("post_id", "avg_up_rate", "gild_rate")
    return round_doubles(C.merge_post_comment_feats(p, f, "post_id"))


@register("drop_already_awarded", f"""
SELECT post_id, community, gold, platinum FROM {POSTS_SQL} WHERE gold + platinum = 0""")
def drop_already_awarded(spark, sf):
    p = posts(spark, sf).select("post_id", "community", "gold", "platinum")
    return C.drop_awarded(p, "gold", "platinum")
