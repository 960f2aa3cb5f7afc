"""Comment aggregation: top-n comments per post, then six per-post features.

Scale notes
* ``top_n`` is ``row_number() <= n`` over a window; Catalyst rewrites it into
  a partial ``WindowGroupLimit`` before the shuffle and a final one after, so
  even a post holding a third of all comments ships at most n rows per map
  task.
* The feature aggregation is a plain ``groupBy`` (partial + final aggregate),
  so a hot post is pre-aggregated map-side.
* Posts without comments are kept by a left join on the per-post result (one
  row per post on each side: no fan-out)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.normalise import age_seconds, rate
from ..util import col_of

FEATURES = ["avg_up_rate", "var_up_rate", "gild_rate", "distinguished_rate",
            "op_comment_rate", "premium_auth_rate"]

# Distinguished kinds that count as an official comment.
OFFICIAL_KINDS = ["moderator", "admin"]


def top_n(df: DataFrame, key: str | list, order: list, n: int = 15,
          rank_col: str | None = None) -> DataFrame:
    """First ``n`` rows per key by ``order``.  Give ``order`` enough columns to
    be a total order, otherwise ties are cut arbitrarily."""
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*[col_of(c) for c in order])
    r = rank_col or "__rn"
    out = df.withColumn(r, F.row_number().over(w)).where(F.col(r) <= n)
    return out if rank_col else out.drop(r)


def comment_defaults(df: DataFrame, ups="ups", gilded="gilded", distinguished="distinguished",
                     is_submitter="is_submitter", author_premium="author_premium") -> DataFrame:
    """Missing or null values -> 0; distinguished moderator/admin -> 1, any
    other kind -> 0; booleans -> 0/1."""
    def flag(c):
        return F.coalesce(col_of(c).cast("int"), F.lit(0))
    return df.withColumns({
        "ups": F.coalesce(col_of(ups).cast("int"), F.lit(0)),
        "gilded": F.coalesce(col_of(gilded).cast("int"), F.lit(0)),
        "distinguished": F.when(col_of(distinguished).isin(*OFFICIAL_KINDS), F.lit(1)).otherwise(F.lit(0)),
        "is_submitter": flag(is_submitter),
        "author_premium": flag(author_premium),
    })


def rate_stats(df: DataFrame, key: str, ups: str = "ups", age: str = "age_s") -> list:
    """Aggregate expressions: mean and population variance of ups/age."""
    r = rate(ups, age)
    return [F.avg(r).alias("avg_up_rate"), F.var_pop(r).alias("var_up_rate")]


def share_stats(cols: dict[str, str]) -> list:
    """Aggregate expressions: sum(col)/n for each col (a count may exceed 1)."""
    return [F.avg(F.col(c).cast("double")).alias(out) for out, c in cols.items()]


def comment_features(comments: DataFrame, key: str, created: str, asof, n: int = 15,
                     order: list | None = None) -> DataFrame:
    """Per post: the six features over its top-``n`` comments by upvotes.

    ``comments`` must already be through ``comment_defaults``.  Rows without
    a creation time are not comments and are dropped first."""
    c = comments.where(F.col(created).isNotNull())
    order = order or [F.col("ups").desc()]
    c = top_n(c, key, order, n)
    c = c.withColumn("age_s", age_seconds(created, asof))
    return c.groupBy(key).agg(
        *rate_stats(c, key),
        *share_stats({"gild_rate": "gilded", "distinguished_rate": "distinguished",
                      "op_comment_rate": "is_submitter", "premium_auth_rate": "author_premium"}),
        F.count(F.lit(1)).alias("n_comments"),
    )


def fill_zero(posts: DataFrame, stats: DataFrame, key: str, post_key: str | None = None) -> DataFrame:
    """Attach the features to every post; posts without comments get 0."""
    post_key = post_key or key
    s = stats if post_key == key else stats.withColumnRenamed(key, post_key)
    j = posts.join(s, post_key, "left")
    fill = {f: F.coalesce(F.col(f), F.lit(0.0)) for f in FEATURES if f in s.columns}
    if "n_comments" in s.columns:
        fill["n_comments"] = F.coalesce(F.col("n_comments"), F.lit(0)).cast("long")
    return j.withColumns(fill)


def merge_post_comment_feats(posts: DataFrame, stats: DataFrame, key: str) -> DataFrame:
    """Equi join on the post id (one row per post on each side)."""
    return posts.join(stats, key, "inner")


def drop_awarded(df: DataFrame, gold: str = "gold", platinum: str = "platinum") -> DataFrame:
    """Drop posts that already hold gold or platinum at snapshot time
    (silver is ignored)."""
    return df.where((F.coalesce(F.col(gold), F.lit(0)) + F.coalesce(F.col(platinum), F.lit(0))) == 0)
