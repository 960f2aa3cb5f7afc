"""Raw snapshot records -> rows of the declared posts table.

Composes the scalar normalisation functions: friendly names, nested names,
minute of day, age and rates at the scrape time, award counts, flags and
labels, then attaches comment features and the later outcome by post id and
conforms to ``schemas.POSTS_TABLE``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import normalise as N
from ..operators.comments import FEATURES, fill_zero
from .table import conform


def posts_table_rows(raw: DataFrame, file_col: str, scrape_ts, comment_feats: DataFrame | None = None,
                     outcomes: DataFrame | None = None) -> DataFrame:
    """``raw`` has the ``schemas.RAW_POST`` fields and the staged file name in
    ``file_col``; ``scrape_ts`` is the snapshot time (column or literal).
    ``comment_feats`` is one row per post id (``comment_features`` output),
    ``outcomes`` one row per post id (``outcome_fields`` output, key ``id``)."""
    created = F.timestamp_seconds(F.col("created_utc"))
    d = raw.select(
        "*",
        N.name_or_null("author.name").alias("__author"),
        N.name_or_null("subreddit.display_name").alias("__community"),
        N.minute_of_day(created).alias("__post_time"),
        (N.age_minutes(created, scrape_ts)).alias("__age"),
    )
    d = d.withColumns({
        "__up_rate": N.rate("ups", "__age"), "__comment_rate": N.rate("num_comments", "__age"),
        "__sid": N.snapshot_id("id", file_col), "__how": N.how_sorted(file_col)})
    awards = {name: N.award_count("gildings", key) for name, key in N.AWARD_KEYS.items()}
    out = d.select(
        F.col("title").alias("Title"), F.col("__author").alias("Author"), F.col("__sid").alias("ID"),
        F.col("gilded").alias("Gilded"), F.col("ups").alias("Upvotes"), F.col("upvote_ratio").alias("Upvote_ratio"),
        F.col("__post_time").alias("Post_time"), F.col("view_count").alias("Views"),
        F.col("discussion_type").alias("Discussion_type"), N.is_present("distinguished").alias("Distinguished"),
        F.col("contest_mode").alias("Contest_mode"),
        N.first_or_label("content_categories").alias("Content_categories"),
        N.edited_flag("edited").alias("Edited"), F.col("hidden").alias("Hidden"),
        F.col("is_crosspostable").alias("Crosspostable"), F.col("num_crossposts").alias("Crossposts"),
        F.col("is_meta").alias("Meta"), F.col("is_original_content").alias("OC"),
        F.col("is_reddit_media_domain").alias("Reddit_media"), F.col("is_robot_indexable").alias("Robot_indexable"),
        F.col("is_self").alias("Selfpost"), F.col("is_video").alias("Video"),
        N.int_or_flag("likes").alias("Likes"), F.col("num_comments").alias("Comments"),
        F.col("over_18").alias("Adult_content"), N.or_label("__community").alias("Subreddit"),
        F.col("created_utc").alias("Created_utc"), F.col("__age").alias("Post_age"),
        F.col("__up_rate").alias("Upvote_rate"), F.col("__comment_rate").alias("Comment_rate"),
        F.col("__how").alias("How_sorted"),
        awards["silver"].alias("Initial_silver"), awards["gold"].alias("Initial_gold"),
        awards["platinum"].alias("Initial_platinum"), F.col("id").alias("__post"),
    )
    if comment_feats is not None:
        out = fill_zero(out, comment_feats.select("post_id", *FEATURES), "post_id", post_key="__post")
        out = out.withColumnRenamed("var_up_rate", "std_up_rate")   # the table's name for it
    if outcomes is not None:
        o = outcomes.select(F.col(outcomes.columns[0]).alias("__post"), *[
            F.col(c).alias(c[0].upper() + c[1:]) for c in outcomes.columns[1:]])
        out = out.join(o, "__post", "left")
    return conform(out, schemas.POSTS_TABLE)


def scrape_time_of(file_col: str, year: int):
    """Scrape timestamp from a staged file name (the name has no year)."""
    p = F.col(file_col)
    s = F.concat(F.lit(str(year)), F.lit("-"), F.regexp_extract(p, N.STAGED_NAME_RE, 2), F.lit("-"),
                 F.regexp_extract(p, N.STAGED_NAME_RE, 3), F.lit(" "), F.regexp_extract(p, N.STAGED_NAME_RE, 4))
    return F.to_timestamp(s, "yyyy-MM-dd HHmm")

