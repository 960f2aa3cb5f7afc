"""Declared schemas (never inferred).

Fixed values: the field names below are those of the source API records and
of the posts table; they must match the data as delivered."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, D, F32, B = T.StringType(), T.IntegerType(), T.DoubleType(), T.FloatType(), T.BooleanType()


def _st(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Raw post as delivered by the source API (subset used downstream).
RAW_POST = _st(
    ("title", S), ("author", _st(("name", S))), ("id", S), ("gilded", I),
    ("gildings", T.MapType(S, I)), ("ups", I), ("upvote_ratio", D), ("created_utc", D),
    ("view_count", I), ("discussion_type", S), ("distinguished", S), ("contest_mode", B),
    ("content_categories", T.ArrayType(S)), ("edited", S), ("hidden", B), ("is_crosspostable", B),
    ("num_crossposts", I), ("is_meta", B), ("is_original_content", B), ("is_reddit_media_domain", B),
    ("is_robot_indexable", B), ("is_self", B), ("is_video", B), ("likes", S), ("num_comments", I),
    ("over_18", B), ("subreddit", _st(("display_name", S))),
)

# Friendly name -> source field (fixed values of the source API).
POST_FIELDS = {
    "Title": "title", "Author": "author.name", "ID": "id", "Gilded": "gilded",
    "Gildings": "gildings", "Upvotes": "ups", "Upvote ratio": "upvote_ratio",
    "Post time": "created_utc", "Views": "view_count", "Discussion type": "discussion_type",
    "Distinguished": "distinguished", "Contest mode": "contest_mode",
    "Content categories": "content_categories", "Edited": "edited", "Hidden": "hidden",
    "Crosspostable": "is_crosspostable", "Crossposts": "num_crossposts", "Meta": "is_meta",
    "OC": "is_original_content", "Reddit media": "is_reddit_media_domain",
    "Robot indexable": "is_robot_indexable", "Selfpost": "is_self", "Video": "is_video",
    "Likes": "likes", "Comments": "num_comments", "Adult content": "over_18",
    "Subreddit": "subreddit.display_name",
}

RAW_COMMENT = _st(("post_id", S), ("created_utc", D), ("ups", I), ("gilded", I),
                  ("distinguished", S), ("is_submitter", B), ("author_premium", B))

COMMENT_FEATURES = _st(("post_id", S), ("avg_up_rate", D), ("var_up_rate", D), ("gild_rate", D),
                       ("distinguished_rate", D), ("op_comment_rate", D), ("premium_auth_rate", D))

OUTCOME = _st(("post_id", S), ("silver_awarded", I), ("gold_awarded", I), ("platinum_awarded", I),
              ("final_upvotes", I), ("final_num_comments", I))

# The 45-column posts table (primary key ID); fixed values, in the declared order.
POSTS_TABLE = _st(
    ("Title", S), ("Author", S), ("ID", S), ("Gilded", I), ("Upvotes", I), ("Upvote_ratio", F32),
    ("Post_time", I), ("Views", I), ("Discussion_type", S), ("Distinguished", B), ("Contest_mode", B),
    ("Content_categories", S), ("Edited", B), ("Hidden", B), ("Crosspostable", B), ("Crossposts", I),
    ("Meta", B), ("OC", B), ("Reddit_media", B), ("Robot_indexable", B), ("Selfpost", B), ("Video", B),
    ("Likes", I), ("Comments", I), ("Adult_content", B), ("Subreddit", S), ("Created_utc", D),
    ("Post_age", F32), ("Upvote_rate", F32), ("Comment_rate", F32), ("avg_up_rate", F32), ("std_up_rate", F32),
    ("gild_rate", F32), ("distinguished_rate", F32), ("op_comment_rate", F32), ("premium_auth_rate", F32),
    ("Silver_awarded", I), ("Gold_awarded", I), ("Platinum_awarded", I), ("How_sorted", S),
    ("Initial_silver", I), ("Initial_gold", I), ("Initial_platinum", I), ("Final_upvotes", I),
    ("Final_num_comments", I),
)

# Maximum string lengths of the table (validation rules).
POSTS_VARCHAR = {"Title": 301, "Author": 31, "ID": 30, "Discussion_type": 50,
                 "Content_categories": 50, "Subreddit": 50, "How_sorted": 15}

# Columns the model stage reads back.
SELECTED_COLUMNS = [
    "contest_mode", "edited", "adult_content", "oc", "content_categories", "reddit_media", "selfpost",
    "video", "subreddit", "how_sorted", "distinguished", "upvotes", "upvote_ratio", "crossposts",
    "comments", "post_age", "upvote_rate", "comment_rate", "avg_up_rate", "std_up_rate", "gild_rate",
    "distinguished_rate", "op_comment_rate", "premium_auth_rate", "initial_silver", "id", "created_utc",
    "gold_awarded", "platinum_awarded", "final_upvotes", "final_num_comments", "title",
]
