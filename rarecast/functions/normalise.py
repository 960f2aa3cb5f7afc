"""Scalar snapshot normalisation (one row in, one value out).

All of these are Column expressions built from ``pyspark.sql.functions`` so
they stay inside whole-stage codegen; none needs a UDF."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..util import col_of, epoch_seconds

# Fixed values that must match the source system's conventions.
# Award keys in the gildings map: silver, gold, platinum.
AWARD_KEYS = {"silver": "gid_1", "gold": "gid_2", "platinum": "gid_3"}
# Category label used for a missing value.
NONE_LABEL = "None"
# Staged file name pattern: <dir>/gilded_data_sortedby_<how>_MM-DD_at_HHMMutc.<ext>
STAGED_NAME_RE = r"sortedby_([\w\s]+?)_(\d\d)-(\d\d)_at_(\d\d\d\d)utc"
HOW_SORTED_RE = r"sortedby_([\w\s]+)_"


def name_or_null(c) -> Column:
    """Name held in a nested object (``author.name``, ``subreddit.display_name``),
    null when the object is absent.  Struct field access is null-safe."""
    return col_of(c)


def minute_of_day(ts) -> Column:
    """UTC hour*60 + minute of the posting time."""
    t = col_of(ts)
    return F.hour(t) * 60 + F.minute(t)


def age_minutes(ts, asof) -> Column:
    """(snapshot time - created) in fractional minutes.  ``asof`` is a column
    or literal timestamp, never the wall clock, so reruns agree."""
    return (epoch_seconds(asof) - epoch_seconds(ts)) / F.lit(60.0)


def age_seconds(ts, asof) -> Column:
    """(snapshot time - created) in seconds (comment ages use seconds)."""
    return epoch_seconds(asof) - epoch_seconds(ts)


def rate(count, age) -> Column:
    """count / age; age 0 (or null) gives null instead of an error."""
    return F.try_divide(col_of(count).cast("double"), col_of(age).cast("double"))


def rates(df: DataFrame, ups: str, comments: str, age: str,
          ups_out: str = "upvote_rate", comments_out: str = "comment_rate") -> DataFrame:
    """Upvotes per minute and comments per minute of post age."""
    return df.withColumns({ups_out: rate(ups, age), comments_out: rate(comments, age)})


def normalise_names(df: DataFrame) -> DataFrame:
    """Whitespace runs in column names become ``_``."""
    return df.toDF(*[re.sub(r"\s+", "_", c) for c in df.columns])


def how_sorted(path) -> Column:
    """Sort mode from a staged file name (``..._sortedby_new_...`` -> ``new``)."""
    return F.regexp_extract(col_of(path), HOW_SORTED_RE, 1)


def snapshot_id(post_id, path) -> Column:
    """``<id>_<how><MM><DD><HHMM>`` from the staged file name.  The label has
    no year (it repeats yearly); keep ``scrape_ts`` beside it when needed."""
    p = col_of(path)
    return F.concat(col_of(post_id), F.lit("_"),
                    F.regexp_extract(p, STAGED_NAME_RE, 1),
                    F.regexp_extract(p, STAGED_NAME_RE, 2),
                    F.regexp_extract(p, STAGED_NAME_RE, 3),
                    F.regexp_extract(p, STAGED_NAME_RE, 4))


def scrape_tag(how, ts) -> Column:
    """Snapshot label ``how + MMddHHmm`` (UTC)."""
    return F.concat(col_of(how), F.date_format(col_of(ts), "MMddHHmm"))


def staged_file_name(how, ts, folder: str = "staging") -> Column:
    """Name of the staged file a scrape writes."""
    t = col_of(ts)
    return F.concat(F.lit(f"{folder}/gilded_data_sortedby_"), col_of(how), F.lit("_"),
                    F.date_format(t, "MM-dd"), F.lit("_at_"), F.date_format(t, "HHmm"),
                    F.lit("utc.pkl"))


def award_count(awards, key: str) -> Column:
    """Count for one award key of a map; a missing key or map gives 0."""
    return F.coalesce(F.try_element_at(col_of(awards), F.lit(key)), F.lit(0)).cast("int")


def unpack_awards(df: DataFrame, awards: str, prefix: str = "",
                  keys: dict[str, str] | None = None) -> DataFrame:
    """Award map -> one int column per award (silver, gold, platinum)."""
    keys = keys or AWARD_KEYS
    return df.withColumns({f"{prefix}{name}": award_count(awards, k) for name, k in keys.items()})


def int_or_flag(c) -> Column:
    """null -> 0; a number -> its integer part; integer text -> that integer; anything else -> -1."""
    x = col_of(c)
    number = F.typeof(x).rlike("^(tinyint|smallint|int|bigint|float|double|decimal.*)$")
    s = F.trim(x.cast("string"))
    return (F.when(x.isNull(), F.lit(0))
            .when(number, F.coalesce(x.cast("string").try_cast("double").try_cast("int"), F.lit(-1)))
            .when(s.rlike(r"^[+-]?\d+$"), F.coalesce(s.try_cast("int"), F.lit(-1)))
            .otherwise(F.lit(-1)))


def is_present(c) -> Column:
    return col_of(c).isNotNull()


def or_label(c, label: str = NONE_LABEL) -> Column:
    return F.coalesce(col_of(c).cast("string"), F.lit(label))


def first_or_label(arr, label: str = NONE_LABEL) -> Column:
    """First list element, ``'None'`` for a null or empty list."""
    return F.coalesce(F.get(col_of(arr), 0), F.lit(label))


def edited_flag(raw) -> Column:
    """``False``/0 -> false; an edit timestamp -> true; null -> true
    (the source compares ``value != False``, which holds for None)."""
    s = F.lower(F.trim(col_of(raw).cast("string")))
    return F.when(s.isin("false", "0", "0.0"), F.lit(False)).otherwise(F.lit(True))


def cast_cols(df: DataFrame, cols: list[str], to: str = "double") -> DataFrame:
    return df.withColumns({c: F.col(c).cast(to) for c in cols})


def label_positive(*count_cols) -> Column:
    """Target: gold + platinum > 0 (silver is not part of it)."""
    total = col_of(count_cols[0])
    for c in count_cols[1:]:
        total = total + col_of(c)
    return total > 0


def weekday(ts) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(col_of(ts))


def calendar_parts(df: DataFrame, ts: str, weekday_out: str = "weekday",
                   hour_out: str = "post_hour") -> DataFrame:
    return df.withColumns({weekday_out: weekday(ts), hour_out: F.hour(F.col(ts))})


def scrape_hhmm(snapshot_id_col) -> Column:
    """Last four characters of the snapshot id: the scrape time HHMM."""
    return F.right(col_of(snapshot_id_col), F.lit(4))


def scrape_tag_of(snapshot_id_col) -> Column:
    """Tag part of a snapshot id (after the first ``_``)."""
    return F.regexp_extract(col_of(snapshot_id_col), r"_(.*)$", 1)
