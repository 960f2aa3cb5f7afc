"""Registered queries: scalar snapshot normalisation on events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import normalise as N
from .fixtures import (EVENTS_ASOF_SQL, STAGED_EVENTS_SQL, epoch_sql, events, events_asof,
                       round_doubles, staged_events)
from .registry import register

_AGE_SQL = f"(({epoch_sql(EVENTS_ASOF_SQL)} - {epoch_sql('ts')}) / 60.0)"
_NULLED = "nullif(event_type, 'error')"


def _nulled():
    return F.when(F.col("event_type") != "error", F.col("event_type"))


def _awards():
    return F.from_json(F.col("props"), "map<string,int>")


@register("nested_name_or_null", """
SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS author_name FROM events""")
def nested_name_or_null(spark, sf):
    e = events(spark, sf)
    author = F.when(F.col("event_type") != "error", F.struct(F.col("user_id").cast("string").alias("name")))
    return e.withColumn("author", author).select("event_id", N.name_or_null("author.name").alias("author_name"))


@register("minute_of_day", "SELECT event_id, CAST(hour(ts) * 60 + minute(ts) AS INTEGER) AS post_time FROM events")
def minute_of_day(spark, sf):
    return events(spark, sf).select("event_id", N.minute_of_day("ts").alias("post_time"))


@register("post_age_minutes", f"SELECT event_id, round({_AGE_SQL}, 6) AS post_age FROM events")
def post_age_minutes(spark, sf):
    e = events(spark, sf)
    return round_doubles(e.select("event_id", N.age_minutes("ts", events_asof()).alias("post_age")))


@register("engagement_rates", f"""
SELECT event_id, round(value / {_AGE_SQL}, 6) AS upvote_rate, round(user_id / {_AGE_SQL}, 6) AS comment_rate
FROM events""")
def engagement_rates(spark, sf):
    e = events(spark, sf).withColumn("post_age", N.age_minutes("ts", events_asof()))
    return round_doubles(N.rates(e, "value", "user_id", "post_age").select("event_id", "upvote_rate", "comment_rate"))


@register("normalise_names", "SELECT event_id, user_id, event_type FROM events")
def normalise_names(spark, sf):
    e = events(spark, sf).select(F.col("event_id").alias("event id"), F.col("user_id").alias("user  id"),
                                 F.col("event_type").alias("event\ttype"))
    return N.normalise_names(e)


@register("how_sorted", f"""
SELECT event_id, regexp_extract(file_name, 'sortedby_([\\w\\s]+)_', 1) AS how_sorted FROM {STAGED_EVENTS_SQL}""")
def how_sorted(spark, sf):
    return staged_events(spark, sf).select("event_id", N.how_sorted("file_name").alias("how_sorted"))


@register("unique_snapshot_id", f"""
SELECT event_id, CAST(event_id AS VARCHAR) || '_' || how || strftime(ts, '%m%d%H%M') AS snapshot_id
FROM {STAGED_EVENTS_SQL}""")
def unique_snapshot_id(spark, sf):
    s = staged_events(spark, sf)
    return s.select("event_id", N.snapshot_id(F.col("event_id").cast("string"), "file_name").alias("snapshot_id"))


@register("unpack_awards", """
SELECT event_id, coalesce(CAST(json_extract_string(props, '$.z') AS INTEGER), 0) AS silver,
  coalesce(CAST(json_extract_string(props, '$.k') AS INTEGER), 0) AS gold,
  coalesce(CAST(json_extract_string(props, '$.z') AS INTEGER), 0) AS platinum FROM events""")
def unpack_awards(spark, sf):
    e = events(spark, sf).withColumn("awards", _awards())
    return N.unpack_awards(e, "awards", keys={"silver": "z", "gold": "k", "platinum": "z"}) \
        .select("event_id", "silver", "gold", "platinum")


_RAW_INT_SQL = f"""CASE WHEN event_type = 'error' THEN NULL
  WHEN event_type IN ('view', 'click') THEN ' ' || json_extract_string(props, '$.k') || ' '
  WHEN event_type = 'signup' THEN CAST(value AS VARCHAR) ELSE event_type END"""


@register("null_to_zero_int", f"""
SELECT event_id, CASE WHEN raw IS NULL THEN 0
  WHEN regexp_full_match(trim(raw), '[+-]?[0-9]+') THEN coalesce(TRY_CAST(trim(raw) AS INTEGER), -1)
  ELSE -1 END AS n
FROM (SELECT event_id, {_RAW_INT_SQL} AS raw FROM events)""")
def null_to_zero_int(spark, sf):
    e = events(spark, sf)
    raw = (F.when(F.col("event_type") == "error", F.lit(None))
           .when(F.col("event_type").isin("view", "click"),
                 F.concat(F.lit(" "), F.get_json_object("props", "$.k"), F.lit(" ")))
           .when(F.col("event_type") == "signup", F.col("value").cast("string"))
           .otherwise(F.col("event_type")))
    return e.select("event_id", N.int_or_flag(raw).alias("n"))


@register("null_to_bool", f"SELECT event_id, {_NULLED} IS NOT NULL AS present FROM events")
def null_to_bool(spark, sf):
    return events(spark, sf).select("event_id", N.is_present(_nulled()).alias("present"))


@register("null_to_label", f"SELECT event_id, coalesce({_NULLED}, 'None') AS category FROM events")
def null_to_label(spark, sf):
    return events(spark, sf).select("event_id", N.or_label(_nulled()).alias("category"))


@register("first_or_label", f"""
SELECT event_id, coalesce(string_split({_NULLED}, 'i')[1], 'None') AS category FROM events""")
def first_or_label(spark, sf):
    return events(spark, sf).select("event_id", N.first_or_label(F.split(_nulled(), "i")).alias("category"))


@register("edited_flag", """
SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN false WHEN event_type = 'error' THEN true
  WHEN value = 0 THEN false ELSE true END AS edited FROM events""")
def edited_flag(spark, sf):
    e = events(spark, sf)
    raw = (F.when(F.col("event_type") == "view", F.lit("False"))
           .when(F.col("event_type") == "click", F.lit("0"))
           .when(F.col("event_type") == "error", F.lit(None).cast("string"))
           .otherwise(F.col("value").cast("string")))
    return e.select("event_id", N.edited_flag(raw).alias("edited"))


@register("cast_rates", """
SELECT CAST(event_id AS DOUBLE) AS event_id, CAST(user_id AS DOUBLE) AS user_id, round(value, 6) AS value FROM events""")
def cast_rates(spark, sf):
    e = events(spark, sf).select("event_id", "user_id", "value")
    return round_doubles(N.cast_cols(e, ["event_id", "user_id", "value"], "double"))


@register("label_positive", """
SELECT event_id, coalesce(CAST(json_extract_string(props, '$.k') AS INTEGER), 0)
  + coalesce(CAST(json_extract_string(props, '$.z') AS INTEGER), 0) > 0 AS gilded FROM events""")
def label_positive(spark, sf):
    e = events(spark, sf).withColumn("awards", _awards())
    e = N.unpack_awards(e, "awards", keys={"gold": "k", "platinum": "z"})
    return e.select("event_id", N.label_positive("gold", "platinum").alias("gilded"))


@register("calendar_parts", """
SELECT event_id, CAST(isodow(ts) - 1 AS INTEGER) AS weekday, CAST(hour(ts) AS INTEGER) AS post_hour FROM events""")
def calendar_parts(spark, sf):
    return N.calendar_parts(events(spark, sf), "ts").select("event_id", "weekday", "post_hour")


@register("scrape_hhmm", f"SELECT event_id, right(id, 4) AS scrape_time FROM {STAGED_EVENTS_SQL}")
def scrape_hhmm(spark, sf):
    return staged_events(spark, sf).select("event_id", N.scrape_hhmm("id").alias("scrape_time"))
