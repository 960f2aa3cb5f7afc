"""Registered queries: delayed outcome.  Snapshot = a ``view``
event, outcome = a ``purchase`` of the same user."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import outcome as O
from .fixtures import events, round_doubles
from .registry import register

_V = "(SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'view')"
_P = "(SELECT event_id, user_id, ts, value, props FROM events WHERE event_type = 'purchase')"


def _views(spark, sf):
    return events(spark, sf).where(F.col("event_type") == "view").select("event_id", "user_id", "ts", "value")


def _purchases(spark, sf):
    return events(spark, sf).where(F.col("event_type") == "purchase") \
        .select("event_id", "user_id", "ts", "value", "props")


@register("outcome_fields", f"""
SELECT event_id, 0 AS silver_awarded, coalesce(CAST(json_extract_string(props, '$.k') AS INTEGER), 0) AS gold_awarded,
  0 AS platinum_awarded, CAST(floor(value) AS INTEGER) AS final_upvotes, CAST(user_id AS INTEGER) AS final_num_comments
FROM {_P}""")
def outcome_fields(spark, sf):
    p = _purchases(spark, sf).withColumn("awards", F.from_json("props", "map<string,int>"))
    return O.outcome_fields(p, "awards", F.floor("value"), "user_id", key="event_id",
                            keys={"silver": "gid_1", "gold": "k", "platinum": "gid_3"})


@register("join_outcome", f"""
SELECT v.event_id, v.user_id, o.final_value, o.user_id IS NULL AS outcome_missing
FROM {_V} v LEFT JOIN (SELECT user_id, round(arg_max(value, (ts, event_id)), 6) AS final_value
                        FROM {_P} GROUP BY user_id) o USING (user_id)""")
def join_outcome(spark, sf):
    last = _purchases(spark, sf).groupBy("user_id").agg(
        F.max_by("value", F.struct("ts", "event_id")).alias("final_value"))
    v = _views(spark, sf).select("event_id", "user_id")
    return round_doubles(O.join_outcome(v, last, "user_id"))


@register("outcome_after_delay", f"""
WITH m AS (SELECT v.event_id, p.event_id AS out_event_id, p.value AS out_value,
    row_number() OVER (PARTITION BY v.event_id ORDER BY p.ts, p.event_id) AS rn
  FROM {_V} v JOIN {_P} p ON v.user_id = p.user_id
   AND p.ts >= v.ts + INTERVAL 24 HOUR AND p.ts < v.ts + INTERVAL 48 HOUR)
SELECT v.event_id, v.user_id, m.out_event_id, round(m.out_value, 6) AS out_value
FROM {_V} v LEFT JOIN (SELECT * FROM m WHERE rn = 1) m USING (event_id)""")
def outcome_after_delay(spark, sf):
    v = _views(spark, sf).select("event_id", "user_id", "ts")
    p = _purchases(spark, sf).select("event_id", "user_id", "ts", "value")
    r = O.outcome_after(v, p, "user_id", "ts", "ts", ["value"], "24 hours", "48 hours", out_id="event_id")
    return round_doubles(r.select("event_id", "user_id", "out_event_id", "out_value"))


@register("outcome_gap_report", f"""
SELECT strftime(CAST(v.ts AS DATE), '%Y-%m-%d') AS day, count(*) AS n_missing FROM {_V} v
WHERE NOT EXISTS (SELECT 1 FROM {_P} p WHERE p.user_id = v.user_id AND CAST(p.ts AS DATE) = CAST(v.ts AS DATE))
GROUP BY 1""")
def outcome_gap_report(spark, sf):
    v = _views(spark, sf).withColumn("day", F.to_date("ts"))
    p = _purchases(spark, sf).withColumn("day", F.to_date("ts"))
    r = O.outcome_gaps(v, p, ["user_id", "day"], ["day"])
    return r.withColumn("day", F.date_format("day", "yyyy-MM-dd"))
