"""Registered queries: sources, sinks and the posts table."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..session import compiled_methods, fresh_path
from ..sources import posts as P
from ..sources import table as TB
from ..sources.published import PublishedTable
from ..util import kept_table
from .fixtures import STAGED_EVENTS_SQL, events, round_doubles, staged_events, table
from .registry import register

_EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()),
])


@register("scan_posts", "SELECT event_id, user_id, event_type, value FROM events")
def scan_posts(spark, sf):
    return P.read_posts(spark, f"{sf}/events.parquet", _EVENT_SCHEMA)


@register("project_fields", """
SELECT event_id AS post_id, user_id AS author, event_type AS kind, value AS upvotes FROM events""")
def project_fields(spark, sf):
    return P.project_fields(events(spark, sf), {"post_id": "event_id", "author": "user_id",
                                                "kind": "event_type", "upvotes": "value"})


@register("filter_allowlist", """
SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE n_name IN (SELECT trim(n_name) FROM nation WHERE n_regionkey < 2)""")
def filter_allowlist(spark, sf):
    nation = table(spark, sf, "nation")
    # The list arrives as comma-terminated text lines, as in a list file.
    lines = nation.where(F.col("n_regionkey") < 2).select(F.concat(F.col("n_name"), F.lit(",")).alias("value"))
    allow = P.parse_allowlist(lines)
    cust = table(spark, sf, "customer").join(
        nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey")
    return P.filter_allowlist(cust, allow, "n_name").select("c_custkey", "c_name", "n_name")


@register("latest_n_per_sort", """
SELECT event_type, event_id FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) <= 250""")
def latest_n_per_sort(spark, sf):
    e = events(spark, sf)
    return P.latest_n(e, "event_type", [F.col("ts").desc(), F.col("event_id").desc()], 250) \
        .select("event_type", "event_id")


@register("scrape_tag", f"SELECT event_id, scrape_tag FROM {STAGED_EVENTS_SQL}")
def scrape_tag(spark, sf):
    return staged_events(spark, sf).select("event_id", "scrape_tag")


# Scrapes by day: the part of the tag before hours and minutes.
_DAY_SQL = "left(scrape_tag, length(scrape_tag) - 4)"


def _by_day(spark, sf):
    return staged_events(spark, sf).withColumn("day_tag", F.expr("left(scrape_tag, length(scrape_tag) - 4)"))


@register("list_staged_files", f"""
SELECT day_tag, count(*) AS n_files FROM (SELECT DISTINCT {_DAY_SQL} AS day_tag FROM {STAGED_EVENTS_SQL}) GROUP BY day_tag""")
def list_staged_files(spark, sf):
    """A real listing: the events are staged as a folder per scrape day; markers and folders are no files."""
    path = fresh_path(spark, "staging")
    _by_day(spark, sf).select("day_tag", "event_id").repartition("day_tag").write.partitionBy("day_tag").parquet(path)
    files = P.staged_files(spark, path, "*.parquet")
    tag = F.regexp_extract("file_path", "day_tag=([^/]*)/", 1)
    return files.groupBy(tag.alias("day_tag")).agg(F.count(F.lit(1)).alias("n_files"))


@register("staged_names", f"""
SELECT DISTINCT file_name FROM (SELECT file_name FROM {STAGED_EVENTS_SQL} UNION ALL SELECT 'staging/')
WHERE starts_with(file_name, 'staging/') AND file_name <> 'staging/' AND NOT ends_with(file_name, '/')""")
def staged_names(spark, sf):
    keys = staged_events(spark, sf).select("file_name")
    marker = spark.range(1).select(F.lit("staging/").alias("file_name"))
    return P.staged_names(keys.unionByName(marker), "file_name", "staging/")


_BATCH_SQL = """(SELECT event_id, event_type, value FROM events WHERE event_type <> 'error'
  UNION ALL SELECT event_id, event_type, value + 1000 FROM events WHERE event_type <> 'error')"""


@register("append_first_wins", f"""
WITH t AS (SELECT event_id, event_type, value FROM events WHERE event_type IN ('view', 'click')),
f AS (SELECT * FROM {_BATCH_SQL} QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY value, event_type) = 1)
SELECT * FROM t UNION ALL SELECT * FROM f WHERE event_id NOT IN (SELECT event_id FROM t)""")
def append_first_wins(spark, sf):
    e = events(spark, sf).select("event_id", "event_type", "value")
    target = e.where(F.col("event_type").isin("view", "click"))
    b = e.where(F.col("event_type") != "error")
    batch = b.unionByName(b.withColumn("value", F.col("value") + 1000))
    return round_doubles(TB.append_first_wins(target, batch, "event_id", ["value", "event_type"]))


_CONFORM = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("user_id", T.IntegerType()),
    T.StructField("value", T.FloatType()), T.StructField("event_type", T.StringType()),
    T.StructField("props", T.StringType()), T.StructField("note", T.StringType()),
])


@register("conform_schema", """
SELECT CAST(event_id AS BIGINT) AS event_id, TRY_CAST(user_id AS INTEGER) AS user_id,
  round(CAST(TRY_CAST(value AS REAL) AS DOUBLE), 6) AS value, event_type, props, CAST(NULL AS VARCHAR) AS note FROM events""")
def conform_schema(spark, sf):
    return round_doubles(TB.conform(events(spark, sf), _CONFORM))


# The 45 columns as raw text made from the events, with cells that their type, their length or the key rule refuses.
def _raw_cell(i: int, f: T.StructField, sql: bool) -> str:
    text = "VARCHAR" if sql else "STRING"
    n = f"(event_id + {i})"
    if f.name == "ID":
        return f"CASE WHEN event_id % 101 = 0 THEN NULL ELSE CAST(event_id AS {text}) || '_new01011200' END"
    good, bad = {"string": (f"'t' || repeat('x', CAST({n} % 320 AS INT))", None),
                 "integer": (f"CAST({n} % 1000 AS {text})", "'many'"), "boolean": (f"CASE WHEN {n} % 2 = 0 THEN 'true' ELSE 'false' END", "'maybe'")
                 }.get(f.dataType.typeName(), (f"CAST({n} % 1000 AS {text}) || '.5'", "'n/a'"))
    return good if bad is None else f"CASE WHEN {n} % 97 = 0 THEN {bad} WHEN {n} % 89 = 0 THEN NULL ELSE {good} END"


def _verdict_sql() -> tuple[str, str]:
    kinds = {"string": "VARCHAR", "integer": "INTEGER", "boolean": "BOOLEAN", "float": "REAL", "double": "DOUBLE"}
    cells, said = [], []
    for i, f in enumerate(schemas.POSTS_TABLE.fields):
        raw, kind = f"r.{f.name}", f.dataType.typeName()
        typed = f"TRY_CAST({raw} AS {kinds[kind]})"
        cells.append(f"CAST({typed} AS DOUBLE) AS {f.name}" if kind in ("float", "double") else f"{typed} AS {f.name}")
        said.append(f"CASE WHEN {raw} IS NOT NULL AND {typed} IS NULL THEN '{f.name}:cast:' || {raw} END")
        if f.name in schemas.POSTS_VARCHAR:
            said.append(f"CASE WHEN length({raw}) > {schemas.POSTS_VARCHAR[f.name]} THEN '{f.name}:length:' || {raw} END")
        if f.name == "ID":
            said.append(f"CASE WHEN {raw} IS NULL THEN '{f.name}:null_key:' END")
    raws = ", ".join(f"{_raw_cell(i, f, True)} AS {f.name}" for i, f in enumerate(schemas.POSTS_TABLE.fields))
    return f"(SELECT event_id, event_type, {raws} FROM events) r", f"{', '.join(cells)}, md5(concat_ws('|', {', '.join(said)})) AS verdicts", said


_RAW_SQL, _CELLS_SQL, _SAID = _verdict_sql()


def _judged(spark, sf):
    raw = events(spark, sf).select("event_id", "event_type", *[
        F.expr(_raw_cell(i, f, False)).alias(f.name) for i, f in enumerate(schemas.POSTS_TABLE.fields)])
    return TB.with_verdicts(raw, schemas.POSTS_TABLE, "ID", schemas.POSTS_VARCHAR, keep=["event_id", "event_type"])


def _told():
    return F.array_join(F.transform("verdicts", lambda v: F.concat(v["column"], F.lit(":"), v["rule"], F.lit(":"), F.coalesce(v["value"], F.lit("")))), "|")


@register("conform_verdicts", f"SELECT event_id, {_CELLS_SQL} FROM {_RAW_SQL}")
def conform_verdicts(spark, sf):
    """The 45-column table from raw text, with every refused cell named."""
    typed = [F.col(f.name).cast("double") if f.dataType.typeName() == "float" else F.col(f.name) for f in schemas.POSTS_TABLE.fields]
    return _judged(spark, sf).select("event_id", *[c.alias(f.name) for c, f in zip(typed, schemas.POSTS_TABLE.fields)],
                                     F.md5(_told()).alias("verdicts"))


@register("read_selected_columns", f"SELECT {', '.join(f'{c} AS {c}' for c in schemas.SELECTED_COLUMNS)} FROM (SELECT {_CELLS_SQL} FROM {_RAW_SQL})")
def read_selected_columns(spark, sf):
    """The 32 columns that the model stage reads, from the written 45-column table."""
    written = kept_table(_judged(spark, sf).select(*schemas.POSTS_TABLE.names), "posts-table")
    kinds = dict(written.dtypes)
    named = {n.lower(): n for n in kinds}
    return written.select(*[F.col(named[c]).cast("double" if kinds[named[c]] == "float" else kinds[named[c]]).alias(c)
                            for c in schemas.SELECTED_COLUMNS])


@register("reject_by_schema", f"""
WITH j AS (SELECT event_id, floor(event_id / 20) AS file, {' + '.join(f'CAST(({x}) IS NOT NULL AS INTEGER)' for x in _SAID)} AS n FROM {_RAW_SQL})
SELECT CAST(file AS BIGINT) AS file, CASE WHEN max(n) > 0 THEN 'error' ELSE 'completed' END AS status, count(*) AS n_rows,
  CAST(sum(CAST(n > 0 AS INTEGER)) AS BIGINT) AS n_bad_rows, CAST(sum(n) AS BIGINT) AS n_bad_cells FROM j GROUP BY file""")
def reject_by_schema(spark, sf):
    """The verdicts feed the router: files of 20 rows, rejected whole for one bad cell."""
    d = _judged(spark, sf).select(F.floor(F.col("event_id") / 20).alias("file"), F.size("verdicts").alias("n"))
    with compiled_methods(spark):
        d = kept_table(d, "verdict-counts")         # the rules run once; rows, failing files and cells are counted from it
    routed = TB.route_files(d, "file", F.col("n") > 0)
    cells = d.groupBy("file").agg(F.sum("n").alias("n_bad_cells"))
    return TB.load_ledger(routed, "file").join(cells, "file")


_FIELD_EXPR = {
    "title": "'event ' || CAST(event_id AS {text})", "author.name": "CASE WHEN user_id % 7 = 0 THEN NULL ELSE 'u' || CAST(user_id AS {text}) END",
    "id": "CAST(event_id AS {text})", "ups": "CAST(event_id % 500 AS INT)", "created_utc": "CAST(event_id AS DOUBLE)",
    "upvote_ratio": "0.5", "distinguished": "CASE WHEN event_id % 11 = 0 THEN 'moderator' END", "num_comments": "CAST(user_id % 50 AS INT)",
    "over_18": "event_id % 13 = 0", "is_self": "event_id % 2 = 0", "subreddit.display_name": "event_type",
}


@register("project_post_fields", "SELECT " + ", ".join(
    f'{_FIELD_EXPR[s].format(text="VARCHAR") if s in _FIELD_EXPR else "CAST(NULL AS VARCHAR)"} AS "{d}"'
    for d, s in schemas.POST_FIELDS.items()) + " FROM events")
def project_post_fields(spark, sf):
    """Records of the source's shape, nested as delivered, through all 27 fields."""
    def build(fields, prefix=""):
        out = []
        for f in fields:
            name = prefix + f.name
            if isinstance(f.dataType, T.StructType):
                out.append(F.struct(*build(f.dataType.fields, name + ".")).alias(f.name))
            elif name in _FIELD_EXPR:
                out.append(F.expr(_FIELD_EXPR[name].format(text="STRING")).cast(f.dataType).alias(f.name))
            else:
                out.append(F.lit(None).cast(f.dataType).alias(f.name))
        return out
    raw = events(spark, sf).select(*build(schemas.RAW_POST.fields))
    return P.project_fields(raw, schemas.POST_FIELDS)


_ROUTE_SQL = """(SELECT event_id, user_id, value > 400 AS row_bad,
  CASE WHEN max(CAST(value > 400 AS INTEGER)) OVER (PARTITION BY user_id) = 1 THEN 'error' ELSE 'completed' END AS route
  FROM events)"""


def _routed(spark, sf):
    e = events(spark, sf).select("event_id", "user_id", "value")
    return TB.route_files(e, "user_id", F.col("value") > 400)


@register("route_valid_invalid", f"SELECT event_id, user_id, row_bad, route FROM {_ROUTE_SQL}")
def route_valid_invalid(spark, sf):
    return _routed(spark, sf).select("event_id", "user_id", "row_bad", "route")


@register("load_ledger", f"""
SELECT user_id, min(route) AS status, count(*) AS n_rows, CAST(sum(CAST(row_bad AS INTEGER)) AS BIGINT) AS n_bad_rows
FROM {_ROUTE_SQL} GROUP BY user_id""")
def load_ledger(spark, sf):
    return TB.load_ledger(_routed(spark, sf), "user_id")


@register("distinct_scrape_tags", f"""
SELECT DISTINCT regexp_extract(id, '_(.*)$', 1) AS scrape_tag FROM {STAGED_EVENTS_SQL}""")
def distinct_scrape_tags(spark, sf):
    return TB.scrape_tags(staged_events(spark, sf), "id")


@register("read_by_tags", f"""
SELECT id, event_type, value, scrape_tag FROM {STAGED_EVENTS_SQL}
WHERE scrape_tag IN (SELECT scrape_tag FROM {STAGED_EVENTS_SQL} WHERE event_type = 'purchase')""")
def read_by_tags(spark, sf):
    s = staged_events(spark, sf)
    tags = s.where(F.col("event_type") == "purchase").select("scrape_tag")
    return TB.read_by_tags(s, tags, ["id", "event_type", "value", "scrape_tag"])


_TAGGED = T.StructType([T.StructField("id", T.StringType()), T.StructField("event_type", T.StringType()),
                        T.StructField("value", T.DoubleType()), T.StructField("day_tag", T.StringType())])


def tagged_table(spark, sf) -> PublishedTable:
    """The staged events as two published batches of a table partitioned by tag; the second repeats
    every third row of the first with another value, which first-wins ignores."""
    s = _by_day(spark, sf).select("id", "event_type", "value", "day_tag", "event_id")
    t = PublishedTable(spark, fresh_path(spark, "posts"), _TAGGED, "day_tag")
    t.publish(0, s.where("event_id % 2 = 0").drop("event_id"), "id", ["value"])
    t.publish(1, s.where("event_id % 2 = 1 OR event_id % 3 = 0").withColumn("value", F.col("value") + 1).drop("event_id"), "id", ["value"])
    return t


@register("read_tag_partitions", f"""
SELECT id, event_type, round(CASE WHEN event_id % 2 = 0 THEN value ELSE value + 1 END, 6) AS value, {_DAY_SQL} AS day_tag
FROM {STAGED_EVENTS_SQL}
WHERE {_DAY_SQL} IN (SELECT DISTINCT {_DAY_SQL} FROM {STAGED_EVENTS_SQL} ORDER BY 1 LIMIT 5)""")
def read_tag_partitions(spark, sf):
    """The first five tags from a table partitioned by tag: only their partitions are read."""
    tags = [r[0] for r in _by_day(spark, sf).select("day_tag").distinct().orderBy("day_tag").limit(5).collect()]
    return round_doubles(tagged_table(spark, sf).rows(tags))


@register("union_blocks", f"SELECT id, how, value FROM {STAGED_EVENTS_SQL}")
def union_blocks(spark, sf):
    s = staged_events(spark, sf).select("id", "how", "value")
    return TB.union_blocks([s.where(F.col("how") == "new"), s.where(F.col("how") == "rising")])


@register("materialise_snapshot", "SELECT event_id, user_id, event_type, value FROM events")
def materialise_snapshot(spark, sf):
    e = events(spark, sf).select("event_id", "user_id", "event_type", "value")
    return TB.materialise_snapshot(e, fresh_path(spark, "snapshot"), "2024-01-31") \
        .select("event_id", "user_id", "event_type", "value")
