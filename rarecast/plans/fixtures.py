"""Adapters from the driver's test tables to the operators' data model.

Stand-ins (see FIXTURES.md): orders are posts, lineitems their comments,
events carry timestamps, award maps (``props``) and the view -> purchase
outcome, documents/labels/embeddings carry titles, categories, a rare label
and title vectors."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_utc

# Snapshot clock for the order/lineitem stand-in: after the last ship date.
ASOF = dt.datetime(2002, 1, 1)
ASOF_SQL = "TIMESTAMP '2002-01-01 00:00:00'"
# Reference time for event ages (just before the first event).
EVENT_EPOCH = dt.datetime(2023, 12, 31)
EVENT_EPOCH_SQL = "TIMESTAMP '2023-12-31 00:00:00'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def asof_lit():
    return F.lit(ASOF).cast("timestamp_ntz")


def posts(spark, sf_dir) -> DataFrame:
    """orders as posts."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("post_id"),
        F.col("o_orderpriority").alias("community"),
        F.when(F.col("o_orderstatus") == "O", F.lit("new")).otherwise(F.lit("rising")).alias("how"),
        F.col("o_totalprice").alias("ups"),
        F.col("o_orderdate").alias("created"),
        (F.col("o_totalprice") > 250000).cast("int").alias("gold"),
        (F.col("o_orderstatus") == "P").cast("int").alias("platinum"),
    )


POSTS_SQL = """(SELECT o_orderkey AS post_id, o_orderpriority AS community,
  CASE WHEN o_orderstatus = 'O' THEN 'new' ELSE 'rising' END AS how,
  o_totalprice AS ups, o_orderdate AS created,
  CAST(o_totalprice > 250000 AS INTEGER) AS gold,
  CAST(o_orderstatus = 'P' AS INTEGER) AS platinum FROM orders)"""


def raw_comments(spark, sf_dir) -> DataFrame:
    """lineitems as raw comments of their order."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("post_id"),
        F.col("l_shipdate").alias("created"),
        F.col("l_quantity").alias("ups"),
        (F.col("l_linenumber") % 2).alias("gilded"),
        F.when(F.col("l_returnflag") == "R", F.lit("moderator"))
         .when(F.col("l_returnflag") == "A", F.lit("admin")).alias("distinguished"),
        (F.col("l_linestatus") == "O").alias("is_submitter"),
        (F.col("l_tax") > 0.04).alias("author_premium"),
        # tie-break columns: (orderkey, linenumber) is not unique
        "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus",
    )


COMMENT_ORDER = ["ups DESC", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "created"]


def comment_order():
    out = []
    for c in COMMENT_ORDER:
        name, *d = c.split()
        out.append(F.col(name).desc() if d else F.col(name).asc())
    return out


COMMENTS_SQL = """(SELECT l_orderkey AS post_id, l_shipdate AS created, l_quantity AS ups,
  l_linenumber % 2 AS gilded,
  CASE WHEN l_returnflag IN ('R', 'A') THEN 1 ELSE 0 END AS distinguished,
  CAST(l_linestatus = 'O' AS INTEGER) AS is_submitter,
  CAST(l_tax > 0.04 AS INTEGER) AS author_premium,
  l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus
  FROM lineitem)"""

COMMENT_ORDER_SQL = ", ".join(COMMENT_ORDER)


def events(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events")


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double/float column (both engines sum in other orders)."""
    out = []
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        if t in ("double", "float"):
            out.append(F.round(F.col(f"`{f.name}`").cast("double"), places).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


# ----------------------------------------------------------------------------- events as snapshots
EVENTS_ASOF = dt.datetime(2024, 2, 1)
EVENTS_ASOF_SQL = "TIMESTAMP '2024-02-01 00:00:00'"


def events_asof():
    return F.lit(EVENTS_ASOF).cast("timestamp_ntz")


def staged_events(spark, sf_dir) -> DataFrame:
    """events with a sort mode, the staged file name a scrape would write and
    the snapshot id ``<event_id>_<how><MMddHHmm>``."""
    from ..functions.normalise import scrape_tag, staged_file_name
    e = events(spark, sf_dir)
    how = F.when(F.col("event_id") % 2 == 0, F.lit("new")).otherwise(F.lit("rising"))
    e = e.withColumn("how", how)
    return e.withColumns({
        "file_name": staged_file_name("how", "ts"),
        "id": F.concat(F.col("event_id").cast("string"), F.lit("_"), scrape_tag("how", "ts")),
        "scrape_tag": scrape_tag("how", "ts"),
    })


STAGED_EVENTS_SQL = """(SELECT *,
  'staging/gilded_data_sortedby_' || how || '_' || strftime(ts, '%m-%d') || '_at_' || strftime(ts, '%H%M') || 'utc.pkl' AS file_name,
  CAST(event_id AS VARCHAR) || '_' || how || strftime(ts, '%m%d%H%M') AS id,
  how || strftime(ts, '%m%d%H%M') AS scrape_tag
  FROM (SELECT *, CASE WHEN event_id % 2 = 0 THEN 'new' ELSE 'rising' END AS how FROM events))"""


def epoch_sql(ts: str) -> str:
    return f"(epoch_us({ts}) / 1000000.0)"


# ----------------------------------------------------------------------------- documents as posts
def docs_labeled(spark, sf_dir) -> DataFrame:
    """documents with their labels: title text, categories, a size and the
    rare label ``toxic``."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars", "text")
    lab = table(spark, sf_dir, "labels")
    return d.join(lab, "doc_id")


DOCS_SQL = """(SELECT d.doc_id, d.lang, d.source, d.n_chars, d.text, l.quality, l.toxic
  FROM documents d JOIN labels l USING (doc_id))"""


def hash_uniform_sql(id_sql: str, seed) -> str:
    return f"(('0x' || substr(md5(CAST({id_sql} AS VARCHAR) || '|' || '{seed}'), 1, 8))::BIGINT / 4294967296.0)"


def edges_sql(src: str, col: str, n_bins: int) -> str:
    """Equal-frequency edges (edge k, value) as SQL: linear interpolation of
    the sorted column at position n*k/n_bins, clamped to the last point."""
    return f"""(SELECT pos.k AS edge, lo.x + (pos.p - floor(pos.p)) * (coalesce(hi.x, lo.x) - lo.x) AS value
  FROM (SELECT k, least(n * k / {float(n_bins)}, n - 1) AS p
        FROM range({n_bins + 1}) t(k), (SELECT count({col}) AS n FROM {src})) pos
  JOIN (SELECT CAST({col} AS DOUBLE) AS x, row_number() OVER (ORDER BY {col}) - 1 AS r FROM {src} WHERE {col} IS NOT NULL) lo
    ON lo.r = floor(pos.p)
  LEFT JOIN (SELECT CAST({col} AS DOUBLE) AS x, row_number() OVER (ORDER BY {col}) - 1 AS r FROM {src} WHERE {col} IS NOT NULL) hi
    ON hi.r = floor(pos.p) + 1)"""


def bin_sql(x_sql: str, edges: str) -> str:
    """Bin number: count of the distinct inner edges below x."""
    return f"""(SELECT count(*) FROM (SELECT DISTINCT value AS v FROM {edges}) e
   WHERE e.v > (SELECT min(value) FROM {edges}) AND e.v < (SELECT max(value) FROM {edges}) AND e.v < {x_sql})"""
