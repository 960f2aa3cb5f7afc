"""Batch readers for snapshots: declared schemas, field projection,
allow-lists, newest-n per sort mode and staged-file listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.comments import top_n
from ..util import col_of


def read_posts(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
               id_keyed: bool = False) -> DataFrame:
    """Read a batch of snapshots with a declared schema (never inferred).

    ``id_keyed=True`` reads files shaped ``{post_id: {field: value}}`` (one
    JSON object per line) as ``map<string, struct>`` and explodes them to one
    row per post; the map key becomes ``post_id``."""
    if id_keyed:
        wrapped = T.StructType([T.StructField("posts", T.MapType(T.StringType(), schema))])
        raw = (spark.read.format("text").load(path)
               .select(F.from_json(F.concat(F.lit('{"posts":'), F.col("value"), F.lit("}")),
                                   wrapped).alias("j")))
        return raw.select(F.explode("j.posts").alias("post_id", "p")).select("post_id", "p.*")
    return spark.read.schema(schema).format(fmt).load(path)


def project_fields(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Keep the mapped source fields, renamed ``{friendly: source}``."""
    return df.select(*[col_of(src).alias(dst) for dst, src in mapping.items()])


def parse_allowlist(lines: DataFrame, col: str = "value") -> DataFrame:
    """Names from text lines separated by commas and/or newlines: trimmed,
    empty entries dropped, duplicates removed.  One column ``name``."""
    names = lines.select(F.explode(F.split(F.col(col), r"[,\r\n]")).alias("name"))
    return names.select(F.trim("name").alias("name")).where(F.col("name") != "").distinct()


def read_allowlist(spark: SparkSession, path: str) -> DataFrame:
    return parse_allowlist(spark.read.text(path))


def filter_allowlist(df: DataFrame, allow: DataFrame, key: str, allow_col: str = "name") -> DataFrame:
    """Keep rows whose ``key`` is listed (left-semi join).  Whether the
    list is broadcast is decided by its bytes at run time."""
    a = allow.select(F.col(allow_col).alias(key)).distinct()
    return df.join(a, key, "left_semi")


def latest_n(df: DataFrame, by: str | list, order: list, n: int) -> DataFrame:
    """Newest ``n`` rows per sort mode (partial + final WindowGroupLimit)."""
    return top_n(df, by, order, n)


def staged_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Files under ``path`` (one row per file; folders are never returned).
    Only the listing columns are selected, so file contents are not read."""
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path).select(F.col("path").alias("file_path"), "length", "modificationTime")


def staged_names(keys: DataFrame, key: str, prefix: str) -> DataFrame:
    """Object keys waiting under ``prefix``: keys under it, the folder marker
    (the prefix itself or any key ending in ``/``) removed, distinct."""
    k = F.col(key)
    return (keys.where(k.startswith(prefix) & (k != prefix) & ~k.endswith("/"))
            .select(k.alias("file_name")).distinct())


def _listing_schema(fields: T.StructType) -> T.ArrayType:
    child = T.StructType([T.StructField("kind", T.StringType()), T.StructField("data", fields)])
    listing = T.StructType([T.StructField("data", T.StructType([
        T.StructField("children", T.ArrayType(child))]))])
    return T.ArrayType(listing)


def read_comment_listings(spark: SparkSession, path: str, comment_schema: T.StructType,
                          whole_file: bool = False) -> DataFrame:
    """Comments from API responses shaped ``[post_listing, comment_listing]``
    (one response per line, or one per file with ``whole_file``): the post id
    comes from the first listing, one row per ``comment_listing.data.children
    [].data``.  Fields missing from a comment are null (see comment_defaults)."""
    post = T.StructType([T.StructField("id", T.StringType())])
    reader = spark.read.option("wholetext", True) if whole_file else spark.read
    raw = reader.text(path).select(F.from_json("value", _listing_schema(post)).alias("p"),
                                   F.from_json("value", _listing_schema(comment_schema)).alias("c"))
    rows = raw.select(F.col("p")[0]["data"]["children"][0]["data"]["id"].alias("post_id"),
                      F.explode(F.col("c")[1]["data"]["children"]).alias("child"))
    fields = [f.name for f in comment_schema.fields if f.name != "post_id"]
    return rows.select("post_id", "child.kind", *[F.col(f"child.data.{f}").alias(f) for f in fields])
