"""Line deduplication with DataFrame functions only.

Every line's key (ends stripped, A-Z lower-cased) is hashed to 128 bits.  The hashes are
range-partitioned, with a secondary sort by document and position inside each key, and the
sorted stream marks first occurrences and counts documents.  Keys are dealt in ``SALTS``
parts by document, so a line that sits in a third of all documents is streamed, and joined back,
by several tasks; the parts' counts are summed afterwards.  Only keys that lose lines are joined back
to the occurrences, and what returns to the texts is one run-length coded keep bitmap per
document that loses a line, as the first and last line of each dropped run; texts are rebuilt from
slices between these runs, in time linear in the lines.

Defined cases: a null or empty text is one empty line; keys shorter than ``min_chars`` code
points are never dropped; each row counts as one document, also where ids or whole rows repeat;
rows equal in id and text lose the same lines; null ids are legal; an empty table gives no rows; all other
columns pass through, and one named like a column of the result comes out with ``_input`` added to its name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WHITESPACE, fold_ascii, read_table
from .registry import register

SALTS = 8


def _lines(text):
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _row_key(id_col: str, text_col: str):
    """Tells rows with the same id apart."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def line_occurrences(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    keys = F.transform(_lines(fold_ascii(F.col(text_col))), lambda x: F.btrim(x, F.lit(WHITESPACE)))
    hashed = F.transform(keys, lambda k: F.struct(
        F.char_length(k).alias("n"), F.xxhash64(k).alias("h1"), F.xxhash64(F.lit(1), k).alias("h2")))
    # the row key below the explode, else each line would hash its whole text; the outer form adds no filter that
    # splits the text once more (its one null for no lines does not come up: a text has one line at least)
    return (docs.select(F.col(id_col).alias("doc"), _row_key(id_col, text_col).alias("rk"), hashed.alias("lines"))
            .select("doc", "rk", F.posexplode_outer("lines").alias("pos", "line"))
            .filter(F.col("line.n") >= min_chars)
            .select("doc", "rk", "pos", "line.h1", "line.h2", F.pmod("rk", F.lit(SALTS)).cast("int").alias("part")))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 1,
                 min_docs: int = 2, keep_first: bool = True) -> DataFrame:
    """(doc, rk, dropped positions, keep_runs) of the documents that lose a line.  A key found in
    ``min_docs`` documents loses all lines, or all but the first by (id, position) with
    ``keep_first`` (a repeat inside one document counts once towards ``min_docs``)."""
    occ = line_occurrences(docs, id_col, text_col, min_chars)
    # first place of the key in its document; rows that repeat a document repeat that place, so each is counted
    place = F.first("pos").over(Window.partitionBy("h1", "h2", "part", "doc", "rk").orderBy("pos"))
    stream = occ.repartitionByRange("h1", "h2", "part").withColumn("place", place)
    parts = stream.groupBy("h1", "h2", "part").agg(
        F.count_if(F.col("pos") == F.col("place")).alias("n"), F.min(F.struct("doc", "rk", "pos")).alias("first"))
    facts = (parts.groupBy("h1", "h2").agg(F.sum("n").alias("n_docs"), F.min("first").alias("first"))
             .filter(F.col("n_docs") >= min_docs).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    hit = occ.join(facts, ["h1", "h2", "part"])
    if keep_first:
        hit = hit.filter(~F.struct("doc", "rk", "pos").eqNullSafe(F.col("first")))
    dropped = hit.groupBy("doc", "rk").agg(F.sort_array(F.collect_set("pos")).alias("dropped"))

    def borders(step):
        return F.filter("dropped", lambda p, i: ~F.get("dropped", i + step).eqNullSafe(p + step))

    return dropped.select("doc", "rk", borders(F.lit(-1)).alias("first"), borders(F.lit(1)).alias("last"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the dropped lines gone, plus ``n_lines``, ``n_dropped`` and ``keep_runs`` (lengths of alternating
    kept and dropped runs, kept first, up to the last dropped line; null where nothing is dropped)."""
    for c in ("n_lines", "n_dropped", "keep_runs"):
        free = c
        while free in docs.columns:
            free += "_input"
        docs = docs.withColumnRenamed(c, free)
    columns = docs.columns
    b = bitmaps.select(F.col("doc").alias("__bm_doc"), F.col("rk").alias("__bm_rk"), F.col("first").alias("__bm_first"),
                       F.col("last").alias("__bm_last"))
    d = (docs.withColumn("__bm_key", _row_key(id_col, text_col))
         .join(b, F.col(id_col).eqNullSafe(F.col("__bm_doc")) & (F.col("__bm_key") == F.col("__bm_rk")), "left")
         .withColumn("__bm_lines", _lines(F.col(text_col))))

    def after(i):                     # line after dropped run i, 0 before the first
        return F.coalesce(F.get("__bm_last", i) + 1, F.lit(0))

    between = F.transform("__bm_first", lambda p, i: F.slice("__bm_lines", after(i - 1) + 1, p - after(i - 1)))
    tail = F.slice("__bm_lines", F.element_at("__bm_last", -1) + 2, F.size("__bm_lines"))
    kept = F.array_join(F.concat(F.flatten(between), tail), "\n")
    size = F.zip_with("__bm_first", "__bm_last", lambda a, z: z - a + 1)
    runs = F.flatten(F.transform("__bm_first", lambda p, i: F.array(p - after(i - 1), F.get("__bm_last", i) - p + 1)))
    return d.select(
        *[F.when(F.col("__bm_first").isNotNull(), kept).otherwise(F.col(c)).alias(c) if c == text_col else F.col(c) for c in columns],
        F.size("__bm_lines").cast("long").alias("n_lines"),
        F.coalesce(F.aggregate(size, F.lit(0), lambda s, x: s + x), F.lit(0)).cast("long").alias("n_dropped"), runs.alias("keep_runs"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 1,
                min_docs: int = 2, keep_first: bool = True) -> DataFrame:
    return apply_bitmaps(docs, keep_bitmaps(docs, id_col, text_col, min_chars, min_docs, keep_first), id_col, text_col)


@register("op7_line_dedup", """
WITH l AS (SELECT doc_id, rk, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS pos
           FROM (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS rk FROM documents)),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT rk) >= 10),
m AS (SELECT k.*, f.key IS NOT NULL AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id, rk""")
def op7(spark, sf_dir):
    d = dedup_lines(read_table(spark, sf_dir, "documents"), min_chars=1, min_docs=10, keep_first=False)
    return d.select("doc_id", "n_lines", "n_dropped",
                    F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
