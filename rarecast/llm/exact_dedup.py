"""Exact deduplication by content sort.

Texts are normalised (A-Z lower-cased), range-partitioned by sampled splitters, sorted
inside each partition by an external sort, and compared with their neighbour in full.

The splitter key is (first bytes, 64-bit hash, id), so sampled splitters stay small however
long the texts are, and one huge group of equal texts spreads over several partitions by id.
Runs that lie inside a partition are final.  Only the runs that touch a partition's first or
last key can continue elsewhere: two keys per partition, merged by SHA-256 and joined back.

Defined cases: a null text equals the empty text; null ids are legal rows (the smallest for
``keep="largest"``, the largest for ``keep="smallest"``: they stay only if no other row can);
of rows that share text and id one stays; an empty table gives no rows; columns other than
the two named ones are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read_table, stored
from .registry import register

LEAD_BYTES = 24          # bytes of the normalised text in the splitter key

_RUN_SCHEMA = "doc_id long, keep_id long, size long, pick boolean, edge boolean, head boolean, sha binary"


def _normalise(batches):
    for b in batches:
        norm = pc.ascii_lower(b.column("text").fill_null(""))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), norm], names=["doc_id", "norm"])


class _Run:
    """Equal neighbours met so far: their ids, one copy of the text, and its key."""

    __slots__ = ("ids", "text", "key")

    def __init__(self, ids, text, key):
        self.ids, self.text, self.key = [ids], text, key


def _runs(largest: bool):
    at = -1 if largest else 0

    def emit(done):
        """done: (run, edge) pairs -> one batch."""
        ids = [pa.concat_arrays(r.ids) for r, _ in done]
        n = np.array([len(x) for x in ids])
        keep = pa.array([x[at].as_py() for x in ids], pa.int64())
        sha = pa.array([hashlib.sha256(r.text.as_buffer()).digest() for r, _ in done], pa.binary())
        which = pa.array(np.repeat(np.arange(len(n)), n))
        first = np.zeros(n.sum(), bool)
        first[np.cumsum(n) - n] = True
        pick = first if not largest else np.zeros(n.sum(), bool)
        if largest:
            pick[np.cumsum(n) - 1] = True
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays(ids), keep.take(which), pa.array(np.repeat(n, n)), pa.array(pick),
             pa.array(np.repeat(np.array([e for _, e in done], bool), n)), pa.array(first), sha.take(which)],
            names=["doc_id", "keep_id", "size", "pick", "edge", "head", "sha"])

    def stream(batches):
        first_key, tail = None, []        # tail: runs under the newest key, maybe unfinished
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            ids, norm, key = b.column("doc_id"), b.column("norm"), b.column("h")
            lead = b.column("lead")
            change = np.ones(n, bool)
            if n > 1:
                change[1:] = pc.not_equal(norm.slice(1), norm.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(change)
            done = []
            for s, e in zip(starts, [*starts[1:], n]):
                text, k = norm[s], (lead[s].as_py(), key[s].as_py())
                if first_key is None:
                    first_key = k
                if tail and s == 0 and tail[-1].key == k and tail[-1].text.equals(text):
                    tail[-1].ids.append(ids.slice(0, e))
                    continue
                if tail and tail[-1].key != k:
                    done += [(r, r.key == first_key) for r in tail]
                    tail = []
                tail.append(_Run(ids.slice(s, e - s), text, k))
            for r in tail:                # let go of the batch's text buffer
                r.text = pa.scalar(r.text.as_py(), pa.string())
            if done:
                yield emit(done)
        if tail:
            yield emit([(r, True) for r in tail])

    return stream


def content_sort_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       keep: str = "smallest", partitions: int | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id (the row of its group that stays), group_size,
    kept, text_sha256 of the normalised text.  ``keep``: "smallest" or "largest" id."""
    largest = {"smallest": False, "largest": True}[keep]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    norm = (rows.mapInArrow(_normalise, "doc_id long, norm string")
            .withColumn("lead", F.substring(F.col("norm").cast("binary"), 1, LEAD_BYTES))
            .withColumn("h", F.xxhash64("norm")))
    by_id = F.col("doc_id").asc_nulls_first() if largest else F.col("doc_id").asc_nulls_last()
    key = [F.col("lead"), F.col("h"), by_id]
    spread = norm.repartitionByRange(partitions, *key) if partitions else norm.repartitionByRange(*key)
    ordered = spread.sortWithinPartitions("lead", "h", "norm", by_id)
    runs = stored(ordered.mapInArrow(_runs(largest), _RUN_SCHEMA), "content-runs")
    pick = F.max if largest else F.min
    merged = (runs.filter("edge and head").groupBy("sha")
              .agg(pick("keep_id").alias("all_keep"), F.sum("size").alias("all_size")))
    # at most two keys per sorted partition: a bounded table
    out = runs.join(F.broadcast(merged.withColumn("edge", F.lit(True))), ["sha", "edge"], "left")
    keep_id = F.when(F.col("all_size").isNull(), F.col("keep_id")).otherwise(F.col("all_keep"))
    return out.select(
        "doc_id", keep_id.alias("keep_id"),
        F.coalesce("all_size", "size").alias("group_size"),
        (F.col("pick") & F.col("doc_id").eqNullSafe(keep_id)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


@register("op3_content_sort_dedup", """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS n
           FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY n) AS keep_id, count(*) OVER (PARTITION BY n) AS group_size,
       row_number() OVER (PARTITION BY n ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(n) AS text_sha256
FROM t""")
def op3(spark, sf_dir):
    return content_sort_dedup(read_table(spark, sf_dir, "documents"), keep="largest")
