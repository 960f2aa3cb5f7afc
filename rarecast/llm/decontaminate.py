"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are short and documents may be very long, so resemblance says little; what counts
is how much of the item lies inside the document.  Items are partitioned by the size of their
shingle set (powers of two).  Each partition has its own sketch length: an item's sketch is its
``k`` smallest MinHash values.  An item of n shingles may miss at most ``n - ceil(t n)`` of them,
so a document that contains it holds at least ``k`` minus that many sketch values.  With k above
the allowed misses of the partition's largest size, no match can be lost.  Candidates are then
verified by the exact share of the item's shingles in the whole document.

Items go to the executors in blocks of about ``BLOCK_HASHES`` shingles (a proven size), every
document is read against each block, and nothing is shuffled.

Defined cases: words are lower-cased (A-Z); a text with fewer than ``width`` words is one
shingle, which only the same short text contains; texts without words contain nothing and are
in nothing; null texts are empty; equal items or documents are reported separately; null ids
are legal; an empty benchmark or table gives no matches; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read_table, stored
from .kernels import chunks, distinct_per_row, list_array, shingles, words
from .registry import register

WIDTH = 5
THRESHOLD = 0.8
BLOCK_HASHES = 2_000_000


def allowed_misses(n, threshold: float):
    return n - np.ceil(np.asarray(n) * threshold - 1e-9).astype(np.int64)


def sketch_sizes(n: np.ndarray, threshold: float) -> np.ndarray:
    """Sketch length of each item, from the upper end of its size partition."""
    upper = 2 ** np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64)
    return np.minimum(n, 2 * allowed_misses(upper, threshold) + 4)


def item_sets(benchmark: DataFrame, width: int) -> DataFrame:
    def sets(batches):
        for b in batches:
            for c in chunks(b.column("text")):
                row, h = shingles(words(c), c.n, width)
                flat, offs = distinct_per_row(row, h, c.n)
                yield pa.RecordBatch.from_arrays(
                    [b.column("item_id").slice(c.at, c.n), list_array(flat, offs)], names=["item_id", "hashes"])

    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return stored(items.mapInArrow(sets, "item_id long, hashes array<long>").filter("size(hashes) > 0"), "items")


class _Block:
    """Items of one block: flat sorted hash sets, and an index from sketch value to items."""

    def __init__(self, rows, threshold: float):
        self.ids = [r[0] for r in rows]
        self.sets = [np.array(r[1], np.int64).view(np.uint64) for r in rows]     # sorted, distinct
        n = np.array([len(s) for s in self.sets])
        self.n, k = n, sketch_sizes(n, threshold)
        self.need = np.maximum(k - allowed_misses(n, threshold), 1)
        self.full = np.ceil(n * threshold - 1e-9).astype(np.int64)
        value = np.concatenate([s[:m] for s, m in zip(self.sets, k)])
        item = np.repeat(np.arange(len(n)), k)
        order = np.argsort(value, kind="stable")
        self.value, first, count = np.unique(value[order], return_index=True, return_counts=True)
        self.item, self.first, self.count = item[order], first, count
        bits = min(26, max(10, int(np.ceil(np.log2(len(self.value)))) + 5))
        self.shift = np.uint64(64 - bits)
        self.seen = np.zeros(1 << bits, bool)
        self.seen[(self.value >> self.shift).astype(np.int64)] = True

    def matches(self, row, h, n_rows):
        """(row, item, shared shingles) of the rows that contain an item."""
        maybe = np.flatnonzero(self.seen[(h >> self.shift).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.value, h[maybe]), len(self.value) - 1)
        hit = self.value[at] == h[maybe]
        maybe, at = maybe[hit], at[hit]
        if not len(maybe):
            return
        key = np.unique(np.stack([row[maybe], at], 1), axis=0)                    # once per text
        times = self.count[key[:, 1]]
        step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        pair = np.repeat(key[:, 0], times) * len(self.n) + self.item[np.repeat(self.first[key[:, 1]], times) + step]
        pair, hits = np.unique(pair, return_counts=True)
        r, i = np.divmod(pair, len(self.n))
        good = hits >= self.need[i]
        sets = {}
        for a, b in zip(r[good], i[good]):
            if a not in sets:
                lo, hi = np.searchsorted(row, [a, a + 1])
                sets[a] = np.unique(h[lo:hi])
            s = sets[a]
            shared = int((s[np.minimum(np.searchsorted(s, self.sets[b]), len(s) - 1)] == self.sets[b]).sum())
            if shared >= self.full[b]:
                yield int(a), int(b), shared


def _blocks(docs: DataFrame, benchmark: DataFrame, width: int, threshold: float, block: int):
    """Broadcast variables, one per block of items."""
    items = item_sets(benchmark, width)
    total = items.agg(F.sum(F.size("hashes"))).first()[0] or 0
    n = -(-total // block)
    deal = F.pmod(F.xxhash64("hashes", "item_id"), F.lit(n))
    for k in range(n):
        rows = items.filter(deal == k).collect()      # about ``block`` hashes
        if rows:
            yield docs.sparkSession.sparkContext.broadcast(_Block(rows, threshold))


def contained_items(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = WIDTH, threshold: float = THRESHOLD, block: int = BLOCK_HASHES) -> DataFrame:
    """One row per (document, item it contains): doc_id, item_id, n_item, n_shared, containment."""
    schema = "doc_id long, item_id long, n_item long, n_shared long, containment double"
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = None
    for held in _blocks(docs, benchmark, width, threshold, block):
        def find(batches, held=held):
            items = held.value
            for b in batches:
                found = []
                for c in chunks(b.column("text")):
                    row, h = shingles(words(c), c.n, width)
                    found += [(c.at + r, i, s) for r, i, s in items.matches(row, h, c.n)]
                if found:
                    r, i, s = (np.array(x) for x in zip(*found))
                    yield pa.RecordBatch.from_arrays(
                        [b.column("doc_id").take(pa.array(r)), pa.array([items.ids[x] for x in i], pa.int64()),
                         pa.array(items.n[i]), pa.array(s), pa.array(s / items.n[i])],
                        names=["doc_id", "item_id", "n_item", "n_shared", "containment"])

        part = rows.mapInArrow(find, schema)
        out = part if out is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", width: int = WIDTH,
                      threshold: float = THRESHOLD, block: int = BLOCK_HASHES) -> DataFrame:
    """``docs`` without the rows whose text contains an item."""
    for held in _blocks(docs, benchmark, width, threshold, block):
        def clean(batches, held=held):
            for b in batches:
                text = b.column(b.schema.get_field_index(text_col))
                keep = np.ones(b.num_rows, bool)
                for c in chunks(text):
                    row, h = shingles(words(c), c.n, width)
                    for r, _, _ in held.value.matches(row, h, c.n):
                        keep[c.at + r] = False
                yield b.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs


@register("op8_containment_search", """
WITH s AS (SELECT doc_id AS id, row_number() OVER () AS rk, 'd' AS kind, text FROM documents
           UNION ALL SELECT item_id, row_number() OVER (), 'i', text FROM benchmark),
w AS (SELECT id, rk, kind, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM s),
g AS (SELECT DISTINCT id, rk, kind, array_to_string(ws[p:p + 4], ' ') AS sh
      FROM (SELECT *, unnest(range(1, greatest(len(ws) - 3, 2))) AS p FROM w WHERE len(ws) > 0)),
n AS (SELECT rk, count(*) AS n FROM g WHERE kind = 'i' GROUP BY rk),
m AS (SELECT d.id AS doc_id, i.id AS item_id, d.rk AS drk, i.rk AS irk, count(*) AS shared
      FROM g d JOIN g i ON d.sh = i.sh WHERE d.kind = 'd' AND i.kind = 'i' GROUP BY ALL)
SELECT doc_id, item_id, n AS n_item, shared AS n_shared, shared / n AS containment
FROM m JOIN n ON irk = n.rk WHERE 10 * shared >= 8 * n""")
def op8(spark, sf_dir):
    return contained_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
