"""Substring deduplication by sliding sentence spans.

Sentences end at . ! ? or at a line break; one longer than ``CUT`` words is cut after the words whose hash
falls in a fixed class, one in four, and every ``PIECE`` words where none comes for that long.  So
the cuts inside a passage depend, from its first such word on, on the passage alone, wherever in a
sentence it was put.  From every sentence a run starts that takes
at least ``RUN`` consecutive sentences and ``MIN_WORDS`` words.  The hashes of all runs are joined
over the whole corpus: a run met more than once is a repeated span, its first occurrence by
(id, position) stays, and every sentence that a non-first occurrence covers is removed.

(hash, id, position) is shuffled once and sorted; a hash's first row is carried along as the others are
met.  What a piece of a task (1 MB of text) holds of a hash travels as one row, so a passage
that sits in a third of all documents is few rows.  Of the texts only those that a bitmap of the ids
with spans lets through are shuffled.

Defined cases: words are compared with A-Z lower-cased and white space ignored; null, empty and short
texts have no runs and stay as they are; repeats inside one document count like others; rows equal in
id and text are one document (their spans do not repeat each other); a removal is applied only where
the run's hash is found at its place, so rows that merely share an id do not affect each other; null
ids sort first; empty tables give no rows; all other columns pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import IdFilter, read_table, stored
from .kernels import Words, chunks, combine, mix64, words
from .registry import register

RUN = 3
MIN_WORDS = 15
CUT = 16
PIECE = 8
_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?")] = True


def sentences(c, w: Words, cut: int):
    """(row, first word, word after the last, hash) of each sentence."""
    n = len(w.hash)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, np.uint64)
    lines = np.zeros(len(c.buf) + 1, np.int64)
    np.cumsum(c.buf == 10, out=lines[1:])
    stop = np.ones(n, bool)
    stop[:-1] = (_ENDS[c.buf[w.end[:-1] - 1]] | (lines[w.start[1:]] > lines[w.end[:-1]])
                 | (w.row[1:] != w.row[:-1]))
    first = np.concatenate([[0], np.flatnonzero(stop)[:-1] + 1])
    size = np.diff(np.append(first, n))
    long = np.repeat(size > cut, size)
    stop |= long & (mix64(w.hash + np.uint64(5)) & np.uint64(3) == 0)
    first = np.concatenate([[0], np.flatnonzero(stop)[:-1] + 1])
    size = np.diff(np.append(first, n))
    cut = np.where(long[first], min(PIECE, cut), cut)
    pieces = -(-size // cut)                                  # where the content gives no cut
    step = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = np.repeat(first, pieces) + step * np.repeat(cut, pieces)
    last = np.append(first[1:], n)
    place = np.arange(n) - np.repeat(first, last - first)
    h = np.add.reduceat(mix64(w.hash + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), first)
    return w.row[first], first, last, mix64(h + (last - first).astype(np.uint64))


def runs(row, first, last, h, n_run: int, min_words: int):
    """(start sentence, sentence after the end, hash) of the run that starts at each sentence, where the
    text holds enough sentences and words after it."""
    n = len(row)
    if n < n_run:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, np.uint64)
    s = np.arange(n)
    e = np.maximum(s + n_run, np.searchsorted(last, first + min_words) + 1)
    ok = e <= n
    s, e = s[ok], e[ok]
    ok = row[e - 1] == row[s]
    s, e = s[ok], e[ok]
    # order-sensitive hash of sentences s..e-1: sums of hashes mixed with their place in the run
    size = e - s
    flat = np.repeat(s - (np.cumsum(size) - size), size) + np.arange(size.sum())
    place = flat - np.repeat(s, size)
    total = np.add.reduceat(mix64(h[flat] + place.astype(np.uint64)), np.cumsum(size) - size) if len(s) else h[:0]
    return s, e, combine([total, size.astype(np.uint64)], 3)


def _text_runs(c, n_run, min_words, cut):
    row, first, last, h = sentences(c, w := words(c), cut)
    s, e, g = runs(row, first, last, h, n_run, min_words)
    return w, row, first, last, np.searchsorted(row, np.arange(c.n + 1)), s, e, g


def span_table(docs: DataFrame, id_col: str, text_col: str, n_run: int, min_words: int, cut: int) -> DataFrame:
    """(h, doc, pos, more): once per run hash and piece of a task the first occurrence there, and the others."""
    def run(batches):
        for b in batches:
            ids = b.column("doc")
            for c in chunks(b.column("text")):
                _, row, _, _, at, s, _, g = _text_runs(c, n_run, min_words, cut)
                doc, pos = ids.take(pa.array(c.at + row[s])), (s - at[row[s]]).astype(np.int32)
                # by hash, then by the order of the occurrences, null ids first
                order = np.lexsort((pos, doc.fill_null(0).to_numpy(), doc.is_valid().to_numpy(zero_copy_only=False), g))
                g, pos = g[order], pos[order]
                doc = doc.take(pa.array(order))
                new = np.ones(len(g), bool)
                new[1:] = g[1:] != g[:-1]
                lead, rest = np.flatnonzero(new), np.flatnonzero(~new)
                offs = np.searchsorted(rest, np.append(lead, len(g)))
                more = pa.ListArray.from_arrays(
                    pa.array(offs, pa.int32()),
                    pa.StructArray.from_arrays([doc.take(pa.array(rest)), pa.array(pos[rest])], names=["doc", "pos"]),
                    mask=pa.array(np.diff(offs) == 0))
                yield pa.RecordBatch.from_arrays([pa.array(g[lead].view(np.int64)), doc.take(pa.array(lead)),
                                                  pa.array(pos[lead]), more], names=["h", "doc", "pos", "more"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "h long, doc long, pos int, more array<struct<doc: long, pos: int>>")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_run: int = RUN,
                   min_words: int = MIN_WORDS, cut: int = CUT) -> DataFrame:
    """Per document with a non-first repeated span: doc, spans (pos, h), first_ids (documents that keep
    a first occurrence)."""
    t = span_table(docs, id_col, text_col, n_run, min_words, cut)
    # rows of a hash come in order, so its first one is known when the others are met
    so_far = Window.partitionBy("h").orderBy("doc", "pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = F.struct("doc", "pos")
    met = (t.withColumn("first", F.first(at).over(so_far))
           .filter(F.col("more").isNotNull() | ~at.eqNullSafe(F.col("first"))))
    every = F.concat(F.array(at), F.coalesce("more", F.array().cast("array<struct<doc: bigint, pos: int>>")))
    return (met.select("h", "first", F.inline(every)).filter(~at.eqNullSafe(F.col("first")))
            .groupBy("doc").agg(F.collect_set(F.struct("pos", "h")).alias("__spans"),
                                F.collect_set("first.doc").alias("first_ids")))


def _removal(n_run, min_words, cut, keep_all: bool, extra):
    """Applies the joined spans to texts."""
    def run(batches):
        for b in batches:
            text = b.column("__span_text")
            spans = b.column("__spans")
            has = spans.is_valid().to_numpy(zero_copy_only=False)
            new, total, gone, cuts = [None] * b.num_rows, [0] * b.num_rows, [0] * b.num_rows, [[] for _ in range(b.num_rows)]
            for c in chunks(text):
                w, row, first, last, at, s, e, g = _text_runs(c, n_run, min_words, cut)
                where = {int(x): k for k, x in enumerate(s)}
                for r in range(c.n):
                    i = c.at + r
                    total[i] = int(at[r + 1] - at[r])
                    if not has[i]:
                        continue
                    drop = np.zeros(total[i], bool)
                    for p in spans[i].as_py():
                        k = where.get(int(at[r]) + p["pos"])
                        if k is not None and p["pos"] < total[i] and int(g[k].astype(np.int64)) == p["h"]:
                            drop[p["pos"]:p["pos"] + int(e[k] - s[k])] = True
                    gone[i] = int(drop.sum())
                    if not gone[i]:
                        continue
                    # cut from the first byte of a removed run to the next kept sentence
                    raw, o = c.bytes_of(r), int(c.offs[r])
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], drop, [0]])))
                    keep, pos = [], 0
                    for a, z in zip(edges[::2], edges[1::2]):
                        lo = int(w.start[first[at[r] + a]]) - o
                        hi = int(w.start[first[at[r] + z]]) - o if z < total[i] else len(raw)
                        keep.append(raw[pos:lo])
                        cuts[i].append({"start": lo, "end": int(w.end[last[at[r] + z - 1] - 1]) - o})
                        pos = hi
                    new[i] = b"".join([*keep, raw[pos:]]).decode("utf-8")
            out = pa.RecordBatch.from_arrays(
                [*[b.column(n) for n in extra], pa.array(new, pa.string()), pa.array(total, pa.int64()),
                 pa.array(gone, pa.int64()),
                 pa.array(cuts, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                names=[*extra, "__span_new", "n_sentences", "n_removed", "removed"])
            yield out if keep_all else out.filter(pa.array(np.array(gone) > 0))
    return run


def remove_repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_run: int = RUN,
                          min_words: int = MIN_WORDS, cut: int = CUT, changed_only: bool = False) -> DataFrame:
    """``docs`` with repeated spans removed from the text, plus n_sentences, n_removed, removed (byte spans
    of the old text) and first_ids; ``changed_only`` leaves out the documents that lose nothing."""
    spans = stored(repeated_spans(docs, id_col, text_col, n_run, min_words, cut).withColumnRenamed("doc", "__span_doc"), "spans")
    texts = docs.withColumns({"__span_text": F.col(text_col).cast("string"), "__span_id": F.col(id_col).cast("long")})
    # only texts that may hold a span are shuffled
    maybe = F.col("__span_id").isNull() | IdFilter(spans.select("__span_doc")).column("__span_id")
    d = texts.filter(maybe).join(spans, F.col("__span_id").eqNullSafe(F.col("__span_doc")), "inner" if changed_only else "left")
    if not changed_only:
        d = d.unionByName(texts.filter(~maybe), allowMissingColumns=True)
    d = d.drop("__span_doc", "__span_id")
    extra = [c for c in d.columns if c not in ("__span_text", "__spans")]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema if f.name in extra],
                        "__span_new string, n_sentences long, n_removed long, removed array<struct<start: long, end: long>>"])
    out = d.mapInArrow(_removal(n_run, min_words, cut, not changed_only, extra), schema)
    return out.withColumn(text_col, F.coalesce("__span_new", text_col)).drop("__span_new")


@register("op5_sentence_spans")
def op5(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeated_spans(docs, changed_only=True).select(
        "doc_id", "n_sentences", "n_removed", "removed", F.sort_array("first_ids").alias("first_ids"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
