"""Quality classifier: a factorisation machine.

Features of a whole text: its words hashed to ``DIM`` slots (counts scaled to unit length) and
statistics of its structure and metadata, each as one slot per bin: shares of capitals, symbols,
bars, digits, repeated neighbours and distinct words over the document, the highest such shares
of any line, word and line lengths, and the table's character count.  A linear term and rank
``RANK`` pairwise interactions are scored in linear time by
    sum_{i<j} <v_i, v_j> x_i x_j = (|sum_i v_i x_i|^2 - sum_i |v_i x_i|^2) / 2.

Trained by AdaGrad on the logistic loss over at most ``TRAIN_ROWS`` labelled documents (a bounded
sample by id hash) whose features come to the driver; the model (a few MB) is broadcast and every
document is scored in one map over the table.

Defined cases: null and empty texts have structure bins only and get a score from them; a null
character count has a bin of its own; without labels of both classes the score is the share of
label 1 (0.5 without labels); rows are scored one by one, so repeated rows and ties change nothing;
columns other than id, text and the character count are ignored; empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, labelled_sample, read_table
from .kernels import byte_spans, chunks, words
from .registry import register

TRAIN_ROWS = 12_000
DIM = 1 << 15
RANK = 6
EPOCHS = 6
BATCH = 64
CUTOFF = 0.3

# Bin edges of shares; the byte classes counted.
SHARE_EDGES = np.array([0.001, 0.005, 0.01, 0.02, 0.04, 0.07, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.75, 0.9])
BINS = len(SHARE_EDGES) + 1
_CLASSES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*+/<=>@\\^_`{}~", b"|", b"!?", b"0123456789"]
_IS = []
for _c in _CLASSES:
    _m = np.zeros(256, bool)
    _m[list(_c)] = True
    _IS.append(_m)
N_STATS = 2 * (len(_CLASSES) + 1) + 5


def _ratio(a, b):
    return a / np.maximum(b, 1)


def _log_bin(x):
    return np.minimum(np.log2(np.maximum(x, 0) + 1).astype(np.int64), BINS - 1)


def _share_bin(x):
    return np.searchsorted(SHARE_EDGES, x)


def features(c, n_chars: np.ndarray):
    """(row, slot, value) of all features of a chunk, rows ascending; every row has its structure slots."""
    w = words(c)
    count = np.diff(w.first)
    # distinct words and their counts
    order = np.lexsort((w.hash, w.row))
    r, h = w.row[order], w.hash[order]
    new = np.ones(len(h), bool)
    if len(h) > 1:
        new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(h))).astype(np.float64)
    r, slot = r[at], (h[at] % np.uint64(DIM)).astype(np.int64)
    distinct = np.bincount(r, minlength=c.n)
    norm = np.sqrt(np.bincount(r, times ** 2, minlength=c.n))
    value = times / norm[r]
    # structure over documents and over lines
    repeat = np.zeros(len(w.hash) + 1, np.int64)
    if len(w.hash) > 1:
        repeat[2:] = np.cumsum((w.hash[1:] == w.hash[:-1]) & (w.row[1:] == w.row[:-1]))
    line_s, line_e = byte_spans(c, c.buf != 10)
    line_row = np.searchsorted(c.offs[1:], line_s, "right")
    first_w, last_w = np.searchsorted(w.start, line_s), np.searchsorted(w.start, line_e)
    n_w = last_w - first_w
    solid = np.flatnonzero(n_w >= 4)                       # shorter lines say little
    n_bytes = np.diff(c.offs)
    bins = []

    def top(per_line):
        out = np.zeros(c.n)
        if len(solid):
            np.maximum.at(out, line_row[solid], per_line[solid])
        return _share_bin(out)

    for mask in _IS:
        total = np.zeros(len(c.buf) + 1, np.int64)
        np.cumsum(mask[c.buf], out=total[1:])
        bins.append(_share_bin(_ratio(total[c.offs[1:]] - total[c.offs[:-1]], n_bytes)))
        bins.append(top(_ratio(total[line_e] - total[line_s], line_e - line_s)))
    last = len(repeat) - 1
    bins.append(_share_bin(_ratio(repeat[np.minimum(w.first[1:], last)] - repeat[np.minimum(w.first[:-1] + 1, last)], count)))
    bins.append(top(_ratio(repeat[np.minimum(last_w, last)] - repeat[np.minimum(first_w + 1, last)], n_w)))
    bins.append(_share_bin(_ratio(distinct, count)))
    bins.append(_log_bin(count))
    bins.append(_log_bin(_ratio(n_bytes, count)))
    bins.append(_log_bin(_ratio(count, np.bincount(line_row, minlength=c.n))))
    bins.append(np.where(np.isnan(n_chars), BINS - 1, np.minimum(_log_bin(np.nan_to_num(n_chars)) // 2, BINS - 2)))
    stats = np.stack(bins, 1) + DIM + BINS * np.arange(N_STATS)
    row = np.concatenate([r, np.repeat(np.arange(c.n), N_STATS)])
    slot = np.concatenate([slot, stats.ravel()])
    value = np.concatenate([value, np.full(c.n * N_STATS, 0.5)])
    order = np.argsort(row, kind="stable")
    return row[order], slot[order], value[order]


class FactorisationMachine:
    def __init__(self, dim: int, rank: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.bias, self.w = 0.0, np.zeros(dim, np.float32)
        self.v = rng.normal(0, 0.02, (dim, rank)).astype(np.float32)

    def margin(self, starts, slot, value):
        """Rows given by the start of each in the flat features; also what the gradient needs."""
        x = value.astype(np.float32)
        vx = self.v[slot] * x[:, None]
        s = np.add.reduceat(vx, starts, axis=0)
        q = np.add.reduceat(vx * vx, starts, axis=0)
        return self.bias + np.add.reduceat(self.w[slot] * x, starts) + 0.5 * (s * s - q).sum(1), s, vx, x

    def fit(self, indptr, slot, value, y, epochs: int, batch: int, rate: float = 0.1, l2: float = 1e-5, seed: int = 5):
        rng = np.random.default_rng(seed)
        gw, gv, gb = np.full_like(self.w, 1e-3), np.full_like(self.v, 1e-3), 1e-3
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for at in range(0, len(y), batch):
                rows = order[at:at + batch]
                n = indptr[rows + 1] - indptr[rows]
                starts = np.cumsum(n) - n
                flat = np.repeat(indptr[rows] - starts, n) + np.arange(n.sum())
                j = slot[flat]
                m, s, vx, x = self.margin(starts, j, value[flat])
                d = ((1 / (1 + np.exp(-np.clip(m, -30, 30)))) - y[rows]).astype(np.float32) / len(rows)
                dx = np.repeat(d, n) * x
                u, inv = np.unique(j, return_inverse=True)
                g1 = np.bincount(inv, dx, len(u)).astype(np.float32) + l2 * self.w[u]
                g2 = np.zeros((len(u), self.v.shape[1]), np.float32)
                np.add.at(g2, inv, dx[:, None] * (np.repeat(s, n, axis=0) - vx))
                g2 += l2 * self.v[u]
                gw[u] += g1 ** 2
                gv[u] += g2 ** 2
                self.w[u] -= rate * g1 / np.sqrt(gw[u])
                self.v[u] -= rate * g2 / np.sqrt(gv[u])
                gb += d.sum() ** 2
                self.bias -= rate * d.sum() / np.sqrt(gb)
        return self

    def probability(self, starts, slot, value):
        return 1 / (1 + np.exp(-np.clip(self.margin(starts, slot, value)[0], -30, 30)))


def _metadata(b, name="n_chars"):
    return b.column(name).cast(pa.float64()).to_numpy(zero_copy_only=False)


def fit(docs: DataFrame, labels: DataFrame, training, target: str = "quality", rows: int = TRAIN_ROWS,
        n_chars_col: str | None = "n_chars"):
    """A trained machine, or the share of label 1 where there is nothing to tell apart."""
    meta = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       _meta_col(n_chars_col))
    sample = labelled_sample(meta, labels, target, training, rows, extra=("n_chars",))

    def run(batches):
        for b in batches:
            n_chars = _metadata(b)
            for c in chunks(b.column("text")):
                row, slot, value = features(c, n_chars[c.at:c.at + c.n])
                cut = np.searchsorted(row, np.arange(c.n + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(cut), pa.array(x)) for x in
                         (slot.astype(np.int32), value.astype(np.float32))]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(c.at, c.n), b.column("label").slice(c.at, c.n), *lists],
                    names=["doc_id", "label", "slot", "value"])

    t = (sample.mapInArrow(run, "doc_id long, label int, slot array<int>, value array<float>")
         .toArrow().sort_by("doc_id").combine_chunks())          # TRAIN_ROWS documents at most
    y = t["label"].to_numpy().astype(np.float64)
    if not len(y) or y.min() == y.max():
        return float(y[0]) if len(y) else 0.5
    n = np.array([len(x) for x in t["slot"]])
    indptr = np.concatenate([[0], np.cumsum(n)])
    slot = np.concatenate([x.values.to_numpy() for x in t["slot"]]).astype(np.int64)
    value = np.concatenate([x.values.to_numpy() for x in t["value"]])
    return FactorisationMachine(DIM + BINS * N_STATS, RANK).fit(indptr, slot, value, (y > 0).astype(float), EPOCHS, BATCH)


def _meta_col(name):
    return (F.col(name).cast("double") if name else F.lit(None).cast("double")).alias("n_chars")


def score_documents(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text",
                    n_chars_col: str | None = "n_chars") -> DataFrame:
    """doc_id, score (probability of label 1)."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = held.value
        for b in batches:
            score = np.full(b.num_rows, m if isinstance(m, float) else 0.0)
            if not isinstance(m, float):
                n_chars = _metadata(b)
                for c in chunks(b.column("text")):
                    row, slot, value = features(c, n_chars[c.at:c.at + c.n])
                    score[c.at:c.at + c.n] = m.probability(np.searchsorted(row, np.arange(c.n)), slot, value)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       _meta_col(n_chars_col))
    return rows.mapInArrow(run, "doc_id long, score double")


@register("op1_quality_fm")
def op1(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    out = crc_mod(F.col("doc_id"), 5) == 0
    model = fit(docs, read_table(spark, sf_dir, "labels"), ~out)
    return score_documents(docs, model).select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= CUTOFF).cast("int").alias("predicted"))
