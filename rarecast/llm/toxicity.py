"""Toxicity by maximum-scoring segments.

A token's log-odds of the toxic class comes from a chain of Dirichlet priors: a word's share
of toxic occurrences is smoothed towards that of its longest known prefix, that one towards
the next shorter prefix, and the shortest towards the class share.  Words that training has
not met so still get their prefix's log-odds.  A document's tokens, minus a fixed cost each,
form a score sequence; a linear-time scan (Ruzzo and Tompa) finds all maximal segments.

Calibration is by extreme values: for a random clean sequence the best segment score S over n
tokens exceeds s with about K n exp(-lambda s) expected segments.  lambda solves
E[exp(lambda score)] = 1 over clean training tokens; K makes the expected number of segments
equal to that seen in clean training documents.  Segments whose expected number is below
``E_VALUE`` are the significant passages; a document's evidence is the summed surprise of its
segments, mapped to a probability by a one-variable logistic fit.

Learned from at most ``TRAIN_ROWS`` labelled documents (a bounded sample by id hash); the unit
table keeps at most ``MAX_UNITS`` units.  Scoring is one map over whole texts.

Defined cases: null, empty and wordless texts have no segments and get the evidence 0's
probability; without labels of both classes every score is the share of label 1 (0.0 without
labels); rows are scored one by one, so repeated rows, ties and extra columns change nothing;
empty tables give no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, labelled_sample, logistic_1d, read_table, stored
from .kernels import IS_SEP, HashIndex, chunks, combine, span_hash, words
from .registry import register

TRAIN_ROWS = 20_000
MAX_UNITS = 1 << 17
PREFIXES = (6, 5, 4)         # bytes, longest first
STRENGTH = 4.0               # occurrences that a prior is worth
COST = 1.0                   # of each token in a segment
E_VALUE = 0.05
CUTOFF = 0.3

SEPARATORS = IS_SEP.copy()
SEPARATORS[[b for b in range(33, 127) if not chr(b).isalnum()]] = True


def _units(c):
    """Words and, level by level (whole word, then each prefix), their unit hashes."""
    w = words(c, SEPARATORS)
    levels = [w.hash]
    for k in PREFIXES:
        h = combine([span_hash(c, w.start, np.minimum(w.end, w.start + k))], k)
        levels.append(np.where(w.end - w.start >= k, h, np.uint64(0)))
    return w, levels


def _count_units(batches):
    """Per batch: (level, unit, parent unit, occurrences in toxic and in clean documents)."""
    for b in batches:
        label = b.column("label").to_numpy(zero_copy_only=False)
        held = [None] * (1 + len(PREFIXES))
        for c in chunks(b.column("text")):
            w, levels = _units(c)
            toxic = (label[c.at + w.row] == 1).astype(np.int64)
            for k, h in enumerate(levels):
                parent = np.zeros(len(h), np.uint64)
                for j in range(len(levels) - 1, k, -1):      # the longest prefix the unit has
                    parent = np.where(levels[j] != 0, levels[j], parent)
                part = [h, parent, toxic, 1 - toxic]
                if held[k] is not None:
                    part = [np.concatenate(x) for x in zip(held[k], part)]
                u, one, at = np.unique(part[0], return_index=True, return_inverse=True)
                held[k] = [u, part[1][one], *[np.bincount(at, x, len(u)).astype(np.int64) for x in part[2:]]]
        for k, x in enumerate(held):
            if x is not None:
                u, parent, toxic, clean = x
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(u), k, np.int32)), pa.array(u.view(np.int64)), pa.array(parent.view(np.int64)),
                     pa.array(toxic), pa.array(clean)], names=["level", "unit", "parent", "toxic", "clean"])


class Model:
    """Log-odds by unit; calibration constants."""

    def __init__(self, levels, share):
        self.levels, self.share = levels, share      # levels: (index of unit hashes, log-odds)
        self.lam, self.k, self.a, self.b = 1.0, 1.0, 0.0, 1.0

    def token_scores(self, levels):
        score = np.zeros(len(levels[0]))
        todo = np.arange(len(levels[0]))
        for h, (unit, odds) in zip(levels, self.levels):
            at = unit.find(h[todo])
            hit = at >= 0
            score[todo[hit]] = odds[at[hit]]
            todo = todo[~hit]
        repeat = np.flatnonzero(levels[0][1:] == levels[0][:-1]) + 1
        score[repeat] = np.minimum(score[repeat], 0)      # a word said again at once adds nothing
        return score - COST

    def segments(self, c):
        """Per text with any: (row, n tokens, [(first token, last token, score)]), and the words."""
        w, levels = _units(c)
        s = self.token_scores(levels)
        total = np.concatenate([[0.0], np.cumsum(s)])
        up = np.flatnonzero(s > 0)
        if not len(up):
            return w, []
        new = np.ones(len(up), bool)                  # runs of positive tokens of one text
        new[1:] = (np.diff(up) > 1) | (np.diff(w.row[up]) > 0)
        first, last = up[new], up[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(up) - 1]])]
        rows = w.row[first]
        cut = np.flatnonzero(np.diff(rows)) + 1
        out = []
        for f, e in zip(np.split(first, cut), np.split(last, cut)):
            r = int(w.row[f[0]])
            segs = maximal_segments(total[f].tolist(), total[e + 1].tolist())
            out.append((r, int(w.first[r + 1] - w.first[r]),
                        [(int(f[i]), int(e[j]), v) for i, j, v in segs]))
        return w, out

    def surprise(self, n: int, segs) -> float:
        """Summed surprise of a text's segments beyond what its length explains."""
        base = math.log(max(self.k * n, 1e-12))
        return sum(max(self.lam * v - base, 0.0) for _, _, v in segs)

    def probability(self, x):
        return 1 / (1 + np.exp(-np.clip(self.a + self.b * np.log1p(x), -30, 30)))


def maximal_segments(left: list, right: list) -> list:
    """Runs given by the running total before and after each -> maximal segments (first run, last run,
    score).  Each kept segment points to the nearest earlier one with a smaller left total, so the
    search for a partner skips what cannot be one."""
    segs, back = [], []            # [first, last, left, right]; index of the partner below
    for k in range(len(left)):
        cur = [k, k, left[k], right[k]]
        while True:
            j = len(segs) - 1
            while j >= 0 and segs[j][2] >= cur[2]:
                j = back[j]
            if j < 0 or segs[j][3] >= cur[3]:
                segs.append(cur)
                back.append(j)
                break
            cur = [segs[j][0], cur[1], segs[j][2], cur[3]]
            del segs[j:], back[j:]
    return [(a, b, r - l) for a, b, l, r in segs]


def _log_odds(counts: DataFrame, share: float) -> list:
    """Per level (units, log-odds), from the MAX_UNITS units seen most often in toxic documents.  A
    parent is seen at least as often as its units, so it is among them too."""
    top = (counts.filter("toxic + clean >= 2 AND unit <> 0")
           .orderBy(F.desc("toxic"), F.desc("clean"), F.desc("level"), "unit").limit(MAX_UNITS).toPandas())
    root = math.log(share / (1 - share))
    known, levels = {}, []
    for k in range(len(PREFIXES), -1, -1):
        t = top[top.level == k].sort_values("unit")
        prior = np.array([known.get(p, share) for p in t.parent])
        theta = (t.toxic.to_numpy(float) + STRENGTH * prior) / (t.toxic + t.clean + STRENGTH).to_numpy(float)
        known.update(zip(t.unit, theta))
        unit = t.unit.to_numpy(np.int64).view(np.uint64)
        order = np.argsort(unit)
        levels.insert(0, (HashIndex(unit[order]), (np.log(theta / (1 - theta)) - root)[order]))
    return levels


def fit(docs: DataFrame, labels: DataFrame, training, target: str = "toxic", rows: int = TRAIN_ROWS) -> Model:
    sample = stored(labelled_sample(docs, labels, target, training, rows), "toxic-train")
    n = dict(sample.groupBy("label").count().collect())
    if not n.get(1) or not sum(v for k, v in n.items() if k != 1):
        return Model([], 1.0 if n.get(1) else 0.0)
    counts = (sample.mapInArrow(_count_units, "level int, unit long, parent long, toxic long, clean long")
              .groupBy("level", "unit").agg(F.max("parent").alias("parent"), F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
    counts = stored(counts, "toxic-units")
    tox, clean = counts.filter("level = 0").agg(F.sum("toxic"), F.sum("clean")).first()
    if not tox or not clean:
        return Model([], n[1] / sum(n.values()))
    model = Model(_log_odds(counts, tox / (tox + clean)), None)
    held = sample.sparkSession.sparkContext.broadcast(model)

    def measure(batches):
        """Per document: label, tokens, segment scores; and a histogram of clean token scores."""
        m = held.value
        for b in batches:
            label = b.column("label").to_pylist()
            rows_, hist = [], np.zeros(400)
            for c in chunks(b.column("text")):
                w, found = m.segments(c)
                segs = {r: [v for _, _, v in x] for r, _, x in found}
                for r in range(c.n):
                    rows_.append((label[c.at + r], int(w.first[r + 1] - w.first[r]), segs.get(r, [])))
                s = m.token_scores(_units(c)[1])
                is_clean = np.array([label[c.at + r] != 1 for r in range(c.n)])[w.row] if len(s) else np.zeros(0, bool)
                hist += np.histogram(np.clip(s[is_clean], -19.99, 19.99), 400, (-20, 20))[0]
            rows_.append((-1, 0, hist.tolist()))
            yield pa.RecordBatch.from_pylist([{"label": y, "n": k, "segs": v} for y, k, v in rows_], pa.schema(
                [("label", pa.int32()), ("n", pa.int64()), ("segs", pa.list_(pa.float64()))]))

    seen = sample.mapInArrow(measure, "label int, n long, segs array<double>").collect()   # TRAIN_ROWS at most
    hist = np.sum([r.segs for r in seen if r.label == -1], axis=0)
    score = -20 + 0.1 * (np.arange(400) + 0.5)
    if hist[score > 0].sum() and (hist * score).sum() < 0:
        lo, hi = 1e-3, 20.0
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if (hist * np.exp(mid * score)).sum() < hist.sum() else (lo, mid)
        model.lam = lo
    docs_ = [r for r in seen if r.label != -1]
    clean_n = sum(r.n for r in docs_ if r.label != 1)
    # K: as many segments above the median clean score as clean documents show
    v = np.array([x for r in docs_ if r.label != 1 for x in r.segs])
    if len(v):
        mid = float(np.median(v))
        model.k = max((v > mid).sum(), 1) / max(clean_n, 1) * math.exp(model.lam * mid)
    x = np.array([model.surprise(r.n, [(0, 0, s) for s in r.segs]) for r in docs_])
    model.a, model.b = logistic_1d(np.log1p(x), np.array([float(r.label == 1) for r in docs_]))
    return model


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, n_passages, passages (significant ones: first and last byte in UTF-8, score)."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def run(batches):
        m = held.value
        for b in batches:
            ids, score, spans = b.column("doc_id"), np.zeros(b.num_rows), [[] for _ in range(b.num_rows)]
            if not m.levels:
                score[:] = m.share
            else:
                score[:] = m.probability(0.0)
                for c in chunks(b.column("text")):
                    w, found = m.segments(c)
                    for r, n, segs in found:
                        score[c.at + r] = m.probability(m.surprise(n, segs))
                        spans[c.at + r] = [
                            {"start": int(w.start[i] - c.offs[r]), "end": int(w.end[j] - c.offs[r]), "score": v}
                            for i, j, v in segs if m.k * n * math.exp(-m.lam * v) < E_VALUE]
            yield pa.RecordBatch.from_arrays([ids, pa.array(score), pa.array(spans, pa.list_(span))],
                                             names=["doc_id", "score", "passages"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, passages array<struct<start: long, end: long, score: double>>")


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", cutoff: float = CUTOFF) -> DataFrame:
    """``docs`` without the rows whose score reaches ``cutoff``."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = held.value
        for b in batches:
            keep = np.full(b.num_rows, float(m.probability(0.0)) < cutoff if m.levels else m.share < cutoff)
            for c in chunks(b.column(b.schema.get_field_index(text_col))) if m.levels else ():
                for r, n, segs in m.segments(c)[1]:
                    keep[c.at + r] = m.probability(m.surprise(n, segs)) < cutoff
            yield b.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


@register("op9_toxic_segments")
def op9(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    out = crc_mod(F.col("doc_id"), 4) == 2
    model = fit(docs, read_table(spark, sf_dir, "labels"), ~out)
    return score_documents(docs, model).select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= CUTOFF).cast("int").alias("predicted"),
        F.size("passages").cast("long").alias("n_passages"))
