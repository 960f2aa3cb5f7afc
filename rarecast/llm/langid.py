"""Language identification by interpolated Kneser-Ney character models.

A text is read as symbols: letters in lower case, and one blank for each run of anything else, after ``ORDER`` - 1
blanks.  Each language has a model of order ``ORDER``: absolute discounts D = n1 / (n1 + 2 n2) per order, counts
of distinct predecessors below the highest order, down to a uniform share for symbols never seen.  The language of
least cross-entropy (bits a symbol) is chosen.

Models are counted by Spark over at most ``TRAIN_ROWS`` documents of each language (chosen by id hash; the bound on
what a classifier is fitted on), of which one in ``CALIBRATION`` is left for calibration.  Their grams, at most as
many as the sample has symbols, come to the driver, which resolves the recursion once: for each order one sorted
hash array holds the grams of all languages, with log p of every language beside it, and one the histories with the
logs of the backoff factors.  A text then needs one search per symbol, and more only where its gram is in no model.

Calibration: pieces of several sizes of the documents left out give the distance in bits between the best and the
second language and whether the best was right; a logistic fit on the log of that distance is the score (0 to 1).
``rejected`` marks scores under which fewer than ``PRECISION`` of the pieces were right, and texts whose
cross-entropy is far above that of any left-out document of their language.

Defined cases: null texts and texts without a letter are ``und`` with score 0; so is everything if no document has
a language; a null language is not learned from; ids shared by several rows of one language are sampled together;
equal rows get equal results; other columns are ignored; an empty table gives no rows; texts of any length are scored whole.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import crc_mod, logistic_1d, read_table, stored
from .kernels import Chunk, HashIndex, chunks, mix64
from .registry import register

ORDER = 5
TRAIN_ROWS = 1500          # documents of each language that are learned from
CALIBRATION = 8
PIECES = (6, 12, 24, 48, 96, 384)
PRECISION = 0.99
UNKNOWN = "und"

_U = np.uint64
_STEP = _U(0xD6E8FEB86659FD93)
_POWERS = [_U(pow(int(_STEP), k, 1 << 64)) for k in range(ORDER)]
_FOLD: list[np.ndarray] = []


def _fold() -> np.ndarray:
    """Symbol of each code point: the lower-case letter, 32 for what is no letter."""
    if not _FOLD:
        low = np.full(0x110000, 32, np.uint32)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low[c] = ord(ch.lower()[0])
        _FOLD.append(low)
    return _FOLD[0]


class Symbols(NamedTuple):
    sym: np.ndarray        # all texts, each after ORDER - 1 blanks
    first: np.ndarray      # start of each text, its blanks included; one more entry
    letters: np.ndarray    # letters of each text


def symbols(c: Chunk) -> Symbols:
    pad = ORDER - 1
    point = np.frombuffer(c.buf.tobytes().decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), np.uint32)
    lead = np.zeros(len(c.buf) + 1, np.int64)
    np.cumsum((c.buf & 0xC0) != 0x80, out=lead[1:])
    offs = lead[c.offs]
    if offs[-1] != len(point):                                    # not UTF-8: text by text
        texts = [c.bytes_of(i).decode("utf-8", "replace") for i in range(c.n)]
        point = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        offs = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    sym = _fold()[point]
    blank = sym == 32
    keep = np.ones(len(sym), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    starts = offs[:-1][np.diff(offs) > 0]
    keep[starts] = ~blank[starts]                                 # the leading blanks stand for this one
    kept = np.concatenate([[0], np.cumsum(keep)])[offs]
    letter = np.concatenate([[0], np.cumsum(~blank)])[offs]
    first = kept + pad * np.arange(c.n + 1)
    out = np.full(int(first[-1]), 32, np.uint32)
    row = np.repeat(np.arange(c.n), np.diff(kept))
    out[np.arange(int(kept[-1])) + pad * (row + 1)] = sym[keep]
    return Symbols(out, first, np.diff(letter))


def gram_hashes(sym: np.ndarray) -> list[np.ndarray]:
    """For k = 1..ORDER the hash of the k symbols that end at each position (of no use before k - 1)."""
    one = mix64((sym.astype(np.uint64) + _U(1)) * _STEP)
    out = [one]
    for k in range(1, ORDER):
        h = out[-1].copy()
        h[k:] += one[:-k] * _POWERS[k]
        out.append(h)
    return out


def _predicted(s: Symbols) -> np.ndarray:
    """Positions of the symbols that are scored, text by text."""
    n = np.diff(s.first) - (ORDER - 1)
    return np.arange(int(n.sum())) + np.repeat((ORDER - 1) * np.arange(1, len(n) + 1), n)


def _count_grams(batches):
    """Occurrences of the longest grams, chunk by chunk, as their symbols."""
    for b in batches:
        langs = np.array(b.column("lang").to_pylist(), object)
        for c in chunks(b.column("text")):
            s = symbols(c)
            h = gram_hashes(s.sym)[-1]
            row = np.repeat(np.arange(c.n), np.diff(s.first) - (ORDER - 1))
            at = _predicted(s)
            of = langs[c.at:c.at + c.n]
            for lang in sorted(set(of)):
                mine = at[(of == lang)[row]]
                _, one, n = np.unique(h[mine], return_index=True, return_counts=True)
                end = mine[one]
                arrays = [pa.array(s.sym[end - k].astype(np.int32)) for k in range(ORDER - 1, -1, -1)]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(end), pa.string()), *arrays, pa.array(n, pa.int64())],
                                                 names=["lang", *(f"s{k}" for k in range(ORDER)), "n"])


class Model(NamedTuple):
    langs: list[str]
    grams: list[HashIndex]         # by order 1..ORDER
    log_p: list[np.ndarray]        # grams x languages, bits
    histories: list[HashIndex]     # by order 1..ORDER (order 1: the empty history)
    log_rest: list[np.ndarray]     # histories x languages, bits of the backoff factor
    log_unseen: np.ndarray         # bits of a symbol in no model, after the empty history's factor
    fit: tuple[float, float]       # score = 1 / (1 + exp(-(a + b log(1 + distance))))
    cutoff: float
    worst: np.ndarray              # highest cross-entropy accepted, by language


def _hash_rows(s: np.ndarray) -> np.ndarray:
    """Hash of each row of symbols, as ``gram_hashes`` gives it."""
    h = np.zeros(len(s), np.uint64)
    for k in range(s.shape[1]):
        h += mix64((s[:, k].astype(np.uint64) + _U(1)) * _STEP) * _POWERS[s.shape[1] - 1 - k]
    return h


def _by_hash(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes, first row and sum of ``n`` of each."""
    u, first, inverse = np.unique(h, return_index=True, return_inverse=True)
    return u, first, np.bincount(inverse, n, len(u))


def build(langs: list[str], lang: np.ndarray, grams: np.ndarray, n: np.ndarray) -> Model:
    """Model from the counted grams of ``ORDER`` symbols; without calibration."""
    top = len(langs)
    by_order: list[list] = [[None] * top for _ in range(ORDER)]     # (rows of symbols, counts) by order and language
    for j in range(top):
        s, c = grams[lang == j], n[lang == j].astype(np.float64)
        for k in range(ORDER - 1, -1, -1):
            by_order[k][j] = (s, c)
            if k:
                _, first, c = _by_hash(_hash_rows(s[:, 1:]), np.ones(len(s)))
                s = s[first][:, 1:]
    alphabet = len(np.unique(grams)) + 1
    index, log_p, histories, log_rest = [], [], [], []
    below = np.full((1, top), 1.0 / alphabet)
    unseen = None
    for k in range(ORDER):
        every = np.concatenate([s for s, _ in by_order[k]])
        keys, first = np.unique(_hash_rows(every), return_index=True)
        every = every[first]
        h_keys = np.unique(_hash_rows(every[:, :-1])) if k else np.zeros(1, np.uint64)
        h_index = HashIndex(h_keys)
        mine, rest = np.zeros((len(keys), top)), np.ones((len(h_keys), top))
        for j, (s, c) in enumerate(by_order[k]):
            n1, n2 = (c == 1).sum(), (c == 2).sum()
            d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
            of = h_index.find(_hash_rows(s[:, :-1])) if k else np.zeros(len(s), np.int64)
            total, kinds = np.bincount(of, c, len(h_keys)), np.bincount(of, minlength=len(h_keys))
            seen = total > 0
            rest[seen, j] = d * kinds[seen] / total[seen]
            mine[np.searchsorted(keys, _hash_rows(s)), j] = (c - d) / total[of]
        lower = index[-1].find(_hash_rows(every[:, 1:])) if k else np.zeros(len(every), np.int64)
        history = h_index.find(_hash_rows(every[:, :-1])) if k else np.zeros(len(every), np.int64)
        p = mine + rest[history] * below[lower]
        if unseen is None:
            unseen = np.log2(rest[0] / alphabet)
        index.append(HashIndex(keys))
        log_p.append(np.log2(p).astype(np.float32))
        histories.append(h_index)
        log_rest.append(np.log2(rest).astype(np.float32))
        below = p
    return Model(langs, index, log_p, histories, log_rest, unseen, (0.0, 1.0), 0.0, np.full(top, np.inf))


def log_probabilities(m: Model, s: Symbols) -> np.ndarray:
    """Bits (log2 p) of every predicted symbol in every language."""
    at = _predicted(s)
    h = gram_hashes(s.sym)
    out = np.zeros((len(at), len(m.langs)), np.float32)
    todo = np.arange(len(at))
    for k in range(ORDER - 1, -1, -1):
        found = m.grams[k].find(h[k][at[todo]])
        hit = found >= 0
        out[todo[hit]] += m.log_p[k][found[hit]]
        todo = todo[~hit]
        if not len(todo):
            return out
        if k:
            history = m.histories[k].find(h[k - 1][at[todo] - 1])
            known = history >= 0
            out[todo[known]] += m.log_rest[k][history[known]]
    out[todo] += m.log_unseen.astype(np.float32)
    return out


def _best(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best language of each row of total bits, and its distance to the second."""
    best = bits.argmax(1)
    if bits.shape[1] == 1:
        return best, np.full(len(bits), np.inf)
    two = np.partition(bits, -2, axis=1)
    return best, two[:, -1] - two[:, -2]


def _sums(bits: np.ndarray, cut: np.ndarray) -> np.ndarray:
    total = np.zeros((len(bits) + 1, bits.shape[1]))
    np.cumsum(bits, axis=0, dtype=np.float64, out=total[1:])
    return total[cut[1:]] - total[cut[:-1]]


def _learning(docs: DataFrame, training, rows: int, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """(lang, text, spare) of ``rows`` documents of each language at most."""
    d = (docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                     F.col(lang_col).cast("string").alias("lang"), training.alias("learn"))
         .filter("learn AND lang IS NOT NULL AND text IS NOT NULL").drop("learn"))
    draw = F.pmod(F.xxhash64(F.lit(29), "doc_id", "lang"), F.lit(1 << 40))
    share = stored(d.groupBy("lang").agg(F.count("*").alias("n"))
                   .select("lang", F.least(F.lit(float(1 << 40)), F.lit(4.0 * rows * (1 << 40)) / F.col("n")).alias("limit")), "langid-shares")
    near = d.select("doc_id", "lang", draw.alias("draw")).join(share, "lang").filter(F.col("draw") < F.col("limit"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id"))
    ids = stored(near.withColumn("rank", rank).filter(F.col("rank") <= rows).select("doc_id", "lang", "draw").distinct(), "langid-sample")
    return (d.join(ids, [d["doc_id"].eqNullSafe(ids["doc_id"]), d["lang"] == ids["lang"]])
            .select(d["lang"], "text", (F.col("draw") % CALIBRATION == 0).alias("spare")))


def fit(docs: DataFrame, training, rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang") -> Model | None:
    """Model of the languages of the rows for which ``training`` holds; None where there is none."""
    sample = _learning(docs, training, rows, id_col, text_col, lang_col)
    columns = [f"s{k}" for k in range(ORDER)]
    schema = "lang string, " + ", ".join(f"{c} int" for c in columns) + ", n long"
    counted = (sample.filter(~F.col("spare")).select("lang", "text").mapInArrow(_count_grams, schema)
               .groupBy("lang", *columns).agg(F.sum("n").alias("n")).toArrow())       # no more rows than the sample has symbols
    if not counted.num_rows:
        return None
    order = counted.column("lang").to_pylist()
    langs = sorted(set(order))
    number = {x: j for j, x in enumerate(langs)}
    m = build(langs, np.array([number[x] for x in order]), np.stack([counted.column(c).to_numpy() for c in columns], 1),
              counted.column("n").to_numpy())
    held = docs.sparkSession.sparkContext.broadcast(m)

    def pieces(batches):
        m = held.value
        for b in batches:
            lang = b.column("lang").to_pylist()
            for c in chunks(b.column("text")):
                s = symbols(c)
                bits = log_probabilities(m, s)
                cut, rows = s.first - (ORDER - 1) * np.arange(c.n + 1), []
                for i in range(c.n):
                    n = int(cut[i + 1] - cut[i])
                    if not s.letters[i] or lang[c.at + i] not in number:
                        continue
                    for size in (*PIECES, n):
                        if size <= n:
                            at = cut[i] + (n - size) // 2
                            total = bits[at:at + size].sum(0, dtype=np.float64)[None]
                            best, distance = _best(total)
                            rows.append((int(best[0]), size == n, langs[best[0]] == lang[c.at + i], float(distance[0]),
                                         float(-total[0, best[0]] / size)))
                if rows:
                    kinds = (pa.int32(), pa.bool_(), pa.bool_(), pa.float64(), pa.float64())
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)],
                                                     names=["lang", "whole", "right", "distance", "entropy"])

    got = (sample.filter("spare").select("lang", "text")
           .mapInArrow(pieces, "lang int, whole boolean, right boolean, distance double, entropy double").toArrow())
    if got.num_rows:
        m = _calibrated(m, *(got.column(c).to_numpy() for c in ("lang", "whole", "right", "distance", "entropy")))
    return m


def _calibrated(m: Model, lang, whole, right, distance, entropy) -> Model:
    x = np.log1p(np.minimum(distance, 1e9))
    a, b = logistic_1d(x, right.astype(float))
    b = max(b, 1e-3)
    score = 1 / (1 + np.exp(-(a + b * x)))
    order = np.argsort(-score, kind="stable")
    precision = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(precision >= PRECISION)
    cutoff = float(score[order][good[-1]]) if len(good) else 1.0
    worst = np.full(len(m.langs), np.inf)
    for j in range(len(m.langs)):
        mine = whole & right & (lang == j)
        if mine.any():
            worst[j] = 1.25 * entropy[mine].max()
    return m._replace(fit=(float(a), float(b)), cutoff=cutoff, worst=worst)


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", reject: bool = False) -> DataFrame:
    """doc_id, lang_pred, score, cross_entropy, rejected; with ``reject`` a rejected text is ``und`` too."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = held.value
        for b in batches:
            for c in chunks(b.column("text")):
                pred, score = np.full(c.n, UNKNOWN, object), np.zeros(c.n)
                entropy, out = np.full(c.n, np.nan), np.ones(c.n, bool)
                if m is not None:
                    s = symbols(c)
                    cut = s.first - (ORDER - 1) * np.arange(c.n + 1)
                    total = _sums(log_probabilities(m, s), cut)
                    has = np.flatnonzero(s.letters > 0)
                    best, distance = _best(total[has])
                    a, slope = m.fit
                    score[has] = 1 / (1 + np.exp(-np.clip(a + slope * np.log1p(np.minimum(distance, 1e9)), -30, 30)))
                    entropy[has] = -total[has, best] / np.diff(cut)[has]
                    out[has] = (score[has] < m.cutoff) | (entropy[has] > m.worst[best])
                    pred[has] = np.array(m.langs, object)[best]
                    if reject:
                        pred[out] = UNKNOWN
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(c.at, c.n), pa.array(pred, pa.string()), pa.array(score), pa.array(entropy, mask=np.isnan(entropy)),
                     pa.array(out)], names=["doc_id", "lang_pred", "score", "cross_entropy", "rejected"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, cross_entropy double, rejected boolean")


@register("op12_language_id")
def op12(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    found = identify(docs, fit(docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")
