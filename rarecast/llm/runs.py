"""Periodic run detection on a grammar.

A run is a stretch of words with smallest period q, of length max(``MIN_LENGTH``, ``MIN_POWER`` * q) or more,
that no neighbouring word extends keeping the period.  All documents of a chunk are worked on together:

1.  Words become ids (A-Z are not folded).  In a run of four periods each pair of neighbours occurs three
    times, so words are cut where a pair occurs less often in its document; what is left are segments.
2.  Re-Pair: in each document the most frequent pairs, counted without overlap, become nonterminals until
    no pair occurs twice.  Of equally frequent pairs that overlap, a mixed hash picks the first.
3.  A run lies inside the expansion of some nonterminal (or in a segment, the start rule) and crosses the
    boundary of its two parts; so for each nonterminal, once, the runs crossing its boundary are computed.
    Period candidates come from names of 2^k-grams (equal names, equal words): near the boundary a gram longer
    than the period and its next (or previous) occurrence lie one period apart.  Descending the same names
    gives how far the period holds to both sides.
4.  Runs of a nonterminal are moved to all its positions in the derivation; of the intervals of one period
    those contained in another go, which leaves the maximal ones.

Each word is in at most log(n) grams and in one derivation, so time is n log n for the repeated part of a text,
and the rest is split and hashed only.  A chunk holds about ``CHUNK`` bytes or one longer text.

Defined cases: null and empty texts have no words and no run; equal rows are worked on one by one; ties for the
greatest exponent go to the smallest start, then period; an empty table gives no rows; other columns pass
through, and one named like a column of the result comes out with ``_input`` added to its name.
"""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, read_table
from .kernels import _BASE, IS_SEP, Chunk, byte_spans, chunks, combine, mix64, span_hash
from .registry import register

MIN_LENGTH = 6
MIN_POWER = 4
CHUNK = 1 << 21

_U = np.uint64
_EXACT = mix64(np.arange(1, 257, dtype=np.uint64) * _U(_BASE))      # byte values of words whose case counts


class Runs(NamedTuple):
    doc: np.ndarray
    start: np.ndarray      # word number
    length: np.ndarray
    period: np.ndarray


def _number(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal keys get equal numbers; also how often each number occurs."""
    _, inverse, n = np.unique(keys, return_inverse=True, return_counts=True)
    return inverse, n


def _segments(row: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Positions of the words of all segments."""
    at = np.arange(len(h))
    while len(at) >= MIN_LENGTH:
        near = (at[1:] == at[:-1] + 1) & (row[at[1:]] == row[at[:-1]])
        pair, n = _number(combine([h[at[:-1]], h[at[1:]], row[at[:-1]].astype(np.uint64)], 2))
        if not near.all():
            pair, n = pair.copy(), np.bincount(pair, near, len(n)).astype(np.int64)
        often = near & (n[pair] >= MIN_POWER - 1)
        edge = np.diff(np.concatenate([[0], often.view(np.int8), [0]]))
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)     # words first..last
        long = last - first + 1 >= MIN_LENGTH
        first, last = first[long], last[long]
        inside = np.zeros(len(at) + 1, np.int64)
        inside[first] += 1
        inside[last + 1] -= 1
        keep = np.cumsum(inside[:-1]) > 0
        if keep.all():
            return at
        at = at[keep]
    return at[:0]


class Grammar(NamedTuple):
    lo: np.ndarray         # of each boundary: the expansion around it and the boundary itself, as text positions
    mid: np.ndarray
    hi: np.ndarray
    rule: np.ndarray       # nonterminal, -1 for the start rules
    occ_rule: np.ndarray   # every position at which a nonterminal stands in the derivation, by nonterminal
    occ_at: np.ndarray


def repair(word: np.ndarray, seg: np.ndarray, doc: np.ndarray, seg_lo: np.ndarray, seg_hi: np.ndarray) -> Grammar:
    """Re-Pair over the segments of several documents; ``word`` ids are not shared between documents."""
    sym, at, s, d = word.astype(np.int64), np.arange(len(word)), seg, doc
    size = np.ones(int(word.max(initial=-1)) + 1, np.int64)
    live = np.ones(max(len(sym) - 1, 0), bool)          # pairs that may occur twice
    n_docs = int(doc.max(initial=-1)) + 1
    n_rules, lo, mid, hi, occ_rule, occ_at = 0, [], [], [], [], []
    while live.any():
        live &= s[:-1] == s[1:]
        i = np.flatnonzero(live)
        twin = (sym[:-1] == sym[1:]) & (s[:-1] == s[1:])
        if twin[i].any():                               # of aaaa take pairs 0 and 2
            same = np.flatnonzero(twin)
            head = np.maximum.accumulate(np.where(np.diff(same, prepend=-2) > 1, np.arange(len(same)), 0))
            odd = np.zeros(len(twin), bool)
            odd[same] = (same - same[head]) & 1 == 1
            i = i[~odd[i]]
        key = sym[i] * len(size) + sym[i + 1]
        kinds, which, n = np.unique(key, return_inverse=True, return_counts=True)
        rare = n[which] < 2
        live[i[rare]] = False
        i, which = i[~rare], which[~rare]
        if not len(i):
            break
        most = np.zeros(n_docs, np.int64)
        np.maximum.at(most, d[i], n[which])
        top = n[which] == most[d[i]]
        i, which = i[top], which[top]
        turn = mix64(kinds.astype(np.uint64) * _U(_BASE) + _U(1))
        near = np.flatnonzero((np.diff(i) == 1) & (which[1:] != which[:-1]))
        out = np.zeros(len(kinds), bool)
        a, b = which[near], which[near + 1]
        out[np.where(turn[a] > turn[b], a, b)] = True
        i, which = i[~out[which]], which[~out[which]]
        new, name = np.unique(which, return_inverse=True)
        left, right = np.divmod(kinds[new], len(size))
        first = np.full(len(new), len(word), np.int64)
        np.minimum.at(first, name, at[i])
        lo.append(first)
        mid.append(first + size[left])
        hi.append(first + size[left] + size[right])
        base = len(size)
        occ_rule.append(name + n_rules)
        n_rules += len(new)
        occ_at.append(at[i])
        sym[i] = base + name
        size = np.concatenate([size, size[left] + size[right]])
        keep = np.ones(len(sym), bool)
        keep[i + 1] = False
        again = np.append(live, False)                  # pairs with a new symbol may occur twice
        again[i] = True
        again[i[i > 0] - 1] = True
        sym, at, s, d, live = sym[keep], at[keep], s[keep], d[keep], again[keep][:-1]
    cut = np.flatnonzero(s[:-1] == s[1:]) + 1
    lo.append(seg_lo[s[cut]])
    mid.append(at[cut])
    hi.append(seg_hi[s[cut]])
    rule = np.concatenate([np.arange(n_rules), np.full(len(cut), -1)])
    occ_rule = np.concatenate([*occ_rule, np.zeros(0, np.int64)]).astype(np.int64)
    occ_at = np.concatenate([*occ_at, np.zeros(0, np.int64)]).astype(np.int64)
    order = np.argsort(occ_rule, kind="stable")
    return Grammar(np.concatenate(lo), np.concatenate(mid), np.concatenate(hi), rule, occ_rule[order], occ_at[order])


def gram_names(word: np.ndarray, room: np.ndarray) -> list[np.ndarray]:
    """Names of the 2^k-grams from each position (-1 where ``room``, the words left in the segment, ends
    before), for all k at which any gram occurs twice."""
    names = [word]
    while True:
        step = 1 << (len(names) - 1)
        last = names[-1]
        ok = np.flatnonzero(room >= 2 * step)
        if not len(ok):
            return names
        number, n = _number(last[ok] * (int(last.max()) + 1) + last[ok + step])
        if n.max() < 2:
            return names
        made = np.full(len(word), -1, np.int64)
        made[ok] = number
        names.append(made)


def _same_ahead(names, i, k, limit):
    """Number of equal words from positions i and k on, ``limit`` at most."""
    got = np.zeros(len(i), np.int64)
    for j in range(len(names) - 1, -1, -1):
        t = np.flatnonzero(got + (1 << j) <= limit)
        t = t[names[j][i[t] + got[t]] == names[j][k[t] + got[t]]]
        got[t] += 1 << j
    return got


def _same_behind(names, i, k, limit):
    """Number of equal words just before positions i and k, ``limit`` at most."""
    got = np.zeros(len(i), np.int64)
    for j in range(len(names) - 1, -1, -1):
        t = np.flatnonzero(got + (1 << j) <= limit)
        b = got[t] + (1 << j)
        t = t[names[j][i[t] - b] == names[j][k[t] - b]]
        got[t] += 1 << j
    return got


def boundary_runs(names: list[np.ndarray], g: Grammar) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(boundary, start, end, period) of the runs that cross each boundary inside its expansion."""
    found = []
    for j in range(len(names) - 1):
        low, m = 1 << j, 2 << j                         # periods low..m-1 by grams of m words
        name = names[j + 1]
        order = np.argsort(name, kind="stable")
        order = order[np.searchsorted(name[order], 0):]
        same = name[order[1:]] == name[order[:-1]]
        following, previous = np.full(len(name), -1, np.int64), np.full(len(name), -1, np.int64)
        following[order[:-1][same]] = order[1:][same]
        previous[order[1:][same]] = order[:-1][same]
        wide = np.flatnonzero(g.hi - g.lo >= max(MIN_LENGTH, MIN_POWER * low))
        lo, mid, hi = g.lo[wide], g.mid[wide], g.hi[wide]
        for t in range(-1, 6):
            if t < 0:                                   # the gram that ends at the boundary and the one before
                a = mid - m
                ok = np.flatnonzero(a >= lo)
                to = a[ok]
                at = previous[to]
            else:                                       # a gram before or at the boundary and the next one
                a = mid - t * low
                ok = np.flatnonzero((a >= lo) & (a < hi))
                at = a[ok]
                to = following[at]
            q = to - at
            good = (at >= 0) & (to >= 0) & (q >= low) & (q < m) & (at >= lo[ok]) & (to + m <= hi[ok])
            ok, at, q = ok[good], at[good], q[good]
            if len(ok):
                found.append((wide[ok], at, q))
    if not found:
        return (np.zeros(0, np.int64),) * 4
    b, at, q = (np.concatenate(x) for x in zip(*found))
    lo, mid, hi = g.lo[b], g.mid[b], g.hi[b]
    end = at + q + _same_ahead(names, at, at + q, hi - at - q)
    start = at - _same_behind(names, at, at + q, at - lo)
    ok = (end - start >= np.maximum(MIN_LENGTH, MIN_POWER * q)) & (start < mid) & (end > mid)
    hits = np.unique(np.stack([b[ok], start[ok], end[ok], q[ok]]), axis=1)
    return hits[0], hits[1], hits[2], hits[3]


def runs_of(row: np.ndarray, h: np.ndarray) -> Runs:
    """Runs of all texts, given by the text and the hash of each word; by text, start and period."""
    none = np.zeros(0, np.int64)
    at = _segments(row, h)
    if not len(at):
        return Runs(none, none, none, none)
    doc = row[at].astype(np.int64)
    word, _ = _number(combine([h[at], doc.astype(np.uint64)], 1))
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (doc[1:] != doc[:-1])
    seg = np.cumsum(new) - 1
    seg_lo = np.flatnonzero(new)
    seg_hi = np.append(seg_lo[1:], len(at))
    g = repair(word, seg, doc - doc[0], seg_lo, seg_hi)
    names = gram_names(word, seg_hi[seg] - np.arange(len(at)))
    b, start, end, q = boundary_runs(names, g)
    rule = g.rule[b]
    whole = rule < 0
    a, z = np.searchsorted(g.occ_rule, rule, "left"), np.searchsorted(g.occ_rule, rule, "right")
    times = np.where(whole, 1, z - a)
    of = np.repeat(np.arange(len(b)), times)
    step = np.arange(len(of)) - np.repeat(np.cumsum(times) - times, times)
    to = np.where(whole[of], g.lo[b][of], np.append(g.occ_at, 0)[np.where(whole[of], -1, a[of] + step)])
    moved = to - g.lo[b][of]
    start, end, q = start[of] + moved, end[of] + moved, q[of]
    order = np.lexsort((-end, start, q, seg[start]))
    start, end, q = start[order], end[order], q[order]
    group = np.ones(len(start), bool)
    group[1:] = (seg[start[1:]] != seg[start[:-1]]) | (q[1:] != q[:-1])
    # furthest end before each interval of its group: ends are lifted by group so that one running maximum serves all
    lift = np.cumsum(group) * (len(at) + 1)
    reach = np.maximum.accumulate(end + lift)
    keep = group.copy()
    keep[1:] |= (end + lift)[1:] > reach[:-1]
    start, end, q = start[keep], end[keep], q[keep]
    order = np.lexsort((q, at[start], doc[start]))
    start, end, q = start[order], end[order], q[order]
    return Runs(doc[start], at[start] - np.searchsorted(row, doc[start]), end - start, q)


RESULT = ("n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs array<struct<start: long, length: long, period: long>>, collapsed binary")
OWN = ("n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs", "collapsed")


def chunk_runs(c: Chunk):
    """Rows of ``RESULT`` for the texts of a chunk, as Arrow arrays."""
    sep = IS_SEP[c.buf]
    ws, we = byte_spans(c, ~sep)
    row = np.searchsorted(c.offs[1:], ws, "right")
    first = np.searchsorted(row, np.arange(c.n + 1))
    r = runs_of(row, span_hash(c, ws, we, _EXACT))
    cut = np.searchsorted(r.doc, np.arange(c.n + 1))

    drop = np.zeros(len(ws) + 1, np.int64)
    np.add.at(drop, first[r.doc] + r.start + r.period, 1)
    np.add.at(drop, first[r.doc] + r.start + r.length, -1)
    kept = np.cumsum(drop[:-1]) == 0
    inside = ~sep
    if not kept.all():
        byte = np.zeros(len(c.buf) + 1, np.int8)
        byte[ws[~kept]] += 1
        byte[we[~kept]] -= 1
        inside &= np.cumsum(byte[:-1], dtype=np.int8) == 0
    size = (we - ws)[kept]
    out = np.full(int(size.sum()) + len(size), 32, np.uint8)
    out[np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)] = c.buf[inside]
    word_at = np.concatenate([[0], np.cumsum(size + 1)])
    n_kept = np.concatenate([[0], np.cumsum(kept)])[first]
    collapsed = [out[word_at[n_kept[i]]:max(word_at[n_kept[i + 1]] - 1, word_at[n_kept[i]])].tobytes() for i in range(c.n)]

    best = np.full(c.n, -1, np.int64)
    for i in np.flatnonzero(np.diff(cut)):
        k = cut[i]
        for x in range(cut[i] + 1, cut[i + 1]):
            if int(r.length[x]) * int(r.period[k]) > int(r.length[k]) * int(r.period[x]):
                k = x
        best[i] = k
    has = best >= 0
    pick = [pa.array(np.where(has, x[best] if len(x) else 0, 0), mask=~has) for x in (r.start, r.length, r.period)]
    milli = pa.array(np.where(has, 1000 * r.length[best] // r.period[best] if len(r.length) else 0, 0), mask=~has)
    flat = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (r.start, r.length, r.period)], ["start", "length", "period"])
    return [pa.array(np.diff(first).astype(np.int64)), pa.array(np.diff(cut).astype(np.int64)), *pick, milli,
            pa.ListArray.from_arrays(pa.array(cut, pa.int32()), flat), pa.array(collapsed, pa.binary())]


def periodic_runs(docs: DataFrame, text_col: str = "text", prepare=None) -> DataFrame:
    """``docs`` without its text, with n_words, n_runs, the run of greatest exponent, all runs and the text without
    the words after each run's first period, joined by one space (UTF-8).  ``prepare``, if given, maps an Arrow batch
    to one with changed texts before the search, in the same task."""
    others = [f for f in docs.schema.fields if f.name != text_col]
    taken, names = set(OWN), []
    for f in others:
        name = f.name
        while name in taken:
            name += "_input"
        taken.add(name)
        names.append(name)

    def run(batches):
        for b in batches:
            b = prepare(b) if prepare else b
            column = b.column(text_col)
            for c in chunks(column, CHUNK):
                yield pa.RecordBatch.from_arrays([*(b.column(f.name).slice(c.at, c.n) for f in others), *chunk_runs(c)],
                                                 names=[*names, *OWN])

    fields = [f"`{n}` {f.dataType.simpleString()}" for n, f in zip(names, others)]
    return docs.withColumn(text_col, F.col(text_col).cast("string")).mapInArrow(run, ", ".join([*fields, RESULT]))


def repeat_tail(b: pa.RecordBatch) -> pa.RecordBatch:
    """Texts of ids whose crc32 ends in 0 made periodic from a word on: word i >= a becomes word a + (i - a) % p."""
    texts = b.column("text")
    changed, at = [], 0
    for i, doc_id in enumerate(b.column("doc_id").to_pylist()):
        h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
        if h % 10:
            continue
        words = (texts[i].as_py() or "").encode().split()
        n, g = len(words), h // 10
        if not n:
            continue
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        made = words[:a] + [words[a + k % p] for k in range(n - a)]
        changed += [texts.slice(at, i - at), pa.array([b" ".join(made)], pa.binary()).cast(texts.type)]
        at = i + 1
    if not changed:
        return b
    joined = pa.concat_arrays([*changed, texts.slice(at)])
    return b.set_column(b.schema.get_field_index("text"), "text", joined)


@register("op13_periodic_runs")
def op13(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    runs = periodic_runs(docs, prepare=repeat_tail)
    listed = F.concat_ws("", F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"),
                                                                 F.lit(","), r["period"].cast("string"), F.lit("\n"))))
    return runs.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                       F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
