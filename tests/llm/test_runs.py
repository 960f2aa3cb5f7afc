"""Periodic runs against a brute-force search."""

import hashlib
import random
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from rarecast.llm import kernels, registry, runs

SF = "/root/testdata/sf0.001"


def brute(w):
    """(start, length, period) of all runs, by start and period."""
    found, n = [], len(w)
    for q in range(1, n // 4 + 1):
        s = 0
        while s + q < n:
            if w[s] != w[s + q]:
                s += 1
                continue
            e = s
            while e + q < n and w[e] == w[e + q]:
                e += 1
            start, end = s, e + q
            smaller = any(q % p == 0 and all(w[k] == w[k + p] for k in range(start, end - p)) for p in range(1, q))
            if end - start >= max(6, 4 * q) and not smaller:
                found.append((start, end - start, q))
            s = e
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted(doc_id, text):
    w = [x.decode() for x in (text or "").encode().split()]
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and w:
        n, g = len(w), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def expected(w):
    r = brute(w)
    gone = {i for s, n, q in r for i in range(s + q, s + n)}
    best = min(r, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in r)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return (len(r), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


@pytest.mark.parametrize("seed", range(4))
def test_random_words_against_brute_force(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(400):
        k, n, w = rng.choice([1, 2, 2, 3, 5, 20]), rng.randrange(0, 120), []
        if rng.random() < 0.4:
            w = [rng.randrange(k) for _ in range(n)]
        while len(w) < n:
            w += [rng.randrange(k) for _ in range(rng.randrange(1, 9))] * rng.randrange(1, 9)
            if rng.random() < 0.3:
                w += w[-rng.randrange(1, len(w) + 1):] * rng.randrange(1, 6)
        texts.append(w[:250])
    row = np.array([i for i, w in enumerate(texts) for _ in w], np.int64)
    h = kernels.mix64(np.array([x + 1 for w in texts for x in w], np.uint64))
    got = [[] for _ in texts]
    for d, *r in zip(*(x.tolist() for x in runs.runs_of(row, h))):
        got[d].append(tuple(r))
    assert got == [brute(w) for w in texts]


def test_grammar_derives_the_text():
    """Every nonterminal stands for the same words wherever the derivation puts it, and no pair is left twice."""
    rng = random.Random(5)
    word = np.array([rng.randrange(3) for _ in range(500)], np.int64)
    one = np.zeros(500, np.int64)
    g = runs.repair(word, one, one, np.array([0]), np.array([500]))
    for rule, at in zip(g.occ_rule.tolist(), g.occ_at.tolist()):
        n = g.hi[rule] - g.lo[rule]
        assert word[at:at + n].tolist() == word[g.lo[rule]:g.hi[rule]].tolist()
    start = [0, *g.mid[g.rule < 0].tolist(), 500]
    pieces = [tuple(word[a:b].tolist()) for a, b in zip(start, start[1:])]
    pairs = [p for k, p in enumerate(zip(pieces, pieces[1:])) if not (k and pieces[k - 1] == p[0] == p[1])]
    assert len(pairs) == len(set(pairs))


def test_query_against_brute_force(spark):
    got = {r.doc_id: r for r in registry.QUERIES["op13_periodic_runs"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(docs) == len(got)
    checked = 0
    for d in docs:
        w = planted(d.doc_id, d.text)
        if len(w) > 2500:
            continue
        r = got[d.doc_id]
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) == expected(w)
        checked += r.n_runs > 0
    assert checked > 5


def test_edges(spark):
    long = " ".join(["ab cd ef"] * 200_000) + " " + " ".join(f"w{i}" for i in range(100_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a a a a a a"), (5, "A a A a A a A a"), (6, "x x x x x y"), (7, long), (4, "a a a a a a"),
            (None, "é é é é é é é"), (8, "q " * 6 + "r s " * 4 + "t")]
    docs = spark.createDataFrame(rows, "id long, text string").withColumns({c: F.lit("mine") for c in ("start", "runs", "n_words", "runs_input")})
    before = time.time()
    out = runs.periodic_runs(docs)
    got = {(r.id, k): r for k, r in enumerate(out.collect())}
    assert time.time() - before < 60
    assert {"start_input", "runs_input_input", "runs_input", "n_words_input"} <= set(out.columns)
    by = {i: r for (i, _), r in got.items()}
    assert len(got) == 10 and by[1].start_input == "mine"
    for i in (1, 2, 3, 6):
        assert by[i].n_runs == 0 and by[i].start is None
    assert by[1].n_words == 0 and bytes(by[3].collapsed) == b"" and bytes(by[6].collapsed) == b"x x x x x y"
    assert (by[4].start, by[4].length, by[4].period, by[4].exponent_milli) == (0, 6, 1, 6000) and bytes(by[4].collapsed) == b"a"
    assert (by[5].start, by[5].length, by[5].period) == (0, 8, 2) and bytes(by[5].collapsed) == b"A a"
    assert (by[7].n_runs, by[7].length, by[7].period, by[7].n_words) == (1, 600_000, 3, 700_000)
    assert bytes(by[None].collapsed).decode() == "é"
    assert [tuple(x) for x in by[8].runs] == [(0, 6, 1), (6, 8, 2)] and bytes(by[8].collapsed) == b"q r s t"
    assert runs.periodic_runs(docs.limit(0)).collect() == []
