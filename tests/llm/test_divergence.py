"""Source divergence audit against DuckDB and a plain count."""

import collections
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from rarecast.llm import divergence, registry

SF = "/root/testdata/sf0.001"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
S = 10 ** 9


def plain(rows, min_docs=3, top=200):
    """rows: (text, lang, source)."""
    docs = [((lang or ""), (source or ""), re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(FOLD)))
            for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = collections.Counter(t for d in mine for t in set(d[2]))
        kept = sorted(t for t in df if df[t] >= min_docs)
        count = {s: collections.Counter() for s in {d[1] for d in mine}}
        for _, s, ts in mine:
            count[s].update(t for t in ts if df[t] >= min_docs)

        def share(c):
            total = sum(c.values()) + len(kept)
            return {t: 1 + S * (c[t] + 1) // total for t in kept}

        p = {s: share(c) for s, c in count.items()}
        q = share(sum(count.values(), collections.Counter()))
        for s in count:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in count if o != s]
            terms = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if count[s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, k + 1) for k, (item, v) in enumerate(found[:limit])]
    return collections.Counter(out)


def measured(docs, top=divergence.TOP_TERMS):
    a = divergence.audit(docs)
    out = divergence.ranked(divergence.source_pairs(a), "pair").unionByName(divergence.ranked(divergence.source_terms(a), "term", top))
    return collections.Counter(tuple(r) for r in out.select("lang", "source", "part", "item", "value", "rank").collect())


def test_matches_duckdb(spark):
    got = registry.QUERIES["op11_source_divergence"](spark, SF)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(registry.ORACLE["op11_source_divergence"])
    cols = [d[0] for d in want.description]
    assert sorted(cols) == sorted(got.columns)
    assert collections.Counter(tuple(r) for r in got.select(*cols).collect()) == collections.Counter(want.fetchall())


@pytest.mark.parametrize("held", [5, divergence.HELD_TERMS])
def test_against_plain_count(spark, monkeypatch, held):
    rng = random.Random(8)
    words = ["a", "B", "été", "ÉTÉ", "x9y", "漢字", "the", "The", " ", "z-z", "m\x00n"]
    rows = [(" ".join(rng.choices(words, k=rng.randrange(0, 30))), rng.choice(["en", "de", None]), rng.choice(["s", "t", "u", None, ""]))
            for _ in range(120)]
    rows += [(None, "en", "s"), ("", "fr", "t"), ("1 2 3", "fr", None), ("lonely", "it", "s"), (None, None, None)] + [rows[0]] * 4
    docs = spark.createDataFrame(rows, "text string, lang string, source string").withColumns(
        {c: F.lit("mine") for c in ("n", "term", "idx", "docs", "value", "rank")})
    monkeypatch.setattr(divergence, "HELD_TERMS", held)
    monkeypatch.setattr(divergence, "PAIRS_AT_ONCE", held)
    assert measured(docs.repartition(3)) == plain(rows)


def test_edges(spark):
    schema = "text string, lang string, source string"
    assert not measured(spark.createDataFrame([], schema))
    long = "Word other " * 400_000
    rows = [(long, "en", "a"), ("word", "en", "b"), ("word", "en", "c")]
    assert measured(spark.createDataFrame(rows, schema)) == plain(rows)
    assert divergence.term_counts(("AB" * 2_000_000 + " c d").encode()) == {b"ab" * 2_000_000: 1, b"c": 1, b"d": 1}


def test_shares_of_very_large_counts(spark):
    """Three-step long division where 1e9 * count would not fit a long."""
    c, whole = 7_000_000_000_123, 9_000_000_000_000
    got = spark.range(1).select(F.expr(divergence._share(f"{c}L", f"{whole}L"))).first()[0]
    assert got == 1 + S * (c + 1) // whole
