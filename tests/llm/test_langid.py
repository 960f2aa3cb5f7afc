"""Kneser-Ney language models against a plain recursion, and held-out accuracy."""

import collections
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rarecast.llm import kernels, langid, registry
from rarecast.llm.common import crc_mod

SF = "/root/testdata/sf0.01"


def plain_symbols(text):
    out = [" "] * (langid.ORDER - 1)
    for ch in text:
        ch = ch.lower()[0] if ch.isalpha() else " "
        if ch != " " or out[-1] != " ":
            out.append(ch)
    return "".join(out)


class Plain:
    """Interpolated Kneser-Ney by its textbook recursion."""

    def __init__(self, texts, alphabet):
        self.alphabet, n = alphabet, langid.ORDER
        self.counts = {n: collections.Counter(s[i - n + 1:i + 1] for s in map(plain_symbols, texts) for i in range(n - 1, len(s)))}
        for k in range(n - 1, 0, -1):
            self.counts[k] = collections.Counter(g[1:] for g in self.counts[k + 1])
        self.d, self.total, self.kinds = {}, {}, {}
        for k, c in self.counts.items():
            n1, n2 = (sum(v == x for v in c.values()) for x in (1, 2))
            self.d[k] = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
            self.total[k], self.kinds[k] = collections.Counter(), collections.Counter()
            for g, v in c.items():
                self.total[k][g[:-1]] += v
                self.kinds[k][g[:-1]] += 1

    def p(self, gram):
        k = len(gram)
        if not k:
            return 1 / self.alphabet
        h = gram[:-1]
        if not self.total[k][h]:
            return self.p(gram[1:])
        return (max(self.counts[k][gram] - self.d[k], 0) + self.d[k] * self.kinds[k][h] * self.p(gram[1:])) / self.total[k][h]

    def bits(self, text):
        s, n = plain_symbols(text), langid.ORDER
        return [math.log2(self.p(s[i - n + 1:i + 1])) for i in range(n - 1, len(s))]


def chunk_of(texts):
    return next(kernels.chunks(pa.array(texts)))


def test_models_against_plain_recursion():
    rng = random.Random(3)
    texts = {j: ["".join(rng.choice("abcdÉ .,9"[j:j + 7]) for _ in range(rng.randrange(5, 80))) for _ in range(25)] for j in range(3)}
    rows = []
    for j, ts in texts.items():
        for g, n in collections.Counter(s[i - 4:i + 1] for s in map(plain_symbols, ts) for i in range(4, len(s))).items():
            rows.append((j, [ord(x) for x in g], n))
    m = langid.build(["x", "y", "z"], np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))
    alphabet = len({c for _, g, _ in rows for c in g}) + 1
    plain = [Plain(ts, alphabet) for ts in texts.values()]
    asked = ["", "abc", "ÉaÉ", "zzz unknown Ω", "  a  b", texts[0][0], texts[1][0], "ab" * 50]
    s = langid.symbols(chunk_of(asked))
    got = langid.log_probabilities(m, s)
    want = np.array([row for t in asked for row in zip(*(p.bits(t) for p in plain))])
    assert got.shape == want.shape and np.allclose(got, want, atol=1e-3)


def test_shares_of_a_history_add_up_to_one():
    """Over the letters seen and the one symbol beyond them."""
    texts = ["abra cadabra abra", "bab cab dab"]
    rows = collections.Counter(s[i - 4:i + 1] for s in map(plain_symbols, texts) for i in range(4, len(s)))
    m = langid.build(["x"], np.zeros(len(rows), int), np.array([[ord(c) for c in g] for g in rows]), np.array(list(rows.values())))
    letters = sorted({c for g in rows for c in g})
    for h in ("a", "ab", "cab", "zz", "abra"):
        last = [langid.log_probabilities(m, langid.symbols(chunk_of([h + c])))[-1, 0] for c in [*letters, "Ω"]]
        assert sum(2.0 ** float(x) for x in last) == pytest.approx(1, abs=1e-4)


def test_symbols_fold_and_collapse():
    s = langid.symbols(chunk_of(["ÀB1  2c", "", None, "??", " Ωa"]))
    texts = ["".join(map(chr, s.sym[a:b])) for a, b in zip(s.first, s.first[1:])]
    assert texts == ["    àb c", "    ", "    ", "    ", "    ωa"]
    assert s.letters.tolist() == [3, 0, 0, 0, 2]


def test_held_out_accuracy_and_score(spark):
    got = registry.QUERIES["op12_language_id"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").filter("held_out").collect()
    assert len(rows) > 150 and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.97 * len(rows)


def test_edges(spark):
    schema = "doc_id long, text string, lang string"
    words = {"en": "the of and that with this from", "xx": "zu der die und von mit aus"}
    rows = [(i, " ".join(random.Random(i).choices(words[lang].split(), k=30)), lang) for i in range(400) for lang in words]
    train = spark.createDataFrame(rows, schema)
    m = langid.fit(train, crc_mod(F.col("doc_id"), 4) != 2, rows=150)
    long = "the of and " * 300_000
    asked = [(1, None, "en"), (2, "", "en"), (3, "12 ?!", None), (4, "the of the and", None), (None, "der die und", "q"), (5, long, "xx"),
             (4, "the of the and", None), (6, "Ω Ψ ЖЖ", "en")]
    q = spark.createDataFrame(asked, schema).withColumns({c: F.lit("mine") for c in ("score", "lang_pred", "learn", "draw", "rank", "n")})
    got = langid.identify(q, m).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 8 and all(by[i].lang_pred == "und" and by[i].score == 0 for i in (1, 2, 3))
    assert by[4].lang_pred == "en" and by[None].lang_pred == "xx" and by[5].lang_pred == "en"
    assert by[5].score > 0.9 and not by[5].rejected and by[6].rejected and by[6].lang_pred in words
    assert {r.doc_id: r for r in langid.identify(q, m, reject=True).collect()}[6].lang_pred == "und"
    clash = train.withColumns({c: F.lit("mine") for c in ("draw", "rank", "n", "learn", "spare", "limit")})
    assert langid.fit(clash, F.lit(True), rows=20).langs == ["en", "xx"]
    assert langid.fit(train.limit(0), F.lit(True)) is None
    assert langid.fit(train.withColumn("lang", F.lit(None).cast("string")), F.lit(True)) is None
    assert {r.lang_pred for r in langid.identify(q, None).collect()} == {"und"}
    assert langid.identify(q.limit(0), m).collect() == []
    one = langid.fit(train.filter("lang = 'en'"), F.lit(True), rows=30)
    assert {r.lang_pred for r in langid.identify(q.filter("doc_id = 4"), one).collect()} == {"en"}
