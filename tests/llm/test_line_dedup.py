"""Line dedup against a plain count; long documents, repeated rows and clashing names."""

import collections
import random
import time

import pytest
from pyspark.sql import functions as F

from rarecast.llm import line_dedup

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(texts, min_docs):
    keys = [[x.strip(" \t\n\x0b\x0c\r").translate(FOLD) for x in (t or "").split("\n")] for t in texts]
    found = collections.Counter(k for ks in keys for k in set(ks) if k)
    return ["\n".join(x for x, k in zip((t or "").split("\n"), ks) if found[k] < min_docs) for t, ks in zip(texts, keys)]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_texts_against_plain_count(spark, seed):
    rng = random.Random(seed)
    texts = ["\n".join(rng.choice(["a", "A ", "b", "c", "", " ", "d é", f"x{rng.randrange(40)}"]) for _ in range(rng.randrange(1, 14))) for _ in range(60)]
    texts += [None, "", texts[0]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs, min_docs=5, keep_first=False).collect()}
    for i, (t, want) in enumerate(zip(texts, plain(texts, 5))):
        r = got[i]
        assert (r.text or "") == want
        lines = (t or "").split("\n")
        assert r.n_lines == len(lines)
        if r.keep_runs is not None:                      # the bitmap gives the text back
            marks = [k % 2 == 0 for k, n in enumerate(r.keep_runs) for _ in range(n)]
            marks += [True] * (len(lines) - len(marks))
            assert "\n".join(x for x, m in zip(lines, marks) if m) == want and marks.count(False) == r.n_dropped


def test_equal_rows_count_one_by_one(spark):
    docs = spark.createDataFrame([(7, "same line\nown")] * 10 + [(8, "same line\nother")], "doc_id long, text string")
    rows = line_dedup.dedup_lines(docs, min_docs=11, keep_first=False).collect()
    assert len(rows) == 11 and {r.text for r in rows} == {"own", "other"}
    assert {r.n_dropped for r in line_dedup.dedup_lines(docs, min_docs=12, keep_first=False).collect()} == {0}


def test_a_million_lines(spark):
    n = 1_000_000
    long = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.when(i % 2 == 0, F.concat(F.lit("common "), i.cast("string")))
                                    .otherwise(F.concat(F.lit("own "), F.col("id").cast("string"), F.lit(" "), i.cast("string")))), "\n")
    docs = spark.range(2).select(F.col("id").alias("doc_id"), long.alias("text"))
    before = time.time()
    rows = line_dedup.dedup_lines(docs, keep_first=False).select("n_lines", "n_dropped", F.size("keep_runs").alias("runs"), F.substring("text", 1, 9).alias("head")).collect()
    assert time.time() - before < 120
    assert [(r.n_lines, r.n_dropped, r.runs) for r in rows] == [(n, n // 2, n)] * 2
    assert {r.head for r in rows} == {"own 0 1\no", "own 1 1\no"}


def test_clashing_names_come_out_renamed(spark):
    docs = spark.createDataFrame([(1, "x\ny", "mine", 5, "z"), (2, "x", "mine", 6, "z")], "doc_id long, text string, n_dropped string, keep_runs long, n_dropped_input string")
    out = line_dedup.dedup_lines(docs, keep_first=False)
    assert out.columns == ["doc_id", "text", "n_dropped_input_input", "keep_runs_input", "n_dropped_input", "n_lines", "n_dropped", "keep_runs"]
    r = out.orderBy("doc_id").first()
    assert (r.text, r.n_dropped_input_input, r.keep_runs_input, r.n_dropped, r.keep_runs) == ("y", "mine", 5, 1, [0, 1])
