"""Source divergence audit: term counts by source and language from a translate-table tokenizer.

One ``bytes.translate`` lowers A-Z and blanks every ASCII byte that is no letter (bytes of other
letters stay), ``bytes.split`` cuts the terms and a ``Counter`` per document gives its frequencies.
A task adds these up per (lang, source) and passes on sparse (lang, source, term, occurrences,
documents) rows whenever it holds ``HELD_TERMS`` of them, so its memory does not follow the corpus.
Spark sums them by (lang, source, term), a key no source makes hot, and then by (lang, term), where a
term has one row per source.  A language keeps the terms found in ``min_docs`` of its documents.

Shares are integers: p = 1 + floor(1e9 * (count + 1) / (N + V)) with N the group's occurrences of kept
terms and V the kept terms of the language; the divergence of p from q is floor((p - q)^2 / q).

Each ordered pair of sources of a language sums the divergence over all V terms, though most terms miss
in most sources.  With o the share of a count of 0, the sum over terms is
    sum over A's terms of f(p_A, o_B) + sum over B's terms of f(o_A, p_B) + (V - n_A - n_B) f(o_A, o_B)
    + sum over common terms of f(p_A, p_B) - f(p_A, o_B) - f(o_A, p_B) + f(o_A, o_B).
The first three come from one histogram of counts per source, the last from the terms' own lists of
sources, added up inside each task to one row per pair.

Defined cases: null text, lang and source count as ''; a row without terms still makes its group occur;
every row counts, equal ones too; a language without kept terms has divergence 0 for all its pairs and
no term rows; other columns are ignored; an empty table gives no rows.  Texts of any length are
tokenized in blocks cut at a blank.  Sums fit a long below 9e15 tokens a language.
"""

from __future__ import annotations

from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import read_table, stored
from .registry import register

HELD_TERMS = 300_000       # (lang, source, term) entries that a task holds before it passes them on
BLOCK = 1 << 20            # bytes split at once
PAIRS_AT_ONCE = 1 << 20    # pairs of sources of common terms worked on at once
MIN_DOCS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000

LOWER_OR_BLANK = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_counts(text: bytes) -> Counter:
    """Occurrences of each term of one text."""
    plain = text.translate(LOWER_OR_BLANK)
    if len(plain) <= BLOCK:
        return Counter(plain.split())
    found, at = Counter(), 0
    while at < len(plain):
        to = plain.find(b" ", at + BLOCK)
        to = len(plain) if to < 0 else to
        found.update(plain[at:to].split())
        at = to
    return found


def _count_batches(batches):
    held: dict[tuple, tuple[Counter, Counter]] = {}
    size = 0

    def passed_on():
        for (lang, source), (n, docs) in held.items():
            terms = list(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()), pa.array(terms, pa.binary()),
                 pa.array([n[t] for t in terms], pa.int64()), pa.array([docs[t] for t in terms], pa.int64())],
                names=["lang", "source", "term", "n", "docs"])

    for b in batches:
        lang, source = b.column("lang").to_pylist(), b.column("source").to_pylist()
        for i, text in enumerate(b.column("text")):
            own = term_counts(text.as_py() or b"")
            n, docs = held.setdefault((lang[i], source[i]), (Counter(), Counter()))
            before = len(n)
            n.update(own)
            docs.update(own.keys())
            size += len(n) - before
            if size >= HELD_TERMS:
                yield from passed_on()
                held.clear()
                size = 0
    yield from passed_on()


def _share(count: str, whole: str) -> str:
    """1 + floor(SCALE * (count + 1) / whole) for count < whole, by three steps of long division."""
    x = f"({count} + 1)"
    a, ra = f"({x} * 1000L div {whole})", f"({x} * 1000L % {whole})"
    b, rb = f"({ra} * 1000L div {whole})", f"({ra} * 1000L % {whole})"
    return f"(1L + {a} * 1000000L + {b} * 1000L + ({rb} * 1000L div {whole}))"


def _divergence(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q}) div {q})"


class Audit(NamedTuple):
    groups: DataFrame      # (lang, source, idx, n, terms, vocabulary, o): occurrences and number of kept terms, share of a count of 0
    kept: DataFrame        # (lang, term, idx, p, o, n: arrays over the sources that hold the term, lang_n)
    langs: DataFrame       # (lang, vocabulary, lang_total)


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source") -> Audit:
    """Kept terms with the shares of the sources that hold them, and the groups' totals."""
    def named(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    rows = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"),
                       named(lang_col).alias("lang"), named(source_col).alias("source"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = stored(rows.select("lang", "source").distinct().withColumn("idx", number), "audit-groups")

    counts = (rows.mapInArrow(_count_batches, "lang string, source string, term binary, n long, docs long")
              .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
              .join(groups, ["lang", "source"]))
    terms = stored(counts.groupBy("lang", "term")
                   .agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"), F.collect_list(F.struct("idx", "n")).alias("by"))
                   .filter(F.col("docs") >= min_docs)
                   .select("lang", F.col("term").cast("string").alias("term"), "lang_n", "by"), "audit-terms")

    sums = (terms.select("lang", F.explode("by").alias("e")).groupBy("lang", F.col("e.idx").alias("idx"))
            .agg(F.sum("e.n").alias("n"), F.count("*").alias("terms")))
    groups = groups.join(sums, ["lang", "idx"], "left").fillna(0, ["n", "terms"])
    langs = groups.groupBy("lang").agg(
        F.sum("n").alias("lang_total"),
        F.transform(F.sort_array(F.collect_list(F.struct("idx", "n"))), lambda e: e["n"]).alias("group_totals"))
    langs = stored(langs.join(terms.groupBy("lang").agg(F.count("*").alias("vocabulary")), "lang", "left")
                   .fillna(0, ["vocabulary"]), "audit-langs")
    groups = stored(groups.join(langs.select("lang", "vocabulary"), "lang").withColumn(
        "o", F.expr(f"CASE WHEN vocabulary > 0 THEN {_share('0L', '(n + vocabulary)')} END")), "audit-totals")

    whole = "(group_totals[e.idx] + vocabulary)"
    kept = terms.join(langs, "lang").select(
        "lang", "term", "lang_n", "lang_total", "vocabulary",
        F.expr("transform(by, e -> e.idx)").alias("idx"),
        F.expr(f"transform(by, e -> {_share('e.n', whole)})").alias("p"),
        F.expr(f"transform(by, e -> {_share('0L', whole)})").alias("o"),
        F.expr("transform(by, e -> e.n)").alias("n"))
    return Audit(groups, kept, langs)


def _common_terms(batches):
    """Per task one (lang, a, b, value) row for each ordered pair of sources with common terms."""
    held: dict[tuple, int] = {}

    def passed_on():
        keys = list(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
             pa.array([k[2] for k in keys], pa.int32()), pa.array([held[k] for k in keys], pa.int64())],
            names=["lang", "a", "b", "value"])

    for batch in batches:
        names = batch.column("lang").dictionary_encode()
        lang_of = names.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        names = names.dictionary.to_pylist()
        lists = batch.column("idx")
        offs = lists.offsets.to_numpy().astype(np.int64)
        base = offs[0]
        size = np.diff(offs)
        idx, p, o = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in ("idx", "p", "o"))
        row = np.repeat(np.arange(len(size)), size)
        partners = size[row]
        ends = np.cumsum(partners)
        at = 0
        while at < len(row):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS_AT_ONCE, "right")))
            k = partners[at:to]
            left = np.repeat(np.arange(at, to), k)
            step = np.arange(len(left)) - np.repeat(np.cumsum(k) - k, k)
            right = offs[row[left]] - base + step
            left, right = left[left != right], right[left != right]
            pl, pr, ol, orr = p[left], p[right], o[left], o[right]
            value = (pl - pr) ** 2 // pr - (pl - orr) ** 2 // orr - (ol - pr) ** 2 // pr + (ol - orr) ** 2 // orr
            key = (lang_of[row[left]] << 50) | (idx[left] << 25) | idx[right]
            keys, inverse = np.unique(key, return_inverse=True)
            total = np.zeros(len(keys), np.int64)
            np.add.at(total, inverse, value)
            for k, v in zip(keys.tolist(), total.tolist()):
                pair = (names[k >> 50], (k >> 25) & 0x1FFFFFF, k & 0x1FFFFFF)
                held[pair] = held.get(pair, 0) + v
            if len(held) >= HELD_TERMS:
                yield from passed_on()
                held.clear()
            at = to
    yield from passed_on()


def source_pairs(a: Audit) -> DataFrame:
    """(lang, source, item, value) for each ordered pair of different sources of a language."""
    g = a.groups
    exact = "decimal(38,0)"
    one = (a.kept.select("lang", F.explode(F.arrays_zip("idx", "p", "o")).alias("e"))
           .groupBy("lang", F.col("e.idx").alias("x"), F.col("e.p").alias("p"), F.col("e.o").alias("ox")).agg(F.count("*").alias("terms")))
    other = g.select("lang", F.col("idx").alias("y"), F.col("o").alias("oy"))
    sides = (one.join(other, "lang").filter("x != y").groupBy("lang", "x", "y")
             .agg(F.sum(F.expr(f"cast({_divergence('p', 'oy')} as {exact}) * terms")).alias("to_other"),
                  F.sum(F.expr(f"cast({_divergence('oy', 'p')} as {exact}) * terms")).alias("from_other")))
    common = (a.kept.select("lang", "idx", "p", "o").mapInArrow(_common_terms, "lang string, a int, b int, value long")
              .select("lang", "a", "b", F.col("value").cast(exact).alias("value")))
    parts = (sides.select("lang", F.col("x").alias("a"), F.col("y").alias("b"), F.col("to_other").alias("value"))
             .unionByName(sides.select("lang", F.col("y").alias("a"), F.col("x").alias("b"), F.col("from_other").alias("value")))
             .unionByName(common)
             .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    left = g.select("lang", F.col("idx").alias("a"), "source", F.col("terms").alias("na"), F.col("o").alias("oa"), "vocabulary")
    right = g.select("lang", F.col("idx").alias("b"), F.col("source").alias("item"), F.col("terms").alias("nb"), F.col("o").alias("ob"))
    none = f"coalesce(cast({_divergence('oa', 'ob')} as {exact}) * (vocabulary - na - nb), 0)"
    return (left.join(right, "lang").filter("a != b").join(parts, ["lang", "a", "b"], "left")
            .select("lang", "source", "item", F.expr(f"cast(coalesce(value, 0) + {none} as long)").alias("value")))


def source_terms(a: Audit) -> DataFrame:
    """(lang, source, item, value) for each kept term that a source holds with a larger share than its language."""
    q = _share("lang_n", "(lang_total + vocabulary)")
    rows = (a.kept.select("lang", "term", F.expr(q).alias("q"), F.explode(F.arrays_zip("idx", "p")).alias("e"))
            .filter(F.col("e.p") > F.col("q"))
            .select("lang", F.col("e.idx").alias("idx"), F.col("term").alias("item"), F.expr(_divergence("e.p", "q")).alias("value")))
    return rows.join(a.groups.select("lang", "idx", "source"), ["lang", "idx"]).select("lang", "source", "item", "value")


def ranked(rows: DataFrame, part: str, top: int | None = None) -> DataFrame:
    rank: Column = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    out = rows.withColumn("rank", rank)
    if top:
        out = out.filter(F.col("rank") <= top)
    return out.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


_TERMS = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"


@register("op11_source_divergence", rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERMS}') AS ts
           FROM documents),
t AS (SELECT r, lang, source, unnest(ts) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT r) >= {MIN_DOCS}),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
g AS (SELECT gs.lang, gs.source, coalesce(s.n, 0)::HUGEINT AS n FROM (SELECT DISTINCT lang, source FROM d) gs
      LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL) s USING (lang, source)),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + ({SCALE}::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.n + v.v) AS p
      FROM g JOIN kept k USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
l AS (SELECT c.lang, c.term, 1 + ({SCALE}::HUGEINT * (sum(c.n) + 1)::HUGEINT) // (any_value(s.n) + any_value(v.v)) AS q
      FROM c JOIN (SELECT lang, sum(n)::HUGEINT AS n FROM c GROUP BY lang) s USING (lang) JOIN v USING (lang) GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
allpairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(pairs.value, 0)::BIGINT AS value
             FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
             LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source),
terms AS (SELECT p.lang, p.source, p.term AS item, (((p.p - l.q) * (p.p - l.q)) // l.q)::BIGINT AS value
          FROM p JOIN l ON p.lang = l.lang AND p.term = l.term WHERE p.n > 0 AND p.p > l.q),
x AS (SELECT lang, source, 'pair' AS part, item, value FROM allpairs UNION ALL SELECT lang, source, 'term', item, value FROM terms),
y AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INT AS rank FROM x)
SELECT * FROM y WHERE part = 'pair' OR rank <= {TOP_TERMS}""")
def op11(spark, sf_dir):
    a = audit(read_table(spark, sf_dir, "documents"))
    return ranked(source_pairs(a), "pair").unionByName(ranked(source_terms(a), "term", TOP_TERMS))
