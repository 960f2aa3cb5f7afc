"""N-gram Jaccard self-join with token-combination prefixes, and the components of its links.

Tokens are the hashes of a document's k-word shingles.  Their classes come from counts over all
documents, level by level: words first, then those shingles whose words are all frequent.
A shingle found in ``FREQUENT`` documents is *frequent*, every other is *rare*, so a rare token's
list is short.  All documents share one token order: rare before frequent, then by a bound of the
frequency, then by hash.

A document of n tokens may miss at most e = n - ceil(t n) of them in a linked document.  With e = 0
it may still lie whole inside a larger one, so only sets too small for that are not indexed.  Rare
tokens are indexed one by one: e + 1 of them suffice.  Where the rare ones do not suffice the
prefix is extended into the frequent ones, which are dealt to B buckets by hash and indexed as
pairs inside a bucket: two documents that share no pair miss all but one token of each bucket,
so a prefix with (rare) + sum(bucket size - 1) > e must share an index entry.  B grows with the
size class, which keeps the number of pairs linear in n.  Linked documents have sizes within a
ratio t, and a document near a class border is indexed for both classes.

Only one document of each distinct token set takes part.  Index entries also bound the overlap
before any pair is formed: indexed rare tokens that no other document indexes are certain misses
towards every document that indexes its rare tokens at least as far in the order.  Candidates
are verified exactly on the whole sets.  A group of many near copies is not expanded to all
pairs: first every index entry's most central document is compared with the entry's other
documents and the links are contracted; after that only pairs of *different* components that
share an entry are compared, all of them.  So no link between components is lost and none is
assumed.  Entries of the same documents, as the shingles of a shared passage are, make each pair
once, with their number.  A pair whose sketches (the parity of the tokens in each of ``LANES`` * 64
buckets) differ in more bits than the tokens of two linked sets may differ is none: every such bit
is a token that only one of the two has.  Of the entries of frequent tokens, many of which a pair
shares, the lowest makes the pair and the others, as far as ``EARLIER`` tells them, do not make it again.

Defined cases: texts without words (null, empty) have no tokens and link with nothing, not even
each other; texts with fewer words than k are one token; equal sets always link; rows that share
an id count as one node, so their components merge; rows with a null id belong to the component
of an equal set with an id, else to none (null); ties of centrality go to the smaller id; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import IdFilter, most_frequent, read_table, stored
from .components import components
from .kernels import HashIndex, Words, chunks, combine, distinct_per_row, list_array, mix64, order_by, shingles, words
from .registry import register

WIDTH = 4
PERCENT = 85
FREQUENT = 1000              # documents
TABLE = 1 << 19              # rows of each broadcast table of frequent words or shingles: 8 MB at most
SPLIT = 4                    # allowed misses per bucket of frequent tokens
EARLIER = 8                  # lower keys carried with each pair of frequent tokens; any number gives the same links
LANES = 8                    # longs of a sketch; any number gives the same links, larger sets need more to be told apart
ALL = np.int64(2**63 - 1)    # place in the token order after every rare token


def _counted(sets):
    """Per task: (token, documents with it) of the distinct tokens per document that ``sets`` yields,
    merged in memory up to a bound.  A token met once by a task is not sent: the classes and the
    order need the same counts everywhere, not the last unit of them."""
    def run(batches):
        held, size = [], 0

        def merged():
            u, at = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
            return u, np.bincount(at, np.concatenate([x for _, x in held]), len(u)).astype(np.int64)

        def batch(u, n):
            u, n = u[n > 1], n[n > 1]
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(n)], names=["token", "df"])

        for b in batches:
            for c in chunks(b.column("text")):
                held.append(np.unique(sets(c), return_counts=True))
                size += len(held[-1][0])
                if size > 2_000_000:
                    held = [merged()]
                    size = len(held[0][0])
                    if size > 1_000_000:
                        yield batch(*held[0])
                        held, size = [], 0
        if held:
            yield batch(*merged())
    return run


def _frequent(texts: DataFrame, sets, least: int, limit: int = TABLE):
    """Index of tokens, and document frequencies, of the most frequent tokens, ``limit`` at most: those
    found in ``least`` documents or in as many as the limit asks for."""
    df = stored(texts.mapInArrow(_counted(sets), "token long, df long").groupBy("token")
                .agg(F.sum("df").alias("df")).filter(F.col("df") >= least), "token-df")
    key, n = most_frequent(df, "token", "df", limit)
    return HashIndex(key), n


def _look_up(table, tokens: np.ndarray, other: int) -> np.ndarray:
    index, df = table
    at = index.find(tokens)
    out = np.full(len(at), other)
    out[at >= 0] = df[at[at >= 0]]
    return out


def _bounds(w: Words, h: np.ndarray, row: np.ndarray, word_table, width: int) -> np.ndarray:
    """Upper bound of each shingle's document frequency: the lowest of its words; 1 where it is below the table."""
    freq = _look_up(word_table, w.hash, 1)
    m = len(freq) - width + 1
    bound = np.ones(len(h), np.int64)
    if m > 0:
        low = np.minimum.reduce([freq[i:i + m] for i in range(width)])
        bound[np.diff(w.first)[row] >= width] = low[w.row[:m] == w.row[width - 1:]]
    return bound


def frequency_tables(texts: DataFrame, width: int, frequent: int):
    """Word table, then the table of shingles found in ``frequent`` documents (or more, if that is too many)."""
    def word_sets(c):
        w = words(c)
        return distinct_per_row(w.row, w.hash, c.n)[0]

    held = texts.sparkSession.sparkContext.broadcast(_frequent(texts, word_sets, 2))

    def shingle_sets(c):
        w = words(c)
        row, h = shingles(w, c.n, width)
        some = _bounds(w, h, row, held.value, width) >= frequent
        return distinct_per_row(row[some], h[some], c.n)[0]

    return held, texts.sparkSession.sparkContext.broadcast(_frequent(texts, shingle_sets, frequent))


def _max_misses(n, percent: int):
    return n - (n * percent + 99) // 100


def _buckets(size_class: int, percent: int) -> int:
    return max(1, -(-int(_max_misses(1 << size_class, percent)) // SPLIT))


def _pairs(tokens: np.ndarray, n_rare: int, need: int, n: int, percent: int) -> np.ndarray:
    """Index entries of a document's frequent tokens (in token order); ``need``: misses they must outnumber."""
    lo, hi = (n * percent + 99) // 100, n * 100 // percent
    out = []
    for k in range(int(lo).bit_length() - 1, int(hi).bit_length()):
        b = _buckets(k, percent)
        t = tokens[n_rare:n_rare + need + b]
        deal = mix64(t + np.uint64(k)) % np.uint64(b)
        order = np.lexsort((t, deal))
        t, deal = t[order], deal[order]
        for gap in range(1, len(t)):
            same = deal[gap:] == deal[:-gap]
            if not same.any():
                break
            out.append(combine([t[:-gap][same], t[gap:][same]], 1000 + k))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _sketch(row: np.ndarray, h: np.ndarray, n_rows: int) -> pa.Array:
    """Per row: the parity of its distinct tokens in each of ``LANES`` * 64 buckets, as ``LANES`` longs."""
    bits = np.zeros(n_rows * LANES, np.uint64)
    np.bitwise_xor.at(bits, row * LANES + ((h >> np.uint64(6)) % np.uint64(LANES)).astype(np.int64),
                      np.uint64(1) << (h & np.uint64(63)))
    return list_array(bits, np.arange(n_rows + 1) * LANES)


def _index(word_table, shingle_table, width: int, percent: int):
    def run(batches):
        for b in batches:
            for c in chunks(b.column("text")):
                w = words(c)
                row, h = shingles(w, c.n, width)
                # rank in the token order: rare tokens by bound, then frequent ones
                common = _look_up(shingle_table.value, h, 0) > 0
                bound = _bounds(w, h, row, word_table.value, width)
                rank = np.minimum(np.log2(bound) * 4, 127).astype(np.int64) + 128 * common
                order = order_by(row, rank, h)
                row, h, rank = row[order], h[order], rank[order]
                new = np.ones(len(h), bool)
                if len(h) > 1:
                    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
                row, h, rank = row[new], h[new], rank[new]
                cut = np.searchsorted(row, np.arange(c.n + 1))
                n = np.diff(cut)
                miss = _max_misses(n, percent)
                rare = np.bincount(row[rank < 128], minlength=c.n)
                prints = [np.zeros(c.n, np.uint64), np.zeros(c.n, np.uint64)]
                some = np.flatnonzero(n)
                if len(h):
                    for f, x in zip(prints, (h, mix64(h + np.uint64(77)))):
                        f[some] = np.add.reduceat(x, cut[some])
                able = n * 100 // percent > n              # others link with equal sets only
                single = np.where(able, np.minimum(rare, miss + 1), 0)
                # how far the rare tokens are indexed: to the end, or to this place in the order
                last = np.full(c.n, ALL)
                part = np.flatnonzero(single < rare)
                at = cut[part] + single[part] - 1
                last[part] = np.where(single[part] > 0, rank[at] << 36 | (h[at] >> np.uint64(28)).astype(np.int64), -1)
                first = (np.arange(len(h)) - cut[row]) < single[row]
                more_row, more = [row[first]], [h[first] | np.uint64(1)]      # lowest bit: a rare token's entry
                for r in np.flatnonzero(able & (rare <= miss)):
                    p = _pairs(h[cut[r]:cut[r + 1]], int(rare[r]), int(miss[r] + 1 - rare[r]), int(n[r]), percent)
                    more_row.append(np.full(len(p), r))
                    more.append(p & ~np.uint64(1))
                entry_row, entry = np.concatenate(more_row), np.concatenate(more)
                order = np.argsort(entry_row, kind="stable")
                entry_row, entry = entry_row[order], entry[order]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(c.at, c.n), pa.array(n.astype(np.int64)),
                     pa.array(prints[0].view(np.int64)), pa.array(prints[1].view(np.int64)),
                     pa.array(rare.astype(np.int64)), pa.array(single.astype(np.int64)), pa.array(last),
                     _sketch(row, h, c.n), list_array(entry, np.searchsorted(entry_row, np.arange(c.n + 1)))],
                    names=["doc_id", "n", "f1", "f2", "rare", "singles", "last", "sketch", "entries"])
    return run


def _token_sets(rows: DataFrame, pairs: DataFrame, width: int) -> DataFrame:
    """Stored (node, tokens) of at least the nodes of ``pairs``.  Which texts to take is decided where
    they are read; what the bitmap lets through besides does no harm."""
    ids = IdFilter(pairs.select(F.explode(F.array("u", "v")).alias("node")))
    held = ids.held

    def run(batches):
        for b in batches:
            at = b.column("slot").to_numpy(zero_copy_only=False)
            b = b.filter(pa.array((held.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1))
            for c in chunks(b.column("text")):
                row, h = shingles(words(c), c.n, width)
                flat, offs = distinct_per_row(row, h, c.n)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(c.at, c.n), list_array(flat, offs)],
                                                 names=["node", "tokens"])

    some = rows.filter("doc_id IS NOT NULL").withColumn("slot", ids.slot("doc_id"))
    return stored(some.mapInArrow(run, "node long, tokens array<long>"), "sets")


def _verified(pairs: DataFrame, rows: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (u, v), stored, whose sets reach the threshold."""
    sets = _token_sets(rows, pairs, width)
    a = sets.select(F.col("node").alias("u"), F.col("tokens").alias("a"))
    b = sets.select(F.col("node").alias("v"), F.col("tokens").alias("b"))
    shared = F.size(F.array_intersect("a", "b"))
    return stored(pairs.select("u", "v").join(a, "u").join(b, "v")
                  .filter(100 * shared >= percent * (F.size("a") + F.size("b") - shared)).select("u", "v"), "linked")


def _least_overlap(percent: int):
    """Smallest overlap of u and v that reaches the threshold."""
    return F.floor((percent * (F.col("nu") + F.col("nv")) + (99 + percent)) / F.lit(100 + percent))


def _near_sketches(percent: int):
    """Condition on the sketches of u and v: they differ in no more bits than linked sets in tokens."""
    bits = [F.bit_count(F.get("ku", F.lit(i)).bitwiseXOR(F.get("kv", F.lit(i)))) for i in range(LANES)]
    return reduce(Column.__add__, bits) <= F.col("nu") + F.col("nv") - 2 * _least_overlap(percent)


def _may_link(percent: int):
    """Condition on the facts of u and v: sizes fit, and certain misses leave enough to share."""
    need = _least_overlap(percent)
    u, v = F.col("nu") - F.col("mu") >= need, F.col("nv") - F.col("mv") >= need
    both = u & v
    return ((100 * F.least("nu", "nv") >= percent * F.greatest("nu", "nv"))
            & F.when(F.col("lu") < F.col("lv"), u).when(F.col("lv") < F.col("lu"), v)
            .when(F.col("lu") == F.lit(int(ALL)), both).otherwise(u | v))


def _side(live: DataFrame, s: str, *more: str) -> DataFrame:
    return live.select("entry", F.col("node").alias(s), F.col("n").alias("n" + s), F.col("misses").alias("m" + s),
                       F.col("singles").alias("s" + s), F.col("last").alias("l" + s), *[F.col(c).alias(c[0] + s if c != "met" else c) for c in more])


_FACTS = [k + x for k in "nsl" for x in "uv"]


def _enough(pairs: DataFrame, percent: int) -> DataFrame:
    """Of pairs with facts and ``met`` (rare tokens that both index), those that may link: a rare token
    indexed by one of the pair only is a certain miss between the two."""
    return (pairs.withColumns({"mu": F.col("su") - F.col("met"), "mv": F.col("sv") - F.col("met")})
            .filter(_may_link(percent)).select("u", "v"))


def _live_entries(index: DataFrame, percent: int) -> DataFrame:
    """(entry, node, n, rare, misses, last) of the entries that two different sets share and that may
    hold a link, judged entry by entry without forming pairs."""
    nodes = (index.filter("n > 0 AND doc_id IS NOT NULL AND size(entries) > 0").groupBy("n", "f1", "f2")
             .agg(F.min("doc_id").alias("node"), *[F.first(c).alias(c) for c in ("rare", "singles", "last", "entries")]))
    nodes = stored(nodes.drop("f1", "f2"), "nodes")
    flat = nodes.select("node", F.explode("entries").alias("entry"))
    twice = flat.groupBy("entry").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("entry")
    shared = stored(flat.join(twice, "entry"), "shared")
    facts = (shared.groupBy("node").agg(F.count_if(F.col("entry") % 2 != 0).alias("met"))
             .join(nodes.select("node", "n", "rare", "singles", "last"), "node")
             .select("node", "n", "rare", "singles", (F.col("singles") - F.col("met")).alias("misses"), "last"))
    full = stored(shared.select("node", "entry").join(facts, "node"), "full")
    # what is known of an entry comes from all its rows, and the next question needs the answer: each is written, else
    # the last join would make all before it several times over in one task, with a sort's pages for every one of them
    low = full.groupBy("entry").agg(F.min("n").alias("low"))
    need = F.floor((percent * (F.col("n") + F.col("low")) + (99 + percent)) / F.lit(100 + percent))
    judged = stored(full.join(low, "entry").withColumn("good", F.col("n") - F.col("misses") >= need).drop("low"), "judged")
    reach = judged.groupBy("entry").agg(F.min(F.when(F.col("good"), F.col("last"))).alias("reach"))
    # a bad node can only link with a good one whose rare tokens are indexed less far
    keep = stored(judged.join(reach, "entry")
                  .filter(F.col("good") | (F.col("reach") < F.col("last"))
                          | ((F.col("reach") == F.col("last")) & (F.col("last") < F.lit(int(ALL)))))
                  .drop("good", "reach"), "keep")
    many = keep.groupBy("entry").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a <> b").select("entry")
    return stored(keep.join(many, "entry").distinct(), "live")


def _across(named: DataFrame) -> DataFrame:
    """Of ``named`` (entry, component, more) the entries of several components, one for all that have the very
    same rows; ``met`` tells for how many rare tokens it stands (0: pairs of frequent tokens).  Rows are
    compared by their number and 128 bits of hashes, as token sets are."""
    facts = sorted(set(named.columns) - {"entry"})
    lists = (named.groupBy("entry")
             .agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("c"),
                  F.bit_xor(F.xxhash64(*facts)).alias("f1"), F.bit_xor(F.xxhash64(F.lit(1), *facts)).alias("f2"))
             .filter("lo <> hi").withColumn("single", F.col("entry") % 2 != 0))
    one = (lists.groupBy("single", "c", "f1", "f2").agg(F.min("entry").alias("entry"), F.count(F.lit(1)).alias("met"))
           .select("entry", F.when(F.col("single"), F.col("met")).otherwise(0).alias("met")))
    return named.join(one, "entry")


def _first_meetings(side: DataFrame) -> DataFrame:
    """``side`` with the pairs of frequent tokens rewritten to 32-bit keys (even, as before), each with the
    ``EARLIER`` lowest keys of its node that lie ``before`` it.  Two nodes that have a key before this one in
    common share that key too, so the lowest key they share is never passed over; equal keys of
    different pairs only add a candidate."""
    facts = [c for c in side.columns if c != "entry"]
    pair = F.col("entry") % 2 == 0
    keyed = (side.filter(pair).groupBy(*facts).agg(F.sort_array(F.collect_set(F.hash("entry"))).alias("keys"))
             .select(*facts, "keys", F.posexplode("keys").alias("at", "key"))
             .select(*facts, (F.col("key").cast("long") * 2).alias("entry"),
                     F.slice("keys", F.lit(1), F.least("at", F.lit(EARLIER))).alias("before")))
    return side.filter(~pair).withColumn("before", F.array().cast("array<int>")).unionByName(keyed)


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                       percent: int = PERCENT, frequent: int = FREQUENT) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest id reachable by links)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    tables = frequency_tables(rows.select("text"), width, frequent)
    index = stored(rows.mapInArrow(_index(*tables, width, percent), "doc_id long, n long, f1 long, f2 long, "
                                   "rare long, singles long, last long, sketch array<long>, entries array<long>"), "index")
    key = ["n", "f1", "f2"]
    reps = index.filter("n > 0").groupBy(*key).agg(F.min("doc_id").alias("node"), F.first("sketch").alias("k"))
    live = _live_entries(index, percent)
    rare = live.filter(F.col("entry") % 2 != 0)
    # the entry's most central document against its others
    lead = live.groupBy("entry").agg(F.min(F.struct("rare", "node", "n", "misses", "singles", "last")).alias("lead"))
    star = stored(_side(live, "v").join(lead, "entry").select(
        "v", "nv", "mv", "sv", "lv", *[F.col(f"lead.{c}").alias(a) for c, a in
                                       (("node", "u"), ("n", "nu"), ("misses", "mu"), ("singles", "su"), ("last", "lu"))])
        .filter("u <> v").filter(_may_link(percent)).select("u", "v", *_FACTS).distinct(), "star")
    met = (star.join(rare.select(F.col("node").alias("u"), "entry"), "u", "left")
           .join(rare.select(F.col("node").alias("v"), "entry", F.lit(1).alias("both")), ["v", "entry"], "left")
           .groupBy("u", "v", *_FACTS).agg(F.count("both").alias("met")))
    star = stored(_enough(met, percent), "star")
    links = _verified(star, rows, width, percent)
    first = components(links)
    # what still shares an entry across components
    named = live.join(first, "node", "left").withColumn("component", F.coalesce("component", "node"))
    side = _first_meetings(stored(_across(named), "mixed"))
    side = side.join(reps.select("node", "k"), "node")         # sets that share an id: a candidate more, none less
    more = ("component", "before", "k")
    cross = (_side(side, "u", *more, "met").join(_side(side, "v", *more).withColumnRenamed("entry", "e"),
                                                 (F.col("entry") == F.col("e")) & (F.col("cu") < F.col("cv"))
                                                 & _may_link(percent) & _near_sketches(percent)
                                                 & ~F.arrays_overlap("bu", "bv"))
             .groupBy("u", "v", *_FACTS).agg(F.sum("met").alias("met")))
    cross = _enough(cross, percent).distinct()
    done = star.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b"))
    cross = stored(cross.join(done, (F.least("u", "v") == F.col("a")) & (F.greatest("u", "v") == F.col("b")), "left_anti")
                   .select("u", "v"), "cross")
    last = components(links.union(_verified(cross, rows, width, percent)))
    return (index.select("doc_id", *key).join(reps.drop("k"), key, "left").join(last, "node", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.coalesce("component", "node"))
                    .alias("component_id")))


def keep_one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                           percent: int = PERCENT) -> DataFrame:
    """``docs`` with the smallest id of each component; of rows that repeat an id one stays.  Rows without
    an id all stay."""
    found = stored(jaccard_components(docs, id_col, text_col, width, percent), "found").filter("doc_id IS NOT NULL")
    # ids that go or that stand on several rows; all other rows stay without a shuffle
    doubt = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c"), F.min("component_id").alias("m"))
    doubt = stored(doubt.filter("c > 1 OR m <> doc_id").select(F.col("doc_id").alias(id_col), (F.col("m") == F.col("doc_id"))
                                                               .alias("keep")), "doubt")
    maybe = F.col(id_col).isNotNull() & IdFilter(doubt.select(id_col)).column(id_col)
    some = docs.filter(maybe)
    return (docs.filter(~maybe)
            .unionByName(some.join(doubt.select(id_col), id_col, "left_anti").select(*docs.columns))
            .unionByName(some.join(doubt.filter("keep").select(id_col), id_col, "left_semi").dropDuplicates([id_col])
                         .select(*docs.columns)))


@register("op2_ngram_jaccard", """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(ws[p:p + 3], ' ') AS sh
      FROM (SELECT *, unnest(range(1, greatest(len(ws) - 2, 2))) AS p FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
i AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM g a JOIN g b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS MATERIALIZED (SELECT u, v FROM i JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * c >= 85 * (a.n + b.n - c)),
r AS (SELECT doc_id AS u, doc_id AS v FROM documents UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, (SELECT min(v) FROM r WHERE r.u = w.doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id)""")
def op2(spark, sf_dir):
    return jaccard_components(read_table(spark, sf_dir, "documents"))
