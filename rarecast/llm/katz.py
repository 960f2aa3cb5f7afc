"""Katz backoff language model.

Bigram counts are discounted by Good-Turing for counts up to ``GT_MAX``; the mass this frees is given,
history by history, to the words not seen after it in proportion to their unigram probability, with
backoff weights that make every history's probabilities sum to one.  A token's probability is
evaluated down the levels: bigram if seen, else weight times unigram.

The most frequent words (``HEAD`` at most), their backoff weights and unigram probabilities are
broadcast; this only saves shuffles, every word has its own counts, weight and bigrams whether it is
among them or not.  All other counts grow with the corpus and stay in partitioned tables: unigrams
by word, bigrams with a *tail* word (one outside the head) by the hashes of their words, weights of tail
words by word, bigrams of head words in hash buckets, each a row of sorted keys and counts, as many
buckets as the number of tokens asks for.  What a document needs of the tail is one join of its tail
words and their bigrams with the table of their scores.  Bigrams so frequent that one bucket would feel them (at most 2^16 by the threshold) are
resolved where the text is read; all other (bigram, document) entries go to their bucket in packed
blocks, are looked up there and come back as one sum per document.

Good-Turing at the lowest level: words seen once lend their mass n1 / N to the one outcome <unk>, which
stands for any unseen word.

Defined cases: null text is empty and has its end token only; without training tokens the score is the
base score; a history whose counts are all too large to be discounted counts one more, which leaves
mass to back off to; one after which everything was seen is renormalised and never backs off; rows are
told apart by their place in the table, so repeated rows are scored one by one; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, most_frequent, read_table, stored
from .kernels import HashIndex, chunks, combine, mix64, order_by, words
from .registry import register

HEAD = 1 << 19               # words of the broadcast vocabulary; any number gives the same scores
GT_MAX = 5
BUCKET_TOKENS = 5_000_000    # training tokens a bucket of bigrams stands for
HOT = 1 << 12                # histories above 1 / HOT of all tokens are spread over all buckets
HOT_PAIRS = 1 << 16          # bigrams above 1 / HOT_PAIRS of all tokens are resolved without a shuffle
BLOCK_BYTES = 3 << 19        # of text behind one set of packed blocks
BEGIN, END = mix64(np.array([11, 12], np.uint64))      # stand for the hashes of the two in bigrams with a tail word


def _word_counts(batches):
    """Per task: (word, occurrences); merged in memory up to a bound."""
    held, size = [], 0

    def merged():
        u, at = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
        return u, np.bincount(at, np.concatenate([x for _, x in held]), len(u)).astype(np.int64)

    def batch(u, n):
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(n)], names=["word", "c"])

    for b in batches:
        for c in chunks(b.column("text")):
            held.append(np.unique(words(c).hash, return_counts=True))
            size += len(held[-1][0])
            if size > 1_000_000:
                held = [merged()]
                size = len(held[0][0])
                if size > 500_000:
                    yield batch(*held[0])
                    held, size = [], 0
    if held:
        yield batch(*merged())


class Unigrams:
    """Head vocabulary; ids 0..k-1 by word hash, then end, begin, tail."""

    def __init__(self, head, counts, n_docs: int, n_words: int, n_types: int, once: int):
        self.head, k = HashIndex(head), len(head)
        self.end, self.begin, self.tail, self.ids = k, k + 1, k + 2, k + 3
        self.n = n_words + n_docs                                  # tokens, with one end each
        self.v = n_types + (n_docs > 0)
        self.c = np.concatenate([counts, [n_docs, n_docs, 0]]).astype(np.float64)    # tail: by word, elsewhere
        self.p0 = min((once or 0.5) / max(self.n, 1), 0.5)         # mass of <unk>
        p = (1 - self.p0) * self.c / max(self.n, 1)
        p[self.begin] = 0.0
        self.p = p
        self.all_head = n_types == k
        self.hot = self.c >= self.n / HOT
        self.base0 = np.log10(self.n + 0.5 * (self.v + 1))

    def ids_of(self, h):
        at = self.head.find(h)
        at[at < 0] = self.tail
        return at

    def sequence(self, c, w):
        """(row, bigram key, id) of every token, the end tokens included."""
        ids = self.ids_of(w.hash)
        seq = np.empty(len(ids) + c.n, np.int64)
        seq[np.arange(len(ids)) + w.row] = ids
        ends = w.first[1:] + np.arange(c.n)
        seq[ends] = self.end
        prev = np.empty_like(seq)
        prev[1:] = seq[:-1]
        prev[w.first[:-1] + np.arange(c.n)] = self.begin
        row = np.empty(len(seq), np.int64)
        row[np.arange(len(ids)) + w.row] = w.row
        row[ends] = np.arange(c.n)
        return row, prev * self.ids + seq, seq, ids

    def tail_pairs(self, w, row, key, seq):
        """(place in the sequence, hash of the first word, of the second) of the bigrams with a tail word."""
        prev = key // self.ids
        at = np.flatnonzero((prev == self.tail) | (seq == self.tail))
        word = at - row[at]                                        # number of the second one among the words
        h, t = np.full(len(at), BEGIN), np.full(len(at), END)
        inner, real = prev[at] != self.begin, seq[at] != self.end
        h[inner], t[real] = w.hash[word[inner] - 1], w.hash[word[real]]
        return at, h, t

    def bucket(self, key, n: int):
        h = key // self.ids
        return (mix64(np.where(self.hot[h], key, h).astype(np.uint64) + np.uint64(9)) % np.uint64(n)).astype(np.int64)


_ZSTD = pa.Codec("zstd")


def squeeze(x: np.ndarray) -> bytes:
    """Integers compressed byte place by byte place: the high places are mostly alike."""
    raw = x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes()
    return x.dtype.char.encode() + len(raw).to_bytes(8, "little") + _ZSTD.compress(raw, asbytes=True)


def expand(b) -> np.ndarray:
    b = memoryview(b)
    kind, n = np.dtype(bytes(b[:1]).decode()), int.from_bytes(b[1:9], "little")
    raw = np.frombuffer(_ZSTD.decompress(b[9:], n), np.uint8) if n else np.zeros(0, np.uint8)
    return np.ascontiguousarray(raw.reshape(kind.itemsize, -1).T).view(kind).ravel()


def pack(sorted_keys: np.ndarray) -> bytes:
    """Ascending keys as differences in 4- or 8-byte integers."""
    d = np.diff(sorted_keys, prepend=0)
    wide = len(d) and int(d.max()) >= 1 << 32
    return squeeze(d.astype(np.uint64 if wide else np.uint32))


def unpack(b) -> np.ndarray:
    return np.cumsum(expand(b).astype(np.int64))


def _by_bucket(bucket, *arrays):
    """Arrays sorted by (bucket, first array: below 2^40), cut at bucket borders: (bucket, *parts)."""
    order = np.argsort((bucket.astype(np.uint64) << np.uint64(40)) | arrays[0].astype(np.uint64))
    bucket = bucket[order]
    at = np.flatnonzero(np.diff(bucket, prepend=-1))
    for lo, hi in zip(at, np.append(at[1:], len(bucket))):
        yield int(bucket[lo]), *[a[order[lo:hi]] for a in arrays]


def _pair_counts(held, n_buckets: int):
    def run(batches):
        uni = held.value
        kept, size = [], 0

        def flush():
            if not size:
                return
            u, at = np.unique(np.concatenate([x for x, _ in kept]), return_inverse=True)
            n = np.bincount(at, np.concatenate([x for _, x in kept]), len(u)).astype(np.int64)
            rows = [(k, pack(a), squeeze(m.astype(np.uint32))) for k, a, m in _by_bucket(uni.bucket(u, n_buckets), u, n)]
            b, a, m = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(a, pa.binary()), pa.array(m, pa.binary())],
                                             names=["bucket", "keys", "counts"])

        for b in batches:
            for c in chunks(b.column("text")):
                _, key, seq, _ = uni.sequence(c, words(c))
                kept.append(np.unique(key[(key // uni.ids != uni.tail) & (seq != uni.tail)], return_counts=True))
                size += len(kept[-1][0])
                if size > 1_000_000:
                    yield from flush()
                    kept, size = [], 0
        yield from flush()
    return run


def _tail_pair_counts(held):
    """Per task: (first word, second word, occurrences, join key) of the bigrams with a tail word; merged in
    memory up to a bound.  The key is the tail word, of two the second: the one whose probability is sought."""
    def run(batches):
        uni = held.value
        kept, size = [], 0

        def flush():
            h, t = (np.concatenate([x[i] for x in kept]) for i in (0, 1))
            order = np.lexsort((t, h))
            h, t = h[order], t[order]
            new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (t[1:] != t[:-1])]))
            n = np.diff(np.append(new, len(h)))
            h, t = h[new], t[new]
            k = np.where((uni.head.find(t) < 0) & (t != END), t, h)
            return pa.RecordBatch.from_arrays([*[pa.array(x.view(np.int64)) for x in (h, t)], pa.array(n),
                                               pa.array(k.view(np.int64))], names=["h", "w", "n", "k"])

        for b in batches:
            for c in chunks(b.column("text")):
                w = words(c)
                row, key, seq, _ = uni.sequence(c, w)
                kept.append(uni.tail_pairs(w, row, key, seq)[1:])
                size += len(kept[-1][0])
                if size > 1_000_000:
                    yield flush()
                    kept, size = [], 0
        if size:
            yield flush()
    return run


def _with_head(held):
    """Adds to bigrams, with the probability that the tail's table has for their tail word, what the broadcast
    tells: the id of the first word (-1 in the tail) and the probability of a second word outside the tail."""
    def run(batches):
        u = held.value
        for b in batches:
            h, w = (b.column(c).to_numpy().view(np.uint64) for c in ("h", "w"))
            first, second = u.head.find(h), u.head.find(w)
            first[h == BEGIN] = u.begin
            second[w == END] = u.end
            p = np.where(second < 0, b.column("tail_p").to_numpy(zero_copy_only=False), u.p[second])
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(first), pa.array(p)],
                                             names=["h", "w", "n", "first", "p"])
    return run


def _spread(tail, key: str):
    """Join key of rows that need the tail's tables; the others, which match nothing, are spread."""
    return F.when(tail, F.col(key)).otherwise(F.xxhash64("h", "w", F.lit(key)))


def _merge(table: pa.Table) -> pa.Table:
    """Blocks of one bucket -> one row: its keys, counts and counts of counts."""
    keys = np.concatenate([unpack(x.as_buffer()) for x in table["keys"]])
    n = np.concatenate([expand(x.as_buffer()) for x in table["counts"]])
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    del order
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    u, n = keys[first], np.add.reduceat(n, first, dtype=np.int64)
    of = np.bincount(np.minimum(n, GT_MAX + 2), minlength=GT_MAX + 3)
    return pa.table({"bucket": pa.array([table["bucket"][0].as_py()], pa.int32()), "keys": pa.array([pack(u)], pa.binary()),
                     "counts": pa.array([squeeze(n.astype(np.uint32))], pa.binary()),
                     "of": pa.array([of.tolist()], pa.list_(pa.int64()))})


def discounts(of: np.ndarray) -> np.ndarray:
    """Good-Turing factors of counts 0..GT_MAX+1 (the last stands for all larger counts) from counts of
    counts; where those are too thin for a factor between 0 and 1, half an occurrence is taken off."""
    d = np.ones(GT_MAX + 2)
    for r in range(1, GT_MAX + 1):
        d[r] = (r - 0.5) / r
    if of[1] > 0:
        cut = (GT_MAX + 1) * of[GT_MAX + 1] / of[1]
        for r in range(1, GT_MAX + 1):
            if of[r] > 0 and cut < 1:
                x = ((r + 1) * of[r + 1] / (r * of[r]) - cut) / (1 - cut)
                if 0 < x < 1:
                    d[r] = x
    return d


class Model:
    """Unigrams, discounts and backoff weights; gives the gain of a seen bigram over backing off."""

    def __init__(self, uni: Unigrams, d: np.ndarray, history, used, shadow):
        self.uni, self.d = uni, d
        a, b = np.zeros(uni.ids), np.zeros(uni.ids)
        a[history], b[history] = used, shadow          # discounted counts; unigram mass of seen words
        c = uni.c.copy()
        free = c - a
        den = np.where(free < 1e-9 * np.maximum(c, 1), c + 1, c)
        every = 1 - b < 1e-12                          # nothing left to back off to
        den = np.where(every & (a > 0), a, den)
        with np.errstate(divide="ignore", invalid="ignore"):
            alpha = np.where(every, 1.0, (1 - a / den) / (1 - b))
        alpha[c == 0] = 1.0                            # unseen history: plain unigrams
        den[den == 0] = 1.0
        self.log_alpha, self.log_den = np.log10(np.maximum(alpha, 1e-300)), np.log10(den)
        with np.errstate(divide="ignore"):
            self.log_p = np.log10(uni.p)
        self.log_alpha[uni.tail] = self.log_p[uni.tail] = 0.0      # joined by word
        self.set_hot(np.zeros(0, np.int64), np.zeros(0, np.int64))

    def set_hot(self, keys, counts):
        h = mix64(keys.astype(np.uint64))
        order = np.argsort(h)
        self.hot, self.hot_gain = HashIndex(h[order]), self.gain(keys[order], counts[order])

    def hot_of(self, keys):
        """Position among the hot bigrams, -1 for the others."""
        return self.hot.find(mix64(keys.astype(np.uint64)))

    def gain(self, keys, counts):
        out = np.empty(len(keys))
        for at in range(0, len(keys), 1 << 18):                    # bounds what is held besides
            h, w = np.divmod(keys[at:at + (1 << 18)], self.uni.ids)
            n = counts[at:at + (1 << 18)]
            out[at:at + (1 << 18)] = (np.log10(n * self.d[np.minimum(n, GT_MAX + 1)]) - self.log_den[h]
                                      - self.log_alpha[h] - self.log_p[w])
        return out


def train(texts: DataFrame):
    """((model, number of buckets), stored unigram table, stored bigrams of head words, scores of the tail's
    words and bigrams) of a (text) frame; None without texts."""
    spark = texts.sparkSession
    unigrams = stored(texts.mapInArrow(_word_counts, "word long, c long").groupBy("word").agg(F.sum("c").alias("c")), "unigrams")
    n_docs = texts.count()
    n_words, n_types, once = unigrams.agg(F.sum("c"), F.count(F.lit(1)), F.count_if(F.col("c") == 1)).first()
    if not n_docs:
        return None, unigrams, None, None
    uni = Unigrams(*most_frequent(unigrams, "word", "c", HEAD), n_docs, n_words or 0, n_types, once)
    held = spark.sparkContext.broadcast(uni)
    n_buckets = max(2 * spark.sparkContext.defaultParallelism, -(-uni.n // BUCKET_TOKENS))
    pairs = stored(texts.mapInArrow(_pair_counts(held, n_buckets), "bucket int, keys binary, counts binary")
                   .groupBy("bucket").applyInArrow(_merge, "bucket int, keys binary, counts binary, of array<long>"), "bigrams")
    of = np.array(pairs.agg(*[F.coalesce(F.sum(F.col("of")[i]), F.lit(0)) for i in range(GT_MAX + 3)]).first(), dtype=np.float64)
    tail_pairs = None
    if not uni.all_head:
        # counts and join go by the one key, so the bigrams are shuffled once
        counted = (texts.mapInArrow(_tail_pair_counts(held), "h long, w long, n long, k long").repartition("k")
                   .groupBy("k", "h", "w").agg(F.sum("n").alias("n")))
        known_p = unigrams.select(F.col("word").alias("k"), (F.col("c") * ((1 - uni.p0) / uni.n)).alias("tail_p"))
        tail_pairs = stored(counted.join(known_p, "k", "left").select("h", "w", "n", "tail_p")
                            .mapInArrow(_with_head(held), "h long, w long, n long, first long, p double"), "tail-pairs")
        for n, times in tail_pairs.groupBy(F.least("n", F.lit(GT_MAX + 2))).count().collect():
            of[n] += times
    d = discounts(of)
    least = max(uni.n / HOT_PAIRS, 1)

    def sums(batches):
        """Per history: discounted counts and unigram mass of its seen words; and the hot bigrams."""
        u = held.value
        for b in batches:
            for x, y in zip(b.column("keys"), b.column("counts")):
                keys = unpack(x.as_buffer())
                n = expand(y.as_buffer()).astype(np.int64)
                h, w = np.divmod(keys, u.ids)
                at, first = np.unique(h, return_index=True)
                used = np.add.reduceat(n * d[np.minimum(n, GT_MAX + 1)], first)
                shadow = np.add.reduceat(u.p[w], first)
                big = n >= least
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([at, keys[big]])), pa.array(np.repeat([False, True], [len(at), big.sum()])),
                     pa.array(np.concatenate([used, n[big]]).astype(np.float64)),
                     pa.array(np.concatenate([shadow, np.zeros(big.sum())]))], names=["key", "hot", "x", "y"])

    facts = (pairs.select("keys", "counts").mapInArrow(sums, "key long, hot boolean, x double, y double")
             .groupBy("key", "hot").agg(F.sum("x").alias("x"), F.sum("y").alias("y")).toArrow())   # HEAD + HOT_PAIRS rows
    hot = facts["hot"].to_numpy()
    key, x, y = (facts[c].to_numpy() for c in ("key", "x", "y"))
    used, shadow = np.bincount(key[~hot], x[~hot], uni.ids), np.bincount(key[~hot], y[~hot], uni.ids)
    if tail_pairs is not None:
        factor = F.element_at(F.array(*[F.lit(float(x)) for x in d]), (F.least("n", F.lit(GT_MAX + 1)) + 1).cast("int"))
        sums_of = [F.sum(F.col("n") * factor).alias("used"), F.sum("p").alias("shadow")]
        more = tail_pairs.filter("first >= 0").groupBy("first").agg(*sums_of).toArrow()           # HEAD rows
        used[more["first"].to_numpy()] += more["used"].to_numpy()
        shadow[more["first"].to_numpy()] += more["shadow"].to_numpy()
    history = np.arange(uni.ids)
    model = Model(uni, d, history, used, shadow)
    model.set_hot(key[hot], x[hot].astype(np.int64))
    tail = spark.createDataFrame([], "key long, c long, score double")
    if tail_pairs is not None:
        tail = _tail_scores(tail_pairs, sums_of, spark.sparkContext.broadcast(model))
    return (model, n_buckets), unigrams, pairs, tail


def _tail_scores(tail_pairs: DataFrame, sums_of, held) -> DataFrame:
    """(key, c, score) of every tail word, with its count, its unigram probability and its weight as history,
    and of every bigram with a tail word, with its gain over backing off."""
    # every occurrence of a word begins one bigram, so these sum to its count
    h = tail_pairs.filter("first < 0").groupBy("h").agg(F.sum("n").alias("c"), *sums_of)
    free = F.col("c") - F.col("used")
    every = 1 - F.col("shadow") < 1e-12
    den = F.when(every & (F.col("used") > 0), F.col("used")).when(free < 1e-9 * F.col("c"), F.col("c") + 1).otherwise(F.col("c"))
    alpha = F.when(every, 1.0).otherwise((1 - F.col("used") / den) / (1 - F.col("shadow")))
    h = stored(h.select("h", "c", F.log10(F.greatest(alpha, F.lit(1e-300))).alias("log_alpha"), F.log10(den).alias("log_den")),
               "tail-words")
    uni = held.value.uni
    own = h.select(F.col("h").alias("key"), "c",
                   (F.log10(F.col("c") * ((1 - uni.p0) / uni.n)) + F.col("log_alpha")).alias("score"))

    def gains(batches):
        m = held.value
        for b in batches:
            x = {c: b.column(c).to_numpy(zero_copy_only=False) for c in b.schema.names}
            head = x["first"] >= 0
            n, at = x["n"], np.where(head, x["first"], 0)
            gain = (np.log10(n * m.d[np.minimum(n, GT_MAX + 1)]) - np.log10(x["p"])
                    - np.where(head, m.log_den[at] + m.log_alpha[at], x["back"]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(combine([x["h"].view(np.uint64), x["w"].view(np.uint64)], 7).view(np.int64)),
                 pa.nulls(len(n), pa.int64()), pa.array(gain)], names=["key", "c", "score"])

    back = h.select(F.col("h").alias("k"), (F.col("log_alpha") + F.col("log_den")).alias("back"))
    return own.unionByName(tail_pairs.withColumn("k", _spread(F.col("first") < 0, "h")).join(back, "k", "left")
                           .select("h", "w", "n", "first", "p", "back").mapInArrow(gains, "key long, c long, score double"))


_OUT = "rid long, doc_id long, n_tokens long, n_known long, base double, score double"


def _outcome(rid, doc_id=None, **cols):
    n = len(rid)
    return pa.table({"rid": pa.array(rid, pa.int64()), "doc_id": doc_id if doc_id is not None else pa.nulls(n, pa.int64()),
                     **{k: pa.array(cols[k], t) if k in cols else pa.nulls(n, t) for k, t in
                        (("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()))}})


def score(docs: DataFrame, trained, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """rid, doc_id, n_tokens, n_known, base, score (log10) of each row."""
    spark = docs.sparkSession
    (model, n_buckets), _, pairs, tail_scores = trained
    held = spark.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.monotonically_increasing_id().alias("rid"))

    def once(row, h):
        """Each hash once per document: (row, hash, times)."""
        order = order_by(row, None, h)
        row, h = row[order], h[order]
        new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])])) if len(h) else order
        return row[new], h[new], np.diff(np.append(new, len(h)))

    def known_part(batches):
        """What the broadcast tables tell, per document; its tail words and their bigrams."""
        m, u = held.value, held.value.uni
        floor = np.log10(u.c + 0.5)
        for b in batches:
            rid = b.column("rid").to_numpy()
            for c in chunks(b.column("text")):
                w = words(c)
                row, key, seq, ids = u.sequence(c, w)
                head = seq != u.tail
                hot = m.hot_of(key)
                s = m.log_alpha[key // u.ids] + m.log_p[seq]
                s[hot >= 0] += m.hot_gain[hot[hot >= 0]]
                n = np.bincount(row, minlength=c.n)
                r, h, times = once(w.row[ids == u.tail], w.hash[ids == u.tail])
                k = len(r)
                pair = np.repeat([False], c.n + k)
                if not u.all_head:                                 # else no bigram with a tail word was seen
                    at, *of = u.tail_pairs(w, row, key, seq)
                    r, h, times = (np.concatenate(x) for x in zip((r, h, times), once(row[at], combine(of, 7))))
                    pair = np.concatenate([pair, np.repeat([True], len(r) - k)])
                    k = len(r)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([rid[c.at:c.at + c.n], rid[c.at + r]])),
                    pa.concat_arrays([b.column("doc_id").slice(c.at, c.n), pa.nulls(k, pa.int64())]),
                    pa.concat_arrays([pa.nulls(c.n, pa.int64()), pa.array(h.view(np.int64))]),
                    pa.array(np.concatenate([n, times])),
                    pa.array(np.concatenate([np.bincount(row, head, c.n).astype(np.int64), np.zeros(k, np.int64)])),
                    pa.array(np.concatenate([np.bincount(row, np.where(head, floor[seq], 0.0), c.n) - n * u.base0, np.zeros(k)])),
                    pa.array(np.concatenate([np.bincount(row, s, c.n), np.zeros(k)])), pa.array(pair)],
                    names=["rid", "doc_id", "word", "n_tokens", "n_known", "base", "score", "pair"])

    known = rows.mapInArrow(known_part, "rid long, doc_id long, word long, n_tokens long, n_known long, base double, "
                                        "score double, pair boolean")

    def pair_blocks(batches):
        """Entries (bigram, document) that need their bucket, packed by bucket."""
        m, u = held.value, held.value.uni
        for b in batches:
            rid = b.column("rid").to_numpy()
            for c in chunks(b.column("text"), BLOCK_BYTES):
                row, key, *_ = u.sequence(c, words(c))
                some = (m.hot_of(key) < 0) & (key // u.ids != u.tail) & (key % u.ids != u.tail)
                row, key = row[some], key[some]
                small = np.uint16 if c.n <= 1 << 16 else np.uint32
                out = [(k, pack(a), int(rid[c.at]), squeeze(r.astype(small)))
                       for k, a, r in _by_bucket(u.bucket(key, n_buckets), key, row)]
                if out:
                    k, a, first, r = zip(*out)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(k, pa.int32()), pa.array(a, pa.binary()), pa.array(first, pa.int64()),
                         pa.array(r, pa.binary())], names=["bucket", "keys", "rid", "rows"])

    blocks = rows.mapInArrow(pair_blocks, "bucket int, keys binary, rid long, rows binary")

    def look_up(left: pa.Table, right: pa.Table) -> pa.Table:
        m = held.value
        if not right.num_rows or not left.num_rows:
            return pa.table({"rid": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        keys = unpack(right["keys"][0].as_buffer())
        gain = m.gain(keys, expand(right["counts"][0].as_buffer()))
        rid, total = [], []
        for k, f, r in zip(left["keys"], left["rid"], left["rows"]):
            q = unpack(k.as_buffer())
            at = np.minimum(np.searchsorted(keys, q), len(keys) - 1)
            hit = keys[at] == q
            doc = expand(r.as_buffer())[hit]
            s = np.bincount(doc, gain[at[hit]]).astype(np.float64)
            some = np.flatnonzero(np.bincount(doc))
            rid.append(f.as_py() + some)             # rows of a block are consecutive
            total.append(s[some])
        return pa.table({"rid": pa.array(np.concatenate(rid), pa.int64()), "score": pa.array(np.concatenate(total), pa.float64())})

    gains = (blocks.groupBy("bucket").cogroup(pairs.select("bucket", "keys", "counts").groupBy("bucket"))
             .applyInArrow(look_up, "rid long, score double"))
    # tail words and their bigrams by an ordinary join; an unseen word is <unk>, an unseen bigram gains nothing
    uni = model.uni
    word = F.col("times") > 0                        # a bigram's times are shuffled with a minus
    tails = (known.filter("word IS NOT NULL")
             .select("rid", F.col("word").alias("key"), F.when(F.col("pair"), -F.col("n_tokens")).otherwise(F.col("n_tokens")).alias("times"))
             .join(tail_scores.withColumnRenamed("score", "found"), "key", "left").withColumn("n_tokens", F.abs("times"))
             .select("rid", F.when(word & F.col("c").isNotNull(), F.col("n_tokens")).otherwise(0).alias("n_known"),
                     F.when(word, F.col("n_tokens") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).otherwise(0.0).alias("base"),
                     (F.col("n_tokens") * F.coalesce("found", F.when(word, float(np.log10(uni.p0))).otherwise(0.0)))
                     .alias("score")))
    none = F.lit(None)
    parts = (known.filter("word IS NULL").drop("word", "pair")
             .unionByName(tails.select("rid", none.cast("long").alias("doc_id"), none.cast("long").alias("n_tokens"),
                                       "n_known", "base", "score"))
             .unionByName(gains.select("rid", none.cast("long").alias("doc_id"), none.cast("long").alias("n_tokens"),
                                       none.cast("long").alias("n_known"), none.cast("double").alias("base"), "score")))
    return parts.groupBy("rid").agg(F.max("doc_id").alias("doc_id"), F.sum("n_tokens").alias("n_tokens"),
                                    F.sum("n_known").alias("n_known"), F.sum("base").alias("base_score"),
                                    F.sum("score").alias("score"))


def untrained_score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Without training tokens every token has base probability 1 (0.5 / 0.5)."""
    from .mixing import word_count

    return docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("doc_id"),
                       (word_count(F.col(text_col)) + 1).alias("n_tokens"), F.lit(0).cast("long").alias("n_known"),
                       F.lit(0.0).alias("base_score"), F.lit(0.0).alias("score"))


@register("op6_katz_backoff")
def op6(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    out = crc_mod(F.col("doc_id"), 5) == 1
    trained = train(docs.filter(~out).select("text"))
    n = trained[0][0].uni.n if trained[0] else 0
    scored = score(docs, trained) if trained[0] else untrained_score(docs)
    return scored.select("doc_id", out.alias("held_out"), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
                         "base_score", "score")
