"""Text operators against DuckDB, brute force, held-out labels and edge cases."""

import collections
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rarecast.llm import (components, decontaminate, exact_dedup, katz, kernels, licences, line_dedup, mixing,
                          ngram_join, quality, registry, spans, toxicity)

SF = "/root/testdata/sf0.001"
SF_LABELS = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(FOLD))


def make(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty, very long, repeated and tied rows, clashing extra columns."""
    long = " ".join(f"w{i} x{i % 7}." for i in range(30_000))
    rows = [(1, None, None), (2, "", "a"), (3, "One two three four five six seven eight nine ten.", "a"),
            (4, "ONE two three four five six seven eight nine ten.", "b"), (4, "ONE two three four five six seven eight nine ten.", "b"),
            (5, long, "b"), (6, long, None), (None, "no id here", "a"), (7, " \n\t \n", "a"), (8, "é É\nline\nline", "c")]
    return make(spark, rows).withColumns({c: F.lit("clash") for c in (
        "mix_rate", "part", "n", "size", "component_id", "h", "spans_", "copies", "keep_id", "label", "rid", "node", "entry")})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", sorted(["op2_ngram_jaccard", "op3_content_sort_dedup", "op7_line_dedup",
                                         "op8_containment_search", "op10_source_mix"]))
def test_matches_duckdb(spark, name):
    registry.load_all()
    got = registry.QUERIES[name](spark, SF)
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(registry.ORACLE[name])
    cols = [d[0] for d in want.description]
    assert sorted(cols) == sorted(got.columns)

    def canon(rows):
        return collections.Counter(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows)

    assert canon(want.fetchall()) == canon(tuple(r) for r in got.select(*cols).collect())


def test_content_sort_edges(spark, odd, empty):
    got = exact_dedup.content_sort_dedup(odd, keep="largest", partitions=3).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert len(got) == 10
    assert by[1][0].keep_id == 2 and by[2][0].kept and by[1][0].group_size == 2
    assert by[3][0].keep_id == 4 and sum(r.kept for r in by[4]) == 1 and by[4][0].group_size == 3
    assert by[6][0].kept and not by[5][0].kept
    low = {(r.doc_id, r.keep_id) for r in exact_dedup.content_sort_dedup(odd).collect()}
    assert {(4, 3), (6, 5), (2, 1)} <= low
    assert exact_dedup.content_sort_dedup(empty).count() == 0


def test_content_sort_hot_group_over_partitions(spark):
    docs = make(spark, [(i, "Same text" if i % 3 else f"t{i}", "a") for i in range(3000)])
    got = exact_dedup.content_sort_dedup(docs, keep="largest", partitions=16)
    assert got.filter("kept").count() == 1001
    assert got.filter("group_size = 2000").select("keep_id").distinct().collect()[0][0] == 2999


def brute_components(texts, width, percent):
    sets = {}
    for i, t in texts.items():
        w = tokens(t)
        sets[i] = ({tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)}) if w else set()
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in texts:
        for b in texts:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in texts}


@pytest.mark.parametrize("frequent", [2, 5, 1000])
def test_jaccard_against_all_pairs(spark, frequent):
    """Near copies of few bases: with a low ``frequent`` the pair index carries the join."""
    rng = random.Random(frequent)
    words = [f"w{i}" for i in range(60)]
    texts = {}
    for base in range(4):
        b = [rng.choice(words) for _ in range(rng.choice([12, 40, 90]))]
        for k in range(18):
            t = list(b)
            for _ in range(rng.randrange(0, 4)):
                t[rng.randrange(len(t))] = rng.choice(words)
            texts[len(texts)] = " ".join(t)
    texts |= {100: "", 101: None, 102: "a b", 103: "A  b", 104: "be be be be be be be"}
    got = ngram_join.jaccard_components(make(spark, [(i, t, "a") for i, t in texts.items()]), frequent=frequent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute_components(texts, 4, 85)


@pytest.mark.parametrize("frequent", [2, 1000])
@pytest.mark.parametrize("width,percent,n", [(4, 85, 6), (5, 80, 4)])
def test_jaccard_small_set_inside_larger(spark, width, percent, n, frequent):
    """A set that may miss none of its tokens links with one that holds it and one token more."""
    texts = {}
    for k in range(6):
        w = [f"{'abc'[k % 3]}{k}x{i}" for i in range(n + width)]
        texts |= {10 * k: " ".join(w[:-1]), 10 * k + 1: " ".join(w), 10 * k + 2: " ".join(w[:-2])}
        texts |= {10 * k + 3: " ".join(["new", *w[:-1]]), 10 * k + 4: " ".join(w[1:])}
    docs = make(spark, [(i, t, "a") for i, t in texts.items()]).coalesce(1)
    got = ngram_join.jaccard_components(docs, width=width, percent=percent, frequent=frequent)
    want = brute_components(texts, width, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == want
    assert want[0] == (n, 0) and want[1] == (n + 1, 0)


@pytest.mark.parametrize("earlier", [1, 8])
def test_first_meetings_lose_no_pair(spark, earlier, monkeypatch):
    """Pairs that share an entry before and after are the same; those of frequent tokens come fewer times."""
    monkeypatch.setattr(ngram_join, "EARLIER", earlier)
    rng = random.Random(earlier)
    rows = [(2 * e + (e % 5 == 0), n, n % 4) for n in range(30) for e in rng.sample(range(60), 20)]
    side = spark.createDataFrame(rows, "entry long, node long, component long")

    def meetings(d, *more):
        a = d.select("entry", F.col("node").alias("u"), *[F.col(c).alias(c + "_u") for c in more])
        b = d.select("entry", F.col("node").alias("v"), *[F.col(c).alias(c + "_v") for c in more])
        j = a.join(b, "entry").filter("u < v")
        return j.filter("NOT arrays_overlap(before_u, before_v)") if more else j

    first = ngram_join._first_meetings(side)
    plain, told = meetings(side).collect(), meetings(first, "before").collect()
    assert {(r.u, r.v) for r in plain} == {(r.u, r.v) for r in told}
    odd = [sorted((r.entry, r.u, r.v) for r in x if r.entry % 2) for x in (plain, told)]
    assert odd[0] == odd[1] and len(told) < len(plain)


def test_jaccard_shared_passage_makes_few_pairs(spark, monkeypatch):
    """Texts that share half of their shingles, none linked but the near copies: each shared passage is one entry
    and the pairs that are too far apart are not made."""
    rng = random.Random(7)
    words = [f"w{i}" for i in range(12)]         # in all texts, so the order tells no shared shingle from others
    passage = [rng.choice(words) for _ in range(70)]
    texts = {i: [*[rng.choice(words) for _ in range(35)], *passage, *[rng.choice(words) for _ in range(35)]] for i in range(40)}
    texts |= {50 + i: [*texts[i][:-1], "new"] for i in range(5)}
    texts = {i: " ".join(t) for i, t in texts.items()}
    rows = {}

    def counted(df, name, put=ngram_join.stored):
        made = put(df, name)
        rows.setdefault(name, []).append(made.count())
        return made

    monkeypatch.setattr(ngram_join, "stored", counted)
    docs = make(spark, [(i, t, "a") for i, t in texts.items()])
    got = ngram_join.jaccard_components(docs, width=5, percent=80)
    want = brute_components(texts, 5, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == want
    assert [want[50 + i][1] for i in range(5)] == list(range(5)) and len({c for _, c in want.values()}) == 40
    assert rows["live"][0] > 300 and rows["mixed"][0] < rows["live"][0] / 2 and rows["cross"] == [0]


def test_live_entries_are_judged_in_written_steps(spark, monkeypatch):
    """No written frame of the judging holds the joins of the steps before it: one task would keep the sort
    pages of all of them at once."""
    base = [f"w{i}" for i in range(60)]
    texts = [base[:i] + ["x", "y"] + base[i + 2:] for i in range(20, 24)] + [[f"v{k}{i}" for i in range(30)] for k in range(3)]
    seen, write = [], ngram_join.stored

    def stored(df, name):
        seen.append((name, len(re.findall(r"\bJoin ", df._jdf.queryExecution().optimizedPlan().toString()))))
        return write(df, name)

    judge = ngram_join._live_entries
    monkeypatch.setattr(ngram_join, "_live_entries", lambda *a: (monkeypatch.setattr(ngram_join, "stored", stored), judge(*a),
                                                                 monkeypatch.setattr(ngram_join, "stored", write))[1])
    got = ngram_join.jaccard_components(make(spark, [(i, " ".join(t), "a") for i, t in enumerate(texts)]), width=1, percent=80)
    assert {r.doc_id: r.component_id for r in got.collect()} == {0: 0, 1: 0, 2: 0, 3: 0, 4: 4, 5: 5, 6: 6}
    assert "live" in dict(seen) and max(n for _, n in seen) <= 2, seen


def test_across_keeps_pairs_and_their_rare_tokens(spark):
    """Entries of the same rows become one, whose ``met`` adds up to the rare tokens that a pair shares."""
    rng = random.Random(3)
    lists = [rng.sample(range(20), rng.choice([1, 2, 3, 6])) for _ in range(15)]
    rows = [(e, n, n % 4, n * n) for e in range(90) for n in lists[e % 15]]
    named = spark.createDataFrame(rows, "entry long, node long, component long, n long")

    def meetings(d, met):
        a, b = (d.select("entry", *[F.col(c).alias(c + x) for c in ("node", "component")], met.alias("met" + x)) for x in "uv")
        j = a.join(b, "entry").filter("componentu < componentv").groupBy("nodeu", "nodev").agg(F.sum("metu").alias("m"))
        return {(r.nodeu, r.nodev): r.m for r in j.collect()}

    across = ngram_join._across(named)
    plain = meetings(named, (F.col("entry") % 2 != 0).cast("long"))
    assert plain and meetings(across, F.col("met")) == plain and across.count() < named.count() / 2


@pytest.mark.parametrize("percent", [80, 85])
def test_sketches_rule_out_no_link(spark, percent):
    """Every pair that reaches the threshold passes; of the pairs far below it few do."""
    rng = random.Random(percent)
    sets, sizes = [], [1, 2, 7, 30, 200, 900, 4000]
    for n in sizes * 4:
        base = [rng.getrandbits(64) for _ in range(n)]
        near = [rng.getrandbits(64) if rng.random() < 0.1 else t for t in base]
        half = [rng.getrandbits(64) if rng.random() < 0.5 else t for t in base]
        sets += [(base, near), (base, half), (base, base[n // 6:])]
    flat = [np.array(t, np.uint64) for p in sets for t in p]
    held = ngram_join._sketch(np.repeat(np.arange(len(flat)), [len(t) for t in flat]), np.concatenate(flat), len(flat)).to_pylist()
    rows = [(len(a), len(b), held[2 * i], held[2 * i + 1], 100 * len(set(a) & set(b)) >= percent * len(set(a) | set(b)))
            for i, (a, b) in enumerate(sets)]
    pairs = spark.createDataFrame(rows, "nu long, nv long, ku array<long>, kv array<long>, linked boolean")
    got = pairs.withColumn("near", ngram_join._near_sketches(percent)).collect()
    assert all(r.near for r in got if r.linked) and any(r.linked for r in got)
    assert not any(r.near for r in got[1::3] if r.nu in (200, 900))


def test_jaccard_edges(spark, odd, empty):
    got = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(odd).collect()}
    assert got[1] == 1 and got[2] == 2 and got[4] == 3 and got[6] == 5 and got[None] is None
    assert ngram_join.jaccard_components(empty).count() == 0
    kept = ngram_join.keep_one_per_component(odd)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 5, 7, 8] and kept.columns == odd.columns


def test_components_of_long_paths(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 130)], "u long, v long")
    got = {r.node: r.component for r in components.components(links).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[i] == 100 for i in range(100, 130))


def test_lines_keep_first_and_edges(spark, odd, empty):
    docs = make(spark, [(1, "Head\nx\nhead ", "a"), (2, "HEAD\ny", "a"), (3, "\n\nz\nhead", "a")])
    got = {r.doc_id: (r.text, r.n_dropped, r.keep_runs) for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {1: ("Head\nx", 1, [2, 1]), 2: ("y", 1, [0, 1]), 3: ("\n\nz", 1, [3, 1])}
    none = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs, keep_first=False, min_docs=3).collect()}
    assert none == {1: "x", 2: "y", 3: "\n\nz"}
    assert line_dedup.dedup_lines(odd).count() == odd.count() and line_dedup.dedup_lines(empty).count() == 0


def test_containment_edges(spark, odd, empty):
    bench = spark.createDataFrame([(1, "two three four five six seven eight"), (2, None), (3, "no ID here"), (4, "")],
                                  "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contained_items(odd, bench, block=3).collect()}
    assert got == {(3, 1), (4, 1), (None, 3)}
    assert decontaminate.drop_contaminated(odd, bench).count() == odd.count() - 4
    assert decontaminate.contained_items(empty, bench).count() == 0
    assert decontaminate.contained_items(odd, bench.limit(0)).count() == 0


def test_mix_edges(spark, odd, empty):
    got = mixing.with_copies(odd).select("doc_id", "mix.*").collect()
    assert len(got) == 10 and all(r.taken <= 2 * r["size"] for r in got)
    assert mixing.with_copies(empty).count() == 0
    assert mixing.mix(odd).drop("copy").columns == odd.columns


def test_mix_salted_join_agrees(spark, monkeypatch):
    docs = make(spark, [(i, "w " * (i % 50), f"s{i % 9}" if i % 10 else None) for i in range(900)])
    want = sorted(map(tuple, mixing.with_copies(docs).select("doc_id", "mix.*").collect()))
    monkeypatch.setattr(mixing, "BROADCAST_BYTES", 0)
    assert sorted(map(tuple, mixing.with_copies(docs).select("doc_id", "mix.*").collect())) == want


def test_span_removal(spark, odd, empty):
    p = " ".join(f"Alpha{i} beta{i} gamma{i} delta{i} eps{i} zeta{i}." for i in range(9))
    one = " ".join(f"solo{i}" for i in range(55)) + "."
    docs = make(spark, [(1, f"Start here. {p} The end.", "a"), (2, f"Other words.\n{p}\nLast one.", "a"),
                        (3, "Nothing of this. Is said. Anywhere else.", "a"), (4, f"x y. {one} tail z.", "a"),
                        (5, f"{one} more.", "a")])
    got = {r.doc_id: r for r in spans.remove_repeated_spans(docs).collect()}
    assert got[1].text.startswith("Start here. Alpha0") and got[1].n_removed == 0
    assert got[2].text == "Other words.\nLast one." and got[2].first_ids == [1]
    assert got[3].n_removed == 0 and got[5].n_removed > 0 and got[4].n_removed == 0
    assert spans.remove_repeated_spans(odd).count() == 10
    assert spans.remove_repeated_spans(empty).count() == 0


def test_span_cuts_realign_inside_passages(spark):
    """Passages of 51 to 80 words, without an inner stop or with a late one, put into sentences at different offsets."""
    rng = random.Random(5)

    def some(n, of):
        return [f"{of}{rng.randrange(10 ** 6)}" for _ in range(n)]

    rows, inside = [], {}
    for k in range(40):
        p = some(51 + k % 30, "p")
        if k % 2:
            p[44] += "."
        for i in (2 * k, 2 * k + 1):
            rows.append((i, " ".join([*some(3 + 7 * (i % 2) + k % 5, "x"), *p, *some(9, "y")]) + ".", "a"))
        inside[2 * k + 1] = set(p)
    got = {r.doc_id: r for r in spans.remove_repeated_spans(make(spark, rows)).collect()}
    for i, p in inside.items():
        gone = set(rows[i][1].split()) - set(got[i].text.split())
        assert gone and gone <= p and got[i - 1].n_removed == 0


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_spans_shuffled_once(spark, odd):
    """The runs of all texts go through one exchange, and no text without a span through any."""
    assert len(re.findall(r"Exchange hashpartitioning\(h#", plan_text(spans.repeated_spans(odd)))) == 1
    p = " ".join(f"Alpha{i} beta{i} gamma{i} delta{i} eps{i} zeta{i}." for i in range(9))
    docs = make(spark, [(None, f"{p} One.", "a"), (None, f"Intro here. {p} Two.", "a"), (3, f"{p} Three.", "a"), (4, "Alone here.", "a")])
    got = spans.remove_repeated_spans(docs)
    assert "maybe(" in plan_text(got)
    assert sorted((r.doc_id or 0, r.n_removed > 0) for r in got.collect()) == [(0, False), (0, True), (3, True), (4, False)]
    few = spans.remove_repeated_spans(docs, changed_only=True).collect()
    assert sorted((r.doc_id or 0, r.n_removed > 0) for r in few) == [(0, True), (3, True)]


def test_katz_blocks_are_small():
    """Sorted bigram keys with their counts take less than the 4 bytes a difference and 4 a count had."""
    rng = np.random.default_rng(3)
    for top in (1 << 20, 1 << 30, 1 << 38):
        keys, n = np.sort(rng.integers(0, top, 20_000)), rng.integers(1, 4, 20_000).astype(np.uint32)
        assert (katz.unpack(katz.pack(keys)) == keys).all() and (katz.expand(katz.squeeze(n)) == n).all()
        assert len(katz.pack(keys)) + len(katz.squeeze(n)) < 5 * len(keys)
    assert len(katz.unpack(katz.pack(np.zeros(0, np.int64)))) == 0
    assert katz.expand(katz.squeeze(np.zeros(0, np.uint16))).dtype == np.uint16


def test_katz_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    c, pair, hist, n_docs = collections.Counter(), collections.Counter(), collections.Counter(), 0
    for i, t in docs:
        if zlib.crc32(str(i).encode()) % 5 != 1:
            w = ["<s>", *tokens(t), "</s>"]
            c.update(w[1:-1])
            n_docs += 1
            pair.update(zip(w, w[1:]))
            hist.update(w[:-1])
    n, v, p0 = sum(c.values()) + n_docs, len(c) + 1, sum(x == 1 for x in c.values()) / (sum(c.values()) + n_docs)
    c["</s>"] = n_docs
    of = np.bincount(np.minimum(list(pair.values()), katz.GT_MAX + 2), minlength=katz.GT_MAX + 3)
    d = katz.discounts(of)
    after = collections.defaultdict(list)
    for (a, b), k in pair.items():
        after[a].append((b, k))

    def p1(w):
        return (1 - p0) * c[w] / n if c[w] else p0

    def weights(h):
        used = sum(k * d[min(k, katz.GT_MAX + 1)] for _, k in after[h])
        den = hist[h] + (hist[h] - used < 1e-9 * hist[h])
        return den, (1 - used / den) / (1 - sum(p1(b) for b, _ in after[h]))

    def log_p(h, w):
        if not hist[h]:
            return math.log10(p1(w))
        den, alpha = weights(h)
        k = pair.get((h, w), 0)
        return math.log10(k * d[min(k, katz.GT_MAX + 1)] / den) if k else math.log10(alpha * p1(w))

    for h in list(after)[:20]:            # exactly normalised
        total = sum(10 ** log_p(h, w) for w in c) + 10 ** log_p(h, "<unk>")
        assert abs(total - 1) < 1e-9
    registry.load_all()
    got = {r.doc_id: r for r in registry.QUERIES["op6_katz_backoff"](spark, SF).collect()}
    for i, t in docs[::5]:
        w = [*tokens(t), "</s>"]
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(c[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[x] + .5) / (n + .5 * (v + 1))) for x in w), abs=1e-6)
        assert r.score == pytest.approx(sum(log_p(a, b) for a, b in zip(["<s>", *w], w)), abs=1e-6)


def test_katz_tail_words_equal_head_words_in_base(spark, monkeypatch):
    """With a small head the other words go through the joins: base scores and counts must not change."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    rows = docs.select("text")
    full = {r.doc_id: r for r in katz.score(docs, katz.train(rows)).collect()}
    monkeypatch.setattr(katz, "HEAD", 200)
    small = {r.doc_id: r for r in katz.score(docs, katz.train(rows)).collect()}
    for i, r in full.items():
        assert (small[i].n_tokens, small[i].n_known) == (r.n_tokens, r.n_known)
        assert small[i].base_score == pytest.approx(r.base_score, abs=1e-6) and small[i].score < 0


def test_katz_score_does_not_depend_on_head(spark, monkeypatch):
    """Words outside the head keep their own bigrams, discounts and backoff weights."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 60").union(make(spark, [(
        1000, None, "a"), (1001, "never seenbefore never seenbefore", "a"), (1002, "seenbefore", "a")]))
    rows = docs.filter("doc_id % 5 <> 1").select("text")

    def scores(head):
        monkeypatch.setattr(katz, "HEAD", head)
        return {r.doc_id: tuple(r) for r in katz.score(docs, katz.train(rows)).collect()}

    full = scores(1 << 19)
    assert len(full) == 63
    for head in (200, 0):
        small = scores(head)
        assert all(small[i] == pytest.approx(r, abs=1e-6) for i, r in full.items())


def test_katz_edges(spark, odd, empty):
    assert katz.score(odd, katz.train(odd.select("text"))).count() == 10
    assert katz.train(empty.select("text"))[0] is None
    assert katz.untrained_score(odd).filter("n_tokens = 1").count() == 3


def test_maximal_segments_against_recursion():
    """Ruzzo and Tompa's definition: the best subsequence, then the same on both sides of it."""
    def brute(x, lo, hi):
        best = max(((sum(x[i:j]), i - j, -i, i, j) for i in range(lo, hi) for j in range(i + 1, hi + 1)), default=None)
        if not best or best[0] <= 0:
            return []
        i, j = best[3], best[4]
        return brute(x, lo, i) + [(i, j)] + brute(x, j, hi)

    rng = random.Random(1)
    for _ in range(200):
        x = [rng.choice([-3.1, -2.3, -1.7, 1.13, 2.19, 3.37]) + rng.random() / 7 for _ in range(rng.randrange(1, 14))]
        total = np.concatenate([[0], np.cumsum(x)])
        up = [i for i, v in enumerate(x) if v > 0]
        got = toxicity.maximal_segments([total[i] for i in up], [total[i + 1] for i in up])
        assert [(up[a], up[b] + 1) for a, b, _ in got] == brute(x, 0, len(x))


@pytest.mark.parametrize("name,target", [("op1_quality_fm", "quality"), ("op9_toxic_segments", "toxic")])
def test_held_out_labels(spark, name, target):
    registry.load_all()
    got = registry.QUERIES[name](spark, SF_LABELS).join(spark.read.parquet(f"{SF_LABELS}/labels.parquet"), "doc_id")
    held = got.filter("held_out").select("score", target).collect()
    pos, neg = [s for s, y in held if y == 1], [s for s, y in held if y == 0]
    auc = np.mean([(p > q) + (p == q) / 2 for p in pos for q in neg])
    assert auc > 0.85 and all(0 <= s <= 1 for s in pos + neg)


def test_classifiers_edges(spark, odd, empty):
    labels = spark.createDataFrame([(3, 1, 1), (5, 0, 0), (5, 1, 0), (None, 1, 1), (8, None, None)],
                                   "doc_id long, quality int, toxic int")
    m = quality.fit(odd, labels.filter("doc_id = 3"), F.lit(True))
    assert m == 1.0 and quality.score_documents(odd, m).count() == 10
    m = toxicity.fit(odd, labels, F.lit(True))
    assert toxicity.score_documents(odd, m).filter("score between 0 and 1").count() == 10
    assert toxicity.drop_toxic(empty, m).count() == 0 and quality.score_documents(empty, 0.5).count() == 0


def test_factorisation_identity():
    m = quality.FactorisationMachine(10, 3)
    x = {1: .5, 4: 1.0, 7: 2.0}
    slot, value = np.array(list(x)), np.array(list(x.values()))
    pairs = sum(float(m.v[a] @ m.v[b]) * x[a] * x[b] for a in x for b in x if a < b)
    assert m.margin(np.array([0]), slot, value)[0][0] == pytest.approx(pairs, abs=1e-6)


def test_licences_inherit_from_nearest(spark, empty):
    rows = [(1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/x.txt", "plain words"),
            (3, "a/b/c/LICENSE", "All rights reserved."), (4, "a/b/c/y.txt", None), (5, "d/z.txt", ""),
            (6, "a/own.txt", "Some text here first.\nLicensed under CC BY-NC 4.0. And then some more of the text.")]
    files = spark.createDataFrame(rows, "doc_id long, path string, text string")
    got = {r.doc_id: (r.licence, r.origin, r.licence_dir) for r in licences.licence_scan(files).collect()}
    assert got == {1: ("MIT", "own", None), 2: ("MIT", "inherited", "a"), 3: ("proprietary", "own", None),
                   4: ("proprietary", "inherited", "a/b/c"), 5: (None, "none", None), 6: ("CC-BY-NC-4.0", "own", None)}
    assert licences.licence_scan(empty.withColumn("path", F.lit(None).cast("string"))).count() == 0


def test_licence_texts_headers_and_identifiers(spark):
    """Whole licence files, standard headers behind a copyright line, SPDX lines, texts passed in."""
    prose = " ".join(f"plain word{i} of the code" for i in range(150))
    rows = [(f"w/{n}/LICENSE", f"Copyright (c) 2020 Jane Roe\nAll rights reserved.\n\n{t}", (n, True))
            for n, t in licences.bundled_texts().items()]
    rows += [(f"h/{n}/x.py", f"# Copyright 2020 Jane Roe\n#\n# {t}\n{prose}", (n, False)) for n, t in licences.HEADERS.items()]
    rows += [(f"s/{k}/x.py", f"// SPDX-License-Identifier: {x}\n{prose}", (n, False)) for k, (x, n) in enumerate(
        [("GPL-2.0-or-later", "GPL-2.0"), ("isc", "ISC"), ("Zlib", "Zlib")])]
    rows += [("m/LICENSE", "Own terms one two three four", ("Own", True)), ("w/MIT/src/x.py", prose, ("MIT", False)),
             ("n/x.py", prose, (None, False))]
    files = spark.createDataFrame([(i, p, t) for i, (p, t, _) in enumerate(rows)], "doc_id long, path string, text string")
    own = spark.createDataFrame([("Own", "Own terms one two three four")], "licence string, text string")
    got = {r.path: (r.licence, r.is_licence_file) for r in licences.licence_scan(files, more_texts=own).collect()}
    assert got == {p: want for p, _, want in rows}


def test_licence_cosine_weighs_all_terms_by_the_corpus(spark):
    """A notice among words that most documents hold: the cosine of true document frequencies, by brute force."""
    notice = "this project and its code are licensed under the apache license version 2.0"
    texts = ["this project and its code are plain"] * 300 + [notice, "apache license", None]
    files = spark.createDataFrame([(i, f"d{i}/x", t) for i, t in enumerate(texts)], "doc_id long, path string, text string")
    df = collections.Counter(t for x in texts for t in set((x or "").split()))

    def vector(text):
        return {t: k * (math.log((1 + len(texts)) / (1 + df[t])) + 1) for t, k in collections.Counter(text.split()).items()}

    a, b = vector(notice), vector("licensed under the apache license version 2.0")
    want = sum(a[t] * b[t] for t in b) / math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
    got = {r.doc_id: r for r in licences.licence_scan(files).collect()}
    assert want > 0.9 and got[300].licence == "Apache-2.0" and got[300].cosine == pytest.approx(want, abs=1e-9)
    assert got[0].licence is None


def test_kernels_against_python():
    import pyarrow as pa
    texts = ["", None, "a b  c", " Lead\ttail ", "x", "é Ü\x0bz " * 40, "same words here same words here"]
    c = next(kernels.chunks(pa.array(texts)))
    w = kernels.words(c)
    assert [int(x) for x in np.diff(w.first)] == [len(tokens(t)) for t in texts]
    seen = {}
    for r, h in zip(*kernels.shingles(w, c.n, 3)):
        seen.setdefault(int(r), set()).add(int(h))
    for r, t in enumerate(texts):
        x = tokens(t)
        assert len(seen.get(r, ())) == len({tuple(x[i:i + 3]) for i in range(max(len(x) - 2, 1))} if x else ())


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] and len(corpus_pipeline.STAGES) == 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(i == c for i, (_, c) in brute_components(texts, 5, 80).items())       # no near copies left
    out = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in out.select("doc_id").distinct().collect()} <= set(texts)
