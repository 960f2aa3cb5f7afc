"""Hand-built frames for the semantics listed in SURVEY 2.13 (Q1-Q34)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from rarecast.functions import normalise as N
from rarecast.operators import comments as C
from rarecast.operators import encoders as EN
from rarecast.operators import evaluate as EV
from rarecast.operators import outcome as O
from rarecast.operators import prep as PR
from rarecast.operators import priors as PRI
from rarecast.operators import profile as PF
from rarecast.sources import posts as P
from rarecast.sources import table as TB


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((x is not None, x) for x in t))


def test_int_or_flag_q9(spark):
    df = spark.createDataFrame([(None,), ("42",), (" 7 ",), ("3.7",), ("abc",), ("-5",), ("99999999999",)], "x string")
    out = [r[0] for r in df.select(N.int_or_flag("x")).collect()]
    assert out == [0, 42, 7, -1, -1, -5, -1]


def test_edited_flag_q8(spark):
    df = spark.createDataFrame([("False",), ("0",), ("1600000000.0",), (None,), ("0.0",)], "x string")
    assert [r[0] for r in df.select(N.edited_flag("x")).collect()] == [False, False, True, True, False]


def test_first_or_label_q10(spark):
    df = spark.createDataFrame([([],), (None,), (["a", "b"],)], "x array<string>")
    assert [r[0] for r in df.select(N.first_or_label("x")).collect()] == ["None", "None", "a"]


def test_unpack_awards_missing_key(spark):
    df = spark.createDataFrame([({"gid_1": 2, "gid_2": 1},), (None,)], "m map<string,int>")
    out = rows(N.unpack_awards(df, "m"), "silver", "gold", "platinum")
    assert out == [(0, 0, 0), (2, 1, 0)]


def test_label_ignores_silver_q6(spark):
    df = spark.createDataFrame([(5, 0, 0), (0, 1, 0), (0, 0, 2)], "s int, g int, p int")
    assert [r[0] for r in df.select(N.label_positive("g", "p")).collect()] == [False, True, True]


def test_weekday_monday_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 13, 5),)], "ts timestamp")   # a Monday
    r = df.select(N.weekday("ts").alias("w"), N.minute_of_day("ts").alias("m")).first()
    assert (r["w"], r["m"]) == (0, 13 * 60 + 5)


def test_snapshot_id_and_tag_q11_q12(spark):
    df = spark.createDataFrame([("abc123", "staging/gilded_data_sortedby_new_02-03_at_1530utc.pkl")], "id string, p string")
    r = df.select(N.snapshot_id("id", "p").alias("sid"), N.how_sorted("p").alias("how")).first()
    assert r["sid"] == "abc123_new02031530" and r["how"] == "new"
    r2 = df.select(N.scrape_tag_of(F.lit("abcdefgh_new02031530")).alias("t"),
                   N.scrape_hhmm(F.lit("abc123_new02031530")).alias("h")).first()
    assert r2["t"] == "new02031530" and r2["h"] == "1530"


def test_zero_age_gives_null_rate_q5(spark):
    df = spark.createDataFrame([(10, 0.0), (10, 2.0)], "ups int, age double")
    assert [r[0] for r in df.select(N.rate("ups", "age")).collect()] == [None, 5.0]


def test_normalise_names(spark):
    df = spark.createDataFrame([(1, 2)], "`Upvote ratio` int, `Post  time` int")
    assert N.normalise_names(df).columns == ["Upvote_ratio", "Post_time"]


def test_comment_features_q2_q3_q4_q31(spark):
    asof = dt.datetime(2020, 1, 2)
    t = dt.datetime(2020, 1, 1)
    raw = spark.createDataFrame([
        ("p1", t, 10, 2, "moderator", True, False),
        ("p1", t, 20, 1, "special", False, True),     # other kinds count 0 (Q4)
        ("p1", t, 30, None, None, None, None),
        ("p1", None, 99, 1, None, None, None),        # no creation time: not a comment (Q31)
    ], "post_id string, created timestamp, ups int, gilded int, distinguished string, is_submitter boolean, author_premium boolean")
    c = C.comment_defaults(raw)
    f = C.comment_features(c, "post_id", "created", F.lit(asof), n=15).first()
    age = 86400.0
    rates = [10 / age, 20 / age, 30 / age]
    mean = sum(rates) / 3
    assert f["avg_up_rate"] == pytest.approx(mean)
    assert f["var_up_rate"] == pytest.approx(sum((x - mean) ** 2 for x in rates) / 3)   # population (Q2)
    assert f["gild_rate"] == pytest.approx(1.0)        # counts may sum above n/n (Q3)
    assert f["distinguished_rate"] == pytest.approx(1 / 3)
    assert f["n_comments"] == 3


def test_zero_comment_posts_filled(spark):
    posts = spark.createDataFrame([("a",), ("b",)], "post_id string")
    stats = spark.createDataFrame([("a", 1.0, 0.5, 0.1, 0.2, 0.3, 0.4, 2)],
                                  "post_id string, avg_up_rate double, var_up_rate double, gild_rate double, "
                                  "distinguished_rate double, op_comment_rate double, premium_auth_rate double, n_comments long")
    out = {r["post_id"]: r for r in C.fill_zero(posts, stats, "post_id").collect()}
    assert out["b"]["avg_up_rate"] == 0.0 and out["b"]["n_comments"] == 0


def test_top_n_total_order(spark):
    df = spark.createDataFrame([("p", 5, 1), ("p", 5, 2), ("p", 4, 3), ("q", 1, 4)], "k string, v int, i int")
    out = rows(C.top_n(df, "k", [F.col("v").desc(), "i"], 2), "k", "i")
    assert out == [("p", 1), ("p", 2), ("q", 4)]


def test_join_outcome_missing_flag_q7(spark):
    snap = spark.createDataFrame([("a",), ("b",)], "id string")
    out = spark.createDataFrame([("a", 3)], "id string, final_upvotes int")
    r = rows(O.join_outcome(snap, out, "id"), "id", "outcome_missing")
    assert r == [("a", False), ("b", True)]


def test_exclude_groups_keeps_null(spark):
    df = spark.createDataFrame([("blog",), (None,), ("x",)], "s string")
    assert rows(PR.exclude_groups(df, "s", ["blog"]), "s") == [(None,), ("x",)]


def test_constant_columns(spark):
    df = spark.createDataFrame([(1, None, "a", None), (1, None, "b", 2)], "c int, n string, v string, h int")
    assert sorted(PR.constant_columns(df)) == ["c", "n"]


def test_prep_never_drops_label(spark):
    df = spark.createDataFrame([("x_new01011230", 1.6e9, 0, 0, "s")] * 3,
                               "id string, created_utc double, gold_awarded int, platinum_awarded int, subreddit string")
    out = PR.Prep(drop_groups=["blog"]).fit(df).transform(df)
    assert "gilded" in out.columns and "created_utc" not in out.columns


def test_bin_assign_q18_q19(spark):
    df = spark.createDataFrame([(x,) for x in [0.0, 1.0, 1.5, 2.0, 3.0, 9.0, -1.0]], "x double")
    edges = [0.0, 1.0, 1.0, 2.0, 3.0]        # repeated edge dropped
    out = [r[0] for r in df.select(PRI.bin_assign("x", edges)).collect()]
    assert out == [0, 0, 1, 1, 2, 2, 0]


def test_equal_freq_edges_match_numpy(spark):
    import numpy as np
    vals = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0, 5.0, 3.0, 5.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    n = len(vals)
    expect = np.interp(np.linspace(0, n, 6), np.arange(n), np.sort(vals))
    assert PRI.equal_freq_edges(df, "x", 5) == pytest.approx(list(expect))


def test_target_encode_unseen_and_null_q15_q16(spark):
    train = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1), (None, 0)], "c string, y int")
    test = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    m = EN.TargetMeans(["c"], "y").fit(train)
    out = {r["k"]: r["c"] for r in m.transform(test.withColumn("k", F.coalesce("c", F.lit("null")))).collect()}
    assert out["a"] == pytest.approx(0.5) and out["z"] == pytest.approx(0.5) and out["null"] == pytest.approx(0.0)


def test_target_encode_smoothing(spark):
    train = spark.createDataFrame([("a", 1), ("a", 1), ("b", 0), ("b", 0)], "c string, y int")
    m = EN.TargetMeans(["c"], "y", weight=2).fit(train)
    out = {r["k"]: r["c"] for r in m.transform(train.withColumn("k", F.col("c"))).collect()}
    assert out["a"] == pytest.approx((2 * 1 + 2 * 0.5) / 4)


def test_one_hot_general_q17(spark):
    df = spark.createDataFrame([("x", "p"), ("y", "q"), ("z", "p")], "a string, b string")
    out = EN.OneHot(["a", "b"]).fit(df).transform(df)
    assert sorted(out.columns) == ["a_x", "a_y", "a_z", "b_q"]


def test_log_distance_minimum_learned_at_fit_q24(spark):
    train = spark.createDataFrame([(0.0, 10.0), (2.0, 10.0)], "r double, a double")
    m = EN.LogDistance("r", "a", 1.0).fit(train)
    other = spark.createDataFrame([(0.0, 10.0)], "r double, a double")
    v = m.transform(other).first()["log_feature"]
    assert v == pytest.approx(math.log(0.2) ** 2 + math.log(10) ** 2)


def test_chi2_tail_values(spark):
    df = spark.createDataFrame([(3.841458820694124, 1.0), (0.0, 3.0), (11.070497693516351, 5.0), (100.0, 2.0)],
                               "s double, k double")
    out = [r[0] for r in df.select(PF.chi2_sf("s", "k")).collect()]
    assert out[0] == pytest.approx(0.05, abs=1e-9)
    assert out[1] == 1.0
    assert out[2] == pytest.approx(0.05, abs=1e-9)
    assert out[3] == pytest.approx(math.exp(-50), rel=1e-6)


def test_chi_square_full_is_pos_over_one_minus_p_q26(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("a", 0), ("b", 1), ("b", 1), ("b", 0), ("c", 0)], "f string, y int")
    r = PF.chi_square(df, ["f"], "y").first()
    p = 3 / 7
    assert r["chi2_full"] == pytest.approx(r["chi2_pos"] / (1 - p))
    assert r["dof"] == 2


def test_histograms_sum_to_n(spark):
    df = spark.createDataFrame([(float(x),) for x in range(101)], "x double")
    h = PF.hist_equal(df, "x", 10)
    assert sum(r["n"] for r in h.collect()) == 101
    hf = PF.hist_fixed(df, "x", 0.0, 100.0, 5.0)
    assert sum(r["n"] for r in hf.collect()) == 101


def test_thresholds_report_strict_sweep_inclusive_q27(spark):
    df = spark.createDataFrame([(0.5, 1), (0.4, 0)], "s double, y int")
    assert EV.scores_at(df, "s", "y", 0.5).first()["predicted_share"] == 0.0
    sw = {round(r["thresh"], 3): r for r in EV.sweep(df, "s", "y", 0.5, 0.51, 0.005).collect()}
    assert sw[0.5]["number_of_predictions"] == 5000


def test_auc_and_ap_brute_force_q28(spark):
    import numpy as np
    rng = np.random.default_rng(0)
    s = np.round(rng.random(300), 2)
    y = (rng.random(300) < s * 0.6).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, y)], "s double, y int")
    r = EV.areas(df, "s", "y").first()
    th = np.unique(s)[::-1]
    P, N = y.sum(), (1 - y).sum()
    tp = np.array([(y[s >= t]).sum() for t in th])
    fp = np.array([((1 - y)[s >= t]).sum() for t in th])
    fpr, tpr = np.r_[0, fp / N], np.r_[0, tp / P]
    roc = np.sum(np.diff(fpr) * (tpr[1:] + tpr[:-1]) / 2)
    last = np.searchsorted(tp, P)
    prec = tp[: last + 1] / (tp[: last + 1] + fp[: last + 1])
    rec = tp[: last + 1] / P
    pr = np.sum(np.diff(np.r_[0, rec]) * (np.r_[1, prec][1:] + np.r_[1, prec][:-1]) / 2)
    ap = np.sum(np.diff(np.r_[0, rec]) * prec)
    assert r["roc_auc"] == pytest.approx(roc) and r["pr_auc"] == pytest.approx(pr)
    assert r["average_precision"] == pytest.approx(ap)


def test_allowlist_parser_reference_fixture(spark):
    lines = spark.createDataFrame([("group1,",), ("group2,",), ("group3",), ("history",), ("history",), ("",)],
                                  "value string")
    assert rows(P.parse_allowlist(lines), "name") == [("group1",), ("group2",), ("group3",), ("history",)]


def test_read_posts_id_keyed(spark, tmp_path):
    p = tmp_path / "posts.json"
    p.write_text('{"a1": {"ups": 3, "title": "x"}, "b2": {"ups": 5, "title": "y"}}\n')
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("ups", T.IntegerType()), T.StructField("title", T.StringType())])
    df = P.read_posts(spark, str(p), schema, id_keyed=True)
    assert rows(df, "post_id", "ups") == [("a1", 3), ("b2", 5)]


def test_conform_and_route_all_or_nothing_q33(spark):
    from pyspark.sql import types as T
    df = spark.createDataFrame([("f1", "1"), ("f1", "x"), ("f2", "2")], "file string, v string")
    schema = T.StructType([T.StructField("file", T.StringType()), T.StructField("v", T.IntegerType()),
                           T.StructField("missing", T.StringType())])
    c = TB.conform(df, schema)
    assert c.columns == ["file", "v", "missing"]
    routed = TB.route_files(c, "file", F.col("v").isNull())
    assert rows(routed, "file", "route") == [("f1", "error"), ("f1", "error"), ("f2", "completed")]
    ledger = rows(TB.load_ledger(routed, "file"), "file", "status", "n_rows", "n_bad_rows")
    assert ledger == [("f1", "error", 2, 1), ("f2", "completed", 1, 0)]


def test_append_first_wins_twice_is_once(spark):
    target = spark.createDataFrame([(1, "old")], "id int, v string")
    batch = spark.createDataFrame([(1, "new"), (2, "b"), (2, "a")], "id int, v string")
    once = TB.append_first_wins(target, batch, "id", ["v"])
    twice = TB.append_first_wins(once, batch, "id", ["v"])
    assert rows(once, "id", "v") == rows(twice, "id", "v") == [(1, "old"), (2, "a")]


def test_empty_input_is_noop_q34(spark):
    target = spark.createDataFrame([(1, "old")], "id int, v string")
    empty = spark.createDataFrame([], "id int, v string")
    assert rows(TB.append_first_wins(target, empty, "id", ["v"]), "id") == [(1,)]
    assert TB.load_ledger(TB.route_files(empty, "id", F.lit(False)), "id").count() == 0


def test_prior_matrix_explicit_order_q20(spark):
    t = spark.createDataFrame([("a", 1, 0.5), ("b", 0, 0.25)], "k0 string, k1 int, target_fraction double")
    m = PRI.prior_matrix(t, "k0", "k1", k1_values=[0, 1])
    assert m.columns == ["k0", "0", "1"]
    assert [tuple(r) for r in m.collect()] == [("a", None, 0.5), ("b", 0.25, None)]


def test_complete_grid_three_keys_q21(spark):
    t = spark.createDataFrame([("a", 0, "x", 1)], "k0 string, k1 int, k2 string, total long")
    g = PRI.complete_grid(t, ["k0", "k1", "k2"], domains={"k1": [0, 1]})
    assert g.count() == 2


def test_empty_input_runs_q34(spark):
    """Operators with attached one-row totals run on an empty frame: global
    areas give one all-null row, tables are empty or all-zero bins."""
    from rarecast.operators import resample as RS
    e = spark.createDataFrame([], "id long, s double, y int, c string")
    assert [tuple(r) for r in EV.areas(e, "s", "y").collect()] == [(None, None, None)]
    assert EV.pr_curve(e, "s", "y").count() == 0
    assert all(r["precision"] == 0.0 for r in EV.sweep(e, "s", "y").collect())
    assert PF.share_by(e, "c", "y").count() == 0
    assert PF.chi_square(e, ["c"], "y").count() == 0
    assert all(r["n"] == 0 for r in PF.hist_log(e, "s", -3, 0, 5).collect())
    assert RS.undersample(e, "y", "id", 0.5).count() == 0
    assert RS.split(e, "y", "id").count() == 0
    assert EN.TargetMeans(["c"], "y", 2.0).fit(e).transform(e).count() == 0


def test_pr_curve_cut_is_a_parameter(spark):
    d = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.7, 1), (0.4, 0), (0.2, 0)], "s double, y int")
    assert EV.pr_curve(d, "s", "y").count() == 5
    assert EV.pr_curve(d, "s", "y", to_full_recall=True).count() == 3


def test_half_written_snapshot_is_written_anew(spark, tmp_path):
    d = spark.range(4)
    spark.range(1).write.parquet(str(tmp_path / "day=x"))
    (tmp_path / "day=x" / "_SUCCESS").unlink()
    assert TB.materialise_snapshot(d, str(tmp_path), "x").count() == 4
    assert TB.materialise_snapshot(spark.range(9), str(tmp_path), "x").count() == 4


def test_grid_keeps_null_and_given_domains(spark):
    from rarecast.operators.priors import complete_grid
    t = spark.createDataFrame([("a", 0, 5), (None, 1, 7)], "k string, b int, n long")
    got = {(r.k, r.b): r.n for r in complete_grid(t, ["k", "b"], {"n": 0}, {"b": [0, 1, 2]}).collect()}
    assert got == {("a", 0): 5, ("a", 1): 0, ("a", 2): 0, (None, 0): 0, (None, 1): 7, (None, 2): 0}


def test_replayed_batch_keeps_one_ledger_row_per_file(spark, tmp_path):
    """A batch whose commit got lost runs again: table, ledger and rejected rows stay as they were."""
    import shutil

    from pyspark.sql import types as T

    from rarecast.sources.published import PublishedTable
    from rarecast.sources.table import VERDICT
    from rarecast.streaming import streams as S
    for name, rows in (("good", [(1, 1), (2, 2)]), ("bad", [(3, 500), (4, 1)])):
        spark.createDataFrame(rows, "id int, v int").coalesce(1).write.parquet(str(tmp_path / "in" / name))
    schema = spark.read.parquet(str(tmp_path / "in" / "good")).schema
    target = T.StructType([*schema.fields, T.StructField("tag", T.StringType())])
    table = PublishedTable(spark, str(tmp_path / "table"), target, "tag")

    def run():
        S.ingest_stream(spark, str(tmp_path / "in" / "*"), table, str(tmp_path / "ckpt"), schema, "id", ["v"], F.lit("t"), F.col("v") > 100)
    run()
    shutil.rmtree(tmp_path / "ckpt" / "commits")
    run()
    rejected = T.StructType([*schema.fields, T.StructField("verdicts", T._parse_datatype_string(VERDICT))])
    assert sorted(r.id for r in table.rows().collect()) == [1, 2]
    assert sorted(r.status for r in table.side_rows("ledger", S.LEDGER).collect()) == ["completed", "error"]
    assert sorted(r.id for r in table.side_rows("rejected", rejected).collect()) == [3, 4]
