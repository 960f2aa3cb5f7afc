"""Plan-shape checks on the physical plans of registered queries (from
``explain()``): the scale properties the README claims, kept as tests."""

import contextlib
import io
import re

import pytest

from tests.conftest import SF_SMALL

# These train models, drain streams or publish tables while the frame is built, and what they return reads the
# result: their plans say little.  (Other queries run small jobs first too - fitted tables, range bounds, label limits -
# and are inspected in the plan they return.)
EAGER = {"boosted_trees", "feature_pipeline", "grid_search_cv", "backward_selection", "feature_importance", "resampled_training",
         "tfidf_pca", "tfidf_pca_trace", "vector_pca_variance", "vector_pca_trace", "read_staged_incremental", "list_staged_files",
         "read_tag_partitions", "materialise_snapshot", "pipeline"}


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark, entry_mod):
    qs = entry_mod.queries()
    return {n: _plan(f(spark, SF_SMALL)) for n, f in qs.items()
            if n not in EAGER and not n.startswith("stream")}


def test_no_nested_loop_or_cartesian_join(plans):
    bad = {n for n, t in plans.items() if re.search(r"BroadcastNestedLoopJoin|CartesianProduct", t)}
    assert not bad


def test_single_partition_exchanges_take_aggregates_only(plans):
    """Every Exchange SinglePartition sits on a partial aggregate or on a
    parameter-sized table (thresholds, bins), never on raw rows."""
    for name, text in plans.items():
        lines = text.splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                below = "\n".join(lines[i + 1:i + 6])
                assert re.search(r"HashAggregate|ObjectHashAggregate|SortAggregate|Range \(0, \d+", below), \
                    (name, below)


def test_top_n_is_limited_before_the_shuffle(plans):
    # a partial WindowGroupLimit below the exchange, the final one above it
    assert plans["top_n_comments"].count("WindowGroupLimit") >= 2
    assert plans["comment_feature_report"].count("WindowGroupLimit") >= 2


def test_filters_reach_the_scan(plans):
    t = plans["outcome_after_delay"]
    assert "EqualTo(event_type,view)" in t and "EqualTo(event_type,purchase)" in t


def test_as_of_builds_no_pairs(plans):
    """The as-of join is windows plus equi-joins on (key, bucket, slice) and
    (key, instant): no join carries a range condition."""
    for line in plans["outcome_after_delay"].splitlines():
        if re.search(r"(SortMergeJoin|HashJoin) \[", line):
            tail = line.split("], ")[-1]          # after the two key lists
            assert not re.search(r"[<>]", tail), line


def test_split_and_undersampling_shuffle_no_rows(plans):
    """Rows are decided against one limit per label: a broadcast join, no window, no exchange by label."""
    for name in ("stratified_split", "undersample_majority"):
        assert "Window" not in plans[name] and "SortMergeJoin" not in plans[name], name


def test_grid_and_numbering_take_no_single_task(plans):
    assert "Generate" not in plans["complete_grid"] and "Range (0, " in plans["complete_grid"]
    assert "Range (0, " not in plans["prior_score"]


def test_text_weights_need_no_exchange_of_rows(plans):
    assert "hashpartitioning(doc_id" not in plans["tfidf"] and "Window" not in plans["tfidf"]


def test_running_sums_carry_no_bounds(plans):
    assert "array<double>" not in plans["pr_curve"] and "lambdafunction" not in plans["pr_curve"]
