"""Summarise the physical plans of registered queries from ``explain()``.

python -m tests.plan_report [sf_dir] [name ...]

Per query: shuffles (hash / range / round-robin / single-partition), join
strategies, partial top-n limits, scans with pushed filters, and Python
evaluation nodes.  Plans are the initial AQE plans (before runtime re-plan)."""

from __future__ import annotations

import contextlib
import io
import re
import sys

HEADLINE = ["comment_feature_report", "top_n_comments", "outcome_after_delay", "route_valid_invalid",
            "append_first_wins", "category_profile", "chi_square_rate", "prior_score",
            "target_encode_smooth", "tfidf", "stratified_split", "pr_curve", "roc_auc", "threshold_sweep"]


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def summarise(text: str) -> dict:
    ex = re.findall(r"Exchange (\w+)", text)
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", text)
    return {
        "shuffles": {k: ex.count(k) for k in sorted(set(ex))},
        "joins": {k: joins.count(k) for k in sorted(set(joins))},
        "partial_topn": text.count("WindowGroupLimit") // 2,
        "scans": text.count("FileScan"),
        "scans_with_pushed_filters": len(re.findall(r"PushedFilters: \[[^\]]+\]", text)),
        "python_nodes": len(re.findall(r"ArrowEvalPython|FlatMapGroupsInPandas|BatchEvalPython", text)),
    }


def main(argv):
    sys.path.insert(0, ".")
    from rarecast.session import get_session
    import __spark_entry__ as E
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    names = argv[2:] or HEADLINE
    spark = get_session()
    qs = E.queries()
    for n in names:
        print(n, summarise(plan_text(qs[n](spark, sf))), flush=True)


if __name__ == "__main__":
    main(sys.argv)
