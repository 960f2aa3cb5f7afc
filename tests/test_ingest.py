"""Raw API-shaped records through the readers into the declared table."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from rarecast import schemas
from rarecast.operators import comments as C
from rarecast.operators import outcome as O
from rarecast.sources import posts as P
from rarecast.sources import snapshot as SN


def test_read_comment_listings(spark, tmp_path):
    resp = [{"data": {"children": [{"kind": "t3", "data": {"id": "abc123"}}]}},
            {"data": {"children": [
                {"kind": "t1", "data": {"created_utc": 1600000000.0, "ups": 5, "gilded": 1,
                                        "distinguished": "moderator", "is_submitter": True}},
                {"kind": "t1", "data": {"created_utc": 1600000100.0, "ups": 2}},
                {"kind": "more", "data": {}}]}}]
    f = tmp_path / "c.json"
    f.write_text(json.dumps(resp) + "\n")
    df = P.read_comment_listings(spark, str(f), schemas.RAW_COMMENT)
    rows = df.collect()
    assert [r["post_id"] for r in rows] == ["abc123"] * 3
    c = C.comment_defaults(df).withColumn("created", F.timestamp_seconds("created_utc"))
    assert c.where("created IS NOT NULL").count() == 2    # the "more" child has no time (Q31)
    f = C.comment_features(c, "post_id", "created", F.lit(dt.datetime(2020, 9, 14)), 15).first()
    assert f["n_comments"] == 2 and f["distinguished_rate"] == pytest.approx(0.5)


def test_posts_table_rows(spark, tmp_path):
    post = {"title": "hello", "author": {"name": "ann"}, "id": "abc123", "gilded": 0,
            "gildings": {"gid_1": 1}, "ups": 120, "upvote_ratio": 0.9, "created_utc": 1612366200.0,
            "view_count": None, "discussion_type": None, "distinguished": None, "contest_mode": False,
            "content_categories": None, "edited": "False", "hidden": False, "is_crosspostable": True,
            "num_crossposts": 0, "is_meta": False, "is_original_content": False,
            "is_reddit_media_domain": True, "is_robot_indexable": True, "is_self": False, "is_video": False,
            "likes": None, "num_comments": 12, "over_18": False, "subreddit": {"display_name": "pics"}}
    f = tmp_path / "posts.json"
    f.write_text(json.dumps(post) + "\n")
    raw = P.read_posts(spark, str(f), schemas.RAW_POST, fmt="json") \
        .withColumn("file", F.lit("staging/gilded_data_sortedby_new_02-03_at_1530utc.pkl"))
    feats = spark.createDataFrame([("abc123", 0.5, 0.1, 0.0, 0.0, 0.5, 0.0)],
                                  "post_id string, avg_up_rate double, var_up_rate double, gild_rate double, "
                                  "distinguished_rate double, op_comment_rate double, premium_auth_rate double")
    out_raw = spark.createDataFrame([("abc123", {"gid_2": 1}, 400, 30)],
                                    "post_id string, g map<string,int>, u int, c int")
    outcome = O.outcome_fields(out_raw, "g", "u", "c")
    scrape = SN.scrape_time_of("file", 2021)
    rows = SN.posts_table_rows(raw, "file", scrape, feats, outcome).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r["ID"] == "abc123_new02031530" and r["How_sorted"] == "new" and r["Subreddit"] == "pics"
    assert r["Post_time"] == 15 * 60 + 30 and r["Post_age"] == pytest.approx(0.0)
    assert r["Initial_silver"] == 1 and r["Gold_awarded"] == 1 and r["Final_upvotes"] == 400
    assert r["Content_categories"] == "None" and r["Likes"] == 0 and r["Edited"] is False
    assert r["std_up_rate"] == pytest.approx(0.1)
    assert [f.name for f in spark.createDataFrame(rows, schemas.POSTS_TABLE).schema.fields] == \
        [f.name for f in schemas.POSTS_TABLE.fields]


def test_files_are_rejected_from_one_run_of_the_rules(spark, tmp_path):
    """The plan that counts rows, failing files and cells reads what the rules gave; it holds none of the 45 cells."""
    from rarecast.plans.q_sources import reject_by_schema
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key, None)
    spark.range(60).selectExpr("id as event_id", "'view' as event_type").write.parquet(str(tmp_path / "events.parquet"))
    out = reject_by_schema(spark, str(tmp_path))
    assert "Title" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert spark.conf.get(key, None) == before
    rows = {r.file: r for r in out.collect()}
    assert set(rows) == {0, 1, 2} and all(r.n_rows == 20 and r.n_bad_cells >= r.n_bad_rows for r in rows.values())
    assert rows[0].status == "error" and rows[0].n_bad_rows >= 1              # event 0 has no key
