"""Batches published as one step, read by tag; cell verdicts; a crash between any two writes."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rarecast.sources import table as TB
from rarecast.sources.published import PublishedTable
from rarecast.streaming import streams as S

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.IntegerType()), T.StructField("tag", T.StringType())])
RAW = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.StringType())])


def stage(spark, folder, name, rows):
    spark.createDataFrame(rows, RAW).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def ingest(spark, staging, table, ckpt, **more):
    S.ingest_stream(spark, f"{staging}/*", table, ckpt, RAW, "id", ["v"], F.substring_index("id", "_", -1),
                    max_length={"id": 8}, **more)


@pytest.mark.parametrize("step", ["data", "rejected", "ledger", None])
def test_crash_between_writes_then_replay(spark, tmp_path, step):
    staging, done, err = (str(tmp_path / x) for x in ("staging", "completed", "error"))
    stage(spark, staging, "f1", [("a_t1", "1"), ("a_t1", "0"), ("b_t1", "2")])
    stage(spark, staging, "f2", [("c_t2", "3"), ("d_t2", "many")])
    stage(spark, staging, "f3", [("e_t3", "4"), ("much_too_long_t3", "5")])
    stage(spark, staging, "f4", [("f_t3", "4"), (None, "5")])
    stage(spark, staging, "f5", [("g_t3", "6")])
    table = PublishedTable(spark, str(tmp_path / "table"), SCHEMA, "tag")
    ckpt = str(tmp_path / "ckpt")
    if step:
        with pytest.raises(Exception, match="stopped after"):
            ingest(spark, staging, table, ckpt, fail_after=step)
        assert table.rows().count() == 0 and table.side_rows("ledger", S.LEDGER).count() == 0
    ingest(spark, staging, table, ckpt, moved_to=(done, err))
    ingest(spark, staging, table, ckpt, moved_to=(done, err))          # nothing new
    assert {tuple(r) for r in table.rows().collect()} == {("a_t1", 0, "t1"), ("b_t1", 2, "t1"), ("g_t3", 6, "t3")}
    assert table.rows().count() == 3
    ledger = {r.file.split("/")[-2]: (r.status, r.n_rows, r.n_bad_rows) for r in table.side_rows("ledger", S.LEDGER).collect()}
    assert ledger == {"f1": ("completed", 3, 0), "f2": ("error", 2, 1), "f3": ("error", 2, 1), "f4": ("error", 2, 1), "f5": ("completed", 1, 0)}
    kept = T.StructType([*RAW.fields, T.StructField("verdicts", T._parse_datatype_string(TB.VERDICT))])
    rejected = table.side_rows("rejected", kept).collect()
    assert len(rejected) == 6
    assert {(x["column"], x["rule"], x["value"]) for r in rejected for x in r.verdicts} == {
        ("v", "cast", "many"), ("id", "length", "much_too_long_t3"), ("id", "null_key", None)}
    places = {p.name: sorted(f.name for f in p.glob("*.parquet")) for p in (tmp_path / "completed", tmp_path / "error")}
    assert len(places["completed"]) == 2 and len(places["error"]) == 3
    assert not list((tmp_path / "staging").glob("*/*.parquet"))


def test_reads_and_appends_touch_only_their_tags(spark, tmp_path):
    table = PublishedTable(spark, str(tmp_path / "t"), SCHEMA, "tag")
    rows = spark.createDataFrame([(f"k{i}_t{i % 9}", i, f"t{i % 9}") for i in range(90)], SCHEMA)
    assert table.publish(0, rows, "id", ["v"]) and not table.publish(0, rows, "id", ["v"])
    few = spark.createDataFrame([("k3_t3", -1, "t3"), ("new_t3", 5, "t3"), ("new_t3", 4, "t3")], SCHEMA)
    plan = table.new_rows(few, "id", ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "tag" in plan.split("PartitionFilters")[1][:80] and "In(tag" in plan or "tag#" in plan
    table.publish(1, few, "id", ["v"])
    assert {tuple(r) for r in table.rows(["t3"]).where("v < 6").collect()} == {("k3_t3", 3, "t3"), ("new_t3", 4, "t3")}
    assert table.rows().count() == 91
    read = table.rows(["t3"])
    assert len(read.inputFiles()) >= 1
    scanned = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scanned and "PartitionFilters: []" not in scanned
    assert table.rows(["nothing"]).count() == 0 and table.rows([]).count() == 0
    table.publish(2, rows.limit(0), "id", ["v"])
    assert table.rows().count() == 91 and table.manifests().count() == 3


def test_verdicts_of_every_rule(spark):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("s", T.StringType()), T.StructField("d", T.DoubleType()),
                           T.StructField("absent", T.BooleanType())])
    df = spark.createDataFrame([("1", "short", "1.5", 9), ("x", "far too long", "n/a", 9), (None, None, None, 9)], "k string, s string, d string, more int")
    got = TB.with_verdicts(df, schema, "k", {"s": 5}, keep=["more"]).collect()
    assert [tuple(r)[:5] for r in got] == [(9, 1, "short", 1.5, None), (9, None, "far too long", None, None), (9, None, None, None, None)]
    assert [[tuple(v) for v in r.verdicts] for r in got] == [
        [], [("k", "cast", "x"), ("k", "null_key", "x"), ("s", "length", "far too long"), ("d", "cast", "n/a")], [("k", "null_key", None)]]


def test_table_order_is_the_declared_one():
    from rarecast import schemas
    names = schemas.POSTS_TABLE.names
    assert len(names) == 45 and names[29:32] == ["Comment_rate", "avg_up_rate", "std_up_rate"]
    assert names[35:40] == ["premium_auth_rate", "Silver_awarded", "Gold_awarded", "Platinum_awarded", "How_sorted"]
