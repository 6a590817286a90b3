"""Cases outside the load scenario."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import merge, snapshot, vault
from tidemark.operators.skew import salted_join


def test_null_keys_of_a_merge_are_inserted(spark):
    target = spark.createDataFrame([(1, "a")], "k long, x string")
    source = spark.createDataFrame([(1, "b"), (None, "c"), (None, "d")], "k long, x string")
    cols = {"k": F.col("s.k"), "x": F.col("s.x")}
    out = merge.merge(target, source, ["k"], {"x": F.col("s.x")}, cols).rows
    assert sorted(map(tuple, out.collect()), key=repr) == [(1, "b"), (None, "c"), (None, "d")]


def test_a_small_batch_leaves_the_target_where_it_is(spark):
    target = spark.range(2_000_000).selectExpr("id AS k", "id AS x")
    source = spark.range(10).selectExpr("id * 300000 AS k", "id AS x")
    cols = {"k": F.col("s.k"), "x": F.col("s.x")}
    out = merge.merge(target, source, ["k"], {"x": F.col("s.x")}, cols).rows
    assert out.count() == 2_000_003
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin FullOuter" not in plan and "BroadcastHashJoin" in plan


def test_a_value_that_comes_back_in_one_batch_is_stored(spark):
    day = lambda n: dt.datetime(2024, 1, n)
    schema = "hk string, load_ts timestamp, x string, hash_diff string, rec_src string"
    sat = spark.createDataFrame([("k", day(1), "A", "A", "s")], schema)
    staged = spark.createDataFrame([("k", day(2), "B", "B", "s"), ("k", day(3), "A", "A", "s")], schema)
    out = vault.load_sat(sat, staged.withColumnRenamed("hash_diff", "h"), "hk", "h", ["x"], compare="latest")
    assert [r.x for r in out.orderBy("load_ts").collect()] == ["B", "A"]


def test_the_last_version_may_be_empty(spark, tmp_path):
    snapshot.write_version(spark.range(3), str(tmp_path), 0)
    snapshot.write_version(spark.range(0), str(tmp_path), 1)
    assert snapshot.last_version(spark, str(tmp_path)) == 1


def test_null_keys_of_a_salted_join_are_spread(spark):
    left = spark.range(10_000).selectExpr("IF(id % 2 = 0, null, id) AS k", "id", "parse_json('{}') AS v")
    right = spark.range(100).selectExpr("id AS k", "id AS y")
    out = salted_join(left, right, ["k"], "left", hot_rows=100)
    assert out.count() == 10_000
