"""Lines are exchanged once where one order's rows are asked for twice."""

from __future__ import annotations

import datetime as dt
import os
import re
import time

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from rows_of_frames import rows

from tidemark.operators import balance, merge, skew
from tidemark.operators.numbering import number_within
from tidemark.plans import scenario
from tidemark.plans.scenario import Scenario
from tidemark.session import REMOVE_SHUFFLES, stage
from tidemark.sources.landing import entity_batch


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_a_second_load_needs_no_exchange(spark, folder):
    batch = Scenario(spark, folder).line_batch(with_deletions=True)
    assert "Exchange" not in plan(batch)


def test_numbering_beside_orders(spark):
    lines = [(k, i % 7, i) for k in (1, 2, None) for i in range(300)] + [(9, 1, 1), (10, 1, 1), (10, 1, 2)]
    lines = stage(spark.createDataFrame(lines, "k long, a int, b int"), "lines")
    tags = stage(spark.createDataFrame([(1, "x"), (1, "x"), (9, "y"), (11, "z"), (None, "n")], "k long, tag string"), "tags")
    number = lambda **kw: number_within(lines, ["k"], ["a", "b"], ["a"], "n", **kw)
    plain = number().join(tags.distinct(), "k", "left").select("k", "a", "b", "tag", "n")
    assert rows(number(beside=tags)) == rows(plain)
    assert rows(number(beside=tags, hot_rows=50)) == rows(plain)  # orders 1 and 2 in parts


def test_deletions_are_found_in_the_exchange_of_the_join(spark, monkeypatch):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in keys}
    stamp = lambda n: F.lit(dt.datetime(2020, 1, n))
    first = spark.range(400).select((F.col("id") % 3).alias("sales_order_id"), F.col("id").alias("line_number"))
    first = first.withColumns({"load_ts": stamp(1), "load_type": F.lit("initial")})
    second = first.filter("line_number % 4 > 0").withColumns({"load_ts": stamp(2), "load_type": F.lit("update")})
    landed = stage(first.unionByName(second), "landed")
    try:
        for key in keys:
            spark.conf.set(key, "-1")
        for hot_rows in (skew.HOT_ROWS, 40):
            monkeypatch.setattr(skew, "HOT_ROWS", hot_rows)
            lost = balance.detect_deletions(landed, balance.load_history(landed))
            assert not re.search(r"hashpartitioning\(sales_order_id#\d+L, line_number", plan(lost))
            assert sorted(r.line_number for r in lost.collect()) == list(range(0, 400, 4))
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_known_entities_by_a_column(spark):
    source = spark.createDataFrame([(1, 5, True), (2, 6, None), (None, 7, None)], "o long, q long, seen boolean")
    landed = spark.createDataFrame([(1,)], "o long")
    load = lambda df, **kw: rows(entity_batch(df, landed, "o", {"q": F.col("q") + 1}, F.lit("t"), **kw))
    assert load(source, known="seen") == load(source.drop("seen"))


def test_a_merged_batch_is_not_spread_before_it_is_written(spark, monkeypatch):
    first = spark.range(20).select((F.col("id") % 5).alias("sales_order_id"), F.col("id").alias("line_number"), F.lit(1).alias("qty"))
    first = first.withColumns({"load_ts": F.lit(dt.datetime(2020, 1, 1)), "load_type": F.lit("initial")})
    second = first.withColumns({"load_ts": F.lit(dt.datetime(2020, 1, 2)), "load_type": F.lit("update"), "qty": F.lit(3)})
    plans = []

    def spy(df, label):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return stage(df, label)

    monkeypatch.setattr(merge, "stage", spy)
    fact = balance.rb_initial(stage(first, "first"))
    merged = balance.rb_merge(fact, stage(first.unionByName(second), "landed"), ["sales_order_id", "line_number"], ["qty"])
    assert plans and "RepartitionByExpression" not in plans[0]
    assert rows(merged.rows.groupBy("qty", "as_at_dts").count()) == rows(
        spark.createDataFrame([(3, dt.datetime(2020, 1, 2), 20)], "qty int, as_at_dts timestamp, n long")
    )


def test_loads_are_not_written_beside_the_lines(spark, folder, monkeypatch):
    monkeypatch.setattr(scenario, "_STAGED", {})
    landed = Scenario(spark, folder).src_line_item()
    assert landed.columns == Scenario(spark, folder).lines_initial().columns
    assert [name for *_, name in scenario._STAGED] == ["line_item"]
    assert "Exchange" not in plan(landed)


def shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for top in dirs for _, _, files in os.walk(str(top)) for f in files if f.startswith("shuffle_")}


def test_a_written_table_leaves_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(REMOVE_SHUFFLES, None)
    written = stage(spark.range(1000).repartition(3, "id").groupBy(F.col("id") % 7).count(), "counts")
    for _ in range(50):  # they are removed in the background
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(REMOVE_SHUFFLES, None) == setting
    assert written.count() == 7


def test_reversals_move_the_batch_once_and_by_its_keys(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in keys}
    first = spark.range(40).select((F.col("id") % 5).alias("o"), F.col("id").alias("line"), F.lit(1).alias("qty"), F.lit("x").alias("note"))
    target, source = stage(first, "first"), first.filter("line > 9").withColumns({"qty": F.lit(3), "at": F.lit(7)})
    try:
        for key in keys:
            spark.conf.set(key, "-1")
        merged = merge.merge(target, source, ["o", "line"], update={"qty": F.col("s.at")})
        taken = merged.updates.select("before.*", F.col("after.qty").alias("now"))
        ran = plan(taken)
        assert len(re.findall(r"(?m)^\W*Exchange hashpartitioning", ran)) == 2
        read = [re.search(r"ReadSchema: struct<([^>]*)", line)[1] for line in ran.splitlines() if "merge-batch" in line]
        assert read == ["o:bigint,line:bigint,at:int"]
        assert rows(taken) == sorted([(i % 5, i, 1, "x", 7) for i in range(10, 40)], key=repr)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_updates_of_a_merge_with_nulls_and_repeated_keys(spark):
    target = spark.createDataFrame([(1, 1), (1, 2), (None, 3), (2, None), (3, 3)], "k long, v long")
    source = spark.createDataFrame([(1, 5), (None, 6), (None, 7), (2, 8), (9, 9)], "k long, v long")
    load = lambda src, **kw: merge.merge(target, src, ["k"], update={"v": F.col("s.v")}, **kw).updates.select("before.*", F.col("after.v").alias("w"))
    assert rows(load(source)) == sorted([(1, 1, 5), (1, 2, 5), (2, None, 8)], key=repr)
    assert rows(load(source, when=F.col("t.v") != F.col("s.v"))) == [(1, 1, 5), (1, 2, 5)]
    with pytest.raises(PySparkException, match="more than one source row for key 9"):
        load(source.union(source.filter("k = 9"))).collect()
