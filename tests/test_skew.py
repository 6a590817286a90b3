"""One key with a third of all rows: the plan splits it and the result is whole."""

import datetime as dt
import re

import pytest
from rows_of_frames import rows
from pyspark.sql import functions as F

from tidemark.operators import balance, ranking, skew
from tidemark.operators.lookup import lookup_join
from tidemark.operators.numbering import number_within
from tidemark.session import stage
from tidemark.sources.landing import entity_batch

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2.0",
    "spark.sql.shuffle.partitions": "16",
}
KEYS = ["sales_order_id", "line_number"]
HOT, OTHERS = 20_000, 40_000


@pytest.fixture()
def small_partitions(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture()
def lines(small_partitions):
    """Order 0 has a third of the lines; the others have four each."""
    spark = small_partitions
    hot = spark.range(HOT).select(F.lit(0).cast("long").alias("sales_order_id"), F.col("id").alias("line_number"))
    rest = spark.range(OTHERS).select(
        (F.floor(F.col("id") / 4) + 1).alias("sales_order_id"), F.pmod("id", F.lit(4)).alias("line_number")
    )
    both = hot.unionByName(rest).withColumns({"qty": F.lit(1).cast("long"), "note": F.md5(F.col("line_number").cast("string"))})
    return stage(both.repartition(8, "line_number"), "skew")


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.fixture()
def hot_from_1000(monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 1000)


SALTED = re.compile(r"SortMergeJoin(\(skew=true\))? \[sales_order_id#\d+L, _salt#\d+L\]")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_the_plain_one(small_partitions, lines, how):
    few = stage(lines.filter("sales_order_id % 3 = 0").select("sales_order_id").distinct(), "skew")
    few = few if how in ("left_semi", "left_anti") else few.withColumn("tag", F.lit("x"))
    salted = skew.salted_join(lines, few, ["sales_order_id"], how, hot_rows=1000)
    plain = lines.join(few, "sales_order_id", how)
    summed = lambda df: df.groupBy("sales_order_id").agg(F.count("*"), F.sum("line_number"), F.max("note"))
    assert rows(summed(salted)) == rows(summed(plain))


@pytest.fixture()
def without_adaptive(small_partitions):
    small_partitions.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    small_partitions.conf.set("spark.sql.adaptive.enabled", "true")


def per_task(df):
    """Rows of the fullest task."""
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def test_salted_join_spreads_a_hot_key(without_adaptive, lines):
    few = lines.select("sales_order_id").distinct().withColumn("tag", F.lit("x"))
    assert per_task(lines.join(few, "sales_order_id")) > HOT
    assert per_task(skew.salted_join(lines, few, ["sales_order_id"], hot_rows=1000)) < HOT / 2


def test_reverse_balance(lines, hot_from_1000):
    stamp = lambda n: F.lit(dt.datetime(2020, 1, n))
    first = lines.withColumns({"load_ts": stamp(1), "load_type": F.lit("initial")})
    second = lines.withColumns({"load_ts": stamp(2), "load_type": F.lit("update"), "qty": F.lit(3).cast("long")})
    fact = balance.rb_initial(stage(first, "skew"))
    landed = stage(first.unionByName(second), "skew")
    added = balance.rb_new_rows(fact, landed, KEYS, ["qty"], ["qty"])
    plan = final_plan(added)
    assert SALTED.search(plan) and "REPARTITION_BY_COL" in plan
    assert added.count() == 2 * (HOT + OTHERS)
    assert added.filter("sales_order_id = 0").agg(F.sum("qty")).first()[0] == 2 * HOT


def test_lookup_is_split_by_adaptive_execution(small_partitions, lines):
    orders = stage(lines.select("sales_order_id").distinct().withColumn("name", F.lit("x")), "skew")
    joined = lookup_join(lines, orders, "sales_order_id", {"name": "order_name"})
    assert "SortMergeJoin(skew=true)" in final_plan(joined)
    assert joined.count() == HOT + OTHERS


def test_batches_of_a_hot_order(lines, hot_from_1000):
    batch = entity_batch(lines, lines, "sales_order_id", {"qty": F.col("qty") + 1}, F.lit(dt.datetime(2020, 1, 2)))
    assert SALTED.search(final_plan(batch))
    assert rows(batch.groupBy("load_type").agg(F.sum("qty"))) == [("update", 2 * (HOT + OTHERS))]


def test_deletions_of_a_hot_order(lines, hot_from_1000):
    stamp = lambda n: F.lit(dt.datetime(2020, 1, n))
    first = lines.withColumns({"load_ts": stamp(1), "load_type": F.lit("initial")})
    second = lines.filter("line_number = 0").withColumns({"load_ts": stamp(2), "load_type": F.lit("update")})
    landed = stage(first.unionByName(second), "skew")
    lost = balance.detect_deletions(landed, balance.load_history(landed))
    assert SALTED.search(final_plan(lost))
    assert lost.filter("sales_order_id = 0").count() == HOT - 1


def test_numbering_spreads_a_hot_order(without_adaptive, lines):
    numbered = number_within(
        lines, ["sales_order_id"], ["line_number"], [F.shiftright("line_number", 10)], "n", hot_rows=1000
    )
    assert numbered.filter(F.col("n") != F.col("line_number") + 1).count() == 0
    assert per_task(numbered.filter("n > 0")) < HOT / 2  # the filter keeps the numbering in the plan


def test_totals_meet_customers_as_sums(small_partitions, lines):
    orders = lines.select(F.col("sales_order_id").alias("customer_id"), F.lit(1).cast("decimal(12,2)").alias("total_price_usd"))
    customers = orders.select("customer_id").distinct().select(
        "customer_id", F.lit(1).alias("account_balance_usd"), F.lit(1).alias("location_id")
    )
    totals = ranking.customer_totals(customers, orders)
    plan = final_plan(totals)
    assert plan.index("Join") < plan.index("partial_sum")
    assert totals.filter("customer_id = 0").first()["total_price_usd"] == HOT
