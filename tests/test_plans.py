"""What loads read and move: rows through exchanges, counted from the plans that ran."""

import datetime as dt

from pyspark.sql import functions as F
from rows_of_frames import rows

from tidemark.operators import balance
from tidemark.session import stage

KEYS = ["sales_order_id", "line_number"]


def nodes(plan):
    """All operators of a plan that ran, those inside its stages too."""
    out, todo = [], [plan]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            out.append(node)
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return out


def metric(df, kind, name):
    """Sum of a metric over the operators of a class, after the frame has run."""
    df.collect()
    found = 0
    for node in nodes(df._jdf.queryExecution().executedPlan()):
        if kind in node.getClass().getSimpleName():
            value = node.metrics().get(name)
            found += value.get().value() if value.isDefined() else 0
    return found


def moved(df):
    return metric(df, "ShuffleExchange", "shuffleRecordsWritten")


def stamp(n):
    return F.lit(dt.datetime(2024, 1, n)).cast("timestamp_ntz")


def lines(spark, orders, n, kind, qty):
    frame = spark.range(orders).select(
        F.floor(F.col("id") / 4).alias("sales_order_id"), F.pmod("id", F.lit(4)).alias("line_number"),
        F.lit(qty).cast("long").alias("qty"), stamp(n).alias("load_ts"), F.lit(kind).alias("load_type"),
    )
    return frame


def test_a_small_batch_moves_no_other_order(spark):
    """200,000 orders in the fact, ten in the batch: only lines of the ten pass an exchange."""
    first = lines(spark, 800_000, 1, "initial", 5)
    batch = lines(spark, 40, 2, "update", 7)
    landed = stage(first.unionByName(batch), "landed", "load_ts")
    fact = stage(balance.rb_initial(first), "fact", balance.FACT_PARTITIONS)
    found = balance.newest_as_at(fact, landed.filter("load_type = 'update'"))
    assert moved(found) <= 10 * 8 and found.count() == 10
    added = balance.rb_new_rows(fact, landed, KEYS, ["qty"], ["qty"])
    # the batch itself, its keys counted for hot ones, the current images of its orders
    assert moved(added) <= 40 * 6
    assert rows(added.groupBy("is_after_image").agg(F.sum("qty"), F.count("*"))) == [(False, -200, 40), (True, 280, 40)]


def test_old_images_are_not_read(spark):
    """Only the as-ats that the batch needs are scanned, and no before-images."""
    first = lines(spark, 40_000, 1, "initial", 5)
    landed, fact = first, balance.rb_initial(first)
    for n in (2, 3, 4):
        landed = landed.unionByName(lines(spark, 400, n, "update", n))
        fact = stage(balance.reverse_balance(fact, landed, KEYS, ["qty"], ["qty"]), "fact", balance.FACT_PARTITIONS)
    as_at = stage(balance.newest_as_at(fact, lines(spark, 400, 5, "update", 9)), "as-at")
    images = balance.current_images(fact, as_at)
    assert images.count() == 400 and rows(images.select("qty").distinct()) == [(4,)]
    assert metric(images, "FileSourceScan", "numOutputRows") <= 400 + as_at.count() * 2


def test_deletions_of_many_loads_are_linear(spark):
    """30 loads of one order each day: the rows that are sorted are the landed lines, not lines times loads."""
    landed = lines(spark, 400, 1, "initial", 1)
    for n in range(2, 31):
        landed = landed.unionByName(lines(spark, 400, n, "update", n).filter(F.col("line_number") != n % 4))
    landed = stage(landed, "landed")
    lost = balance.detect_deletions(landed, balance.load_history(landed, full=True), reuse=True)
    assert metric(lost, "WindowExec", "numOutputRows") <= landed.count()
    assert moved(lost) < 3 * landed.count()
    expected = sum(100 for n in range(2, 31) for line in range(4) if line == n % 4 and (n == 2 or (n - 1) % 4 != line))
    assert lost.count() == expected
