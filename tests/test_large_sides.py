"""Tables whose files are small and whose rows are many: they are sorted, not broadcast."""

from __future__ import annotations

from pyspark.sql import functions as F
from rows_of_frames import rows

from tidemark import session
from tidemark.operators import hierarchy, merge, shred, skew
from tidemark.plans import scenario
from tidemark.session import few_rows, stage


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def members(spark, n):
    name = F.concat(F.lit("Party#"), F.lpad(F.col("id").cast("string"), 9, "0"))
    return stage(spark.range(n).select(F.col("id").alias("party_id"), name.alias("name"), F.lit("x").alias("load_name")), "members")


def test_a_dimension_of_many_rows_is_not_broadcast(spark):
    n = session.BROADCAST_ROWS * 2
    dim = members(spark, n)
    batch = stage(dim.select(F.col("name").alias("party_name"), F.lit(2000).alias("year")), "batch")
    found = shred.resolve(batch, dim, "party_name", "name", "party_id", "party_id")
    assert "BroadcastHashJoin" not in plan(found) and found.count() == n
    few = shred.resolve(batch.limit(5), dim, "party_name", "name", "party_id", "party_id")
    assert "SortMergeJoin" not in plan(few) and few.count() == 5


def test_many_known_keys_are_not_broadcast(spark):
    n = session.BROADCAST_ROWS * 2
    target = members(spark, n)
    batch = stage(members(spark, n + 3).unionByName(target.limit(1).withColumn("name", F.lit(None).cast("string"))), "batch")
    fresh = merge.absent(target, batch, ["name"], written=True)
    assert "BroadcastHashJoin" not in plan(fresh)
    assert sorted(r.name or "" for r in fresh.collect()) == ["", *[f"Party#{i:09d}" for i in range(n, n + 3)]]


def test_reading_back_many_members(spark):
    n = session.BROADCAST_ROWS + 10
    carrier = stage(spark.range(n).selectExpr("id AS carrier_id", "'T' AS type"), "carrier")
    rollup = stage(spark.range(n).selectExpr("id AS party_id", "id AS carrier_id", "concat('P', id) AS name", "string(null) AS nickname"), "rollup")
    bridge = stage(spark.range(n - 1).selectExpr("id AS party_id", "id % 2 AS service_id"), "bridge")
    dim = stage(spark.range(2).selectExpr("id AS service_id", "concat('S', id) AS name"), "dim")
    found = shred.shredded_star(rollup, carrier, bridge, dim, "party_id", "carrier_id", "service_id")
    assert plan(found).split("Initial Plan")[0].count("BroadcastHashJoin") == 1  # the two services
    assert rows(found.groupBy("linked_name").count()) == [("None", 1), ("S0", (n - 1) - (n - 1) // 2), ("S1", (n - 1) // 2)]


def test_many_pieces_are_salted(spark, monkeypatch):
    """A region of 400 customers, each with an order: in the last round all orders wait for one row."""
    tree = [("W", None), ("R", "W"), *[(f"C{i}", "R") for i in range(400)], *[(f"O{i}", f"C{i}") for i in range(400)]]
    nodes = stage(spark.createDataFrame([*tree, ("O0", "C1"), ("X", "Y"), ("Z", None)], "id string, up string"), "tree")
    walk = lambda: rows(hierarchy.connect_by(nodes, "id", "up", F.col("id") == "W", "id"))
    plain, calls = walk(), []

    def spy(*args, **kwargs):
        calls.append(kwargs["large"])
        return skew.salted_join(*args, **kwargs)

    monkeypatch.setattr(session, "BROADCAST_ROWS", 10)
    monkeypatch.setattr(hierarchy, "WAITING_ROWS", 50)
    monkeypatch.setattr(hierarchy, "salted_join", spy)
    assert walk() == plain and len(plain) == 803 and calls and all(calls)


def test_a_first_load_does_not_broadcast_its_keys(spark):
    """Nothing or little is known yet, and all of a large batch is new."""
    n = session.BROADCAST_ROWS * 2
    batch = members(spark, n)
    for held in (batch.limit(3), spark.createDataFrame([], batch.schema)):
        fresh = merge.absent(held, batch, ["name"], written=True)
        found = plan(fresh)
        assert "LeftSemi" not in found and "SortMergeJoin" not in found
        assert fresh.count() == n - held.count()


def test_rows_are_not_broadcast_beside_few_keys(spark):
    n = session.BROADCAST_ROWS * 2
    heads = members(spark, n).withColumn("carrier_name", F.concat(F.lit("C"), F.col("party_id") % 7))
    dim = stage(spark.range(7).selectExpr("id AS carrier_id", "concat('C', id) AS name"), "dim")
    found = shred.resolve(heads, dim, "carrier_name", "name", "carrier_id", "carrier_id")
    assert "BuildRight" in plan(found) and "BuildLeft" not in plan(found) and found.count() == n


def test_a_table_is_counted_once(spark, monkeypatch):
    table, calls = members(spark, 5), []
    count = type(table).count
    monkeypatch.setattr(type(table), "count", lambda df: calls.append(df) or count(df))
    assert few_rows(table) and few_rows(table) and len(calls) == 1
    monkeypatch.setattr(session, "BROADCAST_ROWS", 4)
    assert not few_rows(table) and len(calls) == 1


def test_members_of_a_rollup_are_worked_out_once(spark):
    """Later steps read the new parents and children several times; they are scans by then."""
    target = spark.createDataFrame([], "sk long, up long, name string")
    parents = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "name string")
    children = spark.createDataFrame([("c", "a"), ("d", "b"), ("e", "x"), ("f", None), (None, "a")], "name string, owner string")
    first = shred.shred_rollup(target, parents, children, "name", "owner", "sk", "up")
    assert "Join" not in plan(first) and "Window" not in plan(first)
    assert rows(first) == sorted([(1, None, "a"), (2, None, "b"), (3, 1, "c"), (4, 2, "d")], key=repr)
    both = target.unionByName(first)
    again = shred.shred_rollup(both, parents, children.union(spark.createDataFrame([("g", "b")], children.schema)), "name", "owner", "sk", "up")
    assert "Join" not in plan(again) and rows(again) == [(5, 2, "g")]


def test_many_rows_meet_many_known_keys_in_one_join(spark):
    n = session.BROADCAST_ROWS + 5
    fresh = merge.absent(members(spark, n), members(spark, n + 2), ["name"], written=True)
    assert plan(fresh).split("Initial Plan")[0].count("SortMergeJoin") == 1 and fresh.count() == 2


def test_jobs_of_shredding(spark, folder, monkeypatch):
    """What the driver holds follows from the jobs and exchanges of the two loads: 254 jobs here before."""
    monkeypatch.setattr(session, "BROADCAST_ROWS", 20)
    monkeypatch.setattr(scenario, "_STAGED", {})
    spark.sparkContext.setJobGroup("shredding", "two loads")
    scenario.Scenario(spark, folder).shredded()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("shredding")) < 200


def test_a_large_load_counts_only_what_it_must(spark, folder, monkeypatch):
    """Documents and dimensions are counted, the members once a load; rows and years made of many documents are not."""
    frame, asked = type(spark.range(0)), []
    count = frame.count
    monkeypatch.setattr(session, "BROADCAST_ROWS", 20)
    monkeypatch.setattr(scenario, "_STAGED", {})
    monkeypatch.setattr(frame, "count", lambda df: asked.append(df.columns) or count(df))
    scenario.Scenario(spark, folder).shredded()
    monkeypatch.undo()
    made = [{"party_name"}, {"owner_name"}, {"party_id", "year"}, {"party_id", "service_id"}]
    assert asked and not [c for c in asked if any(m <= set(c) for m in made)]
    assert sum("part_of" in c for c in asked) == 2
