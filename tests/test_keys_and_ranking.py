"""Numbering, key checks, lookups, ranking and ordering on small inputs."""

import random
from decimal import Decimal

import pytest
from rows_of_frames import rows
from pyspark.sql import functions as F

from tidemark.functions.computed import update_where, with_computed, with_defaults
from tidemark.functions.hashing import diff_hash, vault_hash
from tidemark.functions.ordering import order_by
from tidemark.operators.keys import check_schema, fk_report, fk_violations, key_violations
from tidemark.operators.lookup import lookup_join, point_lookup
from tidemark.operators.numbering import assign_keys, number_within
from tidemark.operators.ranking import top_by_dense_rank
from tidemark.sources.contracts import Field, Reference, Table
from tidemark.sources.landing import entity_batch, latest_load, sample_rows, whole_entities


@pytest.mark.parametrize("hot_rows", [1, 50, 10_000])
def test_numbering_is_the_same_for_hot_and_other_keys(spark, hot_rows):
    random.seed(3)
    data = [(0, n, n * 7 % 100) for n in random.sample(range(1000), 300)]
    data += [(k, n, n) for k in range(1, 60) for n in range(k % 4 + 1)]
    df = spark.createDataFrame(data, "k long, a long, b long").repartition(4)
    numbered = number_within(df, ["k"], ["a", "b"], [F.shiftright("a", 6)], "n", hot_rows=hot_rows)
    expected = []
    for k in {d[0] for d in data}:
        group = sorted(d for d in data if d[0] == k)
        expected += [(*d, i) for i, d in enumerate(group, start=1)]
    assert rows(numbered, "k", "a", "b", "n") == sorted(expected, key=repr)


def test_assigned_keys_are_dense_ordered_and_continue(spark):
    names = [f"name-{n:04d}" for n in range(500)]
    df = spark.createDataFrame([(n,) for n in random.sample(names, 500)], "name string").repartition(7)
    keyed = {r["name"]: r["sk"] for r in assign_keys(df, "sk", ["name"], 40).collect()}
    assert [keyed[n] for n in names] == list(range(41, 541))


def test_assigned_keys_of_nothing(spark):
    assert assign_keys(spark.createDataFrame([], "name string"), "sk", ["name"]).collect() == []


def test_key_checks(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id long")
    child = spark.createDataFrame([(10, 1), (11, 1), (12, 3), (13, None), (13, 2)], "c long, id long")
    assert rows(key_violations(child, ["c"])) == [(13, 2)]
    assert rows(fk_violations(child, parent, ["id"], ["id"])) == [(12, 3)]
    contracts = {
        "parent": Table("parent", "", (Field("id", "bigint", ""),), ("id",)),
        "child": Table("child", "", (), ("c",), references=(Reference("child_of", ("id",), "parent", ("id",)),)),
    }
    report = fk_report({"parent": parent, "child": child}, contracts, "child", "imported")
    assert rows(report, "matched_rows", "orphan_rows", "null_rows") == [(3, 1, 1)]
    exported = fk_report({"parent": parent, "child": child}, contracts, "parent", "exported")
    assert rows(exported) == rows(report)
    with pytest.raises(ValueError):
        fk_report({}, contracts, "parent", "imported")


def test_schema_check_counts_each_rule(spark):
    contract = Table("t", "", (Field("a", "string", "", max_length=2), Field("b", "bigint", "", nullable=True)), ("a",))
    df = spark.createDataFrame([("xyz", None), (None, 1), ("ab", 2), ("long", 3)], "a string, b long")
    assert rows(check_schema(df, contract), "column_name", "rule", "violations") == [
        ("a", "length <= 2", 2),
        ("a", "not null", 1),
    ]


def test_declared_schema_keeps_nullability_and_comments():
    contract = Table("t", "", (Field("a", "decimal(12,2)", "", nullable=True, comment="money"),), ("a",))
    field = contract.schema()["a"]
    assert field.nullable and field.metadata == {"comment": "money"} and field.dataType.simpleString() == "decimal(12,2)"


def test_lookup_left_out_equals_the_real_join(spark):
    dim = spark.createDataFrame([(1, "x"), (2, "y")], "d long, name string")
    fact = spark.createDataFrame([(1, 1), (2, 1), (3, 2), (4, None)], "id long, d long")
    real = lookup_join(fact, dim, "d", {})
    pruned = lookup_join(fact, dim, "d", {}, rely=True)
    assert rows(real) == rows(pruned)
    assert "Join" in real._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in pruned._jdf.queryExecution().executedPlan().toString()


def test_point_lookup_casts_text_to_the_key_type(spark, folder):
    from tidemark.sources.tables import model

    found = point_lookup(model(spark, folder, "customer"), "customer_id", "42")
    assert [r["customer_id"] for r in found.collect()] == [42]
    assert "PushedFilters: [IsNotNull(c_custkey), EqualTo(c_custkey,42)]" in found._jdf.queryExecution().executedPlan().toString()


def test_ties_keep_all_rows(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([9, 9, 9, 8, 7, 7, 6, None])], "id long, v long")
    top = top_by_dense_rank(df, "v", 3, [(1, "first"), (3, "rest")])
    assert rows(top) == [
        (0, 9, 1, "first"),
        (1, 9, 1, "first"),
        (2, 9, 1, "first"),
        (3, 8, 2, "rest"),
        (4, 7, 3, "rest"),
        (5, 7, 3, "rest"),
    ]


def test_null_order(spark):
    texts = ["1", None, "2", None, "3", "0.01", "A", "a", "$"]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    high = [r["c"] for r in order_by(df, "-c").collect()]
    assert high == [None, None, "a", "A", "3", "2", "1", "0.01", "$"]
    numbers = spark.createDataFrame([(1.0,), (None,), (2.0,), (0.01,)], "c double")
    assert [r["c"] for r in order_by(numbers, "-c", nulls="last").collect()] == [2.0, 1.0, 0.01, None]
    assert [r["c"] for r in order_by(numbers, "c", nulls="first").collect()] == [None, 0.01, 1.0, 2.0]
    assert [r["c"] for r in order_by(numbers, "c").collect()] == [0.01, 1.0, 2.0, None]


def test_defaults_fill_only_what_is_not_given(spark):
    given = spark.createDataFrame([(1, None)], "id long, stamp string")
    absent = spark.createDataFrame([(2,)], "id long")
    default = {"stamp": F.lit("now")}
    both = with_defaults(given, default).unionByName(with_defaults(absent, default))
    assert rows(both) == [(1, None), (2, "now")]
    assert rows(with_computed(both, {"x": F.concat(F.lit("x"), F.col("id"))}), "x") == [("x1",), ("x2",)]


def test_update_keeps_types_and_rows_whose_condition_is_null(spark):
    df = spark.createDataFrame([(1, Decimal("1.00")), (None, Decimal("2.00"))], "id long, v decimal(12,2)")
    updated = update_where(df, {"v": F.col("v") * 3}, F.col("id") == 1)
    assert rows(updated) == [(1, Decimal("3.00")), (None, Decimal("2.00"))]
    assert updated.schema["v"].dataType.simpleString() == "decimal(12,2)"


def test_hash_forms(spark):
    df = spark.createDataFrame([("1", "23"), ("12", "3"), (None, "3"), (" a ", "b")], "a string, b string")
    plain = [r[0] for r in df.select(diff_hash(["a", "b"])).collect()]
    assert plain[0] == plain[1] and plain[2] is None
    vault = [r[0] for r in df.select(vault_hash("a", "b")).collect()]
    assert len(set(map(bytes, vault))) == 4 and all(len(v) == 20 for v in vault)
    same = spark.createDataFrame([("A", "B ")], "a string, b string").select(vault_hash("a", "b")).first()[0]
    assert same == vault[3]


def test_samples_repeat_and_entities_stay_whole(spark):
    df = spark.createDataFrame([(o, n) for o in range(30) for n in range(o % 3 + 1)], "o long, n long")
    picked = sample_rows(df.withColumn("k", F.concat_ws("-", "o", "n")), 5, "k", seed=2)
    again = sample_rows(df.repartition(5).withColumn("k", F.concat_ws("-", "o", "n")), 5, "k", seed=2)
    assert rows(picked) == rows(again) and picked.count() == 5
    orders = {r["o"] for r in picked.collect()}
    assert rows(whole_entities(df, "o", picked)) == sorted(((o, n) for o in orders for n in range(o % 3 + 1)), key=repr)


def test_batches_tag_new_and_known_entities(spark):
    src = spark.createDataFrame([(1, 1, 10), (1, 2, 10), (2, 1, 10)], "o long, n long, v long")
    landed = spark.createDataFrame([(1, 1), (1, 2)], "o long, n long")
    batch = entity_batch(src, landed, "o", {"v": F.col("v") + 5}, F.lit("t2"), keep=F.col("n") > 1)
    assert rows(batch) == [(1, 2, 15, "t2", "update"), (2, 1, 10, "t2", "initial")]
    both = landed.withColumn("load_ts", F.lit("t1")).unionByName(batch.select("o", "n", "load_ts"))
    assert rows(latest_load(both)) == [(1, 2, "t2"), (2, 1, "t2")]
