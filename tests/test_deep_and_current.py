"""Deep trees and documents, current views, incremental rankings, rules on stored values, tokens, several targets of a batch."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from rows_of_frames import rows

from tidemark.functions.strings import strtok, strtok_to_array
from tidemark.operators import documents, hierarchy, keys, ranking, shred, vault
from tidemark.session import new_folder
from tidemark.sources.contracts import CUSTOMER, MODEL
from tidemark.streaming import feeds


def rounds_of(monkeypatch):
    """The folders that a walk writes, one per round."""
    seen = []
    real = hierarchy.new_folder
    monkeypatch.setattr(hierarchy, "new_folder", lambda spark, label: seen.append(real(spark, label)) or seen[-1])
    return seen


def test_a_chain_of_1500_nodes_takes_few_rounds(spark, monkeypatch, tmp_path):
    folders = rounds_of(monkeypatch)
    chain = spark.range(1500).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("up"), F.col("id").cast("string").alias("label"))
    loops = spark.createDataFrame([(9000, 9001, "x"), (9001, 9000, "y"), (9002, 9001, "z")], "id long, up long, label string")
    walked = hierarchy.connect_by(chain.unionByName(loops), "id", "up", F.col("id") == 0, "label", sep="/")
    found = {r["id"]: (r["level"], len(r["path"].split("/")) - 1, r["path"][-5:]) for r in walked.collect()}
    assert len(found) == 1500 and all(found[i][:2] == (i + 1, i + 1) for i in range(1500))
    assert found[1499][2] == "/1499"
    path = spark._jvm.org.apache.hadoop.fs.Path(folders[0])
    written = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    assert len(written) <= 13  # the rows themselves, then at most 12 rounds


def test_starts_below_starts_and_repeated_ids(spark):
    """A start row below another one begins a walk of its own; a repeated id is walked through each row."""
    nodes = spark.createDataFrame([(1, None, "a"), (2, 1, "b"), (2, 1, "B"), (3, 2, "c"), (None, 3, "n"), (4, None, None), (5, 4, "e")], "id long, up long, label string")
    walked = hierarchy.connect_by(nodes, "id", "up", F.col("id").isin(1, 2, 4), "label", sep="/", root_col="root")
    assert rows(walked, "path", "root", "level") == sorted(
        [("/a", "a", 1), ("/a/b", "a", 2), ("/a/B", "a", 2), ("/b", "b", 1), ("/B", "B", 1), (None, None, 1), (None, None, 2)]
        + [(f"/a/{b}/c", "a", 3) for b in "bB"] + [(f"/{b}/c", b, 2) for b in "bB"]
        + [(f"/a/{b}/c/n", "a", 4) for b in "bB"] + [(f"/{b}/c/n", b, 3) for b in "bB"],
        key=repr,
    )
    assert hierarchy.connect_by(nodes.limit(0), "id", "up", F.col("id") == 1, "label").count() == 0


@pytest.mark.parametrize("levels", [1, 8, 40])
def test_documents_of_many_levels(spark, levels):
    deep: object = "leaf"
    for n in range(levels):
        deep = {"k": deep} if n % 2 else [deep]
    texts = spark.createDataFrame([(1, json.dumps(deep)), (2, '{"a": "[[[{{{"}'), (3, "7")], "id long, text string")
    docs = texts.select("id", F.parse_json("text").alias("v"))
    assert documents.depth(docs, "v") == levels
    found = documents.flatten_all(docs, "v")
    assert {r["level"] for r in found.filter("id = 1").collect()} == set(range(1, levels + 1))
    assert found.filter("id = 2").count() == 1 and found.filter("id = 3").count() == 0


def test_depth_below_values_of_different_types(spark):
    texts = spark.createDataFrame([('{"a": 1}',), ('{"a": {"b": [[1, {"c": "\\"]"}]]}}',), (None,)], "text string")
    docs = texts.select(F.parse_json("text").alias("v"))
    assert documents.depth(docs, "v") == 5
    assert documents.flatten_all(docs, "v").agg(F.max("level")).first()[0] == 5
    assert documents.flatten_all(docs.limit(0), "v").count() == 0


ORDER = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
BUYER = "c_custkey long, c_name string, c_nationkey long, c_acctbal double, c_mktsegment string"


def orders(spark, totals, first):
    stamp = dt.datetime(1995, 1, 1)
    return spark.createDataFrame([(first + i, c, "O", float(t), stamp, "1") for i, (c, t) in enumerate(totals)], ORDER)


def test_a_view_sees_rows_that_land_later(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([(i, f"c{i}", 1, 5.0, "x") for i in range(1, 6)], BUYER).write.parquet(f"{root}/customer")
    orders(spark, [(1, 10), (2, 20)], 1).write.parquet(f"{root}/orders")
    ranking.register_loyalty_view(spark, f"{root}/customer", f"{root}/orders", [9], "v_test_loyalty")
    assert rows(ranking.loyalty_view(spark, "v_test_loyalty"), "customer_id", "level", "type") == [
        (1, "gold", "top 400"), (2, "gold", "top 400"), (9, "gold", "early supporter"),
    ]
    orders(spark, [(3, 30)], 50).write.mode("append").parquet(f"{root}/orders")
    assert ranking.loyalty_view(spark, "v_test_loyalty").count() == 4
    spark.sql("DROP VIEW v_test_loyalty")


def test_a_ranking_is_repaired_from_changed_totals(spark):
    """Totals that rise, fall and meet, batch by batch, against the ranking of all of them."""
    root = new_folder(spark, "test-ranking")
    customer = spark.range(1, 40).select(F.col("id").alias("customer_id"), F.lit(1).alias("account_balance_usd"), F.lit(1).alias("location_id"))
    nobody = spark.createDataFrame([], "customer_id long")
    batches = [
        [(i, 100 * i) for i in range(1, 31)],
        [(30, -2950), (29, -2850)],  # two leaders fall
        [(28, -100), (27, 0), (26, 100)],  # three meet
        [(25, -2400), (24, -2300), (23, -2200), (22, -2100), (28, -2600), (27, -2600), (26, -2600)],  # the list runs dry
        [(35, 50_000), (99, 70_000)],
    ]
    schema = "customer_id long, total_price_usd decimal(12,2)"
    seen: dict[int, Decimal] = {}
    for batch in batches:
        spark.createDataFrame([(c, Decimal(t)) for c, t in batch], schema).coalesce(1).write.mode("append").parquet(f"{root}/landed")
        stream = feeds.read_files(spark, f"{root}/landed", spark.createDataFrame([], schema).schema)
        got = feeds.loyalty_stream(stream, customer, nobody, root, n=3)
        for c, t in batch:
            seen[c] = seen.get(c, Decimal(0)) + t
        listed = got.select("customer_id").collect()
        best = sorted({t for c, t in seen.items() if c < 40}, reverse=True)
        want = {c for c, t in seen.items() if c < 40 and t in best[:3]}
        assert want <= {r[0] for r in listed}
        kept = feeds.read_version(spark, f"{root}/list", feeds.last_version(spark, f"{root}/list"))
        assert {r[0]: r[1] for r in kept.select("customer_id", "total_price_usd").collect()}.items() <= seen.items()
    assert kept.count() < 15


def test_rules_on_stored_values(spark):
    good = ("1", "a", "3", "1.25", "x")
    broken = [(None, *good[1:]), ("x1", *good[1:]), ("1", "n" * 26, *good[2:]), ("1", "a", "3", "1.234", "x"), ("1", "a", "3", "12345678901", "x"), ("1", "a", None, "0", "s" * 11)]
    frame = spark.createDataFrame([good, *broken], "c_custkey string, c_name string, c_nationkey string, c_acctbal string, c_mktsegment string")
    found = {(r.column_name, r.rule): r.violations for r in keys.check_source(frame, CUSTOMER).collect()}
    assert {k: v for k, v in found.items() if v} == {
        ("c_custkey", "not null"): 1, ("c_custkey", "is bigint"): 1, ("c_name", "length <= 25"): 1, ("c_nationkey", "not null"): 1,
        ("c_acctbal", "is decimal(12,2)"): 1, ("c_acctbal", "scale of decimal(12,2)"): 1, ("c_mktsegment", "length <= 10"): 1,
    }
    assert len(MODEL) == 7


def test_tokens(spark):
    frame = spark.createDataFrame([("a b.c",), ("  a ",), ("",), (None,), ("x.y\\E z",)], "t string")
    assert rows(frame.select("t", strtok("t", " .", 1), strtok("t", " .", 3), strtok_to_array("t", "\\.")))[:2] == [
        ("  a ", "a", None, ["  a "]),
        ("", None, None, []),
    ]
    assert rows(frame.filter("t like 'x%'").select(strtok("t", " .", 2), F.size(strtok_to_array("t", ".\\")))) == [("y\\E", 3)]


def test_one_batch_feeds_several_targets(spark):
    stamp = lambda n: dt.datetime(2024, 1, n)
    hub = spark.createDataFrame([("k1", stamp(1))], "hk string, load_ts timestamp")
    sat = spark.createDataFrame([("k1", "h1", 5, stamp(1))], "hk string, hash_diff string, x long, load_ts timestamp")
    batch = spark.createDataFrame(
        [("k1", "h1", 5, stamp(2)), ("k1", "h2", 6, stamp(3)), ("k2", "h3", 7, stamp(3)), ("k2", "h3", 8, stamp(2)), (None, "h4", 9, stamp(2)), (None, "h4", 9, stamp(2))],
        "hk string, h string, x long, load_ts timestamp",
    )
    out = vault.insert_absent(batch, {"hub": vault.Target(hub, ["hk"], {}), "sat": vault.Target(sat, ["hk", "hash_diff"], {"hash_diff": "h"})})
    assert rows(out["hub"]) == sorted([("k2", stamp(2)), (None, stamp(2))], key=repr)
    assert rows(out["sat"]) == sorted([("k1", "h2", 6, stamp(3)), ("k2", "h3", 8, stamp(2)), (None, "h4", 9, stamp(2))], key=repr)


def test_a_dimension_asks_its_target_for_the_batch_only(spark):
    target = spark.range(1, 4).select(F.col("id").alias("sk"), F.concat(F.lit("n"), "id").alias("name"))
    out = shred.shred_dim(target, spark.createDataFrame([("n2",), ("n9",), ("n8",), ("n9",), (None,)], "name string"), "name", "sk")
    assert rows(out) == [(4, "n8"), (5, "n9")]
