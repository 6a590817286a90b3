"""JSON documents, shredding, hierarchies and the vault on small inputs."""

import datetime as dt
import json

import pytest
from rows_of_frames import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.functions.variants import array_first, array_last, json_array, json_get, path_depth
from tidemark.operators import documents, hierarchy, shred, vault

DOCUMENT = {
    "name": "Ada Lindqvist",
    "nickname": "The Cartographer",
    "years": [1901, 1904, 1907],
    "vessel": {"name": "Northern Tern", "type": "Schooner"},
    "team": [
        {"name": "Bo Falk", "tools": ["sextant"], "years": [1901, 1904]},
        {"name": "Cleo Marsh", "nickname": "Quill", "tools": ["sextant", "theodolite", "chain"], "years": [1907]},
        {"name": "Dag Ness", "tools": [], "seasick": True},
    ],
    "note": None,
}
STAMP = dt.datetime(2021, 5, 1)


@pytest.fixture(scope="module")
def docs(spark):
    texts = spark.createDataFrame([(1, json.dumps(DOCUMENT)), (2, "{not json"), (3, None)], "id long, text string")
    return documents.land_json(texts, "text", "test", F.lit(STAMP))


def test_landing_splits_bad_text(docs):
    landed, rejected = docs
    assert rows(landed, "id", "load_name") == [(1, "test")]
    assert rows(rejected) == [(2, "{not json"), (3, None)]


def test_paths_and_arrays(docs):
    found = docs[0].select(
        json_get("v", "vessel.name"),
        json_get("v", "no.such.path"),
        json_get("v", "note"),
        F.size(json_array("v", "years")),
        array_first("v", "years", "int"),
        array_last("v", "years", "int"),
        array_last("v", "team[2].tools"),
    )
    assert tuple(found.first()) == ("Northern Tern", None, None, 3, 1901, 1907, None)


def test_flatten(docs):
    team = documents.flatten(docs[0], "v", "team", "member")
    assert rows(team.select("member_index", json_get("member", "name"))) == [
        (0, "Bo Falk"),
        (1, "Cleo Marsh"),
        (2, "Dag Ness"),
    ]
    assert documents.flatten(team, "member", "tools", "tool").count() == 4
    assert documents.flatten(team, "member", "tools", "tool", outer=True).count() == 5
    cleo = F.lower(json_get("item", "name")) == "cleo marsh"
    assert documents.count_nested(docs[0], "v", "team", "tools", cleo).first()[0] == 3


def walk(value, path="", key=None, pos=None):
    """Every node below the root, by plain recursion."""
    if path:
        yield (key, path, pos, json.dumps(value, sort_keys=True, separators=(",", ":")))
    if isinstance(value, dict):
        for k, v in value.items():
            yield from walk(v, f"{path}.{k}" if path else k, key=k)
    elif isinstance(value, list):
        for i, v in enumerate(value):
            yield from walk(v, f"{path}[{i}]", pos=i)


def test_flatten_all_finds_every_node_once(docs):
    nodes = documents.flatten_all(docs[0].select("id", "v"), "v")
    found = rows(nodes.select("key", "path", "pos", F.to_json("value")))
    assert found == sorted(walk(DOCUMENT), key=repr)


def test_flatten_all_deeper_than_a_round(spark):
    value = "leaf"
    for n in range(40):
        value = [value] if n % 2 else {"k": value}
    df = spark.createDataFrame([(json.dumps(value),)], "t string").select(F.parse_json("t").alias("v"))
    assert documents.flatten_all(df, "v").agg(F.max("level")).first()[0] == 40


def test_flatten_of_objects_and_scalars(spark):
    df = spark.createDataFrame([('{"a":{"x":1,"y":2}}',), ('{"a":5}',), ('{"a":[7]}',)], "t string")
    found = documents.flatten(df.select(F.parse_json("t").alias("v")), "v", "a", "e")
    assert rows(found.select("e_index", json_get("e", "", "int"))) == [(0, 1), (0, 7), (1, 2)]


def test_path_depth(spark):
    paths = {"a": 1, "a.b": 2, "a[0]": 2, "a[10]": 2, "a[0].b": 2, "a[0].b[1]": 3, "a.b.c": 3}
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    assert {r[0]: r[1] for r in df.select("path", path_depth("path")).collect()} == paths


def test_shredding(spark, docs):
    stamp = ["load_name", "load_ts"]
    team = documents.flatten(docs[0], "v", "team", "member")
    tools = documents.flatten(team, "member", "tools", "tool").select(
        json_get("member", "name").alias("member_name"), json_get("tool", "").alias("tool_name"), *stamp
    )
    tail = "load_name string, load_ts timestamp_ntz"
    no_tools = spark.createDataFrame([], f"tool_id long, name string, {tail}")
    named = tools.select(F.col("tool_name").alias("name"), *stamp)
    tool = no_tools.unionByName(shred.shred_dim(no_tools, named, "name", "tool_id"))
    assert rows(tool, "tool_id", "name") == [(1, "chain"), (2, "sextant"), (3, "theodolite")]
    assert shred.shred_dim(tool, named, "name", "tool_id").count() == 0
    more = spark.createDataFrame([("axe", "test", STAMP), ("chain", "test", STAMP), ("axe", "test", STAMP)], named.schema)
    assert rows(shred.shred_dim(tool, more, "name", "tool_id"), "tool_id", "name") == [(4, "axe")]

    nobody = spark.createDataFrame([], f"person_id long, leader long, name string, nickname string, {tail}")
    heads = docs[0].select(json_get("v", "name").alias("name"), json_get("v", "nickname").alias("nickname"), *stamp)
    members = team.select(
        json_get("member", "name").alias("name"),
        json_get("member", "nickname").alias("nickname"),
        json_get("v", "name").alias("leader_name"),
        *stamp,
    )
    person = shred.shred_rollup(nobody, heads, members, "name", "leader_name", "person_id", "leader")
    assert rows(person, "person_id", "leader", "name") == sorted(
        [(1, None, "Ada Lindqvist"), (2, 1, "Bo Falk"), (3, 1, "Cleo Marsh"), (4, 1, "Dag Ness")], key=repr
    )

    pairs = shred.shred_bridge(
        spark.createDataFrame([], f"person_id long, tool_id long, {tail}"),
        tools.unionByName(tools),
        {"member_name": (person, "name", "person_id"), "tool_name": (tool, "name", "tool_id")},
    )
    assert rows(pairs, "person_id", "tool_id") == [(2, 2), (3, 1), (3, 2), (3, 3)]

    years = documents.flatten(team, "member", "years", "y").select(
        json_get("member", "name").alias("member_name"), json_get("y", "", "bigint").alias("year"), *stamp
    )
    held = shred.shred_values(
        spark.createDataFrame([(2, 1901, "test", STAMP)], f"person_id long, year long, {tail}"),
        years,
        person,
        "member_name",
        "name",
        "person_id",
        "year",
    )
    assert rows(held, "person_id", "year") == [(2, 1904), (3, 1907)]

    vessel = spark.createDataFrame([(7, "Schooner")], "vessel_id long, type string")
    star = shred.shredded_star(
        person.withColumn("vessel_id", F.lit(7)),
        vessel,
        pairs,
        tool,
        "person_id",
        "vessel_id",
        "tool_id",
    )
    assert rows(star) == sorted(
        [
            ("Ada Lindqvist", "The Cartographer", "Schooner", "None"),
            ("Bo Falk", "None", "Schooner", "sextant"),
            ("Cleo Marsh", "Quill", "Schooner", "chain"),
            ("Cleo Marsh", "Quill", "Schooner", "sextant"),
            ("Cleo Marsh", "Quill", "Schooner", "theodolite"),
            ("Dag Ness", "None", "Schooner", "None"),
        ],
        key=repr,
    )


TREE = [
    (1, None, "Head"),
    (2, 1, "North Lead"),
    (3, 1, "South Lead"),
    (4, 2, "Scout"),
    (5, 2, "Cook"),
    (6, 5, "Helper"),
    (7, 3, "Scout"),
]


@pytest.fixture(scope="module")
def tree(spark):
    return spark.createDataFrame(TREE, "id long, superior long, rank string")


def test_walk(tree):
    walked = hierarchy.connect_by(tree, "id", "superior", F.col("rank") == "Head", "rank")
    assert {r["id"]: (r["path"], r["level"]) for r in walked.collect()} == {
        1: ("-> Head", 1),
        2: ("-> Head-> North Lead", 2),
        3: ("-> Head-> South Lead", 2),
        4: ("-> Head-> North Lead-> Scout", 3),
        5: ("-> Head-> North Lead-> Cook", 3),
        6: ("-> Head-> North Lead-> Cook-> Helper", 4),
        7: ("-> Head-> South Lead-> Scout", 3),
    }


def test_branches_and_edges(tree):
    second_word = F.split_part("rank", F.lit(" "), F.lit(2))
    branches = hierarchy.branches(tree, "id", "superior", second_word == "Lead", F.col("rank") == "Head", "rank")
    assert rows(branches, "id", "branch", "path", "level")[:3] == [
        (1, "Head", "Head", 1),
        (2, "North Lead", "-> North Lead", 2),
        (3, "South Lead", "-> South Lead", 2),
    ]
    assert {r["branch"]: r["count"] for r in branches.groupBy("branch").count().collect()} == {
        "Head": 1,
        "North Lead": 4,
        "South Lead": 2,
    }
    edges = hierarchy.edge_nodes(branches, "id", "superior")
    assert [r["id"] for r in edges.filter("is_edge_node").orderBy("id").collect()] == [4, 6, 7]


def test_a_cycle_fails(spark, tree):
    loop = spark.createDataFrame([(1, 3, "a"), (2, 1, "b"), (3, 2, "c")], "id long, superior long, rank string")
    with pytest.raises(PySparkException, match="cycle at 1"):
        hierarchy.connect_by(loop, "id", "superior", F.col("id") == 1, "rank")
    away = spark.createDataFrame([(1, None, "a"), (2, 1, "b"), (3, 2, "c"), (2, 3, "d")], "id long, superior long, rank string")
    with pytest.raises(RuntimeError, match="more levels than rows"):
        hierarchy.connect_by(away, "id", "superior", F.col("id") == 1, "rank")
    assert hierarchy.connect_by(tree, "id", "superior", F.col("rank") == "Head", "rank").count() == 7


CUSTOMER = "customer_id long, name string, iso2_code string, account_balance_usd decimal(12,2), market_segment string"
ORDER = "sales_order_id long, customer_id long, order_status string, total_price_usd decimal(12,2), order_date date, order_priority string"


def batch(spark, customers, orders, n):
    stamp = {"load_ts": F.lit(dt.datetime(2022, 1, n)), "rec_src": F.lit("s")}
    return (
        vault.stage_customer(
            spark.createDataFrame([(k, f"c{k}", "SE", v, None) for k, v in customers], CUSTOMER).withColumns(stamp)
        ),
        vault.stage_order(
            spark.createDataFrame([(o, k, "O", None, None, "1") for o, k in orders], ORDER).withColumns(stamp)
        ),
    )


def counts(state):
    return {n: df.count() for n, df in state.tables().items() if n != "ref_nation"}


def test_vault_loads_add_only_what_is_new(spark):
    from decimal import Decimal

    one, two = Decimal("1.00"), Decimal("2.00")
    location = spark.createDataFrame([(1, "x", 1)], "location_id long, name string, region_id long")
    codes = spark.createDataFrame([(1, "SE")], "location_id long, iso2_code string")
    nation = vault.src_nation(location, codes, F.lit(STAMP), "s")
    first = batch(spark, [(1, one), (2, one), (2, one)], [(10, 1), (11, 1)], 1)
    state = vault.run_loads(vault.empty_vault(vault.load_ref(nation)), [first])
    assert counts(state) == {
        "hub_customer": 2,
        "hub_order": 2,
        "sat_sys1_customer": 2,
        "sat_sys1_order": 2,
        "lnk_customer_order": 2,
    }
    assert counts(vault.run_loads(state, [first])) == counts(state)
    second = batch(spark, [(1, two), (3, one)], [(10, 1), (12, 3)], 2)
    after = vault.load_vault(state, *second)
    assert counts(after) == {
        "hub_customer": 3,
        "hub_order": 3,
        "sat_sys1_customer": 4,
        "sat_sys1_order": 3,
        "lnk_customer_order": 3,
    }
    back = batch(spark, [(1, one)], [], 3)[0]
    args = (back, "hub_customer_hk", "customer_hash_diff", vault.CUSTOMER_ATTRIBUTES)
    assert vault.load_sat(after.sat_sys1_customer, *args).count() == 0
    assert vault.load_sat(after.sat_sys1_customer, *args, compare="latest").count() == 1
    assert rows(vault.load_audit({"customer": first[0].unionByName(second[0])})) == [("customer", 2, 5)]
