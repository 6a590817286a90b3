"""Every node of odd documents, and the plan that finds them."""

from __future__ import annotations

import json

from pyspark.sql import functions as F
from rows_of_frames import rows

from tidemark.operators import documents

TEXTS = [
    '{"a": {"b.c": [1, null, [], {}, [[2, "x"]]], "": {"": 1.5}}, "z": null, "e": {}, "f": []}',
    '[[], [{}, {"k": [true]}], null, "s"]',
    "7",
    "null",
    None,
    '{"a": 1, "k": "[]"}',
]


def nodes_of(value, path="", level=1):
    """The nodes of a document: key, path, pos, text of a scalar, level."""
    if isinstance(value, dict):
        below = [(k, f"{path}.{k}" if path else k, None, value[k]) for k in value]
    else:
        below = [(None, f"{path}[{i}]", i, x) for i, x in enumerate(value)] if isinstance(value, list) else []
    for key, at, pos, x in below:
        yield key, at, pos, json.dumps(x, separators=(",", ":"), sort_keys=True), level
        yield from nodes_of(x, at, level + 1)


def test_nodes_of_odd_documents(spark, monkeypatch):
    texts = spark.createDataFrame([(i % 5, t) for i, t in enumerate(TEXTS)], "id int, text string")
    docs = texts.select("id", F.parse_json("text").alias("v"))
    want = sorted([(i % 5, *n) for i, t in enumerate(TEXTS) if t for n in nodes_of(json.loads(t))], key=repr)
    for levels in (8, 2, 1):
        monkeypatch.setattr(documents, "LEVELS_PER_PLAN", levels)
        found = documents.flatten_all(docs, "v").withColumn("value", F.to_json("value"))
        assert rows(found.select("id", "key", "path", "pos", "value", "level")) == want


def test_a_level_is_expanded_without_lambdas(spark):
    docs = spark.createDataFrame([('{"a": [{"b": 1}]}',)], "text string").select(F.parse_json("text").alias("v"))
    plan = documents.flatten_all(docs, "v")._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and plan.count("Generate variant_explode") == 3
