"""Landing, flattening and measuring of JSON documents."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.variants import json_elements
from tidemark.session import stage


def land_json(df: DataFrame, col: str, load_name: str, load_ts: Column) -> tuple[DataFrame, DataFrame]:
    """Parse JSON text into a variant `v` with load name and time; text that fails is apart.

    Returns the landed rows and the rejected ones, NULL texts included; other columns pass through
    in both, so every row is in one of them. Landed
    rows come out of an `explode` of the parsed value, which drops NULL without a filter: a
    filter would be pushed down with a second parse of every text.
    """
    others = [c for c in df.columns if c != col]
    parsed = F.array_compact(F.array(F.try_parse_json(col)))
    landed = df.select(*others, F.explode(parsed).alias("v"))
    landed = landed.withColumns({"load_name": F.lit(load_name), "load_ts": load_ts})
    rejected = df.filter(F.try_parse_json(col).isNull())
    return landed, rejected


def flatten(df: DataFrame, v: str, path: str, out: str = "value", outer: bool = False) -> DataFrame:
    """One row per element of the array, or per key of the object, at `path`, beside its parent's columns.

    A scalar has no elements. Keys are in the order of the object, and `<out>_index` counts them.

    Adds `<out>` and its position `<out>_index`. A parent without elements disappears, or stays
    with NULL when `outer`. Expanding is local to the row: no shuffle.
    """
    explode = F.posexplode_outer if outer else F.posexplode
    return df.select("*", explode(json_elements(v, path)).alias(f"{out}_index", out))


def count_nested(df: DataFrame, v: str, outer_path: str, inner_path: str, where: Column) -> DataFrame:
    """Number of inner array elements under the outer elements that meet a condition.

    `where` is a condition over the outer element `item`.
    """
    items = flatten(df, v, outer_path, "item").filter(where)
    return flatten(items, "item", inner_path, "nested").agg(F.count("nested").alias("nested_count"))


#: Levels that one plan expands; deeper documents are staged in between.
LEVELS_PER_PLAN = 8
_NODE = ("key", "path", "pos", "value", "level")


def _expand(nodes: DataFrame, columns: list[str], level: int, levels: int) -> DataFrame:
    """The nodes of one level and those of the `levels` levels below them.

    Each level is one `variant_explode_outer` inside the one before, so a row is the way to a node without
    elements and holds no copies of the nodes above. A node goes out with the row of its first way.
    """
    tvf = nodes.sparkSession.tvf
    ways = nodes.select(*columns, *[F.col(c).alias(f"_{c}0") for c in _NODE if c != "level"])
    for n in range(levels):
        below = tvf.variant_explode_outer(F.col(f"_value{n}").outer()).toDF(f"_at{n + 1}", f"_key{n + 1}", f"_value{n + 1}")
        key, at, path = F.col(f"_key{n + 1}"), F.col(f"_at{n + 1}"), F.col(f"_path{n}")
        name = F.concat(path, F.when(path == "", "").otherwise("."), key)
        place = F.concat(path, F.lit("["), at.cast("string"), F.lit("]"))
        ways = ways.lateralJoin(below).withColumns(
            {f"_path{n + 1}": F.when(key.isNotNull(), name).otherwise(place), f"_pos{n + 1}": F.when(key.isNull(), at)}
        )
    rows = []
    for n in range(levels + 1):
        node = F.struct(*[F.lit(level + n).alias(c) if c == "level" else F.col(f"_{c}{n}").alias(c) for c in _NODE])
        goes = F.lit(True) if n == 0 else F.col(f"_at{n}").isNotNull()
        for m in range(n + 1, levels + 1):
            goes = goes & (F.coalesce(F.col(f"_at{m}"), F.lit(0)) == 0)
        rows.append(F.when(goes, node))
    return ways.select(*columns, F.explode(F.array(*rows)).alias("_node")).filter("_node IS NOT NULL").select(*columns, "_node.*")


def _nested(schema: str) -> int | None:
    """Containers inside each other in a schema's text; None where types that differ hide what is below."""
    plain = re.sub("`[^`]*`", "", schema)  # names with special characters
    if "VARIANT" in plain:
        return None
    depth = deepest = 0
    for mark in re.findall("(?:OBJECT|ARRAY)<|>", plain):
        depth += -1 if mark == ">" else 1
        deepest = max(deepest, depth)
    return deepest


def depth(df: DataFrame, v: str) -> int:
    """Levels of nodes below the root of the deepest document, by one aggregate over all documents.

    The merged schema of the documents tells it. Where documents differ in the type of a value, the schema
    does not show what is below, and the brackets of each document's text are counted instead.
    """
    nested = _nested(df.agg(F.schema_of_variant_agg(v)).first()[0] or "")
    if nested is not None:
        return nested
    brackets = F.regexp_replace(F.regexp_replace(F.to_json(v), r'"(?:[^"\\]|\\.)*+"', ""), r"[^\[\]{}]", "")
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(state, mark):
        now = state["now"] + F.when(mark.isin("[", "{"), 1).when(mark.isin("]", "}"), -1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(state["most"], now).alias("most"))

    most = F.aggregate(F.split(brackets, ""), start, step, lambda state: state["most"])
    return df.agg(F.max(most)).first()[0] or 0


def flatten_all(df: DataFrame, v: str) -> DataFrame:
    """Every node below the root of each document: `key`, `path`, `pos`, `value`, `level`.

    The depth of the documents is found first, then each level is expanded once, in one plan for documents of
    up to eight levels. Beyond that, the nodes so far are written after every eight levels and only the deepest
    ones are read on, so a document of any depth is read once.
    """
    columns = [c for c in df.columns if c != v]
    levels, level, done = depth(df, v), 0, []
    nodes = df.select(
        *columns,
        F.lit(None).cast("string").alias("key"),
        F.lit("").alias("path"),
        F.lit(None).cast("int").alias("pos"),
        F.col(v).alias("value"),
        F.lit(0).alias("level"),
    )
    while level < levels:
        more = min(LEVELS_PER_PLAN, levels - level)
        nodes, level = _expand(nodes, columns, level, more), level + more
        if level < levels:
            nodes = stage(nodes, f"nodes-{level}")
            done.append(nodes.filter(F.col("level") < level))
            nodes = nodes.filter(F.col("level") == level)
    for part in done:
        nodes = nodes.unionByName(part)
    return nodes.filter("level > 0")
