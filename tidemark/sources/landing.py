"""The landing area: load batches, their stamps, and reading them back.

Load times are parameters and every choice of rows follows from the data, so that a load can be
repeated after a failure and lands the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.computed import update_where
from tidemark.operators.skew import salted_join


def sample_rows(df: DataFrame, n: int, key: str, seed: int) -> DataFrame:
    """A repeatable sample of `n` rows: the first in the order of a seeded hash of the key.

    Planned as a top-n: every task keeps n rows, and only those travel.
    """
    scatter = F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))
    return df.orderBy(scatter, F.col(key)).limit(n)


def land(df: DataFrame, load_ts: Column, ts_col: str = "load_ts", where: Column | None = None) -> DataFrame:
    """Stamp rows with their load time."""
    rows = df if where is None else df.filter(where)
    return rows.withColumn(ts_col, load_ts)


def land_delta(
    df: DataFrame,
    load_ts: Column,
    adjust: Mapping[str, Column],
    when: Column | None = None,
    ts_col: str = "load_ts",
) -> DataFrame:
    """A delta batch: some values adjusted by rule, then stamped."""
    return land(update_where(df, adjust, when), load_ts, ts_col)


def latest_load(df: DataFrame, ts_col: str = "load_ts") -> DataFrame:
    """Rows of the newest load. With load-time partitions only that partition is scanned."""
    return df.filter(F.col(ts_col) == df.agg(F.max(ts_col)).scalar())


def next_load(src: DataFrame, target: DataFrame, date_col: str = "load_date") -> DataFrame:
    """Rows of the load one day after the newest load that the target holds."""
    newest = target.agg(F.max(date_col).alias("newest"))
    return src.filter(F.col(date_col) == newest.select(F.date_add("newest", 1)).scalar())


def whole_entities(df: DataFrame, key: str, picked: DataFrame) -> DataFrame:
    """All rows of the entities that the picked rows belong to."""
    return salted_join(df, picked.select(key).distinct(), [key], "left_semi")


def entity_batch(
    src: DataFrame,
    landed: DataFrame,
    key: str,
    adjust: Mapping[str, Column],
    load_ts: Column,
    keep: Column | None = None,
    ts_col: str = "load_ts",
    known: str | None = None,
) -> DataFrame:
    """A load of whole entities, split by whether the landing area knows them.

    Entities that are new arrive as they are, tagged `initial`; known ones arrive with their
    source values adjusted, tagged `update`. `keep` drops rows of known entities, which later
    shows as a deletion. One join tags every row; known keys are reduced to one row each first.
    Where a column `known` of the source says it already, true or NULL, nothing is joined; it is not landed.
    """
    if known:
        tagged, columns = src.withColumnRenamed(known, "_known"), [c for c in src.columns if c != known]
    else:
        keys = landed.select(key).distinct().withColumn("_known", F.lit(True))
        tagged, columns = salted_join(src, keys, [key], "left"), src.columns
    if keep is not None:
        tagged = tagged.filter(F.col("_known").isNull() | keep)
    adjusted = update_where(tagged, adjust, F.col("_known"))
    return adjusted.select(
        *columns,
        load_ts.alias(ts_col),
        F.when(F.col("_known"), "update").otherwise("initial").alias("load_type"),
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Append batches by column name."""
    result = frames[0]
    for df in frames[1:]:
        result = result.unionByName(df)
    return result
