"""Merge of a batch into a table, and the change rows that it makes.

Parquet tables take no row-level merge, so the result is the table's next version; the caller
writes it beside the one being read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import few_rows, stage


@dataclass(frozen=True)
class MergeResult:
    """`rows`: the table after the merge. `changes`: before and after images of what it did, a row each.

    `updates`: one row per updated row, with its images side by side as `before` and `after`.
    """

    rows: DataFrame
    changes: DataFrame
    updates: DataFrame


def _known(on: Sequence[str]) -> Column:
    """Whether a row has its whole key."""
    known = F.lit(True)
    for c in on:
        known = known & F.col(c).isNotNull()
    return known


def _whole_keys(source: DataFrame, on: Sequence[str], flag: str) -> DataFrame:
    """The rows of `single_per_key` that have their whole key, spread and sorted by it."""
    nth = F.row_number().over(Window.partitionBy(*on).orderBy(*on))
    described = F.concat_ws(", ", *[F.col(c).cast("string") for c in on])
    repeated = F.raise_error(F.concat(F.lit("more than one source row for key "), described))
    return source.filter(_known(on)).withColumn(flag, F.when(nth > 1, repeated.cast("boolean")).otherwise(F.lit(True)))


def single_per_key(source: DataFrame, on: Sequence[str], flag: str) -> DataFrame:
    """Mark source rows as present, and fail the job on a second row for a key.

    The running row number reads the shuffle and the sort that the join on the same key needs
    anyway, and it holds no rows back: the second row of a key raises at once. A key with a NULL
    matches nothing, so any number of rows may have it.
    """
    without_key = source.filter(~_known(on)).withColumn(flag, F.lit(True))
    return _whole_keys(source, on, flag).unionByName(without_key)


def join_by_key(target: DataFrame, source: DataFrame, on: Sequence[str]) -> DataFrame:
    """All target rows with their source row, and the source rows with a new key.

    The rows are two structs, `t` and `s`, with the presence flags `t._t` and `s._s`. A full outer
    join has to move both sides; here a small batch is the build side of a left join, and new keys
    are looked for among the target keys that the batch touches, so the target stays where it is.
    Which side is small is left to Spark's own size check; with two large sides both are shuffled.
    The batch is written first: it is worked out once, and its size is known when the joins are planned.
    """
    return _joined(target, stage(source, "merge-batch"), on)


def _joined(target: DataFrame, source: DataFrame, on: Sequence[str]) -> DataFrame:
    left = target.withColumn("_t", F.lit(True)).alias("t")
    right = single_per_key(source, on, "_s")
    same = [F.col(f"t.{c}") == F.col(f"s.{c}") for c in on]
    met = left.join(right.alias("s"), same, "left").select(F.struct("t.*").alias("t"), F.struct("s.*").alias("s"))
    fresh = without(right, target, on).select(
        F.lit(None).cast(met.schema["t"].dataType).alias("t"), F.struct(*right.columns).alias("s")
    )
    return met.unionByName(fresh)


def _met(target: DataFrame, source: DataFrame, on: Sequence[str]) -> DataFrame:
    """The target rows that have a source row, beside it: plain columns under the aliases `t` and `s`.

    Only columns that a later step takes are read and moved. The source is moved once, as its window and
    the join are on the same key; rows without a whole key meet nothing and stay out.
    """
    left = target.withColumn("_t", F.lit(True)).alias("t")
    right = _whole_keys(source, on, "_s").alias("s")
    return left.join(right, [F.col(f"t.{c}") == F.col(f"s.{c}") for c in on]).filter("s._s")


def without(
    source: DataFrame, target: DataFrame, on: Sequence[str], written: bool = False, few: bool | None = None
) -> DataFrame:
    """Source rows whose key the target does not hold; a key with a NULL is never held.

    The target's keys are reduced to those of the batch first, with the batch as the build side.
    `written` tells that both are written tables: their rows are counted then. Few target keys are
    broadcast as they are, and with many rows on both sides each is sorted once and nothing is broadcast.
    With `few` false, which a caller tells of a large batch, that is done without counting.
    """
    if few is not False and written and few_rows(target):
        return source.join(F.broadcast(target.select(*on).distinct()), list(on), "left_anti").select(*source.columns)
    if few is False or written and not few_rows(source):
        return source.join(target.select(*on).hint("merge"), list(on), "left_anti").select(*source.columns)
    touched = target.select(*on).join(source.select(*on), list(on), "left_semi").distinct()
    return source.join(touched, list(on), "left_anti").select(*source.columns)


def merge(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    update: Mapping[str, Column],
    insert: Mapping[str, Column] | None = None,
    when: Column | None = None,
) -> MergeResult:
    """Insert source rows with a new key; update the listed columns of matched rows.

    `update`, `insert` and `when` are columns over the aliases `t` (target) and `s` (source).
    A matched row is updated when `when` is true; a NULL condition leaves it as it is.
    """
    source = stage(source, "merge-batch")
    joined = _joined(target, source, on)
    matched = F.col("t._t").isNotNull() & F.col("s._s").isNotNull()
    hit = matched if when is None else matched & F.coalesce(when, F.lit(False))
    step = (
        F.when(F.col("t._t").isNull(), F.lit("insert")).when(hit, F.lit("update")).otherwise(F.lit("keep"))
    )
    types = {f.name: f.dataType for f in target.schema.fields}

    def after(name: str) -> Column:
        value = F.col(f"t.{name}")
        if name in update:
            value = F.when(F.col("_step") == "update", update[name]).otherwise(value)
        if insert is not None:
            value = F.when(F.col("_step") == "insert", insert.get(name, F.lit(None))).otherwise(value)
        return value.cast(types[name]).alias(name)

    stepped = joined.withColumn("_step", step)
    if insert is None:
        stepped = stepped.filter("_step <> 'insert'")
    rows = stepped.select(*[after(c) for c in target.columns])

    def image(action: str, cols: list[Column], is_update: Column) -> Column:
        return F.struct(*cols, F.lit(action).alias("action"), is_update.alias("is_update"))

    is_update = F.col("_step") == "update"
    new = image("INSERT", [after(c) for c in target.columns], is_update)
    old = image("DELETE", [F.col(f"t.{c}").cast(types[c]).alias(c) for c in target.columns], is_update)
    images = F.when(is_update, F.array(old, new)).otherwise(F.array(new))
    changes = stepped.filter("_step <> 'keep'").select(F.inline(images))
    hits = _met(target, source, on)
    hits = hits if when is None else hits.filter(when)
    old_row = F.struct(*[F.col(f"t.{c}").cast(types[c]).alias(c) for c in target.columns])
    new_row = F.struct(*[update.get(c, F.col(f"t.{c}")).cast(types[c]).alias(c) for c in target.columns])
    return MergeResult(rows, changes, hits.select(old_row.alias("before"), new_row.alias("after")))


def paired(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`updates` of stored change rows: both images of each updated key in one row, by one aggregate."""
    columns = [c for c in changes.columns if c not in ("action", "is_update")]

    def image(action: str) -> Column:
        return F.max(F.when(F.col("action") == action, F.struct(*columns)))

    images = changes.filter("is_update").groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(image("DELETE").alias("before"), image("INSERT").alias("after"))
    return images.select("before", "after")


def absent(
    target: DataFrame, source: DataFrame, on: Sequence[str], written: bool = False, few: bool | None = None
) -> DataFrame:
    """Source rows whose key the target does not hold: the rows to append."""
    return without(source, target, on, written, few).select(*target.columns)


def insert_if_absent(target: DataFrame, source: DataFrame, on: Sequence[str]) -> DataFrame:
    """The target with those source rows whose key it does not hold."""
    return target.unionByName(absent(target, source, on))


def change_feed(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Before and after images between two states of a table, with action and update flag."""
    columns = before.columns
    joined = before.withColumn("_t", F.lit(True)).alias("t").join(
        after.withColumn("_s", F.lit(True)).alias("s"),
        [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys],
        "full_outer",
    )
    same = F.lit(True)
    for c in columns:
        if c not in keys:
            same = same & F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}"))
    both = F.col("t._t").isNotNull() & F.col("s._s").isNotNull()

    def image(side: str, action: str) -> Column:
        return F.struct(
            *[F.col(f"{side}.{c}").alias(c) for c in columns],
            F.lit(action).alias("action"),
            both.alias("is_update"),
        )

    images = (
        F.when(both, F.array(image("t", "DELETE"), image("s", "INSERT")))
        .when(F.col("t._t").isNotNull(), F.array(image("t", "DELETE")))
        .otherwise(F.array(image("s", "INSERT")))
    )
    return joined.filter(~both | ~same).select(F.inline(images))
