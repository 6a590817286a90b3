"""Reverse-balance facts: history by added rows, and recovery of lines deleted at the source.

The fact only grows. A changed line keeps its old row and gets two more: the old values with
additive measures negated, and the new values. So a load reads the newest row of the entities
it touches and appends; nothing of the fact is rewritten.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.merge import MergeResult, merge, single_per_key
from tidemark.operators.skew import salted_join
from tidemark.session import stage
from tidemark.sources.landing import latest_load

DELETION = "deletion"
#: How a fact is written, so that a load reads the after-images of few as-ats.
FACT_PARTITIONS = ["is_after_image", "as_at_dts"]


def rb_initial(landed: DataFrame, ts: str = "load_ts") -> DataFrame:
    """The first load: every row an after-image as at its load."""
    return landed.withColumnRenamed(ts, "as_at_dts").withColumn("is_after_image", F.lit(True))


def load_history(
    landed: DataFrame, order_key: str = "sales_order_id", ts: str = "load_ts", full: bool = False
) -> DataFrame:
    """Per order: its loads, each with the next one; those whose next load is the newest.

    Loads are made distinct first, so the window sees one row per order and load. With
    `full=True` every load that has a next one is given.
    """
    loads = landed.filter(F.col("load_type") != DELETION).select(ts, order_key).distinct()
    following = F.lead(ts).over(Window.partitionBy(order_key).orderBy(ts))
    history = loads.withColumn("next_order_load", following).filter(F.col("next_order_load").isNotNull())
    if full:
        return history
    return history.filter(F.col("next_order_load") == landed.agg(F.max(ts)).scalar())


def detect_deletions(
    landed: DataFrame,
    history: DataFrame,
    order_key: str = "sales_order_id",
    line_key: str = "line_number",
    ts: str = "load_ts",
    reuse: bool = False,
) -> DataFrame:
    """Lines of an order's earlier load that are missing from its next load.

    A line is lost when no later load has it. With `reuse=True`, for sources that use a line
    number again, it is lost when the next load of the order does not have it.

    The history of an order becomes one row with its loads, from each to its next; it has at most
    as many entries as there are loads. The join with it comes first: only lines of the orders in the
    history are sorted, once and in the exchange of the join, each beside the next load that has it. So the work grows with the
    landed lines, also with a full history, and not with pairs of loads. A line that a load holds
    twice is in that load once more, not in a later one.
    """
    steps = F.map_from_entries(F.collect_set(F.struct(ts, "next_order_load"))).alias("_steps")
    orders = history.filter(F.col("next_order_load").isNotNull()).groupBy(order_key).agg(steps)
    following = F.lead(ts).over(Window.partitionBy(order_key, "_salt", line_key).orderBy(ts))
    lines = salted_join(landed, orders, [order_key], deal=[line_key]).withColumn("next_line_load", following)
    lines = lines.withColumn("next_order_load", F.col("_steps")[F.col(ts)]).filter(F.col("next_order_load").isNotNull())
    if reuse:
        lost = lines.filter(~F.col("next_line_load").eqNullSafe(F.col("next_order_load")))
    else:
        lost = lines.filter(F.col("next_line_load").isNull())
    return lost.select(*landed.columns, "next_order_load", "next_line_load")


def logical_deletes(deletions: DataFrame, additive: Sequence[str], ts: str = "load_ts") -> DataFrame:
    """The lost lines as rows of the load that dropped them, additive measures zero.

    Lines that already are deletions are left out. The detected rows carry all columns, so no
    second read of the landing area is needed.
    """
    rows = deletions.filter(F.col("load_type") != DELETION)
    types = {f.name: f.dataType for f in rows.schema.fields}
    return rows.withColumns(
        {
            **{c: F.lit(0).cast(types[c]) for c in additive},
            ts: F.col("next_order_load"),
            "load_type": F.lit(DELETION),
        }
    ).drop("next_order_load", "next_line_load")


def newest_as_at(fact: DataFrame, batch: DataFrame, order_key: str = "sales_order_id") -> DataFrame:
    """(order, max_as_at) of the orders of a batch that the fact holds.

    Only the key and the as-at of after-images are read, and only rows of the batch's orders leave
    their place when the orders, a written table, are small enough for Spark to broadcast.
    """
    orders = stage(batch.select(order_key).distinct(), "touched-orders")
    seen = fact.filter("is_after_image").select(order_key, "as_at_dts").join(orders, order_key, "left_semi")
    return seen.groupBy(order_key).agg(F.max("as_at_dts").alias("max_as_at"))


def current_images(fact: DataFrame, as_at: DataFrame, order_key: str = "sales_order_id") -> DataFrame:
    """The after-images that are the newest state of the orders in `as_at`.

    With a fact written by image flag and as-at (`FACT_PARTITIONS`), before-images are not read, nor
    are as-ats older than the oldest one that any of the orders needs.
    """
    needed = F.col("as_at_dts") >= as_at.agg(F.min("max_as_at")).scalar()
    images = fact.filter(F.col("is_after_image") & needed)
    newest = as_at.select(order_key, F.col("max_as_at").alias("as_at_dts"))
    return images.join(newest, [order_key, "as_at_dts"], "left_semi")


def _newest(batch: DataFrame, as_at: DataFrame, keys: Sequence[str], order_key: str) -> DataFrame:
    """Rows of the newest load, each with the newest as-at that the fact has for its order.

    The rows leave spread by the whole line key, by which the next steps work. If they kept the
    order's partitioning, an order with very many lines would stay in one task to the end.
    """
    return salted_join(batch, as_at, [order_key], "left").repartition(*keys)


def rb_merge(
    fact: DataFrame,
    landed: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    order_key: str = "sales_order_id",
    ts: str = "load_ts",
) -> MergeResult:
    """The newest load merged onto the newest after-image of each order, in place.

    `rows` is the fact between the merge and the reversal; `changes` has the images from which
    `rb_reversals` restores the history.
    """
    batch = latest_load(landed, ts)
    as_at = stage(newest_as_at(fact, batch, order_key), "touched-as-at")
    source = (
        salted_join(batch, as_at, [order_key], "left")
        .withColumn("as_at_dts", F.coalesce("max_as_at", F.col(ts)))
        .withColumn("is_after_image", F.lit(True))
        .select(*fact.columns, ts)
    )
    own = {**{c: F.col(f"s.{c}") for c in fact.columns}, "as_at_dts": F.col(f"s.{ts}")}
    images = fact.filter("is_after_image")
    merged = merge(
        images,
        source,
        [*keys, "as_at_dts"],
        update={c: own[c] for c in [*update, "load_type", "as_at_dts"]},
        insert=own,
    )
    return replace(merged, rows=merged.rows.unionByName(fact.filter("not is_after_image")))


def _negated(additive: Sequence[str], columns: Sequence[str], pick) -> list[Column]:
    return [(-pick(c) if c in additive else pick(c)).alias(c) for c in columns]


def rb_reversals(updates: DataFrame, additive: Sequence[str]) -> DataFrame:
    """For each updated line: the old after-image as it was, and its negation at the new as-at.

    `updates` has one row per updated line with its `before` and `after` image, as a merge gives
    them or `paired` makes of stored change rows. Nothing is shuffled.
    """
    columns = [f.name for f in updates.schema["before"].dataType.fields]
    restored = F.col("before")
    overrides = {"as_at_dts": F.col("after.as_at_dts"), "is_after_image": F.lit(False)}
    types = {f.name: f.dataType for f in updates.schema["before"].dataType.fields}
    negated = _negated(additive, columns, lambda c: overrides.get(c, F.col(f"before.{c}")))
    reversed_ = F.struct(*[c.cast(types[name]).alias(name) for name, c in zip(columns, negated)])
    return updates.select(F.inline(F.array(restored, reversed_)))


def rb_new_rows(
    fact: DataFrame,
    landed: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    additive: Sequence[str],
    order_key: str = "sales_order_id",
    ts: str = "load_ts",
) -> DataFrame:
    """The rows that the newest load adds to the fact.

    The batch is joined once with the current images of its orders: a new line gives one row, a known
    line gives its negated old row and its new row. The join is on the line key alone, by which
    the source is spread already. With a small batch no row of another order leaves its place.
    """
    types = {f.name: f.dataType for f in fact.schema.fields}
    batch = latest_load(landed, ts)
    as_at = stage(newest_as_at(fact, batch, order_key), "touched-as-at")
    source = single_per_key(_newest(batch, as_at, keys, order_key), keys, "_s").alias("s")
    images = current_images(fact, as_at, order_key).withColumn("_t", F.lit(True)).alias("t")
    match = [F.col(f"s.{k}") == F.col(f"t.{k}") for k in keys]
    joined = source.join(images, match, "left").filter("s._s")

    def row(pick) -> Column:
        return F.struct(*[pick(c).cast(types[c]).alias(c) for c in fact.columns])

    def inserted(c: str) -> Column:
        fixed = {"as_at_dts": F.col(f"s.{ts}"), "is_after_image": F.lit(True)}
        return fixed[c] if c in fixed else F.col(f"s.{c}")

    def after(c: str) -> Column:
        return inserted(c) if c in {*update, "load_type", "as_at_dts"} else F.col(f"t.{c}")

    def before(c: str) -> Column:
        fixed = {"as_at_dts": F.col(f"s.{ts}"), "is_after_image": F.lit(False)}
        if c in fixed:
            return fixed[c]
        return -F.col(f"t.{c}") if c in additive else F.col(f"t.{c}")

    rows = F.when(F.col("t._t").isNull(), F.array(row(inserted))).otherwise(F.array(row(before), row(after)))
    return joined.select(F.inline(rows))


def reverse_balance(
    fact: DataFrame,
    landed: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    additive: Sequence[str],
    order_key: str = "sales_order_id",
    ts: str = "load_ts",
) -> DataFrame:
    """The fact after the newest load: all its rows, and those the load adds."""
    return fact.unionByName(rb_new_rows(fact, landed, keys, update, additive, order_key, ts))


def rb_rows(fact: DataFrame, where: Column, order_by: Sequence[str] = ()) -> DataFrame:
    """Rows of the fact under a condition, sorted when asked."""
    rows = fact.filter(where)
    return rows.orderBy(*order_by) if order_by else rows
