"""Row numbers and surrogate keys that never send a whole table or a hot group to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators import skew
from tidemark.session import stage


def number_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    blocks: Sequence[Column],
    out: str,
    hot_rows: int | None = None,
    beside: DataFrame | None = None,
) -> DataFrame:
    """Number the rows of each key, 1 to n in `order`.

    A key with more than `hot_rows` rows is numbered block by block: `blocks` are columns whose
    order agrees with `order` (its leading columns, or a coarser form of them), the blocks are dealt
    over several tasks, and the sizes of the blocks before one are added. All other keys
    share the plain window, and the table is shuffled once in either case.

    `beside` has the key columns and more; rows get these others, NULL where the key is not in it. Equal
    rows of it count once, and a key may have one row. That join uses the exchange of the numbering.
    """
    keys = list(keys)
    hot = skew.hot_keys(df, keys, hot_rows or skew.HOT_ROWS)
    blocked = df.join(F.broadcast(hot), keys, "left").withColumn("_block", F.when(F.col("_parts").isNotNull(), F.struct(*blocks)))
    blocked = blocked.withColumn("_salt", F.coalesce(F.pmod(F.xxhash64("_block"), F.col("_parts")), F.lit(0)))
    place = [*keys, "_salt"]
    tagged, added = blocked, []
    if beside is not None:
        added = [c for c in beside.columns if c not in keys]
        tagged = blocked.join(skew.copies(beside, hot, keys).distinct(), place, "left")

    in_block = Window.partitionBy(*place, "_block").orderBy(*order)
    numbered = tagged.withColumn("_nth", F.row_number().over(in_block).cast("bigint"))

    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = blocked.filter(F.col("_parts").isNotNull()).groupBy(*place, "_block").agg(F.count(F.lit(1)).alias("_size"))
    offset = F.struct("_block", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before")).alias("_offset")
    # one row per part of a hot key, so that the join needs no other exchange than the numbering
    offsets = sizes.select(*place, offset).groupBy(*place).agg(F.map_from_entries(F.collect_list("_offset")).alias("_offsets"))
    return (
        numbered.join(offsets, place, "left")
        .withColumn(out, F.col("_nth") + F.coalesce(F.col("_offsets")[F.col("_block")], F.lit(0)))
        .select(*df.columns, *added, out)
    )


def assign_keys(df: DataFrame, sk: str, order_by: Sequence[str], start: Column | int = 0) -> DataFrame:
    """Give each row the next integer key after `start`, in the order of `order_by`.

    Rows are range-partitioned and sorted inside their partition; the position within the
    partition is written with the row, so a re-run task cannot number it differently. Adding
    the sizes of the earlier partitions needs one row per partition only.
    """
    placed = (
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    placed = stage(placed, f"keys-{sk}")
    sizes = placed.groupBy(F.shiftright("_place", 33).alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))

    base = F.lit(start) if isinstance(start, int) else start
    position = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("_part", F.shiftright("_place", 33))
        .join(F.broadcast(offsets), "_part")
        .select((base + F.col("_before") + position + 1).cast("bigint").alias(sk), *df.columns)
    )
