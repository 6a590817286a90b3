"""Joins on a key that may hold a large part of all rows.

Adaptive execution splits a skewed join partition only where both sides come straight from a
shuffle. Where one side is an aggregate or a window over the join key, as in the operators that
use this module, it does not; there the hot keys are split by hand.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

HOT_ROWS = 1_000_000


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """Keys with more than `hot_rows` rows, and into how many parts of that size each falls.

    Only the key columns are read, and keys are counted on the map side first. There are at most
    (rows of the table) / `hot_rows` hot keys, which is what makes them safe to broadcast.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows)
    return counted.select(*keys, F.ceil(F.col("_n") / hot_rows).alias("_parts"))


def copies(right: DataFrame, hot: DataFrame, on: Sequence[str]) -> DataFrame:
    """The rows of a join's other side with their part in `_salt`: of a hot key a copy for each part."""
    last = F.coalesce(F.col("_parts"), F.lit(1)) - 1
    parts = F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("_salt")
    return right.join(F.broadcast(hot), list(on), "left").select(*right.columns, parts)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    counted: DataFrame | None = None,
    hot_rows: int | None = None,
    large: bool = False,
    deal: Sequence[str] | None = None,
) -> DataFrame:
    """Join a table that may have hot keys to a side with few rows per key.

    Rows of a hot key are dealt into parts by a hash of the row, and the other side's rows of that
    key are repeated once per part; all other keys join as they are. `how` is inner, left,
    left_semi or left_anti. The hot keys are those of `counted` (default `left`), which has the
    key columns and at least the rows of `left` per key. With `large` neither side is broadcast.
    With `deal` the parts follow from these columns alone, and the part stays as `_salt`: a window over
    `on`, `_salt` and them works in the exchange of this join.
    """
    on = list(on)
    # a NULL key meets nothing: its rows are dealt over all parts by themselves
    known = F.lit(True)
    for c in on:
        known = known & F.col(c).isNotNull()
    hot = hot_keys(left if counted is None else counted, on, hot_rows or HOT_ROWS)
    # a VARIANT cannot be hashed; the hash of the rest is the same when a lost task runs again
    hashed = list(deal) if deal else [c for c, kind in left.dtypes if "variant" not in kind]
    turn = F.xxhash64(*hashed)
    dealt = F.when(known, F.coalesce(F.pmod(turn, F.col("_parts")), F.lit(0))).otherwise(turn)
    dealt_left = left.join(F.broadcast(hot), on, "left").select(*left.columns, dealt.alias("_salt"))
    other = copies(right, hot, on)
    joined = dealt_left.join(other.hint("merge") if large else other, [*on, "_salt"], how)
    return joined if deal else joined.drop("_salt")
