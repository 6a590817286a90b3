"""Sorting with a stated place for NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def sort_key(name: str, nulls: str = "high") -> Column:
    """A sort column for `name`, or for `-name` descending.

    `nulls='high'` counts NULL as greater than every value (last when ascending, first when
    descending); `'first'` and `'last'` place it whatever the direction.
    """
    descending = name.startswith("-")
    column = F.col(name.lstrip("-"))
    if nulls not in ("high", "first", "last"):
        raise ValueError(f"unknown null placement: {nulls}")
    first = nulls == "first" or (nulls == "high" and descending)
    if descending:
        return column.desc_nulls_first() if first else column.desc_nulls_last()
    return column.asc_nulls_first() if first else column.asc_nulls_last()


def order_by(df: DataFrame, *names: str, nulls: str = "high") -> DataFrame:
    """Sort by several columns, `-name` for descending, with one rule for NULL.

    Rows that are equal in all of them sort in one task, so end the list with a key where the
    other columns have few values.
    """
    return df.orderBy(*[sort_key(n, nulls) for n in names])
