"""Columns that are derived on read, defaults, and updates by rule."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F


def with_computed(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add columns whose value is an expression over the stored ones; nothing is stored."""
    return df.withColumns(dict(columns))


def with_defaults(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Fill the columns that the input does not give; a NULL that it gives stays NULL."""
    return df.withColumns({name: value for name, value in defaults.items() if name not in df.columns})


def update_where(df: DataFrame, sets: Mapping[str, Column], cond: Column | None = None) -> DataFrame:
    """Set columns on all rows, or on the rows for which `cond` is true."""
    types = dict(zip(df.columns, (f.dataType for f in df.schema.fields)))
    changed = {}
    for name, value in sets.items():
        new = value if cond is None else F.when(cond, value).otherwise(F.col(name))
        changed[name] = new.cast(types[name]) if name in types else new
    return df.withColumns(changed)
