"""Lookups from a fact to a dimension."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F


def lookup_join(fact: DataFrame, dim: DataFrame, on: str, cols: Mapping[str, str], rely: bool = False) -> DataFrame:
    """The fact's rows with dimension columns, `{dimension column: output name}`.

    Every matching row of the fact is kept; no deduplication. When no dimension column is
    taken and `rely` says that the keys hold (unique in the dimension, every non-null key of
    the fact present), the join can neither add nor drop rows beyond those without a key, so
    it is left out.
    """
    if not cols and rely:
        return fact.filter(F.col(on).isNotNull())
    picked = dim.select(F.col(on), *[F.col(c).alias(out) for c, out in cols.items()])
    return fact.join(picked, on, "inner").select(*[fact[c] for c in fact.columns], *cols.values())


def point_lookup(df: DataFrame, col: str, value) -> DataFrame:
    """Rows with one key value; the literal is cast to the column's type and pushed to the scan."""
    return df.filter(F.col(col) == F.lit(value).cast(df.schema[col].dataType))
