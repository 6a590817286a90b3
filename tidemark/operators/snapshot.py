"""Versions of a table, and what changed between two of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F


def write_version(df: DataFrame, root: str, version: int) -> None:
    """Write a version to its own folder; writing the same version again replaces it."""
    df.write.mode("overwrite").parquet(f"{root}/version={version}")


def read_version(spark: SparkSession, root: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{root}/version={version}")


def all_versions(spark: SparkSession, root: str) -> DataFrame:
    """All versions of a table in one read, with the column `version`."""
    return spark.read.parquet(root)


def last_version(spark: SparkSession, root: str) -> int:
    """The highest version written, by the folder names: a version without rows counts as well."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    names = [f.getPath().getName() for f in found]
    return max(int(name.removeprefix("version=")) for name in names if name.startswith("version="))


def changed_rows(before: DataFrame, after: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct rows of the first state, over `cols`, that the second does not have."""
    return before.select(*cols).subtract(after.select(*cols))


def before_after(before: DataFrame, after: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Changed keys with the old and the new value of each column side by side.

    The key is unique in both states, so one join finds the changes and gives both values.
    """
    old = before.select(key, *[F.col(c).alias(f"{c}_before") for c in cols])
    new = after.select(key, *[F.col(c).alias(f"{c}_now") for c in cols])
    differs = F.lit(False)
    for c in cols:
        differs = differs | ~F.col(f"{c}_before").eqNullSafe(F.col(f"{c}_now"))
    return old.join(new, key, "inner").filter(differs)
