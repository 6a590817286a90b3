"""Row sets that are written in the code and joined to tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Two-letter country code per nation key, 0 to 24.
ISO_CODES = [
    (0, "AL"), (1, "AR"), (2, "BR"), (3, "CA"), (4, "EG"),
    (5, "ET"), (6, "FR"), (7, "DE"), (8, "IN"), (9, "ID"),
    (10, "IR"), (11, "IQ"), (12, "JP"), (13, "JO"), (14, "KE"),
    (15, "MA"), (16, "MZ"), (17, "PE"), (18, "CN"), (19, "RO"),
    (20, "SA"), (21, "VN"), (22, "RU"), (23, "GB"), (24, "US"),
]


def values(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """An inline row set; Spark plans it as a local relation of known, small size."""
    return spark.createDataFrame(list(rows), schema)


def iso_codes(spark: SparkSession) -> DataFrame:
    return values(spark, ISO_CODES, "location_id bigint, iso2_code string")
