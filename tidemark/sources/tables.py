"""Model tables read from Parquet: each column is renamed and cast by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators.numbering import number_within
from tidemark.sources.contracts import MODEL


def source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def typed(rows: DataFrame, name: str) -> DataFrame:
    """Rename and cast the columns of a source, batch or stream, to those of a model table."""
    return rows.select(*[F.col(f.source).cast(f.type).alias(f.name) for f in MODEL[name].fields])


def model(spark: SparkSession, folder: str, name: str, scan: Column | None = None) -> DataFrame:
    """One model table. The casts sit on the scan, so unused columns are never read.

    `scan` is a condition on the source's own columns. A condition on a cast column does not
    reach the Parquet reader; one on the stored column does.
    """
    rows = source(spark, folder, MODEL[name].source)
    rows = typed(rows if scan is None else rows.filter(scan), name)
    if name == "inventory":
        return rows.distinct()
    if name == "line_item":
        return _line_items(rows)
    return rows


def lines_beside(spark: SparkSession, folder: str, orders: DataFrame) -> DataFrame:
    """The line items, each with the columns of `orders` for its order; it has one row per order key, or equal ones."""
    return _line_items(typed(source(spark, folder, MODEL["line_item"].source), "line_item"), orders)


def _line_items(rows: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Lines renumbered within their order, with the dates that follow from the ship date.

    The source repeats line numbers within an order, so the declared key needs new ones.
    """
    numbered = number_within(
        rows.withColumnRenamed("line_number", "source_line"),
        keys=["sales_order_id"],
        order=["source_line", "part_id", "supplier_id", "quantity", "extended_price_usd", "ship_date"],
        blocks=[F.col("source_line"), F.shiftright("part_id", 12)],
        out="line_number",
        beside=orders,
    )
    return numbered.select(
        "line_number",
        "sales_order_id",
        "part_id",
        "supplier_id",
        "quantity",
        "extended_price_usd",
        "discount_percent",
        "tax_percent",
        "return_flag",
        "line_status",
        "ship_date",
        F.date_add("ship_date", 7).alias("commit_date"),
        F.date_add("ship_date", 3).alias("receipt_date"),
        *([] if orders is None else [c for c in orders.columns if c != "sales_order_id"]),
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    result = counted[0]
    for one in counted[1:]:
        result = result.unionByName(one)
    return result
