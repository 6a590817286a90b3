"""Loyalty ranking: order totals, tiers by dense rank, and the combined customer set."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.sources.contracts import MODEL

# Highest rank of each tier, and the location left out.
TIERS = [(20, "gold"), (100, "silver"), (400, "bronze")]
EXCLUDED_LOCATION = 22


def customer_totals(customer: DataFrame, sales_order: DataFrame) -> DataFrame:
    """Order total per customer with a positive balance outside the excluded location.

    Orders are summed per customer before the join: the map-side sums shrink a customer with
    many orders to one row per task, and the join meets one row per customer.
    """
    totals = sales_order.groupBy("customer_id").agg(F.sum("total_price_usd").alias("total_price_usd"))
    eligible = customer.filter(
        (F.col("account_balance_usd") > 0) & (F.col("location_id") != EXCLUDED_LOCATION)
    ).select("customer_id")
    return totals.join(eligible, "customer_id").select("customer_id", "total_price_usd")


def _band(rank: Column, bands: Sequence[tuple[int, str]]) -> Column:
    label = F.lit(None).cast("string")
    for upper, name in sorted(bands, reverse=True):
        label = F.when(rank <= upper, name).otherwise(label)
    return label


def top_by_dense_rank(df: DataFrame, col: str, n: int, bands: Sequence[tuple[int, str]]) -> DataFrame:
    """Rows with the n highest values of `col`, with their dense rank and band.

    The n highest distinct values are found by a top-n over distinct values; ranking them is
    work on at most n rows, and joining them back is a broadcast of at most n rows. Ties of
    any number stay spread over the partitions where they are.
    """
    top = df.select(col).filter(F.col(col).isNotNull()).distinct().orderBy(F.desc(col)).limit(n)
    ranked = top.withColumn("cust_level", F.dense_rank().over(Window.orderBy(F.desc(col))))
    return df.join(F.broadcast(ranked), col).select(
        *df.columns, "cust_level", _band(F.col("cust_level"), bands).alias("loyalty_level")
    )


def top_customers(totals: DataFrame) -> DataFrame:
    return top_by_dense_rank(totals, "total_price_usd", TIERS[-1][0], TIERS)


def combine_loyalty(top: DataFrame, supporters: DataFrame) -> DataFrame:
    """Ranked customers and early supporters; a customer in both sets appears twice."""
    ranked = top.select("customer_id", F.col("loyalty_level").alias("level"), F.lit("top 400").alias("type"))
    early = supporters.select("customer_id", F.lit("gold").alias("level"), F.lit("early supporter").alias("type"))
    return ranked.unionByName(early).select(
        "customer_id",
        "level",
        "type",
        F.lit(0).cast("bigint").alias("points_amount"),
        F.lit("").alias("comments"),
    )


def loyalty_customer(customer: DataFrame, sales_order: DataFrame, supporters: DataFrame) -> DataFrame:
    return combine_loyalty(top_customers(customer_totals(customer, sales_order)), supporters)


def _typed_text(name: str, table: str) -> str:
    """SELECT of a model table's columns from its stored table."""
    columns = ", ".join(f"CAST({f.source} AS {f.type}) AS {f.name}" for f in MODEL[name].fields)
    return f"SELECT {columns} FROM {table}"


def register_loyalty_view(spark: SparkSession, customer_path: str, orders_path: str, supporters: Sequence[int], name: str) -> None:
    """The same rows as a view: SQL text over catalogue tables on the two folders.

    The tables are external, so files belong to the folders and stay when a table is registered anew.
    A view is worked out when it is read; `loyalty_view` reads it over the files of that moment.
    """
    for table, path in ((f"{name}_customer", customer_path), (f"{name}_orders", orders_path)):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.catalog.createTable(table, path, source="parquet")
    n = TIERS[-1][0]
    tier = " ".join(f"WHEN cust_level <= {upper} THEN '{label}'" for upper, label in sorted(TIERS))
    early = ", ".join(f"({int(i)})" for i in supporters)
    spark.sql(f"""
        CREATE OR REPLACE VIEW {name} AS
        WITH customer AS ({_typed_text("customer", f"{name}_customer")}),
             sales_order AS ({_typed_text("sales_order", f"{name}_orders")}),
             summed AS (SELECT customer_id, sum(total_price_usd) AS total FROM sales_order GROUP BY customer_id),
             totals AS (SELECT customer_id, total FROM summed WHERE customer_id IN (
                            SELECT customer_id FROM customer WHERE account_balance_usd > 0 AND location_id <> {EXCLUDED_LOCATION})),
             top AS (SELECT DISTINCT total FROM totals WHERE total IS NOT NULL ORDER BY total DESC LIMIT {n}),
             levels AS (SELECT total, dense_rank() OVER (ORDER BY total DESC) AS cust_level FROM top),
             ranked AS (SELECT customer_id, CASE {tier} END AS level, 'top {n}' AS type FROM totals JOIN levels USING (total))
        SELECT customer_id, level, type, CAST(0 AS BIGINT) AS points_amount, '' AS comments
        FROM (SELECT * FROM ranked
              UNION ALL SELECT CAST(id AS BIGINT), 'gold', 'early supporter' FROM VALUES {early} AS early(id))
    """)


def loyalty_view(spark: SparkSession, name: str) -> DataFrame:
    """The registered view, over the files that its folders hold now, whoever wrote them."""
    for table in (f"{name}_customer", f"{name}_orders"):
        spark.catalog.refreshTable(table)
    return spark.table(name)
