"""Structured Streaming forms of the loyalty ranking, the type 2 dimension and the vault load.

Each is a file stream with a checkpoint, run until all landed files are read. What a batch
writes goes to a folder named after the batch, and a batch reads only what earlier batches
wrote; so a batch that is repeated after a failure writes the same rows again.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.ranking import EXCLUDED_LOCATION, TIERS, combine_loyalty, top_customers
from tidemark.operators.scd import VERSIONS, scd2_loads
from tidemark.operators.snapshot import all_versions, last_version, read_version, write_version
from tidemark.operators.vault import load_hub, load_link, load_sat
from tidemark.sources.landing import union_all


def read_files(spark: SparkSession, folder: str, schema, pattern: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """A stream of the Parquet files in a folder, oldest first."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def _run(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _merged_list(listed: DataFrame, changed: DataFrame, floor) -> DataFrame:
    """The totals of the list after a batch: changed ones instead of their old values, from the floor up."""
    kept = listed.join(changed, "customer_id", "left_anti").unionByName(changed.select(*listed.columns))
    return kept if floor is None else kept.filter(F.col("total_price_usd") >= F.lit(floor))


def loyalty_stream(orders: DataFrame, customer: DataFrame, supporters: DataFrame, root: str, n: int = TIERS[-1][0]) -> DataFrame:
    """Totals per customer kept as stream state; each batch repairs the ranking from the totals it changed.

    Written for each batch: the totals that it changed, the list of all customers with a total
    from some floor up (the 2n highest distinct totals when it was made), and the ranking. A batch reads its
    own changed totals and the list before it. Since everybody outside the list is below the floor, the list
    gives the n highest as long as it has n distinct totals; when totals that fell or met leave fewer, it is
    made anew from the newest total of every customer. Returns the last ranking written.
    """
    spark = customer.sparkSession
    totals = orders.groupBy("customer_id").agg(F.sum("total_price_usd").alias("total_price_usd"))
    eligible = customer.filter(f"account_balance_usd > 0 and location_id <> {EXCLUDED_LOCATION}").select("customer_id")
    columns = ["customer_id", "total_price_usd"]

    def highest(df: DataFrame, k: int) -> list:
        """The k highest distinct totals."""
        distinct = df.select("total_price_usd").filter("total_price_usd is not null").distinct()
        return [r[0] for r in distinct.orderBy(F.desc("total_price_usd")).limit(k).collect()]

    def each(batch: DataFrame, batch_id: int) -> None:
        write_version(batch.join(eligible, "customer_id", "left_semi").select(*columns), f"{root}/totals", batch_id)
        changed = read_version(spark, f"{root}/totals", batch_id)
        if batch_id == 0:
            floor, listed = None, changed
        else:
            before = read_version(spark, f"{root}/list", batch_id - 1)
            row = before.select("floor").first()
            floor = row[0] if row else None
            listed = _merged_list(before.select(*columns), changed, floor)
        top = highest(listed, 2 * n + 1)
        if floor is not None and len(top) < n:
            written = all_versions(spark, f"{root}/totals").filter(F.col("version") <= batch_id)
            listed = written.groupBy("customer_id").agg(F.max_by("total_price_usd", "version").alias("total_price_usd"))
            floor, top = None, highest(listed, 2 * n + 1)
        if len(top) > 2 * n:
            floor = top[2 * n - 1]
            listed = listed.filter(F.col("total_price_usd") >= F.lit(floor))
        kind = listed.schema["total_price_usd"].dataType
        write_version(listed.withColumn("floor", F.lit(floor).cast(kind)), f"{root}/list", batch_id)
        newest = read_version(spark, f"{root}/list", batch_id).select(*columns)
        write_version(combine_loyalty(top_customers(newest), supporters), f"{root}/loyalty", batch_id)

    _run(totals, each, f"{root}/checkpoint", mode="update")
    return read_version(spark, f"{root}/loyalty", last_version(spark, f"{root}/loyalty"))


def scd2_stream(landed: DataFrame, dim: DataFrame, keys: Sequence[str], tracked: Sequence[str], root: str) -> DataFrame:
    """Apply the loads of a landing stream to a type 2 dimension, in load order.

    Batch n starts from the open versions that batch n - 1 wrote (batch 0 from those of `dim`)
    and writes the open versions and the ones it closed, each to a partition of its own. So closed versions
    are written once and read once, and open ones are read from the last batch only,
    whatever the number of batches. The load stamps of a batch are few (one per landed load) and
    are the only thing collected.
    """
    spark, path = dim.sparkSession, f"{root}/dim"
    schema = T.StructType([*dim.schema.fields, T.StructField("version", T.IntegerType()), T.StructField("is_open", T.BooleanType())])

    def written(where: Column) -> DataFrame:
        return spark.read.schema(schema).parquet(path).filter(where).select(*dim.columns)

    def open_of(version: int) -> DataFrame:
        return written(F.col("is_open") & (F.col("version") == version))

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        current = VERSIONS.current(dim) if batch_id == 0 else open_of(batch_id - 1)
        loads = [r["load"] for r in batch.select(F.col("load_ts").cast("string").alias("load")).distinct().collect()]
        batches = [batch.filter(F.col("load_ts") == F.lit(load).cast("timestamp_ntz")) for load in sorted(loads)]
        rows = scd2_loads(current, batches, keys, tracked)
        marked = rows.withColumn("is_open", F.col(VERSIONS.to_col) == VERSIONS.open_value())
        marked.write.mode("overwrite").partitionBy("is_open").parquet(f"{path}/version={batch_id}")
        batch.unpersist()

    _run(landed, each, f"{root}/checkpoint")
    return union_all([VERSIONS.closed(dim), written(~F.col("is_open")), open_of(last_version(spark, path))])


def _table_before(spark: SparkSession, root: str, schema: str, batch_id: int) -> DataFrame:
    rows = spark.read.schema(f"{schema}, batch bigint").parquet(root)
    return rows.filter(F.col("batch") < batch_id).drop("batch")


def append_stream(
    stream: DataFrame, schemas: Mapping[str, str], root: str, additions: Callable[[dict[str, DataFrame], DataFrame], dict[str, DataFrame]]
) -> None:
    """Feed several insert-only tables from one stream.

    Every batch is read once and kept while its tables are written one after the other, in the
    order in which `additions` names them.
    """
    spark = stream.sparkSession
    for name, schema in schemas.items():
        empty = spark.createDataFrame([], schema)
        empty.write.mode("ignore").parquet(f"{root}/{name}/batch=-1")

    def each(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        state = {n: _table_before(spark, f"{root}/{n}", s, batch_id) for n, s in schemas.items()}
        for name, rows in additions(state, batch).items():
            rows.write.mode("overwrite").parquet(f"{root}/{name}/batch={batch_id}")
        batch.unpersist()

    _run(stream, each, f"{root}/checkpoint-{'-'.join(schemas)}")


def read_appended(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, batch bigint").parquet(f"{root}/{name}").drop("batch")


def customer_additions(attributes: Sequence[str]):
    def additions(state: dict[str, DataFrame], batch: DataFrame) -> dict[str, DataFrame]:
        return {
            "hub_customer": load_hub(state["hub_customer"], batch, "hub_customer_hk", "customer_id"),
            "sat_sys1_customer": load_sat(
                state["sat_sys1_customer"], batch, "hub_customer_hk", "customer_hash_diff", attributes
            ),
        }

    return additions


def order_additions(attributes: Sequence[str]):
    def additions(state: dict[str, DataFrame], batch: DataFrame) -> dict[str, DataFrame]:
        return {
            "hub_order": load_hub(state["hub_order"], batch, "hub_order_hk", "sales_order_id"),
            "lnk_customer_order": load_link(
                state["lnk_customer_order"], batch, "lnk_customer_order_hk", ["hub_customer_hk", "hub_order_hk"]
            ),
            "sat_sys1_order": load_sat(
                state["sat_sys1_order"], batch, "hub_order_hk", "order_hash_diff", attributes
            ),
        }

    return additions
