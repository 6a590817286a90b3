"""Streams in several batches give what the batch operators give, also when a run is resumed."""

import datetime as dt

from rows_of_frames import rows
from pyspark.sql import functions as F

from tidemark.operators import ranking, scd, vault
from tidemark.plans.scenario import Scenario
from tidemark.session import new_folder
from tidemark.sources import tables
from tidemark.streaming import feeds


def test_type_2_stream_one_file_per_batch_and_resumed(spark):
    def load(values, n):
        data = [(k, v, dt.datetime(2020, 1, n)) for k, v in values.items()]
        return spark.createDataFrame(data, "k long, v long, load_ts timestamp_ntz").coalesce(1)

    dim = scd.scd2_initial(load({1: 1, 2: 2}, 1), ["v"])
    loads = [load({1: 5, 3: 3}, 2), load({1: 1, 2: 2}, 3), load({2: 9, 4: 4}, 4)]
    root = new_folder(spark, "test-stream")

    def run():
        stream = feeds.read_files(spark, f"{root}/landed", loads[0].schema, files_per_batch=1)
        return feeds.scd2_stream(stream, dim, ["k"], ["v"], root)

    for rows_ in loads[:2]:
        rows_.write.mode("append").parquet(f"{root}/landed")
    part = rows(run(), *dim.columns)
    assert part == rows(scd.scd2_loads(dim, loads[:2], ["k"], ["v"]), *dim.columns)
    assert rows(run(), *dim.columns) == part
    loads[2].write.mode("append").parquet(f"{root}/landed")
    assert rows(run(), *dim.columns) == rows(scd.scd2_loads(dim, loads, ["k"], ["v"]), *dim.columns)


def test_loyalty_stream_in_several_batches(spark, folder):
    s = Scenario(spark, folder)
    root = new_folder(spark, "test-loyalty")
    s.source("orders").repartition(3, "o_orderkey").write.parquet(f"{root}/orders")
    files = feeds.read_files(spark, f"{root}/orders", s.source("orders").schema, files_per_batch=1)
    streamed = feeds.loyalty_stream(tables.typed(files, "sales_order"), s.model("customer"), s.supporters, root)
    batch = ranking.loyalty_customer(s.model("customer"), s.model("sales_order"), s.supporters)
    assert rows(streamed) == rows(batch)


def test_vault_stream_in_several_batches(spark):
    stamp = {"load_ts": F.lit(dt.datetime(2022, 1, 1)), "rec_src": F.lit("s")}
    data = [(k, f"c{k}", "SE", None, "x") for k in (1, 2, 3, 2, 1)]
    schema = "customer_id long, name string, iso2_code string, account_balance_usd decimal(12,2), market_segment string"
    staged = vault.stage_customer(spark.createDataFrame(data, schema).withColumns(stamp))
    root = new_folder(spark, "test-vault")
    staged.repartition(3).write.parquet(f"{root}/src")
    tables_ = {n: vault.VAULT_SCHEMAS[n] for n in ("hub_customer", "sat_sys1_customer")}
    for _ in range(2):
        stream = feeds.read_files(spark, f"{root}/src", staged.schema, files_per_batch=1)
        feeds.append_stream(stream, tables_, root, feeds.customer_additions(vault.CUSTOMER_ATTRIBUTES))
        for name, table_schema in tables_.items():
            assert feeds.read_appended(spark, root, name, table_schema).count() == 3
