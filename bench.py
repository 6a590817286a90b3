"""Time the headline queries; prints one JSON line.

Reads BENCH_SF_DIR (default sf0.1), BENCH_CPUS (default 8) and BENCH_QUERIES (`all`, or names
separated by commas). Every query runs to the end into Spark's `noop` sink, so nothing is pruned
by a count. Staged tables are forgotten before each query: a time holds all the work the query
needs, the landing areas included.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tidemark.plans.catalog import QUERIES
from tidemark.plans.scenario import forget_staged
from tidemark.session import build_session

HEADLINE = [
    "model_line_item",
    "fk_references",
    "order_customer_fanout",
    "loyalty_customer",
    "whole_orders",
    "orders_with_deletions",
    "merge_upsert",
    "change_feed",
    "scd1",
    "scd2",
    "scd2_multi_batch",
    "scd3",
    "detect_deletions",
    "rb_merge_after",
    "reverse_balance",
    "employee_daily",
    "type2_fact_load",
    "t2_five_days",
    "cohort_promoted",
    "json_extract",
    "flatten_nested",
    "flatten_recursive",
    "json_depth",
    "shred_bridge",
    "surrogate_key",
    "hierarchy_path",
    "hierarchy_edges",
    "vault_hash_order",
    "satellite_load",
    "vault_incremental",
    "snapshot_before_after",
    "computed_columns",
    "order_nulls_desc",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else (wanted.split(",") if wanted else HEADLINE)

    spark = build_session(
        "tidemark-bench",
        master=f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/orders.parquet").groupBy("o_orderstatus").count().collect()

    seconds: dict[str, float] = {}
    for name in names:
        forget_staged()
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
