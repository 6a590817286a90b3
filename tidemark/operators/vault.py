"""Data Vault: staging with hash keys; hubs, links and satellites loaded by insert only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.hashing import vault_hash
from tidemark.operators.merge import without
from tidemark.session import few_rows, stage

# The attributes in each record hash, in order.
CUSTOMER_ATTRIBUTES = ["name", "iso2_code", "account_balance_usd", "market_segment"]
ORDER_ATTRIBUTES = ["order_status", "total_price_usd", "order_date", "order_priority"]


def src_nation(location: DataFrame, codes: DataFrame, load_ts: Column, rec_src: str) -> DataFrame:
    """Locations with their country code, load time and record source."""
    return location.join(codes, "location_id", "inner").select(
        "location_id", "iso2_code", "name", "region_id", load_ts.alias("load_ts"), F.lit(rec_src).alias("rec_src")
    )


def land_vault_customers(customer: DataFrame, nation: DataFrame, load_ts: Column, rec_src: str) -> DataFrame:
    codes = nation.select("location_id", "iso2_code")
    return customer.join(codes, "location_id", "inner").select(
        "customer_id",
        "name",
        "iso2_code",
        "account_balance_usd",
        "market_segment",
        load_ts.alias("load_ts"),
        F.lit(rec_src).alias("rec_src"),
    )


def land_vault_orders(sales_order: DataFrame, customers: DataFrame, load_ts: Column, rec_src: str) -> DataFrame:
    """All orders of the customers of a load."""
    return sales_order.join(customers.select("customer_id"), "customer_id", "left_semi").select(
        "sales_order_id",
        "customer_id",
        "order_status",
        "total_price_usd",
        "order_date",
        "order_priority",
        load_ts.alias("load_ts"),
        F.lit(rec_src).alias("rec_src"),
    )


def load_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Loads and rows per landing table; counted per load first, so the rows do not travel."""
    report = None
    for name, df in tables.items():
        one = (
            df.groupBy("load_ts")
            .agg(F.count(F.lit(1)).alias("n"))
            .agg(F.count("load_ts").alias("loads"), F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"))
            .select(F.lit(name).alias("tbl"), "loads", "row_count")
        )
        report = one if report is None else report.unionByName(one)
    return report


def stage_customer(rows: DataFrame) -> DataFrame:
    """Hub key and record hash of each landed customer."""
    return rows.withColumns(
        {"hub_customer_hk": vault_hash("customer_id"), "customer_hash_diff": vault_hash(*CUSTOMER_ATTRIBUTES)}
    )


def stage_order(rows: DataFrame) -> DataFrame:
    """Hub keys, link key and record hash of each landed order."""
    return rows.withColumns(
        {
            "hub_order_hk": vault_hash("sales_order_id"),
            "hub_customer_hk": vault_hash("customer_id"),
            "lnk_customer_order_hk": vault_hash("sales_order_id", "customer_id"),
            "order_hash_diff": vault_hash(*ORDER_ATTRIBUTES),
        }
    )


def _earliest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: that of the earliest load, then the least of the rest."""
    others = ["load_ts", *[c for c in rows.columns if c not in keys and c != "load_ts"]]
    least = F.min(F.struct(*others)).alias("_least")
    return rows.groupBy(*keys).agg(least).select(*[c if c in keys else f"_least.{c}" for c in rows.columns])


def _fresh(rows: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The earliest row of each key that the target does not hold; a key with a NULL is never held.

    Few rows look for their keys in the target, which stays where it is. Many rows meet the target's keys in
    the aggregate that finds the earliest one, so both travel once and nothing is broadcast.
    """
    if few_rows(rows):
        return _earliest(without(rows, target, keys), keys)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    others = ["load_ts", *[c for c in rows.columns if c not in keys and c != "load_ts"]]
    held = target.filter(known).select(*keys)
    met = rows.select(*keys, F.struct(*others).alias("_row")).unionByName(held, allowMissingColumns=True)
    least = met.groupBy(*keys).agg(F.min("_row").alias("_least"), F.bool_or(F.col("_row").isNull()).alias("_held"))
    return least.filter("not _held").select(*[c if c in keys else f"_least.{c}" for c in rows.columns])


def load_hub(hub: DataFrame, staged: DataFrame, hk: str, bk: str) -> DataFrame:
    """New business keys of a batch: the rows to append to the hub.

    A batch with several rows of a key gives one, of the earliest load.
    """
    return _fresh(staged.select(hk, bk, "load_ts", "rec_src"), hub, [hk]).select(*hub.columns)


def load_sat(
    sat: DataFrame, staged: DataFrame, hk: str, hash_col: str, attributes: Sequence[str], compare: str = "any"
) -> DataFrame:
    """The rows to append to a satellite.

    `any`: a row is new when its key and hash are nowhere in the satellite's history.
    `latest`: a row is new when its hash differs from the key's newest one, so a value that
    comes back is stored again. Several loads in a batch are compared in their order.
    """
    rows = staged.select(hk, "load_ts", *attributes, F.col(hash_col).alias("hash_diff"), "rec_src")
    if compare == "any":
        fresh = _fresh(rows, sat, [hk, "hash_diff"])
    elif compare == "latest":
        rows = _earliest(rows, [hk, "hash_diff", "load_ts"])
        touched = sat.join(rows.select(hk), hk, "left_semi")
        newest = touched.groupBy(hk).agg(F.max_by("hash_diff", "load_ts").alias("_stored"))
        before = F.lag("hash_diff").over(Window.partitionBy(hk).orderBy("load_ts", "hash_diff"))
        compared = rows.withColumn("_before", before).join(newest, hk, "left")
        last = F.coalesce("_before", "_stored")
        fresh = compared.filter(last.isNull() | (last != F.col("hash_diff")))
    else:
        raise ValueError(f"unknown comparison: {compare}")
    return fresh.select(*sat.columns)


def load_link(link: DataFrame, staged: DataFrame, lk: str, hks: Sequence[str]) -> DataFrame:
    """New key pairs of a batch: the rows to append to the link."""
    return _fresh(staged.select(lk, *hks, "load_ts", "rec_src"), link, [lk]).select(*link.columns)


def load_ref(src: DataFrame) -> DataFrame:
    """A reference table, copied from the landing area."""
    return src.select("iso2_code", "location_id", "name", "region_id", "load_ts", "rec_src")


VAULT_SCHEMAS = {
    "hub_customer": "hub_customer_hk binary, customer_id bigint, load_ts timestamp_ntz, rec_src string",
    "hub_order": "hub_order_hk binary, sales_order_id bigint, load_ts timestamp_ntz, rec_src string",
    "sat_sys1_customer": (
        "hub_customer_hk binary, load_ts timestamp_ntz, name string, iso2_code string, "
        "account_balance_usd decimal(12,2), market_segment string, hash_diff binary, rec_src string"
    ),
    "sat_sys1_order": (
        "hub_order_hk binary, load_ts timestamp_ntz, order_status string, total_price_usd decimal(12,2), "
        "order_date date, order_priority string, hash_diff binary, rec_src string"
    ),
    "lnk_customer_order": (
        "lnk_customer_order_hk binary, hub_customer_hk binary, hub_order_hk binary, "
        "load_ts timestamp_ntz, rec_src string"
    ),
}


@dataclass(frozen=True)
class Vault:
    hub_customer: DataFrame
    hub_order: DataFrame
    sat_sys1_customer: DataFrame
    sat_sys1_order: DataFrame
    lnk_customer_order: DataFrame
    ref_nation: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return dict(vars(self))


def empty_vault(ref_nation: DataFrame) -> Vault:
    spark = ref_nation.sparkSession
    tables = {name: spark.createDataFrame([], schema) for name, schema in VAULT_SCHEMAS.items()}
    return Vault(**tables, ref_nation=ref_nation)


@dataclass(frozen=True)
class Target:
    """A table that a batch feeds: its key columns, and which batch column each column comes from if not its own name."""

    table: DataFrame
    keys: Sequence[str]
    source: Mapping[str, str]

    def column(self, name: str) -> str:
        return self.source.get(name, name)


def insert_absent(batch: DataFrame, targets: Mapping[str, Target]) -> dict[str, DataFrame]:
    """What a batch adds to several insert-only tables.

    Each target takes its own columns of the batch, a written table, and only those travel. The rows
    that a target lacks are reduced to the earliest of a key and written, one table per target.
    A key with a NULL is never held; rows of such a key are one row, as of any other key.
    """
    types = {f.name: f.dataType for t in targets.values() for f in t.table.schema.fields}
    added = {}
    for name, target in targets.items():
        held = {f.name for f in target.table.schema.fields}
        rows = batch.select(*[F.col(target.column(c)).cast(kind).alias(c) for c, kind in types.items() if c in held])
        added[name] = stage(_fresh(rows, target.table, target.keys), f"additions-{name}").select(*target.table.columns)
    return added


def vault_additions(state: Vault, customers: DataFrame, orders: DataFrame) -> dict[str, DataFrame]:
    """The rows that one staged batch adds to each target.

    Every test reads `state` as it was before the batch, and the rows are written before any target
    takes them, so a run that failed half-way can be repeated.
    """
    by_customer = {
        "hub_customer": Target(state.hub_customer, ["hub_customer_hk"], {}),
        "sat_sys1_customer": Target(state.sat_sys1_customer, ["hub_customer_hk", "hash_diff"], {"hash_diff": "customer_hash_diff"}),
    }
    by_order = {
        "hub_order": Target(state.hub_order, ["hub_order_hk"], {}),
        "lnk_customer_order": Target(state.lnk_customer_order, ["lnk_customer_order_hk"], {}),
        "sat_sys1_order": Target(state.sat_sys1_order, ["hub_order_hk", "hash_diff"], {"hash_diff": "order_hash_diff"}),
    }
    return {**insert_absent(customers, by_customer), **insert_absent(orders, by_order)}


def load_vault(state: Vault, customers: DataFrame, orders: DataFrame) -> Vault:
    """The vault after one staged batch."""
    added = vault_additions(state, customers, orders)
    return replace(state, **{name: getattr(state, name).unionByName(rows) for name, rows in added.items()})


def run_loads(state: Vault, loads: Sequence[tuple[DataFrame, DataFrame]]) -> Vault:
    """Several staged batches one after the other; what each adds is written before the next.

    A load reads its batch and the keys of the targets, and writes new rows only.
    """
    for customers, orders in loads:
        state = load_vault(state, customers, orders)
    return state


def vault_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per vault table."""
    report = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(name).alias("src"), "cnt")
        report = one if report is None else report.unionByName(one)
    return report
