"""Load scenario over the supplied tables.

The operators need landing areas with several loads. Here those loads are derived from the
whole tables by fixed rules: first loads are the rows of an earlier business state (customers
in good standing, orders before a date), later loads are whole tables with some values changed.
Tables that many queries read are staged once per application and folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.computed import update_where
from tidemark.operators import balance, bands, documents, shred, vault
from tidemark.session import few_rows, spread, stage
from tidemark.sources import landing, tables
from tidemark.sources.inline import iso_codes, values

# Fixed values of the scenario.
EARLY_SUPPORTERS = [(1,), (5,), (25,), (50,), (100,)]
LOAD_1 = "1995-12-01 00:00:00"
LOAD_2 = "1995-12-02 00:00:00"
LOAD_3 = "1995-12-03 00:00:00"
FIRST_ORDERS_BEFORE = "1998-04-15"
FIRST_DAY = "2001-07-28"
DAYS = ["2001-07-29", "2001-07-30", "2001-07-31", "2001-08-01", "2001-08-02"]
TRACKED = ["account_balance_usd"]
LINE_KEYS = ["sales_order_id", "line_number"]
LINE_ADDITIVE = ["quantity", "extended_price_usd"]
LINE_UPDATED = [
    "quantity",
    "extended_price_usd",
    "discount_percent",
    "return_flag",
    "ship_date",
    "commit_date",
    "receipt_date",
]
LOAD_NAME = "ad-hoc load"
REC_SRC = "sys 1"

_STAGED: dict[tuple[str, str, str], Any] = {}


def ts(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def day(text: str) -> Column:
    return F.lit(text).cast("date")


def forget_staged() -> None:
    """Have the staged tables built anew, for instance before a timed run."""
    _STAGED.clear()


def run_days(
    source: DataFrame, first_day: str, days: Sequence[str], reviewed: Callable[[Column], Column]
) -> tuple[DataFrame, DataFrame]:
    """The employee landing area and the time-banded fact after several daily loads.

    The first landing is the source by rule, so only the fact made of it is written. Each day reads
    the open bands of the day before and writes its own batch, the open bands and the bands it closed. Closed bands are written once and not touched again, and a day
    that fails is repeated from the day before.
    """
    landed = [bands.land_employees(source, day(first_day))]
    current, closed = stage(bands.t2_fact_initial(landed[0]), "employees-fact"), []
    for text in days:
        today = day(text)
        batch = bands.employee_changes(source, current, today, reviewed(today))
        landed.append(stage(batch, "employees-landed"))
        rows = stage(bands.type2_step(current, landed[-1]), "employees-fact")
        current = bands.current_staff(rows)
        closed.append(bands.DAYS_HELD.closed(rows))
    return landing.union_all(landed), landing.union_all([current, *closed])


def hired_on_this_day_of_month(today: Column) -> Column:
    """The review rule of the scenario: staff is reviewed on the day of month of the hire."""
    return F.dayofmonth("hire_date") == F.dayofmonth(today)


@dataclass(frozen=True)
class Shredded:
    service: DataFrame
    carrier: DataFrame
    party: DataFrame
    party_years: DataFrame
    party_services: DataFrame


class Scenario:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def _once(self, name: str, build: Callable[[], DataFrame], partition_by: str | Sequence[str] | None = None) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _STAGED:
            _STAGED[key] = stage(build(), name, partition_by)
        return _STAGED[key]

    def model(self, name: str, scan: Column | None = None) -> DataFrame:
        return tables.model(self.spark, self.folder, name, scan)

    def source(self, name: str) -> DataFrame:
        return tables.source(self.spark, self.folder, name)

    @property
    def supporters(self) -> DataFrame:
        return values(self.spark, EARLY_SUPPORTERS, "customer_id bigint")

    # Customer loads

    def customer_load_1(self) -> DataFrame:
        """First load: customers in good standing."""
        customer = self.model("customer", scan=F.col("c_acctbal") > 0)
        return landing.land(customer, ts(LOAD_1), where=F.col("account_balance_usd") > 0)

    def customer_load_2(self) -> DataFrame:
        """All customers; balances of one segment moved by an amount that is 0 for one location."""
        moved = F.col("account_balance_usd") + (F.col("location_id") - 9)
        return landing.land_delta(
            self.model("customer"),
            ts(LOAD_2),
            {"account_balance_usd": moved},
            when=F.col("market_segment") == "BUILDING",
        )

    def customer_load_3(self) -> DataFrame:
        """All customers at their source balance, another segment moved by five."""
        return landing.land_delta(
            self.model("customer"),
            ts(LOAD_3),
            {"account_balance_usd": F.col("account_balance_usd") + 5},
            when=F.col("market_segment") == "HOUSEHOLD",
        )

    def src_customer(self) -> DataFrame:
        """Landing area of customers, one partition per load."""
        return self._once(
            "src_customer",
            lambda: landing.union_all([self.customer_load_1(), self.customer_load_2()]),
            partition_by="load_ts",
        )

    def early_orders(self) -> DataFrame:
        return self.model("sales_order", scan=F.col("o_orderdate") < ts(f"{FIRST_ORDERS_BEFORE} 00:00:00"))

    # Line-item loads

    def _tagged_lines(self) -> DataFrame:
        """All lines; `first_load` is true for those of the orders placed before a date, else NULL.

        The mark is joined in the exchange that numbers the lines, so that no load has to find its orders again.
        """
        early = self.early_orders().select("sales_order_id", F.lit(True).alias("first_load"))
        return self._once("line_item", lambda: tables.lines_beside(self.spark, self.folder, early))

    def lines(self) -> DataFrame:
        return self._tagged_lines().drop("first_load")

    def lines_initial(self) -> DataFrame:
        """First load: all lines of the orders placed before a date.

        It follows from the written lines by rule, without an exchange, so no second copy of them is written.
        """
        stamp = F.when(F.col("first_load"), ts(LOAD_1))
        rows = landing.land(self._tagged_lines(), stamp, where=F.col("first_load")).drop("first_load")
        return rows.withColumn("load_type", F.lit("initial"))

    def line_batch(self, with_deletions: bool) -> DataFrame:
        """Second load: the other orders as new ones, the landed orders changed.

        With deletions, lines of landed orders whose number ends in 0, 1 or 2 are missing.
        """
        returned = (F.col("return_flag") == "N") & (bands.last_digit(F.col("part_id")) > 4)
        adjust = {
            "extended_price_usd": F.col("extended_price_usd") + 1000,
            "discount_percent": F.col("discount_percent") + F.lit("0.01").cast("decimal(12,2)"),
            "return_flag": F.when(returned, "R").otherwise(F.col("return_flag")),
            "ship_date": F.date_add("ship_date", 1),
            "commit_date": F.date_add("commit_date", 2),
            "receipt_date": F.date_add("receipt_date", 3),
        }
        keep = bands.last_digit(F.col("line_number")) > 2 if with_deletions else None
        return landing.entity_batch(
            self._tagged_lines(), self.lines_initial(), "sales_order_id", adjust, ts(LOAD_2), keep=keep, known="first_load"
        )

    def src_line_item(self) -> DataFrame:
        """Landing area after the load with deletions; both loads follow from the written lines by rule."""
        return landing.union_all([self.lines_initial(), self.line_batch(with_deletions=True)])

    def line_deletions(self) -> DataFrame:
        landed = self.src_line_item()
        return balance.detect_deletions(landed, balance.load_history(landed))

    def line_batch_3(self) -> DataFrame:
        """Third load: every second order. Lines whose number ends in 2 are back, those ending in 3 are missing."""
        digit = bands.last_digit(F.col("line_number"))
        keep = ~digit.isin(0, 1, 3)
        rows = self.lines().filter((F.col("sales_order_id") % 2 == 0) & keep)
        return landing.land(rows, ts(LOAD_3)).withColumn("load_type", F.lit("update"))

    def src_line_item_3(self) -> DataFrame:
        """Landing area after three loads."""
        third = self._once("line_batch_3", self.line_batch_3, partition_by="load_ts")
        return landing.union_all([self.src_line_item(), third])

    def src_line_item_recovered(self) -> DataFrame:
        """Landing area with the lost lines put back as logical deletions."""
        deletes = self._once(
            "line_deletes",
            lambda: balance.logical_deletes(self.line_deletions(), LINE_ADDITIVE),
            partition_by="load_ts",
        )
        return landing.union_all([self.src_line_item(), deletes])

    def line_fact_initial(self) -> DataFrame:
        return balance.rb_initial(self.lines_initial())

    def line_fact(self) -> DataFrame:
        """Reverse-balance fact after the second load: what the load adds is written beside the rest."""
        first = self.line_fact_initial()
        added = self._once(
            "line_fact_added",
            lambda: balance.rb_new_rows(
                first, self.src_line_item_recovered(), LINE_KEYS, LINE_UPDATED, LINE_ADDITIVE
            ),
            partition_by=balance.FACT_PARTITIONS,
        )
        return landing.union_all([first, added])

    # Employees

    def employees(self) -> DataFrame:
        serial = F.lpad((F.col("customer_id") % 1000).cast("string"), 9, "0")
        return bands.employees(self.model("sales_order"), F.concat(F.lit("Clerk#"), serial))

    def employees_landed(self) -> DataFrame:
        return bands.land_employees(self.employees(), day(FIRST_DAY))

    def employee_batch(self) -> DataFrame:
        """The first day's changes over the first fact."""
        fact = bands.t2_fact_initial(self.employees_landed())
        today = day(DAYS[0])
        return bands.employee_changes(
            self.employees(), bands.current_staff(fact), today, hired_on_this_day_of_month(today)
        )

    def employee_fact(self) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.folder, "employee_fact")
        if key not in _STAGED:
            _, _STAGED[key] = run_days(self.employees(), FIRST_DAY, DAYS, hired_on_this_day_of_month)
        return _STAGED[key]

    # Vault

    def vault_nation(self) -> DataFrame:
        return vault.src_nation(self.model("location"), iso_codes(self.spark), ts(LOAD_1), REC_SRC)

    def vault_load(self, number: int) -> tuple[DataFrame, DataFrame]:
        """Landed customers of a load, with all their orders."""
        load = {1: LOAD_1, 2: LOAD_2}[number]
        rows = self.customer_load_1() if number == 1 else self.customer_load_2()
        customers = vault.land_vault_customers(rows.drop("load_ts"), self.vault_nation(), ts(load), REC_SRC)
        orders = vault.land_vault_orders(self.model("sales_order"), customers, ts(load), REC_SRC)
        return customers, orders

    def vault_staged(self, number: int) -> tuple[DataFrame, DataFrame]:
        customers, orders = self.vault_load(number)
        return (
            self._once(f"vault-customers-{number}", lambda: vault.stage_customer(customers)),
            self._once(f"vault-orders-{number}", lambda: vault.stage_order(orders)),
        )

    def vault_after(self, loads: int) -> vault.Vault:
        """The vault after the first load, or after both."""
        key = (self.spark.sparkContext.applicationId, self.folder)

        def load(number: int) -> vault.Vault:
            if number == 0:
                return vault.empty_vault(vault.load_ref(self.vault_nation()))
            if (*key, f"vault-{number}") not in _STAGED:
                _STAGED[(*key, f"vault-{number}")] = vault.run_loads(load(number - 1), [self.vault_staged(number)])
            return _STAGED[(*key, f"vault-{number}")]

        return load(loads)

    # Documents

    def order_texts(self, sales_order: DataFrame) -> DataFrame:
        """One JSON document per order: the order, its carrier, and two stops with services."""
        year = F.year("order_date")
        serial = F.lpad(F.col("sales_order_id").cast("string"), 9, "0")
        document = F.struct(
            F.concat(F.lit("Order#"), serial).alias("name"),
            F.when(F.col("order_priority") != "4-NOT SPECIFIED", F.col("order_priority")).alias("nickname"),
            year.alias("opened"),
            F.col("order_status").alias("status"),
            F.array(year, year + 1).alias("years"),
            F.struct(
                F.concat(F.lit("Carrier#"), F.lpad(F.col("customer_id").cast("string"), 9, "0")).alias("name"),
                F.col("order_status").alias("type"),
                year.alias("year"),
            ).alias("carrier"),
            F.array(
                F.struct(
                    F.concat(F.lit("Stop#"), serial, F.lit("-1")).alias("name"),
                    F.lit("Dock").alias("nickname"),
                    (F.col("total_price_usd") > 250000).alias("express"),
                    F.array("order_priority", "order_status").alias("services"),
                    F.array(year).alias("years"),
                ),
                F.struct(
                    F.concat(F.lit("Stop#"), serial, F.lit("-2")).alias("name"),
                    F.lit(None).cast("string").alias("nickname"),
                    F.lit(None).cast("boolean").alias("express"),
                    F.when(F.col("order_priority") == "5-LOW", F.array().cast("array<string>"))
                    .otherwise(F.array("order_status"))
                    .alias("services"),
                    F.array(year, year + 2).alias("years"),
                ),
            ).alias("stops"),
        )
        return sales_order.select("sales_order_id", F.to_json(document).alias("text"))

    def order_documents(self, load: int = 2) -> DataFrame:
        """Landed documents: load 1 has the orders before a date, load 2 has all."""

        def build() -> DataFrame:
            orders = self.early_orders() if load == 1 else self.model("sales_order")
            texts = self.order_texts(spread(orders, "sales_order_id"))
            landed, _ = documents.land_json(texts, "text", LOAD_NAME, ts({1: LOAD_1, 2: LOAD_2}[load]))
            return landed

        return self._once(f"documents-{load}", build)

    def shredded(self) -> Shredded:
        """The relational tables after shredding both document loads, one after the other."""
        key = (self.spark.sparkContext.applicationId, self.folder)
        names = list(Shredded.__dataclass_fields__)
        if (*key, "service") not in _STAGED:
            state = self._empty_shredded()
            for load in (1, 2):
                state = self._shred_load(state, load)
            for name in names:
                _STAGED[(*key, name)] = getattr(state, name)
        return Shredded(**{name: _STAGED[(*key, name)] for name in names})

    def _empty_shredded(self) -> Shredded:
        stamp = "load_name string, load_ts timestamp_ntz"
        # by the filter the optimizer knows that a table is empty, and leaves it out of unions and joins
        make = lambda schema: self.spark.createDataFrame([], f"{schema}, {stamp}").filter(F.lit(False))
        return Shredded(
            service=make("service_id bigint, name string"),
            carrier=make("carrier_id bigint, name string, type string, year bigint"),
            party=make(
                "party_id bigint, carrier_id bigint, part_of bigint, name string, nickname string, "
                "express boolean, opened bigint, status string"
            ),
            party_years=make("party_id bigint, year bigint"),
            party_services=make("party_id bigint, service_id bigint"),
        )

    def typed_documents(self, load: int) -> DataFrame:
        """The documents of a load as typed columns, stops nested; read from the variants once and written."""
        docs = self.order_documents(load)
        get = lambda path, type_="string", v="v": F.try_variant_get(v, f"$.{path}", type_)

        def stop(s: Column) -> Column:
            return F.struct(
                get("name", v=s).alias("name"), get("nickname", v=s).alias("nickname"), get("express", "boolean", s).alias("express"),
                get("services", "array<string>", s).alias("services"), get("years", "array<bigint>", s).alias("years"),
            )

        return self._once(
            f"typed-documents-{load}",
            lambda: docs.select(
                get("name").alias("name"),
                get("nickname").alias("nickname"),
                get("opened", "bigint").alias("opened"),
                get("status").alias("status"),
                get("carrier.name").alias("carrier_name"),
                get("carrier.type").alias("carrier_type"),
                get("carrier.year", "bigint").alias("carrier_year"),
                get("years", "array<bigint>").alias("years"),
                F.transform(get("stops", "array<variant>"), stop).alias("stops"),
                "load_name",
                "load_ts",
            ),
        )

    def document_rows(self, load: int) -> dict[str, DataFrame]:
        """The relational row sets that the documents of a load hold."""
        heads = self.typed_documents(load)
        stamp = ["load_name", "load_ts"]
        stops = heads.select(F.col("name").alias("owner_name"), "carrier_name", *stamp, F.explode("stops").alias("stop"))
        stops = stops.select("owner_name", "carrier_name", *stamp, "stop.*")
        year = lambda rows: rows.select(F.col("name").alias("party_name"), F.explode("years").alias("year"), *stamp)
        return {
            "heads": heads,
            "stops": stops.select("name", "nickname", "express", "owner_name", "carrier_name", *stamp),
            "services": stops.select(F.col("name").alias("party_name"), F.explode("services").alias("service_name"), *stamp),
            "years": year(heads).unionByName(year(stops)),
        }

    def _shred_load(self, state: Shredded, load: int) -> Shredded:
        rows = self.document_rows(load)
        few = None if few_rows(rows["heads"]) else False  # rows of many documents are not counted
        stamp = ["load_name", "load_ts"]
        services = rows["services"].select(F.col("service_name").alias("name"), *stamp)
        service = state.service.unionByName(stage(shred.shred_dim(state.service, services, "name", "service_id"), "service"))
        carriers = rows["heads"].select(
            F.col("carrier_name").alias("name"),
            F.col("carrier_type").alias("type"),
            F.col("carrier_year").alias("year"),
            *stamp,
        )
        carrier = state.carrier.unionByName(stage(shred.shred_dim(state.carrier, carriers, "name", "carrier_id"), "carrier"))
        on_carrier = lambda df: shred.resolve(df, carrier, "carrier_name", "name", "carrier_id", "carrier_id", few)
        members = shred.shred_rollup(
            state.party,
            on_carrier(rows["heads"].select("name", "nickname", "opened", "status", "carrier_name", *stamp)),
            on_carrier(rows["stops"]),
            "name",
            "owner_name",
            "party_id",
            "part_of",
            few,
        )
        party = state.party.unionByName(members)
        years = shred.shred_values(state.party_years, rows["years"], party, "party_name", "name", "party_id", "year", few)
        pairs = shred.shred_bridge(
            state.party_services,
            rows["services"],
            {"party_name": (party, "name", "party_id"), "service_name": (service, "name", "service_id")},
            few,
        )
        return Shredded(
            service=service,
            carrier=carrier,
            party=party,
            party_years=state.party_years.unionByName(stage(years, "party_years")),
            party_services=state.party_services.unionByName(stage(pairs, "party_services")),
        )

    # Hierarchy

    def organisation(self) -> DataFrame:
        """A parent-child table: world, regions, locations, customers, orders."""

        def nodes(name: str, prefix: str, key: str, label: Column, rank: str, parent: Column) -> DataFrame:
            rows = self.source(name)
            return rows.select(
                F.concat(F.lit(prefix), F.col(key).cast("string")).alias("node_id"),
                label.alias("name"),
                F.lit(rank).alias("rank"),
                parent.alias("superior_id"),
            )

        def point(prefix: str, key: str) -> Column:
            return F.concat(F.lit(prefix), F.col(key).cast("string"))

        top = values(self.spark, [("W", "World", "World", None)], "node_id string, name string, rank string, superior_id string")
        order_name = F.concat(F.lit("Order#"), F.col("o_orderkey").cast("string"))
        return landing.union_all(
            [
                top,
                nodes("region", "R", "r_regionkey", F.col("r_name"), "Region", F.lit("W")),
                nodes("nation", "N", "n_nationkey", F.col("n_name"), "Location", point("R", "n_regionkey")),
                nodes("customer", "C", "c_custkey", F.col("c_name"), "Customer", point("N", "c_nationkey")),
                nodes("orders", "O", "o_orderkey", order_name, "Order", point("C", "o_custkey")),
            ]
        )

    # Snapshots

    def customer_snapshot_2(self) -> DataFrame:
        """The customer table after an update of the rows whose key ends in 42."""
        return update_where(
            self.model("customer"),
            {"account_balance_usd": F.col("account_balance_usd") + 1},
            F.right(F.col("customer_id").cast("string"), F.lit(2)) == "42",
        )
