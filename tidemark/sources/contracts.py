"""Declared models: columns, types, keys and references of each table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    source: str
    nullable: bool = False
    max_length: int | None = None
    comment: str = ""


@dataclass(frozen=True)
class Reference:
    """A foreign key: `columns` of the child point to `parent_columns` of `parent`."""

    name: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class Table:
    name: str
    source: str
    fields: tuple[Field, ...]
    key: tuple[str, ...]
    alternate: tuple[str, ...] = ()
    references: tuple[Reference, ...] = ()
    comment: str = ""

    def schema(self) -> T.StructType:
        """The declared schema, nullability and comments included."""
        return T.StructType(
            [
                T.StructField(
                    f.name,
                    T.DataType.fromDDL(f.type),
                    f.nullable,
                    {"comment": f.comment} if f.comment else None,
                )
                for f in self.fields
            ]
        )


MONEY = "decimal(12,2)"

LOCATION = Table(
    "location",
    "nation",
    (
        Field("location_id", "bigint", "n_nationkey"),
        Field("name", "string", "n_name", max_length=25),
        Field("region_id", "bigint", "n_regionkey"),
    ),
    key=("location_id",),
    alternate=("name",),
    comment="Places where customers and suppliers are based",
)

PART = Table(
    "part",
    "part",
    (
        Field("part_id", "bigint", "p_partkey"),
        Field("name", "string", "p_name", max_length=55),
        Field("brand", "string", "p_brand", max_length=10),
        Field("type", "string", "p_type", max_length=25),
        Field("size_centimeters", "bigint", "p_size"),
        Field("retail_price_usd", MONEY, "p_retailprice"),
    ),
    key=("part_id",),
    comment="Parts that are sold",
)

SUPPLIER = Table(
    "supplier",
    "supplier",
    (
        Field("supplier_id", "bigint", "s_suppkey"),
        Field("name", "string", "s_name", max_length=25),
        Field("location_id", "bigint", "s_nationkey"),
        Field("account_balance_usd", MONEY, "s_acctbal"),
    ),
    key=("supplier_id",),
    references=(Reference("supplier_based_in", ("location_id",), "location", ("location_id",)),),
    comment="Suppliers of parts",
)

CUSTOMER = Table(
    "customer",
    "customer",
    (
        Field("customer_id", "bigint", "c_custkey"),
        Field("name", "string", "c_name", max_length=25),
        Field("location_id", "bigint", "c_nationkey"),
        Field("account_balance_usd", MONEY, "c_acctbal"),
        Field("market_segment", "string", "c_mktsegment", max_length=10),
    ),
    key=("customer_id",),
    references=(Reference("customer_based_in", ("location_id",), "location", ("location_id",)),),
    comment="Registered customers",
)

SALES_ORDER = Table(
    "sales_order",
    "orders",
    (
        Field("sales_order_id", "bigint", "o_orderkey"),
        Field("customer_id", "bigint", "o_custkey"),
        Field("order_status", "string", "o_orderstatus", max_length=1),
        Field("total_price_usd", MONEY, "o_totalprice"),
        Field("order_date", "date", "o_orderdate"),
        Field("order_priority", "string", "o_orderpriority", max_length=15),
    ),
    key=("sales_order_id",),
    references=(Reference("sales_order_placed_by", ("customer_id",), "customer", ("customer_id",)),),
    comment="Order headers",
)

INVENTORY = Table(
    "inventory",
    "lineitem",
    (
        Field("part_id", "bigint", "l_partkey"),
        Field("supplier_id", "bigint", "l_suppkey"),
    ),
    key=("part_id", "supplier_id"),
    references=(
        Reference("inventory_of_part", ("part_id",), "part", ("part_id",)),
        Reference("inventory_from_supplier", ("supplier_id",), "supplier", ("supplier_id",)),
    ),
    comment="Parts and the suppliers that sell them",
)

LINE_ITEM = Table(
    "line_item",
    "lineitem",
    (
        Field("line_number", "bigint", "l_linenumber"),
        Field("sales_order_id", "bigint", "l_orderkey"),
        Field("part_id", "bigint", "l_partkey"),
        Field("supplier_id", "bigint", "l_suppkey"),
        Field("quantity", MONEY, "l_quantity", nullable=True),
        Field("extended_price_usd", MONEY, "l_extendedprice", nullable=True),
        Field("discount_percent", MONEY, "l_discount", nullable=True),
        Field("tax_percent", MONEY, "l_tax", nullable=True),
        Field("return_flag", "string", "l_returnflag", nullable=True, max_length=1),
        Field("line_status", "string", "l_linestatus", nullable=True, max_length=1),
        Field("ship_date", "date", "l_shipdate", nullable=True),
    ),
    key=("line_number", "sales_order_id"),
    references=(
        Reference("line_item_of_order", ("sales_order_id",), "sales_order", ("sales_order_id",)),
        Reference("line_item_of_part", ("part_id",), "part", ("part_id",)),
        Reference("line_item_from_supplier", ("supplier_id",), "supplier", ("supplier_id",)),
    ),
    comment="Lines of each order",
)

MODEL = {t.name: t for t in (LOCATION, PART, SUPPLIER, CUSTOMER, SALES_ORDER, INVENTORY, LINE_ITEM)}
