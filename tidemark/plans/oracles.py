"""SQL that computes each query a second way, on the same tables.

Written from the meaning of each operator, not from its implementation: loads are compared with
window functions over the union of all loads, documents are read from the order table instead of
JSON, and so on. Shared pieces are named fragments that `_with` puts in front as needed.
"""

from __future__ import annotations

import re

from tidemark.plans.scenario import (
    DAYS,
    EARLY_SUPPORTERS,
    FIRST_DAY,
    FIRST_ORDERS_BEFORE,
    LOAD_1,
    LOAD_2,
    LOAD_3,
    LOAD_NAME,
    REC_SRC,
)
from tidemark.sources.contracts import MODEL
from tidemark.sources.inline import ISO_CODES

FRAGMENTS: dict[str, str] = {}
ORACLES: dict[str, str] = {}

T1, T2, T3 = (f"TIMESTAMP '{t}'" for t in (LOAD_1, LOAD_2, LOAD_3))
OPEN_TS = "TIMESTAMP '9999-12-31 00:00:00'"
OPEN_DATE = "DATE '9999-12-31'"


def _with(sql: str) -> str:
    """Put the fragments that a statement uses, directly or not, in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in FRAGMENTS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(FRAGMENTS[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    parts = ",\n".join(f"{n} AS MATERIALIZED ({FRAGMENTS[n]})" for n in needed)
    return f"WITH RECURSIVE {parts}\n{sql}"


def _oracle(name: str, sql: str, money: str = "", text: str = "") -> None:
    """Register a statement; `money` columns are shown as double, `text` columns as text."""
    shown = [f"CAST({c} AS DOUBLE) AS {c}" for c in money.split()]
    shown += [f"CAST({c} AS VARCHAR) AS {c}" for c in text.split()]
    body = f"SELECT * REPLACE ({', '.join(shown)}) FROM ({sql})" if shown else sql
    ORACLES[name] = _with(body)


# Models

FRAGMENTS["m_location"] = """
    SELECT CAST(n_nationkey AS BIGINT) AS location_id, n_name AS name, CAST(n_regionkey AS BIGINT) AS region_id
    FROM nation"""
FRAGMENTS["m_part"] = """
    SELECT p_partkey AS part_id, p_name AS name, p_brand AS brand, p_type AS type,
           CAST(p_size AS BIGINT) AS size_centimeters, CAST(p_retailprice AS DECIMAL(12,2)) AS retail_price_usd
    FROM part"""
FRAGMENTS["m_supplier"] = """
    SELECT s_suppkey AS supplier_id, s_name AS name, CAST(s_nationkey AS BIGINT) AS location_id,
           CAST(s_acctbal AS DECIMAL(12,2)) AS account_balance_usd
    FROM supplier"""
FRAGMENTS["m_customer"] = """
    SELECT c_custkey AS customer_id, c_name AS name, CAST(c_nationkey AS BIGINT) AS location_id,
           CAST(c_acctbal AS DECIMAL(12,2)) AS account_balance_usd, c_mktsegment AS market_segment
    FROM customer"""
FRAGMENTS["m_sales_order"] = """
    SELECT o_orderkey AS sales_order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
           CAST(o_totalprice AS DECIMAL(12,2)) AS total_price_usd, CAST(o_orderdate AS DATE) AS order_date,
           o_orderpriority AS order_priority
    FROM orders"""
FRAGMENTS["m_inventory"] = "SELECT DISTINCT l_partkey AS part_id, l_suppkey AS supplier_id FROM lineitem"
FRAGMENTS["m_line_item"] = """
    SELECT row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
                              l_quantity, l_extendedprice, l_shipdate) AS line_number,
           l_orderkey AS sales_order_id, l_partkey AS part_id, l_suppkey AS supplier_id,
           CAST(l_quantity AS DECIMAL(12,2)) AS quantity,
           CAST(l_extendedprice AS DECIMAL(12,2)) AS extended_price_usd,
           CAST(l_discount AS DECIMAL(12,2)) AS discount_percent, CAST(l_tax AS DECIMAL(12,2)) AS tax_percent,
           l_returnflag AS return_flag, l_linestatus AS line_status, CAST(l_shipdate AS DATE) AS ship_date,
           CAST(l_shipdate AS DATE) + 7 AS commit_date, CAST(l_shipdate AS DATE) + 3 AS receipt_date
    FROM lineitem"""

LINE_MONEY = "quantity extended_price_usd discount_percent tax_percent"
LINE_DAYS = "ship_date commit_date receipt_date"

_oracle("model_location", "SELECT * FROM m_location")
_oracle("model_part", "SELECT * FROM m_part", "retail_price_usd")
_oracle("model_supplier", "SELECT * FROM m_supplier", "account_balance_usd")
_oracle("model_customer", "SELECT * FROM m_customer", "account_balance_usd")
_oracle("model_sales_order", "SELECT * FROM m_sales_order", "total_price_usd", "order_date")
_oracle("model_inventory", "SELECT * FROM m_inventory")
_oracle("model_line_item", "SELECT * FROM m_line_item", LINE_MONEY, LINE_DAYS)
_oracle(
    "model_tables",
    """SELECT 'location' AS table_name, count(*) AS row_count FROM nation
       UNION ALL SELECT 'part', count(*) FROM part
       UNION ALL SELECT 'supplier', count(*) FROM supplier
       UNION ALL SELECT 'customer', count(*) FROM customer
       UNION ALL SELECT 'sales_order', count(*) FROM orders
       UNION ALL SELECT 'inventory', count(*) FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)
       UNION ALL SELECT 'line_item', count(*) FROM lineitem""",
)

_iso = ", ".join(f"({i}, '{code}')" for i, code in ISO_CODES)
FRAGMENTS["iso"] = f"SELECT * FROM (VALUES {_iso}) AS v(location_id, iso2_code)"
_oracle(
    "inline_values",
    """SELECT iso2_code, c_nationkey::BIGINT AS location_id, count(*) AS customers
       FROM customer JOIN iso ON c_nationkey = iso.location_id GROUP BY ALL""",
)
_oracle(
    "sample_rows",
    "SELECT * FROM m_customer ORDER BY md5('7|' || customer_id), customer_id LIMIT 200",
    "account_balance_usd",
)


def _rule(table: str, column: str, length: int | None = None) -> str:
    rule = f"length <= {length}" if length else "not null"
    broken = f"length({column}) > {length}" if length else f"{column} IS NULL"
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{rule}' AS rule, "
        f"count(*) FILTER (WHERE {broken}) AS violations FROM m_{table}"
    )


_RULES = [
    ("customer", "customer_id"), ("customer", "name"), ("customer", "name", 25), ("customer", "location_id"),
    ("customer", "account_balance_usd"), ("customer", "market_segment"), ("customer", "market_segment", 10),
    ("sales_order", "sales_order_id"), ("sales_order", "customer_id"), ("sales_order", "order_status"),
    ("sales_order", "order_status", 1), ("sales_order", "total_price_usd"), ("sales_order", "order_date"),
    ("sales_order", "order_priority"), ("sales_order", "order_priority", 15),
    ("part", "part_id"), ("part", "name"), ("part", "name", 55), ("part", "brand"), ("part", "brand", 10),
    ("part", "type"), ("part", "type", 25), ("part", "size_centimeters"), ("part", "retail_price_usd"),
]


def _source_rules() -> str:
    """Each declared rule, counted on the stored column."""
    parts = []
    for table in MODEL.values():
        for f in table.fields:
            c, kind = f.source, "VARCHAR" if f.type == "string" else f.type
            rules = [] if f.nullable else [("not null", f"{c} IS NULL")]
            rules.append((f"is {f.type}", f"{c} IS NOT NULL AND TRY_CAST({c} AS {kind}) IS NULL"))
            if f.type.startswith("decimal"):
                rules.append(("scale of " + f.type, f"TRY_CAST({c} AS DECIMAL(38,6)) <> CAST(TRY_CAST({c} AS {kind}) AS DECIMAL(38,6))"))
            if f.max_length is not None:
                rules.append((f"length <= {f.max_length}", f"length({c}) > {f.max_length}"))
            parts += [
                f"SELECT '{table.name}' AS table_name, '{c}' AS column_name, '{rule}' AS rule, "
                f"count(*) FILTER (WHERE {broken}) AS violations FROM {table.source}"
                for rule, broken in rules
            ]
    return " UNION ALL ".join(parts)


_oracle("source_rules", _source_rules())
_oracle(
    "pk_check_inventory",
    """SELECT l_partkey::BIGINT AS part_id, l_suppkey::BIGINT AS supplier_id, count(*) AS row_count
       FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
)
_oracle(
    "alternate_key_check",
    """SELECT 'location' AS tbl, n_name AS name, count(*) AS row_count FROM nation GROUP BY ALL HAVING count(*) > 1
       UNION ALL SELECT 'segment', c_mktsegment, count(*) FROM customer GROUP BY ALL HAVING count(*) > 1""",
)
_oracle("model_not_null", " UNION ALL ".join(_rule(*r) for r in _RULES))
_oracle(
    "pk_check",
    """SELECT l_linenumber::BIGINT AS line_number, l_orderkey AS sales_order_id, count(*) AS row_count
       FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
)
_oracle(
    "pk_check_renumbered",
    "SELECT line_number, sales_order_id, count(*) AS row_count FROM m_line_item GROUP BY 1, 2 HAVING count(*) > 1",
)
_oracle(
    "fk_check",
    "SELECT * FROM m_sales_order WHERE customer_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)",
    "total_price_usd",
    "order_date",
)


def _edge(name: str, child: str, column: str, parent: str, parent_rows: str | None = None) -> str:
    rows = parent_rows or f"m_{parent}"
    return f"""
        SELECT '{name}' AS fk_name, '{child}' AS child_table, '{column}' AS child_columns,
               '{parent}' AS parent_table, '{column}' AS parent_columns,
               count(*) FILTER (WHERE {column} IN (SELECT {column} FROM {rows})) AS matched_rows,
               count(*) FILTER (WHERE {column} NOT IN (SELECT {column} FROM {rows})) AS orphan_rows,
               count(*) FILTER (WHERE {column} IS NULL) AS null_rows
        FROM m_{child}"""


_oracle(
    "fk_references",
    " UNION ALL ".join(
        [
            _edge("supplier_based_in", "supplier", "location_id", "location"),
            _edge("customer_based_in", "customer", "location_id", "location"),
            _edge("sales_order_placed_by", "sales_order", "customer_id", "customer"),
            _edge("inventory_of_part", "inventory", "part_id", "part"),
            _edge("inventory_from_supplier", "inventory", "supplier_id", "supplier"),
            _edge("line_item_of_order", "line_item", "sales_order_id", "sales_order"),
            _edge("line_item_of_part", "line_item", "part_id", "part"),
            _edge("line_item_from_supplier", "line_item", "supplier_id", "supplier"),
        ]
    ),
)

# Customer loads

FRAGMENTS["load1"] = f"SELECT *, {T1} AS load_ts FROM m_customer WHERE account_balance_usd > 0"
FRAGMENTS["load2"] = f"""
    SELECT * REPLACE (CAST(account_balance_usd + CASE WHEN market_segment = 'BUILDING' THEN location_id - 9 ELSE 0 END
                           AS DECIMAL(12,2)) AS account_balance_usd), {T2} AS load_ts
    FROM m_customer"""
FRAGMENTS["load3"] = f"""
    SELECT * REPLACE (CAST(account_balance_usd + CASE WHEN market_segment = 'HOUSEHOLD' THEN 5 ELSE 0 END
                           AS DECIMAL(12,2)) AS account_balance_usd), {T3} AS load_ts
    FROM m_customer"""
_oracle("fk_exported", _edge("sales_order_placed_by", "sales_order", "customer_id", "customer", "load1"))

# Lookups

_oracle(
    "customer_location",
    """SELECT c_custkey AS customer_id, c_name AS customer_name, n_name AS location_name
       FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
_oracle(
    "order_customer_fanout",
    "SELECT o_orderkey AS sales_order_id, c_name AS customer_name FROM orders JOIN customer ON c_custkey = o_custkey",
)
_oracle(
    "lookup_pruned",
    """SELECT c_custkey AS customer_id, c_name AS customer_name
       FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
_oracle("point_lookup", "SELECT * FROM m_location WHERE location_id = 22")

# Loyalty

FRAGMENTS["totals"] = """
    SELECT s.customer_id, sum(total_price_usd) AS total_price_usd
    FROM m_sales_order s JOIN m_customer c ON s.customer_id = c.customer_id
    WHERE account_balance_usd > 0 AND location_id <> 22 GROUP BY 1"""
FRAGMENTS["top_ranked"] = """
    SELECT customer_id, total_price_usd, dense_rank() OVER (ORDER BY total_price_usd DESC) AS cust_level,
           CASE WHEN cust_level BETWEEN 1 AND 20 THEN 'gold' WHEN cust_level BETWEEN 21 AND 100 THEN 'silver'
                WHEN cust_level BETWEEN 101 AND 400 THEN 'bronze' END AS loyalty_level
    FROM totals QUALIFY cust_level <= 400"""
_supporters = ", ".join(f"({i})" for (i,) in EARLY_SUPPORTERS)
FRAGMENTS["loyalty"] = f"""
    SELECT customer_id, loyalty_level AS level, 'top 400' AS type, 0::BIGINT AS points_amount, '' AS comments
    FROM top_ranked
    UNION ALL SELECT column0, 'gold', 'early supporter', 0, '' FROM (VALUES {_supporters}) AS v(column0)"""
_oracle("customer_totals", "SELECT * FROM totals", "total_price_usd")
_oracle("top_customers", "SELECT * FROM top_ranked", "total_price_usd")
for _name in ("loyalty_customer", "loyalty_view", "loyalty_stream"):
    _oracle(_name, "SELECT * FROM loyalty")

# Landing

_oracle("landing_initial", "SELECT * FROM load1", "account_balance_usd", "load_ts")
_oracle("landing_delta", "SELECT * FROM load2", "account_balance_usd", "load_ts")
_oracle(
    "diff_hash",
    """SELECT customer_id, md5(CAST(account_balance_usd AS VARCHAR)) AS one_column,
              CASE WHEN account_balance_usd > 0
                   THEN md5(CAST(account_balance_usd AS VARCHAR) || market_segment) END AS plain_concat,
              sha1(upper(trim(name) || '^'
                   || CASE WHEN account_balance_usd > 0 THEN CAST(account_balance_usd AS VARCHAR) ELSE 'x' END
                   || '^' || trim(market_segment))) AS delimited
       FROM m_customer""",
)

FRAGMENTS["lines1"] = f"""
    SELECT l.*, {T1} AS load_ts, 'initial' AS load_type
    FROM m_line_item l JOIN m_sales_order o USING (sales_order_id) WHERE o.order_date < DATE '{FIRST_ORDERS_BEFORE}'"""
FRAGMENTS["lines2_all"] = f"""
    SELECT l.*, {T2} AS load_ts, 'initial' AS load_type
    FROM m_line_item l WHERE sales_order_id NOT IN (SELECT sales_order_id FROM lines1)
    UNION ALL
    SELECT line_number, sales_order_id, part_id, supplier_id, quantity,
           CAST(extended_price_usd + 1000 AS DECIMAL(12,2)), CAST(discount_percent + 0.01 AS DECIMAL(12,2)), tax_percent,
           CASE WHEN return_flag = 'N' AND part_id % 10 > 4 THEN 'R' ELSE return_flag END, line_status,
           ship_date + 1, commit_date + 2, receipt_date + 3, {T2}, 'update'
    FROM m_line_item l WHERE sales_order_id IN (SELECT sales_order_id FROM lines1)"""
FRAGMENTS["lines2"] = "SELECT * FROM lines2_all WHERE load_type = 'initial' OR line_number % 10 > 2"
FRAGMENTS["lost"] = """
    SELECT * FROM lines1 a
    WHERE sales_order_id IN (SELECT sales_order_id FROM lines2)
      AND NOT EXISTS (SELECT 1 FROM lines2 b
                      WHERE b.sales_order_id = a.sales_order_id AND b.line_number = a.line_number)"""
FRAGMENTS["deleted"] = f"""
    SELECT * REPLACE (CAST(0 AS DECIMAL(12,2)) AS quantity, CAST(0 AS DECIMAL(12,2)) AS extended_price_usd,
                      {T2} AS load_ts, 'deletion' AS load_type) FROM lost"""
FRAGMENTS["newest_lines"] = "SELECT * FROM lines2 UNION ALL SELECT * FROM deleted"

LINE_TEXT = f"{LINE_DAYS} load_ts"
_oracle("latest_load", "SELECT * FROM lines2", LINE_MONEY, LINE_TEXT)
_oracle(
    "whole_orders",
    """SELECT * FROM m_line_item WHERE sales_order_id IN (
         SELECT sales_order_id FROM (
           SELECT sales_order_id, sales_order_id || '-' || line_number AS line_key FROM m_line_item
           ORDER BY md5('7|' || line_key), line_key LIMIT 200))""",
    LINE_MONEY,
    LINE_DAYS,
)
_oracle("orders_new_and_updated", "SELECT * FROM lines2_all", LINE_MONEY, LINE_TEXT)
_oracle("orders_with_deletions", "SELECT * FROM lines2", LINE_MONEY, LINE_TEXT)
_oracle(
    "row_counts",
    """SELECT 'src_customer' AS table_name, (SELECT count(*) FROM load1) + (SELECT count(*) FROM load2) AS row_count
       UNION ALL
       SELECT 'src_line_item', (SELECT count(*) FROM lines1) + (SELECT count(*) FROM lines2)""",
)

# Merge, change feed, dimensions

FRAGMENTS["both_loads"] = """
    SELECT b.customer_id, b.name, b.location_id, b.market_segment, a.customer_id IS NULL AS is_new,
           a.account_balance_usd AS old_balance, b.account_balance_usd AS new_balance,
           coalesce(a.account_balance_usd <> b.account_balance_usd, FALSE) AS is_changed,
           a.load_ts AS old_ts, b.load_ts AS new_ts
    FROM load2 b LEFT JOIN load1 a USING (customer_id)"""
_AFTER = """customer_id, name, location_id, new_balance AS account_balance_usd, market_segment"""
_STAMP = "CASE WHEN is_new OR is_changed THEN new_ts ELSE old_ts END AS load_ts"
_oracle("merge_upsert", f"SELECT {_AFTER}, {_STAMP} FROM both_loads", "account_balance_usd", "load_ts")
_oracle(
    "merge_changes",
    f"""SELECT {_AFTER}, new_ts AS load_ts, 'INSERT' AS action, is_changed AS is_update
        FROM both_loads WHERE is_new OR is_changed
        UNION ALL
        SELECT customer_id, name, location_id, old_balance, market_segment, old_ts, 'DELETE', TRUE
        FROM both_loads WHERE is_changed""",
    "account_balance_usd",
    "load_ts",
)
_oracle(
    "insert_if_absent",
    "SELECT * FROM load1 UNION ALL SELECT * FROM load2 WHERE customer_id NOT IN (SELECT customer_id FROM load1)",
    "account_balance_usd",
    "load_ts",
)
_oracle(
    "change_feed",
    f"""SELECT {_AFTER}, 'INSERT' AS action, is_changed AS is_update FROM both_loads WHERE is_new OR is_changed
        UNION ALL
        SELECT customer_id, name, location_id, old_balance, market_segment, 'DELETE', TRUE
        FROM both_loads WHERE is_changed""",
    "account_balance_usd",
)
_oracle(
    "bulk_update",
    """SELECT customer_id, name, location_id,
              account_balance_usd + CASE WHEN account_balance_usd <= 0 THEN 1 ELSE 0 END AS account_balance_usd,
              CASE WHEN account_balance_usd <= 0 THEN lower(market_segment) ELSE market_segment END AS market_segment
       FROM m_customer""",
    "account_balance_usd",
)
_HASH = "md5(CAST(new_balance AS VARCHAR)) AS diff_hash"
_oracle("scd1", f"SELECT {_AFTER}, {_STAMP}, {_HASH} FROM both_loads", "account_balance_usd", "load_ts")
FRAGMENTS["type3"] = f"""
    SELECT {_AFTER}, {_STAMP}, {_HASH}, coalesce(old_balance, new_balance) AS original_account_balance_usd
    FROM both_loads"""
_T3_MONEY = "account_balance_usd original_account_balance_usd"
_oracle("scd3", "SELECT * FROM type3", _T3_MONEY, "load_ts")
_oracle(
    "scd3_changed",
    "SELECT * FROM type3 WHERE account_balance_usd <> original_account_balance_usd",
    _T3_MONEY,
    "load_ts",
)


def _versions(*loads: str) -> str:
    union = " UNION ALL ".join(f"SELECT * FROM {load}" for load in loads)
    return f"""
        SELECT customer_id, name, location_id, account_balance_usd, market_segment,
               md5(CAST(account_balance_usd AS VARCHAR)) AS diff_hash, load_ts AS from_dts,
               coalesce(lead(load_ts) OVER (PARTITION BY customer_id ORDER BY load_ts) - INTERVAL 1 SECOND,
                        {OPEN_TS}) AS to_dts
        FROM (SELECT *, lag(account_balance_usd) OVER (PARTITION BY customer_id ORDER BY load_ts) AS previous
              FROM ({union}))
        WHERE previous IS NULL OR previous <> account_balance_usd"""


_oracle("scd2", _versions("load1", "load2"), "account_balance_usd", "from_dts to_dts")
for _name in ("scd2_multi_batch", "scd2_stream"):
    _oracle(_name, _versions("load1", "load2", "load3"), "account_balance_usd", "from_dts to_dts")

# Reverse-balance facts

FRAGMENTS["fact0"] = "SELECT * RENAME (load_ts AS as_at_dts), TRUE AS is_after_image FROM lines1"
FRAGMENTS["restated"] = f"""
    SELECT o.line_number, o.sales_order_id, o.part_id, o.supplier_id, n.quantity, n.extended_price_usd,
           n.discount_percent, o.tax_percent, n.return_flag, o.line_status, n.ship_date, n.commit_date,
           n.receipt_date, {T2} AS as_at_dts, n.load_type, TRUE AS is_after_image
    FROM newest_lines n JOIN lines1 o USING (sales_order_id, line_number)"""
FRAGMENTS["added"] = f"""
    SELECT * RENAME (load_ts AS as_at_dts), TRUE AS is_after_image FROM newest_lines n
    WHERE NOT EXISTS (SELECT 1 FROM lines1 o
                      WHERE o.sales_order_id = n.sales_order_id AND o.line_number = n.line_number)"""
FRAGMENTS["touched"] = """
    SELECT o.* FROM fact0 o JOIN newest_lines n USING (sales_order_id, line_number)"""
FRAGMENTS["negated"] = f"""
    SELECT * REPLACE (-quantity AS quantity, -extended_price_usd AS extended_price_usd, {T2} AS as_at_dts,
                      FALSE AS is_after_image) FROM touched"""
FRAGMENTS["line_fact"] = """
    SELECT * FROM fact0 UNION ALL SELECT * FROM negated UNION ALL SELECT * FROM restated UNION ALL SELECT * FROM added"""
FACT_TEXT = f"{LINE_DAYS} as_at_dts"
_oracle("rb_initial", "SELECT * FROM fact0", LINE_MONEY, FACT_TEXT)
_oracle(
    "load_history",
    f"""SELECT DISTINCT {T1} AS load_ts, sales_order_id, {T2} AS next_order_load
        FROM lines1 WHERE sales_order_id IN (SELECT sales_order_id FROM lines2)""",
    text="load_ts next_order_load",
)
_oracle(
    "load_history_full",
    f"""SELECT DISTINCT {T1} AS load_ts, sales_order_id, {T2} AS next_order_load
        FROM lines1 WHERE sales_order_id IN (SELECT sales_order_id FROM lines2)""",
    text="load_ts next_order_load",
)
_oracle(
    "detect_deletions",
    f"""SELECT {T2} AS next_order_load, CAST(NULL AS TIMESTAMP) AS next_line_load, load_ts, sales_order_id,
               line_number, load_type FROM lost""",
    text="next_order_load next_line_load load_ts",
)
FRAGMENTS["lines3"] = f"""
    SELECT *, {T3} AS load_ts, 'update' AS load_type FROM m_line_item
    WHERE sales_order_id % 2 = 0 AND line_number % 10 NOT IN (0, 1, 3)"""
FRAGMENTS["three_loads"] = " UNION ALL ".join(
    f"SELECT sales_order_id, line_number, load_ts, load_type FROM {load}" for load in ("lines1", "lines2", "lines3")
)
FRAGMENTS["order_steps"] = """
    SELECT * FROM (SELECT sales_order_id, load_ts,
                          lead(load_ts) OVER (PARTITION BY sales_order_id ORDER BY load_ts) AS next_order_load
                   FROM (SELECT DISTINCT sales_order_id, load_ts FROM three_loads))
    WHERE next_order_load IS NOT NULL"""
FRAGMENTS["missing_next"] = """
    SELECT s.next_order_load, l.load_ts, l.sales_order_id, l.line_number, l.load_type,
           (SELECT min(x.load_ts) FROM three_loads x
            WHERE x.sales_order_id = l.sales_order_id AND x.line_number = l.line_number AND x.load_ts > l.load_ts
           ) AS next_line_load
    FROM three_loads l JOIN order_steps s ON s.sales_order_id = l.sales_order_id AND s.load_ts = l.load_ts
    WHERE NOT EXISTS (SELECT 1 FROM three_loads x WHERE x.sales_order_id = l.sales_order_id
                      AND x.line_number = l.line_number AND x.load_ts = s.next_order_load)"""
_LOST = "next_order_load next_line_load load_ts"
_oracle("load_history_loads", "SELECT * FROM order_steps", text="load_ts next_order_load")
_oracle("detect_deletions_full", "SELECT * FROM missing_next WHERE next_line_load IS NULL", text=_LOST)
_oracle("detect_deletions_reuse", "SELECT * FROM missing_next", text=_LOST)
_oracle("logical_deletes", "SELECT * FROM deleted", LINE_MONEY, LINE_TEXT)
_oracle(
    "rb_merge_after",
    """SELECT * FROM fact0 f
       WHERE NOT EXISTS (SELECT 1 FROM newest_lines n
                         WHERE n.sales_order_id = f.sales_order_id AND n.line_number = f.line_number)
       UNION ALL SELECT * FROM restated UNION ALL SELECT * FROM added""",
    LINE_MONEY,
    FACT_TEXT,
)
_oracle("rb_reverse_before", "SELECT * FROM touched UNION ALL SELECT * FROM negated", LINE_MONEY, FACT_TEXT)
_oracle("reverse_balance", "SELECT * FROM line_fact", LINE_MONEY, FACT_TEXT)
_oracle("rb_inspect", "SELECT * FROM line_fact WHERE load_type = 'deletion'", LINE_MONEY, FACT_TEXT)
_oracle(
    "rb_as_at_totals",
    """SELECT as_at_dts, load_type, is_after_image, count(*) AS row_count, sum(quantity) AS sum_quantity,
              sum(extended_price_usd) AS sum_extended_price_usd
       FROM line_fact GROUP BY 1, 2, 3""",
    "sum_quantity sum_extended_price_usd",
    "as_at_dts",
)

# Time-banded facts

FRAGMENTS["emp"] = """
    SELECT sales_order_id AS employee_id, customer_id AS department_id, total_price_usd AS salary_usd,
           order_date AS hire_date, order_priority AS security_clearance,
           'Clerk#' || lpad(CAST(customer_id % 1000 AS VARCHAR), 9, '0') AS clerk, '' AS comment
    FROM m_sales_order"""
_DAYS_LATER = (
    "hire_date + CAST(right(CAST(CAST(round(salary_usd, 0) AS DECIMAL(12,0)) AS VARCHAR), 3) AS INTEGER)"
)
_DIGIT = "CAST(right(clerk, 1) AS INTEGER)"
FRAGMENTS["emp_landed"] = f"""
    SELECT employee_id, department_id, {_DIGIT} > 7 AS is_contractor, salary_usd, hire_date,
           CASE WHEN {_DIGIT} < 3 THEN {OPEN_DATE} ELSE CAST({_DAYS_LATER} AS DATE) END AS termination_date,
           security_clearance, clerk, termination_date >= DATE '{FIRST_DAY}' AS is_active,
           CASE WHEN termination_date >= DATE '{FIRST_DAY}' THEN 'Hire' ELSE 'Leaver' END AS last_change,
           comment, DATE '{FIRST_DAY}' AS load_date
    FROM emp WHERE hire_date < DATE '{FIRST_DAY}'"""


def _changes(staff: str, today: str) -> str:
    return f"""
        SELECT employee_id, department_id, {_DIGIT} > 7 AS is_contractor, salary_usd, hire_date,
               CASE WHEN {_DIGIT} <= 7 THEN {OPEN_DATE} ELSE CAST({_DAYS_LATER} AS DATE) END AS termination_date,
               security_clearance, clerk, TRUE AS is_active, 'Hire' AS last_change, comment, DATE '{today}' AS load_date
        FROM emp WHERE hire_date = DATE '{today}' - 1
        UNION ALL
        SELECT employee_id, department_id, is_contractor, salary_usd, hire_date, CAST(DATE '{today}' - 1 AS DATE),
               security_clearance, clerk, FALSE, 'Leaver', 'Left ' || comment, DATE '{today}'
        FROM {staff}
        WHERE is_active AND hire_date < DATE '{today}' - 2 AND day(hire_date) = day(DATE '{today}')
          AND CAST(right(CAST(salary_usd AS VARCHAR), 1) AS INTEGER) > 6
        UNION ALL
        SELECT employee_id, department_id, is_contractor, CAST(salary_usd * 1.1 AS DECIMAL(12,2)), hire_date,
               termination_date, security_clearance, clerk, is_active, 'Promoted', '+10% ' || comment, DATE '{today}'
        FROM {staff}
        WHERE is_active AND hire_date < DATE '{today}' - 2 AND day(hire_date) = day(DATE '{today}')
          AND CAST(right(CAST(salary_usd AS VARCHAR), 1) AS INTEGER) <= 6"""


_EMP_HASH = (
    "md5(CAST(salary_usd AS VARCHAR) || CAST(hire_date AS VARCHAR) || CAST(termination_date AS VARCHAR) || comment "
    "|| last_change || CAST(load_date AS VARCHAR) || CAST(is_active AS VARCHAR)) AS diff_hash"
)
FRAGMENTS["open_0"] = f"""
    SELECT *, DATE '1900-01-01' AS from_date, {OPEN_DATE} AS to_date, {_EMP_HASH} FROM emp_landed"""
for _i, _today in enumerate(DAYS, start=1):
    FRAGMENTS[f"chg_{_i}"] = _changes(f"open_{_i - 1}", _today)
    FRAGMENTS[f"open_{_i}"] = f"""
        SELECT * FROM open_{_i - 1} WHERE employee_id NOT IN (SELECT employee_id FROM chg_{_i})
        UNION ALL
        SELECT *, load_date AS from_date, {OPEN_DATE} AS to_date, {_EMP_HASH} FROM chg_{_i}"""
    FRAGMENTS[f"closed_{_i}"] = f"""
        SELECT * REPLACE (CAST(DATE '{_today}' - 1 AS DATE) AS to_date) FROM open_{_i - 1}
        WHERE employee_id IN (SELECT employee_id FROM chg_{_i})"""
FRAGMENTS["emp_fact"] = f"SELECT * FROM open_{len(DAYS)}" + "".join(
    f" UNION ALL SELECT * FROM closed_{_i}" for _i in range(1, len(DAYS) + 1)
)
_EMP_TEXT = "hire_date termination_date load_date"
_FACT_TEXT = f"{_EMP_TEXT} from_date to_date"
_oracle("employee_source", "SELECT * FROM emp", "salary_usd", "hire_date")
_oracle("employee_landing", "SELECT * FROM emp_landed", "salary_usd", _EMP_TEXT)
for _name in ("employee_daily", "next_load"):
    _oracle(_name, "SELECT * FROM chg_1", "salary_usd", _EMP_TEXT)
_oracle("type2_fact_initial", "SELECT * FROM open_0", "salary_usd", _FACT_TEXT)
_oracle("type2_fact_load", "SELECT * FROM open_1 UNION ALL SELECT * FROM closed_1", "salary_usd", _FACT_TEXT)
_oracle("t2_five_days", "SELECT * FROM emp_fact", "salary_usd", _FACT_TEXT)
_COUNT = "SELECT count(DISTINCT employee_id) AS active_employee_count FROM emp_fact WHERE is_active"
_LAST = f"DATE '{DAYS[-1]}'"
_COHORT = f"hire_date BETWEEN DATE '2000-01-01' AND DATE '2000-03-31' AND from_date <= {_LAST} AND to_date >= {_LAST}"
_oracle(
    "active_now",
    f"SELECT count(*) AS active_employee_count FROM emp_fact WHERE is_active AND to_date = {OPEN_DATE}",
)
_oracle("active_as_of", f"{_COUNT} AND from_date <= DATE '{FIRST_DAY}' AND to_date >= DATE '{FIRST_DAY}'")
_oracle("active_in_year", f"{_COUNT} AND year(from_date) <= 2001 AND year(to_date) >= 2001")
_oracle("cohort_as_of", f"{_COUNT} AND {_COHORT}")
_oracle(
    "cohort_promoted",
    f"{_COUNT} AND {_COHORT} AND employee_id IN (SELECT employee_id FROM emp_fact WHERE last_change = 'Promoted')",
)
_oracle(
    "daily_movements",
    f"""SELECT from_date, last_change, count(employee_id) AS employee_count FROM emp_fact
        WHERE from_date > DATE '{FIRST_DAY}' AND to_date = {OPEN_DATE} GROUP BY 1, 2 ORDER BY 1, 2""",
    text="from_date",
)

# Documents: read from the order table instead of JSON

_oracle(
    "json_land",
    f"""SELECT event_id, CAST(json(props) AS VARCHAR) AS v, '{LOAD_NAME}' AS load_name, {T1} AS load_ts FROM events""",
    text="load_ts",
)
_oracle(
    "json_rejects",
    "SELECT conv_id, turn, text FROM conversations WHERE text IS NULL OR NOT json_valid(text)",
)
_oracle(
    "json_event_props",
    """SELECT event_type, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k,
              count(json_extract(props, '$.nothing')) AS count_missing
       FROM events GROUP BY 1""",
)
FRAGMENTS["docs"] = f"""
    SELECT sales_order_id, 'Order#' || lpad(CAST(sales_order_id AS VARCHAR), 9, '0') AS name,
           CASE WHEN order_priority <> '4-NOT SPECIFIED' THEN order_priority END AS nickname,
           year(order_date) AS opened, order_status AS status, order_priority AS priority,
           'Carrier#' || lpad(CAST(customer_id AS VARCHAR), 9, '0') AS carrier_name,
           'Stop#' || lpad(CAST(sales_order_id AS VARCHAR), 9, '0') || '-1' AS stop1,
           'Stop#' || lpad(CAST(sales_order_id AS VARCHAR), 9, '0') || '-2' AS stop2,
           total_price_usd > 250000 AS express,
           CASE WHEN order_date < DATE '{FIRST_ORDERS_BEFORE}' THEN 1 ELSE 2 END AS load
    FROM m_sales_order"""
FRAGMENTS["doc_services"] = """
    SELECT name AS doc_name, stop1 AS party_name, priority AS service, load FROM docs
    UNION ALL SELECT name, stop1, status, load FROM docs
    UNION ALL SELECT name, stop2, status, load FROM docs WHERE priority <> '5-LOW'"""
_oracle(
    "json_extract",
    """SELECT name AS order_name, nickname, opened::INTEGER AS opened, carrier_name, CAST(NULL AS VARCHAR) AS missing
       FROM docs""",
)
_oracle(
    "json_array_ends",
    """SELECT name AS order_name, 2::INTEGER AS year_count, opened::INTEGER AS active_from,
              (opened + 1)::INTEGER AS active_to,
              CASE WHEN priority <> '5-LOW' THEN status END AS last_service
       FROM docs""",
)
_oracle(
    "flatten",
    """SELECT name AS order_name, 0 AS stop_index, stop1 AS stop_name, 'Dock' AS stop_nickname FROM docs
       UNION ALL SELECT name, 1, stop2, NULL FROM docs""",
)
_oracle("flatten_nested", "SELECT doc_name AS order_name, party_name AS stop_name, service FROM doc_services")
_oracle(
    "flatten_outer",
    """SELECT party_name AS stop_name, service FROM doc_services
       UNION ALL SELECT stop2, NULL FROM docs WHERE priority = '5-LOW'""",
)
_oracle("flatten_count", "SELECT 2 * count(*) AS nested_count FROM docs")

_NODES = [
    ("name", "name", "name"), ("opened", "opened", "opened"), ("status", "status", "status"),
    ("years", "years", "NULL"), (None, "years[0]", "opened"), (None, "years[1]", "opened + 1"),
    ("carrier", "carrier", "NULL"), ("name", "carrier.name", "carrier_name"), ("type", "carrier.type", "status"),
    ("year", "carrier.year", "opened"), ("stops", "stops", "NULL"), (None, "stops[0]", "NULL"),
    ("name", "stops[0].name", "stop1"), ("nickname", "stops[0].nickname", "'Dock'"),
    ("express", "stops[0].express", "express"), ("services", "stops[0].services", "NULL"),
    (None, "stops[0].services[0]", "priority"), (None, "stops[0].services[1]", "status"),
    ("years", "stops[0].years", "NULL"), (None, "stops[0].years[0]", "opened"), (None, "stops[1]", "NULL"),
    ("name", "stops[1].name", "stop2"), ("services", "stops[1].services", "NULL"),
    ("years", "stops[1].years", "NULL"), (None, "stops[1].years[0]", "opened"),
    (None, "stops[1].years[1]", "opened + 2"),
]
_SOMETIMES = [
    ("nickname", "nickname", "nickname", "nickname IS NOT NULL"),
    (None, "stops[1].services[0]", "status", "priority <> '5-LOW'"),
]


def _node(key: str | None, path: str, value: str, where: str = "TRUE") -> str:
    shown = f"'{key}'" if key else "CAST(NULL AS VARCHAR)"
    return (
        f"SELECT sales_order_id, {shown} AS key, '{path}' AS path, CAST({value} AS VARCHAR) AS leaf_value "
        f"FROM docs WHERE {where}"
    )


FRAGMENTS["doc_nodes"] = " UNION ALL ".join([*(_node(*n) for n in _NODES), *(_node(*n) for n in _SOMETIMES)])
_oracle("flatten_recursive", "SELECT * FROM doc_nodes")
_oracle(
    "json_depth",
    """SELECT CAST(length(path) - length(replace(path, '.', '')) + 1 + (path LIKE '%]')::INTEGER AS INTEGER) AS depth,
              key, path, count(*) AS documents
       FROM doc_nodes GROUP BY ALL ORDER BY 1""",
)

_LOADED = f"'{LOAD_NAME}' AS load_name, CASE WHEN phase = 1 THEN {T1} ELSE {T2} END AS load_ts"
FRAGMENTS["t_service"] = f"""
    SELECT row_number() OVER (ORDER BY phase, name) AS service_id, name, {_LOADED}
    FROM (SELECT service AS name, min(load) AS phase FROM doc_services GROUP BY 1)"""
FRAGMENTS["t_carrier"] = f"""
    SELECT row_number() OVER (ORDER BY phase, name) AS carrier_id, name, type, year, {_LOADED}
    FROM (SELECT carrier_name AS name, status AS type, opened AS year, load AS phase FROM docs
          QUALIFY row_number() OVER (PARTITION BY carrier_name ORDER BY load, status, opened) = 1)"""
FRAGMENTS["party_names"] = """
    SELECT name, 2 * load - 1 AS step, load AS phase, NULL AS owner, carrier_name, nickname, NULL AS express,
           opened, status FROM docs
    UNION ALL SELECT stop1, 2 * load, load, name, carrier_name, 'Dock', express, NULL, NULL FROM docs
    UNION ALL SELECT stop2, 2 * load, load, name, carrier_name, NULL, NULL, NULL, NULL FROM docs"""
FRAGMENTS["party_keys"] = "SELECT *, row_number() OVER (ORDER BY step, name) AS party_id FROM party_names"
FRAGMENTS["t_party"] = f"""
    SELECT p.party_id, c.carrier_id, o.party_id AS part_of, p.name, p.nickname, p.express,
           p.opened, p.status, '{LOAD_NAME}' AS load_name,
           CASE WHEN p.phase = 1 THEN {T1} ELSE {T2} END AS load_ts
    FROM party_keys p JOIN t_carrier c ON c.name = p.carrier_name LEFT JOIN party_keys o ON o.name = p.owner"""
FRAGMENTS["t_bridge"] = f"""
    SELECT DISTINCT p.party_id, s.service_id, p.load_name, p.load_ts
    FROM doc_services d JOIN t_party p ON p.name = d.party_name JOIN t_service s ON s.name = d.service"""
_oracle("shred_dimension", "SELECT * FROM t_service", text="load_ts")
_oracle("shred_dimension_carrier", "SELECT * FROM t_carrier", text="load_ts")
_oracle("shred_rollup", "SELECT * FROM t_party", text="load_ts")
_oracle("shred_bridge", "SELECT * FROM t_bridge", text="load_ts")
_oracle(
    "shred_multivalue",
    f"""SELECT p.party_id, y.year, p.load_name, p.load_ts FROM (
          SELECT name, opened AS year FROM docs UNION ALL SELECT name, opened + 1 FROM docs
          UNION ALL SELECT stop1, opened FROM docs
          UNION ALL SELECT stop2, opened FROM docs UNION ALL SELECT stop2, opened + 2 FROM docs) y
        JOIN t_party p ON p.name = y.name""",
    text="load_ts",
)
_oracle(
    "shredded_star",
    """SELECT p.name, coalesce(p.nickname, 'None') AS nickname, c.type AS carrier_type,
              coalesce(s.name, 'None') AS linked_name
       FROM t_party p JOIN t_carrier c USING (carrier_id) LEFT JOIN t_bridge b USING (party_id)
       LEFT JOIN t_service s USING (service_id)""",
)
_oracle(
    "surrogate_key",
    """SELECT (SELECT max(n_nationkey) FROM nation) + row_number() OVER (ORDER BY c_name) AS customer_sk,
              c_name AS name, c_mktsegment AS market_segment FROM customer""",
)

# Hierarchies

FRAGMENTS["org"] = """
    SELECT 'W' AS node_id, 'World' AS name, 'World' AS rank, NULL AS superior_id
    UNION ALL SELECT 'R' || r_regionkey, r_name, 'Region', 'W' FROM region
    UNION ALL SELECT 'N' || n_nationkey, n_name, 'Location', 'R' || n_regionkey FROM nation
    UNION ALL SELECT 'C' || c_custkey, c_name, 'Customer', 'N' || c_nationkey FROM customer
    UNION ALL SELECT 'O' || o_orderkey, 'Order#' || o_orderkey, 'Order', 'C' || o_custkey FROM orders"""
ORACLES["hierarchy_path"] = f"""WITH RECURSIVE org AS ({FRAGMENTS["org"]}),
    walk AS (
      SELECT node_id, name, rank, superior_id, '-> ' || name AS path, 1 AS level FROM org WHERE rank = 'World'
      UNION ALL
      SELECT o.node_id, o.name, o.rank, o.superior_id, w.path || '-> ' || o.name, w.level + 1
      FROM org o JOIN walk w ON o.superior_id = w.node_id)
    SELECT * FROM walk ORDER BY level"""
_BRANCHES = f"""WITH RECURSIVE org AS ({FRAGMENTS["org"]}),
    walk AS (
      SELECT node_id, name, rank, superior_id, '-> ' || name AS path, name AS branch, 2 AS level
      FROM org WHERE rank = 'Region'
      UNION ALL
      SELECT o.node_id, o.name, o.rank, o.superior_id, w.path || '-> ' || o.name, w.branch, w.level + 1
      FROM org o JOIN walk w ON o.superior_id = w.node_id),
    labelled AS (
      SELECT * FROM walk
      UNION ALL SELECT node_id, name, rank, superior_id, name, name, 1 FROM org WHERE rank = 'World')"""
ORACLES["hierarchy_branches"] = f"{_BRANCHES} SELECT * FROM labelled ORDER BY branch, level"
ORACLES["hierarchy_named_branches"] = f"""WITH RECURSIVE org AS ({FRAGMENTS["org"]}),
    walk AS (
      SELECT node_id, name, '-> ' || name AS path, name AS branch, 2 AS level
      FROM org WHERE rank = 'Region' AND split_part(name, ' ', 2) = 'EAST'
      UNION ALL
      SELECT o.node_id, o.name, w.path || '-> ' || o.name, w.branch, w.level + 1
      FROM org o JOIN walk w ON o.superior_id = w.node_id)
    SELECT node_id, path, branch, level, string_split_regex(name, '[#_ ]+')[2] AS second_part
    FROM (SELECT * FROM walk UNION ALL SELECT node_id, name, name, name, 1 FROM org WHERE rank = 'World')"""
ORACLES["hierarchy_edges"] = f"""{_BRANCHES}
    SELECT *, node_id NOT IN (SELECT superior_id FROM labelled WHERE superior_id IS NOT NULL) AS is_edge_node
    FROM labelled"""

# Data Vault


def _vault_customers(load: str, stamp: str) -> str:
    return f"""
        SELECT customer_id, name, iso2_code, account_balance_usd, market_segment, {stamp} AS load_ts,
               '{REC_SRC}' AS rec_src, sha1(CAST(customer_id AS VARCHAR)) AS hub_customer_hk,
               sha1(upper(trim(name) || '^' || iso2_code || '^' || CAST(account_balance_usd AS VARCHAR)
                          || '^' || trim(market_segment))) AS customer_hash_diff
        FROM {load} JOIN iso USING (location_id)"""


def _vault_orders(load: str, stamp: str) -> str:
    return f"""
        SELECT sales_order_id, customer_id, order_status, total_price_usd, order_date, order_priority,
               {stamp} AS load_ts, '{REC_SRC}' AS rec_src, sha1(CAST(sales_order_id AS VARCHAR)) AS hub_order_hk,
               sha1(CAST(customer_id AS VARCHAR)) AS hub_customer_hk,
               sha1(sales_order_id || '^' || customer_id) AS lnk_customer_order_hk,
               sha1(upper(order_status || '^' || CAST(total_price_usd AS VARCHAR) || '^'
                          || CAST(order_date AS VARCHAR) || '^' || trim(order_priority))) AS order_hash_diff
        FROM m_sales_order WHERE customer_id IN (SELECT customer_id FROM {load})"""


FRAGMENTS["vc1"] = _vault_customers("load1", T1)
FRAGMENTS["vc2"] = _vault_customers("load2", T2)
FRAGMENTS["vo1"] = _vault_orders("load1", T1)
FRAGMENTS["vo2"] = _vault_orders("load2", T2)
FRAGMENTS["nation_codes"] = f"""
    SELECT location_id, iso2_code, name, region_id, {T1} AS load_ts, '{REC_SRC}' AS rec_src
    FROM m_location JOIN iso USING (location_id)"""
FRAGMENTS["sat1"] = """
    SELECT hub_customer_hk, load_ts, name, iso2_code, account_balance_usd, market_segment,
           customer_hash_diff AS hash_diff, rec_src FROM vc1"""
FRAGMENTS["sat2_new"] = """
    SELECT hub_customer_hk, load_ts, name, iso2_code, account_balance_usd, market_segment,
           customer_hash_diff AS hash_diff, rec_src FROM vc2
    WHERE NOT EXISTS (SELECT 1 FROM vc1 WHERE vc1.hub_customer_hk = vc2.hub_customer_hk
                                          AND vc1.customer_hash_diff = vc2.customer_hash_diff)"""
_oracle("nation_iso", "SELECT * FROM nation_codes", text="load_ts")
_oracle("reference_load", "SELECT * FROM nation_codes", text="load_ts")
_oracle(
    "vault_landing",
    """SELECT customer_id, name, iso2_code, account_balance_usd, market_segment, load_ts, rec_src,
              order_count, order_total_usd
       FROM vc1 LEFT JOIN (SELECT customer_id, count(*) AS order_count, sum(total_price_usd) AS order_total_usd
                           FROM m_sales_order GROUP BY 1) USING (customer_id)""",
    "account_balance_usd order_total_usd",
    "load_ts",
)
_oracle(
    "load_audit",
    """SELECT 'customer' AS tbl, count(DISTINCT load_ts) AS loads, count(*) AS row_count
       FROM (SELECT load_ts FROM vc1 UNION ALL SELECT load_ts FROM vc2)
       UNION ALL
       SELECT 'order', count(DISTINCT load_ts), count(*)
       FROM (SELECT load_ts FROM vo1 UNION ALL SELECT load_ts FROM vo2)""",
)
_oracle("vault_hash_customer", "SELECT * FROM vc1", "account_balance_usd", "load_ts")
_oracle("vault_hash_order", "SELECT * FROM vo1", "total_price_usd", "order_date load_ts")
_oracle(
    "hub_load",
    """SELECT hub_customer_hk, customer_id, load_ts, rec_src FROM vc2
       WHERE customer_id NOT IN (SELECT customer_id FROM vc1)""",
    text="load_ts",
)
_oracle("satellite_load", "SELECT * FROM sat2_new", "account_balance_usd", "load_ts")
_oracle(
    "satellite_latest",
    f"""SELECT * REPLACE ({T3} AS load_ts) FROM sat1
        WHERE hub_customer_hk IN (SELECT hub_customer_hk FROM sat2_new)""",
    "account_balance_usd",
    "load_ts",
)
_oracle(
    "link_load",
    """SELECT lnk_customer_order_hk, hub_customer_hk, hub_order_hk, load_ts, rec_src FROM vo2
       WHERE sales_order_id NOT IN (SELECT sales_order_id FROM vo1)""",
    text="load_ts",
)
_oracle("vault_incremental", "SELECT * FROM sat1 UNION ALL SELECT * FROM sat2_new", "account_balance_usd", "load_ts")
_oracle(
    "multi_target_load",
    """SELECT 'hub_customer' AS src, (SELECT count(*) FROM vc2) - (SELECT count(*) FROM vc1) AS cnt
       UNION ALL SELECT 'hub_order', (SELECT count(*) FROM vo2) - (SELECT count(*) FROM vo1)
       UNION ALL SELECT 'lnk_customer_order', (SELECT count(*) FROM vo2) - (SELECT count(*) FROM vo1)
       UNION ALL SELECT 'sat_sys1_customer', (SELECT count(*) FROM sat2_new)
       UNION ALL SELECT 'sat_sys1_order', (SELECT count(*) FROM vo2) - (SELECT count(*) FROM vo1)""",
)


def _vault_rows(customers: str, orders: str, satellite: str, reference: bool) -> str:
    counts = [
        ("hub_customer", customers),
        ("hub_order", orders),
        ("sat_sys1_customer", satellite),
        ("sat_sys1_order", orders),
        ("lnk_customer_order", orders),
    ]
    if reference:
        counts.append(("ref_nation", "SELECT count(*) FROM nation"))
    return " UNION ALL ".join(f"SELECT '{name}' AS src, ({sql}) AS cnt" for name, sql in counts)


_SAT2 = "SELECT (SELECT count(*) FROM sat1) + (SELECT count(*) FROM sat2_new)"
_oracle(
    "vault_counts",
    _vault_rows(
        "SELECT count(*) FROM vc1", "SELECT count(*) FROM vo1", "SELECT count(*) FROM sat1", reference=True
    ),
)
_oracle(
    "vault_incremental_counts",
    _vault_rows("SELECT count(*) FROM customer", "SELECT count(*) FROM orders", _SAT2, reference=True),
)
_oracle(
    "vault_stream",
    _vault_rows("SELECT count(*) FROM customer", "SELECT count(*) FROM orders", _SAT2, reference=False),
)

# Snapshots, computed columns, ordering

FRAGMENTS["snapshot2"] = """
    SELECT * REPLACE (account_balance_usd + CASE WHEN right(CAST(customer_id AS VARCHAR), 2) = '42' THEN 1 ELSE 0 END
                      AS account_balance_usd) FROM m_customer"""
_oracle("snapshot_update", "SELECT * FROM snapshot2", "account_balance_usd")
_oracle(
    "snapshot_diff_count",
    """SELECT count(*) AS cnt FROM (SELECT customer_id, account_balance_usd FROM m_customer
                                    EXCEPT SELECT customer_id, account_balance_usd FROM snapshot2)""",
)
_oracle(
    "snapshot_before_after",
    """SELECT o.customer_id, o.account_balance_usd AS account_balance_usd_before,
              n.account_balance_usd AS account_balance_usd_now
       FROM m_customer o JOIN snapshot2 n USING (customer_id)
       JOIN (SELECT customer_id, account_balance_usd FROM m_customer
             EXCEPT SELECT customer_id, account_balance_usd FROM snapshot2) USING (customer_id)""",
    "account_balance_usd_before account_balance_usd_now",
)
_oracle(
    "snapshot_versions",
    """SELECT *, 'DELETE' AS action, TRUE AS is_update FROM (SELECT * FROM m_customer EXCEPT SELECT * FROM snapshot2)
       UNION ALL
       SELECT *, 'INSERT', TRUE FROM (SELECT * FROM snapshot2 EXCEPT SELECT * FROM m_customer)""",
    "account_balance_usd",
)
_oracle(
    "computed_columns",
    """SELECT *, 'Legacy data, do not use in reporting without re-mapping' AS sys_message,
              'x' || customer_id AS legacy_customer_id,
              CAST(account_balance_usd * CASE market_segment WHEN 'MACHINERY' THEN 0.10 WHEN 'AUTOMOBILE' THEN 0.15
                                         ELSE 0.20 END AS DECIMAL(12,2)) AS tax_amount_usd
       FROM m_customer""",
    "account_balance_usd tax_amount_usd",
)
_oracle(
    "default_columns",
    f"""SELECT customer_id, name, CASE WHEN account_balance_usd > 0 THEN {T2} END AS load_dts,
               'Hi, my name is ' || name AS v_name
        FROM m_customer""",
    text="load_dts",
)
FRAGMENTS["credit"] = """
    SELECT customer_id, CASE WHEN account_balance_usd > 0 THEN account_balance_usd END AS credit_usd,
           CASE WHEN account_balance_usd > 0 THEN market_segment END AS segment FROM m_customer"""
_CREDIT = "customer_id, CAST(credit_usd AS DOUBLE) AS credit_usd, segment FROM credit"
ORACLES["order_nulls_desc"] = _with(
    f"""SELECT {_CREDIT}
        ORDER BY credit.credit_usd DESC NULLS FIRST, segment DESC NULLS FIRST, customer_id"""
)
ORACLES["order_nulls_last"] = _with(f"SELECT {_CREDIT} ORDER BY credit.credit_usd DESC NULLS LAST, customer_id")
ORACLES["order_nulls_first"] = _with(f"SELECT {_CREDIT} ORDER BY credit.credit_usd ASC NULLS FIRST, customer_id")
