"""Every operator as a named query over the supplied tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.computed import update_where, with_computed, with_defaults
from tidemark.functions.hashing import diff_hash
from tidemark.functions.ordering import order_by
from tidemark.functions.strings import strtok
from tidemark.functions.variants import array_first, array_last, json_array, json_get, path_depth
from tidemark.operators import (
    balance,
    bands,
    documents,
    hierarchy,
    keys,
    lookup,
    merge,
    numbering,
    ranking,
    scd,
    shred,
    snapshot,
    vault,
)
from tidemark.plans.scenario import (
    DAYS,
    EARLY_SUPPORTERS,
    FIRST_DAY,
    LINE_ADDITIVE,
    LINE_KEYS,
    LINE_UPDATED,
    LOAD_1,
    LOAD_2,
    LOAD_NAME,
    TRACKED,
    Scenario,
    day,
    ts,
)
from tidemark.session import new_folder
from tidemark.sources import landing, tables
from tidemark.sources.contracts import MODEL, SALES_ORDER
from tidemark.sources.inline import iso_codes
from tidemark.streaming import feeds

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def portable(df: DataFrame) -> DataFrame:
    """Types that every reader shows alike: money as double, days and stamps as text, keys as hex."""

    def plain(f: T.StructField):
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(f.dataType, (T.DateType, T.TimestampNTZType, T.TimestampType)):
            column = column.cast("string")
        elif isinstance(f.dataType, T.BinaryType):
            column = F.lower(F.hex(column))
        elif isinstance(f.dataType, T.VariantType):
            column = F.to_json(column)
        return column.alias(f.name)

    return df.select(*[plain(f) for f in df.schema.fields])


def query(name: str):
    def register(build: Callable[[Scenario], DataFrame]):
        QUERIES[name] = lambda spark, folder: portable(build(Scenario(spark, folder)))
        return build

    return register


# Sources, models, keys


def _model_query(name: str) -> None:
    query(f"model_{name}")(lambda s: s.model(name))


for _name in MODEL:
    _model_query(_name)


def _models(s: Scenario) -> dict[str, DataFrame]:
    """All model tables; lines with their source numbers, as neither counts nor references need new ones."""
    models = {name: s.model(name) for name in MODEL if name != "line_item"}
    return {**models, "line_item": tables.typed(s.source("lineitem"), "line_item")}


@query("model_tables")
def model_tables(s: Scenario) -> DataFrame:
    return tables.row_counts(_models(s))


@query("inline_values")
def inline_values(s: Scenario) -> DataFrame:
    """Customers per country code, the codes being an inline row set."""
    per_location = s.model("customer").groupBy("location_id").agg(F.count(F.lit(1)).alias("customers"))
    return per_location.join(iso_codes(s.spark), "location_id").select("iso2_code", "location_id", "customers")


@query("sample_rows")
def sample_rows(s: Scenario) -> DataFrame:
    return landing.sample_rows(s.model("customer"), 200, "customer_id", seed=7)


@query("model_not_null")
def model_not_null(s: Scenario) -> DataFrame:
    return landing.union_all([keys.check_schema(s.model(n), MODEL[n]) for n in ("customer", "sales_order", "part")])


@query("source_rules")
def source_rules(s: Scenario) -> DataFrame:
    """Column rules of all seven tables, on the values as they are stored."""
    return landing.union_all([keys.check_source(s.source(t.source), t) for t in MODEL.values()])


@query("pk_check_inventory")
def pk_check_inventory(s: Scenario) -> DataFrame:
    """Pairs of part and supplier that several lines hold: why the inventory is made distinct."""
    return keys.key_violations(tables.typed(s.source("lineitem"), "inventory"), MODEL["inventory"].key)


@query("alternate_key_check")
def alternate_key_check(s: Scenario) -> DataFrame:
    """Location names, the alternate key, that occur more than once; beside the names of customers per segment."""
    location = keys.key_violations(s.model("location"), MODEL["location"].alternate).select(F.lit("location").alias("tbl"), "name", "row_count")
    segments = s.model("customer").select(F.col("market_segment").alias("name"))
    repeated = keys.key_violations(segments, ["name"]).select(F.lit("segment").alias("tbl"), "name", "row_count")
    return location.unionByName(repeated)


@query("pk_check")
def pk_check(s: Scenario) -> DataFrame:
    """Repeated line numbers of the source, the reason for renumbering."""
    return keys.key_violations(tables.typed(s.source("lineitem"), "line_item"), MODEL["line_item"].key)


@query("pk_check_renumbered")
def pk_check_renumbered(s: Scenario) -> DataFrame:
    return keys.key_violations(s.lines(), MODEL["line_item"].key)


@query("fk_check")
def fk_check(s: Scenario) -> DataFrame:
    """Orders whose customer the first customer load does not hold."""
    ref = SALES_ORDER.references[0]
    return keys.fk_violations(s.model("sales_order"), s.customer_load_1(), ref.columns, ref.parent_columns)


@query("fk_references")
def fk_references(s: Scenario) -> DataFrame:
    return keys.fk_report(_models(s), MODEL)


@query("fk_exported")
def fk_exported(s: Scenario) -> DataFrame:
    """Where the customer table is referenced, counted against the first customer load."""
    return keys.fk_report({**_models(s), "customer": s.customer_load_1()}, MODEL, "customer", "exported")


# Lookups


@query("customer_location")
def customer_location(s: Scenario) -> DataFrame:
    joined = lookup.lookup_join(s.model("customer"), s.model("location"), "location_id", {"name": "location_name"})
    return joined.select("customer_id", F.col("name").alias("customer_name"), "location_name")


@query("order_customer_fanout")
def order_customer_fanout(s: Scenario) -> DataFrame:
    joined = lookup.lookup_join(s.model("sales_order"), s.model("customer"), "customer_id", {"name": "customer_name"})
    return joined.select("sales_order_id", "customer_name")


@query("lookup_pruned")
def lookup_pruned(s: Scenario) -> DataFrame:
    joined = lookup.lookup_join(s.model("customer"), s.model("location"), "location_id", {}, rely=True)
    return joined.select("customer_id", F.col("name").alias("customer_name"))


@query("point_lookup")
def point_lookup(s: Scenario) -> DataFrame:
    return lookup.point_lookup(s.model("location"), "location_id", "22")


@query("row_counts")
def row_counts(s: Scenario) -> DataFrame:
    return tables.row_counts({"src_customer": s.src_customer(), "src_line_item": s.src_line_item()})


# Loyalty


@query("customer_totals")
def customer_totals(s: Scenario) -> DataFrame:
    return ranking.customer_totals(s.model("customer"), s.model("sales_order"))


@query("top_customers")
def top_customers(s: Scenario) -> DataFrame:
    return ranking.top_customers(ranking.customer_totals(s.model("customer"), s.model("sales_order")))


@query("loyalty_customer")
def loyalty_customer(s: Scenario) -> DataFrame:
    return ranking.loyalty_customer(s.model("customer"), s.model("sales_order"), s.supporters)


@query("loyalty_view")
def loyalty_view(s: Scenario) -> DataFrame:
    ids = [i for (i,) in EARLY_SUPPORTERS]
    ranking.register_loyalty_view(s.spark, f"{s.folder}/customer.parquet", f"{s.folder}/orders.parquet", ids, "v_loyalty_customer")
    return ranking.loyalty_view(s.spark, "v_loyalty_customer")


@query("loyalty_stream")
def loyalty_stream(s: Scenario) -> DataFrame:
    files = feeds.read_files(s.spark, s.folder, s.source("orders").schema, pattern="orders.parquet")
    root = new_folder(s.spark, "loyalty-stream")
    return feeds.loyalty_stream(tables.typed(files, "sales_order"), s.model("customer"), s.supporters, root)


# Landing


@query("landing_initial")
def landing_initial(s: Scenario) -> DataFrame:
    return s.customer_load_1()


@query("landing_delta")
def landing_delta(s: Scenario) -> DataFrame:
    return s.customer_load_2()


@query("latest_load")
def latest_load(s: Scenario) -> DataFrame:
    return landing.latest_load(s.src_line_item())


@query("next_load")
def next_load(s: Scenario) -> DataFrame:
    """The first day's employee batch, found as the load after the fact's newest one."""
    fact = bands.t2_fact_initial(s.employees_landed())
    landed = landing.union_all([s.employees_landed(), s.employee_batch()])
    return landing.next_load(landed, fact, "load_date")


@query("diff_hash")
def diff_hash_variants(s: Scenario) -> DataFrame:
    """The three hash forms; the nickname-like column is NULL for some rows."""
    credit = F.when(F.col("account_balance_usd") > 0, F.col("account_balance_usd"))
    return s.model("customer").select(
        "customer_id",
        diff_hash(["account_balance_usd"]).alias("one_column"),
        diff_hash([credit, "market_segment"]).alias("plain_concat"),
        diff_hash(["name", credit, "market_segment"], "sha1", "^", "x", upper=True, trim=True).alias("delimited"),
    )


@query("whole_orders")
def whole_orders(s: Scenario) -> DataFrame:
    """Sample lines by key, then all lines of their orders."""
    lines = s.lines().withColumn("line_key", F.concat_ws("-", "sales_order_id", "line_number"))
    picked = landing.sample_rows(lines, 200, "line_key", seed=7)
    return landing.whole_entities(lines, "sales_order_id", picked).drop("line_key")


@query("orders_new_and_updated")
def orders_new_and_updated(s: Scenario) -> DataFrame:
    return s.line_batch(with_deletions=False)


@query("orders_with_deletions")
def orders_with_deletions(s: Scenario) -> DataFrame:
    return s.line_batch(with_deletions=True)


# Merge, change feed, dimensions


def _dim_1(s: Scenario) -> DataFrame:
    return scd.scd1_initial(s.customer_load_1(), TRACKED)


def _dim_2(s: Scenario) -> DataFrame:
    return scd.scd2_initial(s.customer_load_1(), TRACKED)


def _dim_3(s: Scenario) -> DataFrame:
    return scd.scd3_initial(s.customer_load_1(), TRACKED, "original_account_balance_usd")


def _latest_customers(s: Scenario) -> DataFrame:
    return landing.latest_load(s.src_customer())


def _merged(s: Scenario) -> merge.MergeResult:
    target = s.customer_load_1()
    return merge.merge(
        target,
        _latest_customers(s),
        ["customer_id"],
        update={"account_balance_usd": F.col("s.account_balance_usd"), "load_ts": F.col("s.load_ts")},
        insert={c: F.col(f"s.{c}") for c in target.columns},
        when=F.col("t.account_balance_usd") != F.col("s.account_balance_usd"),
    )


@query("merge_upsert")
def merge_upsert(s: Scenario) -> DataFrame:
    return _merged(s).rows


@query("merge_changes")
def merge_changes(s: Scenario) -> DataFrame:
    return _merged(s).changes


@query("insert_if_absent")
def insert_if_absent(s: Scenario) -> DataFrame:
    return merge.insert_if_absent(s.customer_load_1(), s.customer_load_2(), ["customer_id"])


@query("change_feed")
def change_feed(s: Scenario) -> DataFrame:
    return merge.change_feed(
        s.customer_load_1().drop("load_ts"), s.customer_load_2().drop("load_ts"), ["customer_id"]
    )


@query("bulk_update")
def bulk_update(s: Scenario) -> DataFrame:
    return update_where(
        s.model("customer"),
        {"account_balance_usd": F.col("account_balance_usd") + 1, "market_segment": F.lower("market_segment")},
        F.col("account_balance_usd") <= 0,
    )


@query("scd1")
def scd1(s: Scenario) -> DataFrame:
    return scd.scd1(_dim_1(s), _latest_customers(s), ["customer_id"], TRACKED).rows


@query("scd2")
def scd2(s: Scenario) -> DataFrame:
    return scd.scd2(_dim_2(s), _latest_customers(s), ["customer_id"], TRACKED)


@query("scd2_multi_batch")
def scd2_multi_batch(s: Scenario) -> DataFrame:
    return scd.scd2_loads(_dim_2(s), [s.customer_load_2(), s.customer_load_3()], ["customer_id"], TRACKED)


@query("scd2_stream")
def scd2_stream(s: Scenario) -> DataFrame:
    """Loads 2 and 3 as landed files, applied to the dimension by a stream."""
    root = new_folder(s.spark, "scd2-stream")
    landed = None
    for load in (s.customer_load_2(), s.customer_load_3()):
        load.write.mode("append").parquet(f"{root}/landed")
        landed = load.schema
    stream = feeds.read_files(s.spark, f"{root}/landed", landed)
    return feeds.scd2_stream(stream, _dim_2(s), ["customer_id"], TRACKED, root)


def _type_3(s: Scenario) -> DataFrame:
    original = "original_account_balance_usd"
    return scd.scd3(_dim_3(s), _latest_customers(s), ["customer_id"], TRACKED, original).rows


@query("scd3")
def scd3(s: Scenario) -> DataFrame:
    return _type_3(s)


@query("scd3_changed")
def scd3_changed(s: Scenario) -> DataFrame:
    return scd.changed_from_original(_type_3(s), "account_balance_usd", "original_account_balance_usd")


# Reverse-balance facts


@query("rb_initial")
def rb_initial(s: Scenario) -> DataFrame:
    return s.line_fact_initial()


@query("load_history")
def load_history(s: Scenario) -> DataFrame:
    return balance.load_history(s.src_line_item())


@query("load_history_full")
def load_history_full(s: Scenario) -> DataFrame:
    return balance.load_history(s.src_line_item_recovered(), full=True)


@query("detect_deletions")
def detect_deletions(s: Scenario) -> DataFrame:
    return s.line_deletions().select(
        "next_order_load", "next_line_load", "load_ts", "sales_order_id", "line_number", "load_type"
    )


def _lost_lines(s: Scenario, reuse: bool) -> DataFrame:
    """Deletions over all loads of a landing area with three."""
    landed = s.src_line_item_3()
    lost = balance.detect_deletions(landed, balance.load_history(landed, full=True), reuse=reuse)
    return lost.select("next_order_load", "next_line_load", "load_ts", "sales_order_id", "line_number", "load_type")


@query("detect_deletions_full")
def detect_deletions_full(s: Scenario) -> DataFrame:
    return _lost_lines(s, reuse=False)


@query("detect_deletions_reuse")
def detect_deletions_reuse(s: Scenario) -> DataFrame:
    return _lost_lines(s, reuse=True)


@query("load_history_loads")
def load_history_loads(s: Scenario) -> DataFrame:
    """Every load of an order that has a next one, over three loads."""
    return balance.load_history(s.src_line_item_3(), full=True)


@query("logical_deletes")
def logical_deletes(s: Scenario) -> DataFrame:
    return balance.logical_deletes(s.line_deletions(), LINE_ADDITIVE)


def _line_merge(s: Scenario) -> merge.MergeResult:
    return balance.rb_merge(s.line_fact_initial(), s.src_line_item_recovered(), LINE_KEYS, LINE_UPDATED)


@query("rb_merge_after")
def rb_merge_after(s: Scenario) -> DataFrame:
    return _line_merge(s).rows


@query("rb_reverse_before")
def rb_reverse_before(s: Scenario) -> DataFrame:
    return balance.rb_reversals(_line_merge(s).updates, LINE_ADDITIVE)


@query("reverse_balance")
def reverse_balance(s: Scenario) -> DataFrame:
    return balance.reverse_balance(
        s.line_fact_initial(), s.src_line_item_recovered(), LINE_KEYS, LINE_UPDATED, LINE_ADDITIVE
    )


@query("rb_inspect")
def rb_inspect(s: Scenario) -> DataFrame:
    """The deletion rows, in order and line order."""
    return balance.rb_rows(s.line_fact(), F.col("load_type") == balance.DELETION, LINE_KEYS)


@query("rb_as_at_totals")
def rb_as_at_totals(s: Scenario) -> DataFrame:
    """Sums per as-at and image: summed up to an as-at they give the state of that time."""
    return (
        s.line_fact()
        .groupBy("as_at_dts", "load_type", "is_after_image")
        .agg(F.count(F.lit(1)).alias("row_count"), *[F.sum(c).alias(f"sum_{c}") for c in LINE_ADDITIVE])
    )


# Time-banded facts


@query("employee_source")
def employee_source(s: Scenario) -> DataFrame:
    return s.employees()


@query("employee_landing")
def employee_landing(s: Scenario) -> DataFrame:
    return s.employees_landed()


@query("employee_daily")
def employee_daily(s: Scenario) -> DataFrame:
    return s.employee_batch()


@query("type2_fact_initial")
def type2_fact_initial(s: Scenario) -> DataFrame:
    return bands.t2_fact_initial(s.employees_landed())


@query("type2_fact_load")
def type2_fact_load(s: Scenario) -> DataFrame:
    landed = landing.union_all([s.employees_landed(), s.employee_batch()])
    return bands.type2_fact(bands.t2_fact_initial(s.employees_landed()), landed)


@query("t2_five_days")
def t2_five_days(s: Scenario) -> DataFrame:
    return s.employee_fact()


@query("active_now")
def active_now(s: Scenario) -> DataFrame:
    return bands.active_now(s.employee_fact())


@query("active_as_of")
def active_as_of(s: Scenario) -> DataFrame:
    return bands.active_employees(bands.as_of(s.employee_fact(), day(FIRST_DAY)))


@query("active_in_year")
def active_in_year(s: Scenario) -> DataFrame:
    return bands.active_employees(bands.in_period(s.employee_fact(), day("2001-01-01"), day("2001-12-31")))


def _cohort(s: Scenario) -> DataFrame:
    rows = bands.as_of(s.employee_fact(), day(DAYS[-1]))
    return bands.hired_between(rows, day("2000-01-01"), day("2000-03-31"))


@query("cohort_as_of")
def cohort_as_of(s: Scenario) -> DataFrame:
    return bands.active_employees(_cohort(s))


@query("cohort_promoted")
def cohort_promoted(s: Scenario) -> DataFrame:
    return bands.active_employees(bands.ever_promoted(_cohort(s), s.employee_fact()))


@query("daily_movements")
def daily_movements(s: Scenario) -> DataFrame:
    return bands.movements(s.employee_fact(), day(FIRST_DAY))


# Documents


@query("json_land")
def json_land(s: Scenario) -> DataFrame:
    landed, _ = documents.land_json(s.source("events").select("event_id", "props"), "props", LOAD_NAME, ts(LOAD_1))
    return landed


@query("json_rejects")
def json_rejects(s: Scenario) -> DataFrame:
    """Turns of conversations read as JSON: the text that is none."""
    turns = s.source("conversations").select("conv_id", "turn", "text")
    _, rejected = documents.land_json(turns, "text", LOAD_NAME, ts(LOAD_1))
    return rejected


@query("json_extract")
def json_extract(s: Scenario) -> DataFrame:
    return s.order_documents().select(
        json_get("v", "name").alias("order_name"),
        json_get("v", "nickname").alias("nickname"),
        json_get("v", "opened", "int").alias("opened"),
        json_get("v", "carrier.name").alias("carrier_name"),
        json_get("v", "no_such_attribute").alias("missing"),
    )


@query("json_event_props")
def json_event_props(s: Scenario) -> DataFrame:
    landed, _ = documents.land_json(s.source("events").select("event_type", "props"), "props", LOAD_NAME, ts(LOAD_1))
    return landed.groupBy("event_type").agg(
        F.sum(json_get("v", "k", "bigint")).alias("sum_k"), F.count(json_get("v", "nothing")).alias("count_missing")
    )


@query("json_array_ends")
def json_array_ends(s: Scenario) -> DataFrame:
    return s.order_documents().select(
        json_get("v", "name").alias("order_name"),
        F.size(json_array("v", "years")).alias("year_count"),
        array_first("v", "years", "int").alias("active_from"),
        array_last("v", "years", "int").alias("active_to"),
        array_last("v", "stops[1].services").alias("last_service"),
    )


@query("flatten")
def flatten(s: Scenario) -> DataFrame:
    stops = documents.flatten(s.order_documents(), "v", "stops", "stop")
    return stops.select(
        json_get("v", "name").alias("order_name"),
        F.col("stop_index"),
        json_get("stop", "name").alias("stop_name"),
        json_get("stop", "nickname").alias("stop_nickname"),
    )


@query("flatten_nested")
def flatten_nested(s: Scenario) -> DataFrame:
    stops = documents.flatten(s.order_documents(), "v", "stops", "stop")
    return documents.flatten(stops, "stop", "services", "service").select(
        json_get("v", "name").alias("order_name"),
        json_get("stop", "name").alias("stop_name"),
        json_get("service", "").alias("service"),
    )


@query("flatten_outer")
def flatten_outer(s: Scenario) -> DataFrame:
    """As the nested flatten, but a stop without services stays."""
    stops = documents.flatten(s.order_documents(), "v", "stops", "stop")
    return documents.flatten(stops, "stop", "services", "service", outer=True).select(
        json_get("stop", "name").alias("stop_name"), json_get("service", "").alias("service")
    )


@query("flatten_count")
def flatten_count(s: Scenario) -> DataFrame:
    dock = F.lower(json_get("item", "nickname")) == "dock"
    return documents.count_nested(s.order_documents(), "v", "stops", "services", dock)


def _document_nodes(s: Scenario) -> DataFrame:
    return documents.flatten_all(s.order_documents().select("sales_order_id", "v"), "v")


@query("flatten_recursive")
def flatten_recursive(s: Scenario) -> DataFrame:
    """Every node; values of leaves as text, NULL for objects and arrays."""
    scalar = F.try_variant_get("value", "$", "struct<_:variant>").isNull()  # an object; its fields are not read
    scalar = scalar & F.try_variant_get("value", "$", "array<variant>").isNull()
    leaf = F.when(scalar, F.try_variant_get("value", "$", "string"))
    return _document_nodes(s).select("sales_order_id", "key", "path", leaf.alias("leaf_value"))


@query("json_depth")
def json_depth(s: Scenario) -> DataFrame:
    """Each path of the documents with its depth and the number of documents that have it."""
    counted = _document_nodes(s).groupBy("key", "path").agg(F.count(F.lit(1)).alias("documents"))
    return order_by(counted.select(path_depth("path").alias("depth"), "key", "path", "documents"), "depth", "path")


@query("shred_dimension")
def shred_dimension(s: Scenario) -> DataFrame:
    return s.shredded().service


@query("shred_dimension_carrier")
def shred_dimension_carrier(s: Scenario) -> DataFrame:
    return s.shredded().carrier


@query("shred_rollup")
def shred_rollup(s: Scenario) -> DataFrame:
    return s.shredded().party


@query("shred_multivalue")
def shred_multivalue(s: Scenario) -> DataFrame:
    return s.shredded().party_years


@query("shred_bridge")
def shred_bridge(s: Scenario) -> DataFrame:
    return s.shredded().party_services


@query("surrogate_key")
def surrogate_key(s: Scenario) -> DataFrame:
    """Keys for all customers in name order, after the highest location key."""
    start = s.model("location").agg(F.max("location_id")).scalar()
    return numbering.assign_keys(s.model("customer").select("name", "market_segment"), "customer_sk", ["name"], start)


@query("shredded_star")
def shredded_star(s: Scenario) -> DataFrame:
    t = s.shredded()
    return shred.shredded_star(
        t.party, t.carrier, t.party_services, t.service, "party_id", "carrier_id", "service_id"
    )


# Hierarchies


@query("hierarchy_path")
def hierarchy_path(s: Scenario) -> DataFrame:
    walked = hierarchy.connect_by(s.organisation(), "node_id", "superior_id", F.col("rank") == "World", "name")
    return order_by(walked, "level", "node_id")


def _branches(s: Scenario) -> DataFrame:
    return hierarchy.branches(
        s.organisation(), "node_id", "superior_id", F.col("rank") == "Region", F.col("rank") == "World", "name"
    )


@query("hierarchy_branches")
def hierarchy_branches(s: Scenario) -> DataFrame:
    return order_by(_branches(s), "branch", "level", "node_id")


@query("hierarchy_named_branches")
def hierarchy_named_branches(s: Scenario) -> DataFrame:
    """The branch below the region whose second word is EAST, each row with the second part of its name."""
    east = (F.col("rank") == "Region") & (strtok("name", " ", 2) == "EAST")
    found = hierarchy.branches(s.organisation(), "node_id", "superior_id", east, F.col("rank") == "World", "name")
    return found.select("node_id", "path", "branch", "level", strtok("name", "#_ ", 2).alias("second_part"))


@query("hierarchy_edges")
def hierarchy_edges(s: Scenario) -> DataFrame:
    return hierarchy.edge_nodes(_branches(s), "node_id", "superior_id")


# Data Vault


@query("nation_iso")
def nation_iso(s: Scenario) -> DataFrame:
    return s.vault_nation()


@query("vault_landing")
def vault_landing(s: Scenario) -> DataFrame:
    """Landed customers of the first load with the number of orders landed beside them."""
    customers, orders = s.vault_staged(1)
    per_customer = orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("total_price_usd").alias("order_total_usd")
    )
    return customers.drop("hub_customer_hk", "customer_hash_diff").join(per_customer, "customer_id", "left")


@query("load_audit")
def load_audit(s: Scenario) -> DataFrame:
    first, second = s.vault_load(1), s.vault_load(2)
    return vault.load_audit(
        {"customer": first[0].unionByName(second[0]), "order": first[1].unionByName(second[1])}
    )


@query("vault_hash_customer")
def vault_hash_customer(s: Scenario) -> DataFrame:
    return vault.stage_customer(s.vault_load(1)[0])


@query("vault_hash_order")
def vault_hash_order(s: Scenario) -> DataFrame:
    return vault.stage_order(s.vault_load(1)[1])


@query("hub_load")
def hub_load(s: Scenario) -> DataFrame:
    """Customers that the second load adds to the hub."""
    state, (customers, _) = s.vault_after(1), s.vault_staged(2)
    return vault.load_hub(state.hub_customer, customers, "hub_customer_hk", "customer_id")


@query("satellite_load")
def satellite_load(s: Scenario) -> DataFrame:
    state, (customers, _) = s.vault_after(1), s.vault_staged(2)
    return vault.load_sat(
        state.sat_sys1_customer, customers, "hub_customer_hk", "customer_hash_diff", vault.CUSTOMER_ATTRIBUTES
    )


def _satellite_reload(s: Scenario, compare: str) -> DataFrame:
    """The first load once more over both: values that come back."""
    state, (customers, _) = s.vault_after(2), s.vault_staged(1)
    again = customers.withColumn("load_ts", ts("1995-12-03 00:00:00"))
    return vault.load_sat(
        state.sat_sys1_customer, again, "hub_customer_hk", "customer_hash_diff", vault.CUSTOMER_ATTRIBUTES, compare
    )


@query("satellite_latest")
def satellite_latest(s: Scenario) -> DataFrame:
    return _satellite_reload(s, "latest")


@query("link_load")
def link_load(s: Scenario) -> DataFrame:
    state, (_, orders) = s.vault_after(1), s.vault_staged(2)
    return vault.load_link(
        state.lnk_customer_order, orders, "lnk_customer_order_hk", ["hub_customer_hk", "hub_order_hk"]
    )


@query("reference_load")
def reference_load(s: Scenario) -> DataFrame:
    return vault.load_ref(s.vault_nation())


@query("multi_target_load")
def multi_target_load(s: Scenario) -> DataFrame:
    """What one batch adds to each of its targets."""
    state = s.vault_after(1)
    added = vault.vault_additions(state, *s.vault_staged(2))
    return vault.vault_counts(added)


@query("vault_counts")
def vault_counts(s: Scenario) -> DataFrame:
    return vault.vault_counts(s.vault_after(1).tables())


@query("vault_incremental")
def vault_incremental(s: Scenario) -> DataFrame:
    return s.vault_after(2).sat_sys1_customer


@query("vault_incremental_counts")
def vault_incremental_counts(s: Scenario) -> DataFrame:
    return vault.vault_counts(s.vault_after(2).tables())


@query("vault_stream")
def vault_stream(s: Scenario) -> DataFrame:
    """Both loads landed as files, then fed to the vault by two streams."""
    root = new_folder(s.spark, "vault-stream")
    for number in (1, 2):
        customers, orders = s.vault_staged(number)
        customers.write.mode("append").parquet(f"{root}/src/customer")
        orders.write.mode("append").parquet(f"{root}/src/orders")
    customers, orders = s.vault_staged(1)
    schemas = vault.VAULT_SCHEMAS
    by_customer = {n: schemas[n] for n in ("hub_customer", "sat_sys1_customer")}
    by_order = {n: schemas[n] for n in ("hub_order", "lnk_customer_order", "sat_sys1_order")}
    feeds.append_stream(
        feeds.read_files(s.spark, f"{root}/src/customer", customers.schema),
        by_customer,
        root,
        feeds.customer_additions(vault.CUSTOMER_ATTRIBUTES),
    )
    feeds.append_stream(
        feeds.read_files(s.spark, f"{root}/src/orders", orders.schema),
        by_order,
        root,
        feeds.order_additions(vault.ORDER_ATTRIBUTES),
    )
    return vault.vault_counts({n: feeds.read_appended(s.spark, root, n, schema) for n, schema in schemas.items()})


# Snapshots, computed columns, ordering


@query("snapshot_update")
def snapshot_update(s: Scenario) -> DataFrame:
    return s.customer_snapshot_2()


@query("snapshot_diff_count")
def snapshot_diff_count(s: Scenario) -> DataFrame:
    changed = snapshot.changed_rows(
        s.model("customer"), s.customer_snapshot_2(), ["customer_id", "account_balance_usd"]
    )
    return changed.agg(F.count(F.lit(1)).alias("cnt"))


@query("snapshot_before_after")
def snapshot_before_after(s: Scenario) -> DataFrame:
    return snapshot.before_after(
        s.model("customer"), s.customer_snapshot_2(), "customer_id", ["account_balance_usd"]
    )


@query("snapshot_versions")
def snapshot_versions(s: Scenario) -> DataFrame:
    """Two versions written and read back: the rows that the second one changed."""
    root = new_folder(s.spark, "snapshot")
    snapshot.write_version(s.model("customer"), root, 0)
    snapshot.write_version(s.customer_snapshot_2(), root, 1)
    before, after = (snapshot.read_version(s.spark, root, n) for n in (0, 1))
    return merge.change_feed(before, after, ["customer_id"])


@query("computed_columns")
def computed_columns(s: Scenario) -> DataFrame:
    balance_usd = F.col("account_balance_usd")

    def rate(text: str):
        return balance_usd * F.lit(text).cast("decimal(2,2)")

    return with_computed(
        s.model("customer"),
        {
            "sys_message": F.lit("Legacy data, do not use in reporting without re-mapping"),
            "legacy_customer_id": F.concat(F.lit("x"), F.col("customer_id").cast("string")),
            "tax_amount_usd": F.when(F.col("market_segment") == "MACHINERY", rate("0.10"))
            .when(F.col("market_segment") == "AUTOMOBILE", rate("0.15"))
            .otherwise(rate("0.20"))
            .cast("decimal(12,2)"),
        },
    )


@query("default_columns")
def default_columns(s: Scenario) -> DataFrame:
    """Customers in good standing give no stamp and get the default; the others give NULL."""
    customer = s.model("customer")
    default = {"load_dts": ts(LOAD_2)}
    not_given = customer.filter("account_balance_usd > 0").select("customer_id", "name")
    given = customer.filter("account_balance_usd <= 0").select(
        "customer_id", "name", F.lit(None).cast("timestamp_ntz").alias("load_dts")
    )
    rows = with_defaults(not_given, default).unionByName(with_defaults(given, default))
    return with_computed(rows, {"v_name": F.concat(F.lit("Hi, my name is "), F.col("name"))})


def _credit(s: Scenario) -> DataFrame:
    """Balances, NULL when not positive."""
    credit = F.when(F.col("account_balance_usd") > 0, F.col("account_balance_usd"))
    segment = F.when(F.col("account_balance_usd") > 0, F.col("market_segment"))
    return s.model("customer").select("customer_id", credit.alias("credit_usd"), segment.alias("segment"))


@query("order_nulls_desc")
def order_nulls_desc(s: Scenario) -> DataFrame:
    return order_by(_credit(s), "-credit_usd", "-segment", "customer_id")


@query("order_nulls_last")
def order_nulls_last(s: Scenario) -> DataFrame:
    return order_by(_credit(s), "-credit_usd", "customer_id", nulls="last")


@query("order_nulls_first")
def order_nulls_first(s: Scenario) -> DataFrame:
    return order_by(_credit(s), "credit_usd", "customer_id", nulls="first")
