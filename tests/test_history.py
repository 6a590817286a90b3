"""Merge, dimensions, reverse-balance facts and bands: examples and invariants."""

import datetime as dt

import pytest
from rows_of_frames import rows
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.operators import balance, bands, scd, snapshot
from tidemark.operators.merge import change_feed, insert_if_absent, merge, paired
from tidemark.session import new_folder

FEW = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
OPEN = dt.datetime(9999, 12, 31)


def at(n):
    return dt.datetime(2020, 1, n)


def load(spark, values, n):
    return spark.createDataFrame([(k, v, at(n)) for k, v in values.items()], "k long, v long, load_ts timestamp_ntz")


def test_merge_rows_and_images(spark):
    target = spark.createDataFrame([(1, 1, "a"), (2, 2, "b"), (3, 3, "c")], "k long, v long, other string")
    source = spark.createDataFrame([(2, 20, "x"), (3, 3, "y"), (4, 4, "z")], "k long, v long, other string")
    result = merge(
        target,
        source,
        ["k"],
        update={"v": F.col("s.v")},
        insert={c: F.col(f"s.{c}") for c in target.columns},
        when=F.col("t.v") != F.col("s.v"),
    )
    assert rows(result.rows) == [(1, 1, "a"), (2, 20, "b"), (3, 3, "c"), (4, 4, "z")]
    assert rows(result.changes) == [
        (2, 2, "b", "DELETE", True),
        (2, 20, "b", "INSERT", True),
        (4, 4, "z", "INSERT", False),
    ]
    only_updates = merge(target, source, ["k"], update={"v": F.col("s.v")})
    assert rows(only_updates.rows, "k", "v") == [(1, 1), (2, 20), (3, 3)]


def test_merge_refuses_two_source_rows_for_a_key(spark):
    target = spark.createDataFrame([(1, 1)], "k long, v long")
    source = spark.createDataFrame([(1, 2), (1, 3)], "k long, v long")
    with pytest.raises(PySparkException, match="more than one source row for key 1"):
        merge(target, source, ["k"], update={"v": F.col("s.v")}).rows.collect()


def test_merge_leaves_rows_whose_condition_is_null(spark):
    target = spark.createDataFrame([(1, None)], "k long, v long")
    source = spark.createDataFrame([(1, 2)], "k long, v long")
    result = merge(target, source, ["k"], update={"v": F.col("s.v")}, when=F.col("t.v") != F.col("s.v"))
    assert rows(result.rows) == [(1, None)] and result.changes.count() == 0


def test_change_feed_is_null_safe(spark):
    before = spark.createDataFrame([(1, None), (2, 2), (3, 3)], "k long, v long")
    after = spark.createDataFrame([(1, 1), (2, 2), (4, None)], "k long, v long")
    assert rows(change_feed(before, after, ["k"])) == [
        (1, 1, "INSERT", True),
        (1, None, "DELETE", True),
        (3, 3, "DELETE", False),
        (4, None, "INSERT", False),
    ]
    assert rows(insert_if_absent(before, after, ["k"])) == [(1, None), (2, 2), (3, 3), (4, None)]


LOADS = st.lists(st.dictionaries(st.integers(1, 6), st.integers(0, 2), max_size=6), min_size=1, max_size=3)


@FEW
@given(first=st.dictionaries(st.integers(1, 6), st.integers(0, 2), max_size=6), later=LOADS)
def test_type_2_bands(spark, first, later):
    dim = scd.scd2_initial(load(spark, first, 1), ["v"])
    batches = [load(spark, values, n) for n, values in enumerate(later, start=2)]
    result = scd.scd2_loads(dim, batches, ["k"], ["v"])

    expected, current = [], {k: (v, 1) for k, v in first.items()}
    for n, values in enumerate(later, start=2):
        for k, v in values.items():
            if k in current and current[k][0] != v:
                expected.append((k, current[k][0], at(current[k][1]), at(n) - dt.timedelta(seconds=1)))
            if k not in current or current[k][0] != v:
                current[k] = (v, n)
    expected += [(k, v, at(n), OPEN) for k, (v, n) in current.items()]
    assert rows(result, "k", "v", "from_dts", "to_dts") == sorted(expected, key=repr)

    again = scd.scd2_loads(result, batches[-1:], ["k"], ["v"])
    assert rows(again, "k", "v", "from_dts", "to_dts") == sorted(expected, key=repr)


def test_types_1_and_3(spark):
    first, second = load(spark, {1: 1, 2: 2}, 1), load(spark, {1: 5, 2: 2, 3: 3}, 2)
    one = scd.scd1(scd.scd1_initial(first, ["v"]), second, ["k"], ["v"])
    assert rows(one.rows, "k", "v", "load_ts") == [(1, 5, at(2)), (2, 2, at(1)), (3, 3, at(2))]
    three = scd.scd3(scd.scd3_initial(first, ["v"], "v0"), second, ["k"], ["v"], "v0").rows
    assert rows(three, "k", "v", "v0") == [(1, 5, 1), (2, 2, 2), (3, 3, 3)]
    assert rows(scd.changed_from_original(three, "v", "v0"), "k") == [(1,)]


LINE = "sales_order_id long, line_number long, qty long, flag string, load_ts timestamp_ntz, load_type string"
KEYS = ["sales_order_id", "line_number"]


def lines(spark, data, n, kind):
    return spark.createDataFrame([(o, l, q, "N", at(n), kind) for (o, l), q in data.items()], LINE)


def day_of_lines(spark, landed, fact, data, n):
    """Land a batch, recover what it lost, and load the fact."""
    landed = landed.unionByName(lines(spark, data, n, "update"))
    lost = balance.detect_deletions(landed, balance.load_history(landed))
    landed = landed.unionByName(balance.logical_deletes(lost, ["qty"]))
    return landed, balance.reverse_balance(fact, landed, KEYS, ["qty", "flag"], ["qty"])


def test_a_changed_a_lost_and_a_new_line(spark):
    landed = lines(spark, {(1, 1): 10, (1, 2): 20, (2, 1): 5}, 1, "initial")
    fact = balance.rb_initial(landed)
    landed, fact = day_of_lines(spark, landed, fact, {(1, 1): 11, (3, 1): 7}, 2)
    assert rows(fact, *KEYS, "qty", "as_at_dts", "is_after_image", "load_type") == sorted(
        [
            (1, 1, 10, at(1), True, "initial"),
            (1, 1, -10, at(2), False, "initial"),
            (1, 1, 11, at(2), True, "update"),
            (1, 2, 20, at(1), True, "initial"),
            (1, 2, -20, at(2), False, "initial"),
            (1, 2, 0, at(2), True, "deletion"),
            (2, 1, 5, at(1), True, "initial"),
            (3, 1, 7, at(2), True, "update"),
        ],
        key=repr,
    )
    assert balance.rb_rows(fact, F.col("load_type") == "deletion", KEYS).count() == 1


def test_merge_then_reversal_gives_the_same_fact(spark):
    landed = lines(spark, {(1, 1): 10, (1, 2): 20, (2, 1): 5}, 1, "initial")
    fact = balance.rb_initial(landed)
    landed = landed.unionByName(lines(spark, {(1, 1): 11, (1, 2): 21, (3, 1): 7}, 2, "update"))
    merged = balance.rb_merge(fact, landed, KEYS, ["qty", "flag"])
    two_steps = merged.rows.unionByName(balance.rb_reversals(merged.updates, ["qty"]))
    one_step = balance.reverse_balance(fact, landed, KEYS, ["qty", "flag"], ["qty"])
    assert rows(two_steps, *fact.columns) == rows(one_step, *fact.columns)
    stored = balance.rb_reversals(paired(merged.changes, KEYS), ["qty"])
    assert rows(stored) == rows(balance.rb_reversals(merged.updates, ["qty"]))


DAY = st.dictionaries(st.tuples(st.integers(1, 3), st.integers(1, 3)), st.integers(1, 9), min_size=1, max_size=6)


@FEW
@given(first=DAY, second=DAY, third=DAY)
def test_sums_up_to_an_as_at_give_the_state_of_that_time(spark, first, second, third):
    landed = lines(spark, first, 1, "initial")
    fact = balance.rb_initial(landed)
    state = dict(first)
    for n, data in ((2, second), (3, third)):
        landed, fact = day_of_lines(spark, landed, fact, data, n)
        touched = {o for o, _ in data}
        state = {k: q for k, q in state.items() if k[0] not in touched} | data
        sums = {r[0]: r[1] for r in fact.groupBy("sales_order_id").agg(F.sum("qty")).collect()}
        expected: dict[int, int] = {}
        for (order, _), qty in state.items():
            expected[order] = expected.get(order, 0) + qty
        assert sums == expected


def test_reused_line_numbers(spark):
    landed = (
        lines(spark, {(1, 1): 1, (1, 2): 2}, 1, "initial")
        .unionByName(lines(spark, {(1, 1): 1}, 2, "update"))
        .unionByName(lines(spark, {(1, 1): 1, (1, 2): 9}, 3, "update"))
    )
    history = balance.load_history(landed, full=True)
    assert balance.detect_deletions(landed, history).count() == 0
    lost = balance.detect_deletions(landed, history, reuse=True)
    assert rows(lost, "line_number", "load_ts", "next_order_load") == [(2, at(1), at(2))]


def test_employee_bands(spark):
    source = spark.createDataFrame(
        [
            (1, 9, "100.07", "2000-01-01", "x", "Clerk#1", ""),
            (2, 9, "100.05", "2000-02-01", "x", "Clerk#9", ""),
            (3, 9, "200.00", "2000-06-01", "x", "Clerk#9", ""),
        ],
        "employee_id long, department_id long, salary_usd string, hire_date string, "
        "security_clearance string, clerk string, comment string",
    ).withColumns({"salary_usd": F.col("salary_usd").cast("decimal(12,2)"), "hire_date": F.to_date("hire_date")})
    today = lambda text: F.lit(text).cast("date")
    landed = bands.land_employees(source, today("2000-04-01"))
    assert rows(landed, "employee_id", "termination_date", "is_active", "last_change", "is_contractor") == [
        (1, dt.date(9999, 12, 31), True, "Hire", False),
        (2, dt.date(2000, 5, 11), True, "Hire", True),
    ]
    fact = bands.t2_fact_initial(landed)
    changes = bands.employee_changes(source, bands.current_staff(fact), today("2000-04-02"), F.lit(True))
    assert rows(changes, "employee_id", "salary_usd", "last_change", "comment", "is_active") == sorted(
        [
            (1, dt_decimal("100.07"), "Leaver", "Left ", False),
            (2, dt_decimal("110.06"), "Promoted", "+10% ", True),
        ],
        key=repr,
    )
    after = bands.type2_fact(fact, landed.unionByName(changes))
    assert rows(after, "employee_id", "from_date", "to_date", "last_change") == [
        (1, dt.date(1900, 1, 1), dt.date(2000, 4, 1), "Hire"),
        (1, dt.date(2000, 4, 2), dt.date(9999, 12, 31), "Leaver"),
        (2, dt.date(1900, 1, 1), dt.date(2000, 4, 1), "Hire"),
        (2, dt.date(2000, 4, 2), dt.date(9999, 12, 31), "Promoted"),
    ]
    assert bands.active_now(after).first()[0] == 1
    assert bands.active_employees(bands.as_of(after, today("2000-04-01"))).first()[0] == 2
    assert bands.active_employees(bands.ever_promoted(after, after)).first()[0] == 1
    assert rows(bands.movements(after, today("2000-04-01"))) == [
        (dt.date(2000, 4, 2), "Leaver", 1),
        (dt.date(2000, 4, 2), "Promoted", 1),
    ]
    hire = bands.employee_changes(source, bands.current_staff(fact), today("2000-06-02"), F.lit(False))
    assert rows(hire, "employee_id", "last_change", "termination_date") == [(3, "Hire", dt.date(2000, 12, 18))]


def dt_decimal(text):
    from decimal import Decimal

    return Decimal(text)


def test_versions_and_before_after(spark):
    before = spark.createDataFrame([(1, 1), (2, None), (3, 3)], "k long, v long")
    after = spark.createDataFrame([(1, 2), (2, 5), (3, 3)], "k long, v long")
    root = new_folder(spark, "versions")
    snapshot.write_version(before, root, 0)
    snapshot.write_version(after, root, 1)
    snapshot.write_version(after, root, 1)
    assert snapshot.last_version(spark, root) == 1
    old, new = snapshot.read_version(spark, root, 0), snapshot.read_version(spark, root, 1)
    assert rows(snapshot.before_after(old, new, "k", ["v"])) == [(1, 1, 2), (2, None, 5)]
    assert rows(snapshot.changed_rows(old, new, ["k", "v"])) == [(1, 1), (2, None)]
