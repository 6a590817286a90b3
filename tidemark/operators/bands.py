"""Time-banded facts about employees: daily change batches, loads and as-of questions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.hashing import diff_hash
from tidemark.operators.scd import Bands, band_load, band_step
from tidemark.sources.landing import next_load

# The columns that a load may change, and those in the row hash.
UPDATED = ["salary_usd", "hire_date", "termination_date", "comment", "last_change", "is_active", "load_date"]
HASHED = ["salary_usd", "hire_date", "termination_date", "comment", "last_change", "load_date", "is_active"]


def open_date() -> Column:
    return F.lit("9999-12-31").cast("date")


def first_date() -> Column:
    return F.lit("1900-01-01").cast("date")


def employees(sales_order: DataFrame, clerk: Column) -> DataFrame:
    """Orders renamed as employees."""
    return sales_order.select(
        F.col("sales_order_id").alias("employee_id"),
        F.col("customer_id").alias("department_id"),
        F.col("total_price_usd").alias("salary_usd"),
        F.col("order_date").alias("hire_date"),
        F.col("order_priority").alias("security_clearance"),
        clerk.alias("clerk"),
        F.lit("").alias("comment"),
    )


def last_digit(value: Column) -> Column:
    return F.right(value.cast("string"), F.lit(1)).cast("int")


def _planned_end(open_below: int) -> Column:
    """Open end for clerks whose last digit is below a bound, else hire date plus days.

    The days are the last three digits of the salary, rounded to whole dollars.
    """
    whole = F.round("salary_usd", 0).cast("decimal(12,0)").cast("string")
    days = F.right(whole, F.lit(3)).cast("int")
    return F.when(last_digit(F.col("clerk")) < open_below, open_date()).otherwise(F.date_add("hire_date", days))


def land_employees(source: DataFrame, today: Column) -> DataFrame:
    """First landing: everybody hired before the load day, with end date and active flag."""
    ended = source.filter(F.col("hire_date") < today).withColumn("termination_date", _planned_end(3))
    active = F.col("termination_date") >= today
    return ended.select(
        "employee_id",
        "department_id",
        (last_digit(F.col("clerk")) > 7).alias("is_contractor"),
        "salary_usd",
        "hire_date",
        "termination_date",
        "security_clearance",
        "clerk",
        active.alias("is_active"),
        F.when(active, "Hire").otherwise("Leaver").alias("last_change"),
        "comment",
        today.alias("load_date"),
    )


def employee_changes(source: DataFrame, staff: DataFrame, today: Column, reviewed: Column) -> DataFrame:
    """One day's batch: new hires of the day before, leavers and promotions.

    `staff` has one row per employee, as it stands before the day. Of the active staff hired
    more than two days before, those under `reviewed` change: a salary that ends in 7, 8 or 9
    leaves, any other rises by a tenth. `staff` is read once: both rules are columns.
    """
    yesterday = F.date_sub(today, 1)
    hires = source.filter(F.col("hire_date") == yesterday).select(
        "employee_id",
        "department_id",
        (last_digit(F.col("clerk")) > 7).alias("is_contractor"),
        "salary_usd",
        "hire_date",
        _planned_end(8).alias("termination_date"),
        "security_clearance",
        "clerk",
        F.lit(True).alias("is_active"),
        F.lit("Hire").alias("last_change"),
        "comment",
        today.alias("load_date"),
    )
    existing = staff.filter(F.col("is_active") & (F.col("hire_date") < F.date_sub(today, 2)) & reviewed)
    leaves = last_digit(F.col("salary_usd")) > 6
    money = staff.schema["salary_usd"].dataType
    changes = existing.select(
        "employee_id",
        "department_id",
        "is_contractor",
        F.when(leaves, F.col("salary_usd"))
        .otherwise((F.col("salary_usd") * F.lit("1.1").cast("decimal(2,1)")).cast(money))
        .cast(money)
        .alias("salary_usd"),
        "hire_date",
        F.when(leaves, yesterday).otherwise(F.col("termination_date")).alias("termination_date"),
        "security_clearance",
        "clerk",
        (~leaves).alias("is_active"),
        F.when(leaves, "Leaver").otherwise("Promoted").alias("last_change"),
        F.concat(F.when(leaves, "Left ").otherwise("+10% "), F.col("comment")).alias("comment"),
        today.alias("load_date"),
    )
    return hires.unionByName(changes)


def t2_fact_initial(landed: DataFrame, hashed: Sequence[str] = HASHED) -> DataFrame:
    return landed.select(
        "*", first_date().alias("from_date"), open_date().alias("to_date"), diff_hash(hashed).alias("diff_hash")
    )


DAYS_HELD = Bands("from_date", "to_date", open_date, lambda load: F.date_sub(load, 1))


def _load_source(batch: DataFrame, hashed: Sequence[str]) -> DataFrame:
    return batch.select("*", F.col("load_date").alias("from_date"), diff_hash(hashed).alias("diff_hash"))


def type2_fact(
    fact: DataFrame,
    landed: DataFrame,
    keys: Sequence[str] = ("employee_id",),
    update: Sequence[str] = UPDATED,
    hashed: Sequence[str] = HASHED,
) -> DataFrame:
    """Load the day after the fact's newest load; the old band ends one day before it."""
    source = _load_source(next_load(landed, fact, "load_date"), hashed)
    return band_load(fact, source, keys, update, DAYS_HELD)


def type2_step(
    current: DataFrame,
    landed: DataFrame,
    keys: Sequence[str] = ("employee_id",),
    update: Sequence[str] = UPDATED,
    hashed: Sequence[str] = HASHED,
) -> DataFrame:
    """The same over the open bands alone: the open bands after the load and those it closed.

    The newest load is always among the open bands, so they tell which load comes next.
    """
    source = _load_source(next_load(landed, current, "load_date"), hashed)
    return band_step(current, source, keys, update, DAYS_HELD)


def current_staff(fact: DataFrame) -> DataFrame:
    """The open band of each employee: how it stands now."""
    return DAYS_HELD.current(fact)


def active_now(fact: DataFrame) -> DataFrame:
    return current_staff(fact).filter("is_active").agg(F.count(F.lit(1)).alias("active_employee_count"))


def in_period(fact: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """Rows whose band overlaps the days from `lo` to `hi`; plain comparisons, so they push down."""
    return fact.filter((F.col("from_date") <= hi) & (F.col("to_date") >= lo))


def as_of(fact: DataFrame, day: Column) -> DataFrame:
    """Rows whose band holds the day."""
    return in_period(fact, day, day)


def active_employees(rows: DataFrame) -> DataFrame:
    return rows.filter("is_active").agg(F.countDistinct("employee_id").alias("active_employee_count"))


def hired_between(rows: DataFrame, lo: Column, hi: Column) -> DataFrame:
    return rows.filter(F.col("hire_date").between(lo, hi))


def ever_promoted(rows: DataFrame, fact: DataFrame) -> DataFrame:
    """Rows of employees whom the fact ever shows as promoted."""
    promoted = fact.filter(F.col("last_change") == "Promoted").select("employee_id")
    return rows.join(promoted, "employee_id", "left_semi")


def movements(fact: DataFrame, after: Column) -> DataFrame:
    """Employees per day and kind of change since a day, from the open bands."""
    return (
        current_staff(fact)
        .filter(F.col("from_date") > after)
        .groupBy("from_date", "last_change")
        .agg(F.count("employee_id").alias("employee_count"))
        .orderBy(F.asc_nulls_last("from_date"), F.asc_nulls_last("last_change"))
    )
