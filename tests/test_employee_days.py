"""The daily loads of the employee fact."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from rows_of_frames import rows

from tidemark.operators import bands
from tidemark.plans import scenario

ORDER = "employee_id long, department_id long, salary_usd decimal(12,2), hire_date date, security_clearance string, clerk string, comment string"


def test_the_first_landing_is_not_written(spark, monkeypatch):
    people = [(i, 1, f"100{i}.00", dt.date(2001, 1, 29), "1", f"Clerk#{i}", "") for i in range(10)]
    people += [(20, 1, "5000.00", dt.date(2001, 7, 28), "1", "Clerk#9", "")]
    source = spark.createDataFrame(people, ORDER.replace("decimal(12,2)", "string")).withColumn("salary_usd", F.col("salary_usd").cast("decimal(12,2)"))
    written, real = [], scenario.stage
    monkeypatch.setattr(scenario, "stage", lambda df, label, *a: written.append(label) or real(df, label, *a))
    landed, fact = scenario.run_days(source, scenario.FIRST_DAY, scenario.DAYS[:1], scenario.hired_on_this_day_of_month)
    assert written == ["employees-fact", "employees-landed", "employees-fact"]  # the fact, then the day's batch and fact
    assert rows(landed.groupBy("load_date").count()) == [(dt.date(2001, 7, 28), 10), (dt.date(2001, 7, 29), 4)]
    assert bands.active_now(fact).first()[0] == 4  # clerks 0 to 2 have open ends, and the new one
