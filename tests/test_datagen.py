from pyspark.sql import functions as F

from dataprism.sources.datagen import EMPLOYEES_SCHEMA, STATES, amplify, employees, write_employees
from dataprism.session import scratch_path


def test_employees_schema_ranges_and_determinism(spark):
    e = employees(spark, 2000)
    assert e.schema == EMPLOYEES_SCHEMA or [f.dataType for f in e.schema] == [f.dataType for f in EMPLOYEES_SCHEMA]
    r = e.agg(F.min("salary"), F.max("salary"), F.min("years_xp"), F.max("years_xp"), F.min("hire_date"),
              F.max("hire_date"), F.count_distinct("email"), F.count_if(~F.col("state").isin(STATES))).first()
    assert 40_000 <= r[0] and r[1] <= 400_000
    assert 0 <= r[2] and r[3] <= 20
    assert (r[5] - r[4]).days <= 90
    assert r[6] == 2000 and r[7] == 0
    assert sorted(e.collect()) == sorted(employees(spark, 2000).collect())


def test_amplify_doubles_in_one_job(spark):
    e = employees(spark, 100)
    assert amplify(e, 5).count() == 3200
    assert amplify(e, 0).count() == 100
    plan = amplify(e, 3)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_write_replaces_table(spark):
    path = scratch_path(spark, "employees")
    write_employees(employees(spark, 50), path)
    back = write_employees(employees(spark, 30), path)
    assert back.count() == 30
