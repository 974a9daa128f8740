"""Sample ``employees`` data: typed synthetic rows from column expressions, and amplification by doubling.

Every field is integer arithmetic on a row key, so a row is the same on every run and on every retry of a task
(no random generator, no Python per row), and any engine can recompute it. Values are produced as text first and
cast into the declared schema (string → typed conversion on insert), which also checks every generated value.

* ``employees_from(df, key, time)`` — one employee per row of an existing table (work grows with that table);
* ``employees(spark, n)`` — ``n`` employees from ``spark.range`` with hire dates in the 90 days before ``as_of``;
* ``amplify(df, k)`` — ``2**k`` copies of every row in one job (``explode(sequence)``: no join, no 15 self-inserts);
* ``write_employees(df, path)`` — create-or-replace the table as Parquet.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EMPLOYEES_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType(), True),
        T.StructField("salary", T.LongType(), True),
        T.StructField("job", T.StringType(), True),
        T.StructField("state", T.StringType(), True),
        T.StructField("email", T.StringType(), True),
        T.StructField("phone", T.StringType(), True),
        T.StructField("dob", T.StringType(), True),
        T.StructField("ssn", T.StringType(), True),
        T.StructField("hire_date", T.TimestampNTZType(), True),
        T.StructField("years_xp", T.LongType(), True),
    ]
)

# Word lists and the arithmetic of the generator (shared with the SQL oracle).
FIRST_NAMES = ["James", "Mary", "Robert", "Patricia", "John", "Jennifer", "Michael", "Linda", "David", "Elizabeth",
               "William", "Barbara", "Richard", "Susan", "Joseph", "Jessica", "Thomas", "Sarah", "Carlos", "Mei"]
LAST_NAMES = ["Smith", "Johnson", "Williams", "Brown", "Jones", "Garcia", "Miller", "Davis", "Rodriguez", "Martinez",
              "Hernandez", "Lopez", "Gonzalez", "Wilson", "Anderson", "Thomas", "Taylor", "Moore", "Jackson", "Lee"]
JOBS = ["Engineer", "Analyst", "Manager", "Designer", "Accountant", "Nurse", "Teacher", "Technician", "Consultant",
        "Scientist", "Clerk", "Sales Associate"]
STATES = ["AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA",
          "ME", "MD", "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ", "NM", "NY", "NC", "ND", "OH", "OK",
          "OR", "PA", "RI", "SC", "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY"]
# Field hash h_i(key) = ((key % MOD) * MULT[i] + ADD[i]) % MOD, fields in EMPLOYEES_SCHEMA order.
MULT = [7919, 104729, 1299709, 15485863, 179424673, 2038074743, 49979687, 982451653, 32452843, 86028121]
ADD = [17, 29, 31, 37, 41, 43, 47, 53, 59, 61]
MOD = 1_000_003
SALARY_MIN, SALARY_MAX = 40_000, 400_000
YEARS_XP_MAX = 20
DOB_ORIGIN = "1960-01-01"
DOB_SPAN_DAYS = 15_000
HIRE_WINDOW_DAYS = 90
FIELD = {f.name: i for i, f in enumerate(EMPLOYEES_SCHEMA.fields)}


def field_hash(key: Column, field: str) -> Column:
    """Deterministic pseudo-random integer in [0, MOD) for ``field`` of the row with ``key`` (a bigint)."""
    i = FIELD[field]
    # The key is reduced first, so the product stays far inside bigint for any key (ANSI overflow never fires).
    return F.pmod(F.pmod(key.cast("bigint"), F.lit(MOD)) * F.lit(MULT[i]) + F.lit(ADD[i]), F.lit(MOD))


def _pick(words: list[str], h: Column) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in words]), (F.pmod(h, F.lit(len(words))) + 1).cast("int"))


def _digits(h: Column, width: int) -> Column:
    return F.lpad(F.pmod(h, F.lit(10 ** width)).cast("string"), width, "0")


def employee_text_columns(key: Column, hire_date: Column) -> list[Column]:
    """The ten fields as text (before the typed cast), from a bigint key and a hire time."""
    hn = field_hash(key, "name")
    first = _pick(FIRST_NAMES, hn)
    last = _pick(LAST_NAMES, F.floor(hn / len(FIRST_NAMES)))
    return [
        F.concat_ws(" ", first, last).alias("name"),
        (F.lit(SALARY_MIN) + F.pmod(field_hash(key, "salary"), F.lit(SALARY_MAX - SALARY_MIN + 1))).cast("string")
        .alias("salary"),
        _pick(JOBS, field_hash(key, "job")).alias("job"),
        _pick(STATES, field_hash(key, "state")).alias("state"),
        F.concat(F.lower(first), F.lit("."), F.lower(last), key.cast("string"), F.lit("@example.com")).alias("email"),
        F.concat_ws("-", _digits(field_hash(key, "phone"), 3), _digits(F.floor(field_hash(key, "phone") / 1000), 3),
                    _digits(key, 4)).alias("phone"),
        F.date_format(F.date_add(F.lit(DOB_ORIGIN).cast("date"),
                                 F.pmod(field_hash(key, "dob"), F.lit(DOB_SPAN_DAYS)).cast("int")), "yyyy-MM-dd")
        .alias("dob"),
        F.concat_ws("-", (F.lit(100) + F.pmod(field_hash(key, "ssn"), F.lit(900))).cast("string"),
                    _digits(F.floor(field_hash(key, "ssn") / 900), 2), _digits(key, 4)).alias("ssn"),
        F.date_format(hire_date, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("hire_date"),
        F.pmod(field_hash(key, "years_xp"), F.lit(YEARS_XP_MAX + 1)).cast("string").alias("years_xp"),
    ]


def typed(text: DataFrame) -> DataFrame:
    """Insert-select into the declared schema: every text field cast to its column type (ANSI casts fail loudly)."""
    return text.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in EMPLOYEES_SCHEMA.fields])


def employees_from(df: DataFrame, key: str, time: str) -> DataFrame:
    """One employee per row of ``df``: fields derived from the integer column ``key``, hire date = column ``time``."""
    return typed(df.select(*employee_text_columns(F.col(key), F.col(time))))


def employees(spark: SparkSession, n: int, *, as_of: dt.datetime | None = None, seed: int = 0) -> DataFrame:
    """``n`` employees from ``spark.range``; hire dates spread over the ``HIRE_WINDOW_DAYS`` before ``as_of``."""
    as_of = as_of or dt.datetime(2024, 1, 1)
    key = F.col("id") + F.lit(seed)
    window_s = HIRE_WINDOW_DAYS * 86_400
    offset = F.pmod(F.pmod(key, F.lit(MOD)) * F.lit(2654435761), F.lit(window_s))
    hire = F.timestamp_add("SECOND", -offset, F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz"))
    return typed(spark.range(n).select(*employee_text_columns(key, hire)))


def amplify(df: DataFrame, doublings: int, partitions: int | None = None) -> DataFrame:
    """``2**doublings`` copies of every row (the result of repeated self-inserts), generated where each row is."""
    if doublings < 0:
        raise ValueError("doublings must be >= 0")
    if doublings == 0:
        return df
    # Copies are generated inside the partition of their row; spread a seed of few partitions before amplifying it.
    if partitions is not None:
        df = df.repartition(partitions)
    copy = F.explode(F.sequence(F.lit(0), F.lit(2 ** doublings - 1)))
    return df.select("*", copy.alias("__copy")).drop("__copy")


def write_employees(df: DataFrame, path: str) -> DataFrame:
    """Create or replace the table at ``path`` (drop-if-exists + create + insert) and return it read back."""
    df.select(*[F.col(f.name).cast(f.dataType) for f in EMPLOYEES_SCHEMA.fields]).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(EMPLOYEES_SCHEMA).parquet(path)
