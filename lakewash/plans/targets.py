"""Target tables the jobs load, and the step that shapes a cleaned frame to
one: the table's columns in its order and types, a serial key where the table
has one, and the per-row list of values that did not fit.

Zone-less ``TIMESTAMP`` columns are ``timestamp_ntz``; ``UUID`` columns are
text (checked with :func:`lakewash.operators.quality.uuid_format_violations`);
``SERIAL`` keys are dense 64-bit integers from
:func:`lakewash.operators.ids.with_surrogate_key`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lakewash.operators.ids import with_surrogate_key
from lakewash.operators.mapping import conform_to_schema


def _f(name: str, dtype: T.DataType, nullable: bool = True) -> T.StructField:
    return T.StructField(name, dtype, nullable)


S, TS, B, D, I, L = T.StringType(), T.TimestampNTZType(), T.BooleanType(), T.DateType(), T.IntegerType(), T.LongType()

# --- fixed values: the target tables, columns in table order ------------------
USERS_TBL = T.StructType([
    _f("user_id", S, False), _f("created_at", TS), _f("updated_at", TS), _f("logged_at", TS),
    _f("name", S), _f("dob", D), _f("address", S), _f("username", S), _f("password", S),
    _f("national_id", S), _f("car_brand", S), _f("car_license_plate", S), _f("is_active", B),
    _f("inserted_date", TS),
])
JOBS_HISTORY = T.StructType([
    _f("id", L, False), _f("user_id", S), _f("occupation", S), _f("is_fulltime", B),
    _f("start", D), _f("end", D), _f("employer", S), _f("inserted_date", TS),
])
TELEPHONE_NUMBERS = T.StructType([
    _f("id", L, False), _f("user_id", S), _f("telephone_number", L), _f("inserted_date", TS),
])
FLAT_RECORDS = T.StructType([
    _f("uuid", S, False), _f("id", I), _f("name", S), _f("address", S), _f("color", S),
    _f("created_at_ori", S), _f("created_at", TS), _f("last_login_ori", S), _f("last_login", TS),
    _f("is_claimed_ori", S), _f("is_claimed", B), _f("paid_amount", T.DecimalType(10, 2)),
    _f("inserted_date", TS),
])
# --- end of fixed values ------------------------------------------------------


def shape_users(users: DataFrame) -> DataFrame:
    """The nested job's users table as the users target stores it (the
    ``uuid`` and ``_ori`` columns are not part of the target)."""
    return conform_to_schema(users, USERS_TBL)


def shape_telephone_numbers(phones: DataFrame) -> DataFrame:
    """Serial ``id`` in (user, row id) order; the cleaned number as an integer."""
    keyed = with_surrogate_key(phones.drop("telephone_numbers_ori"), ["user_id", "uuid"], "id")
    return conform_to_schema(keyed.withColumnRenamed("telephone_numbers", "telephone_number"), TELEPHONE_NUMBERS)


def shape_jobs_history(jobs: DataFrame) -> DataFrame:
    """Serial ``id`` in (user, row id) order; the cleaned dates under the
    target's ``start`` / ``end`` names."""
    keyed = with_surrogate_key(jobs.drop("start_ori", "end_ori"), ["user_id", "uuid"], "id")
    renamed = keyed.withColumnRenamed("start_date", "start").withColumnRenamed("end_date", "end")
    return conform_to_schema(renamed, JOBS_HISTORY)


def shape_flat_records(records: DataFrame) -> DataFrame:
    return conform_to_schema(records, FLAT_RECORDS)
