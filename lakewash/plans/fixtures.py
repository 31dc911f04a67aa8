"""Dirty inputs derived from the driver's clean tables.

The driver's tables hold clean values, so the text a cleaner must repair is
derived from key columns (``CASE key % n WHEN ...``) - every row of the whole
table gets one of several dirty forms; nothing is filtered or sampled. Each
derivation is SQL expression text that Spark (``selectExpr``) and DuckDB run
unchanged, so both engines see byte-identical input.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession

# --- fixed values: calendar names used to spell dates out --------------------
MONTHS = ["January", "February", "March", "April", "May", "June", "July",
          "August", "September", "October", "November", "December"]
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
# --- end of fixed values ------------------------------------------------------

Exprs = Sequence[tuple[str, str]]


def _lookup(index_sql: str, names: Sequence[str], base: int) -> str:
    arms = " ".join(f"WHEN {i + base} THEN '{n}'" for i, n in enumerate(names))
    return f"CASE {index_sql} {arms} END"


def _ordinal(day_sql: str) -> str:
    return (f"CASE WHEN {day_sql} IN (1, 21, 31) THEN 'st' WHEN {day_sql} IN (2, 22) THEN 'nd' "
            f"WHEN {day_sql} IN (3, 23) THEN 'rd' ELSE 'th' END")


def _s(sql: str) -> str:
    return f"CAST({sql} AS STRING)"


def dirty_timestamp_text(key: str, ts: str) -> str:
    """Twenty forms of a date, one per ``key % 20`` (every cleaning arm, and the
    padded, one-digit and zoned forms of a plain date-time)."""
    day = f"day({ts})"
    month_name = _lookup(f"month({ts})", MONTHS, 1)
    long_date = f"{_s(day)} || {_ordinal(day)} || ', ' || {_s(f'year({ts})')}"
    date_text = _s(f"CAST({ts} AS DATE)")
    return (
        f"CASE {key} % 20 "
        f"WHEN 0 THEN 'not a date' "
        f"WHEN 1 THEN {_lookup(f'{key} % 7', WEEKDAYS, 0)} || ', ' || {month_name} || ' ' || {long_date} "
        f"WHEN 2 THEN {month_name} || ' ' || {long_date} "
        f"WHEN 3 THEN {date_text} || 'TEST' "
        f"WHEN 4 THEN '18' || substr({date_text}, 3, 8) || ' 05:00:00' "
        f"WHEN 5 THEN '20' || {_s(f'29 + {key} % 3')} || substr({date_text}, 5, 6) || ' 12:00:00' "
        f"WHEN 6 THEN {_s(ts)} "
        f"WHEN 7 THEN {date_text} || 'T08:30:00' "
        f"WHEN 8 THEN substr({month_name}, 1, 3) || ' ' || {long_date} "
        f"WHEN 9 THEN 'February 30th, ' || {_s(f'year({ts})')} "
        f"WHEN 10 THEN CASE {key} % 3 WHEN 0 THEN '10:15' WHEN 1 THEN {_s(f'year({ts})')} ELSE 'zzz' END "
        f"WHEN 11 THEN '  ' || {date_text} || ' 10:00:00' "
        f"WHEN 12 THEN {date_text} || ' 8:05:00' "
        f"WHEN 13 THEN {date_text} || ' 8:05' "
        f"WHEN 14 THEN {date_text} || ' 10:00:00 UTC' "
        f"WHEN 15 THEN {date_text} || ' 10:00:00+08' "
        f"WHEN 16 THEN {date_text} || ' 10:00:00.25 -05:30  ' "
        f"WHEN 17 THEN ' ' || {date_text} || '  ' "
        f"WHEN 18 THEN {date_text} || ' 25:00:00' "
        f"ELSE NULL END"
    )


def broken_time_text(key: str, date_sql: str, hh: str, mi: str, ss: str, epoch: str) -> str:
    """Eleven broken time forms, one per ``key % 11``."""
    return (
        f"CASE {key} % 11 "
        f"WHEN 0 THEN {_s(epoch)} "
        f"WHEN 1 THEN {date_sql} || ' ' || {hh} || {mi} || {ss} "
        f"WHEN 2 THEN {date_sql} || 'T' || {hh} || {mi} "
        f"WHEN 3 THEN {date_sql} || 'T' || {hh} || ':' || {mi} || ':' || {ss} "
        f"WHEN 4 THEN {date_sql} || 'T' || {hh} || ':' || {_s(f'60 + {key} % 30')} || ':' || {ss} "
        f"WHEN 5 THEN {date_sql} || 'T' || {hh} || ':' || {mi} || ':' || {_s(f'60 + {key} % 40')} "
        f"WHEN 6 THEN 'garbage' "
        f"WHEN 7 THEN {date_sql} || ' ' || {hh} || {mi} || ':' || {ss} "
        f"WHEN 8 THEN {date_sql} || 'T99:10:10' "
        f"WHEN 9 THEN '  ' || {date_sql} || ' ' || {hh} || ':' || {mi} || ':' || {ss} || 'Z ' "
        f"ELSE {date_sql} || ' ' || {hh} || ':' || {mi} || ':' || {ss} END"
    )


def _event_broken_time() -> str:
    t = _s("ts")
    return broken_time_text("event_id", f"substr({t}, 1, 10)", f"substr({t}, 12, 2)", f"substr({t}, 15, 2)",
                            f"substr({t}, 18, 2)", "1700000000 + event_id * 37")


def _lp(sql: str, n: int) -> str:
    return f"lpad({_s(sql)}, {n}, '0')"


def _customer_broken_time(shift: int) -> str:
    k = f"(c_custkey + {shift})"
    return broken_time_text(k, _s(f"DATE '2020-01-01' + CAST({k} % 1400 AS INT)"), _lp(f"{k} % 24", 2),
                            _lp(f"{k} * 7 % 60", 2), _lp(f"{k} * 13 % 60", 2), f"1577836800 + {k} * 3631")


def phone_text(key: str, a: str, b: str) -> str:
    """Phone numbers in six written forms, one per ``key % 6``."""
    area, mid, last = _s(f"200 + {a} % 800"), _lp(f"{b} % 1000", 3), _lp(f"{a} % 10000", 4)
    return (
        f"CASE {key} % 6 "
        f"WHEN 0 THEN '+1 (' || {area} || ') ' || {mid} || '-' || {last} "
        f"WHEN 1 THEN '001-' || {area} || '-' || {mid} || '-' || {last} || 'x' || {_s(f'{b} % 90 + 10')} "
        f"WHEN 2 THEN {area} || '.' || {mid} || '.' || {last} "
        f"WHEN 3 THEN '1-' || {area} || '-' || {mid} || '-' || {last} "
        f"WHEN 4 THEN {mid} || ' ' || {last} "
        f"ELSE {area} || ' ' || {mid} || ' ' || {last} || ' x-' || {_s(f'{b} % 10')} END"
    )


def identity_text(key: str) -> str:
    ssn = f"{_lp(f'{key} % 1000', 3)} || '-' || {_lp(f'{key} % 100', 2)} || '-' || {_lp(f'{key} * 7 % 10000', 4)}"
    return (
        f"CASE {key} % 7 "
        f"WHEN 0 THEN ' ' || {ssn} || CHR(9) "
        f"WHEN 1 THEN {_lp(f'{key} % 100', 2)} || '<br />' || {_lp(f'{key} % 1000', 3)} "
        f"WHEN 2 THEN {_lp(f'{key} % 1000', 3)} || ' <br/>' "
        f"WHEN 3 THEN '   ' "
        f"WHEN 4 THEN '' "
        f"WHEN 5 THEN NULL "
        f"ELSE {ssn} END"
    )


def boolean_text(key: str) -> str:
    forms = ["TRUE", "truee", "False", "fal_se", "trueee", " true", "yes", "1", "FALSE"]
    arms = " ".join(f"WHEN {i} THEN '{f}'" for i, f in enumerate(forms))
    return f"CASE {key} % 10 {arms} ELSE NULL END"


def epoch_text(key: str) -> str:
    return (
        f"CASE {key} % 10 "
        f"WHEN 0 THEN {_s(f'946684800 + {key} * 86413')} "
        f"WHEN 1 THEN {_s(f'1600000000 + {key}')} || '.5' "
        f"WHEN 2 THEN 'never' "
        f"WHEN 3 THEN {_s(f'-86400 * ({key} % 100)')} "
        f"WHEN 4 THEN {_s(f'1700000000000 + {key}')} "
        f"WHEN 5 THEN '000' || {_s(f'1700000000 + {key}')} "
        f"WHEN 6 THEN ' ' || {_s(f'1700000000 + {key}')} || '  ' "
        f"WHEN 7 THEN '+' || {_s(f'1700000000 + {key}')} "
        f"WHEN 8 THEN '99999999999999999999999' "
        f"ELSE NULL END"
    )


def amount_text(key: str, price: str) -> str:
    p = _s(f"CAST({price} AS DECIMAL(12,2))")
    return (
        f"CASE {key} % 7 "
        f"WHEN 0 THEN {p} "
        f"WHEN 1 THEN {p} || '5' "
        f"WHEN 2 THEN '-' || {p} || '5' "
        f"WHEN 3 THEN '1' || {_s(key)} || '00000000.5' "
        f"WHEN 4 THEN {_s(f'{key} % 9 + 1')} || ',' || {_lp(f'{key} % 1000', 3)} || '.50' "
        f"WHEN 5 THEN {_s(f'{key} % 100')} || 'e2' "
        f"ELSE NULL END"
    )


def date_text(key: str) -> str:
    return (
        f"CASE {key} % 7 "
        f"WHEN 0 THEN {_s(f'DATE {chr(39)}1950-01-01{chr(39)} + CAST({key} % 18000 AS INT)')} "
        f"WHEN 1 THEN '1985-02-30' "
        f"WHEN 2 THEN 'unknown' "
        f"WHEN 3 THEN {_s(f'DATE {chr(39)}1960-06-01{chr(39)} + CAST({key} % 9000 AS INT)')} || ' 00:00:00' "
        f"WHEN 4 THEN '  1985-2-3' "
        f"WHEN 5 THEN '1985-12-31T   ' "
        f"ELSE NULL END"
    )


def uuid_text(sql: str) -> str:
    h = f"md5({_s(sql)})"
    return (f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || substr({h}, 13, 4) || '-' || "
            f"substr({h}, 17, 4) || '-' || substr({h}, 21, 12)")


# ---------------------------------------------------------------- flat records
# Header names are dirty on purpose; normalize_columns tidies them.
FLAT_SOURCE: Exprs = [
    ("ID", _s("o_orderkey")),
    ("Name", "CASE o_orderkey % 4 WHEN 0 THEN '  Customer ' || CAST(o_custkey AS STRING) || '  ' "
             "WHEN 1 THEN 'Customer ' || CAST(o_custkey AS STRING) "
             "WHEN 2 THEN 'customer  ' || CAST(o_custkey AS STRING) || ' ' ELSE NULL END"),
    ("Address", "CAST(o_orderkey % 997 AS STRING) || ' Main St' || CHR(10) || 'Suite ' || "
                "CAST(o_custkey % 50 AS STRING) || CASE WHEN o_orderkey % 3 = 0 THEN CHR(10) ELSE '  ' END"),
    ("Color", "CASE o_orderstatus WHEN 'F' THEN 'forest GREEN' WHEN 'O' THEN ' ocean blue ' "
              "ELSE 'PALE  yellow' END"),
    ("Created At (dd/mm/yyyy)", dirty_timestamp_text("o_orderkey", "o_orderdate")),
    ("Last Login", epoch_text("o_orderkey")),
    ("Is Claimed?", boolean_text("o_orderkey")),
    ("Paid  Amount ($)", amount_text("o_orderkey", "o_totalprice")),
]
FLAT_COLUMNS = ["id", "name", "address", "color", "created_at", "last_login", "is_claimed", "paid_amount"]

# ------------------------------------------------------- nested user records
NESTED_SCALARS: Exprs = [
    ("user_id", uuid_text("c_custkey")),
    ("created_at", _customer_broken_time(0)),
    ("updated_at", _customer_broken_time(3)),
    ("logged_at", "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 1577836800 + c_custkey * 7919 END"),
    ("car_brand", "CASE c_custkey % 5 WHEN 0 THEN 'Toyota' WHEN 1 THEN 'Ford' WHEN 2 THEN 'Honda' "
                  "WHEN 3 THEN 'Kia' ELSE NULL END"),
    ("car_license_plate", f"upper(substr(md5(c_name), 1, 3)) || '-' || {_lp('c_custkey % 10000', 4)}"),
    ("is_active", "CASE c_custkey % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE ELSE NULL END"),
    ("name", "c_name"),
    ("dob", date_text("c_custkey")),
    ("address", "CAST(c_custkey % 500 AS STRING) || ' Oak Ave' || CHR(10) || c_mktsegment || "
                "CASE WHEN c_custkey % 2 = 0 THEN CHR(10) ELSE ' ' END"),
    ("username", "lower(replace(c_name, '#', '_'))"),
    ("password", "'pw-' || CAST(c_custkey * 31 % 100000 AS STRING)"),
    ("national_id", identity_text("c_custkey")),
]
PHONE_COUNT = "c_custkey % 4"
PHONES: Exprs = [
    ("phone_0", phone_text("c_custkey", "c_custkey", "c_nationkey")),
    ("phone_1", f"CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE {phone_text('(c_custkey + 1)', 'c_custkey * 3', 'c_custkey')} END"),
    ("phone_2", phone_text("(c_custkey + 2)", "c_custkey * 5", "c_nationkey + 7")),
]
JOB_COUNT = "c_custkey % 3"


def _job(i: int) -> Exprs:
    k = f"(c_custkey + {i})"
    return [
        (f"job_{i}_id", _s(f"c_custkey * 10 + {i}")),
        (f"job_{i}_employer", f"CASE {k} % 3 WHEN 0 THEN ' ' || c_mktsegment || ' Corp ' "
                              f"WHEN 1 THEN 'Acme ' || CAST(c_nationkey AS STRING) ELSE NULL END"),
        (f"job_{i}_occupation", f"CASE {k} % 4 WHEN 0 THEN ' data ENGINEER ' WHEN 1 THEN 'clerk' "
                                f"WHEN 2 THEN 'SALES  lead' ELSE NULL END"),
        (f"job_{i}_is_fulltime", f"CASE {k} % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE ELSE NULL END"),
        (f"job_{i}_start", date_text(k)),
        (f"job_{i}_end", date_text(f"({k} + 2)")),
    ]


JOBS: Exprs = [*_job(0), *_job(1)]
JOB_FIELDS = ["id", "employer", "occupation", "is_fulltime", "start", "end"]

# --------------------------------------------------------------- event texts
EVENT_TEXTS: Exprs = [
    ("time_text", _event_broken_time()),
    ("bool_text", boolean_text("event_id")),
    ("epoch_text", epoch_text("event_id")),
    ("pattern_text", "CASE event_id % 3 WHEN 0 THEN substr(CAST(ts AS STRING), 1, 13) || "
                     "substr(CAST(ts AS STRING), 15, 5) WHEN 1 THEN substr(CAST(ts AS STRING), 1, 19) "
                     "ELSE NULL END"),
]


def derive(df: DataFrame, exprs: Exprs, keep: Sequence[str] = ()) -> DataFrame:
    """Spark side of a derivation: one projection of SQL expression text."""
    return df.selectExpr(*keep, *[f"{sql} AS `{name}`" for name, sql in exprs])


def derive_sql(table: str, exprs: Exprs, keep: Sequence[str] = ()) -> str:
    """DuckDB side of the same derivation."""
    cols = [*keep, *[f'{sql} AS "{name}"' for name, sql in exprs]]
    return f"SELECT {', '.join(cols)} FROM {table}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def flat_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(table(spark, sf_dir, "orders"), FLAT_SOURCE)


def nested_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested user records, one per customer, with 0-3 phones and 0-2 jobs
    built from the row itself (no grouping, so no record grows with skew).
    ``_bad_balance`` marks customers whose record the writer also emits as a
    malformed line (see :func:`lakewash.plans.catalog.write_nested_json`)."""
    from pyspark.sql import functions as F

    flat = derive(table(spark, sf_dir, "customer"), [*NESTED_SCALARS, *PHONES, *JOBS],
                  keep=["c_custkey", "c_acctbal"])
    details = F.struct(*[F.col(n) for n in ["name", "dob", "address", "username", "password", "national_id"]],
                       F.slice(F.array("phone_0", "phone_1", "phone_2"), 1, F.expr(PHONE_COUNT).cast("int"))
                       .alias("telephone_numbers"))
    jobs = F.array(*[F.struct(*[F.col(f"job_{i}_{f}").alias(f) for f in JOB_FIELDS]) for i in range(2)])
    return flat.select(
        "user_id", "created_at", "updated_at", "logged_at", "car_brand", "car_license_plate", "is_active",
        details.alias("user_details"),
        F.slice(jobs, 1, F.expr(JOB_COUNT).cast("int")).alias("jobs_history"),
        (F.col("c_acctbal") < 0).alias("_bad_balance"),
    )


def event_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(table(spark, sf_dir, "events"), EVENT_TEXTS, keep=["event_id"])
