"""Query catalog: one Spark query per operator, each paired (where SQL can
say the same thing) with DuckDB oracle SQL over the same parquet tables.

Every query reads the given tables - whole tables, whole texts - or data
Spark derives from them. Dirty input comes from :mod:`lakewash.plans.fixtures`;
the dirty CSV and JSON input files are written once per application under the
session's ``spark.checkpoint.dir``, and every sink round trip writes to a
fresh folder there.

All timestamp outputs leave as ``timestamp_ntz`` (the zone-less form a
target table stores), so the comparison does not depend on a machine zone.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewash import functions as X
from lakewash.operators import ids, mapping, nested, quality
from lakewash.plans import fixtures as FX
from lakewash.plans import jobs
from lakewash.plans import oracle as O
from lakewash.plans import targets
from lakewash.session import pin_utc, scratch_path
from lakewash.sources import readers, sinks

# Fixed load time, so that every run of a query returns the same rows.
RUN_TS = "2024-06-01 00:00:00"
RUN_TS_SQL = f"TIMESTAMP '{RUN_TS}'"


@dataclass
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


CATALOG: dict[str, Query] = {}


def register(name: str, oracle: str | None = None):
    def wrap(fn: Callable[[SparkSession, str], DataFrame]):
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            pin_utc(spark)
            return mapping.to_zoneless(fn(spark, sf_dir))
        build.__name__ = fn.__name__
        build.__doc__ = fn.__doc__
        CATALOG[name] = Query(build, oracle)
        return fn
    return wrap


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return FX.table(spark, sf_dir, name)


# ============================================================ staged inputs

_WRITTEN: dict[tuple[str, str, str], str] = {}


def _write_once(spark: SparkSession, sf_dir: str, kind: str, write: Callable[[], str]) -> str:
    """Input files are written once per application and scale directory and
    then shared by every query that reads them (they are never modified)."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), kind)
    path = _WRITTEN.get(key)
    if path is None or not readers.path_exists(spark, path):
        path = _WRITTEN[key] = write()
    return path


def write_flat_csv(spark: SparkSession, sf_dir: str) -> str:
    """The dirty flat records as multi-line CSV files (one per task; padding
    kept, as in a file someone else produced)."""
    return _write_once(spark, sf_dir, "flat-csv", lambda: _write_flat_csv(spark, sf_dir))


def write_nested_json(spark: SparkSession, sf_dir: str) -> str:
    """One JSON line per customer, plus one malformed line (a text
    ``logged_at``) for each customer with a negative balance."""
    return _write_once(spark, sf_dir, "nested-json", lambda: _write_nested_json(spark, sf_dir))


def write_flat_as(spark: SparkSession, sf_dir: str, fmt: str) -> str:
    """The same dirty flat records as Parquet or line JSON files."""
    def write() -> str:
        path = scratch_path(spark, f"flat-{fmt}")
        FX.flat_source(spark, sf_dir).repartition(spark.sparkContext.defaultParallelism).write.format(fmt).save(path)
        return path
    return _write_once(spark, sf_dir, f"flat-{fmt}", write)


def _write_flat_csv(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "flat-csv")
    # Files arrive as many files; a multi-line CSV file cannot be split.
    parts = spark.sparkContext.defaultParallelism
    (FX.flat_source(spark, sf_dir).repartition(parts).write.option("header", "true")
     .option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .csv(path))
    return path


def _write_nested_json(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "nested-json")
    src = FX.nested_source(spark, sf_dir).repartition(spark.sparkContext.defaultParallelism)
    src.drop("_bad_balance").write.json(path)
    bad = src.where("_bad_balance").select(
        F.to_json(F.struct("user_id", F.lit("n/a").alias("logged_at"))).alias("value"))
    bad.write.mode("append").text(path)
    return path


# ============================================================ DuckDB pieces

FLAT_SRC_SQL = FX.derive_sql("orders", list(zip(FX.FLAT_COLUMNS, [s for _, s in FX.FLAT_SOURCE])))


def flat_clean_sql() -> str:
    """DuckDB form of the cleaned flat-record table."""
    return (
        f"SELECT {O.stable_uuid('id', '0')} AS uuid, id, {O.trim_text('name')} AS name, "
        f"{O.single_line_text('address')} AS address, {O.initcap_text('color')} AS color, "
        f"created_at AS created_at_ori, {O.clean_timestamp('created_at')} AS created_at, "
        f"last_login AS last_login_ori, {O.epoch_text_to_timestamp('last_login')} AS last_login, "
        f"is_claimed AS is_claimed_ori, {O.clean_boolean('is_claimed')} AS is_claimed, "
        f"{O.decimal_amount('paid_amount')} AS paid_amount, {RUN_TS_SQL} AS inserted_date "
        f"FROM ({FLAT_SRC_SQL})"
    )


NESTED_SQL = FX.derive_sql("customer", [*FX.NESTED_SCALARS, *FX.PHONES, *FX.JOBS,
                                        ("n_phones", f"CAST({FX.PHONE_COUNT} AS BIGINT)"),
                                        ("n_jobs", f"CAST({FX.JOB_COUNT} AS BIGINT)")], keep=["c_acctbal"])


def phones_sql() -> str:
    arms = [f"SELECT user_id, {i} AS pos, phone_{i} AS telephone_numbers FROM ({NESTED_SQL}) WHERE n_phones > {i}"
            for i in range(3)]
    return " UNION ALL ".join(arms)


def jobs_sql() -> str:
    arms = [f"SELECT user_id, {i} AS pos, " + ", ".join(f'job_{i}_{f} AS "{f}"' for f in FX.JOB_FIELDS)
            + f" FROM ({NESTED_SQL}) WHERE n_jobs > {i}" for i in range(2)]
    return " UNION ALL ".join(arms)


def _scalar(name: str, table_name: str, key: str, raw_sql: str, spark_fn, duck_fn, keep_raw: bool = True):
    """Register ``(key, raw, cleaned)`` over a derived text column."""
    raw_cols = ", raw" if keep_raw else ""
    sql = f"SELECT {key}{raw_cols}, {duck_fn('raw')} AS cleaned FROM (SELECT {key}, {raw_sql} AS raw FROM {table_name})"

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        keys = [k.strip() for k in key.split(",")]
        df = t(spark, sf_dir, table_name).selectExpr(*keys, f"{raw_sql} AS raw")
        cols = [*keys, "raw"] if keep_raw else keys
        return df.select(*cols, spark_fn(F.col("raw")).alias("cleaned"))
    build.__doc__ = f"{name}: cleaned values of a derived column of {table_name}."
    register(name, sql)(build)


# ============================================================ sources, sinks


@register("scan_csv_dialect", FX.derive_sql("orders", FX.FLAT_SOURCE))
def scan_csv_dialect(spark, sf_dir):
    """Multi-line, quoted CSV with a header, read back as text."""
    return readers.read_csv(spark, write_flat_csv(spark, sf_dir))


_NESTED_TOP = ["user_id", "created_at", "updated_at", "logged_at", "car_brand", "car_license_plate", "is_active"]
_NESTED_DETAIL = ["name", "dob", "address", "username", "password", "national_id"]


@register("scan_json_nested",
          f"SELECT {', '.join(_NESTED_TOP + _NESTED_DETAIL)}, n_phones, n_jobs FROM ({NESTED_SQL})")
def scan_json_nested(spark, sf_dir):
    """Line JSON read with the declared nested schema; good rows only."""
    recs = jobs.read_nested_records(spark, write_nested_json(spark, sf_dir))
    good = recs.where(F.col(readers.CORRUPT_RECORD).isNull())
    return good.select(*_NESTED_TOP, *[F.col(f"user_details.{c}").alias(c) for c in _NESTED_DETAIL],
                       F.size("user_details.telephone_numbers").cast("bigint").alias("n_phones"),
                       F.size("jobs_history").cast("bigint").alias("n_jobs"))


@register("nested_rejects",
          "SELECT " + FX.uuid_text("c_custkey") + " AS user_id, '{\"user_id\":\"' || "
          + FX.uuid_text("c_custkey") + " || '\",\"logged_at\":\"n/a\"}' AS _corrupt_record "
          "FROM customer WHERE c_acctbal < 0")
def nested_rejects(spark, sf_dir):
    """Lines whose values do not fit the schema are set aside whole."""
    recs = jobs.stage_nested_records(spark, write_nested_json(spark, sf_dir))
    return jobs.nested_rejects(recs)


@register("scan_parquet", "SELECT * FROM orders")
def scan_parquet(spark, sf_dir):
    """S3."""
    return readers.read_data(spark, f"{sf_dir}/orders.parquet", "parquet")


_LINE_COLS = "l_orderkey, l_linenumber, l_quantity, l_returnflag, l_shipdate"


@register("sink_parquet_append",
          f"SELECT {_LINE_COLS}, 1 AS batch FROM lineitem UNION ALL SELECT {_LINE_COLS}, 2 AS batch FROM lineitem")
def sink_parquet_append(spark, sf_dir):
    """Two appends to one Parquet folder, read back."""
    path = scratch_path(spark, "append")
    src = t(spark, sf_dir, "lineitem").select(*[c.strip() for c in _LINE_COLS.split(",")])
    for batch in (1, 2):
        sinks.write_data(src.withColumn("batch", F.lit(batch)), path, "parquet")
    return spark.read.parquet(path)


@register("sink_csv_overwrite",
          "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer")
def sink_csv_overwrite(spark, sf_dir):
    """Any other format falls back to CSV with a header, replacing; two
    writes leave one copy."""
    path = scratch_path(spark, "csv")
    src = t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    for _ in range(2):
        sinks.write_data(src, path, "text-table")
    return spark.read.option("header", "true").csv(path)


_DIRTY_CSV = ("CASE c_custkey % 6 WHEN 0 THEN '  ' || c_name || ' ' WHEN 1 THEN 'q' || CHR(34) || 'x' || c_name "
              "WHEN 2 THEN '' WHEN 3 THEN c_name || CHR(10) || 'second ' || CHR(92) || ' line, ' || CHR(34) || 'a' || CHR(34) "
              "WHEN 4 THEN NULL ELSE c_name END")


@register("sink_csv_dirty_round_trip", f"SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, {_DIRTY_CSV} AS note FROM customer")
def sink_csv_dirty_round_trip(spark, sf_dir):
    """Padding, quotes, line breaks, empty texts and nulls come back from
    the CSV sink as they were."""
    path = scratch_path(spark, "csv-dirty")
    sinks.write_csv(t(spark, sf_dir, "customer").selectExpr("c_custkey", f"{_DIRTY_CSV} AS note"), path)
    return readers.read_csv(spark, path, sinks.CSV_SINK_DIALECT)


@register("scan_csv_mixed_headers",
          "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CASE WHEN c_custkey % 3 = 2 THEN NULL ELSE c_mktsegment "
          "END AS segment FROM customer")
def scan_csv_mixed_headers(spark, sf_dir):
    """S1 over files whose headers differ in order and columns: matched by name."""
    path, cust = scratch_path(spark, "csv-mixed"), t(spark, sf_dir, "customer")
    forms = (["c_custkey AS id", "c_name AS name", "c_mktsegment AS segment"],
             ["c_mktsegment AS segment", "c_custkey AS id", "c_name AS name"], ["c_name AS name", "c_custkey AS id"])
    for i, columns in enumerate(forms):
        sinks.write_csv(cust.where(F.col("c_custkey") % 3 == i).selectExpr(*columns), path, mode="append")
    return readers.read_csv_by_name(spark, path).select("id", "name", "segment")


@register("sink_with_observed_count", "SELECT count(*) AS rows_written, count(*) AS rows_read FROM lineitem")
def sink_with_observed_count(spark, sf_dir):
    """Rows counted during the write, compared with what reads back."""
    path = scratch_path(spark, "observed")
    written = sinks.write_parquet(t(spark, sf_dir, "lineitem"), path, "overwrite")
    back = spark.read.parquet(path)
    return back.agg(F.lit(written).cast("bigint").alias("rows_written"), F.count(F.lit(1)).alias("rows_read"))


@register("sink_staged_refresh",
          f"SELECT c_custkey, upper({O.trim_text('c_name')}) AS c_name, c_mktsegment FROM customer")
def sink_staged_refresh(spark, sf_dir):
    """A table loaded, then fully refreshed through staging."""
    target = scratch_path(spark, "refresh")
    cust = t(spark, sf_dir, "customer")
    sinks.staged_refresh(cust.select("c_custkey", "c_name", "c_mktsegment"), target)
    sinks.staged_refresh(cust.select("c_custkey", F.upper(X.trim_text("c_name")).alias("c_name"),
                                     "c_mktsegment"), target)
    return spark.read.parquet(target)


@register("sink_empty_as_null",
          f"SELECT c_custkey, NULLIF({FX.identity_text('c_custkey')}, '') AS national_id, c_name FROM customer")
def sink_empty_as_null(spark, sf_dir):
    """Empty text becomes null before a bulk load."""
    df = t(spark, sf_dir, "customer").selectExpr("c_custkey", f"{FX.identity_text('c_custkey')} AS national_id",
                                                 "c_name")
    return sinks.empty_as_null(df, ["national_id"])


# ============================================================ projections


@register("map_select", "SELECT c_custkey AS cust_id, upper(c_name) AS name, lower(c_mktsegment) AS segment "
                        "FROM customer")
def map_select(spark, sf_dir):
    """Name, Column and function values in one select."""
    return mapping.apply_mapping(t(spark, sf_dir, "customer"), {
        "cust_id": "c_custkey",
        "name": F.upper("c_name"),
        "segment": lambda df: F.lower(df["c_mktsegment"]),
    })


_BAND = "CASE WHEN c_acctbal < 0 THEN 'negative' WHEN c_acctbal < 5000 THEN 'low' ELSE 'high' END"


@register("map_extend", f'SELECT c_custkey, upper(trim(c_name)) AS "C_NAME", c_nationkey, c_acctbal, '
                        f"c_mktsegment, {_BAND} AS balance_band FROM customer")
def map_extend(spark, sf_dir):
    """Replace a column in place (case-insensitive), append a new one."""
    return mapping.apply_mapping(t(spark, sf_dir, "customer"), {
        "C_NAME": F.upper(X.trim_text("c_name")),
        "balance_band": F.expr(_BAND),
    }, extend=True)


@register("normalize_columns", FLAT_SRC_SQL)
def normalize_columns(spark, sf_dir):
    """Dirty header names tidied."""
    return mapping.normalize_columns(FX.flat_source(spark, sf_dir))


@register("flatten_struct", f"SELECT user_id, {', '.join(_NESTED_DETAIL)} FROM ({NESTED_SQL})")
def flatten_struct(spark, sf_dir):
    """P4."""
    return nested.flatten_struct(FX.nested_source(spark, sf_dir), "user_details", _NESTED_DETAIL, keep=["user_id"])


@register("explode_scalars", phones_sql())
def explode_scalars(spark, sf_dir):
    """P5: one row per phone, null elements kept, empty arrays give none."""
    return nested.explode_scalars(FX.nested_source(spark, sf_dir), ["user_id"], "user_details.telephone_numbers",
                                  "telephone_numbers", position="pos")


@register("explode_structs", jobs_sql())
def explode_structs(spark, sf_dir):
    """P6."""
    return nested.explode_structs(FX.nested_source(spark, sf_dir), ["user_id"], "jobs_history", position="pos")


def _relational(spark, sf_dir):
    src = FX.nested_source(spark, sf_dir)
    return nested.nested_to_relational(
        src, ["user_id"], {**{c: c for c in _NESTED_TOP}, **{c: f"user_details.{c}" for c in _NESTED_DETAIL}},
        scalar_children={"telephone_numbers": ("user_details.telephone_numbers", "telephone_number")},
        struct_children={"jobs_history": "jobs_history"})


@register("nested_to_relational_users", f"SELECT {', '.join(_NESTED_TOP + _NESTED_DETAIL)} FROM ({NESTED_SQL})")
def nested_to_relational_users(spark, sf_dir):
    """The parent table of the split."""
    return _relational(spark, sf_dir)["parent"]


@register("nested_to_relational_phones",
          f"SELECT user_id, telephone_numbers AS telephone_number FROM ({phones_sql()})")
def nested_to_relational_phones(spark, sf_dir):
    """The scalar child table."""
    return _relational(spark, sf_dir)["telephone_numbers"]


@register("nested_to_relational_jobs",
          "SELECT user_id, " + ", ".join(f'"{f}"' for f in FX.JOB_FIELDS) + f" FROM ({jobs_sql()})")
def nested_to_relational_jobs(spark, sf_dir):
    """The struct child table."""
    return _relational(spark, sf_dir)["jobs_history"]


@register("derive_columns", "SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net_price, "
                            "CAST(year(l_shipdate) AS INTEGER) AS ship_year FROM lineitem")
def derive_columns(spark, sf_dir):
    """P8."""
    df = mapping.derive_columns(t(spark, sf_dir, "lineitem"), {
        "net_price": F.col("l_extendedprice") * (1 - F.col("l_discount")),
        "ship_year": F.year("l_shipdate"),
    })
    return df.select("l_orderkey", "l_linenumber", "net_price", "ship_year")


_ORDER_PHONE = FX.phone_text("o_orderkey", "o_orderkey", "o_custkey")


@register("keep_original", f"SELECT o_orderkey, phone AS phone_ori, {O.clean_phone('phone')} AS phone "
                           f"FROM (SELECT o_orderkey, {_ORDER_PHONE} AS phone FROM orders)")
def keep_original(spark, sf_dir):
    """Raw value kept beside the cleaned one."""
    df = t(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{_ORDER_PHONE} AS phone")
    return mapping.apply_mapping(df, {"o_orderkey": "o_orderkey", **mapping.keep_original("phone", X.clean_phone("phone"))})


@register("audit_run_timestamp", f"SELECT o_orderkey, {RUN_TS_SQL} AS inserted_date FROM orders")
def audit_run_timestamp(spark, sf_dir):
    """P10."""
    return t(spark, sf_dir, "orders").select("o_orderkey", ids.audit_timestamp(RUN_TS).alias("inserted_date"))


@register("random_uuid")
def random_uuid(spark, sf_dir):
    """Rows-only check (values are random by design)."""
    return t(spark, sf_dir, "orders").select("o_orderkey", ids.random_uuid().alias("uuid"))


@register("stable_uuid", f"SELECT o_orderkey, o_custkey, {O.stable_uuid('o_orderkey', 'o_custkey')} AS uuid FROM orders")
def stable_uuid(spark, sf_dir):
    """P12."""
    return t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey",
                                             ids.stable_uuid("o_orderkey", "o_custkey").alias("uuid"))


@register("surrogate_key", "SELECT row_number() OVER (ORDER BY ts, event_id) AS id, event_id, ts, user_id FROM events")
def surrogate_key(spark, sf_dir):
    """Dense serial key in (ts, event_id) order, without a global window."""
    ev = t(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    return ids.with_surrogate_key(ev, ["ts", "event_id"], "id")


CONFORM_TARGET = T.StructType([
    T.StructField("id", T.IntegerType(), False),
    T.StructField("name", T.StringType(), True),
    T.StructField("paid_amount", T.DecimalType(10, 2), True),
    T.StructField("color", T.StringType(), True),
    T.StructField("closed_on", T.DateType(), True),
])


@register("conform_to_schema",
          "SELECT CAST(id AS INTEGER) AS id, name, try_cast(paid_amount AS DECIMAL(10,2)) AS paid_amount, color, "
          "CAST(NULL AS DATE) AS closed_on, CASE WHEN paid_amount IS NOT NULL AND try_cast(paid_amount AS "
          f"DECIMAL(10,2)) IS NULL THEN 'paid_amount' ELSE '' END AS conform_errors FROM ({FLAT_SRC_SQL})")
def conform_to_schema(spark, sf_dir):
    """Shaped to a target table's columns and types, errors listed."""
    df = mapping.conform_to_schema(mapping.normalize_columns(_flat_raw(spark, sf_dir)), CONFORM_TARGET)
    return df.withColumn("conform_errors", F.array_join(mapping.CONFORM_ERRORS, ",")).drop(mapping.CONFORM_ERRORS)


@register("safe_casts",
          "SELECT event_id, try_cast(CAST(event_id AS VARCHAR) AS BIGINT) AS id_num, "
          "try_cast(substr(CAST(ts AS VARCHAR), 1, 10) AS DATE) AS day, try_cast(event_type AS INTEGER) AS type_num, "
          "try_cast(CAST(CAST(value AS DECIMAL(12,4)) AS VARCHAR) AS DECIMAL(10,2)) AS amount FROM events")
def safe_casts(spark, sf_dir):
    """Casts that give null instead of failing under ANSI."""
    ev = t(spark, sf_dir, "events")
    return ev.select("event_id",
                     X.safe_cast(F.col("event_id").cast("string"), "bigint").alias("id_num"),
                     X.safe_cast(F.substring(F.col("ts").cast("string"), 1, 10), "date").alias("day"),
                     X.safe_cast("event_type", "int").alias("type_num"),
                     X.decimal_amount(F.col("value").cast("decimal(12,4)").cast("string")).alias("amount"))


@register("file_lineage", "SELECT o_orderkey, 'orders' AS source_file FROM orders")
def file_lineage(spark, sf_dir):
    """The file each row came from."""
    return t(spark, sf_dir, "orders").select("o_orderkey", ids.source_file_stem().alias("source_file"))


# ============================================================ filters, checks


def _flat_raw(spark, sf_dir) -> DataFrame:
    """The dirty flat records as a job sees them: read back from CSV files."""
    return readers.read_csv(spark, write_flat_csv(spark, sf_dir))


def _flat_cleaned(spark, sf_dir) -> DataFrame:
    return jobs.clean_flat_records(_flat_raw(spark, sf_dir), RUN_TS)


@register("unparsed_rows", "SELECT id, created_at_ori FROM (" + flat_clean_sql() + ") "
                           "WHERE created_at IS NULL AND created_at_ori IS NOT NULL AND created_at_ori <> 'not a date'")
def unparsed_rows(spark, sf_dir):
    """L2: values that failed to parse, known non-dates left out (over the
    records as the job reads them from CSV)."""
    return quality.unparsed_rows(_flat_cleaned(spark, sf_dir), "created_at_ori", "created_at", "not a date") \
        .select("id", "created_at_ori")


@register("row_cap", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 10000")
def row_cap(spark, sf_dir):
    """L3: the first 10,000 rows in key order (the cap is the feature)."""
    return quality.row_cap(t(spark, sf_dir, "orders"), 10000, ["o_orderkey"])


_FLAT_OUT = ["uuid", "id", "name", "address", "color", "created_at_ori", "created_at", "last_login_ori",
             "last_login", "is_claimed_ori", "is_claimed", "paid_amount", "inserted_date"]


@register("null_counts", "SELECT count(*) AS row_count, " + ", ".join(
    f"CAST(count_if({c} IS NULL) AS BIGINT) AS {c}" for c in _FLAT_OUT) + " FROM (" + flat_clean_sql() + ")")
def null_counts(spark, sf_dir):
    """Q1 + Q4: row count and every column's nulls in one pass."""
    return quality.null_counts(_flat_cleaned(spark, sf_dir))


_NN_COLS = ["name", "color", "created_at", "last_login", "is_claimed", "paid_amount"]


@register("not_null_violations", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS null_count FROM ({flat_clean_sql()}) "
    f"HAVING count_if({c} IS NULL) > 0" for c in _NN_COLS))
def not_null_violations(spark, sf_dir):
    """Q2."""
    return quality.not_null_violations(_flat_cleaned(spark, sf_dir), _NN_COLS)


@register("duplicate_keys", "SELECT user_id, count(*) AS count FROM events GROUP BY user_id HAVING count(*) > 1")
def duplicate_keys(spark, sf_dir):
    """Q3 (with L1): keys that repeat."""
    return quality.duplicate_keys(t(spark, sf_dir, "events"), "user_id")


@register("row_count", "SELECT count(*) AS row_count FROM lineitem")
def row_count(spark, sf_dir):
    """Q4."""
    return quality.row_count(t(spark, sf_dir, "lineitem"))


@register("non_empty", "SELECT count(*) > 0 AS non_empty FROM (SELECT 1 FROM lineitem LIMIT 1)")
def non_empty(spark, sf_dir):
    """Q5: stops at the first row found."""
    return t(spark, sf_dir, "lineitem").limit(1).agg((F.count(F.lit(1)) > 0).alias("non_empty"))


@register("count_reconciliation", "SELECT count(*) AS src_count, count(*) AS dest_count FROM orders")
def count_reconciliation(spark, sf_dir):
    """Q7: rows read against rows written, observed during the write."""
    res = jobs.flat_record_job(spark, write_flat_csv(spark, sf_dir), RUN_TS,
                               sink=lambda d: d.write.format("noop").mode("overwrite").save())
    return spark.createDataFrame([(res.metrics["src_count"], res.metrics["dest_count"])],
                                 "src_count bigint, dest_count bigint")


_UUID_CANDIDATE = (f"CASE o_orderkey % 5 WHEN 0 THEN upper({FX.uuid_text('o_orderkey')}) "
                   f"WHEN 1 THEN substr({FX.uuid_text('o_orderkey')}, 1, 30) WHEN 2 THEN NULL "
                   f"ELSE {FX.uuid_text('o_orderkey')} END")


@register("uuid_format_violations",
          f"SELECT o_orderkey, candidate FROM (SELECT o_orderkey, {_UUID_CANDIDATE} AS candidate FROM orders) "
          f"WHERE candidate IS NULL OR NOT regexp_matches(candidate, {O.q(quality.UUID_PATTERN)})")
def uuid_format_violations(spark, sf_dir):
    """Q8."""
    df = t(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{_UUID_CANDIDATE} AS candidate")
    return quality.uuid_format_violations(df, "candidate")


_PK = "CASE WHEN event_type = 'error' THEN NULL ELSE user_id END"


@register("primary_key_violations",
          f"SELECT pk, count(*) AS count, concat_ws(',', CASE WHEN count(*) > 1 THEN 'duplicate' END, "
          f"CASE WHEN pk IS NULL THEN 'null' END) AS reason FROM (SELECT {_PK} AS pk FROM events) "
          f"GROUP BY pk HAVING count(*) > 1 OR pk IS NULL")
def primary_key_violations(spark, sf_dir):
    """Q9: repeats and nulls in one grouped pass."""
    return quality.primary_key_violations(t(spark, sf_dir, "events").selectExpr(f"{_PK} AS pk"), "pk")


@register("foreign_key_orphans",
          "SELECT o.* FROM orders o WHERE o.o_custkey IS NOT NULL AND NOT EXISTS "
          "(SELECT 1 FROM customer c WHERE c.c_acctbal >= 0 AND c.c_custkey = o.o_custkey)")
def foreign_key_orphans(spark, sf_dir):
    """Q10: orders whose customer was rejected (negative balance)."""
    kept = t(spark, sf_dir, "customer").where(F.col("c_acctbal") >= 0)
    return quality.foreign_key_orphans(t(spark, sf_dir, "orders"), kept, ["o_custkey"], ["c_custkey"])


@register("cascade_delete",
          "SELECT o.* FROM orders o WHERE NOT EXISTS "
          "(SELECT 1 FROM customer c WHERE c.c_mktsegment = 'AUTOMOBILE' AND c.c_custkey = o.o_custkey)")
def cascade_delete(spark, sf_dir):
    """Q11: orders left after the AUTOMOBILE customers are deleted."""
    gone = t(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "AUTOMOBILE")
    return quality.cascade_delete(t(spark, sf_dir, "orders"), gone, ["o_custkey"], ["c_custkey"])


def contract_rules() -> dict:
    return {
        "name_present": F.col("name").isNotNull() & (X.trim_text("name") != ""),
        "created_at_readable": F.col("created_at").isNull() | X.clean_timestamp("created_at").isNotNull()
        | (F.col("created_at") == "not a date"),
        "paid_amount_fits": F.col("paid_amount").isNull() | X.decimal_amount("paid_amount").isNotNull(),
    }


def _contract_sql() -> str:
    rules = {
        "name_present": "name IS NOT NULL AND trim(name) <> ''",
        "created_at_readable": f"created_at IS NULL OR {O.clean_timestamp('created_at')} IS NOT NULL "
                               f"OR created_at = 'not a date'",
        "paid_amount_fits": f"paid_amount IS NULL OR {O.decimal_amount('paid_amount')} IS NOT NULL",
    }
    flags = ", ".join(f"CASE WHEN NOT coalesce(({sql}), FALSE) THEN '{n}' END" for n, sql in rules.items())
    return (f"SELECT id, failed_rules FROM (SELECT id, concat_ws(',', {flags}) AS failed_rules "
            f"FROM ({FLAT_SRC_SQL})) WHERE failed_rules <> ''")


@register("contract_rejects", _contract_sql())
def contract_rejects(spark, sf_dir):
    """Q12: rows breaking the record contract, with the rules they break."""
    src = mapping.normalize_columns(_flat_raw(spark, sf_dir))
    _, rejected = quality.split_by_contract(src, contract_rules())
    return rejected.select("id", F.array_join(quality.FAILED_RULES, ",").alias("failed_rules"))


@register("cleaning_failure_report", "SELECT " + ", ".join(
    f"CAST(count_if({c}_ori IS NOT NULL AND {c} IS NULL) AS BIGINT) AS {c}"
    for c in ["created_at", "last_login", "is_claimed"]) + f" FROM ({flat_clean_sql()})")
def cleaning_failure_report(spark, sf_dir):
    """Q13."""
    return quality.cleaning_failure_report(_flat_cleaned(spark, sf_dir), {
        c: (f"{c}_ori", c) for c in ["created_at", "last_login", "is_claimed"]})


_REPORT_PAIRS = {c: (f"{c}_ori", c) for c in ["created_at", "last_login", "is_claimed"]}


@register("quality_report",
          "SELECT count(*) AS row_count, CAST(count_if(id IS NULL) AS BIGINT) AS nulls_id, "
          "CAST(count_if(uuid IS NULL) AS BIGINT) AS nulls_uuid, "
          + ", ".join(f"CAST(count_if({c}_ori IS NOT NULL AND {c} IS NULL) AS BIGINT) AS failed_{c}"
                      for c in _REPORT_PAIRS)
          + ", CAST(count_if(NOT coalesce(name IS NOT NULL AND trim(name) <> '', FALSE)) AS BIGINT) AS broken_name_present"
          + ", CAST(count_if(NOT coalesce(paid_amount IS NOT NULL, FALSE)) AS BIGINT) AS broken_paid_amount_present"
          + f" FROM ({flat_clean_sql()})")
def quality_report(spark, sf_dir):
    """Q1 + Q4 + Q12 + Q13 in one aggregate pass over the cleaned records."""
    return quality.quality_report(
        _flat_cleaned(spark, sf_dir), required=["id", "uuid"], clean_pairs=_REPORT_PAIRS,
        rules={"name_present": F.col("name").isNotNull() & (F.col("name") != ""),
               "paid_amount_present": F.col("paid_amount").isNotNull()})


@register("latest_per_key",
          "SELECT event_id, ts, user_id, event_type, value, props FROM (SELECT *, row_number() OVER "
          "(PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC, event_type DESC, value DESC, "
          "props DESC) AS rn FROM events) WHERE rn = 1")
def latest_per_key(spark, sf_dir):
    """The latest event per user."""
    return quality.latest_per_key(t(spark, sf_dir, "events"), ["user_id"], ["ts"])


# ============================================================ scalar cleaners

_CUST_PADDED = "CASE c_custkey % 3 WHEN 0 THEN '  ' || c_name || ' ' WHEN 1 THEN c_name || CHR(9) ELSE c_name END"
_PART_CASED = "CASE p_partkey % 3 WHEN 0 THEN ' ' || upper(p_name) || ' ' WHEN 1 THEN lower(p_name) ELSE p_name END"
_REGEX_REWRITES = [(r"\s+", " "), (r"[0-9]+", "#"), (r"^ | $", "")]
_DIRTY_TS = FX.dirty_timestamp_text("o_orderkey", "o_orderdate")
_CLAMP_TEXT = ("CASE o_orderkey % 3 WHEN 0 THEN '18' || substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 3, 8) "
               "WHEN 1 THEN '20' || CAST(29 + o_orderkey % 3 AS STRING) || substr(CAST(CAST(o_orderdate AS DATE) "
               "AS STRING), 5, 6) || ' 12:00:00' ELSE CAST(o_orderdate AS STRING) END")
_LONG_DATES = ("CASE WHEN o_orderkey % 20 IN (1, 2, 8, 9) THEN " + _DIRTY_TS + " ELSE "
               "CAST(day(o_orderdate) AS STRING) || 'th of the month' END")

_scalar("trim_text", "customer", "c_custkey", _CUST_PADDED, X.trim_text, O.trim_text)
_scalar("single_line_text", "documents", "doc_id", "text", X.single_line_text, O.single_line_text, keep_raw=False)
_scalar("initcap_text", "part", "p_partkey", _PART_CASED, X.initcap_text, O.initcap_text)
_scalar("regex_chain", "conversations", "conv_id, turn", "text",
        lambda c: X.regex_chain(c, _REGEX_REWRITES), lambda x: O.chain(x, _REGEX_REWRITES), keep_raw=False)
_scalar("clean_phone", "orders", "o_orderkey", _ORDER_PHONE, X.clean_phone, O.clean_phone)
_scalar("clean_identity_number", "customer", "c_custkey", FX.identity_text("c_custkey"),
        X.clean_identity_number, O.clean_identity_number)
_scalar("clean_boolean", "events", "event_id", FX.boolean_text("event_id"), X.clean_boolean, O.clean_boolean)
_scalar("file_stem", "pages", "page_id", "url", X.file_stem, O.file_stem)
_scalar("clean_timestamp", "orders", "o_orderkey", _DIRTY_TS, X.clean_timestamp, O.clean_timestamp)
_scalar("epoch_text_to_timestamp", "events", "event_id", FX.epoch_text("event_id"),
        X.epoch_text_to_timestamp, O.epoch_text_to_timestamp)
_scalar("epoch_to_timestamp", "events", "event_id", "1577836800 + event_id * 3607",
        X.epoch_to_timestamp, O.epoch_to_timestamp)
_scalar("repair_time_string", "events", "event_id", FX.EVENT_TEXTS[0][1], X.repair_time_string, O.repair_time_string)
_scalar("parse_with_pattern", "events", "event_id", FX.EVENT_TEXTS[3][1],
        lambda c: X.parse_with_pattern(c, "yyyy-MM-dd HHmm:ss"), lambda x: f"try_strptime({x}, '%Y-%m-%d %H%M:%S')")
_scalar("strip_ordinals", "orders", "o_orderkey", _LONG_DATES, X.strip_ordinals, O.strip_ordinals)
_scalar("clamp_dates", "orders", "o_orderkey", _CLAMP_TEXT,
        lambda c: X.clamp_dates(X.safe_timestamp(c)), lambda x: O.clamp_dates(O.safe_timestamp(x)))
_scalar("decimal_amount", "orders", "o_orderkey", FX.amount_text("o_orderkey", "o_totalprice"),
        X.decimal_amount, O.decimal_amount)
_scalar("text_to_date", "customer", "c_custkey", FX.date_text("c_custkey"), X.text_to_date, O.text_to_date)
_scalar("hash_identifier", "customer", "c_custkey", "c_name", X.hash_identifier, O.hash_identifier)
_scalar("mask_secret", "customer", "c_custkey", "'pw-' || CAST(c_custkey * 31 % 100000 AS STRING)",
        X.mask_secret, lambda x: "'********'")
_scalar("regex_predicate", "part", "p_partkey", "p_name", lambda c: X.matches(c, r"^(red|blue) "),
        lambda x: f"regexp_matches({x}, '^(red|blue) ')")
_scalar("substring_length", "events", "event_id", FX.EVENT_TEXTS[0][1],
        lambda c: F.concat_ws("|", X.text_prefix(c, 10), X.text_length(c).cast("string")),
        lambda x: f"concat_ws('|', substr({x}, 1, 10), CAST(length({x}) AS VARCHAR))")


# ============================================================ whole jobs


@register("job_flat_records", flat_clean_sql())
def job_flat_records(spark, sf_dir):
    """B1 (flagship): CSV read, checked, names tidied, mapped and cleaned."""
    return jobs.flat_record_job(spark, write_flat_csv(spark, sf_dir), RUN_TS).frames["records"]


@register("job_flat_records_parquet", flat_clean_sql())
def job_flat_records_parquet(spark, sf_dir):
    """B1 with Parquet input (format dispatch): the same table as from CSV."""
    return jobs.flat_record_job(spark, write_flat_as(spark, sf_dir, "parquet"), RUN_TS,
                                file_format="parquet").frames["records"]


@register("job_flat_records_json", flat_clean_sql())
def job_flat_records_json(spark, sf_dir):
    """B1 with line-JSON input and its known all-text schema: the same table again."""
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n, _ in FX.FLAT_SOURCE])
    return jobs.flat_record_job(spark, write_flat_as(spark, sf_dir, "json"), RUN_TS, file_format="json",
                                schema=schema).frames["records"]


# Each order twice under the key of its customer, the second copy the same row
# again for every third order: repeated ids, and rows that are wholly equal.
_DUP_COLUMNS = ["id", "name", "address", "color", "created_at", "last_login", "is_claimed", "paid_amount"]
_DUP_SQL = (f"SELECT CAST(c AS VARCHAR) AS id, {', '.join(_DUP_COLUMNS[1:])} FROM (SELECT o_custkey AS c, f.* "
            f"FROM orders o JOIN ({FLAT_SRC_SQL}) f ON CAST(o.o_orderkey AS VARCHAR) = f.id "
            f"UNION ALL SELECT o_custkey AS c, f.* FROM orders o JOIN ({FLAT_SRC_SQL}) f "
            f"ON CAST(o.o_orderkey AS VARCHAR) = f.id WHERE o_orderkey % 3 = 0)")


def duplicated_flat_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = FX.derive(t(spark, sf_dir, "orders"), list(zip(FX.FLAT_COLUMNS, [x for _, x in FX.FLAT_SOURCE])),
                    keep=["o_orderkey", "o_custkey"]).withColumn("id", F.col("o_custkey").cast("string"))
    return src.unionByName(src.where("o_orderkey % 3 = 0")).select(*_DUP_COLUMNS)


@register("job_flat_duplicates",
          f"SELECT {O.stable_uuid('id', 'occurrence')} AS uuid, id, {O.trim_text('name')} AS name, "
          f"{O.decimal_amount('paid_amount')} AS paid_amount FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY "
          f"{O.row_digest(*_DUP_COLUMNS)}) - 1 AS occurrence FROM ({_DUP_SQL}))")
def job_flat_duplicates(spark, sf_dir):
    """B1 where ids repeat and rows are equal: as many distinct uuids as rows,
    the same ones on each run."""
    def write() -> str:
        path = scratch_path(spark, "flat-duplicates")
        duplicated_flat_records(spark, sf_dir).write.parquet(path)
        return path
    path = _write_once(spark, sf_dir, "flat-duplicates", write)
    return jobs.flat_record_job(spark, path, RUN_TS, file_format="parquet").frames["records"].select(
        "uuid", "id", "name", "paid_amount")


def _nested_users_sql() -> str:
    return (
        f"SELECT user_id, {O.stable_uuid(O.q('users'), 'user_id', '0')} AS uuid, created_at AS created_at_ori, "
        f"{O.repair_time_string('created_at')} AS created_at, updated_at AS updated_at_ori, "
        f"{O.repair_time_string('updated_at')} AS updated_at, logged_at AS logged_at_ori, "
        f"{O.epoch_to_timestamp('logged_at')} AS logged_at, name, {O.text_to_date('dob')} AS dob, "
        f"{O.single_line_text('address')} AS address, username, '********' AS password, "
        f"{O.hash_identifier('national_id')} AS national_id, car_brand, car_license_plate, is_active, "
        f"{RUN_TS_SQL} AS inserted_date FROM ({NESTED_SQL})"
    )


def _nested_phones_sql() -> str:
    return (f"SELECT user_id, {O.stable_uuid(O.q('telephone_numbers'), 'user_id', '0', 'pos')} AS uuid, "
            f"telephone_numbers AS telephone_numbers_ori, {O.clean_phone('telephone_numbers')} AS telephone_numbers, "
            f"{RUN_TS_SQL} AS inserted_date FROM ({phones_sql()})")


def _nested_jobs_sql() -> str:
    return (f"SELECT user_id, {O.stable_uuid(O.q('jobs_history'), 'user_id', '0', 'pos')} AS uuid, "
            f"{O.initcap_text('occupation')} AS occupation, {O.trim_text('employer')} AS employer, is_fulltime, "
            f'"start" AS start_ori, {O.text_to_date(chr(34) + "start" + chr(34))} AS start_date, '
            f'"end" AS end_ori, {O.text_to_date(chr(34) + "end" + chr(34))} AS end_date, '
            f"{RUN_TS_SQL} AS inserted_date FROM ({jobs_sql()})")


def _nested_job(spark, sf_dir, table_name):
    return jobs.nested_record_job(spark, write_nested_json(spark, sf_dir), RUN_TS).frames[table_name]


@register("job_nested_users", _nested_users_sql())
def job_nested_users(spark, sf_dir):
    """B2: the users table of the nested-record job."""
    return _nested_job(spark, sf_dir, "users")


@register("job_nested_users_parquet", _nested_users_sql())
def job_nested_users_parquet(spark, sf_dir):
    """B2 with Parquet input: the same users table."""
    def write() -> str:
        path = scratch_path(spark, "nested-parquet")
        FX.nested_source(spark, sf_dir).drop("_bad_balance").write.parquet(path)
        return path
    path = _write_once(spark, sf_dir, "nested-parquet", write)
    return jobs.nested_record_job(spark, path, RUN_TS, file_format="parquet").frames["users"]


@register("job_nested_phones", _nested_phones_sql())
def job_nested_phones(spark, sf_dir):
    """B2: the telephone-numbers table."""
    return _nested_job(spark, sf_dir, "telephone_numbers")


@register("job_nested_jobs", _nested_jobs_sql())
def job_nested_jobs(spark, sf_dir):
    """B2: the jobs-history table."""
    return _nested_job(spark, sf_dir, "jobs_history")


def _with_errors(df: DataFrame) -> DataFrame:
    return df.withColumn("conform_errors", F.array_join(mapping.CONFORM_ERRORS, ",")).drop(mapping.CONFORM_ERRORS)


_USERS_TBL_COLS = ", ".join(f.name for f in targets.USERS_TBL.fields)


@register("target_users_tbl", f"SELECT {_USERS_TBL_COLS}, CASE WHEN user_id IS NULL THEN 'user_id' ELSE '' END "
                              f"AS conform_errors FROM ({_nested_users_sql()})")
def target_users_tbl(spark, sf_dir):
    """P14 on the users target table: the nested job's users in its shape."""
    return _with_errors(targets.shape_users(_nested_job(spark, sf_dir, "users")))


@register("target_telephone_numbers",
          "SELECT row_number() OVER (ORDER BY user_id, uuid) AS id, user_id, "
          "try_cast(telephone_numbers AS BIGINT) AS telephone_number, inserted_date, '' AS conform_errors "
          f"FROM ({_nested_phones_sql()})")
def target_telephone_numbers(spark, sf_dir):
    """P13 + P14: serial ids and the integer number column of the target."""
    return _with_errors(targets.shape_telephone_numbers(_nested_job(spark, sf_dir, "telephone_numbers")))


@register("target_jobs_history",
          "SELECT row_number() OVER (ORDER BY user_id, uuid) AS id, user_id, occupation, "
          'is_fulltime, start_date AS "start", end_date AS "end", employer, inserted_date, \'\' AS conform_errors '
          f"FROM ({_nested_jobs_sql()})")
def target_jobs_history(spark, sf_dir):
    """P13 + P14: serial ids, dates under the target's start / end names."""
    return _with_errors(targets.shape_jobs_history(_nested_job(spark, sf_dir, "jobs_history")))


@register("target_flat_records",
          "SELECT uuid, CAST(id AS INTEGER) AS id, name, address, color, created_at_ori, created_at, "
          "last_login_ori, last_login, is_claimed_ori, is_claimed, paid_amount, inserted_date, "
          f"CASE WHEN uuid IS NULL THEN 'uuid' ELSE '' END AS conform_errors FROM ({flat_clean_sql()})")
def target_flat_records(spark, sf_dir):
    """P14 on the flat-record target table."""
    return _with_errors(targets.shape_flat_records(
        jobs.flat_record_job(spark, write_flat_csv(spark, sf_dir), RUN_TS).frames["records"]))


@register("fk_orphans_bucketed",
          f"SELECT p.* FROM ({_nested_phones_sql()}) p WHERE p.user_id IS NOT NULL AND NOT EXISTS "
          f"(SELECT 1 FROM ({_nested_users_sql()}) u WHERE (u.is_active IS NULL OR u.is_active) "
          f"AND u.user_id = p.user_id)")
def fk_orphans_bucketed(spark, sf_dir):
    """Q10 between loaded tables bucketed on user_id: phones whose user was
    left out of the users table (inactive users), with no shuffle when the
    tables are too big to broadcast."""
    res = jobs.nested_record_job(spark, write_nested_json(spark, sf_dir), RUN_TS)
    tag = scratch_path(spark, "bucketed").rsplit("-", 1)[-1]
    users, phones = f"lw_users_{tag}", f"lw_phones_{tag}"
    kept = res.frames["users"].where(F.col("is_active").isNull() | F.col("is_active"))
    sinks.write_table(kept, users, bucket_by=["user_id"], num_buckets=8, path=scratch_path(spark, users))
    sinks.write_table(res.frames["telephone_numbers"], phones, bucket_by=["user_id"], num_buckets=8,
                      path=scratch_path(spark, phones))
    return quality.foreign_key_orphans(spark.table(phones), spark.table(users), ["user_id"])


@register("stream_flat_records", flat_clean_sql())
def stream_flat_records(spark, sf_dir):
    """The flat-record mapping run incrementally with Structured Streaming
    (available-now trigger, checkpointed), read back from its sink."""
    from lakewash.streaming import run_flat_record_load

    source = write_flat_csv(spark, sf_dir)
    out, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    run_flat_record_load(spark, source, out, ckpt, RUN_TS)
    return spark.read.parquet(out).drop("batch_id")


@register("stream_nested_users", _nested_users_sql())
def stream_nested_users(spark, sf_dir):
    """E1 for the nested job: users table from an incremental load."""
    from lakewash.streaming import run_nested_record_load

    out, ckpt = scratch_path(spark, "stream-nested-out"), scratch_path(spark, "stream-nested-ckpt")
    run_nested_record_load(spark, write_nested_json(spark, sf_dir), out, ckpt, RUN_TS)
    return spark.read.parquet(f"{out}/users").drop("batch_id")


from lakewash.plans import catalog_loads  # noqa: E402,F401  (registers its queries here)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q.build for name, q in CATALOG.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.oracle for name, q in CATALOG.items() if q.oracle is not None}
