"""More of the catalog: queries over several loads, versions, malformed
records, content checks and joins along time (see
:mod:`lakewash.plans.catalog`, which registers these at its end)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewash.operators import quality, sketches, temporal
from lakewash.operators.fingerprint import reconcile
from lakewash.plans import catalog as C
from lakewash.plans import fixtures as FX
from lakewash.plans import jobs
from lakewash.plans import oracle as O
from lakewash.plans.catalog import register, t
from lakewash.session import scratch_path
from lakewash.sources import records, sinks
from lakewash.sources.versions import VersionedTable

# ================================================== uniqueness across loads

# Three loads of orders under their customer's id; every ninth order comes
# again, as it was, in the load after its own.
_LOADS = "o_orderkey % 3"
_LOADED = [c for c in FX.FLAT_COLUMNS if c != "id"]


def _loads_sql() -> str:
    flat = FX.derive_sql("orders", list(zip(FX.FLAT_COLUMNS, [x for _, x in FX.FLAT_SOURCE])), keep=["o_orderkey", "o_custkey"])
    rows = f"SELECT CAST(o_custkey AS VARCHAR) AS id, {', '.join(_LOADED)}, o_orderkey FROM ({flat})"
    return (f"SELECT *, {_LOADS} AS load FROM ({rows}) UNION ALL "
            f"SELECT *, ({_LOADS} + 1) % 3 AS load FROM ({rows}) WHERE o_orderkey % 9 = 0")


def _load(spark: SparkSession, sf_dir: str, i: int) -> DataFrame:
    src = FX.derive(t(spark, sf_dir, "orders"), list(zip(FX.FLAT_COLUMNS, [x for _, x in FX.FLAT_SOURCE])),
                    keep=["o_orderkey", "o_custkey"]).withColumn("id", F.col("o_custkey").cast("string"))
    load = F.expr(_LOADS)
    again = src.where("o_orderkey % 9 = 0").withColumn("load", (load + 1) % 3)
    both = src.withColumn("load", load).unionByName(again).select("load", "id", *_LOADED)
    return both.where(F.col("load") == i).drop("load")


def _run_loads(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    from lakewash.streaming import run_flat_record_load

    source, out, ckpt = (scratch_path(spark, x) for x in ("three-loads", "loads-out", "loads-ckpt"))
    parts = spark.sparkContext.defaultParallelism
    for i in range(3):  # a load is many files, since a multi-line file is one task; what has landed is one batch
        sinks.write_csv(_load(spark, sf_dir, i).repartition(parts), source, mode="append", options={"nullValue": ""})
        run_flat_record_load(spark, source, out, ckpt, C.RUN_TS)
    return out, ckpt


_CSV_BACK = ", ".join(f"NULLIF({c}, '') AS {c}" for c in _LOADED)  # an empty field is read as null


@register("stream_duplicate_keys",
          "SELECT id AS key, CAST(sum(n) AS BIGINT) AS rows, CAST(sum(most) AS BIGINT) AS different, "
          "CAST(max(loads) AS BIGINT) AS loads FROM (SELECT id, "
          + ", ".join(_LOADED) + ", sum(n) AS n, max(n) AS most, max(loads) AS loads FROM (SELECT id, "
          + ", ".join(_LOADED) + ", load, count(*) AS n, max(loads) AS loads FROM (SELECT l.*, k.loads FROM (SELECT id, "
          + _CSV_BACK + f", load FROM ({_loads_sql()})) l JOIN (SELECT id, count(DISTINCT load) AS loads FROM "
          f"({_loads_sql()}) GROUP BY id) k ON k.id = l.id) GROUP BY id, " + ", ".join(_LOADED) + ", load) GROUP BY id, "
          + ", ".join(_LOADED) + ") GROUP BY id HAVING sum(n) > 1")
def stream_duplicate_keys(spark, sf_dir):
    """Q3 and Q9 over loads: keys that came more than once in three batches,
    with how many rows, how many different ones and in how many batches."""
    from lakewash.streaming import key_table

    _, ckpt = _run_loads(spark, sf_dir)
    return key_table(spark, ckpt).duplicates().select("key", "rows", "different", "loads")


@register("stream_row_ids",
          "SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(sum(most) AS BIGINT) AS ids FROM (SELECT sum(n) AS n, max(n) AS most "
          "FROM (SELECT id, " + ", ".join(_LOADED) + ", load, count(*) AS n FROM (SELECT id, " + _CSV_BACK
          + f", load FROM ({_loads_sql()})) GROUP BY ALL) GROUP BY id, " + ", ".join(_LOADED) + ")")
def stream_row_ids(spark, sf_dir):
    """P12 over loads: a row that arrives again has the uuid it had, any other
    row one of its own."""
    out, _ = _run_loads(spark, sf_dir)
    return spark.read.parquet(out).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("uuid").alias("ids"))


# ================================================== malformed records

_Q = "CHR(34)"
_NAME = f"replace(c_name, '#', {_Q} || {_Q})"
_RECORD = (f"CASE c_custkey % 11 "
           f"WHEN 1 THEN CAST(c_custkey AS STRING) || ',' || c_mktsegment "
           f"WHEN 2 THEN CAST(c_custkey AS STRING) || ',' || c_mktsegment || ',x,more' "
           f"WHEN 3 THEN CAST(c_custkey AS STRING) || ',' || {_Q} || c_mktsegment || ',x' "
           f"WHEN 4 THEN CAST(c_custkey AS STRING) || ',a,' || {_Q} || c_mktsegment "
           f"WHEN 5 THEN CAST(c_custkey AS STRING) || ',' || {_Q} || c_mktsegment || {_Q} || 'junk,x' "
           f"WHEN 6 THEN CAST(c_custkey AS STRING) || ',' || {_Q} || c_mktsegment || ', ' || {_NAME} || {_Q} || ',' "
           f"WHEN 7 THEN {_Q} || CAST(c_custkey AS STRING) || {_Q} || ',' || c_mktsegment || ',6' || {_Q} || ' nail' "
           f"ELSE CAST(c_custkey AS STRING) || ',' || c_mktsegment || ',' || c_name END")
_REASON = ("CASE c_custkey % 11 WHEN 1 THEN 'short' WHEN 2 THEN 'long' WHEN 3 THEN 'broken_quote' WHEN 4 THEN 'broken_quote' "
           "WHEN 5 THEN 'broken_quote' END")
_HEADER = ["id", "segment", "note"]


def _write_records(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "csv-records")
    lines = t(spark, sf_dir, "customer").selectExpr(f"{_RECORD} AS value")
    header = F.lit(",".join(_HEADER))
    for part in range(3):  # three files, each with its header
        rows = lines.where(F.pmod(F.xxhash64("value"), F.lit(3)) == part).repartition(1)
        files = rows.agg(F.collect_list("value").alias("v")).select(
            F.concat_ws("\n", header, F.array_join("v", "\n")).alias("value"))
        files.write.mode("append").text(path)
    return path


_RECORDS_SQL = (
    f"SELECT CASE WHEN reason IS NULL THEN CAST(c_custkey AS VARCHAR) END AS id, CASE WHEN reason IS NULL THEN CASE "
    f"c_custkey % 11 WHEN 6 THEN c_mktsegment || ', ' || replace(c_name, '#', {_Q}) ELSE c_mktsegment END END AS segment, "
    f"CASE WHEN reason IS NULL THEN CASE c_custkey % 11 WHEN 6 THEN NULL WHEN 7 THEN '6' || {_Q} || ' nail' ELSE c_name END "
    f"END AS note, CASE WHEN reason IS NOT NULL THEN record END AS raw, reason "
    f"FROM (SELECT *, {_RECORD} AS record, {_REASON} AS reason FROM customer)")


def _records_out(df: DataFrame) -> DataFrame:
    good = F.col(records.REASON).isNull()
    return df.select(*[F.when(good, F.col(c)).alias(c) for c in _HEADER], F.col(records.RAW).alias("raw"),
                     F.col(records.REASON).alias("reason"))


@register("scan_csv_rejects", _RECORDS_SQL)
def scan_csv_rejects(spark, sf_dir):
    """Every record of one-line CSV files, malformed ones set aside
    with their raw text and reason."""
    path = C._write_once(spark, sf_dir, "csv-records", lambda: _write_records(spark, sf_dir))
    return _records_out(records.read_csv_records(spark, path, {"multiLine": False}))


@register("stream_csv_rejects", f"SELECT raw, reason FROM ({_RECORDS_SQL}) WHERE reason IS NOT NULL")
def stream_csv_rejects(spark, sf_dir):
    """The same on a stream: malformed records of files as they arrive."""
    source = C._write_once(spark, sf_dir, "csv-records", lambda: _write_records(spark, sf_dir))
    out = scratch_path(spark, "stream-records")
    read = records.stream_csv_records(spark, source, _HEADER, {"multiLine": False}, max_files_per_trigger=1)
    query = (records.rejected_records(read).writeStream.format("parquet")
             .option("checkpointLocation", scratch_path(spark, "records-ckpt"))
             .option("path", out).trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return spark.read.parquet(out)


_BAD_FLAT = ("CASE o_orderkey % 3 WHEN 0 THEN CAST(o_orderkey AS STRING) || ',only a name' "
             "WHEN 1 THEN CAST(o_orderkey AS STRING) || ',a,b,c,d,e,f,g,and more' "
             "ELSE CAST(o_orderkey AS STRING) || ',a,b,c' END")


def _write_flat_with_rejects(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "flat-rejects")
    orders = t(spark, sf_dir, "orders")
    (FX.flat_source(spark, sf_dir).repartition(4).write.option("header", "true").option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path))
    header = ",".join(name for name, _ in FX.FLAT_SOURCE)
    bad = orders.where("o_orderkey % 10 = 0").repartition(1).agg(F.collect_list(F.expr(_BAD_FLAT)).alias("v"))
    bad.select(F.concat_ws("\n", F.lit(header), F.array_join("v", "\n")).alias("value")).write.mode("append").text(path)
    return path


@register("job_flat_rejects",
          f"SELECT {_BAD_FLAT} AS raw, CASE o_orderkey % 3 WHEN 1 THEN 'long' ELSE 'short' END AS reason, "
          "CAST((SELECT count(*) FROM orders) AS BIGINT) AS loaded FROM orders WHERE o_orderkey % 10 = 0")
def job_flat_rejects(spark, sf_dir):
    """B1 on files with malformed rows: they are rejects, the others are loaded
    and both make up the source count."""
    path = C._write_once(spark, sf_dir, "flat-rejects", lambda: _write_flat_with_rejects(spark, sf_dir))
    res = jobs.flat_record_job(spark, path, C.RUN_TS, sink=sinks.StagedFolder(scratch_path(spark, "flat-loaded")))
    loaded = F.lit(res.metrics["src_count"] - res.metrics["rejected_rows"]).cast("bigint")
    return res.frames["rejects"].select("raw", "reason", loaded.alias("loaded"))


# ================================================== content reconciliation

_ALTERED = "CASE WHEN o_orderkey = (SELECT max(o_orderkey) FROM orders) THEN o_totalprice + 0.01 ELSE o_totalprice END"
_SWAPPED = "CASE o_orderkey WHEN 1 THEN (SELECT max(o_orderkey) FROM orders) WHEN (SELECT max(o_orderkey) FROM orders) THEN 1 ELSE o_orderkey END"


def _reconciled_sql(case: str, select: str) -> str:
    return (f"SELECT '{case}' AS copy, (SELECT count(*) FROM orders) AS source_rows, (SELECT count(*) FROM ({select})) AS "
            f"stored_rows, (SELECT count(*) FROM orders) = (SELECT count(*) FROM ({select})) AS same_rows, "
            f"(SELECT count(*) FROM (FROM orders EXCEPT ALL SELECT * FROM ({select}))) + (SELECT count(*) FROM "
            f"(SELECT * FROM ({select}) EXCEPT ALL FROM orders)) = 0 AS same_content")


_COPIES = {
    "whole": "SELECT * FROM orders",
    "one value altered": f"SELECT * REPLACE ({_ALTERED} AS o_totalprice) FROM orders",
    "two keys swapped": f"SELECT * REPLACE ({_SWAPPED} AS o_orderkey) FROM orders",
    "one row for another": "SELECT * FROM orders WHERE o_orderkey <> 1 UNION ALL SELECT * FROM orders WHERE o_orderkey = "
                           "(SELECT max(o_orderkey) FROM orders)",
}


@register("content_reconciliation", " UNION ALL ".join(_reconciled_sql(k, v) for k, v in _COPIES.items()))
def content_reconciliation(spark, sf_dir):
    """Q7 by content: a written copy of a table against its source, whole and
    after damage that keeps the number of rows (and some sums)."""
    orders = t(spark, sf_dir, "orders")
    last = orders.agg(F.max("o_orderkey").alias("last"))  # one row
    beside = orders.join(F.broadcast(last))
    changed = {
        "whole": orders,
        "one value altered": beside.withColumn("o_totalprice", F.when(
            F.col("o_orderkey") == F.col("last"), F.col("o_totalprice") + 0.01).otherwise(F.col("o_totalprice"))),
        "two keys swapped": beside.withColumn("o_orderkey", F.when(F.col("o_orderkey") == 1, F.col("last")).when(
            F.col("o_orderkey") == F.col("last"), F.lit(1)).otherwise(F.col("o_orderkey"))),
        "one row for another": orders.where("o_orderkey <> 1").unionByName(
            beside.where("o_orderkey = last").drop("last")),
    }
    out = None
    for case, rows in changed.items():
        path = scratch_path(spark, "copy")
        sinks.write_parquet(rows.select(*orders.columns), path)
        found = reconcile(orders, spark.read.parquet(path)).withColumn("copy", F.lit(case))
        out = found if out is None else out.unionByName(found)
    return out.select("copy", "source_rows", "stored_rows", "same_rows", "same_content")


# ================================================== versions and merges

_CUST = ["c_custkey", "c_name", "c_mktsegment", "c_acctbal"]
_CUST_COLS = ", ".join(_CUST)
_CLEAN_CUST = f"SELECT c_custkey, upper(trim(c_name)) AS c_name, c_mktsegment, c_acctbal FROM customer WHERE c_acctbal >= 0"


def _two_versions(spark: SparkSession, sf_dir: str) -> VersionedTable:
    table = VersionedTable(spark, scratch_path(spark, "versions"))
    cust = t(spark, sf_dir, "customer").select(*_CUST)
    table.refresh(cust)
    table.refresh(cust.where("c_acctbal >= 0").withColumn("c_name", F.upper(F.trim("c_name"))))
    return table


@register("sink_versioned_refresh", _CLEAN_CUST)
def sink_versioned_refresh(spark, sf_dir):
    """S12 without a rename: a table loaded, then refreshed by a new version."""
    return _two_versions(spark, sf_dir).read()


@register("scan_as_of_version", f"SELECT {_CUST_COLS} FROM customer")
def scan_as_of_version(spark, sf_dir):
    """The rows of the first version, after a second one was committed."""
    return _two_versions(spark, sf_dir).read(version=1)


@register("sink_merge",
          "SELECT c_custkey, CASE WHEN c_custkey % 5 = 1 THEN 'changed ' || c_name ELSE c_name END AS c_name, "
          "CASE WHEN c_custkey % 5 = 1 THEN NULL ELSE c_mktsegment END AS c_mktsegment, c_acctbal FROM customer "
          "WHERE c_custkey % 5 <> 2 UNION ALL SELECT -c_custkey, 'new ' || c_name, c_mktsegment, c_acctbal FROM customer "
          "WHERE c_custkey % 5 = 3")
def sink_merge(spark, sf_dir):
    """S7 by key: updates, inserts and deletes, some of keys that are not
    there, in one commit that rewrites the parts they fall in."""
    table = VersionedTable(spark, scratch_path(spark, "merge"))
    cust = t(spark, sf_dir, "customer").select(*_CUST)
    table.refresh(cust, key=["c_custkey"], parts=16)
    gone = F.lit(False).alias("gone")
    kind = F.col("c_custkey") % 5
    changes = cust.where(kind == 1).select("c_custkey", F.concat(F.lit("changed "), "c_name").alias("c_name"),
                                           F.lit(None).cast("string").alias("c_mktsegment"), "c_acctbal", gone)
    changes = changes.unionByName(cust.where(kind == 3).select(
        (-F.col("c_custkey")).alias("c_custkey"), F.concat(F.lit("new "), "c_name").alias("c_name"), "c_mktsegment", "c_acctbal", gone))
    changes = changes.unionByName(cust.where(kind == 2).withColumn("gone", F.lit(True)))
    changes = changes.unionByName(cust.where(kind == 4).withColumns({"c_custkey": -F.col("c_custkey"), "gone": F.lit(True)}))
    table.merge(changes, delete="gone")
    return table.read()


# ================================================== joins along time

# Orders as jobs of a user; a third of them belong to one user.
_JOB_USER = "CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END"
_JOB_END = ("CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) + "
            "CAST(o_orderkey % 40 - 3 AS INT) END")
_JOBS = (f"SELECT o_orderkey AS job_id, CASE WHEN o_orderkey % 71 = 0 THEN NULL ELSE {_JOB_USER} END AS user_id, "
         f"CASE WHEN o_orderkey % 67 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS start_date, {_JOB_END} AS end_date FROM orders")


def _jobs_of_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS job_id", f"CASE WHEN o_orderkey % 71 = 0 THEN NULL ELSE {_JOB_USER} END AS user_id",
        "CASE WHEN o_orderkey % 67 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS start_date", f"{_JOB_END} AS end_date")


@register("overlapping_jobs",
          "WITH j AS (SELECT *, coalesce(end_date, DATE '9999-12-31') AS e, user_id IS NOT NULL AND start_date < "
          f"coalesce(end_date, DATE '9999-12-31') AS ok FROM ({_JOBS})), p AS (SELECT user_id, start_date AS tm, 1 AS b, 0 AS z "
          "FROM j WHERE ok UNION ALL SELECT user_id, e, 0, 1 FROM j WHERE ok), r AS (SELECT user_id, tm, sum(sum(b)) OVER w - "
          "sum(b) AS begun, sum(sum(z)) OVER w AS ended FROM p GROUP BY user_id, tm WINDOW w AS (PARTITION BY user_id ORDER BY tm)) "
          "SELECT j.job_id, j.user_id, j.start_date, j.end_date, CAST(CASE WHEN ok THEN a.begun - s.ended - 1 END AS BIGINT) "
          "AS overlaps FROM j LEFT JOIN r a ON a.user_id = j.user_id AND a.tm = j.e LEFT JOIN r s ON s.user_id = j.user_id "
          "AND s.tm = j.start_date")
def overlapping_jobs(spark, sf_dir):
    """How many other jobs of a user overlap each job, one user holding a third
    of them: a sweep along time, no pairs."""
    return temporal.overlap_counts(_jobs_of_users(spark, sf_dir), "user_id", "start_date", "end_date")


_HISTORY = (f"SELECT user_id, user_id || ':' || pos AS job, {O.text_to_date(chr(34) + 'start' + chr(34))} AS s, "
            f"{O.text_to_date(chr(34) + 'end' + chr(34))} AS e FROM ({C.jobs_sql()})")


@register("overlapping_job_pairs",
          f"WITH h AS (SELECT *, coalesce(e, DATE '9999-12-31') AS z FROM ({_HISTORY}) WHERE s < coalesce(e, DATE '9999-12-31')) "
          "SELECT a.user_id, a.job AS left_id, b.job AS right_id, greatest(a.s, b.s) AS shared_from, "
          "NULLIF(least(a.z, b.z), DATE '9999-12-31') AS shared_to FROM h a JOIN h b ON a.user_id = b.user_id AND a.job < b.job "
          "AND a.s < b.z AND b.s < a.z")
def overlapping_job_pairs(spark, sf_dir):
    """Every two jobs of a user's history that overlap, and the shared time."""
    from lakewash.functions import text_to_date
    from lakewash.operators import nested

    fanned = nested.explode_structs(FX.nested_source(spark, sf_dir), ["user_id"], "jobs_history", position="pos")
    dated = fanned.select("user_id", F.concat_ws(":", "user_id", F.col("pos").cast("string")).alias("job"),
                          text_to_date("start").alias("s"), text_to_date("end").alias("e"))
    return temporal.overlapping_pairs(dated, "user_id", "job", "s", "e", days=3650)


_STATES = ("SELECT c_custkey AS user_id, CAST(DATE '1992-03-01' + CAST((c_custkey * 37 + (CASE WHEN c_custkey % 5 = 0 AND i = 3 "
           "THEN 2 ELSE i END) * 400) % 2400 AS INT) AS DATE) AS valid_from, c_mktsegment || ' ' || i AS segment, "
           "c_acctbal + i AS balance FROM (SELECT *, {unnest} AS i FROM customer)")


@register("users_as_of_job",
          "WITH s AS (SELECT user_id, valid_from, max(struct_pack(segment := segment, balance := balance)) AS v FROM ("
          + _STATES.format(unnest="unnest([0, 1, 2, 3])") + f") GROUP BY user_id, valid_from), j AS ({_JOBS}) "
          "SELECT j.job_id, j.user_id, j.start_date, s.v.segment AS segment, s.v.balance AS balance FROM j ASOF LEFT JOIN s "
          "ON j.user_id = s.user_id AND j.start_date >= s.valid_from")
def users_as_of_job(spark, sf_dir):
    """Each job with the user row that was valid at its start; users' rows tie,
    begin after some jobs, and one user holds a third of the jobs."""
    states = t(spark, sf_dir, "customer").selectExpr("*", "explode(array(0, 1, 2, 3)) AS i").selectExpr(
        "c_custkey AS user_id",
        "DATE '1992-03-01' + CAST((c_custkey * 37 + (CASE WHEN c_custkey % 5 = 0 AND i = 3 THEN 2 ELSE i END) * 400) % 2400 "
        "AS INT) AS valid_from", "c_mktsegment || ' ' || i AS segment", "c_acctbal + i AS balance")
    jobs_of = _jobs_of_users(spark, sf_dir).drop("end_date")
    return temporal.as_of_join(jobs_of, states, "user_id", "start_date", "valid_from", ["segment", "balance"])


# ================================================== reports and profiles

_SOURCES = ["north", "south", "west"]
_SOURCE_SQL = "CASE CAST(id AS BIGINT) % 3 WHEN 0 THEN 'north' WHEN 1 THEN 'south' ELSE 'west' END"


def _write_sources(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "landing")
    src = FX.flat_source(spark, sf_dir)
    for i, name in enumerate(_SOURCES):
        sinks.write_csv(src.where(F.col("ID").cast("bigint") % 3 == i).repartition(2), f"{path}/{name}",
                        options={"nullValue": ""})
    return path


_ROLLUP_AGGS = ("count(*) AS row_count, CAST(count_if(id IS NULL) AS BIGINT) AS nulls_id, "
                "CAST(count_if(name IS NULL) AS BIGINT) AS nulls_name, "
                + ", ".join(f"CAST(count_if({c}_ori IS NOT NULL AND {c} IS NULL) AS BIGINT) AS failed_{c}" for c in C._REPORT_PAIRS)
                + ", CAST(count_if(NOT coalesce(paid_amount IS NOT NULL, FALSE)) AS BIGINT) AS broken_paid_amount_present")


@register("quality_rollup",
          f"SELECT source, color, CAST(GROUPING(source) * 2 + GROUPING(color) AS INTEGER) AS level, {_ROLLUP_AGGS} FROM "
          f"(SELECT {_SOURCE_SQL} AS source, * FROM ({C.flat_clean_sql()})) GROUP BY ROLLUP(source, color)")
def quality_rollup(spark, sf_dir):
    """Q1, Q12 and Q13 for each source folder and colour, each folder, and all
    rows, in one pass."""
    path = C._write_once(spark, sf_dir, "landing", lambda: _write_sources(spark, sf_dir))
    read = records.good_records(records.read_csv_records(spark, f"{path}/*").withColumn(
        "source", F.element_at(F.split(records.FILE, "/"), -2)))
    cleaned = read.select("source", F.struct(*[F.col(f"`{c}`") for c in read.columns if c != "source"]).alias("r"))
    named = C.mapping.normalize_columns(cleaned.select("r.*")).columns
    rows = cleaned.select("source", *[F.col(f"r.`{c}`").alias(n) for c, n in zip(read.drop("source").columns, named)])
    mapped = C.mapping.apply_mapping(rows, {"source": "source", **jobs.flat_record_mapping(C.RUN_TS)})
    return quality.quality_rollup(mapped, ["source", "color"], required=["id", "name"], clean_pairs=C._REPORT_PAIRS,
                                  rules={"paid_amount_present": F.col("paid_amount").isNotNull()})


_PROFILED = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "clerk"]
_WITH_NULLS = "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'Clerk ' || CAST(o_custkey % 100 AS STRING) END AS clerk"


@register("profile_merge", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS rows, CAST(count_if({c} IS NULL) AS BIGINT) AS nulls, "
    f"count(DISTINCT {c}) AS exact, TRUE AS within_error, TRUE AS same_for_any_split FROM (SELECT *, {_WITH_NULLS} FROM orders)"
    for c in _PROFILED))
def profile_merge(spark, sf_dir):
    """Q1, Q3 and Q4 from stored profiles: three loads' sketches merged, held
    against the exact number of different values (three standard errors) and
    against another split of the same rows."""
    orders = t(spark, sf_dir, "orders").selectExpr("*", _WITH_NULLS)
    merged = []
    for label, load in (("thirds", "o_orderkey % 3"), ("status", "o_orderstatus")):
        path = scratch_path(spark, f"profiles-{label}")
        sinks.write_parquet(sketches.profile_sketch(orders.withColumn("load", F.expr(load)), _PROFILED, by=["load"]), path)
        stored = spark.read.parquet(path)
        merged.append(sketches.read_profile(sketches.merge_profiles(stored)))
    exact = orders.agg(*[F.count_distinct(F.col(c)).alias(c) for c in _PROFILED])
    exact = exact.unpivot([], [F.col(c) for c in _PROFILED], "column_name", "exact")
    one = merged[0].join(exact, "column_name")
    other = merged[1].select("column_name", F.col("distinct_estimate").alias("again"), F.col("rows").alias("rows_again"),
                             F.col("least").alias("least_again"), F.col("greatest").alias("greatest_again"))
    both = one.join(other, "column_name")
    near = F.abs(F.col("distinct_estimate") - F.col("exact")) <= F.lit(3) * sketches.RELATIVE_ERROR * F.col("exact") + 0.5
    same = ((F.col("again") == F.col("distinct_estimate")) & (F.col("rows") == F.col("rows_again"))
            & (F.col("least") == F.col("least_again")) & (F.col("greatest") == F.col("greatest_again")))
    return both.select("column_name", "rows", "nulls", "exact", near.alias("within_error"), same.alias("same_for_any_split"))


# ================================================== late parents

# An order waits for its payment of the next day; payments arrive a batch after
# their orders, and every seventh order is never paid.
_PERIOD = "least(CAST((year(o_orderdate) - 1992) / 2 AS INT), 2)"


def _write_orders_and_payments(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "late-parents")
    orders = t(spark, sf_dir, "orders").selectExpr("o_orderkey AS order_id", "CAST(o_orderdate AS TIMESTAMP) AS ordered_at",
                                                   f"{_PERIOD} AS period")
    paid = orders.where("order_id % 7 <> 0").selectExpr("order_id", "ordered_at + INTERVAL 1 DAY AS paid_at", "period")
    first = orders.agg(F.min("ordered_at").alias("paid_at")).select(F.lit(-1).cast("bigint").alias("order_id"), "paid_at")
    first.repartition(1).write.mode("append").parquet(f"{path}/payments")
    for i in range(3):
        orders.where(F.col("period") == i).drop("period").repartition(1).write.mode("append").parquet(f"{path}/orders")
        paid.where(F.col("period") == i).drop("period").repartition(1).write.mode("append").parquet(f"{path}/payments")
    return path


@register("stream_fk_orphans",
          "SELECT o_orderkey AS order_id, CAST(o_orderdate AS TIMESTAMP) AS ordered_at FROM orders, (SELECT least("
          "max(CAST(o_orderdate AS TIMESTAMP)), max(CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS TIMESTAMP) + "
          "INTERVAL 1 DAY END)) - INTERVAL 800 DAY AS mark FROM orders) WHERE o_orderkey % 7 = 0 AND "
          "CAST(o_orderdate AS TIMESTAMP) + INTERVAL 2 DAY < mark")
def stream_fk_orphans(spark, sf_dir):
    """Q10 on streams: orders that no payment can reach any more, payments
    coming one batch late; orders that may yet be paid are not reported."""
    from lakewash.streaming import run_orphan_report

    path = C._write_once(spark, sf_dir, "late-parents", lambda: _write_orders_and_payments(spark, sf_dir))

    def stream(name: str, schema: str) -> DataFrame:
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/{name}")
    out, ckpt = scratch_path(spark, "orphans-out"), scratch_path(spark, "orphans-ckpt")
    run_orphan_report(stream("orders", "order_id bigint, ordered_at timestamp"),
                      stream("payments", "order_id bigint, paid_at timestamp"), "order_id", "ordered_at", "paid_at",
                      out, ckpt, state_partitions=8, late="800 days", parent_within="2 days")
    return spark.read.schema("order_id bigint, ordered_at timestamp").parquet(out)
