"""Benchmark: prints ONE JSON line.

    BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
    BENCH_REPEATS (default 5), BENCH_CATALOG (default 1: also time every
    catalog query once).


* the flat-record job (multi-line CSV -> checks -> cleaning -> noop sink) and
  the nested-record job (line JSON -> staged parse -> three tables -> noop
  sinks), end to end; median of ``BENCH_REPEATS`` after two warm-up runs. Inputs
  are written once before timing.
* the same cleaning projection with native expressions and with row-at-a-time
  Python UDFs, for the timestamp, phone and boolean cleaners;
* Spark jobs started per job run (job groups);
* the flat-record job on ``BENCH_SCALE_UP`` copies of the same records (one
  multi-file CSV written once), for the growth from 1x to that size;
* every catalog query, run once to a noop sink (cold: each includes its own
  planning and code generation), and their total.

``value`` is the sum of the two job medians, in seconds.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from lakewash import functions as X  # noqa: E402
from lakewash.plans import catalog, jobs  # noqa: E402
from lakewash.plans import fixtures as FX  # noqa: E402
from lakewash.session import local_session, scratch_path  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEATS = int(os.environ.get("BENCH_REPEATS", "5"))
RUN_CATALOG = os.environ.get("BENCH_CATALOG", "1") == "1"
SCALE_UP = int(os.environ.get("BENCH_SCALE_UP", "10"))


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def timed(fn, repeats=REPEATS, warmup=2):
    for _ in range(warmup):
        fn()
    secs = []
    for _ in range(repeats):
        t0 = time.perf_counter()
        fn()
        secs.append(time.perf_counter() - t0)
    return statistics.median(secs)


def jobs_in_group(spark, group, fn):
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        fn()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(group))


# Row-at-a-time Python versions of three cleaners, for comparison only.
@F.udf(T.BooleanType())
def py_boolean(v):
    if v is None:
        return None
    s = str(v).lower().replace("truee", "true").replace("fal_se", "false")
    return True if s == "true" else False if s == "false" else None


@F.udf(T.StringType())
def py_phone(v):
    if v is None:
        return None
    s = re.sub(r"\s+", "", v)
    s = re.sub(r"^\+1|^001", "", s)
    s = re.sub(r"x\d*", "", s)
    s = re.sub(r"[^\d]", "", s)
    return s if len(s) == 10 else None


@F.udf(T.TimestampType())
def py_timestamp(v):
    from datetime import datetime
    if v is None or "not a date" in v:
        return None
    for fmt in ("%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d"):
        try:
            return datetime.strptime(v, fmt)
        except ValueError:
            pass
    return None


def main():
    spark = local_session(cores=CPUS, shuffle_partitions=max(8, CPUS * 2), app_name="lakewash-bench")
    out = {"metric": "flat_plus_nested_job_seconds", "unit": "sec", "sf": os.path.basename(SF_DIR),
           "cpus": CPUS, "queries": {}}

    csv_path = catalog.write_flat_csv(spark, SF_DIR)
    json_path = catalog.write_nested_json(spark, SF_DIR)
    flat_rows = FX.table(spark, SF_DIR, "orders").count()
    user_rows = FX.table(spark, SF_DIR, "customer").count()

    def flat():
        jobs.flat_record_job(spark, csv_path, catalog.RUN_TS, sink=noop).close()

    def nested():
        jobs.nested_record_job(spark, json_path, catalog.RUN_TS,
                               sinks={"users": noop, "telephone_numbers": noop, "jobs_history": noop},
                               rejects_sink=noop).close()

    t_flat = timed(flat)
    t_nested = timed(nested)
    # medians of warm runs; the catalog's one cold run of a job has its own key
    out["queries"]["headline_flat_job"] = round(t_flat, 3)
    out["queries"]["headline_nested_job"] = round(t_nested, 3)
    out["value"] = round(t_flat + t_nested, 3)
    out["rows_per_sec"] = {"flat": round(flat_rows / t_flat), "nested": round(user_rows / t_nested)}
    out["spark_jobs_per_run"] = {"flat": jobs_in_group(spark, "bench-flat", flat),
                                 "nested": jobs_in_group(spark, "bench-nested", nested)}

    if SCALE_UP > 1:
        src = FX.flat_source(spark, SF_DIR)
        big = src
        for _ in range(SCALE_UP - 1):
            big = big.union(src)
        big_path = scratch_path(spark, "bench-scale-up")
        (big.repartition(CPUS * 2).write.option("header", "true").option("quote", '"').option("escape", '"')
         .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(big_path))
        t_big = timed(lambda: jobs.flat_record_job(spark, big_path, catalog.RUN_TS, sink=noop).close(), repeats=3)
        out["scale_up"] = {"factor": SCALE_UP, "flat_rows": flat_rows * SCALE_UP, "flat_sec": round(t_big, 3),
                           "rows_per_sec": round(flat_rows * SCALE_UP / t_big),
                           "time_growth": round(t_big / t_flat, 2)}

    # Native expressions against Python UDFs on the same rows.
    orders = FX.table(spark, SF_DIR, "orders")
    dirty = FX.derive(orders, [("ts", FX.dirty_timestamp_text("o_orderkey", "o_orderdate")),
                               ("phone", FX.phone_text("o_orderkey", "o_orderkey", "o_custkey")),
                               ("flag", FX.boolean_text("o_orderkey"))]).repartition(CPUS).cache()
    dirty.count()
    native = dirty.select(X.clean_timestamp("ts").alias("a"), X.clean_phone("phone").alias("b"),
                          X.clean_boolean("flag").alias("c"))
    python = dirty.select(py_timestamp("ts").alias("a"), py_phone("phone").alias("b"), py_boolean("flag").alias("c"))
    t_native = timed(lambda: noop(native))
    t_python = timed(lambda: noop(python))
    dirty.unpersist()
    out["native_vs_python_udf"] = {"native_sec": round(t_native, 3), "python_udf_sec": round(t_python, 3),
                                   "speedup": round(t_python / t_native, 2) if t_native else None}

    if RUN_CATALOG:
        total = 0.0
        for name, build in catalog.queries().items():
            t0 = time.perf_counter()
            try:
                noop(build(spark, SF_DIR))
                out["queries"][name] = round(time.perf_counter() - t0, 3)
                total += out["queries"][name]
            except Exception as err:  # keep measuring the rest
                out["queries"][name] = None
                out.setdefault("errors", {})[name] = str(err)[:200]
        out["catalog_total_sec"] = round(total, 3)
        out["catalog_queries"] = len(catalog.queries())
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
