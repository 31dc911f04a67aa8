"""Run the jobs from the command line (``spark-submit`` or ``python -m``).

    python -m lakewash.plans.cli flat --input s3a://b/landing/ --sink parquet --output s3a://b/clean/records
    python -m lakewash.plans.cli flat --input in.csv --sink jdbc --jdbc-url jdbc:postgresql://db/etl \\
        --table records --if-exists replace --jdbc-user etl --jdbc-password-env ETL_PASSWORD
    python -m lakewash.plans.cli nested --input s3a://b/users/ --sink parquet --output s3a://b/clean/

The session comes from ``SparkSession.builder.getOrCreate()``, so the
cluster's own settings (``spark.checkpoint.dir`` among them) apply. The run's
metrics are printed as one JSON line.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
from datetime import datetime, timezone
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewash.operators.mapping import CONFORM_ERRORS
from lakewash.operators.quality import split_rejects
from lakewash.plans import jobs, targets
from lakewash.sources import sinks
from lakewash.sources.versions import StagedVersion, VersionedTable

SINKS = ("parquet", "csv", "delta", "jdbc", "staged", "versioned", "table", "noop")


def _sink(args: argparse.Namespace, table: str | None = None) -> jobs.Sink:
    """A writer for one output; ``table`` names it inside a multi-table run."""
    where = args.output.rstrip("/") + (f"/{table}" if table else "") if args.output else None
    if args.sink in ("parquet", "csv", "delta", "staged", "versioned") and not where:
        raise SystemExit(f"--output is needed for the {args.sink} sink")
    if args.sink == "parquet":
        if args.mode == "replace-partitions":  # re-running a run replaces that run's rows
            return lambda df: sinks.write_parquet(df, where, partition_by=["inserted_date"],
                                                  replace_partitions=True)
        return lambda df: sinks.write_parquet(df, where, args.mode)
    if args.sink == "csv":
        return lambda df: sinks.write_csv(df, where, args.mode)
    if args.sink == "delta":
        return lambda df: sinks.write_delta(df, where, args.mode)
    if args.sink == "staged":
        return sinks.StagedFolder(where)
    if args.sink == "versioned":  # a new version of the table, whole or not at all, on any store
        return StagedVersion(VersionedTable(SparkSession.getActiveSession(), where))
    if args.sink == "noop":
        return lambda df: df.write.format("noop").mode("overwrite").save()
    if args.sink == "table":
        name = table or args.table
        if not name:
            raise SystemExit("--table is needed for the table sink")
        key = ["user_id"] if args.job == "nested" else ["id"]
        buckets = args.buckets or None
        return lambda df: sinks.write_table(df, name, "overwrite" if args.mode == "overwrite" else "append",
                                            bucket_by=key if buckets else (), num_buckets=buckets)
    if not args.jdbc_url:
        raise SystemExit("--jdbc-url is needed for the jdbc sink")
    props = {k: v for k, v in {"user": args.jdbc_user, "driver": args.jdbc_driver,
                               "password": os.environ.get(args.jdbc_password_env or "", None)}.items() if v}
    name = table or args.table
    if not name:
        raise SystemExit("--table is needed for the jdbc sink")
    return lambda df: sinks.load_jdbc(df, args.jdbc_url, name, args.if_exists, props, args.jdbc_partitions)


SHAPES = {"flat": targets.shape_flat_records, "users": targets.shape_users,
          "telephone_numbers": targets.shape_telephone_numbers, "jobs_history": targets.shape_jobs_history}


def _conformed(shape: Callable[[DataFrame], DataFrame], good: jobs.Sink, misfits: jobs.Sink) -> jobs.Sink:
    """A sink that loads the rows in the target table's shape and sends those
    that do not fit it, with the columns at fault, to a second sink."""
    def load(df: DataFrame) -> None:
        fit, unfit = split_rejects(shape(df), CONFORM_ERRORS)
        jobs.load(fit, good, "fit")
        jobs.load(unfit.withColumn(CONFORM_ERRORS, F.array_join(CONFORM_ERRORS, ",")), misfits, "misfits")
    return load


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lakewash", description=__doc__.split("\n\n")[0])
    sub = p.add_subparsers(dest="job", required=True)
    for name in ("flat", "nested"):
        j = sub.add_parser(name)
        j.add_argument("--input", required=True, help="file, folder or glob, any Hadoop URI")
        j.add_argument("--run-ts", default=None, help="load time stamped on every row (default: now, UTC)")
        j.add_argument("--sink", choices=SINKS, default="parquet")
        j.add_argument("--output", help="target path (file sinks); a folder per table for the nested job")
        j.add_argument("--mode", default="append",
                       help="save mode of file sinks (append, overwrite, ...); replace-partitions (parquet) "
                            "partitions by load time and replaces only this run's partition")
        j.add_argument("--uuid", choices=("stable", "random"), default="stable")
        j.add_argument("--jdbc-url")
        j.add_argument("--table", help="target table (flat job, jdbc sink)")
        j.add_argument("--if-exists", choices=("fail", "replace", "append"), default="replace")
        j.add_argument("--jdbc-user")
        j.add_argument("--jdbc-password-env", help="name of the environment variable holding the password")
        j.add_argument("--jdbc-driver")
        j.add_argument("--jdbc-partitions", type=int, default=None, help="parallel connections at most")
        j.add_argument("--incremental", action="store_true",
                       help="process only files not seen before (Structured Streaming, available-now); "
                            "writes parquet under --output, one batch_id=<n> folder per batch")
        j.add_argument("--checkpoint", help="streaming checkpoint folder for --incremental")
        j.add_argument("--max-files-per-trigger", type=int, default=None,
                       help="--incremental: files to a batch at most (default: all that have arrived)")
        j.add_argument("--conform", action="store_true",
                       help="load the target tables' columns and types; rows that do not fit go to <name>_misfits")
        j.add_argument("--buckets", type=int, default=0,
                       help="table sink: bucket on the key (user_id for the nested tables) so that "
                            "foreign-key checks between them need no shuffle")
        if name == "flat":
            j.add_argument("--format", default="csv", choices=("csv", "json", "parquet"))
            j.add_argument("--delimiter", default=",")
            j.add_argument("--quote", default='"')
            j.add_argument("--escape", default='"')
            j.add_argument("--multiline", default="true", choices=("true", "false"))
            j.add_argument("--unique-check", choices=("exact", "approx", "off"), default="exact")
            j.add_argument("--allow-empty", action="store_true")
            j.add_argument("--rejects-table", help="folder under --output, or table, for records that do not fit "
                                                   "the header (default: they are counted only)")
        else:
            j.add_argument("--format", default="json", choices=("json", "parquet"))
            j.add_argument("--rejects-table", default="rejected_lines")
            j.add_argument("--users-table", default="user_tbl")
            j.add_argument("--phones-table", default="telephone_numbers")
            j.add_argument("--jobs-table", default="jobs_history")
    return p


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"lakewash-{args.job}").getOrCreate()
    run_ts = args.run_ts or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    if args.incremental:
        return _incremental(spark, args, run_ts)
    if args.job == "flat":
        options = {"delimiter": args.delimiter, "quote": args.quote, "escape": args.escape,
                   "multiLine": args.multiline}
        sink = _sink(args)
        if args.conform:
            extra = f"{args.table}_misfits" if args.sink in ("jdbc", "table") else "misfits"
            sink = _conformed(SHAPES["flat"], _sink(args, None if args.sink in ("jdbc", "table") else "records"),
                              _sink(args, extra))
        res = jobs.flat_record_job(spark, args.input, run_ts, sink=sink, options=options,
                                   allow_empty=args.allow_empty, uuid_mode=args.uuid,
                                   unique_check=args.unique_check, file_format=args.format,
                                   rejects_sink=_sink(args, args.rejects_table) if args.rejects_table else None)
        res.close()
    else:
        tables = {"users": args.users_table, "telephone_numbers": args.phones_table,
                  "jobs_history": args.jobs_table}
        names = {k: v if args.sink in ("jdbc", "table") else k for k, v in tables.items()}
        load = {k: _sink(args, name) for k, name in names.items()}
        if args.conform:
            load = {k: _conformed(SHAPES[k], sink, _sink(args, f"{names[k]}_misfits")) for k, sink in load.items()}
        res = jobs.nested_record_job(
            spark, args.input, run_ts, uuid_mode=args.uuid, file_format=args.format, sinks=load,
            rejects_sink=_sink(args, args.rejects_table if args.sink in ("jdbc", "table") else "rejects"))
        res.close()
    metrics = {"job": args.job, **res.metrics}
    print(json.dumps(metrics, default=str))
    return metrics


def _incremental(spark: SparkSession, args: argparse.Namespace, run_ts: str) -> dict:
    from lakewash.streaming import run_flat_record_load, run_nested_record_load

    if not (args.output and args.checkpoint):
        raise SystemExit("--incremental needs --output and --checkpoint")
    if args.job == "flat":
        options = {"delimiter": args.delimiter, "quote": args.quote, "escape": args.escape,
                   "multiLine": args.multiline}
        query = run_flat_record_load(spark, args.input, args.output, args.checkpoint, run_ts, options=options,
                                     uuid_mode=args.uuid, max_files_per_trigger=args.max_files_per_trigger)
    else:
        query = run_nested_record_load(spark, args.input, args.output, args.checkpoint, run_ts, uuid_mode=args.uuid,
                                       max_files_per_trigger=args.max_files_per_trigger)
    progress = [p for p in query.recentProgress if p.get("numInputRows", 0) > 0]
    metrics = {"job": args.job, "incremental": True, "batches": len(progress),
               "input_rows": sum(p["numInputRows"] for p in progress)}
    print(json.dumps(metrics))
    return metrics


if __name__ == "__main__":
    main(sys.argv[1:])
