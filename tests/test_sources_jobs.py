"""Readers, sinks and whole jobs, on files written into a fresh scratch
folder under the session's checkpoint root."""

import logging
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lakewash.operators import quality
from lakewash.plans import catalog, jobs
from lakewash.session import scratch_path
from lakewash.sources import readers, sinks

CSV_TEXT = ('ID,Name,Address,Color,Created At (dd/mm/yyyy),Last Login,Is Claimed?,Paid  Amount ($)\n'
            '1,  Ann  ,"12 Main St\nSuite 4 ", dark  BLUE ,"March 22nd, 2024",1700000000,truee,2.345\n'
            '2,Bob,"He said ""hi""",red,not a date,never,FALSE,"1,000.5"\n')


def _write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as fh:
        fh.write(text)
    return path


def test_csv_dialect_multiline_and_quotes(spark):
    path = _write(scratch_path(spark, "t-csv"), "in.csv", CSV_TEXT)
    df = readers.read_csv(spark, path)
    rows = {r["ID"]: r for r in df.collect()}
    assert rows["1"]["Address"] == "12 Main St\nSuite 4 "
    assert rows["1"]["Name"] == "  Ann  "
    assert rows["2"]["Address"] == 'He said "hi"'
    assert all(f.dataType.simpleString() == "string" for f in df.schema.fields)


def test_read_data_dispatch(spark):
    with pytest.raises(ValueError, match="not a supported"):
        readers.read_data(spark, "/nowhere", "xml")
    inferred = _write(scratch_path(spark, "t-json-infer"), "a.json", '{"a": 1, "b": "x"}\n')
    assert readers.read_data(spark, inferred, "json").columns == ["a", "b"]
    assert readers.read_data(spark, f"{SF_SMALL}/region.parquet", "parquet").count() == 5


def test_path_exists(spark):
    assert readers.path_exists(spark, f"{SF_SMALL}/orders.parquet")
    assert readers.path_exists(spark, f"file://{SF_SMALL}/*.parquet")
    assert not readers.path_exists(spark, f"{SF_SMALL}/missing.parquet")
    with pytest.raises(FileNotFoundError):
        readers.require_path(spark, f"{SF_SMALL}/missing.parquet")


def test_json_rejects_staged(spark):
    good = '{"user_id":"u1","logged_at":1700000000,"user_details":{"telephone_numbers":["555.123.4567"]}}'
    lines = "\n".join([good, '{"user_id":"u2","logged_at":"n/a"}', "not json at all"]) + "\n"
    path = _write(scratch_path(spark, "t-json"), "in.json", lines)
    res = jobs.nested_record_job(spark, path, catalog.RUN_TS)
    assert [r.user_id for r in res.frames["users"].collect()] == ["u1"]
    assert [r.telephone_numbers for r in res.frames["telephone_numbers"].collect()] == ["5551234567"]
    rejects = res.frames["rejects"].collect()
    assert len(rejects) == 2 and {r.user_id for r in rejects} == {"u2", None}


def test_parquet_append_csv_overwrite_and_counts(spark):
    df = spark.range(10).select(F.col("id"), (F.col("id") % 3).alias("g"))
    p = scratch_path(spark, "t-parquet")
    assert sinks.write_data(df, p, "parquet") == 10
    assert sinks.write_data(df, p, "parquet") == 10
    assert spark.read.parquet(p).count() == 20
    c = scratch_path(spark, "t-csv-out")
    sinks.write_data(df, c, "orc-ish")
    sinks.write_data(df, c, "orc-ish")
    assert spark.read.option("header", "true").csv(c).count() == 10
    part = scratch_path(spark, "t-partitioned")
    assert sinks.write_parquet(df, part, "overwrite", partition_by=["g"]) == 10
    assert spark.read.parquet(part).where("g = 1").count() == 3


def test_delta_unavailable_is_clear(spark):
    with pytest.raises(sinks.SinkUnavailable, match="delta"):
        sinks.write_data(spark.range(1), scratch_path(spark, "t-delta"), "delta")


def test_jdbc_mode_mapping():
    assert sinks.jdbc_mode("fail") == "errorifexists"
    assert sinks.jdbc_mode("replace") == "overwrite"
    assert sinks.jdbc_mode("append") == "append"
    with pytest.raises(ValueError):
        sinks.jdbc_mode("upsert")
    opts = sinks.jdbc_writer_options({"user": "u"}, 16, 5000, True)
    assert opts == {"batchsize": "5000", "truncate": "true", "numPartitions": "16", "user": "u"}


def test_staged_refresh_all_or_nothing(spark):
    target = scratch_path(spark, "t-refresh")
    old = spark.range(5).select("id")
    assert sinks.staged_refresh(old, target)["dest_rows"] == 5
    failing = spark.range(7).select(F.when(F.col("id") == 6, F.raise_error(F.lit("boom")))
                                    .otherwise(F.col("id")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="boom"):
        sinks.staged_refresh(failing, target)
    assert spark.read.parquet(target).count() == 5
    new = spark.range(3).select("id")
    assert sinks.staged_refresh(new, target)["dest_rows"] == 3
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == [0, 1, 2]
    assert not [d for d in os.listdir(os.path.dirname(target)) if d.startswith(os.path.basename(target) + ".staging")]


def test_empty_as_null(spark):
    df = spark.createDataFrame([("", " ", 1)], "a string, b string, n int")
    assert tuple(sinks.empty_as_null(df).first()) == (None, " ", 1)


def test_flat_job_metrics_and_checks(spark, caplog):
    path = _write(scratch_path(spark, "t-flat"), "in.csv", CSV_TEXT)
    out = scratch_path(spark, "t-flat-out")
    res = jobs.flat_record_job(spark, path, catalog.RUN_TS, sink=lambda d: d.write.parquet(out))
    assert res.metrics["src_count"] == res.metrics["dest_count"] == 2
    back = {r.id: r for r in spark.read.parquet(out).collect()}
    assert back["1"].name == "Ann" and back["1"].address == "12 Main St Suite 4"
    assert back["1"].color == "Dark  Blue" and back["1"].is_claimed is True
    assert str(back["1"].paid_amount) == "2.35" and back["2"].paid_amount is None
    assert back["2"].created_at is None and back["2"].is_claimed is False
    dup = _write(scratch_path(spark, "t-dup"), "in.csv", CSV_TEXT + CSV_TEXT.split("\n", 1)[1])
    with caplog.at_level(logging.WARNING):
        res_dup = jobs.flat_record_job(spark, dup, catalog.RUN_TS)
    assert res_dup.metrics["unique_key"] is False
    nulls = _write(scratch_path(spark, "t-null"), "in.csv", "ID,Name\n,x\n2,y\n")
    with pytest.raises(AssertionError, match="null"):
        jobs.flat_record_job(spark, nulls, catalog.RUN_TS)
    empty = _write(scratch_path(spark, "t-empty"), "in.csv", "ID,Name\n")
    with pytest.raises(AssertionError, match="empty"):
        jobs.flat_record_job(spark, empty, catalog.RUN_TS)
    res = jobs.flat_record_job(spark, empty, catalog.RUN_TS, allow_empty=True, sink=lambda d: 1 / 0)
    assert res.metrics["src_count"] == res.metrics["dest_count"] == 0
    rows = res_dup.frames["records"].collect()
    assert len(rows) == len({r.uuid for r in rows}) == 4
    with pytest.raises(FileNotFoundError):
        jobs.flat_record_job(spark, scratch_path(spark, "t-missing"), catalog.RUN_TS)


def test_nested_job_with_sinks(spark):
    path = catalog.write_nested_json(spark, SF_SMALL)
    counted = {}
    res = jobs.nested_record_job(spark, path, catalog.RUN_TS,
                                 sinks={n: (lambda d: d.write.format("noop").mode("overwrite").save())
                                        for n in ["users", "telephone_numbers", "jobs_history"]},
                                 rejects_sink=lambda d: d.write.format("noop").mode("overwrite").save())
    counted = res.metrics
    assert counted["users_count"] == 150
    assert counted["telephone_numbers_count"] > 0 and counted["jobs_history_count"] > 0
    assert counted["rejects_count"] >= 0


def test_no_python_udfs_in_job_plans(spark):
    for name in ["job_flat_records", "job_nested_users", "job_nested_phones", "job_nested_jobs"]:
        plan = catalog.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_scan_prunes_and_pushes(spark):
    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet").where(F.col("o_custkey") == 5).select("o_orderkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_custkey), EqualTo(o_custkey,5)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def test_stream_processes_only_new_files(spark):
    from lakewash.streaming import run_flat_record_load
    src = _write(scratch_path(spark, "t-stream-in"), "a.csv", CSV_TEXT)
    out, ckpt = scratch_path(spark, "t-stream-out"), scratch_path(spark, "t-stream-ckpt")
    run_flat_record_load(spark, src, out, ckpt, catalog.RUN_TS)
    assert spark.read.parquet(out).count() == 2
    run_flat_record_load(spark, src, out, ckpt, catalog.RUN_TS)
    assert spark.read.parquet(out).count() == 2
    _write(src, "b.csv", CSV_TEXT.replace("1,  Ann", "3,  Ann").replace("2,Bob", "4,Bob"))
    run_flat_record_load(spark, src, out, ckpt, catalog.RUN_TS)
    back = spark.read.parquet(out)
    assert sorted(r.id for r in back.collect()) == ["1", "2", "3", "4"]
    assert back.select("batch_id").distinct().count() == 2


def test_object_store_style_uri_and_oversized_files(spark, caplog):
    path = _write(scratch_path(spark, "t-uri"), "in.csv", CSV_TEXT)
    assert readers.read_csv(spark, "file://" + path).count() == 2
    big = readers.oversized_files(spark, path, max_bytes=10).collect()
    assert len(big) == 1 and big[0].length == len(CSV_TEXT.encode())
    assert readers.oversized_files(spark, path).count() == 0
    with caplog.at_level(logging.WARNING):
        jobs.flat_record_job(spark, path, catalog.RUN_TS, warn_file_bytes=10)
    assert any("one task" in r.getMessage() for r in caplog.records)


def test_no_python_evaluation_in_any_query_plan(spark):
    """No query of the library proper evaluates Python, and neither does any
    plan that it runs on the way (before a write cuts the lineage)."""
    ran = []
    write = type(spark.range(0).write).parquet

    def watched(self, *args, **kwargs):
        ran.append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, *args, **kwargs)

    type(spark.range(0).write).parquet = watched
    try:
        for name, build in catalog.queries().items():
            ran.append(build(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString())
            for plan in ran:
                assert not any(x in plan for x in ("EvalPython", "MapInPandas", "MapInArrow", "PythonUDF")), name
            ran.clear()
    finally:
        type(spark.range(0).write).parquet = write


def test_library_never_collects_datasets():
    """Driver-side reads are limited to one-row summaries and bounded lists."""
    import re
    root = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "lakewash")
    allowed = {
        ("quality.py", "not_null_violations(df, cols).collect()"),   # one row per listed column
        ("quality.py", "df.agg(*aggs).first()"),                      # the one-row profile
        ("fingerprint.py", "df.agg(*fingerprint_columns(df, columns, as_text)).first()"),  # one row
        ("temporal.py", "F.percentile_approx(\"t\", at, 1000).alias(\"cuts\")).first()"),  # one row of 63 cuts
        ("versions.py", "stored.groupBy(PART).count().collect()"),    # one row for each part of a table
        ("versions.py", "F.max(null_key.cast(\"int\")).alias(\"nulls\")).collect()"),  # the same
    }
    found = set()
    for dirpath, _, files in os.walk(root):
        if os.path.basename(dirpath) == "llm":  # has bounds and tests of its own
            continue
        for f in (f for f in files if f.endswith(".py")):
            for line in open(os.path.join(dirpath, f)):
                if re.search(r"\.(collect|toPandas|first|take)\(", line):
                    found.add((f, line.strip()))
    assert len(found) == len(allowed)
    for f, line in found:
        assert any(f == af and snippet in line for af, snippet in allowed), (f, line)


def test_flat_job_loads_through_staged_refresh(spark):
    """The flat job's output replaces a table all-or-nothing."""
    path = _write(scratch_path(spark, "t-b3"), "in.csv", CSV_TEXT)
    target = scratch_path(spark, "t-b3-target")
    sinks.staged_refresh(spark.range(7).select(F.col("id").cast("string").alias("id")), target)
    res = jobs.flat_record_job(spark, path, catalog.RUN_TS, sink=lambda d: sinks.staged_refresh(d, target))
    assert res.metrics["dest_count"] == 2
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == ["1", "2"]


def test_command_line_runs(spark, capsys):
    from lakewash.plans import cli
    src = _write(scratch_path(spark, "t-cli"), "in.csv", CSV_TEXT)
    out = scratch_path(spark, "t-cli-out")
    metrics = cli.main(["flat", "--input", src, "--sink", "parquet", "--output", out,
                        "--run-ts", catalog.RUN_TS], spark=spark)
    assert metrics["dest_count"] == 2 and spark.read.parquet(out).count() == 2
    assert '"dest_count": 2' in capsys.readouterr().out
    nested_out = scratch_path(spark, "t-cli-nested")
    metrics = cli.main(["nested", "--input", catalog.write_nested_json(spark, SF_SMALL), "--sink", "parquet",
                        "--output", nested_out, "--run-ts", catalog.RUN_TS], spark=spark)
    assert metrics["users_count"] == spark.read.parquet(nested_out + "/users").count() == 150
    with pytest.raises(SystemExit):
        cli.main(["flat", "--input", src, "--sink", "jdbc"], spark=spark)
    cli.main(["nested", "--input", catalog.write_nested_json(spark, SF_SMALL), "--sink", "table", "--buckets", "4",
              "--users-table", "cli_users", "--phones-table", "cli_phones", "--jobs-table", "cli_jobs",
              "--run-ts", catalog.RUN_TS], spark=spark)
    assert spark.table("cli_users").count() == 150
    info = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED cli_phones").collect()}
    assert info.get("Num Buckets") == "4" and "user_id" in info.get("Bucket Columns", "")


def test_pretty_printed_json_needs_multiline(spark):
    text = ('[\n  {\n    "user_id": "u1",\n    "logged_at": 1\n  },\n'
            '  {\n    "user_id": "u2",\n    "logged_at": 2\n  }\n]\n')
    path = _write(scratch_path(spark, "t-pretty"), "in.json", text)
    schema = jobs.NESTED_SCHEMA
    whole = readers.read_json(spark, path, schema, multi_line=True).select("user_id").collect()
    assert sorted(r.user_id for r in whole) == ["u1", "u2"]
    by_line = readers.read_json(spark, path, schema).cache()
    assert by_line.where(F.col("user_id").isNotNull()).count() == 0
    assert by_line.where(F.col(readers.CORRUPT_RECORD).isNotNull()).count() > 0


def test_bucketed_tables_join_without_shuffle(spark):
    """Parent and child saved bucketed on the key: the foreign-key check
    plans with no exchange at all."""
    res = jobs.nested_record_job(spark, catalog.write_nested_json(spark, SF_SMALL), catalog.RUN_TS)
    kept_users = res.frames["users"].where(F.col("is_active").isNull() | F.col("is_active"))
    sinks.write_table(kept_users, "lw_users_b", bucket_by=["user_id"], num_buckets=8)
    sinks.write_table(res.frames["telephone_numbers"], "lw_phones_b", bucket_by=["user_id"], num_buckets=8,
                      sort_by=["user_id"])
    users, phones = spark.table("lw_users_b"), spark.table("lw_phones_b")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables too big to broadcast
    try:
        orphans = quality.foreign_key_orphans(phones, users, ["user_id"])
        plan = orphans._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
        expected = phones.join(users.select("user_id"), "user_id", "left_anti").count()
        assert orphans.count() == expected > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    with pytest.raises(ValueError):
        sinks.write_table(users, "lw_bad", bucket_by=["user_id"])


def test_nested_job_stops_before_loading(spark):
    no_phones = '{"user_id":"u1","logged_at":1,"user_details":{"telephone_numbers":[]}}\n'
    path = _write(scratch_path(spark, "t-nophones"), "in.json", no_phones)
    wrote = []
    with pytest.raises(AssertionError, match="telephone"):
        jobs.nested_record_job(spark, path, catalog.RUN_TS, sinks={
            "users": lambda d: (wrote.append(1), d.write.format("noop").mode("overwrite").save())})
    assert wrote == []
    res = jobs.nested_record_job(spark, path, catalog.RUN_TS, require_phones=False)
    assert res.metrics == {"records": 1, "rejected_lines": 0}
    bad = _write(scratch_path(spark, "t-allbad"), "in.json", "not json\n")
    with pytest.raises(AssertionError, match="empty"):
        jobs.nested_record_job(spark, bad, catalog.RUN_TS)


def test_max_records_per_file(spark):
    path = scratch_path(spark, "t-maxrec")
    assert sinks.write_data(spark.range(100).coalesce(1), path, "parquet", max_records_per_file=30) == 100
    files = [f for f in os.listdir(path) if f.endswith(".parquet")]
    assert len(files) == 4 and spark.read.parquet(path).count() == 100


def test_rerun_replaces_its_own_partition(spark):
    from lakewash.plans import cli
    src = _write(scratch_path(spark, "t-rerun"), "in.csv", CSV_TEXT)
    out = scratch_path(spark, "t-rerun-out")
    run = ["flat", "--input", src, "--sink", "parquet", "--output", out, "--mode", "replace-partitions"]
    cli.main(run + ["--run-ts", "2024-06-01 00:00:00"], spark=spark)
    cli.main(run + ["--run-ts", "2024-06-02 00:00:00"], spark=spark)
    cli.main(run + ["--run-ts", "2024-06-02 00:00:00"], spark=spark)  # a re-run of the second load
    back = spark.read.parquet(out)
    assert back.count() == 4 and back.select("inserted_date").distinct().count() == 2
    with pytest.raises(ValueError):
        sinks.write_parquet(spark.range(1), out, replace_partitions=True)


def test_nested_stream_processes_only_new_files(spark):
    from lakewash.streaming import run_nested_record_load
    good = '{"user_id":"u1","logged_at":1,"user_details":{"telephone_numbers":["555.123.4567", "x"]}}\n'
    src = _write(scratch_path(spark, "t-nstream-in"), "a.json", good + '{"user_id":"u9","logged_at":"n/a"}\n')
    out, ckpt = scratch_path(spark, "t-nstream-out"), scratch_path(spark, "t-nstream-ckpt")
    run_nested_record_load(spark, src, out, ckpt, catalog.RUN_TS)
    run_nested_record_load(spark, src, out, ckpt, catalog.RUN_TS)
    assert [r.user_id for r in spark.read.parquet(out + "/users").collect()] == ["u1"]
    assert spark.read.parquet(out + "/telephone_numbers").count() == 2
    assert [r.user_id for r in spark.read.parquet(out + "/rejects").collect()] == ["u9"]
    _write(src, "b.json", good.replace("u1", "u2"))
    run_nested_record_load(spark, src, out, ckpt, catalog.RUN_TS)
    assert sorted(r.user_id for r in spark.read.parquet(out + "/users").collect()) == ["u1", "u2"]


def test_command_line_incremental(spark):
    from lakewash.plans import cli
    src = _write(scratch_path(spark, "t-cli-inc"), "a.csv", CSV_TEXT)
    out, ckpt = scratch_path(spark, "t-cli-inc-out"), scratch_path(spark, "t-cli-inc-ckpt")
    args = ["flat", "--input", src, "--incremental", "--output", out, "--checkpoint", ckpt, "--run-ts", catalog.RUN_TS]
    assert cli.main(args, spark=spark)["input_rows"] == 2
    assert cli.main(args, spark=spark)["input_rows"] == 0
    assert spark.read.parquet(out).count() == 2
    with pytest.raises(SystemExit):
        cli.main(["flat", "--input", src, "--incremental"], spark=spark)


def test_windows_line_endings(spark):
    path = scratch_path(spark, "t-crlf")
    os.makedirs(path)
    with open(os.path.join(path, "in.csv"), "w", newline="") as fh:
        fh.write(CSV_TEXT.replace("\n", "\r\n"))
    rows = {r.id: r for r in jobs.flat_record_job(spark, path, catalog.RUN_TS).frames["records"].collect()}
    assert rows["1"].address == "12 Main St Suite 4" and str(rows["1"].paid_amount) == "2.35"
    assert rows["2"].paid_amount is None and rows["2"].is_claimed is False


def test_byte_order_mark_in_header(spark):
    path = scratch_path(spark, "t-bom")
    os.makedirs(path)
    with open(os.path.join(path, "in.csv"), "w", encoding="utf-8-sig") as fh:
        fh.write(CSV_TEXT)
    res = jobs.flat_record_job(spark, path, catalog.RUN_TS)
    assert sorted(r.id for r in res.frames["records"].collect()) == ["1", "2"]


def test_jdbc_partitioned_read_needs_bounds(spark):
    with pytest.raises(ValueError, match="lower_bound"):
        readers.read_jdbc(spark, "jdbc:none://nowhere", "t", partition_column="id", num_partitions=4)


def test_command_line_parquet_input(spark):
    from lakewash.plans import cli
    src = catalog.write_flat_as(spark, SF_SMALL, "parquet")
    metrics = cli.main(["flat", "--input", src, "--format", "parquet", "--sink", "noop",
                        "--run-ts", catalog.RUN_TS], spark=spark)
    assert metrics["src_count"] == metrics["dest_count"] == 1500


def test_failed_swap_keeps_the_old_rows(spark, monkeypatch):
    target = scratch_path(spark, "t-swap")
    sinks.staged_refresh(spark.range(5), target)
    monkeypatch.setattr(sinks, "_rename", lambda *a: False)
    with pytest.raises(OSError):
        sinks.staged_refresh(spark.range(9), target)
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == [0, 1, 2, 3, 4]


def test_no_raw_secret_at_rest(spark):
    good = ('{"user_id":"u1","logged_at":1,"user_details":{"name":"n","password":"pw-raw-1","national_id":"999-11-2222",'
            '"telephone_numbers":["555.123.4567"]}}')
    lines = [good, good.replace('"logged_at":1', '"logged_at":"n/a"').replace("pw-raw-1", 'pw\\"raw'),
             '{"user_id":"u3","user_details":{"password":"pw-raw-open']
    path = _write(scratch_path(spark, "t-secrets"), "in.json", "\n".join(lines) + "\n")
    out = scratch_path(spark, "t-secrets-out")
    res = jobs.nested_record_job(spark, path, catalog.RUN_TS, sinks={
        n: (lambda d, n=n: d.write.parquet(f"{out}/{n}")) for n in jobs.NESTED_TABLES},
        rejects_sink=lambda d: d.write.parquet(f"{out}/rejects"))
    staging = res.staging[1]
    for folder in (staging, *(f"{out}/{n}" for n in (*jobs.NESTED_TABLES, "rejects"))):
        text = "".join(str(r) for r in spark.read.parquet(folder).collect())
        assert "pw-raw" not in text and "raw" not in text and "999-11-2222" not in text, folder
    res.close()
    assert not os.path.exists(staging)


def test_header_mismatch_is_an_error(spark):
    path = _write(scratch_path(spark, "t-headers"), "a.csv", "id,name,address\n1,n,a\n")
    _write(path, "b.csv", "id,address,name\n2,addr,Bob\n")
    with pytest.raises(Exception, match="header"):
        readers.read_csv(spark, path).collect()
    rows = {r.id: (r.name, r.address) for r in readers.read_csv_by_name(spark, path).collect()}
    assert rows == {"1": ("n", "a"), "2": ("Bob", "addr")}


def test_stream_takes_a_bounded_number_of_files(spark):
    from lakewash.streaming import run_flat_record_load
    src = scratch_path(spark, "t-three")
    for i in range(3):
        _write(src, f"{i}.csv", CSV_TEXT)
    out, ckpt = scratch_path(spark, "t-three-out"), scratch_path(spark, "t-three-ckpt")
    run_flat_record_load(spark, src, out, ckpt, max_files_per_trigger=1)
    back = spark.read.parquet(out)
    assert back.select("batch_id").distinct().count() == 3
    # the same two rows arrive in each file: they keep their ids over the batches
    assert back.count() == 6 and back.select("uuid").distinct().count() == 2


def test_row_ids_do_not_depend_on_the_layout(spark):
    df = catalog.duplicated_flat_records(spark, SF_SMALL)
    from lakewash.operators.ids import with_occurrence
    got = [sorted((r.id, r.name or "", r._occurrence) for r in with_occurrence(df.repartition(n), "id").collect())
           for n in (2, 5)]
    assert got[0] == got[1] and len(set((i, o) for i, _, o in got[0])) == len(got[0])


def test_command_line_conformed_target(spark):
    from lakewash.plans import cli
    src = _write(scratch_path(spark, "t-conform"), "in.csv", CSV_TEXT + "x9,Eve,a,b,,,,\n")
    out = scratch_path(spark, "t-conform-out")
    cli.main(["flat", "--input", src, "--output", out, "--run-ts", catalog.RUN_TS, "--conform"], spark=spark)
    assert sorted(r.id for r in spark.read.parquet(out + "/records").collect()) == [1, 2]
    assert [r._conform_errors for r in spark.read.parquet(out + "/misfits").collect()] == ["id"]
