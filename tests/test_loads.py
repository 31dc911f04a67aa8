"""Loads that follow one another: versions, merges, content checks, malformed
records, keys over batches; and joins along time against brute force."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lakewash.operators import ids, quality, sketches, temporal
from lakewash.operators.fingerprint import ContentMismatch, fingerprint, reconcile
from lakewash.plans import catalog, jobs
from lakewash.session import scratch_path
from lakewash.sources import records, sinks
from lakewash.sources.versions import CommitConflict, StagedVersion, VersionedTable
from lakewash.streaming import KeyTable, run_flat_record_load


def _write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", newline="") as fh:
        fh.write(text)
    return path


# ------------------------------------------------------------------ versions

def people(spark, ids_, name="n"):
    return spark.createDataFrame([(i, f"{name}{i}", None if i % 2 else i) for i in ids_], "id long, name string, score long")


def test_versions_and_readers_of_old_ones(spark):
    table = VersionedTable(spark, scratch_path(spark, "t-versions"))
    with pytest.raises(FileNotFoundError):
        table.read()
    table.refresh(people(spark, range(10)))
    before = table.read()
    table.append(people(spark, range(10, 13)))
    table.refresh(people(spark, range(3), "x"))
    assert table.versions() == [1, 2, 3] and [table.version(n).row_count for n in (1, 2, 3)] == [10, 13, 3]
    assert before.count() == 10  # a frame reads the version it was made of
    assert sorted(r.name for r in table.read().collect()) == ["x0", "x1", "x2"]
    assert table.read(2).count() == 13
    with pytest.raises(LookupError):
        table.read(7)
    table.refresh(people(spark, []))
    assert table.read().count() == 0 and table.read().columns == ["id", "name", "score"]
    dead = table.vacuum(keep=2)
    assert table.versions() == [3, 4] and len(dead) == 3 and table.read(3).count() == 3


def test_broken_commits_show_nothing(spark, monkeypatch):
    table = VersionedTable(spark, scratch_path(spark, "t-broken"))
    table.refresh(people(spark, range(5)))
    monkeypatch.setattr(VersionedTable, "_publish", lambda self, version: (_ for _ in ()).throw(OSError("store is gone")))
    with pytest.raises(OSError):
        table.refresh(people(spark, range(50)))
    monkeypatch.undo()
    assert table.read().count() == 5 and table.versions() == [1]
    failing = people(spark, range(5)).withColumn("name", F.expr("raise_error('task lost')").cast("string"))
    with pytest.raises(Exception, match="task lost"):
        table.refresh(failing)
    assert table.read().count() == 5
    table.refresh(people(spark, range(6)))
    assert table.read().count() == 6 and len(table.vacuum()) == 2  # the first version's rows and the orphans


def test_two_writers_one_commit(spark):
    table = VersionedTable(spark, scratch_path(spark, "t-two"))
    table.refresh(people(spark, range(4)))
    one, two = StagedVersion(table), StagedVersion(table)
    one.stage(people(spark, range(5)))
    two.stage(people(spark, range(9)))
    two.publish()
    with pytest.raises(CommitConflict):
        one.publish()
    assert table.read().count() == 9 and table.versions() == [1, 2]


def test_merge_against_a_dict(spark):
    rng = random.Random(2)
    table = VersionedTable(spark, scratch_path(spark, "t-merge"))
    table.refresh(people(spark, range(60)), key=["id"], parts=8)
    want = {r.id: (r.name, r.score) for r in table.read().collect()}
    for turn in range(3):
        picked = rng.sample(range(-10, 80), 25 if turn else 1)
        rows = [(i, f"t{turn}-{i}", None, rng.random() < .3) for i in picked]
        before = table.version()
        after = table.merge(spark.createDataFrame(rows, "id long, name string, score long, gone boolean"), delete="gone")
        for i, name, score, gone in rows:
            want.pop(i, None)
            if not gone:
                want[i] = (name, score)
        got = table.read().collect()
        assert {r.id: (r.name, r.score) for r in got} == want and len(got) == len(want)
        same = [p for p, folder in before.folders.items() if after.folders.get(p) == folder]
        if turn == 0:  # one key: one part is written, the others are listed as they were
            assert len(same) >= len(before.folders) - 1
    changes = people(spark, [1, 1])
    with pytest.raises(ValueError, match="more than once"):
        table.merge(changes)
    with pytest.raises(ValueError, match="null"):
        table.merge(spark.createDataFrame([(None, "a", 1)], "id long, name string, score long"))
    assert table.merge(people(spark, [])).number == table.versions()[-1]
    with pytest.raises(ValueError, match="no key"):
        plain = VersionedTable(spark, scratch_path(spark, "t-plain"))
        plain.refresh(people(spark, range(2)))
        plain.merge(people(spark, [1]))
    with pytest.raises(ValueError, match="part"):
        plain.refresh(people(spark, range(2)).withColumnRenamed("name", "Part"))


# ------------------------------------------------------------------ content

def test_fingerprints_see_what_sums_do_not(spark):
    df = people(spark, range(20))
    same = fingerprint(df)
    assert fingerprint(df.repartition(7).select("score", "name", "id")) == same
    assert fingerprint(df.union(df.limit(1))) != same
    swapped = df.withColumn("id", F.when(F.col("id") == 1, 2).when(F.col("id") == 2, 1).otherwise(F.col("id")))
    assert fingerprint(swapped) != same and fingerprint(swapped).rows == same.rows
    nulls = spark.createDataFrame([(None, "a"), ("b", None)], "x string, y string")
    moved = spark.createDataFrame([("a", None), (None, "b")], "x string, y string")
    assert fingerprint(nulls) != fingerprint(moved)
    assert fingerprint(df.limit(0)).rows == 0
    maps = spark.sql("SELECT map('b', 1, 'a', 2) AS m")
    assert fingerprint(maps) == fingerprint(spark.sql("SELECT map('a', 2, 'b', 1) AS m"))
    row = reconcile(df, swapped).collect()[0]
    assert (row.source_rows, row.stored_rows, row.same_rows, row.same_content) == (20, 20, True, False)


class Altering(sinks.StagedFolder):
    """A store that keeps the number of rows and changes one value."""

    def _save(self, df, path):
        super()._save(df.withColumn("name", F.when(F.col("id") == F.lit("1"), F.lit("someone else")).otherwise(F.col("name"))), path)


CSV = "ID,Name,Address,Color,Created At (dd/mm/yyyy),Last Login,Is Claimed?,Paid  Amount ($)\n"


def test_a_load_that_alters_a_value_is_refused(spark):
    src = _write(scratch_path(spark, "t-alter"), "a.csv", CSV + "1,Ann,a,b,,,,\n2,Bob,a,b,,,,\n")
    target = scratch_path(spark, "t-alter-out")
    jobs.flat_record_job(spark, src, catalog.RUN_TS, sink=sinks.StagedFolder(target))
    with pytest.raises(ContentMismatch, match="content"):
        jobs.flat_record_job(spark, src, catalog.RUN_TS, sink=Altering(target))
    assert sorted(r.name for r in spark.read.parquet(target).collect()) == ["Ann", "Bob"]
    assert [f for f in os.listdir(os.path.dirname(target)) if f.startswith(os.path.basename(target) + ".")] == []


def test_a_wrong_count_is_found_before_readers_see_it(spark):
    target = scratch_path(spark, "t-count")
    jobs.load(spark.range(3), sinks.StagedFolder(target), "x", 3)
    with pytest.raises(AssertionError, match="4 rows were read"):
        jobs.load(spark.range(9), sinks.StagedFolder(target), "x", 4)
    assert spark.read.parquet(target).count() == 3


def test_move_path_never_leaves_a_gap(spark, monkeypatch):
    base = scratch_path(spark, "t-move")
    spark.range(2).write.parquet(base + "/old")
    spark.range(5).write.parquet(base + "/new")
    sinks.move_path(spark, base + "/new", base + "/old")
    assert spark.read.parquet(base + "/old").count() == 5 and os.listdir(base) == ["old"]
    with pytest.raises(Exception, match="missing"):
        sinks.move_path(spark, base + "/missing", base + "/old")
    assert spark.read.parquet(base + "/old").count() == 5


# ------------------------------------------------------------------ records

LINES = ["1,a,b", "2,a", "3,a,b,c", '4,"a,b', '5,a,"b', '6,"x ""y"" z",b', '7,a"b,c', '8,"",', '9,"a"b,c', "",
         '10,"a,b",c', '12,"a,"b",c', '"13",a,b', ",,"]
REASONS = {"2": "short", "3": "long", "4": "broken_quote", "5": "broken_quote", "9": "broken_quote", "12": "broken_quote"}


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_one_line_records(spark, end):
    path = _write(scratch_path(spark, "t-records"), "a.csv", end.join(["ID,Na me,c", *LINES]) + end)
    _write(path, "b.csv", "﻿ID,Na me,c" + end + "20,x,y")
    got = records.read_csv_records(spark, path, {"multiLine": False})
    rows = {r.ID: r for r in got.collect()}
    assert len(rows) == 14 and rows["6"]["Na me"] == 'x "y" z' and rows["7"]["Na me"] == 'a"b' and rows["20"].c == "y"
    for line in filter(None, LINES):
        key = line.split(",")[0].strip('"') or None
        assert rows[key]._reason == REASONS.get(key)
        assert rows[key]._raw == (line if key in REASONS else None)
    assert records.good_records(got).count() == 8 and records.rejected_records(got).count() == 6
    assert records.files_without_header(spark, path, ["ID", "Na me", "c"], {"multiLine": False}).count() == 0
    _write(path, "c.csv", "c,ID,Na me" + end + "1,2,3" + end)
    assert [r.first_line for r in records.files_without_header(spark, path, ["ID", "Na me", "c"]).collect()] == ["c,ID,Na me"]


def test_multi_line_records(spark):
    text = 'ID,n,c\n1,"a\nb",x\n2,a\n3,a,b,c\n4,"a\n\nq",z,w\n5,"b,y\n6,"c",z\n7,u,v\n8,"q,w\n9,u,v\n'
    got = records.read_csv_records(spark, _write(scratch_path(spark, "t-multi"), "a.csv", text)).collect()
    assert {r.ID: r._reason for r in got} == {"1": None, "2": "short", "3": "long", "4": "long", "5": "broken_quote",
                                               "7": None, "8": "broken_quote"}
    raw = {r.ID: r._raw for r in got}
    assert raw["2"] == "2,a" and raw["4"] == '4,"a\n\nq",z,w' and raw["8"].endswith("9,u,v") and '6,"c"' in raw["5"]


@pytest.mark.parametrize("quote, delimiter, escape", [("'", ";", "'"), ('"', "|", "\\")])
def test_other_dialects(spark, quote, delimiter, escape):
    d, q = delimiter, quote
    lines = [f"id{d}a{d}b", f"1{d}{q}x{d}y{escape}{q}{q}{d}z", f"2{d}{q}x{d}z", f"3{d}x", f"4{d}x{d}y"]
    path = _write(scratch_path(spark, "t-dialect"), "a.csv", "\n".join(lines))
    got = records.read_csv_records(spark, path, {"multiLine": False, "quote": q, "delimiter": d, "escape": escape})
    assert {r.id: r._reason for r in got.collect()} == {"1": None, "2": "broken_quote", "3": "short", "4": None}
    assert [r.a for r in got.where("id = 1").collect()] == [f"x{d}y{q}"]


def test_flat_job_sets_malformed_rows_aside(spark):
    text = CSV + "1,Ann,a,b,,,,\n2,Bob\n3,Cy,a,b,,,,,,\n4,Di,a,b,,,,\n"
    src = _write(scratch_path(spark, "t-flat-rejects"), "a.csv", text)
    for options in ({}, {"multiLine": "false"}):
        out, bad = scratch_path(spark, "t-good"), scratch_path(spark, "t-bad")
        with jobs.flat_record_job(spark, src, catalog.RUN_TS, sink=sinks.StagedFolder(out), options=options,
                                  rejects_sink=sinks.StagedFolder(bad)) as res:
            assert (res.metrics["src_count"], res.metrics["dest_count"], res.metrics["rejected_rows"]) == (4, 2, 2)
            folder = res.staging[1]
        assert not os.path.exists(folder)  # staging goes with the result
        assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["1", "4"]
        assert sorted((r.raw, r.reason) for r in spark.read.parquet(bad).collect()) == [("2,Bob", "short"), ("3,Cy,a,b,,,,,,", "long")]
    _write(src, "b.csv", "Name,ID,Address,Color,Created At (dd/mm/yyyy),Last Login,Is Claimed?,Paid  Amount ($)\nEve,5,a,b,,,,\n")
    with pytest.raises(AssertionError, match="not the header"):
        jobs.flat_record_job(spark, src, catalog.RUN_TS, options={"multiLine": "false"})


# ------------------------------------------------------------------ keys over loads

def test_occurrence_numbers_against_a_dict(spark):
    rows = [(k, v) for k in ("hot",) * 40 + ("a", "a", "b", None, None) for v in ("x", "y")] + [("hot", "same")] * 60
    df = spark.createDataFrame(rows, "id string, v string")
    got = [sorted((str(r.id), r.v, r._occurrence) for r in ids.with_occurrence(df.repartition(n), "id").collect())
           for n in (1, 3, 8)]
    assert got[0] == got[1] == got[2] and len(got[0]) == len(rows)
    per_key = {}
    for key, v, n in got[0]:
        per_key.setdefault(key, []).append(n)
    assert all(sorted(ns) == list(range(len(ns))) for ns in per_key.values())


@pytest.mark.parametrize("singles", [0, 2000])  # all rows move, or only those of repeated keys
def test_heavy_keys_are_numbered_like_light_ones(spark, singles):
    rows = ([("hot", str(i % 90)) for i in range(300)] + [("same", "x")] * 200 + [("a", "x"), ("a", "y"), (None, None), (None, "z")]
            + [(f"s{i}", "x") for i in range(singles)])
    df = spark.createDataFrame(rows, "id string, v string")

    def numbered(heavy, n):
        found = ids.with_occurrence(df.repartition(n), "id", heavy=heavy).collect()
        return sorted((r.id or "", r.v or "", r._occurrence) for r in found)
    light = numbered(1000, 4)
    assert numbered(100, 4) == numbered(1, 7) == light and len(light) == len(rows)
    per_key = {}
    for key, _, n in light:
        per_key.setdefault(key, []).append(n)
    assert all(sorted(ns) == list(range(len(ns))) for ns in per_key.values())


@pytest.mark.parametrize("singles", [0, 500])
def test_key_lists_too_large_to_broadcast(spark, singles, monkeypatch):
    monkeypatch.setattr(ids, "BROADCAST_BYTES", 0)
    rows = [("hot", str(i)) for i in range(60)] + [("a", "x"), ("a", "x")] + [(f"s{i}", "x") for i in range(singles)]
    got = ids.with_occurrence(spark.createDataFrame(rows, "id string, v string").repartition(3), "id", heavy=10).collect()
    assert sorted(r._occurrence for r in got if r.id == "hot") == list(range(60)) and len(got) == len(rows)
    assert sorted(r._occurrence for r in got if r.id == "a") == [0, 1]
    assert {r._occurrence for r in got if r.id.startswith("s")} <= {0}


def tagged_batch(spark, rows):
    df = spark.createDataFrame(rows, "id string, v string").repartition(3)
    return ids.staged(ids.tagged(df, "id"), "t-batch")


def numbers(table, spark, rows, batch):
    return sorted((r.id, r.v, r._occurrence) for r in table.number(tagged_batch(spark, rows), ["id", "v"], "id", batch).collect())


def test_keys_keep_their_numbers_over_batches(spark):
    table = KeyTable(spark, scratch_path(spark, "t-keys"))
    first = numbers(table, spark, [("a", "x"), ("a", "y"), ("b", "x"), ("b", "x")], 0)
    assert sorted(n for k, _, n in first if k == "a") == [0, 1] and [n for k, _, n in first if k == "b"] == [0, 1]
    again = numbers(table, spark, [("a", "y"), ("a", "z"), ("b", "x"), ("c", "x")], 1)
    known = {(k, v): n for k, v, n in first}
    assert dict((k[:2], k[2]) for k in again)[("a", "y")] == known[("a", "y")]  # it came before
    assert [n for k, v, n in again if (k, v) == ("a", "z")] == [2]  # another row of the key
    assert [n for k, v, n in again if k == "b"] == [0] and [n for k, v, n in again if k == "c"] == [0]
    more = numbers(table, spark, [("b", "x")] * 3 + [("a", "x")], 2)
    assert [n for k, v, n in more if k == "b"] == [0, 1, 2]
    # a batch that is replayed gives the same numbers
    assert numbers(table, spark, [("a", "y"), ("a", "z"), ("b", "x"), ("c", "x")], 1) == again
    assert numbers(table, spark, [("b", "x")] * 3 + [("a", "x")], 2) == more
    found = {r.key: (r.rows, r.different, r.loads, r.first_load, r.last_load) for r in table.duplicates().collect()}
    assert found == {"a": (5, 3, 3, 0, 2), "b": (6, 3, 3, 0, 2)}


def test_the_key_table_is_compacted(spark, monkeypatch):
    from lakewash.streaming import keys
    monkeypatch.setattr(keys, "COMPACT", 2)
    table = KeyTable(spark, scratch_path(spark, "t-compact"))
    for batch in range(5):
        got = numbers(table, spark, [("a", f"v{batch}"), ("a", "v0")], batch)
        assert sorted(n for _, _, n in got) == ([0, 1] if batch == 0 else [0, batch + 1]) or batch == 0
    assert any(n.startswith("upto-") for n in os.listdir(table.path)) and len(table._state(5)) < 5
    assert {r.key: (r.rows, r.loads) for r in table.duplicates().collect()} == {"a": (10, 5)}


def test_stream_ids_over_loads(spark):
    src = _write(scratch_path(spark, "t-again"), "a.csv", CSV + "1,Ann,a,b,,,,\n2,Bob,a,b,,,,\n")
    out, ckpt = scratch_path(spark, "t-again-out"), scratch_path(spark, "t-again-ckpt")
    run_flat_record_load(spark, src, out, ckpt, catalog.RUN_TS)
    _write(src, "b.csv", CSV + "1,Ann,a,b,,,,\n2,Rob,a,b,,,,\n3\n")
    run_flat_record_load(spark, src, out, ckpt, catalog.RUN_TS)
    rows = spark.read.parquet(out).collect()
    uuids = {}
    for r in rows:
        uuids.setdefault((r.id, r.name), set()).add(r.uuid)
    assert len(rows) == 4 and all(len(u) == 1 for u in uuids.values())  # Ann arrived twice, as she was
    assert len(set.union(*uuids.values())) == 3
    assert [(r.raw, r.reason) for r in spark.read.parquet(out + "-rejects").collect()] == [("3", "short")]


def test_nested_job_runs_six_spark_jobs(spark):
    """One to stage, two to see that no user repeats, one for each table."""
    path = catalog.write_nested_json(spark, SF_SMALL)
    spark.sparkContext.setJobGroup("t-nested", "count")
    try:
        with jobs.nested_record_job(spark, path, catalog.RUN_TS, sinks={
                n: (lambda d: d.write.format("noop").mode("overwrite").save()) for n in jobs.NESTED_TABLES}) as res:
            assert res.metrics["users_count"] > 0
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("t-nested")) <= 6
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


# ------------------------------------------------------------------ along time

def days(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def intervals():
    rng = random.Random(1)
    rows = []
    for i in range(300):
        s = None if rng.random() < .05 else days(rng.randint(0, 400))
        e = None if s is None or rng.random() < .1 else s + dt.timedelta(days=rng.randint(-2, 60))
        rows.append((i, rng.choice(["hot"] * 4 + ["b", "c", None]), s, e))
    return rows


def valid(r):
    return r[1] is not None and r[2] is not None and r[2] < (r[3] or dt.date.max)


def overlap(a, b):
    return a[1] == b[1] and a[2] < (b[3] or dt.date.max) and b[2] < (a[3] or dt.date.max)


@pytest.mark.parametrize("slices", [1, 5, 64])
def test_overlap_counts(spark, intervals, slices):
    df = spark.createDataFrame(intervals, "id int, k string, s date, e date")
    good = [r for r in intervals if valid(r)]
    want = {r[0]: sum(overlap(r, o) for o in good if o[0] != r[0]) if valid(r) else None for r in intervals}
    assert {r.id: r.overlaps for r in temporal.overlap_counts(df, "k", "s", "e", slices=slices).collect()} == want


@pytest.mark.parametrize("width", [7, 1000])
def test_overlapping_pairs(spark, intervals, width):
    df = spark.createDataFrame(intervals, "id int, k string, s date, e date")
    good = [r for r in intervals if valid(r)]
    want = {(a[0], b[0]): (max(a[2], b[2]), min(a[3] or dt.date.max, b[3] or dt.date.max))
            for a in good for b in good if a[0] < b[0] and overlap(a, b)}
    got = temporal.overlapping_pairs(df, "k", "id", "s", "e", width).collect()
    assert len(got) == len(want)
    for r in got:
        since, until = want[r.left_id, r.right_id]
        assert r.shared_from == since and (r.shared_to or dt.date.max) == until


@pytest.mark.parametrize("slices", [1, 4, 64])
def test_as_of_join(spark, intervals, slices):
    rng = random.Random(4)
    right = [(rng.choice(["hot", "b", "d", None]), None if rng.random() < .1 else days(rng.randint(100, 400)),
              f"v{rng.randint(0, 99)}", i) for i in range(80)]

    def found(r):
        seen = [(o[1], o[2], o[3]) for o in right if r[1] is not None and o[0] == r[1] and r[2] and o[1] and o[1] <= r[2]]
        return max(seen)[1:] if seen else (None, None)
    left = spark.createDataFrame(intervals, "id int, k string, s date, e date")
    rows = spark.createDataFrame(right, "k string, t date, v string, n int")
    got = temporal.as_of_join(left, rows, "k", "s", "t", ["v", "n"], slices).collect()
    assert {r.id: (r.v, r.n) for r in got} == {r[0]: found(r) for r in intervals} and len(got) == len(intervals)
    none = temporal.as_of_join(left, rows.limit(0), "k", "s", "t", ["v"]).collect()
    assert len(none) == len(intervals) and all(r.v is None for r in none)
    assert temporal.as_of_join(left.limit(0), rows, "k", "s", "t", ["v"]).count() == 0


def test_a_hot_key_is_cut_along_time(spark):
    """With one key, the window still runs in many groups."""
    df = spark.range(6400).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") * 977 % 100_000).alias("t"))
    cuts = temporal._cuts(df.select("t"), 64)
    sizes = [r["count"] for r in df.groupBy(temporal._slice(F.col("t"), cuts)).count().collect()]
    assert len(sizes) == 64 and max(sizes) < 3 * 6400 / 64


# ------------------------------------------------------------------ profiles and reports

def test_profiles_merge(spark):
    df = spark.range(5000).select((F.col("id") % 900 - 450).alias("n"), F.when(F.col("id") % 3 > 0, F.col("id")).cast("string").alias("s"),
                                  F.lit(None).cast("string").alias("none"), (F.col("id") % 4).alias("load"))
    splits = [["load"], [], ["n"]]
    several = [sketches.read_profile(sketches.merge_profiles(sketches.profile_sketch(df, ["n", "s", "none"], by=by))).collect()
               for by in splits]
    merged = several[0]
    assert all(sorted(map(tuple, other), key=str) == sorted(map(tuple, merged), key=str) for other in several[1:])
    by = {r.column_name: r for r in merged}
    assert (by["n"].least, by["n"].greatest, by["none"].distinct_estimate, by["none"].nulls) == ("-450", "449", 0, 5000)
    for name, exact in (("n", 900), ("s", 3333)):
        assert abs(by[name].distinct_estimate - exact) <= 3 * sketches.RELATIVE_ERROR * exact


def test_rollup_tells_totals_from_nulls(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "x", None), (None, None, 2)], "f string, c string, v int")
    got = {(r.f, r.c, r.level): (r.row_count, r.nulls_v) for r in quality.quality_rollup(df, ["f", "c"], ["v"]).collect()}
    assert got == {("a", None, 0): (1, 0), ("a", "x", 0): (1, 1), (None, None, 0): (1, 0), ("a", None, 1): (2, 1),
                   (None, None, 1): (1, 0), (None, None, 3): (3, 1)}


def test_a_load_lands_as_many_files_and_is_one_batch(spark, monkeypatch):
    import lakewash.streaming as streaming
    from lakewash.plans import catalog_loads

    run, landed = streaming.run_flat_record_load, []

    def spy(session, source, *args, **kwargs):
        landed.append(len([f for f in os.listdir(source) if f.endswith(".csv")]))
        return run(session, source, *args, **kwargs)

    monkeypatch.setattr(streaming, "run_flat_record_load", spy)
    out, _ = catalog_loads._run_loads(spark, SF_SMALL)
    assert sorted(f for f in os.listdir(out) if f.startswith("batch_id=")) == [f"batch_id={i}" for i in range(3)]
    assert min(b - a for a, b in zip([0, *landed], landed)) > 1
    assert spark.read.parquet(out).where("batch_id = 0").count() > 0
