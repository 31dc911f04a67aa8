"""Frame operators: mapping, names, nesting, ids and quality checks."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakewash.operators import ids, mapping, nested, quality


def test_apply_mapping_value_kinds(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    out = mapping.apply_mapping(df, {"key": "k", "up": F.upper("v"), "fn": lambda d: d["k"] + 1})
    assert out.columns == ["key", "up", "fn"]
    assert tuple(out.first()) == (1, "A", 2)
    with pytest.raises(ValueError):
        mapping.apply_mapping(df, {"bad": 42})


def test_apply_mapping_extend(spark):
    df = spark.createDataFrame([(1, "a", "x")], "K int, Name string, other string")
    out = mapping.apply_mapping(df, {"name": F.upper("Name"), "new": F.lit(1), "NEW": F.lit(2)}, extend=True)
    # replaced in place (key's case wins), the rest kept, new keys appended; NEW collapses onto new
    assert out.columns == ["K", "name", "other", "NEW"]
    assert tuple(out.first()) == (1, "A", "x", 2)


def test_normalize_columns(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["Start (dd/mm/yyyy)", "Paid  Amount ($)", "__ID__", "a.b"])
    assert mapping.normalize_columns(df).columns == ["start", "paid_amount", "id", "a_b"]
    assert mapping.normalize_name(mapping.normalize_name("Paid  Amount ($)")) == "paid_amount"
    with pytest.raises(ValueError, match="a_b"):
        mapping.normalize_columns(spark.createDataFrame([(1, 2)], ["A B", "a_b"]))
    with pytest.raises(ValueError, match="empty"):
        mapping.normalize_columns(spark.createDataFrame([(1,)], ["***"]))


def test_require_columns():
    class Fake:
        columns = ["a", "b"]
    mapping.require_columns(Fake(), ["a"])
    with pytest.raises(AssertionError):
        mapping.require_columns(Fake(), ["a", "c"])


def test_conform_to_schema(spark):
    from pyspark.sql import types as T
    df = spark.createDataFrame([("1", "2.345", "x"), ("zz", "1,000.5", None), (None, None, "y")],
                               "ID string, amount string, extra string")
    target = T.StructType([T.StructField("id", T.IntegerType(), False),
                           T.StructField("amount", T.DecimalType(10, 2), True),
                           T.StructField("missing", T.DateType(), True)])
    out = mapping.conform_to_schema(df, target)
    assert out.columns == ["id", "amount", "missing", mapping.CONFORM_ERRORS]
    rows = sorted(out.collect(), key=lambda r: str(r[3]))
    errs = {tuple(r[3]) for r in rows}
    assert errs == {(), ("id", "amount"), ("id",)}
    good, bad = quality.split_rejects(out, mapping.CONFORM_ERRORS)
    assert good.count() == 1 and bad.count() == 2


def test_explode_edge_cases(spark):
    df = spark.createDataFrame([(1, ["a", None]), (2, []), (3, None)], "k int, arr array<string>")
    out = nested.explode_scalars(df, ["k"], "arr", "v", position="pos")
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1, 0, "a"), (1, 1, None)], key=str)


def test_explode_structs_and_flatten(spark):
    df = spark.createDataFrame([(1, {"a": 1, "b": "x"}, [{"a": 2, "b": "y"}, {"a": 3, "b": None}])],
                               "k int, s struct<a:int,b:string>, arr array<struct<a:int,b:string>>")
    assert nested.flatten_struct(df, "s", keep=["k"]).columns == ["k", "a", "b"]
    out = nested.explode_structs(df, ["k"], "arr")
    assert sorted(map(tuple, out.collect()), key=str) == [(1, 2, "y"), (1, 3, None)]


def test_stable_uuid_repeatable(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "a")], "k int, v string")
    a = [r[0] for r in df.select(ids.stable_uuid("k", "v")).collect()]
    b = [r[0] for r in df.select(ids.stable_uuid("k", "v")).collect()]
    assert a == b and len(set(a)) == 3
    assert quality.uuid_format_violations(df.select(ids.stable_uuid("k", "v").alias("u")), "u").count() == 0


def test_surrogate_key_dense_and_ordered(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5000).alias("k"), F.lit("x").alias("payload"))
    out = ids.with_surrogate_key(df.repartition(7), ["k"], "sk", num_partitions=5)
    rows = out.orderBy("sk").collect()
    assert [r.sk for r in rows] == list(range(1, 5001))
    assert [r.k for r in rows] == sorted(r.k for r in rows)


def test_audit_timestamp(spark):
    df = spark.range(1).select(ids.audit_timestamp(datetime(2024, 6, 1, 12, 30)).alias("t"))
    assert df.first().t == datetime(2024, 6, 1, 12, 30)


def test_duplicates_and_null_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    dups = {r.k: r["count"] for r in quality.duplicate_keys(df, "k").collect()}
    assert dups == {1: 2, None: 2}
    with pytest.raises(AssertionError):
        quality.require_unique(df, "k")
    quality.require_unique(spark.createDataFrame([(1,), (2,)], "k int"), "k")
    pk = {r.k: r.reason for r in quality.primary_key_violations(
        spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int"), "k").collect()}
    assert pk == {1: "duplicate", None: "null"}


def test_profile_one_pass(spark):
    df = spark.createDataFrame([(1, None), (1, "a"), (None, "b")], "id int, v string")
    prof = quality.profile(df, key="id")
    assert prof.row_count == 3 and prof.null_counts == {"id": 1, "v": 1}
    assert prof.key_groups == 2 and prof.has_duplicate_keys
    assert not quality.profile(spark.createDataFrame([(1,), (2,)], "id int"), key="id").has_duplicate_keys


def test_not_null(spark):
    df = spark.createDataFrame([(1, None), (2, "a")], "a int, b string")
    assert [tuple(r) for r in quality.not_null_violations(df, ["a", "b"]).collect()] == [("b", 1)]
    with pytest.raises(AssertionError, match="b"):
        quality.require_not_null(df, ["a", "b"])
    quality.require_not_null(df, ["a"])


def test_foreign_keys(spark):
    parent = spark.createDataFrame([(1,), (2,)], "pk int")
    child = spark.createDataFrame([(10, 1), (11, 3), (12, None), (13, 3)], "id int, fk int")
    orphans = quality.foreign_key_orphans(child, parent, ["fk"], ["pk"])
    assert sorted(r.id for r in orphans.collect()) == [11, 13]
    left = quality.cascade_delete(child, parent.where("pk = 1"), ["fk"], ["pk"])
    assert sorted(r.id for r in left.collect()) == [11, 12, 13]


def test_contract_split_is_whole(spark):
    df = spark.createDataFrame([("a", "2024-01-01"), ("", None), (None, "junk")], "name string, d string")
    from lakewash.functions import text_to_date
    rules = {"name": F.col("name").isNotNull() & (F.col("name") != ""),
             "date": F.col("d").isNull() | text_to_date("d").isNotNull()}
    good, bad = quality.split_by_contract(df, rules)
    assert good.count() + bad.count() == df.count()
    assert sorted(tuple(r[quality.FAILED_RULES]) for r in bad.collect()) == [("name",), ("name", "date")]


def test_latest_per_key_ties_and_nulls(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 5, "b"), (1, 5, "c"), (2, None, "z")],
                               "k int, ts int, v string")
    out = {r.k: (r.ts, r.v) for r in quality.latest_per_key(df, ["k"], ["ts"]).collect()}
    assert out == {1: (5, "c"), 2: (None, "z")}


def test_row_cap_and_unparsed(spark):
    df = spark.range(100).select(F.col("id").alias("k"))
    assert [r.k for r in quality.row_cap(df, 3, [F.col("k").desc()]).collect()] == [99, 98, 97]
    rows = spark.createDataFrame([("not a date", None), ("x", None), ("2024-01-01", "ok"), (None, None)],
                                 "raw string, clean string")
    assert [r.raw for r in quality.unparsed_rows(rows, "raw", "clean", "not a date").collect()] == ["x"]


def test_cleaning_failure_report(spark):
    df = spark.createDataFrame([("a", None), (None, None), ("b", "B")], "r string, c string")
    assert tuple(quality.cleaning_failure_report(df, {"c": ("r", "c")}).first()) == (1,)


def test_latest_per_key_plan_aggregates_map_side(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("ts"))
    plan = quality.latest_per_key(df, ["k"], ["ts"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and ("partial_max" in plan)


def test_surrogate_key_splits_a_hot_value(spark):
    df = spark.range(0, 6000).select(F.when(F.col("id") < 3000, F.lit(1)).otherwise(F.col("id")).alias("k"),
                                     F.col("id").alias("v"))
    out = ids.with_surrogate_key(df, ["k"], "sk", num_partitions=6)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(sizes) < 3000
    rows = out.orderBy("sk").collect()
    assert [r.sk for r in rows] == list(range(1, 6001))
    assert [r.k for r in rows] == sorted(r.k for r in rows)


def test_profile_unique_modes(spark):
    df = spark.range(0, 2000).select(F.col("id").alias("id"))
    assert quality.profile(df, key="id", unique_check="approx").has_duplicate_keys is None
    dup = df.union(df)
    assert quality.profile(dup, key="id", unique_check="approx").has_duplicate_keys
    assert quality.profile(dup, key="id", unique_check="off").key_groups is None
    with pytest.raises(ValueError):
        quality.profile(df, key="id", unique_check="maybe")


def test_surrogate_key_splits_a_group_of_copies(spark):
    copies = spark.range(0, 3000).select(F.lit(5).alias("k"), F.lit("same").alias("v"))
    rest = spark.range(0, 6000).select(F.col("id").alias("k"), F.lit("other").alias("v"))
    df = copies.union(rest)
    out = ids.with_surrogate_key(df, ["k"], "sk", num_partitions=6)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(sizes) < 3000 and sum(sizes) == 9000
    rows = out.orderBy("sk").collect()
    assert [r.sk for r in rows] == list(range(1, 9001))
    assert [r.k for r in rows] == sorted(r.k for r in rows)
    again = ids.with_surrogate_key(df, ["k"], "sk", num_partitions=6)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))


def test_hot_orphan_key_is_split_by_aqe(spark):
    """With broadcast off, a key holding a third of the child is cut into
    several tasks by AQE's skew-join handling (left-anti is supported)."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        parent = spark.range(0, 20000).select(F.col("id").alias("pk"))
        child = spark.range(0, 60000).select(
            F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 30000).alias("fk"),
            F.sha2(F.col("id").cast("string"), 256).alias("pad"))
        df = quality.foreign_key_orphans(child, parent, ["fk"], ["pk"])
        rows = df.collect()
        assert len(rows) == child.where((F.col("fk") < 0) | (F.col("fk") >= 20000)).count()
        assert "SortMergeJoin(skew=true)" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_quality_report_one_pass(spark):
    df = spark.createDataFrame([("1", "a", None), ("2", None, "x"), (None, "b", "y")], "id string, raw string, v string")
    df = df.withColumn("clean", F.when(F.col("raw") == "a", F.lit("A")))
    row = quality.quality_report(df, required=["id"], clean_pairs={"raw": ("raw", "clean")},
                                 rules={"v_set": F.col("v").isNotNull()}).first()
    assert row.asDict() == {"row_count": 3, "nulls_id": 1, "failed_raw": 1, "broken_v_set": 1}
    plan = quality.quality_report(df, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1  # a single aggregate


def test_surrogate_key_ignores_input_layout(spark):
    """The same rows in a different partition layout get the same ids - the
    property a retried task relies on."""
    rows = spark.range(0, 3000).select((F.col("id") * 37 % 1000).alias("k"), (F.col("id") % 7).alias("v"))
    a = ids.with_surrogate_key(rows.repartition(3), ["k"], "sk", num_partitions=4)
    b = ids.with_surrogate_key(rows.repartition(7, "v"), ["k"], "sk", num_partitions=5)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
