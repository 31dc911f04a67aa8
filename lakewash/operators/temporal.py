"""Joins and counts along time: the row valid at a moment, and intervals that
overlap. No pair of rows is tried that need not be, and a key that holds a
third of all rows is cut along time, so that no task gets it whole.

Time is cut at quantiles of the rows' own times into ``slices`` slices. Rows
are dealt by (key, slice); what a slice needs to know of earlier ones is one
row for each key and slice, carried forward over at most ``slices`` rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICES = 64
#: Stands for an end that has not come.
OPEN_END = "9999-12-31 23:59:59"

_BEFORE = (Window.unboundedPreceding, -1)


def _cuts(times: DataFrame, slices: int) -> list:
    """Quantiles of the column ``t``: at most ``slices`` - 1 values."""
    at = [i / slices for i in range(1, slices)]
    row = times.agg(F.percentile_approx("t", at, 1000).alias("cuts")).first()
    return sorted(set(row.cuts or []))


def _slice(t: Column, cuts: Sequence) -> Column:
    if not cuts:
        return F.lit(0)
    return F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= t))


def as_of_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str,
               columns: Sequence[str], slices: int = SLICES) -> DataFrame:
    """Every row of ``left`` with ``columns`` of the ``right`` row of its key
    that was valid at its time: the last one whose time is not later.

    Where several right rows of a key share that time, the one whose
    ``columns`` are greatest counts. Without such a row, or where the left row
    has no key or no time, the columns are null. Left rows are never lost or
    repeated. Both sides are put in one sequence by time and the last right row
    is carried along it; each left row moves once.
    """
    lcols = left.columns
    payload = F.struct(*[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(columns)])
    mine = left.select(F.col(f"`{key}`").alias("k"), F.col(f"`{left_time}`").alias("t"), F.lit(1).alias("side"),
                       F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(lcols)]).alias("own"))
    theirs = right.select(F.col(f"`{key}`").alias("k"), F.col(f"`{right_time}`").alias("t"), F.lit(0).alias("side"),
                          payload.alias("value")).where("k IS NOT NULL AND t IS NOT NULL")
    findable = F.col("k").isNotNull() & F.col("t").isNotNull()
    cuts = _cuts(mine.where(findable).select("t").unionByName(theirs.select("t")), slices)
    both = mine.where(findable).unionByName(theirs, allowMissingColumns=True).withColumn("s", _slice(F.col("t"), cuts))
    last = (both.groupBy("k", "s").agg(F.max(F.when(F.col("side") == 0, F.struct("t", "value"))).alias("last"))
            .withColumn("carried", F.last("last", ignorenulls=True).over(
                Window.partitionBy("k").orderBy("s").rowsBetween(*_BEFORE)))
            .select("k", "s", F.col("carried.value").alias("carried")))
    order = Window.partitionBy("k", "s").orderBy("t", "side", "value").rowsBetween(Window.unboundedPreceding, 0)
    found = both.join(last, ["k", "s"]).withColumn(
        "found", F.coalesce(F.last("value", ignorenulls=True).over(order), "carried")).where("side = 1")
    names = [*[F.col(f"own.c{i}").alias(c) for i, c in enumerate(lcols)],
             *[F.col(f"found.v{i}").alias(c) for i, c in enumerate(columns)]]
    kinds = {f.name: f.dataType for f in right.schema.fields}
    lost = left.where(F.col(f"`{key}`").isNull() | F.col(f"`{left_time}`").isNull()).select(
        *[F.col(f"`{c}`") for c in lcols], *[F.lit(None).cast(kinds[c]).alias(c) for c in columns])
    return found.select(*names).unionByName(lost)


def overlap_counts(df: DataFrame, key: str, start: str, end: str, name: str = "overlaps",
                   slices: int = SLICES) -> DataFrame:
    """``df`` with the number of other intervals of the same key that overlap
    each row's [start, end). A null end is open; a row without key or start, or
    whose end is not after its start, is no interval: it overlaps none and its
    number is null.

    A sweep, no pairs: those that overlap are the intervals that begin before
    this one's end, less those that end by its start, less itself. Beginnings
    and ends are counted by (key, time) first, so intervals that share a time
    are one row, and both counts run over those rows.
    """
    k, s = F.col(f"`{key}`"), F.col(f"`{start}`")
    e = F.coalesce(F.col(f"`{end}`"), F.lit(OPEN_END).cast(df.schema[end].dataType))
    rows = df.withColumns({"_lw_s": s, "_lw_e": e, "_lw_k": k})
    valid = F.col("_lw_k").isNotNull() & F.col("_lw_s").isNotNull() & (F.col("_lw_s") < F.col("_lw_e"))
    good = rows.where(valid)
    points = good.select("_lw_k", F.col("_lw_s").alias("t"), F.lit(1).alias("b"), F.lit(0).alias("z")).unionByName(
        good.select("_lw_k", F.col("_lw_e").alias("t"), F.lit(0).alias("b"), F.lit(1).alias("z")))
    at = points.groupBy("_lw_k", "t").agg(F.sum("b").alias("b"), F.sum("z").alias("z"))
    at = at.withColumn("s", _slice(F.col("t"), _cuts(points.select("t"), slices)))
    whole = Window.partitionBy("_lw_k").orderBy("s").rowsBetween(*_BEFORE)
    carried = (at.groupBy("_lw_k", "s").agg(F.sum("b").alias("sb"), F.sum("z").alias("sz"))
               .select("_lw_k", "s", F.coalesce(F.sum("sb").over(whole), F.lit(0)).alias("cb"),
                       F.coalesce(F.sum("sz").over(whole), F.lit(0)).alias("cz")))
    inside = Window.partitionBy("_lw_k", "s").orderBy("t")
    begun = F.col("cb") + F.coalesce(F.sum("b").over(inside.rowsBetween(*_BEFORE)), F.lit(0))  # before t
    ended = F.col("cz") + F.sum("z").over(inside.rowsBetween(Window.unboundedPreceding, 0))  # by t
    run = at.join(carried, ["_lw_k", "s"]).select("_lw_k", "t", begun.alias("begun"), ended.alias("ended"))
    by_end = run.select("_lw_k", F.col("t").alias("_lw_e"), F.col("begun").alias("_lw_begun"))
    by_start = run.select("_lw_k", F.col("t").alias("_lw_s"), F.col("ended").alias("_lw_ended"))
    counted = good.join(by_end, ["_lw_k", "_lw_e"]).join(by_start, ["_lw_k", "_lw_s"])
    cols = [F.col(f"`{c}`") for c in df.columns]
    number = (F.col("_lw_begun") - F.col("_lw_ended") - 1).cast("bigint").alias(name)
    none = rows.where(~F.coalesce(valid, F.lit(False))).select(*cols, F.lit(None).cast("bigint").alias(name))
    return counted.select(*cols, number).unionByName(none)


def overlapping_pairs(df: DataFrame, key: str, row_id: str, start: str, end: str, days: int = 365) -> DataFrame:
    """``(key, left_id, right_id, shared_from, shared_to)`` of every two
    intervals of a key that overlap, each pair once, the smaller id first.

    An interval is dealt to every bucket of ``days`` days that it touches and
    met there by the others of its key; a pair is reported in the bucket in
    which its shared time begins. Intervals that are no interval (see
    :func:`overlap_counts`) have no pair. Choose ``days`` near the usual length:
    an open end is dealt up to the last bucket that any start falls in. The
    result holds every pair, and so can be much larger than the input.
    """
    k, kind = F.col(f"`{key}`").alias("k"), df.schema[end].dataType
    e = F.coalesce(F.col(f"`{end}`"), F.lit(OPEN_END).cast(kind))
    rows = df.select(k, F.col(f"`{row_id}`").alias("id"), F.col(f"`{start}`").alias("s"), e.alias("e")).where(
        "k IS NOT NULL AND s < e")

    def bucket(t: Column) -> Column:
        return F.floor(F.unix_date(t.cast("date")) / F.lit(days))
    latest = rows.agg(F.max(bucket(F.col("s"))).alias("latest"))  # one row
    dealt = rows.join(F.broadcast(latest)).withColumn(
        "bucket", F.explode(F.sequence(bucket(F.col("s")), F.least(bucket(F.col("e")), F.col("latest"))))).drop("latest")
    a = dealt.select("k", "bucket", F.col("id").alias("left_id"), F.col("s").alias("as"), F.col("e").alias("ae"))
    b = dealt.select("k", "bucket", F.col("id").alias("right_id"), F.col("s").alias("bs"), F.col("e").alias("be"))
    since, until = F.greatest("as", "bs"), F.least("ae", "be")
    met = a.join(b, ["k", "bucket"]).where(
        (F.col("left_id") < F.col("right_id")) & (since < until) & (bucket(since) == F.col("bucket")))
    open_end = F.lit(OPEN_END).cast(kind)
    return met.select(F.col("k").alias(key), "left_id", "right_id", since.alias("shared_from"),
                      F.when(until < open_end, until).alias("shared_to"))
