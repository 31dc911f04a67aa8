"""Column profiles that can be kept and merged: one row for each column and
group, whose counts, extremes and distinct-value sketch of any number of loads
add up to the profile of all of them without reading a row again.

Row and null counts, least and greatest value are exact. The number of
different values is estimated from HyperLogLog registers: a value's hash picks
one of 2^PRECISION registers, which keeps the longest run of leading zeros
seen. Registers are a maximum, so what is merged does not depend on how rows
were split over loads or tasks, to the last bit. The estimator is Ertl's (New
cardinality estimation algorithms for HyperLogLog sketches, 2017), without
bias from one value up; its standard error is 1.04 / sqrt(2^PRECISION), 1.6 %.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRECISION = 12
_REGISTERS, _REST = 1 << PRECISION, 64 - PRECISION
#: Standard error of the number of different values, as a share of it.
RELATIVE_ERROR = 1.04 / _REGISTERS ** 0.5
#: Terms of the estimator's series; later ones are below 1e-16 for this many registers.
_TERMS = 20


def _ordered(numeric: Column, text: Column) -> Column:
    """A value that sorts by its number where the column holds numbers."""
    return F.when(text.isNotNull(), F.struct(F.when(numeric, text.try_cast("double")).alias("number"), text.alias("text")))


def _registers() -> Column:
    return (F.map_from_entries(F.collect_list(F.when(F.col("_lw_register").isNotNull(), F.struct("_lw_register", "_lw_run"))))
            .alias("registers"))  # at most 4,096 entries


def profile_sketch(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``by`` columns, ``column_name``, ``numeric`` (whether it holds numbers),
    ``rows``, ``nulls``, ``least``, ``greatest`` (as text, in the order of the
    column's type) and ``registers``. One pass for all columns; each task hands
    on at most one row for each group, column and register."""
    numbers = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    each = [F.struct(F.lit(c).alias("column_name"), F.lit(c in numbers).alias("numeric"),
                     F.col(f"`{c}`").cast("string").alias("_lw_text")) for c in columns]
    groups = [F.col(f"`{c}`") for c in by]
    long = df.select(*groups, F.explode(F.array(*each)).alias("_lw_v")).select(*groups, "_lw_v.*")
    h = F.xxhash64("_lw_text")
    rest = F.shiftrightunsigned(h, PRECISION)
    run = F.lit(_REST + 1) - F.when(rest == 0, 0).otherwise(F.length(F.bin(rest)))
    there = F.col("_lw_text").isNotNull()
    seen = long.select(*groups, "column_name", "numeric", _ordered(F.col("numeric"), F.col("_lw_text")).alias("_lw_value"),
                       F.when(there, F.pmod(h, F.lit(_REGISTERS)).cast("int")).alias("_lw_register"),
                       F.when(there, run.cast("int")).alias("_lw_run"))
    cells = seen.groupBy(*groups, "column_name", "numeric", "_lw_register").agg(
        F.count(F.lit(1)).alias("_lw_n"), F.max("_lw_run").alias("_lw_run"), F.min("_lw_value").alias("_lw_least"),
        F.max("_lw_value").alias("_lw_greatest"))
    return cells.groupBy(*groups, "column_name", "numeric").agg(
        F.sum("_lw_n").alias("rows"), F.sum(F.when(F.col("_lw_register").isNull(), F.col("_lw_n")).otherwise(0)).alias("nulls"),
        F.min("_lw_least")["text"].alias("least"), F.max("_lw_greatest")["text"].alias("greatest"), _registers())


def merge_profiles(profiles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Stored profiles of several loads as one, for each column and ``by``
    group."""
    groups = [F.col(f"`{c}`") for c in by]
    least, greatest = (_ordered(F.col("numeric"), F.col(c)) for c in ("least", "greatest"))
    counts = profiles.groupBy(*groups, "column_name", "numeric").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.min(least)["text"].alias("least"),
        F.max(greatest)["text"].alias("greatest"))
    cells = (profiles.select(*[g.alias(f"_g{i}") for i, g in enumerate(groups)], F.col("column_name").alias("_c"),
                             F.explode_outer("registers").alias("_lw_register", "_lw_run")))
    names = [f"_g{i}" for i in range(len(groups))]
    kept = cells.groupBy(*names, "_c", "_lw_register").agg(F.max("_lw_run").alias("_lw_run")).groupBy(*names, "_c").agg(_registers())
    same = F.col("column_name") == F.col("_c")
    for i, c in enumerate(by):
        same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"_g{i}"))
    return counts.join(kept, same).drop("_c", *names)


def distinct_estimate(registers: Column) -> Column:
    """The number of different values that filled the registers."""
    m = F.lit(float(_REGISTERS))
    empty = (m - F.size(registers)) / m
    runs = F.aggregate(F.map_values(registers), F.lit(0.0), lambda s, r: s + F.pow(F.lit(2.0), -r))
    series = F.aggregate(F.sequence(F.lit(1), F.lit(_TERMS)), empty, lambda s, k: s + F.pow(
        empty, F.pow(F.lit(2.0), k)) * F.pow(F.lit(2.0), k - 1))
    return F.when(F.size(registers) == 0, F.lit(0)).otherwise(
        F.round(m * m / F.lit(2 * log(2)) / (m * series + runs))).cast("bigint")


def read_profile(profiles: DataFrame) -> DataFrame:
    """A profile with ``distinct_estimate`` and the ``standard_error`` of it in
    place of the registers."""
    estimate = distinct_estimate(F.col("registers"))
    return profiles.withColumns({
        "distinct_estimate": estimate,
        "standard_error": F.round(estimate * F.lit(RELATIVE_ERROR), 3)}).drop("registers")
