"""Data-quality checks as distributed aggregates.

Every check returns a ``DataFrame`` (of violations, or a one-row summary);
the ``require_*`` helpers raise on top of them. Nothing here collects rows to
the driver except the one-row summaries the ``require_*`` helpers read.

Grouped checks aggregate map-side first (partial aggregation), so a hot key
holding a third of the rows still leaves each task with one partial row per
key rather than the rows themselves.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterable, Mapping, Sequence, Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Keys = Union[str, Column, Sequence[Union[str, Column]]]

# --- fixed values ---------------------------------------------------------------
UUID_PATTERN = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
# --- end of fixed values ------------------------------------------------------

FAILED_RULES = "_failed_rules"


def _keys(cols: Keys) -> list[Column]:
    if isinstance(cols, (str, Column)):
        cols = [cols]
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row: ``row_count`` and, per column, the number of nulls (one pass)."""
    cols = list(cols) if cols is not None else df.columns
    return df.agg(F.count(F.lit(1)).alias("row_count"),
                  *[F.count_if(_q(c).isNull()).alias(c) for c in cols])


def not_null_violations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column_name, null_count)`` for each listed column holding nulls."""
    counts = null_counts(df, cols).drop("row_count")
    long = counts.unpivot([], [_q(c) for c in cols], "column_name", "null_count")
    return long.where(F.col("null_count") > 0)


def require_not_null(df: DataFrame, cols: Sequence[str]) -> None:
    bad = {r["column_name"]: r["null_count"] for r in not_null_violations(df, cols).collect()}
    if bad:
        raise AssertionError(f"null values in required columns: {bad}")


def duplicate_keys(df: DataFrame, cols: Keys) -> DataFrame:
    """Key values occurring more than once, with their ``count``. Null keys
    form one group, so two rows with a null key are a duplicate."""
    return df.groupBy(*_keys(cols)).count().where(F.col("count") > 1)


def require_unique(df: DataFrame, cols: Keys) -> None:
    if not duplicate_keys(df, cols).isEmpty():
        raise AssertionError(f"some values of {cols!r} occur more than once")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def require_non_empty(df: DataFrame, what: str = "DataFrame") -> None:
    if df.isEmpty():
        raise AssertionError(f"{what} holds no rows")


def uuid_format_violations(df: DataFrame, col: str) -> DataFrame:
    """Rows whose value is not a lower-case 8-4-4-4-12 UUID (nulls included)."""
    return df.where(~F.coalesce(_q(col).rlike(UUID_PATTERN), F.lit(False)))


def primary_key_violations(df: DataFrame, cols: Keys) -> DataFrame:
    """Primary-key check in one grouped pass: keys that repeat or contain a
    null, with ``count`` and a ``reason`` (``duplicate``, ``null``, or both)."""
    keys = _keys(cols)
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | k.isNull()
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    null_flag = F.lit(False)
    for name in grouped.columns[:-1]:
        null_flag = null_flag | _q(name).isNull()
    reason = F.concat_ws(",", F.when(F.col("count") > 1, F.lit("duplicate")), F.when(null_flag, F.lit("null")))
    return grouped.where((F.col("count") > 1) | null_flag).withColumn("reason", reason)


def _join_cond(child: DataFrame, parent: DataFrame, child_cols: Sequence[str], parent_cols: Sequence[str]) -> Column:
    cond = None
    for c, p in zip(child_cols, parent_cols):
        term = child[c] == parent[p]
        cond = term if cond is None else cond & term
    return cond


def foreign_key_orphans(child: DataFrame, parent: DataFrame, child_cols: Sequence[str],
                        parent_cols: Sequence[str] | None = None) -> DataFrame:
    """Child rows whose non-null key has no parent row.

    A left-anti join on the key. The parent side is reduced to its distinct
    keys first (map-side partial aggregation). The planner broadcasts it only
    when its measured size is under ``spark.sql.autoBroadcastJoinThreshold``
    (AQE re-checks the actual size at run time); otherwise both sides shuffle
    on the key and AQE's skew-join handling splits an oversized child
    partition: a left-anti join may be cut on its child side, since a child
    row only needs the parent's key once.
    Rows with a null key are not orphans, as in SQL's MATCH SIMPLE.
    """
    parent_cols = list(parent_cols or child_cols)
    not_null = F.lit(True)
    for c in child_cols:
        not_null = not_null & _q(c).isNotNull()
    parent_keys = parent.select(*[_q(p) for p in parent_cols]).distinct()
    rows = child.where(not_null)
    return rows.join(parent_keys, _join_cond(rows, parent_keys, child_cols, parent_cols), "left_anti")


def cascade_delete(child: DataFrame, deleted_parents: DataFrame, child_cols: Sequence[str],
                   parent_cols: Sequence[str] | None = None) -> DataFrame:
    """Child rows that remain after the given parent rows are deleted with
    ``ON DELETE CASCADE``: those whose key matches no deleted parent."""
    parent_cols = list(parent_cols or child_cols)
    deleted = deleted_parents.select(*[_q(p) for p in parent_cols]).distinct()
    return child.join(deleted, _join_cond(child, deleted, child_cols, parent_cols), "left_anti")


def contract_flags(df: DataFrame, rules: Mapping[str, Column], out: str = FAILED_RULES) -> DataFrame:
    """Add ``out``: the names of the rules a row breaks (empty when none).
    A rule is a predicate that must be true; a null result counts as broken."""
    failed = [F.when(~F.coalesce(pred, F.lit(False)), F.lit(name)) for name, pred in rules.items()]
    return df.withColumn(out, F.array_compact(F.array(*failed)))


def split_rejects(df: DataFrame, errors_col: str = FAILED_RULES) -> tuple[DataFrame, DataFrame]:
    """(good rows without the errors column, rejected rows with it)."""
    good = df.where(F.size(errors_col) == 0).drop(errors_col)
    rejected = df.where(F.size(errors_col) > 0)
    return good, rejected


def split_by_contract(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    return split_rejects(contract_flags(df, rules))


def cleaning_failure_report(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """One row: per cleaned column, how many rows had a raw value but no
    cleaned value (``name -> (raw column, cleaned column)``)."""
    return df.agg(*[F.count_if(_q(raw).isNotNull() & _q(clean).isNull()).alias(name)
                    for name, (raw, clean) in pairs.items()])


def _report(required: Sequence[str], clean_pairs: Mapping[str, tuple[str, str]] | None,
            rules: Mapping[str, Column] | None) -> list[Column]:
    aggs = [F.count(F.lit(1)).alias("row_count")]
    aggs += [F.count_if(_q(c).isNull()).alias(f"nulls_{c}") for c in required]
    aggs += [F.count_if(_q(raw).isNotNull() & _q(clean).isNull()).alias(f"failed_{name}")
             for name, (raw, clean) in (clean_pairs or {}).items()]
    aggs += [F.count_if(~F.coalesce(pred, F.lit(False))).alias(f"broken_{name}")
             for name, pred in (rules or {}).items()]
    return aggs


def quality_report(df: DataFrame, required: Sequence[str] = (), clean_pairs: Mapping[str, tuple[str, str]] | None = None,
                   rules: Mapping[str, Column] | None = None) -> DataFrame:
    """Several checks in one aggregate pass, as one row: ``row_count``,
    ``nulls_<col>`` for each required column, ``failed_<name>`` for each
    ``(raw, cleaned)`` pair whose raw value did not clean, and
    ``broken_<rule>`` for each contract rule (null counts as broken)."""
    return df.agg(*_report(required, clean_pairs, rules))


LEVEL = "level"


def quality_rollup(df: DataFrame, by: Sequence[str], required: Sequence[str] = (),
                   clean_pairs: Mapping[str, tuple[str, str]] | None = None,
                   rules: Mapping[str, Column] | None = None) -> DataFrame:
    """:func:`quality_report` for every group of ``by``, every coarser group
    (``by`` without its last columns) and the whole table, in one pass.

    ``level`` is the grouping id: 0 for the finest groups, 2^n - 1 for the
    table; it tells a total's null from a null that the data hold. Tasks hand
    on one row for each group they saw and each of its totals, so a group that
    holds a third of the rows costs no more than another.
    """
    return df.rollup(*[_q(c) for c in by]).agg(F.grouping_id().cast("int").alias(LEVEL),
                                               *_report(required, clean_pairs, rules))


def unparsed_rows(df: DataFrame, raw: str, cleaned: str, marker: str | None = None) -> DataFrame:
    """Rows whose raw value failed to clean, leaving out a known marker
    (such as ``not a date``) that is meant to become null."""
    cond = _q(cleaned).isNull() & _q(raw).isNotNull()
    if marker is not None:
        cond = cond & (_q(raw) != F.lit(marker))
    return df.where(cond)


def row_cap(df: DataFrame, n: int, order_by: Sequence[str | Column]) -> DataFrame:
    """The first ``n`` rows in ``order_by`` order: a repeatable cap. Planned as
    a per-partition top-n merged once (no full sort)."""
    return df.orderBy(*order_by).limit(n)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Latest row per key: largest ``order_by`` (nulls last), the remaining
    columns breaking ties in descending order.

    Computed as ``max(struct(order_by..., rest...))`` per key, an aggregate
    with a map-side partial step: a key holding a third of the rows reduces
    to one candidate per task before the shuffle. (A plain window over the
    key would move every row of that key into one task; Spark 4 spares
    ``row_number() = 1`` that with a partial group limit, see SKEW.md.)
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    best = F.max(F.struct(*[_q(c) for c in [*order_by, *rest]])).alias("_lw_best")
    return (df.groupBy(*[_q(k) for k in keys]).agg(best)
            .select(*[_q(c) for c in keys], *[F.col(f"_lw_best.`{c}`").alias(c) for c in [*order_by, *rest]])
            .select(*[_q(c) for c in df.columns]))


@dataclass
class Profile:
    """Outcome of :func:`profile`: counts from one aggregate pass."""

    row_count: int
    null_counts: dict[str, int]
    key_groups: int | None

    approximate: bool = False

    @property
    def has_duplicate_keys(self) -> bool | None:
        """True or False where it is known; None where keys were not counted,
        or a sketch's count is too near the row count to tell."""
        if self.key_groups is None:
            return None
        if self.approximate:  # a sketch can show many duplicates, never their absence
            return True if self.key_groups < 0.97 * self.row_count else None
        return self.key_groups < self.row_count


def profile(df: DataFrame, key: str | None = None, cols: Iterable[str] | None = None,
            unique_check: str = "exact") -> Profile:
    """Row count, null count per column and, when ``key`` is given, the number
    of distinct key groups (nulls forming one group) - all in one aggregate.

    ``unique_check="exact"`` counts distinct keys exactly (the keys are
    shuffled once, after a map-side de-duplication); ``"approx"`` uses a
    HyperLogLog sketch (about 1% error, nothing but fixed-size sketches is
    shuffled), which can show duplicates but never rule them out; ``"off"``
    skips it.
    """
    if unique_check not in ("exact", "approx", "off"):
        raise ValueError("unique_check must be 'exact', 'approx' or 'off'")
    if unique_check == "off":
        key = None
    cols = list(cols) if cols is not None else df.columns
    aggs = [F.count(F.lit(1)).alias("row_count"), *[F.count_if(_q(c).isNull()).alias(c) for c in cols]]
    if key is not None:
        distinct = F.count_distinct(_q(key)) if unique_check == "exact" else F.approx_count_distinct(_q(key), 0.01)
        aggs.append(distinct.alias("_lw_distinct"))
        aggs.append(F.max(_q(key).isNull().cast("int")).alias("_lw_has_null"))
    row = df.agg(*aggs).first()
    groups = None
    if key is not None:
        groups = int(row["_lw_distinct"]) + int(row["_lw_has_null"] or 0)
    return Profile(int(row["row_count"]), {c: int(row[c]) for c in cols}, groups, unique_check == "approx")
