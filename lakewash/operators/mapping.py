"""Projection and schema shaping.

A mapping is always applied as a single ``select`` (never a ``withColumn``
loop), so Catalyst sees one projection it can collapse and prune.
"""

from __future__ import annotations

import re
from typing import Callable, Mapping, Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MappingValue = Union[str, Column, Callable[[DataFrame], Column]]

# --- fixed values: column-name tidying rules, applied in this order ----------
NAME_DROP_LITERAL = r"\(dd/mm/yyyy\)"
NAME_INVALID_CHARS = r"[^a-zA-Z0-9_]"
NAME_REPEATED_UNDERSCORE = r"_+"
# --- end of fixed values ------------------------------------------------------


def _as_column(df: DataFrame, value: MappingValue) -> Column:
    if callable(value) and not isinstance(value, Column):
        value = value(df)
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        return F.col(value)
    raise ValueError(f"a mapping value must be a column name, a Column or a function of the frame, not {value!r}")


def _extended(df: DataFrame, mapping: Mapping[str, MappingValue]) -> list[tuple[str, MappingValue]]:
    """(output name, value) of every column of an extending mapping: where
    each lower-cased name first occurs among the frame's columns and then the
    keys, with the last thing said about it."""
    said: list[tuple[str, MappingValue]] = [(c, F.col(f"`{c}`")) for c in df.columns] + list(mapping.items())
    last = {name.lower(): (name, value) for name, value in said}
    return [last[name] for name in dict.fromkeys(name.lower() for name, _ in said)]


def apply_mapping(df: DataFrame, mapping: Mapping[str, MappingValue], extend: bool = False) -> DataFrame:
    """Declarative projection: output name -> column name, ``Column``, or a
    function of the frame returning a ``Column``.

    ``extend=False`` keeps only the mapped columns, all of them, in mapping
    order; keys that differ only in case stay two columns. ``extend=True``
    keeps every input column in place, replacing those whose name matches a
    key (case-insensitive, the key's case wins) and appending the remaining
    keys at the end; there, keys differing only in case are one column.
    """
    plan = _extended(df, mapping) if extend else list(mapping.items())
    return df.select(*[_as_column(df, value).alias(name) for name, value in plan])


def normalize_name(name: str) -> str:
    """``Start (dd/mm/yyyy)`` -> ``start``; ``Paid  Amount ($)`` -> ``paid_amount``."""
    name = re.sub(NAME_DROP_LITERAL, "", name)
    name = re.sub(NAME_INVALID_CHARS, "_", name)
    name = re.sub(NAME_REPEATED_UNDERSCORE, "_", name)
    return name.lower().strip("_")


def normalize_columns(df: DataFrame) -> DataFrame:
    """Tidy every column name (metadata only; no data is touched).

    Names that collide or become empty raise ``ValueError`` listing them.
    """
    names = [normalize_name(c) for c in df.columns]
    problems = [f"{orig!r} -> empty" for orig, new in zip(df.columns, names) if not new]
    seen: dict[str, list[str]] = {}
    for orig, new in zip(df.columns, names):
        seen.setdefault(new, []).append(orig)
    problems += [f"{origs} -> {new!r}" for new, origs in seen.items() if new and len(origs) > 1]
    if problems:
        raise ValueError("column names cannot be normalised: " + "; ".join(problems))
    return df.toDF(*names)


def derive_columns(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add or replace several columns in one projection."""
    return df.withColumns(dict(columns))


def keep_original(name: str, cleaned: Column, source: str | None = None) -> dict[str, MappingValue]:
    """Two mapping entries: the raw value as ``<name>_ori`` and the cleaned one."""
    return {f"{name}_ori": source or name, name: cleaned}


def require_columns(df: DataFrame, required: list[str]) -> None:
    """Fail early when a required column is missing (no Spark job)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise AssertionError(f"the input lacks these columns: {missing}")


def to_zoneless(df: DataFrame) -> DataFrame:
    """Cast every ``timestamp`` column to ``timestamp_ntz`` for a sink whose
    columns carry no zone (the session zone is pinned to UTC)."""
    cols = [F.col(f"`{f.name}`").cast(T.TimestampNTZType()).alias(f.name)
            if isinstance(f.dataType, T.TimestampType) else F.col(f"`{f.name}`")
            for f in df.schema.fields]
    return df.select(*cols)


CONFORM_ERRORS = "_conform_errors"


def conform_to_schema(df: DataFrame, target: T.StructType, errors_col: str = CONFORM_ERRORS) -> DataFrame:
    """Shape a frame to a target table: its columns, in its order, with its
    types (``try_cast``). Missing columns become typed nulls; extra columns
    are dropped. ``errors_col`` lists, per row, the columns whose non-null
    value did not fit the type, or that are null but declared not nullable.
    Split good and rejected rows with :func:`lakewash.operators.quality.split_rejects`.
    """
    by_lower = {c.lower(): c for c in df.columns}
    out: list[Column] = []
    failures: list[Column] = []
    for field in target.fields:
        src = by_lower.get(field.name.lower())
        if src is None:
            value = F.lit(None).cast(field.dataType)
            raw = F.lit(None)
        else:
            raw = F.col(f"`{src}`")
            value = raw if df.schema[src].dataType == field.dataType else raw.try_cast(field.dataType)
        out.append(value.alias(field.name))
        bad = raw.isNotNull() & value.isNull()
        if not field.nullable:
            bad = bad | value.isNull()
        failures.append(F.when(bad, F.lit(field.name)))
    errors = F.array_compact(F.array(*failures)) if failures else F.array().cast("array<string>")
    return df.select(*out, errors.alias(errors_col))
