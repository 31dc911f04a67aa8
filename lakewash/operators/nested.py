"""Nested records to relational tables.

All of these are narrow operators (no shuffle): a record's arrays are fanned
out inside the task that read the record.
"""

from __future__ import annotations

from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _struct_fields(df: DataFrame, path: str) -> list[str]:
    dtype = df.select(path).schema.fields[0].dataType
    if isinstance(dtype, T.ArrayType):
        dtype = dtype.elementType
    if not isinstance(dtype, T.StructType):
        raise TypeError(f"{path} is not a struct or an array of structs")
    return [f.name for f in dtype.fields]


def flatten_struct(df: DataFrame, struct_col: str, fields: Sequence[str] | None = None,
                   keep: Iterable[str | Column] = ()) -> DataFrame:
    """``keep`` columns followed by the struct's fields as top-level columns."""
    names = list(fields) if fields is not None else _struct_fields(df, struct_col)
    return df.select(*keep, *[F.col(f"{struct_col}.`{n}`").alias(n) for n in names])


def explode_scalars(df: DataFrame, keys: Sequence[str], array_col: str, alias: str,
                    position: str | None = None) -> DataFrame:
    """One row per array element, with the parent keys. Null and empty arrays
    give no rows; null elements give a row. ``position`` adds the element's
    0-based index, a stable handle for child ids."""
    if position:
        return df.select(*keys, F.posexplode(array_col).alias(position, alias))
    return df.select(*keys, F.explode(array_col).alias(alias))


def explode_structs(df: DataFrame, keys: Sequence[str], array_col: str,
                    fields: Sequence[str] | None = None, position: str | None = None) -> DataFrame:
    """One row per struct element, its fields flattened next to the keys."""
    names = list(fields) if fields is not None else _struct_fields(df, array_col)
    if position:
        fanned = df.select(*keys, F.posexplode(array_col).alias(position, "_element"))
        lead = [*keys, position]
    else:
        fanned = df.select(*keys, F.explode(array_col).alias("_element"))
        lead = list(keys)
    return fanned.select(*lead, *[F.col(f"_element.`{n}`").alias(n) for n in names])


def nested_to_relational(df: DataFrame, keys: Sequence[str], parent: Mapping[str, str],
                         scalar_children: Mapping[str, tuple[str, str]] | None = None,
                         struct_children: Mapping[str, str] | None = None,
                         position: str | None = None) -> dict[str, DataFrame]:
    """Split one nested source into a parent table and child tables.

    ``parent`` maps output names to (possibly dotted) source paths.
    ``scalar_children`` maps a child table name to ``(array path, value name)``;
    ``struct_children`` maps a child table name to an array-of-struct path.
    The frames share one read; persist ``df`` first when several are written.
    """
    out = {"parent": df.select(*keys, *[F.col(p).alias(n) for n, p in parent.items() if n not in keys])}
    for name, (path, value) in (scalar_children or {}).items():
        out[name] = explode_scalars(df, keys, path, value, position)
    for name, path in (struct_children or {}).items():
        out[name] = explode_structs(df, keys, path, position=position)
    return out
