"""Content fingerprints: one small value for a table's rows, whatever their
order, so that two copies of a table can be compared without joining them.

A row gives two 64-bit hashes of its values; the fingerprint is the number of
rows and the sum of either hash, as decimals that hold the sum exactly for up
to 10^19 rows. Sums do not depend on order or partitioning, and unlike an
exclusive-or they count repeated rows. Two tables that differ in any row agree
in both sums with a chance of about 2^-128; the hashes are not meant to stop
someone who makes rows collide on purpose.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

SUM_TYPE = "decimal(38,0)"


class ContentMismatch(AssertionError):
    """The stored rows are not the rows that were handed over."""


@dataclass(frozen=True)
class Fingerprint:
    rows: int
    first: int
    second: int


def _value(name: str, kind: T.DataType, as_text: bool) -> Column:
    col = F.col(f"`{name}`")
    if isinstance(kind, T.MapType):  # maps have no order, and no hash
        return F.to_json(F.array_sort(F.map_entries(col)))
    return col.cast("string") if as_text else col


def _marked(df: DataFrame, columns: Sequence[str], as_text: bool) -> list[Column]:
    """The values of a row, each beside a mark of whether it is null: Spark's
    hash passes over nulls, so (null, 'a') and ('a', null) would agree."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    values = [_value(c, kinds[c], as_text) for c in columns]
    return [x for v in values for x in (v.isNull(), v)]


def fingerprint_columns(df: DataFrame, columns: Sequence[str] | None = None, as_text: bool = False) -> list[Column]:
    """The three aggregates of a fingerprint: ``rows``, ``first``, ``second``.
    Columns are taken in the given order (default: by name, so that a reader
    that orders columns otherwise agrees). ``as_text`` compares the texts of
    values, for sinks such as CSV that store no types."""
    columns = sorted(df.columns) if columns is None else list(columns)
    marked = _marked(df, columns, as_text)
    hashes = F.xxhash64(F.lit("first"), *marked), F.xxhash64(F.lit("second"), *reversed(marked))
    sums = [F.coalesce(F.sum(h.cast(SUM_TYPE)), F.lit(0).cast(SUM_TYPE)) for h in hashes]
    return [F.count(F.lit(1)).alias("rows"), sums[0].alias("first"), sums[1].alias("second")]


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None, as_text: bool = False) -> Fingerprint:
    """The fingerprint of a frame: one aggregate with a map-side step."""
    row = df.agg(*fingerprint_columns(df, columns, as_text)).first()
    return Fingerprint(int(row["rows"]), int(row["first"]), int(row["second"]))


def write_fingerprinted(df: DataFrame, write: Callable[[DataFrame], None], columns: Sequence[str] | None = None,
                        as_text: bool = False) -> Fingerprint:
    """Run ``write`` on ``df`` and return the fingerprint of the rows that were
    handed to it, observed while they were written: no second pass. Rows of a
    task that was tried again count once."""
    seen = Observation(f"content-{uuid.uuid4().hex[:8]}")
    write(df.observe(seen, *fingerprint_columns(df, columns, as_text)))
    got = seen.get
    return Fingerprint(int(got["rows"]), int(got["first"]), int(got["second"]))


def require_same_content(source: Fingerprint, stored: Fingerprint, what: str) -> None:
    if source.rows != stored.rows:
        raise ContentMismatch(f"{what}: {source.rows} rows were handed over and {stored.rows} are stored")
    if source != stored:
        raise ContentMismatch(f"{what}: the number of rows agrees ({source.rows}), their content does not")


def reconcile(source: DataFrame, stored: DataFrame, columns: Sequence[str] | None = None,
              as_text: bool = False) -> DataFrame:
    """One row: ``source_rows``, ``stored_rows``, ``same_rows``,
    ``same_content``. Both sides are one aggregate each, brought together as
    two rows, so nothing is joined."""
    sides = []
    for name, df in (("source", source), ("stored", stored)):
        sides.append(df.agg(*fingerprint_columns(df, columns, as_text)).withColumn("side", F.lit(name)))
    both = sides[0].unionByName(sides[1])

    def of(side: str, value: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col(value)))
    agree = [of("source", v) == of("stored", v) for v in ("rows", "first", "second")]
    return both.agg(of("source", "rows").alias("source_rows"), of("stored", "rows").alias("stored_rows"),
                    agree[0].alias("same_rows"), (agree[0] & agree[1] & agree[2]).alias("same_content"))
