"""CSV read record by record: rows that do not fit the header are set aside
with their raw text and a reason instead of being padded, cut or misread.

Every reader here returns the header's columns as text, and beside them

* ``_raw``: the raw record of a malformed row, else null;
* ``_reason``: ``short`` (fewer fields than the header), ``long`` (more),
  ``broken_quote`` (a quoted field that is never closed, or goes on after its
  closing quote), else null.

Two dialects, as in :func:`lakewash.sources.readers.read_csv`:

* records of one line (``multiLine`` false): lines are read as text, so files
  split like any text file, and parsed natively; a broken quote spoils its own
  line and no other.
* fields that span lines (``multiLine`` true): Spark's reader, one task a file,
  as only it knows where a record ends. A quote that is never closed reads on
  into the lines after it; the record that results is set aside as a whole.
  Its raw text is what the reader kept, or, where the number of fields
  happened to fit, its fields as read.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewash.sources.readers import CSV_DIALECT, _opts, read_csv

RAW, REASON = "_raw", "_reason"
FILE = "_file"
_BROKEN = "_lw_broken"


def _dialect(options: Mapping[str, object] | None) -> dict[str, str]:
    given = _opts(options)
    if "sep" in given:
        given["delimiter"] = given.pop("sep")
    return {**CSV_DIALECT, **given}


def header_columns(spark: SparkSession, path: str, options: Mapping[str, object] | None = None) -> list[str]:
    """Column names of the files at ``path`` (reads one header line)."""
    return read_csv(spark, path, options).columns


def _text_schema(columns: Sequence[str], *more: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in [*columns, *more]])


def _without_quoted(raw: Column, dialect: Mapping[str, str]) -> Column:
    """A record with its well-formed quoted fields emptied, so that separators
    and quotes which remain are no field's content."""
    q, s, e = (re.escape(dialect[k]) for k in ("quote", "delimiter", "escape"))
    inner = f"[^{q}]*+(?:{q}{q}[^{q}]*+)*+" if q == e else f"(?:[^{q}{e}]|{e}.)*+"
    emptied = F.regexp_replace(raw, f"(?s)(^|{s}){q}{inner}{q}(?={s}|$)", "$1")
    return F.when(F.instr(raw, dialect["quote"]) > 0, emptied).otherwise(raw)


def _reason(raw: Column, malformed: Column, broken: Column, n: int, dialect: Mapping[str, str]) -> Column:
    bare = _without_quoted(raw, dialect)
    fields = F.size(F.split(bare, re.escape(dialect["delimiter"]), -1))
    return (F.when(broken, F.lit("broken_quote"))
            .when(malformed, F.when(fields < n, F.lit("short")).otherwise(F.lit("long"))))


def _opens(raw: Column, dialect: Mapping[str, str]) -> Column:
    """Whether a field still begins with a quote once well-formed ones are gone."""
    q, s = re.escape(dialect["quote"]), re.escape(dialect["delimiter"])
    return F.coalesce(_without_quoted(raw, dialect).rlike(f"(^|{s}){q}"), F.lit(False))


def parse_lines(lines: DataFrame, columns: Sequence[str], options: Mapping[str, object] | None = None) -> DataFrame:
    """Records of one line each: ``lines`` has a text column ``value`` (other
    columns are kept, after the record's). Blank lines are no records. Header
    lines, those whose fields are the column names, are left out."""
    dialect = _dialect(options)
    names = [f"c{i}" for i in range(len(columns))]
    read = {k: v for k, v in dialect.items() if k not in ("header", "multiLine", "enforceSchema", "lineSep")}
    raw = F.regexp_replace("value", "^﻿", "")  # a byte order mark is no part of the first name
    parsed = F.from_csv(raw, _text_schema(names, "bad").simpleString()[len("struct<"):-1].replace(":", " "),
                        {**read, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"})
    kept = [c for c in lines.columns if c != "value"]
    rows = lines.where(F.length("value") > 0).select(raw.alias(RAW), parsed.alias("_lw_row"), *kept)
    is_header = F.lit(dialect["header"] == "true")
    for name, column in zip(names, columns):
        is_header = is_header & F.col(f"_lw_row.{name}").eqNullSafe(F.lit(column))
    broken = _opens(F.col(RAW), dialect)
    malformed = F.col("_lw_row.bad").isNotNull()
    reason = _reason(F.col(RAW), malformed, broken, len(columns), dialect)
    fields = [F.col(f"_lw_row.{name}").alias(column) for name, column in zip(names, columns)]
    out = rows.where(~is_header).select(*fields, F.col(RAW), reason.alias(REASON), *kept)
    return out.withColumn(RAW, F.when(F.col(REASON).isNotNull(), F.col(RAW)))


def _mark(read: DataFrame, columns: Sequence[str], dialect: Mapping[str, str], kept: Sequence[str]) -> DataFrame:
    """Reasons for rows of Spark's multi-line reader. A field that begins with
    a quote and holds a line break is what the reader makes of a quote that it
    never saw closed."""
    swallowed = F.lit(False)
    for c in columns:
        v = F.col(f"`{c}`")
        swallowed = swallowed | (v.startswith(dialect["quote"]) & v.rlike("[\\r\\n]"))
    swallowed = F.coalesce(swallowed, F.lit(False))
    malformed = F.col(RAW).isNotNull()
    broken = swallowed | (malformed & _opens(F.col(RAW), dialect))
    as_read = F.concat_ws(dialect["delimiter"], *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in columns])
    reason = _reason(F.col(RAW), malformed, broken, len(columns), dialect)
    out = read.select(*[F.col(f"`{c}`") for c in columns], F.col(RAW), reason.alias(REASON), *kept)
    return out.withColumn(RAW, F.when(F.col(REASON).isNotNull(), F.coalesce(F.col(RAW), as_read)))


def read_csv_records(spark: SparkSession, path: str, options: Mapping[str, object] | None = None,
                     columns: Sequence[str] | None = None) -> DataFrame:
    """CSV files as records (see the module text). ``columns`` names the header
    where it is known; otherwise one header line is read. ``_file`` names the
    file of a row. A file whose header has the same names in another order is
    an error in the multi-line dialect; in the one-line dialect, ask
    :func:`files_without_header`."""
    dialect = _dialect(options)
    columns = list(columns or header_columns(spark, path, options))
    at = F.col("_metadata.file_path").alias(FILE)
    if dialect["multiLine"] != "true":
        reader = spark.read.option("lineSep", dialect["lineSep"]) if "lineSep" in dialect else spark.read
        return parse_lines(reader.text(path).select("value", at), columns, options)
    read = (spark.read.format("csv").options(**dialect).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", RAW).schema(_text_schema(columns, RAW)).load(path))
    return _mark(read.select("*", at), columns, dialect, [FILE])


def stream_csv_records(spark: SparkSession, path: str, columns: Sequence[str],
                       options: Mapping[str, object] | None = None,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """:func:`read_csv_records` on files that land in a folder."""
    dialect = _dialect(options)
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if dialect["multiLine"] != "true":
        if "lineSep" in dialect:
            reader = reader.option("lineSep", dialect["lineSep"])
        return parse_lines(reader.text(path), columns, options)
    read = (reader.format("csv").options(**dialect).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", RAW).schema(_text_schema(columns, RAW)).load(path))
    return _mark(read, columns, dialect, [])


def files_without_header(spark: SparkSession, path: str, columns: Sequence[str],
                         options: Mapping[str, object] | None = None) -> DataFrame:
    """``(file, first_line)`` of files whose first line is not the header: a
    file with its columns in another order would be read by position. One
    aggregate over the lines, one row a file."""
    dialect = _dialect(options)
    place = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    lines = spark.read.text(path).where(F.length("value") > 0).select(
        "value", F.col("_metadata.file_path").alias("file"), place.alias("place"))
    first = lines.groupBy("file").agg(F.min_by("value", "place").alias("value"))
    read = {**dialect, "header": "true"}
    other = parse_lines(first.select("value", "file", F.col("value").alias("first_line")), columns, read)
    return other.select("file", "first_line")


def good_records(records: DataFrame) -> DataFrame:
    """The rows that fit the header, without the columns of this module."""
    return records.where(F.col(REASON).isNull()).drop(RAW, REASON, FILE)


def rejected_records(records: DataFrame) -> DataFrame:
    """``(raw, reason)`` and, where it is known, ``file`` of the others."""
    more = [F.col(FILE).alias("file")] if FILE in records.columns else []
    return records.where(F.col(REASON).isNotNull()).select(F.col(RAW).alias("raw"), F.col(REASON).alias("reason"), *more)
