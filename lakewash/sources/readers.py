"""Readers: CSV with a dialect, JSON with a declared nested schema, Parquet,
and JDBC. Every reader is lazy and runs on the executors; the path may be any
URI Hadoop understands (``file://``, ``s3a://``, ``abfss://``, ``hdfs://``).
"""

from __future__ import annotations

from typing import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT_RECORD = "_corrupt_record"

# Dialect of the flat-record files: header row, comma, double quote used both
# to quote and to escape, fields allowed to span lines.
CSV_DIALECT = {"header": "true", "delimiter": ",", "quote": '"', "escape": '"', "multiLine": "true",
               # a file whose header differs from the first file's is an error, never read by position
               "enforceSchema": "false"}


def _opts(options: Mapping[str, object] | None) -> dict[str, str]:
    out = {}
    for k, v in (options or {}).items():
        out[k] = str(v).lower() if isinstance(v, bool) else str(v)
    return out


def read_csv(spark: SparkSession, path: str, options: Mapping[str, object] | None = None,
             schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with the job's dialect (overridable through ``options``).

    Without a schema every column is read as text and typed later by the
    mapping; ``inferSchema`` stays available as an option, at the price of an
    extra pass and types that depend on the data. A multi-line file cannot be
    split, so one file is one task: parallelism comes from many files. Every
    file must have the first one's header; files with columns in another order
    are read with :func:`read_csv_by_name`.
    """
    reader = spark.read.format("csv").options(**{**CSV_DIALECT, **_opts(options)})
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def _header_of(spark: SparkSession, path: str, options: Mapping[str, object] | None) -> tuple[str, ...]:
    return tuple(read_csv(spark, path, {**(options or {}), "enforceSchema": "true"}).columns)


def read_csv_by_name(spark: SparkSession, path: str, options: Mapping[str, object] | None = None) -> DataFrame:
    """CSV files whose headers differ in order or columns, matched by name.

    Files are grouped by header (one header line read per file) and each group
    is read as usual; the groups are joined up by column name, and a column
    that a file lacks is null there. Use it for landing folders that several
    producers write to.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path"))
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in files.toLocalIterator():  # paths only
        groups.setdefault(_header_of(spark, row.path, options), []).append(row.path)
    out = None
    for paths in groups.values():
        part = spark.read.format("csv").options(**{**CSV_DIALECT, **_opts(options)}).load(paths)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise FileNotFoundError(f"no CSV file under {path}")
    return out


def read_json(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False,
              corrupt_col: str = CORRUPT_RECORD) -> DataFrame:
    """JSON (one record per line by default) with a declared schema.

    ``PERMISSIVE`` mode: a line that is not JSON, or whose values do not fit
    the schema, becomes a row with ``corrupt_col`` holding the raw text, so
    rejects can be set aside instead of failing the job.

    Spark parses only the fields a query uses, so a value that does not fit
    an unused field is not noticed. When rejects must be decided on the whole
    record, parse once into a staging table first
    (:func:`lakewash.plans.jobs.stage_nested_records` does this).
    """
    full = T.StructType([*schema.fields, T.StructField(corrupt_col, T.StringType(), True)])
    return (spark.read.schema(full)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", corrupt_col)
            .option("multiLine", str(multi_line).lower())
            .json(path))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _json(spark: SparkSession, path: str, options: Mapping[str, object] | None,
          schema: T.StructType | None) -> DataFrame:
    multi = str((options or {}).get("multiLine", "false")).lower() == "true"
    if schema is None:  # inferred: one extra pass over the input
        return spark.read.option("multiLine", str(multi).lower()).json(path)
    return read_json(spark, path, schema, multi_line=multi)


_READERS: dict[str, Callable[..., DataFrame]] = {
    "csv": lambda spark, path, options, schema: read_csv(spark, path, options, schema),
    "json": _json,
    "parquet": lambda spark, path, options, schema: read_parquet(spark, path),
}


def read_data(spark: SparkSession, path: str, file_format: str, options: Mapping[str, object] | None = None,
              schema: T.StructType | None = None) -> DataFrame:
    """Dispatch on ``file_format`` (``csv``, ``json``, ``parquet``); any other
    format raises ``ValueError``. JSON without a schema is inferred (an extra
    pass); with one, malformed lines are kept in ``_corrupt_record``."""
    if file_format not in _READERS:
        raise ValueError(f"{file_format!r} is not a supported input format; use one of {sorted(_READERS)}")
    return _READERS[file_format](spark, path, options, schema)


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when the path (or glob) matches something on its file system."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(hpath)
    return found is not None and len(found) > 0


def oversized_files(spark: SparkSession, path: str, max_bytes: int = 1 << 30) -> DataFrame:
    """Files under ``path`` larger than ``max_bytes``, with their ``length``.

    Reads file metadata only (the ``binaryFile`` source never loads the
    content when it is not selected). Meant for multi-line CSV and JSON,
    which Spark cannot split: each such file is read by a single task.
    """
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            .where(F.col("length") > max_bytes).select("path", "length"))


def require_path(spark: SparkSession, path: str) -> None:
    if not path_exists(spark, path):
        raise FileNotFoundError(f"nothing found at {path}")


def read_jdbc(spark: SparkSession, url: str, table: str, properties: Mapping[str, str] | None = None,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None,
              fetch_size: int = 10000) -> DataFrame:
    """Read a table (or a parenthesised subquery with an alias) over JDBC.

    Filters and projections on the result are pushed into the database's
    query. With ``partition_column`` and bounds, ``num_partitions`` executors
    read disjoint ranges in parallel.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table) \
        .option("fetchsize", str(fetch_size))
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or num_partitions is None:
            raise ValueError("partitioned JDBC reads need lower_bound, upper_bound and num_partitions")
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions)))
    return reader.load()
