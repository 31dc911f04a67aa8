"""Sinks: Parquet, Delta, CSV, JDBC, and a staged full refresh.

Every write counts its own rows with an ``Observation`` while it runs, so the
count costs no second pass over the data. Executors write in parallel; no
rows pass through the driver.
"""

from __future__ import annotations

import logging
import uuid
from typing import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewash.operators.fingerprint import (
    ContentMismatch, Fingerprint, fingerprint, require_same_content, write_fingerprinted,
)

log = logging.getLogger(__name__)

JDBC_MODES = {"fail": "errorifexists", "replace": "overwrite", "append": "append"}


class SinkUnavailable(RuntimeError):
    """The requested sink format is not on the classpath."""


def write_observed(df: DataFrame, write: Callable[[DataFrame], None], name: str = "written") -> int:
    """Run ``write`` on ``df`` and return the number of rows it wrote.

    ``write`` must run an action on the frame it is given (a save, an insert):
    the count arrives when that action finishes, and ``Observation.get`` waits
    for it.
    """
    obs = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
    write(df.observe(obs, F.count(F.lit(1)).alias("rows")))
    return int(obs.get["rows"])


def write_parquet(df: DataFrame, path: str, mode: str = "append", partition_by: Sequence[str] = (),
                  max_records_per_file: int | None = None, replace_partitions: bool = False) -> int:
    """Parquet write; ``max_records_per_file`` caps file size so a later read
    gets evenly sized splits (no row is dropped: a task just opens more files).

    ``replace_partitions`` overwrites only the partitions the new rows fall
    in (dynamic partition overwrite) and keeps the rest: partitioned by the
    run's load time, a re-run of the same run replaces its own rows instead
    of adding them twice.
    """
    if replace_partitions and not partition_by:
        raise ValueError("replace_partitions needs partition_by")

    def go(d: DataFrame) -> None:
        w = d.write.mode("overwrite" if replace_partitions else mode)
        if replace_partitions:
            w = w.option("partitionOverwriteMode", "dynamic")
        if max_records_per_file:
            w = w.option("maxRecordsPerFile", str(max_records_per_file))
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
    return write_observed(df, go, "parquet")


# What the flat-record dialect reads back unchanged: quotes doubled, padding
# kept, and a mark for null, so that an empty text stays one.
CSV_NULL = "\\N"
CSV_SINK_DIALECT = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
                    "ignoreTrailingWhiteSpace": "false", "nullValue": CSV_NULL}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True,
              options: Mapping[str, str] | None = None, max_records_per_file: int | None = None) -> int:
    """CSV in the dialect of :data:`CSV_SINK_DIALECT`; read it back with
    ``read_csv(spark, path, CSV_SINK_DIALECT)``. Only the text ``\\N`` itself
    cannot be told from null."""
    def go(d: DataFrame) -> None:
        w = d.write.mode(mode).option("header", str(header).lower()).options(**{**CSV_SINK_DIALECT, **(options or {})})
        if max_records_per_file:
            w = w.option("maxRecordsPerFile", str(max_records_per_file))
        w.csv(path)
    return write_observed(df, go, "csv")


def write_table(df: DataFrame, table: str, mode: str = "overwrite", bucket_by: Sequence[str] = (),
                num_buckets: int | None = None, sort_by: Sequence[str] = (), partition_by: Sequence[str] = (),
                fmt: str = "parquet", path: str | None = None) -> int:
    """Save as a catalog table, optionally bucketed (and sorted) on a key;
    with ``path`` the table's files live there instead of the warehouse.

    Tables bucketed on the same key with the same bucket count join and
    aggregate on that key without a shuffle - e.g. the foreign-key checks
    between a parent table and its children. The rows are dealt out by the
    bucket key first, so each bucket is one file. Choose the bucket count from
    the table's size (a bucket should fit one task); for a key that holds more
    than a task's share, do not bucket on it: an unbucketed table shuffles
    when joined, and adaptive execution splits that key there.
    """
    if bucket_by and not num_buckets:
        raise ValueError("bucket_by needs num_buckets")

    def go(d: DataFrame) -> None:
        if bucket_by:
            d = d.repartition(num_buckets, *bucket_by)
        w = d.write.mode(mode).format(fmt)
        if path:
            w = w.option("path", path)
        if partition_by:
            w = w.partitionBy(*partition_by)
        if bucket_by:
            w = w.bucketBy(num_buckets, *bucket_by)
            if sort_by:
                w = w.sortBy(*sort_by)
        w.saveAsTable(table)
    return write_observed(df, go, "table")


def write_delta(df: DataFrame, path: str, mode: str = "append") -> int:
    """Append to a Delta table; raises :class:`SinkUnavailable` when the Delta
    package is not installed in the session."""
    try:
        return write_observed(df, lambda d: d.write.format("delta").mode(mode).save(path), "delta")
    except Exception as err:  # the data source lookup fails before any row is written
        text = str(err)
        if "DATA_SOURCE_NOT_FOUND" in text or "Failed to find the data source" in text \
                or "delta" in text.lower() and "ClassNotFound" in text:
            raise SinkUnavailable("the 'delta' format is not available: add the delta-spark package "
                                  "to the session (spark.jars.packages) to write Delta tables") from err
        raise


def write_data(df: DataFrame, output_path: str, storage_format: str,
               partition_by: Sequence[str] = (), max_records_per_file: int | None = None) -> int:
    """``delta`` and ``parquet`` append; any other format writes CSV with a
    header, replacing what was there. Returns the rows written."""
    if storage_format == "delta":
        rows = write_delta(df, output_path)
    elif storage_format == "parquet":
        rows = write_parquet(df, output_path, "append", partition_by, max_records_per_file)
    else:
        log.warning("No writer for format %r: the rows go to CSV files.", storage_format)
        rows = write_csv(df, output_path, "overwrite", max_records_per_file=max_records_per_file)
    log.info("%s now holds %d more rows.", output_path, rows)
    return rows


def empty_as_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Empty strings become null in the given (default: all string) columns,
    the convention of a ``NULL AS ''`` bulk load."""
    targets = set(cols) if cols is not None else {
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(*[F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) if c in targets else F.col(f"`{c}`")
                       for c in df.columns])


def jdbc_mode(if_exists: str) -> str:
    try:
        return JDBC_MODES[if_exists]
    except KeyError:
        raise ValueError(f"if_exists must be one of {sorted(JDBC_MODES)}, not {if_exists!r}") from None


def jdbc_writer_options(properties: Mapping[str, str] | None, num_partitions: int | None,
                        batch_size: int, truncate: bool) -> dict[str, str]:
    opts = {"batchsize": str(batch_size), "truncate": str(truncate).lower()}
    if num_partitions:
        opts["numPartitions"] = str(num_partitions)
    opts.update(properties or {})
    return opts


def load_jdbc(df: DataFrame, url: str, table: str, if_exists: str = "replace",
              properties: Mapping[str, str] | None = None, num_partitions: int | None = None,
              batch_size: int = 10000, truncate: bool = False) -> int:
    """Load a table over JDBC: ``fail``, ``replace`` or ``append`` when it
    exists. Executors insert their partitions in parallel (at most
    ``num_partitions`` connections); each partition commits on its own, so use
    :func:`staged_refresh_jdbc` when the load must be all-or-nothing."""
    mode = jdbc_mode(if_exists)
    opts = jdbc_writer_options(properties, num_partitions, batch_size, truncate)

    def go(d: DataFrame) -> None:
        d.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table).options(**opts).save()
    return write_observed(df, go, "jdbc")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library's own making, wherever it lives."""
    fs, hpath = _fs(spark, path)
    fs.delete(hpath, True)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder to the place of ``target``. What stands there steps aside
    under a name that readers of the parent folder pass over, and is deleted
    once the new folder is in place."""
    fs, src = _fs(spark, source)
    dst = _fs(spark, target)[1]
    aside = _fs(spark, f"{dst.getParent()}/_old-{uuid.uuid4().hex}")[1]
    had = fs.exists(dst)
    if had and not fs.rename(dst, aside):
        raise OSError(f"{target} could not be moved aside")
    try:
        if not fs.rename(src, dst):
            raise OSError(f"{source} could not be moved to {target}")
    except Exception:
        if had:
            fs.rename(aside, dst)
        raise
    if had:
        fs.delete(aside, True)


class StagedSink:
    """A sink in two steps: rows are written and compared first, and only then
    shown to readers. A job that finds something wrong between the two steps
    discards them, and the target is as it was."""

    def stage(self, df: DataFrame) -> Fingerprint:
        raise NotImplementedError

    def publish(self) -> None:
        raise NotImplementedError

    def discard(self) -> None:
        raise NotImplementedError


# Formats that read back every value as it was written.
_TYPED = {"parquet", "orc"}


class StagedFolder(StagedSink):
    """Full refresh of a file table: all new rows or all old ones.

    The rows are written once, in parallel, to a fresh folder beside the
    target; their fingerprint is observed as they go and compared with that of
    the rows in the folder (in formats that store no types, the number of
    rows). Two renames on the file system then swap the folders: the old rows
    step aside and the new ones take their place. If the second rename fails,
    the old rows are moved back; nothing is deleted before the new rows are in
    place. An object store renames by copying: use a
    :class:`~lakewash.sources.versions.VersionedTable` there.
    """

    def __init__(self, target_path: str, fmt: str = "parquet"):
        self.target, self.fmt = target_path.rstrip("/"), fmt
        self._spark: SparkSession | None = None
        self._staging = ""

    def _save(self, df: DataFrame, path: str) -> None:
        df.write.mode("errorifexists").format(self.fmt).save(path)

    def stage(self, df: DataFrame) -> Fingerprint:
        self._spark, self._staging = df.sparkSession, f"{self.target}.staging-{uuid.uuid4().hex}"
        try:
            source = write_fingerprinted(df, lambda d: self._save(d, self._staging))
            stored = self._spark.read.format(self.fmt).schema(df.schema).load(self._staging)
            if self.fmt in _TYPED:
                require_same_content(source, fingerprint(stored), self.target)
            elif stored.count() != source.rows:
                raise ContentMismatch(f"{self.target}: {source.rows} rows were written and another number is stored")
        except Exception:
            self.discard()
            raise
        return source

    def discard(self) -> None:
        remove_path(self._spark, self._staging)  # only this sink's own folder

    def publish(self) -> None:
        swap_folder(self._spark, self._staging, self.target)
        self._spark.catalog.refreshByPath(self.target)


def swap_folder(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder in the place of another one, which steps aside first and
    goes last; if the new one can't take its place, the old one comes back."""
    fs, new = _fs(spark, source)
    final, old = (_fs(spark, p)[1] for p in (target, f"{target}.old-{uuid.uuid4().hex}"))
    had_rows = fs.exists(final)
    if had_rows and not fs.rename(final, old):
        raise OSError(f"{target} could not be moved aside; the new rows are in {source}")
    try:
        if not _rename(fs, new, final):
            raise OSError(f"{source} could not take the place of {target}")
    except Exception:
        if had_rows:
            fs.rename(old, final)
        raise
    if had_rows:
        fs.delete(old, True)


def staged_refresh(df: DataFrame, target_path: str, fmt: str = "parquet") -> dict:
    """Full refresh of a file table in one go, by a :class:`StagedFolder`."""
    sink = StagedFolder(target_path, fmt)
    rows = sink.stage(df).rows
    sink.publish()
    return {"staged_rows": rows, "dest_rows": rows}


def _rename(fs, source, target) -> bool:
    return fs.rename(source, target)


def staged_refresh_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None,
                        num_partitions: int | None = None) -> dict:
    """All-or-nothing refresh of a database table.

    The rows go in parallel to a staging table of a name of its own
    (executors, many connections). The driver then runs one short SQL-only transaction - delete
    the target's rows, insert them from staging, drop staging - so no row
    crosses the driver, and a failure rolls back to the old rows.
    """
    spark = df.sparkSession
    staging = f"{table}_staging_{uuid.uuid4().hex[:12]}"
    rows = load_jdbc(df, url, staging, "fail", properties, num_partitions)
    columns = ", ".join('"' + c.replace('"', '""') + '"' for c in df.columns)
    props = dict(properties or {})
    jvm = spark.sparkContext._jvm
    if "driver" in props:  # load it where --jars / --packages put it
        loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
        jvm.java.lang.Class.forName(props["driver"], True, loader)
    jprops = jvm.java.util.Properties()
    for k, v in props.items():
        jprops.setProperty(k, v)
    conn = jvm.java.sql.DriverManager.getConnection(url, jprops)
    try:
        conn.setAutoCommit(False)
        stmt = conn.createStatement()
        stmt.executeUpdate(f"DELETE FROM {table}")
        inserted = stmt.executeUpdate(f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {staging}")
        if inserted != rows:
            raise AssertionError(f"inserted {inserted} rows from staging, expected {rows}")
        stmt.executeUpdate(f"DROP TABLE {staging}")
        conn.commit()
    except Exception:
        conn.rollback()
        raise
    finally:
        conn.close()
    return {"staged_rows": rows, "dest_rows": inserted}
