"""Incremental loads with Structured Streaming.

The cleaners are stateless column expressions, so the flat-record mapping
runs unchanged on ``readStream``: each trigger picks up only files that the
checkpoint has not seen, cleans them and appends them. No watermark or state
store is involved.

Each micro-batch goes through ``foreachBatch``: it is written to a folder of its
own, the required-column null check observed on the way, and moved to
``batch_id=<n>`` if it holds (fatal if not, as in the batch job). A batch replayed
after a failure replaces exactly that folder, so the sink stays exactly-once.

Keys are followed over all batches in a :class:`~lakewash.streaming.keys.KeyTable`
under ``<checkpoint>/keys``: a row that arrives again keeps its id, another row
of a known key gets an id of its own, and ``key_table(...).duplicates()`` lists
the keys that came more than once.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakewash.operators.ids import OCCURRENCE, TIE, tagged
from lakewash.operators.mapping import apply_mapping, normalize_columns
from lakewash.plans.jobs import (
    FLAT_REQUIRED, NESTED_SCHEMA, NESTED_TABLES, flat_record_mapping, nested_rejects, protect,
)
from lakewash.session import pin_utc, scratch_path
from lakewash.sources.readers import CORRUPT_RECORD, read_csv
from lakewash.sources.records import RAW, REASON, rejected_records, stream_csv_records
from lakewash.sources.sinks import move_path, remove_path
from lakewash.streaming.keys import KeyTable

BATCH_COLUMN = "batch_id"


def text_schema_from_header(spark: SparkSession, sample_path: str,
                            options: Mapping[str, object] | None = None) -> T.StructType:
    """All-text schema named by the header of the files at ``sample_path``
    (reads the header line only)."""
    names = read_csv(spark, sample_path, options).columns
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def _now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def _batch_time(run_ts: datetime | str | None) -> datetime | str:
    """The load time of a batch: the caller's, or the batch's own."""
    return _now() if run_ts is None else run_ts


def _publish(df: DataFrame, output_dir: str, batch_id: int, required: Sequence[str] = ()) -> None:
    """Write one batch to a folder of its own and move it to
    ``batch_id=<n>`` only if no required value is null. The check is observed
    during the write, so the batch is read once; a replayed batch replaces its
    folder."""
    spark, base = df.sparkSession, output_dir.rstrip("/")
    staging, final = f"{base}/_batch-{batch_id}", f"{base}/{BATCH_COLUMN}={batch_id}"
    obs = Observation(f"batch-{uuid.uuid4().hex[:8]}")
    nulls = [F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in required]
    df.observe(obs, F.count(F.lit(1)).alias("rows"), *nulls).write.mode("overwrite").parquet(staging)
    seen = obs.get
    bad = {c: int(seen[f"n_{c}"]) for c in required if seen[f"n_{c}"]}
    if bad:
        remove_path(spark, staging)
        raise AssertionError(f"batch {batch_id}: null where a value is required (column: rows): {bad}")
    move_path(spark, staging, final)


def key_table(spark: SparkSession, checkpoint_dir: str) -> KeyTable:
    """The keys that a load has brought so far, kept beside its checkpoint."""
    return KeyTable(spark, f"{checkpoint_dir.rstrip('/')}/keys")


def _trigger(writer, available_now: bool, processing_time: str | None):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=processing_time or "1 minute")


def flat_record_source(spark: SparkSession, input_dir: str, schema: T.StructType,
                       options: Mapping[str, object] | None = None,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame of the raw flat records in CSV files landing in
    ``input_dir``, malformed ones marked (see
    :mod:`lakewash.sources.records`). In the multi-line dialect a file with
    another header than ``schema`` fails its batch."""
    pin_utc(spark)
    return stream_csv_records(spark, input_dir, schema.names, options, max_files_per_trigger)


def start_flat_record_load(spark: SparkSession, input_dir: str, output_dir: str, checkpoint_dir: str,
                           run_ts: datetime | str | None = None, schema: T.StructType | None = None,
                           available_now: bool = True, processing_time: str | None = None,
                           options: Mapping[str, object] | None = None, uuid_mode: str = "stable",
                           max_files_per_trigger: int | None = None,
                           rejects_dir: str | None = None) -> StreamingQuery:
    """Start the incremental load; ``available_now`` processes what has
    arrived, ``max_files_per_trigger`` files to a batch, and stops; otherwise
    it runs every ``processing_time``. Without ``run_ts`` each batch carries
    its own load time. Records that do not fit the header go to
    ``rejects_dir`` (default: ``<output_dir>-rejects``)."""
    schema = schema or text_schema_from_header(spark, input_dir, options)
    raw = flat_record_source(spark, input_dir, schema, options, max_files_per_trigger)

    rejects_dir = rejects_dir or f"{output_dir.rstrip('/')}-rejects"

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        session, when = spark, _batch_time(run_ts)  # the batch's own session has adaptive execution off
        names = normalize_columns(batch.drop(RAW, REASON)).columns
        named = batch.toDF(*names, RAW, REASON)
        staging = scratch_path(session, "flat-batch")  # rejects and keys are looked up in it: the files are parsed once
        try:
            named.withColumn(TIE, F.monotonically_increasing_id()).write.parquet(staging)
            staged = session.read.parquet(staging)
            good = staged.where(F.col(REASON).isNull()).drop(RAW, REASON)
            occurrence = None
            if uuid_mode == "stable":
                good = key_table(session, checkpoint_dir).number(
                    tagged(good, FLAT_REQUIRED[0], F.col(TIE)), names, FLAT_REQUIRED[0], batch_id)
                occurrence = F.col(OCCURRENCE)
            _publish(rejected_records(staged), rejects_dir, batch_id)
            _publish(apply_mapping(good, flat_record_mapping(when, uuid_mode, occurrence)),
                     output_dir, batch_id, FLAT_REQUIRED)
        finally:
            remove_path(session, staging)

    writer = raw.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint_dir)
    return _trigger(writer, available_now, processing_time).start()


def run_flat_record_load(spark: SparkSession, input_dir: str, output_dir: str, checkpoint_dir: str,
                         run_ts: datetime | str | None = None, **kwargs) -> StreamingQuery:
    """Process every file that has arrived since the last run, then stop."""
    query = start_flat_record_load(spark, input_dir, output_dir, checkpoint_dir, run_ts, **kwargs)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return query


def start_nested_record_load(spark: SparkSession, input_dir: str, output_dir: str, checkpoint_dir: str,
                             run_ts: datetime | str | None = None, available_now: bool = True,
                             processing_time: str | None = None, uuid_mode: str = "stable",
                             max_files_per_trigger: int | None = None) -> StreamingQuery:
    """The nested-record job on line-JSON files landing in ``input_dir``.

    Each micro-batch is protected (secrets masked or hashed) and staged first,
    so every field is parsed once and a line is rejected on the whole record;
    then the users, telephone-number and jobs-history tables and the rejects
    are written under ``output_dir/<table>/batch_id=<n>``, replaced whole
    when a batch is replayed, and the staging goes.
    """
    pin_utc(spark)
    full = T.StructType([*NESTED_SCHEMA.fields, T.StructField(CORRUPT_RECORD, T.StringType(), True)])
    reader = (spark.readStream.schema(full).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT_RECORD))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.json(input_dir)

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        session, when = spark, _batch_time(run_ts)  # the batch's own session has adaptive execution off
        staging = scratch_path(session, "nested-batch")
        safe = protect(batch)
        tags = tagged(safe, "user_id")
        try:
            tags.write.parquet(staging)
            records = session.read.schema(tags.schema).parquet(staging)
            good = records.where(F.col(CORRUPT_RECORD).isNull())
            if uuid_mode == "stable":
                good = key_table(session, checkpoint_dir).number(good, safe.columns, "user_id", batch_id)
            tables = {name: build(good, when, uuid_mode) for name, build in NESTED_TABLES.items()}
            tables["rejects"] = nested_rejects(records)
            for name, table in tables.items():
                _publish(table, f"{output_dir.rstrip('/')}/{name}", batch_id)
        finally:
            remove_path(session, staging)

    writer = stream.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint_dir)
    return _trigger(writer, available_now, processing_time).start()


def run_nested_record_load(spark: SparkSession, input_dir: str, output_dir: str, checkpoint_dir: str,
                           run_ts: datetime | str | None = None, **kwargs) -> StreamingQuery:
    """Process every JSON file that has arrived since the last run, then stop."""
    query = start_nested_record_load(spark, input_dir, output_dir, checkpoint_dir, run_ts, **kwargs)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return query
