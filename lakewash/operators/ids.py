"""Row identity: audit time, random and repeatable ids, dense surrogate
keys, and source-file lineage."""

from __future__ import annotations

import uuid
from datetime import datetime
from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewash.functions.text import ColumnOrName, _col, file_stem
from lakewash.session import scratch_path

def audit_timestamp(run_ts: datetime | str) -> Column:
    """The load time as a constant column. It is passed in, so a re-run of the
    same job gives the same rows."""
    text = run_ts.strftime("%Y-%m-%d %H:%M:%S.%f") if isinstance(run_ts, datetime) else run_ts
    return F.lit(text).cast("timestamp")


def random_uuid() -> Column:
    """A new random UUID per row (Spark's ``uuid()``). It is redrawn whenever
    the rows are recomputed; prefer :func:`stable_uuid` for loaded tables."""
    return F.expr("uuid()")


NULL_FIELD = "~"


def key_text(*cols: ColumnOrName) -> Column:
    """Text of several key columns that no other values can give: each field
    follows its own length, and a null is a mark that no length starts with."""
    def field(c: Column) -> Column:
        return F.when(c.isNull(), F.lit(NULL_FIELD)).otherwise(
            F.concat(F.length(c).cast("string"), F.lit(":"), c))
    return F.concat(*[field(_col(c).cast("string")) for c in cols])


def stable_uuid(*cols: ColumnOrName) -> Column:
    """Repeatable id shaped like a UUID (8-4-4-4-12 hex), from the MD5 of the
    key columns. The same key always gives the same id, on any run; where keys
    repeat, add :func:`with_occurrence` to them."""
    h = F.md5(key_text(*cols))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def source_file_stem() -> Column:
    """Name of the file each row was read from, without folder or extension
    (file sources only: Parquet, CSV, JSON, ...)."""
    return file_stem(F.col("_metadata.file_name"))


def _hashable(df: DataFrame, name: str) -> Column:
    """A column as a hash or a sort can read it (maps, which neither takes,
    as the sorted list of their entries)."""
    col = F.col(f"`{name}`")
    return F.to_json(F.array_sort(F.map_entries(col))) if isinstance(df.schema[name].dataType, T.MapType) else col


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written under the shared checkpoint folder and read back."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_surrogate_key(df: DataFrame, order_by: Sequence[ColumnOrName], name: str = "id",
                       start: int = 1, num_partitions: int | None = None) -> DataFrame:
    """Dense serial key ``start, start+1, ...`` in ``order_by`` order, 64-bit.

    No global window, no Python, nothing through the driver:

    1. each row gets ``monotonically_increasing_id`` as a tie-break and is
       staged under ``spark.checkpoint.dir``: the source runs once and the
       tie-break is fixed;
    2. the staged rows are range-partitioned and sorted on ``order_by``, the
       row's hash and the tie-break - unique to every row, so a hot order
       value, or a group of copies holding a third of the table, is cut over
       several ranges - and staged again with their place in the partition;
    3. per-partition row counts, read from that one column, give each
       partition its offset (one row per partition: a bounded broadcast).

    Rows that tie up to the tie-break are equal, so the numbered rows are the
    same on every run and for every input partitioning.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = df.columns
    fixed = staged(df.withColumns({
        **{f"_lw_o{i}": _col(c) for i, c in enumerate(order_by)},
        "_lw_h": F.xxhash64(*[_hashable(df, c) for c in names]),
        "_lw_tie": F.monotonically_increasing_id()}), "key-rows")
    order = [F.col(f"_lw_o{i}") for i in range(len(order_by))] + [F.col("_lw_h"), F.col("_lw_tie")]
    tagged = staged(fixed.repartitionByRange(n, *order).sortWithinPartitions(*order)
                     .withColumn("_lw_tag", F.monotonically_increasing_id())
                     .select(*[F.col(f"`{c}`") for c in names], "_lw_tag"), "key-tagged")
    part = F.shiftright("_lw_tag", 33)
    # One row per range partition, so the running sum over all of them (a
    # window without partitions) sees at most num_partitions rows.
    offsets = (tagged.groupBy(part.alias("_lw_part")).agg(F.count(F.lit(1)).alias("_lw_rows"))
               .withColumn("_lw_offset", F.coalesce(
                   F.sum("_lw_rows").over(Window.orderBy("_lw_part")
                                          .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
               .select("_lw_part", "_lw_offset"))
    joined = tagged.join(F.broadcast(offsets), part == F.col("_lw_part"))
    row_in_part = F.col("_lw_tag") - F.shiftleft(F.col("_lw_part"), 33)
    key = (F.col("_lw_offset") + row_in_part + F.lit(start)).cast("bigint").alias(name)
    return joined.select(key, *[F.col(f"`{c}`") for c in names])


OCCURRENCE = "_occurrence"

# What numbering adds to a row, fixed by staging: the key as text, the digest of
# the whole row, and a tie-break whose upper bits name the task that wrote it.
KEY, DIGEST, TIE, CHUNK = "_lw_key", "_lw_digest", "_lw_tie", "_lw_chunk"
TAGS = (KEY, DIGEST, TIE)
#: Rows that one key's window may hold, and bytes of a list of keys that may be broadcast.
HEAVY_ROWS = 1_000_000
BROADCAST_BYTES = 32 << 20


def tie_break() -> Column:
    """A tie-break for staged rows: different for every row, fixed once written."""
    return F.monotonically_increasing_id().alias(TIE)


def tagged(df: DataFrame, key: str, tie: Column | None = None) -> DataFrame:
    """``df`` with the tags that numbering reads. Stage it before it is
    numbered, so that the tie-break is fixed, or pass that of a staged frame
    (a column of ``df`` then, and no part of a row's digest)."""
    row = key_text(*[_hashable(df, c).cast("string") for c in df.columns if c != TIE])
    return df.withColumns({KEY: key_text(F.col(f"`{key}`")), DIGEST: F.unhex(F.md5(row)),
                           TIE: F.monotonically_increasing_id() if tie is None else tie})


def chunk_counts(rows: DataFrame, *more: Column) -> DataFrame:
    """How many equal rows each task wrote, by key, digest and task: copies are
    reduced to one row a task before they are shuffled. ``more`` aggregates go
    with them."""
    return rows.groupBy(KEY, DIGEST, F.shiftright(TIE, 33).alias(CHUNK)).agg(F.count(F.lit(1)).alias("n"), *more)


def running_total(counts: DataFrame, order: Sequence[str], n: str, name: str) -> DataFrame:
    """``counts`` with the sum of ``n`` over the rows before it in ``order``
    (which begins with the digest) among those of its key.

    A key's rows are cut into 4,096 ranges of the digest. Sums of ranges, at
    most 4,096 rows for a key, give each range its start; a second running sum
    stays inside a range, so a key that holds a third of all rows is spread.
    """
    cut = counts.withColumn("_lw_range", F.substring(F.hex(DIGEST), 1, 3))
    starts = (cut.groupBy(KEY, "_lw_range").agg(F.sum(n).alias("_lw_sum"))
              .withColumn("_lw_before", F.coalesce(F.sum("_lw_sum").over(
                  Window.partitionBy(KEY).orderBy("_lw_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .drop("_lw_sum"))
    inside = F.coalesce(F.sum(n).over(Window.partitionBy(KEY, "_lw_range").orderBy(*order)
                                      .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (cut.join(starts, [KEY, "_lw_range"])
            .withColumn(name, (inside + F.col("_lw_before")).cast("bigint")).drop("_lw_range", "_lw_before"))


def copy_number(start: Column) -> Column:
    """The place of a row whose task wrote several equal ones: the task's
    start and the row's own place in the task."""
    own = F.row_number().over(Window.partitionBy(KEY, DIGEST, CHUNK).orderBy(TIE)) - 1
    return (start + own).cast("bigint")


def repeats(df: DataFrame, key: str) -> bool:
    """Whether any value of ``key`` occurs more than once (nulls are a value)."""
    return not df.groupBy(F.col(f"`{key}`")).count().where("count > 1").isEmpty()


def with_occurrence(df: DataFrame, key: str, name: str = OCCURRENCE, heavy: int = HEAVY_ROWS) -> DataFrame:
    """``df`` with the number, from 0, of each row among the rows of its key.

    Rows of a key are ordered by an MD5 of the whole row; rows that tie there
    are equal, so each row gets the same number on every run and for every
    partitioning. ``df`` runs once, into a staging folder; see
    :func:`number_tagged` for the rest.
    """
    columns = df.columns
    return number_tagged(staged(tagged(df, key), "rows-to-number"), columns, name, heavy)


def number_tagged(rows: DataFrame, columns: Sequence[str], name: str = OCCURRENCE,
                  heavy: int = HEAVY_ROWS) -> DataFrame:
    """:func:`with_occurrence` for rows that are :func:`tagged` and staged.

    Keys that repeat are counted once and staged. While at most half of the rows
    have such a key, the others stay where they are (their number is 0);
    otherwise all rows move, once, to the rows of their key. A key of up to
    ``heavy`` rows is numbered by a window. Rows of a heavier one are numbered
    from counts of equal rows by digest and task: it is spread by digest, a
    row that a third of all rows are copies of by task. Lists of keys are
    broadcast up to ``BROADCAST_BYTES`` of key text.
    """
    seen = Observation(f"repeats-{uuid.uuid4().hex[:8]}")
    bytes_ = F.octet_length(KEY).cast("long") + 16
    again = staged(rows.groupBy(KEY).agg(F.count(F.lit(1)).alias("n")).observe(
        seen, F.sum("n").alias("rows"), F.sum(F.when(F.col("n") > 1, F.col("n"))).alias("repeated"),
        F.sum(F.when(F.col("n") > 1, bytes_)).alias("again_bytes"),
        F.count(F.when(F.col("n") > heavy, True)).alias("heavy"),
        F.sum(F.when(F.col("n") > heavy, bytes_)).alias("heavy_bytes")).where("n > 1"), "repeated-keys")
    found = {k: int(v or 0) for k, v in seen.get.items()}
    cols = [F.col(f"`{c}`") for c in columns]

    def keys(of: DataFrame, size: int) -> DataFrame:
        return F.broadcast(of.select(KEY)) if size <= BROADCAST_BYTES else of.select(KEY)

    parts, moved = [], rows
    if found["repeated"] * 2 <= found["rows"]:
        listed = keys(again, found["again_bytes"])
        parts.append(rows.join(listed, KEY, "left_anti").select(*cols, F.lit(0).cast("bigint").alias(name)))
        moved = rows.join(listed, KEY, "left_semi")
    if found["heavy"]:
        listed = keys(again.where(F.col("n") > heavy), found["heavy_bytes"])
        parts.append(_number_heavy(moved.join(listed, KEY, "left_semi"), cols, name))
        moved = moved.join(listed, KEY, "left_anti")
    own = F.row_number().over(Window.partitionBy(KEY).orderBy(DIGEST, TIE)) - 1
    out = moved.select(*cols, own.cast("bigint").alias(name))
    for part in parts:
        out = out.unionByName(part)
    return out


def _number_heavy(rows: DataFrame, cols: Sequence[Column], name: str) -> DataFrame:
    """Numbers of tagged rows whose keys are too heavy for a window each."""
    placed = staged(running_total(chunk_counts(rows), [DIGEST, CHUNK], "n", "_lw_start"), "places")
    joined = rows.withColumn(CHUNK, F.shiftright(TIE, 33)).join(placed, [KEY, DIGEST, CHUNK])
    once = joined.where("n = 1").select(*cols, F.col("_lw_start").alias(name))
    copies = joined.where("n > 1").select(*cols, copy_number(F.col("_lw_start")).alias(name))
    return once.unionByName(copies)
