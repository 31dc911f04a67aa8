"""Keys over several loads: which rows of a batch came before, and what number
a row has among all rows of its key.

A key table is a folder with the state that outlives a batch: for every key
and every different row of it (known by its digest), how often each batch
brought the row and which numbers its copies have. A batch reads the state of
earlier batches only and writes its own folder, so a batch that is replayed
after a failure gives the same numbers again.

* A row that arrives again, in another file or batch, keeps the number, and so
  the id, it had.
* Another row of a known key takes the key's next number.
* More copies of a row than ever arrived in one batch take further numbers.

The state has one narrow row for each different row and batch. Every
``COMPACT`` batches it is written together into one folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakewash.operators.ids import (
    CHUNK, DIGEST, KEY, OCCURRENCE, TIE, chunk_counts, copy_number, running_total, staged,
)

SCHEMA = (f"{KEY} string, {DIGEST} binary, value string, delivered bigint, copy_from bigint, copies bigint, "
          "base bigint, batch bigint")
COMPACT = 32


class KeyTable:
    """The keys that a stream of batches has brought so far."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folders(self) -> dict[str, int]:
        """Folders of the state and the batch that each ends with."""
        jpath = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = jpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(jpath):
            return {}
        names = [s.getPath().getName() for s in fs.listStatus(jpath)]
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        whole = [n for n in names if n.startswith("batch-")  # a batch's folder is only read once the batch is through
                 or n.startswith("upto-") and fs.exists(path(f"{self.path}/{n}/_SUCCESS"))]
        return {n: int(n.split("-")[1]) for n in whole}

    def _state(self, before: int) -> list[str]:
        found = {n: b for n, b in self._folders().items() if b < before}
        base = max((b for n, b in found.items() if n.startswith("upto-")), default=-1)
        return sorted([f"upto-{base}"] * (base >= 0) + [n for n, b in found.items() if n.startswith("batch-") and b > base])

    def entries(self, before: int = 1 << 62) -> DataFrame:
        """The state that batches before the given one left."""
        folders = [f"{self.path}/{n}" for n in self._state(before)]
        if not folders:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(*folders)

    def number(self, rows: DataFrame, columns: Sequence[str], key: str, batch: int, name: str = OCCURRENCE) -> DataFrame:
        """``columns`` of ``rows`` (a staged batch with the tags of
        :func:`lakewash.operators.ids.tagged`) with each row's number among all
        rows of its key, and the batch's state written."""
        self._compact(batch)
        zero = F.lit(0).cast("bigint")
        counts = staged(chunk_counts(rows, F.any_value(F.col(f"`{key}`").cast("string")).alias("value")), "batch-counts")
        arrived = counts.groupBy(KEY, DIGEST).agg(F.sum("n").alias("delivered"), F.any_value("value").alias("value"))
        earlier = self.entries(batch).where("copies > 0").join(counts.select(KEY).distinct(), KEY, "left_semi")
        earlier = staged(earlier.select(KEY, DIGEST, "copy_from", "copies", "base"), "batch-known")
        known = earlier.groupBy(KEY, DIGEST).agg(F.sum("copies").alias("known"))
        given = earlier.groupBy(KEY).agg(F.sum("copies").alias("given"))
        state = (arrived.join(known, [KEY, DIGEST], "left").join(given, KEY, "left")
                 .withColumn("copy_from", F.coalesce("known", zero))
                 .withColumn("copies", F.greatest(F.col("delivered") - F.col("copy_from"), zero)))
        state = running_total(state, [DIGEST], "copies", "base")
        folder = f"{self.path}/batch-{batch}"
        (state.withColumns({"base": F.col("base") + F.coalesce("given", zero), "batch": F.lit(batch).cast("bigint")})
         .select(KEY, DIGEST, "value", "delivered", "copy_from", "copies", "base", "batch")
         .write.mode("overwrite").parquet(folder))
        own = self.spark.read.schema(SCHEMA).parquet(folder)
        ranges = (own.where("copies > 0").select(*earlier.columns).unionByName(earlier).groupBy(KEY, DIGEST)
                  .agg(F.collect_list(F.struct("copy_from", "copies", "base")).alias("ranges")))  # one for each batch that brought more copies than any before
        start = F.coalesce(F.sum("n").over(Window.partitionBy(KEY, DIGEST).orderBy(CHUNK)
                                           .rowsBetween(Window.unboundedPreceding, -1)), zero)
        placed = counts.withColumn("_lw_start", start).join(ranges, [KEY, DIGEST])
        joined = rows.withColumn(CHUNK, F.shiftright(TIE, 33)).join(placed, [KEY, DIGEST, CHUNK])
        once = joined.where("n = 1").withColumn("_lw_copy", F.col("_lw_start"))
        more = joined.where("n > 1").withColumn("_lw_copy", copy_number(F.col("_lw_start")))
        copy = F.col("_lw_copy")
        mine = F.filter("ranges", lambda r: (r["copy_from"] <= copy) & (copy < r["copy_from"] + r["copies"]))[0]
        return once.unionByName(more).select(
            *[F.col(f"`{c}`") for c in columns], (mine["base"] + copy - mine["copy_from"]).cast("bigint").alias(name))

    def duplicates(self) -> DataFrame:
        """Keys that occur more than once over all loads: ``key``, ``rows``
        (all that arrived), ``different`` (numbers given), ``loads`` (batches
        that brought the key), ``first_load`` and ``last_load``."""
        return (self.entries().groupBy(KEY).agg(
            F.any_value("value").alias("key"), F.sum("delivered").alias("rows"), F.sum("copies").alias("different"),
            F.count_distinct("batch").alias("loads"), F.min("batch").alias("first_load"), F.max("batch").alias("last_load"))
            .where("rows > 1").drop(KEY))

    def _compact(self, batch: int) -> None:
        """Write the folders before the batch's predecessor into one. The
        predecessor may yet be replayed, older batches never are."""
        names = self._state(batch - 1)
        if len(names) < COMPACT:
            return
        last = max(self._folders()[n] for n in names)
        self.entries(last + 1).write.mode("overwrite").parquet(f"{self.path}/upto-{last}")
        if f"upto-{last}" not in self._folders():
            return
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for n in names:
            old = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{n}")
            old.getFileSystem(conf).delete(old, True)
