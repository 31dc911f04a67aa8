"""Child rows without a parent, on streams: a child waits for its parent as
long as the parent may still come, and is reported when it no longer can."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def stream_orphans(children: DataFrame, parents: DataFrame, key: str, child_time: str, parent_time: str,
                   late: str = "1 day", parent_within: str = "1 day") -> DataFrame:
    """Streaming rows of ``children`` whose ``key`` no row of ``parents`` has.

    A parent counts if its time is at most ``parent_within`` before or after
    the child's. ``late`` is how much behind the newest row of its stream a row
    may arrive (the watermark of either stream). A child is held in state until
    the watermark shows that no parent in reach can come any more; then it is
    an orphan, once and for good. Children with a null key are no orphans (as
    in SQL's MATCH SIMPLE); a row later than ``late`` allows is dropped. State
    is bounded by the rows of that time, whatever the length of the stream.
    """
    c = (children.where(F.col(f"`{key}`").isNotNull()).withWatermark(child_time, late)
         .select(*[F.col(f"`{x}`").alias(f"c_{x}") for x in children.columns]))
    p = (parents.where(F.col(f"`{key}`").isNotNull()).withWatermark(parent_time, late)
         .select(F.col(f"`{key}`").alias("p_key"), F.col(f"`{parent_time}`").alias("p_time")))
    near = F.expr(f"p_key = `c_{key}` AND p_time >= `c_{child_time}` - INTERVAL {parent_within} "
                  f"AND p_time <= `c_{child_time}` + INTERVAL {parent_within}")
    joined = c.join(p, near, "left_outer")
    return joined.where("p_key IS NULL").select(*[F.col(f"`c_{x}`").alias(x) for x in children.columns])


def run_orphan_report(children: DataFrame, parents: DataFrame, key: str, child_time: str, parent_time: str,
                      output_dir: str, checkpoint_dir: str, state_partitions: int | None = None,
                      **bounds: str) -> StreamingQuery:
    """Process all that has arrived, append the orphans that are certain to
    Parquet under ``output_dir``, and stop. The children that may yet find a
    parent stay in the checkpoint for the next run. The first run fixes over
    how many partitions the state is dealt: ``state_partitions``, or the
    session's number of shuffle partitions."""
    spark = children.sparkSession
    orphans = stream_orphans(children, parents, key, child_time, parent_time, **bounds)
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions or usual))
    try:
        query = (orphans.writeStream.format("parquet").option("path", output_dir)
                 .option("checkpointLocation", checkpoint_dir).outputMode("append").trigger(availableNow=True).start())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return query
