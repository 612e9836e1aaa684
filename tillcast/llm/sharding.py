"""Contiguous, byte-balanced shards from a global prefix sum.

Rows are put in one global order by range partitioning (order columns, then
size and checksum); each partition's byte and row totals give its offsets, and
a window inside the partition adds the running sum.  A row goes to the shard
in which the middle of its byte interval lies when the total is cut at equal
targets, so shards are contiguous in the order and differ from the target by
at most one row at each cut.  Only per-partition totals leave the executors:
one row per partition, whatever the input.

Law ``bytes``.  Copies of a text are ordinary rows; they are spread by the
order columns, and a row that fills a third of the table is cut across shards
because the tie column ends the range key.  Null text: 0 bytes + overhead,
checksum 0.  Identical rows are interchangeable.  Empty table: no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.common import stage

OVERHEAD = 16       # bytes counted for each row besides its text
SHARDS = 40


def shard_by_bytes(docs: DataFrame, order: list[str], text: str = "text", shards: int = SHARDS,
                   overhead: int = OVERHEAD, partitions: int | None = None) -> DataFrame:
    """order columns, size, text_crc32, shard, slot (gapless from 0 in each shard)."""
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    raw = F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b""))
    slim = docs.select(*[F.col(f"`{c}`") for c in order],
                       (F.octet_length(raw).cast("long") + overhead).alias("size"),
                       F.crc32(raw).alias("text_crc32"),
                       F.monotonically_increasing_id().alias("__tie"))
    key = [*order, "size", "text_crc32", "__tie"]
    placed = stage(slim.repartitionByRange(n, *key).withColumn("__p", F.spark_partition_id()))
    totals = placed.groupBy("__p").agg(F.sum("size").alias("__b"), F.count("*").alias("__n"))
    # one row per partition: a global window over it is bounded by the partition count
    w = Window.orderBy("__p")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    offs = totals.select("__p", F.coalesce(F.sum("__b").over(before), F.lit(0)).alias("__b0"),
                         F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__n0"),
                         F.sum("__b").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("__t"))
    inside = Window.partitionBy("__p").orderBy(*key)
    rows = (placed.withColumn("__s", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("__r", F.row_number().over(inside))
            .join(offs, "__p"))
    rows = rows.withColumn("__mid2", 2 * (F.col("__b0") + F.col("__s")) - F.col("size"))
    rows = rows.withColumn("shard", F.least(F.lit(shards - 1), F.expr(f"(__mid2 * {shards}L) div (2 * __t)")).cast("int"))
    rows = rows.withColumn("__g", F.col("__n0") + F.col("__r") - 1)
    first = rows.groupBy("shard").agg(F.min("__g").alias("__g0"))
    return rows.join(first, "shard").select(*order, "size", "text_crc32", "shard",
                                            (F.col("__g") - F.col("__g0")).alias("slot"))
