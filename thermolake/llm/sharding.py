"""Contiguous shards of near-equal bytes by global prefix sums of sizes.

Rows are range-partitioned by id; each partition's total gives its offset in the global prefix sum, and
within a partition a window adds up. A row belongs to the shard in whose byte interval its middle lies,
so a shard misses its target by at most one row's size. All of it is DataFrame work on narrow rows; only
the totals, one row for each partition, meet in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from thermolake.session import Scratch


def balanced_shards(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row.

    Null text: no bytes, size 1, the crc32 of nothing. Rows stand in the order (id, size, crc32), nulls
    first, so that repeated ids stand together; rows equal in all three are interchangeable. A text longer than a
    shard is not cut: it takes its shard to itself, and others may be left without rows. An empty table gives no
    rows. Other columns are not read, so that they may have any name.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "shards")
    bytes_of = F.coalesce(F.col(text_col), F.lit(""))
    narrow = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(bytes_of).cast("long") + 1).alias("size"), F.crc32(bytes_of.cast("binary")).alias("text_crc32"))
    order = ["doc_id", "size", "text_crc32"]
    ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # written once: a partition's number must not change if a task runs again
    rows = scratch.table(narrow.repartitionByRange(ranges, *order).withColumn("part", F.spark_partition_id()), "rows")

    totals = rows.groupBy("part").agg(F.sum("size").alias("part_size"), F.count("*").alias("part_rows"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    everything = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("part_size").over(ahead), F.lit(0)).alias("size_before"),
        F.coalesce(F.sum("part_rows").over(ahead), F.lit(0)).alias("rows_before"),
        F.sum("part_size").over(everything).alias("all_size"),
    )
    inside = Window.partitionBy("part").orderBy(*order)
    placed = (
        rows.withColumn("to_here", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("nth", F.row_number().over(inside))
        .join(F.broadcast(offsets), "part")  # as many rows as there are ranges
        .withColumn("twice_middle", 2 * (F.col("size_before") + F.col("to_here")) - F.col("size"))
        .withColumn("shard", F.least(F.expr(f"int((twice_middle * {shards}) div (2 * all_size))"), F.lit(shards - 1)))
        .withColumn("rank", F.col("rows_before") + F.col("nth") - 1)
    )
    placed = scratch.table(placed.select("doc_id", "size", "text_crc32", "shard", "rank"), "placed")
    firsts = placed.groupBy("shard").agg(F.min("rank").alias("first"))  # one row for each shard
    return placed.join(F.broadcast(firsts), "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("rank") - F.col("first")).alias("slot"))


def op10_balanced_shards(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return balanced_shards(docs, 16).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
