"""Dense numbers for the rows of large tables, without a window over all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from thermolake.session import Scratch


def dense_ids(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Adds 0, 1, 2, .. in the order of the keys, which are distinct.

    Rows are range-partitioned and written once with their partition's number; what lies before a partition is a
    sum over one row for each, and within it rows are counted.
    """
    scratch = Scratch(df.sparkSession, "ids")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = scratch.table(df.repartitionByRange(parts, *keys).withColumn("_part", F.spark_partition_id()), "rows")
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    before = rows.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    nth = F.row_number().over(Window.partitionBy("_part").orderBy(*keys))
    return rows.withColumn("_nth", nth).join(F.broadcast(before), "_part").select(*df.columns, (F.col("_before") + F.col("_nth") - 1).alias(name))
