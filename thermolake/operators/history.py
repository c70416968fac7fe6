"""Source merging, partition inventory, selection of parts, pending work."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from thermolake.functions import scalars as S
from thermolake.operators.numbering import dense_ids


def union_sources(dfs: list[DataFrame]) -> DataFrame:
    """All sources under the union of their columns, in the order in which columns are first seen."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def fixed_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Exactly these columns and types: missing ones null, others dropped."""
    return df.select([(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in columns.items()])


def merge_history(dfs: list[DataFrame], keys: list[str], required: list[str], columns: dict[str, str], date_col: str = "date") -> DataFrame:
    """Later sources win. Dates that do not parse are dropped, as are rows with a null in `required`; ISO dates, sorted."""
    text = {c: ("string" if c == date_col else t) for c, t in columns.items()}
    rows = reduce(DataFrame.unionByName, [fixed_columns(df, text).withColumn("_source", F.lit(i)) for i, df in enumerate(dfs)])
    rows = rows.withColumn(date_col, F.try_to_date(F.col(date_col), "yyyy-MM-dd")).dropna(subset=[date_col, *required])
    others = [F.col(c).desc_nulls_last() for c in columns if c not in keys]
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("_source").desc(), *others))
    rows = rows.withColumn("_nth", nth).where("_nth = 1").withColumn(date_col, F.date_format(date_col, "yyyy-MM-dd"))
    return rows.select(*columns).orderBy(*keys)


def partition_value(path: Column, key: str) -> Column:
    """The integer after key= in a path, null where there is none."""
    return F.regexp_extract(path, rf"(?:^|/){key}=(\d+)(?:/|$)", 1).try_cast("int")


def shard_keys(paths: DataFrame, path_col: str = "path") -> DataFrame:
    """path, year, month (0 where the tree has none), tile_id of the paths that name a year and a tile."""
    p = F.col(path_col)
    return paths.select(p.alias("path"), partition_value(p, "year").alias("year"), F.coalesce(partition_value(p, "month"), F.lit(0)).alias("month"), partition_value(p, "tile_id").alias("tile_id")).where("year is not null and tile_id is not null")


def partition_inventory(df: DataFrame, keys: list[str]) -> DataFrame:
    """The sorted files of each combination of partition columns of a file-based table."""
    files = df.select(*keys, F.col("_metadata.file_path").alias("_file")).distinct()
    return files.groupBy(*keys).agg(F.array_sort(F.collect_set("_file")).alias("files"))


def every_nth(df: DataFrame, order_keys: list[str], index: int, count: int, where: Column | None = None) -> DataFrame:
    """The rows whose key's place among all sorted keys leaves `index` when divided by `count`; `where` keeps some keys, before they are numbered.

    The keys' places come from their distinct values, numbered over range partitions.
    """
    if count < 1 or not 0 <= index < count:
        raise ValueError("index must lie in 0..count-1, and count must be positive")
    keys = df.select(*order_keys).distinct()
    places = dense_ids(keys if where is None else keys.where(where), order_keys, "_place")
    chosen = places.where(F.col("_place") % count == index).drop("_place")
    return df.join(chosen, order_keys, "left_semi")


def common_keys(dfs: list[DataFrame], keys: list[str]) -> DataFrame:
    return reduce(DataFrame.intersect, [df.select(*keys) for df in dfs])


def pending(planned: DataFrame, done: DataFrame, keys: list[str], force: bool = False) -> DataFrame:
    """Planned work whose output is not there; with force all of it."""
    return planned if force else planned.join(done.select(*keys).distinct(), keys, "left_anti")


def time_batches(spark, first_hour: int, last_hour: int, size: int) -> DataFrame:
    """batch_index, start_h, end_h of consecutive blocks of hours; the last one may be shorter."""
    n = -(-(last_hour - first_hour + 1) // size)
    start = F.lit(first_hour) + F.col("id") * size
    return spark.range(n).select(F.col("id").cast("int").alias("batch_index"), start.cast("int").alias("start_h"), F.least(start + size - 1, F.lit(last_hour)).cast("int").alias("end_h"))


def year_batches(years: DataFrame, size: int, year_col: str = "year") -> DataFrame:
    """year, batch_index, start_h, end_h: each year's hours in blocks of `size`, of which the last one may be shorter."""
    first, last = S.first_hour(F.col("year")), S.first_hour(F.col("year") + 1) - 1
    spans = years.select(F.col(year_col).cast("int").alias("year")).distinct().select("year", first.alias("first"), last.alias("last"))
    nth = F.explode(F.sequence(F.lit(0), F.floor((F.col("last") - F.col("first")) / size).cast("int"))).alias("batch_index")
    start = F.col("first") + F.col("batch_index") * size
    return spans.select("year", "first", "last", nth).select("year", "batch_index", start.alias("start_h"), F.least(start + size - 1, F.col("last")).alias("end_h"))


def read_parquet(spark, paths: list[str], columns: list[str] | None = None, where: Column | None = None, base_path: str | None = None) -> DataFrame:
    """Some columns and rows of some files; both reach the scan."""
    reader = spark.read.option("basePath", base_path) if base_path else spark.read
    df = reader.parquet(*paths)
    df = df.where(where) if where is not None else df
    return df.select(*columns) if columns else df


def scan_tree(spark, root: str, glob: str = "*.parquet", merge: bool = False) -> DataFrame:
    """All files of a tree of key=value folders that match a name pattern, with the keys as columns."""
    return spark.read.option("basePath", root).option("pathGlobFilter", glob).option("mergeSchema", merge).parquet(root)


def scan_csv(spark, path: str, schema: str | T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)
