"""Partitioned parquet tables: writing, keyed upserts, window deletes, replacement and materialisation."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from thermolake.session import from_files


def filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def narrowed(df: DataFrame) -> DataFrame:
    """Doubles as floats, as tables store them."""
    return df.select([F.col(f.name).cast("float").alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name) for f in df.schema.fields])


def with_year(df: DataFrame, date_col: str = "date") -> DataFrame:
    return df.withColumn("year", F.year(date_col))


def write_partitioned(df: DataFrame, path: str, by: tuple[str, ...] = ("year",), mode: str = "overwrite") -> None:
    """Snappy parquet under by=value folders; only folders with rows are replaced.

    Rows of a folder come together in files of the advisory partition size: small folders get one file, and a
    folder of any size is spread over as many tasks as it needs (which takes adaptive execution).
    """
    rows = narrowed(df).hint("rebalance", *by)
    rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").option("compression", "snappy").partitionBy(*by).parquet(path)


def replace_partitions(df: DataFrame, path: str, by: str, touched: list) -> None:
    """Replaces the folders by=touched with the rows of df, which may come from the same table; a folder without rows goes.

    Rows are written once, beside the table. Old folders are moved aside, new ones into their place, and only then
    the old ones are deleted; if a move fails, what was moved is moved back. Readers may meet the state between
    two moves: a table that has readers meanwhile is a SnapshotTable.
    """
    spark = df.sparkSession
    label = uuid.uuid4().hex
    staged, old = (f"{path.rstrip('/')}.{k}-{label}" for k in ("staged", "old"))
    write_partitioned(df, staged, (by,))
    fs, at = filesystem(spark, path)
    made = [s.getPath().getName() for s in fs.listStatus(at(staged)) if s.isDirectory()]
    wanted = {*made, *(f"{by}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}" for value in touched)}
    moves = [(f"{path}/{f}", f"{old}/{f}") for f in sorted(wanted) if fs.exists(at(f"{path}/{f}"))] + [(f"{staged}/{f}", f"{path}/{f}") for f in sorted(made)]
    fs.mkdirs(at(old))
    moved = []
    for source, target in moves:
        if not fs.rename(at(source), at(target)):
            for back, there in reversed(moved):
                fs.rename(at(there), at(back))
            raise OSError(f"cannot move {source} to {target}")
        moved.append((source, target))
    fs.delete(at(old), True)
    fs.delete(at(staged), True)


def overwrite(df: DataFrame, path: str) -> DataFrame:
    """Writes to a fresh folder and puts it in the table's place, which df may be read from. The old table is kept beside it until then."""
    spark = df.sparkSession
    fresh, old = (f"{path.rstrip('/')}.{k}-{uuid.uuid4().hex}" for k in ("fresh", "old"))
    df.write.option("compression", "snappy").parquet(fresh)
    fs, at = filesystem(spark, path)
    there = fs.exists(at(path)) and fs.rename(at(path), at(old))
    if not fs.rename(at(fresh), at(path)):
        if there:
            fs.rename(at(old), at(path))
        raise OSError(f"cannot move {fresh} to {path}")
    if there:
        fs.delete(at(old), True)
    return spark.read.schema(df.schema).parquet(path)


materialise = overwrite


def staged_in_order(sources: list[DataFrame]) -> tuple[DataFrame, list[Column]]:
    """The union of staged sources with columns that tell when a row arrived, and the order by them: source, then file, then row.

    Sources are parquet tables, or else their rows have no place in a file, and content decides between them.
    """
    placed = []
    for i, df in enumerate(sources):
        content = F.xxhash64(*df.columns).alias("_content")
        if from_files(df):
            placed.append(df.select("*", F.lit(i).alias("_source"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"), content))
        else:
            placed.append(df.select("*", F.lit(i).alias("_source"), F.lit(None).cast("string").alias("_file"), F.lit(None).cast("long").alias("_row"), content))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), placed)
    return rows, [F.col(c) for c in ("_source", "_file", "_row", "_content")]


def last_staged(staged: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """One row for each key, the last in the given order; by default any one of equal rows, told apart by their content."""
    order = order or [F.xxhash64(*staged.columns)]
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*[o.desc() for o in order]))
    return staged.withColumn("_nth", nth).where("_nth = 1").drop("_nth")


def merge_upsert(base: DataFrame, staged: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """The base with the staged rows: columns that the staged rows lack keep their stored value, and are null in new rows. Null keys are equal."""
    new = last_staged(staged, keys, order)
    new = new.select([F.col(c).alias(f"_new_{c}") for c in new.columns]).withColumn("_here", F.lit(True))
    on = [base[k].eqNullSafe(new[f"_new_{k}"]) for k in keys]
    both = base.join(new, on, "full_outer")
    pick = lambda f: F.when(F.col("_here"), F.col(f"_new_{f.name}").cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name) if f.name in staged.columns else F.col(f.name)
    return both.select([pick(f) for f in base.schema.fields])


def insert_absent(base: DataFrame, staged: DataFrame, keys: list[str]) -> DataFrame:
    """The base with the staged rows whose key it lacks; null keys are equal."""
    new = last_staged(staged, keys)
    new = new.join(base, [new[k].eqNullSafe(base[k]) for k in keys], "left_anti")
    return base.unionByName(new, allowMissingColumns=True)


def upsert_table(spark: SparkSession, path: str, staged: DataFrame | list[DataFrame], keys: list[str], date_col: str = "date") -> None:
    """merge_upsert into a table of year folders; only years that the staged rows touch are read and written.

    Of staged rows with one key the last counts, in the order of source (of several), file and row.
    """
    staged, order = staged_in_order(staged if isinstance(staged, list) else [staged])
    staged = last_staged(staged, keys, order).drop("_source", "_file", "_row", "_content")
    years = [r[0] for r in staged.select(F.year(date_col)).distinct().collect()]
    base = spark.read.parquet(path)
    some = base.where(in_years(years))
    merged = merge_upsert(some.drop("year"), staged, keys)
    replace_partitions(with_year(merged, date_col).select(base.columns), path, "year", years)


def in_years(years: list) -> Column:
    """Whether a row's year is one of these, null among them."""
    found = F.coalesce(F.col("year").isin([y for y in years if y is not None]), F.lit(False))
    return found | F.col("year").isNull() if None in years else found


def delete_window(df: DataFrame, date_col: str, start, end) -> DataFrame:
    """The rows outside a window of dates, both ends of which belong to it; rows without a date stay."""
    return df.where(~F.coalesce(F.col(date_col).between(F.lit(start).cast("date"), F.lit(end).cast("date")), F.lit(False)))


outside_window = delete_window


def delete_window_in_table(spark: SparkSession, path: str, date_col: str, start, end) -> None:
    first, last = (int(str(d)[:4]) for d in (start, end))
    base = spark.read.parquet(path)
    touched = [r[0] for r in base.where(F.col("year").between(first, last)).select("year").distinct().collect()]
    left = delete_window(base.where(F.col("year").isin(touched)), date_col, start, end)
    replace_partitions(left, path, "year", touched)


def export_excluding(df: DataFrame, date_col: str, start=None, end=None) -> DataFrame:
    """The table, or what lies outside a window of dates, in the order of place and date."""
    rows = df if start is None else delete_window(df, date_col, start, end)
    return rows.orderBy("location_id", date_col)


def write_csv(df: DataFrame, path: str, order_by: list[str], places: dict[str, int] | None = None) -> None:
    """CSV with a header in each file and a fixed number of decimals for some columns; an empty table still gives its header."""
    fixed = [F.format_string(f"%.{(places or {})[c]}f", F.col(c)).alias(c) if c in (places or {}) else F.col(c) for c in df.columns]
    rows = df.orderBy(*order_by).select(fixed)
    if df.limit(1).count() == 0:  # a file is only written by a task that has a partition
        rows = rows.repartition(1)
    rows.write.mode("overwrite").option("header", True).csv(path)
