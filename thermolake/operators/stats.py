"""Season statistics, coverage, rankings and table checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from thermolake.functions import scalars as S


def _summary(daily_value: str, name: str) -> list[Column]:
    """The 10th and 90th percentile of a column in one pass: one buffer gives both."""
    return [F.percentile(daily_value, F.array(F.lit(0.1), F.lit(0.9))).alias(name)]


def year_stats(pet: DataFrame) -> DataFrame:
    """location_id, year, season and rounded avg, max, p10, p90 of pet and avg, p10, p90 of pet_avg.

    Each day counts for the year as a whole and for its season. Nulls in either value are left out of its
    statistics; percentiles are exact and interpolated.
    """
    rows = pet.select("location_id", F.year("date").cast("smallint").alias("year"), F.explode(S.with_annual(F.col("date"))).alias("season"), F.col("pet").cast("float").alias("pet"), F.col("pet_avg").cast("float").alias("pet_avg"))
    found = rows.groupBy("location_id", "year", "season").agg(F.avg("pet").alias("m"), F.max("pet").alias("x"), *_summary("pet", "q"), F.avg("pet_avg").alias("ma"), *_summary("pet_avg", "qa"))
    one = lambda c: S.round_half_up(c, 1).cast("float")
    return found.select(
        F.col("location_id").cast("int").alias("location_id"), "year", "season", one(F.col("m")).alias("avg_pet"), one(F.col("x")).alias("max_pet"), one(F.col("q")[0]).alias("p10"), one(F.col("q")[1]).alias("p90"),
        one(F.col("ma")).alias("avg_pet_avg"), one(F.col("qa")[0]).alias("p10_avg"), one(F.col("qa")[1]).alias("p90_avg"),
    )


def year_stats_grouping_sets(pet: DataFrame) -> DataFrame:
    """The same rows by GROUPING SETS instead of an explode."""
    spark = pet.sparkSession
    rows = pet.select("location_id", F.year("date").cast("smallint").alias("year"), S.season(F.col("date")).alias("s"), F.col("pet").cast("float").alias("pet"), F.col("pet_avg").cast("float").alias("pet_avg"))
    rounded = lambda e: f"cast(round(cast({e} as decimal(24,12)), 1) as float)"
    return spark.sql(
        f"""SELECT cast(location_id AS int) AS location_id, year, CASE WHEN grouping(s) = 1 THEN '{S.ANNUAL}' ELSE s END AS season,
                   {rounded("avg(pet)")} AS avg_pet, {rounded("max(pet)")} AS max_pet, {rounded("percentile(pet, 0.1)")} AS p10, {rounded("percentile(pet, 0.9)")} AS p90,
                   {rounded("avg(pet_avg)")} AS avg_pet_avg, {rounded("percentile(pet_avg, 0.1)")} AS p10_avg, {rounded("percentile(pet_avg, 0.9)")} AS p90_avg
            FROM {{rows}} GROUP BY GROUPING SETS ((location_id, year), (location_id, year, s))""",
        rows=rows,
    )


def city_rankings(stats: DataFrame, forecasts: DataFrame, locations: DataFrame, base_year: int = 2000, horizon: int = 2100) -> DataFrame:
    """Statistics with city names, the interval at the horizon year, and the change since the base year.

    Base values come from statistics, or where a season has none from the forecast; a statistic's null
    counts. Stats and forecasts have a row for each place, year and season, so all joins are on narrow,
    aggregated tables.
    """
    keys = ["location_id", "year", "season"]
    seen = stats.select(*keys, F.lit(0).alias("source_order"), F.col("avg_pet").alias("v"), F.col("avg_pet_avg").alias("va"))
    ahead = forecasts.select(*keys, F.lit(1).alias("source_order"), F.col("pet").alias("v"), F.col("pet").alias("va"))
    base = seen.unionByName(ahead).where(F.col("year") == base_year).groupBy("location_id", "season").agg(F.min_by(F.struct("v", "va"), "source_order").alias("b"))
    far = forecasts.where(F.col("year") == horizon).select("location_id", "season", F.col("lower").alias("future_lower"), F.col("upper").alias("future_upper"))
    named = locations.select(F.col("id").alias("location_id"), "city", "state")
    change = lambda a, b: S.round_half_up(F.col(a).cast("float") - F.col(b).cast("float"), 2).cast("float")
    return (
        stats.where(~(F.col("location_id") < 0)).join(named, "location_id").join(far, ["location_id", "season"], "left").join(base, ["location_id", "season"], "left")
        .select(
            F.col("location_id").cast("smallint").alias("location_id"), "year", "season", "avg_pet", "max_pet", "avg_pet_avg", "city", "state", "p10", "p90", "p10_avg", "p90_avg", "future_lower", "future_upper",
            change("avg_pet", "b.v").alias("change_from_2000"), change("avg_pet_avg", "b.va").alias("change_from_2000_avg"),
        )
    )


def history_coverage(pet: DataFrame, min_years: int = 10) -> DataFrame:
    """One row: distinct years, years with pet_avg, city-years with a missing pet_avg, and a status."""
    year = F.year("date")
    found = pet.agg(F.countDistinct(year).alias("years"), F.countDistinct(F.when(F.col("pet_avg").isNotNull(), year)).alias("avg_years"), F.countDistinct(F.when(F.col("pet_avg").isNull(), F.struct("location_id", year.alias("y")))).alias("incomplete"))
    status = F.when(F.col("years") < min_years, F.concat(F.lit(f"fail: at least {min_years} years are needed, found "), F.col("years").cast("string"))).when((F.col("avg_years") < min_years) | (F.col("incomplete") > 0), "warning").otherwise("ok")
    return found.withColumn("status", status)


def require_history(pet: DataFrame, min_years: int = 10) -> str:
    """The status of history_coverage; raises where there are too few years."""
    status = history_coverage(pet, min_years).first()["status"]
    if status.startswith("fail"):
        raise ValueError(status)
    return status


def coverage_range(pet: DataFrame) -> DataFrame:
    return pet.agg(F.min(F.year("date")).alias("first_year"), F.max(F.year("date")).alias("last_year"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def table_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: rows of a that b lacks, and rows of b that a lacks, counting repeats."""
    missing = a.exceptAll(b).agg(F.count("*").alias("missing"))
    extra = b.select(*a.columns).exceptAll(a).agg(F.count("*").alias("extra"))
    return missing.join(extra, F.lit(True))  # one row each


def dedupe_latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The row of each key that comes first in the order given."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_nth", nth).where("_nth = 1").drop("_nth")
