"""The driver's tables in the shape of the engine's own: daily facts, cities, gridded weather, history sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """location_id (region), date, pet, pet_avg from line items: highest and mean quantity of a day."""
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", F.to_date("l_shipdate").alias("date"), "l_quantity")
    places = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("n_regionkey").alias("location_id"))
    rows = lines.join(places, F.col("l_suppkey") == F.col("s_suppkey"))
    return rows.groupBy("location_id", "date").agg(F.max("l_quantity").cast("float").alias("pet"), F.avg("l_quantity").cast("float").alias("pet_avg"))


DAILY = """daily AS (
  SELECT n.n_regionkey AS location_id, CAST(l.l_shipdate AS DATE) AS date, CAST(max(l.l_quantity) AS FLOAT) AS pet, CAST(avg(l.l_quantity) AS FLOAT) AS pet_avg
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey GROUP BY 1, 2)"""


def daily_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three locations, which have every day of most years."""
    return table(spark, sf_dir, "lineitem").groupBy((F.col("l_suppkey") % 3).cast("int").alias("location_id"), F.to_date("l_shipdate").alias("date")).agg(F.max("l_quantity").cast("float").alias("pet"), F.avg("l_quantity").cast("float").alias("pet_avg"))


DAILY_ALL = """daily AS (
  SELECT CAST(l_suppkey % 3 AS INTEGER) AS location_id, CAST(l_shipdate AS DATE) AS date, CAST(max(l_quantity) AS FLOAT) AS pet, CAST(avg(l_quantity) AS FLOAT) AS pet_avg FROM lineitem GROUP BY 1, 2)"""


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """location_id, period (months), value of the months of which all days are there."""
    rows = daily(spark, sf_dir).groupBy("location_id", (F.year("date") * 12 + F.month("date") - 1).alias("period")).agg(F.avg("pet_avg").alias("value"), F.count("*").alias("days"), F.max(F.dayofmonth(F.last_day("date"))).alias("expected"))
    return rows.where("days = expected").select("location_id", "period", "value")


MONTHLY = (
    DAILY
    + """, monthly AS (
  SELECT location_id, period, value FROM (
    SELECT location_id, year(date) * 12 + month(date) - 1 AS period, avg(pet_avg) AS value, count(*) AS days, max(day(last_day(date))) AS expected FROM daily GROUP BY 1, 2)
  WHERE days = expected)"""
)


def cities_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City, State, Population, lat, lon from customers; some lie outside the box, some share a cell."""
    rows = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    key = F.col("c_custkey")
    return rows.select(F.col("c_name").alias("City"), F.col("n_name").alias("State"), F.floor(F.col("c_acctbal") * 100).cast("bigint").alias("Population"), (22.0 + (key * 37 % 3000) / 100.0).alias("lat"), (-128.0 + (key * 53 % 6500) / 100.0).alias("lon"))


CITIES = """cities_src AS (
  SELECT c_name AS city, n_name AS state, CAST(floor(c_acctbal * 100) AS BIGINT) AS population, 22.0::DOUBLE + (c_custkey * 37 % 3000) / 100.0::DOUBLE AS lat, -128.0::DOUBLE + (c_custkey * 53 % 6500) / 100.0::DOUBLE AS lng
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def grid_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """hour, lat, lng and nine variables from events: one row for each hour and user's cell."""
    events = table(spark, sf_dir, "events")
    hour = F.floor((F.unix_timestamp("ts") + 2208988800) / 3600).cast("int")
    rows = events.groupBy(hour.alias("hour"), (F.col("user_id") % 400).alias("place")).agg(F.min("event_id").alias("e"))
    e, p = F.col("e"), F.col("place")
    return rows.select(
        "hour", (26.0 + (p % 20) * 0.25).alias("lat"), (236.0 + F.floor(p / 20) * 0.25).alias("lng"),
        ((e * 7 % 121 - 60) / 10.0).alias("10u"), ((e * 11 % 101 - 50) / 10.0).alias("10v"), (265.0 + e % 400 / 10.0).alias("2t"), (265.0 + e % 400 / 10.0 - 0.5 - e % 17).alias("2d"),
        ((e % 25) * 100000.0).alias("ssrd"), ((e % 25) * 80000.0).alias("ssr"), ((e % 25) * 55000.0).alias("fdir"), (1000000.0 + (e % 9) * 50000.0).alias("strd"), (-200000.0 - (e % 5) * 10000.0).alias("str"),
    )


GRID = """grid AS (
  SELECT hour, 26.0::DOUBLE + (place % 20) * 0.25::DOUBLE AS lat, 236.0::DOUBLE + (place // 20) * 0.25::DOUBLE AS lng, (e * 7 % 121 - 60) / 10.0::DOUBLE AS u10, (e * 11 % 101 - 50) / 10.0::DOUBLE AS v10,
    265.0::DOUBLE + e % 400 / 10.0::DOUBLE AS t2, 265.0::DOUBLE + e % 400 / 10.0::DOUBLE - 0.5::DOUBLE - e % 17 AS d2, (e % 25) * 100000.0::DOUBLE AS ssrd, (e % 25) * 80000.0::DOUBLE AS ssr, (e % 25) * 55000.0::DOUBLE AS fdir,
    1000000.0::DOUBLE + (e % 9) * 50000.0::DOUBLE AS strd, -200000.0::DOUBLE - (e % 5) * 10000.0::DOUBLE AS str
  FROM (SELECT CAST((epoch_us(ts) // 1000000 + 2208988800) // 3600 AS INTEGER) AS hour, user_id % 400 AS place, min(event_id) AS e FROM events GROUP BY 1, 2))"""


def grid_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places near the cells of grid_hourly: one for each customer, longitudes west of Greenwich."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    return c.select(F.col("k").cast("int").alias("location_id"), (26.0 + (F.col("k") % 97) * 0.05).alias("lat"), (-124.0 + (F.col("k") % 89) * 0.06).alias("lng"))


GRID_CITIES = """places AS (
  SELECT CAST(c_custkey AS INTEGER) AS location_id, 26.0::DOUBLE + (c_custkey % 97) * 0.05::DOUBLE AS lat, -124.0::DOUBLE + (c_custkey % 89) * 0.06::DOUBLE AS lng FROM customer)"""


def history_sources(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Overlapping slices of orders: an old one without pet_avg, a middle one with dates that do not parse, a new one."""
    orders = table(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 50).alias("location_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date")).agg(F.floor(F.max("o_totalprice")).alias("pet"), F.floor(F.min("o_totalprice")).alias("pet_avg"))
    middle = orders.where("location_id between 10 and 35").select("location_id", F.when(F.col("pet") % 10 == 0, "not a date").otherwise(F.col("date")).alias("date"), (F.col("pet") + 1).alias("pet"), F.when(F.col("pet") % 3 == 0, None).otherwise(F.col("pet_avg")).alias("pet_avg"))
    return [orders.where("location_id < 25").select("location_id", "date", "pet"), middle, orders.where("location_id >= 30").select("location_id", "date", (F.col("pet") + 2).alias("pet"), "pet_avg")]


HISTORY = """orders_day AS (
  SELECT o_custkey % 50 AS location_id, strftime(o_orderdate, '%Y-%m-%d') AS date, CAST(floor(max(o_totalprice)) AS BIGINT) AS pet, CAST(floor(min(o_totalprice)) AS BIGINT) AS pet_avg FROM orders GROUP BY 1, 2),
sources AS (
  SELECT 0 AS source, location_id, date, pet, CAST(NULL AS BIGINT) AS pet_avg FROM orders_day WHERE location_id < 25
  UNION ALL SELECT 1, location_id, CASE WHEN pet % 10 = 0 THEN 'not a date' ELSE date END, pet + 1, CASE WHEN pet % 3 = 0 THEN NULL ELSE pet_avg END FROM orders_day WHERE location_id BETWEEN 10 AND 35
  UNION ALL SELECT 2, location_id, date, pet + 2, pet_avg FROM orders_day WHERE location_id >= 30)"""
