"""Cities at the same coordinates are one place, whose weather, comfort and days are computed once."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from test_updates import PLACES, cheap, days_of, facts_of, grid
from thermolake.operators import updates, weather
from thermolake.plans import registry

SHARED = 8633  # customers so far apart have the same coordinates


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Two places with three cities each, and a day of events at their cells."""
    d = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(k + SHARED * n,) for k in (0, 5) for n in range(3)], "c_custkey long").write.parquet(f"{d}/customer.parquet")
    events = [(h * 400 + u, datetime(2024, 1, 5) + timedelta(hours=h, minutes=1), u) for h in range(24) for u in range(0, 400)]
    spark.createDataFrame(events, "event_id long, ts timestamp, user_id long").write.parquet(f"{d}/events.parquet")
    lines = [(s, f"{y}-03-0{k}", float(s + k)) for s in range(3) for y in (1997, 1998) for k in range(1, 9)]
    spark.createDataFrame(lines, "l_suppkey long, l_shipdate string, l_quantity double").withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp")).write.parquet(f"{d}/lineitem.parquet")
    spark.createDataFrame([(s, s) for s in range(3)], "s_suppkey long, s_nationkey long").write.parquet(f"{d}/supplier.parquet")
    spark.createDataFrame([(s, s) for s in range(3)], "n_nationkey long, n_regionkey long").write.parquet(f"{d}/nation.parquet")
    return d


HOURLY = ["d5_nearest_cell", "d5_store_join", "i18_cossza", "j1_hourly_derivation", "d4_distinct_solve", "d4_memo", "j2_comfort"]


@pytest.mark.parametrize("name", [*HOURLY, "a9_grid_store", "n3_daily_comfort", "d6_resumed_days", "c6_job_counts", "n10_incremental_stats", "n10_comfort_update"])
def test_work_follows_places(spark, tables, monkeypatch, name):
    """Grid rows meet each place, not each of its cities (each place and shard where the query has shards); all cities come out."""
    met = []
    inner = weather.sample_grid
    for module in (weather, registry.gridstore):
        monkeypatch.setattr(module, "sample_grid", lambda *a: met.append(inner(*a)) or met[-1])
    found = registry.queries()[name](spark, tables)
    shards = {"d6_resumed_days": 3, "d4_memo": 2}.get(name, 1)
    assert len(met) == 1 and 0 < met[0].count() <= 2 * shards * 24
    if name in HOURLY:
        rows = sorted(found.withColumn("location_id", F.col("location_id") % SHARED).collect())
        assert found.select("location_id").distinct().count() == 6 and rows[::3] == rows[1::3] == rows[2::3]


CITIES = [(1, 30.1, -130.0), (2, 30.1, -130.0), (3, 30.1, -130.0), (4, 35.0, -125.0), (5, 30.0, -130.05), (6, 30.0, -130.0), (6, 35.0, -125.0), (7, 35.0, -125.0), (7, 35.0, -125.0), (None, 30.1, -130.0), (8, None, -130.0), (9, 80.0, 0.0)]


@pytest.mark.parametrize("together", [1024, 1])
@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_each_city_gets_its_rows(spark, monkeypatch, together, broadcast):
    """As if each city had met the grid by itself: shared coordinates and ids, no id, no coordinates, no cell."""
    monkeypatch.setattr(weather, "CITIES_TOGETHER", together)
    monkeypatch.setattr(weather, "BROADCAST_CITIES", broadcast)
    cities = spark.createDataFrame(CITIES, "location_id int, lat double, lng double")
    rows = grid(spark, PLACES, 3)
    text = lambda df: sorted(str(sorted(r.asDict().items())) for r in df.collect())
    for shards in (1, 2):
        places, members = weather.by_place(cities, shards)
        wanted = weather.derive_weather(weather.sample_grid(rows, cities))
        derived = weather.derive_weather(weather.sample_grid(rows, places))
        once = "location_id is not null and location_id <> 6"  # places of one id share its rows below
        assert text(weather.each_city(derived, members).where(once)) == text(wanted.where(once))
        days = lambda df: weather.daily_comfort(df.withColumn("pet", F.rint("t").cast("float")))
        assert text(weather.each_city(days(derived), members)) == text(days(wanted))
    assert places.where("location_id < 4").agg(F.sum("cities")).first()[0] == 3 and places.where("location_id < 4").count() == 2


def test_days_by_place_are_days_by_city(spark, tmp_path):
    cities = spark.createDataFrame([(k, *PLACES[k % 2]) for k in range(7)], "location_id int, lat double, lng double")
    years, rows = spark.createDataFrame([(2024,)], "year int"), grid(spark, PLACES[:2], 24 * 9)
    one = updates.compute_days(weather.sample_grid(rows, cities), years, f"{tmp_path}/one", cheap, 168, 3)

    def by_place(rows, seen):
        found = rows.withColumn("pet", F.when(F.col("t") < 20, F.rint("t")).cast("float"))
        return found.observe(seen, weather.city_hours(found, F.col("pet").isNull()).alias("comfort")).dropna(subset=["pet"])

    places, members = weather.by_place(cities, 3)
    for only in ("shard = 1", None):
        two = updates.compute_days(weather.sample_grid(rows, places), years, f"{tmp_path}/two", by_place, 168, 3, only=only, members=members)
    assert days_of(one) == days_of(two) and one.manifest().parts.keys() == two.manifest().parts.keys()
    whole = updates.compute_days(weather.sample_grid(rows, places), years, f"{tmp_path}/three", by_place, 168, 3, members=members)
    assert whole.manifest().facts["counts"] == one.manifest().facts["counts"]


def test_a_refresh_collects_years_not_locations(spark, tmp_path, monkeypatch):
    facts = facts_of(spark, f"{tmp_path}/facts", years=2, places=40)
    updates.refresh_statistics(facts, f"{tmp_path}/stats")
    facts.delete_window("date", "2000-07-01", "2000-07-01")
    sizes, kind = [], type(facts.scan())
    collect = kind.collect
    monkeypatch.setattr(kind, "collect", lambda self: (lambda rows: sizes.append(len(rows)) or rows)(collect(self)))
    assert updates.refresh_statistics(facts, f"{tmp_path}/stats")[1] == 40
    assert sizes and max(sizes) <= 2


def test_days_are_dealt_out_before_they_multiply(spark):
    """Also where days were just put together by the same columns: the optimiser must not drop the deal and leave the copies to a few tasks."""
    hours = spark.range(200 * 24).select((F.col("id") % 200).cast("int").alias("location_id"), (1087000 + F.col("id") / 200).cast("int").alias("hour"), F.lit(1.0).cast("float").alias("pet"))
    members = spark.range(200).select(F.col("id").cast("int").alias("_place"), F.array(F.col("id").cast("int"), (F.col("id") + 200).cast("int")).alias("ids"))
    found = weather.each_city(weather.daily_comfort(hours), members)
    per_task = [r["n"] for r in found.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    assert len(per_task) == tasks and sum(per_task) == 2 * weather.daily_comfort(hours).count() and max(per_task) < 2 * sum(per_task) / tasks
