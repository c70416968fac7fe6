"""The grid store, the memo of solved tuples, resumable days, and refreshes in proportion to change."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from thermolake.operators import forecast, gridstore, snapshots, stats, tables, updates, weather

GRID = "hour int, lat double, lng double, u10 double, v10 double, t2 double, d2 double, ssrd double, strd double, ssr double, str double, fdir double"
FIRST = 1087008  # the third of January 2024


def grid(spark, places, hours, first=FIRST):
    rows = [(first + h, lat, lng, 1.0 + k % 3, 1.0, 275.0 + (h * 7 + k) % 20, 270.0 + (h * 7 + k) % 20, 9e5, 1e6, 8e5, -2e5, 3e5) for k, (lat, lng) in enumerate(places) for h in range(hours)]
    return spark.createDataFrame(rows, GRID)


def cities(spark, places):
    return spark.createDataFrame([(i, lat + 0.05, lng - 360.05 if lng > 180 else lng + 0.05) for i, (lat, lng) in enumerate(places)], "location_id int, lat double, lng double")


def cheap(rows, seen=None):
    found = rows.withColumn("pet", F.when(F.col("t") < 20, F.rint("t")).cast("float"))
    return (found.observe(seen, F.count(F.when(F.col("pet").isNull(), 1)).alias("comfort")) if seen is not None else found).dropna(subset=["pet"])


def read(df):
    """Files and bytes that a query's scans have opened."""
    df.collect()
    found, plans = [0, 0], [df._jdf.queryExecution().executedPlan()]
    while plans:
        plan = plans.pop()
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            plans.append(plan.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            plans.append(plan.plan())
            continue
        if name == "FileSourceScanExec":
            for k, m in enumerate(("numFiles", "filesSize")):
                found[k] += plan.metrics().apply(m).value()
        plans += [plan.children().apply(i) for i in range(plan.children().size())]
    return found


PLACES = [(30.0 + 5 * i, 230.0 + 5 * j) for i in range(4) for j in range(5)]


def test_cities_read_their_own_tiles(spark, tmp_path):
    store = gridstore.write_grid(grid(spark, PLACES, 48), f"{tmp_path}/grid")
    assert len(store.manifest().parts) == 20
    whole = read(store.scan())
    some, one = (read(gridstore.scan_cities(store, cities(spark, PLACES[:n]))) for n in (5, 1))
    assert whole[0] == 20 and some[0] == 5 and one[0] == 1
    assert one[1] < some[1] / 3 < whole[1] / 9
    wanted = weather.sample_grid(grid(spark, PLACES, 48), cities(spark, PLACES[:5]))
    found = gridstore.scan_cities(store, cities(spark, PLACES[:5])).select(wanted.columns)
    assert sorted(found.collect()) == sorted(wanted.collect())


def test_a_store_grows_by_years_and_hours_choose_them(spark, tmp_path):
    store = gridstore.write_grid(grid(spark, PLACES[:3], 24), f"{tmp_path}/grid")
    gridstore.write_grid(grid(spark, PLACES[:3], 24, FIRST - 72), f"{tmp_path}/grid")
    places = cities(spark, PLACES[:3])
    assert gridstore.scan_cities(store, places).count() == 3 * 48
    last_day = gridstore.scan_cities(store, places, (FIRST - 72, FIRST - 49))
    assert last_day.count() == 3 * 24 and read(last_day)[0] == 3
    assert gridstore.scan_cities(store, places, (FIRST - 50, FIRST + 4)).count() == 3 * 7
    assert gridstore.scan_cities(store, places.limit(0)).count() == 0
    with pytest.raises(ValueError, match="kept by"):
        gridstore.write_grid(grid(spark, PLACES[:1], 1), f"{tmp_path}/grid", side=4)


@pytest.mark.parametrize(("lat", "lng"), [(89.99, 359.99), (-90.0, 0.0), (90.0, 180.0), (0.0, -0.1), (12.3, -180.0)])
def test_a_city_lies_in_its_cells_tile(spark, lat, lng):
    """A city and the grid point that is nearest to it have the same tile, at the poles and where longitudes wrap too."""
    point = spark.createDataFrame([(lat, lng, round(lat * 4) / 4, round((lng % 360) * 4) % 1440 / 4)], "a double, b double, c double, d double")
    r = point.select(gridstore.tile_of(F.col("a"), F.col("b")).alias("x"), gridstore.tile_of(F.col("c"), F.col("d")).alias("y")).first()
    assert r.x == r.y


def test_a_second_run_solves_what_is_new(spark, tmp_path):
    memo = weather.comfort_memo(spark, f"{tmp_path}/memo")
    rows = weather.derive_weather(weather.sample_grid(grid(spark, PLACES[:4], 24), cities(spark, PLACES[:4])))
    fresh = sorted(weather.with_pet(rows).collect())
    assert sorted(weather.with_pet(rows.where("location_id < 2"), memo=memo).select(weather.with_pet(rows).columns).collect()) == [r for r in fresh if r.location_id < 2]
    solved = memo.scan().count()
    assert sorted(weather.with_pet(rows, memo=memo).select(weather.with_pet(rows).columns).collect()) == fresh
    all_tuples = memo.scan().count()
    assert all_tuples == memo.scan().select(*weather.INPUTS).distinct().count() > solved
    weather.with_pet(rows, memo=memo)
    assert memo.scan().count() == all_tuples
    with pytest.raises(ValueError, match="holds values"):
        weather.comfort_memo(spark, f"{tmp_path}/memo", icl=0.9)


def days_of(table):
    return sorted(tuple(r) for r in table.scan().select("location_id", "date", "pet", "pet_avg").collect())


def test_days_are_resumed(spark, tmp_path):
    sampled = weather.sample_grid(grid(spark, PLACES[:5], 24 * 40), cities(spark, PLACES[:5]))
    years = spark.createDataFrame([(2024,)], "year int")
    whole = updates.compute_days(sampled, years, f"{tmp_path}/whole", cheap, 168, 2)
    calls = []

    def counted(rows, seen):
        calls.append(rows.select("location_id", "hour").distinct().count())
        return cheap(rows, seen)

    path = f"{tmp_path}/days"
    updates.compute_days(sampled, years, path, counted, 168, 2, only="batch < 2 and shard = 1")
    table = updates.compute_days(sampled, years, path, counted, 168, 2)
    assert calls[0] + calls[1] == 5 * 24 * 40 and days_of(table) == days_of(whole)
    assert table.done().count() == 53 * 2  # batches without hours are done too
    updates.compute_days(sampled, years, path, counted, 168, 2)
    assert len(calls) == 2 and table.versions() == [1, 2]
    updates.compute_days(sampled, years, path, counted, 168, 2, force=True)
    assert calls[2] == 5 * 24 * 40 and days_of(table) == days_of(whole)
    with pytest.raises(ValueError, match="batches and shards"):
        updates.compute_days(sampled, years, path, cheap, 240, 2)
    with pytest.raises(ValueError, match="whole days"):
        updates.planned_parts(years, 100, 1)


def test_a_job_that_fails_leaves_the_parts_to_do(spark, tmp_path):
    sampled = weather.sample_grid(grid(spark, PLACES[:2], 48), cities(spark, PLACES[:2]))
    years, path = spark.createDataFrame([(2024,)], "year int"), f"{tmp_path}/days"
    updates.compute_days(sampled, years, path, cheap, only="batch > 3")

    def fails(rows, seen):
        return cheap(rows, seen).withColumn("pet", F.when(F.col("hour") > FIRST + 30, F.raise_error(F.lit("lost"))).otherwise(F.col("pet")))

    with pytest.raises(Exception, match="lost"):
        updates.compute_days(sampled, years, path, fails)
    assert snapshots.SnapshotTable(spark, path).scan().count() == 0
    assert updates.compute_days(sampled, years, path, cheap).scan().count() == 4


def test_the_job_counts_what_it_leaves_out(spark, tmp_path):
    rows = grid(spark, PLACES[:2], 24)
    rows = rows.withColumn("strd", F.when((F.col("hour") % 6 == 0) & (F.col("lng") == 230.0), -9e9).otherwise(F.col("strd"))).withColumn("u10", F.when(F.col("hour") % 12 == 1, 0.0).otherwise(F.col("u10"))).withColumn("v10", F.when(F.col("hour") % 12 == 1, 0.0).otherwise(F.col("v10")))
    table = updates.compute_days(weather.sample_grid(rows, cities(spark, PLACES[:2])), spark.createDataFrame([(2024,)], "year int"), f"{tmp_path}/days", cheap)
    warm = rows.where("t2 >= 293.15 and hour % 12 <> 1 and not (hour % 6 = 0 and lng = 230.0)").count()
    assert table.manifest().facts["counts"] == {"hours": 48, "radiation": 4, "weather": 4, "comfort": warm}


def facts_of(spark, path, years=12, places=3):
    rows = [(p, y, d) for p in range(places) for y in range(2000, 2000 + years) for d in range(1, 366 + (y % 4 == 0))]
    df = spark.createDataFrame(rows, "location_id int, y int, d int").select("location_id", F.date_add(F.make_date("y", F.lit(1), F.lit(1)), F.col("d") - 1).alias("date"), ((F.col("d") * 7 + F.col("y") * 3 + F.col("location_id") * 5) % 40).cast("float").alias("pet"))
    return snapshots.create(tables.with_year(df.withColumn("pet_avg", (F.col("pet") / 2).cast("float"))), path, ["year"])


def test_statistics_and_forecasts_follow_changes_alone(spark, tmp_path):
    facts = facts_of(spark, f"{tmp_path}/facts")
    make = lambda df: forecast.forecast(df)
    kept, n = updates.refresh_statistics(facts, f"{tmp_path}/stats")
    assert n == 36
    ahead, n = updates.refresh_forecasts(facts, f"{tmp_path}/fc", make)
    assert n == 3
    assert updates.refresh_statistics(facts, f"{tmp_path}/stats")[1] == updates.refresh_forecasts(facts, f"{tmp_path}/fc", make)[1] == 0
    facts.upsert(spark.createDataFrame([(1, date(2005, 7, 1), 90.0), (9, date(2005, 7, 1), 1.0), (1, date(2007, 1, 1), 90.0)], "location_id int, date date, pet float"), ["location_id", "date"])
    facts.delete_window("date", "2011-12-31", "2011-12-31")
    before = kept.manifest().parts
    kept, n = updates.refresh_statistics(facts, f"{tmp_path}/stats")
    assert n == 6  # two changed, one new, and the last year of three
    assert {p for p, f in kept.manifest().parts.items() if before.get(p) != f} == {"year=2005", "year=2007", "year=2011"}
    full = stats.year_stats(facts.scan())
    assert stats.table_diff(kept.scan().select(full.columns), full).first().asDict() == {"missing": 0, "extra": 0}
    ahead, n = updates.refresh_forecasts(facts, f"{tmp_path}/fc", make)
    assert n == 4
    full = make(facts.scan())
    assert stats.table_diff(ahead.scan().select(full.columns), full).first().asDict() == {"missing": 0, "extra": 0}
    facts.delete_window("date", "2000-01-01", "2011-12-30")  # what has no facts any more has no statistics
    assert updates.refresh_statistics(facts, f"{tmp_path}/stats")[0].scan().count() == 0
