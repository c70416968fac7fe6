from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermolake.operators import history, numbering, stats, tables, weather

# Small cases of merging, windows and gates below, whose results must be what they are.
PET = "location_id int, date date, pet float, pet_avg float"
LEGACY = "location_id int, date string, pet double"


def facts(spark, rows):
    return spark.createDataFrame(rows, PET)


def test_later_source_wins(spark):
    a = spark.createDataFrame([(1, "2024-05-01", 20.0), (2, "2023-05-01", 21.0)], LEGACY)
    b = spark.createDataFrame([(1, "2024-05-01", 25.0), (3, "2024-05-02", 30.0), (4, "no date", 1.0)], LEGACY)
    columns = {"location_id": "int", "date": "string", "pet": "float", "pet_avg": "float"}
    rows = history.merge_history([a, b], ["location_id", "date"], ["pet"], columns).collect()
    assert [(r.location_id, r.date, r.pet, r.pet_avg) for r in rows] == [(1, "2024-05-01", 25.0, None), (2, "2023-05-01", 21.0, None), (3, "2024-05-02", 30.0, None)]


def test_column_union(spark):
    old, new = spark.createDataFrame([(1, "2024-01-01", 1.0)], LEGACY), facts(spark, []).withColumn("date", F.col("date").cast("string"))
    assert history.union_sources([old, new]).columns == ["location_id", "date", "pet", "pet_avg"]


def test_upsert_keeps_columns_that_are_not_supplied(spark):
    base = facts(spark, [(1, date(2024, 1, 1), 1.0, 9.0), (2, date(2024, 1, 1), 2.0, 8.0)])
    staged = base.where("location_id = 1").select("location_id", "date", (F.col("pet") + 4).cast("float").alias("pet"))
    rows = {r.location_id: (r.pet, r.pet_avg) for r in tables.merge_upsert(base, staged, ["location_id", "date"]).collect()}
    assert rows == {1: (5.0, 9.0), 2: (2.0, 8.0)}


def test_upsert_of_keys_alone_changes_nothing(spark):
    base = facts(spark, [(1, date(2024, 1, 1), 1.0, 9.0)])
    staged = spark.createDataFrame([(1, date(2024, 1, 1)), (5, date(2024, 1, 1))], "location_id int, date date")
    rows = {r.location_id: r.pet for r in tables.insert_absent(base, staged, ["location_id", "date"]).collect()}
    assert rows == {1: 1.0, 5: None}


def test_deleting_a_whole_year_removes_its_folder(spark, tmp_path):
    path = f"{tmp_path}/facts"
    tables.write_partitioned(tables.with_year(facts(spark, [(1, date(2023, 6, 1), 1.0, 1.0), (1, date(2024, 1, 5), 2.0, 2.0), (1, date(2024, 2, 5), 3.0, None)])), path)
    tables.delete_window_in_table(spark, path, "date", "2023-01-01", "2024-01-31")
    assert [r.pet for r in spark.read.parquet(path).collect()] == [3.0]
    assert not (tmp_path / "facts" / "year=2023").exists()


def test_window_ends_belong_to_it(spark):
    df = facts(spark, [(1, date(2024, 1, d), float(d), None) for d in (1, 15, 31)] + [(1, date(2024, 2, 1), 0.0, None)])
    assert [r.pet for r in tables.delete_window(df, "date", "2024-01-01", "2024-01-31").collect()] == [0.0]


def test_overwrite_of_its_own_input(spark, tmp_path):
    path = f"{tmp_path}/t"
    first = tables.overwrite(spark.range(10), path)
    assert tables.overwrite(first.where("id > 6"), path).count() == 3


def test_empty_csv_has_its_header(spark, tmp_path):
    tables.write_csv(spark.createDataFrame([], "a int, b double"), f"{tmp_path}/c", ["a"], {"b": 3})
    assert "".join(p.read_text() for p in (tmp_path / "c").glob("part-*")).strip() == "a,b"


def test_common_keys_and_selection(spark):
    a, b = (spark.createDataFrame(rows, "y int, t int") for rows in ([(2020, 1), (2020, 2)], [(2020, 1)]))
    assert [tuple(r) for r in history.common_keys([a, b], ["y", "t"]).collect()] == [(2020, 1)]
    keys = spark.range(10).select(F.col("id").alias("k"))
    halves = [{r.k for r in history.every_nth(keys, ["k"], i, 2).collect()} for i in (0, 1)]
    assert [len(h) for h in halves] == [5, 5] and not halves[0] & halves[1]
    with pytest.raises(ValueError):
        history.every_nth(keys, ["k"], 2, 2)


def test_time_batches(spark):
    from thermolake.functions.scalars import year_hours

    first, last = year_hours(2024)
    rows = history.time_batches(spark, first, last, 720).orderBy("batch_index").collect()
    assert len(rows) == 13 and [r.batch_index for r in rows] == list(range(13))
    assert rows[0].start_h == first and rows[-1].end_h == last and all(a.end_h + 1 == b.start_h for a, b in zip(rows, rows[1:], strict=False))


def test_history_gate(spark):
    def years(n, missing=0):
        return facts(spark, [(1, date(2000 + i, 1, 1), 1.0, None if i < missing else 1.0) for i in range(n)])

    with pytest.raises(ValueError, match="at least 10"):
        stats.require_history(years(3))
    assert stats.require_history(years(12, 7)) == "warning"
    assert stats.require_history(years(12, 0)) == "ok"


def test_pending(spark):
    planned, done = spark.range(4).withColumnRenamed("id", "b"), spark.range(2).withColumnRenamed("id", "b")
    assert history.pending(planned, done, ["b"]).count() == 2
    assert history.pending(planned, done, ["b"], force=True).count() == 4


def test_warm_city_stays_above_cold_city(spark):
    hours = range(1087008, 1087032)
    grid = [(h, 30.0 + c, 270.0, 1.0, 1.0, 300.0 - 20 * c, 290.0 - 20 * c, 0.0, 300.0 * 3600, 0.0, -60.0 * 3600, 0.0) for h in hours for c in (0, 1)]
    names = "hour int, lat double, lng double, `10u` double, `10v` double, `2t` double, `2d` double, ssrd double, strd double, ssr double, str double, fdir double"
    raw = spark.createDataFrame(grid, names)
    df = raw.select("hour", "lat", "lng", *[F.col(c).alias(k) for k, c in weather.resolve_variables(raw.columns).items()])
    cities = spark.createDataFrame([(1, 30.05, -89.95), (2, 31.0, -90.0)], "location_id int, lat double, lng double")
    rows = {r.location_id: r for r in weather.daily_comfort(weather.with_pet(weather.derive_weather(weather.sample_grid(df, cities)))).collect()}
    assert rows[1].pet > rows[2].pet
    with pytest.raises(ValueError, match="no column for"):
        weather.resolve_variables(["10u"])


def grid_and_cities(spark):
    names = "hour int, lat double, lng double, u10 double, v10 double, t2 double, d2 double, ssrd double, strd double, ssr double, str double, fdir double"
    rows = [(1087008 + h, 30.0 + c, 270.0, 1.0, 1.0, 275.0 + h, 270.0 + h, 9e5, 1e6, 8e5, -2e5, 3e5) for h in range(24) for c in (0, 1)]
    return spark.createDataFrame(rows, names), spark.createDataFrame([(1, 30.05, -89.95), (2, 31.0, -90.0)], "location_id int, lat double, lng double")


def test_the_join_of_grid_and_cities_is_on_cells_alone(spark):
    """Formulas and filters stay out of its condition, in which the optimiser would repeat them."""
    plan = weather.derive_weather(weather.sample_grid(*grid_and_cities(spark)))._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert len(joins) == 1 and len(joins[0]) < 200 and "COS" not in joins[0]
    assert plan.upper().count("COS(") < 40


def test_the_solver_is_spread(spark):
    seen = spark.sparkContext.accumulator(0)
    df = spark.range(400).select((F.col("id") % 200).cast("double").alias("t"))

    def run(batches):
        seen.add(1)
        for b in batches:
            yield b.assign(y=2 * b.t)

    found = weather.solve_distinct(df, ["t"], run, T.StructField("y", T.DoubleType()))
    assert found.where("y = 2 * t").count() == 400
    assert seen.value >= 4  # as many tasks as a shuffle has


def test_solved_tuples_beyond_the_broadcast_are_joined(spark, monkeypatch):
    monkeypatch.setattr(weather, "BROADCAST_SOLVED", 0)
    monkeypatch.setattr(weather, "BROADCAST_CITIES", 0)
    rows = weather.with_pet(weather.derive_weather(weather.sample_grid(*grid_and_cities(spark))))
    assert rows.count() == 48


def test_a_large_year_is_many_files(spark, tmp_path):
    rows = spark.range(200_000).select((F.col("id") % 50).cast("int").alias("location_id"), F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 366).cast("int")).alias("date"), F.rand(1).alias("pet"), F.rand(2).alias("pet_avg"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
        tables.write_partitioned(tables.with_year(rows), f"{tmp_path}/facts")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    assert len(list((tmp_path / "facts" / "year=2024").glob("*.parquet"))) > 2
    tables.replace_partitions(spark.read.parquet(f"{tmp_path}/facts").where("location_id < 10"), f"{tmp_path}/facts", "year", [2024])
    assert spark.read.parquet(f"{tmp_path}/facts").count() == 40_000
    assert [p.name for p in tmp_path.iterdir()] == ["facts"]


def test_of_staged_rows_the_last_source_file_and_row_counts(spark, tmp_path):
    key = (1, date(2024, 1, 1))
    first = spark.createDataFrame([(*key, 1.0, 1.0), (*key, 2.0, 2.0)], PET).coalesce(1)
    first.write.parquet(f"{tmp_path}/a")
    staged = spark.read.parquet(f"{tmp_path}/a")
    tables.write_partitioned(tables.with_year(facts(spark, [(*key, 9.0, 9.0)])), f"{tmp_path}/t")
    tables.upsert_table(spark, f"{tmp_path}/t", staged, ["location_id", "date"])
    assert spark.read.parquet(f"{tmp_path}/t").first().pet == 2.0
    tables.upsert_table(spark, f"{tmp_path}/t", [staged, facts(spark, [(*key, 0.5, None)]).select("location_id", "date", "pet")], ["location_id", "date"])
    assert spark.read.parquet(f"{tmp_path}/t").first().asDict()["pet"] == 0.5


def test_selection_of_parts_after_a_filter(spark):
    keys = spark.createDataFrame([(y, t) for y in (2020, 2021) for t in range(5)], "y int, t int")
    some = (F.col("y") == 2021) & F.col("t").isin(1, 2, 4)
    assert sorted(tuple(r) for r in history.every_nth(keys, ["y", "t"], 0, 2, some).collect()) == [(2021, 1), (2021, 4)]


def test_dense_ids(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"))
    assert all(r.k == r.n for r in numbering.dense_ids(df, ["k"], "n").collect())
    assert numbering.dense_ids(df.limit(0), ["k"], "n").count() == 0


def test_hourly_frame(spark):
    cities = spark.createDataFrame([(1, 3, 5), (2, 7, 7), (3, 9, 8)], "location_id int, a int, b int")
    assert sorted(tuple(r) for r in weather.hourly_frame(cities, F.col("a"), F.col("b")).collect()) == [(1, 3), (1, 4), (1, 5), (2, 7)]
    assert weather.hourly_frame(cities, 1, 2).count() == 6


def test_grouping_sets_give_the_same_rows(spark):
    df = facts(spark, [(i % 3, date(2024, 1 + i % 12, 1 + i % 28), float(i % 40), None if i % 7 == 0 else float(i % 13)) for i in range(400)])
    assert stats.table_diff(stats.year_stats(df), stats.year_stats_grouping_sets(df)).first().asDict() == {"missing": 0, "extra": 0}
