import numpy as np

from thermolake.operators import cities

RAW = "City string, State string, Population bigint, lat double, lon double"
SRC = "city string, state string, lat double, lng double, population bigint"


def test_box_keeps_what_lies_inside(spark):
    df = spark.createDataFrame([(40.0, -90.0), (50.0, -80.0), (20.0, -90.0), (35.0, -100.0), (10.0, -130.0)], "lat double, lng double")
    assert cities.in_box(df).count() == 2


def test_headers(spark):
    for schema in (RAW, "name string, State string, pop bigint, lat double, lon double"):
        assert cities.normalise_headers(spark.createDataFrame([], schema)).columns == ["city", "state", "population", "lat", "lng"]


def test_one_city_per_cell_and_ids(spark):
    df = spark.createDataFrame([("Small", "TX", 30.01, -90.01, 1000), ("Big", "TX", 30.02, -90.02, 5000)], SRC)
    rows = cities.build_cities(df).collect()
    assert [(r.city, r.location_id) for r in rows] == [("Big", 0)]


def test_cap_and_coordinates(spark):
    rng = np.random.default_rng(1)
    rows = [(f"c{i}", "S", float(rng.uniform(25, 49)), float(rng.uniform(-124, -67)), int(rng.integers(1, 10**6))) for i in range(900)]
    assert cities.build_cities(spark.createDataFrame(rows, SRC)).count() == 500
    one = cities.build_cities(spark.createDataFrame([("a", "b", 30.12341, -90.98761, 1)], SRC)).first()
    assert (one.lat, one.lng) == (30.123, -90.988)


def test_empty(spark):
    assert cities.build_cities(spark.createDataFrame([], SRC)).count() == 0
