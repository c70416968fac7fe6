from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from thermolake.functions import scalars as S


def values(spark, rows, column):
    return [r[0] for r in spark.createDataFrame([(x,) for x in rows], "x double").select(column(F.col("x"))).collect()]


def test_longitudes(spark):
    given = [x / 8 for x in range(-2880, 2881, 7)]
    wrapped, signed = values(spark, given, S.wrap360), values(spark, given, lambda x: S.to_180(S.wrap360(x)))
    for x, w, s in zip(given, wrapped, signed, strict=True):
        assert 0 <= w < 360 and (w - x) % 360 == 0
        assert -180 < s <= 180 and (s - x) % 360 == 0


def test_flux(spark):
    joules = [0.0, 86400.0, 5.4e6, -900.0]
    assert values(spark, joules, S.flux) == [0.0, 24.0, 1500.0, -0.25]


def test_rounding(spark):
    assert values(spark, [1.25, 1.75, 2.25], lambda x: S.rint_to(x, 2.0)) == [1.0, 2.0, 2.0]
    assert values(spark, [28.849999999999998, -0.25], lambda x: S.round_half_up(x, 1).cast("double")) == [28.9, -0.3]


def test_seasons_and_days(spark):
    days = [date(2024, m, 15) for m in range(1, 13)]
    found = [r[0] for r in spark.createDataFrame([(d,) for d in days], "d date").select(S.season(F.col("d"))).collect()]
    assert found == ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Fall"] * 3 + ["Winter"]
    rows = spark.createDataFrame([(y, s) for y in (1900, 2000, 2023, 2024) for s in S.SEASONS], "y int, s string").select(S.expected_days(F.col("y"), F.col("s"))).collect()
    assert [r[0] for r in rows] == [365, 90, 92, 92, 91, 366, 91, 92, 92, 91, 365, 90, 92, 92, 91, 366, 91, 92, 92, 91]


def test_hours():
    for year, n in ((2024, 8784), (2023, 8760)):
        first, last = S.year_hours(year)
        assert last - first + 1 == n
    assert S.year_hours(1900)[0] == 0


def test_hour_round_trip(spark):
    first, _ = S.year_hours(2024)
    row = spark.createDataFrame([(first,)], "h int").select(S.hour_to_ts(F.col("h")).alias("t")).select("t", S.ts_to_hour(F.col("t")).alias("h")).first()
    assert row.h == first and row.t == datetime(2024, 1, 1)


def test_beam_radiation(spark):
    """What falls on a level plane, divided by the sun's height, from a cosine of a tenth on."""
    df = spark.createDataFrame([(c / 16, 80.0 * c) for c in range(17)] + [(0.75, -4.0)], "c double, f double")
    found = [r[0] for r in df.select(S.dsrp(F.col("f"), F.col("c"))).collect()]
    assert found == [0.0, 0.0, *[1280.0] * 15, 0.0]


def test_not_finite(spark):
    assert values(spark, [1.0, float("nan"), float("inf"), None], S.is_finite) == [True, False, False, False]
    assert values(spark, [22.0, 61.0, -55.0, float("nan")], lambda x: S.null_outside(x, -50.0, 60.0)) == [22.0, None, None, None]


@pytest.mark.parametrize("lat,lng,hour,day", [(0.0, 0.0, 12, True), (0.0, 0.0, 0, False), (40.0, -105.0, 19, True)])
def test_sun(spark, lat, lng, hour, day):
    df = spark.createDataFrame([(lat, lng, datetime(2024, 3, 20, hour))], "a double, b double, t timestamp")
    value = df.select(S.cossza(F.col("a"), F.col("b"), F.col("t"))).first()[0]
    assert (value > 0.3) == day and 0 <= value <= 1
