import math

import numpy as np
import pytest

from thermolake.operators import forecast


def series(spark, points):
    return spark.createDataFrame([(1, int(t), float(y)) for t, y in points], "k int, t int, y double")


def run(spark, points, **kw):
    return forecast.forecast_trend(series(spark, points), ["k"], "t", "y", **kw).orderBy("year").collect()


def test_exact_line(spark):
    rows = run(spark, [(2000 + i, 10 + 0.5 * i) for i in range(20)])
    assert len(rows) == 81 and rows[0].year == 2020
    assert all(r.pet == r.lower == r.upper and r.warming_rate == 0.5 for r in rows)
    assert rows[0].pet == 20.0 and rows[-1].pet == pytest.approx(60.0)


def test_few_points(spark):
    assert run(spark, [(2000 + i, i) for i in range(9)]) == []
    assert run(spark, []) == []


@pytest.mark.parametrize("n,finite", [(10, False), (16, False), (17, True)])
def test_when_validation_begins(spark, n, finite):
    rng = np.random.default_rng(n)
    rows = forecast.rolling_origin_rmse(series(spark, [(2000 + i, rng.normal()) for i in range(n)]), ["k"], "t", "y").collect()
    assert math.isfinite(rows[0].cv_rmse) == finite


@pytest.mark.parametrize("degree", [1, 2])
def test_validation_equals_refitting(spark, degree):
    rng = np.random.default_rng(5)
    t = np.sort(rng.choice(np.arange(1960, 2024), 24, replace=False)).astype(float)
    y = 0.03 * (t - 1990) + rng.normal(size=24)
    errors = [np.polyval(np.polyfit(t[:i] - t[:i].mean(), y[:i], degree), t[i] - t[:i].mean()) - y[i] for i in range(12, 24)]
    got = forecast.rolling_origin_rmse(series(spark, zip(t, y, strict=True)), ["k"], "t", "y", degree=degree).first().cv_rmse
    assert got == pytest.approx(np.sqrt(np.mean(np.square(errors))), rel=1e-7)


def test_horizon_reached(spark):
    assert run(spark, [(2090 + i, i) for i in range(12)]) == []


def test_exact_parabola(spark):
    t = np.arange(2000, 2020)
    fit = forecast.fit_trend(series(spark, [(x, 0.01 * (x - 2005) ** 2 + 3) for x in t]), ["k"], "t", "y", degree=2).first().model
    assert fit.coef2 == pytest.approx(0.01, rel=1e-6) and fit.rmse == pytest.approx(0, abs=1e-6)


def test_singular(spark):
    assert run(spark, [(2000, i) for i in range(12)]) == []


def test_completeness(spark):
    from datetime import date, timedelta

    days = [date(2023, 1, 1) + timedelta(i) for i in range(365)] + [date(2024, 1, 1) + timedelta(i) for i in range(366) if i != 100]
    daily = spark.createDataFrame([(1, d, 1.0, 2.0) for d in days], "location_id int, date date, pet float, pet_avg float")
    found = {(r.year, r.season) for r in forecast.complete_series(daily).collect()}
    assert found == {(2023, s) for s in ("Annual", "Winter", "Spring", "Summer", "Fall")} | {(2024, s) for s in ("Winter", "Summer", "Fall")}
