"""Trend fits, rolling-origin validation and forecasts with intervals, as aggregates and windows over (keys, period, value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from thermolake.functions import scalars as S

INTERVAL_Z = 1.2816
SINGULAR = 1e-12


def _moments(x: Column, y: Column, degree: int, over) -> dict[str, Column]:
    power = lambda k: F.sum(F.pow(x, F.lit(float(k)))).over(over)
    found = {"n": F.count(y).over(over).cast("double"), "x1": F.sum(x).over(over), "x2": F.sum(x * x).over(over), "y": F.sum(y).over(over), "xy": F.sum(x * y).over(over)}
    return found | ({"x3": power(3), "x4": power(4), "x2y": F.sum(x * x * y).over(over)} if degree == 2 else {})


def _coefficients(m: dict[str, Column], degree: int) -> tuple[Column, Column, Column]:
    """(c2, c1, c0) of the least-squares polynomial; null where there are too few points or the system is singular."""
    if degree == 1:
        det = m["n"] * m["x2"] - m["x1"] * m["x1"]
        ok = (m["n"] > 1) & (F.abs(det) >= SINGULAR)
        c1 = (m["n"] * m["xy"] - m["x1"] * m["y"]) / det
        return F.when(ok, F.lit(0.0)), F.when(ok, c1), F.when(ok, (m["y"] - c1 * m["x1"]) / m["n"])
    rows = [[m["x4"], m["x3"], m["x2"]], [m["x3"], m["x2"], m["x1"]], [m["x2"], m["x1"], m["n"]]]
    right = [m["x2y"], m["xy"], m["y"]]

    def det3(a):
        return sum(a[0][i] * (a[1][(i + 1) % 3] * a[2][(i + 2) % 3] - a[1][(i + 2) % 3] * a[2][(i + 1) % 3]) for i in range(3))

    det = det3(rows)
    ok = (m["n"] > 2) & (F.abs(det) >= SINGULAR)
    return tuple(F.when(ok, det3([[right[r] if c == k else rows[r][c] for c in range(3)] for r in range(3)]) / det) for k in range(3))


def fit_trend(df: DataFrame, keys: list[str], period: str, value: str, degree: int = 1, min_train: int = 12, min_errors: int = 5) -> DataFrame:
    """keys, n, last and model (degree, coef2, coef1, coef0, reference_year, rmse, cv_rmse) of every series.

    One shuffle by the keys: totals and running sums are windows over the same partitioning. Rows with a null
    period or value are left out. Series of as many points as the degree, or singular ones, have no model.
    The validation error is infinite with fewer than min_train + 3 points or fewer than min_errors errors.
    """
    rows = df.where(F.col(period).isNotNull() & F.col(value).isNotNull()).select(*keys, F.col(period).alias("_t"), F.col(value).cast("double").alias("_y"))
    every = Window.partitionBy(*keys)
    ordered = every.orderBy("_t")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_ref", F.percentile("_t", F.lit(0.5)).over(every)).withColumn("_x", F.col("_t") - F.col("_ref"))
    x, y = F.col("_x"), F.col("_y")
    sums = {f"_b{k}": v for k, v in _moments(x, y, degree, before).items()} | {f"_a{k}": v for k, v in _moments(x, y, degree, every).items()}
    rows = rows.withColumns(sums | {"_nth": F.row_number().over(ordered)})
    of = lambda mark: {k[2:]: F.col(k) for k in sums if k.startswith(mark)}
    p2, p1, p0 = _coefficients(of("_b"), degree)
    a2, a1, a0 = _coefficients(of("_a"), degree)
    rows = rows.withColumns({"_c2": a2, "_c1": a1, "_c0": a0, "_p": p2 * x * x + p1 * x + p0})
    miss = F.when(F.col("_nth") > min_train, F.pow(F.col("_p") - y, F.lit(2.0)))
    off = F.pow(F.col("_c2") * x * x + F.col("_c1") * x + F.col("_c0") - y, F.lit(2.0))
    fitted = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.max("_t").alias("last"), F.first("_ref").alias("_ref"), *[F.first(c).alias(c) for c in ("_c2", "_c1", "_c0")], F.sqrt(F.avg(off)).alias("_rmse"), F.sqrt(F.avg(miss)).alias("_cv"), F.count(miss).alias("_errors"))
    cv = F.when((F.col("n") >= min_train + 3) & (F.col("_errors") >= min_errors), F.col("_cv")).otherwise(F.lit(float("inf")))
    model = F.struct(F.lit(degree).alias("degree"), F.col("_c2").alias("coef2"), F.col("_c1").alias("coef1"), F.col("_c0").alias("coef0"), F.col("_ref").alias("reference_year"), F.col("_rmse").alias("rmse"), cv.alias("cv_rmse"))
    return fitted.select(*keys, "n", "last", F.when(F.col("_c1").isNotNull(), model).alias("model"))


def rolling_origin_rmse(df: DataFrame, keys: list[str], period: str, value: str, min_train: int = 12, min_errors: int = 5, degree: int = 1) -> DataFrame:
    """keys, cv_rmse: the error of predicting each point from all earlier ones."""
    return fit_trend(df, keys, period, value, degree, min_train, min_errors).select(*keys, F.col("model.cv_rmse").alias("cv_rmse"))


def forecast_trend(df: DataFrame, keys: list[str], period: str, value: str, min_periods: int = 10, min_train: int = 12, min_cv_errors: int = 5, horizon_end: int = 2100, degree: int = 1) -> DataFrame:
    """One row for each future period: keys, year, pet, lower, upper, model_type, full_years_used, warming_rate, acceleration."""
    fits = fit_trend(df, keys, period, value, degree, min_train, min_cv_errors).where((F.col("n") >= min_periods) & F.col("model").isNotNull() & (F.col("last") < horizon_end))
    rows = fits.withColumn("t", F.explode(F.sequence(F.col("last") + 1, F.lit(horizon_end).cast(fits.schema["last"].dataType))))
    m, t, last = F.col("model"), F.col("t").cast("double"), F.col("last")
    raw = S.model_predict(m, t)
    horizon = F.least((F.col("t") - last).cast("double"), F.lit(25.0))
    if degree == 2:  # the curve gives way to its tangent between 15 and 35 periods on
        begin, end = F.least(last + 15, F.lit(horizon_end)).cast("double"), F.least(last + 35, F.lit(horizon_end)).cast("double")
        tail = S.model_predict(m, begin) + (t - begin) * S.model_slope(m, begin)
        weight = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.try_divide(t - begin, end - begin)))
        center = F.when(begin < end, raw * (1.0 - weight) + tail * weight).otherwise(raw)
        spread = F.pow(horizon / 30.0, F.lit(2.0))
    else:
        center, spread = raw, F.lit(0.0)
    base = F.greatest(m["rmse"], F.when(S.is_finite(m["cv_rmse"]), m["cv_rmse"]).otherwise(F.lit(0.0)))
    half = INTERVAL_Z * base * F.sqrt(1.0 + horizon / 10.0 + spread)
    return rows.select(
        *keys, F.col("t").cast("smallint").alias("year"), S.round_half_up(center, 1).cast("float").alias("pet"), S.round_half_up(center - half, 1).cast("float").alias("lower"), S.round_half_up(center + half, 1).cast("float").alias("upper"),
        F.lit("quadratic" if degree == 2 else "linear").alias("model_type"), F.col("n").cast("smallint").alias("full_years_used"), S.round_half_up(S.model_slope(m, t), 2).cast("float").alias("warming_rate"), S.round_half_up(S.model_acceleration(m), 3).cast("float").alias("acceleration"),
    )


def _yearly(daily: DataFrame) -> DataFrame:
    """Both tracks of complete seasons from one pass over the facts: mean of pet_avg and maximum of pet."""
    seasons = daily.select("location_id", "date", "pet", "pet_avg", F.explode(S.with_annual(F.col("date"))).alias("season"))
    by_day = seasons.groupBy("location_id", "date", "season").agg(F.avg("pet_avg").cast("float").alias("mean"), F.max("pet").cast("float").alias("top"))
    by_year = by_day.groupBy("location_id", F.year("date").alias("year"), "season").agg(F.avg("mean").cast("float").alias("mean"), F.max("top").alias("top"), F.count("mean").alias("mean_days"), F.count("top").alias("top_days"))
    return by_year.withColumn("expected", S.expected_days(F.col("year"), F.col("season")))


def complete_series(daily: DataFrame, track: str = "mean") -> DataFrame:
    """location_id, season, year, pet of the seasons with all their days; track: mean (of pet_avg) or top (maximum of pet)."""
    rows = _yearly(daily).where(F.col(f"{track}_days") == F.col("expected"))
    return rows.select(F.col("location_id").cast("smallint").alias("location_id"), "season", F.col("year"), F.col(track).alias("pet"))


def forecast(daily: DataFrame, **kw) -> DataFrame:
    return forecast_trend(complete_series(daily, "mean"), ["location_id", "season"], "year", "pet", **kw)


def forecast_max(daily: DataFrame, **kw) -> DataFrame:
    return forecast_trend(complete_series(daily, "top"), ["location_id", "season"], "year", "pet", **kw)
