"""Queries by name, with the DuckDB SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from thermolake.functions import scalars as S
from thermolake.operators import cities, forecast, gridstore, history, numbering, schemas, snapshots, stats, tables, updates, weather
from thermolake.session import Scratch, ship_path
from thermolake.plans.comfort_sql import COMFORT
from thermolake.sources import adapters as A

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_oracle: dict[str, str] = {}
PET = {"location_id": "int", "date": "string", "pet": "bigint", "pet_avg": "bigint"}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_path(spark)
            return f(spark, sf_dir)

        _queries[name] = run
        if sql:
            _oracle[name] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_oracle)


def _near(x: str, places: int = 6) -> str:
    return f"round(CAST({x} AS DOUBLE), {places})"


def near(x, places: int = 6):
    return F.round(F.col(x) if isinstance(x, str) else x, places)


def _up(x: str, places: int, kind: str = "FLOAT") -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(24,12)), {places}) AS {kind})"


SEASON = "CASE WHEN month(date) IN (12, 1, 2) THEN 'Winter' WHEN month(date) IN (3, 4, 5) THEN 'Spring' WHEN month(date) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END"
SEASONED = f"seasoned AS (SELECT location_id, date, pet, pet_avg, unnest(['Annual', {SEASON}]) AS season FROM daily)"
EXPECTED = """CASE season WHEN 'Annual' THEN datediff('day', make_date(year, 1, 1), make_date(year + 1, 1, 1)) WHEN 'Winter' THEN datediff('day', make_date(year, 1, 1), make_date(year + 1, 1, 1)) - 275 WHEN 'Fall' THEN 91 ELSE 92 END"""
STATS = f"""stats AS (SELECT CAST(location_id AS INTEGER) AS location_id, CAST(year(date) AS SMALLINT) AS year, season, {_up("avg(pet)", 1)} AS avg_pet, {_up("max(pet)", 1)} AS max_pet,
  {_up("quantile_cont(CAST(pet AS DOUBLE), 0.1)", 1)} AS p10, {_up("quantile_cont(CAST(pet AS DOUBLE), 0.9)", 1)} AS p90, {_up("avg(pet_avg)", 1)} AS avg_pet_avg,
  {_up("quantile_cont(CAST(pet_avg AS DOUBLE), 0.1)", 1)} AS p10_avg, {_up("quantile_cont(CAST(pet_avg AS DOUBLE), 0.9)", 1)} AS p90_avg FROM seasoned GROUP BY 1, 2, 3)"""


def series_sql(track: str) -> str:
    value, where = ("avg(pet_avg)", "WHERE pet_avg IS NOT NULL") if track == "mean" else ("max(pet)", "WHERE pet IS NOT NULL")
    outer = "avg(v)" if track == "mean" else "max(v)"
    return f"""by_day AS (SELECT location_id, date, season, CAST({value} AS FLOAT) AS v FROM seasoned {where} GROUP BY 1, 2, 3),
yearly AS (SELECT location_id, season, CAST(year(date) AS INTEGER) AS year, CAST({outer} AS FLOAT) AS v, count(*) AS days FROM by_day GROUP BY 1, 2, 3),
series AS (SELECT CAST(location_id AS SMALLINT) AS location_id, season, year AS t, CAST(v AS DOUBLE) AS y FROM yearly WHERE days = {EXPECTED})"""


def trend_sql(keys: str, min_periods: int, min_train: int, min_errors: int, horizon: int) -> str:
    """CTE fc: the linear forecast over a CTE series (keys, t, y)."""
    on = " AND ".join(f"a.{k.strip()} = b.{k.strip()}" for k in keys.split(","))
    mine = ", ".join(f"a.{k.strip()}" for k in keys.split(","))
    return f"""run AS (SELECT {keys}, t, y, row_number() OVER w AS nth, CASE WHEN count(*) OVER p >= 2 THEN regr_slope(y, t) OVER p * t + regr_intercept(y, t) OVER p END AS guess FROM series
  WINDOW w AS (PARTITION BY {keys} ORDER BY t), p AS (PARTITION BY {keys} ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
line AS (SELECT {keys}, count(*) AS n, max(t) AS last, median(t) AS ref, regr_slope(y, t) AS c1, regr_intercept(y, t) AS c0 FROM series GROUP BY {keys} HAVING count(*) > 1),
err AS (SELECT {mine}, any_value(b.n) AS n, any_value(b.last) AS last, any_value(b.ref) AS ref, any_value(b.c1) AS c1, any_value(b.c0) AS c0, sqrt(avg((b.c1 * a.t + b.c0 - a.y) ** 2)) AS rmse,
  CASE WHEN any_value(b.n) >= {min_train + 3} AND count(a.guess) FILTER (WHERE a.nth > {min_train}) >= {min_errors} THEN sqrt(avg((a.guess - a.y) ** 2) FILTER (WHERE a.nth > {min_train})) END AS cv FROM run a JOIN line b ON {on} GROUP BY {mine}),
grown AS (SELECT *, unnest(range(last + 1, {horizon + 1})) AS t FROM err WHERE n >= {min_periods} AND last < {horizon}),
wide AS (SELECT *, c1 * t + c0 AS mid, 1.2816 * greatest(rmse, coalesce(cv, 0)) * sqrt(1 + least(t - last, 25) / 10.0) AS half FROM grown),
fc AS (SELECT {keys}, CAST(t AS SMALLINT) AS year, {_up("mid", 1)} AS pet, {_up("mid - half", 1)} AS lower, {_up("mid + half", 1)} AS upper, 'linear' AS model_type, CAST(n AS SMALLINT) AS full_years_used, {_up("c1", 2)} AS warming_rate, CAST(0 AS FLOAT) AS acceleration FROM wide)"""


SHORT = {"min_periods": 3, "min_train": 2, "min_cv_errors": 1, "horizon_end": 2030}
SHORT_SQL = trend_sql("location_id, season", 3, 2, 1, 2030)


def _shared(spark, facts: DataFrame) -> DataFrame:
    """Facts that a query uses twice, written once."""
    return Scratch(spark, "facts").table(facts, "daily")


# -- statistics and forecasts ---------------------------------------------------------------------------
@query("n5_year_stats", f"WITH {A.DAILY}, {SEASONED}, {STATS} SELECT * FROM stats")
def n5(spark, d):
    return stats.year_stats(A.daily(spark, d))


@query("n5_year_stats_grouping_sets", f"WITH {A.DAILY}, {SEASONED}, {STATS} SELECT * FROM stats")
def n5_sets(spark, d):
    return stats.year_stats_grouping_sets(A.daily(spark, d))


@query("e3_complete_means", f"WITH {A.DAILY_ALL}, {SEASONED}, {series_sql('mean')} SELECT location_id, season, t AS year, {_near('y')} AS pet FROM series")
def e3(spark, d):
    return forecast.complete_series(A.daily_all(spark, d), "mean").withColumn("pet", near(F.col("pet").cast("double")))


@query("e4_complete_maxima", f"WITH {A.DAILY_ALL}, {SEASONED}, {series_sql('top')} SELECT location_id, season, t AS year, {_near('y')} AS pet FROM series")
def e4(spark, d):
    return forecast.complete_series(A.daily_all(spark, d), "top").withColumn("pet", near(F.col("pet").cast("double")))


@query("e5_ordered_arrays", f"WITH {A.MONTHLY} SELECT location_id, array_to_string(list(period ORDER BY period), ',') AS periods, array_to_string(list(CAST(round(value * 1000) AS BIGINT) ORDER BY period), ',') AS vals FROM monthly GROUP BY 1")
def e5(spark, d):
    pairs = A.monthly(spark, d).groupBy("location_id").agg(F.array_sort(F.collect_list(F.struct("period", F.round(F.col("value") * 1000).cast("bigint").alias("v")))).alias("a"))
    text = lambda f: F.array_join(F.transform("a", lambda x: x[f].cast("string")), ",")
    return pairs.select("location_id", text("period").alias("periods"), text("v").alias("vals"))


@query("e8_median_period", f"WITH {A.MONTHLY} SELECT location_id, CAST(median(period) AS DOUBLE) AS reference_year FROM monthly GROUP BY 1")
def e8(spark, d):
    return A.monthly(spark, d).groupBy("location_id").agg(F.median("period").alias("reference_year"))


@query("e9_ols_linear", f"WITH {A.MONTHLY} SELECT location_id, count(*) AS n, {_near('regr_slope(value, period)')} AS slope, {_near('regr_intercept(value, period) + regr_slope(value, period) * median(period)', 5)} AS level FROM monthly GROUP BY 1")
def e9(spark, d):
    fit = forecast.fit_trend(A.monthly(spark, d), ["location_id"], "period", "value")
    return fit.select("location_id", "n", near("model.coef1").alias("slope"), near("model.coef0", 5).alias("level"))


_QUAD = f"""WITH {A.MONTHLY}, c AS (SELECT location_id, median(period) AS ref FROM monthly GROUP BY 1),
x AS (SELECT m.location_id, m.period - c.ref AS x, m.value AS y FROM monthly m JOIN c USING (location_id)),
s AS (SELECT location_id, count(*)::DOUBLE AS n, sum(x) AS a, sum(x*x) AS b, sum(x**3) AS c, sum(x**4) AS d, sum(y) AS p, sum(x*y) AS q, sum(x*x*y) AS r FROM x GROUP BY 1),
k AS (SELECT *, d*(b*n - a*a) - c*(c*n - a*b) + b*(c*a - b*b) AS det FROM s),
f AS (SELECT location_id, (r*(b*n - a*a) - c*(q*n - a*p) + b*(q*a - b*p)) / det AS c2, (d*(q*n - a*p) - r*(c*n - a*b) + b*(c*p - q*b)) / det AS c1, (d*(b*p - q*a) - c*(c*p - q*b) + r*(c*a - b*b)) / det AS c0 FROM k WHERE n > 2 AND abs(det) >= 1e-12)"""


@query("e10_ols_quadratic", f"{_QUAD} SELECT location_id, {_near('c2')} AS coef2, {_near('c1')} AS coef1, {_near('c0', 5)} AS coef0 FROM f")
def e10(spark, d):
    fit = forecast.fit_trend(A.monthly(spark, d), ["location_id"], "period", "value", degree=2).where("model is not null")
    return fit.select("location_id", near("model.coef2").alias("coef2"), near("model.coef1").alias("coef1"), near("model.coef0", 5).alias("coef0"))


@query("e11_in_sample_rmse", f"{_QUAD} SELECT x.location_id, {_near('sqrt(avg((c2*x.x*x.x + c1*x.x + c0 - x.y) ** 2))', 5)} AS rmse FROM x JOIN f USING (location_id) GROUP BY 1")
def e11(spark, d):
    fit = forecast.fit_trend(A.monthly(spark, d), ["location_id"], "period", "value", degree=2).where("model is not null")
    return fit.select("location_id", near("model.rmse", 5).alias("rmse"))


_MONTH_SERIES = f"WITH {A.MONTHLY}, series AS (SELECT location_id, period AS t, value AS y FROM monthly), {trend_sql('location_id', 10, 12, 5, 24072)}"


@query("f4_rolling_origin_rmse", f"{_MONTH_SERIES} SELECT location_id, {_near('cv', 5)} AS cv_rmse FROM err")
def f4(spark, d):
    found = forecast.rolling_origin_rmse(A.monthly(spark, d), ["location_id"], "period", "value")
    return found.select("location_id", near(F.when(S.is_finite(F.col("cv_rmse")), F.col("cv_rmse")), 5).alias("cv_rmse"))


@query("k1_forecast_trend", f"{_MONTH_SERIES} SELECT * FROM fc")
def k1(spark, d):
    return forecast.forecast_trend(A.monthly(spark, d), ["location_id"], "period", "value", horizon_end=24072)


@query("k1_forecast_quadratic", f"""{_QUAD}, m AS (SELECT f.*, c.ref, z.n, z.last FROM f JOIN c USING (location_id) JOIN (SELECT location_id, count(*) AS n, max(period) AS last FROM monthly GROUP BY 1) z USING (location_id)),
g AS (SELECT *, unnest(range(last + 1, 24073)) AS t FROM m WHERE n >= 10 AND last < 24072),
h AS (SELECT *, c2*(t-ref)**2 + c1*(t-ref) + c0 AS raw, least(last + 15, 24072) AS s0, least(last + 35, 24072) AS s1 FROM g),
e AS (SELECT x.location_id, sqrt(avg((c2*x.x*x.x + c1*x.x + c0 - x.y) ** 2)) AS rmse FROM x JOIN f USING (location_id) GROUP BY 1),
w AS (SELECT location_id, x, y, row_number() OVER o AS nth, (count(*) OVER p)::DOUBLE AS n, sum(x) OVER p AS a, sum(x*x) OVER p AS b, sum(x**3) OVER p AS c, sum(x**4) OVER p AS d, sum(y) OVER p AS p, sum(x*y) OVER p AS q, sum(x*x*y) OVER p AS r FROM x
  WINDOW o AS (PARTITION BY location_id ORDER BY x), p AS (PARTITION BY location_id ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT *, d*(b*n - a*a) - c*(c*n - a*b) + b*(c*a - b*b) AS det FROM w WHERE nth > 12),
u AS (SELECT location_id, count(*) AS errors, sqrt(avg(((r*(b*n - a*a) - c*(q*n - a*p) + b*(q*a - b*p)) / det * x*x + (d*(q*n - a*p) - r*(c*n - a*b) + b*(c*p - q*b)) / det * x + (d*(b*p - q*a) - c*(c*p - q*b) + r*(c*a - b*b)) / det - y) ** 2)) AS cv FROM v WHERE n > 2 AND abs(det) >= 1e-12 GROUP BY 1),
j AS (SELECT h.*, CASE WHEN s0 < s1 THEN raw * (1 - least(1, greatest(0, (t - s0) / (s1 - s0)))) + (c2*(s0-ref)**2 + c1*(s0-ref) + c0 + (t - s0) * (2*c2*(s0-ref) + c1)) * least(1, greatest(0, (t - s0) / (s1 - s0))) ELSE raw END AS mid,
  1.2816 * greatest(rmse, CASE WHEN h.n >= 15 AND errors >= 5 THEN cv ELSE 0 END) * sqrt(1 + least(t - last, 25) / 10.0 + (least(t - last, 25) / 30.0) ** 2) AS half FROM h JOIN e USING (location_id) LEFT JOIN u USING (location_id))
SELECT location_id, CAST(t AS SMALLINT) AS year, {_up("mid", 1)} AS pet, {_up("mid - half", 1)} AS lower, {_up("mid + half", 1)} AS upper, 'quadratic' AS model_type, CAST(n AS SMALLINT) AS full_years_used, {_up("2*c2*(t-ref) + c1", 2)} AS warming_rate, {_up("2*c2", 3)} AS acceleration FROM j""")
def k1_quadratic(spark, d):
    return forecast.forecast_trend(A.monthly(spark, d), ["location_id"], "period", "value", horizon_end=24072, degree=2)


@query("n6_forecast", f"WITH {A.DAILY_ALL}, {SEASONED}, {series_sql('mean')}, {SHORT_SQL} SELECT * FROM fc")
def n6(spark, d):
    return forecast.forecast(A.daily_all(spark, d), **SHORT)


@query("n7_forecast_max", f"WITH {A.DAILY_ALL}, {SEASONED}, {series_sql('top')}, {SHORT_SQL} SELECT * FROM fc")
def n7(spark, d):
    return forecast.forecast_max(A.daily_all(spark, d), **SHORT)


_RANK = f"""WITH {A.DAILY_ALL}, {SEASONED}, {STATS}, {series_sql('mean')}, {SHORT_SQL},
both_ AS (SELECT location_id, year, season, 0 AS o, avg_pet AS v, avg_pet_avg AS va FROM stats UNION ALL SELECT location_id, year, season, 1, pet, pet FROM fc),
one AS (SELECT * FROM both_ QUALIFY row_number() OVER (PARTITION BY location_id, year, season ORDER BY o) = 1),
base AS (SELECT location_id, season, v, va FROM one WHERE year = 1998),
loc AS (SELECT n_nationkey AS id, n_name AS city, r_name AS state FROM nation JOIN region ON n_regionkey = r_regionkey)"""


@query("n8_city_rankings", f"""{_RANK} SELECT CAST(s.location_id AS SMALLINT) AS location_id, s.year, s.season, s.avg_pet, s.max_pet, s.avg_pet_avg, l.city, l.state, s.p10, s.p90, s.p10_avg, s.p90_avg, f.lower AS future_lower, f.upper AS future_upper,
  {_up("s.avg_pet - b.v", 2)} AS change_from_2000, {_up("s.avg_pet_avg - b.va", 2)} AS change_from_2000_avg
FROM stats s JOIN loc l ON l.id = s.location_id LEFT JOIN fc f ON f.location_id = s.location_id AND f.season = s.season AND f.year = 2030 LEFT JOIN base b ON b.location_id = s.location_id AND b.season = s.season WHERE NOT s.location_id < 0""")
def n8(spark, d):
    facts = _shared(spark, A.daily_all(spark, d))
    places = A.table(spark, d, "nation").join(A.table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("city"), F.col("r_name").alias("state"))
    return stats.city_rankings(stats.year_stats(facts), forecast.forecast(facts, **SHORT), places, base_year=1998, horizon=2030)


@query("f1_first_source", f"{_RANK} SELECT location_id, CAST(year AS SMALLINT) AS year, season, v, va FROM one")
def f1(spark, d):
    facts = _shared(spark, A.daily_all(spark, d))
    keys = ["location_id", "year", "season"]
    seen = stats.year_stats(facts).select(*keys, F.lit(0).alias("o"), F.col("avg_pet").alias("v"), F.col("avg_pet_avg").alias("va"))
    ahead = forecast.forecast(facts, **SHORT).select(*keys, F.lit(1).alias("o"), F.col("pet").alias("v"), F.col("pet").alias("va"))
    first = seen.unionByName(ahead).groupBy(*keys).agg(F.min_by(F.struct("v", "va"), "o").alias("b"))
    return first.select(*keys, "b.v", "b.va")


# -- coverage and checks --------------------------------------------------------------------------------
_COVER = "count(DISTINCT year(date)) AS years, count(DISTINCT CASE WHEN pet_avg IS NOT NULL THEN year(date) END) AS avg_years, count(DISTINCT CASE WHEN pet_avg IS NULL THEN location_id * 10000 + year(date) END) AS incomplete"
_GAPPY = "gappy AS (SELECT location_id, date, pet, CASE WHEN month(date) = 2 AND location_id < 3 THEN NULL ELSE pet_avg END AS pet_avg FROM daily)"


@query("n9_history_coverage", f"WITH {A.DAILY}, {_GAPPY}, c AS (SELECT {_COVER} FROM gappy) SELECT *, CASE WHEN years < 5 THEN 'fail: at least 5 years are needed, found ' || years WHEN avg_years < 5 OR incomplete > 0 THEN 'warning' ELSE 'ok' END AS status FROM c")
def n9(spark, d):
    gappy = A.daily(spark, d).withColumn("pet_avg", F.when(~((F.month("date") == 2) & (F.col("location_id") < 3)), F.col("pet_avg")))
    return stats.history_coverage(gappy, 5)


@query("e13_history_gate", f"WITH {A.DAILY}, c AS (SELECT {_COVER} FROM daily) SELECT *, CASE WHEN years < 10 THEN 'fail: at least 10 years are needed, found ' || years WHEN avg_years < 10 OR incomplete > 0 THEN 'warning' ELSE 'ok' END AS status FROM c")
def e13(spark, d):
    return stats.history_coverage(A.daily(spark, d))


@query("e14_coverage_range", f"WITH {A.DAILY} SELECT CAST(min(year(date)) AS INTEGER) AS first_year, CAST(max(year(date)) AS INTEGER) AS last_year FROM daily")
def e14(spark, d):
    return stats.coverage_range(A.daily(spark, d))


@query("e15_duplicate_keys", "SELECT l_suppkey, CAST(l_shipdate AS DATE) AS date, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def e15(spark, d):
    return stats.duplicate_keys(A.table(spark, d, "lineitem").select("l_suppkey", F.to_date("l_shipdate").alias("date")), ["l_suppkey", "date"])


@query("h5_table_diff", f"WITH {A.DAILY} SELECT (SELECT count(*) FROM (SELECT location_id, date FROM daily EXCEPT ALL SELECT location_id, date FROM daily WHERE pet < 50)) AS missing, (SELECT count(*) FROM (SELECT location_id, date FROM daily WHERE pet < 50 EXCEPT ALL SELECT location_id, date FROM daily)) AS extra")
def h5(spark, d):
    days = A.daily(spark, d)
    return stats.table_diff(days.select("location_id", "date"), days.where("pet < 50").select("location_id", "date"))


@query("h3_common_keys", "SELECT o_custkey AS k FROM orders INTERSECT SELECT c_custkey FROM customer INTERSECT SELECT user_id FROM events")
def h3(spark, d):
    sides = [("orders", "o_custkey"), ("customer", "c_custkey"), ("events", "user_id")]
    return history.common_keys([A.table(spark, d, t).select(F.col(c).alias("k")) for t, c in sides], ["k"])


@query("d10_dedupe_latest", "SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) = 1")
def d10(spark, d):
    rows = A.table(spark, d, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    return stats.dedupe_latest(rows, ["o_custkey", "day"], [F.col("o_orderkey").desc()])


@query("d7_season_expansion", f"WITH {A.DAILY}, {SEASONED} SELECT season, count(*) AS n, {_near('sum(pet)', 2)} AS total FROM seasoned GROUP BY 1")
def d7(spark, d):
    rows = A.daily(spark, d).select("pet", F.explode(S.with_annual(F.col("date"))).alias("season"))
    return rows.groupBy("season").agg(F.count("*").alias("n"), near(F.sum("pet"), 2).alias("total"))


@query("c13_expected_days", f"SELECT year, season, CAST({EXPECTED} AS INTEGER) AS days FROM (SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS year, unnest(['Annual', 'Winter', 'Spring', 'Summer', 'Fall']) AS season FROM lineitem)")
def c13(spark, d):
    years = A.table(spark, d, "lineitem").select(F.year("l_shipdate").alias("year"), F.explode(F.array([F.lit(s) for s in S.SEASONS])).alias("season")).distinct()
    return years.withColumn("days", S.expected_days(F.col("year"), F.col("season")))


# -- cities ---------------------------------------------------------------------------------------------
_BOX = f"WITH {A.CITIES}, box AS (SELECT * FROM cities_src WHERE lat BETWEEN 24.25 AND 49.25 AND lng BETWEEN -124.5 AND -66.5)"
_CELL = f"{_BOX}, cell AS (SELECT *, CAST(round_even(lat / 0.25, 0) AS INTEGER) AS i, CAST(round_even(lng / 0.25, 0) AS INTEGER) AS j FROM box), one AS (SELECT * FROM cell QUALIFY row_number() OVER (PARTITION BY i, j ORDER BY population DESC, city, state) = 1)"
_TOP = f"{_CELL}, top AS (SELECT CAST(row_number() OVER (ORDER BY population DESC, city, state) - 1 AS INTEGER) AS location_id, city, state, round_even(lat * 1000, 0) / 1000 AS lat, round_even(lng * 1000, 0) / 1000 AS lng FROM one QUALIFY location_id < 500)"


@query("c1_normalise_headers", f"WITH {A.CITIES} SELECT city, state, population, {_near('lat')} AS lat, {_near('lng')} AS lng FROM cities_src")
def c1(spark, d):
    return cities.normalise_headers(A.cities_raw(spark, d)).withColumns({c: near(c) for c in ("lat", "lng")})


@query("c3_bounding_box", f"{_BOX} SELECT city, {_near('lat')} AS lat, {_near('lng')} AS lng FROM box")
def c3(spark, d):
    return cities.in_box(cities.normalise_headers(A.cities_raw(spark, d))).select("city", near("lat").alias("lat"), near("lng").alias("lng"))


@query("f3_one_per_cell", f"{_CELL} SELECT city, state, population FROM one")
def f3(spark, d):
    return cities.one_per_cell(cities.in_box(cities.normalise_headers(A.cities_raw(spark, d)))).select("city", "state", "population")


@query("n1_build_cities", f"{_TOP} SELECT * FROM top")
def n1(spark, d):
    return cities.build_cities(cities.normalise_headers(A.cities_raw(spark, d)))


@query("n2_build_locations", f"{_TOP} SELECT CAST(location_id AS SMALLINT) AS id, city, state, CAST(lat AS FLOAT) AS lat, CAST(lng AS FLOAT) AS lng FROM top")
def n2(spark, d):
    return cities.build_locations(cities.build_cities(cities.normalise_headers(A.cities_raw(spark, d))))


@query("g2_top_k", f"WITH {A.CITIES} SELECT city, population FROM cities_src ORDER BY population DESC, city LIMIT 100")
def g2(spark, d):
    return cities.normalise_headers(A.cities_raw(spark, d)).orderBy(F.col("population").desc(), "city").limit(100).select("city", "population")


# -- weather --------------------------------------------------------------------------------------------
_NEAREST = f"""WITH {A.GRID}, {A.GRID_CITIES}, sampled AS (SELECT p.location_id, p.lat AS city_lat, p.lng AS city_lng, g.* EXCLUDE (lat, lng) FROM grid g JOIN places p
  ON round_even(g.lat / 0.25, 0) = round_even(p.lat / 0.25, 0) AND round_even(g.lng / 0.25, 0) = round_even((p.lng + 360) / 0.25, 0))"""
_SUN = f"""{_NEAREST}, clock AS (SELECT *, make_timestamp((CAST(hour AS BIGINT) * 3600 - 2208988800 - 1800) * 1000000) AS moment FROM sampled),
angle AS (SELECT *, hour(moment) + minute(moment) / 60.0::DOUBLE AS h, 2 * pi() / 365 * (dayofyear(moment) - 1 + (hour(moment) + minute(moment) / 60.0::DOUBLE - 12) / 24.0::DOUBLE) AS g FROM clock),
tilt AS (SELECT *, 0.006918::DOUBLE - 0.399912::DOUBLE*cos(g) + 0.070257::DOUBLE*sin(g) - 0.006758::DOUBLE*cos(2*g) + 0.000907::DOUBLE*sin(2*g) - 0.002697::DOUBLE*cos(3*g) + 0.00148::DOUBLE*sin(3*g) AS decl,
  229.18::DOUBLE * (0.000075::DOUBLE + 0.001868::DOUBLE*cos(g) - 0.032077::DOUBLE*sin(g) - 0.014615::DOUBLE*cos(2*g) - 0.040849::DOUBLE*sin(2*g)) AS eq FROM angle),
sun AS (SELECT *, least(1.0::DOUBLE, greatest(0.0::DOUBLE, sin(radians(city_lat)) * sin(decl) + cos(radians(city_lat)) * cos(decl) * cos(radians((h * 60 + eq + 4 * city_lng) / 4 - 180)))) AS cz FROM tilt)"""
_DERIVED = f"""{_SUN}, fluxes AS (SELECT *, ssrd/3600 AS fs, ssr/3600 AS fn, strd/3600 AS fl, str/3600 AS ft, fdir/3600 AS fd, degrees(asin(cz)) AS el FROM sun),
beam AS (SELECT *, CASE WHEN cz >= 0.1 THEN greatest(fd / cz, 0) ELSE 0 END AS b FROM fluxes),
heat AS (SELECT location_id, hour, t2 - 273.15 AS t, d2 - 273.15 AS td, sqrt(u10*u10 + v10*v10) AS v, (0.5*fl + 0.5*(fl - ft) + 0.7::DOUBLE/0.97*(0.5*(fs - fd) + 0.5*(fs - fn) + 0.308*cos(radians(el*(0.998 - el*el/50000)))*b)) / 5.67e-8 AS q FROM beam),
frame AS (SELECT location_id, hour, t, v, least(100, greatest(0, 100*exp(17.625*td/(243.04+td))/exp(17.625*t/(243.04+t)))) AS rh, CASE WHEN q >= 0 THEN pow(q, 0.25) - 273.15 END AS mrt FROM heat),
clean AS (SELECT * FROM frame WHERE mrt BETWEEN -80 AND 120 AND rh BETWEEN 1 AND 100 AND v > 0)"""


@query("d5_nearest_cell", f"{_NEAREST} SELECT location_id, hour, {_near('t2')} AS t2, {_near('ssrd')} AS ssrd FROM sampled")
def d5(spark, d):
    sampled, members = _sampled(spark, d)
    return weather.each_city(sampled.select("location_id", "hour", near("t2").alias("t2"), near("ssrd").alias("ssrd")), members)


def _sampled(spark, d, shards: int = 1) -> tuple[DataFrame, DataFrame]:
    """Grid rows by place, and the cities of each place."""
    places, members = weather.by_place(A.grid_cities(spark, d), shards)
    return weather.sample_grid(_grid(A.grid_hourly(spark, d)), places), members


def _grid(raw: DataFrame) -> DataFrame:
    return raw.select("hour", "lat", "lng", *[F.col(c).alias(k) for k, c in weather.resolve_variables(raw.columns).items()])


@query("a9_grid_scan", f"WITH {A.GRID} SELECT hour, {_near('lat')} AS lat, {_near('lng')} AS lng, {_near('u10')} AS u10, {_near('t2')} AS t2 FROM grid WHERE hour BETWEEN 1087000 AND 1087300")
def a9(spark, d):
    scratch = Scratch(spark, "grid")
    A.grid_hourly(spark, d).write.parquet(scratch.path("grid"))
    found = weather.scan_grid(spark, scratch.path("grid"), hour_range=(1087000, 1087300))
    return found.select("hour", *[near(c).alias(c) for c in ("lat", "lng", "u10", "t2")])


@query("i18_cossza", f"{_SUN} SELECT location_id, hour, {_near('cz', 5)} AS cz FROM sun")
def i18(spark, d):
    rows, members = _sampled(spark, d)
    at = S.hour_to_ts(F.col("hour")) - F.expr("INTERVAL 30 MINUTES")
    return weather.each_city(rows.select("location_id", "hour", near(S.cossza(F.col("city_lat"), S.to_180(F.col("city_lng")), at), 5).alias("cz")), members)


@query("j1_hourly_derivation", f"{_DERIVED} SELECT location_id, hour, {_near('t', 4)} AS t, {_near('v', 4)} AS v, {_near('rh', 4)} AS rh, {_near('mrt', 4)} AS mrt FROM clean")
def j1(spark, d):
    sampled, members = _sampled(spark, d)
    return weather.each_city(weather.derive_weather(sampled).select("location_id", "hour", *[near(c, 4).alias(c) for c in ("t", "v", "rh", "mrt")]), members)


@query("d4_distinct_solve", f"{_DERIVED} SELECT location_id, hour, {_near('round_even(t*2, 0)/2 + 2*(round_even(v*2, 0)/2)')} AS y FROM clean")
def d4(spark, d):
    from pyspark.sql import types as T

    sampled, members = _sampled(spark, d)
    rounded = weather.derive_weather(sampled).withColumns({c: S.rint_to(F.col(c), 2.0) for c in ("t", "v")})

    def run(batches):
        for b in batches:
            yield b.assign(y=b.t + 2 * b.v)

    found = weather.solve_distinct(rounded, ["t", "v"], run, T.StructField("y", T.DoubleType()))
    return weather.each_city(found.select("location_id", "hour", near("y").alias("y")), members)


_RECURSIVE = _DERIVED.replace("WITH", "WITH RECURSIVE", 1)


@query("j2_comfort", f"{_RECURSIVE}, {COMFORT} SELECT location_id, hour, t, mrt, v, rh, pet FROM hours")
def j2(spark, d):
    sampled, members = _sampled(spark, d)
    return weather.each_city(weather.with_pet(weather.derive_weather(sampled)), members)


@query("n3_daily_comfort", f"{_RECURSIVE}, {COMFORT} SELECT location_id, date, pet, pet_avg FROM comfort_days")
def n3(spark, d):
    sampled, members = _sampled(spark, d)
    return weather.each_city(weather.daily_comfort(weather.with_pet(weather.derive_weather(sampled))), members)


def _cheap(rows: DataFrame, seen=None) -> DataFrame:
    """A comfort value that SQL can give too, in the solver's place: t + 2 v of the rounded weather."""
    found = rows.withColumns({c: S.rint_to(F.col(c), 2.0) for c in ("t", "v")}).withColumn("pet", S.null_outside(F.col("t") + 2 * F.col("v"), -20.0, 40.0).cast("float"))
    return (found.observe(seen, weather.city_hours(found, F.col("pet").isNull()).alias("comfort")) if seen is not None else found).dropna(subset=["pet"])


_CHEAP = """cheap AS (SELECT location_id, CAST(make_timestamp((CAST(hour AS BIGINT) * 3600 - 2208988800) * 1000000) AS DATE) AS date, round_even(t*2, 0)/2 + 2*(round_even(v*2, 0)/2) AS y FROM clean),
days AS (SELECT location_id, date, CAST(max(y) AS FLOAT) AS pet, CAST(round_even(avg(y) * 10, 0) / 10 AS FLOAT) AS pet_avg FROM cheap WHERE y BETWEEN -20 AND 40 GROUP BY 1, 2)"""


@query("a9_grid_store", f"{_NEAREST} SELECT location_id, hour, {_near('t2')} AS t2, {_near('fdir')} AS fdir FROM sampled WHERE hour BETWEEN 1087000 AND 1087300")
def a9_store(spark, d):
    """Cities' hours from tiles: only those that a city lies in are opened."""
    store = gridstore.write_grid(_grid(A.grid_hourly(spark, d)), Scratch(spark, "store").path("grid"))
    places, members = weather.by_place(A.grid_cities(spark, d))
    return weather.each_city(gridstore.scan_cities(store, places, (1087000, 1087300)).select("location_id", "hour", near("t2").alias("t2"), near("fdir").alias("fdir")), members)


@query("d5_store_join", f"{_NEAREST} SELECT location_id, hour, {_near('t2')} AS t2, {_near('ssrd')} AS ssrd FROM sampled")
def d5_store(spark, d):
    store = gridstore.write_grid(_grid(A.grid_hourly(spark, d)), Scratch(spark, "store").path("grid"))
    places, members = weather.by_place(A.grid_cities(spark, d))
    return weather.each_city(gridstore.scan_cities(store, places).select("location_id", "hour", near("t2").alias("t2"), near("ssrd").alias("ssrd")), members)


@query("d4_memo", f"{_DERIVED} SELECT location_id, hour, {_near('round_even(t*2, 0)/2 + 2*(round_even(v*2, 0)/2)')} AS y FROM clean")
def d4_memo(spark, d):
    """Tuples that a first run has solved (half of the locations) are not solved by the second one."""
    from pyspark.sql import types as T

    places, members = _sampled(spark, d, 2)
    rows = weather.derive_weather(places).withColumns({c: S.rint_to(F.col(c), 2.0) for c in ("t", "v")})
    memo = snapshots.create(spark.createDataFrame([], "t double, v double, y double"), Scratch(spark, "memo").path("memo"), narrow=False)

    def run(batches):
        for b in batches:
            yield b.assign(y=b.t + 2 * b.v)

    solve = lambda df: weather.solve_distinct(df, ["t", "v"], run, T.StructField("y", T.DoubleType()), memo)
    solve(rows.where("location_id % 2 = 0"))
    return weather.each_city(solve(rows).select("location_id", "hour", near("y").alias("y")), members)


@query("d6_resumed_days", f"{_DERIVED}, {_CHEAP} SELECT location_id, date, pet, pet_avg FROM days")
def d6_resumed(spark, d):
    """Half of the batches first, then what is missing; what is done is not computed again."""
    sampled, members = _sampled(spark, d, 3)
    sampled, path = Scratch(spark, "d6").table(sampled, "sampled"), Scratch(spark, "d6").path("days")
    years = sampled.select(S.hour_year(F.col("hour")).alias("year")).distinct()
    for some in ("batch % 2 = 0", None, None):
        table = updates.compute_days(sampled, years, path, _cheap, 168, 3, only=some, members=members)
    return table.scan().select("location_id", "date", "pet", "pet_avg")


@query("c6_job_counts", f"""{_DERIVED}, {_CHEAP} SELECT (SELECT count(*) FROM frame) AS hours, (SELECT count(*) FROM frame WHERE NOT coalesce(mrt BETWEEN -80 AND 120, false)) AS radiation,
  (SELECT count(*) FROM frame WHERE mrt BETWEEN -80 AND 120 AND NOT (rh BETWEEN 1 AND 100 AND v > 0)) AS weather, (SELECT count(*) FROM cheap WHERE NOT y BETWEEN -20 AND 40) AS comfort, (SELECT count(*) FROM days) AS days""")
def c6_counts(spark, d):
    """What the daily job left out, counted by the job itself."""
    sampled, members = _sampled(spark, d)
    years = sampled.select(S.hour_year(F.col("hour")).alias("year")).distinct()
    table = updates.compute_days(sampled, years, Scratch(spark, "c6").path("days"), _cheap, members=members)
    counts = table.manifest().facts["counts"]
    found = table.scan().agg(F.count("*").alias("days"))
    return found.select(*[F.lit(counts[c]).cast("long").alias(c) for c in ("hours", "radiation", "weather", "comfort")], "days")


@query("n10_incremental_stats", f"""{_DERIVED}, {_CHEAP}, {A.DAILY_ALL.replace('daily AS', 'old AS')}, fresh AS (SELECT location_id % 3 AS location_id, CAST(date - INTERVAL 26 YEAR AS DATE) AS date, max(pet) AS pet, max(pet_avg) AS pet_avg FROM days GROUP BY 1, 2),
daily AS (SELECT coalesce(f.location_id, o.location_id) AS location_id, coalesce(f.date, o.date) AS date, coalesce(f.pet, o.pet) AS pet, coalesce(f.pet_avg, o.pet_avg) AS pet_avg FROM old o FULL JOIN fresh f USING (location_id, date)), {SEASONED}, {STATS} SELECT * FROM stats""")
def n10_incremental(spark, d):
    """Facts and statistics stand; a year's days are computed from weather and upserted; only the groups they changed are computed again."""
    scratch = Scratch(spark, "n10i")
    facts = snapshots.create(tables.with_year(A.daily_all(spark, d)), scratch.path("facts"), ["year"])
    updates.refresh_statistics(facts, scratch.path("stats"))
    sampled, members = _sampled(spark, d)
    years = sampled.select(S.hour_year(F.col("hour")).alias("year")).distinct()
    days = updates.compute_days(sampled, years, scratch.path("days"), _cheap, members=members).scan()
    fresh = days.groupBy((F.col("location_id") % 3).alias("location_id"), F.add_months("date", -12 * 26).alias("date")).agg(F.max("pet").alias("pet"), F.max("pet_avg").alias("pet_avg"))
    facts.upsert(fresh, ["location_id", "date"])
    return updates.refresh_statistics(facts, scratch.path("stats"))[0].scan().select(*stats.year_stats(facts.scan()).columns)


@query("n10_incremental_forecasts", f"WITH {A.DAILY_ALL.replace('daily AS', 'old AS')}, daily AS (SELECT location_id, date, pet, CASE WHEN location_id = 1 AND month(date) = 7 THEN CAST(pet_avg + 5 AS FLOAT) ELSE pet_avg END AS pet_avg FROM old), {SEASONED}, {series_sql('mean')}, {SHORT_SQL} SELECT * FROM fc")
def n10_forecasts(spark, d):
    """Julys of one location change: its forecasts alone are fitted again."""
    scratch = Scratch(spark, "n10f")
    facts = snapshots.create(tables.with_year(A.daily_all(spark, d)), scratch.path("facts"), ["year"])
    make = lambda df: forecast.forecast(df, **SHORT)
    before = updates.refresh_forecasts(facts, scratch.path("fc"), make)[0].scan().columns
    hot = facts.scan().where("location_id = 1 and month(date) = 7").select("location_id", "date", (F.col("pet_avg") + 5).cast("float").alias("pet_avg"))
    facts.upsert(hot, ["location_id", "date"])
    return updates.refresh_forecasts(facts, scratch.path("fc"), make)[0].scan().select([c for c in before if c != "slice"])


@query("e1_daily_max_mean", "SELECT user_id AS location_id, CAST(ts AS DATE) AS date, CAST(max(event_id % 500 / 10.0::DOUBLE) AS FLOAT) AS pet, CAST(round_even(avg(event_id % 500 / 10.0::DOUBLE) * 10, 0) / 10 AS FLOAT) AS pet_avg FROM events GROUP BY 1, 2")
def e1(spark, d):
    hours = A.table(spark, d, "events").select(F.col("user_id").alias("location_id"), S.ts_to_hour(F.col("ts")).alias("hour"), (F.col("event_id") % 500 / 10.0).alias("pet"))
    return weather.daily_comfort(hours).withColumn("pet", F.col("pet").cast("float"))


@query("i_scalars", f"""WITH x AS (SELECT event_id, (event_id % 7200) / 10.0::DOUBLE - 360 AS lng, (event_id % 1000) / 8.0::DOUBLE AS v, 250 + event_id % 70 AS k FROM events)
SELECT event_id, {_near("((lng % 360) + 360) % 360", 4)} AS wrapped, {_near("CASE WHEN lng > 180 THEN lng - 360 ELSE lng END", 4)} AS signed, {_near("round_even(v / 0.25, 0) * 0.25", 4)} AS snapped, {_near("round_even(v * 2, 0) / 2", 4)} AS halves,
  {_up("v", 2, "DOUBLE")} AS cents, {_near("6.11 * pow(10, 7.45 * (k - 273.15) / (235 + k - 273.15))", 5)} AS svp, CASE WHEN v BETWEEN 10 AND 60 THEN v END AS kept FROM x""")
def scalars(spark, d):
    e = F.col("event_id")
    x = A.table(spark, d, "events").select("event_id", (e % 7200 / 10.0 - 360).alias("lng"), (e % 1000 / 8.0).alias("v"), (250 + e % 70).alias("k"))
    lng, v = F.col("lng"), F.col("v")
    return x.select("event_id", near(S.wrap360(lng), 4).alias("wrapped"), near(S.to_180(lng), 4).alias("signed"), near(S.snap(v), 4).alias("snapped"), near(S.rint_to(v, 2.0), 4).alias("halves"), S.round_half_up(v, 2).cast("double").alias("cents"), near(S.svp(F.col("k")), 5).alias("svp"), S.null_outside(v, 10.0, 60.0).alias("kept"))


@query("c4_month_filter", f"WITH {A.DAILY} SELECT location_id, date, pet FROM daily WHERE month(date) IN (6, 7, 8)")
def c4(spark, d):
    return weather.only_months(A.daily(spark, d), "date", [6, 7, 8]).select("location_id", "date", "pet")


@query("c6_discarded", "SELECT count(*) FILTER (WHERE NOT (value * 10 - 100 BETWEEN -80 AND 120)) AS discarded, count(*) AS rows FROM events")
def c6(spark, d):
    return weather.discarded_radiation(A.table(spark, d, "events").select((F.col("value") * 10 - 100).alias("mrt")))


@query("d9_hourly_frame", f"""WITH {A.GRID_CITIES}, h AS (SELECT location_id, min(hour) AS a, max(hour) AS b FROM (SELECT user_id AS location_id, CAST((epoch_us(ts) // 1000000 + 2208988800) // 3600 AS INTEGER) AS hour FROM events) GROUP BY 1)
SELECT location_id, CAST(unnest(range(a, b + 1)) AS INTEGER) AS hour FROM places JOIN h USING (location_id)""")
def d9(spark, d):
    """The frame of each place, from its own first hour to its last."""
    spans = A.table(spark, d, "events").groupBy(F.col("user_id").alias("location_id")).agg(F.min(S.ts_to_hour(F.col("ts"))).alias("a"), F.max(S.ts_to_hour(F.col("ts"))).alias("b"))
    return weather.hourly_frame(A.grid_cities(spark, d).join(spans, "location_id"), F.col("a"), F.col("b"))


# -- tables ---------------------------------------------------------------------------------------------
def _written(spark, d, label) -> tuple[Scratch, str]:
    scratch = Scratch(spark, label)
    path = scratch.path("facts")
    tables.write_partitioned(tables.with_year(A.daily(spark, d)), path)
    return scratch, path


def _snapshot(spark, d, label) -> snapshots.SnapshotTable:
    return snapshots.create(tables.with_year(A.daily(spark, d)), Scratch(spark, label).path("facts"), ["year"])


def _fact_columns(df: DataFrame) -> DataFrame:
    return df.select("location_id", "date", "pet", "pet_avg", F.col("year").cast("int").alias("year"))


def _facts(spark, path: str) -> DataFrame:
    return spark.read.parquet(path).select("location_id", "date", "pet", "pet_avg", F.col("year").cast("int").alias("year"))


_FACT = "location_id, date, CAST(pet AS FLOAT) AS pet, CAST(pet_avg AS FLOAT) AS pet_avg, CAST(year(date) AS INTEGER) AS year"


@query("b1_write_partitioned", f"WITH {A.DAILY} SELECT {_FACT} FROM daily")
def b1(spark, d):
    return _facts(spark, _written(spark, d, "b1")[1])


@query("b2_replace_years", f"WITH {A.DAILY} SELECT {_FACT} FROM daily WHERE year(date) <> 1996 AND (year(date) <> 1997 OR location_id < 2)")
def b2(spark, d):
    table = _snapshot(spark, d, "b2")
    table.replace(table.scan().where("year = 1997 and location_id < 2"), [1996, 1997])
    return _fact_columns(table.scan())


@query("b2_replace_folders", f"WITH {A.DAILY} SELECT {_FACT} FROM daily WHERE year(date) <> 1996 AND (year(date) <> 1997 OR location_id < 2)")
def b2_folders(spark, d):
    """The same over plain year folders."""
    _, path = _written(spark, d, "b2f")
    kept = spark.read.parquet(path).where("year = 1997 and location_id < 2")
    tables.replace_partitions(kept, path, "year", [1996, 1997])
    return _facts(spark, path)


@query("b2_earlier_version", f"WITH {A.DAILY} SELECT {_FACT} FROM daily")
def b2_earlier(spark, d):
    """What a reader of the version before a replacement, an upsert and a deletion still sees."""
    table = _snapshot(spark, d, "b2e")
    version = table.manifest().version
    table.replace(table.scan().where("year = 1997 and location_id < 2"), [1996, 1997])
    table.upsert(A.daily(spark, d).withColumn("pet", F.lit(0.0)), ["location_id", "date"])
    table.delete_window("date", "1992-01-01", "1995-12-31")
    return _fact_columns(table.scan(version))


_STAGED = "staged AS (SELECT location_id, CAST(date + INTERVAL 3 YEAR AS DATE) AS date, CAST(pet + 100 AS FLOAT) AS pet FROM daily WHERE year(date) = 1999 AND month(date) < 12)"


@query("b3_upsert", f"WITH {A.DAILY}, {_STAGED} SELECT coalesce(s.location_id, b.location_id) AS location_id, coalesce(s.date, b.date) AS date, coalesce(s.pet, b.pet) AS pet, b.pet_avg, CAST(year(coalesce(s.date, b.date)) AS INTEGER) AS year FROM daily b FULL JOIN staged s ON b.location_id = s.location_id AND b.date = s.date")
def b3(spark, d):
    table = _snapshot(spark, d, "b3")
    staged = A.daily(spark, d).where("year(date) = 1999 and month(date) < 12").select("location_id", F.add_months("date", 36).alias("date"), (F.col("pet") + 100).cast("float").alias("pet"))
    table.upsert(staged, ["location_id", "date"])
    return _fact_columns(table.scan())


_UNDATED = """undated AS (SELECT o_custkey AS k, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) END AS date, max(o_totalprice) AS v FROM orders GROUP BY 1, 2),
changes AS (SELECT k, CASE WHEN k % 3 = 0 THEN NULL ELSE date END AS date, max(v) + 1 AS v FROM undated WHERE k % 2 = 0 AND (date IS NULL OR year(date) = 1995) GROUP BY 1, 2)"""


@query("b3_upsert_undated", f"WITH {_UNDATED} SELECT coalesce(c.k, b.k) AS k, coalesce(c.date, b.date) AS date, {_near('coalesce(c.v, b.v)', 2)} AS v FROM undated b FULL JOIN changes c ON b.k = c.k AND b.date IS NOT DISTINCT FROM c.date")
def b3_undated(spark, d):
    """Rows without a date, stored and staged, by the same key."""
    day = F.when(F.col("o_orderkey") % 5 != 0, F.to_date("o_orderdate"))
    base = A.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("k"), day.alias("date")).agg(F.max("o_totalprice").alias("v"))
    table = snapshots.create(tables.with_year(base), Scratch(spark, "b3u").path("t"), ["year"], narrow=False)
    some = base.where("k % 2 = 0 and (date is null or year(date) = 1995)")
    table.upsert(some.groupBy("k", F.when(F.col("k") % 3 != 0, F.col("date")).alias("date")).agg((F.max("v") + 1).alias("v")), ["k", "date"])
    return table.scan().select("k", "date", near("v", 2).alias("v"))


@query("b4_insert_absent", "SELECT c_custkey AS k FROM customer UNION SELECT o_custkey + 1000 FROM orders")
def b4(spark, d):
    base = A.table(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    return tables.insert_absent(base, A.table(spark, d, "orders").select((F.col("o_custkey") + 1000).alias("k")), ["k"])


@query("b5_append", f"WITH {A.DAILY} SELECT location_id, date, pet FROM daily UNION ALL SELECT location_id, date, pet FROM daily WHERE location_id = 1")
def b5(spark, d):
    path = Scratch(spark, "b5").path("rows")
    rows = A.daily(spark, d).select("location_id", "date", "pet")
    rows.write.parquet(path)
    rows.where("location_id = 1").write.mode("append").parquet(path)
    return spark.read.parquet(path)


@query("b6_overwrite", f"WITH {A.DAILY} SELECT location_id, date, pet FROM daily WHERE pet > 40")
def b6(spark, d):
    path = Scratch(spark, "b6").path("rows")
    first = tables.overwrite(A.daily(spark, d).select("location_id", "date", "pet"), path)
    return tables.overwrite(first.where("pet > 40"), path)


@query("b7_delete_window", f"WITH {A.DAILY} SELECT {_FACT} FROM daily WHERE NOT date BETWEEN DATE '1996-01-01' AND DATE '1997-06-30'")
def b7(spark, d):
    table = _snapshot(spark, d, "b7")
    table.delete_window("date", "1996-01-01", "1997-06-30")
    return _fact_columns(table.scan())


@query("b8_csv_export", f"{_TOP} SELECT location_id, city, state, CAST(lat AS FLOAT) AS lat, CAST(lng AS FLOAT) AS lng FROM top")
def b8(spark, d):
    path = Scratch(spark, "b8").path("csv")
    tables.write_csv(cities.build_cities(cities.normalise_headers(A.cities_raw(spark, d))), path, ["location_id"], {"lat": 3, "lng": 3})
    return history.scan_csv(spark, path, "location_id int, city string, state string, lat float, lng float")


@query("b10_materialise", f"WITH {A.DAILY}, {SEASONED}, {STATS} SELECT * FROM stats")
def b10(spark, d):
    """Made once for some years and then again for all; a reader finds one or the other."""
    facts = A.daily(spark, d)
    table = snapshots.create(stats.year_stats(facts.where("year(date) < 1995")), Scratch(spark, "b10").path("stats"))
    table.commit(stats.year_stats(facts))
    return table.scan()


@query("a1_projected_scan", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity > 30 AND l_discount < 0.05")
def a1(spark, d):
    return history.read_parquet(spark, [f"{d}/lineitem.parquet"], ["l_orderkey", "l_quantity"], (F.col("l_quantity") > 30) & (F.col("l_discount") < 0.05))


@query("a2_tree_scan", f"WITH {A.DAILY} SELECT CAST(year(date) AS INTEGER) AS year, count(*) AS n FROM daily GROUP BY 1")
def a2(spark, d):
    return history.scan_tree(spark, _written(spark, d, "a2")[1]).groupBy(F.col("year").cast("int").alias("year")).agg(F.count("*").alias("n"))


@query("a6_export_excluding", f"WITH {A.DAILY} SELECT location_id, date, pet FROM daily WHERE date < DATE '1998-01-01' OR date > DATE '1998-12-31' ORDER BY 1, 2")
def a6(spark, d):
    return tables.export_excluding(A.daily(spark, d), "date", "1998-01-01", "1998-12-31").select("location_id", "date", "pet")


@query("a7_partition_inventory", f"WITH {A.DAILY} SELECT DISTINCT CAST(year(date) AS INTEGER) AS year, true AS listed, 'year=' || year(date) AS folder FROM daily")
def a7(spark, d):
    """Each year's files by name: how many depends on their size, where they lie does not."""
    found = history.partition_inventory(spark.read.parquet(_written(spark, d, "a7")[1]), ["year"])
    folders = F.array_distinct(F.transform("files", lambda f: F.element_at(F.split(f, "/"), -2)))
    return found.select(F.col("year").cast("int").alias("year"), (F.size("files") > 0).alias("listed"), F.array_join(folders, ",").alias("folder"))


@query("a8_partition_keys", """WITH p AS (SELECT 'root/year=' || year(l_shipdate) || CASE WHEN l_linenumber % 2 = 0 THEN '/month=' || month(l_shipdate) ELSE '' END || CASE WHEN l_linenumber = 3 THEN '/tile_id=x' ELSE '/tile_id=' || (l_suppkey % 7) END || '/data.parquet' AS path FROM lineitem)
SELECT DISTINCT path, CAST(regexp_extract(path, 'year=([0-9]+)', 1) AS INTEGER) AS year, coalesce(TRY_CAST(regexp_extract(path, 'month=([0-9]+)', 1) AS INTEGER), 0) AS month, CAST(regexp_extract(path, 'tile_id=([0-9]+)', 1) AS INTEGER) AS tile_id FROM p WHERE path NOT LIKE '%tile_id=x%'""")
def a8(spark, d):
    line = F.col("l_linenumber")
    path = F.concat(F.lit("root/year="), F.year("l_shipdate"), F.when(line % 2 == 0, F.concat(F.lit("/month="), F.month("l_shipdate"))).otherwise(""), F.when(line == 3, "/tile_id=x").otherwise(F.concat(F.lit("/tile_id="), F.col("l_suppkey") % 7)), F.lit("/data.parquet"))
    return history.shard_keys(A.table(spark, d, "lineitem").select(path.alias("path")).distinct())


# -- history --------------------------------------------------------------------------------------------
@query("a5_union_sources", f"WITH {A.HISTORY} SELECT location_id, date, pet, pet_avg FROM sources")
def a5(spark, d):
    return history.union_sources(A.history_sources(spark, d)).select("location_id", "date", "pet", "pet_avg")


_EVOLVED = """evolved AS (SELECT source, location_id, date, CAST(pet AS DOUBLE) AS pet, CASE WHEN source > 0 THEN pet_avg END AS pet_avg, CASE WHEN source = 2 THEN CASE WHEN location_id % 2 = 0 THEN 'even' END END AS note FROM sources)"""


@query("a5_evolving_tree", f"WITH {A.HISTORY}, {_EVOLVED} SELECT CAST(source AS INTEGER) AS source, CAST(location_id AS BIGINT) AS location_id, date, pet, pet_avg, note FROM evolved")
def a5_tree(spark, d):
    """A tree of files that differ: columns come later, and whole numbers become longs and doubles; the reader widens them."""
    root = _evolving_tree(spark, d, lambda i: ["int", "bigint", "double"][i])
    return schemas.scan_evolving(spark, root).select("source", F.col("location_id").cast("bigint").alias("location_id"), "date", "pet", "pet_avg", "note")


@query("a5_evolving_text", f"WITH {A.HISTORY}, {_EVOLVED} SELECT CAST(source AS INTEGER) AS source, CAST(location_id AS BIGINT) AS location_id, date, CASE WHEN source = 2 THEN CAST(CAST(pet AS BIGINT) AS VARCHAR) || ' degrees' ELSE CAST(CAST(pet AS BIGINT) AS VARCHAR) END AS pet, pet_avg, note FROM evolved")
def a5_text(spark, d):
    """The same where one file has text in a column of numbers: what the reader cannot widen is cast."""
    root = _evolving_tree(spark, d, lambda i: ["int", "bigint", "string"][i])
    return schemas.scan_evolving(spark, root).select("source", F.col("location_id").cast("bigint").alias("location_id"), "date", "pet", "pet_avg", "note")


def _evolving_tree(spark, d, kind) -> str:
    root = Scratch(spark, "a5").path("tree")
    for i, df in enumerate(A.history_sources(spark, d)):
        pet = F.col("pet").cast(kind(i)) if kind(i) != "string" else F.concat(F.col("pet").cast("string"), F.lit(" degrees"))
        df = df.withColumn("pet", pet).withColumn("location_id", F.col("location_id").cast("int" if i != 1 else "bigint"))
        df = df.withColumn("note", F.when(F.col("location_id") % 2 == 0, "even")) if i == 2 else df
        df.coalesce(2).write.parquet(f"{root}/source={i}")
    return root


@query("h2_source_order", f"WITH {A.HISTORY} SELECT source, count(*) AS n, CAST(sum(pet) AS BIGINT) AS pet FROM sources GROUP BY 1")
def h2(spark, d):
    tagged = history.union_sources([s.withColumn("source", F.lit(i)) for i, s in enumerate(A.history_sources(spark, d))])
    return tagged.groupBy("source").agg(F.count("*").alias("n"), F.sum("pet").alias("pet"))


@query("n4_merge_history", f"WITH {A.HISTORY}, ok AS (SELECT * FROM sources WHERE TRY_CAST(date AS DATE) IS NOT NULL AND pet IS NOT NULL) SELECT CAST(location_id AS INTEGER) AS location_id, date, pet, pet_avg FROM ok QUALIFY row_number() OVER (PARTITION BY location_id, date ORDER BY source DESC) = 1")
def n4(spark, d):
    return history.merge_history(A.history_sources(spark, d), ["location_id", "date"], ["pet"], PET)


@query("d6_pending", "SELECT DISTINCT o_custkey AS batch, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE (o_custkey, year(o_orderdate)) NOT IN (SELECT o_custkey, year(o_orderdate) FROM orders WHERE o_orderstatus = 'F')")
def d6(spark, d):
    work = A.table(spark, d, "orders").select(F.col("o_custkey").alias("batch"), F.year("o_orderdate").alias("year"), "o_orderstatus")
    return history.pending(work.select("batch", "year").distinct(), work.where("o_orderstatus = 'F'"), ["batch", "year"])


@query("f7_every_nth", f"WITH {A.DAILY}, k AS (SELECT DISTINCT year(date) AS y, location_id AS l FROM daily), c AS (SELECT y, l FROM k QUALIFY (row_number() OVER (ORDER BY y, l) - 1) % 3 = 1) SELECT location_id, date, pet FROM daily JOIN c ON y = year(date) AND l = location_id")
def f7(spark, d):
    rows = A.daily(spark, d).withColumn("year", F.year("date"))
    return history.every_nth(rows, ["year", "location_id"], 1, 3).select("location_id", "date", "pet")


@query("f7_selected_parts", f"WITH {A.DAILY}, k AS (SELECT DISTINCT year(date) AS y, location_id AS l FROM daily WHERE year(date) = 1996 AND location_id IN (0, 2, 3, 4)), c AS (SELECT y, l FROM k QUALIFY (row_number() OVER (ORDER BY y, l) - 1) % 2 = 0) SELECT location_id, date, pet FROM daily JOIN c ON y = year(date) AND l = location_id")
def f7_filtered(spark, d):
    rows = A.daily(spark, d).withColumn("year", F.year("date"))
    some = (F.col("year") == 1996) & F.col("location_id").isin(0, 2, 3, 4)
    return history.every_nth(rows, ["year", "location_id"], 0, 2, some).select("location_id", "date", "pet")


@query("f9_time_buckets", "SELECT CAST(floor((h - 1087008) / 168.0) AS INTEGER) AS bucket, count(*) AS n FROM (SELECT (epoch_us(ts) // 1000000 + 2208988800) // 3600 AS h FROM events) GROUP BY 1")
def f9(spark, d):
    hours = A.table(spark, d, "events").select(S.ts_to_hour(F.col("ts")).alias("h"))
    return hours.groupBy(S.time_bucket(F.col("h"), 1087008, 168).alias("bucket")).agg(F.count("*").alias("n"))


_BATCHES = """years AS (SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS year FROM lineitem),
spans AS (SELECT year, datediff('day', DATE '1900-01-01', make_date(year, 1, 1)) * 24 AS a, datediff('day', DATE '1900-01-01', make_date(year + 1, 1, 1)) * 24 - 1 AS b FROM years),
batches AS (SELECT year, CAST(n AS INTEGER) AS batch_index, CAST(a + n * 720 AS INTEGER) AS start_h, CAST(least(a + n * 720 + 719, b) AS INTEGER) AS end_h FROM (SELECT *, unnest(range((b - a) // 720 + 1)) AS n FROM spans))"""


@query("f9_batch_table", f"WITH {_BATCHES}, d AS (SELECT CAST(l_shipdate AS DATE) AS date, count(*) AS n FROM lineitem GROUP BY 1) SELECT b.year, batch_index, start_h, end_h, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows FROM batches b LEFT JOIN d ON datediff('day', DATE '1900-01-01', d.date) * 24 BETWEEN start_h AND end_h GROUP BY ALL")
def f9_table(spark, d):
    """The batches of all years that there are rows for, with their rows: each row's batch is arithmetic, not a range join."""
    days = A.table(spark, d, "lineitem").groupBy(F.to_date("l_shipdate").alias("date")).agg(F.count("*").alias("n"))
    batches = history.year_batches(days.select(F.year("date").alias("year")), 720)
    held = days.select(F.year("date").alias("year"), S.time_bucket(S.date_hour(F.col("date")), S.first_hour(F.year("date")), 720).alias("batch_index"), "n")
    held = held.groupBy("year", "batch_index").agg(F.sum("n").alias("n"))
    return batches.join(held, ["year", "batch_index"], "left").select("year", "batch_index", "start_h", "end_h", F.coalesce("n", F.lit(0)).alias("rows"))


@query("f6_factorise", "SELECT l_suppkey, l_linenumber, CAST(dense_rank() OVER (ORDER BY l_suppkey, l_linenumber) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT l_suppkey, l_linenumber FROM lineitem)")
def f6(spark, d):
    pairs = A.table(spark, d, "lineitem").select("l_suppkey", "l_linenumber").distinct()
    return numbering.dense_ids(pairs, ["l_suppkey", "l_linenumber"], "code").withColumn("code", F.col("code").cast("int"))


@query("c11_fixed_columns", f"WITH {A.HISTORY} SELECT CAST(location_id AS INTEGER) AS location_id, date, pet, pet_avg FROM sources")
def c11(spark, d):
    fixed = [history.fixed_columns(df.withColumn("more", F.lit(1)), PET) for df in A.history_sources(spark, d)]
    return history.union_sources(fixed)


@query("c12_date_parse", f"WITH {A.HISTORY} SELECT date, TRY_CAST(date AS DATE) AS day, count(*) AS n FROM sources GROUP BY 1, 2")
def c12(spark, d):
    rows = history.union_sources(A.history_sources(spark, d))
    return rows.groupBy("date", F.try_to_date(F.col("date"), "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"))


@query("n10_yearly_update", f"WITH {A.DAILY}, {SEASONED}, {STATS} SELECT * FROM stats")
def n10(spark, d):
    """Clears a window, computes its days anew, upserts them and refreshes the statistics."""
    facts, path = _snapshot(spark, d, "n10"), Scratch(spark, "n10").path("stats")
    updates.refresh_statistics(facts, path)
    facts.delete_window("date", "1999-01-01", "1999-12-31")
    updates.refresh_statistics(facts, path)
    facts.upsert(A.daily(spark, d).where("year(date) = 1999"), ["location_id", "date"])
    return updates.refresh_statistics(facts, path)[0].scan().select(*stats.year_stats(facts.scan()).columns)


_UPDATED = """daily AS (SELECT coalesce(c.location_id, o.location_id) AS location_id, coalesce(c.date, o.date) AS date, coalesce(c.pet, o.pet) AS pet, coalesce(c.pet_avg, o.pet_avg) AS pet_avg FROM old o FULL JOIN comfort_days c USING (location_id, date))"""


@query("n10_comfort_update", f"{_RECURSIVE}, {COMFORT}, {A.DAILY.replace('daily AS', 'old AS')}, {_UPDATED}, {SEASONED}, {STATS} SELECT * FROM stats")
def n10_comfort(spark, d):
    """The yearly job with its own daily computation: days by the comfort solver over a grid store, facts, statistics."""
    scratch = Scratch(spark, "n10c")
    store = gridstore.write_grid(_grid(A.grid_hourly(spark, d)), scratch.path("grid"))
    places, members = weather.by_place(A.grid_cities(spark, d))
    sampled = gridstore.scan_cities(store, places)
    memo = weather.comfort_memo(spark, scratch.path("memo"))
    days = updates.compute_days(sampled, store.scan().select("year").distinct(), scratch.path("days"), lambda rows, seen: weather.with_pet(rows, memo=memo, seen=seen), members=members)
    facts = snapshots.create(tables.with_year(A.daily(spark, d)), scratch.path("facts"), ["year"])
    updates.refresh_statistics(facts, scratch.path("stats"))
    facts.upsert(days.scan().select("location_id", "date", "pet", "pet_avg"), ["location_id", "date"])
    return updates.refresh_statistics(facts, scratch.path("stats"))[0].scan().select(*stats.year_stats(facts.scan()).columns)


# -- single steps of the composed jobs ------------------------------------------------------------------
@query("a4_csv_scan", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def a4(spark, d):
    path = Scratch(spark, "a4").path("csv")
    A.table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal").write.option("header", True).csv(path)
    return history.scan_csv(spark, path, "c_custkey long, c_name string, c_acctbal double")


@query("c2_rename_key", "SELECT n_nationkey AS id, n_name FROM nation")
def c2(spark, d):
    return A.table(spark, d, "nation").select("n_nationkey", "n_name").withColumnRenamed("n_nationkey", "id")


@query("c5_date_window", f"WITH {A.DAILY} SELECT location_id, date, pet FROM daily WHERE date BETWEEN DATE '1997-03-01' AND DATE '1997-09-30'")
def c5(spark, d):
    rows = A.daily(spark, d).select("location_id", "date", "pet")
    return rows.where(F.col("date").between(F.lit("1997-03-01").cast("date"), F.lit("1997-09-30").cast("date")))


@query("c7_drop_nulls", f"WITH {A.HISTORY} SELECT location_id, pet, pet_avg FROM sources WHERE pet_avg IS NOT NULL AND pet IS NOT NULL")
def c7(spark, d):
    return history.union_sources(A.history_sources(spark, d)).dropna(subset=["pet", "pet_avg"]).select("location_id", "pet", "pet_avg")


@query("c8_valid_weather", "SELECT event_id FROM events WHERE event_id % 130 BETWEEN 1 AND 100 AND event_id % 7 - 1 > 0")
def c8(spark, d):
    rows = A.table(spark, d, "events").select("event_id", (F.col("event_id") % 130).alias("rh"), (F.col("event_id") % 7 - 1).alias("v"))
    return rows.where(weather.valid_weather()).select("event_id")


@query("c9_exclude_synthetic", "SELECT c_custkey, c_nationkey - 5 AS location_id FROM customer WHERE NOT (c_nationkey - 5 < 0)")
def c9(spark, d):
    return A.table(spark, d, "customer").select("c_custkey", (F.col("c_nationkey") - 5).alias("location_id")).where(~(F.col("location_id") < 0))


@query("c10_narrowing", "SELECT s_suppkey, CAST(s_nationkey AS SMALLINT) AS location_id, CAST(s_acctbal AS FLOAT) AS pet FROM supplier")
def c10(spark, d):
    return A.table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").cast("smallint").alias("location_id"), F.col("s_acctbal").cast("float").alias("pet"))


@query("d1_dimension_join", f"WITH {A.DAILY}, {SEASONED}, {STATS} SELECT s.location_id, s.year, s.season, s.avg_pet, r_name AS state FROM stats s JOIN region ON r_regionkey = location_id")
def d1(spark, d):
    names = A.table(spark, d, "region").select(F.col("r_regionkey").alias("location_id"), F.col("r_name").alias("state"))
    return stats.year_stats(A.daily(spark, d)).select("location_id", "year", "season", "avg_pet").join(names, "location_id")


@query("d2_horizon_join", f"WITH {A.DAILY_ALL}, {SEASONED}, {STATS}, {series_sql('mean')}, {SHORT_SQL} SELECT s.year, s.season, f.lower AS future_lower, f.upper AS future_upper FROM stats s LEFT JOIN fc f ON f.location_id = s.location_id AND f.season = s.season AND f.year = 2030")
def d2(spark, d):
    facts = _shared(spark, A.daily_all(spark, d))
    far = forecast.forecast(facts, **SHORT).where("year = 2030").select("location_id", "season", F.col("lower").alias("future_lower"), F.col("upper").alias("future_upper"))
    return stats.year_stats(facts).join(far, ["location_id", "season"], "left").select("year", "season", "future_lower", "future_upper")


@query("d3_baseline_change", f"WITH {A.DAILY}, {SEASONED}, {STATS}, b AS (SELECT location_id, season, avg_pet AS v FROM stats WHERE year = 1998) SELECT s.location_id, s.year, s.season, {_up('s.avg_pet - b.v', 2)} AS change FROM stats s LEFT JOIN b USING (location_id, season)")
def d3(spark, d):
    found = stats.year_stats(A.daily(spark, d))
    base = found.where("year = 1998").select("location_id", "season", F.col("avg_pet").alias("v"))
    return found.join(base, ["location_id", "season"], "left").select("location_id", "year", "season", S.round_half_up(F.col("avg_pet") - F.col("v"), 2).cast("float").alias("change"))


@query("d8_future_rows", f"WITH {A.MONTHLY}, m AS (SELECT location_id, max(period) AS last FROM monthly GROUP BY 1) SELECT location_id, unnest(range(last + 1, 24073)) AS period FROM m WHERE last < 24072")
def d8(spark, d):
    last = A.monthly(spark, d).groupBy("location_id").agg(F.max("period").alias("last")).where("last < 24072")
    return last.select("location_id", F.explode(F.sequence((F.col("last") + 1).cast("bigint"), F.lit(24072).cast("bigint"))).alias("period"))


@query("e2_percentiles", f"WITH {A.DAILY} SELECT location_id, {_near('quantile_cont(CAST(pet AS DOUBLE), 0.1)')} AS p10, {_near('quantile_cont(CAST(pet AS DOUBLE), 0.9)')} AS p90 FROM daily GROUP BY 1")
def e2(spark, d):
    found = A.daily(spark, d).groupBy("location_id").agg(F.percentile(F.col("pet").cast("double"), F.array(F.lit(0.1), F.lit(0.9))).alias("q"))
    return found.select("location_id", near(F.col("q")[0]).alias("p10"), near(F.col("q")[1]).alias("p90"))


@query("e6_distinct_years", "SELECT count(DISTINCT year(o_orderdate)) AS years FROM orders")
def e6(spark, d):
    return A.table(spark, d, "orders").agg(F.countDistinct(F.year("o_orderdate")).alias("years"))


@query("e7_filtered_distinct", "SELECT count(DISTINCT o_custkey * 10000 + year(o_orderdate)) FILTER (WHERE o_orderstatus = 'F') AS pairs FROM orders")
def e7(spark, d):
    pair = F.when(F.col("o_orderstatus") == "F", F.struct("o_custkey", F.year("o_orderdate").alias("y")))
    return A.table(spark, d, "orders").agg(F.countDistinct(pair).alias("pairs"))


@query("f2_keep_last_source", f"WITH {A.HISTORY} SELECT location_id, date, source FROM sources QUALIFY row_number() OVER (PARTITION BY location_id, date ORDER BY source DESC, pet DESC) = 1")
def f2(spark, d):
    tagged = history.union_sources([s.withColumn("source", F.lit(i)) for i, s in enumerate(A.history_sources(spark, d))])
    return stats.dedupe_latest(tagged, ["location_id", "date"], [F.col("source").desc(), F.col("pet").desc()]).select("location_id", "date", "source")


@query("f5_dense_ids", "SELECT CAST(row_number() OVER (ORDER BY p_partkey) - 1 AS INTEGER) AS id, p_partkey FROM (SELECT p_partkey FROM part ORDER BY p_partkey LIMIT 500)")
def f5(spark, d):
    top = A.table(spark, d, "part").select("p_partkey").orderBy("p_partkey").limit(500)
    return top.select((F.row_number().over(Window.orderBy("p_partkey")) - 1).cast("int").alias("id"), "p_partkey")


@query("g1_multi_key_sort", f"WITH {A.DAILY} SELECT location_id, date, pet FROM daily ORDER BY location_id, date")
def g1(spark, d):
    return A.daily(spark, d).select("location_id", "date", "pet").orderBy("location_id", "date")


@query("h1_tagged_union", f"WITH {A.DAILY_ALL}, {SEASONED}, {STATS}, {series_sql('mean')}, {SHORT_SQL} SELECT year, season, 0 AS source_order, avg_pet AS pet FROM stats UNION ALL SELECT year, season, 1, pet FROM fc")
def h1(spark, d):
    facts = _shared(spark, A.daily_all(spark, d))
    seen = stats.year_stats(facts).select("year", "season", F.lit(0).alias("source_order"), F.col("avg_pet").alias("pet"))
    return seen.unionByName(forecast.forecast(facts, **SHORT).select("year", "season", F.lit(1).alias("source_order"), "pet"))


@query("i1_seasons", "SELECT o_orderkey, CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'Winter' WHEN month(o_orderdate) < 6 THEN 'Spring' WHEN month(o_orderdate) < 9 THEN 'Summer' ELSE 'Fall' END AS season FROM orders")
def i1(spark, d):
    return A.table(spark, d, "orders").select("o_orderkey", S.season(F.to_date("o_orderdate")).alias("season"))


@query("i17_hour_epoch", "SELECT event_id, CAST((epoch_us(ts) // 1000000 + 2208988800) // 3600 AS INTEGER) AS hour, date_trunc('hour', ts) AS back FROM events")
def i17(spark, d):
    rows = A.table(spark, d, "events").select("event_id", S.ts_to_hour(F.col("ts")).alias("hour"))
    return rows.withColumn("back", S.hour_to_ts(F.col("hour")).cast("timestamp_ntz"))


@query("i20_weather_scalars", f"WITH {A.GRID} SELECT hour, {_near('lat')} AS lat, {_near('lng')} AS lng, {_near('t2 - 273.15', 4)} AS t, {_near('sqrt(u10*u10 + v10*v10)', 4)} AS v, {_near('ssrd / 3600', 4)} AS s, {_near('least(100, greatest(0, 100*exp(17.625*(d2 - 273.15)/(243.04 + d2 - 273.15))/exp(17.625*(t2 - 273.15)/(243.04 + t2 - 273.15))))', 4)} AS rh FROM grid")
def i20(spark, d):
    g = _grid(A.grid_hourly(spark, d))
    t, dew = S.celsius(F.col("t2")), S.celsius(F.col("d2"))
    return g.select("hour", near("lat").alias("lat"), near("lng").alias("lng"), near(t, 4).alias("t"), near(S.wind(F.col("u10"), F.col("v10")), 4).alias("v"), near(S.flux(F.col("ssrd")), 4).alias("s"), near(S.relative_humidity(t, dew), 4).alias("rh"))
