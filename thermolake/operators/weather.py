"""Gridded weather to hourly inputs, comfort values and daily facts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from thermolake.functions import scalars as S
from thermolake.functions.comfort import solve
from thermolake.operators.snapshots import SnapshotTable, create
from thermolake.session import Scratch

#: Names under which stores keep each variable.
ALIASES = {
    "u10": ["u10", "10u", "10m_u_component_of_wind"],
    "v10": ["v10", "10v", "10m_v_component_of_wind"],
    "t2": ["t2", "2t", "t2m", "2m_temperature"],
    "d2": ["d2", "2d", "d2m", "2m_dewpoint_temperature"],
    "ssrd": ["ssrd", "surface_solar_radiation_downwards"],
    "strd": ["strd", "surface_thermal_radiation_downwards"],
    "ssr": ["ssr", "surface_net_solar_radiation"],
    "str": ["str", "surface_net_thermal_radiation"],
    "fdir": ["fdir", "total_sky_direct_solar_radiation_at_surface"],
}
INPUTS = ["t", "mrt", "v", "rh"]
#: Cities that are broadcast (about 60 bytes each); beyond it both sides are shuffled by cell.
BROADCAST_CITIES = 500_000
#: Cities of one place that lie in one array, so that no row grows with their number.
CITIES_TOGETHER = 1024
#: Cities that are broadcast in arrays (at most 8 bytes each), if the arrays are no more than BROADCAST_CITIES.
BROADCAST_MEMBERS = 8_000_000
#: Solved tuples that are broadcast (about 60 bytes each); beyond it both sides are shuffled by tuple.
BROADCAST_SOLVED = 500_000
#: What radiant temperatures (Celsius) and comfort values may be.
RADIANT_RANGE, COMFORT_RANGE = (-80.0, 120.0), (-50.0, 60.0)


def resolve_variables(columns: list[str], aliases: dict[str, list[str]] = ALIASES) -> dict[str, str]:
    """The column that holds each variable; raises where one has none."""
    found = {k: next((c for c in names if c in columns), None) for k, names in aliases.items()}
    if missing := [k for k, c in found.items() if c is None]:
        raise ValueError(f"no column for {', '.join(missing)}")
    return found


def scan_grid(spark, path: str, aliases: dict[str, list[str]] = ALIASES, hour_range: tuple[int, int] | None = None) -> DataFrame:
    """hour, lat, lng and the nine variables; the range of hours reaches the scan."""
    raw = spark.read.parquet(path)
    if hour_range:
        raw = raw.where(F.col("hour").between(*hour_range))
    return raw.select("hour", "lat", "lng", *[F.col(c).alias(k) for k, c in resolve_variables(raw.columns, aliases).items()])


def by_place(cities: DataFrame, shards: int = 1) -> tuple[DataFrame, DataFrame]:
    """Cities at the same coordinates as one place, and what gives every city its rows back (`each_city`).

    Places: location_id (of the city that stands for all of them), lat, lng, cities (how many). Members: _place (that
    location_id), ids (arrays of at most about CITIES_TOGETHER cities). Weather, comfort and days of a place are those
    of all its cities, so that work follows places and hours, and only the last step the cities. With shards, a place
    stands for cities of one shard (location_id modulo `shards`). Cities without a location_id, and rows that share
    one, stand for themselves.
    """
    scratch = Scratch(cities.sparkSession, "places")
    same = F.count(F.lit(1)).over(Window.partitionBy("location_id"))
    rows = scratch.table(cities.select("location_id", "lat", "lng", F.pmod("location_id", F.lit(shards)).alias("_shard"), same.alias("_same")), "cities")
    single = F.col("location_id").isNotNull() & (F.col("_same") == 1)
    once, more = rows.where(single).drop("_same"), rows.where(~single)
    key = ["lat", "lng", "_shard"]
    groups = scratch.table(once.groupBy(*key).agg(F.min("location_id").alias("_place"), F.count(F.lit(1)).alias("cities")), "groups")
    places = groups.select(F.col("_place").alias("location_id"), "lat", "lng", "cities").unionByName(more.select("location_id", "lat", "lng", F.lit(1).cast("bigint").alias("cities")))
    nth = F.pmod(F.xxhash64("location_id"), F.ceil(F.col("cities") / CITIES_TOGETHER)).alias("_nth")
    members = once.join(F.broadcast(groups) if groups.count() <= BROADCAST_CITIES else groups, key).groupBy("_place", nth).agg(F.collect_list("location_id").alias("ids")).drop("_nth")
    alone = more.select(F.col("location_id").alias("_place")).distinct().withColumn("ids", F.array("_place"))
    return places, scratch.table(members.unionByName(alone), "members")


def each_city(df: DataFrame, members: DataFrame) -> DataFrame:
    """A row of each city for every row of its place, which is named by location_id.

    Rows are first dealt out over as many tasks as a shuffle has: they are few, and their copies many. They are dealt by a
    hash of their keys, since a deal by the keys themselves is dropped where rows come from a grouping by the same
    keys, whose few bytes adaptive execution then puts together into a few tasks.
    """
    spark = df.sparkSession
    arrays, ids = members.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()
    side = F.broadcast(members) if arrays <= BROADCAST_CITIES and ids <= BROADCAST_MEMBERS else members
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    when = [c for c in ("location_id", "hour", "date") if c in df.columns]
    found = df.repartition(tasks, F.xxhash64(*when)).join(side, F.col("location_id").eqNullSafe(F.col("_place")))
    return found.select([F.explode("ids").alias(c) if c == "location_id" else F.col(c) for c in df.columns if c != "cities"])


def city_hours(df: DataFrame, where: Column | None = None) -> Column:
    """How many hours of cities rows stand for, of those that a condition holds for: a place's row counts for each of its cities."""
    n = F.col("cities") if "cities" in df.columns else F.lit(1)
    return F.coalesce(F.sum(n if where is None else F.when(where, n)), F.lit(0)).cast("bigint")


def sample_grid(grid: DataFrame, cities: DataFrame, cell: float = 0.25) -> DataFrame:
    """Each city's (or place's) grid rows: both sides are snapped to integer cells, longitudes wrapped, and joined on equality."""
    around = round(360 / cell)
    cells = lambda lat, lng: (S.cell_id(F.col(lat), cell).alias("_i"), (S.cell_id(S.wrap360(F.col(lng)), cell) % around).alias("_j"))
    places = cities.select("location_id", F.col("lat").alias("city_lat"), F.col("lng").alias("city_lng"), *_cities(cities), *cells("lat", "lng"))
    side = F.broadcast(places) if cities.limit(BROADCAST_CITIES + 1).count() <= BROADCAST_CITIES else places
    return grid.select("*", *cells("lat", "lng")).drop("lat", "lng").join(side, ["_i", "_j"]).drop("_i", "_j")


def _cities(df: DataFrame) -> list[str]:
    """The column of places that tells how many cities they stand for, where there is one."""
    return [c for c in df.columns if c == "cities"]


def derive_weather(df: DataFrame, seen: Observation | None = None) -> DataFrame:
    """location_id, hour, t, v, rh, mrt of sampled rows: valid ones only, all by column expressions.

    `seen` gets, from the job that runs anyway, hours: all sampled rows; radiation: those whose radiant
    temperature is no number or out of range; weather: those left out for another reason.

    The row goes through a one-element array between derivation and filter. Else the optimiser would put the
    formulas into the filter in place of their names, and both into the condition of the join below.
    """
    f = {c: S.flux(F.col(c)) for c in ("ssrd", "ssr", "strd", "str", "fdir")}
    middle = S.hour_to_ts(F.col("hour")) - F.expr("INTERVAL 30 MINUTES")
    sun = df.withColumn("_sun", S.cossza(F.col("city_lat"), S.to_180(F.col("city_lng")), middle))
    t, dew = S.celsius(F.col("t2").cast("double")), S.celsius(F.col("d2").cast("double"))
    radiant = S.mrt(f["ssrd"], f["ssr"], S.dsrp(f["fdir"], F.col("_sun")), f["strd"], f["fdir"], f["str"], F.col("_sun"))
    out = sun.select("location_id", "hour", *_cities(df), t.alias("t"), S.wind(F.col("u10"), F.col("v10")).alias("v"), S.relative_humidity(t, dew).alias("rh"), S.null_outside(S.celsius(radiant), *RADIANT_RANGE).alias("mrt"))
    out = out.select(F.inline(F.array(F.struct(*out.columns))))
    # NaN is above every bound, so these comparisons also drop what is not a number, and nulls
    fine = valid_weather() & (F.col("t") < float("inf")) & (F.col("v") < float("inf"))
    if seen is not None:
        bad = ~F.coalesce(fine, F.lit(False)) & F.col("mrt").isNotNull()
        out = out.observe(seen, city_hours(out).alias("hours"), city_hours(out, F.col("mrt").isNull()).alias("radiation"), city_hours(out, bad).alias("weather"))
    return out.where(fine & F.col("mrt").isNotNull())


def discarded_radiation(df: DataFrame) -> DataFrame:
    """How many values of a column mrt (Celsius) are not finite or out of range."""
    return df.agg(F.count(F.when(S.null_outside(F.col("mrt"), *RADIANT_RANGE).isNull() & F.col("mrt").isNotNull(), 1)).alias("discarded"), F.count("*").alias("rows"))


def valid_weather() -> Column:
    return F.col("rh").between(1.0, 100.0) & (F.col("v") > 0.0)


def only_months(df: DataFrame, date_col: str, months: list[int]) -> DataFrame:
    """The rows of some months; no months mean all."""
    return df.where(F.month(date_col).isin(months)) if months else df


def solve_distinct(df: DataFrame, inputs: list[str], fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], output: T.StructField, memo: SnapshotTable | None = None) -> DataFrame:
    """Adds fn's output by computing it once for each distinct tuple of inputs and joining it back. Rows with a null input go.

    Rows are written once for both uses. Tuples are dealt out over as many tasks as a shuffle has, since a small
    table of them may be much work. With a memo, a table of tuples that were solved before, only those that it
    lacks are solved, and added to it.
    """
    scratch = Scratch(df.sparkSession, "solve")
    rows = scratch.table(df, "rows")
    distinct = rows.select(*inputs).dropna().distinct()
    if memo is not None:
        distinct = scratch.table(distinct, "tuples")
        wanted, distinct = distinct, distinct.join(memo.scan().select(*inputs), inputs, "left_anti")
    spread = distinct.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = spread.mapInPandas(fn, T.StructType([*distinct.schema.fields, output]))
    if memo is None:
        solved = scratch.table(found, "solved")
    else:
        memo.commit(found, append=True, facts=memo.manifest().facts)
        solved = scratch.table(memo.scan().join(wanted, inputs, "left_semi"), "solved")
    return rows.join(F.broadcast(solved) if solved.count() <= BROADCAST_SOLVED else solved, inputs, "inner")


def comfort_memo(spark, path: str, icl: float = 0.5, **body) -> SnapshotTable:
    """The table of comfort values that were solved for this clothing and body; made if it is not there, refused if it is for others."""
    about = {"icl": icl, **body}
    memo = SnapshotTable(spark, path)
    if not memo.versions():
        memo = create(spark.createDataFrame([], "t double, mrt double, v double, rh double, pet float"), path, narrow=False, facts=about)
    if memo.manifest().facts != about:
        raise ValueError(f"{path} holds values for {memo.manifest().facts}, not {about}")
    return memo


def with_pet(df: DataFrame, icl: float = 0.5, memo: SnapshotTable | None = None, seen: Observation | None = None, **body) -> DataFrame:
    """Rounds t, mrt, v, rh to 0.5 and adds the comfort temperature pet, rounded to 0.5; rows out of -50..60 go, and `seen` gets their number (comfort)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(pet=solve(*(b[c].to_numpy() for c in INPUTS), icl=icl, **body).astype("float32"))

    rounded = df.withColumns({c: S.rint_to(F.col(c), 2.0) for c in INPUTS})
    found = solve_distinct(rounded, INPUTS, run, T.StructField("pet", T.FloatType()), memo)
    found = found.withColumn("pet", S.rint_to(S.null_outside(F.col("pet"), *COMFORT_RANGE), 2.0).cast("float"))
    if seen is not None:
        found = found.observe(seen, city_hours(found, F.col("pet").isNull()).alias("comfort"))
    return found.dropna(subset=["pet"])


def observed(seen: Observation, names: list[str]) -> dict[str, int]:
    """What a job has counted; zeros where the optimiser saw that there are no rows at all, and left out the branch that counts."""
    try:
        return seen.get
    except Py4JJavaError:
        return dict.fromkeys(names, 0)


def daily_comfort(df: DataFrame) -> DataFrame:
    """location_id, date (UTC), highest and mean pet of each day, the mean on a grid of 0.1."""
    day = F.to_date(S.hour_to_ts(F.col("hour")))
    return df.groupBy("location_id", day.alias("date")).agg(F.max("pet").alias("pet"), S.rint_to(F.avg("pet"), 10.0).cast("float").alias("pet_avg"))


def hourly_frame(cities: DataFrame, first: Column | int, last: Column | int) -> DataFrame:
    """Every city at every hour from first to last (numbers, or columns of the cities), for gap-filled frames; each city's hours grow from its own row."""
    at = lambda x: (x if isinstance(x, Column) else F.lit(x)).cast("int")
    return cities.where(at(first) <= at(last)).select("location_id", F.explode(F.sequence(at(first), at(last))).alias("hour"))
