"""The yearly job: daily comfort by resumable parts, facts by upsert, statistics and forecasts where facts changed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from thermolake.functions import scalars as S
from thermolake.operators import history, stats, weather
from thermolake.operators.snapshots import SnapshotTable, create, part_name
from thermolake.session import Scratch

PART = ["year", "batch", "shard"]
#: Slices of the locations that forecasts are kept by: a changed location rewrites one of them.
SLICES = 64


def planned_parts(years: DataFrame, batch_hours: int, shards: int) -> DataFrame:
    """year, batch, shard, start_h, end_h of all parts that the hours of some years make."""
    if batch_hours % 24:
        raise ValueError("a batch must be whole days")
    batches = history.year_batches(years, batch_hours)
    return batches.select("year", F.col("batch_index").alias("batch"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "start_h", "end_h")


def compute_days(sampled: DataFrame, years: DataFrame, path: str, with_comfort: Callable[[DataFrame, Observation], DataFrame], batch_hours: int = 720, shards: int = 1, force: bool = False, only: str | None = None, members: DataFrame | None = None) -> SnapshotTable:
    """Daily comfort of sampled grid rows, as a table by (year, batch, shard) that is also the ledger of what is done.

    Only planned parts that the table lacks are computed (all with `force`; of these those that the condition
    `only` holds for), in one job, and committed together: a run that is stopped has done all or nothing of them,
    and the next one goes on from there. Parts without rows count as done. A location's shard is its number
    modulo `shards`; a batch is whole days, so that no day is split. with_comfort(rows, seen) adds pet to derived
    weather. The manifest's facts hold how many hours were sampled and how many were left out, and why, counted by the jobs themselves.
    Sampled rows may be those of places instead of cities, with their members (weather.by_place, by the same shards):
    then days are computed by place, and given to each city when they are written.
    """
    table = SnapshotTable(sampled.sparkSession, path)
    plan = planned_parts(years, batch_hours, shards)
    plan = plan.where(only) if only else plan
    version = max(table.versions(), default=0)
    if version:
        if table.manifest().facts["plan"] != [batch_hours, shards]:
            raise ValueError(f"{path} was made with batches and shards of {table.manifest().facts['plan']}")
        plan = history.pending(plan, table.done(version), PART, force)
    todo = plan.collect()  # a row for each part
    if not todo:
        return table
    parts = F.broadcast(sampled.sparkSession.createDataFrame(todo, plan.schema).select(*PART))
    hour = F.col("hour")
    year = S.hour_year(hour)
    placed = sampled.withColumns({"year": year, "batch": S.time_bucket(hour, S.first_hour(year), batch_hours), "shard": F.pmod("location_id", F.lit(shards)).cast("int")})
    spans = (min(r.start_h for r in todo), max(r.end_h for r in todo))
    chosen = placed.where(hour.between(*spans)).join(parts, PART, "left_semi").drop(*PART)
    sky, skin = Observation("sky"), Observation("skin")
    days = weather.daily_comfort(with_comfort(weather.derive_weather(chosen, sky), skin))
    days = days if members is None else weather.each_city(days, members)
    first = S.date_hour(F.col("date"))
    rows = days.withColumns({"year": F.year("date"), "batch": S.time_bucket(first, S.first_hour(F.year("date")), batch_hours), "shard": F.pmod("location_id", F.lit(shards)).cast("int")})
    names = [part_name({k: r[k] for k in PART}) for r in todo]
    counts = lambda: {"plan": [batch_hours, shards], "counts": weather.observed(sky, ["hours", "radiation", "weather"]) | weather.observed(skin, ["comfort"])}
    table.commit(rows, PART, drop=names, sort=["location_id", "date"], facts=counts, base=version)
    return table


def refresh_statistics(facts: SnapshotTable, path: str) -> tuple[SnapshotTable, int]:
    """Year statistics kept by year: only (location, year) groups whose facts changed since the last refresh are computed. Also how many these were."""
    kept, source = SnapshotTable(facts.spark, path), facts.manifest()
    if not kept.versions():
        found = stats.year_stats(facts.scan(source.version))
        table = create(found, path, ["year"], facts={"source": source.version})
        return table, table.scan().select("location_id", "year").distinct().count()
    m = kept.manifest()
    changed = facts.changed_keys([F.col("location_id").cast("int").alias("location_id"), F.year("date").cast("smallint").alias("year")], m.facts["source"], source.version)
    scratch = Scratch(facts.spark, "changed")
    groups = scratch.table(changed.where("year is not null"), "groups")  # written, as all locations may have changed
    found = {r.year: r.n for r in groups.groupBy("year").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not found:
        return kept, 0
    years = sorted(found)
    names = {part_name({"year": y}) for y in years}
    again = facts.scan(source.version, names.__contains__)
    again = again.withColumn("year", F.year("date").cast("smallint")).withColumn("location_id", F.col("location_id").cast("int")).join(groups, ["location_id", "year"], "left_semi")
    new = stats.year_stats(again)
    rest = kept.scan(m.version, names.__contains__).join(groups, ["location_id", "year"], "left_anti")
    kept.commit(rest.select(*new.columns).unionByName(new), drop=sorted(names), facts={"source": source.version}, base=m.version)
    scratch.keep()
    return kept, sum(found.values())


def refresh_forecasts(facts: SnapshotTable, path: str, make: Callable[[DataFrame], DataFrame]) -> tuple[SnapshotTable, int]:
    """Forecasts kept by slices of the locations: only locations whose facts changed since the last refresh are fitted. Also how many these were."""
    kept, source = SnapshotTable(facts.spark, path), facts.manifest()
    sliced = lambda df: df.withColumn("slice", F.pmod(F.col("location_id").cast("int"), F.lit(SLICES)).cast("int"))
    if not kept.versions():
        table = create(sliced(make(facts.scan(source.version))), path, ["slice"], facts={"source": source.version})
        return table, facts.scan(source.version).select("location_id").distinct().count()
    m = kept.manifest()
    changed = facts.changed_keys([F.col("location_id").cast("int").alias("location_id")], m.facts["source"], source.version)
    changed = [r[0] for r in changed.collect()]
    if not changed:
        return kept, 0
    places = facts.spark.createDataFrame([(c,) for c in changed], "location_id int")
    names = {part_name({"slice": c % SLICES}) for c in changed}
    new = sliced(make(facts.scan(source.version).join(places, "location_id", "left_semi")))
    rest = kept.scan(m.version, names.__contains__).join(places, "location_id", "left_anti")
    kept.commit(rest.select(*new.columns).unionByName(new), drop=sorted(names), facts={"source": source.version}, base=m.version)
    return kept, len(changed)
