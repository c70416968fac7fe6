"""City and location tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from thermolake.functions import scalars as S

# The box of places, and the names of columns in city sources.
LAT_BOX, LNG_BOX = (24.25, 49.25), (-124.5, -66.5)
HEADERS = {"City": "city", "name": "city", "State": "state", "Population": "population", "pop": "population", "lon": "lng"}


def normalise_headers(df: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    names = renames or HEADERS
    return df.toDF(*[names.get(c, c).lower() for c in df.columns])


def in_box(df: DataFrame, lat: tuple[float, float] = LAT_BOX, lng: tuple[float, float] = LNG_BOX) -> DataFrame:
    return df.where(F.col("lat").between(*lat) & F.col("lng").between(*lng))


def one_per_cell(df: DataFrame, cell: float = 0.25) -> DataFrame:
    """The most populous city of each grid cell; ties go by city and state."""
    rank = F.struct(F.col("population").isNull().alias("none"), (-F.col("population")).alias("size"), "city", "state", *[F.col(c).alias(f"own_{c}") for c in df.columns])
    # an aggregate, so that a cell's rows meet only after each task has kept its best
    best = df.groupBy(S.cell_id(F.col("lat"), cell).alias("_lat"), S.cell_id(F.col("lng"), cell).alias("_lng")).agg(F.min(rank).alias("best"))
    return best.select([F.col(f"best.own_{c}").alias(c) for c in df.columns])


def build_cities(df: DataFrame, cell: float = 0.25, k: int = 500) -> DataFrame:
    """location_id, city, state, lat, lng of the k most populous cities, one per cell, numbered from 0 by population.

    The top-k comes before the numbering, so that only k rows meet in one partition.
    """
    order = [F.col("population").desc_nulls_last(), F.col("city"), F.col("state")]
    top = one_per_cell(in_box(df), cell).orderBy(*order).limit(k)
    three = lambda c: S.rint_to(F.col(c), 1000.0).alias(c)
    return top.select((F.row_number().over(Window.orderBy(*order)) - 1).cast("int").alias("location_id"), "city", "state", three("lat"), three("lng"))


def build_locations(cities: DataFrame) -> DataFrame:
    """The dimension table: location_id is called id, in stored types."""
    return cities.select(F.col("location_id").cast("smallint").alias("id"), "city", "state", F.col("lat").cast("float").alias("lat"), F.col("lng").cast("float").alias("lng"))
