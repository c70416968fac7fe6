"""Gridded weather kept by place: a city reads the tiles that it lies in, not the globe.

Cells of the grid are put together in square tiles. A store is a snapshot table with a partition for each year
and tile, whose files are sorted by cell and hour, so that a scan opens the tiles of the wanted cells alone, and
the statistics of row groups skip other cells and hours inside them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermolake.functions import scalars as S
from thermolake.operators.snapshots import SnapshotTable, part_name
from thermolake.operators.weather import sample_grid

#: Cells along a tile's side: 2.5 degrees, so that the globe has 10,512 tiles.
SIDE = 10


def tile_of(lat: Column, lng: Column, cell: float = 0.25, side: int = SIDE) -> Column:
    """The number of the tile that holds a place's nearest cell; longitudes are wrapped."""
    around = round(360 / cell)
    row = F.floor((S.cell_id(lat, cell) + round(90 / cell)) / side)
    return (row * -(-around // side) + F.floor((S.cell_id(S.wrap360(lng), cell) % around) / side)).cast("int")


def write_grid(grid: DataFrame, path: str, cell: float = 0.25, side: int = SIDE) -> SnapshotTable:
    """Adds grid rows (hour, lat, lng and variables) to a store, which is made if it is not there. Years and tiles that the rows lie in are replaced."""
    store = SnapshotTable(grid.sparkSession, path)
    placed = grid.select(F.col("hour").cast("int").alias("hour"), *[c for c in grid.columns if c != "hour"], S.hour_year(F.col("hour")).alias("year"), tile_of(F.col("lat"), F.col("lng"), cell, side).alias("tile"))
    about = {"cell": cell, "side": side}
    if store.versions() and store.manifest().facts != about:
        raise ValueError(f"{path} is kept by {store.manifest().facts}, not {about}")
    store.commit(placed, ["year", "tile"], sort=["lat", "lng", "hour"], facts=about, narrow=False)
    return store


def scan_cities(store: SnapshotTable, cities: DataFrame, hours: tuple[int, int] | None = None) -> DataFrame:
    """Each city's hours from the store, as sample_grid gives them; only the tiles of cities, and the years of the hours, are opened."""
    m = store.manifest()
    cell, side = m.facts["cell"], m.facts["side"]
    # no more tiles than the globe has, however many cities
    tiles = {r[0] for r in cities.select(tile_of(F.col("lat"), F.col("lng"), cell, side)).distinct().collect()}
    years = None
    if hours:
        one = cities.sparkSession.range(1)
        years = set(range(*(one.select(S.hour_year(F.lit(h)) + k).first()[0] for k, h in enumerate(hours))))
    wanted = {part_name({"year": y, "tile": t}) for y in years for t in tiles} if years is not None else None
    held = store.scan(m.version, (lambda n: n in wanted) if wanted is not None else (lambda n: int(n.rsplit("=", 1)[1]) in tiles))
    if hours:
        held = held.where(F.col("hour").between(*hours))
    return sample_grid(held.drop("year", "tile"), cities, cell)
