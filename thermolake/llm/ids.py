"""Keys of rows, and selecting rows by a table of keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermolake.session import Scratch

#: Keys that are broadcast (16 bytes each); beyond it the tables are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def fresh(df: DataFrame, name: str) -> str:
    """The name, or the next one like it that no column of the table has in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def by_ids(scratch: Scratch, docs: DataFrame, ids: DataFrame, how: str, label: str, on: str | list[str] = "doc_id") -> DataFrame:
    """docs that have (left_semi) or lack (left_anti) their key in ids, a table with the key's columns. A null matches nothing."""
    on = [on] if isinstance(on, str) else on
    ids = scratch.table(ids.select(*on).distinct(), label)
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, on, how).select(*docs.columns)


def row_keys(scratch: Scratch, docs: DataFrame, name: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with a number that tells the texts of one id apart: 0 where rows have their id alone, else the text's hash."""
    several = docs.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count("*").alias("n")).where("n > 1").select(id_col)
    several = scratch.table(several, "several")
    n = several.limit(BROADCAST_IDS + 1).count()
    if not n:
        return docs.withColumn(name, F.lit(0).cast("long"))
    found = several.select(F.col(id_col).alias(f"{name}_id"), F.lit(True).alias(f"{name}_is"))
    joined = docs.join(F.broadcast(found) if n <= BROADCAST_IDS else found, F.col(id_col) == F.col(f"{name}_id"), "left")
    return joined.select(*docs.columns, F.when(F.col(f"{name}_is"), F.xxhash64(text_col)).otherwise(F.lit(0)).cast("long").alias(name))
