"""Trees of parquet files whose columns and types differ from file to file, read as one table.

The schema of each file is in its footer, which tasks read; only distinct schemas come to the driver. Columns are
united in the order in which files, by path, first have them, and a column's type is the narrowest that holds all
of its types. Where the reader itself can widen what a file has, the tree is one scan with the united schema,
filters and column selection pushed down; files that need a cast are scans of their own, one for each schema.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
#: What the parquet reader widens by itself: from, to.
_BY_READER = {(a, b) for i, a in enumerate(_WHOLE) for b in _WHOLE[i:]} | {(a, T.DoubleType()) for a in [*_WHOLE[:3], T.FloatType()]}


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds both; a string where there is none."""
    if a == b:
        return a
    if a in _WHOLE and b in _WHOLE:
        return _WHOLE[max(_WHOLE.index(a), _WHOLE.index(b))]
    number = [*_WHOLE, T.FloatType(), T.DoubleType()]
    if a in number and b in number:
        return T.DoubleType()
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else T.StringType()
    if {a, b} <= {T.DateType(), T.TimestampType(), T.TimestampNTZType()}:
        return T.TimestampType() if T.TimestampType() in (a, b) else T.TimestampNTZType()
    return b if isinstance(a, T.NullType) else a if isinstance(b, T.NullType) else T.StringType()


def united(schemas: list[T.StructType]) -> T.StructType:
    """Columns in the order in which they are first seen, each as wide as its widest."""
    found: dict[str, T.DataType] = {}
    for f in (f for s in schemas for f in s.fields):
        found[f.name] = wider(found[f.name], f.dataType) if f.name in found else f.dataType
    return T.StructType([T.StructField(k, t) for k, t in found.items()])


def _footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pyarrow.parquet as pq
    from pyarrow import fs
    from pyspark.sql.pandas.types import from_arrow_schema

    for batch in batches:
        schemas = []
        for path in batch["path"]:
            files, at = fs.FileSystem.from_uri(path)
            with files.open_input_file(at) as f:
                schemas.append(from_arrow_schema(pq.read_schema(f), prefer_timestamp_ntz=True).json())
        yield batch.assign(schema=schemas)


def file_schemas(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """path, schema (JSON) of every file of a tree that matches a name pattern. Footers alone are read, through pyarrow's file systems."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(root).select("path")
    spread = listed.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path")
    return spread.mapInPandas(_footers, "path string, schema string")


def scan_evolving(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """All files of a tree of key=value folders under their united columns, with the keys as columns. Columns that a file lacks are null in its rows."""
    rows = file_schemas(spark, root, glob)
    # one row for each distinct schema
    kinds = sorted(rows.groupBy("schema").agg(F.min("path").alias("first")).collect(), key=lambda r: r.first)
    if not kinds:
        raise FileNotFoundError(f"no file like {glob} under {root}")
    schemas = {r.schema: T.StructType.fromJson(json.loads(r.schema)) for r in kinds}
    whole = united(list(schemas.values()))
    fits = lambda s: all(f.dataType == whole[f.name].dataType or (f.dataType, whole[f.name].dataType) in _BY_READER for f in s.fields)
    odd = {k for k, s in schemas.items() if not fits(s)}
    reader = lambda schema: spark.read.schema(schema).option("basePath", root).option("pathGlobFilter", glob)
    if not odd:
        return reader(whole).parquet(root)
    paths: dict[str, list[str]] = {}
    for r in rows.collect():  # a path for each file, as a scan's own listing has them
        paths.setdefault(r.schema if r.schema in odd else "", []).append(r.path)
    parts = []
    for kind in [k for k in ("", *schemas) if k in paths]:
        df = reader(schemas[kind] if kind else whole).parquet(*sorted(paths[kind]))
        keys = [c for c in df.columns if c not in whole.names]
        parts.append(df.select([(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in whole.fields] + keys))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
