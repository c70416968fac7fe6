"""Tables of immutable files under versioned manifests: a change is seen whole or not at all.

A table is a folder of partitions (`data/year=1999/<commit>/part-*.parquet`) and of manifests, one small JSON
file for each version, which names the folders that the version consists of. A change writes new folders, which
nobody reads yet, and then moves one finished manifest into place. Whatever stops a writer before that move
leaves the old version; after it, the new one is complete. Two writers of the same version cannot both win.
Readers take the newest manifest once, and what they read stays until `vacuum` takes away what no kept version
names.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thermolake.operators.tables import filesystem, last_staged, merge_upsert, narrowed, outside_window, staged_in_order

_NULL = "__HIVE_DEFAULT_PARTITION__"


class CommitConflict(RuntimeError):
    """Another writer has made the version that this one was about to make."""


@dataclass
class Manifest:
    """parts: the folders of each partition, by its name (year=1999); a partition that is done but has no rows has none."""

    version: int
    schema: str
    by: list[str]
    parts: dict[str, list[str]]
    facts: dict = field(default_factory=dict)


def part_name(keys: dict) -> str:
    """The folder name of partition values: key=value, with what file names cannot hold written as %XX; null has a name of its own."""
    # The characters that a partition folder's name cannot hold.
    text = lambda v: _NULL if v is None or v == "" else re.sub(r"[\x00-\x1f\"#%'*/:=?\\\x7f{\[\]^]", lambda m: f"%{ord(m[0]):02X}", str(v))
    return "/".join(f"{k}={text(v)}" for k, v in keys.items())


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.fs, self.at = filesystem(spark, self.path)

    # -- manifests -------------------------------------------------------------------------------------
    def _log(self, version: int | None = None) -> str:
        return f"{self.path}/manifests" + ("" if version is None else f"/{version:012d}.json")

    def versions(self) -> list[int]:
        where = self.at(self._log())
        names = [s.getPath().getName() for s in self.fs.listStatus(where)] if self.fs.exists(where) else []
        return sorted(int(n[:12]) for n in names if re.fullmatch(r"\d{12}\.json", n))

    def manifest(self, version: int | None = None) -> Manifest:
        """A version's manifest, the newest one's by default."""
        version = max(self.versions(), default=0) if version is None else version
        if not version:
            raise FileNotFoundError(f"{self.path} has no version yet")
        stream = self.fs.open(self.at(self._log(version)))
        try:
            body = json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()
        if body.pop("digest") != hashlib.sha256(json.dumps(body, sort_keys=True).encode()).hexdigest():
            raise ValueError(f"manifest {version} of {self.path} is damaged")
        return Manifest(**body)

    def _publish(self, manifest: Manifest) -> None:
        """The only step that changes what readers see: a finished manifest is moved to its name, which must be free."""
        body = {"version": manifest.version, "schema": manifest.schema, "by": manifest.by, "parts": manifest.parts, "facts": manifest.facts}
        body["digest"] = hashlib.sha256(json.dumps(body, sort_keys=True).encode()).hexdigest()
        final, fresh = self.at(self._log(manifest.version)), self.at(f"{self._log()}/.{uuid.uuid4().hex}.tmp")
        stream = self.fs.create(fresh, False)
        try:
            stream.write(json.dumps(body).encode())
        finally:
            stream.close()
        if self.fs.exists(final) or not self.fs.rename(fresh, final):
            self.fs.delete(fresh, False)
            raise CommitConflict(f"version {manifest.version} of {self.path} is there already, or cannot be made")

    # -- reading ---------------------------------------------------------------------------------------
    def scan(self, version: int | None = None, parts: Callable[[str], bool] | None = None) -> DataFrame:
        """A version's rows; parts: which partitions, by name (else filters on partition columns prune as usual)."""
        m = self.manifest(version)
        schema = T.StructType.fromJson(json.loads(m.schema))
        folders = [f"{self.path}/data/{f}" for name, own in m.parts.items() if parts is None or parts(name) for f in own]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*folders).select(*schema.names)

    def done(self, version: int | None = None) -> DataFrame:
        """The partition columns of all partitions that were ever committed and not taken away, those without rows too."""
        m = self.manifest(version)
        kinds = {f.name: f.dataType for f in T.StructType.fromJson(json.loads(m.schema)).fields}
        rows = [tuple(None if v == _NULL else re.sub(r"%([0-9A-F]{2})", lambda x: chr(int(x[1], 16)), v) for v in (p.split("=", 1)[1] for p in name.split("/"))) for name in m.parts if m.by]
        found = self.spark.createDataFrame(rows, T.StructType([T.StructField(k, T.StringType()) for k in m.by]))
        return found.select([F.col(k).cast(kinds[k]).alias(k) for k in m.by])

    # -- writing ---------------------------------------------------------------------------------------
    def _written(self, df: DataFrame, by: list[str], sort: list[str]) -> dict[str, list[str]]:
        """New folders by partition: written beside the data and moved under their partitions, where only a manifest makes them count."""
        commit = uuid.uuid4().hex
        staged = f"{self.path}/staged/{commit}"
        rows = df.hint("rebalance", *by)
        rows = rows.sortWithinPartitions(*by, *sort) if sort else rows
        writer = rows.write.option("compression", "snappy")
        (writer.partitionBy(*by) if by else writer).parquet(staged)
        found: dict[str, list[str]] = {}

        def leaves(folder: str, depth: int) -> list[str]:
            inner = [s.getPath().getName() for s in self.fs.listStatus(self.at(f"{staged}/{folder}")) if s.isDirectory()]
            return [x for n in inner for x in ([f"{folder}/{n}".lstrip("/")] if depth == 1 else leaves(f"{folder}/{n}".lstrip("/"), depth - 1))]

        for name in leaves("", len(by)) if by else [""]:
            place = f"{name}/{commit}".lstrip("/")
            target = self.at(f"{self.path}/data/{place}")
            self.fs.mkdirs(target.getParent())
            if not self.fs.rename(self.at(f"{staged}/{name}".rstrip("/")), target):
                raise OSError(f"cannot move {staged}/{name} to {target}")
            found[name] = [place]
        self.fs.delete(self.at(staged), True)
        return found

    def commit(self, df: DataFrame, by: list[str] | None = None, drop: list[str] | None = None, append: bool = False, sort: list[str] | None = None, facts: dict | Callable[[], dict] | None = None, base: int | None = None, narrow: bool = True) -> int:
        """Writes df's rows as a new version and returns its number.

        Partitions that df has rows for are replaced (append: added to), those named in `drop` become empty, all
        others stay; without partition columns the whole table is replaced. `base` is the version that df was made
        from; if another writer has gone beyond it meanwhile, CommitConflict is raised and nothing has changed.
        df may read the table itself, as old files stay. `facts` are kept in the manifest; a function is asked for
        them once the rows are written.
        """
        old = max(self.versions(), default=0)
        if base is not None and base != old:
            raise CommitConflict(f"{self.path} is at version {old}, not {base}")
        before = self.manifest(old) if old else Manifest(0, "", by or [], {})
        if old and by is not None and by != before.by:
            raise ValueError(f"{self.path} is partitioned by {before.by}")
        df = narrowed(df) if narrow and not before.schema else df
        schema = df.schema
        if before.schema:
            kept = T.StructType.fromJson(json.loads(before.schema))
            if set(kept.names) != set(schema.names):
                raise ValueError(f"columns {schema.names} are not those of {self.path}: {kept.names}")
            df = df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in kept.fields])
            schema = kept
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
        new = self._written(df, before.by, sort or [])
        parts = dict(before.parts) if before.by or append else {}
        for name in drop or []:
            parts[name] = []
        for name, folders in new.items():
            parts[name] = [*(parts.get(name, []) if append else []), *folders]
        self._publish(Manifest(old + 1, schema.json(), before.by, parts, facts() if callable(facts) else facts or {}))
        return old + 1

    def replace(self, df: DataFrame, values: list, base: int | None = None) -> int:
        """The partitions of these values of the one partition column get df's rows; those without rows are taken away."""
        m = self.manifest(base)
        version = self.commit(df, drop=[part_name({m.by[0]: v}) for v in values], base=m.version)
        return version

    def upsert(self, staged: DataFrame | list[DataFrame], keys: list[str], date_col: str = "date") -> int:
        """merge_upsert by year partitions; rows without a date lie in the partition of their own, and are found there.

        Only partitions that the staged rows touch are read and written. Of staged rows with one key the last
        counts, in the order of source (of several), file and row; keys that are null are equal to each other.
        """
        m = self.manifest()
        rows, order = staged_in_order(staged if isinstance(staged, list) else [staged])
        # rows of one key have one date where the date is a key, so that all years can be told before the last row is
        dated = rows if date_col in keys else last_staged(rows, keys, order)
        values = [r[0] for r in dated.select(F.year(date_col)).distinct().collect()]  # one for each year
        names = {part_name({m.by[0]: v}) for v in values}
        some = self.scan(m.version, names.__contains__)
        merged = merge_upsert(some.drop(m.by[0]), rows, keys, order).withColumn(m.by[0], F.year(date_col))
        return self.commit(merged.select(some.columns), base=m.version)

    def delete_window(self, date_col: str, start, end) -> int:
        """Takes away the rows of a window of dates, both ends of which belong to it; rows without a date stay."""
        m = self.manifest()
        first, last = (int(str(d)[:4]) for d in (start, end))
        names = [n for n in m.parts if n != f"{m.by[0]}={_NULL}" and first <= int(n.split("=")[1]) <= last]
        if not names:
            return m.version
        left = outside_window(self.scan(m.version, set(names).__contains__), date_col, start, end)
        return self.commit(left, drop=names, base=m.version)

    def changed_keys(self, keys: list[Column], before: int, after: int | None = None) -> DataFrame:
        """The distinct keys of rows that one of two versions has and the other lacks; only partitions whose folders differ are read."""
        a, b = self.manifest(before), self.manifest(after)
        names = {n for n in {*a.parts, *b.parts} if a.parts.get(n, []) != b.parts.get(n, [])}
        old, new = (self.scan(m.version, names.__contains__) for m in (a, b))
        columns = [c for c in new.columns if c in old.columns]
        count = lambda df, n: df.select(*columns, F.lit(n).alias("_n"))
        both = count(old, -1).unionByName(count(new, 1)).groupBy(*columns).agg(F.sum("_n").alias("_n")).where("_n <> 0")
        return both.select(*keys).distinct()

    def vacuum(self, keep: int = 1) -> int:
        """Deletes what none of the newest `keep` versions names, and returns how many folders. No writer or reader of older ones may be at work."""
        versions = self.versions()
        kept, gone = versions[-keep:], versions[:-keep]
        named = {f for v in kept for own in self.manifest(v).parts.values() for f in own}
        depth, n = len(self.manifest().by) + 1, 0
        for v in gone:
            self.fs.delete(self.at(self._log(v)), False)
        for status in self.fs.globStatus(self.at(f"{self.path}/data/" + "/".join(["*"] * depth))) or []:
            where = status.getPath()
            name = where.toString().split("/data/", 1)[1]
            if name not in named and status.isDirectory():
                self.fs.delete(where, True)
                n += 1
        self.fs.delete(self.at(f"{self.path}/staged"), True)
        return n


def create(df: DataFrame, path: str, by: list[str] | None = None, sort: list[str] | None = None, facts: dict | None = None, narrow: bool = True) -> SnapshotTable:
    """A new table with df's rows as its first version; doubles are kept as floats unless `narrow` is off."""
    table = SnapshotTable(df.sparkSession, path)
    if table.versions():
        raise ValueError(f"{path} has versions already")
    table.commit(df, by, sort=sort, facts=facts, narrow=narrow)
    return table
