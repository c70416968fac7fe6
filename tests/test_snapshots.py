"""Versions of tables: a change that is stopped anywhere leaves the old version or the new one."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from thermolake.operators import snapshots, tables

FACT = "location_id int, date date, pet float, pet_avg float"
ROWS = [(1, date(1998, 3, 1), 1.0, None), (1, date(1999, 1, 1), 2.0, 2.0), (2, None, 3.0, 3.0), (3, None, 4.0, None), (2, date(2000, 2, 29), 5.0, 5.0)]


class Stopped(Exception):
    pass


class Breaking:
    """A file system that breaks off at its nth change, or whose nth move fails."""

    def __init__(self, fs, nth, how):
        self._fs, self._left, self._how = fs, nth, how

    def __getattr__(self, name):
        call = getattr(self._fs, name)
        if name not in ("rename", "delete", "create", "mkdirs"):
            return call

        def counted(*args):
            if self._how == "stop" or name == "rename":
                if self._left == 0:
                    self._left = -1
                    if self._how == "stop":
                        raise Stopped
                    return False
                self._left -= 1
            return call(*args)

        return counted


def made(spark, path):
    return snapshots.create(tables.with_year(spark.createDataFrame(ROWS, FACT)), str(path), ["year"])


def content(table, version=None):
    return sorted(map(str, (tuple(r[c] for c in ("location_id", "date", "pet", "pet_avg", "year")) for r in table.scan(version).collect())))


CHANGES = {
    "replace": lambda t: t.replace(t.scan().where("year = 1999").withColumn("pet", F.col("pet") + 1), [1998, 1999]),
    "upsert": lambda t: t.upsert(t.spark.createDataFrame([(1, date(1999, 1, 1), 9.0), (3, None, 9.0), (4, None, 8.0), (4, date(2001, 1, 1), 7.0)], "location_id int, date date, pet float"), ["location_id", "date"]),
    "delete": lambda t: t.delete_window("date", "1998-01-01", "1999-12-31"),
    "whole": lambda t: t.commit(t.scan().where("pet > 3"), drop=list(t.manifest().parts)),
}


@pytest.mark.parametrize("change", CHANGES)
def test_a_change_that_breaks_off_anywhere(spark, tmp_path, change):
    goal = made(spark, tmp_path / "goal")
    CHANGES[change](goal)
    before, after = content(goal, 1), content(goal)
    assert before != after
    seen = set()
    for how in ("stop", "fail"):
        table = made(spark, tmp_path / how)
        for nth in range(40):
            broken = snapshots.SnapshotTable(spark, table.path)
            broken.fs = Breaking(broken.fs, nth, how)
            try:
                CHANGES[change](broken)
                failed = False
            except (Stopped, OSError, snapshots.CommitConflict):
                failed = True
            now = content(table)
            assert now == before or (now == after and table.versions()[-1] > 1)
            seen.add((failed, now == after))
            if now == after:
                break
        assert content(table, 1) == before
    assert (True, False) in seen


def test_rows_without_a_date_survive_an_upsert(spark, tmp_path):
    t = made(spark, tmp_path / "t")
    t.upsert(spark.createDataFrame([(9, None, 1.0), (1, date(1999, 1, 1), 7.0)], "location_id int, date date, pet float"), ["location_id", "date"])
    rows = {(r.location_id, r.date): (r.pet, r.pet_avg) for r in t.scan().collect()}
    assert rows == {(1, date(1998, 3, 1)): (1.0, None), (1, date(1999, 1, 1)): (7.0, 2.0), (2, None): (3.0, 3.0), (3, None): (4.0, None), (2, date(2000, 2, 29)): (5.0, 5.0), (9, None): (1.0, None)}


def test_plain_folders_keep_rows_without_a_date(spark, tmp_path):
    path = f"{tmp_path}/plain"
    tables.write_partitioned(tables.with_year(spark.createDataFrame([(1, date(1999, 1, 1), 1.0, 1.0), (2, None, 2.0, 2.0)], FACT)), path)
    tables.upsert_table(spark, path, spark.createDataFrame([(3, None, 3.0, None), (1, date(1999, 1, 1), 4.0, None), (2, None, 6.0, None)], FACT), ["location_id", "date"])
    assert sorted((r.location_id, str(r.date), r.pet) for r in spark.read.parquet(path).collect()) == [(1, "1999-01-01", 4.0), (2, "None", 6.0), (3, "None", 3.0)]


@pytest.mark.parametrize("nth", range(6))
def test_a_failed_move_of_a_plain_folder_is_taken_back(spark, tmp_path, monkeypatch, nth):
    path = f"{tmp_path}/plain"
    tables.write_partitioned(tables.with_year(spark.createDataFrame(ROWS, FACT)), path)
    before = sorted(map(str, spark.read.parquet(path).collect()))
    fs, at = tables.filesystem(spark, path)
    broken = Breaking(fs, nth, "fail")
    monkeypatch.setattr(tables, "filesystem", lambda *_: (broken, at))
    new = spark.read.parquet(path).where("year > 1998").withColumn("pet", F.lit(0.0))
    if nth < 5:  # three years aside, two into place
        with pytest.raises(OSError):
            tables.replace_partitions(new, path, "year", [1998, 1999, 2000])
        assert sorted(map(str, spark.read.parquet(path).collect())) == before
    else:
        tables.replace_partitions(new, path, "year", [1998, 1999, 2000])
        assert sorted(r.pet for r in spark.read.parquet(path).collect()) == [0.0, 0.0, 3.0, 4.0]


def test_two_writers_of_one_version(spark, tmp_path):
    t = made(spark, tmp_path / "t")
    base = t.manifest().version
    t.delete_window("date", "1998-01-01", "1998-12-31")
    with pytest.raises(snapshots.CommitConflict):
        t.commit(t.scan(base), base=base)
    other = snapshots.SnapshotTable(spark, str(tmp_path / "t"))
    other.versions = lambda: [1]  # a writer that looked before the deletion
    with pytest.raises(snapshots.CommitConflict):
        other.commit(t.scan(1).where("pet > 4"), base=1)
    assert t.versions() == [1, 2] and len(content(t)) == 4


def test_a_damaged_manifest_is_refused(spark, tmp_path):
    t = made(spark, tmp_path / "t")
    file = tmp_path / "t" / "manifests" / f"{1:012d}.json"
    file.write_text(file.read_text().replace("year=1998", "year=1997", 1))
    (tmp_path / "t" / "manifests" / f".{1:012d}.json.crc").unlink(missing_ok=True)
    with pytest.raises(ValueError, match="damaged"):
        t.scan()


def test_vacuum_keeps_what_kept_versions_name(spark, tmp_path):
    t = made(spark, tmp_path / "t")
    t.delete_window("date", "1998-01-01", "1998-12-31")
    t.upsert(spark.createDataFrame([(1, date(1999, 1, 1), 9.0)], "location_id int, date date, pet float"), ["location_id", "date"])
    before = [content(t, v) for v in (2, 3)]
    assert t.vacuum(keep=2) == 1 and t.versions() == [2, 3]
    assert [content(t, v) for v in (2, 3)] == before


def test_only_touched_partitions_are_written_and_compared(spark, tmp_path):
    t = made(spark, tmp_path / "t")
    t.upsert(spark.createDataFrame([(1, date(1999, 1, 1), 9.0), (1, date(1999, 1, 2), 9.0)], "location_id int, date date, pet float"), ["location_id", "date"])
    a, b = t.manifest(1).parts, t.manifest(2).parts
    assert {n for n in b if a.get(n) != b[n]} == {"year=1999"}
    keys = [F.col("location_id"), F.year("date").alias("y")]
    assert [tuple(r) for r in t.changed_keys(keys, 1).collect()] == [(1, 1999)]
    t.upsert(spark.createDataFrame([(1, date(1999, 1, 1), 9.0)], "location_id int, date date, pet float"), ["location_id", "date"])
    assert t.changed_keys(keys, 2).collect() == []


def test_odd_partition_values(spark, tmp_path):
    rows = [("a b", 1), ("x/y=z", 2), (None, 3), ("100%", 4), ("é:?", 5)]
    t = snapshots.create(spark.createDataFrame(rows, "k string, v int"), f"{tmp_path}/t", ["k"])
    assert sorted(map(str, (tuple(r) for r in t.scan().select("k", "v").collect()))) == sorted(map(str, rows))
    assert {r.k for r in t.done().collect()} == {k for k, _ in rows}
    t.replace(t.scan().limit(0), ["x/y=z", None])
    assert {r.k for r in t.scan().collect()} == {"a b", "100%", "é:?"}


def test_empty_tables_and_other_columns(spark, tmp_path):
    t = snapshots.create(spark.createDataFrame([], "id int, v double"), f"{tmp_path}/t")
    assert t.scan().collect() == [] and t.scan().schema["v"].dataType.simpleString() == "float"
    t.commit(spark.createDataFrame([(1, 2.0)], "id int, v double"), append=True)
    t.commit(spark.createDataFrame([(3.0, 2)], "v double, id int"), append=True)
    assert sorted(tuple(r) for r in t.scan().collect()) == [(1, 2.0), (2, 3.0)]
    with pytest.raises(ValueError, match="columns"):
        t.commit(spark.createDataFrame([(1,)], "other int"))
    with pytest.raises(FileNotFoundError):
        snapshots.SnapshotTable(spark, f"{tmp_path}/none").scan()
