"""Trees of files with different columns and types."""

import pytest
from pyspark.sql import types as T

from thermolake.operators import schemas


def write(spark, root, parts):
    for name, (ddl, rows) in parts.items():
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{root}/part={name}")


def rows(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def test_columns_in_first_seen_order_and_widened_by_one_scan(spark, tmp_path):
    write(spark, tmp_path, {1: ("id int, b float", [(1, 0.5)]), 2: ("a string, id bigint", [("x", 1 << 40)]), 3: ("b double, id int, z date", [(0.25, None, None)])})
    df = schemas.scan_evolving(spark, str(tmp_path))
    assert df.schema.simpleString() == "struct<id:bigint,b:double,a:string,z:date,part:int>"
    assert rows(df) == sorted(map(str, [(1, 0.5, None, None, 1), (1 << 40, None, "x", None, 2), (None, 0.25, None, None, 3)]))
    plan = df.where("id > 5 and part = 2").select("a")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "GreaterThan(id,5)" in plan and "ReadSchema: struct<id:bigint,a:string>" in plan


def test_files_that_need_a_cast_are_scans_of_their_own(spark, tmp_path):
    write(spark, tmp_path, {1: ("v int, w decimal(5,2)", [(7, None)]), 2: ("v string", [("seven",)]), 3: ("v bigint, w decimal(9,1)", [(1 << 40, None)])})
    df = schemas.scan_evolving(spark, str(tmp_path))
    assert df.schema.simpleString() == "struct<v:string,w:decimal(10,2),part:int>"
    assert {r.v for r in df.collect()} == {"7", "seven", str(1 << 40)}
    write(spark, tmp_path / "more", {1: ("v bigint", [((1 << 53) + 2,)]), 2: ("v double", [(0.5,)])})
    assert {r.v for r in schemas.scan_evolving(spark, f"{tmp_path}/more").collect()} == {0.5, float((1 << 53) + 2)}


@pytest.mark.parametrize(("a", "b", "both"), [("int", "int", "int"), ("tinyint", "bigint", "bigint"), ("bigint", "float", "double"), ("float", "double", "double"), ("date", "timestamp", "timestamp"), ("date", "timestamp_ntz", "timestamp_ntz"), ("decimal(38,0)", "decimal(38,10)", "string"), ("boolean", "int", "string"), ("array<int>", "int", "string")])
def test_the_narrowest_type_of_two(a, b, both):
    kind = lambda x: T.StructType.fromDDL(f"x {x}")["x"].dataType
    assert schemas.wider(kind(a), kind(b)) == schemas.wider(kind(b), kind(a)) == kind(both)


def test_a_tree_without_files(spark, tmp_path):
    (tmp_path / "part=1").mkdir()
    with pytest.raises(FileNotFoundError):
        schemas.scan_evolving(spark, str(tmp_path))
