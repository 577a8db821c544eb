"""Schemas found in dict cells."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentimart.operators.projection import _declared, discover_schemas, flatten_discovered

CELLS = ["{'a': 1, 'b': {'c': 'x', 'd e': None}}", '{"a": 2.5, "b": {"c": "y", "q": {"r": true}}, "t": [1, 2]}', "{'VARIANT': 'v', 'OBJECT': 1}",
         "{'a': None, 'mixed': 1}", '{"mixed": "one", "x.y": 3, "big": 9007199254740993}', "{'none': None, 'empty': {}}", "nonsense", "[1, 2]", None, "{}"]


def cells(spark, values, parts=1):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, cell string").repartition(parts)


def test_types_are_merged(spark):
    found = discover_schemas(cells(spark, CELLS), ["cell"])["cell"]
    assert {f.name: f.dataType.simpleString() for f in found.fields} == {
        "OBJECT": "bigint", "VARIANT": "string", "a": "double", "b": "struct<c:string,d e:string,q:struct<r:boolean>>",
        "big": "bigint", "empty": "string", "mixed": "string", "none": "string", "t": "array<bigint>", "x.y": "bigint"}


@pytest.mark.parametrize("parts", [1, 4, 9])
def test_schema_and_rows_do_not_depend_on_partitions(spark, parts):
    out = flatten_discovered(cells(spark, CELLS * 3, parts), ["cell"])
    assert out.columns == ["id", "OBJECT", "VARIANT", "a", "b.c", "b.d e", "b.q.r", "big", "empty", "mixed", "none", "t", "x.y"]
    got = {r["id"]: r.asDict() for r in out.collect()}
    assert len(got) == 30
    assert [got[i]["a"] for i in range(4)] == [1.0, 2.5, None, None]
    assert (got[0]["b.c"], got[1]["b.q.r"], got[1]["t"], got[2]["VARIANT"], got[2]["OBJECT"]) == ("x", True, [1, 2], "v", 1)
    assert [got[i]["mixed"] for i in (3, 4)] == ["1", "one"] and got[4]["x.y"] == 3 and got[4]["big"] == 9007199254740993
    for i in (6, 7, 8, 9):
        assert all(v is None for k, v in got[i].items() if k != "id")


def test_columns_without_a_dict_disappear(spark):
    df = cells(spark, ["x", None]).withColumn("other", F.lit("{'k': 1}"))
    assert flatten_discovered(df, ["cell", "other"], keep_prefix=True).columns == ["id", "other.k"]
    assert flatten_discovered(df.limit(0), ["cell", "other"]).columns == ["id"]


@pytest.mark.parametrize("inferred,declared", [
    ("OBJECT<a: DECIMAL(21,1), b: VARIANT>", "STRUCT<a: DOUBLE, b: STRING>"),
    ("OBJECT<`VOID: x`: VOID, VOID: ARRAY<ARRAY<VARIANT>>>", "STRUCT<`VOID: x`: STRING, VOID: ARRAY<ARRAY<STRING>>>"),
    ("OBJECT<`a``b`: OBJECT<>>", "STRUCT<`a``b`: STRING>"), ("VOID", "STRING")])
def test_declared(inferred, declared):
    assert _declared(inferred) == declared
    T.StructType.fromDDL(f"s {declared}")
