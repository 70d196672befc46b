"""Schemas found from JSON texts."""

import itertools

import pytest
from pyspark.sql import types as T

from normwatch.sources import from_json_inferred, infer_schema, read_json_inferred
from normwatch.sources.inference import _as_type, merge_types


def texts(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string").repartition(3)


def found(spark, *rows):
    return infer_schema(texts(spark, rows)).simpleString()


def test_numbers_widen(spark):
    assert found(spark, '{"a":1}', '{"a":null}') == "struct<a:bigint>"
    assert found(spark, '{"a":1}', '{"a":2.5}') == "struct<a:double>"
    assert found(spark, '{"a":1}', '{"a":1e30}') == "struct<a:double>"
    assert found(spark, '{"a":123456789012345678901234567890}') == "struct<a:double>"
    assert found(spark, '{"a":9223372036854775807}') == "struct<a:bigint>"
    assert found(spark, '{"a":40.0,"b":"1.0"}', '{"a":1}') == "struct<a:double,b:string>"
    assert found(spark, '{"a":[40, 7.00]}') == "struct<a:array<double>>"
    assert found(spark, '{"a":true}', '{"a":false}') == "struct<a:boolean>"


def test_conflicts_and_nulls_are_text(spark):
    assert found(spark, '{"a":null}', '{"a":null, "b":[]}') == "struct<a:string,b:array<string>>"
    assert found(spark, '{"a":1}', '{"a":"x"}') == "struct<a:string>"
    assert found(spark, '{"a":{"x":1}}', '{"a":[1]}') == "struct<a:string>"
    assert found(spark, '{"a":{}}') == "struct<a:string>"
    assert found(spark, '{"a":[1,"x"]}') == "struct<a:array<string>>"


def test_records_and_arrays_of_records_merge(spark):
    rows = ['{"a":{"x":1}}', '[{"a":{"y":"t"}},{"b":[{"z":1.5}]}]', ' \n{"OBJECT<":1,"b":null, "w d":2}']
    want = "struct<OBJECT<:bigint,a:struct<x:bigint,y:string>,b:array<struct<z:double>>,w d:bigint>"
    for order in itertools.permutations(rows):
        assert found(spark, *order) == want


def test_texts_that_say_nothing(spark):
    assert found(spark, '{"a":1}', "no json", "5", '"text"', "[1,2]", "", None, "{") == "struct<a:bigint>"
    assert infer_schema(texts(spark, ["5"])) == T.StructType()
    assert infer_schema(texts(spark, ["5"]).where("false")) == T.StructType()


def test_records_read_with_the_schema_that_was_found(spark, tmp_path):
    rows = ['{"a":1,"c":{"x":"u"}}', '{"a":"x","b":[1,2]}', '[{"b":[3]},{"a":{"k":1}}]']
    read = from_json_inferred(texts(spark, rows))
    got = sorted(((r["a"], r["b"], r["c"] and r["c"]["x"]) for r in read.collect()), key=str)
    want = [("1", None, "u"), ("x", [1, 2], None), (None, [3], None), ('{"k":1}', None, None)]
    assert got == sorted(want, key=str)
    path = str(tmp_path / "lines")
    texts(spark, [*rows, "", " "]).write.text(path)
    assert sorted(map(str, read_json_inferred(spark, path).collect())) == sorted(map(str, read.collect()))


def test_merging_is_commutative_and_associative():
    kinds = [
        _as_type(t)
        for t in ("BIGINT", "DOUBLE", "STRING", "VOID", "VARIANT", "ARRAY<BIGINT>", "ARRAY<VOID>",
                  "OBJECT<a: BIGINT>", "OBJECT<a: STRING, b: VOID>", "OBJECT<>", None)
    ]
    for a, b in itertools.product(kinds, repeat=2):
        assert merge_types(a, b) == merge_types(b, a)
    for a, b, c in itertools.product(kinds, repeat=3):
        assert merge_types(merge_types(a, b), c) == merge_types(a, merge_types(b, c))


@pytest.mark.parametrize("name", ["observations", "systems"])
def test_known_schemas(spark, name):
    import samples

    rows = getattr(samples, name)(spark)
    kinds = {f.name: f.dataType.simpleString() for f in infer_schema(rows.selectExpr("to_json(struct(*)) as value"))}
    if name == "observations":
        assert kinds["result"].startswith("struct<_type:string")
        assert kinds["resultTime"] == "string"
    else:
        assert "array<struct<" in kinds["hasOperatingRange"]
