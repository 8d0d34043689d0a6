"""Shards of different types, and documents of several shapes."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.sinks.tables import common_type, merge_shards, union_shards, widened_columns
from tableferry.sources.documents import parse_mixed, read_mixed_documents

BIG = 1 << 53


def test_common_types_are_the_least_that_hold_all():
    kinds = [T.IntegerType(), T.BooleanType(), T.DecimalType(9, 0)], [T.LongType(), T.FloatType()], [T.LongType(), T.DateType()]
    assert [common_type(k).simpleString() for k in kinds] == ["bigint", "double", "string"]
    assert common_type([T.DoubleType(), T.StringType(), T.LongType()]) == T.StringType()


def test_shards_of_other_types_are_refused_or_widened(spark, rows, new_table):
    shards = {
        "a": spark.createDataFrame([(1, BIG + 1, "x"), (2, None, None)], "k int, v bigint, s string"),
        "b": spark.createDataFrame([(3, 0.5, 7)], "k bigint, v double, s smallint"),
        "c": spark.createDataFrame([], "v decimal(5,0)"),
    }
    with pytest.raises(ValueError, match="column v is bigint but double in b"):
        union_shards(shards)
    merged = union_shards(shards, widen=True)
    assert dict(merged.dtypes) == {"k": "bigint", "v": "double", "s": "string", "shard": "string"}
    assert rows(merged) == [(1, float(BIG), "x", "a"), (2, None, None, "a"), (3, 0.5, "7", "b")]
    name = new_table()
    merge_shards(shards, name, widen=True)
    merge_shards(shards, name, widen=True)
    assert rows(spark.table(name)) == rows(merged)


@pytest.mark.parametrize("value", [0, 1, BIG, BIG + 1, BIG + 2, -BIG - 1, (1 << 62), (1 << 63) - 1, (1 << 63) - 1024, -(1 << 63), -(1 << 63) + 1])
def test_inexact_values_are_those_python_changes(spark, value):
    shards = {"a": spark.createDataFrame([(value,), (None,)], "v bigint"), "b": spark.createDataFrame([], "v double")}
    assert [tuple(r) for r in widened_columns(shards).collect()] == [("a", "v", "bigint", "double", 1, int(int(float(value)) != value))]


def test_report_of_empty_and_equal_shards(spark, rows):
    one, none = spark.createDataFrame([(1, "x")], "v int, `a.b` string"), spark.createDataFrame([], "v double, `a.b` int")
    assert rows(widened_columns({"a": one, "b": none})) == [("a", "v", "bigint", "double", 1, 0), ("b", "a.b", "bigint", "string", 0, 0)]
    assert rows(widened_columns({"a": one, "b": one})) == []
    with pytest.raises(ValueError):
        widened_columns({})


TEXTS = ['{"k": 1, "a": 2, "z": [1, "x"], "n": {"p": 1, "q": true}}', '{"k": "x", "n": {"p": "y"}}', "[1, 2]", '"t"', "null",
         '{"k": {"q": 1.5}, "a": null}', None, "{}", "7"]


def test_mixed_fields_are_variants_and_the_rest_is_typed(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, doc string")
    got = parse_mixed(df, "doc")
    kinds = {f.name: f.dataType.simpleString() for f in got.schema["doc"].dataType.fields}
    assert kinds == {"a": "bigint", "k": "variant", "n": "struct<p:variant,q:boolean>", "z": "array<variant>"}
    seen = {r.i: (r.d, r.rest) for r in got.select("i", F.to_json("doc").alias("d"), F.to_json("doc_rest").alias("rest")).collect()}
    for i, text in enumerate(TEXTS):
        want = None if text is None else json.loads(text)
        document, rest = seen[i]
        if isinstance(want, dict):
            assert rest is None
            assert json.loads(document) == {k: v for k, v in want.items() if v is not None}
        else:
            assert document is None and (rest is None if text is None else json.loads(rest) == want)


def test_text_that_is_no_json(spark, rows):
    df = spark.createDataFrame([('{"k": 1}',), ("{bad",), ("",)], "doc string")
    with pytest.raises(PySparkException):
        parse_mixed(df, "doc").collect()
    got = parse_mixed(df, "doc", "other", on_bad="null").select("doc.k", F.to_json("other").alias("o"))
    assert rows(got) == [(1, None), (None, None), (None, None)]
    with pytest.raises(ValueError):
        parse_mixed(df, "doc", "doc")


def test_no_objects_and_empty_tables(spark, tmp_path):
    for texts in ([], [("[1]",)], [(None,)]):
        got = parse_mixed(spark.createDataFrame(texts, "doc string"), "doc")
        assert got.schema["doc"].dataType == T.StructType() and got.count() == len(texts)
    lines = ['{"a": 1, "b c": "x"}', "", '{"a": [2]}', "3"]
    (tmp_path / "d.json").write_text("\n".join(lines))
    got = read_mixed_documents(spark, str(tmp_path))
    assert dict(got.dtypes) == {"a": "variant", "b c": "string", "_rest": "variant"} and got.count() == 3


def test_mixed_documents_need_no_python(spark, capsys):
    parse_mixed(spark.createDataFrame([('{"k": 1}',), ('{"k": "x"}',)], "doc string").repartition(2), "doc").explain()
    assert "Python" not in capsys.readouterr().out
