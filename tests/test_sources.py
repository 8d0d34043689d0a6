import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import types as T

from tableferry.session import scratch_dir, shared_dir
from tableferry.sources.catalog import column_report, list_tables, with_comments
from tableferry.sources.documents import (
    document_schema,
    inferred_schema,
    parse_documents,
    read_collection,
    read_documents,
    unreadable_documents,
    unreadable_texts,
)

PEOPLE = ['{"name": "Ann"}', '{"name": "Bo", "age": 30}', '{"name": "Cy", "age": 19}']


def test_tables_by_pattern(spark, rows):
    for name in ("zz_orders_1", "zz_orders_2", "zz_other"):
        spark.range(1).createOrReplaceTempView(name)
    assert rows(list_tables(spark, "ZZ_orders_[0-9]")) == [("zz_orders_1",), ("zz_orders_2",)]
    assert rows(list_tables(spark, "^other")) == []
    assert rows(list_tables(spark, "zz_other$", "default")) == [("zz_other",)]


def test_comments_follow_columns_and_leave_pushdown_alone(spark, rows, tmp_path):
    spark.range(5).selectExpr("id", "id as x", "id as unread").write.parquet(str(tmp_path / "t"))
    df = with_comments(spark.read.parquet(str(tmp_path / "t")), {"id": "the row's key", "gone": "?"})
    kept = df.where("x > 2").select("id", "x")
    assert rows(column_report(kept)) == [("id", "bigint", "the rows key", 2), ("x", "bigint", "", 2)]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(x,2)" in plan and "unread" not in plan


def test_document_files(spark, tmp_path, rows):
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "people.json").write_text("\n".join(PEOPLE))
    inferred = read_documents(spark, str(tmp_path / "docs"))
    assert inferred.schema.simpleString() == "struct<age:bigint,name:string>"
    declared = read_documents(spark, str(tmp_path / "docs"), '{"name": "string", "age": "int", "none": ["string"]}')
    assert rows(declared) == [("Ann", None, None), ("Bo", 30, None), ("Cy", 19, None)]


class Reader:
    def __init__(self):
        self.seen = {}

    @property
    def read(self):
        return self

    def format(self, name):
        self.seen["format"] = name
        return self

    def options(self, **options):
        self.seen.update(options)
        return self

    def schema(self, schema):
        self.seen["schema"] = schema.simpleString()
        return self

    def load(self):
        return self.seen


def test_collections_are_read_through_the_connector():
    plain = read_collection(Reader(), "mongodb://host", "db", "people", batchSize="10")
    assert plain == {
        "format": "mongodb", "connection.uri": "mongodb://host", "database": "db", "collection": "people",
        "batchSize": "10",
    }
    declared = read_collection(Reader(), "mongodb://host", "db", "people", '{"name": "string", "age": "int"}')
    assert declared["schema"] == "struct<name:string,age:int>"


def test_schema_descriptions():
    nested = document_schema('{"a": "string", "b": {"c": "double"}, "d": ["int"], "e": [{"f": "bigint"}]}')
    assert nested.simpleString() == "struct<a:string,b:struct<c:double>,d:array<int>,e:array<struct<f:bigint>>>"
    assert document_schema("a string, b int").simpleString() == "struct<a:string,b:int>"
    assert document_schema(nested) is nested
    assert document_schema(nested.json()) == nested
    assert document_schema({"type": "string"}) == T.StructType([T.StructField("type", T.StringType())])
    with pytest.raises(ValueError):
        document_schema({"a": ["int", "string"]})


def test_documents_in_a_column(spark, rows):
    df = spark.createDataFrame([(i, d) for i, d in enumerate([*PEOPLE, "not json", None])], "id int, doc string")
    out = parse_documents(df, "doc", "name string, age int", on_bad="null").select("id", "doc.name", "doc.age")
    assert rows(out) == [(0, "Ann", None), (1, "Bo", 30), (2, "Cy", 19), (3, None, None), (4, None, None)]
    assert rows(parse_documents(df, "doc", on_bad="null").select("id", "doc.age"))[1] == (1, 30)


BAD_LINES = ['{"k": 1}', '{"k":', '{"k": "x"}', "plain", '{"k": null}', '{"other": 2}']


def test_unreadable_documents_are_errors_or_counted_nulls(spark, rows, tmp_path):
    df = spark.createDataFrame([(t,) for t in [*BAD_LINES, None]], "doc string")
    assert rows(parse_documents(df, "doc", "k bigint", on_bad="null").selectExpr("doc.k", "doc is null")) == sorted(
        [(1, False), (None, True), (None, True), (None, True), (None, False), (None, False), (None, True)], key=repr
    )
    assert tuple(unreadable_texts(df, "doc", "k bigint").first()) == (6, 3)
    for text in BAD_LINES[1:4]:
        with pytest.raises(Exception, match="unreadable document"):
            parse_documents(df.where(df.doc == text), "doc", "k bigint").collect()
    (tmp_path / "a.json").write_text("\n".join(BAD_LINES))
    path = str(tmp_path / "a.json")
    assert rows(read_documents(spark, path, "k bigint", on_bad="null")) == sorted([(1,)] + [(None,)] * 5, key=repr)
    assert tuple(unreadable_documents(spark, path, "k bigint").first()) == (6, 3)
    with pytest.raises(Exception):
        read_documents(spark, path, "k bigint").collect()
    with pytest.raises(ValueError):
        read_documents(spark, path, on_bad="skip")


def test_inferred_document_schema(spark):
    docs = [
        {"VOID": 1, "a b": {"x": None, "OBJECT": [1, 2]}, "t": "OBJECT<VOID>"},
        {"VOID": 2.5, "list": [{"y": True}]},
    ]
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "doc string")
    schema = inferred_schema(df, "doc")
    assert schema["a b"].dataType.simpleString() == "struct<OBJECT:array<bigint>,x:string>"
    assert schema["list"].dataType.simpleString() == "array<struct<y:boolean>>"
    assert schema["VOID"].dataType.typeName() in ("decimal", "double")
    first = parse_documents(df, "doc").first()["doc"]
    assert first["a b"]["OBJECT"] == [1, 2] and first["t"] == "OBJECT<VOID>"
    with pytest.raises(ValueError):
        inferred_schema(spark.createDataFrame([("[1]",)], "doc string"), "doc")


def test_scratch_folder_is_the_shared_one(spark, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == shared
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second and first.startswith(shared) and not os.path.exists(first)


NO_SHARED_FOLDER = """
from tableferry.session import local_session, scratch_dir, shared_dir
spark = local_session(1)
assert spark.conf.get("spark.checkpoint.dir", None) is None
first = shared_dir(spark)
assert "tableferry-" in first and shared_dir(spark) == first
assert scratch_dir(spark, "x").startswith(first)
print("fine")
"""


def test_a_local_folder_is_used_only_without_a_setting(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": root}
    done = subprocess.run([sys.executable, "-c", NO_SHARED_FOLDER], env=env, capture_output=True, text=True, timeout=300)
    assert "fine" in done.stdout, done.stderr


def test_a_cluster_must_name_its_shared_folder():
    class Cluster:
        class conf:
            get = staticmethod(lambda name, default: default)

        class sparkContext:
            master = "yarn"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Cluster)
