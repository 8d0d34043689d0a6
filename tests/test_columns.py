import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tableferry.functions.text import register_functions, slice_text
from tableferry.operators.columns import list_items, normalize_types, prune_columns, select_list, substring_column
from tableferry.operators.sqlstep import sql_step
from tableferry.plans.job import Job, preview, show

ALL_TYPES = (
    "a byte, b short, c int, d bigint, e boolean, f float, g double, h string, i timestamp, j date, "
    "k decimal(20,0), l decimal(10,2), m array<int>, n map<string,int>, o struct<x:int>, p binary, "
    "q timestamp_ntz, r decimal(5,0)"
)


def test_every_type_becomes_bigint_double_or_string(spark):
    when = dt.datetime(2024, 1, 2, 3, 4, 5)
    full = (1, 2, 3, 4, True, 0.5, 2.5, "t", when, when.date(), Decimal(9), Decimal("1.25"), [1, 2], {"x": 1}, (1,),
            bytearray(b"ab"), when, Decimal(7))
    df = spark.createDataFrame([full, (None,) * len(full)], ALL_TYPES)
    out = normalize_types(df)
    assert {f.name: f.dataType.simpleString() for f in out.schema.fields} == dict(
        a="bigint", b="bigint", c="bigint", d="bigint", e="bigint", f="double", g="double", h="string", i="string",
        j="string", k="bigint", l="double", m="string", n="string", o="string", p="string", q="string", r="bigint",
    )
    first, nulls = sorted(out.collect(), key=lambda r: r["a"] is None)
    assert tuple(first) == (
        1, 2, 3, 4, 1, 0.5, 2.5, "t", "2024-01-02 03:04:05", "2024-01-02", 9, 1.25, "[1,2]", '{"x":1}', '{"x":1}',
        "ab", "2024-01-02 03:04:05", 7,
    )
    assert set(nulls) == {None}


def test_whole_decimals_beyond_64_bits(spark):
    df = spark.createDataFrame([(Decimal(2**64 - 1),), (Decimal(5),)], "x decimal(20,0)")
    with pytest.raises(PySparkException, match="does not fit in bigint"):
        normalize_types(df).collect()
    assert sorted(r["x"] or 0 for r in normalize_types(df, on_overflow="null").collect()) == [0, 5]
    with pytest.raises(ValueError):
        normalize_types(df, on_overflow="wrap")


def test_pruning_keeps_table_order_and_case(spark):
    df = spark.createDataFrame([(1, "d", "n")], "id int, desc string, Name string")
    assert prune_columns(df, "Name, id").columns == ["id", "Name"]
    assert prune_columns(df, ["name", "id", "none"]).columns == ["id"]


def test_select_lists(spark):
    df = spark.createDataFrame([(1, "d", "n", 2)], "id int, desc string, Name string, `my-col` int")
    out = select_list(df, "id as user_id, desc, concat(id, ',', Name) as c")
    assert out.columns == ["user_id", "desc", "c"] and tuple(out.first()) == (1, "d", "1,n")
    assert tuple(select_list(df, "my-col, desc, id").first()) == (2, "d", 1)
    assert tuple(select_list(df, ["my-col", "id AS x", "concat(Name, '{a}, b') AS y"]).first()) == (2, 1, "n{a}, b")
    mixed = select_list(df, "my-col, desc AS d,`my-col` as m , concat(Name, ',', nvl(desc, ',')) as c,array(1,2)[0] as e")
    assert mixed.columns == ["my-col", "d", "m", "c", "e"] and tuple(mixed.first()) == (2, "d", 2, "n,d", 1)
    assert select_list(df, "*, id + 1 as next").columns == [*df.columns, "next"]
    assert list_items(r"'it\'s, x' as a, 'b\\', c") == [r"'it\'s, x' as a", r"'b\\'", "c"]
    assert list_items("a, 'x, (y' as b, f(g(1, 2), 3)") == ["a", "'x, (y' as b", "f(g(1, 2), 3)"]


def test_substrings(spark):
    df = spark.createDataFrame([(None,), ("",), ("abc",), ("a\U0001f600bcd",)], "raw_message string")
    out = [r["__ROOT__"] for r in substring_column(df, 2, pos=1).collect()]
    assert out == [None, "", "bc", "\U0001f600b"]
    assert [r["x"] for r in df.select(slice_text(F.col("raw_message"), 2, 5).alias("x")).collect()] == [
        None, "", "c", "bcd",
    ]
    with pytest.raises(PySparkException, match="shorter"):
        substring_column(df, 2, pos=1, strict=True).collect()
    long = df.where("length(raw_message) > 3")
    assert substring_column(long, 2, target="raw_message", strict=True).first()[0] == "a\U0001f600"
    with pytest.raises(ValueError):
        substring_column(df, 2, pos=-1)


def test_sql_function_runs_without_python(spark):
    register_functions(spark)
    df = spark.createDataFrame([("abcdef",), (None,)], "s string")
    out = sql_step(df, "select my_sub(s, 2, 3) as x from texts", view="texts")
    assert [r["x"] for r in out.collect()] == ["cde", None]
    for plan in (out, substring_column(df, 2, source="s"), normalize_types(df)):
        assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(PySparkException):
        sql_step(spark, "select my_sub('abc', -1, 2)").collect()


def test_sql_step_repartitions_only_when_asked(spark):
    df = spark.range(10)
    assert sql_step(df, "select id from r10", view="r10", partitions=7).rdd.getNumPartitions() == 7
    plain = sql_step(df, "select id from r10", view="r10")
    assert "Exchange" not in plain._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["id"] for r in sql_step(df, "select id from r10", partitions=3).collect()) == list(range(10))


def test_preview(spark, capsys):
    df = spark.range(500).select((499 - F.col("id")).alias("id"))
    assert [r["id"] for r in preview(df, 3, "id").collect()] == [0, 1, 2]
    assert "TakeOrderedAndProject" in preview(df, 3, "id")._jdf.queryExecution().executedPlan().toString()
    assert preview(df).count() == 100
    with pytest.raises(ValueError):
        preview(df, 0)
    show(spark.createDataFrame([("x" * 50,)], "long_text string"), 5)
    assert "x" * 50 in capsys.readouterr().out


def test_job(spark):
    job = Job(
        source=lambda s: s.range(6).withColumnRenamed("id", "n"),
        view="numbers",
        steps=[lambda df: df.where("n > 1"), lambda df: sql_step(df, "select count(*) as c from kept", view="kept")],
    )
    assert job.run(spark).first()["c"] == 4
    assert spark.table("numbers").count() == 6
    sunk = []
    Job(lambda s: s.range(2), sink=lambda df: sunk.append(df.count())).run(spark)
    assert sunk == [2]
