import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

from tableferry.functions.types import UnsupportedTargetType, target_type
from tableferry.operators.conform import conform, conform_report, target_schema
from tableferry.session import setting

NOW = dt.datetime(2024, 5, 6, 7, 8, 9)

TARGET = {
    "s": "String",
    "d": "Date",
    "t": "DateTime",
    "i": "Int8",
    "u": "UInt64",
    "f": "Float32",
    "m": "Decimal(10,2)",
    "a": "Array(Int32)",
    "nm": "Nullable(Decimal(10,2))",
    "ls": "LowCardinality(Nullable(String))",
    "lc": "LowCardinality(String)",
    "na": "Array(Nullable(Int32))",
}
DEFAULTS = ("", NOW.date(), NOW, 0, Decimal(0), 0.0, Decimal("0.00"), [], None, None, "", [])


def test_types_and_defaults(spark):
    full = ("x", "2020-01-02", "2020-01-02 03:04:05", 5, Decimal(2**63), 0.5, 1.25, [1, None], 2.5, "y", "z", [None, 3])
    schema = (
        "s string, d string, t string, i int, u decimal(20,0), f double, m double, a array<bigint>, "
        "nm double, ls string, lc string, na array<int>"
    )
    df = spark.createDataFrame([full, (None,) * len(full)], schema)
    out = conform(df, TARGET, now=NOW)
    assert [f.dataType.simpleString() for f in out.schema.fields] == [
        "string", "date", "timestamp", "tinyint", "decimal(20,0)", "float", "decimal(10,2)", "array<int>",
        "decimal(10,2)", "string", "string", "array<int>",
    ]
    filled, present = sorted(out.collect(), key=lambda r: r["i"])
    assert tuple(present) == (
        "x", dt.date(2020, 1, 2), dt.datetime(2020, 1, 2, 3, 4, 5), 5, Decimal(2**63), 0.5, Decimal("1.25"), [1, 0],
        Decimal("2.50"), "y", "z", [None, 3],
    )
    assert tuple(filled) == DEFAULTS


def test_missing_fields_take_their_default(spark):
    out = conform(spark.range(1), {"id": "Int64", **TARGET}, ["id", *TARGET], now=NOW)
    assert tuple(out.first()) == (0, *DEFAULTS)


def test_fields_choose_and_order_the_output(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    target = {"a": "Int32", "b": "Int32", "c": "Int32"}
    assert conform(df, target, ["c", "a"]).columns == ["c", "a"]
    assert conform(df, target).columns == ["a", "b", "c"]


def test_unknown_fields_and_types_are_refused(spark):
    with pytest.raises(ValueError, match="ghost: not in target"):
        conform(spark.range(1), {"id": "Int64"}, ["id", "ghost"])
    with pytest.raises(ValueError, match="id: type not supported"):
        conform(spark.range(1), {"id": "UUID"})
    for text in (
        "IntervalDay", "UUID", "Int", "Int128", "Array", "Nullable(UUID)", "Decimal", "Decimal(50,2)", "Array(Int32",
        "", "FixedString(3)",
    ):
        with pytest.raises(UnsupportedTargetType):
            target_type(text)


@pytest.mark.parametrize("kind, good, bad", [("UInt8", 255, 256), ("Int8", -128, 128), ("UInt16", 0, -1)])
def test_values_that_do_not_fit(spark, kind, good, bad):
    df = spark.createDataFrame([(good,), (bad,)], "x int")
    with pytest.raises(PySparkException):
        conform(df, {"x": kind}).collect()
    assert sorted(r["x"] for r in conform(df, {"x": kind}, strict=False).collect()) == sorted([good, 0])
    report = conform_report(df, {"x": kind}).first()
    assert (report["verdict"], report["n_filled"], report["n_unfit"]) == ("ok", 0, 1)


def test_unfit_values_are_errors_without_ansi_mode_too(spark):
    with setting(spark, "spark.sql.ansi.enabled", "false"):
        df = spark.createDataFrame([("300",), ("x",)], "x string")
        for kind in ("Int8", "Nullable(Int8)"):
            with pytest.raises(PySparkException, match="does not fit"):
                conform(df, {"x": kind}).collect()
        assert [r["x"] for r in conform(df, {"x": "Nullable(Int8)"}, strict=False).collect()] == [None, None]


def test_unfit_array_elements(spark):
    df = spark.createDataFrame([([1, 300, None],), ([2],), (None,)], "x array<int>")
    with pytest.raises(PySparkException, match="does not fit UInt8: 300"):
        conform(df, {"x": "Array(UInt8)"}).collect()
    assert [r["x"] for r in conform(df, {"x": "Array(UInt8)"}, strict=False).collect()] == [[1, 0, 0], [2], []]
    report = conform_report(df, {"x": "Array(Nullable(UInt8))"}).first()
    assert (report["n_filled"], report["n_unfit"]) == (1, 1)
    with pytest.raises(PySparkException, match="does not fit UInt8: 300"):
        conform(df.selectExpr("cast(x as array<smallint>) as x"), {"x": "Array(UInt8)"}).collect()
    nested = spark.createDataFrame([([["1"], None],)], "x array<array<string>>")
    assert conform(nested, {"x": "Array(Array(Int64))"}).first()["x"] == [[1], []]


def test_one_now_for_all_rows(spark):
    out = conform(spark.range(3), {"id": "Int64", "t": "DateTime", "d": "Date"}, ["id", "t", "d"])
    found = {(r["t"], r["d"]) for r in out.collect()} | {(r["t"], r["d"]) for r in out.collect()}
    ((moment, day),) = found
    assert abs(moment - dt.datetime.now()) < dt.timedelta(minutes=5) and day == moment.date()
    assert moment.microsecond == 0


def test_report(spark, rows):
    df = spark.createDataFrame([(1, "1"), (None, "x")], "a int, b string")
    target = {"a": "Int32", "b": "Nullable(Int32)", "c": "String", "d": "UUID"}
    assert rows(conform_report(df, target, ["a", "b", "c", "d", "e"])) == sorted(
        [
            ("a", "Int32", "ok", 1, 0, 0),
            ("b", "Nullable(Int32)", "ok", 0, 1, 0),
            ("c", "String", "filled with default", 2, 0, 0),
            ("d", "UUID", "type not supported", 0, 0, 0),
            ("e", None, "not in target", 0, 0, 0),
        ],
        key=repr,
    )
    assert conform_report(df.limit(0), target, ["a", "c"]).count() == 2


def test_target_described_by_rows(spark):
    description = spark.createDataFrame([("a", "Int32", "x"), ("b", "String", "y")], "name string, type string, z string")
    assert target_schema(description) == {"a": "Int32", "b": "String"}


def test_conforming_needs_no_python_and_no_shuffle(spark):
    plan = conform(spark.range(5), {"id": "UInt8", "x": "Array(String)"}, ["id", "x"])._jdf.queryExecution().executedPlan()
    assert "Python" not in plan.toString() and "Exchange" not in plan.toString()


@pytest.mark.parametrize("kind", ["Int8", "UInt8", "Int64", "UInt64", "Nullable(Int32)"])
@pytest.mark.parametrize("source", ["double", "decimal(20,2)", "float"])
def test_whole_number_types_do_not_cut_fractions(spark, kind, source):
    df = spark.sql(f"select cast(v as {source}) as v from values (1.5), (2.0), (null) as t(v)")
    target = {"v": kind}
    fill = None if kind.startswith("Nullable") else 0
    assert [int(r.v) if r.v is not None else None for r in conform(df, target, strict=False).collect()] == [fill, 2, fill]
    with pytest.raises(Exception, match="does not fit"):
        conform(df, target).collect()
    assert conform_report(df, target).first().n_unfit == 1


def test_fractions_in_arrays_and_rounded_decimals(spark):
    df = spark.sql("select array(1.0D, 2.5D) as a, 1.25D as d, cast(1.25 as decimal(5,2)) as e")
    report = {r.field: r for r in conform_report(df, {"a": "Array(Int32)", "d": "Decimal(5,1)", "e": "Decimal(5,2)"}).collect()}
    assert (report["a"].n_unfit, report["d"].n_rounded, report["e"].n_rounded, report["d"].n_unfit) == (1, 1, 0, 0)
