import pytest
from pyspark.errors import PySparkException

from tableferry.operators.keyed import keyed_entries, kv_hash, kv_set, kv_string

DUPS = [("k", "a", 1), ("k", "c", 3), ("k", "b", 3), ("k", None, 9), ("m", "x", None), ("n", None, 1)]


def test_the_last_value_wins_and_ties_fall_to_the_greater(spark, rows):
    df = spark.createDataFrame(DUPS, "k string, v string, at int")
    assert rows(kv_string(df, "at")) == [("k", "c"), ("m", "x")]


def test_keys_and_values_become_text(spark, rows):
    df = spark.createDataFrame([(1, 0.5)], "k int, v double")
    assert rows(kv_string(df)) == [("1", "0.5")]


def test_repeating_keys_need_an_order(spark):
    df = spark.createDataFrame(DUPS, "k string, v string, at int")
    for entries in (kv_string(df), kv_hash(df, fields=["v"])):
        with pytest.raises(PySparkException, match="order_by"):
            entries.collect()


def test_equal_rows_need_no_order(spark, rows):
    df = spark.createDataFrame([("k", "a"), ("k", "a"), ("k", None)], "k string, v string")
    assert rows(kv_string(df)) == [("k", "a")] and rows(kv_hash(df)) == [("k", "v", "a")]


def test_a_missing_key_fails(spark):
    df = spark.createDataFrame([(None, "v", 1)], "k string, v string, at int")
    for entries in (kv_string(df, "at"), kv_hash(df, "at"), kv_set(df)):
        with pytest.raises(PySparkException, match="no key"):
            entries.collect()


def test_hash_fields_merge_and_nulls_write_nothing(spark, rows):
    df = spark.createDataFrame(
        [("k", "a1", None, 1), ("k", None, "b2", 2), ("k", "a0", "b0", 0), ("e", None, None, 5)],
        "k string, a string, b string, at int",
    )
    assert rows(kv_hash(df, "at")) == [("k", "a", "a1"), ("k", "b", "b2")]
    assert ("k", "at", "2") in rows(kv_hash(df, "at", fields=["a", "at"]))
    with pytest.raises(ValueError):
        kv_hash(df.select("k", "at"), "at")


def test_set_members_collapse(spark, rows):
    df = spark.createDataFrame([("k", 1), ("k", 1), ("k", 2), ("j", 1), ("k", None)], "k string, v int")
    assert rows(kv_set(df)) == [("j", "1"), ("k", "1"), ("k", "2")]


def test_expiry(spark):
    df = spark.createDataFrame([("k", "v")], "k string, v string")
    assert kv_string(df, expire_ms=1500).first()["expire_ms"] == 1500
    for expire in (0, -1):
        entry = kv_set(df, expire_ms=expire)
        assert entry.first()["expire_ms"] is None and entry.schema["expire_ms"].dataType.simpleString() == "bigint"
    assert kv_set(df).columns == ["key", "member"]


@pytest.mark.parametrize("kind, field", [("string", None), ("hash", "v"), ("set", None)])
def test_common_entry_shape(spark, kind, field):
    df = spark.createDataFrame([("k", "x")], "k string, v string")
    entries = keyed_entries(df, kind, expire_ms=10)
    assert entries.columns == ["key", "kind", "field", "value", "expire_ms"]
    assert tuple(entries.first()) == ("k", kind, field, "x", 10)
    with pytest.raises(ValueError):
        keyed_entries(df, "list")


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("'hot' as k", "cast(id as string) as v", "id as at")
    for entries in (kv_string(df, "at"), kv_hash(df, "at"), kv_set(df)):
        plan = entries._jdf.queryExecution().executedPlan().toString()
        below = plan.split("Exchange")[1]
        assert plan.count("Exchange") == 1
        assert "partial_max(" in below or "HashAggregate(keys=" in below
        assert "Python" not in plan
    assert kv_string(df, "at").first()["value"] == "99"


def test_keys_with_the_same_text_are_one_key(spark, rows):
    df = spark.sql("select map('a', 1) k, 'x' v, 1 at union all select map('a', 1), 'y', 2")
    assert rows(kv_set(df.selectExpr("to_json(k) k", "v"))) == [('{"a":1}', "x"), ('{"a":1}', "y")]
    moments = spark.sql(
        "select timestamp_ntz '2024-01-01 00:00:00' k, 'x' v, 1 at union all select timestamp_ntz '2024-01-01', 'y', 2"
    )
    assert rows(kv_string(moments, "at")) == [("2024-01-01 00:00:00", "y")]


def test_nested_keys_and_values_become_json(spark, rows):
    df = spark.sql("select array(1, 2) k, named_struct('x', 1) v, map('a', 2) w")
    assert rows(kv_string(df)) == [("[1,2]", '{"x":1}')]
    assert rows(kv_hash(df)) == [("[1,2]", "v", '{"x":1}'), ("[1,2]", "w", '{"a":2}')]
    assert rows(kv_set(df)) == [("[1,2]", '{"x":1}')]
