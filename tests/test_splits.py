from collections import Counter
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tableferry.operators.splits import (
    KeyBounds,
    key_bounds,
    mod_predicates,
    range_predicates,
    read_bounds,
    refine_predicates,
    split_summary,
    with_mod_split,
    with_range_split,
)

MIXED = [(None, "n"), (-3, "a"), (0, "b"), (5, "c"), (10, "d")]


def keyed(spark, ids, dtype="bigint"):
    return spark.createDataFrame([(i, f"v{n}") for n, i in enumerate(ids)], f"id {dtype}, v string")


def slices(df, predicates):
    """How often each row is read, and the slice it is read in."""
    read = {}
    for i, predicate in enumerate(predicates):
        for row in df.where(predicate).collect():
            read.setdefault(row["v"], []).append(i)
    return read


def bounds_of(df, where=None):
    return read_bounds(key_bounds(df, "id", where))


@pytest.mark.parametrize(
    "ids, n",
    [
        ([None, -3, 0, 5, 10], 4),
        ([7], 4),
        ([0], 4),
        ([0, 0, 0], 3),
        (list(range(17)), 4),
        ([9007199254740992, 9007199254740993], 3),
        ([-(2**63), 0, 2**63 - 1], 5),
        ([None, None], 2),
        ([1, 2], 50),
        ([3, 8], 1),
    ],
)
def test_every_row_is_read_once_in_the_same_slice_by_both_forms(spark, ids, n):
    df = keyed(spark, ids)
    bounds = bounds_of(df)
    read = slices(df, range_predicates("id", bounds, n))
    assert {v: len(s) for v, s in read.items()} == {f"v{i}": 1 for i in range(len(ids))}
    column = {r["v"]: [r["split_id"]] for r in with_range_split(df, "id", n).collect()}
    assert column == read


@pytest.mark.parametrize("dtype", ["int", "bigint", "decimal(20,0)", "decimal(12,2)"])
def test_empty_input_keeps_its_schema(spark, dtype):
    df = keyed(spark, [], dtype)
    bounds = bounds_of(df)
    assert bounds.empty
    assert range_predicates("id", bounds, 4, "v = 'x'") == ["(v = 'x') AND (1 = 1)"]
    split = with_range_split(df, "id", 4)
    assert split.columns == ["id", "v", "split_id"] and split.count() == 0
    assert with_mod_split(df, "id", 4).count() == 0


def test_fractional_and_wide_decimal_keys(spark):
    df = keyed(spark, [Decimal("1.25"), Decimal("2.75"), None], "decimal(12,2)")
    bounds = bounds_of(df)
    assert bounds == KeyBounds(1, 3)
    read = slices(df, range_predicates("id", bounds, 2))
    assert read == {r["v"]: [r["split_id"]] for r in with_range_split(df, "id", 2).collect()}
    residues = slices(df, mod_predicates("floor(id)", 2))
    assert sorted(residues) == ["v0", "v1", "v2"]
    assert {r["v"]: r["split_id"] for r in with_mod_split(df, "id", 2).collect()} == {"v0": 1, "v1": 0, "v2": 0}

    wide = keyed(spark, [Decimal(0), Decimal(2**64 - 1)], "decimal(20,0)")
    read = slices(wide, range_predicates("id", bounds_of(wide), 3))
    assert read == {r["v"]: [r["split_id"]] for r in with_range_split(wide, "id", 3).collect()}


def test_residues_read_negative_and_null_keys_once(spark):
    df = spark.createDataFrame(MIXED, "id bigint, v string")
    read = slices(df, mod_predicates("id", 4))
    assert read == {"n": [0], "a": [1], "b": [0], "c": [1], "d": [2]}
    assert read == {r["v"]: [r["split_id"]] for r in with_mod_split(df, "id", 4).collect()}


def test_where_with_or_does_not_repeat_rows(spark):
    df = spark.createDataFrame(MIXED, "id bigint, v string")
    where = "v = 'a' or v = 'b'"
    for predicates in (range_predicates("id", bounds_of(df, where), 5, where), mod_predicates("id", 5, where)):
        assert {v: len(s) for v, s in slices(df, predicates).items()} == {"a": 1, "b": 1}
    assert with_range_split(df, "id", 5, where=where).count() == 2
    assert with_mod_split(df, "id", 5, where=F.col("v") == "a").count() == 1
    assert with_mod_split(df, "id", 5, where="  ").count() == 5


def test_bounds_apply_where_and_given_bounds_never_filter(spark):
    df = spark.createDataFrame(MIXED, "id bigint, v string")
    assert bounds_of(df, "id > 0") == KeyBounds(5, 10)
    split = with_range_split(df, "id", 4, bounds=KeyBounds(0, 4))
    assert {r["v"]: r["split_id"] for r in split.collect()} == {"n": 0, "a": 0, "b": 0, "c": 4, "d": 4}
    # Rows outside the probed bounds are still read by the open outer slices.
    assert all(len(s) == 1 for s in slices(df, range_predicates("id", KeyBounds(0, 4), 4)).values())


def test_keys_at_the_ends_of_bigint_under_narrow_bounds(spark):
    df = keyed(spark, [-(2**63), 2**63 - 1, 5])
    split = with_range_split(df, "id", 4, bounds=KeyBounds(0, 8))
    assert {r["v"]: r["split_id"] for r in split.collect()} == {"v0": 0, "v1": 4, "v2": 2}


def test_a_hot_key_is_divided_by_a_second_key(spark):
    df = spark.createDataFrame([(7, str(i), i) for i in range(30)] + [(1, "x", 5)], "id int, v string, other int")
    predicates = refine_predicates(range_predicates("id", KeyBounds(1, 7), 2), "other", 3)
    read = slices(df, predicates)
    assert all(len(s) == 1 for s in read.values()) and len(read) == 31
    assert max(Counter(s[0] for s in read.values()).values()) == 10


def test_wrong_arguments_are_refused(spark):
    with pytest.raises(TypeError):
        with_range_split(spark.createDataFrame([("a",)], "id string"), "id", 2)
    with pytest.raises(TypeError):
        read_bounds(key_bounds(spark.createDataFrame([(1.5,)], "id double"), "id"))
    with pytest.raises(ValueError):
        mod_predicates("id", 0)


def test_splitting_shuffles_nothing_and_reads_few_columns(spark, tmp_path):
    spark.range(100).selectExpr("id", "id as a", "id as b").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    split = with_range_split(df, "id", 4, where="a > 50").select("id", "split_id")
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "GreaterThan(a,50)" in plan
    assert ",b:" not in plan.split("ReadSchema: ")[1]
    summary = split_summary(with_range_split(df, "id", 4), "id")
    assert "partial_count" in summary._jdf.queryExecution().executedPlan().toString()


keys = st.lists(
    st.one_of(st.none(), st.integers(-20, 20), st.integers(-(2**63), 2**63 - 1)), min_size=0, max_size=12
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ids=keys, n=st.integers(1, 5), low=st.integers(-5, 5))
def test_splits_are_a_partition_of_the_filtered_rows(spark, ids, n, low):
    df = keyed(spark, ids)
    where = f"id is null or id >= {low} or v = 'v0'"
    wanted = Counter(r["v"] for r in df.where(where).collect())
    for predicates, column in (
        (range_predicates("id", bounds_of(df, where), n, where), with_range_split(df, "id", n, where=where)),
        (mod_predicates("id", n, where), with_mod_split(df, "id", n, where=where)),
    ):
        read = slices(df, predicates)
        assert Counter({v: len(s) for v, s in read.items()}) == wanted
        assert {r["v"]: [r["split_id"]] for r in column.collect()} == read
