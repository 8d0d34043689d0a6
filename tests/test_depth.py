"""Slices of equal depth: every row once, none much deeper than the others."""

from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tableferry.operators.depth import DepthCuts, Slice, depth_cuts, depth_predicates, with_depth_split


def both(df, n, second=None, where=None):
    """Ids by slice, from predicates and from the column; they must agree."""
    cuts = depth_cuts(df, "k", n, second, where)
    texts = depth_predicates("k", cuts, second, where)
    assert len(texts) == cuts.count
    read = [sorted(r["id"] for r in df.where(t).collect()) for t in texts]
    split = with_depth_split(df, "k", n, second, cuts, where).select("id", "split_id").collect()
    assert sorted((r["id"], r["split_id"]) for r in split) == sorted((i, s) for s, ids in enumerate(read) for i in ids)
    return read


def test_a_third_on_one_key_and_a_third_on_null(spark):
    key = F.when(F.col("id") % 3 == 0, 77).when(F.col("id") % 3 == 1, F.col("id") * F.col("id")).cast("bigint")
    df = spark.range(6000).select("id", key.alias("k"), (F.col("id") - 50).alias("s")).repartition(3)
    read = both(df, 10, "s")
    assert sorted(i for ids in read for i in ids) == list(range(6000))
    assert max(map(len, read)) <= 2 * 600 and len(read) >= 10
    # Without a second key the heavy ones stay whole.
    assert sorted(map(len, both(df, 10)))[-2:] == [2000, 2000]


def test_steep_keys(spark):
    df = spark.range(8000).select("id", F.floor(F.exp(F.col("id") / 400.0)).alias("k"), F.col("id").alias("s"))
    read = both(df, 16, "s")
    assert sorted(i for ids in read for i in ids) == list(range(8000)) and max(map(len, read)) <= 1000
    wide = max(df.where(f"k >= {a} and k < {a + 186000000}").count() for a in (0, 186000000))
    assert wide > 4 * max(map(len, read))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-3, 3), st.integers(-(2**63), 2**63 - 2)), max_size=40), st.integers(1, 7), st.booleans())
def test_every_row_once(spark, keys, n, refined):
    df = spark.createDataFrame([(i, k, i % 5 if i % 4 else None) for i, k in enumerate(keys)], "id int, k bigint, s int")
    read = both(df, n, "s" if refined else None)
    assert sorted(i for ids in read for i in ids) == list(range(len(keys)))


def test_conditions_fractions_and_late_rows(spark):
    df = spark.createDataFrame([(i, Decimal(i) / 8 - 20, i) for i in range(400)], "id int, k decimal(20,3), s int")
    read = both(df, 6, "s", where="id < 100 or id >= 300")
    assert sorted(i for ids in read for i in ids) == [*range(100), *range(300, 400)]
    cuts = depth_cuts(df, "k", 4)
    late = spark.createDataFrame([(1, Decimal(-9999), 1), (2, None, 1), (3, Decimal(9999), 1)], df.schema)
    assert sorted(r["split_id"] for r in with_depth_split(late, "k", 4, cuts=cuts).collect()) == [0, 0, cuts.count - 1]


def test_empty_and_wrong(spark):
    assert depth_cuts(spark.createDataFrame([], "k bigint"), "k", 5) == DepthCuts((Slice(None, None),))
    assert depth_predicates("k", DepthCuts((Slice(None, None),))) == ["1 = 1"]
    nulls = spark.createDataFrame([(None, 1), (None, 2)], "k bigint, id int")
    assert sorted(i for ids in both(nulls, 3, "id") for i in ids) == [1, 2]
    with pytest.raises(TypeError):
        depth_cuts(spark.createDataFrame([("a",)], "k string"), "k", 2)
    with pytest.raises(ValueError):
        depth_cuts(nulls, "k", 0)


def test_no_rows_move(spark):
    df = spark.range(100).select("id", F.col("id").alias("k"))
    plan = with_depth_split(df, "k", 4)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "WholeStageCodegen" in plan or "*(1)" in plan
