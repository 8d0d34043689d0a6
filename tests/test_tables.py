import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tableferry.session import setting
from tableferry.sinks.tables import (
    _any_partition,
    delete_then_write,
    ensure_table,
    merge_shards,
    overwrite_partition,
    partition_spec,
    save_files,
    union_shards,
)
from tableferry.sources.catalog import with_comments


def described(spark, table):
    return {c.name: (c.dataType, c.description or "", c.isPartition) for c in spark.catalog.listColumns(table)}


def one(report):
    return tuple(report.first())


def test_partition_values_are_text_and_counts_must_match():
    assert partition_spec("dt, hr", "2024-01-01,05") == {"dt": "2024-01-01", "hr": "05"}
    assert partition_spec("dt", "'2024-01-01'") == {"dt": "2024-01-01"}
    assert partition_spec(["dt"], ["x"]) == {"dt": "x"} and partition_spec({"n": 5}) == {"n": "5"}
    assert partition_spec(None) == {} and partition_spec("", "") == {}
    for values in ("2024-01-01", "a,b,c", "a,"):
        with pytest.raises(ValueError):
            partition_spec("dt,hr", values)
    with pytest.raises(ValueError, match="blank"):
        partition_spec({"dt": ""})


def test_created_tables_have_stored_types_comments_and_text_partitions(spark, new_table, tmp_path):
    table, location = new_table(), str(tmp_path / "t")
    df = spark.createDataFrame([(1, True, "x")], "`desc` int, flag boolean, `my col` string")
    df = with_comments(df, {"desc": "it's \\ a key"})
    ensure_table(spark, table, df.schema, ["dt"], location)
    ensure_table(spark, table, df.schema, ["dt"], location)
    assert described(spark, table) == {
        "desc": ("bigint", "its \\ a key", False),
        "flag": ("bigint", "", False),
        "my col": ("string", "", False),
        "dt": ("string", "", True),
    }
    overwrite_partition(df, table, {"dt": "05"})
    assert os.listdir(location + "/dt=05")
    assert tuple(spark.table(table).first()) == (1, 1, "x", "05")
    with pytest.raises(ValueError, match="also data columns"):
        ensure_table(spark, new_table(), df.schema, ["flag"])
    with pytest.raises(ValueError, match="partitioned by"):
        ensure_table(spark, table, df.schema, ["other"])


def test_blank_location_means_a_managed_table(spark, new_table):
    table = new_table()
    ensure_table(spark, table, spark.range(1).schema, location="  ")
    kind = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Type'").first()["data_type"]
    assert kind == "MANAGED"


def test_overwriting_a_partition_leaves_others_and_is_repeatable(spark, new_table, rows):
    table = new_table()
    first = spark.createDataFrame([(1, 0.5), (2, 1.5)], "id int, x double")
    spec = {"dt": "2024-01-01", "hr": "05"}
    assert one(overwrite_partition(first, table, spec)) == (table, "dt=2024-01-01/hr=05", 2)
    overwrite_partition(first.limit(1), table, {"dt": "2024-01-01", "hr": "06"})
    for _ in range(2):
        assert one(overwrite_partition(first, table, spec))[2] == 2
    assert rows(spark.table(table)) == [
        (1, 0.5, "2024-01-01", "05"), (1, 0.5, "2024-01-01", "06"), (2, 1.5, "2024-01-01", "05"),
    ]
    # No rows today: yesterday's are gone, and nothing else.
    assert one(overwrite_partition(first.where("id > 5"), table, spec))[2] == 0
    assert rows(spark.table(table)) == [(1, 0.5, "2024-01-01", "06")]
    assert spark.sql(f"SHOW PARTITIONS {table}").count() == 1


def test_emptied_partition_of_a_table_at_a_location_has_no_files(spark, new_table, tmp_path):
    table = new_table()
    overwrite_partition(spark.range(3), table, {"dt": "a"}, location=str(tmp_path / "t"))
    overwrite_partition(spark.range(0), table, {"dt": "a"})
    assert spark.table(table).count() == 0
    assert spark.read.schema("id bigint, dt string").parquet(str(tmp_path / "t")).count() == 0


def test_columns_named_like_table_properties(spark, new_table, rows, tmp_path):
    table, odd = new_table(), str(tmp_path / "a dir with spaces")
    df = spark.sql("select 'here' Location, 1 Type, 2 `# Partition Information`")
    overwrite_partition(df, table, {"dt": "a"}, location=odd)
    overwrite_partition(df, table, {"dt": "a"})
    assert rows(spark.table(table)) == [("here", 1, 2, "a")]
    assert os.listdir(odd + "/dt=a")


def test_columns_are_matched_by_name(spark, new_table, rows):
    table = new_table()
    df = spark.createDataFrame([(1, 0.5, "t")], "a int, b double, c string")
    overwrite_partition(df, table, {"dt": "x"})
    overwrite_partition(df, table, {"dt": "y"}, columns="c, b, a")
    overwrite_partition(df, table, {"dt": "z"}, columns="b * 2 as b, a, upper(c) as c")
    assert rows(spark.table(table)) == [(1, 0.5, "t", "x"), (1, 0.5, "t", "y"), (1, 1.0, "T", "z")]


def test_column_order_of_a_new_table_follows_the_list(spark, new_table):
    table = new_table()
    df = spark.createDataFrame([(1, 0.5)], "a int, b double")
    overwrite_partition(df, table, columns="b, a as key")
    assert spark.table(table).columns == ["b", "key"]


def test_whole_table_overwrite(spark, new_table, rows):
    table = new_table()
    overwrite_partition(spark.range(5), table)
    assert one(overwrite_partition(spark.range(2), table, {})) == (table, "", 2)
    assert rows(spark.table(table)) == [(0,), (1,)]
    overwrite_partition(spark.range(0), table)
    assert spark.table(table).count() == 0


def test_growing_schema(spark, new_table, rows):
    table = new_table()
    overwrite_partition(spark.sql("select 1 x"), table, {"dt": "a"})
    overwrite_partition(spark.sql("select 2 x, 'new' y"), table, {"dt": "b"})
    overwrite_partition(spark.sql("select 3L x"), table, {"dt": "c"})
    assert rows(spark.table(table)) == [(1, None, "a"), (2, "new", "b"), (3, None, "c")]
    with pytest.raises(ValueError, match="column x"):
        overwrite_partition(spark.sql("select 'text' x"), table, {"dt": "d"})


def test_a_failing_write_leaves_the_old_partition(spark, new_table, rows):
    table = new_table()
    overwrite_partition(spark.range(3), table, {"dt": "a"})
    bad = F.when(F.col("id") == 2, F.raise_error(F.lit("bad row"))).otherwise(F.col("id"))
    failing = spark.range(3).select(bad.alias("id"))
    with pytest.raises(PySparkException):
        overwrite_partition(failing, table, {"dt": "a"})
    assert rows(spark.table(table)) == [(0, "a"), (1, "a"), (2, "a")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


@pytest.mark.parametrize("layout", [None, "rebalance", 3])
def test_layouts_write_the_same_rows(spark, new_table, layout):
    table = new_table()
    overwrite_partition(spark.range(100), table, {"dt": "a"}, layout=layout)
    assert spark.table(table).agg(F.sum("id")).first()[0] == 4950


def shards_of(spark):
    return {
        "t_0": spark.sql("select 1 a, 'p' b"),
        "t_1": spark.sql("select 2L a, 'q' b, 1.5D c union all select 3, 'r', null"),
        "t_2": spark.sql("select 9 a, 'z' b where 1 = 0"),
    }


def test_merged_shards(spark, new_table, rows):
    table = new_table()
    shards = shards_of(spark)
    yesterday = {"t_2": spark.sql("select 7 a, 'old' b"), "t_9": spark.sql("select 8 a, 'kept' b, 0.5D c")}
    merge_shards(yesterday, table, columns="a,b,c")
    for _ in range(2):
        report = merge_shards(shards, table, columns="a, b, c")
        assert rows(report) == [(table, "shard=t_0", 1), (table, "shard=t_1", 2), (table, "shard=t_2", 0)]
        assert rows(spark.table(table)) == [
            (1, "p", None, "t_0"), (2, "q", 1.5, "t_1"), (3, "r", None, "t_1"), (8, "kept", 0.5, "t_9"),
        ]


def test_merged_shards_under_a_static_partition(spark, new_table, rows):
    table = new_table()
    shards = shards_of(spark)
    merge_shards(shards, table, columns="a", partition={"dt": "1"})
    merge_shards(shards, table, columns="a + 1 as a", partition={"dt": "2"})
    merge_shards({"t_1": shards["t_2"]}, table, columns="a", partition={"dt": "1"})
    assert rows(spark.table(table)) == [(1, "1", "t_0"), (2, "2", "t_0"), (3, "2", "t_1"), (4, "2", "t_1")]


def test_merging_is_one_write_without_a_shuffle(spark):
    union = union_shards(shards_of(spark))
    plan = union._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Union") == 1
    many = {f"s{i}": spark.range(1) for i in range(33)}
    assert union_shards(many).count() == 33
    with pytest.raises(ValueError, match="column a"):
        union_shards({"x": spark.sql("select 1 a"), "y": spark.sql("select 'b' a")})
    with pytest.raises(ValueError, match="no shards"):
        merge_shards({}, "t")


def test_save_modes(spark, tmp_path):
    path = str(tmp_path / "files")
    df = spark.range(5)
    save_files(df, path)
    for mode, expected in (("append", 10), ("ignore", 10), ("overwrite", 5)):
        save_files(df, path, mode)
        assert spark.read.parquet(path).count() == expected
    with pytest.raises(PySparkException):
        save_files(df, path, "error")
    with pytest.raises(ValueError):
        save_files(df, path, "upsert")


PREDICATES = "select * from values (1, true), (2, false), (3, cast(null as boolean)) as t(id, gone)"


def test_delete_then_write(spark, new_table, rows):
    table = new_table()
    delete_then_write(spark.sql(PREDICATES), table, "gone = 1")
    assert spark.table(table).count() == 3
    new = spark.sql("select 4 id, false gone")
    first = delete_then_write(new, table, "gone = 1").first()
    assert first["n_rows"] == 3 and first["replaced_location"]
    assert rows(spark.table(table)) == [(2, 0), (3, None), (4, 0)]
    # A failing load changes nothing.
    failing = spark.sql("select cast(raise_error('bad') as int) id, true gone")
    with pytest.raises(PySparkException):
        delete_then_write(failing, table, "id = 2")
    assert rows(spark.table(table)) == [(2, 0), (3, None), (4, 0)]
    # The same load again gives the same table.
    delete_then_write(new, table, "id = 4")
    assert rows(spark.table(table)) == [(2, 0), (3, None), (4, 0)]
    delete_then_write(new, table, "  ")
    assert spark.table(table).count() == 4


def test_delete_then_write_rewrites_only_partitions_concerned(spark, new_table, rows, tmp_path):
    table = new_table()
    for dt in "abc":
        overwrite_partition(spark.range(3), table, {"dt": dt}, location=str(tmp_path / "t"))
    before = set(spark.table(table).where("dt = 'c'").inputFiles())
    new = spark.sql("select 10L id, 'a' dt union all select 11L, 'd'")
    delete_then_write(new, table, "dt = 'b' or (dt = 'a' and id > 0)")
    assert rows(spark.table(table)) == [
        (0, "a"), (0, "c"), (1, "c"), (10, "a"), (11, "d"), (2, "c"),
    ]
    assert set(spark.table(table).where("dt = 'c'").inputFiles()) == before
    with pytest.raises(ValueError, match="partition columns"):
        delete_then_write(spark.range(1), table, "id = 0")
    assert "dt=b" not in [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]


def test_delete_then_write_reads_only_partitions_concerned(spark, new_table):
    table = new_table()
    for dt in "abc":
        overwrite_partition(spark.range(3), table, {"dt": dt})
    plan = spark.table(table).where(_any_partition(["dt"], [("a",), ("c",)]))._jdf.queryExecution()
    filters = plan.executedPlan().toString().split("PartitionFilters: [")[1]
    assert "dt" in filters.split("], PushedFilters")[0]


def test_rows_without_a_partition_value(spark, new_table, rows):
    table = new_table()
    overwrite_partition(spark.range(1), table, {"dt": "a"})
    delete_then_write(spark.sql("select 5L id, cast(null as string) dt"), table, "id = 9")
    assert rows(spark.table(table)) == [(0, "a"), (5, None)]
    delete_then_write(spark.sql("select 6L id, 'a' dt"), table, "dt is null")
    assert rows(spark.table(table)) == [(0, "a"), (6, "a")]


def test_partition_writes_do_not_sort(spark, new_table):
    table = new_table()
    ensure_table(spark, table, spark.range(1).schema, ["shard"])
    union_shards({"a": spark.range(2), "b": spark.range(3)}).createOrReplaceTempView("merged")
    sql = f"EXPLAIN INSERT OVERWRITE {table} PARTITION (shard) SELECT id, shard FROM merged"
    with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", "16"):
        assert "Sort [" not in spark.sql(sql).first()[0]
    assert "Sort [" in spark.sql(sql).first()[0]


def test_parallel_loads_in_one_session(spark, new_table):
    table = new_table()
    overwrite_partition(spark.range(1), table, {"dt": "kept"})
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda i: overwrite_partition(spark.range(i + 1), table, {"dt": str(i)}), range(6)))
    counts = {r["dt"]: r["count"] for r in spark.table(table).groupBy("dt").count().collect()}
    assert counts == {"kept": 1, **{str(i): i + 1 for i in range(6)}}
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_partition_values_with_special_characters(spark, new_table, rows):
    table = new_table()
    values = ["a/b", "x=1", "it's", "50%"]
    for value in values:
        overwrite_partition(spark.range(1), table, {"dt": value})
        overwrite_partition(spark.range(1, 2), table, {"dt": value})
    assert rows(spark.table(table)) == sorted([(1, v) for v in values], key=repr)
    overwrite_partition(spark.range(0), table, {"dt": "it's"})
    assert spark.table(table).count() == 3


def test_comments_reach_the_table_through_aliases(spark, new_table):
    table = new_table()
    df = with_comments(spark.sql("select 1 id, 'x' name"), {"id": "the key", "name": "its name"})
    overwrite_partition(df, table, {"dt": "a"}, columns="id as key, name, upper(name) as loud")
    assert {k: v[1] for k, v in described(spark, table).items()} == {
        "key": "the key", "name": "its name", "loud": "", "dt": "",
    }


def test_replaced_content_is_deleted_unless_kept(spark, new_table):
    table = new_table()
    overwrite_partition(spark.range(3), table)
    kept = delete_then_write(spark.range(5, 6), table, "id = 0", keep_replaced=True).first()["replaced_location"]
    assert spark.read.parquet(kept).count() == 3
    gone = delete_then_write(spark.range(6, 7), table, "id = 1").first()["replaced_location"]
    assert not os.path.exists(gone.removeprefix("file:"))
    assert sorted(r["id"] for r in spark.table(table).collect()) == [2, 5, 6]


def test_a_shard_column_in_the_data_is_refused(spark):
    with pytest.raises(ValueError, match="shard"):
        union_shards({"a": spark.sql("select 1 id, 'x' shard")})


def test_rebalancing_divides_a_large_shard_and_keeps_small_ones_whole(spark, new_table):
    table = new_table()
    hot = spark.range(0, 400_000, 1, 8).selectExpr("id", "uuid() as u")
    shards = {"hot": hot, **{f"s{i}": hot.where(f"id % 8 = {i} and id < 800") for i in range(3)}}
    with setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m"):
        report = merge_shards(shards, table, layout="rebalance")
    assert {r["partition"]: r["n_rows"] for r in report.collect()} == {
        "shard=hot": 400_000, "shard=s0": 100, "shard=s1": 100, "shard=s2": 100,
    }
    files = [f.split("shard=")[1].split("/")[0] for f in spark.table(table).inputFiles()]
    assert files.count("hot") > 3 and all(files.count(f"s{i}") == 1 for i in range(3))


@pytest.mark.parametrize("empty", ["select 1L id where 1 = 0", "select a.id from range(5) a join range(0) b using (id)"])
def test_loads_known_to_be_empty(spark, new_table, empty):
    table = new_table()
    for partition in (None, {"dt": "a"}):
        table = new_table()
        overwrite_partition(spark.range(3), table, partition)
        assert one(overwrite_partition(spark.sql(empty), table, partition))[2] == 0
        assert spark.table(table).count() == 0
    plain = new_table()
    assert delete_then_write(spark.sql(empty), plain, "id = 0").first()["n_rows"] == 0
    overwrite_partition(spark.range(3), plain)
    assert delete_then_write(spark.sql(empty), plain, "id = 0").first()["n_rows"] == 2
    merged = new_table()
    assert [r["n_rows"] for r in merge_shards({"x": spark.sql(empty)}, merged).collect()] == [0]


def test_tables_of_a_named_database(spark, rows):
    spark.sql("CREATE DATABASE IF NOT EXISTS other_db")
    try:
        overwrite_partition(spark.range(2), "other_db.loads", {"dt": "a"})
        merge_shards({"x": spark.range(1), "y": spark.range(0)}, "other_db.merged")
        delete_then_write(spark.sql("select 9L id, 'a' dt"), "other_db.loads", "id = 0")
        overwrite_partition(spark.range(2), "other_db.plain")
        delete_then_write(spark.range(7, 8), "other_db.plain", "id = 0")
        assert rows(spark.table("other_db.loads")) == [(1, "a"), (9, "a")]
        assert rows(spark.table("other_db.merged")) == [(0, "x")]
        assert rows(spark.table("other_db.plain")) == [(1,), (7,)]
        spark.sql("DROP TABLE other_db.plain")
        overwrite_partition(spark.range(1), "other_db.plain")
        assert spark.table("other_db.plain").count() == 1
    finally:
        spark.sql("DROP DATABASE other_db CASCADE")
