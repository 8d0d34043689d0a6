"""Database reads and writes without a database.

The stand-in reader answers each read the way a database would: query texts and
predicates are run, by Spark, over tables of the test.
"""

from functools import reduce

import pytest
from pyspark.sql import DataFrame

from tableferry.operators.conform import conform
from tableferry.sinks.jdbc import _beside, delete_then_write_jdbc, save_jdbc
from tableferry.sinks.tables import merge_shards
from tableferry.sources.catalog import column_report
from tableferry.sources import jdbc
from tableferry.sources.jdbc import (
    JdbcLink,
    jdbc_bounds,
    list_jdbc_tables,
    read_jdbc_bounds,
    read_jdbc_depths,
    read_jdbc_ranges,
    read_jdbc_residues,
    read_jdbc_shards,
    target_types,
)

LINK = JdbcLink("jdbc:some:db", "reader", "hush", driver="some.Driver", options={"fetchsize": "500"})


class Reader:
    def __init__(self, spark, tables):
        self.spark, self.tables, self.calls = spark, tables, []

    @property
    def read(self):
        return self

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        self.calls.append(options)
        return self

    def load(self):
        options = self.calls[-1]
        if "query" in options:
            return self.spark.sql(options["query"])
        return self.tables[options["dbtable"]]

    def jdbc(self, url, table, predicates, properties):
        self.calls.append({"table": table, "predicates": predicates, **properties})
        return reduce(DataFrame.union, [self.tables[table].where(p) for p in predicates])


@pytest.fixture
def reader(spark):
    tables = {
        "people": spark.createDataFrame(
            [(None, "n", 1), (-3, "a", 2), (0, "b", 3), (5, "c", 4), (10, "d", 5)], "id bigint, name string, age int"
        ),
        "p_0": spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string"),
        "p_1": spark.createDataFrame([(7, "z")], "id int, v string"),
        "p_2": spark.createDataFrame([], "id int, v string"),
        "information_schema.tables": spark.createDataFrame(
            [("db", "p_0"), ("db", "P_1"), ("db", "other"), ("elsewhere", "p_9")], "TABLE_SCHEMA string, TABLE_NAME string"
        ),
        "information_schema.columns": spark.createDataFrame(
            [("db", "people", "id", "the key's name"), ("db", "people", "age", None), ("db", "p_0", "id", "no")],
            "TABLE_SCHEMA string, TABLE_NAME string, COLUMN_NAME string, COLUMN_COMMENT string",
        ),
        "system.columns": spark.createDataFrame(
            [("db", "t", "id", "UInt64"), ("db", "t", "n", "Nullable(Int8)"), ("db", "u", "id", "String")],
            "database string, table string, name string, type string",
        ),
    }
    for name, df in tables.items():
        if "." not in name:
            df.createOrReplaceTempView(name)
    return Reader(spark, tables)


def test_credentials_are_passed_and_not_shown():
    assert "hush" not in repr(LINK)
    assert LINK.properties() == {"user": "reader", "password": "hush", "driver": "some.Driver", "fetchsize": "500"}
    assert "driver" not in JdbcLink("u", "a", "b").properties()


def test_bounds_are_probed_once_under_where(reader):
    bounds = jdbc_bounds(reader, LINK, "people", "id", "id >= 0 or name = 'a'")
    assert (bounds.low, bounds.high) == (-3, 10) and len(reader.calls) == 1
    assert jdbc_bounds(reader, LINK, "people", "id", " ").low == -3
    assert jdbc_bounds(reader, LINK, "p_2", "id").empty


def test_bounded_read_sets_options_and_filters_nothing(reader, rows):
    out = read_jdbc_bounds(reader, LINK, "people", "id", 4, "name, id")
    assert out.columns == ["id", "name"] and out.count() == 5
    options = reader.calls[-1]
    assert (options["partitionColumn"], options["lowerBound"], options["upperBound"], options["numPartitions"]) == (
        "id", "-3", "10", "4",
    )
    assert read_jdbc_bounds(reader, LINK, "p_2", "id", 4).count() == 0
    assert "partitionColumn" not in reader.calls[-1]


def test_range_read(reader, rows):
    out = read_jdbc_ranges(reader, LINK, "people", "id", 4, "id as key, upper(name) as name", comments_from="db")
    assert sorted(r["name"] for r in out.collect()) == ["A", "B", "C", "D", "N"]
    assert len(reader.calls[1]["predicates"]) == 5
    some = read_jdbc_ranges(reader, LINK, "people", "id", 4, where="name = 'a' or name = 'b'")
    assert sorted(r["name"] for r in some.collect()) == ["a", "b"]
    assert read_jdbc_ranges(reader, LINK, "p_2", "id", 4).count() == 0


def test_range_read_attaches_comments(reader, rows):
    out = read_jdbc_ranges(reader, LINK, "people", "id", 2, comments_from="db")
    assert [r["comment"] for r in column_report(out).collect()] == ["the keys name", "", ""]


def test_residue_read(reader):
    out = read_jdbc_residues(reader, LINK, "people", "id", 4, "id, name", "name <> 'c' or age = 9")
    assert sorted(r["name"] for r in out.collect()) == ["a", "b", "d", "n"]
    assert len(reader.calls) == 1 and len(reader.calls[0]["predicates"]) == 4


def test_slices_can_be_divided_by_a_second_key(reader):
    ranges = read_jdbc_ranges(reader, LINK, "people", "id", 2, where="id > 0 or id is null", refine=("age", 3))
    assert len(reader.calls[-1]["predicates"]) == 9
    assert sorted(r["name"] for r in ranges.collect()) == ["c", "d", "n"]
    residues = read_jdbc_residues(reader, LINK, "people", "id", 2, refine=("age", 2))
    assert sorted(r["name"] for r in residues.collect()) == ["a", "b", "c", "d", "n"]


def test_slices_of_equal_depth(reader, rows):
    out = read_jdbc_depths(reader, LINK, "people", "id", 3, second="age", columns="id, name")
    assert sorted(r["name"] for r in out.collect()) == ["a", "b", "c", "d", "n"]
    assert len(reader.calls[-1]["predicates"]) >= 3
    some = read_jdbc_depths(reader, LINK, "people", "id", 2, where="name = 'a' or name = 'b'")
    assert sorted(r["name"] for r in some.collect()) == ["a", "b"]
    assert read_jdbc_depths(reader, LINK, "p_2", "id", 4).count() == 0


def test_tables_of_a_database(reader, rows):
    assert rows(list_jdbc_tables(reader, LINK, "db", "^p_")) == [("P_1",), ("p_0",)]


def test_types_of_a_target_table(reader, spark):
    target = target_types(reader, LINK, "db", "t")
    assert target == {"id": "UInt64", "n": "Nullable(Int8)"}
    assert tuple(conform(spark.range(1), target, ["id", "n"]).first()) == (0, None)


def test_shards_are_probed_in_one_query_and_merged(reader, spark, rows, new_table):
    shards = read_jdbc_shards(reader, LINK, ["p_0", "p_1", "p_2"], "id", 3, where="id > 1")
    assert len([c for c in reader.calls if "query" in c]) == 1
    table = new_table()
    merge_shards(shards, table, columns="id,v")
    assert rows(spark.table(table)) == [(2, "y", "p_0"), (7, "z", "p_1")]
    assert read_jdbc_shards(reader, LINK, [], "id", 3) == {}


def test_shards_by_residues_with_columns_and_a_second_key(reader, rows):
    plain = read_jdbc_shards(reader, LINK, ["p_0", "p_1"], "id", 3)
    fine = read_jdbc_shards(reader, LINK, ["p_0", "p_1"], "id", 3, columns="id", refine=("id", 2), by="residues")
    for name in plain:
        assert fine[name].columns == ["id"] and rows(fine[name]) == rows(plain[name].select("id"))
    with pytest.raises(TypeError, match="split key"):
        read_jdbc_shards(reader, LINK, ["p_0"], "v", 3)
    with pytest.raises(ValueError):
        read_jdbc_shards(reader, LINK, ["p_0"], "id", 3, by="luck")


def test_many_shards_are_probed_in_several_queries(reader, monkeypatch):
    monkeypatch.setattr(jdbc, "PROBES_PER_QUERY", 2)
    shards = read_jdbc_shards(reader, LINK, ["p_0", "p_1", "p_2"], "id", 2)
    assert len([c for c in reader.calls if "query" in c]) == 2
    assert [df.count() for df in shards.values()] == [2, 1, 0]


class Writes:
    """A DataFrame stand-in that notes how it is written."""

    columns = ["id", "desc"]

    def __init__(self, log, spark=None):
        self.log, self.note, self.sparkSession = log, {}, spark

    def repartition(self, n):
        self.note["partitions"] = n
        return self

    def limit(self, n):
        other = Writes(self.log)
        other.note["limit"] = n
        return other

    @property
    def write(self):
        return self

    def mode(self, mode):
        self.note["mode"] = mode
        return self

    def jdbc(self, url, table, properties):
        self.log.append(("write", table, dict(self.note), properties))


class Connection:
    def __init__(self, log, fail_on=None):
        self.log, self.fail_on = log, fail_on

    def setAutoCommit(self, on):
        self.log.append(("autocommit", on))

    def createStatement(self):
        return self

    def executeUpdate(self, sql):
        if self.fail_on and self.fail_on in sql:
            raise RuntimeError(sql)
        self.log.append(("sql", sql))

    def commit(self):
        self.log.append(("commit",))

    def rollback(self):
        self.log.append(("rollback",))

    def close(self):
        self.log.append(("close",))


def test_saving():
    log = []
    save_jdbc(Writes(log), LINK, "t")
    save_jdbc(Writes(log), LINK, "t", "overwrite", partitions=5, batch_rows=50)
    assert log[0][2] == {"mode": "append"} and log[1][2] == {"mode": "overwrite", "partitions": 5}
    assert log[0][3] == {
        **LINK.properties(), "batchsize": "200", "isolationLevel": "READ_COMMITTED", "truncate": "true",
    }
    assert log[1][3]["batchsize"] == "50"
    with pytest.raises(ValueError):
        save_jdbc(Writes(log), LINK, "t", "merge")


def test_delete_and_append_share_a_transaction(spark):
    log = []
    link = JdbcLink("jdbc:mysql://host/db", "writer", "hush")
    delete_then_write_jdbc(
        Writes(log, spark), link, "t", "DELETE FROM t WHERE id > 5", partitions=3, connect=lambda *_: Connection(log)
    )
    assert log[0][:2] == ("write", "t") and log[1][1].startswith("t_incoming_")
    incoming = log[1][1]
    assert log[0][2] == {"limit": 0, "mode": "append"} and log[1][2] == {"partitions": 3, "mode": "overwrite"}
    assert log[2:] == [
        ("autocommit", False),
        ("sql", "DELETE FROM t WHERE id > 5"),
        ("sql", "INSERT INTO t (`id`, `desc`) SELECT `id`, `desc` FROM " + incoming),
        ("commit",),
        ("autocommit", True),
        ("sql", "DROP TABLE " + incoming),
        ("close",),
    ]


def test_a_failed_takeover_is_rolled_back(spark):
    log = []
    with pytest.raises(RuntimeError, match='"desc"'):
        delete_then_write_jdbc(
            Writes(log, spark), LINK, "t", "DELETE FROM t", connect=lambda *_: Connection(log, "INSERT")
        )
    assert ("commit",) not in log and log[-1] == ("close",)
    assert log[-4] == ("rollback",) and log[-2][1].startswith("DROP TABLE t_incoming_")


def test_a_failed_drop_does_not_fail_the_job(spark):
    log = []
    with pytest.warns(UserWarning, match="could not be dropped"):
        delete_then_write_jdbc(Writes(log, spark), LINK, "t", "DELETE FROM t", connect=lambda *_: Connection(log, "DROP"))
    assert ("commit",) in log and log[-1] == ("close",)


def test_a_failed_staging_is_dropped_too(spark):
    class Failing(Writes):
        def jdbc(self, url, table, properties):
            super().jdbc(url, table, properties)
            raise RuntimeError("disk full")

        def limit(self, n):
            return Writes(self.log)

    log = []
    with pytest.raises(RuntimeError, match="disk full"):
        delete_then_write_jdbc(Failing(log, spark), LINK, "t", "DELETE FROM t", connect=lambda *_: Connection(log))
    assert log[-2][1].startswith("DROP TABLE t_incoming_") and not any(e == ("commit",) for e in log)


def test_staging_names_are_unique_and_inside_the_quotes():
    assert _beside("`my-t`", "_x") == "`my-t_x`" and _beside('s."a b"', "_x") == 's."a b_x"' and _beside("s.t", "_x") == "s.t_x"


def test_a_blank_delete_is_an_append():
    log = []
    delete_then_write_jdbc(Writes(log), LINK, "t", "  ", connect=lambda *_: pytest.fail("no connection needed"))
    assert [(e[1], e[2]["mode"]) for e in log] == [("t", "append")]
