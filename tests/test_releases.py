"""Releases: all of a load or nothing, whatever step it dies in."""

import threading

import pytest
from pyspark.sql import functions as F

from tableferry.sinks import releases
from tableferry.sinks.releases import ReleaseConflict, clear_releases, point_view, publish, read_release, release

STEPS = ("_written", "_put", "point_view")


@pytest.fixture
def place(tmp_path):
    return f"file:{tmp_path}/t"


@pytest.fixture
def view(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS released")
    yield "released.v"
    spark.sql("DROP DATABASE released CASCADE")


def rows(spark, *given):
    return spark.createDataFrame(list(given), "id bigint, x string, dt string")


def content(df):
    return sorted(tuple(r) for r in df.select("id", "x", "dt").collect())


def test_loads_replace_the_partitions_they_have_rows_for(spark, place):
    first = publish(rows(spark, (1, "a", "d1"), (2, "b", "d2"), (3, "c", "d 3/x=%")), place, ["dt"])
    assert sorted(map(tuple, first.collect())) == [(1, "dt=d 3/x=%", 1), (1, "dt=d1", 1), (1, "dt=d2", 1)]
    second = publish(rows(spark, (4, "d", "d2"), (5, "e", "d2"), (6, "f", None)), place, ["dt"], replace=[{"dt": "d1"}, {"dt": "d9"}])
    assert sorted(map(tuple, second.collect())) == [(2, "dt=None", 1), (2, "dt=d1", 0), (2, "dt=d2", 2), (2, "dt=d9", 0)]
    got = read_release(spark, place)
    assert sorted(map(tuple, got.collect()), key=repr) == [(3, "c", "d 3/x=%"), (4, "d", "d2"), (5, "e", "d2"), (6, "f", None)]
    # Earlier states stay readable.
    assert content(read_release(spark, place, 1)) == [(1, "a", "d1"), (2, "b", "d2"), (3, "c", "d 3/x=%")]
    assert read_release(spark, place, 0).count() == 0


def test_only_touched_partitions_are_written(spark, place):
    publish(rows(spark, *[(i, "a", f"d{i % 5}") for i in range(50)]), place, ["dt"])
    publish(rows(spark, (100, "z", "d0")), place, ["dt"], delete_where="id = 7")
    folders = {p.values: p.folder.split("/")[0] for p in release(spark, place).parts}
    first = {p.values: p.folder.split("/")[0] for p in release(spark, place, 1).parts}
    assert {v for v in folders if folders[v] != first[v]} == {("d0",), ("d2",)}
    assert content(read_release(spark, place)) == sorted([(i, "a", f"d{i % 5}") for i in range(50) if i != 7] + [(100, "z", "d0")])


def test_deleting_keeps_rows_for_which_the_condition_is_null(spark, place):
    publish(rows(spark, (1, None, "a"), (2, "x", "a"), (3, "x", "b")), place, ["dt"])
    report = publish(rows(spark, (4, "y", "c")), place, ["dt"], delete_where=F.col("x") == "x")
    assert sorted(map(tuple, report.collect())) == [(2, "dt=a", 1), (2, "dt=b", 0), (2, "dt=c", 1)]
    assert sorted(map(tuple, read_release(spark, place).collect()), key=repr) == [(1, None, "a"), (4, "y", "c")]


def test_tables_without_keys(spark, place, view):
    publish(spark.range(5), place, view=view)
    assert spark.table(view).count() == 5
    publish(spark.range(3), place, delete_where="id < 4", view=view)
    assert sorted(r.id for r in spark.table(view).collect()) == [0, 1, 2, 4]
    publish(spark.range(0), place, view=view)
    assert spark.table(view).count() == 0 and read_release(spark, place).count() == 0


def test_new_columns_and_changed_types(spark, place):
    publish(rows(spark, (1, "a", "d1")), place, ["dt"])
    publish(rows(spark, (2, "b", "d2")).withColumn("y", F.lit(1.5)), place, ["dt"])
    assert sorted(map(tuple, read_release(spark, place).select("id", "y").collect())) == [(1, None), (2, 1.5)]
    with pytest.raises(ValueError, match="column x is string"):
        publish(spark.createDataFrame([(1, 2.5, "d")], "id bigint, x double, dt string"), place, ["dt"])
    with pytest.raises(ValueError, match="partitioned by"):
        publish(rows(spark, (1, "a", "d1")), place, ["x"])
    with pytest.raises(ValueError, match="partition columns"):
        publish(spark.range(1), place, ["dt"])
    assert release(spark, place).number == 2


@pytest.mark.parametrize("when", ["before", "after"])
@pytest.mark.parametrize("step", STEPS)
def test_a_load_that_dies_shows_the_old_state_or_the_new(spark, place, view, monkeypatch, step, when):
    old = [(i, "a", f"d{i % 4}") for i in range(20)]
    publish(rows(spark, *old), place, ["dt"], load="first", view=view)
    new = [(i, "b", f"d{i % 3}") for i in range(100, 130)]
    after = sorted([r for r in old if r[2] == "d3"] + new)
    real = getattr(releases, step)

    def dies(*args, **more):
        if when == "after":
            real(*args, **more)
        raise OSError("the driver died")

    with monkeypatch.context() as patched:
        patched.setattr(releases, step, dies)
        with pytest.raises(OSError):
            publish(rows(spark, *new), place, ["dt"], load="second", view=view)
    switched = (step, when) in {("_put", "after"), ("point_view", "before"), ("point_view", "after")}
    assert content(read_release(spark, place)) == (after if switched else sorted(old))
    assert content(spark.table(view)) == (after if (step, when) == ("point_view", "after") else sorted(old))
    # The same load again ends the work; done once more it changes nothing.
    for _ in range(2):
        report = publish(rows(spark, *new), place, ["dt"], load="second", view=view)
        assert sorted(map(tuple, report.collect())) == [(2, "dt=d0", 10), (2, "dt=d1", 10), (2, "dt=d2", 10)]
        assert content(read_release(spark, place)) == content(spark.table(view)) == after
        assert release(spark, place).number == 2


def test_a_view_table_that_was_left_half_made_is_completed(spark, place, view, monkeypatch):
    monkeypatch.setattr(releases, "PARTITIONS_PER_STATEMENT", 2)
    publish(rows(spark, (1, "a", "d1")), place, ["dt"], view=view)
    real = spark.sql

    class Failing:
        def __getattr__(self, name):
            return getattr(spark, name)

        def sql(self, text):
            if "d4" in text and "ADD" in text:
                raise OSError("lost")
            return real(text)

    publish(rows(spark, *[(i, "b", f"d{i}") for i in range(6)]), place, ["dt"])
    with pytest.raises(OSError):
        point_view(Failing(), place, view)
    assert content(spark.table(view)) == [(1, "a", "d1")]
    point_view(spark, place, view)
    assert spark.table(view).count() == 6


def test_loads_of_other_partitions_meanwhile_are_kept(spark, place, monkeypatch):
    publish(rows(spark, (1, "a", "d1"), (2, "a", "d2")), place, ["dt"])
    real, other = releases._written, {}

    def written(*args):
        out = real(*args)
        if other:
            load = other.popitem()[1]
            publish(load, place, ["dt"])
        return out

    monkeypatch.setattr(releases, "_written", written)
    other["x"] = rows(spark, (3, "c", "d3"))
    publish(rows(spark, (4, "b", "d1")), place, ["dt"])
    assert content(read_release(spark, place)) == [(2, "a", "d2"), (3, "c", "d3"), (4, "b", "d1")]
    other["x"] = rows(spark, (5, "c", "d1"))
    with pytest.raises(ReleaseConflict):
        publish(rows(spark, (6, "d", "d1")), place, ["dt"])
    assert content(read_release(spark, place)) == [(2, "a", "d2"), (3, "c", "d3"), (5, "c", "d1")]


def test_many_loads_at_once(spark, place):
    errors = []

    def load(i):
        try:
            publish(rows(spark, (i, "x", f"d{i}")), place, ["dt"], attempts=50)
        except Exception as error:
            errors.append(error)

    threads = [threading.Thread(target=load, args=(i,)) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors and content(read_release(spark, place)) == [(i, "x", f"d{i}") for i in range(4)]
    assert [p.n_rows for p in release(spark, place).parts] == [1] * 4


def test_clearing_removes_what_no_kept_release_reads(spark, place, view):
    publish(rows(spark, (1, "a", "d1"), (2, "a", "d2")), place, ["dt"], load="one", view=view)
    publish(rows(spark, (3, "a", "d1")), place, ["dt"], load="two", view=view)
    publish(rows(spark, (4, "a", "d1")), place, ["dt"], load="three", view=view)
    gone = clear_releases(spark, place, keep=1, view=view)
    assert [g.split("-")[0] for g in gone] == ["two"]
    assert content(read_release(spark, place)) == content(spark.table(view)) == [(2, "a", "d2"), (4, "a", "d1")]
    with pytest.raises(ValueError, match="no release 1"):
        read_release(spark, place, 1)
