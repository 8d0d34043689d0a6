"""Job graphs: order, errors, staging, and going on after a failure."""

import pytest
from pyspark.sql import functions as F

from tableferry.plans.graph import JobGraph, SinkFailed


def numbers(n):
    return lambda s: s.range(n)


def collected(out):
    return lambda df: out.append(sorted(tuple(r) for r in df.collect()))


def counted(spark, n, log):
    """A source that counts each row whenever it is computed."""
    seen = spark.sparkContext.accumulator(0)
    log.append(seen)

    def read(s):
        def rows(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        return s.range(n).mapInArrow(rows, "id bigint")

    return read


def test_names_link_sources_steps_and_sinks(spark):
    left, right = [], []
    graph = (
        JobGraph()
        .sink("small", "joined", collected(left))
        .sink("big", "sums", collected(right))
        .step("sums", "joined", "select sum(id) as total from joined")
        .step("joined", ["a", "b"], "select a.id from a join b on a.id = 2 * b.id")
        .source("a", numbers(10))
        .source("b", numbers(4))
    )
    assert graph.order().index("joined") > max(graph.order().index(n) for n in "ab")
    assert set(graph.run(spark)) == {"small", "big"}
    assert left == [[(0,), (2,), (4,), (6,)]] and right == [[(12,)]]


def test_each_source_is_computed_once(spark):
    log, out = [], []
    graph = (
        JobGraph()
        .source("a", counted(spark, 100, log))
        .source("b", counted(spark, 50, log))
        .step("joined", ["a", "b"], lambda a, b: a.join(b, "id"))
        .step("odd", "joined", "select * from joined where id % 2 = 1")
        .sink("rows", "joined", collected(out))
        .sink("again", "joined", collected(out))
        .sink("odd_rows", "odd", collected(out))
    )
    run = graph.start(spark)
    run.go()
    assert [seen.value for seen in log] == [100, 50] and [len(rows) for rows in out] == [50, 50, 25]
    plan = run.frame("odd")._jdf.queryExecution().toString()
    assert "joined-" in plan and "Range" not in plan


def test_a_source_that_may_be_read_again_is_not_copied(spark):
    log, out = [], []
    graph = JobGraph().source("a", counted(spark, 10, log), again=True)
    graph.sink("x", "a", collected(out)).sink("y", "a", collected(out)).run(spark)
    assert log[0].value == 20


def test_what_no_sink_needs_is_not_computed(spark):
    out = []
    graph = JobGraph().source("a", numbers(3)).step("broken", "a", "select no_such from a").sink("x", "a", collected(out))
    graph.run(spark)
    assert out == [[(0,), (1,), (2,)]] and "broken" not in graph.order()


@pytest.mark.parametrize(
    "build, said",
    [
        (lambda g: g.step("a", "b", "x").step("b", "c", "x").step("c", "a", "x").sink("s", "a", print), "a -> b -> c -> a"),
        (lambda g: g.sink("s", "nowhere", print), "needs nowhere"),
        (lambda g: g.source("a", numbers(1)).sink("s", "a", print).sink("t", "s", print), "cannot read the sink s"),
        (lambda g: g.source("a", numbers(1)).sink("s", "a", print, after="a"), "only come after sinks"),
        (lambda g: g.source("a", numbers(1)).sink("s", "a", print, after="t").sink("t", "a", print, after="s"), "s -> t -> s"),
        (lambda g: g.source("a", numbers(1)).source("a", numbers(1)), "there already"),
        (lambda g: g.source("a b", numbers(1)), "name of a view"),
    ],
)
def test_wrong_graphs(build, said):
    with pytest.raises(ValueError, match=said):
        build(JobGraph()).order()


@pytest.mark.parametrize("at_once", [1, 3])
def test_a_failed_run_goes_on_where_it_stopped(spark, at_once):
    log, out, broken = [], [], [True]

    def weak(df):
        if broken[0]:
            raise OSError("no connection")
        out.append(("weak", df.count()))

    graph = (
        JobGraph()
        .source("a", counted(spark, 20, log))
        .sink("strong", "a", lambda df: out.append(("strong", df.count())))
        .sink("weak", "a", weak)
        .sink("late", "a", lambda df: out.append(("late", df.count())), after=["weak", "strong"])
    )
    run = graph.start(spark)
    with pytest.raises(SinkFailed) as error:
        run.go(at_once)
    assert error.value.done == ["strong"] and set(error.value.failed) == {"weak"} and out == [("strong", 20)]
    broken[0] = False
    assert set(run.go(at_once)) == {"strong", "weak", "late"}
    # What was staged is read again, and what is done is not done again.
    assert out == [("strong", 20), ("weak", 20), ("late", 20)] and log[0].value == 20


def test_a_step_that_fails_stops_its_sinks_only(spark):
    out = []
    graph = JobGraph().source("a", numbers(3)).step("bad", "a", "select no_such from a")
    graph.sink("x", "bad", collected(out)).sink("y", "a", collected(out))
    with pytest.raises(SinkFailed) as error:
        graph.run(spark)
    assert error.value.done == ["y"] and len(out) == 1


def test_views_of_the_same_name_come_back(spark):
    spark.range(7).createOrReplaceTempView("a")
    out = []
    JobGraph().source("a", numbers(2)).step("b", "a", "select * from a").sink("x", "b", collected(out)).run(spark)
    assert out == [[(0,), (1,)]] and spark.table("a").count() == 7
    spark.catalog.dropTempView("a")


def test_empty_sources(spark):
    out = []
    graph = JobGraph().source("a", numbers(0)).step("n", "a", lambda df: df.agg(F.count("*").alias("n")))
    graph.sink("x", "a", collected(out)).sink("y", "n", collected(out)).run(spark)
    assert out == [[], [(0,)]]
