"""Random loads and entries against plain Python models."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tableferry.operators.keyed import kv_hash, kv_set, kv_string
from tableferry.sinks.tables import delete_then_write, merge_shards, overwrite_partition

SLOW = dict(deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
ids = st.lists(st.integers(0, 5), max_size=4)
loads = st.lists(
    st.one_of(
        st.tuples(st.just("overwrite"), st.sampled_from("ab"), ids),
        st.tuples(st.just("merge"), st.dictionaries(st.sampled_from("abc"), ids, min_size=1), st.none()),
        st.tuples(st.just("delete"), st.integers(0, 5), st.dictionaries(st.sampled_from("abcd"), ids, max_size=2)),
    ),
    min_size=1,
    max_size=4,
)


@settings(max_examples=6, **SLOW)
@given(loads=loads)
def test_any_sequence_of_loads(spark, new_table, loads):
    table, model = new_table(), {}
    overwrite_partition(spark.createDataFrame([(0,)], "id bigint"), table, {"shard": "a"})
    model["a"] = [0]

    def frame(values):
        return spark.createDataFrame([(v,) for v in values], "id bigint")

    for kind, first, second in loads:
        if kind == "overwrite":
            overwrite_partition(frame(second), table, {"shard": first})
            model[first] = second
        elif kind == "merge":
            merge_shards({name: frame(values) for name, values in first.items()}, table)
            model.update(first)
        else:
            new = [(v, part) for part, values in second.items() for v in values]
            delete_then_write(spark.createDataFrame(new, "id bigint, shard string"), table, f"id = {first}")
            model = {part: [v for v in values if v != first] for part, values in model.items()}
            for v, part in new:
                model[part] = [*model.get(part, []), v]
        stored = sorted((r["shard"], r["id"]) for r in spark.table(table).collect())
        assert stored == sorted((part, v) for part, values in model.items() for v in values)


values = st.one_of(st.none(), st.text("xyz", max_size=2))
entries = st.lists(
    st.tuples(st.integers(0, 3), values, values, st.integers(0, 3), st.one_of(st.none(), st.integers(0, 2))), max_size=12
)


def last(rows, position):
    """Per key the value of the last row that has one; null order first, ties to the greater value."""
    best = {}
    for row in rows:
        if row[position] is not None:
            rank = (row[3], row[4] is not None, row[4] or 0, row[position])
            best[row[0]] = max(best.get(row[0], rank), rank)
    return {str(key): rank[-1] for key, rank in best.items()}


@settings(max_examples=12, **SLOW)
@given(entries=entries)
def test_any_entries(spark, entries):
    df = spark.createDataFrame(entries, "k int, a string, b string, at int, tie int")
    order = ["at", "tie"]
    wins = {i: last(entries, i) for i in (1, 2)}
    assert {tuple(r) for r in kv_string(df, order).collect()} == set(wins[1].items())
    assert {tuple(r) for r in kv_hash(df, order, fields=["a", "b"]).collect()} == {
        (key, field, value) for i, field in ((1, "a"), (2, "b")) for key, value in wins[i].items()
    }
    assert {tuple(r) for r in kv_set(df).collect()} == {(str(e[0]), e[1]) for e in entries if e[1] is not None}
