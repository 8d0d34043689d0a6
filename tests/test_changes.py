"""Publishing changes: after any number of loads, failed ones too, the store is what the last full load would make it."""

import glob
import os
import random

import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tableferry.operators.keyed import keyed_entries
from tableferry.sinks.changes import entry_changes, publish_changes, published_state


class Store:
    """Batches as files in order; replayed, they are what a key-value store would hold."""

    def __init__(self, folder):
        self.folder, self.log = str(folder), []
        self.held = {}

    def writer(self, fails_at=None):
        folder = f"{self.folder}/{len(self.log)}"
        os.makedirs(folder)
        self.log.append(folder)

        def open_writer():
            class Writer:
                n = 0

                def write(self, table):
                    self.n += 1
                    if fails_at is not None and self.n >= fails_at:
                        raise RuntimeError("the store is gone")
                    pq.write_table(table, f"{folder}/{os.urandom(8).hex()}.parquet")

                def close(self):
                    pass

            return Writer()

        return open_writer

    def replay(self):
        """Apply the last publication; the number of changes."""
        sent = [r for f in glob.glob(f"{self.log[-1]}/*.parquet") for r in pq.read_table(f).to_pylist()]
        random.shuffle(sent)  # order must not matter
        for r in sent:
            slot = (r["key"], r["field"], r["value"] if r["kind"] == "set" else None)
            if r["change"] == "set":
                self.held[slot] = r["value"]
            else:
                self.held.pop(slot, None)
        return len(sent)


def full(df, kind):
    rows = keyed_entries(df, kind).collect()
    return {(r.key, r.field, r.value if kind == "set" else None): r.value for r in rows}


@pytest.fixture
def store(tmp_path):
    return Store(tmp_path / "store")


def hashes(spark, *rows):
    return spark.createDataFrame(list(rows), "id bigint, name string, city string")


def counts(report):
    return tuple(report.select("n_set", "n_removed", "n_kept", "n_rows").first())


def test_only_changes_are_sent(spark, store, tmp_path):
    state = f"file:{tmp_path}/state"
    first = hashes(spark, (1, "a", "x"), (2, "b", None), (3, "c", "z"))
    assert counts(publish_changes(first, store.writer(), "hash", state)) == (5, 0, 0, 5)
    store.replay()
    assert store.held == full(first, "hash")
    # One value changes, one goes, one comes, a key goes.
    second = hashes(spark, (1, "a", "y"), (2, None, "w"))
    assert counts(publish_changes(second, store.writer(), "hash", state)) == (2, 3, 1, 5)
    assert store.replay() == 5 and store.held == full(second, "hash")
    assert counts(publish_changes(second, store.writer(), "hash", state)) == (0, 0, 3, 0)
    assert store.replay() == 0
    assert counts(publish_changes(second.limit(0), store.writer(), "hash", state)) == (0, 3, 0, 3)
    store.replay()
    assert store.held == {} and published_state(spark, state).count() == 0


@pytest.mark.parametrize("kind", ["string", "set"])
def test_strings_and_sets(spark, store, tmp_path, kind):
    state = f"file:{tmp_path}/state"
    for rows in ([("a", "1"), ("b", "")], [("a", "2"), ("b", ""), ("", "x")], [("b", None)]):
        df = spark.createDataFrame(rows, "k string, v string")
        publish_changes(df, store.writer(), kind, state)
        store.replay()
        assert store.held == full(df, kind)


def test_members_of_one_key_that_differ_in_little(spark, store, tmp_path):
    state = f"file:{tmp_path}/state"
    df = spark.range(3000).select(F.lit("hot").alias("k"), F.col("id").alias("m"))
    assert counts(publish_changes(df, store.writer(), "set", state)) == (3000, 0, 0, 3000)
    store.replay()
    later = df.where("m % 10 > 0").union(spark.createDataFrame([("hot", 5000)], "k string, m bigint"))
    assert counts(publish_changes(later, store.writer(), "set", state)) == (1, 300, 2700, 301)
    store.replay()
    assert store.held == full(later, "set")


def test_a_load_that_died_leaves_its_slots_open(spark, store, tmp_path):
    state = f"file:{tmp_path}/state"
    first = hashes(spark, (1, "a", "x"), (2, "b", "y"))
    publish_changes(first, store.writer(), "hash", state)
    store.replay()
    broken = hashes(spark, (1, "A", "x"), (3, "c", "z"), (4, "d", "v"))
    with pytest.raises(Exception, match="the store is gone"):
        publish_changes(broken, store.writer(fails_at=3), "hash", state, pipeline_rows=1, partitions=1)
    assert store.replay() == 2  # some of it came through
    # The next load knows neither which; slots that only the broken one had are removed.
    report = publish_changes(first, store.writer(), "hash", state)
    assert counts(report)[2] == 1  # (1, city) was never in doubt
    store.replay()
    assert store.held == full(first, "hash")


def test_a_load_that_died_before_it_sent_anything(spark, store, tmp_path, monkeypatch):
    from tableferry.sinks import changes

    state = f"file:{tmp_path}/state"
    first, second = hashes(spark, (1, "a", "x")), hashes(spark, (1, "b", "x"), (2, "c", None))
    publish_changes(first, store.writer(), "hash", state)
    store.replay()
    for step in ("publish", "write_bulk"):
        with monkeypatch.context() as patch:
            patch.setattr(changes, step, lambda *a, **b: (_ for _ in ()).throw(RuntimeError("died")))
            with pytest.raises(RuntimeError, match="died"):
                publish_changes(second, store.writer(), "hash", state)
    publish_changes(second, store.writer(), "hash", state)
    store.replay()
    assert store.held == full(second, "hash")


def test_dropped_batches_are_sent_again(spark, store, tmp_path):
    class Busy(RuntimeError):
        code = 7

    def busy():
        class Writer:
            def write(self, table):
                raise Busy()

            def close(self):
                pass

        return Writer()

    state, df = f"file:{tmp_path}/state", hashes(spark, (1, "a", "x"))
    publish_changes(df, busy, "hash", state, retry_codes=[7], retry=0, on_exhausted="drop")
    publish_changes(df, store.writer(), "hash", state)
    store.replay()
    assert store.held == full(df, "hash")


def test_entries_that_expire_are_renewed_when_half_their_time_is_over(spark, store, tmp_path):
    state, df = f"file:{tmp_path}/state", spark.createDataFrame([("a", "1"), ("b", "2")], "k string, v string")
    sent = [
        counts(publish_changes(df, store.writer(), "string", state, expire_ms=ms, now_ms=now))[0]
        for ms, now in ((1000, 0), (1000, 499), (1000, 500), (1000, 900), (2000, 901), (0, 902), (0, 10**9))
    ]
    assert sent == [2, 0, 2, 0, 2, 2, 0]


def test_clashing_names_and_empty_tables(spark, store, tmp_path):
    state = f"file:{tmp_path}/state"
    df = spark.createDataFrame([(1, "k", "f", "v", "d", 3, "c")], "key bigint, kind string, field string, value string, digest string, sent_ms int, change string")
    assert counts(publish_changes(df, store.writer(), "hash", state)) == (6, 0, 0, 6)
    store.replay()
    assert store.held == full(df, "hash")
    empty = f"file:{tmp_path}/empty"
    assert counts(publish_changes(df.limit(0), store.writer(), "hash", empty)) == (0, 0, 0, 0)


ENTRIES = st.dictionaries(st.tuples(st.sampled_from("abc"), st.sampled_from(["", "f", "g"])), st.sampled_from(["", "1", "2"]))


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=ENTRIES, new=ENTRIES)
def test_changes_lead_from_old_to_new(spark, old, new):
    def entries(held):
        rows = [(k, "hash", f, v, None) for (k, f), v in held.items()]
        return spark.createDataFrame(rows, "key string, kind string, field string, value string, expire_ms bigint")

    empty = spark.createDataFrame([], "key string, field string, member string, digest string, expire_ms bigint, sent_ms bigint")
    state = entry_changes(empty, entries(old), 0).drop("value", "change")
    held = dict(old)
    for r in entry_changes(state, entries(new), 1).collect():
        if r.change == "set":
            assert held.get((r.key, r.field)) != r.value
            held[r.key, r.field] = r.value
        elif r.change == "remove":
            del held[r.key, r.field]
    assert held == new
