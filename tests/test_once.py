"""Delivery once: killed and failing jobs, run again, leave each row in the store once."""

import glob
import os
import subprocess
import sys

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import ROOT
from tableferry.sinks.once import COUNTERS, BatchChanged, deliver_once, ledger_entries


def store(folder, dies=None):
    """A store that keeps each batch id once. ``dies(n, batch_id)`` may raise before the n-th write of a task, or after it."""
    os.makedirs(folder, exist_ok=True)

    def open_writer():
        class Writer:
            n = 0

            def write(self, table, batch_id):
                self.n += 1
                if dies:
                    dies(self.n, batch_id, "before")
                path = f"{folder}/{batch_id}.parquet"
                with open(f"{folder}/sent.log", "a") as log:
                    log.write(batch_id + "\n")
                if not os.path.exists(path):
                    pq.write_table(table, f"{path}.{os.getpid()}")
                    os.replace(f"{path}.{os.getpid()}", path)
                if dies:
                    dies(self.n, batch_id, "after")

            def close(self):
                pass

        return Writer()

    return open_writer


def stored(folder):
    return sorted((tuple(r.values()) for f in glob.glob(f"{folder}/*.parquet") for r in pq.read_table(f).to_pylist()), key=repr)


def sent(folder):
    with open(f"{folder}/sent.log") as log:
        return log.read().split()


@pytest.fixture
def rows(spark):
    return spark.range(1000).select("id", F.when(F.col("id") % 7 > 0, F.concat(F.lit("x"), F.col("id") % 50)).alias("x"), F.array("id").alias("a"))


def expected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def counts(df):
    return dict(zip(COUNTERS, df.select(*COUNTERS).first()))


def test_each_row_is_sent_once_and_a_second_run_sends_nothing(spark, rows, tmp_path):
    folder, ledger = str(tmp_path / "s"), str(tmp_path / "ledger")
    first = counts(deliver_once(rows, store(folder), ledger, "d", bulk_size=64, splits=3))
    assert first["n_rows"] == 1000 and first["n_skipped_rows"] == 0 and stored(folder) == expected(rows)
    assert ledger_entries(rows, ledger).count() == first["n_batches"] == len(sent(folder))
    # Other tasks, another order of rows: the same batches.
    again = counts(deliver_once(rows.repartition(7).orderBy(F.rand(1)), store(folder), ledger, "d", bulk_size=64, splits=3))
    assert again["n_rows"] == 0 and again["n_skipped_rows"] == 1000 and len(sent(folder)) == first["n_batches"]
    other = counts(deliver_once(rows, store(str(tmp_path / "o")), ledger, "other", bulk_size=64, splits=3))
    assert other["n_rows"] == 1000


@pytest.mark.parametrize("moment", ["before", "after"])
def test_a_job_that_fails_half_way_goes_on(spark, rows, tmp_path, moment):
    folder, ledger = str(tmp_path / "s"), str(tmp_path / "ledger")

    def dies(n, batch_id, now):
        if now == moment and glob.glob(f"{ledger}/part-*"):
            raise OSError("lost")

    with pytest.raises(Exception, match="lost"):
        deliver_once(rows, store(folder, dies), ledger, "d", bulk_size=10, splits=24)
    taken = ledger_entries(rows, ledger)
    assert 0 < taken.agg(F.sum("n_rows")).first()[0] < 1000
    before = {r.split for r in taken.collect()}
    done = counts(deliver_once(rows, store(folder), ledger, "d", bulk_size=10, splits=24))
    assert done["n_skipped_rows"] > 0 and done["n_rows"] + done["n_skipped_rows"] == 1000
    assert stored(folder) == expected(rows)
    # Splits that had ended were not sent again.
    log = sent(folder)
    assert all(log.count(b) == 1 for b in log if int(b.split("-")[3]) in before)


def test_a_killed_driver(tmp_path, spark, rows):
    script = f"""
import sys, os, glob
sys.path.insert(0, {ROOT!r}); sys.path.insert(0, {ROOT!r} + "/tests")
from tableferry.session import local_session
from tableferry.sinks.once import deliver_once
from test_once import store
from pyspark.sql import functions as F
spark = local_session(1, **{{"spark.sql.shuffle.partitions": "4"}})
rows = spark.range(1000).select("id", F.when(F.col("id") % 7 > 0, F.concat(F.lit("x"), F.col("id") % 50)).alias("x"), F.array("id").alias("a"))
def dies(n, batch_id, now):
    if glob.glob({str(tmp_path)!r} + "/ledger/part-*"):
        os.kill(int(open({str(tmp_path)!r} + "/pid").read()), 9)
open({str(tmp_path)!r} + "/pid", "w").write(str(spark._jvm.java.lang.ProcessHandle.current().pid()))
deliver_once(rows, store({str(tmp_path / "s")!r}, dies), {str(tmp_path / "ledger")!r}, "d", bulk_size=10, splits=24)
"""
    env = os.environ | {"PYTHONPATH": os.pathsep.join([ROOT, f"{ROOT}/tests"])}
    ended = subprocess.run([sys.executable, "-c", script], env=env, capture_output=True, timeout=200)
    assert ended.returncode != 0
    assert len(stored(str(tmp_path / "s"))) < 1000
    done = counts(deliver_once(rows, store(str(tmp_path / "s")), str(tmp_path / "ledger"), "d", bulk_size=10, splits=24))
    assert done["n_skipped_rows"] > 0 and stored(str(tmp_path / "s")) == expected(rows)


def test_changed_rows_are_an_error(spark, rows, tmp_path):
    folder, ledger = str(tmp_path / "s"), str(tmp_path / "ledger")
    deliver_once(rows, store(folder), ledger, "d", bulk_size=100, splits=2)
    for changed in (rows.where("id <> 5"), rows.withColumn("x", F.lit("y")), rows.limit(0)):
        with pytest.raises(Exception, match="BatchChanged"):
            deliver_once(changed, store(folder), ledger, "d", bulk_size=100, splits=2)


def test_a_task_that_runs_again_sends_the_same_batches(tmp_path):
    script = f"""
import sys
from tableferry.session import local_session
from tableferry.sinks.once import deliver_once
from test_once import counts, store
from pyspark import TaskContext
spark = local_session("4,3", **{{"spark.sql.shuffle.partitions": "4"}})
spark.sparkContext.setLogLevel("OFF")
def dies(n, batch_id, now):
    context = TaskContext.get()
    if context.attemptNumber() == 0 and n == 3 and now == "after":
        raise OSError("executor lost")
done = counts(deliver_once(spark.range(1000), store({str(tmp_path / "s")!r}, dies), {str(tmp_path / "ledger")!r}, "d", bulk_size=50, splits=4))
assert done["n_rows"] == 1000, done
"""
    env = os.environ | {"PYTHONPATH": os.pathsep.join([ROOT, f"{ROOT}/tests"])}
    ended = subprocess.run([sys.executable, "-c", script], env=env, capture_output=True, timeout=200, text=True)
    assert ended.returncode == 0, ended.stderr[-2000:]
    folder = str(tmp_path / "s")
    assert sorted(stored(folder)) == [(i,) for i in range(1000)] and len(sent(folder)) > len(set(sent(folder)))


def test_equal_rows_and_odd_tables(spark, tmp_path):
    same = spark.range(500).select(F.lit(1).alias("id"), F.lit(None).cast("string").alias("x"))
    folder, ledger = str(tmp_path / "s"), str(tmp_path / "ledger")
    assert counts(deliver_once(same, store(folder), ledger, "d", bulk_size=64, splits=3))["n_batches"] == 8
    assert stored(folder) == [(1, None)] * 500
    nothing = counts(deliver_once(same.limit(0), store(str(tmp_path / "n")), ledger, "n"))
    assert not any(nothing.values())
    clash = spark.range(10).selectExpr("id as hash", "id as row", "id as split", "id as number", "id as kind")
    deliver_once(clash, store(str(tmp_path / "c")), ledger, "c", bulk_size=3, splits=2)
    assert stored(str(tmp_path / "c")) == expected(clash)


def test_listed_codes_are_tried_again(spark, rows, tmp_path):
    folder, ledger = str(tmp_path / "s"), str(tmp_path / "ledger")

    def busy(n, batch_id, now):
        if n == 2 and now == "before":
            error = OSError("busy")
            error.code = 159
            raise error

    done = counts(deliver_once(rows, store(folder, busy), ledger, "d", bulk_size=400, splits=1, retry=1, retry_codes=[159]))
    assert done["n_retries"] == 1 and stored(folder) == expected(rows)


def tasks_of(spark, group, run):
    """What ``run`` gives, and the most tasks of a stage in its jobs."""
    spark.sparkContext.setJobGroup(group, group)
    done = run()
    status = spark.sparkContext.statusTracker()
    stages = [status.getStageInfo(s) for j in status.getJobIdsForGroup(group) for s in status.getJobInfo(j).stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return done, max(s.numTasks for s in stages if s)


def test_splits_follow_the_rows_and_stay_for_later_runs(spark, rows, tmp_path):
    folder, ledger = str(tmp_path / "s"), str(tmp_path / "ledger")
    first, tasks = tasks_of(spark, "first", lambda: counts(deliver_once(rows, store(folder), ledger, "d", bulk_size=10, splits=3, split_rows=50)))
    # 1000 rows of 50 to a split: 20 parts, as a multiple of the 3 that were asked for.
    assert tasks == 21 and first["n_rows"] == 1000 and stored(folder) == expected(rows)
    held = {r.split: r.n for r in ledger_entries(rows, ledger).groupBy("split").agg(F.sum("n_rows").alias("n")).collect()}
    assert set(held) <= set(range(21)) and sum(held.values()) == 1000 and max(held.values()) < 100
    again = counts(deliver_once(rows, store(folder), ledger, "d", bulk_size=10, splits=3))
    assert again["n_rows"] == 0 and again["n_skipped_rows"] == 1000 and len(sent(folder)) == first["n_batches"]
    # Fewer rows would make fewer splits: the number of the first run holds, so that the change is seen.
    with pytest.raises(Exception, match="BatchChanged"):
        deliver_once(rows.where("id < 700"), store(folder), ledger, "d", bulk_size=10, splits=3, split_rows=50)


def test_a_delivery_begun_without_a_note_keeps_its_splits(spark, rows, tmp_path):
    folder, ledger = str(tmp_path / "s"), str(tmp_path / "ledger")
    deliver_once(rows, store(folder), ledger, "d", bulk_size=10, splits=3)
    for note in glob.glob(f"{ledger}/_splits-*") + glob.glob(f"{ledger}/._splits-*"):
        os.remove(note)
    again = counts(deliver_once(rows, store(folder), ledger, "d", bulk_size=10, splits=3, split_rows=50))
    assert again["n_rows"] == 0 and again["n_skipped_rows"] == 1000


def test_each_split_has_a_task_of_its_own(spark, rows, tmp_path):
    def one_split(n, batch_id, now):
        from pyspark import TaskContext

        assert int(batch_id.split("-")[3]) == TaskContext.get().partitionId()

    counts(deliver_once(rows, store(str(tmp_path / "s"), one_split), str(tmp_path / "ledger"), "d", bulk_size=100, splits=8))
