"""The batch writer as a data source: all of a job shows, or nothing."""

import os
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from conftest import ROOT
from tableferry.sinks.datasource import batch_files, clear_batches, read_batches, write_batches


def failing(df, after):
    def rows(batches):
        from pyspark import TaskContext

        n = 0
        for batch in batches:
            yield batch
            n += batch.num_rows
        if TaskContext.get().partitionId() == 1 and n > after:
            raise RuntimeError("lost after its rows were written")

    return df.mapInArrow(rows, df.schema)


def content(spark, path, schema):
    return sorted(tuple(r) for r in read_batches(spark, path, schema).collect())


@pytest.fixture
def rows(spark):
    return spark.range(0, 1000, 1, 4).select("id", F.concat(F.lit("x"), "id").alias("x"))


def test_rows_come_in_bounded_batches(spark, rows, tmp_path):
    path = f"{tmp_path}/t"
    write_batches(rows, path, batch_rows=64)
    assert content(spark, path, rows.schema) == sorted(tuple(r) for r in rows.collect())
    sizes = [n for _, n in batch_files(path)]
    assert max(sizes) == 64 and sum(sizes) == 1000 and len(sizes) == 16


def test_jobs_add_up_and_replace(spark, rows, tmp_path):
    path = f"file:{tmp_path}/t"
    write_batches(rows, path)
    write_batches(rows.where("id < 10"), path)
    assert read_batches(spark, path, rows.schema).count() == 1010
    before = read_batches(spark, path, rows.schema)
    write_batches(rows.where("id < 3"), path, mode="overwrite")
    assert content(spark, path, rows.schema) == [(0, "x0"), (1, "x1"), (2, "x2")]
    assert before.count() == 1010
    write_batches(rows.limit(0), path, mode="overwrite")
    assert content(spark, path, rows.schema) == []


def test_a_failing_task_leaves_the_target_untouched(spark, rows, tmp_path):
    path = f"{tmp_path}/t"
    write_batches(rows.where("id < 5"), path)
    files = {os.path.join(d, f) for d, _, names in os.walk(path) for f in names}
    for mode in ("append", "overwrite"):
        with pytest.raises(Exception, match="lost after"):
            write_batches(failing(rows, 0), path, batch_rows=50, mode=mode)
        assert len(content(spark, path, rows.schema)) == 5
    # Tasks that were still running when the job was given up may have left files, which never show.
    for _ in range(20):
        clear_batches(path)
        if {os.path.join(d, f) for d, _, names in os.walk(path) for f in names} == files:
            break
        time.sleep(0.5)
    else:
        raise AssertionError("files are left")
    assert len(content(spark, path, rows.schema)) == 5


def test_tasks_that_run_again_show_once(tmp_path):
    script = f"""
import sys
from tableferry.session import local_session
from tableferry.sinks.datasource import read_batches, write_batches
spark = local_session("4,3")
spark.sparkContext.setLogLevel("OFF")
def rows(batches):
    from pyspark import TaskContext
    yield from batches
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("lost")
df = spark.range(0, 1000, 1, 8)
write_batches(df.mapInArrow(rows, df.schema), {str(tmp_path / "t")!r}, batch_rows=30)
assert sorted(r.id for r in read_batches(spark, {str(tmp_path / "t")!r}, df.schema).collect()) == list(range(1000))
"""
    env = os.environ | {"PYTHONPATH": ROOT}
    ended = subprocess.run([sys.executable, "-c", script], env=env, capture_output=True, timeout=200, text=True)
    assert ended.returncode == 0, ended.stderr[-2000:]


def test_options(spark, rows, tmp_path):
    with pytest.raises(Exception, match="batch_rows"):
        write_batches(rows, f"{tmp_path}/t", batch_rows=0)
    assert read_batches(spark, f"{tmp_path}/nothing", rows.schema).count() == 0
