import json
import os

import pytest
from pyspark.errors import PythonException

from tableferry.sinks.bulk import batch_plan, write_bulk
from tableferry.sinks.stores import publish_conformed, publish_keyed


def writer_to(folder, fail_on=(), code=210, times=1):
    """A writer that keeps what it is given, failing on some calls."""

    def open_writer():
        class StoreError(Exception):
            def __init__(self, code):
                super().__init__(f"store error {code}")
                self.code = code

        class Writer:
            def __init__(self):
                self.calls, self.failed = 0, {}
                self.path = os.path.join(folder, os.urandom(8).hex())
                self.log = open(self.path, "w")

            def write(self, table):
                position = self.calls
                if position in fail_on and self.failed.get(position, 0) < times:
                    self.failed[position] = self.failed.get(position, 0) + 1
                    raise StoreError(code)
                self.calls += 1
                self.log.write(json.dumps(table.to_pylist()) + "\n")

            def close(self):
                self.log.write('"closed"\n')
                self.log.close()

        return Writer()

    return open_writer


def logs(folder):
    out = []
    for name in os.listdir(folder):
        with open(os.path.join(folder, name)) as f:
            out.append([json.loads(line) for line in f])
    return out


@pytest.fixture
def folder(tmp_path):
    path = tmp_path / "store"
    path.mkdir()
    return str(path)


def test_batches_of_one_task(spark, folder):
    report = write_bulk(spark.range(25), writer_to(folder), bulk_size=10, partitions=1)
    assert tuple(report.first()) == (25, 3, 0, 0, 0)
    (log,) = logs(folder)
    assert [len(batch) for batch in log[:-1]] == [10, 10, 5] and log[-1] == "closed"
    assert sorted(r["id"] for batch in log[:-1] for r in batch) == list(range(25))


def test_no_empty_last_batch_and_no_connection_without_rows(spark, folder):
    assert tuple(write_bulk(spark.range(20).coalesce(1), writer_to(folder), bulk_size=10).first())[:2] == (20, 2)
    assert tuple(write_bulk(spark.range(0), writer_to(folder)).first()) == (0, 0, 0, 0, 0)
    assert len(logs(folder)) == 1


def test_batches_smaller_and_larger_than_arrow_batches(spark, folder):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        report = write_bulk(spark.range(50).coalesce(1), writer_to(folder), bulk_size=20)
        assert tuple(report.first())[:2] == (50, 3)
        report = write_bulk(spark.range(50).coalesce(1), writer_to(folder), bulk_size=3)
        assert tuple(report.first())[:2] == (50, 17)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(r["id"] for log in logs(folder) for b in log[:-1] for r in b) == sorted([*range(50)] * 2)


def test_a_listed_error_is_retried(spark, folder):
    report = write_bulk(
        spark.range(25).coalesce(1), writer_to(folder, fail_on=[1]), bulk_size=10, retry=1, retry_codes=[210]
    )
    assert tuple(report.first()) == (25, 3, 1, 0, 0)


def test_exhausted_retries_fail_or_are_counted(spark, folder):
    always = writer_to(folder, fail_on=[1], times=99)
    with pytest.raises(PythonException, match="store error 210"):
        write_bulk(spark.range(25).coalesce(1), always, bulk_size=10, retry=2, retry_codes=[210])
    once_then_out = writer_to(folder, fail_on=[1], times=2)
    report = write_bulk(
        spark.range(25).coalesce(1), once_then_out, bulk_size=10, retry=1, retry_codes=[210], on_exhausted="drop"
    )
    assert tuple(report.first()) == (15, 2, 1, 10, 1)


def test_other_errors_are_not_retried_even_when_dropping(spark, folder):
    with pytest.raises(PythonException, match="store error 62"):
        write_bulk(
            spark.range(5), writer_to(folder, fail_on=[0], code=62), retry=5, retry_codes=[210], on_exhausted="drop"
        )


def sent(folder):
    return sorted(tuple(r.values()) for log in logs(folder) for batch in log[:-1] for r in batch)


def test_key_value_entries_are_published(spark, folder):
    df = spark.createDataFrame([("k", "a"), ("k", "a"), ("k", "b")], "k string, v string")
    report = publish_keyed(df, writer_to(folder), "set", expire_ms=5)
    assert report.first()["n_rows"] == 2
    assert sent(folder) == [("k", "set", None, "a", 5), ("k", "set", None, "b", 5)]


def test_conformed_rows_are_published_with_retries(spark, folder):
    df = spark.range(3).selectExpr("id", "if(id = 1, null, id) as n").coalesce(1)
    report = publish_conformed(
        df, writer_to(folder, fail_on=[0]), {"id": "Int64", "n": "Int32"}, bulk_size=2, retry=3, retry_codes=[210]
    )
    assert tuple(report.first()) == (3, 2, 1, 0, 0)
    assert sent(folder) == [(0, 0), (1, 0), (2, 2)]


def test_wrong_arguments(spark, folder):
    for wrong in ({"bulk_size": 0}, {"retry": -1}, {"on_exhausted": "skip"}):
        with pytest.raises(ValueError):
            write_bulk(spark.range(1), writer_to(folder), **wrong)
    with pytest.raises(ValueError):
        batch_plan(spark.range(1), "id", 0)


def test_plan_agrees_with_batches_sent(spark, folder, rows):
    df = spark.range(25).selectExpr("id", "if(id < 20, 0, 1) as split_id")
    assert rows(batch_plan(df, "split_id", 10)) == [(0, 20, 2, 10), (1, 5, 1, 5)]
