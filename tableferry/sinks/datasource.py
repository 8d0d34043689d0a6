"""A batch writer as a Spark data source: ``df.write.format("tableferry_batches")``.

Each task writes its rows as files of at most ``batch_rows`` rows into a folder of the job's own, beside the
target's files, and answers with a message that names them. Only when all tasks have ended does the driver
write one index of the job's files; readers go by the indexes, so of a job that fails, or of a task that ran
twice, nothing shows. A failed job's folder is removed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from tableferry.sinks.bulk import BULK_ROWS

FORMAT = "tableferry_batches"
_JOBS, _INDEX = "jobs", "index"


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and place of a folder, named by a path or a URI."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = path.replace("file:", "file://", 1)
    return pafs.FileSystem.from_uri(path)


@dataclass
class TaskFiles(WriterCommitMessage):
    """What one task wrote: file names below the job's folder, and rows in each."""

    files: list[str]
    rows: list[int]


class BatchWriter(DataSourceArrowWriter):
    """Runs on the driver to begin, commit or abort a job, and in its tasks to write."""

    def __init__(self, path: str, batch_rows: int, overwrite: bool):
        self.path, self.batch_rows, self.overwrite = path, batch_rows, overwrite
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> TaskFiles:
        fs, root = _opened(self.path)
        folder, done = f"{root}/{_JOBS}/{self.job}", TaskFiles([], [])
        fs.create_dir(folder, recursive=True)
        waiting, n = [], 0

        def flush(table: pa.Table) -> None:
            # A name of its own for each attempt: one that is run again never meets the other's files.
            name = f"{uuid.uuid4().hex}.parquet"
            pq.write_table(table, f"{folder}/{name}", filesystem=fs)
            done.files.append(name)
            done.rows.append(table.num_rows)

        for batch in iterator:
            waiting.append(batch)
            n += batch.num_rows
            if n < self.batch_rows:
                continue
            table = pa.Table.from_batches(waiting)
            whole = n - n % self.batch_rows
            for at in range(0, whole, self.batch_rows):
                flush(table.slice(at, self.batch_rows))
            waiting, n = table.slice(whole).to_batches(), n - whole
        if n:
            flush(pa.Table.from_batches(waiting))
        return done

    def commit(self, messages: list[TaskFiles | None]) -> None:
        fs, root = _opened(self.path)
        fs.create_dir(f"{root}/{_INDEX}", recursive=True)
        jobs = sorted(_indexes(fs, root), key=lambda i: i["number"])
        said = [m for m in messages if m]
        index = {
            "job": self.job,
            "number": jobs[-1]["number"] + 1 if jobs else 1,
            "replaces": [i["job"] for i in jobs] if self.overwrite else [],
            "files": [f for m in said for f in m.files],
            "rows": [n for m in said for n in m.rows],
        }
        draft, final = f"{root}/{_INDEX}/.{self.job}", f"{root}/{_INDEX}/{self.job}.json"
        with fs.open_output_stream(draft) as out:
            out.write(json.dumps(index).encode())
        fs.move(draft, final)

    def abort(self, messages: list[TaskFiles | None]) -> None:
        fs, root = _opened(self.path)
        folder = f"{root}/{_JOBS}/{self.job}"
        if fs.get_file_info(folder).type == pafs.FileType.Directory:
            fs.delete_dir(folder)


def _indexes(fs: pafs.FileSystem, root: str) -> list[dict]:
    """Indexes of all jobs that ended, without those that a later one replaces."""
    chosen = pafs.FileSelector(f"{root}/{_INDEX}", allow_not_found=True)
    found = []
    for info in fs.get_file_info(chosen):
        if info.base_name.endswith(".json"):
            with fs.open_input_stream(info.path) as file:
                found.append(json.loads(file.read()))
    gone = {job for i in found for job in i["replaces"]}
    return [i for i in found if i["job"] not in gone]


class BatchSource(DataSource):
    """Options: the target folder as path, and ``batch_rows``. Modes append and overwrite."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> BatchWriter:
        path = self.options.get("path")
        rows = int(self.options.get("batch_rows", BULK_ROWS))
        if not path or rows < 1:
            raise ValueError("a path is needed, and batch_rows of at least 1")
        return BatchWriter(path, rows, overwrite)


def write_batches(df: DataFrame, path: str, batch_rows: int = BULK_ROWS, mode: str = "append") -> None:
    """Write rows in batches that show all at once, when every task has ended; none if one fails.

    ``mode`` is append or overwrite; what is overwritten is replaced by the same index, so readers see the
    old rows or the new. Empty tables add an empty job. Columns must have types that Arrow files hold.
    """
    df.sparkSession.dataSource.register(BatchSource)
    df.write.format(FORMAT).option("batch_rows", str(batch_rows)).mode(mode).save(path)


def batch_files(path: str) -> list[tuple[str, int]]:
    """Files that show, in the order of their jobs, with their rows."""
    fs, root = _opened(path)
    jobs = sorted(_indexes(fs, root), key=lambda i: (i["number"], i["job"]))
    return [(f"{path}/{_JOBS}/{i['job']}/{f}", n) for i in jobs for f, n in zip(i["files"], i["rows"])]


def clear_batches(path: str) -> None:
    """Remove files that no index names, of failed and replaced jobs. Not while a job is being written."""
    fs, root = _opened(path)
    shown = {i["job"]: set(i["files"]) for i in _indexes(fs, root)}
    for folder in fs.get_file_info(pafs.FileSelector(f"{root}/{_JOBS}", allow_not_found=True)):
        if folder.base_name not in shown:
            fs.delete_dir(folder.path)
            continue
        for file in fs.get_file_info(pafs.FileSelector(folder.path)):
            if file.base_name not in shown[folder.base_name]:
                fs.delete_file(file.path)


def read_batches(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All rows of jobs that ended; later jobs do not change what was read."""
    files = [name for name, _ in batch_files(path)]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
