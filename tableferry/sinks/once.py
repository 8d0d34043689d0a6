"""Batches that a store takes once, however often a job is killed and run again.

Rows are dealt out by a hash of their content and sorted, so that the same rows make the same
batches in every run. A batch is known by its split, its number there and a digest of its rows. What the
store took is written to a ledger as each task ends. A new run reads the ledger beside the
rows, in the same sorted stream, and leaves out what is in it.

Between a batch and its entry a task may die. The batch is then sent again under the same id,
so the store must ignore an id that it has, as stores with insert tokens do.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tableferry.operators.columns import quoted
from tableferry.session import filesystem
from tableferry.sinks.bulk import BULK_ROWS

#: Rows of a split; a split is one task's work, in batches. More rows than this times the splits make more splits.
SPLIT_ROWS = 1_000_000
LEDGER = "plan string, split int, number bigint, digest string, n_rows bigint"
COUNTERS = ("n_rows", "n_batches", "n_retries", "n_skipped_rows", "n_skipped_batches")


class BatchChanged(RuntimeError):
    """A batch that the store has taken now has other rows: the source has changed between two runs."""


def ledger_entries(df: DataFrame, ledger: str) -> DataFrame:
    """Batches that are recorded as taken, each once; none if there is no ledger yet."""
    spark = df.sparkSession
    fs, path = filesystem(spark, ledger)
    if not fs.exists(path):
        return spark.createDataFrame([], LEDGER)
    # A task that ran twice recorded its batches twice.
    return spark.read.schema(LEDGER).parquet(ledger).distinct()


def _settled_splits(df: DataFrame, ledger: str, delivery: str, splits: int | None, split_rows: int) -> int:
    """How many splits the delivery has in all its runs: ``splits``, or so many times more that each has about ``split_rows``.

    The first run counts the rows and writes the number beside the ledger, before anything is sent. A
    delivery that was begun without such a note keeps the number it was begun with.
    """
    spark = df.sparkSession
    fs, path = filesystem(spark, f"{ledger}/_splits-{hashlib.sha256(f'{delivery} {splits}'.encode()).hexdigest()}")
    if fs.exists(path):
        return int(_read_text(spark, path))
    begun = ledger_entries(df, ledger).where(F.col("plan") == delivery).take(1)
    if begun and splits:
        return splits
    parts = -(-df.count() // split_rows)
    found = max(1, parts if not splits else splits * -(-parts // splits))
    if not begun:
        draft = filesystem(spark, f"{ledger}/_draft-{uuid.uuid4().hex}")[1]
        stream = fs.create(draft)
        try:
            stream.write(bytearray(str(found).encode()))
        finally:
            stream.close()
        fs.rename(draft, path)
    return found


def _read_text(spark: SparkSession, path) -> str:
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def deliver_once(
    df: DataFrame,
    open_writer: Callable[[], object],
    ledger: str,
    delivery: str,
    order_by: Sequence[str] | None = None,
    bulk_size: int = BULK_ROWS,
    splits: int | None = None,
    retry: int = 1,
    retry_codes: Iterable[int] = (),
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """Send every row once, in batches of ``bulk_size``; one row of counters.

    ``open_writer()`` runs in each task that has something to send; its result needs
    ``write(table, batch_id)``, given an Arrow table, and ``close()``. It must do nothing
    if the store has the id. ``ledger`` is a folder that all runs share, ``delivery`` names what is
    delivered: the same name after a crash goes on, another name sends anew. ``order_by`` sorts the rows of
    a split (default: all columns); equal rows are alike, so their order says nothing.

    ``splits`` and ``bulk_size`` must be the same in all runs of a delivery, and the rows too: a batch that was
    taken with other rows is a :class:`BatchChanged` error. ``splits`` defaults to one per ``split_rows``; a given
    number is multiplied until a split has about as many, so that a task's sort does not grow with the table. The
    first run notes the number beside the ledger and later ones go by it. Batches that fail with a listed code are sent again as in ``write_bulk``; then the job fails, and what its
    finished tasks sent stays recorded. A task holds one batch. A row that fills a third of the table
    lands in one split: it streams through in batches, sorted by Spark, but by one task.
    """
    if bulk_size < 1 or retry < 0:
        raise ValueError("bulk_size must be at least 1 and retry not negative")
    names, codes = list(df.columns), frozenset(retry_codes)
    if "'" in delivery or not delivery:
        raise ValueError("a delivery needs a name without quotes")
    splits = _settled_splits(df, ledger, delivery, splits, split_rows)
    own = [quoted(n) for n in names]
    packed = F.struct(*own).alias("row")
    split = F.pmod(F.xxhash64(*own), F.lit(splits)).cast("int").alias("split")
    nothing = [F.lit(None).cast(kind).alias(n) for n, kind in (("number", "bigint"), ("digest", "string"), ("n_rows", "bigint"))]
    rows = df.select(split, F.lit(1).alias("kind"), F.xxhash64(*own).alias("hash"), packed, *nothing)
    taken = ledger_entries(df, ledger).where(F.col("plan") == delivery)
    taken = taken.select(
        "split", F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("hash"),
        F.lit(None).cast(rows.schema["row"].dataType).alias("row"), "number", "digest", "n_rows",
    )
    order = [F.col(f"row.{quoted(n)}") for n in order_by or names]
    stream = (
        rows.unionByName(taken)
        .repartitionById(splits, F.col("split"))
        .sortWithinPartitions("split", "kind", "number", *order, "hash")
    )
    counters = COUNTERS

    def send(batches: Iterator) -> Iterator:
        import pyarrow as pa

        writer, count, said = None, dict.fromkeys(counters, 0), []
        state = {"split": None, "number": 0, "known": {}, "waiting": [], "n": 0}

        def flush() -> None:
            nonlocal writer
            if not state["n"]:
                return
            table = pa.Table.from_batches(state["waiting"])
            number, digest = state["number"], hashlib.sha256(table.column("hash").combine_chunks().to_numpy().tobytes()).hexdigest()
            before = state["known"].pop(number, None)
            if before is not None and before != (digest, table.num_rows):
                raise BatchChanged(f"batch {number} of split {state['split']} of {delivery} has other rows than were sent")
            if before is not None:
                count["n_skipped_batches"] += 1
                count["n_skipped_rows"] += table.num_rows
            else:
                batch_id = f"{delivery}-{splits}-{bulk_size}-{state['split']}-{number}-{digest[:16]}"
                if writer is None:
                    writer = open_writer()
                given = pa.Table.from_arrays(table.column("row").combine_chunks().flatten(), names=names)
                for attempt in range(retry + 1):
                    try:
                        writer.write(given, batch_id)
                        break
                    except Exception as error:
                        if getattr(error, "code", None) not in codes or attempt == retry:
                            raise
                        count["n_retries"] += 1
                count["n_batches"] += 1
                count["n_rows"] += table.num_rows
                said.append((delivery, state["split"], number, digest, table.num_rows))
            state.update(number=number + 1, waiting=[], n=0)

        def close_split() -> None:
            flush()
            if state["known"]:
                raise BatchChanged(f"split {state['split']} of {delivery} has fewer batches than were sent")

        def entries(rows: list[tuple], with_counts: bool) -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [()] * 5
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64())
            out = [pa.array(c, k) for c, k in zip(columns, kinds)]
            # Counters ride on the first entry, or on a row without a plan.
            counts = [pa.array([count[c] if with_counts and i == 0 else 0 for i in range(len(rows))], pa.int64()) for c in counters]
            return pa.RecordBatch.from_arrays([*out, *counts], [*LEDGER_NAMES, *(f"c_{c}" for c in counters)])

        try:
            for batch in batches:
                column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
                splits_of, kinds_of = column["split"].to_numpy(), column["kind"].to_numpy()
                at = 0
                while at < batch.num_rows:
                    if splits_of[at] != state["split"]:
                        if state["split"] is not None:
                            close_split()
                        state.update(split=int(splits_of[at]), number=0, known={}, waiting=[], n=0)
                    if kinds_of[at] == 0:
                        state["known"][column["number"][at].as_py()] = (column["digest"][at].as_py(), column["n_rows"][at].as_py())
                        at += 1
                        continue
                    same = int((splits_of[at:] == splits_of[at]).sum())
                    some = min(same, bulk_size - state["n"])
                    state["waiting"].append(batch.slice(at, some).select(["hash", "row"]))
                    state["n"] += some
                    at += some
                    if state["n"] == bulk_size:
                        flush()
            if state["split"] is not None:
                close_split()
        finally:
            if writer is not None:
                writer.close()
        yield entries(said or [(None, None, None, None, None)], True)

    seen = Observation()
    ddl = ", ".join([LEDGER, *(f"c_{c} bigint" for c in counters)])
    sent = stream.mapInArrow(send, ddl).observe(seen, *[F.sum(f"c_{c}").alias(c) for c in counters])
    # With this algorithm an entry is there as soon as its task has ended, whatever becomes of the job.
    (
        sent.select(*LEDGER_NAMES).where("plan is not null")
        .write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(ledger)
    )
    totals = tuple(seen.get[c] or 0 for c in counters)
    return df.sparkSession.createDataFrame([totals], ", ".join(f"{c} bigint" for c in counters))


LEDGER_NAMES = tuple(part.split()[0] for part in LEDGER.split(", "))
