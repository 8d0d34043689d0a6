"""Batched writes to an external store, one connection per task, with retries."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

BULK_ROWS = 20_000
PIPELINE_ROWS = 1_000
COUNTERS = ("n_rows", "n_batches", "n_retries", "n_dropped_rows", "n_dropped_batches")


def batch_plan(df: DataFrame, split: str, bulk_size: int = BULK_ROWS) -> DataFrame:
    """How many batches each split will send, from row counts alone."""
    if bulk_size < 1:
        raise ValueError("bulk_size must be at least 1")
    counts = df.groupBy(split).agg(F.count(F.lit(1)).alias("n_rows"))
    n_batches = F.expr(f"(n_rows + {bulk_size - 1}L) div {bulk_size}L")
    return counts.select(
        split,
        "n_rows",
        n_batches.alias("n_batches"),
        (F.col("n_rows") - (n_batches - 1) * F.lit(bulk_size).cast("bigint")).alias("last_rows"),
    )


def write_bulk(
    df: DataFrame,
    open_writer: Callable[[], object],
    bulk_size: int = BULK_ROWS,
    retry: int = 1,
    retry_codes: Iterable[int] = (),
    on_exhausted: str = "error",
    partitions: int | None = None,
) -> DataFrame:
    """Send every row to a writer, in batches of ``bulk_size``.

    ``open_writer()`` runs once in each task that has rows; its result needs
    ``write(table)``, given an Arrow table, and ``close()``. A batch that fails
    with an exception whose ``code`` is in ``retry_codes`` is sent again up to
    ``retry`` times. After that the job fails, or with ``on_exhausted="drop"``
    the batch is left out and counted. Other failures always fail the job.

    A task holds one batch, whatever the size of its partition. Tasks that are
    run again send their rows again, so the store should accept repeats.
    Returns one row of counters.
    """
    if bulk_size < 1 or retry < 0:
        raise ValueError("bulk_size must be at least 1 and retry not negative")
    if on_exhausted not in ("error", "drop"):
        raise ValueError(f"on_exhausted must be error or drop, got {on_exhausted}")
    codes = frozenset(retry_codes)
    counters = COUNTERS

    def send(batches):
        import pyarrow as pa

        count = dict.fromkeys(counters, 0)
        writer, waiting, n_waiting = None, [], 0

        def flush(table):
            for attempt in range(retry + 1):
                try:
                    writer.write(table)
                    break
                except Exception as error:
                    if getattr(error, "code", None) not in codes:
                        raise
                    if attempt < retry:
                        count["n_retries"] += 1
                    elif on_exhausted == "error":
                        raise
                    else:
                        count["n_dropped_batches"] += 1
                        count["n_dropped_rows"] += table.num_rows
                        return
            count["n_batches"] += 1
            count["n_rows"] += table.num_rows

        try:
            for batch in batches:
                if batch.num_rows == 0:
                    continue
                if writer is None:
                    writer = open_writer()
                waiting.append(batch)
                n_waiting += batch.num_rows
                if n_waiting < bulk_size:
                    continue
                table = pa.Table.from_batches(waiting)
                whole = n_waiting - n_waiting % bulk_size
                for start in range(0, whole, bulk_size):
                    flush(table.slice(start, bulk_size))
                waiting, n_waiting = table.slice(whole).to_batches(), n_waiting - whole
            if n_waiting:
                flush(pa.Table.from_batches(waiting))
        finally:
            if writer is not None:
                writer.close()
        yield pa.RecordBatch.from_pydict({name: [value] for name, value in count.items()})

    rows = df if partitions is None else df.repartition(partitions)
    # One row of counters per task is summed where it is made: an observed sum of one stage, not a second
    # stage, which could make a lost executor's tasks, and their writes, run again.
    seen = Observation()
    sums = [F.sum(name).alias(name) for name in counters]
    sent = rows.mapInArrow(send, ", ".join(f"{name} bigint" for name in counters))
    sent.observe(seen, *sums).write.format("noop").mode("overwrite").save()
    totals = tuple(seen.get[name] or 0 for name in counters)
    return df.sparkSession.createDataFrame([totals], ", ".join(f"{name} bigint" for name in counters))
