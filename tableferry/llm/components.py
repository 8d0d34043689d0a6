"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import nullcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tableferry.session import scratch_dir, setting

#: Edges that one task may join with a union-find; more are joined by rounds of stars over all tasks.
IN_TASK = 500_000
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def stored(spark: SparkSession, df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """``df`` written to the shared folder and read again, which cuts its lineage.

    ``batch_rows`` bounds the rows that go to a Python worker at once: for whole texts, which
    it holds beside its working arrays.
    """
    path = scratch_dir(spark, name)
    given = int(spark.conf.get(ARROW_ROWS))
    fewer = batch_rows and not 0 < given < batch_rows
    with setting(spark, ARROW_ROWS, str(batch_rows)) if fewer else nullcontext():
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Point the greater (or not greater) neighbours of every node at its least neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.where("b < a")
    least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    # The neighbours are joined by node: a node with many is a hot key of a plain join, which Spark splits.
    joined = (both.where("b > a") if large else both).join(least, "a")
    moved = joined.select(F.col("b").alias("a"), F.col("least").alias("b"))
    if not large:
        moved = moved.unionByName(least.select("a", F.col("least").alias("b")))
    return moved.where("a <> b").distinct()


def _joined(edges: DataFrame) -> DataFrame:
    """Each node's edge to its root, from a union-find over all edges in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = [(np.asarray(b.column("a")), np.asarray(b.column("b"))) for b in batches]
        if not ends:
            return
        a, b = (np.concatenate(x) for x in zip(*ends))
        # Nodes are numbered in their order, so that the least number is the least node.
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        root = list(range(len(nodes)))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        for x, y in zip(at[: len(a)].tolist(), at[len(a) :].tolist()):
            x, y = find(x), find(y)
            root[max(x, y)] = min(x, y)
        found = nodes[[find(x) for x in range(len(nodes))]]
        far = found != nodes
        yield pa.RecordBatch.from_arrays([pa.array(nodes[far]), pa.array(found[far])], ["a", "b"])

    return edges.coalesce(1).mapInArrow(run, "a bigint, b bigint")


def components(spark: SparkSession, edges: DataFrame, rounds: int = 60, in_task: int = IN_TASK) -> DataFrame:
    """``(node, root)`` for every node with an edge ``(a, b)`` of bigints; root is the least node reachable.

    Loops and repeated edges do no harm; no edges give no rows. At most ``in_task``
    edges are joined by one task; more by rounds of stars, each written to
    the shared folder. The driver only sees a count and a checksum.
    """

    def written(df: DataFrame) -> tuple[DataFrame, tuple]:
        seen = Observation()
        sums = F.count("*").alias("n"), F.expr("sum(cast(xxhash64(a, b) as decimal(38, 0)))").alias("sum")
        out = stored(spark, df.observe(seen, *sums), "components")
        return out, (seen.get["n"], seen.get["sum"])

    plain = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    now, state = written(plain)
    if 0 < state[0] <= in_task:
        now, state = stored(spark, _joined(now), "components"), (0, None)
    for _ in range(rounds):
        if not state[0]:
            break
        before = state
        now, state = written(_star(_star(now, large=True), large=False))
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def prefixed(df: DataFrame, prefix: str = "own_") -> DataFrame:
    """``df`` with a prefix on all names, so that columns added meanwhile clash with none."""
    return df.select(*[F.col(f"`{c}`").alias(prefix + c) for c in df.columns])


def unprefixed(df: DataFrame, names: list[str], prefix: str = "own_") -> DataFrame:
    """Back to the columns and names from before."""
    return df.select(*[F.col(f"`{prefix}{c}`").alias(c) for c in names])
