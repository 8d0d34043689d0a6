"""A job: one source, steps, one sink."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Step = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Job:
    """Read, transform, publish. Each step takes and gives a DataFrame, so Spark
    plans the whole chain at once; ``view`` names the source for SQL steps."""

    source: Callable[[SparkSession], DataFrame]
    steps: Sequence[Step] = ()
    sink: Callable[[DataFrame], DataFrame | None] | None = None
    view: str | None = None

    def frame(self, spark: SparkSession) -> DataFrame:
        """The rows that reach the sink, not yet computed."""
        df = self.source(spark)
        if self.view:
            df.createOrReplaceTempView(self.view)
        for step in self.steps:
            df = df.transform(step)
        return df

    def run(self, spark: SparkSession) -> DataFrame | None:
        df = self.frame(spark)
        return df if self.sink is None else self.sink(df)


def preview(df: DataFrame, limit: int = 100, order_by: str | Sequence[str] | None = None) -> DataFrame:
    """The first ``limit`` rows; with an order Spark keeps only that many per task."""
    if limit < 1:
        raise ValueError("limit must be greater than 0")
    return (df.orderBy(order_by) if order_by else df).limit(limit)


def show(df: DataFrame, limit: int = 100) -> None:
    """Print the first ``limit`` rows in full."""
    preview(df, limit).show(limit, truncate=False)
