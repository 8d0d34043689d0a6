"""A step given as Spark SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def sql_step(
    source: DataFrame | SparkSession,
    text: str,
    view: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Run ``text``, with the input visible as ``view`` when one is named.

    Without ``partitions`` adaptive execution sizes the output; a number forces
    a shuffle into that many partitions.
    """
    if isinstance(source, DataFrame):
        if view:
            source.createOrReplaceTempView(view)
        spark = source.sparkSession
    else:
        spark = source
    result = spark.sql(text)
    return result if partitions is None else result.repartition(partitions)
