"""Finding tables and carrying column comments."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.operators.columns import quoted


def list_tables(spark: SparkSession, pattern: str, database: str | None = None) -> DataFrame:
    """``table_name`` of the tables and views whose name contains a match, in any case."""
    tables = spark.sql(f"SHOW TABLES IN {quoted(database)}" if database else "SHOW TABLES")
    return tables.where(F.col("tableName").rlike("(?i)" + pattern)).select(F.col("tableName").alias("table_name"))


def with_comments(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Attach column comments; they follow the columns into any table made from them.

    Apostrophes are dropped and unnamed columns get an empty comment. Only
    metadata changes, so pruning and pushdown still reach the scan.
    """
    return df.select(
        [
            F.col(quoted(f.name)).alias(
                f.name, metadata={**f.metadata, "comment": comments.get(f.name, "").replace("'", "")}
            )
            for f in df.schema.fields
        ]
    )


def column_report(df: DataFrame) -> DataFrame:
    """``column_name, data_type, comment, n_values``: one row per column, from one pass."""
    fields = df.schema.fields
    counts = df.agg(*[F.count(quoted(f.name)).alias(f"_n_{i}") for i, f in enumerate(fields)])
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.lit(f.metadata.get("comment", "")).alias("comment"),
            F.col(f"_n_{i}").alias("n_values"),
        )
        for i, f in enumerate(fields)
    ]
    return counts.select(F.inline(F.array(*rows)))
