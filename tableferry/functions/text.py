"""Text functions, as column expressions and as a SQL function."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def slice_text(column: Column, pos: int, length: int, strict: bool = False) -> Column:
    """``length`` characters from 0-based ``pos``.

    Null stays null and short text gives what is there; with ``strict`` both
    are errors. Positions count characters, not UTF-16 units.
    """
    if pos < 0 or length < 0:
        raise ValueError("pos and length must not be negative")
    part = F.substring(column, pos + 1, length)
    if not strict:
        return part
    too_short = column.isNull() | (F.length(column) < pos + length)
    return F.when(too_short, F.raise_error(F.lit(f"text is shorter than {pos + length}"))).otherwise(part)


def register_functions(spark: SparkSession) -> None:
    """Make ``my_sub(s, pos, len)`` callable in SQL; Catalyst inlines its body."""
    spark.sql(
        """
        CREATE OR REPLACE TEMPORARY FUNCTION my_sub(s STRING, pos INT, len INT)
        RETURNS STRING
        RETURN CASE WHEN pos < 0 OR len < 0 THEN raise_error('pos and len must not be negative')
                    ELSE substring(s, pos + 1, len) END
        """
    )
