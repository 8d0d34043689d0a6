"""Choosing, renaming and conforming columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.functions.text import slice_text
from tableferry.functions.types import to_canonical


def quoted(name: str) -> str:
    """A column name as Spark reads it, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def list_items(columns: str | Sequence[str]) -> list[str]:
    """The items of a comma list; commas inside calls and quotes do not count."""
    if not isinstance(columns, str):
        return [item.strip() for item in columns if item.strip()]
    items, depth, quote, escaped = [""], 0, "", False
    for char in columns:
        if quote:
            quote = "" if char == quote and not escaped else quote
            escaped = char == "\\" and not escaped
        elif char in "'\"`":
            quote = char
        elif char in "()[]":
            depth += 1 if char in "([" else -1
        if char == "," and not quote and depth == 0:
            items.append("")
        else:
            items[-1] += char
    return [item.strip() for item in items if item.strip()]


def prune_columns(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Keep the named columns in table order; names are case-sensitive, unknown ones ignored."""
    keep = {item.strip("`") for item in list_items(columns)}
    return df.select([F.col(quoted(c)) for c in df.columns if c in keep])


def select_list(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """Project a list such as ``a, my-col, b as c, concat(a, ',', b) as d``.

    Bare column names need no quoting; every other item is a Spark expression.
    """
    return df.select(
        [F.col(quoted(item)) if item in df.columns else F.expr(item) for item in list_items(columns)]
    )


def normalize_types(df: DataFrame, on_overflow: str = "error") -> DataFrame:
    """Every column as bigint, double or string; names, order and comments stay."""
    return df.select(
        [
            to_canonical(F.col(quoted(f.name)), f.dataType, on_overflow).alias(f.name, metadata=f.metadata)
            for f in df.schema.fields
        ]
    )


def substring_column(
    df: DataFrame,
    length: int,
    source: str = "raw_message",
    target: str = "__ROOT__",
    pos: int = 0,
    strict: bool = False,
) -> DataFrame:
    """Add or replace ``target`` with ``length`` characters of ``source`` from 0-based ``pos``."""
    return df.withColumn(target, slice_text(F.col(quoted(source)), pos, length, strict))
