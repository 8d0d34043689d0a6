"""Tables as key-value entries: strings, hashes and sets, with an optional expiry.

Writing entries one by one means "the last write wins". Here the winner is
named by ``order_by``, and found with partial aggregation: a key that holds a
large share of the rows leaves each task as a single row before any shuffle. As
winners are texts and structs, Spark sorts each task's rows for it (it spills).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions.types import to_text
from tableferry.operators.columns import quoted

KINDS = ("string", "hash", "set")


def _order(order_by: Sequence[str] | str) -> list[str]:
    return [order_by] if isinstance(order_by, str) else list(order_by)


# Different values of these types have different texts, so rows can be grouped
# before the cast, on the cheaper value.
_TEXT_KEEPS_APART = (T.IntegralType, T.StringType, T.BooleanType, T.DateType, T.DecimalType)


def _grouping(df: DataFrame, position: int) -> Column:
    field = df.schema.fields[position]
    return F.col(quoted(field.name)) if isinstance(field.dataType, _TEXT_KEEPS_APART) else _text(df, field.name)


def _text(df: DataFrame, name: str) -> Column:
    return to_text(F.col(quoted(name)), df.schema[name].dataType)


def _key_text(column: str) -> Column:
    key = F.col(column).cast("string")
    return F.when(key.isNull(), F.raise_error(F.lit("an entry has no key"))).otherwise(key).alias("key")


def _latest(value: Column, order_by: list[str] | None) -> Column:
    """The value of the last row that has one; equal order falls to the greater value.

    With no order a key may have one distinct value only, else the query fails.
    """
    if order_by is None:
        return F.when(
            F.min(value) != F.max(value),
            F.raise_error(F.lit("a key has several values: name the order of its rows with order_by")),
        ).otherwise(F.max(value))
    ranked = F.struct(*[F.col(quoted(c)).alias(f"_order_{i}") for i, c in enumerate(order_by)], value.alias("_value"))
    return F.max(F.when(value.isNotNull(), ranked))["_value"]


def _expiring(df: DataFrame, expire_ms: int | None) -> DataFrame:
    if expire_ms is None:
        return df
    alive = F.lit(expire_ms) if expire_ms > 0 else F.lit(None)
    return df.withColumn("expire_ms", alive.cast("bigint"))


def _payload(df: DataFrame, order_by: list[str] | None, wanted: Sequence[str] | None) -> list[str]:
    if wanted is not None:
        return list(wanted)
    return [c for c in df.columns[1:] if c not in (order_by or [])]


def kv_string(
    df: DataFrame,
    order_by: Sequence[str] | str | None = None,
    expire_ms: int | None = None,
) -> DataFrame:
    """``key, value`` from the first two columns; rows without a value write nothing."""
    order_by = _order(order_by) if order_by else None
    value = _text(df, df.columns[1])
    latest = (
        df.groupBy(_grouping(df, 0).alias("_key"))
        .agg(_latest(value, order_by).alias("value"))
        .where(F.col("value").isNotNull())
        .select(_key_text("_key"), "value")
    )
    return _expiring(latest, expire_ms)


def kv_hash(
    df: DataFrame,
    order_by: Sequence[str] | str | None = None,
    fields: Sequence[str] | None = None,
    expire_ms: int | None = None,
) -> DataFrame:
    """``key, field, value``: the first column is the key, the others its fields.

    Fields merge per key and null ones write nothing. One aggregation holds all
    fields of a key; rows are widened to one per field only afterwards. By
    default the fields are all other columns except those in ``order_by``.
    """
    order_by = _order(order_by) if order_by else None
    names = _payload(df, order_by, fields)
    if not names:
        raise ValueError("a hash needs at least one field column")
    slots = [f"_field_{i}" for i in range(len(names))]
    wide = df.groupBy(_grouping(df, 0).alias("_key")).agg(
        *[
            _latest(_text(df, name), order_by).alias(slot)
            for name, slot in zip(names, slots)
        ]
    )
    pairs = F.array(*[F.struct(F.lit(n).alias("field"), F.col(s).alias("value")) for n, s in zip(names, slots)])
    entries = wide.select(_key_text("_key"), F.inline(pairs)).where(F.col("value").isNotNull())
    return _expiring(entries, expire_ms)


def kv_set(df: DataFrame, expire_ms: int | None = None) -> DataFrame:
    """``key, member`` from the first two columns, each pair once.

    Members stay rows, so a key may have any number of them.
    """
    pairs = df.select(_grouping(df, 0).alias("_key"), _grouping(df, 1).alias("_member"))
    pairs = pairs.where(F.col("_member").isNotNull()).distinct()
    return _expiring(pairs.select(_key_text("_key"), F.col("_member").cast("string").alias("member")), expire_ms)


def keyed_entries(
    df: DataFrame,
    kind: str,
    order_by: Sequence[str] | str | None = None,
    expire_ms: int = 0,
) -> DataFrame:
    """Entries of any kind in one shape: ``key, kind, field, value, expire_ms``."""
    if kind == "string":
        entries = kv_string(df, order_by, expire_ms).withColumn("field", F.lit(None).cast("string"))
    elif kind == "hash":
        entries = kv_hash(df, order_by, expire_ms=expire_ms)
    elif kind == "set":
        entries = kv_set(df, expire_ms).withColumn("field", F.lit(None).cast("string"))
        entries = entries.withColumnRenamed("member", "value")
    else:
        raise ValueError(f"kind must be one of {', '.join(KINDS)}, got {kind}")
    return entries.select("key", F.lit(kind).alias("kind"), "field", "value", "expire_ms")
