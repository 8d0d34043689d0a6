"""Fitting rows to the schema of a column-store target."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableferry.functions.types import TargetType, UnsupportedTargetType, target_type
from tableferry.operators.columns import quoted


def target_schema(description: DataFrame) -> dict[str, str]:
    """Column name to type text, from the ``name, type`` rows a target describes itself with."""
    name, kind = description.columns[:2]
    return {row[0]: row[1] for row in description.select(quoted(name), quoted(kind)).collect()}


def _now(now: dt.datetime | None) -> Column:
    return F.lit(now or dt.datetime.now(dt.timezone.utc).replace(microsecond=0)).cast("timestamp")


def _verdict(field: str, target: Mapping[str, str], df: DataFrame) -> tuple[str, TargetType | None]:
    if field not in target:
        return "not in target", None
    try:
        kind = target_type(target[field])
    except UnsupportedTargetType:
        return "type not supported", None
    return ("ok" if field in df.columns else "filled with default"), kind


def conform_report(df: DataFrame, target: Mapping[str, str], fields: Sequence[str] | None = None) -> DataFrame:
    """One row per requested field: can it be written, and what happens to its values.

    ``n_filled`` counts rows that take the default (or NULL), ``n_unfit`` rows
    whose value does not fit the target type, ``n_rounded`` rows that a decimal
    type rounds. All counts come from one pass.
    """
    rows = []
    for field in fields or df.columns:
        verdict, kind = _verdict(field, target, df)
        filled = unfit = rounded = F.lit(0)
        if verdict == "ok":
            value, source = F.col(quoted(field)), df.schema[field].dataType
            filled = F.count_if(value.isNull())
            unfit = F.count_if(kind.unfit(value, source))
            rounded = F.count_if(kind.rounded(value, source))
        elif kind is not None:
            filled = F.count(F.lit(1))
        rows.append((field, target.get(field), verdict, filled, unfit, rounded))
    counts = df.agg(
        *[c.cast("bigint").alias(f"_{name}_{i}") for i, row in enumerate(rows) for name, c in zip("fur", row[3:])]
    )
    report = [
        F.struct(
            F.lit(field).alias("field"),
            F.lit(kind).cast("string").alias("target_type"),
            F.lit(verdict).alias("verdict"),
            F.col(f"_f_{i}").alias("n_filled"),
            F.col(f"_u_{i}").alias("n_unfit"),
            F.col(f"_r_{i}").alias("n_rounded"),
        )
        for i, (field, kind, verdict, *_) in enumerate(rows)
    ]
    return counts.select(F.inline(F.array(*report)))


def conform(
    df: DataFrame,
    target: Mapping[str, str],
    fields: Sequence[str] | None = None,
    now: dt.datetime | None = None,
    strict: bool = True,
) -> DataFrame:
    """Rows with exactly ``fields`` (default: the input's columns), typed for the target.

    Missing columns and nulls get the default of their type, or NULL where the
    target takes it. Dates default to one ``now``, in whole seconds, for the whole job. A value
    that does not fit is an error, or takes the default with ``strict=False``; so
    does a fraction for a whole-number type. Decimal types round.
    """
    fields = list(fields or df.columns)
    verdicts = {field: _verdict(field, target, df) for field in fields}
    refused = [f"{field}: {verdict}" for field, (verdict, kind) in verdicts.items() if kind is None]
    if refused:
        raise ValueError("the target cannot take these fields: " + "; ".join(refused))
    moment = _now(now)
    columns = []
    for field in fields:
        verdict, kind = verdicts[field]
        if verdict == "ok":
            source = df.schema[field].dataType
            same = source.simpleString() == kind.spark
            as_is = same and kind.upper is None and kind.element is None
            value = kind.encode(F.col(quoted(field)), moment, strict and not as_is, source)
        else:
            value = kind.fill_column(moment)
        columns.append(value.alias(field))
    return df.select(columns)
