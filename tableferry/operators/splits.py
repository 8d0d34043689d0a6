"""Cutting a table into parallel read slices on a key.

Two forms of the same rule: predicate texts, one per read task of a database
scan, and a computed split column on a DataFrame. In both, every row that
satisfies ``where`` falls in exactly one slice, whatever its key: rows with a
null key go to slice 0, and the outer slices are open, so rows that arrive
after the bounds were probed are still read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LONG_MIN, LONG_MAX = -(2**63), 2**63 - 1


@dataclass(frozen=True)
class KeyBounds:
    """Whole-number bounds of a split key; both None when there is no key to split on."""

    low: int | None
    high: int | None

    @classmethod
    def of(cls, low, high) -> KeyBounds:
        """Bounds from key values, fractions rounded outwards."""
        if low is None:
            return cls(None, None)
        if isinstance(low, Decimal):
            return cls(math.floor(low), math.ceil(high))
        return cls(int(low), int(high))

    @property
    def empty(self) -> bool:
        return self.low is None

    def stride(self, n: int) -> int:
        return max(1, -((self.low - self.high) // n))

    def cuts(self, n: int) -> list[int]:
        """The n cut points that make n + 1 half-open ranges."""
        return [self.low + i * self.stride(n) for i in range(1, n + 1)]


def _check_count(n: int) -> None:
    if n < 1:
        raise ValueError(f"the number of splits must be at least 1, got {n}")


def check_key_type(name: str, dtype: T.DataType) -> None:
    if not isinstance(dtype, (T.IntegralType, T.DecimalType)):
        raise TypeError(f"split key {name} must be an integer or decimal, got {dtype.simpleString()}")


def filtered(df: DataFrame, where: str | Column | None) -> DataFrame:
    """``df`` under an optional condition; blank text means none."""
    if where is None or (isinstance(where, str) and not where.strip()):
        return df
    return df.where(where)


def key_bounds(df: DataFrame, key: str, where: str | Column | None = None) -> DataFrame:
    """One row ``max_key, min_key`` over the rows satisfying ``where``."""
    return filtered(df, where).agg(F.max(key).alias("max_key"), F.min(key).alias("min_key"))


def read_bounds(probe: DataFrame) -> KeyBounds:
    """Run a bounds probe once and round its two values outwards to whole numbers."""
    for field in probe.schema.fields:
        check_key_type(field.name, field.dataType)
    row = probe.first()
    return KeyBounds.of(row["min_key"], row["max_key"])


def _conjoin(where: str | None, split: str) -> str:
    if where is None or not where.strip():
        return split
    return f"({where.strip()}) AND ({split})"


def range_predicates(key: str, bounds: KeyBounds, n: int, where: str | None = None) -> list[str]:
    """Predicates for n + 1 ranges of equal width, each one index-friendly."""
    _check_count(n)
    if bounds.empty:
        return [_conjoin(where, "1 = 1")]
    cuts = bounds.cuts(n)
    splits = [f"{key} < {cuts[0]} OR {key} IS NULL"]
    splits += [f"{key} >= {a} AND {key} < {b}" for a, b in zip(cuts, cuts[1:])]
    splits.append(f"{key} >= {cuts[-1]}")
    return [_conjoin(where, split) for split in splits]


def mod_predicates(key: str, n: int, where: str | None = None) -> list[str]:
    """Predicates for n residue classes, for sparse or unevenly spread keys.

    Residues are brought into 0..n-1, so negative keys are read too. For a key
    with a fraction pass ``floor(key)``.
    """
    _check_count(n)
    residue = f"mod(mod({key}, {n}) + {n}, {n})"
    splits = [f"{residue} = {i}" for i in range(n)]
    splits[0] += f" OR {key} IS NULL"
    return [_conjoin(where, split) for split in splits]


def refine_predicates(predicates: list[str], key: str, n: int) -> list[str]:
    """Split every slice again by the residues of a second key.

    For a table where one value of the first key holds a large share of the
    rows, which no split on that key alone can divide.
    """
    return [f"({outer}) AND ({inner})" for outer in predicates for inner in mod_predicates(key, n)]


def with_range_split(
    df: DataFrame,
    key: str,
    n: int,
    bounds: KeyBounds | None = None,
    where: str | Column | None = None,
    column: str = "split_id",
) -> DataFrame:
    """Add the range split 0..n of each row; row-local, so nothing is shuffled.

    Without ``bounds`` they are probed with one aggregate. Given bounds only
    steer the cuts: keys outside them land in the first or last split.
    """
    _check_count(n)
    dtype = df.schema[key].dataType
    check_key_type(key, dtype)
    rows = filtered(df, where)
    if bounds is None:
        bounds = read_bounds(key_bounds(rows, key))
    if bounds.empty:
        return rows.withColumn(column, F.lit(0).cast("bigint"))

    low, stride = bounds.low, bounds.stride(n)
    top = low + stride * n
    whole = F.floor(F.col(key)) if isinstance(dtype, T.DecimalType) else F.col(key)
    in_long = (
        LONG_MIN <= low
        and top <= LONG_MAX
        and top - low <= LONG_MAX
        and not (isinstance(dtype, T.DecimalType) and dtype.precision - dtype.scale > 18)
    )
    number = "bigint" if in_long else "decimal(38,0)"

    def const(value: int) -> Column:
        return F.lit(str(value)).cast(number)

    # Clamping first keeps the subtraction inside the number type.
    inside = F.least(F.greatest(whole.cast(number), const(low)), const(top))
    split = F.call_function("div", inside - const(low), const(stride))
    return rows.withColumn(column, F.when(F.col(key).isNull(), F.lit(0)).otherwise(split).cast("bigint"))


def with_mod_split(
    df: DataFrame,
    key: str,
    n: int,
    where: str | Column | None = None,
    column: str = "split_id",
) -> DataFrame:
    """Add the residue split 0..n-1 of each row; null keys go to split 0."""
    _check_count(n)
    dtype = df.schema[key].dataType
    check_key_type(key, dtype)
    whole = F.floor(F.col(key)) if isinstance(dtype, T.DecimalType) else F.col(key)
    split = F.pmod(whole, F.lit(n).cast(dtype) if isinstance(dtype, T.LongType) else F.lit(n))
    return filtered(df, where).withColumn(column, F.coalesce(split.cast("bigint"), F.lit(0).cast("bigint")))


def split_summary(df: DataFrame, key: str, column: str = "split_id") -> DataFrame:
    """Rows and key range per split; partial aggregation keeps the shuffle tiny."""
    return df.groupBy(column).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(key).alias("min_key"),
        F.max(key).alias("max_key"),
    )
