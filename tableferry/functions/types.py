"""The small type set stored tables use, and the type grammar of column-store targets."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def canonical_type(dtype: T.DataType) -> T.DataType:
    """bigint, double or string: the type under which a column is stored."""
    if isinstance(dtype, (T.IntegralType, T.BooleanType)):
        return T.LongType()
    if isinstance(dtype, T.FractionalType) and not isinstance(dtype, T.DecimalType):
        return T.DoubleType()
    if isinstance(dtype, T.DecimalType):
        return T.LongType() if dtype.scale == 0 else T.DoubleType()
    return T.StringType()


def to_text(column: Column, dtype: T.DataType) -> Column:
    """The text of a value; JSON for arrays, maps and structs."""
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.to_json(column)
    return column if dtype == T.StringType() else column.cast("string")


def _refuse(column: Column, message: str) -> Column:
    """An error naming the value, unless it is null; evaluated only where reached."""
    return F.when(column.isNotNull(), F.raise_error(F.concat(F.lit(message), column.cast("string"))))


def to_canonical(column: Column, dtype: T.DataType, on_overflow: str = "error") -> Column:
    """Cast one column to its stored type.

    A whole decimal beyond 64 bits is an error, or null with ``on_overflow="null"``.
    Arrays, maps and structs become JSON text.
    """
    if on_overflow not in ("error", "null"):
        raise ValueError(f"on_overflow must be error or null, got {on_overflow}")
    target = canonical_type(dtype)
    if dtype == target:
        return column
    if target == T.StringType():
        return to_text(column, dtype)
    if isinstance(dtype, T.DecimalType) and dtype.scale == 0 and dtype.precision > 18:
        fitted = column.try_cast(target)
        if on_overflow == "null":
            return fitted
        return F.coalesce(fitted, _refuse(column, "value does not fit in bigint: "))
    return column.cast(target)


# Target type names accepted, their Spark types and fill values.
SIMPLE_TARGETS = {
    "String": ("string", ""),
    "Date": ("date", None),
    "DateTime": ("timestamp", None),
    "Int8": ("tinyint", "0"),
    "Int16": ("smallint", "0"),
    "Int32": ("int", "0"),
    "Int64": ("bigint", "0"),
    "UInt8": ("smallint", "0"),
    "UInt16": ("int", "0"),
    "UInt32": ("bigint", "0"),
    "UInt64": ("decimal(20,0)", "0"),
    "Float32": ("float", "0"),
    "Float64": ("double", "0"),
}


class UnsupportedTargetType(ValueError):
    """The target column has a type no value can be written to."""


@dataclass(frozen=True)
class TargetType:
    """What a target column holds: its Spark type, fill value and whether it takes nulls."""

    text: str
    spark: str
    fill: str | None
    nullable: bool = False
    upper: int | None = None
    element: "TargetType | None" = None

    def fill_column(self, now: Column) -> Column:
        """The value a null or missing entry gets."""
        if self.nullable:
            return F.lit(None).cast(self.spark)
        if self.element is not None:
            return F.array().cast(self.spark)
        if self.fill is None:
            return now.cast(self.spark)
        return F.lit(self.fill).cast(self.spark)

    @property
    def whole(self) -> bool:
        """Whether the type only holds whole numbers."""
        return self.upper is not None or self.spark in ("tinyint", "smallint", "int", "bigint")

    def _fitted(self, column: Column, source: T.DataType | None = None) -> Column:
        """The value as the type holds it; null if it cannot. A whole number does not cut a fraction off."""
        fitted = column.try_cast(self.spark)
        if self.whole and isinstance(source, (T.FractionalType, T.TimestampType, T.TimestampNTZType)):
            exact = isinstance(source, T.DecimalType)
            same = fitted.cast(source) == column if exact else column.try_cast("double") == F.floor(column.try_cast("double"))
            fitted = F.when(same, fitted)
        if self.upper is None:
            return fitted
        return F.when(fitted.between(F.lit(0), F.lit(str(self.upper)).cast(self.spark)), fitted)

    def unfit(self, column: Column, source: T.DataType | None = None) -> Column:
        """True where there is a value and the type cannot hold it."""
        if self.element is not None:
            inner = source.elementType if isinstance(source, T.ArrayType) else None
            return F.coalesce(F.exists(column, lambda item: self.element.unfit(item, inner)), F.lit(False))
        return column.isNotNull() & self._fitted(column, source).isNull()

    def rounded(self, column: Column, source: T.DataType | None = None) -> Column:
        """True where a decimal type holds a value only after rounding it."""
        if not self.spark.startswith("decimal") or self.whole or not isinstance(source, T.FractionalType):
            return F.lit(False)
        back = column.try_cast(self.spark).try_cast(source)
        return F.coalesce(back != column, F.lit(False))

    def encode(self, column: Column, now: Column, strict: bool = True, source: T.DataType | None = None) -> Column:
        """Cast present values and fill nulls. An unfit value is an error, or
        with ``strict=False`` filled like a null, whether or not ANSI mode is on."""
        if self.element is not None:
            inner = source.elementType if isinstance(source, T.ArrayType) else None
            present = F.transform(column, lambda item: self.element.encode(item, now, strict, inner))
        else:
            present = self._fitted(column, source)
            if strict:
                present = F.coalesce(present, _refuse(column, f"value does not fit {self.text}: "))
        return present if self.nullable else F.coalesce(present, self.fill_column(now))


_WRAPPED = re.compile(r"^(Nullable|LowCardinality|Array)\((.*)\)$")
_DECIMAL = re.compile(r"^Decimal\(\s*(\d+)\s*,\s*(\d+)\s*\)$")


def target_type(text: str) -> TargetType:
    """Read a target type name; anything not exactly known is refused."""
    text = text.strip()
    wrapped = _WRAPPED.match(text)
    if wrapped:
        inner = target_type(wrapped.group(2))
        if wrapped.group(1) == "Array":
            return TargetType(text, f"array<{inner.spark}>", None, element=inner)
        nullable = inner.nullable or wrapped.group(1) == "Nullable"
        return TargetType(text, inner.spark, inner.fill, nullable, inner.upper, inner.element)
    decimal = _DECIMAL.match(text)
    if decimal and 1 <= int(decimal.group(1)) <= 38 and int(decimal.group(2)) <= int(decimal.group(1)):
        return TargetType(text, f"decimal({decimal.group(1)},{decimal.group(2)})", "0")
    if text in SIMPLE_TARGETS:
        spark, fill = SIMPLE_TARGETS[text]
        upper = 2 ** int(text[4:]) - 1 if text.startswith("UInt") else None
        return TargetType(text, spark, fill, upper=upper)
    raise UnsupportedTargetType(f"target type {text} is not supported")
