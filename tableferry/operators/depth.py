"""Read slices of equal depth: cuts at quantiles of the key, heavy keys divided by a second one.

Slices of equal width hold very unequal numbers of rows if keys are sparse or a few of them
are frequent. Here one pass over the key takes quantiles, from a sketch that each task
makes and Spark merges; a second one counts the few values at the cuts, where every value must be
that holds more than a slice's share. As in :mod:`splits` every row falls in exactly one slice: the outer
ones are open, and null keys have a place.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.operators.splits import _check_count, _conjoin, check_key_type, filtered

#: How much finer the sketch is than the slices: ranks are off by at most this part of a slice.
FINENESS = 100


@dataclass(frozen=True)
class Slice:
    """Keys from ``low`` up to, not with, ``high``; None is open. ``nulls`` has no keys but null ones."""

    low: int | None
    high: int | None
    parts: int = 1
    nulls: bool = False


@dataclass(frozen=True)
class DepthCuts:
    """Slices in the order of their keys, those of null keys last."""

    slices: tuple[Slice, ...]

    @property
    def count(self) -> int:
        return sum(s.parts for s in self.slices)


def _whole(value) -> int:
    return int(value.to_integral_value(rounding="ROUND_FLOOR")) if isinstance(value, Decimal) else int(value)


def depth_cuts(df: DataFrame, key: str, n: int, second: str | None = None, where: str | Column | None = None) -> DepthCuts:
    """Slices of about a ``n``-th of the rows each, at most twice that.

    A value with more rows than an ``n``-th is a slice of its own, in as many parts as it fills, by the residues of
    ``second``; without a second key it stays whole. The driver gets ``n`` quantiles and as many counts. An
    empty table is one open slice.
    """
    _check_count(n)
    check_key_type(key, df.schema[key].dataType)
    rows = filtered(df, where).select(F.col(key).alias("key"))
    shares = [i / n for i in range(1, n)] or [0.5]
    cuts = F.percentile_approx("key", F.array(*[F.lit(s) for s in shares]), F.lit(min(n * FINENESS, 1_000_000)))
    total, known, quantiles = rows.agg(F.count(F.lit(1)), F.count("key"), cuts).first()
    if not total:
        return DepthCuts((Slice(None, None),))
    places = sorted({_whole(q) for q in quantiles or ()}) if n > 1 else []
    floor = F.floor("key")
    counted = rows.select(floor.alias("v")).where(F.col("v").isin(places)).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    heavy = {_whole(r["v"]): r["n"] for r in counted.collect() if r["n"] * n > total} if places else {}
    borders = sorted({*places, *heavy, *(v + 1 for v in heavy)})
    edges = [None, *borders, None]

    def parts(rows_: int) -> int:
        return max(1, -(-rows_ * n // total)) if second else 1

    slices = [Slice(a, b, parts(heavy[a]) if a in heavy and b == a + 1 else 1) for a, b in zip(edges, edges[1:])]
    nulls = total - known
    if nulls * n > total:
        slices.append(Slice(None, None, parts(nulls), nulls=True))
    return DepthCuts(tuple(slices))


def depth_predicates(key: str, cuts: DepthCuts, second: str | None = None, where: str | None = None) -> list[str]:
    """One predicate text per slice and part; together they hold every row that satisfies ``where`` once."""
    with_nulls = not any(s.nulls for s in cuts.slices)
    out = []
    for i, s in enumerate(cuts.slices):
        inside = [f"{key} >= {s.low}"] if s.low is not None else []
        inside += [f"{key} < {s.high}"] if s.high is not None else []
        if s.nulls:
            text = f"{key} IS NULL"
        elif not inside:
            text = "1 = 1" if with_nulls else f"{key} IS NOT NULL"
        else:
            text = " AND ".join(inside) + (f" OR {key} IS NULL" if i == 0 and with_nulls else "")
        if s.parts == 1:
            out.append(_conjoin(where, text))
            continue
        residue = f"mod(mod({second}, {s.parts}) + {s.parts}, {s.parts})"
        for part in range(s.parts):
            null = f" OR {second} IS NULL" if part == 0 else ""
            out.append(_conjoin(where, f"({text}) AND ({residue} = {part}{null})"))
    return out


def with_depth_split(
    df: DataFrame,
    key: str,
    n: int,
    second: str | None = None,
    cuts: DepthCuts | None = None,
    where: str | Column | None = None,
    column: str = "split_id",
) -> DataFrame:
    """Add the slice of each row, numbered as :func:`depth_predicates` lists them; nothing is shuffled.

    Without ``cuts`` they are taken from the rows, in two passes over the key.
    """
    for name in (key, second) if second else (key,):
        check_key_type(name, df.schema[name].dataType)
    rows = filtered(df, where)
    cuts = cuts or depth_cuts(rows, key, n, second)
    before, total = [], 0
    for s in cuts.slices:
        before.append(total)
        total += s.parts

    def number(i: int) -> Column:
        s = cuts.slices[i]
        if s.parts == 1:
            return F.lit(before[i]).cast("bigint")
        residue = F.pmod(F.floor(second).cast("decimal(38,0)"), F.lit(s.parts).cast("decimal(38,0)"))
        return F.lit(before[i]).cast("bigint") + F.coalesce(residue.cast("bigint"), F.lit(0).cast("bigint"))

    keyed = [i for i, s in enumerate(cuts.slices) if not s.nulls]
    decimal = isinstance(df.schema[key].dataType, T.DecimalType)

    def found(some: Sequence[int]) -> Column:
        """A search that halves the slices at every step."""
        if len(some) == 1:
            return number(some[0])
        half = len(some) // 2
        low = cuts.slices[some[half]].low
        # A literal of its own precision: one of 38 digits would round the key's fraction away.
        border = F.lit(Decimal(low)) if decimal else F.lit(low).cast("bigint")
        return F.when(F.col(key) < border, found(some[:half])).otherwise(found(some[half:]))

    null = next((number(i) for i, s in enumerate(cuts.slices) if s.nulls), F.lit(0).cast("bigint"))
    return rows.withColumn(column, F.when(F.col(key).isNull(), null).otherwise(found(keyed)))
