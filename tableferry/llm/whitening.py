"""Whitening of embeddings along the leading components of their covariance.

Vectors become whole numbers, and each distinct one is fitted once. Their sums are exact;
products are taken of centred vectors, added up within each task and then cell by cell
by Spark. Only these sums, as many as the dimension and its square, reach the driver,
where contour integration (:mod:`tableferry.llm.feast`) finds the components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.llm import feast
from tableferry.llm.components import stored

COMPONENTS = 4
#: Parts of 1 that an entry is rounded down to.
STEPS = 256
_LARGEST = (1 << 63) - 1


@dataclass(frozen=True)
class Fit:
    """What is known of the distinct vectors: number, sums, components as columns and how much they explain."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def explained(self) -> np.ndarray:
        """The share of all variance of each component; not a number where there is none."""
        return self.values / self.trace if self.trace > 0 else np.full(len(self.values), np.nan)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return x - np.array([s / self.n for s in self.sums])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Not a number for components without variance."""
        varies = self.values > len(self.sums) * np.finfo(float).eps * max(self.values.max(initial=0.0), 0.0)
        out = self.centred(x) @ self.vectors
        return np.divide(out, np.sqrt(np.where(varies, self.values, 1.0)), out=np.full_like(out, np.nan), where=varies)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sums of squares of ``n * x - sums``, exact; None beyond a bigint."""
        sums = self.sums
        most = max((self.n * int(np.abs(x.astype(np.float64)).max(initial=0.0) + 1) + max(map(abs, sums), default=0)), 1)
        if most * most * max(len(sums), 1) <= _LARGEST:
            return np.square(self.n * x - np.array(sums, np.int64)).sum(axis=1).tolist()
        exact = (sum((self.n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist())
        return [d if d <= _LARGEST else None for d in exact]


def whole_numbers(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """``embeddings`` with ``x``, its vector in whole steps; rows whose vector is null or holds null, NaN or infinity go.

    Vectors of unequal lengths are filled up with 0 to the longest.
    """
    column = F.col(f"`{vector}`")
    finite = F.forall(column, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = F.transform(column, lambda c: F.floor(c.cast("double") * STEPS))
    kept = embeddings.where(column.isNotNull() & finite).withColumn("x", x)
    shortest, longest = kept.select(F.min(F.size("x")), F.max(F.size("x"))).first()
    if shortest != longest:
        kept = kept.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("bigint"), F.lit(longest) - F.size("x"))))
    return kept


def _vectors(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


def _cells(vectors: DataFrame, kind: str, add: Callable[[np.ndarray, dict], None]) -> dict[int, int | float]:
    """Sums by cell: ``add`` puts those of a block of vectors into a task's own, which Spark then adds up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        for batch in batches:
            if batch.num_rows:
                add(_vectors(batch.column("x")), sums)
        if sums:
            cells = np.concatenate([np.asarray(v).ravel() for v in sums.values()])
            keep = np.flatnonzero(cells != 0)
            value = [str(int(v)) for v in cells[keep]] if kind == "string" else cells[keep].astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keep), pa.array(value, pa.string() if kind == "string" else pa.float64())], ["cell", "value"]
            )

    each = vectors.select("x").mapInArrow(run, f"cell bigint, value {kind}")
    value = F.col("value").cast("decimal(38, 0)") if kind == "string" else F.col("value")
    return {r["cell"]: r["value"] for r in each.groupBy("cell").agg(F.sum(value).alias("value")).collect()}


def fitted(vectors: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """The fit to a table of distinct vectors ``x`` of one length; None without any."""
    n, size = vectors.agg(F.count("*"), F.max(F.size("x"))).first()
    if not n or not size:
        return None

    def add_sums(x: np.ndarray, sums: dict) -> None:
        small = np.abs(x.astype(np.float64)).max() * len(x) < 1 << 62
        total = (x if small else x.astype(object)).sum(axis=0).astype(object)
        sums[0] = sums[0] + total if 0 in sums else total

    found = _cells(vectors, "string", add_sums)
    sums = tuple(int(found.get(i, 0)) for i in range(size))
    mean, upper = np.array([s / n for s in sums]), np.triu_indices(size)

    def add_products(x: np.ndarray, sums: dict) -> None:
        z = x - mean
        part = (z.T @ z)[upper]
        sums[0] = sums[0] + part if 0 in sums else part

    covariance = np.zeros((size, size))
    products = _cells(vectors, "double", add_products)
    cells = np.fromiter(products.keys(), np.int64, len(products))
    covariance[upper[0][cells], upper[1][cells]] = np.fromiter(products.values(), np.float64, len(products)) / n
    covariance = np.triu(covariance) + np.triu(covariance, 1).T
    values, turned = feast.leading(covariance, components)
    return Fit(n, sums, np.maximum(values, 0.0), turned, float(np.trace(covariance)))


def identity_error(vectors: DataFrame, fit: Fit) -> float:
    """The greatest entry, by size, of the whitened vectors' covariance less the identity; measured over all of them."""
    varies = ~np.isnan(fit.whitened(np.zeros((1, len(fit.sums))))[0])
    k = int(varies.sum())

    def add(x: np.ndarray, sums: dict) -> None:
        w = fit.whitened(x)[:, varies]
        sums[0] = sums[0] + w.sum(axis=0) if 0 in sums else w.sum(axis=0)
        sums[1] = sums[1] + w.T @ w if 1 in sums else w.T @ w

    if not k:
        return float("nan")
    found = _cells(vectors, "double", add)
    cells = np.array([found.get(i, 0.0) for i in range(k + k * k)]) / fit.n
    mean, products = cells[:k], cells[k:].reshape(k, k)
    return float(np.abs(products - np.outer(mean, mean) - np.eye(k)).max())


def whiten(
    spark: SparkSession, embeddings: DataFrame, components: int = COMPONENTS, vector: str = "embedding"
) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` per usable row and component.

    Rows whose vector is null or holds null, NaN or infinity give no rows; repeated
    rows are fitted once and all given; ids may be null or repeated; other columns are
    not read. Vectors of unequal lengths are filled up with 0; there are as many
    components as dimensions, if these are fewer, and none (so no rows) for empty
    vectors or an empty table. A component without variance, as that of equal vectors, has a null
    ``whitened`` and is left out of ``identity_error``, which is null without others;
    ``explained`` is null if nothing varies. A deviation beyond a bigint is null.
    """
    kind = dict(embeddings.dtypes)["vec_id"]
    schema = (
        f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    )
    rows = whole_numbers(embeddings.select("vec_id", vector), vector).select("vec_id", "x")
    vectors = stored(spark, rows.select("x").distinct(), "vectors")
    fit = fitted(vectors, components)
    if fit is None:
        return spark.createDataFrame([], schema)
    error = identity_error(vectors, fit)
    k = len(fit.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, rows = _vectors(batch.column("x")), batch.num_rows
            each = np.repeat(np.arange(rows), k)
            numbers = [fit.whitened(x).ravel(), np.tile(fit.explained, rows), np.full(rows * k, error)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, fit.n, np.int64)),
                    pa.array(fit.deviations(x), pa.int64()).take(pa.array(each)),
                    *(pa.array(v, pa.float64(), from_pandas=True) for v in numbers),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, schema)
