"""Bounded, repeatable training samples and the folds the queries hold out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % folds


def draw(*columns: str) -> Column:
    """A repeatable number in [0, 1) for a row, from its columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 40)) / float(1 << 40)
