"""Publishing to key-value and column stores."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame

from tableferry.operators.conform import conform
from tableferry.operators.keyed import keyed_entries
from tableferry.sinks.bulk import BULK_ROWS, PIPELINE_ROWS, write_bulk


def publish_keyed(
    df: DataFrame,
    open_writer: Callable[[], object],
    kind: str,
    order_by: Sequence[str] | str | None = None,
    expire_ms: int = 0,
    pipeline_rows: int = PIPELINE_ROWS,
    **retrying,
) -> DataFrame:
    """Send a table as string, hash or set entries; each batch is one pipeline.

    The writer gets ``key, kind, field, value, expire_ms``. Every entry is sent
    once and any failure fails the job. Returns the counters of ``write_bulk``.
    """
    entries = keyed_entries(df, kind, order_by, expire_ms)
    return write_bulk(entries, open_writer, bulk_size=pipeline_rows, **retrying)


def publish_conformed(
    df: DataFrame,
    open_writer: Callable[[], object],
    target: Mapping[str, str],
    fields: Sequence[str] | None = None,
    now: dt.datetime | None = None,
    strict: bool = True,
    bulk_size: int = BULK_ROWS,
    **retrying,
) -> DataFrame:
    """Send rows fitted to a column-store target. Returns the counters of ``write_bulk``."""
    return write_bulk(conform(df, target, fields, now, strict), open_writer, bulk_size=bulk_size, **retrying)
