"""Writing to a relational database."""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tableferry.sinks.tables import SAVE_MODES
from tableferry.sources.jdbc import JdbcLink


def save_jdbc(
    df: DataFrame,
    link: JdbcLink,
    table: str,
    mode: str = "append",
    partitions: int | None = None,
    batch_rows: int = 200,
) -> None:
    """Write under one of the four save modes; overwriting truncates and keeps the table.

    ``partitions`` bounds the number of connections the database sees.
    """
    if mode not in SAVE_MODES:
        raise ValueError(f"save mode must be one of {', '.join(SAVE_MODES)}, got {mode}")
    rows = df if partitions is None else df.repartition(partitions)
    properties = {
        **link.properties(),
        "batchsize": str(batch_rows),
        "isolationLevel": "READ_COMMITTED",
        "truncate": "true",
    }
    rows.write.mode(mode).jdbc(link.url, table, properties=properties)


def _connect(spark: SparkSession, link: JdbcLink):
    """A connection with all options of the link, by the driver that Spark itself takes for it."""
    jvm = spark._jvm
    named = link.driver or jvm.java.sql.DriverManager.getDriver(link.url).getClass().getCanonicalName()
    jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(named)
    properties = jvm.java.util.Properties()
    for name, value in link.properties().items():
        properties.setProperty(name, str(value))
    return jvm.java.sql.DriverManager.getConnection(link.url, properties)


def _beside(table: str, suffix: str) -> str:
    """A table name next to ``table``; a suffix goes inside the quotes of the last part."""
    return f"{table[:-1]}{suffix}{table[-1]}" if table[-1:] in ('"', "`", "]") else table + suffix


def _quoted_names(spark: SparkSession, link: JdbcLink, names: list[str]) -> str:
    """A column list quoted as Spark itself quotes names for this database."""
    dialect = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(link.url)
    return ", ".join(dialect.quoteIdentifier(name) for name in names)


def delete_then_write_jdbc(
    df: DataFrame,
    link: JdbcLink,
    table: str,
    delete_sql: str | None = None,
    partitions: int | None = None,
    batch_rows: int = 200,
    connect: Callable[[SparkSession, JdbcLink], object] = _connect,
) -> None:
    """Run ``delete_sql`` and append ``df`` so that the database shows both or neither.

    The rows are first written by all tasks to a table of a name of its own beside
    it; one transaction then deletes the old rows and takes over the new ones. The
    table is dropped however the job ends; if dropping fails after the commit, the
    rows are in and a warning says what is left. A blank ``delete_sql`` is a plain
    append.
    """
    if not delete_sql or not delete_sql.strip():
        save_jdbc(df, link, table, "append", partitions, batch_rows)
        return
    incoming = _beside(table, f"_incoming_{uuid.uuid4().hex[:12]}")
    # Appending no rows creates the table where it is absent.
    save_jdbc(df.limit(0), link, table, "append")
    columns = _quoted_names(df.sparkSession, link, df.columns)
    connection = None
    try:
        save_jdbc(df, link, incoming, "overwrite", partitions, batch_rows)
        connection = connect(df.sparkSession, link)
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        try:
            statement.executeUpdate(delete_sql)
            statement.executeUpdate(f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {incoming}")
            connection.commit()
        except Exception:
            connection.rollback()
            raise
    finally:
        _drop(connection or connect(df.sparkSession, link), incoming)


def _drop(connection, table: str) -> None:
    """Drop a table and close the connection; what the job did is settled by now, so a failure only warns."""
    try:
        connection.setAutoCommit(True)
        connection.createStatement().executeUpdate(f"DROP TABLE {table}")
    except Exception as error:  # noqa: BLE001
        warnings.warn(f"{table} could not be dropped: {error}", stacklevel=3)
    finally:
        connection.close()
