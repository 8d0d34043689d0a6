"""Parallel reads from a relational database.

The database is reached through Spark's own JDBC source; its driver jar must be
on the cluster's class path.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.operators.columns import prune_columns, select_list
from tableferry.operators.conform import target_schema
from tableferry.operators.depth import depth_cuts, depth_predicates
from tableferry.operators.splits import (
    KeyBounds,
    check_key_type,
    mod_predicates,
    range_predicates,
    read_bounds,
    refine_predicates,
)
from tableferry.sources.catalog import with_comments

PROBES_PER_QUERY = 200


@dataclass(frozen=True)
class JdbcLink:
    """Where a database is; the driver class is taken from the url unless named."""

    url: str
    user: str
    password: str = field(repr=False)
    driver: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)

    def properties(self) -> dict[str, str]:
        named = {"user": self.user, "password": self.password}
        if self.driver:
            named["driver"] = self.driver
        return {**self.options, **named}

    def load(self, spark: SparkSession, **options: str) -> DataFrame:
        return spark.read.format("jdbc").options(url=self.url, **self.properties(), **options).load()


def _where(where: str | None) -> str:
    return f" WHERE ({where.strip()})" if where and where.strip() else ""


def jdbc_bounds(
    spark: SparkSession, link: JdbcLink, table: str, key: str, where: str | None = None
) -> KeyBounds:
    """Largest and smallest key, computed by the database, fetched once."""
    query = f"SELECT max({key}) AS max_key, min({key}) AS min_key FROM {table}{_where(where)}"
    return read_bounds(_bounds_columns(link.load(spark, query=query)))


def _bounds_columns(probe: DataFrame) -> DataFrame:
    # Databases differ in the case of unquoted names.
    return probe.toDF(*[c.lower() for c in probe.columns])


def read_jdbc_bounds(
    spark: SparkSession,
    link: JdbcLink,
    table: str,
    key: str,
    n: int,
    columns: str | None = None,
) -> DataFrame:
    """All rows, in n slices steered by the key's bounds; nothing is filtered."""
    bounds = jdbc_bounds(spark, link, table, key)
    if bounds.empty:
        rows = link.load(spark, dbtable=table)
    else:
        rows = link.load(
            spark,
            dbtable=table,
            partitionColumn=key,
            lowerBound=str(bounds.low),
            upperBound=str(bounds.high),
            numPartitions=str(n),
        )
    return prune_columns(rows, columns) if columns else rows


def read_jdbc_ranges(
    spark: SparkSession,
    link: JdbcLink,
    table: str,
    key: str,
    n: int,
    columns: str | None = None,
    where: str | None = None,
    comments_from: str | None = None,
    refine: tuple[str, int] | None = None,
) -> DataFrame:
    """Rows satisfying ``where``, in n + 1 key ranges, one task each.

    ``comments_from`` names the database whose column comments are attached.
    ``refine=("other_key", m)`` reads each range in m residues of another key,
    for tables where one value of the first key has very many rows.
    """
    bounds = jdbc_bounds(spark, link, table, key, where)
    predicates = range_predicates(key, bounds, n, where)
    if refine:
        predicates = refine_predicates(predicates, *refine)
    rows = spark.read.jdbc(link.url, table, predicates=predicates, properties=link.properties())
    if comments_from:
        rows = with_comments(rows, jdbc_comments(spark, link, comments_from, table))
    return select_list(rows, columns) if columns else rows


def read_jdbc_depths(
    spark: SparkSession,
    link: JdbcLink,
    table: str,
    key: str,
    n: int,
    second: str | None = None,
    columns: str | None = None,
    where: str | None = None,
) -> DataFrame:
    """Rows satisfying ``where``, in slices of about equal depth, one task each.

    The key column is read first, in ``n`` ranges of equal width, for its quantiles; values that
    fill more than a slice are divided by the residues of ``second``.
    """
    keys = range_predicates(key, jdbc_bounds(spark, link, table, key, where), n, where)
    probe = spark.read.jdbc(link.url, table, predicates=keys, properties=link.properties()).select(key)
    predicates = depth_predicates(key, depth_cuts(probe, key, n, second), second, where)
    rows = spark.read.jdbc(link.url, table, predicates=predicates, properties=link.properties())
    return select_list(rows, columns) if columns else rows


def read_jdbc_residues(
    spark: SparkSession,
    link: JdbcLink,
    table: str,
    key: str,
    n: int,
    columns: str | None = None,
    where: str | None = None,
    refine: tuple[str, int] | None = None,
) -> DataFrame:
    """Rows satisfying ``where``, in n residue classes of the key, one task each;
    ``refine`` as for ranges."""
    predicates = mod_predicates(key, n, where)
    if refine:
        predicates = refine_predicates(predicates, *refine)
    rows = spark.read.jdbc(link.url, table, predicates=predicates, properties=link.properties())
    return select_list(rows, columns) if columns else rows


def list_jdbc_tables(spark: SparkSession, link: JdbcLink, database: str, pattern: str) -> DataFrame:
    """``table_name`` of the database's tables whose name contains a match, in any case."""
    tables = link.load(spark, dbtable="information_schema.tables")
    tables = tables.toDF(*[c.lower() for c in tables.columns])
    return tables.where(
        (F.col("table_schema") == database) & F.col("table_name").rlike("(?i)" + pattern)
    ).select("table_name")


def jdbc_comments(spark: SparkSession, link: JdbcLink, database: str, table: str) -> dict[str, str]:
    """Column comments from the database catalog; one row per column of one table."""
    columns = link.load(spark, dbtable="information_schema.columns")
    columns = columns.toDF(*[c.lower() for c in columns.columns])
    found = columns.where(
        (F.col("table_schema") == database) & (F.col("table_name") == table.replace("`", "").split(".")[-1])
    ).select("column_name", "column_comment")
    return {row[0]: row[1] or "" for row in found.collect()}


def target_types(spark: SparkSession, link: JdbcLink, database: str, table: str) -> dict[str, str]:
    """Column name to type text of a column-store table, from its own catalog."""
    columns = link.load(spark, dbtable="system.columns")
    described = columns.where((F.col("database") == database) & (F.col("table") == table)).select("name", "type")
    return target_schema(described)


def read_jdbc_shards(
    spark: SparkSession,
    link: JdbcLink,
    tables: Iterable[str],
    key: str,
    n: int,
    where: str | None = None,
    columns: str | None = None,
    refine: tuple[str, int] | None = None,
    by: str = "ranges",
) -> dict[str, DataFrame]:
    """Every table of a sharded set as a split read, ready to be merged.

    ``by="residues"`` splits by residue classes of the key and probes nothing; else
    one query fetches the bounds of up to ``PROBES_PER_QUERY`` shards. ``columns``
    and ``refine`` are those of the single-table reads.
    """
    if by not in ("ranges", "residues"):
        raise ValueError(f"by must be ranges or residues, got {by}")
    tables = list(tables)
    bounds: dict[int, KeyBounds] = {}
    for start in range(0, len(tables) if by == "ranges" else 0, PROBES_PER_QUERY):
        probes = " UNION ALL ".join(
            f"SELECT {i} AS shard_no, max({key}) AS max_key, min({key}) AS min_key FROM {table}{_where(where)}"
            for i, table in enumerate(tables[start : start + PROBES_PER_QUERY], start)
        )
        probe = _bounds_columns(link.load(spark, query=probes))
        for name in ("max_key", "min_key"):
            check_key_type(key, probe.schema[name].dataType)
        bounds.update({r["shard_no"]: KeyBounds.of(r["min_key"], r["max_key"]) for r in probe.collect()})
    shards = {}
    for i, table in enumerate(tables):
        predicates = mod_predicates(key, n, where) if by == "residues" else range_predicates(key, bounds[i], n, where)
        if refine:
            predicates = refine_predicates(predicates, *refine)
        rows = spark.read.jdbc(link.url, table, predicates=predicates, properties=link.properties())
        shards[table] = select_list(rows, columns) if columns else rows
    return shards
