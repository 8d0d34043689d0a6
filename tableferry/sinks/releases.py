"""Publishing many partitions at once: readers see all of a load, or nothing of it.

A released table is a folder. Files of a load go to a folder of their own and are never
changed; a manifest, written last and under a number that only one writer can take, says
which folder holds each partition. Partitions that a load does not touch stay in the
folders of earlier loads, so a load writes its own rows only. For SQL a view is pointed, by
one statement, at a catalog table made of the partitions of one release.

A load that dies leaves the manifest as it was; files it left are removed by
:func:`clear_releases`. One that dies between manifest and view is finished by the next
load, or by :func:`point_view`. A load that names itself is not done twice.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.operators.columns import normalize_types, quoted
from tableferry.session import filesystem, scratch_dir
from tableferry.sinks.tables import NULL_PARTITION, PARTITIONS_PER_STATEMENT, _any_partition, _spec_sql, _text

REPORT = "release int, partition string, n_rows bigint"
_DATA, _MANIFESTS = "data", "releases"


class ReleaseConflict(RuntimeError):
    """Another load took the number of this one, and touched partitions that this one read or wrote."""


@dataclass(frozen=True)
class Part:
    """One partition of a release: its values by key, the folder below the table's that holds it, its rows."""

    values: tuple[str | None, ...]
    folder: str
    n_rows: int


@dataclass(frozen=True)
class Release:
    """A whole state of the table. Number 0 is the empty table before the first load."""

    number: int
    keys: tuple[str, ...] = ()
    schema: str = ""
    load: str = ""
    touched: tuple[tuple[str | None, ...], ...] = ()
    parts: tuple[Part, ...] = field(default=())

    def text(self) -> str:
        return json.dumps(asdict(self), separators=(",", ":"))

    @staticmethod
    def of(text: str) -> Release:
        found = json.loads(text)
        parts = tuple(Part(tuple(p["values"]), p["folder"], p["n_rows"]) for p in found.pop("parts"))
        touched = tuple(tuple(t) for t in found.pop("touched"))
        return Release(keys=tuple(found.pop("keys")), parts=parts, touched=touched, **found)

    @property
    def columns(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema)) if self.schema else T.StructType()


def _manifest(number: int) -> str:
    return f"{number:012d}.json"


def _read_text(spark: SparkSession, location: str) -> str:
    fs, path = filesystem(spark, location)
    stream = fs.open(path)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def _numbers(spark: SparkSession, table: str) -> list[int]:
    """Numbers of the releases whose manifests are there, ascending."""
    fs, path = filesystem(spark, f"{table}/{_MANIFESTS}")
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())


def release(spark: SparkSession, table: str, number: int | None = None) -> Release:
    """A release of the table, by default the last; number 0 is empty."""
    numbers = _numbers(spark, table)
    number = (numbers[-1] if numbers else 0) if number is None else number
    if number == 0:
        return Release(0)
    if number not in numbers:
        raise ValueError(f"{table} has no release {number}")
    return Release.of(_read_text(spark, f"{table}/{_MANIFESTS}/{_manifest(number)}"))


def _put(spark: SparkSession, table: str, made: Release) -> bool:
    """Write a manifest under its number; False if the number is taken.

    The text is written beside and renamed without overwriting, so that no reader finds half of it.
    """
    folder = f"{table}/{_MANIFESTS}"
    fs, path = filesystem(spark, folder)
    fs.mkdirs(path)
    _, draft = filesystem(spark, f"{folder}/.draft-{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(made.text().encode()))
    finally:
        stream.close()
    jvm = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(getattr(jvm, "Options$Rename"), 1)
    options[0] = getattr(getattr(jvm, "Options$Rename"), "NONE")
    _, final = filesystem(spark, f"{folder}/{_manifest(made.number)}")
    context = jvm.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(final), options)
        return True
    except Exception as error:
        fs.delete(draft, False)
        if "FileAlreadyExists" in str(error) or fs.exists(final):
            return False
        raise


def _reader(spark: SparkSession, table: str, found: Release, parts: Sequence[Part]) -> DataFrame:
    """Rows of some partitions of a release; partition values come from the folders and stay text."""
    columns = found.columns
    if not parts:
        return spark.createDataFrame([], columns)
    # Folders end in key=value; those of one load have the same base.
    loads: dict[str, list[str]] = {}
    for part in parts:
        loads.setdefault(part.folder.split("/")[0], []).append(f"{table}/{_DATA}/{part.folder}")
    frames = [
        spark.read.schema(columns).option("basePath", f"{table}/{_DATA}/{load}").parquet(*folders)
        for load, folders in sorted(loads.items())
    ]
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


def read_release(spark: SparkSession, table: str, number: int | None = None) -> DataFrame:
    """All rows of one release, by default the last: data columns, then partition keys as text.

    What is read does not change while later loads are published, until its files are cleared.
    """
    found = release(spark, table, number)
    return _reader(spark, table, found, found.parts)


def _written(rows: DataFrame, table: str, load: str, keys: Sequence[str]) -> dict[tuple[str | None, ...], int]:
    """Write a load's files below a folder of its own; rows by partition.

    Rows are counted as they are written, from partial sums of the same pass.
    """
    folder = f"{table}/{_DATA}/{load}"
    seen = Observation()
    if not keys:
        rows.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(folder)
        n = seen.get["n"]
        return {(): n} if n else {}
    rows.write.partitionBy(*keys).parquet(folder)
    schema = T.StructType([f for f in rows.schema.fields if f.name not in keys])
    path = F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("folder")
    # Counts need the footers of the new files only.
    counted = rows.sparkSession.read.schema(schema).option("recursiveFileLookup", "true").parquet(folder)
    out: dict[tuple[str | None, ...], int] = {}
    for r in counted.groupBy(path).agg(F.count(F.lit(1)).alias("n")).collect():
        pairs = dict(p.split("=", 1) for p in unquote(r["folder"]).split("/")[-len(keys) :])
        values = tuple(None if pairs[k] == NULL_PARTITION else unquote(pairs[k]) for k in keys)
        out[values] = out.get(values, 0) + r["n"]
    return out


def _folder(load: str, keys: Sequence[str], values: Sequence[str | None], spark: SparkSession) -> str:
    escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return "/".join([load, *(escaped.getPartitionPathString(k, v) for k, v in zip(keys, values))])


def _merged_schema(old: Release, new: T.StructType, keys: Sequence[str]) -> T.StructType:
    """Columns of the table so far and new ones behind them; a changed type or key is refused."""
    if old.number and list(old.keys) != list(keys):
        raise ValueError(f"the table is partitioned by {list(old.keys)}, not {list(keys)}")
    known = {f.name: f for f in old.columns.fields if f.name not in keys}
    for f in new.fields:
        if f.name in known and known[f.name].dataType != f.dataType:
            raise ValueError(f"column {f.name} is {known[f.name].dataType.simpleString()}, not {f.dataType.simpleString()}")
    added = [f for f in new.fields if f.name not in known and f.name not in keys]
    return T.StructType([*known.values(), *added, *(T.StructField(k, T.StringType()) for k in keys)])


def publish(
    df: DataFrame,
    table: str,
    keys: Sequence[str] = (),
    load: str | None = None,
    replace: Sequence[Mapping[str, str]] = (),
    delete_where: str | Column | None = None,
    view: str | None = None,
    attempts: int = 5,
) -> DataFrame:
    """Publish a load as the next release of the table at a folder; ``release, partition, n_rows`` of what it touched.

    Without ``delete_where`` every partition that ``df`` has rows for is replaced, and those named in
    ``replace`` even if it has none for them (they are then empty). With it, rows for which the condition
    holds are removed and ``df`` is added; only partitions with such rows, or with new ones, are written,
    and rows for which the condition is null stay. A table without ``keys`` is one partition.

    A ``load`` that is published already is not published again: its report is returned and no row is
    computed. If another load was published meanwhile, this one is put behind it if the two share no
    partition; else :class:`ReleaseConflict` is raised and nothing is changed. ``view`` names a view that
    is pointed at the new release.
    """
    spark, keys, load = df.sparkSession, list(keys), load or uuid.uuid4().hex
    absent = set(keys) - set(df.columns)
    if absent:
        raise ValueError(f"rows need the partition columns {sorted(absent)}")
    base = release(spark, table)
    done = _published(spark, table, load)
    if done is None:
        rows = normalize_types(df.drop(*keys)).columns
        data = normalize_types(df).select(*[quoted(c) for c in rows], *[F.col(quoted(k)).cast("string").alias(k) for k in keys])
        columns = _merged_schema(base, data.schema, keys)
        lost: list[Part] = []
        if delete_where is not None:
            condition = F.expr(delete_where) if isinstance(delete_where, str) else delete_where
            data, lost = _with_survivors(spark, data, table, base, condition, keys, columns)
        named = [tuple(str(spec[k]) for k in keys) for spec in replace]
        # The folder carries no meaning beyond its name, so a run that died before leaves one nobody reads.
        folder = f"{quote(load, safe='')}-{uuid.uuid4().hex[:8]}"
        counts = _written(data, table, folder, keys)
        # A table without keys is replaced even by no rows.
        touched = {*counts, *named, *(p.values for p in lost), *([()] if not keys else [])}
        fresh = {v: Part(v, _folder(folder, keys, v, spark), n) for v, n in counts.items()}
        done = _committed(spark, table, base, load, keys, columns, touched, fresh, attempts)
    if view:
        point_view(spark, table, view)
    rows_of = {p.values: p.n_rows for p in done.parts}
    report = [(done.number, "/".join(f"{k}={v}" for k, v in zip(keys, t)), rows_of.get(t, 0)) for t in done.touched]
    return spark.createDataFrame(report, REPORT)


def _published(spark: SparkSession, table: str, load: str) -> Release | None:
    """The release that a load made, if it is published."""
    for number in reversed(_numbers(spark, table)):
        found = release(spark, table, number)
        if found.load == load:
            return found
    return None


def _committed(spark, table, base, load, keys, columns, touched, fresh, attempts) -> Release:
    """Put the manifest behind the last one; what others changed meanwhile must be other partitions."""
    last = base
    for _ in range(attempts):
        parts = [p for p in last.parts if p.values not in touched] + list(fresh.values())
        made = Release(
            last.number + 1, tuple(keys), json.dumps(columns.jsonValue()), load,
            tuple(sorted(touched, key=repr)), tuple(sorted(parts, key=lambda p: repr(p.values))),
        )
        if _put(spark, table, made):
            return made
        for number in range(last.number + 1, release(spark, table).number + 1):
            other = release(spark, table, number)
            shared = touched & set(other.touched)
            if shared:
                raise ReleaseConflict(f"release {number} of {table} has changed {sorted(shared, key=repr)} meanwhile")
            columns, last = _merged_schema(other, columns, keys), other
    raise ReleaseConflict(f"{table} was published {attempts} times meanwhile")


def _with_survivors(spark, data, table, base, condition, keys, columns) -> tuple[DataFrame, list[Part]]:
    """New rows and those that stay in the partitions that change, and the partitions that lose rows."""
    path = scratch_dir(spark, "incoming")
    data.write.parquet(path)
    data = spark.read.schema(data.schema).parquet(path)
    whole = Release(base.number, base.keys, json.dumps(columns.jsonValue()), base.load, (), base.parts)
    stored = _reader(spark, table, whole, base.parts)
    names = [quoted(k) for k in keys]
    if keys:
        hit = stored.where(condition).select(names).union(data.select(names)).distinct()
        losing = {tuple(r) for r in stored.where(condition).select(names).distinct().collect()}
        changed = {tuple(r) for r in hit.collect()}
    else:
        losing = changed = {()}
    parts = [p for p in base.parts if p.values in changed]
    # Only folders that are written again are read.
    kept = _reader(spark, table, whole, parts).where(~F.coalesce(condition, F.lit(False)))
    return kept.unionByName(data, allowMissingColumns=True), [p for p in base.parts if p.values in losing]


def point_view(spark: SparkSession, table: str, view: str) -> None:
    """Point a view at the last release, by one statement over a catalog table of its partitions.

    Repeating it, or a run that died in it, does no harm; readers see the old release or the new one.
    """
    found = release(spark, table)
    if not found.number:
        raise ValueError(f"{table} has no release")
    database, _, name = view.rpartition(".")
    prefix = f"{quoted(database)}." if database else ""
    own = f"{prefix}{quoted(f'{name}__r{found.number}')}"
    columns, keys = found.columns, list(found.keys)
    if not keys:
        location = f"{table}/{_DATA}/{found.parts[0].folder}" if found.parts else None
    else:
        location = f"{table}/{_DATA}"
    if location is None:
        fs, path = filesystem(spark, f"{table}/{_DATA}/none")
        fs.mkdirs(path)
        location = f"{table}/{_DATA}/none"
    listed = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in columns.fields)
    by = f" PARTITIONED BY ({', '.join(map(quoted, keys))})" if keys else ""
    # A table of the same number that an earlier, broken attempt left may lack partitions: all are added again.
    spark.sql(f"CREATE TABLE IF NOT EXISTS {own} ({listed}) USING parquet{by} LOCATION {_text(location)}")
    if keys:
        clauses = [
            f"PARTITION ({_spec_sql(dict(zip(keys, p.values)))}) LOCATION {_text(f'{table}/{_DATA}/{p.folder}')}"
            for p in found.parts
        ]
        for start in range(0, len(clauses), PARTITIONS_PER_STATEMENT):
            some = " ".join(clauses[start : start + PARTITIONS_PER_STATEMENT])
            spark.sql(f"ALTER TABLE {own} ADD IF NOT EXISTS {some}")
        spark.catalog.refreshTable(own)
    spark.sql(f"CREATE OR REPLACE VIEW {prefix}{quoted(name)} AS SELECT * FROM {own}")


def clear_releases(spark: SparkSession, table: str, keep: int = 2, view: str | None = None) -> list[str]:
    """Remove all but the last ``keep`` releases and the folders that none of those reads; the folders removed.

    Not while a load is being written: its folder is one that no manifest names yet.
    """
    if keep < 1:
        raise ValueError("at least one release must be kept")
    numbers = _numbers(spark, table)
    old, kept = numbers[:-keep], [release(spark, table, n) for n in numbers[-keep:]]
    used = {p.folder.split("/")[0] for r in kept for p in r.parts}
    for number in old:
        if view:
            database, _, name = view.rpartition(".")
            spark.sql(f"DROP TABLE IF EXISTS {f'{quoted(database)}.' if database else ''}{quoted(f'{name}__r{number}')}")
        fs, path = filesystem(spark, f"{table}/{_MANIFESTS}/{_manifest(number)}")
        fs.delete(path, False)
    fs, data = filesystem(spark, f"{table}/{_DATA}")
    names = [s.getPath().getName() for s in fs.listStatus(data)] if fs.exists(data) else []
    gone = sorted(n for n in names if n not in used and n != "none")
    for name in gone:
        _, path = filesystem(spark, f"{table}/{_DATA}/{name}")
        fs.delete(path, True)
    return gone
