"""Publishing DataFrames as file tables of the session catalog, parquet where they are new.

A partition is written to a staging folder and moved into place when the job
commits, so a failed run leaves the old partition. Overwriting a table without
partitions clears it first, as Spark does. Nothing is shuffled unless a layout
is asked for: each write task writes the rows it read.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions.types import canonical_type, to_canonical
from tableferry.operators.columns import list_items, normalize_types, prune_columns, quoted, select_list
from tableferry.session import filesystem, scratch_dir, setting

SAVE_MODES = ("overwrite", "append", "ignore", "error")
OPEN_FILES = 16
PARTITIONS_PER_STATEMENT = 100
#: Formats whose files can be replaced partition by partition.
FILE_FORMATS = ("parquet", "orc", "csv", "json")
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
REPORT = "table_name string, partition string, n_rows bigint"


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _listed(text: str | Sequence[str] | None) -> list[str]:
    if isinstance(text, str):
        return [item.strip() for item in text.split(",")] if text.strip() else []
    return [str(item) for item in text or ()]


def _unquoted(value: str) -> str:
    return value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "'\"" else value


def partition_spec(
    keys: Mapping[str, str] | str | Sequence[str] | None, values: str | Sequence[str] | None = None
) -> dict[str, str]:
    """Static partition values, from a mapping or from two lists of equal length.

    Values are text; in lists, quotes around a value are taken as quoting.
    """
    if isinstance(keys, Mapping):
        spec = {k: str(v) for k, v in keys.items()}
    else:
        names, texts = _listed(keys), _listed(values)
        if len(names) != len(texts):
            raise ValueError(f"{len(names)} partition keys but {len(texts)} values")
        spec = {name: _unquoted(text) for name, text in zip(names, texts)}
    blank = [name for name, value in spec.items() if not value]
    if blank:
        raise ValueError(f"partition values are blank: {blank}")
    return spec


def _spec_sql(spec: Mapping[str, str]) -> str:
    return ", ".join(f"{quoted(k)}={'null' if v is None else _text(str(v))}" for k, v in spec.items())


def _partition_keys(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def ensure_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    partition_keys: Sequence[str] = (),
    location: str | None = None,
) -> None:
    """Create the table if it is absent, else add the columns it lacks.

    Columns of a new table are stored as bigint, double or string with their
    comments; its partition keys are strings. Of an existing table a changed column
    type or partitioning is refused, and a format whose partitions cannot be replaced.
    """
    wanted = {f.name: f for f in schema.fields}
    clash = set(partition_keys) & set(wanted)
    if clash:
        raise ValueError(f"partition keys are also data columns: {sorted(clash)}")

    def declared(f: T.StructField) -> str:
        comment = f.metadata.get("comment", "")
        text = f"{quoted(f.name)} {canonical_type(f.dataType).simpleString()}"
        return f"{text} COMMENT {_text(comment)}" if comment else text

    if not spark.catalog.tableExists(table):
        columns = [declared(f) for f in schema.fields] + [f"{quoted(k)} string" for k in partition_keys]
        ddl = f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(columns)}) USING parquet"
        if partition_keys:
            ddl += f" PARTITIONED BY ({', '.join(map(quoted, partition_keys))})"
        if location and location.strip():
            ddl += f" LOCATION {_text(location.strip())}"
        spark.sql(ddl)
        return

    _described(spark, table)
    stored = spark.table(table).schema
    keys = _partition_keys(spark, table)
    if sorted(keys) != sorted(partition_keys):
        raise ValueError(f"{table} is partitioned by {keys}, not {list(partition_keys)}")
    present = {f.name: f.dataType for f in stored.fields}
    for name, f in wanted.items():
        if name in present and present[name] != canonical_type(f.dataType):
            raise ValueError(
                f"column {name} of {table} is {present[name].simpleString()}, "
                f"not {canonical_type(f.dataType).simpleString()}"
            )
    added = [declared(f) for name, f in wanted.items() if name not in present]
    if added:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(added)})")


def _laid_out(df: DataFrame, layout: int | str | None, keys: Sequence[str] = ()) -> DataFrame:
    """``None`` keeps the tasks as they are. ``"rebalance"`` brings the rows of a
    partition together and lets adaptive execution form files of even size, in
    several tasks where a partition is large. A number repartitions the rows
    evenly, whatever their partition."""
    if layout is None:
        return df
    if layout == "rebalance":
        return df.hint("rebalance", *[F.col(quoted(k)) for k in keys])
    return df.repartition(int(layout))


def _by_name(df: DataFrame, table: str) -> DataFrame:
    """The columns of ``df`` in the table's order; those it lacks are null. Partition keys get the table's types."""
    spark = df.sparkSession
    stored, keys = spark.table(table).schema, _partition_keys(spark, table)
    extra = set(df.columns) - set(stored.fieldNames())
    if extra:
        raise ValueError(f"{table} has no columns {sorted(extra)}")

    def column(f: T.StructField) -> Column:
        if f.name not in df.columns:
            return F.lit(None).cast(f.dataType).alias(f.name)
        found = F.col(quoted(f.name))
        return found.cast(f.dataType).alias(f.name) if f.name in keys and df.schema[f.name].dataType != f.dataType else found

    return df.select([column(f) for f in stored.fields])


def _described(spark: SparkSession, table: str) -> dict:
    """Location, format and type of a table; a format that is not files of rows is refused."""
    described = json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {table} AS JSON").collect()[0]["json_metadata"])
    if str(described.get("provider", "")).lower() not in FILE_FORMATS:
        raise ValueError(f"{table} is stored as {described.get('provider')}, not as one of {', '.join(FILE_FORMATS)}")
    return described


def table_location(spark: SparkSession, table: str) -> str:
    """Where the files of a table are."""
    return _described(spark, table)["location"]


def _format_options(described: Mapping) -> dict[str, str]:
    """Options a table was created with, such as a separator."""
    return {str(k): str(v) for k, v in (described.get("storage_properties") or {}).items() if k != "serialization.format"}


def _typed(spark: SparkSession, table: str, spec: Mapping[str, str]) -> dict[str, str]:
    """Partition values as the key's type writes them, in the table's order: ``05`` is ``5`` for a whole number."""
    fields = [f for f in spark.table(table).schema.fields if f.name in spec]
    if not fields:
        return {}
    cast = [F.lit(spec[f.name]).try_cast(f.dataType).cast("string").alias(f.name) for f in fields]
    values = spark.range(1).select(cast).first()
    for f in fields:
        if values[f.name] is None:
            raise ValueError(f"{f.name}={spec[f.name]} is no {f.dataType.simpleString()}")
    return {f.name: values[f.name] for f in fields}


def _files(spark: SparkSession, location: str) -> dict[str, set[str]]:
    """Data files below a folder, by the folder that holds them; nothing is read."""
    fs, path = filesystem(spark, location)
    found: dict[str, set[str]] = {}
    if not fs.exists(path):
        return found
    listing = fs.listFiles(path, True)
    while listing.hasNext():
        name = listing.next().getPath().toString()
        folder, _, file = name.rpartition("/")
        if not file.startswith(("_", ".")):
            found.setdefault(folder, set()).add(file)
    return found


def _values_of(folder: str, keys: Sequence[str]) -> tuple:
    """Partition values in a folder's name."""
    parts = dict(part.split("=", 1) for part in folder.split("/")[-len(keys) :])
    return tuple(None if parts[k] == NULL_PARTITION else unquote(parts[k]) for k in keys)


def _publish(
    df: DataFrame, table: str, keys: Sequence[str], spec: Mapping[str, str] | None = None
) -> tuple[int, dict[tuple, int]]:
    """Replace exactly the partitions ``df`` has rows for; returns rows written, in all and by partition.

    ``spec`` holds what is known of the partitions beforehand: only folders below it
    are listed, before and after the write. What was written is counted from the
    footers of the new files, so that the write itself is a plain one. Tasks keep a
    few files open instead of sorting their rows by partition: most write to one
    partition only, and Spark sorts by itself beyond that.
    """
    spark, described = df.sparkSession, _described(df.sparkSession, table)
    location, kind, options = described["location"], described["provider"].lower(), _format_options(described)
    rows = _by_name(df, table)
    if not keys:
        before = _files(spark, location)
        rows.write.mode("overwrite").insertInto(table)
        return _count_new(spark, table, described, before, _files(spark, location), ()).get((), 0), {}
    prefix = location + "".join(f"/{part}" for part in _leading(keys, spec or {}))
    before = _files(spark, prefix)
    # The mode is an option of this write, so parallel loads in one session do
    # not disturb each other; the partitions are then made known to the catalog.
    with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FILES)):
        (
            rows.write.mode("overwrite")
            .format(kind)
            .options(**options)
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*keys)
            .save(location)
        )
    counts = _count_new(spark, table, described, before, _files(spark, prefix), keys)
    _list_partitions(spark, table, keys, counts)
    return sum(counts.values()), counts


def _leading(keys: Sequence[str], spec: Mapping[str, str]) -> list[str]:
    """Folders of the first keys whose values are known and plain enough to be their own names."""
    out = []
    for k in keys:
        if k not in spec or not re.fullmatch(r"[\w.-]+", spec[k]):
            break
        out.append(f"{k}={spec[k]}")
    return out


def _count_new(spark, table, described, before, after, keys) -> dict[tuple, int]:
    """Rows of the files that were not there before, by partition; from footers where the format has them."""
    fresh = {folder: files - before.get(folder, set()) for folder, files in after.items()}
    paths = [f"{folder}/{file}" for folder, files in sorted(fresh.items()) for file in sorted(files)]
    if not paths:
        return {}
    schema = T.StructType([f for f in spark.table(table).schema.fields if f.name not in keys])
    reader = spark.read.format(described["provider"].lower()).options(**_format_options(described)).schema(schema)
    counted = reader.load(paths).groupBy(F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("folder"))
    counts: dict[tuple, int] = {}
    for r in counted.agg(F.count(F.lit(1)).alias("n")).collect():
        part = _values_of(unquote(r["folder"]) if keys else r["folder"], keys) if keys else ()
        counts[part] = counts.get(part, 0) + r["n"]
    return counts


def _list_partitions(spark: SparkSession, table: str, keys: Sequence[str], parts) -> None:
    """Make partitions known to the catalog, many with one statement."""
    listed = [f"PARTITION ({_spec_sql(dict(zip(keys, part)))})" for part in sorted(parts, key=repr)]
    for start in range(0, len(listed), PARTITIONS_PER_STATEMENT):
        some = " ".join(listed[start : start + PARTITIONS_PER_STATEMENT])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {some}")
    spark.catalog.refreshTable(table)


def _clear(spark: SparkSession, table: str, specs: Sequence[Mapping[str, str | None]]) -> None:
    """Forget partitions, many with one statement, and delete their files."""
    if not specs:
        return
    location, keys = table_location(spark, table), _partition_keys(spark, table)
    for start in range(0, len(specs), PARTITIONS_PER_STATEMENT):
        some = ", ".join(f"PARTITION ({_spec_sql(s)})" for s in specs[start : start + PARTITIONS_PER_STATEMENT])
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {some}")
    # Dropping a partition of a table at a location of its own leaves its files.
    path = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for spec in specs:
        folder = "/".join(path.getPartitionPathString(k, spec[k]) for k in keys)
        fs, where = filesystem(spark, f"{location}/{folder}")
        fs.delete(where, True)
    spark.catalog.refreshTable(table)


def _tagged(df: DataFrame, spec: Mapping[str, str]) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in spec.items()}) if spec else df


def _path(spec: Mapping[str, str]) -> str:
    return "/".join(f"{k}={v}" for k, v in spec.items())


def overwrite_partition(
    df: DataFrame,
    table: str,
    partition: Mapping[str, str] | str | Sequence[str] | None = None,
    columns: str | Sequence[str] | None = None,
    location: str | None = None,
    layout: int | str | None = None,
    on_overflow: str = "error",
    partition_values: str | Sequence[str] | None = None,
) -> DataFrame:
    """Replace one partition, or the whole table when none is named; other partitions stay.

    The partition is a mapping, or a list of keys with ``partition_values``. Columns
    are matched by name and stored in canonical types; the table is created or
    widened as needed, and written in its own format. Returns ``table_name,
    partition, n_rows``.
    """
    spark, spec = df.sparkSession, partition_spec(partition, partition_values)
    rows = normalize_types(select_list(df, columns) if columns else df, on_overflow)
    ensure_table(spark, table, rows.schema, list(spec), location)
    spec = _typed(spark, table, spec)
    n_rows, _ = _publish(_tagged(_laid_out(rows, layout), spec), table, list(spec), spec)
    if spec and n_rows == 0:
        _clear(spark, table, [spec])
    return spark.createDataFrame([(table, _path(spec), n_rows)], REPORT)


def _union_all(frames: list[DataFrame]) -> DataFrame:
    """A balanced union by position, so thousands of shards make no deep plan."""
    while len(frames) > 1:
        pairs = [frames[i : i + 2] for i in range(0, len(frames), 2)]
        frames = [reduce(DataFrame.union, pair) for pair in pairs]
    return frames[0]


#: The stored types in a chain: a value of each has a value of every later one.
_WIDER = (T.LongType(), T.DoubleType(), T.StringType())


def common_type(types: Iterable[T.DataType]) -> T.DataType:
    """The narrowest stored type that all the given ones widen to: bigint, then double, then string."""
    return _WIDER[max(_WIDER.index(canonical_type(t)) for t in types)]


def _shard_types(shards: Mapping[str, DataFrame], widen: bool, shard_column: str) -> dict[str, T.DataType]:
    """The type of each column over all shards."""
    found: dict[str, dict[T.DataType, str]] = {}
    for name, df in shards.items():
        for f in df.schema.fields:
            found.setdefault(f.name, {}).setdefault(canonical_type(f.dataType), name)
    if shard_column in found:
        raise ValueError(f"the shards already have a column {shard_column}")
    for c, kinds in found.items():
        if len(kinds) > 1 and not widen:
            (first, _), (other, name) = list(kinds.items())[:2]
            raise ValueError(f"column {c} is {first.simpleString()} but {other.simpleString()} in {name}")
    return {c: common_type(kinds) for c, kinds in found.items()}


def union_shards(shards: Mapping[str, DataFrame], shard_column: str = "shard", widen: bool = False) -> DataFrame:
    """All shards as one table, tagged by name; columns a shard lacks are null.

    Types are made canonical first, so shards may differ in integer width. Shards
    whose stored types differ are refused, or with ``widen`` take the narrowest type
    that holds both: bigint and double meet in double, anything and string in string
    (a number as Spark writes it: 5 of a bigint shard, 5.0 of a double one).
    :func:`widened_columns` counts what that costs.
    """
    types = _shard_types(shards, widen, shard_column)

    def column(fields: Mapping[str, T.StructField], c: str) -> Column:
        if c not in fields:
            return F.lit(None).cast(types[c]).alias(c)
        f = fields[c]
        return to_canonical(F.col(quoted(c)), f.dataType).cast(types[c]).alias(c, metadata=f.metadata)

    # One projection per shard keeps the planning of thousands of them cheap.
    aligned = []
    for name, df in shards.items():
        fields = {f.name: f for f in df.schema.fields}
        aligned.append(df.select(*[column(fields, c) for c in types], F.lit(name).alias(shard_column)))
    return _union_all(aligned)


def _inexact(whole: Column) -> Column:
    """Whether a bigint is another number as a double."""
    near = whole.cast("double")
    # The cast back of 2^63 saturates, and so would seem to give the greatest bigint.
    return (near >= F.lit(float(1 << 63))) | ~near.try_cast("bigint").eqNullSafe(whole)


def widened_columns(shards: Mapping[str, DataFrame]) -> DataFrame:
    """``shard, column_name, stored_type, merged_type, n_values, n_inexact`` for each column a merge widens.

    ``n_values`` counts values that are not null, ``n_inexact`` those whose merged value
    is another number (a bigint beyond 2^53 as a double). A shard without rows has zeros;
    shards of one type give no rows. One partial aggregate over all shards; the
    driver sees schemas only.
    """
    if not shards:
        raise ValueError("there are no shards to merge")
    spark = next(iter(shards.values())).sparkSession
    types = _shard_types(shards, True, "shard")
    plan, counted = [], []
    for name, df in shards.items():
        fields = [f for f in df.schema.fields if canonical_type(f.dataType) != types[f.name]]
        marks = []
        for f in fields:
            kind, merged = canonical_type(f.dataType), types[f.name]
            plan.append((name, f.name, kind.simpleString(), merged.simpleString()))
            value = to_canonical(F.col(quoted(f.name)), f.dataType)
            lossy = _inexact(value) if (kind, merged) == (T.LongType(), T.DoubleType()) else F.lit(False)
            present = value.isNotNull()
            marks.append(F.struct(F.lit(f.name).alias("column_name"), present.alias("present"), (present & lossy).alias("lossy")))
        if marks:
            counted.append(df.select(F.lit(name).alias("shard"), F.inline(F.array(*marks))))
    named = "shard string, column_name string, stored_type string, merged_type string"
    if not counted:
        return spark.createDataFrame([], f"{named}, n_values bigint, n_inexact bigint")
    sums = _union_all(counted).groupBy("shard", "column_name").agg(
        F.count_if("present").alias("n_values"), F.count_if("lossy").alias("n_inexact")
    )
    out = spark.createDataFrame(plan, named).join(sums, ["shard", "column_name"], "left")
    zero = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("n_values", "n_inexact")]
    return out.select("shard", "column_name", "stored_type", "merged_type", *zero)


def merge_shards(
    shards: Mapping[str, DataFrame],
    table: str,
    columns: str | Sequence[str] | None = None,
    partition: Mapping[str, str] | str | Sequence[str] | None = None,
    location: str | None = None,
    layout: int | str | None = None,
    partition_values: str | Sequence[str] | None = None,
    widen: bool = False,
) -> DataFrame:
    """Publish tables of one shape as partitions ``shard=<name>`` of one table, in one write.

    Only the partitions of the given shards change; a shard without rows has its
    old partition emptied. A plain list of names may name columns some shards
    lack. Types that differ are refused, or widened as in :func:`union_shards`; a table
    that exists keeps its types, so that one narrower than the shards is refused. Returns ``table_name, partition, n_rows`` per shard: what this merge wrote.
    """
    if not shards:
        raise ValueError("there are no shards to merge")
    spark, spec = next(iter(shards.values())).sparkSession, partition_spec(partition, partition_values)
    if columns:
        known = {c for df in shards.values() for c in df.columns}
        pick = prune_columns if known.issuperset(list_items(columns)) else select_list
        shards = {name: pick(df, columns) for name, df in shards.items()}
    merged = union_shards(shards, widen=widen)
    ensure_table(spark, table, merged.drop("shard").schema, [*spec, "shard"], location)
    spec, keys = _typed(spark, table, spec), _partition_keys(spark, table)
    stored = {name: _typed(spark, table, {"shard": name})["shard"] for name in shards} if not _is_text(spark, table) else {n: n for n in shards}
    _, counts = _publish(_tagged(_laid_out(merged, layout, ["shard"]), spec), table, keys, spec)
    place = keys.index("shard")
    written = {part[place]: n for part, n in counts.items()}
    _clear(spark, table, [{**spec, "shard": value} for value in stored.values() if value not in written])
    prefix = f"{_path(spec)}/" if spec else ""
    report = [(table, f"{prefix}shard={name}", written.get(value, 0)) for name, value in stored.items()]
    return spark.createDataFrame(report, REPORT)


def _is_text(spark: SparkSession, table: str) -> bool:
    return spark.table(table).schema["shard"].dataType == T.StringType()


def save_files(df: DataFrame, path: str, mode: str = "append", layout: int | str | None = None) -> None:
    """Write parquet files under one of the four save modes."""
    if mode not in SAVE_MODES:
        raise ValueError(f"save mode must be one of {', '.join(SAVE_MODES)}, got {mode}")
    _laid_out(df, layout).write.mode(mode).parquet(path)


def _any_partition(keys: Sequence[str], parts: list[tuple]) -> Column:
    """True for rows of the given partitions; a balanced condition however many there are."""
    if not parts:
        return F.lit(False)
    if len(parts) == 1:
        return reduce(
            lambda a, b: a & b, [F.col(quoted(k)).eqNullSafe(F.lit(v)) for k, v in zip(keys, parts[0])]
        )
    half = len(parts) // 2
    return _any_partition(keys, parts[:half]) | _any_partition(keys, parts[half:])


def _next_version(location: str) -> str:
    """A sibling of a table's folder; the mark of an earlier version is replaced."""
    return f"{re.sub(r'__v_[0-9a-f]{32}$', '', location.rstrip('/'))}__v_{uuid.uuid4().hex}"


class _Doomed:
    """Key values whose rows are to go: distinct, in the types of the table, staged once."""

    def __init__(self, keys: DataFrame, schema: T.StructType, on, null_safe: bool):
        names = {on: on} if isinstance(on, str) else on if isinstance(on, Mapping) else {c: c for c in on or ()}
        absent = [c for c in names if c not in schema.names] + [c for c in names.values() if c not in keys.columns]
        if not names or absent:
            raise ValueError(f"delete_keys needs columns to compare; these are absent: {absent}" if absent else "delete_keys needs on")
        # Renamed, so that no name of the table is ambiguous in a condition.
        self.pairs = {c: f"__doomed_{i}" for i, c in enumerate(names)}
        chosen = normalize_types(keys.select(*[F.col(quoted(theirs)).alias(self.pairs[ours]) for ours, theirs in names.items()]))
        columns = []
        for ours, own in self.pairs.items():
            has, wants = chosen.schema[own].dataType, schema[ours].dataType
            if has != wants and wants != T.StringType():
                raise ValueError(f"key {ours} is {wants.simpleString()} in the table but {has.simpleString()} in delete_keys")
            columns.append(F.col(own).cast(wants).alias(own))
        self.null_safe = null_safe
        chosen = chosen.select(columns)
        path = scratch_dir(keys.sparkSession, "doomed")
        (chosen if null_safe else chosen.dropna()).distinct().write.parquet(path)
        self.keys = keys.sparkSession.read.schema(chosen.schema).parquet(path)
        ends = [f(c).alias(f"{n}{c}") for c in self.pairs.values() for n, f in (("lo", F.min), ("hi", F.max))]
        self.ends = self.keys.agg(*ends).first()

    def _same(self, also: Column | None) -> Column:
        tests = [F.col(quoted(c)).eqNullSafe(F.col(k)) if self.null_safe else F.col(quoted(c)) == F.col(k) for c, k in self.pairs.items()]
        return reduce(lambda a, b: a & b, tests if also is None else [*tests, also])

    def _between(self, column: str, key: str) -> Column:
        """Between the least and the greatest key: literals that prune partitions and row groups before the join does."""
        low, high = self.ends[f"lo{key}"], self.ends[f"hi{key}"]
        column = F.col(quoted(column)) if column in self.pairs else F.col(column)
        inside = F.lit(False) if low is None else (column >= F.lit(low)) & (column <= F.lit(high))
        return inside | column.isNull() if self.null_safe else inside

    def lost(self, stored: DataFrame, also: Column | None) -> DataFrame:
        """Rows that go. With a range on both sides Spark also filters partitions by the keys it finds at run time."""
        keys = self.keys
        for ours, own in self.pairs.items():
            stored, keys = stored.where(self._between(ours, own)), keys.where(self._between(own, own))
        return stored.join(keys, self._same(also), "left_semi")

    def kept(self, stored: DataFrame, also: Column | None) -> DataFrame:
        """All other rows, those with a null condition too."""
        return stored.join(self.keys, self._same(also), "left_anti")


def delete_then_write(
    df: DataFrame,
    table: str,
    delete_where: str | Column | None = None,
    keep_replaced: bool | None = None,
    delete_keys: DataFrame | None = None,
    on: Mapping[str, str] | Sequence[str] | str | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Remove the rows matching ``delete_where``, then append ``df``.

    With ``delete_keys`` only rows go whose columns ``on`` (names of the table, or a
    mapping of them to names of ``delete_keys``) have their values in one of its rows;
    a null is in none, unless ``null_safe``. The keys are made distinct and stored
    once, may be more than fit a broadcast, and bound what is read of the table.

    Rows for which the condition is null stay. Incoming rows are computed once and
    staged in the shared folder. Of a partitioned table, partitions that lose rows
    are rewritten first, together with their new rows; then the others are appended
    to. Without partitions, the new content is written beside the old and the table
    pointed at it, so a failure changes nothing; if no row matches, rows are only
    appended. The old content is then deleted, unless it is to be kept
    (``keep_replaced``; by default that of tables at a location of their own).
    Returns ``table_name, partition, n_rows`` and the ``replaced_location``.
    """
    spark = df.sparkSession
    rows = normalize_types(df)
    is_new = not spark.catalog.tableExists(table)
    keys = [] if is_new else _partition_keys(spark, table)
    absent = set(keys) - set(df.columns)
    if absent:
        raise ValueError(f"rows for {table} need the partition columns {sorted(absent)}")
    ensure_table(spark, table, rows.drop(*keys).schema, keys)
    if isinstance(delete_where, str):
        delete_where = F.expr(delete_where) if delete_where.strip() else None
    rows = _by_name(rows, table)
    doomed = None if delete_keys is None else _Doomed(delete_keys, spark.table(table).schema, on, null_safe)
    if is_new or (delete_where is None and doomed is None):
        return _delete_report(spark, table, _append(rows, table, keys), None)

    path = scratch_dir(spark, "incoming")
    rows.write.parquet(path)
    staged, stored = spark.read.schema(rows.schema).parquet(path), spark.table(table)
    if doomed:
        lost, kept = doomed.lost(stored, delete_where), doomed.kept(stored, delete_where)
    else:
        lost, kept = stored.where(delete_where), stored.where(~F.coalesce(delete_where, F.lit(False)))
    if keys:
        names = [quoted(k) for k in keys]
        touched = [tuple(r) for r in lost.select(names).distinct().collect()]
        # Literal values prune the scan to the partitions that will be written again.
        concerned = _any_partition(keys, sorted(touched, key=repr))
        n_rows = 0
        if touched:
            n_rows, written = _publish(kept.where(concerned).unionByName(staged.where(concerned)), table, keys)
            emptied = {_as_text(spark, table, keys, part) for part in touched} - set(written)
            _clear(spark, table, [dict(zip(keys, part)) for part in sorted(emptied, key=repr)])
        n_rows += _append(staged.where(~concerned), table, keys)
        return _delete_report(spark, table, n_rows, None)

    if lost.isEmpty():
        return _delete_report(spark, table, _append(staged, table, keys), None)
    described = _described(spark, table)
    old, kind, options = described["location"], described["provider"].lower(), _format_options(described)
    new = _next_version(old)
    kept.unionByName(staged).write.format(kind).options(**options).save(new)
    n_rows = _count_new(spark, table, described, {}, _files(spark, new), ()).get((), 0)
    spark.sql(f"ALTER TABLE {table} SET LOCATION {_text(new)}")
    if keep_replaced is None:
        keep_replaced = str(described.get("type", "")).upper() == "EXTERNAL" and "__v_" not in old.rpartition("/")[2]
    if not keep_replaced:
        fs, folder = filesystem(spark, old)
        fs.delete(folder, True)
    return _delete_report(spark, table, n_rows, old)


def _as_text(spark: SparkSession, table: str, keys: Sequence[str], part: tuple) -> tuple:
    """Partition values as their folders name them."""
    types = {f.name: f.dataType for f in spark.table(table).schema.fields}
    if all(types[k] == T.StringType() for k in keys):
        return part
    cast = [F.lit(v).cast(types[k]).cast("string").alias(k) for k, v in zip(keys, part)]
    return tuple(spark.range(1).select(cast).first())


def _append(rows: DataFrame, table: str, keys: Sequence[str]) -> int:
    """Append rows and return their number; new partitions are made known by the insert."""
    spark = rows.sparkSession
    described = _described(spark, table)
    before = _files(spark, described["location"])
    with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FILES)):
        rows.write.insertInto(table)
    return sum(_count_new(spark, table, described, before, _files(spark, described["location"]), keys).values())


def _delete_report(spark: SparkSession, table: str, n_rows: int, old: str | None) -> DataFrame:
    return spark.createDataFrame([(table, "", n_rows, old)], REPORT + ", replaced_location string")
