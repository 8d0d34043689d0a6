"""Documents as rows, with a declared schema or one found in the data."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.operators.columns import quoted

SchemaSpec = T.StructType | Mapping | str


def _nested(spec) -> T.DataType:
    if isinstance(spec, Mapping):
        return T.StructType([T.StructField(name, _nested(kind)) for name, kind in spec.items()])
    if isinstance(spec, (list, tuple)):
        if len(spec) != 1:
            raise ValueError("an array is described by exactly one element type")
        return T.ArrayType(_nested(spec[0]))
    return T.DataType.fromDDL(spec)


def document_schema(spec: SchemaSpec) -> T.StructType:
    """A schema from a StructType, DDL text, or JSON such as
    ``{"name": "string", "tags": ["string"], "place": {"lat": "double"}}``."""
    if isinstance(spec, T.StructType):
        return spec
    if isinstance(spec, str):
        if not spec.lstrip().startswith("{"):
            return T.StructType.fromDDL(spec)
        spec = json.loads(spec)
    if spec.get("type") == "struct" and isinstance(spec.get("fields"), list):
        return T.StructType.fromJson(spec)
    return _nested(spec)


CORRUPT = "_unreadable"


def _check_on_bad(on_bad: str) -> None:
    if on_bad not in ("error", "null"):
        raise ValueError(f"on_bad must be error or null, got {on_bad}")


def read_documents(
    spark: SparkSession, path: str, schema: SchemaSpec | None = None, on_bad: str = "error"
) -> DataFrame:
    """A folder of JSON documents, one per line; with no schema all of them are inspected.

    A line that is no document, or holds a value of another type, is an error, or with
    ``on_bad="null"`` a row of nulls; :func:`unreadable_documents` counts those.
    """
    _check_on_bad(on_bad)
    reader = spark.read.option("columnNameOfCorruptRecord", CORRUPT)
    if on_bad == "error":
        reader = reader.option("mode", "FAILFAST")
        return (reader.schema(document_schema(schema)) if schema is not None else reader).json(path)
    found = document_schema(schema) if schema is not None else reader.json(path).schema
    kept = T.StructType([f for f in found.fields if f.name != CORRUPT])
    rows = reader.schema(T.StructType([*kept.fields, T.StructField(CORRUPT, T.StringType())])).json(path)
    whole = F.col(CORRUPT).isNull()
    return rows.select([F.when(whole, F.col(quoted(f.name))).alias(f.name) for f in kept.fields])


def unreadable_documents(spark: SparkSession, path: str, schema: SchemaSpec) -> DataFrame:
    """``n_documents, n_unreadable`` of a folder of JSON lines under a schema."""
    return _readability(spark.read.text(path), "value", document_schema(schema))


def unreadable_texts(df: DataFrame, column: str, schema: SchemaSpec) -> DataFrame:
    """``n_documents, n_unreadable`` of a JSON text column; null texts are no documents."""
    return _readability(df, column, document_schema(schema))


def _parsed(column: Column, struct: T.StructType) -> tuple[Column, Column]:
    """The struct a text describes, and whether it does not fit; nested under one field to carry both."""
    marked = T.StructType([*struct.fields, T.StructField(CORRUPT, T.StringType())])
    value = F.from_json(column, marked, {"columnNameOfCorruptRecord": CORRUPT})
    bad = column.isNotNull() & (value.isNull() | value[CORRUPT].isNotNull())
    return value.dropFields(CORRUPT), bad


def _readability(df: DataFrame, column: str, struct: T.StructType) -> DataFrame:
    text = F.col(quoted(column))
    _, bad = _parsed(text, struct)
    return df.agg(F.count(text).alias("n_documents"), F.count_if(bad).alias("n_unreadable"))


def read_collection(
    spark: SparkSession,
    uri: str,
    database: str,
    collection: str,
    schema: SchemaSpec | None = None,
    **options: str,
) -> DataFrame:
    """A collection of a document store, through the ``mongodb`` data source.

    The connector must be on the cluster's class path. Without a schema it
    infers one.
    """
    reader = spark.read.format("mongodb").options(
        **{"connection.uri": uri, "database": database, "collection": collection, **options}
    )
    if schema is not None:
        reader = reader.schema(document_schema(schema))
    return reader.load()


# Outside back-quoted names, variant types read as column types after these replacements.
_VARIANT_WORDS = {"OBJECT": "STRUCT", "VOID": "STRING"}


def _is_object(parsed: Column) -> Column:
    return F.schema_of_variant(parsed).startswith("OBJECT<")


def inferred_schema(df: DataFrame, column: str, objects_only: bool = False) -> T.StructType:
    """The merged schema of all documents in a text column, from one aggregate over all rows.

    A field whose types have nothing in common is a variant. With ``objects_only``
    other documents are passed over, and no objects at all give no fields.
    """
    parsed = F.try_parse_json(F.col(quoted(column)))
    if objects_only:
        parsed = F.when(_is_object(parsed), parsed)
    found = df.agg(F.schema_of_variant_agg(parsed).alias("schema")).first()["schema"]
    if objects_only and found in (None, "VOID", "OBJECT<>"):
        return T.StructType()
    if found is None or not found.startswith("OBJECT<"):
        raise ValueError(f"column {column} holds no JSON objects of one shape: {found}")
    parts = re.split(r"(`(?:[^`]|``)*`)", found)
    for i in range(0, len(parts), 2):
        for word, name in _VARIANT_WORDS.items():
            # A type stands before < or after a colon; a field name stands before a colon.
            parts[i] = re.sub(rf"\b{word}\b(?!\s*:)", name, parts[i])
    return T.DataType.fromDDL("".join(parts))


def parse_documents(
    df: DataFrame, column: str, schema: SchemaSpec | None = None, on_bad: str = "error"
) -> DataFrame:
    """Replace a JSON text column by the struct it describes.

    Text that does not fit the schema is an error, or null with ``on_bad="null"``;
    :func:`unreadable_texts` counts it. Null texts stay null.
    """
    _check_on_bad(on_bad)
    struct = document_schema(schema) if schema is not None else inferred_schema(df, column)
    text = F.col(quoted(column))
    value, bad = _parsed(text, struct)
    if on_bad == "null":
        value = F.when(~bad, value)
    else:
        value = F.when(bad, F.raise_error(F.concat(F.lit(f"unreadable document in {column}: "), text))).otherwise(value)
    return df.withColumn(column, value)


def parse_mixed(df: DataFrame, column: str, rest: str | None = None, on_bad: str = "error") -> DataFrame:
    """Replace a JSON text column of documents of several shapes by the struct of its objects and a variant.

    Fields of one type over all objects are typed, at any depth; fields whose type
    differs are variants. Documents that are no object (arrays, texts, numbers, the JSON
    null) are in the variant column ``rest`` (``<column>_rest`` if not named) and have a
    null struct; objects have a null there. Null texts are null in both. Text that is no
    JSON is an error, or null in both with ``on_bad="null"``. An empty table, or one
    without objects, gives a struct with no fields.
    """
    _check_on_bad(on_bad)
    rest = rest or f"{column}_rest"
    if rest in df.columns:
        raise ValueError(f"there already is a column {rest}")
    struct, text = inferred_schema(df, column, objects_only=True), F.col(quoted(column))
    parsed = F.try_parse_json(text)
    is_object = F.coalesce(_is_object(parsed), F.lit(False))
    value, misfit = _parsed(text, struct) if struct.fields else (F.struct(), F.lit(False))
    bad = text.isNotNull() & (parsed.isNull() | (is_object & misfit))
    fits = F.when(is_object & ~bad, value)
    if on_bad == "error":
        fits = F.when(bad, F.raise_error(F.concat(F.lit(f"unreadable document in {column}: "), text))).otherwise(fits)
    return df.withColumns({column: fits, rest: F.when(~is_object, parsed)})


def read_mixed_documents(spark: SparkSession, path: str, on_bad: str = "error") -> DataFrame:
    """A folder of JSON documents of several shapes, one per line: a column per field of the objects, and ``_rest``.

    As :func:`parse_mixed`; blank lines are no documents.
    """
    lines = spark.read.text(path).where("value rlike '[^ \\t\\r]'")
    rows = parse_mixed(lines, "value", "_rest", on_bad)
    names = rows.schema["value"].dataType.names
    if "_rest" in names:
        raise ValueError("a field of the documents is named _rest")
    return rows.select(*[F.col(f"value.{quoted(n)}") for n in names], "_rest")
