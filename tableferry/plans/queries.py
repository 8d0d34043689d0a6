"""The registered queries: each operator over the whole of the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.functions.text import register_functions
from tableferry.operators.columns import normalize_types, prune_columns, select_list, substring_column
from tableferry.operators.conform import conform, conform_report, target_schema
from tableferry.operators.depth import with_depth_split
from tableferry.operators.keyed import keyed_entries, kv_hash, kv_set, kv_string
from tableferry.operators.splits import (
    KeyBounds,
    filtered,
    key_bounds,
    split_summary,
    with_mod_split,
    with_range_split,
)
from tableferry.operators.sqlstep import sql_step
from tableferry.plans.graph import JobGraph
from tableferry.plans.job import Job, preview
from tableferry.session import scratch_dir
from tableferry.sinks.bulk import batch_plan, write_bulk
from tableferry.sinks.changes import publish_changes
from tableferry.sinks.datasource import read_batches, write_batches
from tableferry.sinks.once import deliver_once
from tableferry.sinks.releases import publish, read_release
from tableferry.sinks.stores import publish_conformed, publish_keyed
from tableferry.sinks.tables import (
    SAVE_MODES,
    delete_then_write,
    ensure_table,
    merge_shards,
    overwrite_partition,
    save_files,
    table_location,
    widened_columns,
)
from tableferry.sources.catalog import column_report, list_tables, with_comments
from tableferry.sources.documents import parse_documents, parse_mixed, read_documents, read_mixed_documents, unreadable_texts

Query = Callable[[SparkSession, str], DataFrame]

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()
SPLITS = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


class _Target:
    """A new table in the shared folder, and what was stored in it.

    The catalog entry is dropped once the table is written; its files are read
    back with the table's own schema, so partition values stay text.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.location = scratch_dir(spark, name)
        self.name = f"tableferry_{name}_{uuid.uuid4().hex}"

    def stored(self, kind: str = "parquet") -> DataFrame:
        schema = self.spark.table(self.name).schema
        location = table_location(self.spark, self.name)
        self.spark.sql(f"DROP TABLE {self.name}")
        return self.spark.read.schema(schema).format(kind).load(location)


# --- reading ---------------------------------------------------------------


def q_key_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_bounds(table(spark, sf_dir, "orders"), "o_orderkey", "o_orderstatus = 'F'")


def q_scan_bounds_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return with_range_split(rows, "l_orderkey", SPLITS, bounds=KeyBounds(100, 1000))


def q_scan_range_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = with_range_split(table(spark, sf_dir, "orders"), "o_orderkey", SPLITS, where="o_orderstatus = 'F'")
    return split_summary(split, "o_orderkey")


def q_scan_depth_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by user in slices of equal depth, which hold the rows of any of them between none and twice the mean."""
    split = with_depth_split(table(spark, sf_dir, "events"), "user_id", SPLITS, second="event_id")
    slices = split_summary(split, "user_id")
    return slices.agg(
        F.sum("n_rows").alias("n_rows"),
        F.min("min_key").alias("min_key"),
        F.max("max_key").alias("max_key"),
        (F.max("n_rows") * SPLITS <= 2 * F.sum("n_rows")).alias("even"),
        (F.count(F.lit(1)) >= SPLITS).alias("enough"),
    )


def q_scan_mod_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = with_mod_split(table(spark, sf_dir, "orders"), "o_orderkey", SPLITS)
    return split.groupBy("split_id").agg(F.count(F.lit(1)).alias("n_rows"))


def q_scan_where_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = with_mod_split(
        table(spark, sf_dir, "orders"),
        "o_orderkey",
        SPLITS,
        where="o_orderstatus = 'F' or o_orderpriority = '1-URGENT'",
    )
    return split.groupBy("split_id").agg(F.count(F.lit(1)).alias("n_rows"))


def q_list_tables_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    _views(spark, sf_dir, *TABLES)
    # The names are catalog entries; rows are counted from file footers.
    names = [r.table_name for r in list_tables(spark, "^(PART|LINEITEM|ORDERS|CUSTOMER|NATION)$").collect()]
    counts = [
        spark.table(n).agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n_rows")) for n in sorted(names)
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.union(count)
    return result


def q_column_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    comments = {"c_custkey": "customer key", "c_name": "the customer's name", "c_acctbal": "balance"}
    commented = with_comments(table(spark, sf_dir, "customer"), comments)
    # Comments stay with their columns through later steps.
    kept = prune_columns(commented, "c_custkey,c_name,c_nationkey,c_acctbal")
    return column_report(kept).select("column_name", "comment", "n_values")


def q_doc_scan_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "props")
    return parse_documents(events, "props", '{"k": "bigint"}').select("event_id", F.col("props.k").alias("k"))


def q_doc_scan_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "props")
    return parse_documents(events, "props").select("event_id", F.col("props.k").alias("k"))


def _property_files(spark: SparkSession, sf_dir: str) -> str:
    """The properties of all events as a folder of JSON lines."""
    path = scratch_dir(spark, "documents")
    table(spark, sf_dir, "events").select("props").where("props is not null").write.text(path)
    return path


def q_doc_read_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_documents(spark, _property_files(spark, sf_dir), '{"k": "bigint"}')


def q_doc_read_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_documents(spark, _property_files(spark, sf_dir))


def q_doc_unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that are no document, counted and read as null."""
    events = table(spark, sf_dir, "events")
    cut = events.select(F.when(F.col("value") > 50, F.substring("props", 1, 5)).otherwise(F.col("props")).alias("props"))
    return unreadable_texts(cut, "props", "k bigint")


def _mixed_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The properties of all events in five shapes: k as number, text, list and absent, and no object at all."""
    events = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    shapes = [
        F.concat(F.lit('{"v":'), F.col("value").cast("decimal(12,2)"), F.lit(',"k":'), k, F.lit("}")),
        F.concat(F.lit('{"k":"'), k, F.lit('"}')),
        F.concat(F.lit('{"k":['), k, F.lit('],"v":null}')),
        F.concat(F.lit('{"t":"'), F.col("event_type"), F.lit('"}')),
        F.concat(F.lit("["), k, F.lit(',"x"]')),
    ]
    turn = F.pmod("event_id", F.lit(len(shapes)))
    return events.select("event_id", F.coalesce(*[F.when(turn == i, s) for i, s in enumerate(shapes)]).alias("props"))


def q_doc_scan_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose field k has several types, and arrays among them."""
    rows = parse_mixed(_mixed_properties(spark, sf_dir), "props")
    return rows.select(
        "event_id",
        F.col("props.v").cast("double").alias("v"),
        F.col("props.t").alias("t"),
        F.schema_of_variant("props.k").alias("k_type"),
        F.to_json("props.k").alias("k"),
        F.to_json("props_rest").alias("rest"),
    )


def q_doc_read_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "documents")
    _mixed_properties(spark, sf_dir).select("props").where("props is not null").write.text(path)
    rows = read_mixed_documents(spark, path)
    return rows.select(F.to_json("k").alias("k"), "t", F.col("v").cast("double").alias("v"), F.to_json("_rest").alias("rest"))


# --- columns ---------------------------------------------------------------


def q_prune_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prune_columns(table(spark, sf_dir, "customer"), "c_nationkey, c_custkey")


def q_select_list_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_list(
        table(spark, sf_dir, "customer"),
        "c_custkey, upper(c_mktsegment) as segment, concat(c_name, '/', c_mktsegment) as label",
    )


def q_substr_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return substring_column(customer, 9, source="c_name", target="x", pos=9).select("c_custkey", "x")


def q_derived_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_column(table(spark, sf_dir, "customer"), 8, source="c_name")


def q_udf_in_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_functions(spark)
    customer = table(spark, sf_dir, "customer")
    return sql_step(customer, "select c_custkey, my_sub(c_name, 9, 9) as x from customer", view="customer")


def q_normalize_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_types(table(spark, sf_dir, "lineitem"))


# --- SQL steps: the text asks for small intermediate results ---------------


def q_sql_join_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders are summed per customer before the join, so one customer with very
    many orders is a single row by the time rows move, and per nation before the
    names are joined; decimals make the sums exact."""
    _views(spark, sf_dir, "orders", "customer", "nation")
    return sql_step(
        spark,
        """
        with per_customer as (
          select o_custkey, count(*) as n, sum(cast(o_totalprice as decimal(18,2))) as total
          from orders group by o_custkey
        ),
        per_nation as (
          select c_nationkey, sum(n) as n, sum(total) as total
          from per_customer join customer on c_custkey = o_custkey
          group by c_nationkey
        )
        select n_name, sum(n) as n_orders, cast(sum(total) as double) as total_price
        from per_nation join nation on n_nationkey = c_nationkey
        group by n_name
        """,
    )


def q_sql_window_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    _views(spark, sf_dir, "events")
    return sql_step(
        spark,
        """
        select user_id, event_id, value, cast(rn as bigint) as rn
        from (select user_id, event_id, value,
                     row_number() over (partition by user_id order by value desc, event_id) as rn
              from events)
        where rn <= 3
        """,
    )


def q_sql_setop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides are made distinct in their own tasks before any row is shuffled."""
    _views(spark, sf_dir, "customer", "supplier")
    return sql_step(
        spark,
        "select distinct c_nationkey as k from customer intersect select distinct s_nationkey from supplier",
    )


def q_sql_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows are grouped once; only the groups are expanded to the three levels."""
    _views(spark, sf_dir, "lineitem")
    return sql_step(
        spark,
        """
        select l_returnflag, l_linestatus, sum(n) as n_rows
        from (select l_returnflag, l_linestatus, count(*) as n from lineitem group by all)
        group by rollup (l_returnflag, l_linestatus)
        """,
        partitions=1,
    )


def q_sql_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return sql_step(
        events,
        "select event_id, cast(ts as string) as ts, cast(value > 50 as bigint) as is_large from events",
        view="events",
    )


def q_preview_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(table(spark, sf_dir, "orders"), 100, order_by="o_orderkey")


# --- table sinks -----------------------------------------------------------


def _statuses(orders: DataFrame) -> dict[str | None, DataFrame]:
    """Orders by status, whichever there are; the driver gets the distinct statuses."""
    found = sorted((r[0] for r in orders.select("o_orderstatus").distinct().collect()), key=lambda s: (s is None, s))
    return {s: orders.where(F.col("o_orderstatus").eqNullSafe(F.lit(s))) for s in found}


def q_merge_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    for status, rows in _statuses(orders).items():
        rows.createOrReplaceTempView(f"orders_{'none' if status is None else status.lower()}")
    names = [r.table_name for r in list_tables(spark, "^orders_").collect()]
    target = _Target(spark, "merge_shards")
    merge_shards(
        {name: spark.table(name) for name in names},
        target.name,
        columns="o_orderkey,o_totalprice",
        location=target.location,
    )
    return target.stored()


def q_merge_drifting_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables of like shape, one lacking a column, under a dated partition."""
    customer = table(spark, sf_dir, "customer")
    supplier = table(spark, sf_dir, "supplier")
    shards = {
        "customer": select_list(
            customer,
            "c_custkey as party_key, c_name as name, c_nationkey as nation_key, c_mktsegment as segment",
        ),
        "supplier": select_list(supplier, "s_suppkey as party_key, s_name as name, s_nationkey as nation_key"),
    }
    target = _Target(spark, "merge_drifting_shards")
    merge_shards(
        shards,
        target.name,
        columns="party_key,name,nation_key,segment",
        partition={"dt": "2024-01-01"},
        location=target.location,
    )
    return target.stored()


def _differing_shards(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Amounts as whole numbers near 2^53, as doubles, and codes as numbers and texts."""
    return {
        "orders": select_list(table(spark, sf_dir, "orders"), "o_orderkey as row_key, 9007199254740992 + o_orderkey as amount, o_custkey as code"),
        "lines": select_list(table(spark, sf_dir, "lineitem"), "l_orderkey as row_key, l_extendedprice as amount, l_returnflag as code"),
    }


def q_merge_widened_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of different types, merged in the narrowest common ones."""
    target = _Target(spark, "merge_widened_shards")
    merge_shards(_differing_shards(spark, sf_dir), target.name, location=target.location, widen=True)
    return target.stored()


def q_widened_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return widened_columns(_differing_shards(spark, sf_dir))


def q_table_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = with_comments(
        table(spark, sf_dir, "orders"), {"o_orderkey": "order key", "o_totalprice": "order's total"}
    )
    target = _Target(spark, "table_ddl")
    overwrite_partition(orders, target.name, {"dt": "2024-01-01"}, location=target.location)
    return column_report(target.stored())


def q_overwrite_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two dates are loaded and one of them again: it is replaced, the other stays."""
    supplier = table(spark, sf_dir, "supplier")
    target = _Target(spark, "overwrite_partition")
    overwrite_partition(supplier, target.name, {"dt": "2024-01-01"}, location=target.location)
    overwrite_partition(supplier.where("s_acctbal < 0"), target.name, {"dt": "2024-01-02"})
    overwrite_partition(supplier.where("s_acctbal >= 0"), target.name, {"dt": "2024-01-02"})
    return target.stored()


def q_overwrite_typed_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Into a table that another made, in ORC and with a whole-number key: ``05`` replaces 5, and 6 stays."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    target = _Target(spark, "typed_partition")
    spark.sql(
        f"CREATE TABLE {target.name} (s_suppkey bigint, s_acctbal double, h int) USING orc "
        f"PARTITIONED BY (h) LOCATION '{target.location}'"
    )
    overwrite_partition(supplier, target.name, {"h": "5"})
    overwrite_partition(supplier, target.name, "h", partition_values="6")
    overwrite_partition(supplier.where("s_acctbal < 0"), target.name, {"h": "05"})
    return target.stored("orc")


def q_save_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One write, then a second one under each mode; ``error`` refuses the second."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    results = []
    for mode in SAVE_MODES:
        path = scratch_dir(spark, f"save_{mode}")
        save_files(customer, path, "error")
        if mode != "error":
            save_files(customer.where("c_acctbal > 0"), path, mode)
        stored = spark.read.schema(customer.schema).parquet(path)
        results.append(
            stored.agg(
                F.lit(mode).alias("mode"),
                F.count(F.lit(1)).alias("n_rows"),
                F.sum("c_custkey").alias("key_sum"),
            )
        )
    return results[0].union(results[1]).union(results[2]).union(results[3])


def q_delete_then_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = select_list(table(spark, sf_dir, "orders"), "o_orderkey, o_orderstatus, o_orderdate")
    target = _Target(spark, "delete_then_write")
    overwrite_partition(orders, target.name, location=target.location)
    incoming = orders.where("o_orderdate >= timestamp '1997-01-01' and o_orderstatus = 'F'")
    delete_then_write(incoming, target.name, "o_orderdate >= '1997-01-01'")
    return target.stored()


def q_delete_then_write_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by status: one partition loses rows, one loses all, one gains rows."""
    orders = select_list(table(spark, sf_dir, "orders"), "o_orderkey, o_totalprice, o_orderstatus")
    target = _Target(spark, "delete_partitions")
    statuses = _statuses(orders)
    merge_shards({s or "none": rows for s, rows in statuses.items()}, target.name, columns="o_orderkey,o_totalprice", location=target.location)
    incoming = orders.where("o_orderstatus = 'P'").select(
        (-F.col("o_orderkey")).alias("o_orderkey"), "o_totalprice", F.lit("P").alias("shard")
    )
    delete_then_write(incoming, target.name, "shard = 'F' or (shard = 'O' and o_totalprice > 100000)")
    return target.stored()


def q_delete_by_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by status, without the dear ones of customers that another table names, and with copies of a few."""
    orders = select_list(table(spark, sf_dir, "orders"), "o_orderkey, o_custkey, o_totalprice, o_orderstatus as status").where("status is not null")
    target = _Target(spark, "delete_by_keys")
    ensure_table(spark, target.name, orders.drop("status").schema, ["status"], target.location)
    delete_then_write(orders, target.name)
    named = table(spark, sf_dir, "customer").where("c_mktsegment in ('BUILDING', 'MACHINERY')")
    copies = orders.where("status = 'P'").withColumn("o_orderkey", -F.col("o_orderkey"))
    delete_then_write(copies, target.name, "o_totalprice > 50000", delete_keys=named, on={"o_custkey": "c_custkey"})
    return target.stored()


# --- keyed and column-store sinks ------------------------------------------


def _latest_input(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("user_id", *columns, "ts", "event_id")


def q_kv_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kv_string(_latest_input(spark, sf_dir, "event_type"), order_by=["ts", "event_id"])


def q_kv_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kv_hash(_latest_input(spark, sf_dir, "event_type", "props"), order_by=["ts", "event_id"])


def q_kv_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kv_set(table(spark, sf_dir, "events").select("user_id", "event_type"))


def q_kv_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kv_string(_latest_input(spark, sf_dir, "event_type"), order_by=["ts", "event_id"], expire_ms=3_600_000)


def q_kv_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashes in the common entry shape: the last order of each customer."""
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate", "o_orderkey"
    )
    return keyed_entries(orders, "hash", order_by=["o_orderdate", "o_orderkey"], expire_ms=60_000)


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return documents.join(table(spark, sf_dir, "labels"), "doc_id", "left")


def q_conform_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = {
        "doc_id": "UInt64",
        "n_chars": "UInt8",
        "quality": "Int8",
        "toxic": "Nullable(Int8)",
        "note": "LowCardinality(String)",
        "span": "IntervalDay",
    }
    return conform_report(_labelled(spark, sf_dir), target, [*target, "ghost"])


def q_conform_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = {"doc_id": "Int64", "quality": "Int8", "toxic": "Nullable(Int32)", "note": "String"}
    return conform(_labelled(spark, sf_dir), target, list(target))


def q_conform_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = {
        "p_partkey": "Int64",
        "p_size": "UInt8",
        "p_retailprice": "Decimal(12,2)",
        "p_brand": "LowCardinality(Nullable(String))",
    }
    return conform(table(spark, sf_dir, "part"), target, list(target))


def q_conform_fractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fractions for whole-number types take the default; decimals are rounded."""
    target = {"c_custkey": "Int64", "c_acctbal": "Int32", "balance": "Decimal(12,1)"}
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", F.col("c_acctbal").alias("balance"))
    return conform(customer, target, strict=False)


def q_conform_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors stored as arrays of doubles; every value is shown with its place."""
    target = {"vec_id": "Int64", "embedding": "Array(Float64)", "label": "UInt8"}
    fitted = conform(table(spark, sf_dir, "embeddings"), target, list(target))
    return fitted.select("vec_id", "label", F.posexplode("embedding").alias("place", "value")).withColumn(
        "place", F.col("place").cast("bigint")
    )


def q_batch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = with_mod_split(table(spark, sf_dir, "lineitem"), "l_orderkey", SPLITS)
    return batch_plan(split, "split_id", 1000)


def _file_writer(folder: str):
    """A writer that stores each batch as a file in the shared folder, as a store would keep it."""

    def open_writer():
        import pyarrow.parquet as pq
        from pyarrow import fs

        class Files:
            def __init__(self):
                place = folder if "://" in folder or folder.startswith("/") else folder.replace("file:", "file://", 1)
                self.fs, self.root = fs.FileSystem.from_uri(place)
                self.fs.create_dir(self.root, recursive=True)

            def write(self, batch, batch_id=None):
                pq.write_table(batch, f"{self.root}/{batch_id or uuid.uuid4().hex}.parquet", filesystem=self.fs)

            def close(self):
                pass

        return Files()

    return open_writer


def q_bulk_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line goes to a writer in batches; what the writers stored is read back."""
    rows = prune_columns(table(spark, sf_dir, "lineitem"), "l_orderkey,l_partkey,l_suppkey,l_linenumber")
    folder = scratch_dir(spark, "bulk_write")
    write_bulk(rows, _file_writer(folder), bulk_size=5000)
    return spark.read.schema(rows.schema).parquet(folder)


def q_kv_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set entries go to a writer, one pipeline per batch, and are read back."""
    members = table(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag")
    folder = scratch_dir(spark, "kv_publish")
    publish_keyed(members, _file_writer(folder), "set", expire_ms=60_000)
    return spark.read.parquet(folder).select("key", "kind", "value", "expire_ms")


def q_kv_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of each customer's last order, the second of other orders; what the store holds, and which load sent it."""
    orders = table(spark, sf_dir, "orders").where("o_custkey is not null")
    orders = orders.select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority")
    state, loads = scratch_dir(spark, "kv_state"), []
    for rows in (orders.where("o_orderkey % 3 > 0"), orders.where("o_orderpriority <> '5-LOW'")):
        folder = scratch_dir(spark, "kv_changes")
        publish_changes(rows, _file_writer(folder), "hash", state, order_by="o_orderkey")
        sent = "change string, key string, kind string, field string, value string, expire_ms bigint"
        loads.append(spark.read.schema(sent).parquet(folder))
    first, second = loads
    held = first.join(second, ["key", "field"], "left_anti").select("key", "field", "value", F.lit(1).alias("load"))
    return held.unionByName(second.where("change = 'set'").select("key", "field", "value", F.lit(2).alias("load")))


def q_conform_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column-store job: the target describes itself, rows are fitted to it, sent in batches, and read back."""
    described = [("doc_id", "UInt64"), ("quality", "Int8"), ("toxic", "Nullable(Int32)"), ("note", "String"), ("other", "UUID")]
    target = target_schema(spark.createDataFrame(described, "name string, type string"))
    folder = scratch_dir(spark, "conform_publish")
    fields = ["doc_id", "quality", "toxic", "note"]
    publish_conformed(_labelled(spark, sf_dir), _file_writer(folder), target, fields, bulk_size=2000)
    return spark.read.parquet(folder).select(F.col("doc_id").cast("bigint").alias("doc_id"), *fields[1:])


def q_bulk_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines delivered under a name, and once more by other tasks, which have nothing left to send; what the store holds."""
    rows = prune_columns(table(spark, sf_dir, "lineitem"), "l_orderkey,l_partkey,l_suppkey,l_linenumber")
    folder, ledger = scratch_dir(spark, "bulk_once"), scratch_dir(spark, "ledger")
    for again in (rows, rows.repartition(SPLITS)):
        deliver_once(again, _file_writer(folder), ledger, "lines", ["l_orderkey", "l_linenumber"], bulk_size=5000, splits=SPLITS)
    return spark.read.schema(rows.schema).parquet(folder)


def q_bulk_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines written through the batch data source: all of them, then only those returned in their place, then the open ones."""
    rows = prune_columns(table(spark, sf_dir, "lineitem"), "l_orderkey,l_linenumber,l_returnflag")
    folder = scratch_dir(spark, "bulk_source")
    write_batches(rows, folder, batch_rows=5000)
    write_batches(rows.where("l_returnflag = 'R'"), folder, batch_rows=5000, mode="overwrite")
    write_batches(rows.where("l_returnflag = 'N'"), folder, batch_rows=5000)
    return read_batches(spark, folder, rows.schema)


# --- releases --------------------------------------------------------------


def q_release_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by status: all of them, then some removed and copies added, then one status replaced; the last release."""
    location = f"{scratch_dir(spark, 'released')}/orders"
    orders = select_list(
        table(spark, sf_dir, "orders"), "o_orderkey as order_key, o_totalprice as price, o_orderpriority as priority, o_orderstatus as status"
    )
    publish(orders, location, ["status"], load="all")
    urgent = orders.where("priority = '1-URGENT' and status = 'F'").withColumn("order_key", -F.col("order_key"))
    publish(urgent, location, ["status"], load="urgent", delete_where="status = 'F' and price > 100000")
    publish(orders.where("status = 'O' and price < 50000"), location, ["status"], load="small")
    return read_release(spark, location)


# --- a whole job -----------------------------------------------------------


def q_job_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders, split on their key, renamed, conformed and published under a date."""
    target = _Target(spark, "job_ingest")
    job = Job(
        source=lambda s: table(s, sf_dir, "orders"),
        steps=[
            lambda df: filtered(df, "o_orderstatus = 'F' or o_orderpriority = '1-URGENT'"),
            lambda df: with_range_split(df, "o_orderkey", SPLITS),
            lambda df: select_list(
                df,
                "o_orderkey as order_key, o_custkey as customer_key, upper(o_orderstatus) as status, "
                "o_totalprice as total_price, o_orderdate as order_date, split_id",
            ),
        ],
        sink=lambda df: overwrite_partition(df, target.name, {"dt": "2024-01-01"}, location=target.location),
    )
    job.run(spark)
    return target.stored()


def q_job_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and customers joined once, published as a table by nation and as totals by segment."""
    rows, totals = _Target(spark, "graph_rows"), _Target(spark, "graph_totals")
    graph = (
        JobGraph()
        .source("orders", lambda s: table(s, sf_dir, "orders"))
        .source("customers", lambda s: table(s, sf_dir, "customer"))
        .step("open_orders", "orders", lambda df: filtered(df, "o_orderstatus <> 'F'"))
        .step(
            "sales",
            ["open_orders", "customers"],
            "select o_orderkey as order_key, c_nationkey as nation_key, c_mktsegment as segment, o_totalprice as price "
            "from open_orders join customers on o_custkey = c_custkey",
        )
        .step(
            "by_segment",
            "sales",
            "select segment, count(*) as n_orders, min(price) as least, max(price) as most from sales group by segment",
        )
        .sink("rows", "sales", lambda df: overwrite_partition(df, rows.name, {"dt": "2024-01-01"}, location=rows.location))
        .sink("totals", "by_segment", lambda df: overwrite_partition(df, totals.name, location=totals.location), after="rows")
    )
    graph.run(spark)
    by_nation = (
        rows.stored()
        .groupBy(F.col("nation_key").cast("string").alias("name"), "dt")
        .agg(F.count("*").alias("n_orders"), F.min("price").alias("least"), F.max("price").alias("most"))
    )
    by_segment = totals.stored().select(F.col("segment").alias("name"), F.lit("all").alias("dt"), "n_orders", "least", "most")
    return by_nation.unionByName(by_segment)


def registry() -> dict[str, Query]:
    """Query name to function."""
    return {name[2:]: query for name, query in globals().items() if name.startswith("q_")}
