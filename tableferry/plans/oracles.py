"""For each registered query, plain SQL that gives the same rows."""

_MOD_SPLIT = "((o_orderkey % 8) + 8) % 8"

_LAST_EVENT = """
select user_id, event_type, props from (
  select user_id, event_type, props,
         row_number() over (partition by user_id order by ts desc, event_id desc) as rn
  from events) t
where rn = 1
"""

_ALL_COUNTS = " union all ".join(
    f"select '{name}' as table_name, count(*) as n_rows from {name}"
    for name in (
        "region nation customer supplier part orders lineitem events "
        "documents embeddings pages benchmark labels conversations"
    ).split()
)

_LABELLED = (
    "select d.doc_id, d.n_chars, l.quality, l.toxic from documents d left join labels l on l.doc_id = d.doc_id"
)

ORACLES = {
    "key_bounds": """
        select max(o_orderkey) as max_key, min(o_orderkey) as min_key
        from orders where o_orderstatus = 'F'
    """,
    "scan_bounds_split": """
        select l_orderkey, l_linenumber, l_quantity,
               cast(case when l_orderkey < 100 then 0
                         else least((l_orderkey - 100) // 113, 8) end as bigint) as split_id
        from lineitem
    """,
    "scan_range_split": """
        with o as (select * from orders where o_orderstatus = 'F'),
        b as (select min(o_orderkey) as lo, max(o_orderkey) as hi from o),
        s as (select lo, greatest(1, cast(ceil((hi - lo) / 8.0) as bigint)) as stride from b)
        select cast((o_orderkey - lo) // stride as bigint) as split_id, count(*) as n_rows,
               min(o_orderkey) as min_key, max(o_orderkey) as max_key
        from o cross join s group by 1
    """,
    "scan_mod_split": f"""
        select cast({_MOD_SPLIT} as bigint) as split_id, count(*) as n_rows from orders group by 1
    """,
    "scan_where_split": f"""
        select cast({_MOD_SPLIT} as bigint) as split_id, count(*) as n_rows from orders
        where (o_orderstatus = 'F' or o_orderpriority = '1-URGENT') group by 1
    """,
    "list_tables_regex": f"""
        select table_name, n_rows from ({_ALL_COUNTS}) t
        where regexp_matches(table_name, '(?i)^(PART|LINEITEM|ORDERS|CUSTOMER|NATION)$')
    """,
    "column_comments": """
        select 'c_custkey' as column_name, 'customer key' as comment, count(c_custkey) as n_values from customer
        union all select 'c_name', 'the customers name', count(c_name) from customer
        union all select 'c_nationkey', '', count(c_nationkey) from customer
        union all select 'c_acctbal', 'balance', count(c_acctbal) from customer
    """,
    "doc_scan_declared": "select event_id, cast(json_extract(props, '$.k') as bigint) as k from events",
    "doc_scan_inferred": "select event_id, cast(json_extract(props, '$.k') as bigint) as k from events",
    "doc_read_declared": "select cast(json_extract(props, '$.k') as bigint) as k from events where props is not null",
    "doc_read_inferred": "select cast(json_extract(props, '$.k') as bigint) as k from events where props is not null",
    "doc_scan_mixed": """
        select event_id, case when k is not null and event_id % 5 = 0 then round("value", 2) end as v,
               case event_id % 5 when 3 then event_type end as t,
               case when k is not null then case event_id % 5 when 0 then 'BIGINT' when 1 then 'STRING' when 2 then 'ARRAY<BIGINT>' end end as k_type,
               case event_id % 5 when 0 then k when 1 then '"' || k || '"' when 2 then '[' || k || ']' end as k,
               case event_id % 5 when 4 then '[' || k || ',"x"]' end as rest
        from (select *, props ->> '$.k' as k from events)
    """,
    "doc_read_mixed": """
        select case event_id % 5 when 0 then k when 1 then '"' || k || '"' when 2 then '[' || k || ']' end as k,
               case event_id % 5 when 3 then event_type end as t,
               case event_id % 5 when 0 then round("value", 2) end as v,
               case event_id % 5 when 4 then '[' || k || ',"x"]' end as rest
        from (select *, props ->> '$.k' as k from events)
        where case event_id % 5 when 3 then event_type when 0 then k || "value" else k end is not null
    """,
    "doc_unreadable": """
        select count(props) as n_documents, count(case when "value" > 50 and props is not null then 1 end) as n_unreadable
        from events
    """,
    "prune_columns": "select c_custkey, c_nationkey from customer",
    "select_list_alias": """
        select c_custkey, upper(c_mktsegment) as segment, concat(c_name, '/', c_mktsegment) as label
        from customer
    """,
    "substr_column": "select c_custkey, substring(c_name, 10, 9) as x from customer",
    "derived_column": 'select *, substring(c_name, 1, 8) as "__ROOT__" from customer',
    "udf_in_sql": "select c_custkey, substring(c_name, 10, 9) as x from customer",
    "normalize_types": """
        select l_orderkey, l_partkey, l_suppkey, cast(l_linenumber as bigint) as l_linenumber, l_quantity,
               l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
               cast(l_shipdate as varchar) as l_shipdate
        from lineitem
    """,
    "sql_join_agg": """
        select n_name, count(*) as n_orders,
               cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total_price
        from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey
        group by n_name
    """,
    "sql_window_topk": """
        select user_id, event_id, value, rn from (
          select user_id, event_id, value,
                 row_number() over (partition by user_id order by value desc, event_id) as rn
          from events) t
        where rn <= 3
    """,
    "sql_setop": "select c_nationkey as k from customer intersect select s_nationkey from supplier",
    "sql_rollup": """
        select l_returnflag, l_linestatus, count(*) as n_rows
        from lineitem group by rollup (l_returnflag, l_linestatus)
    """,
    "sql_cast": """
        select event_id, cast(ts as varchar) as ts, cast(value > 50 as bigint) as is_large from events
    """,
    "preview_limit": "select * from orders order by o_orderkey limit 100",
    "merge_shards": """
        select o_orderkey, o_totalprice, 'orders_' || coalesce(lower(o_orderstatus), 'none') as shard from orders
    """,
    "merge_drifting_shards": """
        select c_custkey as party_key, c_name as name, cast(c_nationkey as bigint) as nation_key,
               c_mktsegment as segment, '2024-01-01' as dt, 'customer' as shard from customer
        union all
        select s_suppkey, s_name, cast(s_nationkey as bigint), null, '2024-01-01', 'supplier' from supplier
    """,
    "merge_widened_shards": """
        select o_orderkey as row_key, cast(9007199254740992 + o_orderkey as double) as amount,
               cast(o_custkey as varchar) as code, 'orders' as shard from orders
        union all
        select l_orderkey, l_extendedprice, l_returnflag, 'lines' from lineitem
    """,
    "widened_columns": """
        select 'orders' as shard, 'amount' as column_name, 'bigint' as stored_type, 'double' as merged_type,
               count(o_orderkey) as n_values,
               count(case when cast(cast(9007199254740992 + o_orderkey as double) as bigint) <> 9007199254740992 + o_orderkey then 1 end) as n_inexact
        from orders
        union all
        select 'orders', 'code', 'bigint', 'string', count(o_custkey), 0 from orders
    """,
    "table_ddl": """
        select 'o_orderkey' as column_name, 'bigint' as data_type, 'order key' as comment,
               count(o_orderkey) as n_values from orders
        union all select 'o_custkey', 'bigint', '', count(o_custkey) from orders
        union all select 'o_orderstatus', 'string', '', count(o_orderstatus) from orders
        union all select 'o_totalprice', 'double', 'orders total', count(o_totalprice) from orders
        union all select 'o_orderdate', 'string', '', count(o_orderdate) from orders
        union all select 'o_orderpriority', 'string', '', count(o_orderpriority) from orders
        union all select 'dt', 'string', '', count(*) from orders
    """,
    "overwrite_partition": """
        select s_suppkey, s_name, cast(s_nationkey as bigint) as s_nationkey, s_acctbal, '2024-01-01' as dt
        from supplier
        union all
        select s_suppkey, s_name, cast(s_nationkey as bigint), s_acctbal, '2024-01-02'
        from supplier where s_acctbal >= 0
    """,
    "overwrite_typed_partition": """
        select s_suppkey, s_acctbal, 6 as h from supplier
        union all
        select s_suppkey, s_acctbal, 5 from supplier where s_acctbal < 0
    """,
    "save_modes": """
        with a as (select count(*) as n, sum(c_custkey) as s from customer),
        p as (select count(*) as n, sum(c_custkey) as s from customer where c_acctbal > 0)
        select 'overwrite' as "mode", p.n as n_rows, cast(p.s as bigint) as key_sum from p
        union all select 'append', a.n + p.n, cast(a.s + p.s as bigint) from a cross join p
        union all select 'ignore', a.n, cast(a.s as bigint) from a
        union all select 'error', a.n, cast(a.s as bigint) from a
    """,
    "delete_then_write": """
        select o_orderkey, o_orderstatus, cast(o_orderdate as varchar) as o_orderdate from orders
        where o_orderdate < timestamp '1997-01-01' or o_orderstatus = 'F'
    """,
    "delete_then_write_partitions": """
        select o_orderkey, o_totalprice, coalesce(o_orderstatus, 'none') as shard from orders
        where not coalesce(o_orderstatus = 'F' or (o_orderstatus = 'O' and o_totalprice > 100000), false)
        union all
        select -o_orderkey, o_totalprice, 'P' from orders where o_orderstatus = 'P'
    """,
    "delete_by_keys": """
        with o as (
            select o_orderkey, o_custkey, o_totalprice, o_orderstatus as status from orders where o_orderstatus is not null)
        select * from o
        where not coalesce(o_totalprice > 50000, false) or not exists (
            select 1 from customer c
            where c.c_custkey = o.o_custkey and c.c_mktsegment in ('BUILDING', 'MACHINERY'))
        union all
        select -o_orderkey, o_custkey, o_totalprice, status from o where status = 'P'
    """,
    "kv_changes": """
        with e as (
            select o_custkey, o_orderkey, o_orderpriority, 'o_orderstatus' as field, o_orderstatus as "value" from orders
            union all
            select o_custkey, o_orderkey, o_orderpriority, 'o_orderpriority', o_orderpriority from orders),
        one as (
            select o_custkey, field, arg_max("value", o_orderkey) as "value" from e
            where o_orderkey % 3 > 0 and "value" is not null group by all),
        two as (
            select o_custkey, field, arg_max("value", o_orderkey) as "value" from e
            where o_orderpriority <> '5-LOW' and "value" is not null group by all)
        select cast(two.o_custkey as varchar) as "key", two.field, two."value",
               case when one."value" = two."value" then 1 else 2 end as "load"
        from two left join one on one.o_custkey = two.o_custkey and one.field = two.field
        where two.o_custkey is not null
    """,
    "kv_string": f"""
        select cast(user_id as varchar) as "key", event_type as "value" from ({_LAST_EVENT}) e
    """,
    "kv_hash": f"""
        select cast(user_id as varchar) as "key", 'event_type' as field, event_type as "value" from ({_LAST_EVENT}) e
        union all
        select cast(user_id as varchar), 'props', props from ({_LAST_EVENT}) e
    """,
    "kv_set": 'select distinct cast(user_id as varchar) as "key", event_type as member from events',
    "kv_ttl": f"""
        select cast(user_id as varchar) as "key", event_type as "value", cast(3600000 as bigint) as expire_ms
        from ({_LAST_EVENT}) e
    """,
    "kv_entries": """
        with ranked as (
          select o_custkey, o_orderstatus, o_orderpriority,
                 row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rn
          from orders),
        l as (select * from ranked where rn = 1)
        select cast(o_custkey as varchar) as "key", 'hash' as kind, 'o_orderstatus' as field,
               o_orderstatus as "value", cast(60000 as bigint) as expire_ms from l
        union all
        select cast(o_custkey as varchar), 'hash', 'o_orderpriority', o_orderpriority, 60000 from l
    """,
    "conform_report": f"""
        with d as ({_LABELLED})
        select 'doc_id' as field, 'UInt64' as target_type, 'ok' as verdict,
               count(*) - count(doc_id) as n_filled, cast(0 as bigint) as n_unfit, cast(0 as bigint) as n_rounded from d
        union all select 'n_chars', 'UInt8', 'ok', count(*) - count(n_chars),
               count(case when n_chars > 255 then 1 end), 0 from d
        union all select 'quality', 'Int8', 'ok', count(*) - count(quality), 0, 0 from d
        union all select 'toxic', 'Nullable(Int8)', 'ok', count(*) - count(toxic), 0, 0 from d
        union all select 'note', 'LowCardinality(String)', 'filled with default', count(*), 0, 0 from d
        union all select 'span', 'IntervalDay', 'type not supported', 0, 0, 0
        union all select 'ghost', null, 'not in target', 0, 0, 0
    """,
    "conform_fill": f"""
        select doc_id, cast(coalesce(quality, 0) as tinyint) as quality, toxic, '' as note from ({_LABELLED}) d
    """,
    "conform_types": """
        select p_partkey, cast(p_size as smallint) as p_size,
               cast(p_retailprice as decimal(12,2)) as p_retailprice, p_brand
        from part
    """,
    "conform_fractions": """
        select c_custkey, cast(case when c_acctbal = floor(c_acctbal) then c_acctbal else 0 end as integer) as c_acctbal,
               cast(c_acctbal as decimal(12,1)) as balance
        from customer
    """,
    "conform_arrays": """
        select vec_id, cast(label as smallint) as label, cast(place as bigint) as place,
               cast(embedding[place + 1] as double) as "value"
        from (select *, unnest(range(len(embedding))) as place from embeddings) e
    """,
    "batch_plan": """
        with r as (
          select ((l_orderkey % 8) + 8) % 8 as split_id,
                 row_number() over (partition by ((l_orderkey % 8) + 8) % 8 order by l_orderkey) as rn
          from lineitem),
        b as (select split_id, (rn - 1) // 1000 as batch, count(*) as n from r group by 1, 2)
        select cast(split_id as bigint) as split_id, cast(sum(n) as bigint) as n_rows, count(*) as n_batches,
               arg_max(n, batch) as last_rows
        from b group by 1
    """,
    "bulk_write": "select l_orderkey, l_partkey, l_suppkey, l_linenumber from lineitem",
    "kv_publish": """
        select distinct cast(l_partkey as varchar) as "key", 'set' as kind, l_returnflag as "value",
               cast(60000 as bigint) as expire_ms
        from lineitem
    """,
    "conform_publish": f"""
        select doc_id, cast(coalesce(quality, 0) as tinyint) as quality, toxic, '' as note from ({_LABELLED}) d
    """,
    "job_ingest": """
        with o as (select * from orders where o_orderstatus = 'F' or o_orderpriority = '1-URGENT'),
        b as (select min(o_orderkey) as lo, max(o_orderkey) as hi from o),
        s as (select lo, greatest(1, cast(ceil((hi - lo) / 8.0) as bigint)) as stride from b)
        select o_orderkey as order_key, o_custkey as customer_key, upper(o_orderstatus) as status,
               o_totalprice as total_price, cast(o_orderdate as varchar) as order_date,
               cast((o_orderkey - lo) // stride as bigint) as split_id, '2024-01-01' as dt
        from o cross join s
    """,
    "job_graph": """
        with sales as (
            select c_nationkey, c_mktsegment, o_totalprice as price
            from orders join customer on o_custkey = c_custkey where o_orderstatus <> 'F')
        select cast(c_nationkey as varchar) as name, '2024-01-01' as dt, count(*) as n_orders,
               min(price) as least, max(price) as most
        from sales group by c_nationkey
        union all
        select c_mktsegment, 'all', count(*), min(price), max(price) from sales group by c_mktsegment
    """,
    "release_partitions": """
        with o as (
            select o_orderkey as order_key, o_totalprice as price, o_orderpriority as priority, o_orderstatus as status
            from orders)
        select * from o where status = 'P'
        union all
        select * from o where status = 'F' and not price > 100000
        union all
        select -order_key, price, priority, status from o where status = 'F' and priority = '1-URGENT'
        union all
        select * from o where status = 'O' and price < 50000
    """,
    "bulk_once": "select l_orderkey, l_partkey, l_suppkey, l_linenumber from lineitem",
    "bulk_source": "select l_orderkey, l_linenumber, l_returnflag from lineitem where l_returnflag in ('R', 'N')",
    "scan_depth_split": """
        select count(*) as n_rows, min(user_id) as min_key, max(user_id) as max_key, true as even, true as enough
        from events
    """,
}
