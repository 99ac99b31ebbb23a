"""Inputs derived from the test tables. Each text runs in Spark and in DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

FIXTURES = {
    "src_orders": """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       case when o_orderkey % 113 = 1 then null else o_orderdate end as update_date_time
from {orders}
""",
    "work_orders": """
select
  case when o_orderkey % 50 = 7 then cast(o_orderkey - 1 as string)
       when o_orderkey % 211 = 13 then ''
       else cast(o_orderkey as string) end as o_orderkey,
  case when o_orderkey % 97 = 3 then 'abc'
       when o_orderkey % 89 = 5 then ''
       when o_orderkey % 83 = 9 then '99999999999999999999'
       when o_orderkey % 79 = 2 then '1.5'
       else cast(o_custkey as string) end as o_custkey,
  case when o_orderkey % 61 = 4 then '12.345'
       when o_orderkey % 67 = 8 then '-5'
       when o_orderkey % 71 = 2 then '1e3'
       else cast(cast(o_totalprice as decimal(18,2)) as string) end as o_totalprice,
  case when o_orderkey % 53 = 6 then '2023-02-29'
       when o_orderkey % 59 = 1 then '1996/02/29'
       when o_orderkey % 47 = 3 then '19970704'
       else cast(cast(o_orderdate as date) as string) end as o_orderdate,
  case when o_orderkey % 101 = 11 then 'nan'
       when o_orderkey % 103 = 5 then ''
       else o_orderstatus end as o_orderstatus,
  case when o_orderkey % 3 = 0 then 'True'
       when o_orderkey % 3 = 1 then 'false' else 'yes' end as is_urgent,
  case when o_orderkey % 5 = 0 then concat(o_orderpriority, chr(10), 'x')
       when o_orderkey % 43 = 1 then concat('a', chr(92), 'b')
       else o_orderpriority end as note,
  case when o_orderkey % 10 = 9 then 'D'
       when o_orderkey % 307 = 17 then 'Z'
       when o_orderkey % 311 = 19 then '' else 'U' end as process_div
from {orders}
""",
    "target_orders": """
select o_orderkey, o_custkey, cast(o_totalprice as decimal(18,2)) as o_totalprice,
       cast(o_orderdate as date) as o_orderdate, o_orderstatus,
       o_orderpriority as note, 'ETL' as create_id, o_orderdate as create_dtt,
       'ETL' as last_upd_id, o_orderdate as last_upd_dtt
from {orders} where o_orderkey % 4 <> 0
""",
    "control_rows": """
select 'src' as aurora_schema,
       concat('t', cast(cast((p_partkey - p_partkey % 8) / 8 as bigint) as string)) as aurora_table,
       'wrk' as target_work_schema,
       concat('w', cast(cast((p_partkey - p_partkey % 8) / 8 as bigint) as string)) as target_work_table,
       'core' as target_schema,
       concat('t', cast(cast((p_partkey - p_partkey % 8) / 8 as bigint) as string)) as target_table,
       concat('c', cast(p_partkey % 8 as string)) as target_column,
       p_partkey % 8 = 0 and p_size % 9 <> 0 as search_key,
       case when p_size % 6 = 0 then 'Required' when p_size % 6 = 1 then 'MaxLength'
            when p_size % 6 = 2 then 'MinLength,MaxLength' when p_size % 6 = 3 then 'MaxValue,MinValue'
            when p_partkey % 31 = 0 then 'Required,Foo' else '' end as validation,
       case when p_partkey % 29 = 0 then null else p_size end as max_length,
       case when p_partkey % 23 = 0 then null else 1 end as min_length,
       case when p_partkey % 19 = 0 then null else cast(p_retailprice as decimal(18,2)) end as max_value,
       case when p_partkey % 17 = 0 then null else cast(0 as decimal(18,2)) end as min_value,
       cast(p_partkey % 8 + 1 as int) as seq
from {part}
""",
    "meta_objects": """
select case when p_partkey % 37 = 0 then 'SYS' when p_partkey % 41 = 0 then null else p_brand end as owner,
       concat('T', cast(p_partkey as string)) as object_name,
       case when p_size % 5 = 0 then 'VIEW' when p_size % 7 = 0 then 'INDEX' else 'TABLE' end as object_type,
       date '2024-01-01' + p_size as last_ddl_time
from {part}
""",
    "meta_tables": """
select case when p_partkey % 37 = 0 then 'SYS' else p_brand end as owner,
       concat('T', cast(p_partkey as string)) as table_name,
       case when p_partkey % 11 = 0 then null else p_size * 100 end as num_rows,
       case when p_partkey % 13 = 0 then null else date '2024-06-01' + p_size end as last_analyzed
from {part}
""",
    "meta_columns": """
select case when l_partkey % 37 = 0 then 'SYS' else p_brand end as owner,
       concat('T', cast(l_partkey as string)) as table_name,
       l_linenumber as column_id, concat('C', cast(l_linenumber as string)) as column_name,
       case when l_linenumber % 2 = 0 then 'NUMBER' else 'VARCHAR2' end as data_type,
       case when l_linenumber % 2 = 0 then 22 else 30 + l_linenumber end as data_length,
       case when l_linenumber % 2 = 0 then 10 + l_linenumber end as data_precision,
       case when l_linenumber % 2 = 0 then 2 end as data_scale,
       case when l_linenumber = 1 then 'N' else 'Y' end as nullable
from (select distinct l_partkey, l_linenumber from {lineitem}) l join {part} on l_partkey = p_partkey
""",
    "query_log": """
select event_id as query_id, ts as start_ts, user_id, value as elapsed_s,
       value * 1048576 * 10 as scan_bytes,
       cast(1 + user_id % 13 as double) as skew_ratio,
       case when event_type in ('view', 'click', 'error') then 'dm'
            when event_type = 'purchase' then 'core' else 'stg' end as layer,
       case when event_type = 'error' then 'abort' else 'ok' end as outcome
from {events}
""",
    "work_events": """
select cast(event_id as string) as event_id,
       case when event_id % 10 = 1 then replace(substr(cast(ts as string), 1, 19), '-', '/')
            when event_id % 10 = 2 then replace(substr(cast(ts as string), 1, 19), ' ', 'T')
            when event_id % 10 = 3 then '2024-02-30 10:00:00'
            when event_id % 10 = 4 then concat(substr(cast(ts as string), 1, 19), '.123456')
            when event_id % 10 = 5 then concat(substr(cast(ts as string), 1, 19), 'Z')
            when event_id % 10 = 6 then concat(substr(cast(ts as string), 1, 19), '+09:00')
            when event_id % 10 = 7 then concat(substr(cast(ts as string), 1, 10), ' 25:00:00')
            when event_id % 10 = 8 then substr(cast(ts as string), 1, 16)
            when event_id % 70 = 9 then ''
            when event_id % 70 = 19 then concat(replace(substr(cast(ts as string), 1, 10), '-', ''), ' 010203')
            when event_id % 70 = 29 then 'soon'
            else substr(cast(ts as string), 1, 10) end as at_text,
       case when event_id % 9 = 1 then replace(substr(cast(ts as string), 12, 8), ':', '')
            when event_id % 9 = 2 then '24:00:00'
            when event_id % 9 = 3 then concat(substr(cast(ts as string), 12, 8), '.123')
            when event_id % 9 = 4 then concat(substr(cast(ts as string), 12, 8), '.1234')
            when event_id % 9 = 5 then concat(substr(cast(ts as string), 12, 8), '+14:30')
            when event_id % 9 = 6 then concat(substr(cast(ts as string), 12, 8), '-13:00')
            when event_id % 9 = 7 then ''
            else substr(cast(ts as string), 12, 8) end as time_text,
       case when event_id % 11 = 1 then '1e5' when event_id % 11 = 2 then 'abc'
            when event_id % 11 = 3 then '12345678901234567890123' when event_id % 11 = 4 then ''
            when event_id % 11 = 5 then '-7' when event_id % 11 = 6 then concat('7', chr(10))
            else cast(cast(value as decimal(18,2)) as string) end as value_text,
       case when event_id % 12 = 1 then concat(event_type, 'é') when event_id % 12 = 2 then concat(event_type, chr(9))
            when event_id % 12 = 3 then '' else event_type end as code_text,
       case when event_id % 307 = 17 then '' else 'U' end as process_div
from {events}
""",
    "work_replace": """
select cast(o_orderkey as string) as o_orderkey, cast(o_custkey as string) as o_custkey,
       cast(cast(o_totalprice as decimal(18,2)) as string) as o_totalprice,
       cast(cast(o_orderdate as date) as string) as o_orderdate, o_orderstatus, o_orderpriority as note,
       case when o_orderkey % 307 = 17 then 'U' else 'L' end as process_div,
       o_orderkey % 19 = 3 as error_flg
from {orders}
""",
    "etl_runs": """
select event_id as run_id, cast(cast(ts as date) as timestamp_ntz) as due_ts,
       case when event_id % 50 = 3 then ts else cast(cast(ts as date) as timestamp_ntz) end as end_ts,
       case when event_id % 97 = 5 then 'failed' else 'ok' end as outcome
from {events}
""",
    "open_runs": """
select event_id as run_id, cast(cast(ts as date) as timestamp_ntz) as due_ts,
       case when event_id % 89 = 7 then null when event_id % 50 = 3 then ts else cast(cast(ts as date) as timestamp_ntz) end as end_ts,
       case when event_id % 97 = 5 then 'failed' when event_id % 89 = 7 then 'running' else 'ok' end as outcome
from {events}
""",
    "expected_users": """
select user_id from {events} union select c_custkey + 1000000 as user_id from {customer} where c_nationkey = 3
""",
    "spring_log": """
select event_id as query_id, ts as start_ts, case when event_type = 'error' then 'abort' else 'ok' end as outcome
from {events} where day(ts) < 20 or day(ts) > 26
""",
    "run_marks": """
select event_id, user_id as run, case when event_id % 4 < 2 then 'import' else 'check' end as title,
       case when event_type in ('signup', 'click') then 'start' when event_type = 'purchase' then 'end' else 'note' end as status,
       ts
from {events}
""",
    "alerts": """
select event_id as alert_id, cast(event_id % 90 as double) / 10 as severity, ts as opened_ts,
       ts + interval '5' minute as acked_ts,
       case when event_id % 7 = 1 then null when event_id % 3 = 0 then ts + interval '3' hour
            else ts + interval '1' hour end as resolved_ts
from {events}
""",
    "users": """
select c_custkey as user_id, c_mktsegment <> 'HOUSEHOLD' as mfa from {customer}
""",
    "entitlements": """
select concat('bi_', cast(n_regionkey as string)) as principal, n_nationkey as c_nationkey from {nation}
""",
    "requests": """
select event_id,
       case when user_id % 4 = 0 then 'role_admin' when user_id % 4 = 1 then 'role_etl_writer'
            when user_id % 4 = 2 then 'role_bi_reader' else 'role_audit' end as role,
       case when event_id % 4 = 0 then 'stg' when event_id % 4 = 1 then 'core'
            when event_id % 4 = 2 then 'dm' else 'ext' end as layer,
       case when event_type in ('view', 'click') then 'read' else 'write' end as privilege
from {events}
""",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fixture(spark: SparkSession, folder: str, name: str) -> DataFrame:
    text = FIXTURES[name]
    used = set(re.findall(r"\{(\w+)\}", text))
    return spark.sql(text, **{t: table(spark, folder, t) for t in used})


def fixture_sql(name: str) -> str:
    """The same input for DuckDB, over the registered views."""
    return re.sub(r"\{(\w+)\}", r"\1", FIXTURES[name]).replace("timestamp_ntz", "timestamp").strip()
