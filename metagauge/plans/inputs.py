"""Inputs of the queries: SQL that both Spark and DuckDB run, so that both sides see the same records.

Nulls, blanks and personal data are put in by the last digit of a key; every row of a table is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _last(key: str) -> str:
    return f"right(cast({key} as string), 1)"


RESOURCES = f"""
select 'C' || cast(o_custkey as string) as catalog_title,
  case {_last('o_orderkey')} when '1' then '  ' when '2' then null else 'Order ' || cast(o_orderkey as string) end as title,
  case left(o_orderpriority, 1) when '1' then 'text/csv' when '2' then 'application/JSON' when '3' then 'WMS' when '4' then null else ' ' end as file_format,
  case {_last('o_orderkey')} when '3' then null when '4' then 'ftp://h.example.org/x' when '5' then null else 'https://h.example.org/d/' || cast(o_orderkey as string) || '.csv' end as datafile,
  case {_last('o_orderkey')} when '5' then null when '6' then 'http://h.example.org/' || cast(o_orderkey as string) when '7' then 'HTTP://h.example.org' else null end as datafile_url,
  case {_last('o_custkey')} when '0' then 'Größe' when '1' then null else 'plain' end as note,
  case o_orderstatus when 'O' then 'open' when 'F' then '' else null end as resource_category,
  case {_last('o_custkey')} when '2' then 'Central' when '3' then ' STATE ' when '4' then 'State' when '5' then null else 'Union' end as govt_type,
  case o_orderstatus when 'O' then 'Dept' when 'F' then '  ' else null end as state_department,
  case {_last('o_orderkey')} when '8' then 'api' when '9' then ' NaN ' else null end as external_api_reference,
  case left(o_orderpriority, 1) when '1' then ' All ' when '2' then '' when '3' then null else 'Trade' end as sector,
  o_orderkey as ord, o_totalprice as price
from orders
"""

CATALOGS = f"""
select 'C' || cast(c_custkey as string) as title,
  case c_mktsegment when 'BUILDING' then ' ' when 'MACHINERY' then null else 'Segment ' || c_mktsegment end as `body:value`,
  case {_last('c_custkey')} when '0' then null else '2024-01-0' || {_last('c_custkey')} end as published_date,
  case {_last('c_nationkey')} when '1' then '' else 'Ministry ' || cast(c_nationkey as string) end as `field_ministry_department:name`,
  'node/' || cast(c_custkey as string) as node_alias,
  case {_last('c_nationkey')} when '2' then null else 'k' end as keywords,
  case {_last('c_custkey')} when '3' then null when '4' then ' ' else 'National' end as `field_asset_jurisdiction:name`,
  case {_last('c_nationkey')} when '3' then null else 'Central' end as field_ds_govt_type,
  case {_last('c_nationkey')} when '4' then 'ALL' when '5' then null when '6' then ' ' else 'Health' end as `field_sector:name`
from customer
"""

MAPPINGS = f"""
select case when p_size <= 20 then 'Catalog' when p_size <= 45 then 'Dataset' else 'Distribution' end as level,
  case {_last('p_partkey')} when '1' then null when '2' then '  ' else p_name end as source_field,
  case {_last('p_partkey')} when '1' then ' dcat:' || p_brand || ' ' when '3' then null else 'dcat:' || p_type end as dcat_field,
  case {_last('p_partkey')} when '1' then 'dcat:' || p_type when '2' then 'dc:' || p_brand else null end as dc_field,
  case {_last('p_size')} when '0' then 'Exact match' when '1' then 'Closest match' when '2' then 'No match' when '3' then 'exact or partial' when '4' then 'NO DIRECT equivalent' when '5' then 'other' else 'Partial' end as mapping_type,
  case {_last('p_partkey')} when '1' then 'add' else null end as action
from part
"""

LETTERS = """
select c_custkey as id, case right(cast(c_custkey as string), 1)
  when '0' then null
  when '1' then ''
  when '2' then 'Tel ' || cast(6000000000 + c_custkey * 7919 as string) || ' PAN ABCDE' || lpad(right(cast(c_custkey as string), 4), 4, '0') || 'Z'
  when '3' then 'id 1234-5678-' || lpad(right(cast(c_custkey as string), 4), 4, '0') || ' and 1234 5678 9012, or 9876543210'
  else 'Call ' || cast(7000000000 + c_custkey as string) || ', ' || c_name end as text
from customer
"""


def derived(spark: SparkSession, sf_dir: str, sql: str, table: str) -> DataFrame:
    """The Spark side of one of the above."""
    return spark.sql(sql.replace(f"from {table}", "from {source}"), source=spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def duck(sql: str) -> str:
    """The DuckDB side."""
    return sql.replace("`", '"')
