"""Dirty bronze frames derived from the driver's tables.

The driver's tables are clean and do not have the warehouse's shape, so each bronze table is
derived from them by fixed arithmetic (nulls, padded codes, bad dates, wrong sales, duplicates).
The statements are plain SQL that runs unchanged in Spark and in DuckDB, so the same text builds
the Spark input and the DuckDB oracle's input. ``{orders}`` style placeholders name driver tables.

Work grows with the driver tables: every frame is a projection, an equi-join or a grouping of whole
tables. Missing partners come from ids that match nothing (``AX`` for ``AW``, ``X`` before a category),
never from dropped rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixture statements (schema and defects of each dirty bronze frame).
FIXTURE_SQL: dict[str, str] = {
    "crm_cust_info": """
select cast(case when o_orderkey % 97 = 0 then null else o_custkey end as int) as cst_id,
  concat('AW', lpad(cast(o_custkey as string), 8, '0')) as cst_key,
  concat(case when o_orderkey % 3 = 0 then '  ' else '' end, c_mktsegment) as cst_firstname,
  concat(c_name, case when o_orderkey % 7 = 0 then ' ' else '' end) as cst_lastname,
  case o_orderkey % 4 when 0 then 'S' when 1 then 'm ' when 2 then null else 'X' end as cst_marital_status,
  case o_orderkey % 5 when 0 then ' F' when 1 then 'M' when 2 then 'f' when 3 then '' else null end as cst_gndr,
  cast(o_orderdate as date) as cst_create_date, o_orderkey as src_seq
from {orders} join {customer} on o_custkey = c_custkey""",
    "crm_prd_info": """
select cast(p_partkey as int) as prd_id,
  concat(lpad(cast(cast(floor(p_partkey / 2400) as int) % 100 as string), 2, '0'), '-', lpad(cast(cast(floor(p_partkey / 24) as int) % 100 as string), 2, '0'),
         '-P', lpad(cast(cast((p_partkey - p_partkey % 3) / 3 as int) as string), 6, '0')) as prd_key,
  concat(p_name, case when p_partkey % 9 = 0 then ' ' else '' end) as prd_nm, cast(case when p_partkey % 50 = 0 then null else floor(p_retailprice) end as int) as prd_cost,
  case p_size % 6 when 0 then 'M ' when 1 then 'r' when 2 then 'S ' when 3 then 'T' when 4 then 'Q' else null end as prd_line,
  case p_partkey % 3 when 0 then timestamp '2011-07-01 00:00:00' when 1 then timestamp '2012-07-01 00:00:00' else timestamp '2013-07-01 00:00:00' end as prd_start_dt,
  case p_partkey % 3 when 0 then timestamp '2007-12-28 00:00:00' when 1 then timestamp '2008-12-27 00:00:00' else null end as prd_end_dt
from {part}""",
    "crm_sales_details": """
select concat('SO', cast(l_orderkey as string)) as sls_ord_num,
  concat('P', lpad(cast(cast((l_partkey - l_partkey % 3) / 3 as int) as string), 6, '0')) as sls_prd_key,
  cast(o_custkey as int) as sls_cust_id,
  cast(case l_orderkey % 50 when 0 then 0 when 1 then 32154 when 2 then year(o_orderdate) * 10000 + 1340 else year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) end as int) as sls_order_dt,
  cast(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) as int) as sls_ship_dt,
  cast(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) as int) as sls_due_dt,
  cast(case l_linenumber % 7 when 0 then null when 1 then -floor(l_extendedprice) when 2 then floor(l_extendedprice) + 1 else l_quantity * floor(l_extendedprice / l_quantity) end as int) as sls_sales,
  cast(l_quantity as int) as sls_quantity,
  cast(case l_suppkey % 10 when 0 then null when 1 then -floor(l_extendedprice / l_quantity) else floor(l_extendedprice / l_quantity) end as int) as sls_price
from {lineitem} join {orders} on l_orderkey = o_orderkey""",
    "erp_cust_az12": """
select concat(case when c_custkey % 2 = 0 then 'NAS' else '' end, case when c_custkey % 11 = 0 then 'AX' else 'AW' end, lpad(cast(c_custkey as string), 8, '0')) as cid,
  case when c_custkey % 40 = 0 then date '2999-01-01' when c_custkey % 41 = 0 then date '1916-02-10' else date '1971-10-06' end as bdate,
  case c_custkey % 6 when 0 then 'Female' when 1 then 'male ' when 2 then 'F' when 3 then 'M' when 4 then '' else null end as gen
from {customer}""",
    "erp_loc_a101": """
select concat(case when c_custkey % 13 = 0 then 'AX-' else 'AW-' end, lpad(cast(c_custkey as string), 8, '0')) as cid,
  case c_nationkey % 6 when 0 then 'DE' when 1 then 'USA' when 2 then 'US ' when 3 then ' ' when 4 then null else n_name end as cntry
from {customer} join {nation} on c_nationkey = n_nationkey""",
    "erp_px_cat_g1v2": """
select concat(case when g % 5 = 4 then 'X' else '' end, lpad(cast(cast(floor(g / 100) as int) % 100 as string), 2, '0'), '_', lpad(cast(g % 100 as string), 2, '0')) as id,
  min(p_type) as cat, concat(min(p_brand), case when g % 7 = 0 then ' ' else '' end) as subcat,
  case when g % 2 = 0 then 'Yes' else 'No' end as maintenance
from (select cast(floor(p_partkey / 24) as int) % 10000 as g, p_type, p_brand from {part}) parts
group by g""",
}

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

FIXTURE_NAMES = tuple(FIXTURE_SQL)

# Default "now" for the clock-dependent rules (future birth dates) when testing.
FIXED_AS_OF = "2026-01-01"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (Parquet, so filters and projections reach the scan)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _placeholders(text: str) -> list[str]:
    return [t for t in DRIVER_TABLES if "{" + t + "}" in text]


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Dirty bronze frame ``name`` built from the driver tables under ``sf_dir``."""
    text = FIXTURE_SQL[name]
    frames = {t: read_table(spark, sf_dir, t) for t in _placeholders(text)}
    return spark.sql(text, **frames)


def fixtures(spark: SparkSession, sf_dir: str, names=FIXTURE_NAMES) -> dict[str, DataFrame]:
    return {n: fixture(spark, sf_dir, n) for n in names}


def fixture_sql_plain(name: str) -> str:
    """The fixture statement over plainly named tables (for DuckDB, where they are views)."""
    text = FIXTURE_SQL[name]
    return text.format(**{t: t for t in DRIVER_TABLES})
