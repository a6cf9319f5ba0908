"""Typed table definitions of the bronze and silver layers.

Fixed values: the column names, order and types below must equal the source system's table
definitions, because delimited extracts are bound to them by position. Strings are limited to
50 characters in the tables (``VARCHAR(50)``); readers use plain strings.
"""

from __future__ import annotations

from pyspark.sql import types as T

from tierline.session import PARQUET_OPTIONS

STRING_LIMIT = 50

_S, _I, _D, _TS = T.StringType(), T.IntegerType(), T.DateType(), T.TimestampType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Bronze table definitions (name -> ordered columns).
BRONZE: dict[str, T.StructType] = {
    "crm_cust_info": _struct(
        ("cst_id", _I), ("cst_key", _S), ("cst_firstname", _S), ("cst_lastname", _S),
        ("cst_marital_status", _S), ("cst_gndr", _S), ("cst_create_date", _D)),
    "crm_prd_info": _struct(
        ("prd_id", _I), ("prd_key", _S), ("prd_nm", _S), ("prd_cost", _I), ("prd_line", _S),
        ("prd_start_dt", _TS), ("prd_end_dt", _TS)),
    "crm_sales_details": _struct(
        ("sls_ord_num", _S), ("sls_prd_key", _S), ("sls_cust_id", _I), ("sls_order_dt", _I),
        ("sls_ship_dt", _I), ("sls_due_dt", _I), ("sls_sales", _I), ("sls_quantity", _I),
        ("sls_price", _I)),
    "erp_loc_a101": _struct(("cid", _S), ("cntry", _S)),
    "erp_cust_az12": _struct(("cid", _S), ("bdate", _D), ("gen", _S)),
    "erp_px_cat_g1v2": _struct(("id", _S), ("cat", _S), ("subcat", _S), ("maintenance", _S)),
}

# Silver table definitions, without the audit column.
SILVER: dict[str, T.StructType] = {
    "crm_cust_info": BRONZE["crm_cust_info"],
    "crm_prd_info": _struct(
        ("prd_id", _I), ("cat_id", _S), ("prd_key", _S), ("prd_nm", _S), ("prd_cost", _I),
        ("prd_line", _S), ("prd_start_dt", _D), ("prd_end_dt", _D)),
    "crm_sales_details": _struct(
        ("sls_ord_num", _S), ("sls_prd_key", _S), ("sls_cust_id", _I), ("sls_order_dt", _D),
        ("sls_ship_dt", _D), ("sls_due_dt", _D), ("sls_sales", _I), ("sls_quantity", _I),
        ("sls_price", _I)),
    "erp_loc_a101": BRONZE["erp_loc_a101"],
    "erp_cust_az12": BRONZE["erp_cust_az12"],
    "erp_px_cat_g1v2": BRONZE["erp_px_cat_g1v2"],
}

AUDIT_COLUMN = "dwh_create_date"

# Source file of each bronze table, relative to the extract root.
SOURCE_FILES: dict[str, str] = {
    "crm_cust_info": "source_crm/cust_info.csv",
    "crm_prd_info": "source_crm/prd_info.csv",
    "crm_sales_details": "source_crm/sales_details.csv",
    "erp_loc_a101": "source_erp/LOC_A101.csv",
    "erp_cust_az12": "source_erp/CUST_AZ12.csv",
    "erp_px_cat_g1v2": "source_erp/PX_CAT_G1V2.csv",
}


def _sql_type(dt: T.DataType) -> str:
    if isinstance(dt, T.StringType):
        return f"VARCHAR({STRING_LIMIT})"
    return dt.simpleString().upper()


# Raw text and file of a row that did not parse; NULL in all other rows.
REJECT_COLUMNS = ("_raw", "_file")


def table_ddl(qualified_name: str, schema: T.StructType, with_audit: bool = False,
              location: str | None = None, with_rejects: bool = False) -> str:
    """``CREATE TABLE`` text with 50-character strings and, for silver, a defaulted audit column; with
    ``with_rejects`` the columns of rows that did not parse."""
    cols = [f"{f.name} {_sql_type(f.dataType)}" for f in schema.fields]
    if with_audit:
        cols.append(f"{AUDIT_COLUMN} TIMESTAMP DEFAULT current_timestamp()")
    if with_rejects:
        cols += [f"{c} STRING" for c in REJECT_COLUMNS]
    loc = f" LOCATION '{location}'" if location else ""
    options = ", ".join(f"'{k}' = '{v}'" for k, v in PARQUET_OPTIONS.items())
    return f"CREATE TABLE {qualified_name} ({', '.join(cols)}) USING parquet OPTIONS ({options}){loc}"
