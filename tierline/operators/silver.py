"""Silver cleaning jobs T1-T6: bronze frame in, cleaned frame out (audit column not included).

Every rule is one ``select`` over the *raw* columns, as in the source system's statements: an
output alias is never visible inside the same select, so e.g. the product history window is
partitioned by the raw product key and the derived price divides the raw sales amount.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.functions import codes
from tierline.functions.expressions import (
    day_before, int_to_date, map_code, remainder_from, strip_prefix)
from tierline.operators.ranged import lead_in_group


SILVER_COLUMNS_T1 = ("cst_id", "cst_key", "cst_firstname", "cst_lastname", "cst_marital_status", "cst_gndr",
                     "cst_create_date")


def latest_per_key(df: DataFrame, key: str | Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """Keep one row per ``key``: the first by ``newest_first`` (e.g. ``[desc(date), desc(seq)]``).

    ``row_number() = 1`` over the key window: Spark turns this into a partial top-1 before the
    shuffle and a final one after it (``WindowGroupLimit``), so a key holding millions of rows
    sends at most one row per map task across the network.
    """
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_tl_rn", F.row_number().over(w)).filter(F.col("_tl_rn") == 1).drop("_tl_rn")


def _tiebreak(df: DataFrame, used: Sequence[str], tiebreak: Sequence[str] | None) -> list[str]:
    if tiebreak is not None:
        return list(tiebreak)
    return [c for c in df.columns if c not in used]


def clean_crm_customers(df: DataFrame, drop_null_ids: bool = True, tiebreak: Sequence[str] | None = None,
                        key: str = "cst_id", created: str = "cst_create_date",
                        names: Sequence[str] = ("cst_firstname", "cst_lastname"),
                        coded: Mapping[str, Mapping[str, str]] | None = None,
                        keep: Sequence[str] | None = SILVER_COLUMNS_T1) -> DataFrame:
    """Newest row per ``key``, trimmed ``names``, coded columns as words.

    ``drop_null_ids=False`` is the append variant, which keeps one row for the NULL id group.
    Equal newest dates are broken by ``tiebreak`` (descending; default: all other columns) so the
    result does not depend on shuffle order. ``coded`` maps a column to its code map (default:
    marital status and gender). ``keep`` lists the output columns (None: all input columns).
    """
    coded = coded if coded is not None else {"cst_marital_status": codes.MARITAL_STATUS,
                                             "cst_gndr": codes.CRM_GENDER}
    if drop_null_ids:
        df = df.filter(F.col(key).isNotNull())
    tb = _tiebreak(df, [key, created], tiebreak)
    latest = latest_per_key(df, key, [F.col(created).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in tb]])

    def out(c: str) -> Column:
        if c in names:
            return F.trim(c).alias(c)
        if c in coded:
            return map_code(c, coded[c]).alias(c)
        return F.col(c)

    return latest.select(*[out(c) for c in (keep if keep is not None else df.columns)])


def clean_crm_products(df: DataFrame, tiebreak: Sequence[str] = ("prd_id",), rows_per_bucket: int | None = None,
                       line_codes: Mapping[str, str] = codes.PRODUCT_LINE, n_rows: int | None = None) -> DataFrame:
    """Category id and product number from the key, cost 0 when missing, line as a word,
    dates as DATE, and the history end = the day before the next start of the same raw key.

    The source's own end date is ignored. ``lead`` runs in range buckets (no hot key task).
    """
    with_next = lead_in_group(df, ["prd_key"], ["prd_start_dt", *tiebreak], "prd_start_dt",
                              "_tl_next_start", rows_per_bucket=rows_per_bucket, n_rows=n_rows)
    return with_next.select(
        "prd_id",
        F.replace(F.col("prd_key").substr(1, codes.CATEGORY_ID_LENGTH), F.lit("-"), F.lit("_")).alias("cat_id"),
        remainder_from("prd_key", codes.PRODUCT_NUMBER_START).alias("prd_key"),
        "prd_nm",
        F.coalesce(F.col("prd_cost"), F.lit(0)).alias("prd_cost"),
        map_code("prd_line", line_codes).alias("prd_line"),
        F.to_date("prd_start_dt").alias("prd_start_dt"),
        day_before("_tl_next_start").alias("prd_end_dt"))


def repaired_sales(sales: Column, quantity: Column, price: Column) -> Column:
    """Sales recomputed as quantity x |price| when missing, not positive, or inconsistent."""
    expected = quantity * F.abs(price)
    return F.when(sales.isNull() | (sales <= 0) | (sales != expected), expected).otherwise(sales)


def repaired_price(sales: Column, quantity: Column, price: Column) -> Column:
    """Price derived as raw sales / quantity when missing or not positive: integer division
    toward zero (``div``), quantity 0 -> NULL."""
    derived = F.call_function("div", sales, F.nullif(quantity, F.lit(0))).cast("int")
    return F.when(price.isNull() | (price <= 0), derived).otherwise(price)


def clean_crm_sales(df: DataFrame, order_dt: str = "sls_order_dt", ship_dt: str = "sls_ship_dt",
                    due_dt: str = "sls_due_dt", sales: str = "sls_sales", quantity: str = "sls_quantity",
                    price: str = "sls_price") -> DataFrame:
    """Integer dates to DATE (bad -> NULL), sales and price repaired in one select."""
    s, q, p = F.col(sales), F.col(quantity), F.col(price)
    out = []
    for c in df.columns:
        if c in (order_dt, ship_dt, due_dt):
            out.append(int_to_date(c).alias(c))
        elif c == sales:
            out.append(repaired_sales(s, q, p).alias(c))
        elif c == price:
            out.append(repaired_price(s, q, p).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def clean_erp_customers(df: DataFrame, as_of: str | Column | None = None,
                        gender_codes: Mapping[str, str] = codes.ERP_GENDER,
                        id_prefix: str = codes.ERP_ID_PREFIX) -> DataFrame:
    """T4: strip the id prefix, birth dates after ``as_of`` (default today) -> NULL, gender words."""
    now = F.current_date() if as_of is None else (as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date"))
    return df.select(
        strip_prefix("cid", id_prefix).alias("cid"),
        F.when(F.col("bdate") > now, F.lit(None).cast("date")).otherwise(F.col("bdate")).alias("bdate"),
        map_code("gen", gender_codes).alias("gen"))


def clean_erp_locations(df: DataFrame, country_codes: Mapping[str, str] = codes.COUNTRY,
                        collation: str | None = None) -> DataFrame:
    """T5: remove '-' from the id; country codes to names, blank or NULL -> 'n/a', else trimmed. With a
    ``collation`` (such as ``codes.SOURCE_COLLATION``) codes are compared under it."""
    cntry = F.trim("cntry")
    code = cntry if collation is None else F.collate(cntry, collation)
    named = map_code("cntry", country_codes, default=None, normalize=lambda _: code)
    return df.select(
        F.replace(F.col("cid"), F.lit(codes.LOCATION_ID_SEPARATOR), F.lit("")).alias("cid"),
        F.when(named.isNotNull(), named)
         .when((cntry == "") | F.col("cntry").isNull(), F.lit(codes.UNKNOWN))
         .otherwise(cntry).alias("cntry"))


def clean_erp_categories(df: DataFrame) -> DataFrame:
    """Categories are copied unchanged."""
    return df.select("id", "cat", "subcat", "maintenance")


SILVER_JOBS = {
    "crm_cust_info": clean_crm_customers,
    "crm_prd_info": clean_crm_products,
    "crm_sales_details": clean_crm_sales,
    "erp_cust_az12": clean_erp_customers,
    "erp_loc_a101": clean_erp_locations,
    "erp_px_cat_g1v2": clean_erp_categories,
}
