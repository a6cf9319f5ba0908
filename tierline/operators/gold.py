"""Gold star schema: two dimensions with dense surrogate keys (G1, G2, G4) and the sales fact.

Surrogate keys are ``row_number`` over the dimension's sort order, computed in range buckets
(``dense_key``) instead of one global window task. Callers materialise the dimensions once (see
``plans.layers``), so keys are stable between the dimension table and the fact that uses them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions.codes import UNKNOWN
from tierline.operators.joins import (
    BROADCAST_MAX_ROWS, ROW_ID, fits_broadcast, hot_keys, lookup_join, with_row_id)
from tierline.operators.ranged import dense_key
from tierline.staging import Staged, Stats, measure_all, stage


def integrated_gender(crm_gender: Column, erp_gender: Column) -> Column:
    """CRM gender wins unless it is 'n/a' (or NULL); then the ERP gender; then 'n/a'."""
    return F.when(crm_gender != UNKNOWN, crm_gender).otherwise(F.coalesce(erp_gender, F.lit(UNKNOWN)))


def customers_joined(cust: DataFrame, erp_cust: DataFrame, erp_loc: DataFrame) -> DataFrame:
    """Silver CRM customers left-joined to ERP customers and locations on ``cst_key = cid``,
    renamed to the dimension's columns (no surrogate key yet).

    Each ERP side is broadcast when it passes the size check, else joined by a salted shuffle
    join, so NULL or hot customer keys do not pile up in one task.
    """
    ca = erp_cust.select(F.col("cid").alias("_tl_ca_cid"), F.col("bdate").alias("_tl_bdate"),
                         F.col("gen").alias("_tl_gen"))
    la = erp_loc.select(F.col("cid").alias("_tl_la_cid"), F.col("cntry").alias("_tl_cntry"))
    size_ca, size_la = measure_all([ca, la])      # both size checks at once
    joined = lookup_join(lookup_join(cust, ca, [("cst_key", "_tl_ca_cid")], stats=size_ca),
                         la, [("cst_key", "_tl_la_cid")], stats=size_la)
    return joined.select(
        F.col("cst_id").alias("customer_id"),
        F.col("cst_key").alias("customer_number"),
        F.col("cst_firstname").alias("firstname"),
        F.col("cst_lastname").alias("lastname"),
        F.col("_tl_cntry").alias("country"),
        F.col("cst_marital_status").alias("marital_status"),
        integrated_gender(F.col("cst_gndr"), F.col("_tl_gen")).alias("gender"),
        F.col("_tl_bdate").alias("birthdate"),
        F.col("cst_create_date").alias("create_date"))


def products_joined(prd: DataFrame, cat: DataFrame) -> DataFrame:
    """Current products (no end date) left-joined to categories on ``cat_id = id``."""
    pn = prd.filter(F.col("prd_end_dt").isNull())
    pc = cat.select(F.col("id").alias("_tl_id"), F.col("cat").alias("_tl_cat"),
                    F.col("subcat").alias("_tl_subcat"), F.col("maintenance").alias("_tl_maint"))
    joined = lookup_join(pn, pc, [("cat_id", "_tl_id")])
    return joined.select(
        F.col("prd_id").alias("product_id"),
        F.col("prd_key").alias("product_number"),
        F.col("prd_nm").alias("product_name"),
        F.col("cat_id").alias("category_id"),
        F.col("_tl_cat").alias("category"),
        F.col("_tl_subcat").alias("subcategory"),
        F.col("_tl_maint").alias("maintenance"),
        F.col("prd_cost").alias("cost"),
        F.col("prd_line").alias("product_line"),
        F.col("prd_start_dt").alias("start_dt"))


# Sort order of each key, and the column that makes it unique.
CUSTOMER_ORDER, CUSTOMER_ID = ["customer_id"], []
PRODUCT_ORDER, PRODUCT_ID = ["start_dt", "product_number"], ["product_id"]


def with_surrogate_key(df: DataFrame, order: list[str], unique: list[str], key: str, n_rows: int | None = None,
                       rows_per_bucket: int | None = None) -> DataFrame:
    """``key`` = 1..n in ``order``, then ``unique``, then all other columns, as the first column.

    Buckets are cut on the sort order and the unique id alone; the other columns only break ties
    inside a bucket, so the numbering is a function of the data (stable when a lost task is recomputed).
    """
    ranges = order + unique
    keyed = dense_key(df, ranges, key, n_rows=n_rows, rows_per_bucket=rows_per_bucket,
                      tie_cols=[c for c in df.columns if c not in ranges])
    return keyed.select(key, *df.columns)


def dim_customers(cust: DataFrame, erp_cust: DataFrame, erp_loc: DataFrame,
                  rows_per_bucket: int | None = None) -> DataFrame:
    """G1: customer dimension with ``customer_key`` = row number by ``customer_id``. The joined rows are
    written once; counting and numbering read that table."""
    joined = stage(customers_joined(cust, erp_cust, erp_loc), "dim-customers")
    return with_surrogate_key(joined.df, CUSTOMER_ORDER, CUSTOMER_ID, "customer_key", joined.stats.rows, rows_per_bucket)


def dim_products(prd: DataFrame, cat: DataFrame, rows_per_bucket: int | None = None) -> DataFrame:
    """Current-product dimension with ``product_key`` by (start date, product number)."""
    joined = stage(products_joined(prd, cat), "dim-products")
    return with_surrogate_key(joined.df, PRODUCT_ORDER, PRODUCT_ID, "product_key", joined.stats.rows, rows_per_bucket)


def fact_sales(sales: DataFrame, dim_prod: DataFrame, dim_cust: DataFrame, prod_stats: Stats | None = None,
               cust_stats: Stats | None = None, max_rows: int = BROADCAST_MAX_ROWS,
               fixed_order: bool = False) -> DataFrame:
    """Sales with surrogate keys looked up on the natural keys; unmatched -> NULL key, row kept.

    Each dimension's lookup columns are broadcast when their measured size (or ``prod_stats`` /
    ``cust_stats``, when known) fits, otherwise joined by a salted shuffle join. For that the sales are
    numbered and their hot keys counted once, on the base rows, before either join. ``fixed_order``: the
    sales come from a scan without a shuffle, so they need not be written to be numbered.
    """
    prod = dim_prod.select(F.col("product_number").alias("_tl_pn"), F.col("product_key"))
    cust = dim_cust.select(F.col("customer_id").alias("_tl_cid"), F.col("customer_key"))
    if prod_stats is None or cust_stats is None:
        prod_stats, cust_stats = measure_all([prod, cust])
    lookups = [(prod, ("sls_prd_key", "_tl_pn"), prod_stats), (cust, ("sls_cust_id", "_tl_cid"), cust_stats)]
    return _fact_columns(_looked_up(sales, lookups, max_rows, fixed_order))


def _looked_up(sales: DataFrame, lookups: Sequence[tuple[DataFrame, tuple[str, str], Stats]], max_rows: int,
               fixed_order: bool) -> DataFrame:
    salted = [not fits_broadcast(stats, max_rows) for _, _, stats in lookups]
    base = with_row_id(sales, fixed_order) if any(salted) else sales
    hot = [hot_keys(base, [pair[0]]) if s else None for (_, pair, _), s in zip(lookups, salted)]
    out = base
    for (side, pair, stats), keys in zip(lookups, hot):
        out = lookup_join(out, side, [pair], "left", max_rows=max_rows, stats=stats, hot=keys)
    return out


def key_counts(dim: DataFrame, natural: str) -> Staged:
    """Rows of a dimension by natural key (``natural``, ``_tl_n``), written once."""
    counted = dim.filter(F.col(natural).isNotNull()).groupBy(natural).agg(F.count(F.lit(1)).alias("_tl_n"))
    return stage(counted, "natural-keys")


def fact_lines(sales: DataFrame, prod_counts: Staged, cust_counts: Staged, max_rows: int = BROADCAST_MAX_ROWS,
               fixed_order: bool = False) -> DataFrame:
    """G3 before it fans out: one row per sales line with its natural keys, ``_tl_times`` (fact rows of the
    line: the product of its keys' rows in the dimensions, 1 where there is none) and ``_tl_bad`` (a key
    without a dimension row).

    A line whose product stands n times and whose customer m times in the dimensions is n * m fact rows. Where
    natural keys repeat, the lines and the dimensions' keys hold the same rows in a size that grows with the
    lines and the dimensions. ``max_rows`` and ``fixed_order`` as in ``fact_sales``.
    """
    prod = prod_counts.df.select(F.col("product_number").alias("_tl_pn"), F.col("_tl_n").alias("_tl_np"))
    cust = cust_counts.df.select(F.col("customer_id").alias("_tl_cid"), F.col("_tl_n").alias("_tl_nc"))
    found = _looked_up(sales, [(prod, ("sls_prd_key", "_tl_pn"), prod_counts.stats),
                               (cust, ("sls_cust_id", "_tl_cid"), cust_counts.stats)], max_rows, fixed_order)
    return found.select(
        *[F.col(c).alias(name) for name, c in LINE_COLUMNS.items()], "sls_prd_key", "sls_cust_id",
        (F.coalesce("_tl_np", F.lit(1)) * F.coalesce("_tl_nc", F.lit(1))).alias("_tl_times"),
        (F.col("_tl_np").isNull() | F.col("_tl_nc").isNull()).alias("_tl_bad"))


def fact_sales_bucketed(sales: DataFrame, dim_prod: DataFrame, dim_cust: DataFrame, prod_stats: Stats | None = None,
                        cust_stats: Stats | None = None, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """G3 over tables bucketed alike, the sales on ``sls_cust_id`` and the customers on ``customer_id``.

    Customers are joined bucket by bucket, without a shuffle of either side. A customer with more than half a
    bucket's fair share of the sales would make one task too long; if there is one (counted inside the
    buckets), the customers are looked up as in ``fact_sales``. Products are looked up as there.
    """
    if not hot_keys(sales, ["sls_cust_id"]).isEmpty():
        return fact_sales(sales, dim_prod, dim_cust, prod_stats, cust_stats, max_rows)
    cust = dim_cust.select(F.col("customer_id").alias("_tl_cid"), F.col("customer_key"))
    prod = dim_prod.select(F.col("product_number").alias("_tl_pn"), F.col("product_key"))
    joined = sales.join(cust.hint("merge"), sales["sls_cust_id"] == cust["_tl_cid"], "left")
    return _fact_columns(lookup_join(joined, prod, [("sls_prd_key", "_tl_pn")], "left", max_rows=max_rows, stats=prod_stats))


# The fact's columns: the line's own under their silver names, and the two surrogate keys.
LINE_COLUMNS = {"order_number": "sls_ord_num", "order_date": "sls_order_dt", "shipping_date": "sls_ship_dt",
                "due_date": "sls_due_dt", "sales_amount": "sls_sales", "quantity": "sls_quantity", "price": "sls_price"}
FACT_COLUMNS = ("order_number", "product_key", "customer_key", "order_date", "shipping_date", "due_date",
                "sales_amount", "quantity", "price")


def _fact_columns(found: DataFrame) -> DataFrame:
    return found.select(*[F.col(LINE_COLUMNS.get(c, c)).alias(c) for c in FACT_COLUMNS])
