"""Registered queries: one Spark job per operator key, each over the driver tables at ``sf_dir``.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame. Inputs are the driver tables or
the dirty bronze frames Spark derives from them (``sources.fixtures``), so the work grows with the
tables. Outputs carry explicit names and types so that ``oracle.ORACLE_SQL`` can state the same
result in DuckDB. Keys that write (CSV extracts, tables) use a fresh folder under the shared
checkpoint folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions import codes
from tierline.functions.expressions import day_before
from tierline.operators import gold, quality, silver
from tierline.operators.joins import lookup_join
from tierline.operators.ranged import dense_key, lead_in_group
from tierline.plans.catalog import Warehouse
from tierline.plans.layers import run_all, run_concurrently, run_layers
from tierline.plans.sinks import append, delete_where, refresh
from tierline.session import register_scratch, scratch_path
from tierline.sources.delimited import read_extract, write_extract
from tierline.sources.fixtures import FIXED_AS_OF, fixture, read_table
from tierline.sources.schemas import BRONZE, SILVER, SOURCE_FILES
from tierline.staging import Staged, stage

# Rows per bucket for the keys that exercise the range-bucketed forms on small tables: the number of
# buckets grows with the rows.
SMALL_BUCKET = 4_000

# Buckets of the bucketed tables; on a cluster about the number of shuffle partitions.
BUCKETS = 16

Query = Callable[[SparkSession, str], DataFrame]


# ---- shared building blocks ------------------------------------------------------------------

def _bronze(spark, sf, name, with_seq=False):
    df = fixture(spark, sf, name)
    if name == "crm_cust_info" and not with_seq:
        df = df.drop("src_seq")
    return df


def s_cust(spark, sf, drop_null_ids=True):
    return silver.clean_crm_customers(_bronze(spark, sf, "crm_cust_info", True),
                                      drop_null_ids=drop_null_ids, tiebreak=["src_seq"])


def s_prd(spark, sf):
    return silver.clean_crm_products(_bronze(spark, sf, "crm_prd_info"))


def s_sales(spark, sf):
    return silver.clean_crm_sales(_bronze(spark, sf, "crm_sales_details"))


def s_az(spark, sf):
    return silver.clean_erp_customers(_bronze(spark, sf, "erp_cust_az12"), as_of=FIXED_AS_OF)


def s_loc(spark, sf):
    return silver.clean_erp_locations(_bronze(spark, sf, "erp_loc_a101"))


def s_cat(spark, sf):
    return silver.clean_erp_categories(_bronze(spark, sf, "erp_px_cat_g1v2"))


def _dim_customers(spark, sf, cust=None, rows_per_bucket=None):
    return gold.dim_customers(cust if cust is not None else s_cust(spark, sf), s_az(spark, sf), s_loc(spark, sf),
                              rows_per_bucket)


def _dim_products(spark, sf, rows_per_bucket=None):
    return gold.dim_products(s_prd(spark, sf), s_cat(spark, sf), rows_per_bucket)


def _staged_dims(spark, sf, cust=None) -> tuple[Staged, Staged]:
    """Both dimensions (product, customer) written once, concurrently, with their sizes: later size
    checks and joins read the files instead of recomputing the plans."""
    out = {}

    def product() -> None:
        out["prod"] = stage(_dim_products(spark, sf), "dim-products")

    def customer() -> None:
        out["cust"] = stage(_dim_customers(spark, sf, cust), "dim-customers")

    run_concurrently([product, customer])
    return out["prod"], out["cust"]


def _fact(spark, sf, prod: Staged, cust: Staged, sales=None, **kwargs):
    return gold.fact_sales(sales if sales is not None else s_sales(spark, sf), prod.df, cust.df, prod_stats=prod.stats, cust_stats=cust.stats, **kwargs)


def _as_dates(df, cols):
    return df.select(*[F.to_date(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def _wh(spark, tag):
    wh = Warehouse(spark, root=scratch_path(spark, f"wh-{tag}"), prefix=f"tl{uuid.uuid4().hex[:8]}_")
    for layer in ("bronze", "silver", "gold", "audit"):
        register_scratch(spark, "database", wh.db(layer))
    return wh


# ---- silver (T1-T6) ----------------------------------------------------------------------------

def q_silver_crm_cust_info(spark, sf):
    """T1 on the dirty customer frame (tie-break: source sequence)."""
    return s_cust(spark, sf)


def q_silver_crm_prd_info(spark, sf):
    """T2 on the dirty product frame."""
    return s_prd(spark, sf)


def q_silver_crm_sales_details(spark, sf):
    """T3 on the dirty sales frame."""
    return s_sales(spark, sf)


def q_silver_erp_cust_az12(spark, sf):
    """T4 with ``as_of`` fixed at 2026-01-01."""
    return s_az(spark, sf)


def q_silver_erp_loc_a101(spark, sf):
    """T5."""
    return s_loc(spark, sf)


def q_silver_erp_px_cat_g1v2(spark, sf):
    """T6."""
    return s_cat(spark, sf)


# ---- gold (G1-G4) ------------------------------------------------------------------------------

def q_dim_customers(spark, sf):
    """G1 + G4: customer dimension."""
    return _dim_customers(spark, sf)


def q_dim_products(spark, sf):
    """G2 + G4: current-product dimension."""
    return _dim_products(spark, sf)


def q_dim_customers_bucketed(spark, sf):
    """G1 + G4 in range buckets, as for a dimension too large for one task."""
    return _dim_customers(spark, sf, rows_per_bucket=SMALL_BUCKET // 40)


def q_dim_products_bucketed(spark, sf):
    """G2 + G4 in range buckets."""
    return _dim_products(spark, sf, rows_per_bucket=SMALL_BUCKET // 40)


def q_fact_sales(spark, sf):
    """Sales fact with surrogate keys."""
    return _fact(spark, sf, *_staged_dims(spark, sf))


def q_fact_sales_salted(spark, sf):
    """G3 by salted shuffle joins, as for dimensions too large to broadcast."""
    return _fact(spark, sf, *_staged_dims(spark, sf), max_rows=0)


def q_fact_sales_bucketed(spark, sf):
    """G3 with sales and customers in tables bucketed by customer."""
    prod, cust = _staged_dims(spark, sf)
    wh = _wh(spark, "bucketed")
    wh.publish("silver", "crm_sales_details", s_sales(spark, sf), bucket_by=(BUCKETS, "sls_cust_id"))
    wh.publish("gold", "dim_customers", cust.df, bucket_by=(BUCKETS, "customer_id"))
    return gold.fact_sales_bucketed(wh.read("silver", "crm_sales_details"), prod.df, wh.read("gold", "dim_customers"),
                                    prod_stats=prod.stats, cust_stats=cust.stats)


def q_sales_star(spark, sf):
    """The fact joined back to both dimensions: revenue lines with product and customer context."""
    prod, cust = _staged_dims(spark, sf)
    fact = _fact(spark, sf, prod, cust)
    dp = prod.df.select(F.col("product_key").alias("_tl_pk"), "product_name", "category", "product_line")
    dc = cust.df.select(F.col("customer_key").alias("_tl_ck"), "country", "gender")
    star = lookup_join(lookup_join(fact, dp, [("product_key", "_tl_pk")], stats=prod.stats),
                       dc, [("customer_key", "_tl_ck")], stats=cust.stats)
    return star.select("order_number", "order_date", "product_name", "category", "product_line",
                       "country", "gender", "quantity", "price", "sales_amount")


# ---- native driver tables ----------------------------------------------------------------------

def q_latest_order_per_customer(spark, sf):
    """T1's window on native orders: newest order per customer."""
    orders = read_table(spark, sf, "orders")
    latest = silver.latest_per_key(orders, "o_custkey",
                                   [F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey").desc()])
    return latest.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("order_date"),
                         "o_orderstatus")


def q_order_validity_ranges(spark, sf):
    """T2's ``lead`` on native orders, range-bucketed, heads in two levels."""
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    nxt = lead_in_group(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderdate",
                        "next_orderdate", rows_per_bucket=SMALL_BUCKET, fan=2)
    return nxt.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("valid_from"),
                      day_before("next_orderdate").alias("valid_to"))


def q_surrogate_key_bucketed(spark, sf):
    """G4's scalable form on native orders."""
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    keyed = dense_key(orders, ["o_orderdate", "o_orderkey"], "order_key", rows_per_bucket=SMALL_BUCKET)
    return keyed.select("order_key", "o_orderkey")


def _native_sales(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        F.floor(F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("int").alias("sls_sales"),
        F.col("l_quantity").cast("int").alias("sls_quantity"),
        (F.when(F.col("l_returnflag") == "R", F.lit(-1)).otherwise(F.lit(1))
         * F.floor(F.col("l_extendedprice") / F.col("l_quantity"))).cast("int").alias("sls_price"))


def q_sales_reconcile(spark, sf):
    """T3's sales and price rules on native line items."""
    s = _native_sales(spark, sf)
    q, p, a = F.col("sls_quantity"), F.col("sls_price"), F.col("sls_sales")
    return s.select("l_orderkey", "l_linenumber",
                    silver.repaired_sales(a, q, p).alias("sls_sales"), q.alias("sls_quantity"),
                    silver.repaired_price(a, q, p).alias("sls_price"))


# ---- data quality (Q1-Q15) ---------------------------------------------------------------------

def q_dq_duplicate_keys(spark, sf):
    """Q1 on native line items (order, line number)."""
    return quality.duplicate_keys(read_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_dq_null_or_duplicate_id(spark, sf):
    """Q1 with its NULL branch on the dirty customers."""
    return quality.duplicate_keys(_bronze(spark, sf, "crm_cust_info"), "cst_id")


def q_dq_nulls(spark, sf):
    """Q2: product rows with a NULL cost or line."""
    rows = quality.null_rows(_bronze(spark, sf, "crm_prd_info"), ["prd_cost", "prd_line"])
    return _as_dates(rows, {"prd_start_dt", "prd_end_dt"})


def q_dq_spaces(spark, sf):
    """Q3: customer rows whose names have leading or trailing spaces."""
    return quality.spaced_rows(_bronze(spark, sf, "crm_cust_info"), ["cst_firstname", "cst_lastname"])


def q_dq_spaces_product_name(spark, sf):
    """Q3: product rows whose name has leading or trailing spaces."""
    rows = quality.spaced_rows(_bronze(spark, sf, "crm_prd_info"), ["prd_nm"])
    return _as_dates(rows, {"prd_start_dt", "prd_end_dt"})


def q_dq_spaces_categories(spark, sf):
    """Q3: category rows with such spaces in any of three columns."""
    return quality.spaced_rows(_bronze(spark, sf, "erp_px_cat_g1v2"), ["cat", "subcat", "maintenance"])


def q_dq_domain(spark, sf):
    """Q4: distinct silver countries, sorted."""
    return quality.domain(s_loc(spark, sf), "cntry")


def q_dq_domain_product_line(spark, sf):
    """Q4: distinct raw product lines."""
    return quality.domain(_bronze(spark, sf, "crm_prd_info"), "prd_line")


def q_dq_domain_categories(spark, sf):
    """Q4: distinct (category, subcategory, maintenance)."""
    return quality.domain(_bronze(spark, sf, "erp_px_cat_g1v2"), ["cat", "subcat", "maintenance"])


def q_dq_negative(spark, sf):
    """Q5 on native customer balances."""
    return quality.negative_rows(read_table(spark, sf, "customer"), "c_acctbal", keep=["c_custkey"])


def q_dq_negative_cost(spark, sf):
    """Q5 on product costs."""
    return quality.negative_rows(_bronze(spark, sf, "crm_prd_info"), "prd_cost", keep=["prd_id"])


def q_dq_date_order(spark, sf):
    """Q6 on native data: line items shipped before their order date."""
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    joined = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    bad = quality.date_order_rows(joined, [("o_orderdate", "l_shipdate")])
    return bad.select("l_orderkey", "l_linenumber", F.to_date("o_orderdate").alias("order_date"),
                      F.to_date("l_shipdate").alias("ship_date"))


def q_dq_date_order_products(spark, sf):
    """Q6: product end before start."""
    bad = quality.date_order_rows(_bronze(spark, sf, "crm_prd_info"), [("prd_start_dt", "prd_end_dt")])
    return _as_dates(bad, {"prd_start_dt", "prd_end_dt"})


def q_dq_date_order_sales(spark, sf):
    """Q6: order date after ship or due date (integer dates)."""
    return quality.date_order_rows(_bronze(spark, sf, "crm_sales_details"),
                                   [("sls_order_dt", "sls_ship_dt"), ("sls_order_dt", "sls_due_dt")])


def q_dq_int_dates(spark, sf):
    """Q7: invalid integer order dates."""
    return quality.int_date_rows(_bronze(spark, sf, "crm_sales_details"), "sls_order_dt")


def q_dq_sales_consistency(spark, sf):
    """Q8: inconsistent sales with proposed repairs."""
    return quality.sales_consistency(_bronze(spark, sf, "crm_sales_details"))


def q_dq_birthdate_range(spark, sf):
    """Q9: implausible birth dates."""
    return quality.birthdate_rows(_bronze(spark, sf, "erp_cust_az12"), as_of=FIXED_AS_OF)


def q_dq_gender_map(spark, sf):
    """Q10: raw gender code -> word."""
    return quality.code_preview(_bronze(spark, sf, "erp_cust_az12"), "gen", codes.ERP_GENDER)


def _seeded_customers(spark, sf):
    """All customers; the seeded defect gives a tenth of them an id and key that nothing refers to."""
    moved = F.col("cst_id") % 10 == 0
    return (s_cust(spark, sf)
            .withColumn("cst_key", F.when(moved, F.concat(F.lit("ZZ"), F.col("cst_key").substr(3, 50))).otherwise(F.col("cst_key")))
            .withColumn("cst_id", F.when(moved, -F.col("cst_id") - 1).otherwise(F.col("cst_id"))))


def q_dq_orphans_not_in(spark, sf):
    """Q11 with the seeded defect."""
    return quality.location_orphans(_bronze(spark, sf, "erp_loc_a101"), _seeded_customers(spark, sf))


def q_dq_orphans_not_in_salted(spark, sf):
    """Q11 by a salted shuffle join, as for a subquery too large to broadcast."""
    return quality.location_orphans(_bronze(spark, sf, "erp_loc_a101"), _seeded_customers(spark, sf), max_rows=0,
                                    salted=True)


def q_dq_orphans_not_in_filter(spark, sf):
    """Q11 by a Bloom filter of the customer keys, as for a subquery too large to broadcast."""
    return quality.location_orphans(_bronze(spark, sf, "erp_loc_a101"), _seeded_customers(spark, sf), max_rows=0)


def q_dq_orphans_not_in_null(spark, sf):
    """A NULL in the subquery empties the result."""
    cust = _seeded_customers(spark, sf).select("cst_key")
    # The seeded defect: one NULL key (a global aggregate yields exactly one row).
    null_row = cust.agg(F.max(F.lit(None).cast("string")).alias("cst_key"))
    with_null = cust.unionByName(null_row)
    return quality.location_orphans(_bronze(spark, sf, "erp_loc_a101"), with_null)


def q_dq_customer_fanout(spark, sf):
    """Q12 with the seeded defect (duplicated location ids)."""
    loc = s_loc(spark, sf)
    seeded = loc.unionByName(loc.filter(F.col("cid").endswith("00")))
    return quality.customer_fanout(s_cust(spark, sf), s_az(spark, sf), seeded)


def q_dq_gender_matrix(spark, sf):
    """Q13: CRM gender x ERP gender -> integrated gender."""
    return quality.gender_matrix(s_cust(spark, sf), s_az(spark, sf))


def q_dq_product_fanout(spark, sf):
    """Q14 with the seeded defect (duplicated categories)."""
    cat = s_cat(spark, sf)
    seeded = cat.unionByName(cat.filter(F.col("id").endswith("0")))
    return quality.product_fanout(s_prd(spark, sf), seeded)


def q_dq_fk_integrity(spark, sf):
    """Q15 with the seeded defect (customers that the sales don't refer to)."""
    dp, dc = _staged_dims(spark, sf, cust=_seeded_customers(spark, sf))
    return quality.fk_integrity(_fact(spark, sf, dp, dc), dc.df, dp.df, cust_stats=dc.stats, prod_stats=dp.stats)


def q_dq_fk_integrity_filter(spark, sf):
    """Q15 by Bloom filters of both dimensions' keys, as for dimensions too large to broadcast.
    The check scans the fact more than once, so the cleaned sales it is made of are written before."""
    dp, dc = _staged_dims(spark, sf, cust=_seeded_customers(spark, sf))
    sales = stage(s_sales(spark, sf), "sales").df
    return quality.fk_integrity(_fact(spark, sf, dp, dc, sales), dc.df, dp.df, cust_stats=dc.stats, prod_stats=dp.stats,
                                max_rows=0)


def q_dq_spaces_source_collation(spark, sf):
    """Q3 as the source system's collation sees it: leading spaces only."""
    return quality.spaced_rows(_bronze(spark, sf, "crm_cust_info"), ["cst_firstname", "cst_lastname"],
                               codes.SOURCE_COLLATION)


def q_silver_erp_loc_a101_collated(spark, sf):
    """T5 with codes compared under the source system's collation (the seeded defect: lower-case countries)."""
    loc = _bronze(spark, sf, "erp_loc_a101")
    seeded = loc.withColumn("cntry", F.when(F.col("cid").endswith("3"), F.lower("cntry")).otherwise(F.col("cntry")))
    return silver.clean_erp_locations(seeded, collation=codes.SOURCE_COLLATION)


def q_dq_summary_one_pass(spark, sf):
    """Q2 Q3 Q5 Q6 Q7 Q8 Q9 counted in one pass per bronze table."""
    bronze = {t: _bronze(spark, sf, t) for t in ("crm_cust_info", "crm_prd_info", "crm_sales_details",
                                                 "erp_cust_az12", "erp_px_cat_g1v2")}
    return quality.quality_summary(bronze, as_of=FIXED_AS_OF)


# ---- sources, sinks, catalog, pipeline (S1-S10, O1-O5) ----------------------------------------

def q_bronze_csv_load(spark, sf):
    """S1 + S5: write the customer frame as an extract, read it back by position."""
    path = scratch_path(spark, "extract-cust")
    write_extract(_bronze(spark, sf, "crm_cust_info"), path)
    return read_extract(spark, path, BRONZE["crm_cust_info"], keep_corrupt=False)


def q_bronze_refresh_twice(spark, sf):
    """Refreshing twice leaves the rows of one load."""
    path = scratch_path(spark, "extract-prd")
    write_extract(_bronze(spark, sf, "crm_prd_info"), path)
    wh = _wh(spark, "refresh")
    for _ in range(2):
        refresh(wh, "bronze", "crm_prd_info", read_extract(spark, path, BRONZE["crm_prd_info"], keep_corrupt=False))
    return _as_dates(wh.read("bronze", "crm_prd_info"), {"prd_start_dt", "prd_end_dt"})


def q_silver_append_default(spark, sf):
    """S3 + S4: append by column name; the audit column takes its default."""
    wh = _wh(spark, "append")
    wh.create_table("silver", "crm_cust_info", SILVER["crm_cust_info"], with_audit=True)
    append(wh, "silver", "crm_cust_info", s_cust(spark, sf, drop_null_ids=False))
    out = wh.read("silver", "crm_cust_info")
    return out.filter(F.col("dwh_create_date").isNotNull()).drop("dwh_create_date")


def q_delete_null_keys(spark, sf):
    """Delete NULL ids by publishing the kept rows as the next version."""
    wh = _wh(spark, "delete")
    refresh(wh, "bronze", "crm_cust_info", _bronze(spark, sf, "crm_cust_info"))
    delete_where(wh, "bronze", "crm_cust_info", F.col("cst_id").isNull())
    return wh.read("bronze", "crm_cust_info")


def q_catalog_views(spark, sf):
    """Namespaces, drop-if-exists of published tables, published view read back."""
    wh = _wh(spark, "catalog")
    wh.ensure_layers()
    for _ in range(2):  # the second round drops and re-creates what the first published
        for name in ("crm_prd_info", "erp_px_cat_g1v2"):
            wh.drop_table("silver", name)
            wh.create_table("silver", name, SILVER[name], with_audit=True)
        append(wh, "silver", "crm_prd_info", s_prd(spark, sf))
        append(wh, "silver", "erp_px_cat_g1v2", s_cat(spark, sf))
        wh.drop_view("gold", "dim_products")
        dim = gold.dim_products(wh.read("silver", "crm_prd_info").drop("dwh_create_date"),
                                wh.read("silver", "erp_px_cat_g1v2").drop("dwh_create_date"))
        refresh(wh, "gold", "dim_products", dim)
    return wh.read("gold", "dim_products")


# Sales rows staged with an unreadable quantity: every customer id with this remainder of 50.
BAD_QUANTITY = 3


def stage_extracts(spark, sf, root: str) -> str:
    """Write the six dirty bronze frames as delimited extracts in the source folder layout; some sales
    rows hold text where a number belongs."""
    def extract(name: str):
        df = _bronze(spark, sf, name)
        if name == "crm_sales_details":
            bad = F.col("sls_cust_id") % 50 == BAD_QUANTITY
            text = F.when(bad, F.lit("n/a")).otherwise(F.col("sls_quantity").cast("string"))
            df = df.withColumn("sls_quantity", text)
        return df

    run_concurrently([lambda n=name, r=rel: write_extract(extract(n), f"{root}/{r}")
                      for name, rel in SOURCE_FILES.items()])
    return root


def _pipeline(spark, sf, layers, run_id=None):
    """The named layer steps over staged extracts: the warehouse and its audit rows."""
    wh = _wh(spark, "run")
    sources = stage_extracts(spark, sf, scratch_path(spark, "sources"))
    return wh, run_layers(wh, layers, sources, as_of=FIXED_AS_OF, run_id=run_id)


def q_bronze_rejects(spark, sf):
    """Rows of the staged sales extract that don't parse, with their raw text and file."""
    wh, _ = _pipeline(spark, sf, ("bronze",))
    rejects = wh.read("bronze", "crm_sales_details_rejects")
    return rejects.select(F.col("_raw").alias("raw"), F.col("_file").contains("sales_details.csv").alias("from_sales"))


def q_silver_append_repeat(spark, sf):
    """S3: a run appended twice counts once; the contents of all six silver tables, as text."""
    wh, _ = _pipeline(spark, sf, ("bronze", "silver", "append"), run_id="first")
    run_layers(wh, ("append",), as_of=FIXED_AS_OF, run_id="first")
    out = None
    for t in SILVER:
        cells = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in SILVER[t].fieldNames()]
        # counted table by table: the name is added to the counted rows, not carried to them
        rows = wh.read("silver", t).groupBy(F.concat_ws("|", *cells).alias("row_text")).agg(F.count(F.lit(1)).alias("n_rows"))
        rows = rows.select(F.lit(t).alias("table_name"), "row_text", "n_rows")
        out = rows if out is None else out.unionByName(rows)
    return out


def q_silver_append_all(spark, sf):
    """S3 for all six tables: silver loaded, then the six append variants into the same tables; rows
    per table."""
    wh, _ = _pipeline(spark, sf, ("bronze", "silver", "append"))
    parts = [wh.read("silver", t).agg(F.count(F.lit(1)).alias("rows"))
             .select(F.lit(t).alias("table_name"), "rows") for t in SILVER]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_silver_append_gold(spark, sf):
    """S3 into the tables gold reads: load silver, append, rebuild gold; the customer dimension with the
    appended rows."""
    wh, _ = _pipeline(spark, sf, ("bronze", "silver", "append", "gold"))
    return wh.read("gold", "dim_customers")


def q_pipeline_dim_customers(spark, sf):
    """What a full run publishes as ``gold.dim_customers``."""
    return _pipeline(spark, sf, ("bronze", "silver", "gold"))[0].read("gold", "dim_customers")


def q_pipeline_dim_products(spark, sf):
    """What a full run publishes as ``gold.dim_products``."""
    return _pipeline(spark, sf, ("bronze", "silver", "gold"))[0].read("gold", "dim_products")


def q_pipeline_fact_sales(spark, sf):
    """What a full run publishes as ``gold.fact_sales``."""
    return _pipeline(spark, sf, ("bronze", "silver", "gold"))[0].read("gold", "fact_sales")


def q_load_audit(spark, sf):
    """Full run through staged extracts; rows, bad rows and status per layer and table."""
    sources = stage_extracts(spark, sf, scratch_path(spark, "sources"))
    audit = run_all(_wh(spark, "run"), sources, as_of=FIXED_AS_OF)
    return audit.select("layer", "table_name", "rows", "bad_rows", "status")


QUERIES: dict[str, Query] = {
    "silver_crm_cust_info": q_silver_crm_cust_info,
    "silver_crm_prd_info": q_silver_crm_prd_info,
    "silver_crm_sales_details": q_silver_crm_sales_details,
    "silver_erp_cust_az12": q_silver_erp_cust_az12,
    "silver_erp_loc_a101": q_silver_erp_loc_a101,
    "silver_erp_px_cat_g1v2": q_silver_erp_px_cat_g1v2,
    "dim_customers": q_dim_customers,
    "dim_products": q_dim_products,
    "dim_customers_bucketed": q_dim_customers_bucketed,
    "dim_products_bucketed": q_dim_products_bucketed,
    "fact_sales": q_fact_sales,
    "fact_sales_salted": q_fact_sales_salted,
    "fact_sales_bucketed": q_fact_sales_bucketed,
    "sales_star": q_sales_star,
    "latest_order_per_customer": q_latest_order_per_customer,
    "order_validity_ranges": q_order_validity_ranges,
    "surrogate_key_bucketed": q_surrogate_key_bucketed,
    "sales_reconcile": q_sales_reconcile,
    "dq_duplicate_keys": q_dq_duplicate_keys,
    "dq_null_or_duplicate_id": q_dq_null_or_duplicate_id,
    "dq_nulls": q_dq_nulls,
    "dq_spaces": q_dq_spaces,
    "dq_spaces_product_name": q_dq_spaces_product_name,
    "dq_spaces_categories": q_dq_spaces_categories,
    "dq_domain": q_dq_domain,
    "dq_domain_product_line": q_dq_domain_product_line,
    "dq_domain_categories": q_dq_domain_categories,
    "dq_negative": q_dq_negative,
    "dq_negative_cost": q_dq_negative_cost,
    "dq_date_order": q_dq_date_order,
    "dq_date_order_products": q_dq_date_order_products,
    "dq_date_order_sales": q_dq_date_order_sales,
    "dq_int_dates": q_dq_int_dates,
    "dq_sales_consistency": q_dq_sales_consistency,
    "dq_birthdate_range": q_dq_birthdate_range,
    "dq_gender_map": q_dq_gender_map,
    "dq_orphans_not_in": q_dq_orphans_not_in,
    "dq_orphans_not_in_salted": q_dq_orphans_not_in_salted,
    "dq_orphans_not_in_filter": q_dq_orphans_not_in_filter,
    "dq_orphans_not_in_null": q_dq_orphans_not_in_null,
    "dq_customer_fanout": q_dq_customer_fanout,
    "dq_gender_matrix": q_dq_gender_matrix,
    "dq_product_fanout": q_dq_product_fanout,
    "dq_fk_integrity": q_dq_fk_integrity,
    "dq_fk_integrity_filter": q_dq_fk_integrity_filter,
    "dq_spaces_source_collation": q_dq_spaces_source_collation,
    "silver_erp_loc_a101_collated": q_silver_erp_loc_a101_collated,
    "dq_summary_one_pass": q_dq_summary_one_pass,
    "bronze_csv_load": q_bronze_csv_load,
    "bronze_refresh_twice": q_bronze_refresh_twice,
    "silver_append_default": q_silver_append_default,
    "delete_null_keys": q_delete_null_keys,
    "catalog_views": q_catalog_views,
    "silver_append_all": q_silver_append_all,
    "silver_append_gold": q_silver_append_gold,
    "silver_append_repeat": q_silver_append_repeat,
    "bronze_rejects": q_bronze_rejects,
    "pipeline_dim_customers": q_pipeline_dim_customers,
    "pipeline_dim_products": q_pipeline_dim_products,
    "pipeline_fact_sales": q_pipeline_fact_sales,
    "load_audit": q_load_audit,
}
