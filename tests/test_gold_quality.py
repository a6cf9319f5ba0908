"""Gold model and data-quality checks on tiny frames (rows taken from the shipped samples)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tierline.functions import codes
from tierline.operators import gold, quality, silver
from tierline.sources.schemas import BRONZE

from test_silver_rules import PRD_SAMPLE

D = dt.date
CATS = [("AC_HE", "Accessories", "Helmets", "Yes"), ("CO_PD", "Components", "Pedals", "No"),
        ("CO_RF", "Components", "Road Frames", "No")]


def _products(spark):
    prd = silver.clean_crm_products(spark.createDataFrame(PRD_SAMPLE, BRONZE["crm_prd_info"]))
    cat = spark.createDataFrame(CATS, BRONZE["erp_px_cat_g1v2"])
    return prd, cat


def test_dim_products_current_only_keys_by_start_then_number(spark):
    prd, cat = _products(spark)
    dim = gold.dim_products(prd, cat).orderBy("product_key").collect()
    assert [(r["product_key"], r["product_id"], r["category"]) for r in dim] == [
        (1, 210, "Components"), (2, 214, "Accessories"), (3, 542, None)]   # CO_PE has no category
    assert dict(gold.dim_products(prd, cat).dtypes)["product_key"] == "bigint"


def test_dim_customers_gender_integration_and_fact_keys(spark):
    cust = spark.createDataFrame([
        (1, "AW1", "A", "B", "Single", "n/a", D(2020, 1, 1)),
        (2, "AW2", "C", "D", "Married", "Male", D(2020, 1, 2)),
        (3, "AW3", "E", "F", "n/a", "n/a", D(2020, 1, 3)),
    ], BRONZE["crm_cust_info"])
    az = spark.createDataFrame([("AW1", D(1970, 1, 1), "Female"), ("AW2", None, "Female")], BRONZE["erp_cust_az12"])
    loc = spark.createDataFrame([("AW1", "Germany")], BRONZE["erp_loc_a101"])
    dim = gold.dim_customers(cust, az, loc)
    got = {r["customer_id"]: (r["customer_key"], r["gender"], r["country"]) for r in dim.collect()}
    assert got == {1: (1, "Female", "Germany"), 2: (2, "Male", None), 3: (3, "n/a", None)}

    sales = spark.createDataFrame([("SO1", "HL-U509-R", 2, None, None, None, 10, 1, 10),
                                   ("SO2", "NOPE", 9, None, None, None, 5, 1, 5)],
                                  "sls_ord_num string, sls_prd_key string, sls_cust_id int, sls_order_dt date, "
                                  "sls_ship_dt date, sls_due_dt date, sls_sales int, sls_quantity int, sls_price int")
    prd, cat = _products(spark)
    fact = gold.fact_sales(sales, gold.dim_products(prd, cat), dim)
    got = {r["order_number"]: (r["product_key"], r["customer_key"]) for r in fact.collect()}
    assert got == {"SO1": (2, 2), "SO2": (None, None)}     # unmatched rows are kept
    fk = quality.fk_integrity(fact, dim, gold.dim_products(prd, cat))
    assert [r["order_number"] for r in fk.collect()] == ["SO2"]


def test_duplicate_and_fanout_checks(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "id int")
    got = sorted((r["id"] is None, r["id"], r["n_rows"]) for r in quality.duplicate_keys(df, "id").collect())
    assert got == [(False, 1, 2), (True, None, 1)]
    prd, cat = _products(spark)
    dup_cat = cat.unionByName(cat.filter(F.col("id") == "AC_HE"))
    assert [r["product_number"] for r in quality.product_fanout(prd, dup_cat).collect()] == ["HL-U509-R"]


def test_row_checks(spark):
    df = spark.createDataFrame([(" a", "b", -1, 20200101, 20200102, 0), ("a", "b ", None, 19891231, 19891230, 20200101)],
                               "x string, y string, n int, o int, s int, d int")
    assert quality.spaced_rows(df, ["x", "y"]).count() == 2
    assert quality.negative_rows(df, "n").count() == 2
    assert quality.date_order_rows(df, [("o", "s")]).count() == 1
    assert [r["d"] for r in quality.int_date_rows(df, "d").collect()] == [None]


def test_gender_preview_uses_upper_case_words(spark):
    df = spark.createDataFrame([("Female",), ("male ",), ("x",), (None,)], "gen string")
    got = {r["gen"]: r["gen_new"] for r in quality.code_preview(df, "gen", codes.ERP_GENDER).collect()}
    assert got == {"Female": "Female", "male ": "Male", "x": "n/a", None: "n/a"}


def test_summary_counts_every_rule_in_one_row_per_rule(spark):
    bronze = {"crm_prd_info": spark.createDataFrame(PRD_SAMPLE, BRONZE["crm_prd_info"])}
    got = {r["check_name"]: r["n_bad"] for r in quality.quality_summary(bronze).collect()}
    assert got == {"null_cost": 1, "null_line": 0, "negative_or_null_cost": 1, "end_before_start": 2,
                   "spaces_name": 0}


def test_cheap_predicates_match_their_definitions(spark):
    from tierline.functions.expressions import has_eight_digits, has_outer_spaces

    df = spark.createDataFrame([(v,) for v in [0, 1, -1, 9999999, 10000000, 99999999, 100000000, -999999,
                                               -1000000, -9999999, -10000000, None]], "x int")
    diff = df.filter(~has_eight_digits("x").eqNullSafe(F.length(F.col("x").cast("string")) == 8)).collect()
    assert diff == []
    s = spark.createDataFrame([(v,) for v in ["a", " a", "a ", " ", "", "a b", None, "\ta"]], "s string")
    diff = s.filter(~has_outer_spaces("s").eqNullSafe(F.col("s") != F.trim("s"))).collect()
    assert diff == []


def test_fanout_of_a_key_repeated_on_both_sides_is_a_product(spark):
    import time

    from tierline.operators import quality

    n = 100_000
    cust = spark.createDataFrame([(1, "A"), (1, "B"), (2, "B"), (3, None), (4, "C"), (5, "D"), (None, "E"), (None, "F")], "cst_id int, cst_key string")
    many = spark.range(n).select(F.lit("A").alias("cid"))
    az = many.unionByName(spark.createDataFrame([("B",), ("D",), (None,), (None,)], "cid string"))
    loc = many.unionByName(spark.createDataFrame([("C",), ("D",), ("D",), (None,)], "cid string"))
    start = time.perf_counter()
    got = {r["customer_id"]: r["n_rows"] for r in quality.customer_fanout(cust, az, loc).collect()}
    assert got == {1: n * n + 1, 5: 2, None: 2} and time.perf_counter() - start < 60


def test_gender_matrix_joins_distinct_pairs(spark):
    from tierline.operators import quality

    cust = spark.createDataFrame([("A", "Male"), ("A", "Male"), ("B", "n/a"), (None, "n/a"), ("C", None), ("D", "Female")],
                                 "cst_key string, cst_gndr string")
    az = spark.createDataFrame([("A", "Female"), ("A", "n/a"), ("B", "Male"), (None, "Male"), ("C", None)], "cid string, gen string")
    got = {tuple(r) for r in quality.gender_matrix(cust, az).collect()}
    assert got == {("Male", "Female", "Male"), ("Male", "n/a", "Male"), ("n/a", "Male", "Male"), ("n/a", None, "n/a"),
                   (None, None, "n/a"), ("Female", None, "Female")}
