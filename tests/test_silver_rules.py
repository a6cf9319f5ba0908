"""Unit tests of the silver rules and their traps, on tiny frames."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tierline.operators import silver
from tierline.sources.schemas import BRONZE

D = dt.date
TS = dt.datetime


def rows(df, order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_t1_newest_per_id_with_tiebreak_and_codes(spark):
    df = spark.createDataFrame([
        (1, "AW1", "  Ann ", " Lee", "s", " f", D(2020, 1, 1), 1),
        (1, "AW1", "Ann", "Lee", "M ", "M", D(2021, 1, 1), 2),
        (1, "AW1", "Ann", "Lee", "X", "f", D(2021, 1, 1), 3),     # tie on date: higher seq wins
        (2, "AW2", " Bo", "Ng ", None, "", D(2019, 5, 5), 4),
        (None, "AW9", "x", "y", "S", "F", D(2022, 1, 1), 5),
    ], "cst_id int, cst_key string, cst_firstname string, cst_lastname string, "
       "cst_marital_status string, cst_gndr string, cst_create_date date, src_seq bigint")
    out = silver.clean_crm_customers(df, tiebreak=["src_seq"])
    assert rows(out, ["cst_id"]) == [
        (1, "AW1", "Ann", "Lee", "n/a", "Female", D(2021, 1, 1)),
        (2, "AW2", "Bo", "Ng", "n/a", "n/a", D(2019, 5, 5)),
    ]
    # Append variant keeps one row for the NULL id group.
    kept = silver.clean_crm_customers(df, drop_null_ids=False, tiebreak=["src_seq"])
    assert kept.filter(F.col("cst_id").isNull()).count() == 1


def test_t1_null_dates_lose(spark):
    df = spark.createDataFrame([(1, "k", "a", "b", "S", "M", None, 9), (1, "k", "a", "b", "M", "F", D(2000, 1, 1), 1)],
                               "cst_id int, cst_key string, cst_firstname string, cst_lastname string, "
                               "cst_marital_status string, cst_gndr string, cst_create_date date, src_seq bigint")
    out = silver.clean_crm_customers(df, tiebreak=["src_seq"]).collect()
    assert out[0]["cst_create_date"] == D(2000, 1, 1)


PRD_SAMPLE = [  # rows of the shipped product extract (blank = NULL, codes padded with a space)
    (210, "CO-RF-FR-R92B-58", "HL Road Frame - Black- 58", None, "R ", TS(2003, 7, 1), None),
    (212, "AC-HE-HL-U509-R", "Sport-100 Helmet- Red", 12, "S ", TS(2011, 7, 1), TS(2007, 12, 28)),
    (213, "AC-HE-HL-U509-R", "Sport-100 Helmet- Red", 14, "S ", TS(2012, 7, 1), TS(2008, 12, 27)),
    (214, "AC-HE-HL-U509-R", "Sport-100 Helmet- Red", 13, "S ", TS(2013, 7, 1), None),
    (542, "CO-PE-PD-M282", "LL Mountain Pedal", 18, "M ", TS(2013, 7, 1), None),
]


def test_t2_products_history_from_raw_key(spark):
    df = spark.createDataFrame(PRD_SAMPLE, BRONZE["crm_prd_info"])
    out = silver.clean_crm_products(df)
    assert rows(out, ["prd_id"]) == [
        (210, "CO_RF", "FR-R92B-58", "HL Road Frame - Black- 58", 0, "Road", D(2003, 7, 1), None),
        (212, "AC_HE", "HL-U509-R", "Sport-100 Helmet- Red", 12, "Other Sales", D(2011, 7, 1), D(2012, 6, 30)),
        (213, "AC_HE", "HL-U509-R", "Sport-100 Helmet- Red", 14, "Other Sales", D(2012, 7, 1), D(2013, 6, 30)),
        (214, "AC_HE", "HL-U509-R", "Sport-100 Helmet- Red", 13, "Other Sales", D(2013, 7, 1), None),
        (542, "CO_PE", "PD-M282", "LL Mountain Pedal", 18, "Mountain", D(2013, 7, 1), None),
    ]


def test_t2_lead_partitions_by_raw_key_not_short_key(spark):
    # Same short key under two categories: histories must stay separate.
    df = spark.createDataFrame([
        (1, "AC-HE-X1", "a", 1, "T", TS(2011, 1, 1), None),
        (2, "BI-MB-X1", "b", 1, "T", TS(2012, 1, 1), None),
    ], BRONZE["crm_prd_info"])
    out = silver.clean_crm_products(df)
    assert [r["prd_end_dt"] for r in out.collect()] == [None, None]


def test_t2_bucketed_equals_window(spark):
    # Forced range buckets over a product with many versions (a hot key) and nulls.
    data = [(i, "AC-HE-HOT" if i % 3 else f"CL-SO-K{i % 7}", f"n{i}", i, "M",
             None if i % 17 == 0 else TS(2000 + i % 20, 1 + i % 12, 1), None) for i in range(300)]
    df = spark.createDataFrame(data, BRONZE["crm_prd_info"])
    plain = silver.clean_crm_products(df)
    bucketed = silver.clean_crm_products(df, rows_per_bucket=2)
    assert rows(plain, ["prd_id"]) == rows(bucketed, ["prd_id"])


def test_t3_sales_rules(spark):
    df = spark.createDataFrame([
        ("SO1", "P1", 1, 20101229, 20110105, 20110110, 100, 2, 50),     # consistent
        ("SO2", "P1", 1, 0, 20110105, 20110110, None, 2, 50),           # missing sales -> 100
        ("SO3", "P1", 1, 2010122, 20110105, 20110110, -7, 2, -3),       # short date; sales 6; price -7 div 2 = -3 (R2, R5)
        ("SO4", "P1", 1, 20101332, 20110105, 20110110, 40, 2, None),    # no such day -> NULL (R11); price 40 div 2
        ("SO5", "P1", 1, 20101229, 20110105, 20110110, 30, 0, None),    # quantity 0 -> NULL price
        ("SO6", "P1", 1, 20101229, 20110105, 20110110, 30, 2, None),    # NULL price: sales kept (R6)
    ], BRONZE["crm_sales_details"])
    out = {r["sls_ord_num"]: r for r in silver.clean_crm_sales(df).collect()}
    assert (out["SO1"]["sls_order_dt"], out["SO1"]["sls_sales"], out["SO1"]["sls_price"]) == (D(2010, 12, 29), 100, 50)
    assert (out["SO2"]["sls_order_dt"], out["SO2"]["sls_sales"]) == (None, 100)
    assert (out["SO3"]["sls_order_dt"], out["SO3"]["sls_sales"], out["SO3"]["sls_price"]) == (None, 6, -3)
    assert (out["SO4"]["sls_order_dt"], out["SO4"]["sls_price"]) == (None, 20)
    assert out["SO5"]["sls_price"] is None
    assert (out["SO6"]["sls_sales"], out["SO6"]["sls_price"]) == (30, 15)


def test_t4_erp_customers(spark):
    df = spark.createDataFrame([
        ("NASAW001", D(1970, 1, 1), " female"), ("AW002", D(2999, 1, 1), "M"),
        ("nasAW003", D(1950, 1, 1), "Male "), ("AW004", None, None),
    ], BRONZE["erp_cust_az12"])
    out = silver.clean_erp_customers(df, as_of="2026-01-01")
    assert rows(out, ["cid"]) == [
        ("AW001", D(1970, 1, 1), "Female"), ("AW002", None, "Male"), ("AW004", None, "n/a"),
        ("nasAW003", D(1950, 1, 1), "Male"),
    ]
    again = silver.clean_erp_customers(out, as_of="2026-01-01")
    assert rows(again, ["cid"]) == rows(out, ["cid"])  # idempotent


def test_t5_locations(spark):
    df = spark.createDataFrame([("AW-1", "DE"), ("AW-2", "US "), ("A-W-3", "USA"), ("AW-4", "  "),
                                ("AW-5", None), ("AW-6", " France ")], BRONZE["erp_loc_a101"])
    out = silver.clean_erp_locations(df)
    assert rows(out, ["cid"]) == [("AW1", "Germany"), ("AW2", "United States"), ("AW3", "United States"),
                                  ("AW4", "n/a"), ("AW5", "n/a"), ("AW6", "France")]
    assert rows(silver.clean_erp_locations(out), ["cid"]) == rows(out, ["cid"])


def test_t6_categories_copied(spark):
    df = spark.createDataFrame([("AC_HE", "Accessories", "Helmets", "Yes")], BRONZE["erp_px_cat_g1v2"])
    assert silver.clean_erp_categories(df).collect() == df.collect()


def test_int_to_date_arithmetic_equals_string_parsing(spark):
    from tierline.functions.expressions import bad_int_date, int_to_date

    edge = [0, 1, -1, 32154, 20101229, 20101332, 20230229, 20240229, 20240230, 20241131, 20241231,
            19000101, 99991231, 10000101, 9999999, 100000000, -1234567, -9999999, 20100001, 20100100,
            None]
    df = spark.range(0, 20000).select(
        (F.lit(19000000) + F.col("id") * 7_001 % 1_300_000 + (F.col("id") % 13) * 100).cast("int").alias("x"))
    df = df.unionByName(spark.createDataFrame([(v,) for v in edge], "x int"))
    text = F.col("x").cast("string")
    by_string = F.when((F.col("x") == 0) | (F.length(text) != 8), F.lit(None).cast("date")) \
        .otherwise(F.try_to_date(text, "yyyyMMdd"))
    bad_by_string = (F.col("x") != 0) & (F.length(text) == 8) & F.try_to_date(text, "yyyyMMdd").isNull()
    diff = df.filter(~int_to_date("x").eqNullSafe(by_string)
                     | ~bad_int_date("x").eqNullSafe(bad_by_string)).collect()
    assert diff == []
    got = {r["x"]: r["d"] for r in spark.createDataFrame([(v,) for v in edge], "x int")
           .select("x", int_to_date("x").alias("d")).collect()}
    assert got[20240229] == D(2024, 2, 29) and got[20230229] is None and got[20101229] == D(2010, 12, 29)


def test_t3_overflow_raises_like_the_source(spark):
    import pytest

    if spark.conf.get("spark.sql.ansi.enabled") != "true":
        pytest.skip("overflow is only raised in ANSI mode")
    df = spark.createDataFrame([("SO1", "P1", 1, 20200101, 20200101, 20200101, 5, 100_000, 100_000)],
                               BRONZE["crm_sales_details"])
    with pytest.raises(Exception, match="ARITHMETIC_OVERFLOW|overflow"):
        silver.clean_crm_sales(df).collect()
