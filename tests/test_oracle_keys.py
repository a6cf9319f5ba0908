"""Every registered query against its DuckDB oracle on the smallest driver tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tierline.plans.registry import QUERIES
from oracle_compare import compare, duck

from conftest import SF_SMALL, SF_SMOKE

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMOKE)


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(entry.queries())
    assert set(KEYS) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    ok, msg = compare(entry.queries()[key](spark, SF_SMOKE), con, entry.oracle_sql()[key])
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["order_number", "order_date", "product_name"]


# A NULL found in the subquery empties the result before the other side is read.
@pytest.mark.parametrize("key", [k for k in KEYS if k != "dq_orphans_not_in_null"])
def test_every_query_reads_tables(spark, key):
    files = QUERIES[key](spark, SF_SMOKE).inputFiles()   # the driver's tables, or tables written from them
    assert files and all(".parquet" in f or ".csv" in f for f in files)


def test_categories_come_from_the_parts_and_grow_with_them(spark):
    for key in ("silver_erp_px_cat_g1v2", "dq_domain_categories"):
        frames = [QUERIES[key](spark, sf) for sf in (SF_SMOKE, SF_SMALL)]
        assert all(f.endswith("/part.parquet") for df in frames for f in df.inputFiles())
        assert frames[0].count() < frames[1].count()


def test_spaces_check_finds_some_rows_but_not_all(spark):
    from tierline.sources.fixtures import fixture

    for key, table in (("dq_spaces", "crm_cust_info"), ("dq_spaces_product_name", "crm_prd_info"),
                       ("dq_spaces_categories", "erp_px_cat_g1v2")):
        assert 0 < QUERIES[key](spark, SF_SMALL).count() < fixture(spark, SF_SMALL, table).count()


TIME_SENSITIVE = ["silver_crm_prd_info", "silver_crm_sales_details", "bronze_refresh_twice", "dq_nulls",
                  "dq_date_order", "order_validity_ranges", "latest_order_per_customer", "surrogate_key_bucketed"]


def test_results_do_not_depend_on_session_time_zone_or_partitions(spark, con):
    saved = {k: spark.conf.get(k) for k in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        for key in TIME_SENSITIVE:
            ok, msg = compare(entry.queries()[key](spark, SF_SMOKE), con, entry.oracle_sql()[key])
            assert ok, (key, msg)
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
