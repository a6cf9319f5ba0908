"""Sources, sinks, catalog and the layer pipeline, in a fresh warehouse folder."""

from __future__ import annotations

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from tierline.plans.catalog import Warehouse
from tierline.plans.layers import run_all
from tierline.plans.registry import stage_extracts
from tierline.plans.sinks import append, delete_where, refresh
from tierline.session import scratch_path
from tierline.sources.delimited import CORRUPT_COLUMN, read_extract
from tierline.sources.schemas import BRONZE, SILVER

from conftest import SF_SMOKE


def _wh(spark):
    return Warehouse(spark, root=scratch_path(spark, "test-wh"), prefix=f"t{uuid.uuid4().hex[:6]}_")


def _write_text(path: str, text: str) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_extract_binding_quotes_blanks_and_bad_rows(spark):
    path = scratch_path(spark, "csv") + "/PX_CAT.csv"
    # Header names differ in case (bound by position); '"' is ordinary; empty -> NULL; no final newline.
    _write_text(path, 'ID,CAT,SUBCAT,MAINTENANCE\nAC_BR,Accessories,"Bike Racks",Yes\nAC_BS,, Stands ,No')
    df = read_extract(spark, path, BRONZE["erp_px_cat_g1v2"])
    got = [tuple(r) for r in df.orderBy("id").collect()]
    assert got == [("AC_BR", "Accessories", '"Bike Racks"', "Yes", None), ("AC_BS", None, " Stands ", "No", None)]

    bad = scratch_path(spark, "csv") + "/prd.csv"
    _write_text(bad, "h1,h2,h3,h4,h5,h6,h7\n1,K,N,12,R ,2003-07-01,\n2,K,N,not_a_number,R ,2003-07-01,\n")
    prd = read_extract(spark, bad, BRONZE["crm_prd_info"])
    # As in the bronze load, bad rows are counted by a job that needs every column: with column
    # pruning an unread bad field would not be parsed and so not be seen.
    got = prd.collect()
    assert len(got) == 2 and sum(r[CORRUPT_COLUMN] is not None for r in got) == 1
    assert {r["prd_start_dt"] for r in got} == {dt.datetime(2003, 7, 1)}


def test_refresh_versions_and_failed_refresh_keeps_old_data(spark):
    wh = _wh(spark)
    df = spark.range(5).withColumnRenamed("id", "x")
    refresh(wh, "bronze", "t", df)
    refresh(wh, "bronze", "t", df)
    assert wh.read("bronze", "t").count() == 5
    failing = spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).alias("x"))
    with pytest.raises(Exception):
        refresh(wh, "bronze", "t", failing)
    assert wh.read("bronze", "t").count() == 5          # previous version still published
    refresh(wh, "bronze", "t", df.limit(2))
    assert wh.read("bronze", "t").count() == 2
    assert len(wh.versions("bronze", "t")) <= wh.keep_versions


def test_append_fills_audit_default_and_delete_where(spark):
    wh = _wh(spark)
    wh.create_table("silver", "erp_loc_a101", SILVER["erp_loc_a101"], with_audit=True)
    src = spark.createDataFrame([("AW1", "Germany"), ("AW2", None)], BRONZE["erp_loc_a101"])
    append(wh, "silver", "erp_loc_a101", src)
    append(wh, "silver", "erp_loc_a101", src)
    out = wh.read("silver", "erp_loc_a101")
    assert out.count() == 4 and out.filter(F.col("dwh_create_date").isNull()).count() == 0

    refresh(wh, "bronze", "loc", src)
    delete_where(wh, "bronze", "loc", F.col("cntry").isNull())
    assert [r["cid"] for r in wh.read("bronze", "loc").collect()] == ["AW1"]


def test_every_operation_works_on_every_published_name(spark):
    wh = _wh(spark)
    schema = SILVER["erp_loc_a101"]
    rows = spark.createDataFrame([("AW1", "Germany"), ("AW2", None)], schema)
    refresh(wh, "silver", "t", rows, audit_column=True, schema=schema)      # published ...
    append(wh, "silver", "t", rows)                                         # ... appended to by name
    assert wh.read("silver", "t").count() == 4
    delete_where(wh, "silver", "t", F.col("cntry").isNull())
    append(wh, "silver", "t", rows.limit(1))                                # defaults survive the delete
    out = wh.read("silver", "t")
    assert out.count() == 3 and out.filter(F.col("dwh_create_date").isNull()).count() == 0
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH|exceeds"):     # so do the string limits
        append(wh, "silver", "t", spark.createDataFrame([("y" * 51, None)], schema))
    assert wh.read("silver", "t").count() == 3                              # a failed append adds nothing
    wh.create_table("silver", "t", schema, with_audit=True)                 # drop and re-create
    assert wh.read("silver", "t").count() == 0
    append(wh, "silver", "t", rows)
    delete_where(wh, "silver", "t", F.col("cid") == "AW1")                  # created, then deleted from
    refresh(wh, "silver", "t", rows, audit_column=True, schema=schema)
    assert wh.read("silver", "t").count() == 2
    wh.drop_table("silver", "t")
    assert not wh.exists("silver", "t") and wh.versions("silver", "t") == []


def test_a_running_reader_keeps_its_files_during_an_append(spark):
    wh = _wh(spark)
    refresh(wh, "silver", "t", spark.range(100))
    before = wh.read("silver", "t")
    assert before.count() == 100
    append(wh, "silver", "t", spark.range(50))
    assert wh.read("silver", "t").count() == 150


def test_full_run_audit(spark):
    sources = stage_extracts(spark, SF_SMOKE, scratch_path(spark, "src"))
    wh = _wh(spark)
    audit = {(r["layer"], r["table_name"]): r for r in run_all(wh, sources).collect()}
    totals = {layer: audit.pop((layer, "(layer)")) for layer in ("bronze", "silver", "gold")}
    for layer, total in totals.items():
        tables = [r for (name, _), r in audit.items() if name == layer]
        assert total["rows"] == sum(r["rows"] for r in tables) and total["status"] == "ok"
        assert total["seconds"] >= max(r["seconds"] for r in tables)        # wall time of the layer
    assert len(audit) == 15 and all(r["status"] == "ok" for r in audit.values())
    assert audit[("bronze", "crm_sales_details")]["rows"] == audit[("gold", "fact_sales")]["rows"]
    assert audit[("silver", "crm_cust_info")]["rows"] == audit[("gold", "dim_customers")]["rows"]
    assert audit[("bronze", "crm_cust_info")]["bad_rows"] == 0
    assert audit[("bronze", "crm_sales_details")]["bad_rows"] > 0           # staged unreadable quantities
    keys = wh.read("gold", "dim_customers").agg(F.min("customer_key"), F.max("customer_key"),
                                                F.countDistinct("customer_key"), F.count(F.lit(1))).first()
    assert keys[0] == 1 and keys[1] == keys[2] == keys[3]
    assert wh.read("silver", "crm_prd_info").filter(F.col("dwh_create_date").isNull()).count() == 0
    physical = f"{wh.db('gold')}.{wh._physical_versions('gold', 'dim_customers')[-1][1]}"
    stats = [r for r in spark.sql(f"DESCRIBE TABLE EXTENDED {physical}").collect() if r[0] == "Statistics"]
    assert stats and f"{keys[3]} rows" in stats[0][1]


def test_failed_layer_is_recorded_and_raised(spark):
    sources = scratch_path(spark, "missing-src")   # no extracts: the bronze load fails
    wh = _wh(spark)
    with pytest.raises(Exception):
        run_all(wh, sources)
    rows = spark.table(f"{wh.db('audit')}.load_audit").collect()
    # Every bronze table of the layer is attempted and recorded; no later layer runs.
    assert {r["layer"] for r in rows} == {"bronze"} and len(rows) == 7
    assert all(r["status"] == "failed" for r in rows)
    assert all(r["message"] for r in rows if r["table_name"] != "(layer)")


def test_typed_tables_enforce_fifty_characters(spark):
    wh = _wh(spark)
    ok = spark.createDataFrame([("AW1", "x" * 50)], BRONZE["erp_loc_a101"])
    refresh(wh, "bronze", "erp_loc_a101", ok, schema=BRONZE["erp_loc_a101"])
    too_long = spark.createDataFrame([("AW2", "y" * 51)], BRONZE["erp_loc_a101"])
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH|exceeds"):
        refresh(wh, "bronze", "erp_loc_a101", too_long, schema=BRONZE["erp_loc_a101"])
    assert [r["cid"] for r in wh.read("bronze", "erp_loc_a101").collect()] == ["AW1"]
    assert wh.versions("bronze", "erp_loc_a101") == [1]       # the failed version was dropped
    silver_t = refresh(wh, "silver", "erp_loc_a101", ok, audit_column=True, schema=SILVER["erp_loc_a101"])
    row = spark.table(silver_t).first()
    assert row["dwh_create_date"] is not None


def test_append_silver_reaches_gold(spark):
    from tierline.plans.layers import run_layers

    sources = stage_extracts(spark, SF_SMOKE, scratch_path(spark, "src"))
    wh = _wh(spark)
    audit = run_layers(wh, ("bronze", "silver", "append"), sources).collect()
    assert {r["layer"] for r in audit} == {"bronze", "silver", "append"}
    assert all(r["status"] == "ok" for r in audit)
    cust = wh.read("silver", "crm_cust_info")
    ids = wh.read("bronze", "crm_cust_info").select("cst_id").distinct().count()   # NULL counts as one group
    assert cust.count() == 2 * ids - 1                                             # the load drops NULL ids
    assert cust.filter(F.col("cst_id").isNull()).count() == 1
    assert cust.filter(F.col("dwh_create_date").isNull()).count() == 0
    sales = wh.read("silver", "crm_sales_details").count()
    assert sales == 2 * wh.read("bronze", "crm_sales_details").count()
    run_layers(wh, ("gold",))
    assert wh.read("gold", "fact_sales").count() >= sales
    assert wh.read("gold", "dim_customers").filter("customer_id is null").count() > 0


def test_a_fact_that_fans_out_is_kept_as_lines_and_keys(spark):
    from tierline.operators import gold
    from tierline.plans.layers import run_layers

    sources = stage_extracts(spark, SF_SMOKE, scratch_path(spark, "src"))
    wh = _wh(spark)
    run_layers(wh, ("bronze", "silver", "append"), sources)
    audit = run_layers(wh, ("gold",), fact_partition_by=("order_date",)).filter("table_name = 'fact_sales'").first()
    fact, sales = wh.read("gold", "fact_sales"), wh.read("silver", "crm_sales_details").drop("dwh_create_date")
    expect = gold.fact_sales(sales, wh.read("gold", "dim_products"), wh.read("gold", "dim_customers"))
    assert fact.dtypes == expect.dtypes
    assert fact.exceptAll(expect).isEmpty() and expect.exceptAll(fact).isEmpty()
    bad = fact.filter("product_key IS NULL OR customer_key IS NULL").count()
    assert (audit["rows"], audit["bad_rows"], audit["status"]) == (fact.count(), bad, "ok")

    def tables():
        return [t.name for t in spark.catalog.listTables(wh.db("gold"), pattern="fact_sales__v*") if t.tableType != "VIEW"]

    stored = sum(spark.table(wh.name("gold", t)).count() for t in tables())
    keys = wh.read("gold", "dim_products").count() + wh.read("gold", "dim_customers").count()
    assert fact.count() > 4 * sales.count() and stored == sales.count() + keys
    n = fact.count()
    for run_id in (None, "again"):                                        # rows of either kind go beside the join
        append(wh, "gold", "fact_sales", fact.limit(3)) if run_id is None else wh.append("gold", "fact_sales", fact.limit(3), run_id)
    assert wh.read("gold", "fact_sales").count() == n + 6 and wh.appended_runs("gold", "fact_sales") == ["again"]
    for _ in range(3):
        run_layers(wh, ("gold",))
    assert wh.read("gold", "fact_sales").count() == n and len(wh.versions("gold", "fact_sales")) == wh.keep_versions
    wh.drop_table("gold", "fact_sales")
    assert tables() == [] and wh.versions("gold", "fact_sales") == []


def test_append_creates_missing_tables(spark):
    from tierline.plans.layers import run_layers

    sources = stage_extracts(spark, SF_SMOKE, scratch_path(spark, "src"))
    wh = _wh(spark)
    run_layers(wh, ("bronze", "append"), sources)
    assert wh.read("silver", "erp_loc_a101").count() == wh.read("bronze", "erp_loc_a101").count()


def test_scale_conf_sizes_partitions():
    from tierline.session import scale_conf

    small = scale_conf(10 * 1024 ** 2)
    big = scale_conf(100 * 1024 ** 4)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert int(big["spark.sql.shuffle.partitions"]) == 409600       # 256 MB a task, without a cap
    assert int(scale_conf(1024 ** 4)["spark.sql.shuffle.partitions"]) == 4096


def test_cli_run_and_quality(spark, capsys):
    from tierline.__main__ import main

    sources = stage_extracts(spark, SF_SMOKE, scratch_path(spark, "cli-src"))
    root = scratch_path(spark, "cli-wh")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    common = ["--warehouse", root, "--prefix", "cli_"]
    assert main(["run", "--sources", sources, *common, "--partition-fact-by", "order_date", "--verify"]) == 0
    assert main(["quality", *common, "--as-of", "2026-01-01"]) == 0
    out = capsys.readouterr().out
    assert "fact_without_dimension" in out and "spaces_name" in out and out.count("(layer)") == 4
    assert spark.conf.get("spark.sql.shuffle.partitions") == before          # sizing is for the run alone
    assert spark.table("cli_gold.fact_sales").count() == spark.table("cli_bronze.crm_sales_details").count()
    one_day = spark.table("cli_gold.fact_sales").filter(F.col("order_date") == F.lit("1995-03-15").cast("date"))
    assert "PartitionFilters: [isnotnull(order_date" in one_day._jdf.queryExecution().executedPlan().toString()


def test_cli_steps_write_their_own_audit(spark, capsys):
    from tierline.__main__ import main

    sources = stage_extracts(spark, SF_SMOKE, scratch_path(spark, "cli-src"))
    root = scratch_path(spark, "cli-wh")
    common = ["--warehouse", root, "--prefix", "step_"]
    for command in (["load-bronze", "--sources", sources], ["load-silver"], ["append"], ["load-gold"]):
        assert main([*command, *common]) == 0
    audit = spark.table("step_audit.load_audit").collect()
    assert len({r["run_id"] for r in audit}) == 4
    assert {r["layer"] for r in audit if r["table_name"] == "(layer)"} == {"bronze", "silver", "append", "gold"}
    assert all(r["status"] == "ok" and r["seconds"] is not None for r in audit)
    assert "load" not in capsys.readouterr().err


def test_partitioned_publish_prunes_files(spark):
    wh = _wh(spark)
    df = spark.range(0, 100).select(F.col("id"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 5).cast("int")).alias("order_date"))
    refresh(wh, "gold", "fact", df, partition_by=("order_date",))
    filtered = wh.read("gold", "fact").filter(F.col("order_date") == F.lit("2020-01-03").cast("date"))
    assert filtered.count() == 20
    plan = filtered._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_date" in plan and "2020-01-03" in plan


def test_partitioned_publish_bounds_the_files_and_spreads_a_hot_value(spark):
    wh = _wh(spark)
    days = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 40).cast("int"))
    df = spark.range(0, 20_000, 1, 64).select(
        F.when(F.col("id") % 3 != 0, F.col("id")).alias("id"), F.when(F.col("id") % 3 != 0, days).alias("d"))
    keys = ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")
    saved = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set(keys[0], "false")
        spark.conf.set(keys[1], "24")
        refresh(wh, "gold", "fact", df, partition_by=("d",))     # a third of the rows are one row, without a date
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    table = wh.read("gold", "fact")
    assert table.count() == 20_000 and len(table.inputFiles()) <= 41 + 24
    hot = table.filter("d IS NULL").groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in hot) == 6_667 and 7 <= len(hot) <= 10      # a third of 24 tasks
    assert max(r["count"] for r in hot) < 2 * 20_000 / 24
    assert sorted(table.collect(), key=repr) == sorted(df.collect(), key=repr)


def test_many_partition_values_warn(spark, monkeypatch):
    from tierline.plans import catalog

    monkeypatch.setattr(catalog, "MAX_PARTITION_VALUES", 3)
    with pytest.warns(UserWarning, match="folders"):
        refresh(_wh(spark), "gold", "fact", spark.range(10).select("id", (F.col("id") % 9).alias("d")), partition_by=("d",))


def test_scratch_is_removed(spark):
    from tierline import session
    from tierline.session import register_scratch, remove_scratch

    app = spark.sparkContext.applicationId
    others = session._scratch.pop(app, [])           # of other tests
    try:
        path = scratch_path(spark, "gone")
        spark.range(3).write.parquet(path)
        wh = Warehouse(spark, root=path + "/wh", prefix=f"g{uuid.uuid4().hex[:6]}_")
        register_scratch(spark, "database", wh.db("gold"))
        refresh(wh, "gold", "t", spark.range(3))
        assert remove_scratch(spark) == 2
        assert not os.path.exists(path.removeprefix("file:")) and wh.db("gold") not in {
            d.name for d in spark.catalog.listDatabases()}
    finally:
        session._scratch[app] = others


def test_a_cluster_without_a_shared_folder_is_refused():
    import types

    from tierline.session import is_local, shared_dir

    assert is_local("local[8]") and is_local("local") and not is_local("local-cluster[2,1,512]") and not is_local("yarn")
    conf = types.SimpleNamespace(get=lambda *a: None)
    scala = types.SimpleNamespace(getCheckpointDir=lambda: types.SimpleNamespace(isDefined=lambda: False))
    sc = types.SimpleNamespace(getConf=lambda: conf, master="spark://host:7077",
                               _jsc=types.SimpleNamespace(sc=lambda: scala))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(types.SimpleNamespace(conf=conf, sparkContext=sc))


def test_pipeline_bucketed_paths_give_the_same_gold(spark, monkeypatch):
    from tierline.operators import ranged

    sources = stage_extracts(spark, SF_SMOKE, scratch_path(spark, "src"))
    plain = _wh(spark)
    run_all(plain, sources, as_of="2026-01-01")
    monkeypatch.setattr(ranged, "ROWS_PER_BUCKET", 40)      # force range buckets everywhere
    bucketed = _wh(spark)
    run_all(bucketed, sources, as_of="2026-01-01")
    for table in ("dim_customers", "dim_products", "fact_sales"):
        a = plain.read("gold", table).collect()
        b = bucketed.read("gold", table).collect()
        assert sorted(a, key=repr) == sorted(b, key=repr), table
    a = plain.read("silver", "crm_prd_info").drop("dwh_create_date").collect()
    b = bucketed.read("silver", "crm_prd_info").drop("dwh_create_date").collect()
    assert sorted(a, key=repr) == sorted(b, key=repr)


def test_failure_while_building_a_frame_is_audited(spark, monkeypatch):
    from tierline.operators import silver

    def broken(*args, **kwargs):
        raise RuntimeError("planning failed")

    sources = stage_extracts(spark, SF_SMOKE, scratch_path(spark, "src"))
    wh = _wh(spark)
    monkeypatch.setattr(silver, "clean_crm_products", broken)
    with pytest.raises(RuntimeError, match="planning failed"):
        run_all(wh, sources)
    rows = {(r["layer"], r["table_name"]): r for r in spark.table(f"{wh.db('audit')}.load_audit").collect()}
    assert rows[("silver", "crm_prd_info")]["status"] == "failed"
    assert rows[("silver", "crm_sales_details")]["status"] == "ok", rows[("silver", "crm_sales_details")]["message"]
    assert not any(layer == "gold" for layer, _ in rows)                # no later layer


def test_verify_records_post_load_checks(spark):
    sources = stage_extracts(spark, SF_SMOKE, scratch_path(spark, "src"))
    wh = _wh(spark)
    audit = {(r["layer"], r["table_name"]): r for r in run_all(wh, sources, verify=True).collect()}
    checks = {t: r for (layer, t), r in audit.items() if layer == "check" and t != "(layer)"}
    assert set(checks) == {"silver_customer_duplicates", "customer_fanout", "product_fanout",
                           "fact_without_dimension"}
    assert all(r["rows"] == 0 and r["status"] == "ok" for r in checks.values())
    assert audit[("gold", "fact_sales")]["bad_rows"] == checks["fact_without_dimension"]["rows"]


def test_shared_dir_reads_the_session_setting(tmp_path):
    import subprocess
    import sys

    from conftest import ROOT

    target = tmp_path / "shared-ckpt"
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "from tierline.session import shared_dir, scratch_path\n"
        "spark = (SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false')\n"
        "         .config('spark.checkpoint.dir', %r).getOrCreate())\n"
        "print('DIR', shared_dir(spark)); print('SCRATCH', scratch_path(spark, 'x'))\n"
    ) % (ROOT, f"file://{target}")
    proc = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert proc.returncode == 0, proc.stderr[-2000:]
    lines = dict(line.split(" ", 1) for line in proc.stdout.splitlines() if line.startswith(("DIR", "SCRATCH")))
    assert lines["DIR"] == f"file://{target}"
    assert lines["SCRATCH"].startswith(f"file://{target}/x-")


def test_namespaces_and_drop_if_exists(spark):
    wh = _wh(spark)
    wh.ensure_layers()
    assert {f"{wh.prefix}{layer}" for layer in ("bronze", "silver", "gold")} <= {d.name for d in spark.catalog.listDatabases()}
    wh.drop_table("bronze", "missing")          # S6: dropping what is not there is not an error
    wh.drop_view("gold", "missing")
    refresh(wh, "gold", "v", spark.range(3))
    assert wh.exists("gold", "v")
    wh.drop_view("gold", "v")
    assert not wh.exists("gold", "v")
    wh.drop_layer("gold")
    assert f"{wh.prefix}gold" not in {d.name for d in spark.catalog.listDatabases()}


def test_extract_writer_refuses_unrepresentable_values(spark):
    from tierline.sources.delimited import write_extract

    bad = spark.createDataFrame([("AC_BR", "Bikes, racks", "x", "Yes")], BRONZE["erp_px_cat_g1v2"])
    with pytest.raises(ValueError, match="cannot represent"):
        write_extract(bad, scratch_path(spark, "bad-extract"))


def test_bronze_load_counts_rows_with_extra_or_missing_fields(spark):
    from tierline.plans.layers import RunAudit, load_bronze
    from tierline.sources.schemas import SOURCE_FILES

    root = scratch_path(spark, "ragged-src")
    _write_text(f"{root}/{SOURCE_FILES['erp_loc_a101']}", "CID,CNTRY\nAW-1,Germany\nAW-2,United,States\nAW-3\n")
    wh = _wh(spark)
    audit = RunAudit()
    load_bronze(wh, root, audit, tables=("erp_loc_a101",))
    (_, layer, table, rows, bad, _, status, _), = audit.rows
    assert (layer, table, rows, bad, status) == ("bronze", "erp_loc_a101", 3, 2, "ok")
    assert wh.read("bronze", "erp_loc_a101").count() == 3      # bad rows are kept, with NULLs


def _star(wh, sources_of="gold"):
    frames = wh.read_together(sources_of)
    return {t: sorted(f.collect(), key=repr) for t, f in frames.items()}


def _wrong_orders(wh, before):
    """Orders whose customer key leads to another customer than it did."""
    fact, cust = wh.read("gold", "fact_sales"), wh.read("gold", "dim_customers")
    now = {(r["order_number"], r["customer_id"]) for r in fact.join(cust, "customer_key").collect()}
    return len(now - before)


def test_a_failed_gold_load_leaves_the_star_as_it_was(spark, monkeypatch):
    from tierline.operators import gold
    from tierline.plans.layers import run_layers

    sources = stage_extracts(spark, SF_SMOKE, scratch_path(spark, "src"))
    wh = _wh(spark)
    run_all(wh, sources, as_of="2026-01-01")
    star, versions = _star(wh), wh.generation("gold")
    orders = {(r["order_number"], r["customer_id"]) for r in wh.read("gold", "fact_sales").join(
        wh.read("gold", "dim_customers"), "customer_key").collect()}
    delete_where(wh, "silver", "crm_cust_info", F.col("cst_id") < 20)     # every later customer key moves
    seen = {}

    def broken(*args, **kwargs):
        seen.update(_star(wh))                                            # a reader while the fact is built
        raise RuntimeError("no fact")

    with monkeypatch.context() as m:
        m.setattr(gold, "fact_sales", broken)
        with pytest.raises(RuntimeError, match="no fact"):
            run_layers(wh, ("gold",))
    assert seen == star and _star(wh) == star and wh.generation("gold") == versions
    assert _wrong_orders(wh, orders) == 0
    for table in star:                                                    # the unpublished versions are gone
        assert f"{wh.name('gold', wh._physical_versions('gold', table)[-1][1])}" == versions[table]
        assert sorted(wh.read("gold", table).collect(), key=repr) == star[table]
    audit = {r["table_name"]: r["status"] for r in spark.table(f"{wh.db('audit')}.load_audit").filter("layer = 'gold'").collect()
             if r["status"] != "ok"}
    assert audit == {"dim_customers": "dropped", "dim_products": "dropped", "fact_sales": "failed", "(layer)": "failed"}
    run_layers(wh, ("gold",))
    assert wh.read("gold", "dim_customers").filter("customer_id < 20").count() == 0 and wh.generation("gold") != versions


def test_publishing_together_undoes_what_it_began(spark, monkeypatch):
    wh = _wh(spark)
    first = {t: wh.write_version("gold", t, spark.range(3)) for t in ("a", "b")}
    wh.publish_together("gold", first)
    second = {t: wh.write_version("gold", t, spark.range(5)) for t in ("a", "b", "c")}
    repoint, calls = wh._repoint, []

    def failing(layer, table, *args):
        calls.append(table)
        if table == "c":
            raise RuntimeError("metastore away")
        repoint(layer, table, *args)

    monkeypatch.setattr(wh, "_repoint", failing)
    with pytest.raises(RuntimeError, match="metastore away"):
        wh.publish_together("gold", second)
    assert calls == ["a", "b", "c"] and wh.generation("gold") == first
    assert wh.read("gold", "a").count() == wh.read("gold", "b").count() == 3 and not wh.exists("gold", "c")
    assert wh.versions("gold", "a") == [1] and wh.versions("gold", "c") == []
    monkeypatch.undo()
    refresh(wh, "gold", "b", spark.range(7))                              # a later refresh of one table alone
    assert {t: f.count() for t, f in wh.read_together("gold").items()} == {"a": 3, "b": 7}
    wh.drop_table("gold", "b")
    assert list(wh.read_together("gold")) == ["a"]
    wh.drop_table("gold", "a")
    assert wh.read_together("gold") == {} and not wh.exists("gold", "generation")


def test_an_append_repeated_under_its_run_id_adds_nothing(spark, monkeypatch):
    from tierline.plans import catalog

    wh = _wh(spark)
    schema = SILVER["erp_loc_a101"]
    rows = spark.createDataFrame([("AW1", "Germany"), ("AW2", None)], schema)
    refresh(wh, "silver", "t", rows, audit_column=True, schema=schema)
    assert append(wh, "silver", "t", rows, "it's run 1") and not append(wh, "silver", "t", rows, "it's run 1")
    assert append(wh, "silver", "t", rows, "run 2") and wh.appended_runs("silver", "t") == ["it's run 1", "run 2"]
    out = wh.read("silver", "t")
    assert out.count() == 6 and out.filter(F.col("dwh_create_date").isNull()).count() == 0
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH|exceeds"):
        append(wh, "silver", "t", spark.createDataFrame([("y" * 51, None)], schema), "run 3")
    assert wh.appended_runs("silver", "t") == ["it's run 1", "run 2"] and wh.read("silver", "t").count() == 6
    delete_where(wh, "silver", "t", F.col("cntry").isNull())              # one version again, its runs still known
    assert wh.read("silver", "t").count() == 3 and not append(wh, "silver", "t", rows, "run 2")
    monkeypatch.setattr(catalog, "MAX_PARTS", 2)
    for i in range(4):
        append(wh, "silver", "t", rows, f"more {i}")
    assert wh.read("silver", "t").count() == 11 and len(wh.appended_runs("silver", "t")) == 6
    refresh(wh, "silver", "t", rows, audit_column=True, schema=schema)
    assert wh.appended_runs("silver", "t") == [] and wh.read("silver", "t").count() == 2
    refresh(wh, "silver", "t", rows, audit_column=True, schema=schema)
    wh.drop_table("silver", "t")
    assert not spark.catalog.listTables(wh.db("silver"), pattern="t__*")


def test_a_repeated_append_packs_what_it_writes_and_shuffles_texts_alone(spark, monkeypatch):
    from tierline.plans import registry
    from tierline.session import path_bytes
    from tierline.sources import delimited

    out = registry.q_silver_append_repeat(spark, SF_SMOKE)
    assert all(f.endswith(".zstd.parquet") for f in out.inputFiles())               # loaded and appended rows
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(" in plan and "hashpartitioning(table_name" not in plan

    monkeypatch.setattr(delimited, "ROWS_PER_FILE", 500)
    root = stage_extracts(spark, SF_SMOKE, scratch_path(spark, "src"))
    files = [os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.startswith("part-")]
    assert files and all(f.endswith(".csv.gz") for f in files)
    assert path_bytes(spark, root) > 3 * sum(map(os.path.getsize, files))            # sized by their text
    sales = [f for f in files if "sales_details" in f]
    rows = registry._bronze(spark, SF_SMOKE, "crm_sales_details").count()
    assert len(sales) >= rows / 500 and all(spark.read.text(f).count() <= 501 for f in sales)


def test_an_append_run_that_stopped_halfway_is_completed(spark, monkeypatch):
    from tierline.plans import layers

    sources = stage_extracts(spark, SF_SMOKE, scratch_path(spark, "src"))
    wh = _wh(spark)
    layers.run_layers(wh, ("bronze", "silver"), sources, as_of="2026-01-01")
    before = {t: wh.read("silver", t).count() for t in SILVER}
    plain = layers.append

    def failing(wh, layer, table, *args):
        if table == "erp_loc_a101":
            raise RuntimeError("stopped")
        return plain(wh, layer, table, *args)

    monkeypatch.setattr(layers, "append", failing)
    with pytest.raises(RuntimeError, match="stopped"):
        layers.run_layers(wh, ("append",), as_of="2026-01-01", run_id="night")
    monkeypatch.undo()
    layers.run_layers(wh, ("append",), as_of="2026-01-01", run_id="night")
    after = {t: wh.read("silver", t).count() for t in SILVER}
    ids = wh.read("bronze", "crm_cust_info").select("cst_id").distinct().count()
    assert after.pop("crm_cust_info") == before.pop("crm_cust_info") + ids
    assert after == {t: 2 * n for t, n in before.items()}


def test_rejected_rows_are_kept_with_their_file(spark):
    from tierline.plans.layers import RunAudit, load_bronze
    from tierline.sources.schemas import SOURCE_FILES

    root = scratch_path(spark, "ragged-src")
    _write_text(f"{root}/{SOURCE_FILES['erp_loc_a101']}", "CID,CNTRY\nAW-1,Germany\nAW-2,United,States\nAW-3\n" + "y" * 50 + ",a,b\n")
    wh = _wh(spark)
    load_bronze(wh, root, RunAudit(), tables=("erp_loc_a101",))
    assert wh.read("bronze", "erp_loc_a101").columns == ["cid", "cntry"]
    rejects = wh.read("bronze", "erp_loc_a101_rejects").collect()
    assert {r["_raw"] for r in rejects} == {"AW-2,United,States", "AW-3", "y" * 50 + ",a,b"}
    assert all(r["_file"].endswith("LOC_A101.csv") for r in rejects)
    wh.drop_table("bronze", "erp_loc_a101")
    assert not wh.exists("bronze", "erp_loc_a101_rejects")
