"""Range-bucketed keys and lead, salted joins and NOT IN: equal to the plain forms, under skew."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tierline.operators import joins
from tierline.operators.absence import absent_rows, filter_words, may_contain, not_in
from tierline.operators.ranged import bucket_count, dense_key, lead_in_group, ranged
from tierline.staging import measure, stage


@pytest.fixture(scope="module")
def skewed(spark):
    # A third of the rows share one key; some keys are NULL.
    return spark.range(0, 3000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 == 1, F.lit(None))
         .otherwise((F.col("id") % 97).cast("int")).alias("k"),
        F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.col("id") % 13).alias("v"))


def test_ranges_split_a_hot_key_when_order_is_total(skewed):
    tagged = ranged(skewed, ["k", "id"], [], 6)
    assert tagged.filter("k = 7").select("_tl_bucket").distinct().count() >= 2
    # Buckets are ranges: ordering by (bucket, place) never contradicts ordering by the key.
    w = Window.orderBy(F.col("k").asc_nulls_first(), "id")
    seq = tagged.withColumn("prev", F.lag(F.struct("_tl_bucket", "_tl_place")).over(w))
    assert seq.filter(F.col("prev") > F.struct("_tl_bucket", "_tl_place")).count() == 0


def test_dense_key_equals_global_row_number(skewed):
    expect = skewed.withColumn("rk", F.row_number().over(
        Window.orderBy(F.col("k").asc_nulls_first(), "id")).cast("bigint"))
    got = dense_key(skewed, ["k", "id"], "rk", rows_per_bucket=450)
    assert sorted(got.select("id", "rk").collect()) == sorted(expect.select("id", "rk").collect())


def test_lead_in_group_equals_window(skewed):
    w = Window.partitionBy("k").orderBy(F.col("v").asc_nulls_first(), "id")
    expect = skewed.withColumn("nx", F.lead("v").over(w))
    for n in (10_000, 600, 333):
        got = lead_in_group(skewed, ["k"], ["v", "id"], "v", "nx", rows_per_bucket=n)
        assert sorted(got.select("id", "nx").collect()) == sorted(expect.select("id", "nx").collect())


def test_lead_heads_in_many_levels_and_nothing_broadcast(skewed):
    w = Window.partitionBy("k").orderBy(F.col("v").asc_nulls_first(), "id")
    expect = skewed.withColumn("nx", F.lead("v").over(w))
    for fan in (2, 3, 50):
        got = lead_in_group(skewed, ["k"], ["v", "id"], "v", "nx", rows_per_bucket=40, fan=fan)
        assert sorted(got.select("id", "nx").collect()) == sorted(expect.select("id", "nx").collect())
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan.lower()


def test_salted_join_equals_plain_join(spark, skewed):
    dim = spark.range(0, 100).select(F.col("id").cast("int").alias("dk"), (F.col("id") * 10).alias("payload"))
    plain = skewed.join(dim, skewed["k"] == dim["dk"], "left").select("id", "payload")
    salted = joins.salted_join(skewed, dim, [("k", "dk")], "left").select("id", "payload")
    assert sorted(salted.collect()) == sorted(plain.collect())
    hot = joins.hot_keys(skewed, ["k"], partitions=8)
    assert [r["k"] for r in hot.collect()] == [7]


def test_salted_anti_join(spark, skewed):
    right = spark.range(0, 50).select(F.col("id").cast("int").alias("rk"))
    plain = skewed.join(right, skewed["k"] == right["rk"], "left_anti").select("id")
    salted = joins.salted_join(skewed, right, [("k", "rk")], "left_anti").select("id")
    assert sorted(salted.collect()) == sorted(plain.collect())


def test_checked_broadcast_bound(spark):
    small = spark.range(10)
    assert joins.checked_broadcast(small, max_rows=10) is not None
    assert joins.checked_broadcast(small, max_rows=9) is None


def test_broadcast_bytes_are_measured(spark):
    wide = spark.range(100).select(F.repeat(F.lit("x"), 2000).alias("s"))
    assert measure(wide).bytes > 200_000
    assert joins.checked_broadcast(wide, max_bytes=150_000) is None
    nested = spark.range(10).select(F.array_repeat(F.lit("abcdefgh"), 500).alias("a"))
    assert measure(nested).bytes > 40_000
    assert stage(spark.range(7), "t").stats.rows == 7 and measure(spark.range(0)).rows == 0


def test_the_size_check_sends_one_row_a_task(spark):
    import inspect

    from tierline import staging

    assert "limit(" not in inspect.getsource(staging) + inspect.getsource(joins)


def test_hot_key_threshold_follows_the_partitions(spark):
    rows = spark.range(0, 20_000).select(F.when(F.col("id") % 111 == 0, -1).otherwise(F.col("id")).alias("k"))
    assert joins.hot_keys(rows, ["k"], partitions=8).count() == 0            # 0.9% of an eighth
    assert [r["k"] for r in joins.hot_keys(rows, ["k"], partitions=400).collect()] == [-1]


def test_equal_rows_of_a_hot_key_are_spread(spark):
    from collections import Counter

    # A third of the rows are one repeated row.
    path = stage(spark.range(0, 90_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.lit("same").alias("p")), "dup").df
    keys = ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")
    saved = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set(keys[0], "false")
        spark.conf.set(keys[1], "16")
        right = spark.range(-1, 10).select(F.col("id").alias("rk"))
        joined = joins.salted_join(path, right, [("k", "rk")], "left")
        sizes = Counter(r[0] for r in joined.select(F.spark_partition_id()).collect())
        assert sum(sizes.values()) == 90_000 and max(sizes.values()) < 2 * 90_000 / 16
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)


def test_not_in_sql_semantics(spark, skewed):
    skewed.createOrReplaceTempView("l_t")
    cases = {
        "some": spark.range(0, 40).select(F.col("id").cast("int").alias("rk")),
        "with_null": spark.range(0, 40).select(F.when(F.col("id") == 3, None).otherwise(F.col("id")).cast("int").alias("rk")),
        "empty": spark.range(0).select(F.col("id").cast("int").alias("rk")),
    }
    for name, right in cases.items():
        right.createOrReplaceTempView("r_t")
        expect = spark.sql("select id from l_t where k not in (select rk from r_t)")
        for max_rows, salted in ((1_000_000, False), (5, True), (5, False)):  # broadcast, salted shuffle, filter
            got = not_in(skewed, "k", right, "rk", max_rows=max_rows, salted=salted).select("id")
            assert sorted(got.collect()) == sorted(expect.collect()), (name, max_rows, salted)


def test_a_filter_misses_no_key_and_few_others_pass(spark):
    keys = spark.range(0, 20_000).select((F.col("id") * 3).alias("k")).unionByName(spark.createDataFrame([(None,)], "k long"))
    words = filter_words(keys, "k", bits=1 << 18)
    assert len(words.first()["words"]) == (1 << 18) // 64
    asked = spark.range(0, 60_000).select("id", may_contain(words.scalar(), F.col("id"), 1 << 18).alias("hit"))
    counts = {(r["third"], r["hit"]): r["count"] for r in
              asked.groupBy((F.col("id") % 3 == 0).alias("third"), "hit").count().collect()}
    assert counts[True, True] == 20_000 and (True, False) not in counts and counts[False, True] < 2_000


def test_absent_rows_are_exact_even_when_every_key_passes_the_filter(spark, skewed):
    a = spark.range(0, 60).select(F.col("id").cast("int").alias("rk")).unionByName(spark.createDataFrame([(3,), (None,)], "rk int"))
    b = spark.range(0, 9).select(F.col("id").alias("rv"))
    expect = [r["id"] for r in skewed.collect() if r["k"] is None or r["k"] >= 60 or r["v"] is None or r["v"] >= 9]
    for bits in (64, 1 << 20):
        got = absent_rows(skewed, [("k", a, "rk"), ("v", b, "rv")], bits=bits)
        assert got.columns == skewed.columns and sorted(r["id"] for r in got.collect()) == expect


def test_buckets_are_balanced_under_a_hot_key(skewed):
    sizes = [r["count"] for r in ranged(skewed, ["k", "id"], [], 6).groupBy("_tl_bucket").count().collect()]
    assert len(sizes) == 6 and max(sizes) <= 1.5 * sum(sizes) / 6


def test_bucket_count_rises_with_rows_without_a_cap():
    assert [bucket_count(n) for n in (0, 2_000_000, 2_000_001, 10**11)] == [1, 1, 2, 50_000]


def test_salted_inner_join_and_explicit_hot_keys(spark, skewed):
    dim = spark.range(0, 60).select(F.col("id").cast("int").alias("dk"), (F.col("id") % 7).alias("p"))
    plain = skewed.join(dim, skewed["k"] == dim["dk"], "inner").select("id", "p")
    hot = spark.createDataFrame([(7, 5), (3, 2)], "k int, _tl_n int")
    salted = joins.salted_join(skewed, dim, [("k", "dk")], "inner", hot=hot).select("id", "p")
    assert sorted(salted.collect()) == sorted(plain.collect())


def test_shuffle_partitions_parsing(spark):
    from tierline.session import shuffle_partitions

    saved = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert shuffle_partitions(spark) == int(saved)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", saved)


def test_global_lead_without_groups(skewed):
    expect = skewed.withColumn("nx", F.lead("v").over(Window.orderBy(F.col("v").asc_nulls_first(), "id")))
    got = lead_in_group(skewed, [], ["v", "id"], "v", "nx", rows_per_bucket=600)
    assert sorted(got.select("id", "nx").collect()) == sorted(expect.select("id", "nx").collect())


def test_dense_key_over_mixed_types_and_ties(spark):
    df = spark.range(0, 600).select(
        F.when(F.col("id") % 11 == 0, None).otherwise(F.timestamp_seconds(F.lit(1_600_000_000) + F.col("id") % 37)).alias("ts"),
        F.date_add(F.lit("1999-12-30").cast("date"), (F.col("id") % 5).cast("int")).alias("d"),
        F.when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("é-"), (F.col("id") % 13).cast("string"))).alias("s"),
        F.col("id"))
    order = [F.col(c).asc_nulls_first() for c in ("ts", "d", "s", "id")]
    expect = df.withColumn("k", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    got = dense_key(df, ["ts", "d"], "k", rows_per_bucket=50, tie_cols=["s", "id"])
    assert sorted(got.collect(), key=repr) == sorted(expect.collect(), key=repr)
    assert dense_key(df.limit(0), ["ts"], "k", rows_per_bucket=50).count() == 0


def test_bucketed_tables_join_without_an_exchange(spark):
    import uuid

    from tierline.operators import gold
    from tierline.plans.catalog import Warehouse
    from tierline.session import scratch_path

    wh = Warehouse(spark, root=scratch_path(spark, "bucketed-wh"), prefix=f"b{uuid.uuid4().hex[:6]}_")
    sales = spark.range(0, 4000).select(
        F.concat(F.lit("S"), F.col("id")).alias("sls_ord_num"), (F.col("id") % 9).cast("string").alias("sls_prd_key"),
        F.when(F.col("id") % 17 != 0, F.col("id") % 500).cast("int").alias("sls_cust_id"),
        *[F.lit(None).cast("date").alias(f"sls_{c}_dt") for c in ("order", "ship", "due")],
        *[F.lit(1).alias(f"sls_{c}") for c in ("sales", "quantity", "price")])
    cust = spark.range(0, 400).select(F.col("id").cast("int").alias("customer_id"), (F.col("id") + 1).alias("customer_key"))
    prod = spark.range(0, 7).select(F.col("id").cast("string").alias("product_number"), (F.col("id") + 1).alias("product_key"))
    saved = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        for hot in (False, True):
            rows = sales.withColumn("sls_cust_id", F.when(F.col("sls_prd_key") < "4", 7).otherwise(F.col("sls_cust_id"))) if hot else sales
            wh.publish("silver", "sales", rows, bucket_by=(8, "sls_cust_id"))
            wh.publish("gold", "cust", cust, bucket_by=(8, "customer_id"))
            got = gold.fact_sales_bucketed(wh.read("silver", "sales"), prod, wh.read("gold", "cust"))
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert ("SortMergeJoin" in plan) is not hot and plan.count("Exchange hashpartitioning") == 0
            assert sorted(got.collect(), key=repr) == sorted(gold.fact_sales(rows, prod, cust).collect(), key=repr)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", saved)


def test_absent_rows_scans_its_rows_twice_whatever_the_checks(spark, monkeypatch):
    from tierline.operators import absence

    left = stage(spark.range(0, 4000).select(
        "id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 400).alias("a"),
        F.when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 130)).alias("b")), "left").df
    files = set(left.inputFiles())
    a, b = spark.range(0, 390).toDF("a_key"), spark.range(0, 120).select(F.concat(F.lit("k"), "id").alias("b_key"))
    expect = sorted(r["id"] for r in left.collect() if r["a"] >= 390 or r["b"] is None or int(r["b"][1:]) >= 120)
    scans, write = [], absence.stage

    def counted(df, name):
        scans.extend([name] if files & set(df.inputFiles()) else [])
        return write(df, name)

    monkeypatch.setattr(absence, "stage", counted)
    for bits in (64, 1 << 12, 1 << 23):                   # every key passes by chance, some, none
        scans.clear()
        got = absent_rows(left, [("a", a, "a_key"), ("b", b, "b_key")], bits=bits)
        assert sorted(r["id"] for r in got.collect()) == expect and got.columns == left.columns
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert len(scans) == 1 and "Union" not in plan    # the keys asked for, and the rows
    # chance keys beyond a broadcast: the rows that miss a bit stay out of the salted join
    monkeypatch.setattr(absence, "fits_broadcast", lambda stats: False)
    monkeypatch.setattr(joins, "checked_broadcast", lambda *args, **kwargs: None)
    got = absent_rows(left, [("a", a, "a_key"), ("b", b, "b_key")], bits=64)
    assert sorted(r["id"] for r in got.collect()) == expect
