"""Skew report: largest task (shuffle records read) of plain vs skew-aware operators.

Orders from the driver tables are made skewed by giving one customer a third of all rows (and
another 5% NULL customers). Each operator runs in its own job group with Spark's event log written
to a fresh scratch folder; the report reads per-task shuffle records from that log.

Usage: python tools/skew_report.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tierline.operators import joins
from tierline.operators.absence import not_in  # noqa: E402
from tierline.operators.ranged import dense_key, lead_in_group  # noqa: E402
from tierline.operators.silver import latest_per_key  # noqa: E402
from tierline.sources.fixtures import read_table  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="run-eventlog-", dir="/tmp")
    spark = (SparkSession.builder.master("local[8]").appName("skew-report")
             .config("spark.ui.enabled", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", f"file://{log_dir}")
             .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false")
             .config("spark.sql.shuffle.partitions", "16")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
             .config("spark.sql.adaptive.skewJoin.enabled", "false")   # measure our own handling
             .config("spark.sql.autoBroadcastJoinThreshold", "-1")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    orders = read_table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(1)).when(F.col("o_orderkey") % 20 == 1, F.lit(None))
         .otherwise(F.col("o_custkey")).alias("o_custkey"),
        "o_orderdate")
    customers = read_table(spark, sf, "customer").select("c_custkey", "c_mktsegment")

    def run(group: str, build) -> None:
        spark.sparkContext.setJobGroup(group, group)  # before building: some operators write tables
        build().write.format("noop").mode("overwrite").save()

    n = orders.count()
    per = -(-n // 16)
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    run("lead: plain window", lambda: orders.withColumn("nx", F.lead("o_orderdate").over(w)))
    run("lead: range buckets", lambda: lead_in_group(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"],
                                             "o_orderdate", "nx", rows_per_bucket=per, n_rows=n))
    run("key: global window", lambda: orders.withColumn("k", F.row_number().over(Window.orderBy("o_orderdate", "o_orderkey"))))
    run("key: range buckets", lambda: dense_key(orders, ["o_orderdate", "o_orderkey"], "k", rows_per_bucket=per, n_rows=n))
    run("latest per key: window rn=1", lambda: latest_per_key(orders, "o_custkey", [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]))
    run("join: plain shuffle join", lambda: orders.join(customers, orders["o_custkey"] == customers["c_custkey"], "left"))
    run("join: salted shuffle join", lambda: joins.salted_join(orders, customers, [("o_custkey", "c_custkey")], "left"))
    evens = customers.filter(F.col("c_custkey") % 2 == 0)
    run("not in: plain anti join", lambda: orders.join(evens, orders["o_custkey"] == evens["c_custkey"], "left_anti"))
    run("not in: exact, salted", lambda: not_in(orders, "o_custkey", evens, "c_custkey", max_rows=10, salted=True))
    spark.stop()

    stage_group: dict[int, str] = {}
    tasks: dict[str, list[int]] = defaultdict(list)
    for path in [p for p in glob.glob(f"{log_dir}/**/*", recursive=True) if os.path.isfile(p)]:
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        if group:
                            stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    m = ev.get("Task Metrics") or {}
                    read = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    if read:
                        tasks[stage_group.get(ev["Stage ID"], "?")].append((ev["Stage ID"], read))
    print(f"event log: {log_dir}")
    print(f"{'operator':32s} {'tasks':>6s} {'max records':>12s} {'mean':>10s} {'max/mean':>9s}")
    for group in dict.fromkeys(stage_group.values()):
        rows = tasks.get(group, [])
        if not rows:
            continue
        by_stage: dict[int, list[int]] = defaultdict(list)
        for sid, n in rows:
            by_stage[sid].append(n)
        # The stage whose largest task is biggest is the one that matters.
        worst = max(by_stage.values(), key=max)
        mean = sum(worst) / len(worst)
        print(f"{group:32s} {len(worst):6d} {max(worst):12d} {mean:10.0f} {max(worst) / mean:9.2f}")


if __name__ == "__main__":
    main()
