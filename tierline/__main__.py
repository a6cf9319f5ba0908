"""Command line of the warehouse.

``python -m tierline run --sources DIR --warehouse DIR [--as-of DATE]`` runs bronze -> silver -> gold;
``load-bronze``, ``load-silver``, ``load-gold`` and ``append`` run one step each. All print the load
audit they wrote. ``quality --warehouse DIR`` prints the one-pass rule counts of the published bronze
tables.

The session comes from the environment (``spark-submit`` / cluster defaults); shuffle and scan
partition sizes follow the size of the extracts unless ``--no-sizing`` is given.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from tierline.operators.quality import quality_summary
from tierline.plans.catalog import Warehouse
from tierline.plans.layers import run_layers
from tierline.sources.schemas import BRONZE

STEPS = {"run": ("bronze", "silver", "gold"), "load-bronze": ("bronze",), "load-silver": ("silver",),
         "load-gold": ("gold",), "append": ("append",)}


def _print(df: DataFrame) -> None:
    """All rows, as tab-separated lines (an audit or rule count has a row per table or rule)."""
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tierline")
    sub = parser.add_subparsers(dest="command", required=True)
    for name, layers in STEPS.items():
        p = sub.add_parser(name, help=f"steps: {', '.join(layers)}")
        p.add_argument("--warehouse", help="warehouse root (default: <spark.checkpoint.dir>/warehouse)")
        p.add_argument("--prefix", default="", help="namespace prefix, e.g. 'dev_'")
        p.add_argument("--as-of", help="date for future-birth-date checks (default: today)")
        if "bronze" in layers:
            p.add_argument("--sources", required=True, help="folder with source_crm/ and source_erp/ extracts")
            p.add_argument("--no-sizing", action="store_true", help="keep the session's partition settings")
        if "gold" in layers:
            p.add_argument("--partition-fact-by", default="", help="comma-separated fact columns, e.g. order_date")
    sub.choices["append"].add_argument("--run-id", help="name of the run: repeating it appends nothing twice")
    sub.choices["run"].add_argument("--verify", action="store_true", help="count the post-load checks into the audit")
    q = sub.add_parser("quality", help="count every data-quality rule on the published bronze tables")
    q.add_argument("--warehouse")
    q.add_argument("--prefix", default="")
    q.add_argument("--as-of")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("tierline").getOrCreate()
    wh = Warehouse(spark, root=args.warehouse, prefix=args.prefix)
    if args.command == "quality":
        bronze = {t: wh.read("bronze", t) for t in BRONZE if wh.exists("bronze", t)}
        _print(quality_summary(bronze, as_of=args.as_of))
        return 0
    parts = tuple(c for c in getattr(args, "partition_fact_by", "").split(",") if c)
    layers = STEPS[args.command] + (("check",) if getattr(args, "verify", False) else ())
    audit = run_layers(wh, layers, getattr(args, "sources", None), as_of=args.as_of, fact_partition_by=parts,
                       sizing=not getattr(args, "no_sizing", False), run_id=getattr(args, "run_id", None))
    _print(audit.orderBy("layer", "table_name"))
    return 0


if __name__ == "__main__":
    sys.exit(main())
