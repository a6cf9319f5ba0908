"""tierline: a bronze -> silver -> gold warehouse built as Spark DataFrame jobs.

Layout
------
``sources``    table schemas, the delimited-file reader, driver tables and dirty fixture frames
``functions``  column expressions: code maps, integer dates, trimming
``operators``  silver cleaning (T1-T6), gold star schema (G1-G4), data-quality checks (Q1-Q15),
               range-bucketed keys and ``lead``, skew-aware joins
``plans``      catalog (namespaces, tables, views), sinks (refresh / append / delete) and the
               layer pipeline with its load audit
``staging``    written intermediate tables with measured sizes
``llm``        operators of a training-data pipeline (optional: nothing else imports it)

Entry points: ``Warehouse`` (catalog), ``run_all`` (bronze -> silver -> gold with audit), and
``python -m tierline`` on the command line.
"""

from tierline.plans.catalog import Warehouse
from tierline.plans.layers import run_all
from tierline.session import build_session, shared_dir

__all__ = ["Warehouse", "build_session", "run_all", "shared_dir"]
