"""Sinks: full refresh (S2), append by named columns with defaulted audit column (S3, S4) and
conditional delete (S9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.plans.catalog import Joined, Warehouse
from tierline.sources.schemas import AUDIT_COLUMN, REJECT_COLUMNS


def refresh(wh: Warehouse, layer: str, table: str, df: DataFrame, audit_column: bool = False,
            schema: T.StructType | None = None, partition_by: tuple[str, ...] = (),
            analyze: bool = False, rejects: bool = False, publish: bool = True, joined: Joined | None = None) -> str:
    """Replace the contents of ``layer.table`` with ``df`` (new version, then view repoint).

    With ``schema`` the version is a typed table (S5: ``VARCHAR(50)`` strings; with
    ``audit_column`` a ``dwh_create_date DEFAULT current_timestamp()`` column filled by default, S4; with
    ``rejects`` the raw text and file of rows that did not parse, shown by ``<table>_rejects``).
    Without it, ``audit_column`` adds ``dwh_create_date = current_timestamp()`` to the rows. With
    ``publish=False`` the version is written only, for ``Warehouse.publish_together``. ``joined`` as in
    ``Warehouse.write_version``.
    """
    write = wh.publish if publish else wh.write_version
    if schema is not None:
        columns = [*schema.fieldNames(), *(REJECT_COLUMNS if rejects else ())]
        return write(layer, table, df.select(*columns), schema=schema, with_audit=audit_column, analyze=analyze,
                     rejects=rejects)
    if audit_column:
        df = df.withColumn(AUDIT_COLUMN, F.current_timestamp())
    return write(layer, table, df, partition_by=partition_by, analyze=analyze, joined=joined)


def append(wh: Warehouse, layer: str, table: str, df: DataFrame, run_id: str | None = None) -> bool:
    """S3: ``INSERT INTO layer.table (df's columns) SELECT ...``; columns not given (such as the
    silver audit column) take their declared defaults. With ``run_id`` a repeated append of the same run
    adds nothing (returns False)."""
    return wh.append(layer, table, df, run_id)


def delete_where(wh: Warehouse, layer: str, table: str, predicate: Column) -> str:
    """Remove the rows of the published ``layer.table`` for which ``predicate`` is TRUE.

    Parquet tables have no row-level DELETE and a table cannot be overwritten while it is read,
    so the kept rows become the next version, of the same definition, and the view is repointed.
    """
    kept = wh.read(layer, table).filter(~F.coalesce(predicate, F.lit(False)))
    return wh.publish(layer, table, kept, like=wh.current(layer, table), runs=wh.appended_runs(layer, table))
