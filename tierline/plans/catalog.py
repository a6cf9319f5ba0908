"""Catalog objects: layer namespaces (S7), drop-if-exists (S6), typed tables (S5), published views
(S8) and whole-table reads (S10).

A published name is a view over a versioned Parquet table (``name__v0003_<run>``). A refresh writes the
next version in full and only then repoints the view, so a failed load leaves the previous data
readable (a truncate-then-load or an in-place overwrite would leave an empty or broken table). Created,
refreshed and appended tables are all of this one kind, so every operation works on every name.

Tables that belong together (the star schema) are written first, all of them, and then published by
``publish_together``: their views are repointed one after the other, undone if one fails, and the view
``<layer>.generation`` names the versions that belong together. It is replaced by one statement, so
``read_together`` sees all tables of one generation whatever happens in between.

A version may be kept as the parts of a join (``Joined``): its rows and the sides they are looked up in are
tables of their own, and the version is a view that joins them when it is read.

An append may carry a run id. Its rows are then a table of their own, joined to the view by the one
statement that also notes the run in the view's properties: a repeated run adds nothing.
"""

from __future__ import annotations

import re
import uuid
import warnings

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.operators.joins import ROW_ID
from tierline.session import PARQUET_OPTIONS, shared_dir
from tierline.sources.schemas import REJECT_COLUMNS, table_ddl
from tierline.staging import stage

LAYERS = ("bronze", "silver", "gold")
GENERATION = "generation"
REJECTS = "_rejects"
# Appended runs of a name beyond this many are folded into one version.
MAX_PARTS = 32
_RUNS = "tierline.runs"
_VERSION = re.compile(r"^(?P<name>.+)__v(?P<n>\d+)(_[0-9a-f]+)?$")
_SOURCE = re.compile(r"FROM (`[^`]+`\.`[^`]+`)")


def _insert_by_name(spark: SparkSession, target: str, df: DataFrame) -> None:
    """``INSERT INTO target (df's columns) SELECT ...``: missing columns take their defaults."""
    view = f"_tl_src_{uuid.uuid4().hex[:12]}"
    df.createOrReplaceTempView(view)
    try:
        cols = ", ".join(f"`{c}`" for c in df.columns)
        spark.sql(f"INSERT INTO {target} ({cols}) SELECT {cols} FROM `{view}`")
    finally:
        spark.catalog.dropTempView(view)


MAX_PARTITION_VALUES = 10_000


def _spread(df: DataFrame, partition_by: tuple[str, ...]) -> DataFrame:
    """Rows ranged by partition value and row number, so every task writes about as many rows as any other
    whatever the values weigh: a value with a third of all rows (such as NULL dates) is a third of the
    ranges, even if its rows are equal, and rare values share one. There are at most as many files as
    values and tasks together. The rows are written once before, so their numbers hold."""
    if not partition_by:
        return df
    rows = stage(df, "partitioned").df.withColumn(ROW_ID, F.monotonically_increasing_id())
    values = rows.agg(F.approx_count_distinct(F.struct(*partition_by))).first()[0]
    if values > MAX_PARTITION_VALUES:
        warnings.warn(f"partitioning by {', '.join(partition_by)} makes about {values} folders; a coarser "
                      "column (such as the month) prunes nearly as well", stacklevel=3)
    return rows.repartitionByRange(*partition_by, ROW_ID).drop(ROW_ID)


@dataclass(frozen=True)
class Joined:
    """The left joins that make a version's ``columns`` of its rows: (name, side, column of the rows, column
    of the side) each."""
    columns: Sequence[str]
    sides: Sequence[tuple[str, DataFrame, str, str]]


class Warehouse:
    """Namespaces ``{prefix}bronze``, ``{prefix}silver``, ``{prefix}gold`` (and ``{prefix}audit``)
    whose tables live under ``root`` (default: ``<spark.checkpoint.dir>/warehouse``)."""

    def __init__(self, spark: SparkSession, root: str | None = None, prefix: str = "", keep_versions: int = 2):
        self.spark = spark
        self.root = (root or f"{shared_dir(spark)}/warehouse").rstrip("/")
        self.prefix = prefix
        self.keep_versions = keep_versions

    # ---- names ----
    def db(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    def name(self, layer: str, table: str) -> str:
        return f"`{self.db(layer)}`.`{table}`"

    # ---- S7 / S6 ----
    def ensure_namespace(self, layer: str) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.db(layer)}` LOCATION '{self.root}/{self.db(layer)}.db'")

    def ensure_layers(self, layers=LAYERS) -> None:
        for layer in layers:
            self.ensure_namespace(layer)

    def drop_table(self, layer: str, table: str) -> None:
        """Drop-if-exists of a published name: its view and every version behind it."""
        if not self.spark.catalog.databaseExists(self.db(layer)):
            return
        self.drop_view(layer, table)
        self.drop_view(layer, table + REJECTS)
        self._set_generation(layer, {k: v for k, v in self.generation(layer).items() if k != table})
        for _, physical in self._physical_versions(layer, table):
            self._drop_physical(layer, physical)

    def _drop_physical(self, layer: str, physical: str) -> None:
        """Drop a version, the runs appended to it and the parts it joins."""
        for t in self.spark.catalog.listTables(self.db(layer), pattern=f"{physical}|{physical}_p_*"):
            if not t.isTemporary:
                kind = "VIEW" if t.tableType == "VIEW" else "TABLE"
                self.spark.sql(f"DROP {kind} IF EXISTS {self.name(layer, t.name)}")

    def drop_view(self, layer: str, view: str) -> None:
        self.spark.sql(f"DROP VIEW IF EXISTS {self.name(layer, view)}")

    def drop_layer(self, layer: str) -> None:
        self.spark.sql(f"DROP DATABASE IF EXISTS `{self.db(layer)}` CASCADE")

    # ---- S5 ----
    def create_table(self, layer: str, table: str, schema, with_audit: bool = False, replace: bool = True) -> str:
        """Drop-if-exists, then publish an empty typed table (``VARCHAR(50)`` strings; silver tables
        get ``dwh_create_date DEFAULT current_timestamp()``) under the same kind of name that
        ``publish`` makes."""
        self.ensure_namespace(layer)
        if replace:
            self.drop_table(layer, table)
        target = self._next_version(layer, table)
        self.spark.sql(table_ddl(target, schema, with_audit=with_audit))
        self.publish_view(layer, table, f"SELECT * FROM {target}")
        return self.name(layer, table)

    def _view_text(self, layer: str, table: str) -> str:
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(layer, table)}").collect()
        return next(r[1] for r in rows if r[0] == "View Text")

    def current(self, layer: str, table: str) -> str:
        """The versioned table behind a published name (its first, if runs were appended)."""
        return _SOURCE.search(self._view_text(layer, table)).group(1)

    def append(self, layer: str, table: str, df: DataFrame, run_id: str | None = None) -> bool:
        """Append ``df`` to the published name by column name; columns not given take their defaults.

        Without ``run_id`` the rows are inserted into the version behind the name: its files become visible
        when the job commits, running readers keep the files they listed, and a failed insert leaves
        the table as it was. With ``run_id`` they become a table of their own that one statement adds
        to the view together with the run's name; a run that is there already adds nothing. Returns whether
        the rows were appended. A version that is a join of its parts takes rows of either kind as a table.
        """
        if run_id is None and not self._is_join(layer, self.current(layer, table)):
            _insert_by_name(self.spark, self.current(layer, table), df)
            self.spark.catalog.refreshTable(self.name(layer, table))
            return True
        runs = self.appended_runs(layer, table)
        if run_id in runs:
            return False
        text = self._view_text(layer, table)
        sources = _SOURCE.findall(text)
        part = f"{sources[0][:-1]}_p_{uuid.uuid4().hex[:12]}`"  # named after its version, dropped with it
        try:
            self.spark.sql(f"CREATE TABLE {part} LIKE {sources[0]} USING parquet")
            _insert_by_name(self.spark, part, df)
            columns = text[len("SELECT "):text.index(" FROM ")]
            noted = runs if run_id is None else [*runs, run_id]
            self.publish_view(layer, table, f"{text} UNION ALL SELECT {columns} FROM {part}", noted)
        except Exception:
            self.spark.sql(f"DROP TABLE IF EXISTS {part}")
            raise
        if len(sources) >= MAX_PARTS:
            self.publish(layer, table, self.read(layer, table), like=sources[0], runs=noted)
        return True

    def _is_join(self, layer: str, target: str) -> bool:
        return self.spark.catalog.getTable(target).tableType == "VIEW"

    def appended_runs(self, layer: str, table: str) -> list[str]:
        """Ids of the runs appended to a name since its last refresh."""
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(layer, table)}").collect()
        return next((r["value"].split("\n") for r in rows if r["key"] == _RUNS), [])

    def _next_version(self, layer: str, table: str) -> str:
        existing = self._physical_versions(layer, table)
        version = (existing[-1][0] + 1) if existing else 1
        # A run suffix: folders left by a run that died mid-write can never block this name.
        return self.name(layer, f"{table}__v{version:04d}_{uuid.uuid4().hex[:6]}")

    # ---- S8 / S2 ----
    def _physical_versions(self, layer: str, table: str) -> list[tuple[int, str]]:
        out = []
        # The name pattern keeps the listing to this table's versions: a plain listing also walks
        # every temporary view, which concurrent loads create and drop while it runs.
        for t in self.spark.catalog.listTables(self.db(layer), pattern=f"{table}__v*"):
            m = _VERSION.match(t.name)
            if m and m.group("name") == table and not t.isTemporary:
                out.append((int(m.group("n")), t.name))
        return sorted(out)

    def versions(self, layer: str, table: str) -> list[int]:
        """Version numbers of ``table`` that exist as tables, oldest first."""
        return [n for n, _ in self._physical_versions(layer, table)]

    def write_version(self, layer: str, table: str, df: DataFrame, schema=None, with_audit: bool = False,
                      partition_by: tuple[str, ...] = (), analyze: bool = False, like: str | None = None,
                      rejects: bool = False, bucket_by: tuple[int, str] | None = None,
                      joined: Joined | None = None) -> str:
        """Write ``df`` as the next version of ``table`` without publishing it; a failed write drops it.

        With ``schema`` the version is first created as a typed table (``VARCHAR(50)`` strings,
        optional defaulted audit column) and filled by ``INSERT INTO t (cols) SELECT``, so types,
        string limits and defaults are enforced by the table; with ``rejects`` it also holds the raw text and
        file of rows that did not parse. ``like`` names a version whose definition is taken over
        instead. ``partition_by`` (untyped path) writes one folder per value, so filters on those columns
        prune files. ``bucket_by`` (number of buckets, column; untyped path) writes the rows hashed and sorted by
        that column, so that joins of tables bucketed alike need no shuffle. ``analyze`` records row count and size in the catalog (``ANALYZE TABLE``), so later
        plans over the table know its exact size. ``joined`` (untyped path): ``df`` and the sides are written as they
        are, and the version is a view of their left joins; a join whose keys repeat on both sides is kept in the
        size of its parts and has all its rows whenever it is read.
        """
        self.ensure_namespace(layer)
        target = self._next_version(layer, table)
        try:
            if joined is not None:
                self._write_join(target, df, joined, partition_by)
                return target
            if like is not None:
                self.spark.sql(f"CREATE TABLE {target} LIKE {like} USING parquet")
                _insert_by_name(self.spark, target, df)
            elif schema is None:
                rows = df.repartition(*bucket_by) if bucket_by else _spread(df, partition_by)  # one file a bucket
                writer = rows.write.format("parquet").options(**PARQUET_OPTIONS).mode("errorifexists")
                if bucket_by:
                    writer = writer.bucketBy(*bucket_by).sortBy(bucket_by[1])
                if partition_by:
                    writer = writer.partitionBy(*partition_by)
                writer.saveAsTable(target)
            else:
                self.spark.sql(table_ddl(target, schema, with_audit=with_audit, with_rejects=rejects))
                _insert_by_name(self.spark, target, df)
            if analyze:
                self.spark.sql(f"ANALYZE TABLE {target} COMPUTE STATISTICS")
        except Exception:
            self.drop_versions(layer, [target])
            raise
        return target

    def _write_join(self, target: str, df: DataFrame, joined: Joined, partition_by: tuple[str, ...]) -> None:
        def write(name: str, rows: DataFrame, folders: tuple[str, ...] = ()) -> str:
            part = f"{target[:-1]}_p_{name}`"
            writer = _spread(rows, folders).write.format("parquet").options(**PARQUET_OPTIONS).mode("errorifexists")
            (writer.partitionBy(*folders) if folders else writer).saveAsTable(part)
            return part

        source, owner = f"{write('rows', df, partition_by)} AS r", {c: "r" for c in df.columns}
        for i, (name, side, left, right) in enumerate(joined.sides):
            source += f" LEFT JOIN {write(name, side)} AS s{i} ON r.`{left}` = s{i}.`{right}`"
            owner |= {c: f"s{i}" for c in side.columns if c not in owner}
        columns = ", ".join(f"{owner[c]}.`{c}`" for c in joined.columns)
        self.spark.sql(f"CREATE VIEW {target} AS SELECT {columns} FROM {source}")

    def publish(self, layer: str, table: str, df: DataFrame, runs: Sequence[str] = (), **write) -> str:
        """``write_version``, then repoint the view ``layer.table``; on failure the view stays where it was."""
        target = self.write_version(layer, table, df, **write)
        columns = None
        if write.get("rejects"):
            columns = write["schema"].fieldNames()
            raw = ", ".join(f"`{c}`" for c in REJECT_COLUMNS)
            self.publish_view(layer, table + REJECTS,
                              f"SELECT {raw} FROM {target} WHERE `{REJECT_COLUMNS[0]}` IS NOT NULL")
        self._repoint(layer, table, target, columns, runs)
        generation = self.generation(layer)
        if table in generation:
            self._set_generation(layer, {**generation, table: target})
        self._drop_old(layer, table, target)
        return target

    def _repoint(self, layer: str, table: str, target: str, columns: Sequence[str] | None = None,
                 runs: Sequence[str] = ()) -> None:
        chosen = "*" if columns is None else ", ".join(f"`{c}`" for c in columns)
        self.publish_view(layer, table, f"SELECT {chosen} FROM {target}", runs)

    def _drop_old(self, layer: str, table: str, target: str) -> None:
        """Drop the versions beyond ``keep_versions``, each with the runs appended to it."""
        kept = [(n, t) for n, t in self._physical_versions(layer, table) if self.name(layer, t) != target]
        for _, old in kept[: max(0, len(kept) + 1 - self.keep_versions)]:
            self._drop_physical(layer, old)

    def publish_together(self, layer: str, targets: Mapping[str, str]) -> None:
        """Publish written versions (table name to version) as one generation.

        Views are repointed last of all, when every version is complete; if one of these statements fails, those
        before it are undone and the unpublished versions are dropped. The generation is named by one
        statement at the end, the moment from which ``read_together`` reads the new versions.
        """
        before = {t: self._view_text(layer, t) if self.exists(layer, t) else None for t in targets}
        done: list[str] = []
        try:
            for table, target in targets.items():
                done.append(table)
                self._repoint(layer, table, target)
            self._set_generation(layer, {**self.generation(layer), **targets})
        except Exception:
            for table in done:
                if before[table] is None:
                    self.drop_view(layer, table)
                else:
                    self.publish_view(layer, table, before[table])
            self.drop_versions(layer, targets.values())
            raise
        for table, target in targets.items():
            self._drop_old(layer, table, target)

    def drop_versions(self, layer: str, targets) -> None:
        """Drop written versions that were not published."""
        for target in targets:
            self._drop_physical(layer, target.split("`")[-2])

    def generation(self, layer: str) -> dict[str, str]:
        """Table name to version of the tables that were published together."""
        if not self.exists(layer, GENERATION):
            return {}
        return {r["table_name"]: r["version"] for r in self.read(layer, GENERATION).collect()}

    def _set_generation(self, layer: str, versions: Mapping[str, str]) -> None:
        if not versions:
            self.drop_view(layer, GENERATION)
            return
        rows = ", ".join(f"('{t}', '{v}')" for t, v in versions.items())
        self.publish_view(layer, GENERATION, f"SELECT * FROM VALUES {rows} AS g(table_name, version)")

    def publish_view(self, layer: str, view: str, select_sql: str, runs: Sequence[str] = ()) -> str:
        self.ensure_namespace(layer)
        ids = "\n".join(runs).replace("\\", "\\\\").replace("'", "\\'")
        noted = f" TBLPROPERTIES ('{_RUNS}' = '{ids}')" if runs else ""
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(layer, view)}{noted} AS {select_sql}")
        return self.name(layer, view)

    # ---- S10 ----
    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(f"{self.db(layer)}.{table}")

    def read_together(self, layer: str) -> dict[str, DataFrame]:
        """The tables of the layer's current generation, all of one publication."""
        return {t: self.spark.table(v) for t, v in self.generation(layer).items()}

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.db(layer)}.{table}")
