"""Session helpers: a local session for tests and benchmarks, and the shared scratch folder."""

from __future__ import annotations

import atexit
import math
import os
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tierline") -> SparkSession:
    """Local session with AQE on and the UI off. On a cluster use the cluster's session instead."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.default.parallelism", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TIERLINE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(master: str | None) -> bool:
    """``local`` and ``local[n]`` run in one process and share its disk; all else is a cluster
    (``local-cluster`` too: its executors are processes of their own)."""
    return master is None or master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Job outputs that must outlive a task (lineage cuts, scratch tables of a run) go here, never to
    a machine-local folder. When the setting is absent, a local session (one process) gets a fresh
    folder; on a cluster this raises, because executors would write to their own disks.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    try:
        sc = spark.sparkContext
    except Exception:  # a remote session without a local SparkContext
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share") from None
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return str(current.get()).rstrip("/")
    if not is_local(sc.master):
        raise RuntimeError(f"spark.checkpoint.dir is not set and the master is {sc.master}: "
                           "name a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tierline-ckpt-"))
    return str(sc._jsc.sc().getCheckpointDir().get()).rstrip("/")


# Scratch of this process, by application: folders and database prefixes to remove.
_scratch: dict[str, list[tuple[str, str]]] = {}


def register_scratch(spark: SparkSession, kind: str, name: str) -> None:
    """Remember a scratch ``path`` or ``database`` for ``remove_scratch``."""
    app = spark.sparkContext.applicationId
    if app not in _scratch:
        _scratch[app] = []
        atexit.register(_remove_at_exit, spark, app)
    _scratch[app].append((kind, name))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared folder, for one run."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    register_scratch(spark, "path", path)
    return path


def remove_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders and databases this process made in this application; call it when no
    frame that reads them is needed any more. It also runs when the process ends. Returns how many."""
    items = _scratch.pop(spark.sparkContext.applicationId, [])
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for kind, name in items:
        if kind == "database":
            spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")
    for kind, name in items:
        if kind == "path":
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)
    return len(items)


def _remove_at_exit(spark: SparkSession, app: str) -> None:
    try:
        if app in _scratch and spark.sparkContext.applicationId == app:
            remove_scratch(spark)
    except Exception:  # the session is gone already; nothing left to ask
        pass


# Target bytes per task for scans and shuffles: small enough to sort and hash in executor memory
# without heavy spilling, large enough that task overhead stays small.
TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def scale_conf(input_bytes: int, target_partition_bytes: int = TARGET_PARTITION_BYTES,
               min_partitions: int = 200) -> dict[str, str]:
    """Runtime settings sized to the input volume: shuffle partitions of about
    ``target_partition_bytes`` (AQE coalesces small ones and splits skewed join partitions),
    scan splits of the same size."""
    parts = max(min_partitions, math.ceil(input_bytes / target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
    }


def apply_scale_conf(spark: SparkSession, input_bytes: int, saved: dict[str, str | None] | None = None,
                     **kwargs) -> dict[str, str]:
    """Set ``scale_conf``'s settings; ``saved`` receives the values before."""
    conf = scale_conf(input_bytes, **kwargs)
    for key, value in conf.items():
        if saved is not None:
            saved[key] = spark.conf.get(key, None)
        spark.conf.set(key, value)
    return conf


# Files of the warehouse's tables: smaller than Spark's default (snappy).
PARQUET_OPTIONS = {"compression": "zstd"}

# Text that a byte of a packed extract stands for, about.
GZIP_RATIO = 4


def path_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under ``path`` (any Hadoop file system), 0 if it does not exist; files packed
    with gzip count as the text they hold, estimated."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return 0
    total, files = 0, fs.listFiles(hpath, True)
    while files.hasNext():
        f = files.next()
        total += int(f.getLen()) * (GZIP_RATIO if f.getPath().getName().endswith(".gz") else 1)
    return total


def shuffle_partitions(spark: SparkSession, default: int = 200) -> int:
    """``spark.sql.shuffle.partitions`` as a number (some deployments allow a non-numeric value
    such as ``auto``; then the default parallelism, else ``default``)."""
    value = spark.conf.get("spark.sql.shuffle.partitions", str(default))
    try:
        return int(value)
    except ValueError:
        try:
            return int(spark.sparkContext.defaultParallelism)
        except Exception:  # no local SparkContext
            return default


def run_concurrently(steps: list[Callable[[], None]], max_workers: int = 6) -> None:
    """Submit independent table jobs from driver threads (each job is still distributed), wait
    for all of them, then raise the first failure. Tables of one layer do not depend on each
    other, so small tables no longer wait for big ones and the cluster stays busy."""
    if max_workers <= 1 or len(steps) <= 1:
        for step in steps:
            step()
        return
    with ThreadPoolExecutor(max_workers=min(max_workers, len(steps))) as pool:
        futures = [pool.submit(step) for step in steps]
    errors = [f.exception() for f in futures if f.exception() is not None]
    if errors:
        raise errors[0]
