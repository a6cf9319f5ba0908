"""Shared pieces of the operators: written intermediate tables, Arrow text buffers, hot-key joins."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.session import scratch_path

# At most this many keys can hold 1/HOT_KEYS of the rows each, so a broadcast of them is bounded.
HOT_KEYS = 256

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. A text of single-byte characters takes the fast built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _LOWER))


def fold(doc_id: Column, parts: int) -> Column:
    """``crc32(doc_id as text) mod parts``; a null id counts as 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % F.lit(parts), F.lit(0))


_shipped: set[str] = set()
# Arrow batches to and from the Python workers: each is held by the JVM and by the worker.
BATCH_BYTES = 16 << 20


def bound_batches(spark: SparkSession, limit: int) -> None:
    """Keep the session's Arrow batches within ``limit`` bytes unless it has a setting of its own."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, f"{limit}b")


def freeing(batches: Iterator) -> Iterator:
    """``batches``; when a task has had them all, its worker gives back to the machine what is free. Workers
    stay for later tasks, and their executor needs the memory meanwhile."""
    yield from batches
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers (``addPyFile``), once an application, and keep the
    session's Arrow batches within ``BATCH_BYTES`` unless it has a setting of its own."""
    sc = spark.sparkContext
    bound_batches(spark, BATCH_BYTES)
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(prefix="tierline-"), "tierline_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(top, "tierline")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, top))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the job inside are deleted when it ends: its result is already written."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def written(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once to a fresh Parquet folder below ``spark.checkpoint.dir`` and read it back.

    This cuts the lineage: later jobs read files that every executor sees, so a lost executor
    costs only its own running tasks.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with _shuffles_dropped(spark):
        writer = df.write.option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_spread(left: DataFrame, right: DataFrame, keys: Sequence[str], weight: str, total: int,
                how: str = "inner") -> DataFrame:
    """Join ``left`` with ``right`` (one row a key; ``weight`` = how many left rows the key has).

    Keys that hold more than 1/256 of ``total`` go by broadcast, at most 256 rows by construction,
    so a key with a third of all rows is never shuffled to one task; the others go by a plain
    sort-merge join, at every size. ``how`` is ``inner`` or ``left``; ``weight`` is dropped.
    """
    limit = max(total // HOT_KEYS, 1)
    keys = list(keys)
    hot = F.broadcast(right.filter(F.col(weight) > limit).drop(weight))
    rest = right.filter(F.col(weight) <= limit).drop(weight).hint("merge")
    a = left.join(hot, keys, "inner")
    b = left.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(rest, keys, how)
    return a.unionByName(b)


def block_units(rows: DataFrame, group: str, own: str, weight: Column, limit: int) -> DataFrame:
    """Cut the pairs to compare in each group into units of bounded size.

    Every own row of a group must meet every other row of it, own or not; rows that are not own need
    not meet each other. Both kinds are cut by a hash of ``rep`` into blocks of about ``limit`` weight,
    and each row is sent once to every pair of blocks it takes part in: columns ``kind``, ``i``,
    ``j`` name the unit with ``group``, ``left`` its side (a unit without right rows compares its
    left rows with each other). Groups without own rows vanish.
    """
    parts = rows.groupBy(group).agg(
        F.greatest(F.lit(1), F.ceil(F.sum(F.when(F.col(own), weight)) / limit)).cast("int").alias("_no"),
        F.coalesce(F.ceil(F.sum(F.when(~F.col(own), weight)) / limit), F.lit(0)).cast("int").alias("_nv"),
        F.count_if(own).alias("_own"), F.count(F.lit(1)).alias("_rows"))
    cut = join_spread(rows, parts.filter("_own > 0").drop("_own"), [group], "_rows", max(rows.count(), 1))
    part = F.pmod(F.xxhash64("rep"), F.when(F.col(own), F.col("_no")).otherwise(F.greatest("_nv", F.lit(1))))
    cut = cut.withColumn("_part", part.cast("int"))

    def units(first, last, kind: int, mine_first: bool, left: bool):
        part, none = F.col("_part"), F.array().cast("array<int>")
        return F.transform(F.when(first <= last, F.sequence(first, last)).otherwise(none), lambda o: F.struct(
            F.lit(kind).alias("kind"), (part if mine_first else o).alias("i"), (o if mine_first else part).alias("j"),
            F.lit(left).alias("left")))

    zero = F.lit(0)
    mine = F.concat(units(F.col("_part"), F.col("_no") - 1, 0, True, True),  # block i with j >= i
                    units(zero, F.col("_part") - 1, 0, False, False),        # as block j with i < j
                    units(zero, F.col("_nv") - 1, 1, True, True))            # with every block of the others
    sent = cut.withColumn("_u", F.explode(F.when(F.col(own), mine).otherwise(
        units(zero, F.col("_no") - 1, 1, False, False))))
    return sent.select(*rows.columns, "_u.kind", "_u.i", "_u.j", "_u.left")


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each node's group, for links a-b among nodes 0..n-1."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts end to end and their n+1 offsets; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string())
    if texts.null_count:
        texts = texts.fill_null("")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1]
    offsets = offsets.astype(np.int64)
    flat = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return flat, offsets - offsets[0]


def pieces(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents of about ``limit`` bytes each (one longer document stands alone)."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, min(b, n)
        a = b


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of every range, end to end."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit."""
    x = np.array(x, np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
