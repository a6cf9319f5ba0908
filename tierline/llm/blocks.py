"""Many narrow rows as one wide one: columns packed into a binary value per bucket.

A shuffle of tens of millions of small rows costs the JVM a row each. Here every task packs its rows of
one bucket into arrays, so the shuffle moves a few large rows and the task behind it works on arrays.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import mix64


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of every 64-bit key."""
    return (mix64(np.asarray(keys).view(np.uint64)) % np.uint64(buckets)).astype(np.int32)


def binary(data: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Rows ``data[cuts[i]:cuts[i + 1]]`` as binary values."""
    data = np.ascontiguousarray(data)
    width = data.itemsize * (data.shape[1] if data.ndim > 1 else 1)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1,
                                 [None, pa.py_buffer((cuts * width).astype(np.int32)), pa.py_buffer(data)])


TIGHT = ("doc_id", "word")  # columns that nearly ascend in a bucket: stored as differences, byte plane by byte plane


def squeezed(data: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """``binary`` of the differences within each row, first all lowest bytes, then all second ones: the high
    bytes are runs of zeros, which the shuffle's compression takes away."""
    width = data.itemsize
    delta = np.diff(data, prepend=data[:1] * 0)
    delta[cuts[:-1]] = data[cuts[:-1]]
    planes = np.empty((len(data), width), np.uint8)
    flat, raw = planes.reshape(-1), np.ascontiguousarray(delta).view(np.uint8).reshape(-1, width)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        flat[a * width:b * width] = raw[a:b].T.ravel()
    return binary(planes, cuts)


def unsqueezed(column: pa.Array, a: int, b: int, dtype) -> np.ndarray:
    """The elements of rows ``a`` to ``b`` of a squeezed column, end to end."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset + a:column.offset + b + 1].tolist()
    width, out = np.dtype(dtype).itemsize, [np.zeros(0, dtype)]
    for p, q in zip(at[:-1], at[1:]):
        if q > p:
            planes = np.frombuffer(data, np.uint8)[p:q].reshape(width, -1)
            out.append(np.cumsum(np.ascontiguousarray(planes.T).view(dtype).ravel(), dtype=dtype))
    return np.concatenate(out)


def column_values(batch: pa.RecordBatch, name: str, a: int, b: int, dtype) -> np.ndarray:
    """Rows ``a`` to ``b`` of a column that ``pack`` made."""
    return (unsqueezed if name in TIGHT else values)(batch[name], a, b, dtype)


def pack(bucket: np.ndarray, columns: dict[str, np.ndarray | None]) -> pa.RecordBatch:
    """One row a bucket with its part of every column; None gives empty values."""
    small = len(bucket) and int(bucket.max()) < 65536  # numpy sorts 16-bit keys by radix
    order = np.argsort(bucket.astype(np.uint16) if small else bucket, kind="stable")
    b = bucket[order]
    cuts = np.concatenate([np.flatnonzero(np.append(True, b[1:] != b[:-1])), [len(b)]]) if len(b) else np.zeros(1, int)
    arrays = [pa.array(b[cuts[:-1]], pa.int32())]
    for name, c in columns.items():
        if c is None:
            arrays.append(binary(np.zeros(0, np.uint8), np.zeros(len(cuts), int)))
        else:
            arrays.append((squeezed if name in TIGHT else binary)(c[order], cuts))
    return pa.RecordBatch.from_arrays(arrays, ["bucket", *columns])


def values(column: pa.Array, a: int, b: int, dtype) -> np.ndarray:
    """The elements of rows ``a`` to ``b`` of a binary column, end to end, as a copy."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset + a:column.offset + b + 1]
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw.copy().view(dtype)


def sizes(column: pa.Array, dtype) -> np.ndarray:
    """Number of elements of each row of a binary column."""
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return np.diff(at).astype(np.int64) // np.dtype(dtype).itemsize


def unpack(batches: Iterator[pa.RecordBatch], columns: dict[str, type]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Every bucket's columns, from packed rows in order of bucket."""
    held, now = [], None
    for batch in batches:
        b = np.asarray(batch["bucket"])
        if not len(b):
            continue
        cuts = [0, *(np.flatnonzero(b[1:] != b[:-1]) + 1).tolist(), len(b)]
        for s, e in zip(cuts[:-1], cuts[1:]):
            if held and b[s] != now:
                yield now, [np.concatenate(c) for c in zip(*held)]
                held = []
            now = int(b[s])
            held.append([column_values(batch, name, s, e, dtype) for name, dtype in columns.items()])
    if held:
        yield now, [np.concatenate(c) for c in zip(*held)]


def dealt(rows: DataFrame, parts: int, keys: Sequence[str] = ("bucket",)) -> DataFrame:
    """Packed rows dealt over ``parts`` tasks by bucket, in order of ``keys`` within a task."""
    return rows.repartitionById(parts, F.pmod(F.col("bucket"), F.lit(parts)).cast("int")).sortWithinPartitions(*keys)
