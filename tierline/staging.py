"""Written intermediate tables: computed once, reread by every later step, with exact sizes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.session import run_concurrently, scratch_path

_WIDTH = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4}


@dataclass(frozen=True)
class Stats:
    """Exact rows, and bytes of the values (strings by their length)."""
    rows: int
    bytes: int


@dataclass(frozen=True)
class Staged:
    df: DataFrame
    stats: Stats


def _bytes_of(field: T.StructField) -> Column:
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.octet_length(F.col(f"`{field.name}`")).cast("long") + 8
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.octet_length(F.to_json(F.struct(F.col(f"`{field.name}`")))).cast("long") + 8
    return F.lit(_WIDTH.get(type(field.dataType), 16 if isinstance(field.dataType, T.DecimalType) else 8)).cast("long")


def _size(df: DataFrame) -> list[Column]:
    width = F.lit(8).cast("long")
    for f in df.schema.fields:
        width = width + F.coalesce(_bytes_of(f), F.lit(8).cast("long"))
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).cast("long").alias("bytes")]


def measure(df: DataFrame) -> Stats:
    """Rows and bytes of ``df`` by one aggregate (a row a task crosses the network)."""
    row = df.agg(*_size(df)).first()
    return Stats(int(row["rows"]), int(row["bytes"]))


def measure_all(frames: Sequence[DataFrame]) -> list[Stats]:
    """``measure`` of independent frames, run concurrently."""
    out: list[Stats | None] = [None] * len(frames)

    def step(i: int):
        def run() -> None:
            out[i] = measure(frames[i])
        return run

    run_concurrently([step(i) for i in range(len(frames))])
    return out


def stage(df: DataFrame, name: str) -> Staged:
    """Write ``df`` to a fresh folder below ``spark.checkpoint.dir`` and read it back, with its size
    measured on the written rows."""
    path = scratch_path(df.sparkSession, f"stage-{name}")
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    return Staged(back, measure(back))
