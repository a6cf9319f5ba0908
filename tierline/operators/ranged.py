"""Range buckets: global ordering work without a single-partition window.

``row_number() over (order by k)`` and ``lead(v) over (partition by g order by k)`` put a whole
table (or a whole group) into one task. Here Spark's range partitioning cuts the total order into
contiguous ranges of about ``rows_per_bucket`` rows, however many that takes:

1. ``repartitionByRange`` on the order columns, sorted inside each partition, and every row tagged
   with its partition (the bucket) and its place in it;
2. the tagged rows are written once below ``spark.checkpoint.dir``, so buckets and places are fixed
   and a lost task is recomputed from files;
3. buckets are stitched by a table of one row per bucket (row offsets) for keys; for ``lead`` each run of
   rows borrows the first row of the next one, found level by level over runs, buckets and blocks of
   buckets, so nothing is broadcast and no task holds more than ``FAN`` heads. No cut points pass the
   driver and no literals enter the plan.

Range columns must be (nearly) unique, otherwise one value that holds many rows stays in one bucket.
Ordering is ascending with NULLs first, like Spark's default and the source system's.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.session import scratch_path

ROWS_PER_BUCKET = 2_000_000

RUNS_PER_BUCKET = 32
# Heads of buckets (then of blocks of buckets, and so on) that one task orders.
FAN = 1024

_ID, _BUCKET, _PLACE, _RUN = "_tl_id", "_tl_bucket", "_tl_place", "_tl_run"
_PLACE_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def bucket_count(n_rows: int, rows_per_bucket: int | None = None) -> int:
    """Buckets of at most about ``rows_per_bucket`` rows; grows with the rows, without a cap."""
    return max(1, math.ceil(n_rows / (rows_per_bucket or ROWS_PER_BUCKET)))


def ranged(df: DataFrame, range_cols: Sequence[str], tie_cols: Sequence[str], n_buckets: int) -> DataFrame:
    """``df`` written in order of ``range_cols`` then ``tie_cols`` with ``_tl_bucket`` and ``_tl_place``
    (from 0). Only ``range_cols`` are sampled for the cuts; ``tie_cols`` order rows in a bucket."""
    keys = [F.col(c).asc_nulls_first() for c in range_cols]
    ties = [F.col(c).asc_nulls_first() for c in tie_cols]
    spark = df.sparkSession
    path = scratch_path(spark, "ranged")
    placed = (df.repartitionByRange(n_buckets, *keys).sortWithinPartitions(*keys, *ties)
              .withColumn(_ID, F.monotonically_increasing_id()))
    placed.write.parquet(path)
    back = spark.read.schema(placed.schema).parquet(path)
    return back.select(*df.columns, F.shiftright(_ID, _PLACE_BITS).alias(_BUCKET),
                       F.col(_ID).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).alias(_PLACE))


def dense_key(df: DataFrame, order_cols: Sequence[str], key_name: str, rows_per_bucket: int | None = None,
              n_rows: int | None = None, tie_cols: Sequence[str] = ()) -> DataFrame:
    """``row_number() over (order by order_cols, tie_cols)`` as a BIGINT column, without one global task.

    One shuffle of the rows. A bucket's offset is the number of rows in the buckets before it, from
    counts that combine before the shuffle; the offsets, one row per bucket, are broadcast (a few
    bytes for every ``rows_per_bucket`` rows). ``n_rows`` is the exact row count when the caller
    already has it (otherwise counted here).
    """
    n_rows = df.count() if n_rows is None else n_rows
    n_buckets = bucket_count(n_rows, rows_per_bucket)
    if n_buckets == 1:  # the whole table is one bucket
        order = [F.col(c).asc_nulls_first() for c in (*order_cols, *tie_cols)]
        return df.withColumn(key_name, F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    placed = ranged(df, order_cols, tie_cols, n_buckets)
    sizes = placed.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("_tl_n"))
    before = Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(_BUCKET, F.coalesce(F.sum("_tl_n").over(before), F.lit(0)).alias("_tl_offset"))
    return (placed.join(F.broadcast(offsets), _BUCKET)
            .withColumn(key_name, (F.col("_tl_offset") + F.col(_PLACE) + 1).cast("bigint"))
            .select(*df.columns, key_name))


def _next_heads(heads: DataFrame, n: int, fan: int) -> DataFrame:
    """``(at, next)`` for ``heads(at, head)``: the head that follows in order of ``at`` (0..n-1, with gaps).

    Heads are ordered in blocks of ``fan`` places; only the last head of a block looks further, to the
    first head of the next block, which is the same question one level up.
    """
    if n <= fan:
        return heads.select("at", F.lead("head").over(Window.orderBy("at")).alias("next"))
    block = F.floor(F.col("at") / fan)
    inner = heads.withColumn("block", block).withColumn("next", F.lead("head").over(Window.partitionBy("block").orderBy("at")))
    firsts = heads.groupBy(block.alias("at")).agg(F.min_by("head", "at").alias("head"))
    above = _next_heads(firsts, math.ceil(n / fan), fan).select(F.col("at").alias("block"), F.col("next").alias("_tl_after"))
    return inner.join(above, "block", "left").select("at", F.coalesce("next", "_tl_after").alias("next"))


def lead_in_group(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                  value_col: str, out_col: str, rows_per_bucket: int | None = None,
                  n_rows: int | None = None, fan: int | None = None) -> DataFrame:
    """``lead(value_col) over (partition by group_cols order by order_cols)`` without hot groups.

    Ranges are cut on ``group_cols + order_cols``, so a group that holds a third of all rows is
    spread over a third of the buckets, and each bucket into runs of its rows. Inside a (run, group) the
    window gives the next row. A group can only continue into the next run at that run's first row, so
    every run takes along a copy of the row that heads the next run, behind its own rows; the window then
    reads it where the group continues, and the copies go. Heads (one row per ``rows_per_bucket / 32`` rows)
    find their successors in ordered blocks of at most ``fan`` (``_next_heads``); none are broadcast.
    ``n_rows`` as in ``dense_key``.
    """
    full = list(group_cols) + list(order_cols)
    n_rows = df.count() if n_rows is None else n_rows
    n_buckets = bucket_count(n_rows, rows_per_bucket)
    order = [F.col(c).asc_nulls_first() for c in order_cols]
    if n_buckets == 1:
        w = Window.partitionBy(*group_cols).orderBy(*order)
        return df.withColumn(out_col, F.lead(value_col).over(w))
    # Runs of a bucket's rows: small enough that hashing them to tasks comes out even.
    size = max(1, math.ceil((rows_per_bucket or ROWS_PER_BUCKET) / RUNS_PER_BUCKET))
    placed = ranged(df, full, (), n_buckets).withColumn(_RUN, F.floor(F.col(_PLACE) / size))
    taken = list(dict.fromkeys([*group_cols, value_col]))
    heads = placed.filter(F.col(_PLACE) % size == 0).select(_BUCKET, _RUN, F.struct(*taken).alias("head"))
    firsts = heads.filter(F.col(_RUN) == 0).select(F.col(_BUCKET).alias("at"), "head")
    after = _next_heads(firsts, n_buckets, fan or FAN).select(F.col("at").alias(_BUCKET), "next")
    inside = F.lead("head").over(Window.partitionBy(_BUCKET).orderBy(_RUN))
    borrowed = (heads.withColumn("_tl_inside", inside).join(after, _BUCKET)
                .select(_BUCKET, _RUN, F.coalesce("_tl_inside", "next").alias("head")).filter("head IS NOT NULL")
                .select("head.*", _BUCKET, _RUN, F.lit(None).cast("bigint").alias(_PLACE)))
    rows = placed.unionByName(borrowed, allowMissingColumns=True)
    w = Window.partitionBy(_BUCKET, _RUN, *group_cols).orderBy(F.col(_PLACE).asc_nulls_last())
    return (rows.withColumn(out_col, F.lead(value_col).over(w)).filter(F.col(_PLACE).isNotNull())
            .select(*df.columns, out_col))
