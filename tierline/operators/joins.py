"""Joins that hold up under skew: checked broadcasts and salted shuffle joins.

* A side is broadcast only when its measured rows and bytes are within the bounds.
* Otherwise the join shuffles on (key, salt). Keys that hold more than half a shuffle partition's
  fair share of the big side's rows (exact counts; at most two per partition) get their big-side rows
  spread over salts in proportion to their count, and their small-side rows copied once per salt of
  that key. NULL keys, which never match, are spread the same way. The salt is a row number, so equal
  rows get different salts. Every row is kept; nothing is sampled away.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.session import shuffle_partitions
from tierline.staging import Stats, measure, stage

BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 256 * 1024 * 1024
SALTS_PER_PARTITION = 8
ROW_ID = "_tl_row"

_SALT = "_tl_salt"


def fits_broadcast(stats: Stats, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    return stats.rows <= max_rows and stats.bytes <= max_bytes


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                      max_bytes: int = BROADCAST_MAX_BYTES, stats: Stats | None = None) -> DataFrame | None:
    """``broadcast(df)`` if it has at most ``max_rows`` rows and ``max_bytes`` measured bytes, else
    None. ``stats``: its size when the caller already has it."""
    return F.broadcast(df) if fits_broadcast(stats or measure(df), max_rows, max_bytes) else None


def with_row_id(df: DataFrame, fixed_order: bool = False) -> DataFrame:
    """``df`` with a row number in ``ROW_ID`` (unique, increasing inside a task's rows).

    A recomputed task must give its rows the same numbers. ``fixed_order`` says that it does: the rows come
    from a scan by projections, filters and broadcast joins alone. All others are written and reread first.
    """
    rows = df if fixed_order else stage(df, "rows").df
    return rows.withColumn(ROW_ID, F.monotonically_increasing_id())


def hot_keys(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Non-null key values that hold more than half of a shuffle partition's fair share of the rows,
    with their number of salts (``_tl_n``).

    Exact counts, combined before the shuffle. At most ``2 * partitions`` keys can qualify, so the
    result is bounded by that; it is brought back once as a small local frame, so every later use
    sees the same set.
    """
    spark = df.sparkSession
    partitions = partitions or shuffle_partitions(spark)
    counts = stage(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_tl_c")), "key-counts").df
    total = int(counts.agg(F.sum("_tl_c")).first()[0] or 0)
    share = max(total / partitions, 1.0)
    hot = counts.dropna(subset=list(keys)).filter(F.col("_tl_c") > F.lit(max(share / 2, 1.0)))
    salts = F.ceil(F.col("_tl_c") * F.lit(SALTS_PER_PARTITION / share)).cast("int")
    hot = hot.select(*keys, F.greatest(F.lit(1), salts).alias("_tl_n"))
    return spark.createDataFrame(hot.collect(), schema=hot.schema)


def _on(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    cond = None
    for lk, rk in pairs:
        e = left[lk] == right[rk]
        cond = e if cond is None else cond & e
    return cond


def salted_join(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], how: str = "left",
                hot: DataFrame | None = None, fixed_order: bool = False) -> DataFrame:
    """Shuffle join of ``left`` (big, maybe skewed) with ``right`` on ``pairs`` (left, right keys).

    ``how`` is ``left``, ``inner`` or ``left_anti``. Output columns: ``left``'s then ``right``'s
    (right-side names must not repeat left-side names). ``hot`` (keys and ``_tl_n`` salts each)
    overrides the counted hot keys. ``left`` may bring a ``ROW_ID`` of its base rows; it stays, otherwise
    its rows are numbered here (``fixed_order`` as in ``with_row_id``).
    """
    lkeys = [lk for lk, _ in pairs]
    rkeys = [rk for _, rk in pairs]
    if hot is None:
        hot = hot_keys(left, lkeys)
    columns = left.columns
    if ROW_ID not in columns:
        left = with_row_id(left, fixed_order)
    any_null = F.lit(False)
    for k in lkeys:
        any_null = any_null | F.col(k).isNull()
    null_salts = F.lit(SALTS_PER_PARTITION * shuffle_partitions(left.sparkSession))
    tagged = left.join(F.broadcast(hot.select(*lkeys, "_tl_n")), on=lkeys, how="left")
    row = F.xxhash64(F.col(ROW_ID))
    salt = (F.when(F.col("_tl_n").isNotNull(), F.pmod(row, F.col("_tl_n")))
            .when(any_null, F.pmod(row, null_salts)).otherwise(F.lit(0)).cast("int"))
    salted_left = tagged.select(*columns, salt.alias(_SALT))

    hot_r = hot.select(*[F.col(lk).alias(rk) for lk, rk in pairs], "_tl_n")
    rtag = right.join(F.broadcast(hot_r), on=rkeys, how="left").select(*right.columns, "_tl_n")
    salted_right = rtag.withColumn(
        "_tl_rsalt", F.explode(F.when(F.col("_tl_n").isNotNull(), F.sequence(F.lit(0), F.col("_tl_n") - 1))
                               .otherwise(F.array(F.lit(0))))).drop("_tl_n")

    cond = _on(salted_left, salted_right, pairs) & (salted_left[_SALT] == salted_right["_tl_rsalt"])
    return salted_left.join(salted_right.hint("merge"), cond, how).drop(_SALT, "_tl_rsalt")


def lookup_join(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], how: str = "left",
                max_rows: int = BROADCAST_MAX_ROWS, stats: Stats | None = None,
                hot: DataFrame | None = None) -> DataFrame:
    """Join a big ``left`` to a lookup ``right``: broadcast when ``right`` is checked small,
    salted shuffle join otherwise. ``stats``: size of ``right`` if known."""
    small = checked_broadcast(right, max_rows=max_rows, stats=stats)
    if small is not None:
        return left.join(small, _on(left, right, pairs), how)
    return salted_join(left, right, pairs, how, hot=hot)
