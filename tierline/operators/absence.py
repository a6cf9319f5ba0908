"""Rows whose keys are absent elsewhere, found in one scan by Bloom filters and exact for the rest.

The keys are hashed into a bit array of fixed size, whose words are combined by ``bit_or`` before the
shuffle, so a task sends each word once however many keys it has. The array reaches every task as a
scalar subquery. A row whose key misses a bit is absent for certain: it needs no shuffle.
Of the other rows only the distinct keys are looked up, combined before the shuffle, so a key with a
third of all rows is one row a task. The few that passed the filter by chance come back and mark
their rows. However full the filter gets, the result is exact: it only decides how many keys are looked up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.operators.joins import BROADCAST_MAX_ROWS, fits_broadcast, lookup_join
from tierline.staging import stage

# Bits of a filter: one megabyte. Three probes let about 1% pass by chance at a million keys.
FILTER_BITS = 1 << 23
PROBES = 3


def _bits(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits)) for i in range(PROBES)]


def filter_words(keys: DataFrame, column: str, bits: int = FILTER_BITS) -> DataFrame:
    """One row ``words``: the Bloom filter of ``keys``' column as an array of ``bits / 64`` longs."""
    bit = F.explode(F.array(*_bits(F.col(column), bits)))
    words = (keys.filter(F.col(column).isNotNull()).select(bit.alias("bit"))
             .groupBy(F.shiftright("bit", 6).cast("int").alias("at"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit").bitwiseAND(F.lit(63)).cast("int"))).alias("word")))
    places = keys.sparkSession.range(bits // 64).select(F.col("id").cast("int").alias("at"))
    dense = places.join(words, "at", "left").select("at", F.coalesce("word", F.lit(0)).alias("word"))
    return dense.agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("w")).select(F.col("w.word").alias("words"))


def may_contain(words: Column, key: Column, bits: int = FILTER_BITS) -> Column:
    """False where ``key`` is certainly not among the filter's keys (NULL for a NULL key)."""
    out = key.isNotNull()
    for bit in _bits(key, bits):
        word = F.get(words, F.shiftright(bit, 6).cast("int"))
        mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit.bitwiseAND(F.lit(63)).cast("int"))
        out = out & (word.bitwiseAND(mask) != 0)
    return F.when(key.isNotNull(), out)


def absent_rows(left: DataFrame, checks: Sequence[tuple[str, DataFrame, str]], bits: int = FILTER_BITS) -> DataFrame:
    """Rows of ``left`` for which any (column, keys, key column) of ``checks`` finds no key; a NULL finds none.

    ``keys`` may repeat keys or hold NULLs. Each row comes once. ``left`` is scanned twice, whatever the number of
    checks: for the distinct keys that pass the filters, and for the rows.
    """
    words = [stage(filter_words(keys, c, bits), "key-filter").df.scalar() for _, keys, c in checks]
    names = [f"_tl_key{i}" for i in range(len(checks))]
    found = [F.coalesce(may_contain(w, F.col(column), bits), F.lit(False)) for (column, _, _), w in zip(checks, words)]
    certain = F.lit(False)
    for f in found:
        certain = certain | ~f
    flagged = left.withColumn("_tl_absent", certain)
    # One scan asks for the keys of all checks: a row per key, NULL in the other checks' places.
    empty = [F.lit(None).cast(left.schema[column].dataType) for column, _, _ in checks]
    places = [F.struct(F.lit(i).alias("_tl_check"), *[(F.col(checks[i][0]) if j == i else empty[j]).alias(n)
                                                      for j, n in enumerate(names)]) for i in range(len(checks))]
    asked = stage(flagged.filter("NOT _tl_absent").select(F.explode(F.array(*places)).alias("k")).select("k.*").distinct(),
                  "asked-keys").df
    late = []
    for i, (_, keys, c) in enumerate(checks):
        # both sides are distinct: no key is hot here
        mine = asked.filter(F.col("_tl_check") == i).select(names[i])
        known = keys.select(F.col(c).alias("_tl_known")).distinct()
        late.append(stage(mine.join(known, F.col(names[i]) == F.col("_tl_known"), "left_anti"), "late-keys"))
    marks = [(column, n, chance) for (column, _, _), n, chance in zip(checks, names, late) if chance.stats.rows]

    def marked(rows: DataFrame) -> tuple[DataFrame, Column]:
        any_late = F.lit(False)
        for column, n, chance in marks:
            rows = lookup_join(rows, chance.df, [(column, n)], stats=chance.stats)
            any_late = any_late | F.col(n).isNotNull()
        return rows, any_late

    if all(fits_broadcast(chance.stats) for _, _, chance in marks):
        rows, any_late = marked(flagged)
        return rows.filter(F.col("_tl_absent") | any_late).select(*left.columns)
    # Too many for a broadcast: certain rows are spared the shuffle.
    rows, any_late = marked(flagged.filter("NOT _tl_absent"))
    return flagged.filter("_tl_absent").select(*left.columns).unionByName(rows.filter(any_late).select(*left.columns))


def not_in(left: DataFrame, left_col: str, right: DataFrame, right_col: str, max_rows: int = BROADCAST_MAX_ROWS,
           salted: bool = False) -> DataFrame:
    """Rows of ``left`` where ``left_col NOT IN (SELECT right_col FROM right)``, SQL semantics: an empty
    subquery keeps every row, a NULL in it keeps none, otherwise the rows without a key in it stay.

    The subquery is evaluated once: its distinct keys are written with their size. Bounded keys are broadcast
    for an anti join; more keys go by ``absent_rows``, or with ``salted`` by a salted anti join of all rows.
    (Spark alone would plan a nested-loop join once the subquery is too large to broadcast.)
    """
    keys = stage(right.select(F.col(right_col).alias("_tl_key")).distinct(), "not-in-keys")
    if keys.stats.rows == 0:
        return left
    if not keys.df.filter(F.col("_tl_key").isNull()).isEmpty():
        return left.filter(F.lit(False))
    rows = left.filter(F.col(left_col).isNotNull())
    if salted or fits_broadcast(keys.stats, max_rows):
        return lookup_join(rows, keys.df, [(left_col, "_tl_key")], "left_anti", max_rows=max_rows, stats=keys.stats)
    return absent_rows(rows, [(left_col, keys.df, "_tl_key")])
