"""Mixing sources to target weights by capped water-filling, then seeded repetitions.

A source's target is ``w * t`` words for one water level ``t`` common to all sources, but at most
``max_epochs`` times its size; the level is raised until the targets share all words. Levels and
targets are exact fractions R / W of whole numbers: R the words left to the sources below their cap,
W those sources' weights. Only R and W reach the driver.

Repetitions: with e = target / size, every document of a source is taken floor(e) times, and the
documents first in a seeded order once more, until the rest of the target is met to the nearest
document. The order is by seeded hashes of id and text, then by row, so rows that share an id or are
equal are counted one by one. It is cut into ranges of bounded size with running sums over ranges, so that
a source with a third of all rows, or a row repeated that often, is many small groups.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import written
from tierline.operators.ranged import dense_key, ranged

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = 11
WORD = r"[^\x20\x09-\x0D]+"
RANGE_ROWS = 1 << 16

_SOURCE = ["no_source", "src"]


def _big(c):
    return F.col(c).cast("decimal(38,0)")


def water_level(sources: DataFrame, max_epochs: int) -> tuple[int, int]:
    """The level R / W over ``sources(size, weight)``: a source is capped if w * R > max_epochs * size * W."""
    total = int(sources.agg(F.sum("size")).first()[0] or 0)
    left, over = total, int(sources.agg(F.sum("weight")).first()[0] or 0)
    while over:
        capped = F.lit(max_epochs) * _big("size") * F.lit(over) < _big("weight") * F.lit(left)
        row = sources.agg(F.sum(F.when(capped, F.col("size"))), F.sum(F.when(~capped, F.col("weight")))).first()
        now = total - max_epochs * int(row[0] or 0), int(row[1] or 0)
        if now == (left, over):
            break
        left, over = now
    return left, over


def mixture(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
            seed: int = SEED, range_rows: int = RANGE_ROWS) -> DataFrame:
    """How many words the mix takes of each row of ``docs(doc_id, text, source)``.

    One row per input row: doc_id, size, source_size, target, taken, and row_key (a hash of the
    row's doc_id, source and text). A document's size is its number of words; a null text has 0.
    Sources in code-point order, null last, weigh ``weights`` in turn; a null source is a source of
    its own. A source without words has target 0. Rows that share an id are taken one by one, in the order of
    a hash of their text; of equal rows some may be taken once more than others. Texts of any length are read
    whole. Other columns are not read; an empty table gives an empty result; the same rows and seed
    give the same mix.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"),
                           F.md5(F.coalesce("text", F.lit("")).cast("binary"))).cast("binary"))
    rows = written(docs.select(
        "doc_id", F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("src"),
        size.alias("size"), order.alias("order"), F.xxhash64("doc_id", "source", "text").alias("row_key"),
        F.monotonically_increasing_id().alias("row")), "mix-rows")
    sources = written(dense_key(rows.groupBy(*_SOURCE).agg(F.sum("size").alias("size")), _SOURCE, "place")
                      .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)),
                                                         ((F.col("place") - 1) % len(weights) + 1).cast("int"))
                                  .cast("long")), "mix-sources")
    left, over = water_level(sources, max_epochs)
    wide = F.lit(over).cast("decimal(38,0)") * _big("size")  # W * size
    share = _big("weight") * F.lit(left)                     # w * R
    capped = (F.lit(max_epochs) * wide < share) | F.lit(over == 0)
    whole = F.when(capped, max_epochs).when(F.col("size") == 0, 0).otherwise(
        F.floor(share / F.when(wide > 0, wide)).cast("int"))
    plan = (sources.withColumn("whole", whole)
            .withColumn("target", F.when(capped, (F.lit(max_epochs) * F.col("size")).cast("double"))
                        .otherwise(share.cast("double") / F.lit(float(max(over, 1)))))
            # twice the words still to take, times W
            .withColumn("rest", F.when(capped | (F.col("size") == 0), F.lit(0).cast("decimal(38,0)"))
                        .otherwise(((share - F.col("whole") * wide) * 2).cast("decimal(38,0)")))
            .select(*_SOURCE, F.col("size").alias("source_size"), "whole", "target", "rest"))
    ranges = ranged(rows, [*_SOURCE, "order", "row"], (), max(1, math.ceil(rows.count() / range_rows)))
    ranges = ranges.withColumnRenamed("_tl_bucket", "range").withColumnRenamed("_tl_place", "place")
    words = ranges.groupBy(*_SOURCE, "range").agg(F.sum("size").alias("words"))
    before = F.coalesce(F.sum("words").over(Window.partitionBy(*_SOURCE).orderBy("range")
                                            .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    words = words.withColumn("below", before).drop("words").join(plan, _SOURCE)
    here = Window.partitionBy(*_SOURCE, "range").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    out = ranges.join(words, [*_SOURCE, "range"]).withColumn("ahead", F.col("below") + F.coalesce(F.sum("size").over(here), F.lit(0)))
    fits = _big("rest") >= (_big("ahead") * 2 + _big("size")) * F.lit(over)
    times = F.col("whole") + F.when(fits & (F.col("size") > 0) & (F.col("whole") < max_epochs), 1).otherwise(0)
    return out.select("doc_id", "size", "source_size", "target", (times * F.col("size")).cast("long").alias("taken"),
                      "row_key")


def mixed_documents(docs: DataFrame, **params) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it (rows not taken go).

    Rows are found by id, source and a hash of all three columns. Where only some of equal rows are taken once
    more (at most one group of equal rows a source), they are numbered and the first ones are. Rows without
    words go; texts of any length are read whole; an empty table stays empty.
    """
    key = F.xxhash64("doc_id", "source", "text")
    plan = written(mixture(docs, **params).filter("size > 0").groupBy("row_key").agg(
        F.min(F.col("taken") / F.col("size")).cast("int").alias("least"), F.count(F.lit(1)).alias("n"),
        F.sum(F.col("taken") / F.col("size")).cast("long").alias("all")), "mix-plan")
    plan = plan.withColumn("more", F.col("all") - F.col("n") * F.col("least"))
    names = dict(zip(("row_key", "least", "more"), ("_tl_row_key", "_tl_least", "_tl_more")))
    alike = plan.filter("more = 0 or n = 1").select(*[F.col(c).alias(x) for c, x in names.items()])
    apart = plan.filter("more > 0 and n > 1").select(*[F.col(c).alias(x) for c, x in names.items()])
    keyed = docs.withColumn("_tl_key", key)
    even = keyed.join(alike, F.col("_tl_key") == F.col("_tl_row_key")).withColumn(
        "_tl_times", F.col("_tl_least") + F.col("_tl_more"))
    some = keyed.join(F.broadcast(apart), F.col("_tl_key") == F.col("_tl_row_key"))
    some = written(some.withColumn("_tl_id", F.monotonically_increasing_id()), "mix-equal")
    numbered = dense_key(some.select("_tl_key", "_tl_id"), ["_tl_key", "_tl_id"], "_tl_no")
    first = numbered.groupBy("_tl_key").agg(F.min("_tl_no").alias("_tl_first"))
    numbered = numbered.join(F.broadcast(first), "_tl_key").select("_tl_id", (F.col("_tl_no") - F.col("_tl_first")).alias("_tl_no"))
    some = some.join(numbered, "_tl_id").withColumn(
        "_tl_times", F.col("_tl_least") + F.when(F.col("_tl_no") < F.col("_tl_more"), 1).otherwise(0))
    columns = [*docs.columns, "_tl_times"]
    taken = even.select(*columns).unionByName(some.select(*columns)).filter("_tl_times > 0")
    return taken.withColumn("_tl_copy", F.explode(F.sequence(F.lit(1), F.col("_tl_times").cast("int")))).select(*docs.columns)


def mixture_sql(weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> str:
    """The same rows (without row_key) as DuckDB SQL. Sorted by size / weight, the capped sources are a
    prefix; the level is that of the first prefix whose next source stays within its cap."""
    assert all(6 % w == 0 for w in weights)
    weight = "CASE (place - 1) % " + str(len(weights)) + "".join(
        f" WHEN {i} THEN {w}" for i, w in enumerate(weights)) + " END"
    return f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::HUGEINT AS size,
                  md5('{seed}:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS ord FROM documents),
s AS (SELECT source, sum(size)::HUGEINT AS size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM d GROUP BY source),
w AS (SELECT *, ({weight})::HUGEINT AS weight FROM s),
r AS (SELECT *, row_number() OVER (ORDER BY size * (6 // weight), place) AS k FROM w),
l AS (SELECT *, (SELECT sum(size) FROM w)
              - {max_epochs} * coalesce(sum(size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft,
              sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ovr FROM r),
f AS (SELECT k, lft::HUGEINT AS lft, ovr::HUGEINT AS ovr FROM l WHERE weight * lft <= {max_epochs} * size * ovr ORDER BY k LIMIT 1),
p AS (SELECT w.source, w.size AS source_size, w.weight * f.lft AS share, f.ovr AS ovr,
             {max_epochs} * w.size * f.ovr < w.weight * f.lft AS capped FROM w, f),
q AS (SELECT *, CASE WHEN capped THEN {max_epochs} WHEN source_size = 0 THEN 0 ELSE share // (ovr * source_size) END AS whole FROM p),
t AS (SELECT d.doc_id, d.size, q.*, coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.ord
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size,
       CASE WHEN capped THEN ({max_epochs} * source_size)::DOUBLE ELSE share::DOUBLE / ovr::DOUBLE END AS target,
       (size * (whole + CASE WHEN NOT capped AND source_size > 0 AND size > 0 AND whole < {max_epochs}
                              AND 2 * (share - whole * ovr * source_size) >= (2 * ahead + size) * ovr
                             THEN 1 ELSE 0 END))::BIGINT AS taken
FROM t"""
