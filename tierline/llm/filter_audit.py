"""Interaction audit of five text filters: step counts of every order, and exact Shapley values.

One pass over the texts gives every document the set of filters it fails, as five bits. A part (a
source) is then described by at most 32 counts, from which v(S), the documents that the coalition S
of filters removes together, is tabulated for all 32 coalitions. Each figure of a step is a
difference of coalitions: the filter f after the filters P removes v(P + f) - v(P).

The Shapley value is the solution of a constrained least-squares problem: the additive game whose
values fit v best, each coalition weighted by the Shapley kernel, with the values summing to v(all).
Its normal equations are solved in rationals, once for all right-hand sides: the solution is linear
in v, so 120 times it is a table of whole numbers that a plain expression applies to every part.
"""

from __future__ import annotations

import json
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import written

FILTERS = "ABCDE"
MIN_WORDS = 50
SPACES = r"[\x20\x09-\x0D]"
MARKS = r"[#$%&*|]"
N, ALL = len(FILTERS), (1 << len(FILTERS)) - 1
ORDERS = factorial(N)


def solved(matrix: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """``X`` with ``matrix @ X = right``, by elimination in exact fractions."""
    n = len(matrix)
    rows = [list(a) + list(b) for a, b in zip(matrix, right)]
    for c in range(n):
        pivot = next(r for r in range(c, n) if rows[r][c])
        rows[c], rows[pivot] = rows[pivot], rows[c]
        rows[c] = [x / rows[c][c] for x in rows[c]]
        for r in range(n):
            if r != c and rows[r][c]:
                rows[r] = [x - rows[r][c] * y for x, y in zip(rows[r], rows[c])]
    return [r[n:] for r in rows]


def shapley_weights(n: int = N) -> list[list[Fraction]]:
    """For each filter the weight of every coalition's value in its Shapley value.

    Least squares over the proper coalitions S with kernel weight (n-1) / (C(n,|S|) |S| (n-|S|)), under
    sum(phi) = v(all) with a Lagrange multiplier; column S of the right-hand sides stands for v(S) = 1.
    """
    size = [s.bit_count() for s in range(1 << n)]
    full = (1 << n) - 1
    kernel = [Fraction(n - 1, comb(n, k) * k * (n - k)) if 0 < k < n else Fraction(0) for k in size]
    matrix = [[sum((kernel[s] for s in range(1 << n) if s >> i & 1 and s >> j & 1), Fraction(0)) for j in range(n)]
              + [Fraction(1)] for i in range(n)] + [[Fraction(1)] * n + [Fraction(0)]]
    right = [[kernel[s] if s >> i & 1 else Fraction(0) for s in range(1 << n)] for i in range(n)]
    right.append([Fraction(int(s == full)) for s in range(1 << n)])
    return solved(matrix, right)[:n]


def text_failures(text: Column) -> Column:
    """Bits of the filters A-D that a text fails, from one list of its words."""
    words = F.array_remove(F.split(text, SPACES), "")
    n = F.size(words)
    capitals = F.octet_length(F.regexp_replace(text, "[^A-Z]+", ""))
    failed = [n < MIN_WORDS,
              F.size(F.array_distinct(words)) * F.lit(100).cast("long") < n * F.lit(65).cast("long"),
              capitals * F.lit(100).cast("long") > F.char_length(text) * F.lit(5).cast("long"),
              text.rlike(MARKS)]
    bits = F.lit(0)
    for i, f in enumerate(failed):
        bits = bits + F.when(f, 1 << i).otherwise(0)
    return bits


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents by part and by the exact set of filters they fail.

    Texts are read once, into a narrow row with a digest; copies are found on digests. Copies of one
    text in one part are one row of the shuffle a task, with the rows of its smallest id beside all
    rows, so a group that holds a third of the table never meets in one place.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = written(docs.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("part"), text_failures(text).alias("bits"),
        F.unhex(F.sha2(text, 256)).alias("digest")), "audit-rows")
    tags = (labels.filter("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)").groupBy("doc_id")
            .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
                 F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")))
    # One row an id and text; rows without an id can have no label.
    named = (rows.filter("doc_id IS NOT NULL").groupBy("doc_id", "part", "bits", "digest")
             .agg(F.count(F.lit(1)).alias("n")).join(tags, "doc_id", "left")
             .select("doc_id", "part", "bits", "digest", "n", F.when(F.col("good"), F.col("n")).otherwise(0).alias("good"),
                     F.when(F.col("toxic"), F.col("n")).otherwise(0).alias("toxic")))
    sums = [F.sum(c).alias(c) for c in ("n", "good", "toxic")]
    texts = written(named.groupBy("digest", "part", "bits").agg(
        F.min("doc_id").alias("least"), F.min_by(F.struct("n", "good", "toxic"), "doc_id").alias("at"), *sums),
        "audit-texts")
    first = texts.groupBy("digest").agg(F.min("least").alias("first"))
    # Of a text's rows only those of its smallest id are no copies.
    original = F.when(F.col("least") == F.col("first"), F.col("at")).otherwise(
        F.struct(*[F.lit(0).cast("long").alias(c) for c in ("n", "good", "toxic")]))
    split = texts.join(first, "digest").withColumn("kept", original).withColumn("half", F.explode(F.array(
        F.struct(F.lit(0).alias("copy"), *[F.col(f"kept.{c}").alias(c) for c in ("n", "good", "toxic")]),
        F.struct(F.lit(1).alias("copy"), *[(F.col(c) - F.col(f"kept.{c}")).alias(c) for c in ("n", "good", "toxic")]))))
    masks = split.select("part", (F.col("bits") + F.col("half.copy") * (1 << 4)).alias("mask"),
                         *[F.col(f"half.{c}").alias(c) for c in ("n", "good", "toxic")])
    nameless = rows.filter("doc_id IS NULL").select(
        "part", F.col("bits").alias("mask"), F.lit(1).cast("long").alias("n"),
        F.lit(0).cast("long").alias("good"), F.lit(0).cast("long").alias("toxic"))
    return masks.filter("n > 0").unionByName(nameless).groupBy("part", "mask").agg(*sums)


def _steps() -> Column:
    """All orders and steps: the order, the step, the coalition before it and the filter's own bit."""
    rows = []
    for order in permutations(range(N)):
        before = 0
        for k, i in enumerate(order):
            rows.append({"filter_order": "".join(FILTERS[j] for j in order), "step": k + 1, "before": before, "own": 1 << i})
            before |= 1 << i
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<filter_order:string,step:int,before:int,own:int>>")


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts of the five filters A-E over ``docs(doc_id, text, source)`` with ``labels(doc_id, quality, toxic)``.

    One row per part, order of the filters and step: part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley. A null text counts as empty, a null source as the
    empty string (one part with it). E: the text is that of a row with a smaller doc_id; a row without
    an id is no copy, makes none and has no label; rows that repeat an id with one text are no copies of
    each other. An id labelled more than once is good (toxic) if any of its labels says so. Texts of
    any length are read whole. Other columns are not read. An empty table gives an empty result.
    """
    counts = failure_counts(docs, labels)
    # at most 32 entries a part
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("found"))

    def coalitions(column: str) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(ALL)), lambda s: F.aggregate(
            "found", F.lit(0).cast("long"),
            lambda acc, x: acc + F.when(x["mask"].bitwiseAND(s) != 0, x[column]).otherwise(0)))

    weights = [[int(w * ORDERS) for w in row] for row in shapley_weights()]
    assert all(Fraction(w, ORDERS) == x for row, exact in zip(weights, shapley_weights()) for w, x in zip(row, exact))

    def value(row: list[int]) -> Column:
        out = F.lit(0).cast("long")
        for s, w in enumerate(row):
            if w:
                out = out + F.get("gone", F.lit(s)) * w
        return out

    total = F.aggregate("found", F.lit(0).cast("long"), lambda acc, x: acc + x["n"])
    parts = parts.select("part", total.alias("total"), coalitions("n").alias("gone"), coalitions("good").alias("good"),
                         coalitions("toxic").alias("toxic"))
    parts = parts.withColumn("values", F.array(*[value(row) for row in weights]))
    out = parts.withColumn("s", F.explode(_steps()))
    after = F.col("s.before") + F.col("s.own")

    def step(column: str) -> Column:
        return F.get(column, after) - F.get(column, F.col("s.before"))

    return out.select(
        "part", "s.filter_order", "s.step", (F.col("total") - F.get("gone", after)).alias("kept"),
        step("gone").alias("removed"), (F.get("gone", F.col("s.own")) - step("gone")).alias("redundant"),
        (F.get("gone", F.lit(ALL)) - F.get("gone", F.lit(ALL) - F.col("s.own"))).alias("unique_fails"),
        step("good").alias("good_lost"), step("toxic").alias("toxic_lost"),
        F.get("values", F.log2(F.col("s.own")).cast("int")).alias("shapley"))


def audit_filters_sql() -> str:
    """The same rows as DuckDB SQL, by running every order over the failure sets."""
    return """
WITH RECURSIVE d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
m AS (SELECT part,
        CASE WHEN len(w) < 50 THEN 'A' ELSE '' END
        || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
        || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 5 * length(t) THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS failed,
        doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) AS good,
        doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL) AS toxic FROM d),
c AS (SELECT part, failed, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
      FROM m GROUP BY ALL),
o AS (SELECT '' AS o UNION ALL SELECT o.o || l.l FROM o, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l) AS l WHERE NOT contains(o.o, l.l)),
s AS (SELECT o AS filter_order, k AS step, o[k] AS f, o[1:k - 1] AS before
      FROM (SELECT o FROM o WHERE length(o) = 5) AS full_orders, (SELECT unnest([1, 2, 3, 4, 5]) AS k) AS steps),
x AS (SELECT c.*, s.*, contains(failed, f) AS fails, length(translate(failed, before, '')) < length(failed) AS gone FROM c, s),
g AS (SELECT part, filter_order, step, f,
        coalesce(sum(n) FILTER (WHERE NOT gone AND NOT fails), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (WHERE NOT gone AND fails), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (WHERE gone AND fails), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (WHERE failed = f), 0)::BIGINT AS unique_fails,
        coalesce(sum(good) FILTER (WHERE NOT gone AND fails), 0)::BIGINT AS good_lost,
        coalesce(sum(toxic) FILTER (WHERE NOT gone AND fails), 0)::BIGINT AS toxic_lost
      FROM x GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM g"""
