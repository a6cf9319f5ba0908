"""Line deduplication by winnowing, in DataFrame functions only.

Every text is a sequence of line hashes. A run of consecutive lines counts if it has ``run`` lines or
``words`` words. Winnowing: each smallest window that counts selects its smallest hash (the leftmost
on ties) as a fingerprint, so two texts that share a run that counts are guaranteed to share a
fingerprint in it, at the same place of the run. The positions of a fingerprint are joined, and each match
is extended from the fingerprint both ways, line hash by line hash, over the windows that selected it.
The first of equal windows, in order of (doc_id, line), is the original; the lines of all later
ones are deleted. Overlapping windows unite to the maximal repeated run.

A position carries the ``run - 1`` line hashes on both sides, so extending needs no second look at a
text. Equal windows meet in aggregates that combine before the shuffle (first position, count), and the
way back is a join that sends hot windows by a bounded broadcast, so no pairs are formed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import join_spread, written

RUN = 3
WORDS = 10
WORD = r"[^\x20\x09-\x0D]+"


def _positions(rows: DataFrame, run: int, words: int) -> DataFrame:
    """One row a fingerprint: ``h``, its line ``at``, the hashes ``around`` it (null beyond the text)
    and ``spans``: ``(before, n)`` of the windows of ``n`` lines that selected it."""
    side = run - 1
    beyond = F.array_repeat(F.lit(None).cast("long"), side)
    none = F.array_repeat(F.lit(None).cast("int"), side)
    # a line, with run - 1 lines before and after it
    padded = rows.select("doc_id", "row_key", "lines", F.concat(beyond, "lines", beyond).alias("hashes"),
                         F.concat(none, "words", none).alias("counts"))
    lines = padded.select("doc_id", "row_key", F.explode(F.transform("lines", lambda h, i: F.struct(
        h.alias("h"), i.alias("at"), F.slice("hashes", i + 1, 2 * side + 1).alias("around"),
        F.slice("counts", i + 1, 2 * side + 1).alias("counts")))).alias("line")).select("doc_id", "row_key", "line.*")

    def counts(start: int, n: int) -> Column:
        if n == 0:
            return F.lit(False)
        if n == run:
            return F.lit(True)
        total = F.lit(0)
        for k in range(start, start + n):
            total = total + F.get("counts", F.lit(k))
        return total >= words

    def span(before: int, n: int) -> Column:
        start = side - before
        inside = F.get("counts", F.lit(start)).isNotNull() & F.get("counts", F.lit(start + n - 1)).isNotNull()
        chosen = F.lit(True)
        for k in range(start, start + n):
            other = F.get("around", F.lit(k))
            if k != side:
                chosen = chosen & ((other > F.col("h")) if k < side else (other >= F.col("h")))
        # a window whose two halves of n - 1 lines count adds no line to what they delete
        smallest = ~(counts(start, n - 1) & counts(start + 1, n - 1))
        return F.when(inside & counts(start, n) & smallest & chosen,
                      F.struct(F.lit(before).alias("before"), F.lit(n).alias("n")))

    spans = F.array_compact(F.array(*(span(before, n) for n in range(1, run + 1) for before in range(n))))
    return lines.select("doc_id", "row_key", "h", "at", "around", spans.alias("spans")).filter(F.size("spans") > 0)


def repeated_runs(docs: DataFrame, run: int = RUN, words: int = WORDS) -> tuple[DataFrame, DataFrame]:
    """``(rows, later)``: ``rows(doc_id, row_key, lines, words)`` with each text's line hashes and words
    (none above ``words``), and ``later(doc_id, row_key, runs)`` with ``(start, n)`` of its later windows."""
    base = docs.select("doc_id", "text").withColumn("row_key", F.xxhash64("doc_id", "text"))
    split = base.select("doc_id", "row_key", F.split(F.col("text"), "\n", -1).alias("split")).filter("split IS NOT NULL")
    rows = written(split.select(
        "doc_id", "row_key", F.transform("split", lambda x: F.xxhash64(x)).alias("lines"),
        F.transform("split", lambda x: F.least(F.regexp_count(x, F.lit(WORD)), F.lit(words))).alias("words")), "line-hashes")
    positions = _positions(rows, run, words)
    shared = written(positions.groupBy("h").agg(F.count(F.lit(1)).alias("w")).filter("w > 1"), "line-prints")
    total = max(rows.agg(F.sum(F.size("lines"))).first()[0] or 0, 1)
    met = join_spread(positions, shared, ["h"], "w", total)
    # extend from the fingerprint: `before` lines back, the rest of the n lines ahead
    span = F.col("span")
    extended = met.withColumn("span", F.explode("spans")).select(
        "doc_id", "row_key", (F.col("at") - span["before"]).alias("start"),
        F.slice("around", F.lit(run) - span["before"], span["n"]).alias("window"))
    matches = written(extended, "line-matches")
    first = (matches.groupBy("window").agg(F.min(F.struct("doc_id", "start")).alias("first"), F.count(F.lit(1)).alias("w"))
             .filter("w > 1"))
    later = join_spread(matches, first, ["window"], "w", total).filter(
        ~F.struct("doc_id", "start").eqNullSafe(F.col("first")))
    later = later.groupBy("doc_id", "row_key").agg(
        F.collect_set(F.struct("start", F.size("window").alias("n"))).alias("runs"))
    return rows, later


def dedup_lines(docs: DataFrame, run: int = RUN, words: int = WORDS) -> DataFrame:
    """Delete every run of lines of ``docs(doc_id, text)`` that stands earlier and counts: ``run`` or more
    lines, or lines of ``words`` or more words together (a long line is a run by itself).

    One row per input row: doc_id, n_lines, n_removed, text (without the deleted lines). A line goes
    if it is part of a run that counts and also begins at a smaller (doc_id, line); a line's
    first occurrence therefore always stays. Lines end at ``\\n`` and are compared as they are, by
    64-bit hashes of all lines of a window; words are ``[^\\x20\\x09-\\x0D]+``. A null text stays null
    with 0 lines; an empty text is one empty line; texts of fewer lines lose only lines that count by
    their words. Null ids come first; rows that repeat an id stand at the same place, so they don't
    remove each other's lines. A very long text is one row of hashes, 9 bytes a line, and its lines
    spread from there; a very long line is one hash. Other columns are not read. An empty table gives an empty result.
    """
    _, later = repeated_runs(docs, run, words)
    later = written(later, "line-runs")
    base = docs.select("doc_id", "text").withColumn("row_key", F.xxhash64("doc_id", "text"))
    hit = later.select(F.col("doc_id").alias("_id"), F.col("row_key").alias("_key"), "runs").hint("merge")
    out = base.join(hit, base["row_key"].eqNullSafe(hit["_key"]) & base["doc_id"].eqNullSafe(hit["_id"]), "left")
    gone = F.array_sort(F.array_distinct(F.flatten(F.transform(
        "runs", lambda r: F.sequence(r["start"], r["start"] + r["n"] - 1)))))
    out = out.select("doc_id", "text", gone.alias("gone")).select(
        "doc_id", "gone", "text", F.when(F.col("text").isNotNull(), F.split("text", "\n", -1)).alias("lines"))
    kept = F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone")), lambda i: F.get("lines", i)), "\n")
    return out.select(
        "doc_id", F.coalesce(F.when(F.col("lines").isNotNull(), F.size("lines")), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.when(F.col("gone").isNotNull(), F.size("gone")), F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("text"))


def dedup_lines_sql(run: int = RUN, words: int = WORDS) -> str:
    """The same rows as DuckDB SQL: all windows of 1 to ``run`` lines that count, first positions by ``min``."""
    windows, later, gone = [], [], []
    for n in range(1, run + 1):
        lines = ", ".join(["line"] + [f"lead(line, {k}) OVER w" for k in range(1, n)])
        enough = " + ".join(["words"] + [f"lead(words, {k}) OVER w" for k in range(1, n)])
        counts = f"pos + {n} <= n" + (f" AND {enough} >= {words}" if n < run else "")
        windows.append(f"CASE WHEN {counts} THEN [{lines}] END AS win{n}")
        later.append(f"CASE WHEN win{n} IS NOT NULL AND (doc_id, pos) <> min((doc_id, pos)) OVER (PARTITION BY win{n}) "
                     f"THEN 1 ELSE 0 END AS later{n}")
        gone.append(f"max(later{n}) OVER (PARTITION BY doc_id, text ORDER BY pos ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)")
    return f"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, text, unnest(lines) AS line, unnest(range(len(lines))) AS pos, len(lines) AS n FROM d WHERE text IS NOT NULL),
c AS (SELECT *, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS words FROM l),
g AS (SELECT *, {', '.join(windows)}
      FROM c WINDOW w AS (PARTITION BY doc_id, text ORDER BY pos)),
f AS (SELECT *, {', '.join(later)} FROM g),
r AS (SELECT *, greatest({', '.join(gone)}) AS gone FROM f),
k AS (SELECT doc_id, text, sum(gone) AS n_removed, string_agg(CASE WHEN gone = 0 THEN line END, chr(10) ORDER BY pos) AS kept
      FROM r GROUP BY doc_id, text)
SELECT d.doc_id, coalesce(len(d.lines), 0)::BIGINT AS n_lines, coalesce(k.n_removed, 0)::BIGINT AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.kept, '') END AS text
FROM d LEFT JOIN k ON d.doc_id = k.doc_id AND d.text = k.text"""
