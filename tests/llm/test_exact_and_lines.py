"""Operators 1 and 8 (DataFrame functions only) against brute force and their SQL."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest
from llm_fixtures import EDGE_ROWS, LOWER, table
from pyspark.sql import functions as F

from conftest import SF_SMALL, SF_SMOKE
from oracle_compare import compare, duck
from tierline.llm import exact_dedup
from tierline.llm.exact_dedup import build_directory, drop_copies, exact_groups, with_bucket
from tierline.llm.line_dedup import dedup_lines, dedup_lines_sql
from tierline.llm.queries import ORACLE_SQL, op1_exact_dedup, op8_line_dedup


def duck_documents(sf):
    return duck(sf)


def groups(rows):
    found = defaultdict(list)
    for doc_id, text, *_ in rows:
        found[(text or "").translate(LOWER)].append(doc_id)
    out = []
    for text, ids in found.items():
        real = [i for i in ids if i is not None]
        keep = max(real) if real else None
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


@pytest.mark.parametrize("params", [{}, {"bucket_entries": 2}, {"hash_bits": 3, "bucket_entries": 1}])
def test_exact_groups_on_edge_cases_even_when_hashes_collide(spark, params):
    got = exact_groups(table(spark, EDGE_ROWS), **params).collect()
    assert sorted(map(tuple, got), key=str) == groups(EDGE_ROWS)


def test_exact_groups_match_sql(spark):
    ok, message = compare(op1_exact_dedup(spark, SF_SMALL), duck_documents(SF_SMALL), ORACLE_SQL["op1_exact_dedup"])
    assert ok, message


def test_directory_doubles_until_buckets_fit_and_covers_all_entries(spark, monkeypatch):
    entries = spark.range(5000).selectExpr("xxhash64(id) AS h").union(spark.range(300).selectExpr("id AS h"))
    entries = entries.withColumn("n", F.lit(2))
    directory = build_directory(entries, 64).cache()
    sizes = [(r["bits"], r["prefix"], r["entries"], r["rows"]) for r in directory.collect()]
    assert max(b for b, *_ in sizes) > 6 and max(n for _, _, n, _ in sizes) <= 64
    assert sum(n for _, _, n, _ in sizes) == 5300 and sum(w for *_, w in sizes) == 10600
    assert len({b for b, *_ in sizes}) > 1  # only overfull buckets split
    # a bucket that fits was split only because its parent did not fit
    hashes = [r["h"] % 2**64 for r in entries.select("h").collect()]
    for bits, prefix, *_ in sizes:
        assert bits and sum(h >> (65 - bits) == prefix >> 1 for h in hashes) > 64
    for bound in (1 << 18, 0):  # broadcast, and shuffled
        monkeypatch.setattr(exact_dedup, "DIRECTORY_BROADCAST", bound)
        placed = with_bucket(entries, directory, 10600)
        inside = placed.join(directory.selectExpr("shiftleft(prefix, 64 - bits) AS bucket", "bits", "prefix"), "bucket")
        assert inside.count() == 5300
        assert inside.filter("shiftrightunsigned(h, 64 - bits) <> prefix").count() == 0


def test_rows_that_the_directory_sends_to_another_bucket_find_no_entry(spark, monkeypatch):
    real, calls = exact_dedup.with_bucket, []

    def wrong(rows, directory, total):  # the index is right, the rows' lookups are not
        calls.append(1)
        return real(rows, directory, total).withColumn("bucket", F.col("bucket") + (0 if len(calls) == 1 else 1))

    monkeypatch.setattr(exact_dedup, "with_bucket", wrong)
    assert exact_groups(table(spark, EDGE_ROWS), bucket_entries=2).count() == 0


def test_drop_copies_keeps_one_row_of_a_group_and_the_columns(spark):
    docs = table(spark, EDGE_ROWS)
    got = drop_copies(docs)
    assert got.columns == docs.columns
    # ids 3, 5 and the null id go for 4's text group (largest: 5 stays); identical rows of id 7 stay together
    ids = sorted(str(r["doc_id"]) for r in got.select("doc_id").collect())
    expected = sorted(str(i) for i, _, _, kept, _ in groups(EDGE_ROWS) if kept)
    assert ids == expected


def test_exact_empty_table(spark):
    empty = table(spark, [])
    assert exact_groups(empty).count() == 0 and drop_copies(empty).count() == 0


def lines_by_hand(rows, run, words):
    """Place runs that count in order of (doc_id, line); a later equal run marks its lines."""
    first, gone = {}, defaultdict(set)
    order = sorted(((doc_id is not None, doc_id or 0), doc_id, text) for doc_id, text, *_ in rows if text is not None)
    for key, _, text in order:
        lines = text.split("\n")
        for i in range(len(lines)):
            for n in range(1, run + 1):
                part = tuple(lines[i:i + n])
                if len(part) < n or n < run and sum(len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in part) < words:
                    continue
                place = (key, i)
                if first.setdefault(part, place) != place:
                    gone[(key, text)].update(range(i, i + n))
    out = []
    for doc_id, text, *_ in rows:
        if text is None:
            out.append((doc_id, 0, 0, None))
            continue
        cut = gone[((doc_id is not None, doc_id or 0), text)]
        lines = text.split("\n")
        out.append((doc_id, len(lines), len(cut), "\n".join(x for i, x in enumerate(lines) if i not in cut)))
    return sorted(out, key=str)


LONG_LINE = "one line of exactly ten words that stands in two"
LINE_ROWS = EDGE_ROWS + [
    (20, "p\nq\nr\ns\nt", "en", "a"), (21, "0\np\nq\nr\ns\nt\n1", "en", "a"), (22, "r\ns\nt\nx\np\nq", "en", "a"),
    (23, "m\nm\nm\nm\nm", "en", "a"), (24, "\n\n\n\n", "en", "a"), (None, "p\nq\nr", "en", "a"), (25, "p\nq", "en", "a"),
    (30, LONG_LINE, "en", "a"), (31, f"u\n{LONG_LINE}\nv", "en", "a"), (32, f"{LONG_LINE}\nv", "en", "a"),
    (33, "five words stand in here\nand five more of them", "en", "a"),
    (34, "x y\nfive words stand in here\nand five more of them\nx y", "en", "a"),
    (35, "five words stand in here\nx y\nand five more of them", "en", "a"),
]


@pytest.mark.parametrize("run, words", [(1, 4), (2, 10), (3, 10), (3, 4), (4, 6), (3, 10**6)])
def test_lines_on_edge_cases(spark, run, words):
    got = dedup_lines(table(spark, LINE_ROWS), run, words).collect()
    assert sorted(map(tuple, got), key=str) == lines_by_hand(LINE_ROWS, run, words)


def test_a_long_line_is_a_run_by_itself_and_short_ones_are_not(spark):
    got = {r["doc_id"]: r["text"] for r in dedup_lines(table(spark, LINE_ROWS)).collect()}
    assert got[30] == LONG_LINE and got[31] == "u\nv" and got[32] == ""
    assert got[33].count("\n") == 1 and got[34] == "x y\nx y" and got[35].count("\n") == 2  # ten words in two lines
    assert got[25] == "p\nq"


def test_lines_match_sql(spark):
    for sf, run in ((SF_SMOKE, 2), (SF_SMALL, 3)):
        got = dedup_lines(spark.read.parquet(f"{sf}/documents.parquet"), run)
        ok, message = compare(got, duck_documents(sf), dedup_lines_sql(run))
        assert ok, message
    assert op8_line_dedup(spark, SF_SMOKE).filter("n_removed > 0").count() > 0


def test_lines_empty_table(spark):
    assert dedup_lines(table(spark, [])).count() == 0


def test_no_python_in_the_native_plans(spark):
    for query in (op1_exact_dedup, op8_line_dedup):
        plan = query(spark, SF_SMOKE)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
