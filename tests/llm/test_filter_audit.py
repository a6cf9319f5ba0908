"""Operator 11 against every order run by hand, and its least-squares solution against Shapley's formula."""

from __future__ import annotations

import re
from collections import defaultdict
from fractions import Fraction
from itertools import permutations
from math import factorial

from llm_fixtures import EDGE_ROWS, LONG, table

from tierline.llm.filter_audit import audit_filters, shapley_weights

LABELS = "doc_id long, quality int, toxic int, part string, mask int"


def failures(rows):
    """The set of filters each row fails."""
    first = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            first[text or ""] = min(first.get(text or "", doc_id), doc_id)
    for doc_id, text, *_ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        yield "".join(f for f, bad in zip("ABCDE", (
            len(words) < 50, 100 * len(set(words)) < 65 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 5 * len(text), re.search(r"[#$%&*|]", text),
            doc_id is not None and first[text] < doc_id)) if bad)


def audit_by_hand(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    parts = defaultdict(list)
    for row, failed in zip(rows, failures(rows)):
        parts[row[3] or ""].append((row[0], failed))
    out, sums = {}, defaultdict(int)
    for part, docs in parts.items():
        for order in map("".join, permutations("ABCDE")):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                sums[part, f] += len(gone)
                out[part, order, step] = (
                    len(left), len(gone), sum(f in d[1] for d in docs) - len(gone), sum(d[1] == f for d in docs),
                    sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone))
    return {k: (*v, sums[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def got(spark, rows, labels):
    frame = spark.createDataFrame([(*r, "x", 7) for r in labels], LABELS)
    out = audit_filters(table(spark, rows), frame)
    assert out.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                           "toxic_lost", "shapley"]
    return {(r[0], r[1], r[2]): tuple(r[3:]) for r in out.collect()}


def test_weights_are_shapleys():
    n = 5
    for i, row in enumerate(shapley_weights(n)):
        for s, w in enumerate(row):
            k = s.bit_count()
            if s >> i & 1:
                assert w == Fraction(factorial(k - 1) * factorial(n - k), factorial(n))
            elif s:
                assert w == -Fraction(factorial(k) * factorial(n - k - 1), factorial(n))
            else:
                assert w == 0  # no coalition: its value is zero


def test_edge_cases_against_every_order_by_hand(spark):
    many = " ".join(f"word{i}" for i in range(60))
    rows = [*EDGE_ROWS, (20, many, "en", "a"), (21, many, "en", "b"), (21, many, "en", "b"), (19, many, "en", ""),
            (22, many + " 5% more", "en", None), (23, many.upper(), "en", "a"), (24, "Ab" * 10 + " tab\tand\x0bmore", "en", "d"),
            (25, "x" * 20 + "E", "en", "d"), (26, "A" + "x" * 19, "en", "d"), (27, "é" * 19 + "É", "en", "d"),
            (28, LONG + " #", "en", "a"), (30, many, "en", "a"), (30, "other", "en", "a")]
    labels = [(20, 1, 0), (20, 0, 1), (21, 1, None), (3, None, 1), (4, 0, 0), (None, 1, 1), (99, 1, 1), (30, 1, 1)]
    expected = audit_by_hand(rows, labels)
    assert got(spark, rows, labels) == expected
    assert len(expected) == 600 * len({r[3] or "" for r in rows})


def test_a_group_with_most_rows_and_empty_tables(spark):
    rows = [(i, "same text" if i % 3 else f"text {i}", "en", f"s{i % 4}") for i in range(300)]
    assert got(spark, rows, []) == audit_by_hand(rows, [])
    assert got(spark, [], [(1, 1, 1)]) == {}
