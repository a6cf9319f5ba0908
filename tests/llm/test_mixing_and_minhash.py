"""Operators 4 and 5 against brute force and SQL."""

from __future__ import annotations

import random
from collections import Counter
from fractions import Fraction

import pytest
from llm_fixtures import EDGE_ROWS, components, read_documents, table, words

from conftest import SF_SMALL, SF_SMOKE
from oracle_compare import compare, duck
from tierline.llm.components import connected_components
from tierline.llm.minhash import drop_near_duplicates, near_duplicates
from tierline.llm.mixing import mixed_documents, mixture, mixture_sql
from tierline.llm.queries import ORACLE_SQL, op4_source_mixing


def duck_of(rows):
    import pyarrow as pa

    con = duck(SF_SMOKE)
    con.execute("DROP VIEW documents")
    con.register("documents", pa.table({
        "doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string()),
        "source": pa.array([r[3] for r in rows], pa.string())}))
    return con


def targets(sizes, weights, cap):
    """Fill by rounds: share what is left among the sources below their cap, stop those above it."""
    total, capped = sum(sizes), set()
    while True:
        left = total - sum(cap * sizes[i] for i in capped)
        w = sum(weights[i] for i in range(len(sizes)) if i not in capped)
        share = {i: Fraction(weights[i] * left, w) for i in range(len(sizes)) if i not in capped} if w else {}
        over = {i for i, t in share.items() if t > cap * sizes[i]}
        if not over:
            return [Fraction(cap * sizes[i]) if i in capped else share[i] for i in range(len(sizes))]
        capped |= over


@pytest.mark.parametrize("sizes", [[100, 5, 1], [1, 1, 1000, 2, 3, 400], [0, 10, 0], [7]])
def test_targets_are_water_filled(spark, sizes):
    rows, i = [], 0
    for s, n in enumerate(sizes):
        parts = [n] if n < 8 else [3] * (n // 3) + ([n % 3] if n % 3 else [])
        for part in parts:
            rows.append((i, "w " * part, "en", f"s{s}"))
            i += 1
    got = mixture(table(spark, rows)).collect()
    expected = targets(sizes, [1 + k % 3 for k in range(len(sizes))], 3)
    by = {r["doc_id"]: rows[r["doc_id"]][3] for r in got}
    for s, t in enumerate(expected):
        mine = [r for r in got if by[r["doc_id"]] == f"s{s}"]
        assert all(r["target"] == pytest.approx(float(t)) and r["source_size"] == sizes[s] for r in mine)
        assert abs(sum(r["taken"] for r in mine) - t) <= max(r["size"] for r in mine) / 2
    assert sum(expected) == sum(sizes) and all(r["taken"] <= 3 * r["size"] for r in got)


def test_mixture_on_edge_cases_matches_sql(spark):
    rng = random.Random(5)
    rows = EDGE_ROWS + [(100 + i, "t " * rng.randint(0, 9), "en", rng.choice(["a", "b", "Z", "é", "", None])) for i in range(200)]
    got = mixture(table(spark, rows)).drop("row_key")
    ok, message = compare(got, duck_of(rows), mixture_sql())
    assert ok, message


def test_mixture_matches_sql_on_the_driver_table(spark):
    con = duck(SF_SMALL)
    ok, message = compare(op4_source_mixing(spark, SF_SMALL), con, ORACLE_SQL["op4_source_mixing"])
    assert ok, message


def test_rows_that_share_an_id_are_taken_one_by_one(spark):
    """100 rows of 10 words without ids, or with one id, equal or not, against a target of 700 words."""
    other = [(1000 + i, "w " * 10, "en", "b") for i in range(5)]
    for doc_id in (None, 7):
        for text in ("w " * 10, None):
            rows = [(doc_id, text or f"v{i} " * 10, "en", "a") for i in range(100)] + [(2000 + i, "x " * 10, "en", "c") for i in range(100)] + other
            docs = table(spark, rows)
            got = mixture(docs, range_rows=16)
            taken = {r["target"]: r["t"] for r in got.groupBy("target").agg({"taken": "sum"}).withColumnRenamed("sum(taken)", "t").collect()}
            assert all(abs(t - n) <= 5 for t, n in taken.items()), taken
            ok, message = compare(got.drop("row_key"), duck_of(rows), mixture_sql())
            assert ok, message
            copies = Counter(r["source"] for r in mixed_documents(docs).select("source").collect())
            plan = got.collect()
            assert 10 * sum(copies.values()) == sum(r["taken"] for r in plan)


def test_mixed_documents_repeat_rows_as_taken(spark):
    rows = [r for r in EDGE_ROWS if r[0] is not None and r[0] != 7]
    docs = table(spark, rows)
    plan = {r["doc_id"]: r for r in mixture(docs).collect()}
    got = mixed_documents(docs)
    assert got.columns == docs.columns
    times = Counter(r["doc_id"] for r in got.select("doc_id").collect())
    assert {i: t * plan[i]["size"] for i, t in times.items()} == {i: r["taken"] for i, r in plan.items() if r["taken"]}


def test_empty_tables(spark):
    empty = table(spark, [])
    assert mixture(empty).count() == 0 and mixed_documents(empty).count() == 0
    assert near_duplicates(empty).count() == 0 and drop_near_duplicates(empty).count() == 0


# ---- near-duplicates ---------------------------------------------------------------------------


def shingles(text, k):
    w = words(text)
    return {tuple(w[i:i + k]) for i in range(max(len(w) - k + 1, 1))} if w else set()


def near_by_hand(rows, k, percent):
    sets = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            sets[doc_id] = shingles(text, k)
    ids = sorted(i for i in sets if sets[i])
    links = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1:]
             if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    comp = components(sets, links)
    return sorted(((i, len(shingles(t, k)), comp[i] if i is not None else None, i is None or comp[i] == i)
                   for i, t, *_ in rows), key=str)


def edited(rng, base, n):
    w = list(base)
    for _ in range(n):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def near_rows(seed=1):
    """Groups of edited copies around the threshold, chains of edits, copies and unrelated texts."""
    rng = random.Random(seed)
    rows = []
    for g in range(12):
        base = [f"g{g}w{rng.randrange(400)}" for _ in range(rng.choice([6, 30, 120]))]
        rows += [" ".join(base)] * rng.randint(1, 3)
        rows += [edited(rng, base, max(1, len(base) * e // 100)) for e in (1, 2, 4, 5, 6, 8, 12) for _ in range(2)]
        text = " ".join(base)
        for _ in range(4):  # a chain: each a copy of the one before
            text = edited(rng, text.split(" "), max(1, len(base) // 25))
            rows.append(text)
    rng.shuffle(rows)
    return [(i + 50, t, "en", "s") for i, t in enumerate(rows)]


@pytest.mark.parametrize("k", [2, 5])
def test_groups_match_all_pairs(spark, k):
    rows = near_rows() + [r for r in EDGE_ROWS if r[0] is None or r[0] < 50]
    got = sorted((tuple(r) for r in near_duplicates(table(spark, rows), words=k).collect()), key=str)
    assert got == near_by_hand(rows, k, 80)


def test_driver_table_matches_all_pairs(spark):
    rows = read_documents(SF_SMOKE)
    got = sorted((tuple(r) for r in near_duplicates(table(spark, rows)).collect()), key=str)
    assert got == near_by_hand(rows, 2, 80)


def test_one_large_group_makes_comparisons_in_proportion(spark):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(200)]
    rows = [(i, edited(rng, base, 2), "en", "s") for i in range(300)]
    got = near_duplicates(table(spark, rows)).collect()
    assert {r["component_id"] for r in got} == {0}


def test_an_id_with_two_texts_keeps_both(spark):
    rng = random.Random(4)
    a, b = ([f"{x}{i}" for i in range(60)] for x in "ab")
    rows = [(3, " ".join(a), "en", "s"), (7, edited(rng, a, 1), "en", "s"), (7, " ".join(b), "en", "s"),
            (9, "  ".join(b), "en", "s"), (9, "  ".join(b), "en", "s")]
    got = sorted(tuple(r) for r in near_duplicates(table(spark, rows)).collect())
    assert [(r[0], r[2], r[3]) for r in got] == [(3, 3, True), (7, 3, False), (7, 7, True), (9, 7, False), (9, 7, False)]
    kept = {(r["doc_id"], r["text"]) for r in drop_near_duplicates(table(spark, rows)).collect()}
    assert kept == {(3, " ".join(a)), (7, " ".join(b))}


def test_a_unit_of_many_linked_sets_holds_no_list_of_its_pairs():
    import resource

    import numpy as np
    import pyarrow as pa

    from tierline.llm.minhash import _unit

    n, common = 6_000, np.arange(40, dtype=np.uint64) * np.uint64(7919)
    sets = [np.sort(np.append(common, np.uint64(10 ** 9 + i))).tobytes() for i in range(n)]
    t = pa.table({"rep": pa.array(range(n), pa.int64()), "left": [True] * n, "shingles": pa.array(sets, pa.binary())})
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    got = _unit(t, 80)
    assert got.num_rows == n - 1 and set(got["a"].to_pylist()) == {0}
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 400 << 10      # kilobytes


def test_drop_near_duplicates_keeps_columns(spark):
    docs = table(spark, near_rows())
    got = drop_near_duplicates(docs)
    assert got.columns == docs.columns
    assert got.count() == len({r[2] for r in near_by_hand(near_rows(), 2, 80)})


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5), (7000, 6999)]
    edges += [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(300)] + [(None, 3), (2, None)]
    nodes = {x for e in edges if None not in e and e[0] != e[1] for x in e}
    expected = components(nodes, [e for e in edges if None not in e])
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == expected
