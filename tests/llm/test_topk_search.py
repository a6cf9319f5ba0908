"""Operator 12 against all pairs."""

from __future__ import annotations

import math

import numpy as np

from tierline.llm.topk_search import BoxTree, search, top_products, NONE

SCHEMA = "vec_id long, embedding array<float>, label int, row string, q string, shard string, score string"


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(*r, 0, "?", "?", "?", "?") for r in rows], SCHEMA.replace("float", kind))


def by_hand(rows, k=20, every=20):
    fine = []
    for i, v in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            q = [math.floor(64 * x) for x in v]
            if sum(x * x for x in q) < 2 ** 63:
                fine.append((i, q))
    out = []
    for a, (i, p) in enumerate(fine):
        if i is None or i % every:
            continue
        found = [(-sum(x * y for x, y in zip(p, q)), j is None, j or 0, j) for b, (j, q) in enumerate(fine)
                 if a != b and len(p) == len(q)]
        out += [(i, n, j, -s) for n, (s, _, _, j) in enumerate(sorted(found, key=lambda f: f[:3])[:k], 1)]
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def clustered(n, dim, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    x = centres[rng.integers(0, 12, n)] * 0.3 + rng.normal(size=(n, dim)) * 0.05
    return [[float(np.float32(c)) for c in v] for v in x]


def test_all_pairs_over_many_shards_and_blocks(spark):
    vectors = clustered(900, 8, 1)
    vectors[300:500] = [vectors[0]] * 200  # copies of one vector
    rows = [(i * 7 - 700, v) for i, v in enumerate(vectors)]
    expected = by_hand(rows)
    assert rows_of(top_products(frame(spark, rows))) == expected
    assert rows_of(top_products(frame(spark, rows), shard_rows=70, block_queries=10, leaf_rows=4)) == expected
    assert rows_of(top_products(frame(spark, rows), k=3, shard_rows=200, leaf_rows=1)) == by_hand(rows, 3)


def test_edge_cases(spark):
    one = [0.5, -0.25, 1.0]
    rows = [(0, one), (20, None), (40, [0.1, None, 0.2]), (60, [float("nan"), 0.0, 0.0]), (80, [float("inf"), 0.0, 0.0]),
            (100, [0.0, 0.0, 0.0]), (120, [1.0, 2.0]), (140, []), (160, []), (180, [3e8, -2e8, 1e8]), (200, [1e30, 0.0, 0.0]),
            (220, one), (220, one), (240, one), (None, one), (None, [9.0, 9.0, 9.0]), (7, [-0.001, 0.001, 0.0]), (-20, one),
            (5, [2.5e8, 2.5e8, 2.5e8])]
    for kind in ("float", "double"):
        rows = [(i, v and [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows]
        expected = by_hand(rows, 4)
        assert rows_of(top_products(frame(spark, rows, kind), k=4)) == expected
        assert rows_of(top_products(frame(spark, rows, kind), k=4, shard_rows=3, block_queries=2, leaf_rows=1)) == expected
    assert top_products(frame(spark, [])).collect() == []
    assert top_products(frame(spark, [(3, one)])).collect() == []
    assert top_products(frame(spark, [(20, one)])).collect() == []


def test_boxes_are_tight_and_bounds_skip_leaves():
    rng = np.random.default_rng(3)
    x = np.r_[rng.integers(0, 20, (500, 4)), rng.integers(1000, 1020, (500, 4))]
    tree = BoxTree(x, 16)
    assert sorted(tree.order) == list(range(1000))
    for (a, b), low, high, child in zip(tree.span, tree.low, tree.high, tree.child):
        part = x[tree.order[a:b]]
        assert (part.min(0) == low).all() and (part.max(0) == high).all()
        assert child >= 0 or b - a <= 16
    q = np.full((1, 4), 3)
    none = np.array([NONE])
    _, row, score = search(x, q, np.array([-1]), none, 5, 16)
    assert sorted(score) == sorted((x @ q[0]))[-5:]
    # a propagated kth score keeps ties and drops what is below it
    top = int((x @ q[0]).max())
    _, row, score = search(x, q, np.array([-1]), np.array([top]), 5, 16)
    assert (score == top).all() and len(score) == min(5, int((x @ q[0] == top).sum()))
