"""Operator 3 against all pairs."""

from __future__ import annotations

import math
import threading
from contextlib import suppress
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import components

from conftest import SF_SMOKE
from tierline.llm import embedding_dedup
from tierline.llm.embedding_dedup import near_vectors, spherical_kmeans


def brute(rows, t=0.9):
    def fine(i, v):
        return (i is not None and v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)
                and any(x != 0 for x in v))

    good = [(i, np.array(v, float)) for i, v in rows if fine(i, v)]
    links, counts = [], {}
    for a in range(len(good)):
        for b in range(len(good)):
            u, v = good[a][1], good[b][1]
            if a != b and len(u) == len(v) and u @ v / math.sqrt((u @ u) * (v @ v)) >= t:
                links.append((good[a][0], good[b][0]))
                counts[a] = counts.get(a, 0) + 1
    comp = components([i for i, _ in good], links)
    out = [(i, counts.get(a, 0), comp[i], comp[i] == i) for a, (i, _) in enumerate(good)]
    return sorted(out + [(i, 0, i, True) for i, v in rows if not fine(i, v)], key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "?", "?", "?") for i, v in rows],
                                 "vec_id long, embedding array<float>, label int, rep string, cell string, k1 string")


@pytest.mark.parametrize("params", [{}, {"cell_vectors": 10, "block_vectors": 4}])
def test_links_match_all_pairs(spark, params):
    rng = np.random.default_rng(3)
    rows = []
    for c in range(12):
        centre = rng.normal(size=8)
        for _ in range(int(rng.integers(1, 25))):
            rows.append((len(rows), [float(x) for x in np.float32(centre + rng.normal(scale=0.35, size=8))]))
    rows += [(len(rows) + k, rows[5][1]) for k in range(9)]  # equal vectors
    rows += [(900, None), (901, []), (902, [0.0] * 8), (903, [float("nan")] + [1.0] * 7), (904, [None] + [1.0] * 7),
             (905, [float("inf")] + [1.0] * 7), (None, rows[5][1]), (906, [1.0, 2.0]), (907, [1.0, 2.1]),
             (908, [1e30] * 8), (909, [1e-30] * 8)]
    got = sorted((tuple(r) for r in near_vectors(frame(spark, rows), **params).collect()), key=str)
    assert got == brute(rows)


def test_driver_table_with_small_cells(spark):
    df = spark.read.parquet(f"{SF_SMOKE}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    got = sorted((tuple(r) for r in near_vectors(df, cell_vectors=40, block_vectors=16).collect()), key=str)
    assert got == brute(rows)


def test_empty_table_and_only_unusable_vectors(spark):
    assert near_vectors(frame(spark, [])).count() == 0
    got = near_vectors(frame(spark, [(1, None), (2, [0.0])])).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_centres_are_unit_vectors():
    x = np.random.default_rng(1).normal(size=(50, 4))
    c = spherical_kmeans(x / np.linalg.norm(x, axis=1, keepdims=True), 7)
    assert c.shape == (7, 4) and np.allclose(np.linalg.norm(c, axis=1), 1)


def test_disk_follows_the_vectors_not_the_pairs_to_compare(spark):
    """Vectors without structure: all cells meet, but the shuffles on the way don't hold each vector many times for that."""
    vectors = np.random.default_rng(2).normal(size=(4000, 32)).astype(np.float32)
    df = frame(spark, [(i, v.tolist()) for i, v in enumerate(vectors)]).coalesce(2)
    local = [Path(d) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()]

    def shuffles():
        found = {}
        for f in (f for d in local for f in d.rglob("shuffle_*.data")):
            with suppress(OSError):  # it goes with its job
                found[f] = f.stat().st_size
        return found

    before, most, done = shuffles(), [0], threading.Event()

    def watch():
        while not done.wait(0.02):
            most.append(sum(size for f, size in shuffles().items() if f not in before))

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        assert near_vectors(df, cell_vectors=100).count() == len(vectors)
    finally:
        done.set()
        watcher.join()
    assert max(most) < 6 * vectors.nbytes, max(most) / vectors.nbytes


def by_products(x, t=0.9):
    x = x.astype(float)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = x @ x.T >= t
    np.fill_diagonal(hit, False)
    comp = components(range(len(x)), [(int(a), int(b)) for a, b in zip(*np.nonzero(hit))])
    return [(i, int(hit[i].sum()), comp[i], comp[i] == i) for i in range(len(x))]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_wide_vectors_large_groups_and_cells_apart(spark, kind):
    """The ways through a product: few pairs pass the leading components, or most do; cells far apart are skipped."""
    rng = np.random.default_rng(8)
    near = rng.normal(size=64) + rng.normal(scale=0.4, size=(700, 64))  # most pairs close to the threshold
    apart = np.repeat(3 * np.eye(64)[:4], 150, axis=0) + rng.normal(scale=0.05, size=(600, 64))
    flat = np.concatenate([rng.normal(size=(300, 3)), np.zeros((300, 61))], axis=1) + 1e-3
    x = np.concatenate([rng.normal(size=(900, 64)), near, apart, flat])
    x = x[rng.permutation(len(x))].astype(np.float32 if kind == "float" else np.float64)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], f"vec_id long, embedding array<{kind}>")
    want = by_products(x)
    assert sum(r[1] for r in want) > 200_000
    for params in ({"cell_vectors": 100, "block_vectors": 300}, {}):
        assert sorted(map(tuple, near_vectors(df, **params).collect())) == want


def test_links_are_counted_whole_when_the_pairs_held_run_over(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "HELD_LINKS", 1000)
    rng = np.random.default_rng(4)
    x = np.concatenate([c + rng.normal(scale=0.2, size=(40, 8)) for c in rng.normal(size=(6, 8))]).astype(np.float32)
    want = by_products(x)
    block = [embedding_dedup._pack(pa.table({"rep": np.arange(len(x))[s], "mult": np.ones(len(x[s]), int), "embedding": list(x[s]),
                                             "d": pa.array([8] * len(x[s]), pa.int32()), "cell": pa.array([0] * len(x[s]), pa.int32()),
                                             "no": np.zeros(len(x[s]), int)}), x[:1] / np.linalg.norm(x[0]), 0.45)
             for s in (slice(0, 130), slice(130, 240))]
    block = [b.rename_columns([f"a_{c}" for c in b.column_names]).combine_chunks().to_batches()[0] for b in block]
    centre = (x[:1] / np.linalg.norm(x[0])).astype(float)
    a, b = (embedding_dedup._Block(t, 0, "a_", np.float32, centre, None) for t in block)
    links = np.zeros(len(x), int)
    for one, other in ((a, a), (b, b), (a, b)):
        out = embedding_dedup._meet(one, other, centre, 0.45, 0.9)
        np.add.at(links, np.asarray(out["rep"]), np.asarray(out["links"]))
    assert links.tolist() == [r[1] for r in want]
