"""Near-duplicate vectors: spherical k-means cells, blocked cosine products, one kept per group.

Vectors lie in blocks of bounded size in the order of their cells, one packed row a block. Blocks meet in a
product of the block table with itself, each pair once, so a vector is stored and shuffled a fixed number
of times, however many others it must be compared with: the work may be quadratic, the disk isn't.

Cells only decide which pairs need no product, never whether they are linked: for unit vectors, cosine >= t
means a distance of at most r = sqrt(2 - 2t). If x lies in cell A and y in cell B, their distances from
the plane between the centres add up to r at most, or they are no link. Blocks whose cells are out of reach of each
other don't meet, and within a pair of blocks neither do such cells, nor vectors far from the plane between two.
Clustered data skip most pairs so; data without any structure skip none, and then cost what comparing all
pairs costs.

A product takes the leading components first: with the basis fitted on the sample, x . y is at most the product of
the first components plus that of the lengths of the rests (Cauchy-Schwarz). What passes is computed whole in
double precision. Equal vectors are one class from the start. A pair of blocks returns per vector its number of links
and one link to the first member of its local group, never the pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import freeing, join_spread, ragged, roots, ship_package, written
from tierline.llm.components import connected_components

MIN_COSINE = 0.9
CELL_VECTORS = 256
MAX_CELLS = 4096
SAMPLE_VECTORS = 16384
BLOCK_VECTORS = 1024  # at least, if they fit BLOCK_BYTES; more for larger tables
BLOCK_BYTES = 4 << 20
SIDE_BYTES = 48 << 20  # of blocks that a task of the product holds at once
BASIS_VECTORS = 1024
HELD_LINKS = 1 << 20
TILE = (512, 1024)  # vectors of a product: its scores stay in the processor's cache
KINDS = {"array<float>": np.float32, "array<double>": np.float64}
ROUNDS = 8


def unit_length(x: np.ndarray) -> np.ndarray:
    """The rows of ``x`` at unit length, in double precision."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that no square overflows or vanishes
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def raw_rows(vectors: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Vectors of ``dim`` components each as rows."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
        vectors = pa.concat_arrays(vectors.chunks) if isinstance(vectors, pa.ChunkedArray) else vectors
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), dim)


def unit_rows(vectors: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Vectors of ``dim`` components each as rows of unit length, in double precision."""
    return unit_length(raw_rows(vectors, dim))


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 7) -> np.ndarray:
    """``k`` unit centres of the unit rows ``x`` (fewer if ``x`` has fewer rows)."""
    rng = np.random.default_rng(seed)
    k = min(k, len(x))
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        own = np.concatenate([(x[a:a + 4096] @ centres.T).argmax(1) for a in range(0, len(x), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norm > 1e-12, sums / np.maximum(norm, 1e-12), centres)
    return centres


def _heads(x: np.ndarray, basis: np.ndarray | None) -> np.ndarray:
    """The unit rows' components along ``basis`` and the length of the rest: their products bound the rows' own."""
    if basis is None:
        return x.astype(np.float32)
    head = x @ basis
    rest = np.sqrt(np.maximum(1 - np.einsum("ij,ij->i", head, head), 0))
    return np.concatenate([head, rest[:, None]], axis=1).astype(np.float32)


def fit_basis(x: np.ndarray, threshold: float) -> np.ndarray | None:
    """The fewest leading directions of the unit rows ``x`` by which few pairs of them pass that aren't
    linked; None if that takes most of them. It decides the amount of work only."""
    dim = x.shape[1]
    if len(x) < 2:
        return None
    directions = np.linalg.svd(x[:BASIS_VECTORS], full_matrices=False)[2].T
    others = x[-BASIS_VECTORS:]  # tried on those, as directions suit the rows they are fitted on better than the rest
    linked = np.count_nonzero(others @ others.T >= threshold)
    for h in range(7, min(directions.shape[1], dim * 3 // 4), 8):
        heads = _heads(others, directions[:, :h])
        if np.count_nonzero(heads @ heads.T >= threshold) - linked <= 2e-6 * len(others) ** 2:
            return np.ascontiguousarray(directions[:, :h])
    return None


def _gaps(centres: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Distances of ``some`` of the centres to all."""
    return np.sqrt(np.maximum(2 - 2 * centres[some] @ centres.T, 0))


def _place(batches, centres: np.ndarray, dim: int):
    """Each vector's cell: the nearest centre's. Vectors of another length: minus their length."""
    for batch in batches:
        lengths = np.asarray(batch["embedding"].value_lengths()).astype(np.int32)
        cell = -lengths
        same = np.flatnonzero(lengths == dim)
        for a in range(0, len(same), 4096):
            at = same[a:a + 4096]
            cell[at] = (unit_rows(batch["embedding"].take(pa.array(at)), dim) @ centres.T).argmax(1)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lengths), pa.array(cell)],
                                         [*batch.schema.names, "d", "cell"])


def _pack(table: pa.Table, centres: np.ndarray, reach: float) -> pa.Table:
    """One block's vectors in the order of their cells as one row, with its cells and those within reach."""
    cell, rep = np.asarray(table["cell"]), np.asarray(table["rep"])
    order = np.lexsort((rep, cell))
    cell, rep, mult = cell[order], rep[order], np.asarray(table["mult"])[order]
    dim = table["d"][0].as_py()
    raw = np.ascontiguousarray(raw_rows(table["embedding"], dim)[order])
    cells, starts = np.unique(cell, return_index=True)
    visits = cells
    if cells[0] >= 0:
        x, least = unit_length(raw), np.full(len(centres), False)
        for c, gaps, a, b in zip(cells, _gaps(centres, cells), starts, [*starts[1:], len(cell)]):
            for s in range(a, b, 1024):
                dots = x[s:min(s + 1024, b)] @ centres.T
                least |= (dots[:, c][:, None] - dots).min(0) <= reach * gaps + 1e-9
        visits = np.flatnonzero(least)
    one = {"no": table["no"][0].as_py(), "d": dim, "cells": cells.tolist(), "visits": visits.tolist(),
           "rep": rep.astype(np.int64).tobytes(), "mult": mult.astype(np.int64).tobytes(),
           "cell": cell.astype(np.int32).tobytes(), "x": raw.tobytes()}
    return pa.table({k: pa.array([v], _BLOCK.field(k).type) for k, v in one.items()})


_BLOCK = pa.schema([("no", pa.int64()), ("d", pa.int32()), ("cells", pa.list_(pa.int32())), ("visits", pa.list_(pa.int32())),
                    ("rep", pa.binary()), ("mult", pa.binary()), ("cell", pa.binary()), ("x", pa.binary())])
_BLOCK_DDL = "no long, d int, cells array<int>, visits array<int>, rep binary, mult binary, cell binary, x binary"


class _Block:
    """A packed row, ready for products."""

    def __init__(self, batch: pa.RecordBatch, row: int, side: str, kind, centres: np.ndarray, basis):
        def values(name, dtype):
            return np.frombuffer(batch[side + name][row].as_buffer(), dtype)

        self.rep, self.mult, cell = values("rep", np.int64), values("mult", np.int64), values("cell", np.int32)
        self.x = unit_length(values("x", kind).reshape(len(cell), -1))
        self.cells, starts = np.unique(cell, return_index=True)
        self.cuts = np.append(starts, len(cell))
        self.placed = bool(self.cells[0] >= 0)
        self.heads = _heads(self.x, basis if self.placed else None)
        self.turned = np.ascontiguousarray(self.heads.T)
        self.own = np.einsum("ij,ij->i", self.x, centres[cell]) if self.placed else None


def _some(values: np.ndarray, at: np.ndarray, axis: int = 0) -> np.ndarray:
    """The ``values`` at ascending places along ``axis``; not copied if those run on."""
    if at[-1] - at[0] + 1 == len(at):
        return values[at[0]:at[-1] + 1] if axis == 0 else values[:, at[0]:at[-1] + 1]
    return np.take(values, at, axis)


def _true(flat: np.ndarray) -> np.ndarray:
    """Places of the few true ones, eight at a time."""
    even = len(flat) // 8 * 8
    at = np.flatnonzero(flat[:even].view(np.uint64))
    some, bit = np.nonzero(flat[:even].reshape(-1, 8)[at])
    return np.concatenate([at[some] * 8 + bit, np.flatnonzero(flat[even:]) + even])


class _Links:
    """Links found in a pair of blocks: their number for each vector, and groups instead of the pairs."""

    def __init__(self, a: _Block, b: _Block):
        self.shift = 0 if a is b else len(a.rep)  # of b's rows behind a's
        self.rep, self.mult = (a.rep, a.mult) if a is b else (np.concatenate([a.rep, b.rep]), np.concatenate([a.mult, b.mult]))
        self.count = np.zeros(len(self.rep))
        self.edges, self.held, self.n = (np.zeros(0, int), np.zeros(0, int)), [], 0

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        if len(i):
            self.held.append((i, j + self.shift))
            self.n += len(i)
            if self.n > HELD_LINKS:
                self.flush()

    def flush(self) -> None:
        if self.held:
            i, j = (np.concatenate(p) for p in zip(*self.held))
            for at, to in ((i, j), (j, i)):
                self.count += np.bincount(at, weights=self.mult[to], minlength=len(self.rep))
            root = roots(len(self.rep), np.concatenate([self.edges[0], i]), np.concatenate([self.edges[1], j]))
            moved = np.flatnonzero(root != np.arange(len(root)))
            self.edges, self.held, self.n = (moved, root[moved]), [], 0

    def result(self) -> pa.RecordBatch:
        self.flush()
        order = np.argsort(self.rep, kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        root = self.rep[order][roots(len(rank), rank[self.edges[0]], rank[self.edges[1]])][rank]
        hit = self.count > 0
        return pa.RecordBatch.from_arrays([pa.array(self.rep[hit]), pa.array(self.count[hit].astype(np.int64)),
                                           pa.array(root[hit])], ["rep", "links", "root"])


def _compare(a: _Block, b: _Block, rows: np.ndarray, cols: np.ndarray, threshold: float, links: _Links) -> None:
    """Add the links of a's ``rows`` with b's ``cols``; of one block, those of a row with later columns."""
    slack = 1e-4 + 2e-7 * a.x.shape[1]  # above what single precision loses
    left, right = _some(a.heads, rows), _some(b.turned, cols, 1)
    scores = np.empty(min(len(rows), TILE[0]) * min(len(cols), TILE[1]), np.float32)
    passed = np.empty(len(scores), bool)
    for s in range(0, len(rows), TILE[0]):
        for u in range(0, len(cols), TILE[1]):
            r, c = rows[s:s + TILE[0]], cols[u:u + TILE[1]]
            if a is b and c[-1] <= r[0]:
                continue
            tile = scores[:len(r) * len(c)].reshape(len(r), len(c))
            np.matmul(left[s:s + TILE[0]], right[:, u:u + TILE[1]], out=tile)
            at = _true(np.greater_equal(tile.ravel(), np.float32(threshold - slack), out=passed[:tile.size]))
            if not len(at):
                continue
            if len(at) > len(r) * len(c) // 64:  # many pass: whole products of all, and doubles for the close ones only
                whole = a.x[r].astype(np.float32) @ b.x[c].astype(np.float32).T
                sure = np.nonzero(whole >= np.float32(threshold + slack))
                near = np.nonzero((whole >= np.float32(threshold - slack)) & (whole < np.float32(threshold + slack)))
            else:
                sure, near = None, np.divmod(at, len(c))
            for pair, certain in ((sure, True), (near, False)):
                if pair is None:
                    continue
                i, j = r[pair[0]], c[pair[1]]
                if a is b:
                    i, j = i[i < j], j[i < j]
                if not certain:
                    ok = np.concatenate([np.einsum("ij,ij->i", a.x[i[k:k + 8192]], b.x[j[k:k + 8192]]) >= threshold
                                         for k in range(0, len(i), 8192)] or [np.zeros(0, bool)])
                    i, j = i[ok], j[ok]
                links.add(i, j)


def _meet(a: _Block, b: _Block, centres: np.ndarray, reach: float, threshold: float) -> pa.RecordBatch:
    """Links between two blocks, or within one: each cell of one with those of the other within reach. Where that leaves
    under a quarter of two cells' pairs, only the vectors near the plane between them are compared."""
    links = _Links(a, b)
    if not a.placed:  # all of one length, which is their cell
        _compare(a, b, np.arange(len(a.rep)), np.arange(len(b.rep)), threshold, links)
        return links.result()
    far_a = a.own[:, None] - a.x @ centres[b.cells].T  # distances from the planes, times those of the centres
    far_b = b.own[:, None] - b.x @ centres[a.cells].T
    least_a, least_b = np.minimum.reduceat(far_a, a.cuts[:-1]), np.minimum.reduceat(far_b, b.cuts[:-1]).T
    most = reach * _gaps(centres, a.cells)[:, b.cells] + 1e-9
    same = a.cells[:, None] == b.cells
    meet = (least_a + least_b <= most) | same
    if a is b:
        meet = np.triu(meet)
    in_a, in_b = np.diff(a.cuts), np.diff(b.cuts)
    near_a, near_b = far_a <= np.repeat(most - least_b, in_a, axis=0), far_b <= np.repeat((most - least_a).T, in_b, axis=0)
    left = np.add.reduceat(near_a, a.cuts[:-1], dtype=int) * np.add.reduceat(near_b, b.cuts[:-1], dtype=int).T
    few = meet & ~same & (4 * left < in_a[:, None] * in_b)
    whole, m = meet & ~few, 0
    while m < len(a.cells):
        end = m + 1
        while end < len(a.cells) and np.array_equal(whole[end], whole[m]):  # cells that meet the same others go together
            end += 1
        to = np.flatnonzero(whole[m])
        if len(to):
            _compare(a, b, np.arange(a.cuts[m], a.cuts[end]), ragged(b.cuts[to], in_b[to]), threshold, links)
        m = end
    for m, k in zip(*np.nonzero(few & (left > 0))):
        rows, cols = np.arange(a.cuts[m], a.cuts[m + 1]), np.arange(b.cuts[k], b.cuts[k + 1])
        _compare(a, b, rows[near_a[rows, k]], cols[near_b[cols, m]], threshold, links)
    return links.result()


def _products(batches, kind, centres: np.ndarray, basis, reach: float, threshold: float):
    """Links of each pair of blocks; a block in several pairs running is made ready once."""
    ready: dict[tuple, _Block] = {}
    for batch in batches:
        for row in range(batch.num_rows):
            keys = [(batch["a_d"][row].as_py(), batch[f"{s}_no"][row].as_py()) for s in "ab"]
            ready = {k: ready[k] for k in keys if k in ready}
            for side, key in zip("ab", keys):
                if key not in ready:
                    ready[key] = _Block(batch, row, f"{side}_", kind, centres, basis)
            yield _meet(ready[keys[0]], ready[keys[1]], centres, reach, threshold)


def near_vectors(vectors: DataFrame, min_cosine: float = MIN_COSINE, cell_vectors: int = CELL_VECTORS,
                 block_vectors: int | None = None, sample_vectors: int = SAMPLE_VECTORS) -> DataFrame:
    """Link the vectors of ``vectors(vec_id, embedding)`` with cosine >= ``min_cosine``; exact.

    One row per input row: vec_id, n_links, component_id, kept. Vectors that are null, empty, all
    zero or hold a null or non-finite component link with nothing, as do vectors of different
    lengths with each other. A null id keeps a null ``component_id``, links with nothing and is kept.
    An id that repeats stands for its rows' links together. The centres and the basis are fitted on at most
    ``sample_vectors`` distinct vectors (those with the smallest hash); they decide the amount of
    work only. ``block_vectors`` is about how many vectors a block has (unset: by their number and size).
    Other columns are not read. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    x = F.col("embedding")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    fine = F.coalesce((F.size(x) > 0) & ~bad & F.exists(x, lambda v: v != 0) & F.col("vec_id").isNotNull(), F.lit(False))
    ddl = dict(vectors.dtypes)["embedding"]
    ddl = ddl if ddl in KINDS else "array<double>"
    kind = KINDS[ddl]
    base = vectors.select("vec_id", F.when(fine, x).cast(ddl).alias("embedding"))
    base = base.withColumn("k1", F.xxhash64("embedding")).withColumn("k2", F.hash("embedding"))
    rows = written(base.select("vec_id", F.col("embedding").isNotNull().alias("fine"), F.size("embedding").alias("d"), "k1", "k2"),
                   "vectors")
    base = base.filter("embedding is not null")
    hashes = written(rows.filter("fine").select("d", "k1", "k2").distinct(), "vector-hashes")
    n, total = hashes.count(), max(rows.count(), 1)
    dims = hashes.groupBy("d").count().orderBy(F.desc("count"), "d").first()
    dim = dims["d"] if dims else 1
    picked = (hashes.filter(F.col("d") == dim).orderBy(F.xxhash64("k1", "k2"), "k1", "k2").limit(sample_vectors)
              .select("k1", "k2"))
    sample = (base.filter(F.size("embedding") == dim).join(F.broadcast(picked), ["k1", "k2"], "left_semi")
              .groupBy("k1", "k2").agg(F.min("embedding").alias("embedding")).orderBy(F.xxhash64("k1", "k2"), "k1", "k2")
              .select("embedding").toArrow())
    fitted = unit_rows(sample["embedding"], dim) if sample.num_rows else np.zeros((0, dim))
    k = min(MAX_CELLS, max(1, math.ceil(n / cell_vectors)))
    centres = spherical_kmeans(fitted, k) if len(fitted) else fitted
    basis = fit_basis(fitted, min_cosine)
    reach = math.sqrt(max(2 - 2 * min_cosine, 0)) + 1e-9

    classes = written(base.groupBy("k1", "k2", "embedding").agg(F.min("vec_id").cast("long").alias("rep"), F.count(F.lit(1)).alias("mult"))
                      .mapInArrow(lambda it: _place(it, centres, dim),
                                  f"k1 long, k2 int, embedding {ddl}, rep long, mult long, d int, cell int"), "vector-classes")
    limit = block_vectors or max(BLOCK_VECTORS, math.ceil(n / 16))
    size = F.greatest(F.lit(1), F.least(F.lit(limit), F.floor(F.lit(BLOCK_BYTES) / (F.col("d") * np.dtype(kind).itemsize))))
    cells = classes.groupBy("d", "cell").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("d").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
    cells = cells.select("d", "cell", "_n", F.coalesce(before, F.lit(0)).alias("_from"), size.alias("_size"))
    place = F.col("_from") + F.pmod(F.xxhash64("rep"), F.col("_n"))  # in the order of cells; large cells are cut by hash
    blocks = written(classes.join(F.broadcast(cells), ["d", "cell"])
                     .select("rep", "mult", "embedding", "d", "cell", F.floor(place / F.col("_size")).alias("no"))
                     .groupBy("d", "no").applyInArrow(lambda t: _pack(t, centres, reach), _BLOCK_DDL), "vector-blocks")
    count, held = blocks.agg(F.count(F.lit(1)), F.sum(F.octet_length("x"))).first()
    parts = max(1, min(count, max(8, math.ceil((held or 0) / SIDE_BYTES),
                                  math.ceil(2 * math.sqrt(spark.sparkContext.defaultParallelism)))))
    dealt = blocks.repartitionById(parts, F.pmod(F.col("no") + F.col("d"), F.lit(parts)).cast("int"))
    a, b = (dealt.select(*(F.col(c).alias(f"{side}_{c}") for c in blocks.columns)) for side in "ab")
    even = (F.col("a_no") + F.col("b_no")) % 2 == 0
    once = F.when(even, F.col("a_no") <= F.col("b_no")).otherwise(F.col("a_no") > F.col("b_no"))
    near = F.arrays_overlap("a_visits", "b_cells") & F.arrays_overlap("b_visits", "a_cells")
    pairs = a.join(b.hint("shuffle_replicate_nl"), (F.col("a_d") == F.col("b_d")) & once & near)
    needed = [f"{s}_{c}" for s in "ab" for c in ("no", "d", "rep", "mult", "cell", "x")]
    links = written(pairs.select(*needed).mapInArrow(
        lambda it: freeing(_products(it, kind, centres, basis, reach, min_cosine)), "rep long, links long, root long"),
        "vector-links")

    counts = links.groupBy("rep").agg(F.sum("links").alias("links"))
    comps = connected_components(links.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    known = (classes.select("k1", "k2", "rep", "mult").join(counts, "rep", "left")
             .join(comps.select(F.col("node").alias("rep"), "component"), "rep", "left")
             .select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"),
                     F.coalesce("component", "rep").alias("component_id"), F.col("mult").alias("w")))
    out = join_spread(rows.filter("fine").select("vec_id", "k1", "k2"), known, ["k1", "k2"], "w", total)
    out = out.select("vec_id", "n_links", "component_id").unionByName(
        rows.filter("not fine").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
