"""Exact top-k inner-product search by KD-trees over shards.

Rows are dealt to shards of bounded size by a hash of their row number. A task builds one shard's
tree: the widest side of a node's tight bounding box is cut at the median until few rows are left. A
query's bound on a box is the largest inner product any point of it can have. Nodes are visited best
bound first, all queries of a batch in step, and a query ends when no open bound reaches its kth score
so far: nothing that could enter the result is skipped, ties included.

First every query searches the shard it lies in; then its kth score goes with it to the other
shards, whose trees it enters only where a bound reaches it. Queries travel in blocks of bounded
size, so a unit of work holds one shard and one block whatever the size of the table.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import ship_package, written

TOP = 20
EVERY = 20
SCALE = 64
SHARD_ROWS = 4096
BLOCK_QUERIES = 8192
LEAF_ROWS = 128
BATCH = 512
NONE = np.iinfo(np.int64).min
_FOUND = "query_row long, query_id long, row long, vec_id long, score long"


def matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as rows of whole numbers (empty lists as a zero each)."""
    vectors = pa.concat_arrays(vectors.chunks)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(vectors), -1) if len(flat) else np.zeros((len(vectors), 1), np.int64)


class BoxTree:
    """A KD-tree over the rows of ``x``, in arrays: boxes, children and each leaf's rows."""

    def __init__(self, x: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.order = np.arange(len(x))
        low, high, child, span = [], [], [], []

        def add(a: int, b: int) -> int:
            part = x[self.order[a:b]]
            low.append(part.min(axis=0))
            high.append(part.max(axis=0))
            child.append(-1)
            span.append((a, b))
            return len(span) - 1

        open_ = [add(0, len(x))] if len(x) else []
        while open_:
            node = open_.pop()
            a, b = span[node]
            width = high[node] - low[node]
            if b - a <= leaf_rows or not width.any():  # equal rows stay together
                continue
            side = int(width.argmax())
            middle = (b - a) // 2
            self.order[a:b] = self.order[a:b][np.argpartition(x[self.order[a:b], side], middle)]
            child[node] = add(a, a + middle)
            open_ += [child[node], add(a + middle, b)]
        self.low, self.high = np.array(low), np.array(high)
        self.child, self.span = np.array(child, np.int64), np.array(span, np.int64).reshape(-1, 2)


def _norm(x: np.ndarray) -> float:
    return float(np.sqrt(np.square(x.astype(np.float64)).sum(axis=1).max())) if x.size else 0.0


def _best(who: np.ndarray, score: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's k best entries: highest score, then first row."""
    order = np.lexsort((row, -score, who))
    start = np.flatnonzero(np.r_[True, who[order][1:] != who[order][:-1]]) if len(order) else np.zeros(0, int)
    length = np.diff(np.r_[start, len(order)])
    rank = np.arange(len(order)) - np.repeat(start, length)
    return order[rank < k]


def search(x: np.ndarray, queries: np.ndarray, own: np.ndarray, kth: np.ndarray, k: int,
           leaf_rows: int = LEAF_ROWS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best rows of ``x`` for each row of ``queries``: arrays (query, row of x, score).

    ``own`` names each query's own row in ``x`` (-1: not here), which is no candidate; ``kth`` is a score
    that k rows elsewhere are known to reach (``NONE``: none), below which nothing is returned. Ties
    go to the smaller row number.
    """
    if not len(x) or not len(queries):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    tree = BoxTree(x, leaf_rows)
    low, high = tree.low.astype(np.float64), tree.high.astype(np.float64)
    wide = np.maximum(np.abs(low), np.abs(high))
    # Whole numbers below 2**52 stay exact in doubles, whatever the order of a sum.
    exact = _norm(wide[:1]) * _norm(queries) < 2.0 ** 51
    kind = np.float64 if exact else np.int64
    xs, qs = x.astype(kind), queries.astype(kind)
    out = [(np.zeros(0, np.int64),) * 3]
    for a in range(0, len(qs), BATCH):
        q = queries[a:a + BATCH].astype(np.float64)
        up, down, size = np.maximum(q, 0), np.minimum(q, 0), np.abs(q)
        n = len(q)
        bounds = np.full((n, len(tree.child)), -np.inf)  # of the open nodes

        def bound(who: np.ndarray, node: np.ndarray) -> np.ndarray:
            b = np.einsum("ij,ij->i", up[who], high[node]) + np.einsum("ij,ij->i", down[who], low[node])
            return b if exact else b + 1e-9 * np.einsum("ij,ij->i", size[who], wide[node])

        limit = kth[a:a + BATCH].astype(np.float64)
        limit[kth[a:a + BATCH] == NONE] = -np.inf

        def least(who: np.ndarray) -> np.ndarray:  # the kth score, less what rounding may have added to it
            return limit[who] if exact else np.where(np.isfinite(limit[who]), limit[who] - 1e-9 * np.abs(limit[who]), -np.inf)

        bounds[:, 0] = bound(np.arange(n), np.zeros(n, np.int64))
        have = (np.zeros(0, np.int64),) * 3  # query of the batch, row, score
        live = np.arange(n)
        while len(live):
            node = bounds[live].argmax(axis=1)
            top = bounds[live, node]
            going = (top > -np.inf) & (top >= least(live))
            live, node = live[going], node[going]
            bounds[live, node] = -np.inf
            child = tree.child[node]
            inner = child >= 0
            for step in (0, 1):
                bounds[live[inner], child[inner] + step] = bound(live[inner], child[inner] + step)
            who, leaf = live[~inner], node[~inner]
            found = [have]
            for one in np.unique(leaf):
                at = who[leaf == one]
                rows = tree.order[tree.span[one, 0]:tree.span[one, 1]]
                scores = qs[a + at] @ xs[rows].T
                fits = scores >= least(at)[:, None]
                fits &= rows[None, :] != own[a + at][:, None]
                i, j = np.nonzero(fits)
                found.append((at[i], rows[j], scores[i, j].astype(np.int64)))
            if len(found) > 1:
                have = tuple(np.concatenate(p) for p in zip(*found))
                best = _best(have[0], have[2], have[1], k)
                have = tuple(p[best] for p in have)
                counts = np.bincount(have[0], minlength=n)
                last = np.cumsum(counts) - 1
                full = counts == k
                limit[full] = np.maximum(limit[full], have[2][last[full]].astype(np.float64))
        out.append((have[0] + a, have[1], have[2]))
    return tuple(np.concatenate(p) for p in zip(*out))


def _unit(table: pa.Table, k: int, leaf_rows: int) -> pa.Table:
    """One shard against its own queries, or against a block of queries of other shards."""
    null_last = pc.fill_null(table["vec_id"], np.iinfo(np.int64).max)
    order = np.lexsort((np.asarray(table["row"]), np.asarray(null_last), np.asarray(table["vec_id"].is_null())))
    table = table.take(pa.array(order))
    x, row = matrix(table["q"]), np.asarray(table["row"])
    member, asks = np.asarray(table["member"]), np.asarray(table["asks"])
    inside, asking = np.flatnonzero(member), np.flatnonzero(asks)
    own = np.where(member[asking], np.searchsorted(inside, asking), -1)
    # Of equal vectors only the first k + 1 rows can be among any k best.
    _, group = np.unique(x[inside], axis=0, return_inverse=True)
    keep = np.sort(_best(group.ravel(), np.zeros(len(inside), np.int64), np.arange(len(inside)), k + 1))
    at = np.full(len(inside) + 1, -1)
    at[keep] = np.arange(len(keep))
    kth = np.asarray(pc.fill_null(table["kth"], NONE))[asking]
    who, hit, score = search(x[inside[keep]], x[asking], at[own], kth, k, leaf_rows)
    rows = inside[keep][hit]
    return pa.table({"query_row": row[asking][who], "query_id": table["vec_id"].take(pa.array(asking[who])),
                     "row": row[rows], "vec_id": table["vec_id"].take(pa.array(rows)), "score": score})


def top_products(vectors: DataFrame, k: int = TOP, every: int = EVERY, scale: int = SCALE,
                 shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """The ``k`` largest inner products of every row whose vec_id is divisible by ``every`` with all other rows.

    Components become floor(scale * x) in double precision. Returns query_id, rank (from 1), vec_id, score;
    ties go to the smaller vec_id, a null id last. Exact. A vector that is null, holds a null or non-finite
    component, or whose product with itself is 2**63 or more takes no part; vectors meet those of their
    own length only (empty ones meet each other with score 0). Rows that repeat an id are rows of their
    own: each asks for itself (the ranks repeat) and finds the others. Fewer candidates give fewer rows. Other
    columns are not read. An empty table gives an empty result.
    """
    ship_package(vectors.sparkSession)
    wide = F.transform("embedding", lambda v: F.floor(v.cast("double") * F.lit(float(scale))))
    square = F.aggregate("embedding", F.lit(0.0), lambda acc, v: acc + F.pow(F.floor(v.cast("double") * F.lit(float(scale)))
                                                                             .cast("double"), F.lit(2.0)))
    bad = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    fine = F.coalesce(~bad & (square < 2.0 ** 63), F.lit(False))
    rows = written(vectors.select("vec_id", F.when(fine, wide).alias("q")).filter("q IS NOT NULL").select(
        F.monotonically_increasing_id().alias("row"), "vec_id", "q", F.size("q").alias("dim"),
        F.coalesce(F.col("vec_id") % every == 0, F.lit(False)).alias("asks")), "search-rows")
    n, n_queries = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    shards, blocks = max(1, math.ceil(n / shard_rows)), max(1, math.ceil(n_queries / block_queries))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    none = F.lit(None).cast("long")

    def units(df: DataFrame, *by: str) -> DataFrame:
        return df.groupBy("dim", "shard", *by).applyInArrow(lambda t: _unit(t, k, leaf_rows), _FOUND)

    home = written(units(rows.select("row", "vec_id", "q", "dim", "shard", F.lit(True).alias("member"), "asks",
                                     none.alias("kth"))), "search-home")
    found = home
    if shards > 1:
        # the propagated bound: a query's kth score in its own shard
        kth = home.groupBy("query_row").agg(F.count(F.lit(1)).alias("c"), F.min("score").alias("low")).select(
            F.col("query_row").alias("row"), F.when(F.col("c") >= k, F.col("low")).alias("kth"))
        block = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).cast("int")
        asked = (rows.filter("asks").join(kth, "row", "left").withColumn("block", block)
                 .withColumn("to", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).filter("to <> shard")
                 .select("row", "vec_id", "q", "dim", F.col("to").alias("shard"), F.lit(False).alias("member"),
                         F.lit(True).alias("asks"), "kth", "block"))
        stored = (rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
                  .select("row", "vec_id", "q", "dim", "shard", F.lit(True).alias("member"), F.lit(False).alias("asks"),
                          none.alias("kth"), "block"))
        found = found.unionByName(written(units(asked.unionByName(stored), "block"), "search-others"))
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "row")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def top_products_sql(k: int = TOP, every: int = EVERY, scale: int = SCALE) -> str:
    """The same rows as DuckDB SQL, over all pairs of a query and a row."""
    return f"""
WITH f AS (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
v AS (SELECT r, vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * {scale})) AS q FROM f),
p AS (SELECT a.r, a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score, b.r AS s
      FROM v AS a JOIN v AS b ON a.r <> b.r AND len(a.q) = len(b.q) WHERE a.vec_id % {every} = 0),
t AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST, s) AS n FROM p)
SELECT query_id, n::INTEGER AS rank, vec_id, score FROM t WHERE n <= {k}"""
