"""Prefix trie of rebuilt conversations, rolled up in depth bands.

Turns are reduced to a digest and a length while their texts are read; all later rows are narrow. Range
buckets on (conversation, turn) number the turns, so a conversation with a third of all rows spans many
tasks. A node (a sequence of turns) is known by the exclusive or of one 128-bit hash per turn and
place: prefixes of a conversation are running sums of these, taken inside bands of ``BAND`` turns and
then over bands of bands, so no group holds more than ``BAND`` rows.

Rollup: a node sends its figures to its ancestors within its band of depths only, at most ``BAND``
rows. Band roots then carry their band's total in a trie of their own, ``BAND`` times as flat, which is
rolled up the same way; what a band root has in all goes to the nodes of the band above it, at most
``BAND`` again. Rounds grow with the logarithm of the depth, rows with ``BAND`` a node.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import join_spread, ship_package, written

BAND = 16
FAMILY = 5
HEADS = 9
BUCKET_TURNS = 65_536
CHUNK_IDS = 16_384

_KEY = ["h1", "h2", "depth"]


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation, with their task and their place among its rows of the conversation."""
    from pyspark import TaskContext

    part, last, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        conv = np.asarray(batch["conv_id"])
        if not len(conv):
            continue
        start = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
        place = np.arange(len(conv)) - np.repeat(start, np.diff(np.r_[start, len(conv)])) + 1
        if last is not None and conv[0] == last:
            place[:start[1] if len(start) > 1 else len(conv)] += seen
        last, seen = conv[-1], int(place[-1])
        yield pa.RecordBatch.from_arrays(
            [batch["conv_id"], batch["d1"], batch["d2"], batch["bytes"], pa.array(np.full(len(conv), part, np.int32)),
             pa.array(place.astype(np.int64))], ["conv_id", "d1", "d2", "bytes", "part", "place"])


def _word(digest: Column, at: int) -> Column:
    """Eight bytes of a hexadecimal digest as a signed number."""
    high = F.conv(F.substring(digest, at, 8), 16, 10).cast("long")
    return F.shiftleft(high, 32).bitwiseOR(F.conv(F.substring(digest, at + 8, 8), 16, 10).cast("long"))


def numbered_turns(conversations: DataFrame, bucket_turns: int) -> DataFrame:
    """``(conv_id, pos, d1, d2, bytes)``: every turn with its place (from 1) in its conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.filter("conv_id IS NOT NULL").select(
        "conv_id", "turn", F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"))
    narrow = written(turns.select("conv_id", "turn", _word(F.col("digest"), 1).alias("d1"),
                                  _word(F.col("digest"), 17).alias("d2"), "bytes",
                                  F.monotonically_increasing_id().alias("row")), "trie-turns")
    order = ["conv_id", "turn", "d1", "d2", "row"]  # the row number keeps equal rows divisible
    buckets = max(1, math.ceil(narrow.count() / bucket_turns))
    ranged = narrow.repartitionByRange(buckets, *order).sortWithinPartitions(*order)
    placed = written(ranged.mapInArrow(_numbered, "conv_id long, d1 long, d2 long, bytes long, part int, place long"),
                     "trie-places")
    # What a conversation has in the buckets before: only one that spans buckets has any, one row a bucket.
    spans = placed.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    carried = spans.withColumn("carry", before).filter("carry IS NOT NULL").select("conv_id", "part", "carry")
    return placed.join(F.broadcast(carried), ["conv_id", "part"], "left").select(
        "conv_id", (F.col("place") + F.coalesce("carry", F.lit(0))).alias("pos"), "d1", "d2", "bytes")


def _heads(conv_id: Column) -> Column:
    """How many turns of its family's first conversation a conversation takes over."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % F.lit(HEADS)).cast("long")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(conv_id, depth, bytes, t1, t2)`` for every rebuilt turn, and ``(conv_id, length)`` of each conversation."""
    first = F.col("conv_id") - F.col("conv_id") % FAMILY
    lead = turns.filter((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < HEADS)).groupBy(F.col("conv_id").alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "d1", "d2", "bytes"))).alias("lead"))  # at most HEADS - 1 turns
    known = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).withColumn("base", first)
    known = known.join(lead, "base", "left").withColumn("h", _heads(F.col("conv_id")))
    taken = F.slice(F.coalesce("lead", F.array().cast("array<struct<pos:bigint,d1:bigint,d2:bigint,bytes:bigint>>")),
                    F.lit(1), F.col("h").cast("int"))
    info = written(known.select("conv_id", "n", "h", taken.alias("taken"))
                   .withColumn("shift", F.size("taken") - F.col("h")), "trie-conversations")
    total = max(int(info.agg(F.sum("n")).first()[0] or 0), 1)
    own = join_spread(turns.filter(F.col("pos") > _heads(F.col("conv_id"))), info.select("conv_id", "shift", "n"),
                      ["conv_id"], "n", total)
    rows = own.select("conv_id", (F.col("pos") + F.col("shift")).alias("depth"), "d1", "d2", "bytes").unionByName(
        info.select("conv_id", F.explode("taken").alias("t")).select("conv_id", F.col("t.pos").alias("depth"), "t.d1", "t.d2", "t.bytes"))
    rows = rows.select("conv_id", "depth", "bytes", F.xxhash64("d1", "d2", "depth").alias("t1"),
                       F.xxhash64("d2", "depth", "d1", F.lit(1)).alias("t2"))
    lengths = info.select("conv_id", (F.col("n") + F.col("shift")).alias("length"), F.size("taken").cast("long").alias("least"))
    return rows, lengths.select("conv_id", F.greatest("length", "least").alias("length"))


def _prefixes(rows: DataFrame, place: str, values: list[str], deepest: int, band: int) -> DataFrame:
    """``rows`` with running exclusive ors ``p_<value>`` over ``place`` (from 0) in each conversation."""
    block = F.floor(F.col(place) / band)
    inside = Window.partitionBy("conv_id", "_block").orderBy(place)
    rows = rows.withColumn("_block", block)
    here = rows.select("*", *[F.bit_xor(v).over(inside).alias(f"p_{v}") for v in values])
    if deepest < band:
        return here.drop("_block")
    totals = rows.groupBy("conv_id", F.col("_block").alias("_at")).agg(*[F.bit_xor(v).alias(v) for v in values])
    above = _prefixes(totals, "_at", values, deepest // band, band)
    above = above.select("conv_id", (F.col("_at") + 1).alias("_block"), *[F.col(f"p_{v}").alias(f"_{v}") for v in values])
    later = here.filter("_block > 0").join(above, ["conv_id", "_block"]).select(
        *[(F.col(f"p_{c[2:]}").bitwiseXOR(F.col(f"_{c[2:]}")).alias(c) if c in [f"p_{v}" for v in values] else F.col(c))
          for c in here.columns])
    return here.filter("_block = 0").unionByName(later).drop("_block")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over each node's chunks of ids, which arrive in order."""
    node, digest = None, None

    def out(done):
        return pa.RecordBatch.from_pylist([{"h1": k[0], "h2": k[1], "depth": k[2], "ends_sha256": d.hexdigest()} for k, d in done],
                                          schema=pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("depth", pa.int64()),
                                                            ("ends_sha256", pa.string())]))

    for batch in batches:
        done = []
        for key, ids in zip(zip(*(batch[c].to_pylist() for c in _KEY)), batch["ids"].to_pylist()):
            if key == node:
                digest.update(b"," + ids.encode())
            else:
                if node is not None:
                    done.append((node, digest))
                node, digest = key, hashlib.sha256(ids.encode())
        yield out(done)
    if node is not None:
        yield out([(node, digest)])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of at most ``CHUNK_IDS`` ids of one node, joined by commas."""
    for batch in batches:
        keys = [np.asarray(batch[c]) for c in _KEY]
        conv = np.asarray(batch["conv_id"])
        if not len(conv):
            continue
        new = np.r_[True, np.any([k[1:] != k[:-1] for k in keys], axis=0)]
        at = np.flatnonzero(new)
        ends = np.r_[at[1:], len(conv)]
        starts = np.concatenate([np.arange(a, b, CHUNK_IDS) for a, b in zip(at, ends)])
        stops = np.r_[starts[1:], len(conv)]
        text = conv.astype(str)
        ids = [",".join(text[a:b]) for a, b in zip(starts, stops)]
        yield pa.RecordBatch.from_arrays([*[pa.array(k[starts]) for k in keys], pa.array(conv[starts]), pa.array(ids, pa.string())],
                                         [*_KEY, "first", "ids"])


def end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending ids of ``ends(conv_id, h1, h2, depth)`` by node.

    Sorted ranges turn into chunks of ids, many tasks to a node; only the chunks of one node (a row for
    ``CHUNK_IDS`` ids) go through its digest in order, one at a time.
    """
    order = [*_KEY, "conv_id"]
    chunks = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _chunks, "h1 long, h2 long, depth long, first long, ids string")
    return (chunks.repartition(*_KEY).sortWithinPartitions(*_KEY, "first")
            .mapInArrow(_digests, "h1 long, h2 long, depth long, ends_sha256 string"))


def _rolled(nodes: DataFrame, paths: DataFrame, unit: int, deepest: int, band: int, values: list[str]) -> DataFrame:
    """``(h1, h2, depth, values)``: sums over the subtrees of ``nodes(h1, h2, depth, rep, values)``.

    Depths are multiples of ``unit``; ``paths(conv_id, depth, h1, h2)`` holds the nodes on the way to each
    conversation's end. Nodes explode to their ancestors within one band; the totals of band roots are
    completed one level up and then go to the band above each root.
    """
    wide = unit * band
    sums = [F.sum(v).alias(v) for v in values]
    steps = paths.filter(F.col("depth") % unit == 0).groupBy(
        F.col("conv_id").alias("rep"), F.floor(F.col("depth") / wide).alias("_band")).agg(
        F.collect_list(F.struct(*_KEY)).alias("_way"))  # at most ``band`` entries
    inside = (nodes.withColumn("_band", F.floor(F.col("depth") / wide)).join(steps, ["rep", "_band"], "left")
              .withColumn("_to", F.explode(F.concat(F.array(F.struct(*_KEY)), F.coalesce(
                  F.filter("_way", lambda s: s["depth"] < F.col("depth")), F.array().cast(steps.schema["_way"].dataType))))))
    total = written(inside.groupBy("_to").agg(*sums).select("_to.*", *values), "trie-band")
    if deepest < wide:
        return total
    roots = nodes.filter(F.col("depth") % wide == 0).select(*_KEY, "rep").join(total, _KEY)
    whole = _rolled(roots, paths, wide, deepest, band, values)
    upward = (whole.filter("depth > 0").join(roots.select(*_KEY, "rep"), _KEY)
              .withColumn("_band", F.floor(F.col("depth") / wide) - 1).join(steps, ["rep", "_band"])
              .withColumn("_to", F.explode("_way")).groupBy("_to").agg(*sums).select("_to.*", *values))
    return written(total.unionByName(upward).groupBy(*_KEY).agg(*sums), "trie-total")


def prefix_trie(conversations: DataFrame, band: int = BAND, bucket_turns: int = BUCKET_TURNS) -> DataFrame:
    """Nodes of the prefix trie of ``conversations(conv_id, turn, role, text)`` after rebuilding.

    One row a node: conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256. A null role or text counts as empty; turns are
    ordered null first, rows of one turn by the digest of their role and text, and repeated rows stay;
    rows without a conv_id belong to no conversation and are ignored. Conversations without a turn are
    members of the root alone. Texts and conversations of any length are read whole. Other columns are
    not read. An empty table gives an empty result. Two sequences share a node's 128-bit hash with odds
    of 2**-128.
    """
    ship_package(conversations.sparkSession)
    turns = numbered_turns(conversations, bucket_turns)
    rows, lengths = rebuilt(turns)
    rows = written(rows, "trie-rebuilt")
    lengths = written(lengths, "trie-lengths")
    n_convs, smallest, deepest = lengths.agg(F.count(F.lit(1)), F.min("conv_id"), F.max("length")).first()
    deepest = int(deepest or 0)
    placed = _prefixes(rows.withColumn("place", F.col("depth") - 1), "place", ["t1", "t2"], deepest, band)
    paths = written(placed.select("conv_id", "depth", "bytes", F.col("p_t1").alias("h1"), F.col("p_t2").alias("h2"),
                                  F.col("p_t1").bitwiseXOR(F.col("t1")).alias("q1"), F.col("p_t2").bitwiseXOR(F.col("t2")).alias("q2")),
                    "trie-paths")
    zero = F.lit(0).cast("long")
    root = lengths.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("rep")).filter("n_convs > 0").select(
        zero.alias("h1"), zero.alias("h2"), zero.alias("depth"), "rep", "n_convs", zero.alias("bytes"),
        F.lit(None).cast("long").alias("q1"), F.lit(None).cast("long").alias("q2"))
    nodes = paths.groupBy(*_KEY).agg(
        F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("n_convs"), F.min("bytes").alias("bytes"),
        F.min("q1").alias("q1"), F.min("q2").alias("q2")).select(*root.columns)
    nodes = written(nodes.unionByName(root), "trie-nodes")
    children = nodes.filter("depth > 0").groupBy(F.col("q1").alias("h1"), F.col("q2").alias("h2"),
                                                 (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    full = written(nodes.join(children, _KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
                   .withColumn("n_leaves", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"))
                   .withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("bytes")), "trie-full")
    sums = ["n_leaves", "saved_tokens"]
    # the root is on the way of every conversation that has a turn
    ways = paths.select("conv_id", *_KEY).unionByName(
        lengths.filter("length > 0").select("conv_id", zero.alias("h1"), zero.alias("h2"), zero.alias("depth")))
    totals = _rolled(full.select(*_KEY, "rep", *sums), ways, 1, deepest, band, sums)
    ends = (lengths.filter("length > 0").select("conv_id", F.col("length").alias("depth"))
            .join(paths.select("conv_id", *_KEY), ["conv_id", "depth"]).select("conv_id", *_KEY)
            .unionByName(lengths.filter("length = 0").select("conv_id", zero.alias("h1"), zero.alias("h2"), zero.alias("depth"))))
    digests = end_digests(ends)
    out = full.drop(*sums).join(totals, _KEY).join(digests, _KEY, "left")
    parents = full.filter("n_children > 0").select(F.col("h1").alias("q1"), F.col("h2").alias("q2"), (F.col("depth") + 1).alias("depth"),
                                                   F.col("rep").alias("parent_conv_id"), F.col("n_children").alias("w"))
    n_nodes = max(full.count(), 1)
    linked = join_spread(out.filter("depth > 0"), parents, ["q1", "q2", "depth"], "w", n_nodes).unionByName(
        out.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long")))
    return linked.select(F.col("rep").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                         "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def prefix_trie_sql() -> str:
    """The same rows as DuckDB SQL, with whole sequences as keys and every node joined to its ancestors."""
    return """
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
             PARTITION BY conv_id ORDER BY turn NULLS FIRST,
             sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
           FROM conversations WHERE conv_id IS NOT NULL),
g AS (SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY pos) AS turns FROM t GROUP BY conv_id),
c AS (SELECT conv_id, turns, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
        lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                                 lambda p, q: xor(p >> 1, (p & 1) * 3988292384)))) % 9 AS h FROM g),
r AS (SELECT c.conv_id, list_concat(coalesce(b.turns, [])[1:c.h], c.turns[c.h + 1:]) AS turns
      FROM c LEFT JOIN g AS b ON b.conv_id = c.conv_id - c.conv_id % 5),
p AS (SELECT conv_id, d AS depth, turns[1:d] AS path, turns[d].text AS last, d = len(turns) AS ends
      FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM r) AS x),
n AS (SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(any_value(strlen(last)), 0) AS bytes,
             coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ids
      FROM p GROUP BY depth, path),
k AS (SELECT a.depth, a.path, count(b.path) AS n_children FROM n AS a LEFT JOIN n AS b
      ON b.depth = a.depth + 1 AND b.path[1:a.depth] = a.path GROUP BY a.depth, a.path),
f AS (SELECT n.*, k.n_children FROM n JOIN k USING (depth, path)),
u AS (SELECT depth, path, n_children = 0 AS leaf, (n_convs - 1) * bytes AS saved, unnest(range(0, depth + 1)) AS up FROM f),
s AS (SELECT up AS depth, path[1:up] AS path, count(*) FILTER (WHERE leaf) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
      FROM u GROUP BY 1, 2)
SELECT f.conv_id, f.depth, q.conv_id AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves, s.saved_tokens,
       sha256(f.ids) AS ends_sha256
FROM f JOIN s ON s.depth = f.depth AND s.path = f.path
LEFT JOIN f AS q ON q.depth = f.depth - 1 AND q.path = f.path[1:f.depth - 1]"""
