"""Near-duplicate texts: circulant MinHash, banding, and exact Jaccard confirmation.

Signature: shingles are numbers x in Z_(2**32). One fixed permutation s breaks their structure; one
fixed permutation p, applied to the circularly shifted values s(x) + k, gives the k-th coordinate
min p(s(x) + k), for all k = 1..K. With 32 bands of 4 coordinates a pair with Jaccard 0.8 shares no
band with odds of (1 - 0.8**4)**32 = 5e-8.

Links are needed for components, not as pairs, so a bucket (documents that agree in a band) is not
expanded into pairs:

1. texts with equal shingle sets are one class from the start;
2. every member of a bucket is compared with the bucket's first member on full sets: as many
   comparisons as members, however large the bucket;
3. members that are in another component than their bucket's largest one after that meet all members
   of the bucket. In buckets of at most ``SMALL_BUCKET`` members these are pairs, where the
   signatures agree enough for a link to be possible (see ``min_agree``). In larger buckets they are
   units of bounded size that count all overlaps of their sets at once and return one link per
   document: per stray, work in proportion to how it differs from what the unit has in common. Links
   found here join components, which are contracted before they are connected.

A class of equal sets has a key of its own; documents are named by their ids only in the result, so an id that
repeats with different texts stands in each of its classes. So two documents that share a bucket are either compared or known to be connected already.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import (
    block_units, freeing, join_spread, mix64, pieces, ragged, roots, ship_package, utf8, written)
from tierline.llm.components import connected_components
from tierline.llm.words import word_hashes

WORDS = 2
PERCENT = 80
BANDS = 32
BAND_ROWS = 4
PIECE_BYTES = 2 << 20
SMALL_BUCKET = 8
UNIT_SHINGLES = 1 << 18
# What a member weighs in a unit beside its shingles: at most 1,024 members a block, however short.
MEMBER_WEIGHT = 256
PAIRS_AT_ONCE = 1 << 20


def _s(x: np.ndarray) -> np.ndarray:
    """A permutation of 32-bit words (odd products and shifts are bijections)."""
    x = x ^ (x >> np.uint32(16))
    x = x * np.uint32(0x7FEB352D)
    x = x ^ (x >> np.uint32(15))
    x = x * np.uint32(0x846CA68B)
    return x ^ (x >> np.uint32(16))


def _p(x: np.ndarray, t: np.ndarray) -> None:
    """Another one, in place; ``t`` is scratch space."""
    np.right_shift(x, np.uint32(16), out=t)
    np.bitwise_xor(x, t, out=x)
    np.multiply(x, np.uint32(0x85EBCA6B), out=x)
    np.right_shift(x, np.uint32(13), out=t)
    np.bitwise_xor(x, t, out=x)
    np.multiply(x, np.uint32(0xC2B2AE35), out=x)
    np.right_shift(x, np.uint32(16), out=t)
    np.bitwise_xor(x, t, out=x)


def shingle_sets(texts: pa.Array, words: int):
    """Per document the sorted distinct 64-bit shingles of its words, as one array and offsets."""
    data, offsets = utf8(texts)
    for a, b in pieces(offsets, PIECE_BYTES):
        h, first = word_hashes(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
        sets = []
        for d in range(b - a):
            w = h[first[d]:first[d + 1]]
            n = max(len(w) - words + 1, 1) if len(w) else 0
            if n:
                short = min(words, len(w))
                g = w[:n]
                for k in range(1, short):
                    g = mix64(g * np.uint64(0x9FB21C651E98DF25) + w[k:k + n])
                w = np.unique(mix64(g ^ np.uint64(short)))
            sets.append(w)
        yield a, b, sets


def signatures(sets: list[np.ndarray], size: int) -> np.ndarray:
    """The circulant MinHash signature of every non-empty set, ``size`` coordinates each."""
    lengths = np.array([len(x) for x in sets])
    out = np.empty((len(sets), size), np.uint32)
    x = _s((np.concatenate(sets) >> np.uint64(32)).astype(np.uint32))
    ends = np.cumsum(lengths)
    a = 0
    while a < len(sets):  # blocks that stay in the processor's cache
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + 65536, "right")))
        lo = ends[a] - lengths[a]
        part, starts = x[lo:ends[b - 1]], ends[a:b] - lengths[a:b] - lo
        y, t = np.empty_like(part), np.empty_like(part)
        for k in range(size):
            np.add(part, np.uint32(k + 1), out=y)
            _p(y, t)
            out[a:b, k] = np.minimum.reduceat(y, starts)
        a = b
    return out


def _sign(batches, words: int, size: int):
    for batch in batches:
        for a, b, sets in shingle_sets(batch["text"], words):
            n = np.array([len(x) for x in sets], np.int64)
            full = np.flatnonzero(n)
            keys, sigs = [None] * len(sets), [None] * len(sets)
            if len(full):
                for i, s in zip(full, signatures([sets[i] for i in full], size)):
                    x = sets[i]
                    keys[i] = np.array([np.bitwise_xor.reduce(x), x.sum(dtype=np.uint64),
                                        mix64(x * np.uint64(0xD1342543DE82EF95)).sum(dtype=np.uint64)]).tobytes()
                    sigs[i] = s.tobytes()
            yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(a, b - a), batch["text_hash"].slice(a, b - a), pa.array(n),
                                              pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())],
                                             ["doc_id", "text_hash", "n_shingles", "set_key", "sig"])


def _bands(batches, bands: int, rows: int):
    salt = mix64(np.arange(1, bands + 1, dtype=np.uint64))
    for batch in batches:
        for a in range(0, batch.num_rows, 4096):
            part = batch.slice(a, 4096)
            sig = np.frombuffer(b"".join(part["sig"].to_pylist()), np.uint32).reshape(-1, bands, rows).astype(np.uint64)
            h = np.broadcast_to(salt, sig.shape[:2])
            for r in range(rows):
                h = mix64(h ^ sig[:, :, r] * np.uint64(0x9E3779B97F4A7C15))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.asarray(part["rep"]), bands)),
                                              pa.array(h.ravel().view(np.int64))], ["rep", "bucket"])


def _sets(batches, words: int):
    for batch in batches:
        for a, b, sets in shingle_sets(batch["text"], words):
            yield pa.RecordBatch.from_arrays([batch["rep"].slice(a, b - a),
                                              pa.array([x.tobytes() for x in sets], pa.binary())], ["rep", "shingles"])


def _confirm(batches, percent: int):
    """Pairs whose full sets overlap by ``percent`` or more."""
    for batch in batches:
        left, right = batch["x"], batch["y"]
        yes = np.zeros(batch.num_rows, bool)
        last, keep = None, None
        for i in range(batch.num_rows):
            x = np.frombuffer(left[i].as_buffer(), np.uint64)
            y = np.frombuffer(right[i].as_buffer(), np.uint64)
            if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                continue
            at = np.searchsorted(y, x)
            both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
            yes[i] = 100 * both >= percent * (len(x) + len(y) - both)
        yield pa.RecordBatch.from_arrays([batch["a"].filter(pa.array(yes)), batch["b"].filter(pa.array(yes))], ["a", "b"])


def _possible(batches, min_agree: int):
    """Pairs whose signatures agree in at least ``min_agree`` coordinates."""
    for batch in batches:
        for a in range(0, batch.num_rows, 8192):
            part = batch.slice(a, 8192)
            x, y = (np.frombuffer(b"".join(part[c].to_pylist()), np.uint32).reshape(part.num_rows, -1) for c in ("sx", "sy"))
            yes = pa.array((x == y).sum(1) >= min_agree)
            yield pa.RecordBatch.from_arrays([part["a"].filter(yes), part["b"].filter(yes)], ["a", "b"])


def overlaps(sets: list[np.ndarray]):
    """A function of a set's number that gives the sizes of its intersections with all sets.

    Shingles in more than half of the sets are counted by the sets that lack them, so that near copies
    of one text cost as much as they differ.
    """
    m, sizes = len(sets), np.array([len(x) for x in sets])
    values, ids = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(m), sizes)
    counts = np.bincount(ids)
    common = counts * 2 > m
    place = np.cumsum(common) - 1
    has = np.zeros((int(common.sum()), m), bool)
    often = common[ids]
    has[place[ids[often]], owner[often]] = True
    lacking, lacks = np.nonzero(~has)
    some = ~often & (counts[ids] > 1)
    feature = np.concatenate([lacking, len(has) + ids[some]])
    row = np.concatenate([lacks, owner[some]])
    order = np.argsort(feature, kind="stable")
    feature, row = feature[order], row[order]
    first = np.flatnonzero(np.concatenate([[True], feature[1:] != feature[:-1]])) if len(feature) else np.zeros(0, int)
    length = np.diff(np.append(first, len(feature)))
    posting = np.repeat(np.arange(len(first)), length)
    by_row = np.argsort(row, kind="stable")
    cut = np.searchsorted(row[by_row], np.arange(m + 1))
    missing = np.bincount(lacks, minlength=m)

    def of(i: int) -> np.ndarray:
        mine = posting[by_row[cut[i]:cut[i + 1]]]
        shared = np.bincount(row[ragged(first[mine], length[mine])], minlength=m)
        return len(has) - missing[i] - missing + shared

    return of


def _unit(table: pa.Table, percent: int) -> pa.Table:
    """Links of one unit as one link per document to the first of its local group."""
    table = table.take(pa.array(np.argsort(np.asarray(table["rep"]), kind="stable")))
    rep, left = np.asarray(table["rep"]), np.asarray(table["left"])
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["shingles"]]
    sizes = np.array([len(x) for x in sets])
    others = np.ones(len(rep), bool) if left.all() else ~left
    of = overlaps(sets)
    root, a, b, held = np.arange(len(rep)), [], [], 0

    def joined() -> np.ndarray:  # the forest so far and the links found since
        return roots(len(rep), np.concatenate([np.arange(len(rep)), *a]), np.concatenate([root, *b]))

    for i in np.flatnonzero(left):
        both = of(i)
        hit = others & (100 * both >= percent * (sizes[i] + sizes - both))
        hit[i] = False
        j = np.flatnonzero(hit)
        a.append(np.full(len(j), i))
        b.append(j)
        held += len(j)
        if held > PAIRS_AT_ONCE:
            root, a, b, held = joined(), [], [], 0
    root = joined()
    hit = root != np.arange(len(rep))
    return pa.table({"a": rep[root[hit]], "b": rep[hit]})


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, bands: int = BANDS,
                    band_rows: int = BAND_ROWS) -> DataFrame:
    """Group ``docs(doc_id, text)`` whose sets of ``words``-word shingles have Jaccard >= percent/100.

    One row per input row: doc_id, n_shingles, component_id, kept. Words are ``[^\\x20\\x09-\\x0D]+``
    with A-Z lower-cased; a shorter text is one shingle; a null, empty or blank text has no shingles
    and links with nothing. A null id links with nothing, keeps a null ``component_id`` and is kept.
    Rows that repeat an id are rows of their own: each is in the component of its own text, and is kept if its
    id is that component's smallest. Texts of any length are read whole. Other columns are not read. An
    empty table gives an empty result.
    """
    return _classified(docs, words, percent, bands, band_rows).select("doc_id", "n_shingles", "component_id", "kept")


def _classified(docs: DataFrame, words: int, percent: int, bands: int, band_rows: int) -> DataFrame:
    """``near_duplicates`` with the columns ``text_hash`` and ``group``, the component's key."""
    ship_package(docs.sparkSession)
    size = bands * band_rows
    # Agreements of a pair with Jaccard j follow a binomial around j * K: 6 deviations below are enough.
    j = percent / 100
    min_agree = max(1, int(size * j - 6 * (size * j * (1 - j)) ** 0.5))
    base = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    rows = written(base.mapInArrow(lambda it: freeing(_sign(it, words, size)),
                                   "doc_id long, text_hash long, n_shingles long, set_key binary, sig binary"), "minhash-rows")
    total = max(rows.count(), 1)
    linked = rows.filter("n_shingles > 0 and doc_id is not null")
    # Numbered in order of their smallest ids as they are written: the number is the class's key. ``of`` is one of
    # its rows. The order makes the first document of a group the one that most others are compared with.
    classes = written(linked.groupBy("set_key", "n_shingles").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("of"), F.first("sig").alias("sig"), F.count(F.lit(1)).alias("n"))
        .repartitionByRange("of").sortWithinPartitions("of").withColumn("rep", F.monotonically_increasing_id()),
        "minhash-classes")
    in_bands = written(classes.select("rep", "sig").mapInArrow(lambda it: freeing(_bands(it, bands, band_rows)), "rep long, bucket long"),
                       "minhash-bands")
    firsts = in_bands.groupBy("bucket").agg(F.min("rep").alias("head"), F.count(F.lit(1)).alias("w")).filter("w > 1")
    firsts = written(firsts.withColumn("size", F.col("w")), "minhash-buckets")
    n_classes = max(classes.count(), 1)
    members = written(join_spread(in_bands, firsts, ["bucket"], "w", n_classes), "minhash-members")
    stars = written(members.filter("rep <> head").select(F.col("head").alias("a"), F.col("rep").alias("b")).distinct(),
                    "minhash-stars")
    met = stars.select(F.col("a").alias("rep")).union(stars.select(F.col("b").alias("rep"))).distinct()
    # one text of every class that met another; copies of a text go by the broadcast of the classes with very many
    texts = classes.join(met.hint("merge"), "rep").select("of.*", "rep", "n")
    sets = join_spread(base, texts, ["doc_id", "text_hash"], "n", total).select("rep", "text").mapInArrow(
        lambda it: freeing(_sets(it, words)), "rep long, shingles binary")
    sets = written(sets.groupBy("rep").agg(F.min("shingles").alias("shingles")), "minhash-sets")

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        uses = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("w"))
        n = max(pairs.count(), 1)
        x = uses.join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("x")), "a")
        y = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("y"))
        both = join_spread(pairs.join(y.hint("merge"), "b"), x, ["a"], "w", n)
        return written(both.select("a", "b", "x", "y").mapInArrow(lambda it: freeing(_confirm(it, percent)), "a long, b long"), name)

    links = confirmed(stars, "minhash-links")
    comps = connected_components(links)
    comps = written(comps.select(F.col("node").alias("rep"), "component"), "minhash-components")
    # Buckets that still hold several components. Of any pair across components one is outside the
    # bucket's largest component, so only those few meet all members.
    placed = written(members.join(comps.hint("merge"), "rep", "left").select(
        "bucket", "size", "rep", F.coalesce("component", "rep").alias("component")), "minhash-placed")
    parts = placed.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    largest = parts.groupBy("bucket").agg(F.max(F.struct("n", "component"))["component"].alias("main"),
                                          F.count(F.lit(1)).alias("parts"), F.sum("n").alias("w")).filter("parts > 1")
    apart = join_spread(placed, largest.select("bucket", "main", "w"), ["bucket"], "w", n_classes)
    apart = written(apart.join(classes.select("rep", "sig", "n_shingles").hint("merge"), "rep"), "minhash-apart")
    # small buckets: pairs of a stray and any member
    small = apart.filter(F.col("size") <= SMALL_BUCKET)
    left = small.filter("component <> main").select("bucket", F.col("rep").alias("a"), F.col("component").alias("ca"),
                                                    F.col("sig").alias("sx"), F.col("n_shingles").alias("na"))
    right = small.select("bucket", F.col("rep").alias("b"), F.col("component").alias("cb"), "main",
                         F.col("sig").alias("sy"), F.col("n_shingles").alias("nb"))
    rest = left.join(right.hint("merge"), "bucket").filter(
        "ca <> cb and (cb = main or a < b) and 100 * least(na, nb) >= %d * greatest(na, nb)" % percent)
    rest = rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
                       "sx", "sy").mapInArrow(lambda it: freeing(_possible(it, min_agree)), "a long, b long").distinct()
    rest = written(rest.join(stars.hint("merge"), ["a", "b"], "left_anti"), "minhash-rest")
    more = confirmed(rest, "minhash-links")
    # large buckets: strays of one main component meet its members and each other in units
    large = apart.filter(F.col("size") > SMALL_BUCKET).groupBy("main", "rep").agg(
        F.first("n_shingles").alias("n_shingles"), F.bool_or(F.col("component") != F.col("main")).alias("stray"))
    sent = block_units(written(large, "minhash-strays"), "main", "stray", F.col("n_shingles") + MEMBER_WEIGHT, UNIT_SHINGLES)
    uses = sent.groupBy("rep").agg(F.count(F.lit(1)).alias("w"))
    units = join_spread(sent, sets.join(uses.hint("merge"), "rep"), ["rep"], "w", max(sent.count(), 1))
    units = units.select("main", "kind", "i", "j", "rep", "left", "shingles").groupBy("main", "kind", "i", "j")
    spread = written(units.applyInArrow(lambda t: _unit(t, percent), "a long, b long"), "minhash-links")
    # links between components: these are the nodes now
    found = more.unionByName(spread)
    for end in ("a", "b"):
        found = found.join(comps.select(F.col("rep").alias(end), F.col("component").alias("_c")).hint("merge"), end, "left").withColumn(
            end, F.coalesce("_c", end)).drop("_c")
    final = connected_components(found).select(F.col("node").alias("group"), F.col("component").alias("_to"))
    grouped = classes.join(comps.hint("merge"), "rep", "left").withColumn("group", F.coalesce("component", "rep"))
    n_comps = grouped.groupBy("group").agg(F.min("of.doc_id").alias("first"), F.count(F.lit(1)).alias("w"))
    n_comps = n_comps.join(final.hint("merge"), "group", "left").withColumn("to", F.coalesce("_to", "group"))
    least = n_comps.groupBy("to").agg(F.min("first").alias("component_id"))
    where = written(n_comps.join(least.hint("merge"), "to").select("group", "to", "component_id", "w"), "minhash-groups")
    named = join_spread(grouped.select("set_key", "n_shingles", "n", "group"), where, ["group"], "w", n_classes).select(
        "set_key", "n_shingles", "component_id", F.col("to").alias("group"), F.col("n").alias("w"))
    out = join_spread(linked.select("doc_id", "text_hash", "n_shingles", "set_key"), named, ["set_key", "n_shingles"], "w", total)
    out = out.select("doc_id", "text_hash", "n_shingles", "component_id", "group").unionByName(
        rows.filter("n_shingles = 0 or doc_id is null").select(
            "doc_id", "text_hash", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("group")))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, bands: int = BANDS,
                         band_rows: int = BAND_ROWS) -> DataFrame:
    """``docs`` with one document of every group (the smallest id); columns as they were.

    A row stays if its id and text are those of a kept row of ``near_duplicates``: of an id with several texts
    each stays or goes by its own group, equal rows stay or go together, rows with a null id and rows without
    words stay. Texts of any length are read whole; an empty table stays empty.
    """
    keep = _classified(docs, words, percent, bands, band_rows).filter("kept").select(
        F.col("doc_id").alias("_tl_kept_id"), F.col("text_hash").alias("_tl_kept_text")).distinct()
    return docs.join(keep, docs["doc_id"].eqNullSafe(F.col("_tl_kept_id"))
                     & (F.xxhash64(docs["text"]) == F.col("_tl_kept_text")), "left_semi")
