"""Exact deduplication by an extendible-hash index kept as files in the shared folder.

DataFrame functions only. The index has one entry a distinct hash. Its directory starts at a
prefix of the hash of ``depth`` bits and doubles while a bucket holds more entries than
``bucket_entries``; buckets that fit keep their shorter prefix, so only overfull ones split. Tasks
own ranges of hash prefixes (a range partitioning by bucket), write their buckets sorted, and chain
the entries of one hash: the texts behind a hash that occurs more than once are compared byte by
byte, so two texts that merely collide become two links of a chain.

Entries are combined before every shuffle, so copies of one text cost one entry a task however many
there are, and a group that holds a third of all rows meets its index entry by a bounded broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import join_spread, lower_ascii, written

BUCKET_ENTRIES = 1 << 17
HASH_BITS = 64
COUNTED_BITS = 8
DIRECTORY_BROADCAST = 1 << 18


def _prefix(h, bits: int):
    return F.shiftrightunsigned(h, 64 - bits) if bits else F.lit(0).cast("long")


def build_directory(entries: DataFrame, bucket_entries: int) -> DataFrame:
    """Buckets ``(bits, prefix, entries, rows)`` over ``entries(h, n)``, from one slot by doubling.

    A bucket is a prefix whose entries fit while its parent's don't. Each doubling splits the overfull
    buckets by one more bit; it works on counts of prefixes ``COUNTED_BITS`` longer, so the entries of
    overfull buckets are read once for that many doublings. At 64 bits a bucket stays as it is.
    ``rows`` are the documents behind a bucket's entries.
    """
    done, open_, depth = None, entries, 0
    while True:
        finest = min(depth + COUNTED_BITS, 64)
        counts = written(open_.groupBy(_prefix(F.col("h"), finest).alias("fine")).agg(
            F.count(F.lit(1)).alias("entries"), F.sum("n").alias("rows")), "directory-counts")
        while True:
            slot = _prefix(F.shiftleft("fine", 64 - finest), depth)
            sizes = counts.groupBy(slot.alias("prefix")).agg(F.sum("entries").alias("entries"), F.sum("rows").alias("rows"))
            sizes = written(sizes.withColumn("bits", F.lit(depth)), "directory")
            overfull = F.col("entries") > (bucket_entries if depth < 64 else 1 << 62)
            fits, over = sizes.filter(~overfull), sizes.filter(overfull).select(F.col("prefix").alias("over"))
            done = fits if done is None else done.unionByName(fits)
            if over.isEmpty():
                return done
            if depth == finest:
                break
            counts = counts.join(over, slot == F.col("over"), "left_semi")
            depth += 1
        open_ = open_.join(over, _prefix(F.col("h"), depth) == F.col("over"), "left_semi")
        depth += 1


def with_bucket(rows: DataFrame, directory: DataFrame, total: int) -> DataFrame:
    """``rows(h, ...)`` with their ``bucket``, the first hash of its range; rows without a bucket go.

    A row asks for the slot of its hash at every length of prefix in use; exactly one is a bucket. The
    directory is broadcast up to ``DIRECTORY_BROADCAST`` buckets (some 20 MB); above that rows and buckets
    are shuffled, with the buckets that hold many of the ``total`` rows split.
    """
    names = rows.columns
    levels = sorted(r["bits"] for r in directory.select("bits").distinct().collect())  # at most 65 numbers
    slots = F.array(*(F.struct(F.lit(b).alias("bits"), _prefix(F.col("h"), b).alias("prefix")) for b in levels or [0]))
    asked = rows.withColumn("_slot", F.explode(slots)).select(*names, "_slot.bits", "_slot.prefix")
    buckets = directory.select("bits", "prefix", "rows")
    if directory.count() <= DIRECTORY_BROADCAST:
        found = asked.join(F.broadcast(buckets.drop("rows")), ["bits", "prefix"])
    else:
        found = join_spread(asked, buckets, ["bits", "prefix"], "rows", total)
    return found.select(*names, F.expr("shiftleft(prefix, 64 - bits)").alias("bucket"))


def exact_groups(docs: DataFrame, bucket_entries: int = BUCKET_ENTRIES, hash_bits: int = HASH_BITS) -> DataFrame:
    """Group ``docs(doc_id, text)`` by equal text after lower-casing A-Z; the largest id stays.

    One row per input row: doc_id, keep_id, group_size, kept, text_sha256. A null text counts as
    empty; empty texts are equal. A null id is smaller than any other (a group of null ids alone
    keeps a null ``keep_id`` and ``kept`` true). Rows that repeat an id and its text count each in
    ``group_size`` and are kept or dropped together. Other columns are not read. An empty table
    gives an empty result. A very long text is hashed as it is and only shuffled, whole, if its hash occurs
    more than once. ``hash_bits`` below 64 makes collisions (for tests).
    """
    low = 64 - hash_bits
    norm = docs.select("doc_id", lower_ascii(F.coalesce(F.col("text"), F.lit(""))).alias("norm"))
    hashed = norm.withColumn("h", F.shiftleft(F.shiftrightunsigned(F.xxhash64("norm"), low), low))
    # 1. one narrow row a document
    rows = written(hashed.select("doc_id", "h", F.sha2(F.col("norm"), 256).alias("text_sha256")), "exact-rows")
    total = max(rows.count(), 1)
    # 2. the index: one entry a hash, in buckets owned by hash range
    entries = written(rows.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("top")), "exact-entries")
    directory = written(build_directory(entries, bucket_entries), "exact-directory")
    index = with_bucket(entries, directory, total)
    index = written(index.repartitionByRange("bucket", "h").sortWithinPartitions("bucket", "h"), "exact-index")
    # 3. chains: the bytes behind every hash that occurs more than once, found through the directory
    shared = index.filter("n > 1").select("bucket", "h", F.col("n").alias("w"))
    texts = join_spread(with_bucket(hashed, directory, total), shared, ["bucket", "h"], "w", total)
    links = (texts.groupBy("bucket", "h", "norm")
             .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    chains = written(links.select("bucket", "h", F.sha2(F.col("norm"), 256).alias("text_sha256"), "keep_id", "group_size"),
                     "exact-chains")
    # 4. every row finds its bucket, its entry there and its link
    placed = with_bucket(rows, directory, total)
    alone = placed.join(index.filter("n = 1").select("bucket", "h"), ["bucket", "h"], "left_semi").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "text_sha256")
    linked = join_spread(placed, chains.withColumn("w", F.col("group_size")), ["bucket", "h", "text_sha256"], "w", total)
    out = alone.unionByName(linked.select("doc_id", "keep_id", "group_size", "text_sha256"))
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                      "text_sha256")


def drop_copies(docs: DataFrame, **params) -> DataFrame:
    """``docs`` without the rows whose text another row keeps; columns as they were."""
    keep = exact_groups(docs, **params).filter("kept").select(
        F.col("doc_id").alias("_tl_kept_id"), F.col("text_sha256").alias("_tl_kept_sha"))
    sha = F.sha2(lower_ascii(F.coalesce(docs["text"], F.lit(""))), 256)
    return docs.join(keep, docs["doc_id"].eqNullSafe(F.col("_tl_kept_id")) & (sha == F.col("_tl_kept_sha")), "left_semi")
