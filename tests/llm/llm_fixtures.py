"""Small tables with every awkward case, and plain-Python versions of the shared definitions."""

from __future__ import annotations

import re
import zlib

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# Columns that clash with names used inside the operators.
CLASH = ["h", "n", "w", "rep", "chunk", "shard", "kept", "size", "bucket", "order", "cell", "slot", "lines",
         "starts", "first", "norm", "held_out", "score", "row_key", "sig", "x", "src", "word", "target"]
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          + ", ".join(f"{c} string" for c in CLASH))


def table(spark, rows):
    """A documents table of (doc_id, text, lang, source) rows with clashing extra columns."""
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), *["?"] * len(CLASH)) for r in rows], SCHEMA)


LONG = " ".join(f"word{i % 977}" for i in range(30_000))

EDGE_ROWS = [
    (0, None, "en", "a"),
    (1, "", "en", "a"),
    (2, "   \n\t ", None, "a"),
    (3, "Hello World, again and again", "en", "b"),
    (4, "hello world, again and again", "en", None),
    (5, "HELLO WORLD, AGAIN AND AGAIN", None, None),
    (6, "Straße ÄÖÜ é ñ 中文 字", "de", "b"),
    (7, "straße ÄÖÜ é ñ 中文 字", "de", "b"),
    (7, "straße ÄÖÜ é ñ 中文 字", "de", "b"),
    (8, LONG, "en", "c"),
    (9, LONG + " end", "en", "c"),
    (None, "hello world, again and again", "en", "c"),
    (None, None, None, None),
    (10, "x", "en", "c"),
    (11, "12 34 !!", "en", "c"),
    (-5, "a\nb\nc\nd", "en", "c"),
    (12, "z\na\nb\nc\nd", "en", "c"),
    (13, "it's they've we'll 'tis  \n don't", "en", "c"),
]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def remainder(doc_id, parts):
    return 0 if doc_id is None else zlib.crc32(str(doc_id).encode()) % parts


def read_documents(sf_dir):
    import pyarrow.parquet as pq

    t = pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()
    return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in t]


def components(nodes, links):
    """Smallest node of each node's group."""
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}
