"""Token ids in seekable zstandard files: independent frames, a seek table and frame checksums.

A file is a sequence of independent zstandard frames, followed by a skippable frame with the seek
table (the public "zstd seekable format": per frame its compressed size, its decompressed size and
the low 32 bits of the XXH64 of its content; then the number of frames, a descriptor byte and a magic
number). Any zstd tool can decompress the whole file; a reader that wants one document reads the seek
table from the end of the file, then the index frame, then only that document's frame.

Content: data frames hold token ids as little-endian uint32, whole documents in ascending doc_id
order. The last frame is the index: a count n, then per document its id (int64), its first token in
the file (int64), its number of tokens (int64) and its data frame (int64).

Writing is a Spark job: documents are range-partitioned by doc_id, a task writes one file under a name
of its own attempt and returns its path; only files listed by the committed manifest count, so a task
that ran twice or was lost leaves nothing that a reader sees. Paths are URIs opened by pyarrow's file
systems, so the folder can be any shared store.
"""

from __future__ import annotations

import math
import os
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import pieces, ragged, ship_package, utf8, written
from tierline.llm.words import slice_hashes, word_spans
from tierline.session import scratch_path

END_ID = 2
FRAME_BYTES = 1 << 20
FILE_BYTES = 64 << 20
PIECE_BYTES = 2 << 20
CACHE_WORDS = 1 << 18
LEVEL = 3

# Fixed values of the format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


class SeekableWriter:
    """Writes frames, then the seek table."""

    def __init__(self, out, level: int = LEVEL):
        self.out, self.table = out, []
        self.compressor = zstandard.ZstdCompressor(level=level, write_checksum=True)

    def frame(self, content: bytes) -> None:
        packed = self.compressor.compress(content)
        self.out.write(packed)
        self.table.append((len(packed), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))

    def close(self) -> None:
        body = b"".join(struct.pack("<III", *row) for row in self.table)
        body += struct.pack("<IBI", len(self.table), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body)


class SeekableReader:
    """Reads single frames of a file and checks them."""

    def __init__(self, fs: pafs.FileSystem, path: str):
        self.file = fs.open_input_file(path)
        size = self.file.size()
        frames, flags, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError(f"{path}: no seek table with checksums")
        table = self.file.read_at(12 * frames, size - 9 - 12 * frames)
        self.table = np.frombuffer(table, "<u4").reshape(frames, 3).astype(np.int64)
        self.at = np.cumsum(self.table[:, 0]) - self.table[:, 0]
        self.path = path

    def frame(self, k: int) -> bytes:
        packed, size, check = (int(x) for x in self.table[k])
        content = zstandard.ZstdDecompressor().decompress(self.file.read_at(packed, int(self.at[k])), max_output_size=size)
        if len(content) != size or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != check:
            raise ValueError(f"{self.path}: frame {k} fails its checksum")
        return content

    def index(self) -> np.ndarray:
        """Rows doc_id, first token, number of tokens, frame (4 x n)."""
        content = self.frame(len(self.table) - 1)
        return np.frombuffer(content, "<i8", offset=8).reshape(4, -1)

    def document(self, index: np.ndarray, i: int) -> np.ndarray:
        """Token ids of the i-th document of the index; decompresses its frame only."""
        k = int(index[3, i])
        before = int(index[1, np.searchsorted(index[3], k)])
        at = int(index[1, i]) - before
        return np.frombuffer(self.frame(k), "<u4")[at:at + int(index[2, i])]


_LETTER, _PUNCT, _OTHER = 1, 2, 0
_KIND = np.zeros(256, np.uint8)
_KIND[65:91] = _KIND[97:123] = _LETTER
_KIND[[b for b in range(33, 127) if chr(b) not in "'" and not chr(b).isalnum()]] = _PUNCT


def plain_units(data: np.ndarray, offsets: np.ndarray):
    """Words cut where a letter meets ASCII punctuation: starts, ends, whether a unit is plain (letters
    alone or punctuation alone), and per document its first unit (n+1).

    Letters are A-Z, a-z and the two-byte letters of Latin-1; the apostrophe, digits and all else are
    neither, so nothing is cut beside them. The tokenizer cuts at all these places too.
    """
    starts, ends, _ = word_spans(data, offsets)
    kind = _KIND[data]
    lead = np.flatnonzero(data[:-1] == 0xC3) if len(data) else np.zeros(0, int)
    tail = data[lead + 1]
    lead = lead[(tail >= 0x80) & (tail <= 0xBF) & (tail != 0x97) & (tail != 0xB7)]
    kind[lead] = kind[lead + 1] = _LETTER
    inner = np.flatnonzero((kind[1:] * kind[:-1]) == _LETTER * _PUNCT) + 1 if len(data) else np.zeros(0, int)
    starts = np.sort(np.concatenate([starts, np.setdiff1d(inner, starts, assume_unique=True)]))
    ends = np.sort(np.concatenate([ends, np.setdiff1d(inner, ends, assume_unique=True)]))
    other = np.concatenate([[0], np.cumsum(kind == _OTHER)])
    return starts, ends, other[ends] == other[starts], np.searchsorted(starts, offsets)


class WordEncoder:
    """Ids of whole texts by a tokenizer whose pre-tokenizer never joins across white space, nor a
    letter with punctuation: each distinct unit is encoded once by the library (at most ``CACHE_WORDS``
    are kept from batch to batch). Plain units are encoded many in one text and told apart by the
    tokens that end a word. With ``added`` the tokenizer's added tokens (``<|endoftext|>``) stand for
    themselves as the library has it by default, and texts that contain one go to the library whole;
    without, they are text like any other."""

    JOINED = 512

    def __init__(self, path: str, added: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        # the tokenizer may look for them after it lower-cased the text
        self.added = [t.content.encode().lower() for t in self.tokenizer.get_added_tokens_decoder().values()] if added else []
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.keys, self.from_, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lists = self._library(texts)
        counts = np.array([len(x) for x in lists], np.int64)
        return np.fromiter((i for x in lists for i in x), np.uint32, int(counts.sum())), counts

    def _joined(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lists = self._library([" ".join(texts[i:i + self.JOINED]) for i in range(0, len(texts), self.JOINED)])
        ids = np.concatenate([np.array(x, np.uint32) for x in lists]) if lists else np.zeros(0, np.uint32)
        last = np.flatnonzero(self.ends_word[ids])
        if len(last) != len(texts):
            return self._each(texts)
        return ids, np.diff(last, prepend=-1)

    def _with_added(self, data: np.ndarray, offsets: np.ndarray) -> list[int]:
        """The texts that contain an added token."""
        raw = data.tobytes().lower() if self.added else b""
        found = set()
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                d = int(np.searchsorted(offsets, at, "right")) - 1
                if at + len(token) <= offsets[d + 1]:
                    found.add(d)
                at = raw.find(token, at + 1)
        return sorted(found)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and where each text's begin (n+1)."""
        whole = self._with_added(data, offsets)
        if not whole:
            return self._encode(data, offsets)
        lists = self._library([data[offsets[d]:offsets[d + 1]].tobytes().decode() for d in whole])
        parts, sizes, a = [], [], 0
        for d, ids in zip([*whole, len(offsets) - 1], [*lists, None]):
            if d > a:  # the texts between
                between, first = self._encode(data[offsets[a]:offsets[d]], offsets[a:d + 1] - offsets[a])
                parts.append(between)
                sizes.append(np.diff(first))
            if ids is not None:
                parts.append(np.array(ids, np.uint32))
                sizes.append(np.array([len(ids)]))
            a = d + 1
        return np.concatenate(parts), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])

    def _encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts, ends, plain, first = plain_units(data, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        # the tokenizer lower-cases, so A-Z may be folded
        keys, at, which = np.unique(slice_hashes(data, starts, ends, fold_case=True), return_index=True, return_inverse=True)
        slot = np.searchsorted(self.keys, keys)
        known = self.keys[np.minimum(slot, len(self.keys) - 1)] == keys if len(self.keys) else np.zeros(len(keys), bool)
        new = np.flatnonzero(~known)
        new = new[np.argsort(~plain[at[new]], kind="stable")]  # plain ones first
        raw = data.tobytes()
        texts = [raw[s:e].decode() for s, e in zip(starts[at[new]].tolist(), ends[at[new]].tolist())]
        cut = int(plain[at[new]].sum())
        parts = self._joined(texts[:cut]), self._each(texts[cut:])
        ids, counts = (np.concatenate(x) for x in zip(*parts))
        table = np.concatenate([self.ids, ids])
        from_, count = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
        from_[known], count[known] = self.from_[slot[known]], self.counts[slot[known]]
        from_[new], count[new] = len(self.ids) + np.cumsum(counts) - counts, counts
        if len(self.keys) + len(new) <= CACHE_WORDS:
            order = np.argsort(np.concatenate([self.keys, keys[new]]), kind="stable")
            self.from_ = np.concatenate([self.from_, from_[new]])[order]
            self.counts = np.concatenate([self.counts, counts])[order]
            self.keys, self.ids = np.concatenate([self.keys, keys[new]])[order], table
        per = count[which]
        return table[ragged(from_[which], per)], np.append(np.cumsum(per) - per, per.sum())[first]


@lru_cache(2)
def encoder_of(path: str, added: bool = False) -> WordEncoder:
    """One encoder a Python worker, so that its units serve the tasks that follow."""
    return WordEncoder(path, added)


def _write_files(batches, folder: str, make_encoder: Callable, end_id: int, frame_bytes: int, file_bytes: int):
    """Write this task's documents (ascending) as files; one manifest row a file."""
    fs, root = open_folder(folder)
    encoder = out = None

    def begin():
        nonlocal out, writer, index, held, held_bytes, tokens, path
        path = f"{root}/{uuid.uuid4().hex}.zst"
        fs.create_dir(root, recursive=True)
        out = fs.open_output_stream(path, compression=None)
        writer, index, held, held_bytes, tokens = SeekableWriter(out), [], [], 0, 0

    def flush():
        nonlocal held, held_bytes
        if held:
            writer.frame(b"".join(held))
            held, held_bytes = [], 0

    def finish():
        nonlocal out
        flush()
        rows = np.array(index, "<i8").reshape(-1, 4).T
        writer.frame(struct.pack("<q", rows.shape[1]) + np.ascontiguousarray(rows).tobytes())
        writer.close()
        out.close()
        out = None
        return pa.RecordBatch.from_pydict({"path": [path], "first_id": [int(rows[0, 0])], "n_docs": [rows.shape[1]],
                                           "n_tokens": [tokens]}, schema=_MANIFEST)

    writer = index = held = path = None
    held_bytes = tokens = 0
    for batch in batches:
        encoder = encoder or make_encoder()
        data, offsets = utf8(batch["text"])
        doc_ids = batch["doc_id"].to_pylist()
        for a, b in pieces(offsets, PIECE_BYTES):
            ids, first = encoder.encode(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            ids = ids.astype("<u4")
            for d in range(b - a):
                blob = ids[first[d]:first[d + 1]].tobytes() + struct.pack("<I", end_id)
                if out is None:
                    begin()
                if held and held_bytes + len(blob) > frame_bytes:
                    flush()
                index.append((doc_ids[a + d] if doc_ids[a + d] is not None else NULL_ID, tokens, len(blob) // 4, len(writer.table)))
                held.append(blob)
                held_bytes += len(blob)
                tokens += len(blob) // 4
                if 4 * tokens >= file_bytes:
                    yield finish()
    if out is not None:
        yield finish()


NULL_ID = -(1 << 63)
_MANIFEST = pa.schema([("path", pa.string()), ("first_id", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])


def write_tokens(docs: DataFrame, tokenizer_path: str, folder: str | None = None, end_id: int = END_ID,
                 frame_bytes: int = FRAME_BYTES, file_bytes: int = FILE_BYTES, added_tokens: bool = False) -> DataFrame:
    """Encode ``docs(doc_id, text)`` into files below ``folder`` and return their manifest: path,
    file number in doc_id order, start (tokens of all files before), first_id, n_docs, n_tokens.

    Every document is its ids (none for a null or empty text) and ``end_id``. ``added_tokens``: an added
    token of the tokenizer in a text, like ``<|endoftext|>``, is that token (the library's default), else
    it is encoded as text. Null ids come first
    and stand as the smallest int64; rows that repeat an id stand side by side. Other columns are not read. An
    empty table gives an empty manifest and no file.
    """
    spark = docs.sparkSession
    ship_package(spark)
    folder = folder or scratch_path(spark, "tokens")
    base = docs.select("doc_id", "text")
    size = base.agg(F.sum(F.octet_length("text").cast("long") + 64)).first()[0] or 0
    parts = max(1, math.ceil(size / (file_bytes // 4)), spark.sparkContext.defaultParallelism if size > file_bytes else 1)
    ordered = base.repartitionByRange(parts, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first())
    manifest = written(ordered.mapInArrow(
        lambda it: _write_files(it, folder, lambda: encoder_of(tokenizer_path, added_tokens), end_id, frame_bytes, file_bytes),
        "path string, first_id long, n_docs long, n_tokens long"), "token-manifest")
    # one row a file, so the window's single task holds a few bytes for every file_bytes of tokens
    order = Window.orderBy("first_id", "path")
    return manifest.select("path", (F.row_number().over(order) - 1).alias("file"),
                           (F.sum("n_tokens").over(order) - F.col("n_tokens")).alias("start"),
                           "first_id", "n_docs", "n_tokens").withColumn("folder", F.lit(folder))


def _read_files(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            fs, _ = open_folder(row["folder"])
            reader = SeekableReader(fs, row["path"])
            index = reader.index()
            for k in np.unique(index[3]):
                docs = np.flatnonzero(index[3] == k)
                ids = np.frombuffer(reader.frame(int(k)), "<u4")
                at = index[1, docs] - index[1, docs[0]]
                crc = [zlib.crc32(ids[s:s + n]) for s, n in zip(at.tolist(), index[2, docs].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(index[0, docs], pa.int64(), mask=index[0, docs] == NULL_ID),
                     pa.array(index[1, docs] + row["start"]), pa.array(index[2, docs]), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_digests(manifest: DataFrame) -> DataFrame:
    """Read all files of a manifest back, each frame checked: doc_id, start, n_tokens, ids_crc32."""
    ship_package(manifest.sparkSession)
    return (written(manifest, "token-manifest").select("folder", "path", "start", "file")
            .repartition(max(1, manifest.sparkSession.sparkContext.defaultParallelism), "file")
            .mapInArrow(_read_files, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def read_document(folder: str, path: str, doc_id: int) -> list[int]:
    """One document's ids from one file: reads the seek table, the index and that document's frame."""
    fs, _ = open_folder(folder)
    reader = SeekableReader(fs, path)
    index = reader.index()
    i = int(np.searchsorted(index[0], doc_id))
    if i >= index.shape[1] or index[0, i] != doc_id:
        raise KeyError(doc_id)
    return reader.document(index, i).tolist()
