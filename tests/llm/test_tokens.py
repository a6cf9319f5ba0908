"""Operators 6 and 7 against the public libraries, and exact round trips."""

from __future__ import annotations

import base64
import hashlib
import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
import zstandard
from llm_fixtures import EDGE_ROWS, read_documents, table
from tokenizers import Tokenizer

from conftest import SF_SMOKE
from tierline.llm import byte_bpe
from tierline.llm.byte_bpe import Encoder, encode_documents, slice_starts
from tierline.llm.common import utf8
from tierline.llm.token_files import SeekableReader, open_folder, read_digests, read_document, write_tokens

WORD_BPE, BYTE_BPE = P.path("word_bpe_49k.json"), P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def word_tokenizer():
    t = Tokenizer.from_file(WORD_BPE)
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def byte_tokenizer():
    with open(BYTE_BPE, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


TRICKY = ["'s", "it's 'tis x'rey 'they're''s '", "\n's", "\n 's", " 's", "a  b   c\n\nd \n e", "  ", " \n", "a ", "1a2b", "١٢ ½ Ⅷ",
          "a\u0085b c　d​e", "\x1ca\x1fb", "é́", "🙂🙂 ok", "<|endoftext|> <|startoftext|>", "a" * 3000,
          " " * 700 + "x", "ab" * 500, "İstanbul ΣΑΣ", "﻿x", "-" * 400 + "'ll"]
ROWS = EDGE_ROWS + [(100 + i, t, "en", "s") for i, t in enumerate(TRICKY)]


# ---- files ------------------------------------------------------------------------------------------


def expected_files(rows, tokenizer):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out, start = [], 0
    for doc_id, text, *_ in order:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("params", [{}, {"file_bytes": 4000, "frame_bytes": 300}])
def test_files_hold_what_the_library_encodes(spark, word_tokenizer, params):
    rows = [r for r in ROWS if r[0] is not None or r[1]]  # null ids tie: keep one
    got = sorted(map(tuple, read_digests(write_tokens(table(spark, rows), WORD_BPE, **params)).collect()), key=lambda r: r[1])
    assert got == expected_files(rows, word_tokenizer)


def test_driver_table_files(spark, word_tokenizer):
    rows = read_documents(SF_SMOKE)
    manifest = write_tokens(table(spark, rows), WORD_BPE, file_bytes=1 << 17, frame_bytes=1 << 14)
    assert manifest.count() > 3
    got = sorted(map(tuple, read_digests(manifest).collect()), key=lambda r: r[1])
    assert got == expected_files(rows, word_tokenizer)


def test_one_document_is_read_by_its_frame_alone(spark, word_tokenizer):
    rows = [(i, f"document number {i} has some words", "en", "s") for i in range(400)]
    entry = write_tokens(table(spark, rows), WORD_BPE, frame_bytes=500).first()
    assert read_document(entry["folder"], entry["path"], 371) == word_tokenizer.encode(rows[371][1]).ids + [2]
    with pytest.raises(KeyError):
        read_document(entry["folder"], entry["path"], 4000)
    fs, _ = open_folder(entry["folder"])
    reader = SeekableReader(fs, entry["path"])
    assert len(reader.table) > 5
    # any zstd tool reads the whole file: the seek table is a skippable frame
    raw = fs.open_input_file(entry["path"]).read()
    whole = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    assert len(whole) == reader.table[:, 1].sum()
    # damage in one frame is found by its checksum and leaves the others readable
    broken = bytearray(raw)
    broken[int(reader.at[1]) + int(reader.table[1, 0]) // 2] ^= 0xFF
    path = entry["path"] + ".broken"
    with fs.open_output_stream(path) as f:
        f.write(bytes(broken))
    hurt = SeekableReader(fs, path)
    assert hurt.frame(0) == reader.frame(0)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        hurt.frame(1)


def test_added_tokens_are_those_of_the_library_by_default(spark, tmp_path):
    from tierline.llm.queries import op6_token_files

    texts = ["hello <|endoftext|> world", "<|startoftext|>a<|endoftext|>", "x<|ENDOFTEXT|>y it's", "<|endoftext", "|> plain, text",
             "<|endoftext|>" * 3, None, "", "a <|endoftext|>\n\n b", *TRICKY]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    table(spark, rows).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, op6_token_files(spark, str(tmp_path)).collect()), key=lambda r: r[1])
    assert got == expected_files(rows, Tokenizer.from_file(WORD_BPE))
    assert 49407 in Tokenizer.from_file(WORD_BPE).encode(texts[0], add_special_tokens=False).ids


def test_files_of_an_empty_table(spark):
    assert read_digests(write_tokens(table(spark, []), WORD_BPE)).count() == 0


# ---- byte-level BPE -----------------------------------------------------------------------------------


def check(texts, tokenizer):
    data, offsets = utf8(pa.array(texts, pa.string()))
    encoder = Encoder(BYTE_BPE)
    for _ in range(2):  # the second time from the cache
        ids, places, first = encoder.encode(data, offsets)
        for i, text in enumerate(texts):
            assert ids[first[i]:first[i + 1]].tolist() == tokenizer.encode_ordinary(text), text[:80]
        assert np.array_equal(encoder.decode(ids), data)
        assert np.array_equal(places, np.cumsum(encoder.ranks.lengths[ids]) - encoder.ranks.lengths[ids])


def test_ids_equal_the_library_on_tricky_and_random_texts(byte_tokenizer):
    rng = random.Random(4)
    alphabet = list("aabstm'  \n\t1é.,relvd　ß中") + ["'s", "'re", "'ll", "  ", "''", "\n "]
    check(TRICKY + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(3000)], byte_tokenizer)


def test_every_code_point_splits_as_in_the_library(byte_tokenizer):
    points = [c for c in range(0x80, 0x30000, 3) if not 0xD800 <= c < 0xE000]
    check([f"a{chr(c)}1 {chr(c)}'s" for c in points], byte_tokenizer)


def test_scan_equals_the_pattern():
    import regex

    rng = random.Random(8)
    texts = ["".join(rng.choice("ab1 \n\t'stre.,é ll") for _ in range(rng.randint(0, 300))) for _ in range(400)]
    data, offsets = utf8(pa.array(texts))
    starts = set(slice_starts(data, offsets).tolist())
    expected = set()
    for text, at in zip(texts, offsets.tolist()):
        expected |= {at + len(text[:m.start()].encode()) for m in regex.finditer(P.PATTERN, text)}
    assert starts == expected


def test_colliding_slices_are_found_by_decoding(byte_tokenizer, monkeypatch):
    real = byte_bpe.slice_hashes
    monkeypatch.setattr(byte_bpe, "slice_hashes", lambda *a, **k: real(*a, **k) & np.uint64(7))
    check(["many words that collide in three bits of hash, and more of them"], byte_tokenizer)


def test_long_documents_are_encoded_in_parts(spark, byte_tokenizer, monkeypatch):
    rng = random.Random(5)
    words = ["it's", "x", "word", "\n\n", "'ll", "  ", "é", "12", "!?", "\t"]
    text = " ".join(rng.choice(words) for _ in range(4000))
    data, offsets = utf8(pa.array([text, "", text[:50]]))
    parts = byte_bpe.cut_long(data, np.unique(offsets), 500)
    assert len(parts) > 20 and np.diff(parts).max() <= 500
    monkeypatch.setattr(byte_bpe, "PIECE_BYTES", 500)
    out = next(byte_bpe._encode_batches([pa.array([text, "", None, text[:50]])], BYTE_BPE, True)).to_pylist()
    for row, t in zip(out, [text, "", "", text[:50]]):
        assert np.frombuffer(row["token_ids"], "<u4").tolist() == byte_tokenizer.encode_ordinary(t)
        assert row["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()


def test_class_table_takes_little_memory():
    byte_bpe._classes.cache_clear()
    tracemalloc.start()
    try:
        byte_bpe._classes()
        assert tracemalloc.get_traced_memory()[1] < 40 << 20
    finally:
        tracemalloc.stop()


def test_documents_round_trip(spark, byte_tokenizer):
    rows = ROWS + read_documents(SF_SMOKE)
    got = encode_documents(table(spark, rows), BYTE_BPE, with_ids=True).collect()

    def expect(doc_id, text):
        ids = np.array(byte_tokenizer.encode_ordinary(text or ""), "<u4").tobytes()
        return (doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest(), ids)

    assert sorted((r[0], *r[1:4], bytes(r[4])) for r in got if r[0] is not None) == sorted(
        expect(i, t) for i, t, *_ in rows if i is not None)
    assert len(got) == len(rows)
    assert encode_documents(table(spark, []), BYTE_BPE).count() == 0
