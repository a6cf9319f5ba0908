"""Byte-level BPE: vectorised pre-tokenisation by a transition-function scan, cached pair merging.

Pre-tokenisation finds the matches of the pattern

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

without a regular expression. Every code point gets a symbol: its class (letter, number, white
space, other) and what little the pattern looks ahead (is an apostrophe followed by a contraction, is
a white space the last before ink). A symbol is a function from states to states of an automaton
with eight states; functions compose associatively, so a whole batch is scanned in blocks: all blocks
step through their columns together for every possible entry state, the blocks' functions are
composed by doubling, and a second pass with the true entry states marks where matches begin.

Merging works on the distinct slices of a batch that are not in the task's cache: all of them merge
their lowest-ranked leftmost pair together, round by round. The byte offset of every token is kept, and
decoding checks the bytes against the text.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import freeing, pieces, ragged, ship_package, utf8
from tierline.llm.words import slice_hashes

PIECE_BYTES = 1 << 19
CACHE_SLICES = 1 << 18
LONG_SLICE = 256
BLOCK = 64

LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
# Symbols 0..2: letter, number, other. 3, 4: an apostrophe before a contraction of one, two letters.
# 5: white space before white space or the end. 6: the space before ink. 7: other white space before
# ink. Plus 8: the first code point of a document.
S_L, S_N, S_O, S_C1, S_C2, S_W, S_SP, S_WL = range(8)
# States: in letters, numbers, others, white space; after a space that joins what follows; one or two
# letters of a contraction to come; closed (whatever follows begins a match).
Q_L, Q_N, Q_O, Q_W, Q_P, Q_1, Q_2, Q_X = range(8)


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a match begins, by 8 * symbol + state."""
    to, begins = np.zeros(128, np.uint8), np.zeros(128, bool)
    for symbol in range(16):
        for state in range(8):
            s, q = symbol % 8, Q_X if symbol >= 8 else state
            new, start = {S_L: (Q_L, q not in (Q_L, Q_P)), S_N: (Q_N, q not in (Q_N, Q_P)),
                          S_O: (Q_O, q not in (Q_O, Q_P)), S_C1: (Q_1, True), S_C2: (Q_2, True),
                          S_W: (Q_W, q != Q_W), S_SP: (Q_P, True), S_WL: (Q_X, True)}[s]
            if s == S_L and q in (Q_1, Q_2):
                new, start = (Q_X if q == Q_1 else Q_1), False
            if s in (S_C1, S_C2) and q in (Q_O, Q_P):
                new, start = Q_O, False
            to[8 * symbol + state], begins[8 * symbol + state] = new, start
    return to, begins


@lru_cache(1)
def _classes() -> np.ndarray:
    """Class of every code point, by the Unicode tables of the tiktoken library: of the text of all code
    points, an encoding whose pattern is one class returns just the bytes of that class."""
    import tiktoken

    table = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    points = np.arange(sys.maxunicode + 1, dtype="<u4")
    every = points[(points < 0xD800) | (points > 0xDFFF)].tobytes().decode("utf-32-le")  # no list of a million strings
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks={bytes([b]): b for b in range(256)},
                                  special_tokens={})
        found = bytes(probe.encode_ordinary(every)).decode()
        table[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    return table


def _scan(symbols: np.ndarray) -> np.ndarray:
    """Where matches begin, for the symbols of documents laid end to end."""
    to, begins = _automaton()
    n = len(symbols)
    blocks = -(-n // BLOCK)
    padded = np.full(blocks * BLOCK, S_W, np.uint8)
    padded[:n] = symbols
    columns = np.ascontiguousarray(padded.reshape(blocks, BLOCK).T) << 3
    f = np.repeat(np.arange(8, dtype=np.uint8)[:, None], blocks, axis=1)  # f[s, b]: state after block b from s
    for column in columns:
        f = to[column + f]
    f = np.ascontiguousarray(f.T)
    step = 1
    while step < blocks:  # f[b] becomes the composition of blocks 0..b
        f[step:] = np.take_along_axis(f[step:], f[:-step], axis=1)
        step *= 2
    state = np.empty(blocks, np.uint8)
    state[0], state[1:] = Q_X, f[:-1, Q_X]
    marks = np.empty((BLOCK, blocks), bool)
    for j, column in enumerate(columns):
        at = column + state
        marks[j] = begins[at]
        state = to[at]
    return np.ascontiguousarray(marks.T).reshape(-1)[:n]


def slice_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions where the pattern's matches begin; documents begin at ``offsets``."""
    if not len(data):
        return np.zeros(0, np.int64)
    points = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    kind = _classes()[points]
    n = len(points)
    first = np.zeros(n + 1, bool)
    first[np.searchsorted(lead, offsets)] = True
    ends, first = first[1:], first[:-1]  # ends: the last code point of a document

    def ahead(k):  # the k-th next code point inside the document, else 0
        out = np.zeros(n, np.uint32)
        out[:-k] = points[k:]
        for i in range(k):
            out[:n - i][ends[i:]] = 0
        return out

    a, b = ahead(1), ahead(2)
    symbols = np.where(kind == OTHER, S_O, kind).astype(np.uint8)
    quote = np.flatnonzero(points == 39)
    one = np.isin(a[quote], [ord(c) for c in "stmd"])
    a1, b1 = a[quote], b[quote]
    two = ((a1 == 114) & (b1 == 101)) | ((a1 == 118) & (b1 == 101)) | ((a1 == 108) & (b1 == 108))
    symbols[quote[two]] = S_C2
    symbols[quote[one]] = S_C1
    white = np.flatnonzero(kind == SPACE)
    last = np.zeros(len(white), bool)
    inner = white[white < n - 1]
    last[:len(inner)] = kind[inner + 1] != SPACE
    last &= ~ends[white]
    symbols[white] = np.where(last, np.where(points[white] == 32, S_SP, S_WL), S_W)
    symbols[first] += 8
    return lead[_scan(symbols)]


class Ranks:
    """A rank file's tokens: bytes by id, ids of single bytes, and the id that each pair merges into."""

    def __init__(self, path: str):
        tokens: dict[bytes, int] = {}
        with open(path, "rb") as f:
            for line in f:
                if line.strip():
                    token, rank = line.split()
                    tokens[base64.b64decode(token)] = int(rank)
        self.tokens = tokens
        size = max(tokens.values()) + 1
        by_id = [b""] * size
        for token, rank in tokens.items():
            by_id[rank] = token
        self.lengths = np.array([len(t) for t in by_id], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.bytes = np.frombuffer(b"".join(by_id), np.uint8)
        self.single = np.array([tokens[bytes([b])] for b in range(256)], np.int32)
        keys, ids = [], []
        for token, rank in tokens.items():
            for cut in range(1, len(token)):
                a, b = tokens.get(token[:cut]), tokens.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    ids.append(rank)
        # open addressing, at most a quarter full
        self.bits = max(8, (4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ids = np.full(1 << self.bits, NONE, np.int32)
        keys, ids = np.array(keys, np.int64), np.array(ids, np.int32)
        slots, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = left[self.keys[slots[left]] == -1]
            _, one = np.unique(slots[free], return_index=True)
            put = free[one]
            self.keys[slots[put]], self.ids[slots[put]] = keys[put], ids[put]
            left = left[self.keys[slots[left]] != keys[left]]
            slots[left] = (slots[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The id that each pair merges into, or NONE; an id is also the merge's rank."""
        keys = a.astype(np.int64) << 32 | b
        slots = self._slot(keys)
        found = self.keys[slots]
        out = np.where(found == keys, self.ids[slots], NONE)
        left = np.flatnonzero((found != keys) & (found != -1))
        while len(left):
            slots[left] = (slots[left] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slots[left]]
            hit = found == keys[left]
            out[left[hit]] = self.ids[slots[left[hit]]]
            left = left[~hit & (found != -1)]
        return out


NONE = np.int32(2**31 - 1)


@lru_cache(4)
def ranks_of(path: str) -> Ranks:
    return Ranks(path)


def _merge_long(piece: bytes, ranks: Ranks) -> list[int]:
    """One long slice: a heap of pairs over a linked list."""
    if piece in ranks.tokens:
        return [ranks.tokens[piece]]
    part = [piece[i:i + 1] for i in range(len(piece))]
    after, before = list(range(1, len(part) + 1)), list(range(-1, len(part) - 1))
    heap = [(r, i, part[i], part[i + 1]) for i in range(len(part) - 1)
            if (r := ranks.tokens.get(part[i] + part[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if part[i] != a or j >= len(part) or part[j] != b or not a:
            continue
        part[i], part[j] = a + b, b""
        after[i] = after[j]
        if after[i] < len(part):
            before[after[i]] = i
        for x in (before[i], i):
            y = after[x] if x >= 0 else len(part)
            if y < len(part) and (r := ranks.tokens.get(part[x] + part[y])) is not None:
                heapq.heappush(heap, (r, x, part[x], part[y]))
    return [ranks.tokens[p] for p in part if p]


def merge_slices(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, ranks: Ranks):
    """Token ids of every slice, end to end, and how many each has."""
    counts = np.zeros(len(starts), np.int64)
    ids_of: list[tuple[np.ndarray, np.ndarray]] = []  # slice numbers, repeated, and their ids
    for i in np.flatnonzero(lengths > LONG_SLICE):
        ids = np.array(_merge_long(data[starts[i]:starts[i] + lengths[i]].tobytes(), ranks), np.int32)
        counts[i] = len(ids)
        ids_of.append((np.full(len(ids), i), ids))
    live = np.flatnonzero(lengths <= LONG_SLICE)
    sizes = lengths[live]
    ids = ranks.single[data[ragged(starts[live], sizes)]]
    owner = np.repeat(live, sizes)
    last = np.zeros(len(ids), bool)
    last[np.cumsum(sizes) - 1] = True
    pair = np.full(len(ids), NONE, np.int32)
    if len(ids) > 1:
        pair[:-1] = ranks.merged(ids[:-1], ids[1:])
    pair[last] = NONE
    while len(ids):
        heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        sizes = np.diff(np.append(heads, len(ids)))
        best = np.minimum.reduceat(pair, heads)
        done = np.repeat(best == NONE, sizes)
        if done.any():
            counts[owner[heads[best == NONE]]] = sizes[best == NONE]
            ids_of.append((owner[done], ids[done]))
            go = ~done
            ids, owner, pair = ids[go], owner[go], pair[go]
            sizes, best = sizes[best != NONE], best[best != NONE]
            if not len(ids):
                break
        at = np.flatnonzero(pair == np.repeat(best, sizes))
        at = at[np.concatenate([[True], owner[at[1:]] != owner[at[:-1]]])]  # the leftmost of each slice
        ids[at] = pair[at]
        keep = np.ones(len(ids), bool)
        keep[at + 1] = False
        at = at - np.arange(len(at))
        ids, owner = ids[keep], owner[keep]
        pair[np.flatnonzero(~keep) - 1] = NONE
        pair = pair[keep]
        for left in (at, at[at > 0] - 1):
            inside = left[left + 1 < len(ids)]
            inside = inside[owner[inside] == owner[inside + 1]]
            pair[inside] = ranks.merged(ids[inside], ids[inside + 1])
    if not ids_of:
        return np.zeros(0, np.int32), counts
    who = np.concatenate([w for w, _ in ids_of])
    ids = np.concatenate([x for _, x in ids_of])
    return ids[np.argsort(who, kind="stable")], counts


class Encoder:
    """Encodes Arrow batches of texts, keeping the tokens of slices it has met (at most
    ``CACHE_SLICES``; others are merged anew)."""

    def __init__(self, path: str):
        self.ranks = ranks_of(path)
        self.keys, self.from_, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all tokens, the byte offset of each, and per document its first token (n+1)."""
        starts = slice_starts(data, offsets)
        ends = np.append(starts[1:], len(data))
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
        keys, at, which = np.unique(slice_hashes(data, starts, ends), return_index=True, return_inverse=True)
        slot = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        if len(self.keys):
            known = self.keys[np.minimum(slot, len(self.keys) - 1)] == keys
        new = np.flatnonzero(~known)
        ids, counts = merge_slices(data, starts[at[new]], (ends - starts)[at[new]], self.ranks)
        table = np.concatenate([self.ids, ids])
        from_, count = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
        from_[known], count[known] = self.from_[slot[known]], self.counts[slot[known]]
        from_[new], count[new] = len(self.ids) + np.cumsum(counts) - counts, counts
        if len(self.keys) + len(new) <= CACHE_SLICES:
            order = np.argsort(np.concatenate([self.keys, keys[new]]), kind="stable")
            self.from_ = np.concatenate([self.from_, from_[new]])[order]
            self.counts = np.concatenate([self.counts, counts])[order]
            self.keys, self.ids = np.concatenate([self.keys, keys[new]])[order], table
        per = count[which]
        out = table[ragged(from_[which], per)]
        if not np.array_equal(self.decode(out), data):  # two slices share a 64-bit hash: take each by itself
            out, per = merge_slices(data, starts, ends - starts, self.ranks)
        places = np.cumsum(self.ranks.lengths[out]) - self.ranks.lengths[out]
        firsts = np.append(np.cumsum(per) - per, len(out))
        return out, places, firsts[np.searchsorted(starts, offsets)]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ``ids``, end to end."""
        return self.ranks.bytes[ragged(self.ranks.offsets[ids], self.ranks.lengths[ids])]


def cut_long(data: np.ndarray, offsets: np.ndarray, limit: int) -> np.ndarray:
    """``offsets`` with cuts inside documents longer than ``limit`` bytes, each before an ASCII white
    space that follows ink: a match begins there whatever stands before, so the parts encode as the whole."""
    extra = []
    for d in np.flatnonzero(np.diff(offsets) > limit):
        at, end = int(offsets[d]), int(offsets[d + 1])
        while end - at > limit:
            window = data[at + limit // 2:at + limit]
            white = (window == 32) | ((window >= 9) & (window <= 13))
            ink = (data[at + limit // 2 - 1:at + limit - 1] > 32) & (data[at + limit // 2 - 1:at + limit - 1] < 128)
            found = np.flatnonzero(white & ink)
            at = at + limit // 2 + int(found[-1]) if len(found) else at + limit
            if len(found):
                extra.append(at)
    return np.union1d(offsets, np.array(extra, np.int64)) if extra else offsets


def _encode_batches(arrays, path: str, with_ids: bool):
    encoder = Encoder(path)
    for texts in arrays:
        data, offsets = utf8(texts)
        # a document is one part or, if it is long, several; an empty one has none
        parts = cut_long(data, np.unique(offsets), PIECE_BYTES)
        owner = np.searchsorted(offsets, parts[:-1], "right") - 1
        n = np.zeros(len(offsets) - 1, np.int64)
        ids_sha = [hashlib.sha256() for _ in n]
        text_sha = [hashlib.sha256() for _ in n]
        blobs = [bytearray() for _ in n] if with_ids else []
        for a, b in pieces(parts, PIECE_BYTES):
            part, cut = data[parts[a]:parts[b]], parts[a:b + 1] - parts[a]
            ids, places, first = encoder.encode(part, cut)
            back = memoryview(encoder.decode(ids).tobytes())
            raw = memoryview(ids.astype("<u4").tobytes())
            for k, d in enumerate(owner[a:b].tolist()):
                blob = raw[4 * first[k]:4 * first[k + 1]]
                n[d] += first[k + 1] - first[k]
                ids_sha[d].update(blob)
                text_sha[d].update(back[cut[k]:cut[k + 1]])
                if with_ids:
                    blobs[d] += blob
        columns = {"n_tokens": pa.array(n), "ids_sha256": pa.array([h.hexdigest() for h in ids_sha], pa.string()),
                   "decoded_sha256": pa.array([h.hexdigest() for h in text_sha], pa.string())}
        if with_ids:
            columns["token_ids"] = pa.array([bytes(x) for x in blobs], pa.binary())
        yield pa.StructArray.from_arrays(list(columns.values()), list(columns))


def encoded(text: Column, rank_path: str, with_ids: bool = False) -> Column:
    """A struct of n_tokens, ids_sha256 (of the ids as little-endian uint32), decoded_sha256 (of the
    decoded bytes) and, if asked, token_ids (those ids). A null text counts as empty (no tokens)."""
    kind = "struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string" + (",token_ids:binary" if with_ids else "") + ">"

    def run(arrays):
        return freeing(_encode_batches(arrays, rank_path, with_ids))

    run.__annotations__ = {"arrays": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, kind)(text)


def encode_documents(docs: DataFrame, rank_path: str, with_ids: bool = False) -> DataFrame:
    """Encode the text of every row of ``docs(doc_id, text)`` and decode it again.

    One row per input row, in one pass without a shuffle: doc_id, n_tokens, ids_sha256,
    decoded_sha256 and, if asked, token_ids. Null and empty texts have no tokens; ids may be null
    or repeat; other columns are not read; an empty table gives an empty result. ``rank_path`` must
    be readable on every executor.
    """
    ship_package(docs.sparkSession)
    out = docs.select("doc_id", encoded(F.col("text"), rank_path, with_ids).alias("e"))
    return out.select("doc_id", "e.*")
