"""N-gram language model as a weighted backoff automaton, counted and applied on Spark.

Smoothing: p_k(w | h) = (c(h w) + m * p_(k-1)(w | h')) / (c(h) + m), with h' the history h without
its first token and m the ``strength`` of the prior; it sums to 1 over the vocabulary and one
unknown class. The unigram level gives the unknown class the share (n1 + 0.5) / (N + 1), n1 the
tokens seen once, and the known tokens the rest in proportion to their counts.

As an automaton: every history seen in training is a state; a seen n-gram h w is an arc with weight
log10 p(w | h); a state without an arc for the next token takes its failure arc, of weight
log10(m / (c(h) + m)), to the state h', down to the root, which has an arc for every token.

Counting: documents are dealt by hash into chunks of bounded bytes. A chunk sends its distinct
n-grams (64-bit keys, with their training counts) to shards that own key ranges; a shard sums them
and answers each chunk with the totals of just those keys, in the same order. So a chunk holds the
part of the automaton that its own texts can reach, no task holds the whole model, nothing of it
passes the driver but four sums, and a frequent n-gram is one entry a chunk.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import fold, mix64, ship_package, utf8, written
from tierline.llm.words import word_hashes

ORDER = 2
STRENGTH = 300.0
CHUNK_BYTES = 12 << 20
HELD_OUT = (5, 1)

_END = mix64(np.array([0xE0D], np.uint64))[0]
_BEGIN = mix64(np.array([0xB0 + 1], np.uint64))[0]
_STEP = np.uint64(0x9FB21C651E98DF25)


class Grams:
    """The n-grams of a chunk's documents: per order the sorted distinct keys and, per token, which
    of them ends there."""

    def __init__(self, texts: pa.Array, order: int):
        data, offsets = utf8(texts)
        words, first = word_hashes(data, offsets)
        n = len(offsets) - 1
        self.counts = np.diff(first) + 1
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])
        tokens = np.full(self.starts[-1], _END, np.uint64)
        inside = np.ones(len(tokens), bool)
        inside[self.starts[1:] - 1] = False
        tokens[inside] = words
        self.heads = self.starts[:-1]
        self.doc = np.repeat(np.arange(n), self.counts)
        self.keys, self.ids, self.first = [], [], []
        gram = tokens
        for k in range(1, order + 1):
            if k > 1:
                before = np.empty_like(gram)
                before[1:] = gram[:-1]
                before[self.heads] = mix64(_BEGIN + np.array([k], np.uint64))[0]
                gram = mix64(before * _STEP + tokens)
            keys, at, ids = np.unique(gram, return_index=True, return_inverse=True)
            self.keys.append(keys)
            self.first.append(at)
            self.ids.append(ids.astype(np.int32))


class BackoffAutomaton:
    """The states and arcs that the n-grams of one chunk can reach, from their training totals."""

    def __init__(self, grams: Grams, totals: list[np.ndarray], n: int, n1: int, n_docs: int, strength: float):
        self.grams, self.order = grams, len(totals)
        unknown = 1.0 if n == 0 else (n1 + 0.5) / (n + 1.0)
        c = totals[0].astype(float)
        with np.errstate(divide="ignore"):
            self.root = np.log10(np.where(c > 0, (1 - unknown) * c / max(n, 1), unknown))
        self.arcs, self.seen, self.fail = [self.root], [totals[0] > 0], []
        for k in range(1, self.order):
            # state of order k: its count as a history, and its failure arc; the last index is the start
            held = np.append(totals[k - 1].astype(float), float(n_docs))
            self.fail.append(np.log10(strength / (held + strength)))
            at = grams.first[k]
            state = np.where(np.isin(at, grams.heads), len(held) - 1, grams.ids[k - 1][np.maximum(at - 1, 0)])
            lower = self.arcs[k - 1][grams.ids[k - 1][at]]
            lower_p = np.where(self.seen[k - 1][grams.ids[k - 1][at]], 10.0 ** lower, 0.0)
            self.arcs.append(np.log10(np.maximum(totals[k] + strength * lower_p, 1e-300) / (held[state] + strength)))
            self.seen.append(totals[k] > 0)

    def scores(self) -> np.ndarray:
        """log10 probability of every document: all documents of the chunk take their t-th token
        together, each carrying its state (the order of the longest history it is in)."""
        g, order = self.grams, self.order
        by_length = np.argsort(-g.counts, kind="stable")
        heads, lengths = g.heads[by_length], g.counts[by_length]
        score = np.zeros(len(heads))
        state = np.full(len(heads), order - 1, np.int8)
        seen = [s[i] for s, i in zip(self.seen, g.ids)]
        arcs = [a[i] for a, i in zip(self.arcs, g.ids)]
        fails = []  # per order, per token: the failure arc of the state before it
        for k in range(1, order):
            before = np.empty(len(g.ids[k - 1]), np.int64)
            before[1:] = g.ids[k - 1][:-1]
            before[g.heads] = len(self.fail[k - 1]) - 1
            fails.append(self.fail[k - 1][before])
        alive = np.searchsorted(-lengths, -np.arange(1, (lengths[0] if len(lengths) else 0) + 1), "right")
        for t, m in enumerate(alive):
            at = heads[:m] + t
            here = state[:m]
            gain = arcs[0][at]
            to = np.minimum(seen[0][at], order - 1).astype(np.int8)
            for k in range(1, order):  # from the root up: a state of order >= k has an arc or fails to k-1
                inside = here >= k
                has = seen[k][at]
                gain = np.where(inside, np.where(has, arcs[k][at], gain + fails[k - 1][at]), gain)
                to = np.where(inside & has, np.int8(min(k + 1, order - 1)), to)
            score[:m] += gain
            state[:m] = to
        out = np.empty(len(heads))
        out[by_length] = score
        return out


def _requests(chunk: pa.Table, order: int, shards: int) -> pa.Table:
    """The distinct n-grams of a chunk, cut by shard: keys and training counts."""
    grams = Grams(chunk["text"], order)
    train = ~np.asarray(chunk["held_out"])
    weight = np.repeat(train, grams.counts)
    rows = {"shard": [], "chunk": [], "k": [], "keys": [], "counts": []}
    for k in range(order):
        counts = np.bincount(grams.ids[k], weights=weight, minlength=len(grams.keys[k])).astype(np.uint32)
        cuts = np.searchsorted(_owner(grams.keys[k], shards), np.arange(shards + 1))
        for s in np.flatnonzero(np.diff(cuts)):
            rows["shard"].append(int(s) + k * shards)
            rows["chunk"].append(chunk["chunk"][0].as_py())
            rows["k"].append(k + 1)
            rows["keys"].append(grams.keys[k][cuts[s]:cuts[s + 1]].tobytes())
            rows["counts"].append(counts[cuts[s]:cuts[s + 1]].tobytes())
    return pa.table(rows, schema=pa.schema([("shard", pa.int64()), ("chunk", pa.int64()), ("k", pa.int32()),
                                            ("keys", pa.binary()), ("counts", pa.binary())]))


def _owner(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each key: equal ranges of the key's upper 32 bits, so sorted keys stay sorted."""
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def packed(totals: np.ndarray) -> bytes:
    """Totals in four bytes each, or in eight if one of them needs that; the first byte tells which."""
    wide = 8 if len(totals) and int(totals.max()) >> 32 else 4
    return bytes([wide]) + totals.astype(f"<u{wide}").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def _answers(shard: pa.Table) -> pa.Table:
    """Sum a shard's counts; answer every chunk in its own key order. One row more holds the sums."""
    keys = [np.frombuffer(x.as_buffer(), np.uint64) for x in shard["keys"]]
    counts = [np.frombuffer(x.as_buffer(), np.uint32) for x in shard["counts"]]
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.bincount(at, weights=np.concatenate(counts), minlength=len(distinct)).astype(np.int64)
    answers = np.split(totals[at], np.cumsum([len(x) for x in keys])[:-1])
    first = shard["k"][0].as_py() == 1
    sums = [int(totals.sum(dtype=np.int64)), int((totals > 0).sum()), int((totals == 1).sum())] if first else [0, 0, 0]
    n = len(answers)
    return pa.table({
        "chunk": pa.array([*shard["chunk"].to_pylist(), -1], pa.int64()),
        "shard": pa.array([*shard["shard"].to_pylist(), -1], pa.int64()),
        "totals": pa.array([*(packed(x) for x in answers), b""], pa.binary()),
        "n": pa.array([0] * n + sums[:1], pa.int64()), "v": pa.array([0] * n + sums[1:2], pa.int64()),
        "n1": pa.array([0] * n + sums[2:], pa.int64())})


def _scores(docs: pa.Table, answers: pa.Table, order: int, shards: int, n: int, v: int, n1: int, n_docs: int,
            strength: float) -> pa.Table:
    grams = Grams(docs["text"], order)
    by_order: list[list[tuple[int, bytes]]] = [[] for _ in range(order)]
    for s, x in zip(answers["shard"].to_pylist(), answers["totals"].to_pylist()):
        by_order[s // shards].append((s, x))
    totals = [np.concatenate([np.zeros(0, np.int64), *(unpacked(x) for _, x in sorted(part))]) for part in by_order]
    score = BackoffAutomaton(grams, totals, n, n1, n_docs, strength).scores()
    c = totals[0][grams.ids[0]]
    floor = math.log10(n + 0.5 * (v + 1))
    base = np.bincount(grams.doc, weights=np.log10(c + 0.5) - floor, minlength=len(grams.counts))
    known = np.bincount(grams.doc, weights=c > 0, minlength=len(grams.counts))
    return pa.table({"doc_id": docs["doc_id"], "held_out": docs["held_out"],
                     "n_tokens": pa.array(grams.counts, pa.int64()), "n_known": pa.array(known.astype(np.int64)),
                     "train_tokens": pa.array(np.full(len(grams.counts), n, np.int64)),
                     "base_score": pa.array(base), "score": pa.array(score)})


def score_documents(docs: DataFrame, order: int = ORDER, strength: float = STRENGTH,
                    chunk_bytes: int = CHUNK_BYTES, held_out: tuple[int, int] = HELD_OUT) -> DataFrame:
    """Train on the documents whose crc32(doc_id) mod held_out[0] is not held_out[1]; score all.

    ``docs(doc_id, text)``; other columns are not read. One row per input row: doc_id, held_out,
    n_tokens, n_known, train_tokens, base_score, score. Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z
    lower-cased; every document ends in one end token, also an empty or null one. A null id counts
    as remainder 0 (so it trains). With no training rows every token is unknown, with score 0.
    Rows that repeat an id are rows of their own. An empty table gives an empty result.
    """
    ship_package(docs.sparkSession)
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    base = base.withColumn("held_out", fold(F.col("doc_id"), held_out[0]) == held_out[1])
    size = base.agg(F.sum(F.octet_length("text").cast("long") + 64), F.count_if(~F.col("held_out"))).first()
    chunks = max(1, math.ceil((size[0] or 0) / chunk_bytes))
    n_docs = int(size[1] or 0)
    dealt = base.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))
    asked = dealt.groupBy("chunk").applyInArrow(lambda t: _requests(t, order, chunks),
                                                "shard long, chunk long, k int, keys binary, counts binary")
    told = written(asked.groupBy("shard").applyInArrow(
        _answers, "chunk long, shard long, totals binary, n long, v long, n1 long"), "lm-totals")
    sums = told.filter("chunk = -1").agg(F.sum("n"), F.sum("v"), F.sum("n1")).first()
    n, v, n1 = (int(x or 0) for x in sums)
    told = told.filter("chunk >= 0").select("chunk", "shard", "totals")
    return dealt.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(
        lambda d, a: _scores(d, a, order, chunks, n, v, n1, n_docs, strength),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
