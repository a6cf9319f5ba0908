"""Repeated passages: shared k-mer seeds, collinear chains by a Fenwick tree, and alignment.

1. Seeds. Every word k-mer is a seed (with ``window`` > 1 the smallest hash of that many consecutive
   ones), so two texts that share ``k + window - 1`` words in a row share a seed. A seed's first position in
   the corpus, in order of (doc_id, word), is its origin; every later one is an anchor (document, word) -> (origin
   document, origin word). A passage that a third of all documents share thus makes one anchor a seed
   and document, not pairs of documents.
   Windows of ``min_words`` words whose seeds have scattered origins get a first place and anchors too, so
   an exact passage is tied to the document that has it whole.
2. Chains. The anchors between two documents are chained in order: f(i) = gain + max over earlier
   anchors j of f(j) - cost * (gaps on both sides). The gap cost is linear, so the best j is a prefix
   maximum over origin words, kept in a Fenwick tree.
3. Alignment. Gaps between the anchors of a chain are aligned by their longest common subsequence,
   and the ends are extended through single mismatches. What is long and alike enough is a passage.

Seeds, anchors and chains travel as packed arrays (``blocks``), never as a row each. A chain goes to
its source with hashes of the few words around it; only pairs with a chain that may reach
``min_words`` there are sent again, with the words they need, to be aligned. No chain is left out
before that test, and the test never fails a chain that alignment would make long enough.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.blocks import binary, bucket_of, column_values, dealt, pack, sizes, unpack, values
from tierline.llm.common import mix64, pieces, ship_package, utf8, written
from tierline.llm.words import word_hashes, word_spans
from tierline.session import shuffle_partitions

K = 5
WINDOW = 1
MIN_WORDS = 50
MIN_IDENTITY = 0.8
MAX_GAP = 100
GAIN, GAP_COST = 5.0, 0.05
DROP = 8
PIECE_BYTES = 1 << 20
BUCKET_BYTES = 8 << 20  # text behind one bucket of seeds, anchors or sources
FLUSH = 1 << 20  # seeds packed at a time
CONTEXT, WIDE = 16, 64  # words looked at beside a chain, at first and before it is aligned
SLICE = 1 << 14  # chains looked at together
MARGIN = 256  # words sent beside the chains to align; where they don't suffice, all are
UNIT = 1 << 18  # chains that meet one bucket of sources in one place
HOT_SAMPLE, HOT_SEEDS, HOT_MOST = 32, 1 << 20, 1 << 16


def seeds(data: np.ndarray, offsets: np.ndarray, k: int, window: int):
    """Hash, document and first word of every selected k-mer."""
    words, first = word_hashes(data, offsets)
    count = np.maximum(np.diff(first) - k + 1, 0)
    doc = np.repeat(np.arange(len(count)), count)
    begin = np.cumsum(count) - count
    at = np.arange(len(doc)) - begin[doc] + first[:-1][doc]  # the k-mer's first word in the batch
    if len(at) < window:
        return np.zeros(0, np.uint64), np.zeros(0, int), np.zeros(0, int)
    h = words[at]
    for j in range(1, k):
        h = mix64(h * np.uint64(0x9FB21C651E98DF25) + words[at + j])
    if window == 1:
        return h, doc, at - first[:-1][doc]
    view = np.lib.stride_tricks.sliding_window_view(h, window)
    inside = doc[:len(view)] == doc[window - 1:]
    chosen = np.empty(len(view), np.int64)
    for a in range(0, len(view), 65536):
        chosen[a:a + 65536] = view[a:a + 65536].argmin(1)
    chosen = np.unique((np.arange(len(view)) + chosen)[inside])
    return h[chosen], doc[chosen], chosen - begin[doc[chosen]]


_KEYED = {"h": np.uint64, "doc_id": np.int64, "word": np.int32}
_PLACED = {"doc_id": np.int64, "word": np.int32, "src": np.int64, "src_word": np.int32, "flag": np.uint8}


def _schema(columns) -> str:
    return "bucket int, " + ", ".join(f"{c} binary" for c in columns)


def _text_seeds(batches, k: int, window: int):
    """(hash, document, word) of all seeds, about ``FLUSH`` at a time."""
    held, n = [], 0
    for batch in batches:
        data, offsets = utf8(batch["text"])
        ids = np.asarray(batch["doc_id"])
        for a, b in pieces(offsets, PIECE_BYTES):
            h, doc, word = seeds(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], k, window)
            held.append((h, ids[a:b][doc], word.astype(np.int32)))
            n += len(h)
            if n >= FLUSH:
                yield [np.concatenate(c) for c in zip(*held)]
                held, n = [], 0
    if held:
        yield [np.concatenate(c) for c in zip(*held)]


def _window_seeds(batches, sample: int = 1):
    """The same of packed window hashes, or of a ``sample``-th of the documents."""
    for batch in batches:
        h, doc, word = (column_values(batch, c, 0, batch.num_rows, t) for c, t in _KEYED.items())
        if sample > 1:
            mine = bucket_of(doc, sample) == 0
            h, doc, word = h[mine], doc[mine], word[mine]
        yield h, doc, word


def _counts(found):
    for h, _, _ in found:
        key, n = np.unique(h, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], ["h", "n"])


def _places(h: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each hash is one of ``hot`` (ascending), and which."""
    if not len(hot):
        return np.zeros(len(h), bool), np.zeros(len(h), int)
    at = np.minimum(np.searchsorted(hot, h), len(hot) - 1)
    return hot[at] == h, at


def _keyed_blocks(found, buckets: int, hot: np.ndarray):
    for h, doc, word in found:
        if len(hot):
            mine = ~_places(h, hot)[0]
            h, doc, word = h[mine], doc[mine], word[mine]
        yield pack((h % np.uint64(buckets)).astype(np.int32), {"h": h, "doc_id": doc, "word": word})


def _hot_firsts(found, hot: np.ndarray):
    """The first place of each hot seed in each piece."""
    for h, doc, word in found:
        mine, at = _places(h, hot)
        at, doc, word = at[mine], doc[mine], word[mine]
        order = np.lexsort((word, doc, at))
        order = order[np.append(True, np.diff(at[order]) != 0)] if len(order) else order
        yield pa.RecordBatch.from_arrays([pa.array(hot[at[order]].view(np.int64)), pa.array(doc[order]),
                                          pa.array(word[order])], ["h", "doc_id", "word"])


def _hot_blocks(found, hot: np.ndarray, src: np.ndarray, src_word: np.ndarray, buckets: int, flag: int):
    for h, doc, word in found:
        mine, at = _places(h, hot)
        yield _anchor_block(doc[mine], word[mine], src[at[mine]], src_word[at[mine]], buckets, flag)


def _anchor_block(doc, word, src, src_word, buckets: int, flag: int) -> pa.RecordBatch:
    if flag:  # of windows, the first place itself is of no use
        later = (doc != src) | (word != src_word)
        doc, word, src, src_word = doc[later], word[later], src[later], src_word[later]
    return pack(bucket_of(doc, buckets), {"doc_id": doc, "word": word, "src": src, "src_word": src_word,
                                          "flag": np.full(len(doc), flag, np.uint8)})


def _origin_blocks(batches, buckets: int, flag: int):
    """Rows of hashes that stand twice or more, each with the hash's first place."""
    for _, (h, doc, word) in unpack(batches, _KEYED):
        order = np.argsort(h)
        key = h[order]
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        n = np.diff(np.append(starts, len(h)))
        order, n = order[np.repeat(n > 1, n)], n[n > 1]
        if not len(order):
            continue
        begin = np.cumsum(n) - n
        d, w = doc[order], word[order]
        first = np.repeat(np.minimum.reduceat(d, begin), n)
        first_word = np.repeat(np.minimum.reduceat(np.where(d == first, w, np.iinfo(np.int32).max), begin), n)
        src, src_word, mine = np.empty_like(doc), np.empty_like(word), np.zeros(len(doc), bool)
        src[order], src_word[order], mine[order] = first, first_word, True
        yield _anchor_block(doc[mine], word[mine], src[mine], src_word[mine], buckets, flag)


def _first_places(rows: DataFrame, found, sample: DataFrame, sampled, buckets: int, parts: int, flag: int) -> DataFrame:
    """Packed anchors, by document, of the hashes that ``found`` reads from ``rows``. Hashes with more
    rows than half a bucket, as a sample shows (the ``HOT_MOST`` most frequent at most), don't meet in one
    task: their first places are aggregated and go to all tasks."""
    often = sample.mapInArrow(lambda it: _counts(sampled(it)), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    often = often.filter(F.col("n") > HOT_SEEDS // HOT_SAMPLE).orderBy(F.desc("n"), "h").limit(HOT_MOST).collect()
    hot = np.sort(np.array([r["h"] for r in often], np.int64).view(np.uint64))
    schema = _schema(_PLACED)
    met = dealt(rows.mapInArrow(lambda it: _keyed_blocks(found(it), buckets, hot), _schema(_KEYED)), parts)
    out = met.mapInArrow(lambda it: _origin_blocks(it, buckets, flag), schema)
    if len(hot):
        firsts = rows.mapInArrow(lambda it: _hot_firsts(found(it), hot), "h long, doc_id long, word int").groupBy("h").agg(
            F.min(F.struct("doc_id", "word")).alias("o")).select("h", "o.doc_id", "o.word").collect()
        firsts = {r["h"]: (r["doc_id"], r["word"]) for r in firsts}
        place = [firsts.get(h, (0, 0)) for h in hot.view(np.int64).tolist()]
        src, src_word = np.array([p[0] for p in place], np.int64), np.array([p[1] for p in place], np.int32)
        out = out.unionByName(rows.mapInArrow(lambda it: _hot_blocks(found(it), hot, src, src_word, buckets, flag), schema))
    return out


def _runs(doc: np.ndarray, word: np.ndarray, src: np.ndarray, src_word: np.ndarray, step: int) -> np.ndarray:
    """Of a run on one diagonal every ``step``-th row and the last."""
    link = _links(doc, word) & (src[1:] == src[:-1]) & (src_word[1:] == src_word[:-1] + 1)
    begins = np.flatnonzero(np.append(True, ~link))
    at = np.arange(len(doc)) - np.repeat(begins, np.diff(np.append(begins, len(doc))))
    return (at % max(step, 1) == 0) | np.append(~link, True)


def _thinned_blocks(batches, k: int, min_words: int, buckets: int):
    """From the repeated seeds of a bucket of documents, two kinds of rows.

    Anchors (kind 0), thinned: of a run on one diagonal every k-th and the last, which cover the same
    words. And the hashes of windows of ``min_words`` words whose seeds all stand twice but don't have
    their origins side by side (kind 1): such a window may have a first place of its own, which no seed
    tells. (Where the origins are side by side, the whole window stands there.)
    """
    size = max(min_words - k, 0) + 1  # seeds in a window
    for bucket, (doc, word, src, src_word, flag) in unpack(batches, _PLACED):
        order = np.lexsort((word, doc))
        if ((np.diff(doc[order]) == 0) & (np.diff(word[order]) == 0)).any():
            order = np.lexsort((src_word, src, word, doc))
        doc, word, src, src_word = doc[order], word[order], src[order], src_word[order]
        keep = _runs(doc, word, src, src_word, k) & ((src != doc) | (src_word != word))
        yield _kind(0, pack(np.full(int(keep.sum()), bucket, np.int32), {
            "h": None, "doc_id": doc[keep], "word": word[keep], "src": src[keep], "src_word": src_word[keep],
            "flag": flag[keep]}))
        lone = np.append(True, doc[1:] != doc[:-1]) | np.append(True, word[1:] != word[:-1])
        d, w, s, o = doc[lone], word[lone], src[lone], src_word[lone]  # rows that repeat an id: one seed a word
        if len(d) < size:
            continue
        next_word = _links(d, w)
        breaks = np.concatenate([[0], np.cumsum(~next_word)])
        turns = np.concatenate([[0], np.cumsum(~(next_word & (s[1:] == s[:-1]) & (o[1:] == o[:-1] + 1)))])
        n = len(d) - size + 1
        at = np.flatnonzero((breaks[size - 1:] == breaks[:n]) & (turns[size - 1:] != turns[:n]))
        if not len(at):
            continue
        # a seed's origin names the seed
        g = mix64(mix64(s.view(np.uint64)) * np.uint64(0x9FB21C651E98DF25) + o.astype(np.uint64))
        h = np.zeros(len(at), np.uint64)
        for j in [*range(0, size - 1, k), size - 1]:
            h = mix64(h * np.uint64(0x9FB21C651E98DF25) + g[at + j])
        yield _kind(1, pack((h % np.uint64(buckets)).astype(np.int32), {
            "h": h, "doc_id": d[at], "word": w[at], "src": None, "src_word": None, "flag": None}))


def _kind(kind: int, batch: pa.RecordBatch) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(batch.num_rows, kind, np.int32)), *batch.columns],
                                      ["kind", *batch.schema.names])


def _links(doc: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Whether the next row is the next word of the same document."""
    return (doc[1:] == doc[:-1]) & (word[1:] == word[:-1] + 1)


def chain(x: np.ndarray, y: np.ndarray, max_gap: int = MAX_GAP) -> list[list[int]]:
    """The chains among anchors (x ascending), best first, as lists of places; each anchor is in one."""
    n = len(x)
    if n > 1 and (np.diff(y) == np.diff(x)).all() and np.diff(x).min() > 0 and np.diff(x).max() <= max_gap:
        return [list(range(n))]  # one diagonal: the chain is plain
    ranks = np.unique(y, return_inverse=True)[1] + 1
    size = int(ranks.max()) + 1
    tree_value, tree_at = [-1e18] * size, [-1] * size
    score, before = [0.0] * n, [-1] * n
    waiting: list[int] = []
    xs, ys, rs = x.tolist(), y.tolist(), ranks.tolist()
    for i in range(n):
        if waiting and xs[waiting[0]] < xs[i]:  # anchors at one word don't follow each other
            for j in waiting:
                value, r = score[j] + GAP_COST * (xs[j] + ys[j]), rs[j]
                while r < size:
                    if value > tree_value[r]:
                        tree_value[r], tree_at[r] = value, j
                    r += r & -r
            waiting = []
        best, at, r = -1e18, -1, rs[i] - 1
        while r > 0:
            if tree_value[r] > best:
                best, at = tree_value[r], tree_at[r]
            r -= r & -r
        gain = best - GAP_COST * (xs[i] + ys[i])
        if at >= 0 and gain > 0:
            score[i], before[i] = GAIN + gain, at
        else:
            score[i] = GAIN
        waiting.append(i)
    out, used = [], [False] * n
    for i in sorted(range(n), key=lambda i: -score[i]):
        part = []
        while i >= 0 and not used[i]:
            used[i] = True
            part.append(i)
            i = before[i]
        part.reverse()
        cut = 0
        for j in range(1, len(part)):
            if xs[part[j]] - xs[part[j - 1]] > max_gap or ys[part[j]] - ys[part[j - 1]] > max_gap:
                out.append(part[cut:j])
                cut = j
        if part:
            out.append(part[cut:])
    return out


def _chains(doc: np.ndarray, src: np.ndarray, x: np.ndarray, y: np.ndarray, max_gap: int):
    """The chains of anchors sorted by (document, source, x, y): the anchors in order of chains, and
    which begin one. Anchors more than ``max_gap`` apart never share a chain, so stretches between such
    gaps are chained on their own; plain stretches (one anchor, two, one diagonal) need no tree."""
    n = len(doc)
    dx, dy = np.diff(x.astype(np.int64)), np.diff(y.astype(np.int64))
    joined = (doc[1:] == doc[:-1]) & (src[1:] == src[:-1]) & (dx <= max_gap)
    begins = np.flatnonzero(np.append(True, ~joined))
    count = np.diff(np.append(begins, n))
    crooked = np.zeros(len(begins), bool)
    crooked[np.repeat(np.arange(len(begins)), count)[1:][joined & ~((dx == dy) & (dx > 0))]] = True
    order, start = np.arange(n), np.zeros(n, bool)
    start[begins] = True
    i = begins[crooked & (count == 2)]
    linked = (dx[i] > 0) & (dy[i] > 0) & (dy[i] <= max_gap) & (GAIN - GAP_COST * (dx[i] + dy[i]) > 0)
    start[i[~linked] + 1] = True
    for a, b in zip(begins[crooked & (count > 2)].tolist(), (begins + count)[crooked & (count > 2)].tolist()):
        at = x[a:b].tolist()
        parts = sorted(chain(x[a:b], y[a:b], max_gap), key=lambda part: at[part[0]])
        order[a:b] = [a + i for part in parts for i in part]
        start[list(accumulate((len(part) for part in parts[:-1]), initial=a))] = True
    return order, start


_CHAINS = {"src": np.int64, "chains": np.int32, "lens": np.int32, "xs": np.int32, "ys": np.int32}
_CHAIN_ROW = "doc_id long, " + ", ".join(f"{c} binary" for c in _CHAINS)


def _chain_rows(batches, max_gap: int, min_words: int, k: int):
    """One row a document: its sources, the chains with each (``chains``), the anchors of each chain
    (``lens``) and the anchors (``xs``, ``ys``), end to end."""
    for _, (doc, word, src, src_word, flag) in unpack(batches, _PLACED):
        late = np.flatnonzero(flag)
        order = late[np.lexsort((word[late], doc[late]))]
        order = np.append(np.flatnonzero(flag == 0),
                          order[_runs(doc[order], word[order], src[order], src_word[order], min_words - k)])
        order = order[np.lexsort((src_word[order], word[order], src[order], doc[order]))]
        doc, word, src, src_word = doc[order], word[order], src[order], src_word[order]
        if not len(doc):
            continue
        pair = (doc[1:] != doc[:-1]) | (src[1:] != src[:-1])
        new = np.append(True, pair | (word[1:] != word[:-1]) | (src_word[1:] != src_word[:-1]))
        doc, word, src, src_word = doc[new], word[new], src[new], src_word[new]
        order, start = _chains(doc, src, word, src_word, max_gap)
        chains = np.append(np.flatnonzero(start), len(doc))
        pairs = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (src[1:] != src[:-1])))
        docs = np.append(np.flatnonzero(np.append(True, doc[1:] != doc[:-1])), len(doc))
        of_pair = np.searchsorted(chains, np.append(pairs, len(doc)))
        by_pair, by_chain = np.searchsorted(pairs, docs), np.searchsorted(chains, docs)
        yield pa.RecordBatch.from_arrays([
            pa.array(doc[docs[:-1]]), binary(src[pairs], by_pair), binary(np.diff(of_pair).astype(np.int32), by_pair),
            binary(np.diff(chains).astype(np.int32), by_chain), binary(word[order], docs), binary(src_word[order], docs),
        ], ["doc_id", *_CHAINS])


def common_subsequence(a: list, b: list) -> int:
    """Length of the longest common subsequence, with one bit a position of ``a``."""
    masks: dict = {}
    for i, v in enumerate(a):
        masks[v] = masks.get(v, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for v in b:
        hit = row & masks.get(v, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _extend(same: np.ndarray, drop: int) -> tuple[int, bool]:
    """How far to go along equal (True) and unequal words: +1 and -1, until ``drop`` below the best.
    Also whether the way ended by that, not for lack of words."""
    if not len(same):
        return 0, False
    s = np.cumsum(np.where(same, 1, -1))
    low = np.flatnonzero(np.maximum.accumulate(np.maximum(s, 0)) - s > drop)
    s = s[:low[0]] if len(low) else s
    best = int(s.argmax()) if len(s) else 0
    return (best + 1 if len(s) and s[best] > 0 else 0), bool(len(low))


def align(u: np.ndarray, v: np.ndarray, xs: np.ndarray, ys: np.ndarray, k: int = K, drop: int = DROP,
          apart: bool = False):
    """The passage around a chain: its range in ``u``, its range in ``v``, and the aligned words. ``apart``:
    both are one text, and the range in ``v`` ends where the one in ``u`` begins, or before."""
    return _align(u, v, xs, ys, k, drop, apart)[:5]


def _align(u, v, xs, ys, k: int, drop: int = DROP, apart: bool = False, more: tuple[bool, bool] = (False, False)):
    """``align``, and whether the answer may change if ``u`` went on where ``more`` says (left, right)."""
    x0, y0 = int(xs[0]), int(ys[0])
    if apart:
        v = v[:x0]
        fit = ys + k <= x0
        xs, ys = xs[fit], ys[fit]
        if not len(xs):
            return x0, x0, y0, y0, 0, False
    x, y, matched = int(xs[-1]) + k, int(ys[-1]) + k, 0
    if x - x0 == y - y0 and (u[x0:x] == v[y0:y]).all() and (xs - ys == x0 - y0).all():
        matched = x - x0
    else:
        x, y = x0, y0
        for a, b in zip(xs.tolist(), ys.tolist()):
            if a < x or b < y:  # overlaps what is aligned already
                shift = max(x - a, y - b)
                if shift >= k:
                    continue
                a, b, n = a + shift, b + shift, k - shift
            else:
                n = k
            if a - x and b - y:
                p, q = u[x:a], v[y:b]
                matched += int((p == q).sum()) if len(p) == len(q) and len(p) <= 2 else common_subsequence(p.tolist(), q.tolist())
            matched += int((u[a:a + n] == v[b:b + n]).sum())
            x, y = a + n, b + n
    n = min(len(u) - x, len(v) - y)
    open_right = more[1] and n < len(v) - y
    same = u[x:x + n] == v[y:y + n]
    n, ended = _extend(same, drop)
    open_right &= not ended
    x, y, matched = x + n, y + n, matched + int(same[:n].sum())
    n = min(x0, y0, x0 - y if apart else x0)
    open_left = more[0] and n < y0
    same = (u[x0 - n:x0] == v[y0 - n:y0])[::-1]
    n, ended = _extend(same, drop)
    return x0 - n, x, y0 - n, y, matched + int(same[:n].sum()), bool(open_right or (open_left and not ended))


def _around(words, lo, hi, begin, end, pad: int, width: int = CONTEXT) -> np.ndarray:
    """15 bits of each of the ``width`` words before ``begin`` (nearest first) and from ``end`` on, in
    the document whose words are ``words[lo:hi]``."""
    step = np.arange(width)
    out = np.empty((len(begin), 2 * width), np.uint16)
    short = (words if len(words) else np.zeros(1, np.uint64)).astype(np.uint16) & np.uint16(0xFFFE)
    for a in range(0, len(begin), SLICE):
        part = slice(a, a + SLICE)
        at = np.concatenate([begin[part, None] - 1 - step, end[part, None] + step], 1)
        inside = (at >= lo[part, None]) & (at < hi[part, None])
        out[part] = np.where(inside, short[np.clip(at, 0, len(short) - 1)], np.uint16(pad))
    return out


def _far(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """How far chains may be extended, at most, by what stands around them on both sides."""
    out = np.empty(len(u), np.int64)
    for a in range(0, len(u), SLICE):
        same = u[a:a + SLICE] == v[a:a + SLICE]
        out[a:a + SLICE] = reach(same[:, :same.shape[1] // 2]) + reach(same[:, same.shape[1] // 2:])
    return out


def reach(same: np.ndarray, drop: int = DROP) -> np.ndarray:
    """``_extend`` on every row; rows that may go on beyond the last column count as very long."""
    s = np.cumsum(np.where(same, 1, -1), 1)
    best = np.maximum.accumulate(np.maximum(s, 0), 1)
    over = best - s > drop
    ended = over.any(1)
    s = np.where(np.maximum.accumulate(over, 1), -1, s)
    return np.where(ended, np.where(s.max(1) > 0, s.argmax(1) + 1, 0), 1 << 20)


def _flat(batch: pa.RecordBatch, k: int):
    """Of rows with packed chains: the row, source and ends of every chain."""
    n = batch.num_rows
    src, per_pair, lens, xs, ys = (values(batch[c], 0, n, t) for c, t in _CHAINS.items())
    row = np.repeat(np.repeat(np.arange(n), sizes(batch["src"], np.int64)), per_pair)
    end = np.cumsum(lens)
    a, b = end - lens, end - 1
    return row, np.repeat(src, per_pair), xs[a], xs[b] + k, ys[a], ys[b] + k


_LOOK = {"doc": np.int64, "src": np.int64, "n": np.int32, "y0": np.int32, "y1": np.int32, "around": np.uint16}


def _look_blocks(batches, k: int, buckets: int):
    """Every chain with what stands around it in its own document, packed by source."""
    for batch in batches:
        row, src, x0, x1, y0, y1 = _flat(batch, k)
        words, first = _hashes(batch["text"])
        lo, hi = first[row], first[row + 1]
        mine = x1 <= hi - lo  # else the chain belongs to another row of the same id
        row, src, x0, x1, y0, y1, lo, hi = (c[mine] for c in (row, src, x0, x1, y0, y1, lo, hi))
        around = _around(words, lo, hi, lo + x0, lo + x1, 1)
        yield pack(bucket_of(src, buckets), {
            "doc": np.asarray(batch["doc_id"])[row], "src": src, "n": np.maximum(x1 - x0, y1 - y0).astype(np.int32),
            "y0": y0.astype(np.int32), "y1": y1.astype(np.int32), "around": around})


def _hashes(texts) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = utf8(texts)
    return word_hashes(data, offsets)


class _Sources:
    """The texts of a bucket as word hashes, found by id; ``times`` rows share one id at most."""

    def __init__(self, slices: list[pa.RecordBatch]):
        t = pa.Table.from_batches(slices)
        ids = np.asarray(t["doc_id"])
        self.words, first = _hashes(t["text"])
        order = np.argsort(ids, kind="stable")
        self.ids, self.lo, self.hi = ids[order], first[:-1][order], first[1:][order]
        self.times = int(np.unique(ids, return_counts=True)[1].max())

    def find(self, src: np.ndarray):
        """For every row that shares the ids: whether there is one, and the ranges of its words."""
        at = np.searchsorted(self.ids, src)
        for r in range(self.times):
            i = np.minimum(at + r, len(self.ids) - 1)
            yield (at + r < len(self.ids)) & (self.ids[i] == src), self.lo[i], self.hi[i]


def _met(batches):
    """(sources, requests) from rows in order of (bucket, salt, kind): texts, then what is asked of them."""
    now, slices, sources = None, [], None
    for batch in batches:
        b, salt, kind = (np.asarray(batch[c]).astype(np.int64) for c in ("bucket", "salt", "kind"))
        if not len(b):
            continue
        cuts = [0, *(np.flatnonzero((np.diff(b) != 0) | (np.diff(salt) != 0) | (np.diff(kind) != 0)) + 1).tolist(), len(b)]
        for s, e in zip(cuts[:-1], cuts[1:]):
            if (b[s], salt[s]) != now:
                now, slices, sources = (b[s], salt[s]), [], None
            part = batch.slice(s, e - s)
            if kind[s] == 0:
                slices.append(part.select(["doc_id", "text"]))
            elif slices:
                sources = sources or _Sources(slices)
                yield sources, part


def _look(batches, min_words: int):
    """The pairs with a chain whose ends can be extended to ``min_words`` words."""
    for sources, part in _met(batches):
        doc, src, n, y0, y1, around = (values(part[c], 0, part.num_rows, t) for c, t in _LOOK.items())
        around = around.reshape(-1, 2 * CONTEXT)
        good = doc == src  # a document that repeats itself is aligned in any case
        for there, lo, hi in sources.find(src):
            at = np.flatnonzero(there & ~good & (y1 <= hi - lo))
            lo, hi = lo[at], hi[at]
            there = _around(sources.words, lo, hi, lo + y0[at], lo + y1[at], 3)
            good[at[_far(around[at], there) + n[at] >= min_words]] = True
        found = np.unique(np.stack([doc[good], src[good]], 1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["doc_id", "src"])


_ASK = {"xs": np.int32, "ys": np.int32, "lens": np.int32, "u": np.uint64}
_ASK_ROW = "bucket int, doc long, src long, x_from int, more_left boolean, more_right boolean, " + ", ".join(f"{c} binary" for c in _ASK)


def _ask_rows(batches, k: int, buckets: int, margin: int | None):
    """A row a pair to align: its chains and its document's words from ``margin`` before the first to
    ``margin`` after the last (None: all words)."""
    names = ["bucket", "doc", "src", "x_from", "more_left", "more_right", *_ASK]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), *[pa.binary()] * 4]
    for batch in batches:
        words, first = _hashes(batch["text"])
        rows: list[list] = [[] for _ in names]
        for i in range(batch.num_rows):
            src, per_pair, lens, xs, ys = (values(batch[c], i, i + 1, t) for c, t in _CHAINS.items())
            want = set(batch["want"][i].as_py())
            u, doc = words[first[i]:first[i + 1]], batch["doc_id"][i].as_py()
            chain_end, anchor_end = np.cumsum(per_pair), np.append(0, np.cumsum(lens))
            place = bucket_of(src, buckets)
            for j in np.flatnonzero([s in want for s in src.tolist()]).tolist():
                c0, c1 = chain_end[j] - per_pair[j], chain_end[j]
                a, b = anchor_end[c0], anchor_end[c1]
                x, end = xs[a:b], int(xs[a:b].max()) + k
                if end > len(u):
                    continue  # the chains belong to another row of the same id
                p, q = (0, len(u)) if margin is None or src[j] == doc else (max(int(x.min()) - margin, 0), min(end + margin, len(u)))
                for out, value in zip(rows, (int(place[j]), doc, int(src[j]), p, p > 0, q < len(u), (x - p).astype(np.int32).tobytes(),
                                             ys[a:b].tobytes(), lens[c0:c1].tobytes(), u[p:q].tobytes())):
                    out.append(value)
                if len(rows[0]) >= 2048:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], names)
                    rows = [[] for _ in names]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], names)


_SPAN_NAMES = ["doc_id", "start_word", "n_words", "src_doc_id", "src_start_word", "src_n_words", "matched_words"]


def _align_rows(batches, k: int, min_words: int, min_identity: float):
    """The passages of the pairs asked for. A pair whose passage may go on beyond the words that came along
    gives one row marked ``open``, with nothing but its documents."""
    for sources, part in _met(batches):
        rows = []
        src = np.asarray(part["src"])
        found = list(sources.find(src))
        for i in range(part.num_rows):
            doc, p = part["doc"][i].as_py(), part["x_from"][i].as_py()
            more = (part["more_left"][i].as_py(), part["more_right"][i].as_py())
            xs, ys, lens, u = (values(part[c], i, i + 1, t) for c, t in _ASK.items())
            for there, lo, hi in found:
                v = sources.words[lo[i]:hi[i]]
                if there[i] and ys.max() + k <= len(v):  # else the chains belong to another row of the same id
                    rows += _spans(doc, int(src[i]), u, v, xs, ys, lens, p, more, k, min_words, min_identity)
        yield pa.RecordBatch.from_arrays([*(pa.array([r[c] for r in rows], pa.int64()) for c in range(7)),
                                          pa.array([r[7] for r in rows], pa.bool_())], [*_SPAN_NAMES, "open"])


def _spans(doc: int, src: int, u, v, xs, ys, lens, x_from: int, more, k: int, min_words: int, min_identity: float) -> list:
    rows, done = [], -1  # done: where the last passage found ends
    again = np.isin(ys, np.flatnonzero(np.bincount(ys) > 1))  # periodic text: seeds with one origin
    end = np.cumsum(lens)
    first, last = end - lens, end - 1
    if len(lens) > 2:  # all ends are looked at together, with more words around them than before
        none, x0, y0, x1, y1 = np.zeros(len(lens), int), xs[first], ys[first], xs[last] + k, ys[last] + k
        far = _far(_around(u, none, none + len(u), x0, x1, 1, WIDE), _around(v, none, none + len(v), y0, y1, 3, WIDE))
        if doc == src:  # both ways together end where the ranges meet
            far = np.minimum(far, x0 - y1)
        live = far + np.maximum(x1 - x0, y1 - y0) >= min_words
        if doc == src:  # ranges that overlap are trimmed, which may change the chain's end
            live |= y1 > x0
        first, end = first[live], end[live]
    for a, b in zip(first.tolist(), end.tolist()):
        if again[a:b].all() and xs[b - 1] + min_words <= done:
            continue  # a stretch that is covered; what may reach beyond its end is aligned
        # in a document that repeats itself the two ranges must not overlap
        x0, x1, y0, y1, matched, unsure = _align(u, v, xs[a:b], ys[a:b], k, apart=doc == src, more=more)
        if unsure:
            return [(doc, 0, 0, src, 0, 0, 0, True)]
        if x1 - x0 >= min_words and matched >= min_identity * max(x1 - x0, y1 - y0):
            rows.append((doc, x0 + x_from, x1 - x0, src, y0, y1 - y0, matched, False))
            done = max(done, x1)
    return rows


def _pair_weights(batches, buckets: int):
    for batch in batches:
        n = batch.num_rows
        key, at = np.unique(bucket_of(values(batch["src"], 0, n, np.int64), buckets), return_inverse=True)
        count = np.bincount(at, values(batch["chains"], 0, n, np.int32), len(key)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(key, pa.int32()), pa.array(count)], ["bucket", "n"])


def _bucket_rows(batches, buckets: int):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(bucket_of(np.asarray(batch["doc_id"]), buckets)),
                                          batch["doc_id"], batch["text"]], ["bucket", "doc_id", "text"])


def _meet(requests: DataFrame, weights: DataFrame, base: DataFrame, buckets: int, parts: int, unit: int) -> DataFrame:
    """Requests beside the texts of their source's bucket, in order of (bucket, salt, kind). A bucket of which
    more than ``unit`` is asked stands at several places, with its texts at each."""
    total = weights.agg(F.sum("n")).first()[0] or 0
    limit = max(unit, total // HOT_MOST)  # so at most HOT_MOST buckets are salted
    salts = F.broadcast(weights.filter(F.col("n") > limit).select("bucket", F.ceil(F.col("n") / limit).cast("int").alias("salts")))
    texts = base.mapInArrow(lambda it: _bucket_rows(it, buckets), "bucket int, doc_id long, text string")
    texts = texts.join(salts, "bucket", "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("salts").withColumn("kind", F.lit(0))
    asked = requests.join(salts, "bucket", "left").withColumn(
        "salt", F.pmod(F.xxhash64(*requests.columns), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts").withColumn("kind", F.lit(1))
    both = asked.unionByName(texts, allowMissingColumns=True)
    place = F.pmod(F.col("bucket").cast("long") + F.col("salt") * F.lit(7919), F.lit(parts)).cast("int")
    return both.repartitionById(parts, place).sortWithinPartitions("bucket", "salt", "kind")


def repeated_passages(docs: DataFrame, k: int = K, window: int = WINDOW, min_words: int = MIN_WORDS,
                      min_identity: float = MIN_IDENTITY, max_gap: int = MAX_GAP, bucket_bytes: int = BUCKET_BYTES,
                      unit: int = UNIT, margin: int = MARGIN) -> DataFrame:
    """Passages of ``docs(doc_id, text)`` of ``min_words`` words or more that stand, exactly or with
    edits, earlier in the corpus, in order of (doc_id, word).

    One row per passage and source: doc_id, start_word, n_words, src_doc_id, src_start_word,
    src_n_words, matched_words (words aligned as equal, at least ``min_identity`` of the longer
    side). Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. A document without repeats, a null
    or empty text and a row with a null id have no row. Rows that repeat an id count as one place
    (their common passages are no repeats). A very long text is handled whole, its words in the memory of
    one task at a time. Other columns are not read. An empty table gives an empty result.
    ``bucket_bytes``, ``unit`` and ``margin`` change the work, never the result.
    """
    ship_package(docs.sparkSession)
    if k + window - 1 > min_words:
        raise ValueError("windows must fit into a passage")
    base = docs.select("doc_id", "text").filter("doc_id is not null and text is not null")
    parts = shuffle_partitions(docs.sparkSession)
    size = base.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = max(parts, -(-size // bucket_bytes))

    def found(it):
        return _text_seeds(it, k, window)

    sample = base.filter(F.pmod(F.xxhash64("doc_id"), F.lit(HOT_SAMPLE)) == 0)
    seeded = _first_places(base, found, sample, found, buckets, parts, 0)
    placed = written(dealt(seeded, parts).mapInArrow(
        lambda it: _thinned_blocks(it, k, min_words, buckets), "kind int, " + _schema(["h", *_PLACED])), "anchors")
    windows = placed.filter("kind = 1").select("bucket", *_KEYED)
    late = _first_places(windows, _window_seeds, windows, lambda it: _window_seeds(it, HOT_SAMPLE), buckets, parts, 1)
    anchors = placed.filter("kind = 0").select("bucket", *_PLACED).unionByName(late)
    chained = written(dealt(anchors, parts).mapInArrow(lambda it: _chain_rows(it, max_gap, min_words, k), _CHAIN_ROW), "chains")
    # every chain is looked at with a few words around it
    own = chained.join(base.hint("merge"), "doc_id").select("doc_id", "text", *_CHAINS)
    weights = chained.mapInArrow(lambda it: _pair_weights(it, buckets), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    looks = own.mapInArrow(lambda it: _look_blocks(it, k, buckets), _schema(_LOOK))
    pairs = written(_meet(looks, weights, base, buckets, parts, unit).mapInArrow(
        lambda it: _look(it, min_words), "doc_id long, src long").distinct(), "pairs")

    def aligned(pairs: DataFrame, margin: int | None) -> DataFrame:
        needed = pairs.select("doc_id").union(pairs.select("src")).distinct()
        needed = F.broadcast(needed) if pairs.count() <= HOT_MOST else needed.hint("merge")
        texts = written(base.join(needed, "doc_id", "left_semi"), "passage-texts")
        want = pairs.groupBy("doc_id").agg(F.collect_list("src").alias("want"))
        own = chained.join(want.hint("merge"), "doc_id").join(texts.hint("merge"), "doc_id").select(
            "doc_id", "text", "want", *_CHAINS)
        weights = pairs.select("src").mapInArrow(lambda it: _source_weights(it, buckets), "bucket int, n long")
        weights = weights.groupBy("bucket").agg(F.sum("n").alias("n"))
        asks = own.mapInArrow(lambda it: _ask_rows(it, k, buckets, margin), _ASK_ROW)
        return written(_meet(asks, weights, texts, buckets, parts, max(unit // 64, 1)).mapInArrow(
            lambda it: _align_rows(it, k, min_words, min_identity),
            ", ".join(f"{c} long" for c in _SPAN_NAMES) + ", open boolean"), "passages")

    near = aligned(pairs, max(margin, WIDE))
    spans = near.filter("not open").drop("open")
    rest = written(near.filter("open").select("doc_id", F.col("src_doc_id").alias("src")).distinct(), "open-pairs")
    if not rest.isEmpty():  # passages that go on beyond the margin: with all words of their documents
        spans = spans.unionByName(aligned(rest, None).drop("open"))
    return spans.distinct()


def _source_weights(batches, buckets: int):
    for batch in batches:
        key, n = np.unique(bucket_of(np.asarray(batch["src"]), buckets), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(key, pa.int32()), pa.array(n, pa.int64())], ["bucket", "n"])


def _cut(batches):
    for batch in batches:
        out = []
        for text, spans in zip(batch["text"].to_pylist(), batch["spans"].to_pylist()):
            if text is not None and spans:
                raw = text.encode()
                data = np.frombuffer(raw, np.uint8)
                starts, ends, _ = word_spans(data, np.array([0, len(data)]))
                gone = np.zeros(len(data), bool)
                for s in spans:
                    gone[starts[s["start_word"]]:ends[min(s["start_word"] + s["n_words"], len(ends)) - 1]] = True
                text = data[~gone].tobytes().decode()
            out.append(text)
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(out, pa.string())], ["doc_id", "text"])


def cut_passages(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """``(doc_id, text)`` of all rows with the later copies of ``passages`` cut out of the texts."""
    ship_package(docs.sparkSession)
    spans = passages.groupBy("doc_id").agg(F.collect_set(F.struct("start_word", "n_words")).alias("spans"))
    return docs.select("doc_id", "text").join(spans, "doc_id", "left").select("doc_id", "text", "spans").mapInArrow(
        _cut, "doc_id long, text string")
