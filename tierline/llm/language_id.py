"""Language identification: each document as a mixture of languages, fitted by EM.

Learning counts hashed byte 3-grams a language over all labelled training rows. A document's 3-grams
g are drawn from a mixture sum_l pi_l P(g | l); expectation-maximisation estimates the proportions
pi. The language set is chosen by penalised likelihood: languages join in order of their
proportion as long as one more raises the log-likelihood by more than the penalty
``penalty * log(number of grams) / 2``. The label is the set's language with the largest
proportion, the score is that proportion.

The model has ``2**16`` numbers a language; it is the only thing that goes to the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import fold, freeing, pieces, ship_package, utf8

GRAMS = 1 << 16
SMOOTHING = 0.5
PENALTY = 3.0
ROUNDS = 10
HELD_OUT = (4, 2)
# The grams of a piece are held with numbers for every language.
PIECE_BYTES = 1 << 18
UNKNOWN = "und"

_LETTERS = np.zeros(256, bool)
_LETTERS[65:91] = _LETTERS[97:123] = True
# A-Z lower-cased, other ASCII a space, bytes of longer characters as they are
_FOLD = np.where(np.arange(256) < 128, np.where(_LETTERS, np.arange(256) | 32, 32), np.arange(256)).astype(np.uint8)


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed 3-grams of every text with a space before and after it, and each gram's document."""
    n = len(offsets) - 1
    padded = np.full(len(data) + 2 * n, 32, np.uint8)
    doc = np.repeat(np.arange(n), np.diff(offsets))
    padded[np.arange(len(data)) + 2 * doc + 1] = _FOLD[data]
    ends = offsets[1:] + 2 * np.arange(1, n + 1)
    inside = np.ones(len(padded), bool)
    inside[ends - 1] = False
    inside[ends - 2] = False
    at = np.flatnonzero(inside)
    a, b, c = padded[at].astype(np.uint32), padded[at + 1].astype(np.uint32), padded[at + 2].astype(np.uint32)
    code = a << 16 | b << 8 | c
    owner = np.repeat(np.arange(n), np.diff(offsets))
    ink = code != 0x202020
    return ((code * np.uint32(0x9E3779B1)) >> np.uint32(16))[ink], owner[ink]


def _count(batches):
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        data, offsets = utf8(batch["text"])
        names, which = np.unique(np.array(batch["lang"].to_pylist(), object).astype(str), return_inverse=True)
        for a, b in pieces(offsets, PIECE_BYTES):
            g, owner = grams(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            lang = which[a:b][owner]
            for k in np.unique(which[a:b]):
                name = str(names[k])
                if name not in sums:
                    sums[name] = np.zeros(GRAMS, np.int64)
                sums[name] += np.bincount(g[lang == k], minlength=GRAMS)
    for name, count in sums.items():
        full = np.flatnonzero(count)
        if not len(full):  # a language of texts without grams is still a learned value
            full = np.zeros(1, int)
        yield pa.RecordBatch.from_pydict({"lang": [name] * len(full), "gram": full, "n": count[full]}, schema=_COUNTS)


_COUNTS = pa.schema([("lang", pa.string()), ("gram", pa.int32()), ("n", pa.int64())])


class LanguageModel:
    """Languages in code-point order and log P(g | l), grams by languages."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        p = (counts + SMOOTHING) / (counts.sum(0, keepdims=True) + SMOOTHING * GRAMS)
        self.log_p = np.log(p).astype(np.float32)
        self.p = p.astype(np.float32)


def learn(docs: DataFrame) -> LanguageModel:
    """Count the 3-grams of all rows of ``docs(text, lang)`` whose lang is not null. Only sums a
    language and gram (at most ``GRAMS`` a language) reach the driver."""
    ship_package(docs.sparkSession)
    rows = docs.filter("lang is not null").select("text", "lang").mapInArrow(lambda it: freeing(_count(it)), "lang string, gram int, n long")
    got = rows.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(got["lang"].to_pylist()))
    counts = np.zeros((GRAMS, len(langs)))
    if langs:
        place = {x: i for i, x in enumerate(langs)}
        np.add.at(counts, (np.asarray(got["gram"]), [place[x] for x in got["lang"].to_pylist()]), np.asarray(got["n"]))
    return LanguageModel(langs, counts)


def _em(p: np.ndarray, n: np.ndarray, doc: np.ndarray, heads: np.ndarray, pi: np.ndarray, rounds: int):
    """Proportions after EM and the log-likelihood under them. ``pi`` (documents by languages) is
    the start; a zero stays zero, which restricts a document to its set."""
    total = np.add.reduceat(n, heads)[:, None]
    for _ in range(rounds):
        w = p * pi[doc]
        w *= (n / w.sum(1))[:, None]
        pi = np.add.reduceat(w, heads, axis=0) / total
    return pi, np.add.reduceat(n * np.log((p * pi[doc]).sum(1)), heads)


def mixtures(model: LanguageModel, data: np.ndarray, offsets: np.ndarray, penalty: float = PENALTY,
             rounds: int = ROUNDS) -> np.ndarray:
    """Language proportions of every text (zero outside its chosen set); a row of zeros for a text
    without grams."""
    out = np.zeros((len(offsets) - 1, len(model.langs)), np.float32)
    g, owner = grams(data, offsets)
    if not len(g) or not model.langs:
        return out
    key = np.sort(owner.astype(np.uint64) << np.uint64(16) | g.astype(np.uint64))
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    n = np.diff(np.append(first, len(key))).astype(np.float32)
    g, owner = (key[first] & np.uint64(0xFFFF)).astype(np.int64), (key[first] >> np.uint64(16)).astype(np.int64)
    docs, heads = np.unique(owner, return_index=True)
    doc = np.repeat(np.arange(len(docs)), np.diff(np.append(heads, len(owner))))
    p = model.p[g]
    start = np.full((len(docs), len(model.langs)), 1 / len(model.langs), np.float32)
    full, _ = _em(p, n, doc, heads, start, rounds)
    order = np.argsort(-full, axis=1, kind="stable")
    rank = np.argsort(order, axis=1)
    pi = (rank == 0).astype(np.float32)
    like = np.add.reduceat(n * model.log_p[g, order[doc, 0]], heads).astype(np.float64)
    cost = penalty * np.log(np.add.reduceat(n, heads)) / 2
    live = np.arange(len(docs))
    for m in range(2, len(model.langs) + 1):
        rows = np.isin(doc, live)
        sub = np.searchsorted(live, doc[rows])
        sub_heads = np.flatnonzero(np.concatenate([[True], sub[1:] != sub[:-1]]))
        # a little of every language of the set, so that the start excludes none
        begin = np.where(rank[live] < m, full[live] + np.float32(1e-3), 0).astype(np.float32)
        new, better = _em(p[rows], n[rows], sub, sub_heads, begin / begin.sum(1, keepdims=True), rounds)
        gain = better - like[live] > cost[live]
        pi[live[gain]], like[live[gain]] = new[gain], better[gain]
        live = live[gain]
        if not len(live):
            break
    out[docs] = pi
    return out


def _has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    seen = np.concatenate([[0], np.cumsum(_LETTERS[data])])
    yes = seen[offsets[1:]] > seen[offsets[:-1]]
    for d in np.flatnonzero(~yes & (np.diff(offsets) > 0)):
        yes[d] = any(c.isalpha() for c in data[offsets[d]:offsets[d + 1]].tobytes().decode("utf-8", "replace"))
    return yes


def _tell(arrays, m: LanguageModel):
    for texts in arrays:
        data, offsets = utf8(texts)
        langs, scores = [], []
        for a, b in pieces(offsets, PIECE_BYTES):
            part, cut = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
            pi, letters = mixtures(m, part, cut), _has_letter(part, cut)
            best = pi.argmax(1) if m.langs else np.zeros(b - a, int)
            for d in range(b - a):
                sure = letters[d] and len(m.langs) > 0
                langs.append(m.langs[best[d]] if sure else UNKNOWN)
                scores.append(min(1.0, float(pi[d, best[d]])) if sure else 0.0)
        yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                         ["lang_pred", "score"])


def labelled(text: Column, model: LanguageModel, spark) -> Column:
    """A struct (lang_pred, score) for each text: the language with the largest proportion of its
    mixture (the first in code-point order on ties), or ``und`` with score 0 if the text is null or
    has no letter, or if no language was learned."""
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(arrays):
        return freeing(_tell(arrays, shared.value))

    run.__annotations__ = {"arrays": Iterator[pa.Array], "return": Iterator[pa.Array]}
    # so marked, a filter on the result is not pushed below it, which would run the model twice a document
    return F.arrow_udf(run, "struct<lang_pred:string,score:double>").asNondeterministic()(text)


def identify(docs: DataFrame, held_out: tuple[int, int] = HELD_OUT) -> DataFrame:
    """Learn from the rows of ``docs(doc_id, text, lang)`` whose crc32(doc_id) mod held_out[0] is not
    held_out[1]; predict all from their text alone.

    One row per input row: doc_id, held_out, lang_pred, score. A null lang teaches nothing; a null
    id counts as remainder 0; an empty text, or one without a letter, is ``und``. Rows that repeat an
    id are rows of their own. Other columns are not read. An empty table gives an empty result.
    """
    out = fold(F.col("doc_id"), held_out[0]) == held_out[1]
    model = learn(docs.filter(~out))
    got = docs.select("doc_id", out.alias("held_out"), labelled(F.col("text"), model, docs.sparkSession).alias("x"))
    return got.select("doc_id", "held_out", "x.lang_pred", "x.score")


def keep_identified(docs: DataFrame, held_out: tuple[int, int] = HELD_OUT) -> DataFrame:
    """``docs`` without the rows whose language can't be told (``und``); columns as they were, but a null
    ``lang`` becomes the predicted language.

    Rows without text or letters go, however often they repeat; texts of any length are read whole; equal rows
    stay or go together. If no row teaches a language, none can be told and all go. An empty table stays empty.
    """
    model = learn(docs.filter(~(fold(F.col("doc_id"), held_out[0]) == held_out[1])))
    told = labelled(F.col("text"), model, docs.sparkSession)
    marked = docs.withColumn("_tl_language", told).filter(F.col("_tl_language.lang_pred") != UNKNOWN)
    return marked.select(*[F.coalesce("lang", "_tl_language.lang_pred").alias(c) if c == "lang" else F.col(c) for c in docs.columns])
