"""Operator 2 against a dictionary-based model."""

from __future__ import annotations

import math
from collections import Counter

import pytest
from llm_fixtures import EDGE_ROWS, read_documents, remainder, table, words

from conftest import SF_SMOKE
from tierline.llm.ngram_lm import score_documents


def model(rows, order, strength):
    """Interpolated scores by plain recursion, without states or failure arcs."""
    counts, unigrams, n_docs = [Counter() for _ in range(order)], Counter(), 0

    def tokens(text):
        return ["<s>"] * (order - 1) + words(text) + ["</s>"]

    for doc_id, text, *_ in rows:
        if remainder(doc_id, 5) == 1:
            continue
        n_docs += 1
        t = tokens(text)
        for i in range(order - 1, len(t)):
            for k in range(order):
                counts[k][tuple(t[i - k:i + 1])] += 1
    unigrams = counts[0]
    n, v = sum(unigrams.values()), len(unigrams)
    n1 = sum(1 for c in unigrams.values() if c == 1)
    unknown = 1.0 if n == 0 else (n1 + 0.5) / (n + 1)

    def p(gram):
        if len(gram) == 1:
            c = unigrams[gram]
            return (1 - unknown) * c / n if c else unknown
        h = gram[:-1]
        held = n_docs if set(h) == {"<s>"} else counts[len(h) - 1][h]
        return (counts[len(gram) - 1][gram] + strength * p(gram[1:])) / (held + strength)

    out = []
    for doc_id, text, *_ in rows:
        t = tokens(text)
        body = t[order - 1:]
        base = sum(math.log10((unigrams[(w,)] + 0.5) / (n + 0.5 * (v + 1))) for w in body)
        score = sum(math.log10(p(tuple(t[i - order + 1:i + 1]))) for i in range(order - 1, len(t)))
        out.append((doc_id, remainder(doc_id, 5) == 1, len(body), sum((w,) in unigrams for w in body), n, base, score))
    return out


def same(got, expected):
    key = lambda r: (str(r[0]), r[2], round(r[5], 4))
    got, expected = sorted(map(tuple, got), key=key), sorted(expected, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    for g, e in zip(got, expected):
        assert g[5:] == pytest.approx(e[5:], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_match_a_plain_model(spark, order):
    rows = read_documents(SF_SMOKE)[:120]
    got = score_documents(table(spark, rows), order=order, strength=50.0, chunk_bytes=20_000).collect()
    same(got, model(rows, order, 50.0))


def test_edge_cases_in_one_and_in_many_chunks(spark):
    for size in (1 << 24, 500):
        got = score_documents(table(spark, EDGE_ROWS), chunk_bytes=size).collect()
        same(got, model(EDGE_ROWS, 2, 300.0))


def test_probabilities_of_the_next_token_sum_to_one(spark):
    rows = [(i, "a b a c a b", "en", "s") for i in (0, 2, 3, 4)]
    train = [r for r in rows if remainder(r[0], 5) != 1]
    assert train
    # the next token after "a", over the vocabulary and one unknown class
    extra = [(100 + i, f"a {w}", "en", "s") for i, w in enumerate(["a", "b", "c", "zzz"])]
    extra = [(i, t, *r) for (i, t, *r) in extra]
    held = []
    i = 1000
    for _, text, *rest in extra:
        while remainder(i, 5) != 1:
            i += 1
        held.append((i, text, *rest))
        i += 1
    while remainder(i, 5) != 1:
        i += 1
    held.append((i, "a", "en", "s"))  # "a" and the end
    from tierline.llm.ngram_lm import ORDER
    expected = model(rows + held, ORDER, 300.0)
    got = {r["doc_id"]: r["score"] for r in score_documents(table(spark, rows + held)).collect()}
    for r in expected:
        assert got[r[0]] == pytest.approx(r[6])


def test_held_out_text_is_likelier_than_under_the_base(spark):
    rows = score_documents(spark.read.parquet(f"{SF_SMOKE}/documents.parquet")).filter("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_no_training_rows_and_empty_table(spark):
    held = next(i for i in range(100) if remainder(i, 5) == 1)
    row = score_documents(table(spark, [(held, "a b", "en", "s")])).first()
    assert (row["n_known"], row["train_tokens"], row["base_score"], row["score"]) == (0, 0, 0.0, 0.0)
    assert score_documents(table(spark, [])).count() == 0


def test_totals_beyond_four_bytes_are_exact():
    import numpy as np
    import pyarrow as pa

    from tierline.llm.ngram_lm import _answers, unpacked

    keys = np.array([5, 9], np.uint64).tobytes()
    t = pa.table({"shard": [0, 0], "chunk": [0, 1], "k": pa.array([1, 1], pa.int32()), "keys": pa.array([keys, keys], pa.binary()),
                  "counts": pa.array([np.array([3_000_000_000, 1], np.uint32).tobytes()] * 2, pa.binary())})
    got = _answers(t)
    assert [unpacked(x).tolist() for x in got["totals"].to_pylist()[:2]] == [[6_000_000_000, 2]] * 2
    assert got["n"].to_pylist()[-1] == 6_000_000_002
