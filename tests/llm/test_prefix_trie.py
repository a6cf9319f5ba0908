"""Operator 13 against a trie built turn by turn."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

from tierline.llm.prefix_trie import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, h1 string, n string, place string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "?", "?", "?", "?") for r in rows], SCHEMA)


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def by_hand(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append(((turn is not None, turn or 0, digest(role or "", text or "")), role or "", text or ""))
    convs = {c: [(r, t) for _, r, t in sorted(v)] for c, v in convs.items()}
    full = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        full[c] = tuple(convs.get(base, [])[:h] + own[h:])
    nodes = defaultdict(list)
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            nodes[turns[:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in nodes:
        if path:
            children[path[:-1]] += 1
    for path, members in nodes.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(members) - 1) * len(path[-1][1].encode()) if path else 0
    return sorted((min(m), len(p), min(nodes[p[:-1]]) if p else -1, len(m), children[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(c for c in m if full[c] == p))).encode()).hexdigest())
                  for p, m in nodes.items())


def got(spark, rows, **params):
    out = prefix_trie(frame(spark, rows), **params)
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(-1 if x is None else x for x in r) for r in out.collect())


def sampled(seed, n_convs, deepest, words=3):
    rng = random.Random(seed)
    rows = []
    for c in range(-6, n_convs):
        for turn in range(rng.randrange(0, deepest)):
            rows.append((c, turn, rng.choice(["user", "bot"]) if turn > 2 else "user", f"t{rng.randrange(words) if turn > 1 else 0}"))
    rng.shuffle(rows)
    return rows


def test_shared_prefixes(spark):
    rows = sampled(1, 60, 9)
    assert got(spark, rows) == by_hand(rows)


def test_bands_and_buckets_far_smaller_than_the_conversations(spark):
    rows = sampled(2, 25, 14) + [(7, t, "user", f"long {t % 3}") for t in range(20, 90)] + [
        (8, t, "user", f"long {t % 3}") for t in range(20, 70)]
    assert got(spark, rows, band=3, bucket_turns=40) == by_hand(rows)


def test_edge_cases(spark):
    rows = [(5, None, "user", "null turn first"), (5, 3, None, None), (5, 3, None, None), (5, 3, "", "tie"), (5, 1, "user", "ä" * 9),
            (6, None, None, None), (6, None, None, None), (9, 0, "user", "short"), (None, 1, "user", "no conversation"),
            (13, 1, "user", "x" * 300_000), (13, 2, "a:b", "c"), (14, 1, "a", ":bc"), (-7, 1, "user", "minus"), (-5, 1, "user", "base"),
            (10 ** 15, 1, "user", "far"), (10 ** 15 + 3, 1, "user", "far"), (10 ** 15 + 3, 2, "user", "x퟿中")]
    rows += [(c, t, "user", "same") for c in range(100, 140) for t in range(2)]
    rows = rows + rows[-8:]  # repeated rows stay
    assert got(spark, rows) == by_hand(rows)
    assert got(spark, rows, band=2, bucket_turns=5) == by_hand(rows)
    assert got(spark, []) == []
    assert got(spark, [(None, 1, "a", "b")]) == []
